"""A bitmap of bounded size of those hashes that several rows have."""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from accesstally.llm.workers import released

#: Hashes of a part, about, and bytes of all parts and of one at most.
PART_HASHES, BITMAP_BYTES, SLICE_BYTES = 1_000_000, 64_000_000, 1 << 19
#: Rows whose hashes are packed together.
ROWS = 2000


class Bitmap:
    """Two bits for each hash, in the slice of its part. It may hold more than was put in, never less."""

    def __init__(self, expected: float):
        """For about so many hashes, of which those of several rows are put in."""
        self.part_bits = max(1, int(np.ceil(np.log2(max(2, expected / PART_HASHES)))))
        bits = 8 * SLICE_BYTES
        while bits > 64 and (bits >> 3) << self.part_bits > BITMAP_BYTES:
            bits >>= 1
        self.slice_bits = int(np.log2(bits))
        self.data: np.ndarray | None = None

    def part(self, hashes: np.ndarray) -> np.ndarray:
        return (hashes >> np.uint64(64 - self.part_bits)).astype(np.int64)

    def rest(self, hashes: np.ndarray) -> np.ndarray:
        """48 bits behind the part."""
        return (hashes << np.uint64(self.part_bits)) >> np.uint64(16)

    def places(self, rest: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        one = (rest >> np.uint64(48 - self.slice_bits)).astype(np.int64)
        return one, (rest & np.uint64((1 << self.slice_bits) - 1)).astype(np.int64)

    def slice_of(self, rest: np.ndarray) -> bytes:
        own = np.zeros(1 << self.slice_bits, bool)
        for place in self.places(rest):
            own[place] = True
        return zlib.compress(np.packbits(own, bitorder="little").tobytes(), 1)

    def fill(self, slices: dict[int, bytes]) -> None:
        size = (1 << self.slice_bits) // 8
        self.data = np.zeros(size << self.part_bits, np.uint8)
        for part, own in slices.items():
            self.data[part * size : (part + 1) * size] = np.frombuffer(zlib.decompress(own), np.uint8)

    def has(self, hashes: np.ndarray) -> np.ndarray:
        base = self.part(hashes) << self.slice_bits
        hit = np.ones(len(hashes), bool)
        for place in self.places(self.rest(hashes)):
            at = base + place
            hit &= (self.data[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
        return hit


def of_several(rows: DataFrame, hashes_of: Callable[[pa.RecordBatch], list[np.ndarray]], expected: float) -> Bitmap:
    """The hashes that two rows or more have; ``hashes_of`` gives each row's 64-bit hashes, every one once."""
    return counted(rows.mapInArrow, hashes_of, expected)[0]


def counted(
    over: Callable[..., DataFrame], hashes_of: Callable, expected: float, crowd: int | None = None
) -> list[Bitmap]:
    """The hashes that several rows have and, with ``crowd``, those that occur so often.

    With ``crowd`` ``hashes_of`` gives rows' numbers in rising order and their hashes, which may repeat.

    ``over`` applies a function of Arrow batches to the rows, as a table's ``mapInArrow`` does.

    Rows send six bytes for a hash, packed by part, of every ``ROWS`` rows two at most, and what those leave
    out as a number beside it. Each part is sorted in one task and sends back its slices, so the driver gets
    ``BITMAP_BYTES`` at most for each bitmap. With more hashes than that tells apart, a bitmap holds more
    of those it should not.
    """
    bitmap = Bitmap(expected)
    bitmaps = [bitmap] if crowd is None else [bitmap, Bitmap(expected)]
    bits, parts = bitmap.part_bits, 1 << bitmap.part_bits
    kept_bits = ~np.uint64((1 << max(0, 16 - bits)) - 1)  # of part and rest
    schema = pa.schema([("part", pa.int32()), ("packed", pa.binary()), ("more", pa.binary())])
    slices = pa.schema([("part", pa.int32()), ("packed", pa.binary())])
    most = (1 << 16) - 1

    def cuts(values):
        return [*np.searchsorted(values, np.arange(parts, dtype=np.uint64) << np.uint64(64 - bits)).tolist(), len(values)]

    def pack(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                if crowd is None:
                    values = np.sort(np.concatenate([np.empty(0, np.uint64), *hashes_of(batch.slice(at, ROWS))]) & kept_bits)
                else:
                    row, every = hashes_of(batch.slice(at, ROWS))
                    order = np.argsort(every & kept_bits, kind="stable")
                    row, every = row[order], every[order] & kept_bits
                    new = np.ones(len(every), bool)
                    new[1:] = every[1:] != every[:-1]
                    first = new.copy()
                    first[1:] |= row[1:] != row[:-1]
                    values = every[first]
                keep = np.ones(len(values), bool)
                keep[2:] = values[2:] != values[:-2]  # two of each say as much as more
                values = values[keep]
                rest = np.ascontiguousarray(bitmap.rest(values).view(np.uint8).reshape(-1, 8)[:, :6])
                at_values, left, more = cuts(values), np.empty(0, np.uint64), [0] * (parts + 1)
                if crowd is not None and len(every) > len(values):
                    found, times = every[new], np.diff(np.append(np.flatnonzero(new), len(every)))
                    times -= np.searchsorted(values, found, "right") - np.searchsorted(values, found)
                    found, times = found[times > 0], np.minimum(times[times > 0], most).astype(np.uint64)
                    left, more = bitmap.rest(found) << np.uint64(16) | times, cuts(found)
                full = [i for i in range(parts) if at_values[i] < at_values[i + 1]]
                columns = [rest[at_values[i] : at_values[i + 1]].tobytes() for i in full], [left[more[i] : more[i + 1]].tobytes() for i in full]
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), *(pa.array(c, pa.binary()) for c in columns)], schema=schema)

    def count(batches):
        held = defaultdict(lambda: ([], []))
        for batch in batches:
            for part, packed, more in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                held[part][0].append(packed)
                held[part][1].append(more)
        for part, (packed, more) in held.items():
            values = np.zeros((sum(map(len, packed)) // 6, 8), np.uint8)
            values[:, :6] = np.frombuffer(b"".join(packed), np.uint8).reshape(-1, 6)
            values = np.sort(values.view(np.uint64).ravel())
            chosen = [values[1:][values[1:] == values[:-1]]]
            if crowd is not None:
                left = np.sort(np.frombuffer(b"".join(more), np.uint64))
                found, first = np.unique(left >> np.uint64(16), return_index=True)
                times = np.add.reduceat(left & np.uint64(most), first).astype(np.int64) if len(left) else np.empty(0, np.int64)
                times += np.searchsorted(values, found, "right") - np.searchsorted(values, found)
                by_rows = values[crowd - 1 :][values[crowd - 1 :] == values[: max(0, len(values) - crowd + 1)]]
                chosen.append(np.concatenate([by_rows, found[times >= crowd]]))
            numbers = [part * len(bitmaps) + i for i in range(len(bitmaps))]
            yield pa.RecordBatch.from_arrays([pa.array(numbers, pa.int32()), pa.array([bitmap.slice_of(c) for c in chosen], pa.binary())], schema=slices)

    packed = over(released(pack), "part int, packed binary, more binary").repartition(parts, "part")
    found = packed.mapInArrow(released(count), "part int, packed binary").collect()
    for i, one in enumerate(bitmaps):
        one.fill({r["part"] // len(bitmaps): bytes(r["packed"]) for r in found if r["part"] % len(bitmaps) == i})
    return bitmaps
