"""Removal of passages that repeat across documents, by suffix arrays of what may repeat.

Every 50-byte string of a text is known by its anchor, the span of ``GRAM`` bytes in it with the
smallest hash, so equal strings have equal anchors. Neighbouring strings with one anchor form a segment.

1. Texts that are equal as a whole form a class; its smallest number stands for it. Classes of several
   rows are found by hash; only their texts are gathered, and pre-aggregated before that.
2. Anchors of all classes are counted. Those of two classes or more are set in a bitmap with a bounded
   size, which may let others pass as well but misses none; so are those that occur ``CROWDED`` times.
3. Segments with a set anchor are gathered by anchor; of equal ones the smallest number counts. Tasks join
   the different segments of some anchors into one string, sort its rotations, and extend intervals of the
   Burrows-Wheeler transform backward, breadth first: an interval of a word of n bytes gives those of the
   words with one byte more in front, and ends of intervals that no shorter word has separate rows with n
   bytes in common. At 50 bytes it stops, and what no end separates is one repeated string.
   An anchor that occurs very often is not given to one task with all its segments: they are pre-aggregated,
   and the different ones judged in the same way. Only where these are very many too, which texts of one
   byte do not make but texts of few different bytes can, are their strings aggregated one by one.
4. Strings that start under a smaller number come back to their class, and to its rows, and the bytes
   they cover are removed.

Nothing is collected but bitmaps. Cases: null and empty texts and texts under 50 bytes lose nothing.
A row without a number is no document with a smaller number and loses nothing. Rows that share a number
do not repeat each other; rows with equal text under a larger number lose all of it. Extra columns are
ignored.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from accesstally.llm.bitmap import counted, of_several
from accesstally.llm.hashing import gram_hashes
from accesstally.llm.workers import importable, released
from accesstally.sources.scratch import scratch_path, written

LENGTH = 50
GRAM = 20
#: Strings that can share an anchor where it stands.
SPAN = LENGTH - GRAM + 1
#: Bytes of text for an anchor, about.
ANCHOR_EVERY = 16
#: Bytes of segments that are judged together.
BLOCK = 1_000_000
#: An anchor that occurs so often is crowded; of others one task holds fewer segments.
CROWDED = 4096
#: Segments that are one in so many of the crowded ones are no more than that, so they are broadcast.
HOT = 10_000
#: Longer texts are anchored in pieces, which overlap by a string less one byte.
PIECE = 1 << 23
#: Bytes of short texts that are anchored in one call.
TOGETHER = 1 << 16

_LOW = np.uint64(0xFFFFFF)


def _segments(piece: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, ...]:
    """Row, anchor hash, first string and end of strings of the segments of rows that follow each other in a piece.

    Where spans in a row have one hash, as in a run of one byte, their strings are cut at every ``SPAN``.
    """
    counts = np.maximum(ends - starts - LENGTH + 1, 0)
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    grams = gram_hashes(piece, GRAM)
    # the place in the low bits: the smallest value is the leftmost of the smallest hashes
    least, width = (grams & ~_LOW) | np.arange(len(grams), dtype=np.uint64), 1
    while 2 * width <= SPAN:
        least, width = np.minimum(least[:-width], least[width:]), 2 * width
    if width < SPAN:
        least = np.minimum(least[: len(least) - (SPAN - width)], least[SPAN - width :])
    string = np.arange(total) + np.repeat(starts - np.cumsum(counts) + counts, counts)
    row = np.repeat(np.arange(len(starts)), counts)
    place = (least[string] & _LOW).astype(np.int64)
    new_row = row[1:] != row[:-1]
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | new_row]))
    anchor, of_row = grams[place[first]], row[first]
    other = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (of_row[1:] != of_row[:-1])])
    anchor, of_row, first = anchor[other], of_row[other], first[other]
    sizes = np.concatenate([first[1:], [total]]) - first
    cuts = (sizes + SPAN - 1) // SPAN
    nth = np.arange(cuts.sum()) - np.repeat(np.cumsum(cuts) - cuts, cuts)
    begin = np.repeat(string[first], cuts) + SPAN * nth
    end = np.minimum(begin + SPAN, np.repeat(string[first] + sizes, cuts))
    return np.repeat(of_row, cuts), np.repeat(anchor, cuts), begin, end


def anchors(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first string and end of strings of every segment of a text."""
    found = []
    for at in range(0, max(1, len(data) - LENGTH + 1), PIECE):
        piece = data[at : at + PIECE + LENGTH - 1]
        _, anchor, first, end = _segments(piece, np.array([0]), np.array([len(piece)]))
        found.append((anchor, first + at, end + at))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _all_anchors(column: pa.Array) -> tuple[np.ndarray, ...]:
    """Row, anchor hash, first string and end of strings in its row, of all segments of a column of texts.

    Short texts are taken together, so that a call's own time does not count.
    """
    offsets = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    found, row = [], 0
    while row < len(column):
        end_row = max(row + 1, int(np.searchsorted(offsets, offsets[row] + TOGETHER, "right")) - 1)
        piece = data[offsets[row] : offsets[end_row]]
        if end_row == row + 1:
            anchor, first, end = anchors(piece)
            found.append((np.full(len(anchor), row), anchor, first, end))
        else:
            starts = offsets[row : end_row + 1] - offsets[row]
            own, anchor, first, end = _segments(piece, starts[:-1], starts[1:])
            found.append((own + row, anchor, first - starts[own], end - starts[own]))
        row = end_row
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _rows(documents: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id, data, and hash and size that name the class."""
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    return documents.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        body.cast("binary").alias("data"),
        F.xxhash64(body).alias("class"),
        F.octet_length(body).alias("size"),
    )


def _anchors_of(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return _all_anchors(batch.column("data"))[:2]


def _rotations(data: np.ndarray) -> np.ndarray:
    """The rotations of a string, by their first 50 bytes at least."""
    n = len(data)
    around = np.resize(data, n + LENGTH + 14).astype(np.uint64)
    eight = np.zeros(n + LENGTH + 7, np.uint64)
    for i in range(8):
        eight = eight << np.uint64(8) | around[i : i + len(eight)]
    known, rank = np.unique(eight, return_inverse=True)
    width = max(1, len(known).bit_length())
    each = 63 // width  # ranks of eight bytes that fit into one sort key
    keys = []
    for at in range(0, LENGTH, 8 * each):
        key = np.zeros(n, np.int64)
        for i in range(at, min(at + 8 * each, LENGTH), 8):
            key = key << width | rank[i : i + n]
        keys.append(key)
    return np.lexsort(keys[::-1])


def _separate(data: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Whether a row of the sorted rotations differs from the one before within 50 bytes.

    An interval holds the rows that start with one word. The places where its last bytes, those of the transform,
    hold c become, by rank, the interval of the word with c in front. An end found at the word of n + 1 bytes
    and not before has n bytes in common with the row behind it; intervals whose end is known find nothing new.
    """
    n = len(data)
    last = data[order - 1]
    rows = np.argsort(last, kind="stable").astype(np.int32)
    rank = np.empty(n, np.int32)
    rank[rows] = np.arange(n, dtype=np.int32)
    before, after = np.full(n, -1, np.int32), np.full(n, n, np.int32)
    same = np.flatnonzero(last[rows[1:]] == last[rows[:-1]])
    before[rows[same + 1]], after[rows[same]] = rows[same], rows[same + 1]
    known = np.zeros(n + 1, bool)
    known[[0, n]] = True
    low, high = np.array([0]), np.array([n])
    for _ in range(LENGTH):
        sizes = high - low
        ends = np.cumsum(sizes)
        at = np.arange(ends[-1]) + np.repeat(low - ends + sizes, sizes)
        # a byte's first and last place in an interval lead to the first and last row of the new one
        first = np.sort(rank[at[before[at] < np.repeat(low, sizes)]])
        end = np.sort(rank[at[after[at] >= np.repeat(high, sizes)]]) + 1
        new = ~known[end]
        low, high = first[new], end[new]
        known[high] = True
        if not len(low):
            break
    return known[:n]


def repeated(texts: list[bytes], numbers: list[int]) -> list[int]:
    """For each segment a bit for each of its strings that also starts in one with a smaller number.

    All segments are one string with a zero byte behind each; a string holds no end of a segment, so what
    rotations have in common across ends is of no account.
    """
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"\0".join(texts) + b"\0", np.uint8)
    order = _rotations(data)
    group = np.cumsum(_separate(data, order)) - 1
    starts = np.concatenate([[0], np.cumsum(sizes + 1)])
    owner = np.repeat(np.arange(len(texts)), sizes + 1)
    place = np.arange(len(data)) - starts[owner]
    is_string = place <= sizes[owner] - LENGTH
    valid = is_string[order]
    rows, group = order[valid], group[valid]
    number = np.asarray(numbers, np.int64)[owner[rows]]
    least = np.full(int(group.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, group, number)
    hit = rows[least[group] < number]
    bits = np.zeros(len(texts), np.int64)
    np.bitwise_or.at(bits, owner[hit], np.int64(1) << place[hit])
    return bits.tolist()


_OCCURRENCE = "anchor long, class long, size int, number long, at int, segment binary"


def _judge(held: list[tuple]) -> list[tuple[int, int, int, int]]:
    """(class, size, at, bits) of those occurrences, sorted by anchor, that hold strings known under a smaller number."""
    least: dict[tuple[int, bytes], int] = {}
    for anchor, _, _, number, _, segment in held:
        key = (anchor, segment)
        if number < least.get(key, number + 1):
            least[key] = number
    several = Counter(anchor for anchor, _ in least)
    # equal segments need no comparison, nor does an anchor with one segment
    mixed = [key for key in least if several[key[0]] > 1]
    bits = dict(zip(mixed, repeated([k[1] for k in mixed], [least[k] for k in mixed]), strict=True)) if mixed else {}
    found = []
    for anchor, name, size, number, at, segment in held:
        key = (anchor, segment)
        own = (1 << (len(segment) - LENGTH + 1)) - 1 if number > least[key] else bits.get(key, 0)
        if own:
            found.append((name, size, at, own))
    return found


def _hits(occurrences: DataFrame, parts: int) -> DataFrame:
    """Class, size, at and bits of strings to remove, for anchors that are not crowded."""
    out = pa.schema([("class", pa.int64()), ("size", pa.int32()), ("at", pa.int32()), ("bits", pa.int32())])

    def judged(batches):
        held, size, last = [], 0, None

        def done():
            found = _judge(held)
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in enumerate(out.types)], schema=out)

        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                for row in zip(*(part.column(i).to_pylist() for i in range(6)), strict=True):
                    if size > BLOCK and row[0] != last:
                        yield done()
                        held, size = [], 0
                    held.append(row)
                    size += len(row[5])
                    last = row[0]
        if held:
            yield done()

    dealt = occurrences.repartition(parts, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(released(judged), "class long, size int, at int, bits int")


def _different(segments: DataFrame, parts: int) -> DataFrame:
    """Anchor, key and known strings, as bits, of different segments with the smallest number of each."""
    out = pa.schema([("anchor", pa.int64()), ("key", pa.int64()), ("known", pa.int32())])

    def judged(batches):
        held, size = [], 0

        def done():
            bits = repeated([h[3] for h in held], [h[2] for h in held])
            found = [(anchor, key, own) for (anchor, key, _, _), own in zip(held, bits, strict=True) if own]
            return pa.RecordBatch.from_arrays([pa.array([f[i] for f in found], kind) for i, kind in enumerate(out.types)], schema=out)

        for batch in batches:
            for row in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                if size > BLOCK and row[0] != held[-1][0]:
                    yield done()
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield done()

    dealt = segments.select("anchor", "key", "least", "segment").repartition(parts, "anchor").sortWithinPartitions("anchor")
    return dealt.mapInArrow(released(judged), "anchor long, key long, known int")


def _crowded_hits(occurrences: DataFrame, parts: int) -> DataFrame:
    """The same for crowded anchors: equal segments first, then the different ones of an anchor.

    Segments that hold a great part of the occurrences are few and go to these, so none meets in one task.
    """
    spark = occurrences.sparkSession
    keyed = occurrences.withColumn("key", F.xxhash64("segment")).withColumn("length", F.octet_length("segment"))
    segments = keyed.groupBy("anchor", "key", "segment").agg(F.min("number").alias("least"), F.count("*").alias("n"))
    segments = written(segments, scratch_path(spark, "segments"))
    total = segments.agg(F.sum("n")).first()[0] or 0
    anchors_of = segments.groupBy("anchor").agg(F.count("*").alias("different")).filter("different > 1")
    several = segments.join(anchors_of, "anchor")
    known = _different(several.filter(F.col("different") < CROWDED), parts)

    starts = F.sequence(F.lit(1), F.octet_length("segment") - LENGTH + 1)
    each = F.transform(starts, lambda i: F.substring("segment", i, F.lit(LENGTH)))
    strings = several.filter(F.col("different") >= CROWDED).select("anchor", "key", "least", F.posexplode(each).alias("place", "string"))
    first = strings.groupBy("string").agg(F.min("least").alias("first"), F.count("*").alias("n")).filter("n > 1").drop("n")
    one_by_one = strings.join(first, "string").filter("first < least").groupBy("anchor", "key").agg(F.bit_or(F.expr("shiftleft(1, place)")).alias("known"))

    judged = segments.select("anchor", "key", "least", "n").join(known.unionByName(one_by_one), ["anchor", "key"], "left")
    judged = written(judged.filter("n > 1 OR known IS NOT NULL"), scratch_path(spark, "judged"))
    is_hot = F.col("n") * HOT >= F.lit(total)
    hot, rest = judged.filter(is_hot).drop("n"), judged.filter(~is_hot).drop("n")
    places = keyed.select("anchor", "key", "class", "size", "number", "at", "length")
    others = places.join(F.broadcast(hot.select("anchor", "key")), ["anchor", "key"], "left_anti")
    met = places.join(F.broadcast(hot), ["anchor", "key"]).unionByName(others.join(rest, ["anchor", "key"]))
    every = F.expr(f"cast(shiftleft(1L, length - {LENGTH - 1}) - 1 AS int)")
    bits = F.when(F.col("number") > F.col("least"), every).otherwise(F.coalesce("known", F.lit(0)))
    return met.select("class", "size", "at", bits.alias("bits")).filter("bits != 0")


def find_repeats(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """Classes of several rows (class, size, number), and by class the places (at, bits) of strings to remove."""
    spark = importable(documents.sparkSession)
    rows = _rows(documents, text, doc_id).filter(F.col("doc_id").isNotNull() & (F.col("size") >= LENGTH))
    keys = rows.groupBy("class", "size").agg(F.min("doc_id").alias("number"), F.count("*").alias("n"))
    keys = written(keys, scratch_path(spark, "classes"))
    totals = keys.agg(F.sum(F.col("size").cast("double")).alias("bytes"), F.sum("n").alias("rows")).first()
    several = keys.filter("n > 1").select("class", "size", "number")

    # classes of several rows, marked in a bitmap like anchors; their texts alone are gathered
    hashes = lambda batch: [np.asarray(x.values).view(np.uint64) for x in batch.column(0)]
    marked = spark.sparkContext.broadcast(of_several(rows.select(F.array("class")), hashes, float(totals["rows"] or 0)))

    def chosen(batches, yes):
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                part = batch.slice(at, 2000)
                hit = marked.value.has(np.asarray(part.column("class")).view(np.uint64)) == yes
                part = part.filter(pa.array(hit, pa.bool_()))
                if part.num_rows:
                    yield part

    schema = "doc_id long, data binary, class long, size int"
    copies = rows.mapInArrow(lambda batches: chosen(batches, True), schema).groupBy("class", "size")
    copies = copies.agg(F.min("doc_id").alias("doc_id"), F.first("data").alias("data")).select("doc_id", "data", "class", "size")
    copies = written(copies, scratch_path(spark, "copies"))

    def over_classes(function, out):
        """A function of batches over one row of each class, in one Python worker for each task."""
        return rows.mapInArrow(released(lambda batches: function(chosen(batches, False))), out).unionByName(copies.mapInArrow(released(function), out))

    shared, crowded = counted(over_classes, _anchors_of, (totals["bytes"] or 0) / ANCHOR_EVERY, CROWDED)
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 1 << shared.part_bits)
    any_crowded = bool(crowded.data.any())
    shared, crowded = spark.sparkContext.broadcast(shared), spark.sparkContext.broadcast(crowded)

    def occurrences(many):
        """Segments with a shared anchor, those that are crowded or the others."""
        schema = pa.schema([("anchor", pa.int64()), ("class", pa.int64()), ("size", pa.int32()), ("number", pa.int64()), ("at", pa.int32()), ("segment", pa.binary())])

        def cut(batches):
            for batch in batches:
                for start in range(0, batch.num_rows, 500):
                    part = batch.slice(start, 500)
                    body = part.column("data")
                    row, anchor, first, end = _all_anchors(body)
                    keep = shared.value.has(anchor)
                    if any_crowded:
                        keep &= crowded.value.has(anchor) == many
                    row, anchor, first, end = row[keep], anchor[keep], first[keep], end[keep]
                    texts = body.to_pylist()
                    segments = [texts[i][a : b + LENGTH - 1] for i, a, b in zip(row.tolist(), first.tolist(), end.tolist(), strict=True)]
                    own = [part.column(name).take(pa.array(row)) for name in ("class", "size", "doc_id")]
                    columns = [pa.array(anchor.view(np.int64)), *own, pa.array(first.astype(np.int32)), pa.array(segments, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, schema=schema)

        return over_classes(cut, _OCCURRENCE)

    hits = _hits(occurrences(False), parts)
    if any_crowded:
        hits = hits.unionByName(_crowded_hits(written(occurrences(True), scratch_path(spark, "crowded")), parts))
    # plain rows are shuffled, a third of what partly collected lists take
    hits = hits.repartition("class", "size").groupBy("class", "size").agg(F.collect_list(F.struct("at", "bits")).alias("hits"))
    return several, hits


def spans(size: int, hits: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The maximal runs of bytes that the marked strings cover."""
    change = np.zeros(size + LENGTH + 1, np.int64)
    at = np.array([h[0] for h in hits], np.int64)
    bits = np.array([h[1] for h in hits], np.int64)
    for i in range(SPAN):
        starts = at[(bits >> i) & 1 == 1] + i
        np.add.at(change, starts, 1)
        np.add.at(change, starts + LENGTH, -1)
    covered = np.concatenate([[False], np.cumsum(change[:size]) > 0, [False]])
    edges = np.flatnonzero(covered[1:] != covered[:-1])
    return list(zip(edges[::2].tolist(), edges[1::2].tolist(), strict=True))


def remove(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, size, the removed spans [(start, end)] and the kept bytes of every row."""
    import zstandard

    several, hits = find_repeats(documents, text, doc_id)
    known = several.withColumnRenamed("number", "least").join(hits, ["class", "size"], "full_outer")
    packed = pa.schema([("doc_id", pa.int64()), ("data", pa.binary()), ("class", pa.int64()), ("size", pa.int32())])
    schema = "doc_id long, data binary, class long, size int"

    def pack(batches):
        press = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                data = pa.array([press.compress(d) for d in part.column(1).to_pylist()], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0), data, part.column(2), part.column(3)], schema=packed)

    cut = pa.schema([("doc_id", pa.int64()), ("size", pa.int32()), ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32())), ("kept", pa.binary())])

    def cut_out(batches):
        expand = zstandard.ZstdDecompressor()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                found = []
                for row in batch.slice(at, 500).to_pylist():
                    size, data = row["size"], expand.decompress(row["data"]) if row["size"] else b""
                    number = row["doc_id"]
                    if number is None or size < LENGTH:
                        gone = []
                    elif row["least"] is not None and number > row["least"]:
                        gone = [(0, size)]
                    else:
                        gone = spans(size, list(zip(row["at"], row["bits"], strict=True))) if row["at"] else []
                    kept, last = [], 0
                    for a, b in gone:
                        kept.append(data[last:a])
                        last = b
                    kept.append(data[last:])
                    found.append((number, size, [g[0] for g in gone], [g[1] for g in gone], b"".join(kept)))
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*found, strict=True), cut, strict=True)], schema=cut)

    rows = _rows(documents, text, doc_id).mapInArrow(released(pack), schema)
    joined = rows.join(known, ["class", "size"], "left").select("doc_id", "data", "size", "least", F.col("hits.at").alias("at"), F.col("hits.bits").alias("bits"))
    return joined.mapInArrow(released(cut_out), "doc_id long, size int, starts array<int>, ends array<int>, kept binary")


def report(removed: DataFrame) -> DataFrame:
    return removed.select(
        "doc_id",
        F.col("size").cast("long").alias("n_bytes"),
        (F.col("size") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("starts").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_repeats(spark, sf_dir):
    return report(remove(spark.read.parquet(f"{sf_dir}/documents.parquet")))


OP6_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT r, doc_id, i, h[2 * i + 1 : 2 * i + 100] AS s
      FROM (SELECT r, doc_id, h, unnest(range(0, len(h) // 2 - 49)) AS i FROM d WHERE len(h) >= 100 AND doc_id IS NOT NULL)),
m AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s),
c AS (SELECT r, i FROM w JOIN m USING (s) WHERE doc_id > least),
g AS (SELECT r, i, lag(i) OVER (PARTITION BY r ORDER BY i) AS p FROM c),
j AS (SELECT r, i, sum((p IS NULL OR i > p + 50)::INT) OVER (PARTITION BY r ORDER BY i) AS k FROM g),
s AS (SELECT r, k, min(i) AS a, max(i) + 50 AS z FROM j GROUP BY r, k),
o AS (SELECT r, a, z, lag(z, 1, 0) OVER (PARTITION BY r ORDER BY a) AS before FROM s),
q AS (SELECT o.r, count(*) AS n, sum(z - a) AS gone, max(z) AS last,
        string_agg(h[2 * before + 1 : 2 * a], '' ORDER BY a) AS kept FROM o JOIN d USING (r) GROUP BY o.r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(gone, 0)::BIGINT AS n_removed, coalesce(n, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, '') || h[2 * coalesce(last, 0) + 1 :])) AS kept_sha256
FROM d LEFT JOIN q USING (r)
"""
