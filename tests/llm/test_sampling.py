"""Shards, vector codes and resampling against plain versions, on awkward tables."""

import hashlib
import itertools
import math
import random
import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from accesstally.llm import resampling, sharding, vector_codes
from tests.llm import brute
from tests.llm.test_operators import awkward, plain


def plain_shards(rows, shards):
    """rows: (doc_id, text); per row shard and slot, rows in order of number, size and digest."""
    found = sorted(
        ((i is not None, i or 0, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    )
    total, earlier, slots, out = sum(r[2] for r in found), 0, {}, []
    for known, i, size, digest in found:
        middle = Fraction(2 * earlier + size, 2)
        shard = max(k for k in range(shards) if middle >= Fraction(k * total, shards))
        slots[shard] = slots.get(shard, -1) + 1
        out.append((i if known else None, size, digest, shard, slots[shard]))
        earlier += size
    return sorted(out, key=repr)


def digests(frame):
    digest = F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("crc")
    return frame.select("*", sharding.text_size(F.col("text")).alias("bytes"), digest)


@pytest.mark.parametrize("shards", [1, 2, 8, 50])
def test_shards(spark, shards):
    rows, _, frame = awkward(spark)
    frame = digests(frame).withColumns({"part": F.lit(1), "own": F.lit(2), "place": F.lit(3), "shard": F.lit(9)})
    found = sharding.sharded(frame, F.col("bytes"), [F.col("doc_id"), F.col("bytes"), F.col("crc")], shards)
    assert found.columns == [c for c in frame.columns if c != "shard"] + ["shard", "slot"]
    assert plain(found, "doc_id", "bytes", "crc", "shard", "slot") == plain_shards(rows, shards)


def test_shards_of_equal_and_of_huge_rows(spark):
    same = [(7, "x" * 40)] * 300 + [(i, "y") for i in range(200)]
    huge = [(i, "z" * (100_000 if i == 5 else 3)) for i in range(40)]
    for rows in (same, huge):
        frame = digests(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
        found = sharding.sharded(frame, F.col("bytes"), [F.col("doc_id"), F.col("bytes"), F.col("crc")], 8)
        assert plain(found, "doc_id", "bytes", "crc", "shard", "slot") == plain_shards(rows, 8)
    # no shard is further from an eighth of all bytes than its largest row
    sizes = [r["sum(bytes)"] for r in sharding.sharded(digests(spark.createDataFrame(same, "doc_id long, text string")), F.col("bytes"), [F.col("doc_id")]).groupBy("shard").sum("bytes").collect()]
    assert len(sizes) == 8 and max(sizes) - min(sizes) <= 2 * 41


def test_written_shards(spark, tmp_path):
    rows, _, frame = awkward(spark)
    sharding.write_shards(frame, f"{tmp_path}/shards", 4)
    again = spark.read.parquet(f"{tmp_path}/shards")
    assert plain(again, "doc_id", "text") == sorted(rows, key=repr)
    for shard, each in itertools.groupby(sorted((r["shard"], r["slot"]) for r in again.collect()), key=lambda r: r[0]):
        assert [slot for _, slot in each] == list(range(sum(r["shard"] == shard for r in again.collect())))


def plain_codes(rows, parts=16, entries=64, rounds=2):
    """rows: (vec_id, vector, label), usable ones; all entries compared in every round."""
    whole = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows]
    whole.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = len(whole[0][1]) // parts
    books = [[r[1][p * w : (p + 1) * w] for r in whole[:entries]] for p in range(parts)]
    apart = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b, strict=True))
    for turn in range(rounds + 1):
        near = [[min((apart(r[1][p * w : (p + 1) * w], e), k) for k, e in enumerate(books[p])) for p in range(parts)] for r in whole]
        if turn < rounds:
            for p in range(parts):
                for k in range(len(books[p])):
                    own = [r[1][p * w : (p + 1) * w] for r, n in zip(whole, near, strict=True) if n[p][1] == k]
                    if own:
                        books[p][k] = [sum(c) // len(own) for c in zip(*own, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    errors = [sum(d for d, _ in n) for n in near]
    by_label = {}
    for r, e in zip(whole, errors, strict=True):
        by_label[r[2]] = by_label.get(r[2], 0) + e
    return sorted([(r[0], "".join(f"{k:02x}" for _, k in n), e, by_label[r[2]], digest) for r, n, e in zip(whole, near, errors, strict=True)], key=repr)


@pytest.mark.parametrize("n", [1, 30, 64, 260])
def test_vector_codes(spark, n):
    rng = random.Random(n)
    # few different values, so that equally near entries and unused ones are common
    rows = [(i, [rng.choice([-0.01, 0.0, 0.003, 0.5, -1.5]) for _ in range(32)], rng.choice([None, 1, 2])) for i in range(n)]
    rows += [(0, rows[0][1], 1), (None, rows[-1][1], None), (None, rows[0][1], 2)]
    rng.shuffle(rows)
    bad = [(900, None, 1), (901, [], 1), (902, [float("nan")] * 32, 1), (903, [None] * 32, 1), (904, [float("-inf")] * 32, 2), (905, [1.0] * 16, 1)]
    frame = spark.createDataFrame(rows + bad, "vec_id long, embedding array<double>, label int").repartition(4)
    frame = frame.withColumns({"code": F.lit(1), "vector": F.lit(2), "distance": F.lit(3), "of": F.lit(4), "error": F.lit(5)})
    codes, books = vector_codes.compress(frame)
    found = vector_codes.report(codes, books)
    want = plain_codes(rows)
    assert plain(found, "vec_id", "code", "error", "label_error", "codebooks_sha256") == want
    errors = {r[0]: r[2] for r in want}
    decoded = {r.vec_id: r.vector for r in vector_codes.decode(codes, books).collect()}
    for i, v, _ in rows:
        if i not in (0, None):
            error = sum((math.floor(256 * x) - round(256 * y)) ** 2 for x, y in zip(v, decoded[i], strict=True))
            assert error == errors[i]


def test_active_entries_find_what_all_entries_find():
    rng = np.random.default_rng(3)
    for _ in range(300):
        parts, book = rng.integers(-3, 4, (20, 2)), rng.integers(-3, 4, (6, 2))
        code, distance = vector_codes.full_scan(parts, book)
        moved = book + rng.integers(-1, 2, book.shape) * rng.integers(0, 2, (6, 1))
        got = vector_codes.reassigned(parts, moved, (moved != book).any(axis=1), code, distance)
        want = vector_codes.full_scan(parts, moved)
        assert (got[0] == want[0]).all() and (got[1] == want[1]).all()


def test_components_that_do_not_fit_are_refused(spark):
    frame = spark.createDataFrame([(1, [1e30] * 16, 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="are not supported"):
        vector_codes.compress(frame)


def plain_features(text):
    w = brute.words(text)
    return w, [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def plain_resampling(rows, target):
    bucket = lambda f: zlib.crc32(f.encode()) % 10_000
    counts = []
    for texts in ([t for _, t in rows], target):
        n = [0] * 10_000
        for f in itertools.chain.from_iterable(plain_features(t)[1] for t in texts):
            n[bucket(f)] += 1
        counts.append(n)
    s, t = counts
    gain = [math.floor(1000 * math.log((b + 1) * (sum(s) + 10_000) / ((a + 1) * (sum(t) + 10_000)))) for a, b in zip(s, t, strict=True)]
    out = []
    for i, text in rows:
        w, found = plain_features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in found)
        out.append([i, len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(w)])
    eligible = sorted((r for r in out if r[-1] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[1]))
    for rank, r in enumerate(eligible[: 5 * len(eligible) // 100], 1):
        r[4] = rank
    return sorted([tuple(r[:-1]) for r in out], key=repr)


def test_resampling(spark, tmp_path):
    rows, passage, frame = awkward(spark)
    rng = random.Random(2)
    vocabulary = ["alpha", "beta", "über", "x", "longerword" * 30, "日本"]
    more = [(1000 + i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([0, 2, 19, 20, 21, 40])))) for i in range(300)]
    more += [(2000, "same words " * 15)] * 40  # equal scores and numbers
    everything = frame.unionByName(spark.createDataFrame(more, "doc_id long, text string"), allowMissingColumns=True)
    everything.withColumns({"own": F.lit(1), "rank": F.lit(2), "weight": F.lit(3), "bucket": F.lit(4)}).write.parquet(f"{tmp_path}/documents.parquet")
    target = [passage, None, "", "alpha beta alpha", "x"]
    spark.createDataFrame([(i, t) for i, t in enumerate(target)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    found = resampling.op13_resampling(spark, str(tmp_path))
    want = plain_resampling(rows + more, target)
    assert plain(found, "doc_id", "n_features", "weight", "score", "rank") == want
    documents = spark.read.parquet(f"{tmp_path}/documents.parquet")
    drawn = resampling.resample(documents, spark.read.parquet(f"{tmp_path}/benchmark.parquet"))
    assert set(documents.columns) < set(drawn.columns)
    assert plain(drawn, "doc_id", "rank") == sorted(((r[0], r[4]) for r in want if r[4] is not None), key=repr)
    assert all(r.text for r in drawn.collect())


def test_checksums_of_joined_texts():
    rng = random.Random(1)
    first = [rng.randbytes(rng.choice([0, 1, 7, 300])) for _ in range(200)]
    second = [rng.randbytes(rng.choice([1, 2, 3, 255, 70_000])) for _ in range(200)]
    sums = lambda texts: np.array([zlib.crc32(t) for t in texts], np.uint32)
    got = resampling.joined_sums(sums(first), sums(second), np.array([len(t) for t in second]))
    assert got.tolist() == [zlib.crc32(a + b) for a, b in zip(first, second, strict=True)]


def test_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(resampling, "PIECE", 10)
    batch = pa.RecordBatch.from_pydict({"t": pa.array(["aaaa", None, "bbbb", "c" * 50, "", "d"], pa.string())})
    assert [p.column(0).to_pylist() for p in resampling.pieces(batch, 0)] == [["aaaa", None, "bbbb"], ["c" * 50], ["", "d"]]
