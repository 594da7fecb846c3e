"""Importance resampling towards a target text, by hashed n-gram features.

Words, pairs and triples of words are hashed into buckets. Counts of all buckets over the documents and
over the target give each bucket a gain, a document's weight is the sum of its features' gains, and the
documents with the highest weights plus Gumbel noise are drawn, which samples without replacement in
proportion to the exponential of the weights.

Features are made by Arrow kernels, a bounded piece of texts at a time: texts are lower-cased and split,
the lists of words flattened and dictionary-encoded. Shifted dictionary indices, joined to one number,
are pairs; they are dictionary-encoded in turn, so that each distinct pair is hashed once, and its index
joined with the word after it makes a triple. A checksum of a pair follows from its words' checksums and
lengths, as appending bytes is linear over bits; no n-gram is ever written out as text. Buckets and gains
come back to the occurrences by ``take``, and documents' sums by a reduction over segments.

Texts are read twice, for the counts and for the weights; what comes to the driver are the counts of at
most ``BUCKETS`` buckets. Ranks are places in a sort by range, counted with offsets of partitions.

Cases: null or empty texts have no words, no features and weight 0. A document without a number draws
its noise from the text ``42:`` alone and comes last among equal scores. Repeated rows are rows of their
own; equal ones are drawn one by one. Without a target all gains follow from the documents alone. Empty
tables give empty results. Columns named as those added are replaced, others pass, whatever their names.
"""

from __future__ import annotations

import functools
import math
import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T

from accesstally.llm.ordered import in_order, offsets
from accesstally.llm.sharding import CRC_TABLE, crc_sql
from accesstally.llm.text import BETWEEN
from accesstally.llm.workers import importable, released
from accesstally.sources.scratch import scratch_path, written

BUCKETS, LONGEST = 10_000, 3
PERCENT, LEAST_WORDS, SEED = 5, 20, 42
#: Bytes of text that are made features of at once; a longer text is a piece of its own.
PIECE = 1_000_000

_BYTE_STEPS = np.array([zlib.crc32(bytes([i])) for i in range(256)], np.uint32) ^ np.uint32(zlib.crc32(b"\0"))


@functools.lru_cache(1024)
def _appended(n: int) -> np.ndarray:
    """What ``n`` more bytes make of a checksum, as a table [byte, value]: the xor of four looked-up numbers."""
    if n == 1:
        table = np.zeros((4, 256), np.uint32)
        value = np.arange(256, dtype=np.uint32)
        table[0] = _BYTE_STEPS
        for j in range(1, 4):
            table[j] = value << np.uint32(8 * (j - 1))
        return table
    half = _appended(n // 2)
    table = _shift(half, half.ravel()).reshape(4, 256)
    return _shift(_appended(1), table.ravel()).reshape(4, 256) if n % 2 else table


def _shift(table: np.ndarray, sums: np.ndarray) -> np.ndarray:
    b = np.uint32(255)
    return table[0][sums & b] ^ table[1][(sums >> np.uint32(8)) & b] ^ table[2][(sums >> np.uint32(16)) & b] ^ table[3][sums >> np.uint32(24)]


def joined_sums(first: np.ndarray, second: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Checksums of texts put together, from those of both and the second's length in bytes."""
    out = np.empty_like(first)
    order = np.argsort(length, kind="stable")
    edges = np.flatnonzero(np.diff(length[order], prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        at = order[a:b]
        n = int(length[at[0]])
        out[at] = (_shift(_appended(n), first[at]) if n else first[at]) ^ second[at]
    return out


def _encoded(values: pa.Array) -> tuple[np.ndarray, pa.Array]:
    found = pc.dictionary_encode(values)
    return found.indices.to_numpy(zero_copy_only=False).astype(np.int64), found.dictionary


def features(texts: pa.Array, buckets: int, longest: int) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
    """Words of each text, and for n = 1, 2, ... the bucket of every n-gram and the text it is in, in order."""
    lists = pc.split_pattern_regex(pc.ascii_lower(pc.fill_null(texts, "")), pattern=BETWEEN)
    words, owner = pc.list_flatten(lists), pc.list_parent_indices(lists)
    real = pc.not_equal(words, "")
    words, owner = words.filter(real), owner.filter(real).to_numpy(zero_copy_only=False).astype(np.int64)
    word, vocabulary = _encoded(words)
    length = pc.binary_length(vocabulary).to_numpy(zero_copy_only=False).astype(np.int64)
    sums = np.fromiter((zlib.crc32(w.encode()) for w in vocabulary.to_pylist()), np.uint32, len(vocabulary))

    gram, gram_sums, last, out = word, sums, np.arange(len(word)), []
    for n in range(1, longest + 1):
        out.append(((gram_sums % np.uint32(buckets)).astype(np.int64).take(gram), owner.take(last)))
        if n == longest:
            break
        # a gram goes on to the word after it where that stands in the same text
        on = np.flatnonzero(last + 1 < len(word))
        on = on[owner.take(last[on] + 1) == owner.take(last[on])]
        last = last[on] + 1
        pairs = gram.take(on) * len(vocabulary) + word.take(last)
        gram, distinct = _encoded(pa.array(pairs))
        begun, ended = np.divmod(distinct.to_numpy(zero_copy_only=False), max(1, len(vocabulary)))
        begun_sums = _shift(_appended(1), gram_sums.take(begun)) ^ np.uint32(zlib.crc32(b" "))
        gram_sums = joined_sums(begun_sums, sums.take(ended), length.take(ended))
    return np.bincount(owner, minlength=len(texts)), out


def pieces(batch: pa.RecordBatch, column: int):
    """A batch in slices of at most ``PIECE`` bytes of text, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if i > start and held + n > PIECE:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def bucket_counts(texts: DataFrame, text: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> np.ndarray:
    """How many features of all texts fall in each bucket."""
    importable(texts.sparkSession)
    out = pa.schema([("bucket", pa.int64()), ("n", pa.int64())])

    def counted(batches):
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            for piece in pieces(batch, 0):
                for bucket, _ in features(piece.column(0), buckets, longest)[1]:
                    n += np.bincount(bucket, minlength=buckets)
        held = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(n[held])], schema=out)

    rows = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(released(counted), "bucket long, n long")
    found = np.zeros(buckets, np.int64)
    for row in rows.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most ``buckets`` rows
        found[row["bucket"]] = row["n"]
    return found


def gains(documents: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log of how much likelier a bucket is in the target, each count raised by one."""
    n, s_all, t_all = len(documents), float(documents.sum() + len(documents)), float(target.sum() + len(documents))
    ratios = [(t + 1.0) * s_all / ((s + 1.0) * t_all) for s, t in zip(documents.tolist(), target.tolist(), strict=True)]
    return np.fromiter((math.floor(1000 * math.log(r)) for r in ratios), np.int64, n)


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise in thousandths, from a digest of the document's number."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def _named(rows: DataFrame, *added: str) -> list[str]:
    """The columns of a table that none of the added ones replaces."""
    return [c for c in rows.columns if c.lower() not in added]


def weighed(documents: DataFrame, gain: np.ndarray, text: str = "text", doc_id: str = "doc_id", longest: int = LONGEST) -> DataFrame:
    """All rows with ``n_words``, ``n_features``, ``weight`` and ``score``; ``text`` itself passes."""
    importable(documents.sparkSession)
    added = ("n_words", "n_features", "weight")
    kept = _named(documents, *added, "score")
    rows = documents.select(F.col(text).cast("string").alias("of"), F.struct(*[F.col(f"`{c}`") for c in kept]).alias("own"))

    def summed(batches):
        for batch in batches:
            for piece in pieces(batch, 0):
                n_words, grams = features(piece.column(0), len(gain), longest)
                n, weight = np.zeros((2, piece.num_rows), np.int64)
                for bucket, owner in grams:
                    if len(owner):
                        starts = np.flatnonzero(np.diff(owner, prepend=-1))
                        weight[owner[starts]] += np.add.reduceat(gain.take(bucket), starts)
                        n += np.bincount(owner, minlength=piece.num_rows)
                numbers = [pa.array(x.astype(np.int64)) for x in (n_words, n, weight)]
                yield pa.RecordBatch.from_arrays([piece.column(1), *numbers], names=["own", *added])

    schema = T.StructType([rows.schema["own"], *[T.StructField(name, T.LongType()) for name in added]])
    found = rows.mapInArrow(released(summed), schema)
    score = (F.col("weight") + noise(F.col(f"own.`{doc_id}`"))).alias("score")
    return found.select(*[F.col(f"own.`{c}`") for c in kept], *added, score)


def ranked(weighed_rows: DataFrame, doc_id: str = "doc_id", percent: int = PERCENT, least_words: int = LEAST_WORDS) -> DataFrame:
    """All rows with ``rank``: places of the drawn ones, from 1, and null for the others."""
    kept = _named(weighed_rows, "rank")
    eligible = F.col("n_words") >= least_words
    order = [-F.col("score"), F.col(doc_id).isNull(), F.col(doc_id), F.col("n_features")]
    ordered = in_order(weighed_rows.select(*[F.col(f"`{c}`") for c in kept]).filter(eligible), order)
    placed = ordered.join(F.broadcast(offsets(ordered).select("part", "rows_before", "all_rows")), "part")
    rank = F.col("rows_before") + F.col("place") + 1
    drawn = F.when(rank <= F.expr(f"{percent} * all_rows DIV 100"), rank)
    placed = placed.select(*[F.col(f"own.`{c}`") for c in kept], drawn.alias("rank"))
    rest = weighed_rows.filter(~eligible).select(*[F.col(f"`{c}`") for c in kept], F.lit(None).cast("long").alias("rank"))
    return placed.unionByName(rest)


def resample(documents: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id", target_text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The drawn documents with all their columns and n_words, n_features, weight, score and rank."""
    gain = gains(bucket_counts(documents, text), bucket_counts(target, target_text))
    return ranked(weighed(documents, gain, text, doc_id), doc_id, percent).filter("rank IS NOT NULL")


def op13_resampling(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    gain = gains(bucket_counts(documents), bucket_counts(benchmark))
    numbers = weighed(documents, gain).drop("text")
    numbers = written(numbers, scratch_path(spark, "weights"))  # sorting samples its input, which would score all texts twice
    return ranked(numbers).select("doc_id", "n_features", "weight", "score", "rank")


def _features_sql(table: str) -> str:
    words = rf"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""
    return f"""
{table}_w AS MATERIALIZED (SELECT row_number() OVER () AS r, {"doc_id, " if table == "documents" else ""}{words} AS w FROM {table}),
{table}_g AS MATERIALIZED (SELECT r, array_to_string(w[i : i + n - 1], ' ') AS g, count(*) AS c
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM {table}_w, (VALUES (1), (2), (3)) AS v(n) WHERE len(w) >= n) GROUP BY r, g)"""


OP13_SQL = f"""
WITH k AS ({CRC_TABLE}),{_features_sql("documents")},{_features_sql("benchmark")},
b AS MATERIALIZED (SELECT g, {crc_sql("g")} % {BUCKETS} AS b FROM (SELECT g FROM documents_g UNION SELECT g FROM benchmark_g), k),
s AS (SELECT b, sum(c) AS s FROM documents_g JOIN b USING (g) GROUP BY b),
t AS (SELECT b, sum(c) AS t FROM benchmark_g JOIN b USING (g) GROUP BY b),
a AS (SELECT (SELECT coalesce(sum(s), 0) FROM s)::DOUBLE AS sa, (SELECT coalesce(sum(t), 0) FROM t)::DOUBLE AS ta),
n AS (SELECT b, floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (sa + {BUCKETS}) / ((coalesce(s, 0)::DOUBLE + 1) * (ta + {BUCKETS}))))::BIGINT AS gain
  FROM s FULL JOIN t USING (b), a),
f AS (SELECT r, sum(c)::BIGINT AS n_features, sum(c * gain)::BIGINT AS weight FROM documents_g JOIN b USING (g) JOIN n USING (b) GROUP BY r),
d AS (SELECT r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
        coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('{SEED}:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
      FROM documents_w LEFT JOIN f USING (r)),
o AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features) AS p, count(*) OVER () AS n FROM d WHERE n_words >= {LEAST_WORDS})
SELECT doc_id, n_features, weight, score, CASE WHEN p <= {PERCENT} * n // 100 THEN p END::BIGINT AS rank
FROM d LEFT JOIN o USING (r)
"""
