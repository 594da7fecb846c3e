"""Benchmark decontamination: passages of test items found in documents.

The n-grams of all items form a hash set that goes to every task as the build side of a broadcast
join. Documents are read once; each forms the hashes of its own windows, a window whose hash is in
the set is compared word by word, and only hits and one row for each document leave the task.

``MAX_BROADCAST`` bounds the windows that are broadcast. A larger benchmark is joined by a shuffle of
windows instead, which costs more and gives the same rows.

Cases: null or empty text has no words and no hits. An item of fewer words than a window is one
window of all its words; an item without words or without a number cannot be named and is left out.
Items with one number are one item. Rows of documents are judged one by one, also where they repeat
or have no number. Extra columns are ignored, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from accesstally.llm.text import BETWEEN_ANY, WORD_ANY, joined_digest, unused, words

WINDOW = 10
#: Windows of the benchmark that are broadcast at most; each takes about 200 bytes.
MAX_BROADCAST = 1_000_000


def _windows(tokens: Column, size: Column, length: int) -> Column:
    """The words of a window, and the hashes of all windows of so many."""
    starts = F.sequence(F.lit(0), size - length)
    formed = F.transform(starts, lambda i: F.xxhash64(F.slice(tokens, i + 1, F.lit(length))))
    hashes = F.when(size >= length, formed).otherwise(F.array().cast("array<bigint>"))
    return F.struct(F.lit(length).alias("n"), hashes.alias("keys"))


def benchmark_windows(items: DataFrame, text: str = "text", item_id: str = "item_id", window: int = WINDOW) -> DataFrame:
    """key, gram and the items of each distinct window."""
    tokens = items.select(F.col(item_id).alias("item"), words(F.col(text)).alias("w")).filter("item IS NOT NULL AND size(w) > 0")
    length = F.least(F.size("w"), F.lit(window))
    grams = tokens.select("item", F.explode(F.transform(F.sequence(F.lit(1), F.size("w") - length + 1), lambda i: F.slice("w", i, length))).alias("gram"))
    return grams.groupBy("gram").agg(F.collect_set("item").alias("items")).withColumn("key", F.xxhash64("gram"))


def find(
    documents: DataFrame,
    items: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    window: int = WINDOW,
    max_broadcast: int = MAX_BROADCAST,
) -> DataFrame:
    """For every row: doc_id, text_key, n_words, the hit word spans [(at, n)] and the items found."""
    known = benchmark_windows(items, window=window)
    sizes = known.groupBy(F.size("gram").alias("n")).count().collect()  # at most ``window`` rows
    bounded = sum(r["count"] for r in sizes) <= max_broadcast

    rows = documents.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(doc_id).alias("doc_id"),
        F.xxhash64(text).alias("text_key"),
        words(F.col(text)).alias("w"),
    ).withColumn("n_words", F.size("w"))
    # One row of its own (n = 0) for each document, so that those without hits stay; its key spreads them.
    own = F.struct(F.lit(0).alias("n"), F.array("row").alias("keys"))
    formed = F.array(own, *[_windows(F.col("w"), F.col("n_words"), r["n"]) for r in sizes])
    ids = ["row", "doc_id", "text_key", "n_words"]
    each = rows.select(*ids, "w", F.inline(formed)).select(*ids, "w", "n", F.posexplode("keys").alias("at", "key"))
    gram = F.slice("w", F.col("at") + 1, F.col("n"))
    if bounded:
        known = F.broadcast(known)
    else:
        each, gram = each.withColumn("own_gram", gram).drop("w"), F.col("own_gram")
    known = known.withColumnRenamed("key", "known_key")
    # a bare equality would become a key of the join and be formed for every window, not for hits alone
    same = (F.col("key") == F.col("known_key")) & F.coalesce(gram == F.col("gram"), F.lit(False))
    hits = each.join(known, same, "left").filter("n = 0 OR items IS NOT NULL")
    span = F.when(F.col("n") > 0, F.struct("at", "n"))
    found = hits.groupBy(*ids).agg(F.collect_set(span).alias("spans"), F.collect_set("items").alias("items"))
    return found.select(
        "doc_id",
        "text_key",
        F.col("n_words").cast("long").alias("n_words"),
        "spans",
        F.array_distinct(F.flatten("items")).alias("items"),
    )


def hit_words(spans: Column) -> Column:
    """How many words lie in any span."""
    return F.size(F.array_distinct(F.flatten(F.transform(spans, lambda s: F.sequence(s["at"], s["at"] + s["n"] - 1)))))


def report(found: DataFrame) -> DataFrame:
    hit = hit_words(F.col("spans")).cast("long")
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        joined_digest(F.col("items")).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


def _hit(documents: DataFrame, items: DataFrame, text: str, doc_id: str) -> tuple[DataFrame, Column, str]:
    """The documents with hits, each once, the condition that joins them, and the name of the struct with their spans."""
    name = unused(documents, "found")
    found = find(documents, items, text, doc_id).filter(F.size("spans") > 0)
    found = found.groupBy("doc_id", "text_key").agg(F.first("spans").alias("spans")).select(F.struct("doc_id", "text_key", "spans").alias(name))
    same = documents[doc_id].eqNullSafe(F.col(f"{name}.doc_id")) & (F.xxhash64(documents[text]) == F.col(f"{name}.text_key"))
    return found, same, name


def without_spans(documents: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """All documents, without the words in any hit span and what stands before each of them."""
    found, same, name = _hit(documents, items, text, doc_id)
    spans = F.col(f"{name}.spans")
    parts = F.array_remove(F.split(F.col(text), BETWEEN_ANY), "")
    gaps = F.split(F.col(text), WORD_ANY)
    inside = lambda i: F.exists(spans, lambda s: (i >= s["at"]) & (i < s["at"] + s["n"]))
    left = F.transform(parts, lambda x, i: F.when(inside(i), "").otherwise(F.concat(F.get(gaps, i), x)))
    rest = F.concat(F.array_join(left, ""), F.element_at(gaps, -1))
    joined = documents.join(found, same, "left")
    changed = F.when(spans.isNull(), F.col(text)).otherwise(rest).alias(text)
    return joined.select(*[changed if c == text else F.col(f"`{c}`") for c in documents.columns])


def clean(documents: DataFrame, items: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The documents in which no window of an item occurs, with all their columns."""
    found, same, _ = _hit(documents, items, text, doc_id)
    return documents.join(found, same, "left_anti")


def op1_decontaminate(spark, sf_dir):
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return report(find(documents, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


OP1_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
b AS (
  SELECT item_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
bg AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS g
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
dg AS (
  SELECT r, i, n, array_to_string(w[i : i + n - 1], ' ') AS g
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, (SELECT DISTINCT n FROM bg) WHERE len(w) >= n)),
h AS (SELECT r, i, n, item_id FROM dg JOIN bg USING (n, g)),
p AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM h) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS s
      FROM (SELECT DISTINCT r, item_id::VARCHAR AS s FROM h) GROUP BY r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN p USING (r) LEFT JOIN t USING (r)
"""
