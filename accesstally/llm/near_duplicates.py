"""Near-duplicate documents by MinHash with fast similarity sketching.

A document's set is that of its distinct five-word shingles. Its sketch is filled in rounds: in the
first ``COORDINATES`` rounds a shingle goes to one random coordinate a round, later ones fill one
coordinate each, so every coordinate is filled; a value holds the round first, so the smallest value is
that of the earliest round. Documents with equal sets form a class, known by its smallest number. The
sketches of classes are cut into bands, and two classes that agree on a band are a candidate.

With 40 bands of 6 coordinates a pair at the threshold of 0.85 is missed with probability (1 - 0.85**6)**40,
about 6e-9. Links are confirmed on the full sets.

A band shared by many classes is never expanded into pairs while it holds near copies. First, a shingle that
no other candidate has cannot be shared, which bounds the similarity of a class with any other; classes
bounded below the threshold are out, and pairs are tested against their bounds before they are formed.
Then each band's pivot, the class with the fewest shingles of its own, is compared with the others, and links
found join classes into components; this goes on with other pivots while it finds links. Last, exactly
the pairs of different components that agree on a band are compared, each in the first such band. No link
between components is lost; links inside a component cannot change it.

Cases: null and empty text has an empty set and is linked with nothing; it is a component of its own, as
is a document without a number. Rows with one number are one document where their texts agree, and are
reported one by one. Extra columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from accesstally.llm.bitmap import of_several
from accesstally.llm.components import components
from accesstally.llm.hashing import mixed, span_hashes
from accesstally.llm.text import unused
from accesstally.llm.workers import importable, released
from accesstally.sources.scratch import discard, scratch_path, written

SHINGLE = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 85
BANDS, ROWS = 40, 6
COORDINATES = BANDS * ROWS
#: Pivots a band gets at most before pairs are formed, and pairs a class that are formed at once.
ROUNDS, PAIRS_EACH = 4, 8

_rng = np.random.default_rng(59)
_SEEDS = _rng.integers(1, 2**63, 2 * COORDINATES, dtype=np.uint64)
_BAND_ODD = _rng.integers(1, 2**62, ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def shingles(text: str | None) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct shingles of a whole text."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    data = np.frombuffer(b" ".join(words), np.uint8)
    blanks = np.flatnonzero(data == 32)
    starts = np.concatenate([[0], blanks + 1])
    ends = np.concatenate([blanks, [len(data)]])
    n = min(SHINGLE, len(words))
    last = len(words) - n + 1
    return np.unique(span_hashes(data, starts[:last], ends[n - 1 :]))


def sketch(values: np.ndarray) -> np.ndarray:
    """The filled coordinates of a non-empty set; several rounds at once where the set is small."""
    empty = np.iinfo(np.uint64).max
    best = np.full(COORDINATES, empty, np.uint64)
    low, at, step = np.uint64(2**52 - 1), 0, 1 + 1200 // len(values)
    while at < COORDINATES and best.max() == empty:
        rounds = np.arange(at, min(at + step, COORDINATES))
        h = mixed(values[None, :] ^ _SEEDS[rounds, None])
        place = ((h >> np.uint64(52)) * np.uint64(COORDINATES)) >> np.uint64(12)
        value = (h & low) | (rounds.astype(np.uint64) << np.uint64(52))[:, None]
        np.minimum.at(best, place.ravel().astype(np.int64), value.ravel())
        at += step
    rest = np.flatnonzero(best == empty)
    if len(rest):
        h = mixed(values[None, :] ^ _SEEDS[COORDINATES + rest, None]).min(axis=1)
        best[rest] = (h & low) | ((COORDINATES + rest).astype(np.uint64) << np.uint64(52))
    return best


def bands(values: np.ndarray) -> np.ndarray:
    """One hash for each band."""
    return mixed((sketch(values).reshape(BANDS, ROWS) * _BAND_ODD).sum(axis=1, dtype=np.uint64))


def _sketched(documents: DataFrame, text: str, doc_id: str) -> DataFrame:
    """doc_id, n_shingles, a 128-bit key of the set and the bands of every row."""
    out = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_key", pa.binary()), ("bands", pa.list_(pa.int64()))])

    def made(batches):
        import xxhash

        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sizes, keys, lists = [], [], []
                for text in part.column(1).to_pylist():
                    values = shingles(text)
                    sizes.append(len(values))
                    keys.append(xxhash.xxh3_128_digest(values.tobytes()) if len(values) else None)
                    lists.append(bands(values).view(np.int64) if len(values) else None)
                columns = [part.column(0), pa.array(sizes, pa.int64()), pa.array(keys, pa.binary()), pa.array(lists, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, schema=out)

    rows = documents.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(released(made), "doc_id long, n_shingles long, set_key binary, bands array<long>")


def _sets(documents: DataFrame, text: str, doc_id: str, wanted: DataFrame) -> DataFrame:
    """node and the set, as bytes, of the wanted documents."""
    out = pa.schema([("node", pa.int64()), ("shingles", pa.binary())])

    def made(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                found = [shingles(t).tobytes() for t in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(found, pa.binary())], schema=out)

    rows = documents.select(F.col(doc_id).cast("long").alias("node"), F.col(text).cast("string").alias("text"))
    rows = rows.filter("node IS NOT NULL").join(wanted, "node", "left_semi")
    return rows.mapInArrow(released(made), "node long, shingles binary").dropDuplicates(["node"])


def _linked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Those pairs (a, b) whose sets are similar enough."""
    one = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    two = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def confirmed(batches):
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(p, q, assume_unique=True))
                keep.append(100 * both >= PERCENT * (len(p) + len(q) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], schema=out).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(two, "b").join(one, "a").select("a", "b", "set_a", "set_b")
    return joined.mapInArrow(released(confirmed), "a long, b long")


def _linkable(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """node, size and how many shingles other candidates have as well, where those are enough for a link."""
    spark = nodes.sparkSession
    arrays = lambda batch: [np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column("shingles")]
    total = nodes.agg(F.sum(F.col("size").cast("double"))).first()[0] or 0
    shared = spark.sparkContext.broadcast(of_several(sets.select("shingles"), arrays, total))
    out = pa.schema([("node", pa.int64()), ("size", pa.int64()), ("common", pa.int64())])

    def counted(batches):
        for batch in batches:
            own = arrays(batch)
            columns = [batch.column(0), pa.array([len(x) for x in own], pa.int64()), pa.array([int(shared.value.has(x).sum()) for x in own], pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, schema=out)

    found = sets.select("node", "shingles").mapInArrow(released(counted), "node long, size long, common long")
    return written(found.filter(100 * F.col("common") >= PERCENT * F.col("size")), scratch_path(spark, "linkable"))


def _may_link():
    """Whether a class and ``other`` lie in different components and their sizes and bounds allow a link."""
    total = F.col("size") + F.col("other.size")
    least = F.least("size", "other.size")
    common = F.least("common", "other.common")
    # the intersection is at most common, and a link needs PERCENT / (100 + PERCENT) of the sizes
    return (
        (F.col("component") != F.col("other.component"))
        & ((100 + PERCENT) * least >= PERCENT * total)
        & ((100 + PERCENT) * common >= PERCENT * total)
    )


def _confirmed(pairs: DataFrame, sets: DataFrame, paths: list[str], spark) -> bool:
    """Write the links among pairs (node, other) and add their path; whether there are any."""
    pairs = pairs.select(F.least("node", "other.node").alias("a"), F.greatest("node", "other.node").alias("b")).distinct()
    path = scratch_path(spark, "confirmed")
    found = written(_linked(pairs, sets), path)
    paths.append(path)
    return bool(found.take(1))


def near_duplicates(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest number linked) and kept of every row."""
    spark = importable(documents.sparkSession)
    sketched = written(_sketched(documents, text, doc_id), scratch_path(spark, "sketches"))
    classes = sketched.filter("doc_id IS NOT NULL AND n_shingles > 0").groupBy("set_key").agg(
        F.min("doc_id").alias("node"), F.first("n_shingles").alias("size"), F.first("bands").alias("bands")
    )
    entries = classes.select("node", "size", F.posexplode("bands").alias("band", "value"))
    shared = entries.groupBy("band", "value").agg(F.count("*").alias("n")).filter("n > 1").select("band", "value")
    members_path = scratch_path(spark, "members")
    members = written(entries.join(shared, ["band", "value"]), members_path)
    nodes = written(members.select("node", "size").distinct(), scratch_path(spark, "nodes"))
    sets_path = scratch_path(spark, "sets")
    sets = written(_sets(documents, text, doc_id, nodes.select("node")), sets_path)
    nodes = _linkable(nodes, sets)
    members = members.join(nodes.select("node", "common"), "node")
    members = written(members, scratch_path(spark, "members"))
    discard(spark, members_path)
    n_nodes = nodes.count()

    confirmed: list[str] = []
    labels = nodes.select("node", F.col("node").alias("component"))
    for turn in range(ROUNDS + 1):
        # what is left to compare: members of bands that hold several components
        known = members.join(labels, "node")
        parts = known.groupBy("band", "value", "component").agg(F.count("*").alias("n"))
        several = parts.groupBy("band", "value").agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("inside"), F.count("*").alias("parts"))
        open_path = scratch_path(spark, "open")
        several = written(several.filter("parts > 1").select("band", "value", ((F.col("n") * F.col("n") - F.col("inside")) / 2).alias("pairs")), open_path)
        total = several.agg(F.sum("pairs")).first()[0] or 0
        if not total:
            break
        known = known.join(several.select("band", "value"), ["band", "value"])
        last = turn == ROUNDS or total <= PAIRS_EACH * n_nodes
        if not last:
            order = F.struct((-F.col("common") / F.col("size")).alias("own"), "node") if turn == 0 else F.struct(F.xxhash64("node", F.lit(turn)).alias("own"), "node")
            pivots = known.groupBy("band", "value").agg(F.min_by(F.struct("node", "size", "common", "component"), order).alias("other"))
            pairs = known.join(pivots, ["band", "value"]).filter(_may_link())
            found = _confirmed(pairs, sets, confirmed, spark)
            last = not found  # another pivot will not find more than this one did
        if last:
            same = F.exists(F.sequence(F.lit(0), F.col("band") - 1), lambda i: F.get("bands", i) == F.get("other.bands", i))
            with_bands = known.join(classes.select("node", "bands"), "node")
            other = with_bands.select("band", "value", F.struct("node", "size", "common", "component", "bands").alias("other"))
            once = (F.col("band") == 0) | ~same
            pairs = with_bands.join(other, ["band", "value"]).filter((F.col("node") < F.col("other.node")) & _may_link() & once)
            _confirmed(pairs, sets, confirmed, spark)
        labels = components(spark.read.parquet(*confirmed))
        labels = nodes.select("node").join(labels, "node", "left").select("node", F.coalesce("component", "node").alias("component"))
        labels = written(labels, scratch_path(spark, "labels"))
        if last:
            break
    discard(spark, sets_path)
    named = classes.select("set_key", "node").join(labels, "node", "left").select(
        F.col("set_key").alias("key"), F.coalesce("component", "node").alias("component")
    )
    found = sketched.drop("bands").join(named, F.col("set_key") == F.col("key"), "left")
    own = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return found.select(
        "doc_id", "n_shingles", own.alias("component_id"), F.coalesce(own == F.col("doc_id"), F.lit(True)).alias("kept")
    )


def keep_one(documents: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One document of each component, with all columns; rows that repeat a kept number stay."""
    name = unused(documents, "gone")
    gone = near_duplicates(documents, text, doc_id).filter("NOT kept").select(F.col("doc_id").alias(name)).distinct()
    return documents.join(gone, documents[doc_id] == F.col(name), "left_anti")


def op9_near_duplicates(spark, sf_dir):
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP9_SQL = r"""
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[^\x20\x09-\x0D]+') AS w
  FROM documents),
s AS (
  SELECT DISTINCT r, doc_id, array_to_string(w[i : i + least(len(w), 5) - 1], ' ') AS g
  FROM (SELECT r, doc_id, w, unnest(range(1, len(w) - least(len(w), 5) + 2)) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT r, any_value(doc_id) AS doc_id, count(*) AS n FROM s GROUP BY r),
p AS (SELECT x.r AS a, y.r AS b, count(*) AS shared FROM s x JOIN s y ON x.g = y.g AND x.r < y.r
      WHERE x.doc_id IS NOT NULL AND y.doc_id IS NOT NULL GROUP BY 1, 2),
l AS (SELECT p.a, p.b FROM p JOIN n x ON x.r = p.a JOIN n y ON y.r = p.b WHERE 100 * shared >= 85 * (x.n + y.n - shared)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
c AS (SELECT r, r AS other FROM n UNION SELECT c.r, e.b FROM c JOIN e ON e.a = c.other),
m AS (SELECT c.r, min(n.doc_id) AS component FROM c JOIN n ON n.r = c.other GROUP BY c.r)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles,
  CASE WHEN d.doc_id IS NOT NULL THEN coalesce(component, d.doc_id) END AS component_id,
  coalesce(coalesce(component, d.doc_id) = d.doc_id, true) AS kept
FROM d LEFT JOIN n USING (r) LEFT JOIN m USING (r)
"""
