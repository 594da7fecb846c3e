"""Product quantisation of vectors, with codebooks trained by active-entry Lloyd rounds.

Vectors become whole numbers and are cut into equal consecutive parts; each part position has a codebook
of its own. A round assigns every part to its nearest entry and then moves every entry to the floored mean
of its parts. The assignment with its exact distance is kept with the row. In the next round an entry is
active if its values changed. A part whose own entry is not active compares that stored distance with the
active entries alone: no other entry can have come nearer, and of two equally near ones the lower index
still wins. A part whose entry is active is compared with all entries.

Each round reads the table of the round before, part by part in tasks, and writes its own. Tasks hand on
sums for each entry, so a round shuffles tasks times entries, not rows; the codebooks, at most ``ENTRIES``
entries for each part, pass through the driver. All arithmetic is in 64-bit whole numbers.

Cases: rows whose vector is null, empty, or holds null or non-finite components take no part, nor do those
whose length differs from that of the vector with the smallest number; nulls count as largest numbers, and
rows with one number are in the order of their vectors. Fewer vectors than entries give smaller codebooks.
Rows are coded one by one, also repeated ones. An empty table gives no rows. Other columns are ignored,
whatever their names. Components whose size times 256 exceeds ``LARGEST`` raise an error, as squares of
such numbers do not fit; a length that the parts do not divide raises one as well.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from accesstally.llm.workers import importable, released
from accesstally.sources.scratch import discard, scratch_path, written

PARTS, ENTRIES, ROUNDS, SCALE = 16, 64, 2, 256
#: Components in whole numbers; 2**27 leaves room for sums of a thousand squared differences.
LARGEST = 2**26
#: Rows compared at once, which bounds a task's memory.
BLOCK = 1024



def usable(vector: Column) -> Column:
    """Whether a vector has components and all of them are numbers."""
    number = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != F.lit(float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(number(x), F.lit(False)))


def whole_numbers(embeddings: DataFrame, vec_id: str, vector: str, label: str) -> DataFrame:
    """vec_id, label and the floored vector of all usable rows."""
    scaled = F.transform(F.col(vector), lambda x: F.floor(x.cast("double") * SCALE))
    fits = F.forall("vector", lambda x: F.abs(x) <= LARGEST)
    kept = embeddings.filter(usable(F.col(vector))).select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"), scaled.alias("vector"))
    refused = F.raise_error(F.lit(f"components beyond {LARGEST // SCALE} are not supported")).cast("array<bigint>")
    return kept.withColumn("vector", F.when(fits, F.col("vector")).otherwise(refused))


def full_scan(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest entry and squared distance of each part (row, place); the first of equally near ones."""
    apart = ((parts[:, None, :] - book[None, :, :]) ** 2).sum(axis=2)
    nearest = apart.argmin(axis=1)
    return nearest, apart[np.arange(len(parts)), nearest]


def reassigned(parts: np.ndarray, book: np.ndarray, active: np.ndarray, code: np.ndarray, distance: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The assignment to ``book``, given the one to the codebook before and which entries differ from it."""
    code, distance = code.copy(), distance.copy()
    lost = active[code]
    if lost.any():
        code[lost], distance[lost] = full_scan(parts[lost], book)
    moved = np.flatnonzero(active)
    if len(moved) and not lost.all():
        held = np.flatnonzero(~lost)
        near, apart = full_scan(parts[held], book[moved])
        near = moved[near]
        better = (apart < distance[held]) | ((apart == distance[held]) & (near < code[held]))
        code[held[better]], distance[held[better]] = near[better], apart[better]
    return code, distance


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width)


def _assign(rows: DataFrame, books: np.ndarray, before: np.ndarray | None) -> DataFrame:
    """One round's assignment; ``before`` holds the codebooks that the rows' own one refers to."""
    parts, _, width = books.shape
    active = None if before is None else (books != before).any(axis=2)
    names = ["vec_id", "label", "vector", "code", "distance"]

    def assigned(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, BLOCK):
                block = batch.slice(at, BLOCK)
                vectors = _matrix(block.column(2), parts * width)
                code = np.zeros((len(vectors), parts), np.int64)
                distance = np.zeros((len(vectors), parts), np.int64)
                if before is not None:
                    code[:] = np.frombuffer(b"".join(block.column(3).to_pylist()), np.uint8).reshape(-1, parts)
                    distance[:] = _matrix(block.column(4), parts)
                for p in range(parts):
                    own = vectors[:, p * width : (p + 1) * width]
                    if before is None:
                        code[:, p], distance[:, p] = full_scan(own, books[p])
                    else:
                        code[:, p], distance[:, p] = reassigned(own, books[p], active[p], code[:, p], distance[:, p])
                packed = pa.array([bytes(c) for c in code.astype(np.uint8)], pa.binary())
                ends = pa.array(np.arange(len(vectors) + 1, dtype=np.int32) * parts)
                kept = pa.ListArray.from_arrays(ends, pa.array(distance.ravel()))
                yield pa.RecordBatch.from_arrays([block.column(0), block.column(1), block.column(2), packed, kept], names=names)

    kind = rows.schema["label"].dataType.simpleString()
    return rows.mapInArrow(released(assigned), f"vec_id long, label {kind}, vector array<long>, code binary, distance array<long>")


def _means(state: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after a round: floored means of what each entry was assigned, unused ones as they were."""
    parts, entries, width = books.shape
    out = pa.schema([("at", pa.int64()), ("n", pa.int64()), ("total", pa.int64())])

    def summed(batches):
        n = np.zeros((parts, entries), np.int64)
        total = np.zeros((parts, entries, width), np.int64)
        for batch in batches:
            vectors = _matrix(batch.column(0), parts * width)
            code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(-1, parts)
            for p in range(parts):
                np.add.at(n[p], code[:, p], 1)
                np.add.at(total[p], code[:, p], vectors[:, p * width : (p + 1) * width])
        used = np.flatnonzero(np.repeat(n.ravel(), width))
        if len(used):
            columns = [used, np.repeat(n.ravel(), width)[used], total.ravel()[used]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=out)

    sums = state.select("vector", "code").mapInArrow(released(summed), "at long, n long, total long")
    found = books.copy().ravel()
    # at most parts x entries x width rows
    for row in sums.groupBy("at").agg(F.sum("n").alias("n"), F.sum("total").alias("total")).collect():
        found[row["at"]] = row["total"] // row["n"]
    return found.reshape(books.shape)


def compress(
    embeddings: DataFrame,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, label, code, distance) of every usable vector, and the codebooks [part, entry, place].

    ``code`` has one byte for each part, ``distance`` its squared distance to that entry.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code of one byte names 1 to 256 entries")
    spark = importable(embeddings.sparkSession)
    path = scratch_path(spark, "vectors")
    rows = written(whole_numbers(embeddings, vec_id, vector, label), path)
    order = [F.asc_nulls_last("vec_id"), "vector"]
    first = rows.orderBy(*order).select("vector").first()
    if first is None:
        none = rows.select("vec_id", "label", F.lit(b"").alias("code"), F.col("vector").alias("distance"))
        return none, np.zeros((parts, 0, 0), np.int64)
    if len(first["vector"]) % parts:
        raise ValueError(f"{parts} equal parts do not divide {len(first['vector'])} components")
    rows = rows.filter(F.size("vector") == len(first["vector"]))
    seeds = np.array([r["vector"] for r in rows.orderBy(*order).select("vector").limit(entries).collect()], np.int64)
    books = seeds.reshape(len(seeds), parts, -1).transpose(1, 0, 2).copy()

    before = None
    for _ in range(rounds):
        next_path = scratch_path(spark, "codes")
        rows = written(_assign(rows, books, before), next_path)
        discard(spark, path)
        path = next_path
        before, books = books, _means(rows, books)
    final = written(_assign(rows, books, before).select("vec_id", "label", "code", "distance"), scratch_path(spark, "final-codes"))
    discard(spark, path)
    return final, books


def decode(codes: DataFrame, books: np.ndarray) -> DataFrame:
    """vec_id and the vector that a code stands for, in the scale of the input."""
    parts, _, width = books.shape
    tables = F.array(*[F.array(*[F.array(*[F.lit(int(x)) for x in entry]) for entry in book]) for book in books])
    entry = lambda p: F.conv(F.hex(F.substring("code", p + 1, 1)), 16, 10).cast("int")
    pieces = [F.get(F.get(tables, F.lit(p)), entry(p)) for p in range(parts)]
    return codes.select("vec_id", F.transform(F.concat(*pieces), lambda x: x / SCALE).alias("vector"))


def books_digest(books: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def report(codes: DataFrame, books: np.ndarray) -> DataFrame:
    error = F.aggregate("distance", F.lit(0).cast("long"), lambda a, b: a + b)
    rows = codes.select("vec_id", "label", F.lower(F.hex("code")).alias("code"), error.alias("error"))
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "of")
    joined = rows.join(sums, F.col("label").eqNullSafe(F.col("of")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256"))


def op12_codes(spark, sf_dir):
    return report(*compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


def _rounds_sql() -> str:
    """Plain rounds: every part compared with every entry."""
    out = []
    for r in range(ROUNDS + 1):
        out.append(f"""
a{r} AS MATERIALIZED (SELECT x.r, x.p, min(list_sum([(x.v[j] - e.v[j]) * (x.v[j] - e.v[j]) FOR j IN range(1, len(e.v) + 1)])::BIGINT * {ENTRIES} + e.e) AS near
  FROM x JOIN e{r} e USING (p) GROUP BY x.r, x.p)""")
        if r < ROUNDS:
            out.append(f"""
m{r} AS (SELECT p, near % {ENTRIES} AS e, j, sum(v[j])::BIGINT AS s, count(*) AS n
  FROM (SELECT x.p, x.v, a.near, unnest(range(1, len(x.v) + 1)) AS j FROM x JOIN a{r} a USING (r, p)) GROUP BY ALL),
f{r} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY j) AS v FROM m{r} GROUP BY p, e),
e{r + 1} AS MATERIALIZED (SELECT p, e.e, coalesce(f{r}.v, e.v) AS v FROM e{r} e LEFT JOIN f{r} USING (p, e))""")
    return ",".join(out)


OP12_SQL = f"""
WITH k AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
o AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r FROM k),
d AS (SELECT o.* FROM o JOIN (SELECT len(v) AS n FROM o WHERE r = 1) ON len(v) = n),
x AS MATERIALIZED (SELECT r, p, v[p * (len(v) // {PARTS}) + 1 : (p + 1) * (len(v) // {PARTS})] AS v FROM (SELECT r, v, unnest(range({PARTS})) AS p FROM d)),
e0 AS (SELECT p, (s - 1)::BIGINT AS e, v FROM x JOIN (SELECT r, row_number() OVER (ORDER BY r) AS s FROM d) USING (r) WHERE s <= {ENTRIES}),{_rounds_sql()},
c AS (SELECT r, string_agg(lpad(lower(to_hex(near % {ENTRIES})), 2, '0'), '' ORDER BY p) AS code, sum(near // {ENTRIES})::BIGINT AS error FROM a{ROUNDS} GROUP BY r),
b AS (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM e{ROUNDS})
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error, codebooks_sha256
FROM c JOIN d USING (r), b
"""
