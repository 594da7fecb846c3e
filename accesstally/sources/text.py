"""Raw log files as one relation."""

from __future__ import annotations

import functools
import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Tasks of Spark that list many paths.
LISTING_TASKS = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
#: Fixed value: endings of files that cannot be split.
UNSPLITTABLE = r"(?i)\.(gz|deflate|zst|snappy|lz4)$"
#: Names that are written alike in paths and in the scan's names of files.
PLAIN_NAME = r"(?!\.{1,2}$)[A-Za-z0-9._=+-]+"
#: How a name begins whose file system has no host; one file's names differ in the number of slashes.
SCHEME = r"^([a-zA-Z][a-zA-Z0-9+.-]*):/{3}(?!/)"


def _bare(place: str) -> str:
    """An encoded name with one slash after the scheme and none at its end."""
    return re.sub(SCHEME, r"\1:/", place.rstrip("/"))


def _places(spark: SparkSession, paths: Sequence[str]) -> dict[str, list[str]]:
    """What each path stands for now, by its full name and in order; a pattern may match several places.

    Places are names as the scan gives them, with unusual characters encoded.
    Raises where one path lies in another, as its lines would belong to two batches.
    """
    conf = spark._jsc.hadoopConfiguration()

    def qualified(path: str):
        given = spark._jvm.org.apache.hadoop.fs.Path(path)
        system = given.getFileSystem(conf)
        return system, system.makeQualified(given)

    @functools.cache
    def folder(path: str) -> tuple[str, str]:
        whole = qualified(path)[1]
        return whole.toString().rstrip("/"), _bare(whole.toUri().toString())

    full: dict[str, list[str]] = {}
    for path in paths:
        parent, _, name = path.rstrip("/").rpartition("/")
        pattern = any(c in path for c in "*?[{")
        below_root = not re.fullmatch(r"([^/]+:)?/*", parent)
        if below_root and not pattern and re.fullmatch(PLAIN_NAME, name):  # asks the file system once for each folder
            shown, encoded = folder(parent + "/")
            full[f"{shown}/{name}"] = [f"{encoded}/{name}"]
            continue
        system, whole = qualified(path)
        found = system.globStatus(whole) if pattern else None
        full[whole.toString()] = [_bare(p.toUri().toString()) for p in ([s.getPath() for s in found] if found else [whole])]
    places = sorted({(place + "/", name) for name, matched in full.items() for place in matched})
    held: list[tuple[str, str]] = []
    for place, name in places:
        while held and not place.startswith(held[-1][0]):
            held.pop()
        if held and held[-1][1] != name:
            raise ValueError(f"{name!r} and {held[-1][1]!r} share files")
        held.append((place, name))
    return full


def batch_paths(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The given paths in full, each once, in order; the n-th is batch n."""
    return list(_places(spark, paths))


def read_lines(spark: SparkSession, paths: Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """All lines of all paths: ``value``, ``file_path`` and ``batch_id`` (from 1, by path).

    Other encodings than UTF-8 must keep ASCII line ends, as ISO-8859-1 does.
    """
    return _read(spark, paths, encoding)


def read_numbered_lines(spark: SparkSession, paths: Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """Lines with the position columns that chunk statistics need.

    The sequence number is taken on the scan itself, before any filter.
    """
    position = {
        "split_start": F.col("_metadata.file_block_start"),
        "line_seq": F.monotonically_increasing_id(),
    }
    return _read(spark, paths, encoding, position)


#: Between places in one text; no path holds it.
_BETWEEN = "\x01"


def _batch_of(file: Column, places: dict[str, list[str]]) -> Column:
    """The batch of the only place that the file's name begins with.

    The places are sorted with a slash behind each. As none lies in another, the last one that does not
    come after the file's name is the place it lies in. It is found by halving, in one step for each
    binary digit of the number of places.
    """
    numbered = {place + "/": i for i, matched in enumerate(places.values(), start=1) for place in matched}
    if len(numbered) == 1:
        return F.lit(1)
    order = sorted(numbered, key=str.encode)
    names = F.split(F.lit(_BETWEEN.join(order)), _BETWEEN)
    numbers = F.split(F.lit(_BETWEEN.join(str(numbered[name]) for name in order)), _BETWEEN)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range((len(order) - 1).bit_length()))])
    wanted = F.concat(F.regexp_replace(file, SCHEME, r"$1:/"), F.lit("/"))
    at = F.aggregate(
        steps, F.lit(0), lambda at, step: F.when(F.get(names, at + step) <= wanted, at + step).otherwise(at)
    )
    return F.get(numbers, at).cast("int")


def _listed(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """The lines of all files; many paths are listed by a few tasks for each core, not by one for each path."""
    before = spark.conf.get(LISTING_TASKS, None)
    spark.conf.set(LISTING_TASKS, str(4 * spark.sparkContext.defaultParallelism))
    try:
        return spark.read.option("recursiveFileLookup", True).text(list(paths))
    finally:
        if before is None:
            spark.conf.unset(LISTING_TASKS)
        else:
            spark.conf.set(LISTING_TASKS, before)


def _read(spark: SparkSession, paths: Sequence[str], encoding: str, more: dict[str, Column] | None = None) -> DataFrame:
    """One scan of the files of all paths, at any depth, with the batch number found from the file's name.

    A compressed file is one split, so its lines are dealt out after a scan of their own, where there are
    such files; the others' splits are not shuffled. Both scans pick their files by name.
    """
    places = _places(spark, paths)
    if not places:
        raise ValueError("no paths given")
    value = F.col("value")
    if encoding.upper() != "UTF-8":
        value = F.decode(value.cast("binary"), encoding)
    text = _listed(spark, list(places))
    is_packed = F.col("_metadata.file_name").rlike(UNSPLITTABLE)
    packed = text.filter(is_packed)
    file = F.col("_metadata.file_path")
    columns = {"value": value, "file_path": file, "batch_id": _batch_of(file, places), **(more or {})}

    def scan(files: DataFrame) -> DataFrame:
        return files.select(*[c.alias(n) for n, c in columns.items()])

    if packed._jdf.queryExecution().toRdd().getNumPartitions() == 0:  # files are picked when the scan is planned
        return scan(text)
    return scan(text.filter(~is_packed)).unionByName(scan(packed).repartition(spark.sparkContext.defaultParallelism))


def union_batches(*batches: DataFrame) -> DataFrame:
    """Inputs of one schema stacked, numbered from 1 in argument order."""
    if not batches:
        raise ValueError("no batches given")
    numbered = [b.withColumn("batch_id", F.lit(i)) for i, b in enumerate(batches, start=1)]
    return reduce(DataFrame.unionByName, numbered)
