"""All reports of a log in one JSON document."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from accesstally import schema

_PARTS = {
    "q1": ("query1", schema.Q1_RESULT.names, ["log_date", "status_code"]),
    "q2": ("query2", schema.Q2_RESULT.names, ["rank"]),
    "q3": ("query3", schema.Q3_RESULT.names, ["log_date", "log_hour"]),
}


# Report rows a document holds at most: a century of hours, or of days with nine statuses.
MAX_ROWS = 1_000_000


_TOTALS = ["total_records", "malformed_records", "batch_count"]


def combined_json(reports: dict[str, DataFrame], counts: DataFrame) -> DataFrame:
    """One row, one column ``result_json``: the report rows in order, and the totals.

    ``counts`` holds total_records, malformed_records and batch_count. Report rows grow with the days and
    hours a log covers, not with its lines; they are what is gathered here, and a document of more than
    ``MAX_ROWS`` raises an error: ``write_combined`` has no such bound. A report that was not selected is empty.
    """
    tagged = [counts.withColumn("part", F.lit("counts"))]
    shown = {tag: part for tag, part in _PARTS.items() if part[0] in reports}
    for tag, (name, _, _) in shown.items():
        tagged.append(reports[name].withColumn("part", F.lit(tag)))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)

    def listed(tag: str, fields: list[str], keys: list[str]) -> Column:
        ordered = keys + [f for f in fields if f not in keys]
        found = F.collect_list(F.when(F.col("part") == tag, F.struct(*ordered)))
        return F.transform(
            F.sort_array(found), lambda row: F.struct(*[row[f].alias(f) for f in fields])
        ).alias(tag)

    gathered = rows.agg(
        *[listed(tag, fields, keys) for tag, (_, fields, keys) in shown.items()],
        F.max("total_records").alias("total_records"),
        F.max("malformed_records").alias("malformed_records"),
        F.max("batch_count").alias("batch_count"),
        F.count("*").alias("rows"),
    )
    too_many = F.raise_error(F.lit(f"a combined document holds at most {MAX_ROWS} rows"))
    gathered = gathered.filter(F.when(F.col("rows") > MAX_ROWS, too_many.cast("boolean")).otherwise(True))
    lists = [F.col(tag) if tag in shown else F.array().alias(tag) for tag in _PARTS]
    return gathered.select(F.to_json(F.struct(*lists, *_TOTALS)).alias("result_json"))


def write_combined(reports: dict[str, DataFrame], counts: DataFrame, path: str) -> None:
    """The same document as ``combined_json`` in pieces, for reports of any number of rows.

    Report rows are sorted by range and written as text in their order, each with the brackets that it
    opens or closes; the comma that ends every line of the writer is the one between two pieces. The
    totals are a file of their own, as nothing may follow them. All files of ``body`` by name and then
    the one of ``tail`` are the document, byte by byte. Only first and last keys of the three reports
    are gathered.
    """
    spark = counts.sparkSession
    pieces, number = [], {tag: i for i, tag in enumerate(_PARTS)}
    for tag, (name, fields, keys) in _PARTS.items():
        if name in reports:
            key = F.struct(*([F.lit(None).cast("date").alias("day")] if len(keys) == 1 else []), *[F.col(k) for k in keys])
            key = key.cast("struct<day:date,place:int>").alias("key")
            pieces.append(reports[name].select(F.lit(number[tag]).alias("section"), key, F.to_json(F.struct(*fields)).alias("row")))
    names = spark.createDataFrame([(i, tag) for tag, i in number.items()], "section int, tag string")
    if pieces:
        rows = reduce(DataFrame.unionByName, pieces)
    else:
        rows = spark.createDataFrame([], "section int, key struct<day:date,place:int>, row string")
    ends = rows.groupBy("section").agg(F.min("key").alias("first"), F.max("key").alias("last"))
    sections = names.join(ends, "section", "left")  # three rows
    opening = F.concat(F.when(F.col("section") == 0, "{").otherwise(""), F.lit('"'), "tag", F.lit('":['))
    nothing = sections.filter("first IS NULL").select("section", F.col("first").alias("key"), F.concat(opening, F.lit("]")).alias("piece"))
    open_, close = F.when(F.col("key") == F.col("first"), opening).otherwise(""), F.when(F.col("key") == F.col("last"), "]").otherwise("")
    piece = F.concat(open_, F.col("row"), close).alias("piece")
    body = rows.join(F.broadcast(sections), "section").select("section", "key", piece).unionByName(nothing)
    body.orderBy("section", "key").select("piece").write.option("lineSep", ",").text(f"{path}/body")
    totals = F.to_json(F.struct(*_TOTALS))
    counts.select(F.substring(totals, 2, 1 << 30)).write.text(f"{path}/tail")


def read_written(spark: SparkSession, path: str) -> DataFrame:
    """A written document in one row, for what reads it whole."""
    files = spark.read.option("wholetext", True).text([f"{path}/body", f"{path}/tail"])
    gathered = files.agg(F.sort_array(F.collect_list(F.struct(F.col("_metadata.file_path"), "value"))).alias("files"))
    text = F.array_join(F.transform("files", lambda f: f["value"]), "")
    return gathered.select(F.rtrim(text, F.lit("\n")).alias("result_json"))


def read_totals(documents: DataFrame) -> DataFrame:
    """The totals back out of a combined document."""
    columns = ", ".join(f"{name} bigint" for name in _TOTALS)
    return documents.select(F.from_json("result_json", columns).alias("found")).select("found.*")


def read_combined(documents: DataFrame, tag: str) -> DataFrame:
    """The rows of one report back out of a combined document."""
    columns = {"q1": schema.Q1_RESULT, "q2": schema.Q2_RESULT, "q3": schema.Q3_RESULT}[tag]
    parsed = F.from_json("result_json", f"{tag} array<{columns.simpleString()}>")
    return documents.select(F.inline(parsed[tag]))
