"""CSV records with line breaks in quoted fields, read by many tasks a file.

Spark splits a CSV file among tasks only if a line is a record. Here lines are
read as text, split as usual, and stored once with the split ("block") they came
from, since splits may differ from one read to the next. A line with an odd
number of quotes opens or closes a record of several lines, so the count of such
lines before a line says whether it starts inside a quoted field. Counts per
block are summed over the blocks of a file; only blocks that hold or continue a
broken record are then put in order and their broken lines joined. All other
lines pass as they are. Spark parses the records.

Lines end with a line feed, with or without a carriage return before it; breaks
inside a field keep their characters. A quote inside an unquoted field counts like
any other (it has to be quoted and doubled). A file that ends inside a quoted
field aborts the load, before anything is joined. Blank lines outside of quotes
are skipped, and the first record of each file is its header.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

PARSE_OPTIONS = {"quote": '"', "escape": '"', "multiLine": "true"}


def _lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every line with its file, the split it was read in, its place there, and
    whether it has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return (spark.read.option("lineSep", "\n").text(paths)
            .select(F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_block_start").alias("_block"),
                    F.monotonically_increasing_id().alias("_at"), "value", (quotes % 2 == 1).alias("_odd")))


def _blocks(lines: DataFrame, strict: bool) -> DataFrame:
    """Per block: odd lines in it and in the file's earlier blocks."""
    each = lines.groupBy("_path", "_block").agg(F.sum(F.col("_odd").cast("long")).alias("odd"), F.min("_at").alias("first"))
    before = Window.partitionBy("_path").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_path")
    unclosed = F.sum("odd").over(whole) % 2 == 1
    if strict:
        stop = F.raise_error(F.concat(F.lit("file ends inside a quoted field: "), F.col("_path")))
        unclosed = F.when(unclosed, stop.cast("boolean")).otherwise(False)
    return each.select("_path", "_block", "odd", "first", (F.col("_block") == F.min("_block").over(whole)).alias("head"),
                       F.coalesce(F.sum("odd").over(before), F.lit(0)).alias("before"), unclosed.alias("unclosed"))


def split_records(spark: SparkSession, paths: str | list[str], folder: str, strict: bool = True) -> DataFrame:
    """``_path`` and ``record`` (text) of every record but the headers. Lines and
    block counts are stored under ``folder``, a new one. Unless ``strict``, the
    lines of a file that ends inside a quoted field are returned as they are."""
    _lines(spark, paths).write.parquet(f"{folder}/lines")
    lines = spark.read.parquet(f"{folder}/lines")
    _blocks(lines, strict).write.parquet(f"{folder}/blocks")
    blocks = spark.read.parquet(f"{folder}/blocks")         # one row a block: Spark broadcasts it where it is small
    key = ["_path", "_block"]
    dirty = ~F.col("unclosed") & ((F.col("odd") > 0) | (F.col("before") % 2 == 1))
    header = F.col("head") & (F.col("_at") == F.col("first"))
    placed = lines.join(blocks, key)
    whole = placed.where(~dirty & ~header).select("_path", F.col("value").alias("record"))

    earlier = Window.partitionBy(*key).orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    passed = F.col("before") + F.coalesce(F.sum(F.col("_odd").cast("long")).over(earlier), F.lit(0))
    ordered = placed.where(dirty).withColumn("_passed", passed)
    broken = F.col("_odd") | (F.col("_passed") % 2 == 1)
    in_order = F.array_sort(F.collect_list(F.struct("_block", "_at", "value")))
    joined = (ordered.where(broken).groupBy("_path", F.floor(F.col("_passed") / 2).alias("_record"))
              .agg(in_order.alias("parts"), F.max(header).alias("header"))
              .where(~F.col("header")).select("_path", F.array_join("parts.value", "\n").alias("record")))
    between = ordered.where(~broken & ~header).select("_path", F.col("value").alias("record"))
    records = whole.unionByName(between).unionByName(joined)
    return (records.where(F.trim("record", F.lit(" \t\r")) != "")
                   .select("_path", F.regexp_replace("record", r"\r\z", "").alias("record")))


def parse_records(records: DataFrame, schema: T.StructType, mode: str = "FAILFAST") -> DataFrame:
    """The fields of ``schema`` (by position), and ``_path``."""
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    fields = F.from_csv("record", ddl, {**PARSE_OPTIONS, "mode": mode})
    return records.select("_path", fields.alias("_fields")).select("_path", "_fields.*")
