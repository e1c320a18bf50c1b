"""CSV files whose cells hold line breaks and JSON files that are one array, read in splits.

A file is read as lines, split by split. Whether a line begins a record depends on everything before it in its file: on the
parity of quotes in a CSV file, on the depth of brackets in a JSON file. Both are sums, so each line's prefix is the sum of the splits
before its own, one row each, and the running sum inside its split.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from offerflow.workdir import written

_BLANK = r"^[\s﻿]*$"


def lines_of(spark: SparkSession, path: str) -> DataFrame:
    """``file``, ``block`` (where its split begins), ``at`` (rising inside a split) and ``value`` of every line."""
    rows = spark.read.option("lineSep", "\n").text(path)
    return rows.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
                       F.monotonically_increasing_id().alias("at"), "value")


def _records(lines: DataFrame, step: Column, begins: Callable[[Column], Column]) -> DataFrame:
    """``file``, ``first`` (the first record of its file) and ``record``: the lines from each beginning to the next.

    ``step`` is what a line adds to its file's sum, ``begins`` a condition on the sum before a line. A split's lines are put in order in one
    task, so a task holds as much as a split, and a record that goes on in later splits is put together by its first line's place.
    """
    lines = written(lines.withColumn("step", step.cast("long")), "lines")
    splits = lines.groupBy("file", "block").agg(F.sum("step").alias("whole"))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("file", "block", F.coalesce(F.sum("whole").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("file", "block").orderBy("at")
    passed = F.coalesce(F.sum("step").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = lines.join(splits, ["file", "block"]).withColumn("sum", F.col("before") + passed).drop("before", "step")
    mark = F.when(begins(F.col("sum")), F.struct("block", "at"))
    placed = written(placed.withColumn("mark", F.last(mark, True).over(inside.rowsBetween(Window.unboundedPreceding, 0))), "marked-lines")
    # a split that begins inside a record goes on with the last beginning before it
    last = placed.groupBy("file", "block").agg(F.max("mark").alias("mark"))
    carried = last.select("file", "block", F.last("mark", True).over(earlier).alias("carried"))
    whole = placed.join(carried, ["file", "block"]).withColumn("mark", F.coalesce("mark", "carried"))
    records = whole.groupBy("file", "mark").agg(F.array_join(F.transform(
        F.sort_array(F.collect_list(F.struct("block", "at", "value"))), lambda line: line["value"]), "\n").alias("record"))
    records = records.where(~F.col("record").rlike(_BLANK))
    opening = placed.where(~F.col("value").rlike(_BLANK)).groupBy("file").agg(F.min("mark").alias("opening"))
    return records.join(opening, "file").select("file", (F.col("mark") == F.col("opening")).alias("first"), "record")


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of CSV files with a header, in which a quote inside a quoted cell is doubled."""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"')))
    records = _records(lines_of(spark, path), quotes, lambda total: total % 2 == 0).where("NOT first")
    options = {"escape": '"', "multiLine": "true"}
    row = F.from_csv(F.regexp_replace("record", r"\r\z", ""), ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema), options)
    return records.select(row.alias("row")).select("row.*")


def _outside_strings(text: Column) -> Column:
    """JSON text without escapes and strings; as strings hold no line breaks, every line begins outside of one."""
    return F.regexp_replace(F.regexp_replace(text, r"\\.", ""), '"[^"]*"', "")


def _depth(text: Column) -> Column:
    """Brackets opened less brackets closed."""
    bare = _outside_strings(text)
    return F.length(F.translate(bare, "]}", "")) - F.length(F.translate(bare, "[{", ""))


def read_json(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows of JSON files that hold one array of objects, or objects one after the other, on any number of lines each."""
    lines, place = lines_of(spark, path), F.struct("block", "at")
    first = lines.where(~F.col("value").rlike(_BLANK)).groupBy("file").agg(F.min(F.struct(
        "block", "at", F.regexp_extract("value", r"([^\s﻿])", 1).alias("sign"))).alias("first"))
    # the bracket that opens the array does not count, so every element begins at depth 0
    opens = (place == F.struct("first.block", "first.at")) & (F.col("first.sign") == "[")
    lines = lines.join(written(first, "first-lines"), "file")
    lines = lines.select("file", "block", "at", "value", F.when(opens, 1).otherwise(0).alias("opens"))
    records = _records(lines, _depth(F.col("value")) - F.col("opens"), lambda depth: depth <= 0)
    records = records.withColumn("body", F.regexp_replace("record", r"^[\s﻿,]+", ""))
    records = records.withColumn("body", F.when(F.col("first") & F.col("body").startswith("["), F.expr("substring(body, 2)")).otherwise(F.col("body")))
    # what closes more than it opens ends the array
    records = records.withColumn("body", F.when(_depth(F.col("body")) < 0, F.regexp_replace("body", r"\]\s*\z", "")).otherwise(F.col("body")))
    elements = F.concat(F.lit("["), F.regexp_replace("body", r"^[\s,]+|[\s,]+\z", ""), F.lit("]"))
    kind = f"array<struct<{', '.join(f'`{f.name}`: {f.dataType.simpleString()}' for f in schema)}>>"
    rows = records.where(F.col("body").rlike(r"[^\s,]")).select(F.explode_outer(F.from_json(elements, kind)).alias("row"))
    return rows.select("row.*")
