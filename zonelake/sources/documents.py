"""CSV with line ends inside quotes and JSON arrays, each file read by as many tasks as it has splits."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.sources.lines import count_of, physical_lines, records


def read_csv_records(spark: SparkSession, path: str, schema: T.StructType, options: dict) -> DataFrame:
    """CSV files with a header, typed by ``schema``, plus ``_file`` and ``_ord`` (grows in a file).

    Quotes inside fields are doubled, so a line begins inside a field exactly if an odd number of quote characters stands before
    it.  A file that ends inside quotes is an error; blank lines between records are skipped.
    Lines end with a line feed, with or without a carriage return before it.
    """
    lines = physical_lines(spark, path)
    rows = records(lines, count_of(F.col("value"), '"'), lambda s: s % 2 == 0, lambda s: s % 2 == 1, "the file ends inside a quoted field")
    text = F.regexp_replace("value", "\r$", "")
    rows = rows.where(~F.col("first")).select(text.alias("value"), "_file", "_ord").where(F.trim("value") != "")
    parsed = F.from_csv("value", schema.simpleString(), {**options, "multiLine": "true", "mode": "PERMISSIVE"})
    return rows.select(parsed.alias("r"), "_file", "_ord").select("r.*", "_file", "_ord")


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that hold a JSON array of objects each, typed by ``schema``, plus ``_file`` and ``_ord`` (grows in a file).

    Strings hold no raw line ends, so a line's nesting is what is left without them.  Lines that begin at the level of
    the array's elements begin a record of one or several elements; a file that is one line is one record.
    A malformed element, a file that isn't closed or doesn't hold an array is an error.
    """
    lines = physical_lines(spark, path)
    bare = F.regexp_replace(F.regexp_replace("value", r"\\.", ""), '"[^"]*"', "")
    adds = count_of(bare, "{") + count_of(bare, "[") - count_of(bare, "}") - count_of(bare, "]")
    rows = records(lines, adds, lambda s: s <= 1, lambda s: s != 0, "the brackets of the file do not match")
    text = F.regexp_replace("value", r"^[\s﻿]+|\s+$", "")
    opens = (F.col("state") == 0) & (text != "")
    no_array = F.raise_error(F.concat(F.lit("the file does not hold a JSON array: "), F.col("_file"))).cast("string")
    inner = F.when(~opens, text).when(text.startswith("["), F.substring(text, 2, 1 << 30)).otherwise(no_array)
    rows = rows.select(inner.alias("value"), "_file", "_ord")
    # the closing bracket of the array is the one that has no partner in the record
    bare = F.regexp_replace(F.regexp_replace("value", r"\\.", ""), '"[^"]*"', "")
    level = count_of(bare, "{") + count_of(bare, "[") - count_of(bare, "}") - count_of(bare, "]")
    body = F.when(level < 0, F.regexp_replace("value", r"\]\s*$", "")).otherwise(F.col("value"))
    rows = rows.select(F.regexp_replace(body, r"^\s*,|,\s*$", "").alias("value"), "_file", "_ord").where(F.trim("value") != "")
    items = F.from_json(F.concat(F.lit("["), F.col("value"), F.lit("]")), T.ArrayType(schema), {"mode": "FAILFAST"})
    return rows.select(F.posexplode(items).alias("_pos", "r"), "_file", "_ord") \
        .select("r.*", "_file", F.struct(F.col("_ord").alias("line"), F.col("_pos").alias("pos")).alias("_ord"))
