"""SQL-dump load and write as plain Spark text jobs (no database, no SQL parser).

The dump is read line by line, so a table held in one huge ``INSERT`` statement is
still spread over every input split.  Files whose lines are all whole statements need no more than that.  Lines are classified as ``INSERT INTO`` headers
(with or without a schema name and a column list), tuple lines ``(...)`` or other (DDL,
``--`` comments, blank).  A tuple line belongs to the last header above it in the same
file, which is carried over splits together with the strings' state.  Headers may carry tuples on their own line.

Strings in single quotes may go over several lines, also from one split into the next: the state at the
beginning of each line (inside a string or not) is composed over lines and splits (``sources.lines``), and the lines of
one tuple are put together before it is taken apart.

Tuples and values are found by quote-aware patterns: strings with
backslash escapes or doubled quotes; a bare ``NULL`` is null, a quoted one is text.
Values go to columns by the statement's column list, else by position.  A line that does
not parse, or a dump that ends inside a string, is an error.

``_file`` and ``_ord`` (increasing in file order within a file) are kept so that
keep-first deduplication can follow file order.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.session import scratch_path, stored_table
from zonelake.sources.lines import count_of, physical_lines, records

_STRING = r"'(?:[^'\\]++|\\.|'')*+'"
_TUPLE = rf"\((?:[^'()]++|{_STRING})*+\)"
_ITEM = rf"\G\s*,?\s*{_TUPLE}"  # the next tuple of a list, without a gap
_TAIL = r"(?s)^\s*[,;]?\s*(?:--.*)?$"
_VALUE = rf"(?s)(?:^|,)\s*({_STRING}|[^,']*?)\s*(?=,|$)"
_HEADER = r"(?is)^\s*INSERT\s+INTO\s+(?:[`\"]?\w+[`\"]?\.)?[`\"]?(\w+)[`\"]?\s*(?:\(([^)]*)\))?\s*VALUES\s*"


def _ends_inside(line):
    """1 if a line of code ends inside a string, else 0: complete strings and a comment behind them are left out."""
    bare = F.regexp_replace(F.regexp_replace(line, r"\\.", ""), "'[^']*'", "")
    commented = count_of(F.regexp_replace(bare, "^([^']*?)--.*", "$1"), "'")
    quotes = count_of(F.replace(F.replace(line, F.lit("\\\\"), F.lit("")), F.lit("\\'"), F.lit("")), "'") % 2
    return F.when(F.contains(line, F.lit("--")), commented).otherwise(quotes).cast("long")


def _placed_lines(spark: SparkSession, path: str, outside, inside, statement, loose) -> DataFrame:
    """The records of the dump: value, _file, _ord (grows in a file), _into (the header they belong to).

    A file in which every line ends outside strings and brings its own header has a record a line, each where it is.
    Only the lines of the other files need the state and the header that the lines before them lead to.
    """
    lines = physical_lines(spark, path)
    files = stored_table(lines.groupBy("_file").agg(F.max((outside == 1) | loose).alias("_carries")), "dump-files")
    kinds = {r[0] for r in files.select("_carries").distinct().collect()}
    plain = lines.select("value", "_file", F.struct(F.col("_block").alias("block"), F.col("_id").alias("row")).alias("_ord"), statement.alias("_into"))
    if True not in kinds:
        return plain
    carrying = files.where("_carries").select("_file")
    # a line that begins outside or inside a string and where that leads: mostly the other way round, so it adds; else it sets
    carried = records(lines if False not in kinds else lines.join(carrying, "_file", "left_semi"), outside, lambda s: s % 2 == 0, lambda s: s % 2 == 1,
                      "the dump ends inside a string", F.when(outside == inside, outside), statement) \
        .select("value", "_file", F.struct(F.col("_ord").alias("block"), F.lit(0).cast("long").alias("row")).alias("_ord"), F.col("mark").alias("_into"))
    return carried if False not in kinds else plain.join(carrying, "_file", "left_anti").select(plain.columns).unionByName(carried)


def insert_tuples(spark: SparkSession, path: str) -> DataFrame:
    """One row per VALUES tuple: ``table``, ``columns`` (null without a list), ``_file``, ``_ord``, ``_pos``, ``values``."""
    header = F.regexp_extract("value", _HEADER, 1)
    names = F.regexp_extract("value", _HEADER, 2)
    columns = F.when(names != "", F.transform(F.split(names, ","), lambda c: F.regexp_replace(c, r"[\s`\"]", "")))
    statement = F.when(header != "", F.struct(header.alias("t"), columns.alias("c")))
    loose = F.col("value").rlike(r"^\s*\(")
    outside, inside = _ends_inside(F.col("value")), _ends_inside(F.concat(F.lit("'"), F.col("value")))
    lines = _placed_lines(spark, path, outside, inside, statement, loose) \
        .select(F.regexp_replace("value", "\r$", "").alias("value"), "_file", "_ord", "_into")
    kind = F.when(header != "", "header").when(loose, "tuple")
    lines = lines.withColumn("_kind", kind).where("_kind is not null and _into is not null")

    behind = F.substring(F.col("value"), F.length(F.regexp_extract("value", _HEADER, 0)) + 1, F.length("value"))
    content = F.btrim(F.when(F.col("_kind") == "tuple", F.col("value")).otherwise(behind))
    lines = lines.select("value", "_file", "_ord", "_into", content.alias("content"))
    lines = lines.withColumn("items", F.regexp_extract_all("content", F.lit(_ITEM), F.lit(0)))
    tail = F.substring(F.col("content"), F.aggregate("items", F.lit(1), lambda n, x: n + F.length(x)), F.length("content"))
    bad = (F.col("content") != "") & ~F.col("content").startswith("--") & ((F.size("items") == 0) | ~tail.rlike(_TAIL))
    error = F.raise_error(F.concat(F.lit("INSERT line does not parse: "), F.substring("value", 1, 200)))
    # outer, for else a filter on the size of the list would be put before all this and take the lines apart twice
    rows = lines.withColumn("items", F.when(bad, error.cast("array<string>")).otherwise(F.col("items"))) \
        .select(F.col("_into.t").alias("table"), F.col("_into.c").alias("columns"), "_file", "_ord", F.posexplode_outer("items").alias("_pos", "t")) \
        .where("t is not null")
    body = F.btrim(F.expr("substring(t, instr(t, '(') + 1, length(t) - instr(t, '(') - 1)"))
    return rows.select("table", "columns", "_file", "_ord", "_pos", F.regexp_extract_all(body, F.lit(_VALUE), F.lit(1)).alias("values"))


def _text(value):
    """Content of a string literal; a bare value as it is, a bare NULL as null."""
    inner = F.substring(value, F.lit(2), F.length(value) - 2)
    # doubled quotes first: of quotes in a row only the first can be escaped, so pairs from the left leave the right number
    inner = F.replace(inner, F.lit("''"), F.lit("'"))

    def unescaped(part):
        for letter, meant in (("\\n", "\n"), ("\\r", "\r"), ("\\", "")):
            part = F.replace(part, F.lit(letter), F.lit(meant))
        return part

    # what is between escaped backslashes holds no other backslash but those that escape
    several = F.array_join(F.transform(F.split(inner, r"\\\\"), unescaped), "\\")
    inner = F.when(F.contains(inner, F.lit("\\\\")), several).otherwise(unescaped(inner))
    plain = F.when(F.upper(value) == "NULL", F.lit(None)).otherwise(value)
    return F.when(value.startswith("'"), inner).otherwise(plain)


def read_sql_dump(spark: SparkSession, path: str,
                  schemas: Mapping[str, T.StructType]) -> dict[str, DataFrame]:
    """Every table of the dump named in ``schemas`` as a typed DataFrame (plus ``_file``, ``_ord``, ``_pos``).

    The dump is read once: its tuples are stored by table and each table reads its own part.
    """
    store = scratch_path(spark, "dump-tuples")
    tuples = insert_tuples(spark, path)
    tuples.write.partitionBy("table").parquet(store)
    stored = spark.read.schema(tuples.schema).parquet(store)
    out = {}
    for name, schema in schemas.items():
        columns = []
        for i, f in enumerate(schema.fields):
            named = F.get("values", F.array_position("columns", f.name).cast("int") - 1)
            value = F.when(F.col("columns").isNull(), F.get("values", F.lit(i))).when(F.array_contains("columns", f.name), named)
            text = _text(value)
            columns.append((text if isinstance(f.dataType, T.StringType) else text.try_cast(f.dataType)).alias(f.name))
        out[name] = stored.where(F.col("table") == name).select(*columns, "_file", "_ord", "_pos")
    return out


def _sql_literal(field: T.StructField):
    c = F.col(f"`{field.name}`")
    if isinstance(field.dataType, (T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)):
        text = c.cast("string")
        escaped = F.replace(F.replace(text, F.lit("\\"), F.lit("\\\\")), F.lit("'"), F.lit("\\'"))
        escaped = F.replace(F.replace(escaped, F.lit("\n"), F.lit("\\n")), F.lit("\r"), F.lit("\\r"))
        lit = F.concat(F.lit("'"), escaped, F.lit("'"))
    elif isinstance(field.dataType, T.BooleanType):
        lit = F.when(c, F.lit("true")).otherwise(F.lit("false"))
    else:
        lit = c.cast("string")
    return F.coalesce(lit, F.lit("NULL"))


def write_sql_dump(df: DataFrame, path: str, table: str) -> None:
    """Write ``df`` as ``INSERT`` statements, one statement per row, one line each.

    One statement per row keeps every record small and the dump splittable; line ends in
    texts are escaped.
    """
    cols = ", ".join(f.name for f in df.schema.fields)
    values = F.concat_ws(", ", *[_sql_literal(f) for f in df.schema.fields])
    stmt = F.concat(F.lit(f"INSERT INTO {table} ({cols}) VALUES ("), values, F.lit(");"))
    df.select(stmt.alias("value")).write.mode("overwrite").text(path)
