"""Observe-only data quality rules.

Checks never filter or fail a load: they produce rows of a ``quality_checks`` table.
All column rules of one dataset, the ``unique`` ones included, are answered by one scan and one shuffle:
every row gives a pair (rule, value) for each unique rule and one for the row itself, the pairs are
counted map-side first, and the row's own pair carries the counts of the other rules.  A ``references``
rule is one left join against the distinct parent keys.

A job that writes a dataset can count the row rules on the way (``observed``), so that only unique and
references rules read what was written.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.sources.io import utc

RULE_KINDS = ("no_nulls", "unique", "accepted_values", "range", "references")


@dataclass(frozen=True)
class Rule:
    kind: str
    column: str
    values: tuple = ()
    low: float | None = None
    high: float | None = None
    parent: DataFrame | None = field(default=None, compare=False)
    parent_column: str | None = None

    def __post_init__(self):
        if self.kind not in RULE_KINDS:
            raise ValueError(f"unknown rule kind {self.kind}")


def no_nulls(*cols: str) -> list[Rule]:
    return [Rule("no_nulls", c) for c in cols]


def unique(*cols: str) -> list[Rule]:
    return [Rule("unique", c) for c in cols]


def accepted_values(col: str, values: Sequence) -> Rule:
    return Rule("accepted_values", col, values=tuple(values))


def in_range(col: str, low: float | None = None, high: float | None = None) -> Rule:
    return Rule("range", col, low=low, high=high)


def references(col: str, parent: DataFrame, parent_column: str) -> Rule:
    return Rule("references", col, parent=parent, parent_column=parent_column)


_DETAILS = {
    "no_nulls": " null values found",
    "unique": " duplicate values found",
    "accepted_values": " values outside the accepted list",
    "range": " values out of range",
    "references": " orphan keys found",
}

CHECK_SCHEMA = T.StructType([
    T.StructField("dataset", T.StringType()),
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("row_count", T.LongType()),
    T.StructField("rule_idx", T.IntegerType()),
    T.StructField("check_type", T.StringType()),
    T.StructField("column", T.StringType()),
    T.StructField("passed", T.BooleanType()),
    T.StructField("bad_count", T.LongType()),
    T.StructField("details", T.StringType()),
])


def _is_missing(df: DataFrame, c: str) -> Column:
    col = F.col(f"`{c}`")
    dtype = df.schema[c].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return col.isNull() | F.isnan(col)   # pandas counts NaN as null
    return col.isNull()


def _bad(df: DataFrame, rule: Rule) -> Column:
    """Whether a row breaks a row rule."""
    col = F.col(f"`{rule.column}`")
    if rule.kind == "no_nulls":
        cond = _is_missing(df, rule.column)
    elif rule.kind == "accepted_values":
        cond = ~col.isin(*rule.values)          # null passes, as in a SQL CHECK
    else:  # range
        parts = []
        if rule.low is not None:
            parts.append(col < F.lit(rule.low))
        if rule.high is not None:
            parts.append(col > F.lit(rule.high))
        cond = reduce(lambda a, b: a | b, parts) if parts else F.lit(False)
    return F.coalesce(cond, F.lit(False))


ROW_RULES = ("no_nulls", "accepted_values", "range")
SHORT = 32          # bytes; longer texts are compared by their SHA-256


def _value_key(df: DataFrame, c: str) -> Column:
    """A text that two values of the column share exactly if they are equal; null for null."""
    col, dtype = F.col(f"`{c}`"), df.schema[c].dataType
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        text = F.when(col == 0, F.lit("0.0")).otherwise(col.cast("string"))      # -0.0 equals 0.0
    elif isinstance(dtype, T.BinaryType):
        text = F.hex(col)
    elif isinstance(dtype, (T.ArrayType, T.StructType, T.MapType)):
        text = F.when(col.isNotNull(), F.to_json(F.struct(col), {"ignoreNullFields": "false"}))
    else:
        text = col.cast("string")
    return F.when(F.octet_length(text) > SHORT, F.sha2(text, 256)).otherwise(text)


def applicable(df: DataFrame, rules: Sequence[Rule]) -> list[Rule]:
    """Rules on a column that the frame has."""
    return [r for r in rules if r.column in df.columns]


def observed(df: DataFrame, rules: Sequence[Rule]) -> list[Column]:
    """Metrics for ``DataFrame.observe``: ``rows``, and ``bad_<i>`` for each row rule."""
    row_rules = [(i, r) for i, r in enumerate(applicable(df, rules)) if r.kind in ROW_RULES]
    return [F.count(F.lit(1)).alias("rows"), *(F.count_if(_bad(df, r)).cast("long").alias(f"bad_{i}") for i, r in row_rules)]


def _rule_row(idx: int, rule: Rule, bad: Column, rows: Column) -> Column:
    return F.struct(F.lit(idx).alias("rule_idx"), F.lit(rule.kind).alias("check_type"),
                    F.lit(rule.column).alias("column"), bad.alias("bad_count"),
                    rows.alias("row_count"))


def _one_scan(df: DataFrame, row_rules: list, unique_rules: list) -> DataFrame:
    """Rows of ``_rule_row`` for row and unique rules: pairs (rule, value) counted in one shuffle."""
    own = F.struct(F.lit(-1).alias("rule"), F.lit(None).cast("string").alias("key"))
    pairs = F.array(own, *(F.struct(F.lit(i).alias("rule"), _value_key(df, r.column).alias("key")) for i, r in unique_rules))
    rows = df.select(*(_bad(df, r).alias(f"_b{i}") for i, r in row_rules), F.explode(pairs).alias("p"))
    is_own = F.col("p.rule") == -1
    held = rows.groupBy("p.rule", "p.key").agg(
        F.count(F.lit(1)).alias("n"), *(F.count_if(is_own & F.col(f"_b{i}")).alias(f"_b{i}") for i, _ in row_rules))
    repeated = F.when(F.col("key").isNull(), F.col("n")).otherwise(F.col("n") - 1)
    per_rule = held.groupBy("rule").agg(F.sum("n").alias("n"), F.sum(repeated).alias("repeated"), *(F.sum(f"_b{i}").alias(f"_b{i}") for i, _ in row_rules))
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    at = lambda i, c: F.max(F.when(F.col("rule") == i, F.col(c)))
    one = per_rule.agg(zero(at(-1, "n")).alias("rows"), *(zero(at(-1, f"_b{i}")).alias(f"bad_{i}") for i, _ in row_rules),
                       *(zero(at(i, "repeated")).alias(f"bad_{i}") for i, _ in unique_rules))
    return one.select(F.explode(F.array(*(_rule_row(i, r, F.col(f"bad_{i}"), F.col("rows")) for i, r in sorted(
        row_rules + unique_rules, key=lambda x: x[0])))).alias("r")).select("r.*")


def run_checks(df: DataFrame, dataset: str, rules: Sequence[Rule], timestamp: _dt.datetime | None = None,
               metrics: dict | None = None) -> DataFrame:
    """Evaluate ``rules`` on ``df``; one output row per applicable rule.

    Rules on a column the frame does not have are skipped (as the reference does).
    ``passed`` is ``bad_count == 0``.  For ``unique`` every null counts as a duplicate
    (row count minus distinct non-null values).  ``metrics`` are what a write of ``df`` has observed
    (``observed``); the row rules are then taken from there.  An unset time is null.
    """
    rules = applicable(df, rules)
    spark = df.sparkSession
    parts: list[DataFrame] = []

    row_rules = [(i, r) for i, r in enumerate(rules) if r.kind in ROW_RULES]
    unique_rules = [(i, r) for i, r in enumerate(rules) if r.kind == "unique"]
    if metrics is not None and row_rules:
        parts.append(spark.createDataFrame([(i, r.kind, r.column, int(metrics[f"bad_{i}"]), int(metrics["rows"])) for i, r in row_rules],
                                           "rule_idx int, check_type string, column string, bad_count long, row_count long"))
        row_rules = []
    if row_rules or unique_rules:
        parts.append(_one_scan(df, row_rules, unique_rules))
    for i, r in enumerate(rules):
        if r.kind == "references":
            # rows per child key first (a hot key collapses map-side), then one row per key is joined
            per_key = df.groupBy(F.col(f"`{r.column}`").alias("_fk")).agg(F.count(F.lit(1)).alias("_n"))
            keys = r.parent.select(F.col(f"`{r.parent_column}`").alias("_pk")).distinct()
            joined = per_key.join(keys, F.col("_fk") == F.col("_pk"), "left")
            orphan = F.col("_fk").isNotNull() & F.col("_pk").isNull()
            one = joined.agg(F.coalesce(F.sum(F.when(orphan, F.col("_n"))), F.lit(0)).cast("long").alias("_bad"),
                             F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("_rows"))
            parts.append(one.select(_rule_row(i, r, F.col("_bad"), F.col("_rows")).alias("r")).select("r.*"))

    if not parts:
        return spark.createDataFrame([], CHECK_SCHEMA)
    rows = reduce(DataFrame.unionByName, parts)
    details = F.concat(F.col("bad_count").cast("string"),
                       F.element_at(F.create_map(*[x for k, v in _DETAILS.items() for x in (F.lit(k), F.lit(v))]),
                                    F.col("check_type")))
    return rows.select(
        F.lit(dataset).alias("dataset"), F.lit(None if timestamp is None else utc(timestamp)).cast("timestamp").alias("timestamp"),
        F.col("row_count").cast("long").alias("row_count"), F.col("rule_idx").cast("int").alias("rule_idx"),
        "check_type", "column", (F.col("bad_count") == 0).alias("passed"),
        F.col("bad_count").cast("long").alias("bad_count"), details.alias("details"))


def to_records(checks: DataFrame) -> DataFrame:
    """Nest checks into one record per (dataset, timestamp) with an array of checks."""
    item = F.struct(F.col("check_type").alias("check"), "column", "passed", "details")
    return (checks.groupBy("dataset", "timestamp", "row_count")
            .agg(F.sort_array(F.collect_list(F.struct("rule_idx", item.alias("c")))).alias("_cs"))
            .select("dataset", "timestamp", "row_count", F.col("_cs.c").alias("checks")))


def quality_report(records: DataFrame) -> DataFrame:
    """Flatten quality records to one row per check."""
    return (records.select("dataset", "timestamp", F.explode("checks").alias("c"))
            .select("dataset", "timestamp", F.col("c.check").alias("check_type"),
                    F.col("c.column").alias("column"), F.col("c.passed").alias("passed"),
                    F.col("c.details").alias("details")))


def quality_summary(report: DataFrame) -> DataFrame:
    """Per (dataset, check_type): passed_count, total_count, pass_rate in percent."""
    agg = report.groupBy("dataset", "check_type").agg(
        F.sum(F.col("passed").cast("long")).alias("passed_count"),
        F.count(F.lit(1)).alias("total_count"))
    return agg.withColumn("pass_rate",
                          F.try_divide(F.col("passed_count").cast("double"), F.col("total_count").cast("double"))
                          * F.lit(100.0))


def failed_checks(report: DataFrame) -> DataFrame:
    return report.where(~F.col("passed"))
