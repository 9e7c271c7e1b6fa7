"""Records that go over several physical lines, found by many tasks in one file.

A split of a text file begins anywhere, perhaps inside a quoted field or a nested element.  What is needed is the
state at the beginning of each line, from what the lines before it in the file add to it (quote characters, or levels
of nesting) or set it to.  Every split puts its own lines together; a table of one row a split does so with the splits.
Lines that are a whole record by themselves stay where they are; only the lines of longer records are grouped.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def physical_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of text files, cut at line feeds only: value, _file, _block (start of the split), _id."""
    return spark.read.option("lineSep", "\n").text(path).select(
        "value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_id"))


def count_of(text: Column, what: str) -> Column:
    """How often a character occurs."""
    return F.length(text) - F.length(F.replace(text, F.lit(what), F.lit("")))


def _prefix(df: DataFrame, adds: str, sets: str, window, prefix: str) -> DataFrame:
    """``df`` with the state that the rows before and up to each one lead to, in the window's order.

    A row adds ``adds`` to the state or, where ``sets`` is not null, sets it.  Given are {prefix}before and {prefix}after, relative to the
    state at the beginning of the window unless {prefix}set_before or {prefix}set_after tells that some row has set it.
    """
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    earlier = window.rowsBetween(Window.unboundedPreceding, -1)
    total = F.sum(F.when(F.col(sets).isNull(), F.col(adds)).otherwise(0)).over(upto)
    df = df.withColumn(f"{prefix}sum", total)
    df = df.withColumn(f"{prefix}off", F.col(sets) - F.col(f"{prefix}sum"))
    for name, frame, own in (("before", earlier, F.coalesce(F.lag(f"{prefix}sum").over(window), F.lit(0))), ("after", upto, F.col(f"{prefix}sum"))):
        off = F.last(f"{prefix}off", ignorenulls=True).over(frame)
        df = df.withColumn(f"{prefix}{name}", own + F.coalesce(off, F.lit(0))).withColumn(f"{prefix}set_{name}", off.isNotNull())
    return df


def records(lines: DataFrame, adds: Column, is_start, is_open, broken: str, sets: Column | None = None,
            mark: Column | None = None) -> DataFrame:
    """One row a record: value (its lines, joined by line feeds), _file, _ord (grows in a file), first, state, mark.

    ``adds`` is what a line adds to the state, or ``sets`` (where not null) the state after it, whatever it was before.  A record
    begins at each line for whose state before it ``is_start`` holds, and a file is ``broken`` (an error) if ``is_open`` holds for the
    state at its end.  ``first`` tells a file's first record, ``state`` is the state at the record's beginning, ``mark`` the last
    one (not null) of the lines that begin a record, up to this record's own.
    """
    split = Window.partitionBy("_file", "_block").orderBy("_id")
    upto = split.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    lines = lines.withColumn("_adds", adds.cast("long")).withColumn("_sets", F.lit(None).cast("long") if sets is None else sets.cast("long"))
    # a line has one byte at least, so block start + line number grows through the whole file
    lines = _prefix(lines.withColumn("_ord", F.col("_block") + F.row_number().over(split) - 1), "_adds", "_sets", split, "_l_")
    late = F.max_by(F.struct(F.col("_l_after").alias("state"), F.col("_l_set_after").alias("set")), "_id")
    per_split = lines.groupBy("_file", "_block").agg(late.alias("late"))
    per_split = per_split.select("_file", "_block", F.when(~F.col("late.set"), F.col("late.state")).otherwise(0).alias("_adds"),
                                 F.when(F.col("late.set"), F.col("late.state")).alias("_sets"))
    splits = Window.partitionBy("_file").orderBy("_block")
    before = splits.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy("_file")
    carry = _prefix(per_split, "_adds", "_sets", splits, "_s_").select(
        "_file", "_block", F.col("_s_before").alias("_carry"), F.max_by("_s_after", "_block").over(whole).alias("_end"),
        (F.col("_block") == F.min("_block").over(whole)).alias("_top"))
    error = F.raise_error(F.concat(F.lit(f"{broken}: "), F.col("_file"))).cast("string")
    state = lambda n: F.col(f"_l_{n}") + F.when(F.col(f"_l_set_{n}"), F.lit(0)).otherwise(F.col("_carry"))
    lines = lines.join(carry, ["_file", "_block"]).withColumn("_state", state("before")).withColumn("_next", state("after")) \
        .withColumn("value", F.when(is_open(F.col("_end")), error).otherwise(F.col("value"))) \
        .withColumn("_start", is_start(F.col("_state"))).withColumn("_first", F.col("_top") & (F.row_number().over(split) == 1))
    begun = F.struct(F.col("_ord").alias("o"), F.col("_first").alias("f"), F.col("_state").alias("s"))
    lines = lines.withColumn("_own", F.when(F.col("_start"), begun)).withColumn("_last", F.last("_own", ignorenulls=True).over(upto))
    # the lines at the beginning of a split that belong to a record begun in an earlier one
    lines = lines.withColumn("_mark", F.when(F.col("_start"), F.lit(None).cast("string") if mark is None else mark)) \
        .withColumn("_marked", F.last("_mark", ignorenulls=True).over(upto))
    starts = lines.groupBy("_file", "_block").agg(F.max("_own").alias("_late"), F.max_by("_mark", F.when(F.col("_mark").isNotNull(), F.col("_id"))).alias("_late_mark"))
    early = starts.select("_file", "_block", *(F.last(a, ignorenulls=True).over(before).alias(b) for a, b in (("_late", "_early"), ("_late_mark", "_early_mark"))))
    lines = lines.join(early, ["_file", "_block"]).withColumn("_rec", F.coalesce("_last", "_early")).withColumn("_mark", F.coalesce("_marked", "_early_mark"))
    alone = F.col("_start") & is_start(F.col("_next"))
    single = lines.where(alone).select("value", "_file", "_ord", F.col("_first").alias("first"), F.col("_state").alias("state"), F.col("_mark").alias("mark"))
    joined = lines.where(~alone).groupBy("_file", F.col("_rec.o").alias("_ord")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(F.col("_ord").alias("o"), "value"))), lambda x: x["value"]), "\n").alias("value"),
        F.first("_rec.f").alias("first"), F.first("_rec.s").alias("state"), F.min_by("_mark", "_ord").alias("mark"))
    return single.unionByName(joined)
