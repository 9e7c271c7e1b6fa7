"""Enrichment: reference joins, hourly profiles, weekday labels, nearest reference point."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonelake.functions.aggregates import sum_or_zero
from zonelake.functions.scalar import ordinal, row_argmax, time_of_day, weekday_name
from zonelake.functions.totals import grouped
from zonelake.operators.dedup import dedup_keep_first
from zonelake.operators.joins import salted_join
from zonelake.session import stored_table


def left_enrich(df: DataFrame, info: DataFrame, keys: Sequence[str],
                info_order: Sequence[str] | None = None) -> DataFrame:
    """``df`` left-joined with reference ``info`` on ``keys``.

    ``info`` is first reduced to one row per key (keep-first), so a duplicated
    reference key cannot fan rows out.  Null keys stay unmatched (SQL equality).
    Keys of ``df`` that hold more than an even share of its rows are spread over several
    tasks (the reference rows of those keys are replicated), because the aggregation on
    the reference side keeps AQE from splitting a skewed join by itself.  The reference side is still broadcast when its measured size is small.
    """
    return salted_join(df, dedup_keep_first(info, keys, info_order), keys, "left")


def hourly_profile(df: DataFrame, ts_col: str, sum_cols: Sequence[str], mean_cols: Sequence[str] = (),
                   level_col: str | None = None, level_map: Mapping[str, int] | None = None,
                   bucket: str = "time", out_col: str = "hora", level_out: str | None = None,
                   exact_means: bool = False) -> DataFrame:
    """Group by time of day: sums of count columns, means of measures and of an ordinal level.

    ``bucket="time"`` groups by the full ``HH:mm:ss``; ``"hour"`` truncates to the hour
    first.  Rows whose time is null are dropped; an all-null sum is 0; means skip nulls.
    With ``exact_means`` the means are taken from exact sums.
    Result ordered by time ascending.
    """
    ts = F.col(ts_col)
    key = time_of_day(F.date_trunc("hour", ts) if bucket == "hour" else ts)
    rows, order = df.where(ts.isNotNull()), F.col(out_col).asc_nulls_last()
    levels = {level_out or level_col: ordinal(level_col, level_map or {})} if level_col else {}
    if exact_means:
        out = grouped(rows, {out_col: key}, {f"_s_{c}": c for c in mean_cols},
                      {**{c: ("sum", c) for c in sum_cols}, **{name: ("avg", c) for name, c in levels.items()}},
                      means={c: f"_s_{c}" for c in mean_cols})
        return out.select(out_col, *(F.coalesce(c, F.lit(0)).alias(c) for c in sum_cols), *mean_cols, *levels).orderBy(order)
    aggs = [sum_or_zero(c).alias(c) for c in sum_cols] + [F.avg(c).alias(c) for c in mean_cols] + [F.avg(c).alias(name) for name, c in levels.items()]
    return rows.groupBy(key.alias(out_col)).agg(*aggs).orderBy(order)


def top_hours(profile: DataFrame, level_col: str, total_col: str, count_cols: Sequence[str],
              n: int = 5, time_col: str = "hora", argmax_col: str = "vehiculo_predominante") -> DataFrame:
    """The ``n`` times with the highest mean level (ties: earlier time) and the dominant count column."""
    return (profile.select(time_col, level_col, total_col, row_argmax(list(count_cols)).alias(argmax_col))
            .orderBy(F.col(level_col).desc_nulls_last(), F.col(time_col).asc())
            .limit(n))


def with_weekday(df: DataFrame, date_col: str, out_col: str = "dia_semana") -> DataFrame:
    return df.withColumn(out_col, weekday_name(date_col))


def drop_strict(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns that must exist (a missing one is an error)."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise KeyError(f"columns not found: {missing}")
    return df.drop(*cols)


def drop_lenient(df: DataFrame, *cols: str) -> DataFrame:
    """Drop columns if present."""
    return df.drop(*cols)


# ---------------------------------------------------------------------------------------
# Nearest reference point (k = 1, Euclidean distance in the coordinate units).
#
# Exact search down a grid hierarchy instead of a points x references product.  References
# that share a place count once (lowest id).  A cell with more than LEAF_REFS places is cut
# into four, level by level; only crowded cells go deeper.  Each point carries the few cells
# that may hold its nearest reference: a cell goes as soon as the least distance to its
# bounding box exceeds the least of the farthest distances to the boxes the point has seen
# (some reference is at least that near).  What is left at the end are leaves, and only
# their references are compared.  Ties go to the lowest reference id.  Points with a null,
# NaN or infinite coordinate get no reference.
# ---------------------------------------------------------------------------------------

LEAF_REFS = 64
DEEPEST = 40  # cells are then 2**-40 of the extent wide


def _finite(c: str):
    return F.col(c).isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf")))


def _grid(refs: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Cells per level (level, gx, gy, box, leaf) and the references with their leaf (level, gx, gy)."""
    minx, maxx, miny, maxy = refs.agg(F.min("_rx"), F.max("_rx"), F.min("_ry"), F.max("_ry")).first()
    if minx is None:
        return [], None
    extent = max(maxx - minx, maxy - miny)

    def place(c: str, least: float):
        unit = (F.col(c) - F.lit(least)) / F.lit(extent) if extent else F.lit(0.0)
        return F.least(F.floor(unit * F.lit(float(2 ** DEEPEST))), F.lit(2 ** DEEPEST - 1)).cast("long")

    open_ = stored_table(refs.select("*", place("_rx", minx).alias("_ix"), place("_ry", miny).alias("_iy")), "grid-places")
    levels, leaves = [], None
    for level in range(DEEPEST + 1):
        at = open_.select("*", F.shiftright("_ix", DEEPEST - level).alias("_gx"), F.shiftright("_iy", DEEPEST - level).alias("_gy"))
        cells = at.groupBy("_gx", "_gy").agg(
            F.count(F.lit(1)).alias("_n"), F.min("_rx").alias("_x0"), F.max("_rx").alias("_x1"),
            F.min("_ry").alias("_y0"), F.max("_ry").alias("_y1"))
        cells = stored_table(cells.withColumn("_leaf", (F.col("_n") <= LEAF_REFS) | F.lit(level == DEEPEST)), "grid-cells")
        levels.append(cells)
        marked = stored_table(at.join(cells.select("_gx", "_gy", "_leaf"), ["_gx", "_gy"]), "grid-places")
        done = marked.where("_leaf").select(F.lit(level).alias("_level"), "_gx", "_gy", "_rid", "_rx", "_ry")
        leaves = done if leaves is None else leaves.unionByName(done)
        if cells.where("not _leaf").isEmpty():
            return levels, leaves
        open_ = marked.where("not _leaf").drop("_gx", "_gy", "_leaf")
    return levels, leaves


def _square_distance(near: bool):
    """Squared distance of the point to the nearest or farthest place of the box."""
    def side(p: str, low: str, high: str):
        if near:
            return F.greatest(F.col(low) - F.col(p), F.col(p) - F.col(high), F.lit(0.0))
        return F.greatest(F.abs(F.col(p) - F.col(low)), F.abs(F.col(p) - F.col(high)))
    dx, dy = side("_px", "_x0", "_x1"), side("_py", "_y0", "_y1")
    return dx * dx + dy * dy


def nearest_reference(points: DataFrame, refs: DataFrame, x: str, y: str, ref_id: str,
                      ref_x: str, ref_y: str, out_col: str = "nearest_id") -> DataFrame:
    """Distinct finite (x, y) of ``points`` with the id of the nearest row of ``refs``.

    Returns columns ``x, y, out_col, _d2`` (squared distance).  Join the result back to
    the full point table on (x, y): every distinct location is searched once.
    """
    pts = points.select(F.col(x).cast("double").alias("_px"), F.col(y).cast("double").alias("_py")) \
        .where(_finite("_px") & _finite("_py")).distinct()
    rf = refs.select(F.col(ref_id).alias("_rid"), F.col(ref_x).cast("double").alias("_rx"),
                     F.col(ref_y).cast("double").alias("_ry")) \
        .where(_finite("_rx") & _finite("_ry")).groupBy("_rx", "_ry").agg(F.min("_rid").alias("_rid"))
    levels, leaves = _grid(rf)
    if not levels:
        return pts.select(F.col("_px").alias(x), F.col("_py").alias(y),
                          F.lit(None).cast(refs.schema[ref_id].dataType).alias(out_col),
                          F.lit(None).cast("double").alias("_d2"))
    # one row per point: the best bound so far, the leaves kept and the crowded cells to go into
    cell = "struct<lo: double, level: int, gx: bigint, gy: bigint, leaf: boolean>"
    state = pts.select("_px", "_py", F.lit(float("inf")).alias("_bound"), F.expr(f"cast(array() as array<{cell}>)").alias("_kept"),
                       F.expr("array(named_struct('gx', 0L, 'gy', 0L))").alias("_into"))
    for level, cells in enumerate(levels):
        if level == 0:
            boxes = cells.select(F.col("_gx").alias("_ux"), F.col("_gy").alias("_uy"), "*")
        else:
            boxes = cells.select(F.shiftright("_gx", 1).alias("_ux"), F.shiftright("_gy", 1).alias("_uy"), "*")
        if level <= 5:
            boxes = F.broadcast(boxes)  # 4 ** 5 cells at most
        going = state.select("_px", "_py", F.explode("_into").alias("_u")) \
            .select("_px", "_py", F.col("_u.gx").alias("_ux"), F.col("_u.gy").alias("_uy"))
        seen = going.join(boxes, ["_ux", "_uy"]).groupBy("_px", "_py").agg(
            F.min(_square_distance(near=False)).alias("_far"),
            F.collect_list(F.struct(_square_distance(near=True).alias("lo"), F.lit(level).alias("level"), F.col("_gx").alias("gx"),
                                    F.col("_gy").alias("gy"), F.col("_leaf").alias("leaf"))).alias("_new"))
        state = state.drop("_into").join(seen, ["_px", "_py"], "left") \
            .withColumn("_bound", F.least("_bound", F.coalesce("_far", F.lit(float("inf"))))) \
            .withColumn("_all", F.filter(F.concat("_kept", F.coalesce("_new", F.expr(f"cast(array() as array<{cell}>)"))),
                                         lambda c: c["lo"] <= F.col("_bound"))) \
            .select("_px", "_py", "_bound", F.filter("_all", lambda c: c["leaf"]).alias("_kept"),
                    F.transform(F.filter("_all", lambda c: ~c["leaf"]), lambda c: F.struct(c["gx"].alias("gx"), c["gy"].alias("gy"))).alias("_into"))
        if level % 4 == 3:
            state = stored_table(state, "grid-search")
    dx, dy = F.col("_px") - F.col("_rx"), F.col("_py") - F.col("_ry")
    best = state.select("_px", "_py", F.explode("_kept").alias("_c")) \
        .select("_px", "_py", F.col("_c.level").alias("_level"), F.col("_c.gx").alias("_gx"), F.col("_c.gy").alias("_gy")) \
        .join(leaves, ["_level", "_gx", "_gy"]).groupBy("_px", "_py") \
        .agg(F.min(F.struct((dx * dx + dy * dy).alias("_d2"), F.col("_rid"))).alias("_b"))
    return best.select(F.col("_px").alias(x), F.col("_py").alias(y), F.col("_b._rid").alias(out_col), F.col("_b._d2").alias("_d2"))


def assign_nearest(df: DataFrame, refs: DataFrame, x: str, y: str, ref_id: str, ref_x: str, ref_y: str,
                   out_col: str) -> DataFrame:
    """``df`` with ``out_col`` = id of the nearest reference (null for a null coordinate)."""
    near = nearest_reference(df, refs, x, y, ref_id, ref_x, ref_y, out_col).drop("_d2")
    keyed = df.withColumn("_px", F.col(x).cast("double")).withColumn("_py", F.col(y).cast("double"))
    near = near.withColumnRenamed(x, "_px").withColumnRenamed(y, "_py")
    # many rows may share one location: the join back is salted on hot locations
    return salted_join(keyed, near, ["_px", "_py"], "left").drop("_px", "_py")
