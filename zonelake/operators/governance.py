"""Governance kept as tables: catalog, lineage, security policy, retention, masking."""

from __future__ import annotations

import datetime as _dt
import re
import uuid
from collections.abc import Mapping, Sequence
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.session import scratch_path

# --- catalog -----------------------------------------------------------------------------


def latest_per_key(records: DataFrame, keys: Sequence[str], ts_col: str) -> DataFrame:
    """Last write wins: the newest record per key (ties: the larger record)."""
    others = [c for c in records.columns if c not in keys]
    packed = F.struct(F.col(ts_col).alias("_ts"), F.struct(*others).alias("_r"))
    return records.groupBy(*keys).agg(F.max(packed).alias("_m")).select(*keys, "_m._r.*")


def metadata_catalog(records: DataFrame) -> DataFrame:
    """Latest metadata record per (bucket, object); missing names become ``'unknown'``."""
    filled = records.withColumn("source_bucket", F.coalesce("source_bucket", F.lit("unknown"))) \
        .withColumn("object_name", F.coalesce("object_name", F.lit("unknown")))
    return latest_per_key(filled, ["source_bucket", "object_name"], "uploaded_at")


def profile_tables(tables: Mapping[str, DataFrame], bucket: str, fmt: str = "parquet") -> DataFrame:
    """One metadata row per table: row count, column count.

    All tables are counted by one aggregation: each scan contributes only its table
    name (no data columns are read) and is pre-aggregated per task before the
    single shuffle.  Tables with no rows keep a count of 0.
    """
    spark = next(iter(tables.values())).sparkSession
    names = reduce(DataFrame.unionByName,
                   [df.select(F.lit(name).alias("object_name")) for name, df in tables.items()])
    counts = names.groupBy("object_name").agg(F.count(F.lit(1)).alias("rows"))
    listing = spark.createDataFrame([(n, len(df.columns)) for n, df in tables.items()],
                                    "object_name string, n_columns int")
    out = listing.join(counts, "object_name", "left").na.fill(0, subset=["rows"])
    return out.select(F.lit(bucket).alias("source_bucket"), "object_name", F.lit(fmt).alias("format"),
                      "rows", "n_columns")


# --- lineage -----------------------------------------------------------------------------

LINEAGE_SCHEMA = T.StructType([
    T.StructField("timestamp", T.TimestampType()),
    T.StructField("source", T.StructType([T.StructField("bucket", T.StringType()),
                                          T.StructField("object", T.StringType())])),
    T.StructField("target", T.StructType([T.StructField("bucket", T.StringType()),
                                          T.StructField("object", T.StringType())])),
    T.StructField("transformation", T.StringType()),
])


def lineage_edges(lineage: DataFrame) -> DataFrame:
    """Flat edge table (latest record per source/target pair)."""
    flat = lineage.select(F.col("source.bucket").alias("src_bucket"), F.col("source.object").alias("src_object"),
                          F.col("target.bucket").alias("dst_bucket"), F.col("target.object").alias("dst_object"),
                          "timestamp", "transformation")
    return latest_per_key(flat, ["src_bucket", "src_object", "dst_bucket", "dst_object"], "timestamp")


def _bucketed_table(spark: SparkSession, name: str) -> str:
    return f"zl_{name}_{uuid.uuid4().hex}"


def lineage_trace(edges: DataFrame, starts: DataFrame) -> DataFrame:
    """All ancestors of every start node, with the hop count at which each is first reached.

    ``edges``: src_bucket, src_object, dst_bucket, dst_object.  ``starts``: bucket, object.
    Breadth-first over all starts at once, one job per hop, on two written tables in
    the shared checkpoint folder:

    * the edges, bucketed on the target node: joining the frontier never shuffles them;
    * the visited (start, node) pairs, bucketed on that pair and partitioned by depth:
      each hop's new pairs are anti-joined with it without shuffling it (cycles end
      there) and appended to it; the next frontier is a partition-pruned read of the
      newest depth.

    Only the new frontier moves between tasks, so the work per hop follows the size of
    that hop.  The walk goes on until a hop is empty, however long the chains are.
    Output: start_bucket, start_object, bucket, object, depth (1 = direct source).
    """
    spark = edges.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = ["start_bucket", "start_object", "bucket", "object"]
    edge_table, seen_table = _bucketed_table(spark, "edges"), _bucketed_table(spark, "visited")
    seen_path = scratch_path(spark, "lineage-visited")
    (edges.select("src_bucket", "src_object", "dst_bucket", "dst_object").dropDuplicates()
     .write.bucketBy(n, "dst_bucket", "dst_object").option("path", scratch_path(spark, "lineage-edges"))
     .saveAsTable(edge_table))
    start_rows = starts.select(F.col("bucket").alias("start_bucket"), F.col("object").alias("start_object"),
                               F.col("bucket"), F.col("object")).dropDuplicates().withColumn("depth", F.lit(0))
    start_rows.write.partitionBy("depth").bucketBy(n, *key).option("path", seen_path).saveAsTable(seen_table)
    try:
        e = spark.table(edge_table)
        for depth in count(1):
            frontier = spark.table(seen_table).where(F.col("depth") == depth - 1)
            step = (frontier.join(e, (frontier["bucket"] == e["dst_bucket"]) &
                                  (frontier["object"] == e["dst_object"]))
                    .select("start_bucket", "start_object", F.col("src_bucket").alias("bucket"),
                            F.col("src_object").alias("object"))
                    .dropDuplicates(key)
                    .join(spark.table(seen_table).select(*key), key, "left_anti"))
            obs = Observation(f"lineage_hop_{depth}")
            (step.withColumn("depth", F.lit(depth)).observe(obs, F.count(F.lit(1)).alias("n"))
             .write.mode("append").partitionBy("depth").bucketBy(n, *key).saveAsTable(seen_table))
            if obs.get["n"] == 0:
                break
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {edge_table}")
        spark.sql(f"DROP TABLE IF EXISTS {seen_table}")       # external: the files stay for the result
    return spark.read.parquet(seen_path).where(F.col("depth") > 0).select(*key, "depth")


MULTIPLE = "multiple"
MULTIPLE_NOTE = "Built from several source datasets."
_NODE = ("bucket", "object")


def first_records(lineage: DataFrame) -> DataFrame:
    """The record that a trace follows at each target: the first by time, then by source and transformation (nulls first)."""
    order = F.struct(*(F.struct(F.col(c).isNotNull().alias("known"), F.col(c).alias("value")) for c in (
        "timestamp", "source.bucket", "source.object", "transformation")))
    fields = F.struct("timestamp", F.col("source.bucket").alias("source_bucket"), F.col("source.object").alias("source_object"),
                      "transformation")
    return lineage.groupBy(F.col("target.bucket").alias("bucket"), F.col("target.object").alias("object")) \
        .agg(F.min_by(fields, order).alias("r")).select(*_NODE, "r.*")


def _doubled(spark: SparkSession, pointers: DataFrame) -> tuple[list[DataFrame], DataFrame | None]:
    """Pointer tables (node, up) that go 1, 2, 4, ... steps, and the last one if some of its nodes never reach an end.

    A node at depth D of a chain has nodes at all smaller depths above it.  So when as many nodes as before
    have a pointer of doubled length, none of them has an end, and all lead into cycles.
    """
    tables, alive = [], None
    while True:
        pointers, n = _counted(pointers, "lineage-pointers")
        if not n:
            return tables, None
        tables.append(pointers)
        if n == alive and 1 << (len(tables) - 1) >= n:
            return tables, pointers
        alive = n
        above = pointers.select(F.col("node").alias("up"), F.col("up").alias("far"))
        pointers = pointers.join(above, "up").select("node", F.col("far").alias("up"))


def _counted(df: DataFrame, name: str, what: Column | None = None) -> tuple[DataFrame, int]:
    """``df`` written into the shared folder, with the row count (or another sum) that the writing job observed."""
    spark, path, obs = df.sparkSession, scratch_path(df.sparkSession, name), Observation(f"{name}-{uuid.uuid4().hex}")
    df.observe(obs, (F.count(F.lit(1)) if what is None else what).alias("n")).write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), int(obs.get["n"])


def _positions(starts: DataFrame, tables: list[DataFrame]) -> DataFrame:
    """Every node on the way of ``starts`` (start, node, pos): the steps of a way are sums of powers of two, each taken once."""
    here = starts
    for k in range(len(tables) - 1, -1, -1):
        stay, moved = F.struct("node", "pos"), F.struct(F.col("up").alias("node"), (F.col("pos") + (1 << k)).alias("pos"))
        both = F.when(F.col("up").isNull(), F.array(stay)).otherwise(F.array(stay, moved))
        rest = [c for c in starts.columns if c not in ("node", "pos")]
        here = here.join(tables[k], "node", "left").select(*rest, F.explode(both).alias("at")).select(*rest, "at.node", "at.pos")
    return here


def lineage_history(lineage: DataFrame, starts: DataFrame) -> DataFrame:
    """How each start dataset came about: the records from its oldest ancestor to itself.

    ``lineage`` has ``LINEAGE_SCHEMA``, ``starts`` bucket and object.  From a dataset the trace follows the first record
    whose target it is (``first_records``) to that record's source, until no record is found, the source is
    ``multiple`` (bucket ``multiple``, or no source at all: a row with a note then stands before that record), or a dataset would
    come again.  Output: start_bucket, start_object, seq (1 = oldest), timestamp, source_bucket, source_object,
    target_bucket, target_object, transformation, note.

    Pointers to the parent are doubled, so a chain of n records takes log2(n) jobs, whatever the number of
    starts; positions come from the same tables, each row exactly once.  Cycles are found by the nodes that doubled pointers
    end on; there the way goes round once from where it came in.  Starts without a record give no row; repeated starts count once;
    null names are names of their own.
    """
    spark = lineage.sparkSession
    name = lambda b, o: F.to_json(F.struct(F.col(b).alias("b"), F.col(o).alias("o")))  # noqa: E731  one key, nulls kept apart
    records, _ = _counted(first_records(lineage).withColumn("node", name(*_NODE)), "lineage-records")
    several = F.coalesce(F.col("source_bucket") == MULTIPLE, F.col("source_bucket").isNull() & F.col("source_object").isNull())
    known = records.select(F.col("node").alias("up"))
    pointers = records.where(~several).select("node", name("source_bucket", "source_object").alias("up")).join(known, "up", "left_semi")
    begun = starts.select(*_NODE).distinct().select(F.col("bucket").alias("start_bucket"), F.col("object").alias("start_object"),
                                                    name(*_NODE).alias("node"), F.lit(0).cast("long").alias("pos")) \
        .join(records.select("node"), "node", "left_semi")
    tables, endless = _doubled(spark, pointers)
    if endless is None:
        way = _positions(begun, tables)
    else:
        # nodes on cycles lose their pointers; what is left are chains that end on them
        ring, _ = _counted(endless.select(F.col("up").alias("node")).distinct(), "lineage-rings")
        tails, _ = _doubled(spark, tables[0].join(ring, "node", "left_anti"))
        tail = _positions(begun, tails)
        way = tail.unionByName(_rounds(tail.join(ring, "node", "left_semi"), tables[0].join(ring, "node", "left_semi")))
    order = Window.partitionBy("start_bucket", "start_object").orderBy(F.desc("pos"))
    rows = way.join(records, "node").select(
        "start_bucket", "start_object", F.row_number().over(order).alias("seq"), "timestamp", "source_bucket", "source_object",
        F.col("bucket").alias("target_bucket"), F.col("object").alias("target_object"), "transformation",
        F.lit(None).cast("string").alias("note"), several.alias("several"))
    # only the oldest record of a way can have several sources; its note moves the others by one
    noted = rows.where("several").select("start_bucket", "start_object")
    moved = rows.join(noted.withColumn("by", F.lit(1)), [rows["start_bucket"].eqNullSafe(noted["start_bucket"]),
                                                         rows["start_object"].eqNullSafe(noted["start_object"])], "left") \
        .select(rows["*"], F.coalesce("by", F.lit(0)).alias("by"))
    note = rows.where("several").select("start_bucket", "start_object", F.lit(1).alias("seq"), "timestamp", *(
        F.lit(None).cast("string").alias(c) for c in ("source_bucket", "source_object", "target_bucket", "target_object")),
        "transformation", F.lit(MULTIPLE_NOTE).alias("note"))
    return moved.withColumn("seq", F.col("seq") + F.col("by")).drop("by", "several").unionByName(note)


def _rounds(entries: DataFrame, ring: DataFrame) -> DataFrame:
    """The way once round a cycle, from each entry (start, node, pos) to the node before it.

    A cycle is cut at its least node, whose pointer goes; the chain that is left gives every node a place.
    """
    spark = entries.sparkSession
    least, obs = ring.select("node", "up", F.least("node", "up").alias("least"), F.lit(True).alias("new")), None
    while obs is None or obs:      # least node within 2, 4, 8, ... steps, until no node finds a lesser one
        least, obs = _counted(least, "lineage-least", F.count_if("new"))
        above = least.select(F.col("node").alias("up"), F.col("up").alias("far"), F.col("least").alias("beyond"))
        least = least.join(above, "up").select("node", F.col("far").alias("up"), F.least("least", "beyond").alias("least"),
                                               (F.col("beyond") < F.col("least")).alias("new"))
    cycle, _ = _counted(least.select("node", F.col("least").alias("cycle")), "lineage-cycles")
    tables, _ = _doubled(spark, ring.join(cycle.where("node = cycle").select("node"), "node", "left_anti"))
    # pos of the least node seen from each node: the number of steps to the end of the cut chain
    ends = _positions(cycle.select(F.col("node").alias("from"), "cycle", "node", F.lit(0).cast("long").alias("pos")), tables)
    place = ends.groupBy("cycle", F.col("from").alias("node")).agg(F.max("pos").alias("to_end"))
    size = place.groupBy("cycle").agg(F.count(F.lit(1)).alias("size"))
    at = entries.join(place, "node").join(size, "cycle").withColumnRenamed("to_end", "own").drop("node")
    return at.join(place, "cycle").where("to_end <> own") \
        .withColumn("pos", F.col("pos") + F.expr("pmod(own - to_end, size)")).select("start_bucket", "start_object", "node", "pos")


# --- security policy (declared; kept as data) ----------------------------------------------

# The data-lake security policy (zones, grants, retention, classifications, roles).
SECURITY_POLICY = {
    "zones": {
        "raw-ingestion-zone": {"description": "Storage for raw, unmodified data",
                               "access_levels": {"read": ["data_engineer", "data_scientist", "admin"],
                                                 "write": ["data_engineer", "admin", "system_integrator"],
                                                 "delete": ["admin"]},
                               "encryption": "required", "retention_policy": "90 days"},
        "process-zone": {"description": "Storage for processed and transformed data",
                         "access_levels": {"read": ["data_engineer", "data_scientist", "data_analyst", "admin"],
                                           "write": ["data_engineer", "admin"],
                                           "delete": ["admin"]},
                         "encryption": "required", "retention_policy": "180 days"},
        "access-zone": {"description": "Storage for analysis-ready, business-aligned data",
                        "access_levels": {"read": ["data_engineer", "data_scientist", "data_analyst",
                                                   "business_user", "admin"],
                                          "write": ["data_engineer", "admin"],
                                          "delete": ["admin"]},
                        "encryption": "required", "retention_policy": "365 days"},
        "govern-zone-metadata": {"description": "Storage for metadata and governance information",
                                 "access_levels": {"read": ["data_engineer", "admin", "governance_team"],
                                                   "write": ["data_engineer", "admin", "system"],
                                                   "delete": ["admin"]},
                                 "encryption": "required", "retention_policy": "permanent"},
        "govern-zone-security": {"description": "Storage for security policies and audit logs",
                                 "access_levels": {"read": ["admin", "security_team", "compliance_officer"],
                                                   "write": ["admin", "system"],
                                                   "delete": ["admin"]},
                                 "encryption": "required", "retention_policy": "5 years"},
    },
    "data_classification": {
        "public": {"description": "Data that can be freely shared", "access_restriction": "none",
                   "encryption": "optional"},
        "internal": {"description": "Data for internal use only", "access_restriction": "authenticated_users",
                     "encryption": "required"},
        "confidential": {"description": "Sensitive business data", "access_restriction": "authorized_roles",
                         "encryption": "required", "mask_fields": ["email", "phone", "address"]},
        "restricted": {"description": "Highly sensitive data with regulatory implications",
                       "access_restriction": "explicit_grants", "encryption": "required",
                       "mask_fields": ["personal_identifiers", "financial_data", "health_data"],
                       "audit_access": "required"},
    },
    "roles": {
        "admin": {"description": "Full access to all zones and data",
                  "members": ["data_lake_admin", "chief_data_officer"]},
        "data_engineer": {"description": "Build and maintain the data lake infrastructure",
                          "members": ["etl_developers", "integration_specialists"]},
        "data_scientist": {"description": "Develop models and advanced analytics",
                           "members": ["ml_engineers", "research_scientists"]},
        "data_analyst": {"description": "Perform business analysis and reporting",
                         "members": ["business_analysts", "report_developers"]},
        "business_user": {"description": "Consume dashboards and analysis",
                          "members": ["department_managers", "executive_team", "functional_teams"]},
        "governance_team": {"description": "Oversee data governance and quality",
                            "members": ["data_stewards", "data_governance_committee"]},
        "security_team": {"description": "Ensure data security and access controls",
                          "members": ["security_analysts", "compliance_officers"]},
    },
}

_ZONE_SCHEMA = ("zone string, description string, encryption string, retention_policy string, "
                "access_levels map<string, array<string>>")


def _policy(policy: Mapping | None) -> Mapping:
    return policy or SECURITY_POLICY


def zone_policy(spark: SparkSession, policy: Mapping | None = None) -> DataFrame:
    """One row per zone: description, encryption, retention text, retention as a day count or months."""
    rows = [(z, v["description"], v["encryption"], v["retention_policy"], v["access_levels"])
            for z, v in _policy(policy)["zones"].items()]
    df = spark.createDataFrame(rows, _ZONE_SCHEMA)
    num = F.regexp_extract("retention_policy", r"^(\d+)\s+(day|days|year|years)$", 1)
    unit = F.regexp_extract("retention_policy", r"^(\d+)\s+(day|days|year|years)$", 2)
    return df.select(
        "zone", "description", "encryption", "retention_policy", "access_levels",
        F.when(unit.startswith("day"), num.cast("int")).alias("retention_days"),
        F.when(unit.startswith("year"), num.cast("int") * 12).alias("retention_months"))


def policy_grants(spark: SparkSession, policy: Mapping | None = None) -> DataFrame:
    """Exploded grants: one row per (zone, action, role)."""
    z = zone_policy(spark, policy)
    by_action = z.select("zone", F.explode("access_levels").alias("action", "roles"))
    return by_action.select("zone", "action", F.explode("roles").alias("role"))


def classification_policy(spark: SparkSession, policy: Mapping | None = None) -> DataFrame:
    """One row per (classification, mask field); classifications without masks keep a null field."""
    rows = [(k, v["access_restriction"], v["encryption"], v.get("mask_fields", []))
            for k, v in _policy(policy)["data_classification"].items()]
    df = spark.createDataFrame(rows, "classification string, access_restriction string, encryption string, "
                                     "mask_fields array<string>")
    return df.select("classification", "access_restriction", "encryption",
                     F.explode_outer("mask_fields").alias("mask_field"))


def role_members(spark: SparkSession, policy: Mapping | None = None) -> DataFrame:
    rows = [(r, v["description"], v["members"]) for r, v in _policy(policy)["roles"].items()]
    df = spark.createDataFrame(rows, "role string, description string, members array<string>")
    return df.select("role", "description", F.explode("members").alias("member"))


def _grant_map(policy: Mapping | None = None):
    """Literal map zone -> array of (action, role) built from the fixed policy document."""
    pairs = []
    for zone, spec in _policy(policy)["zones"].items():
        grants = [F.struct(F.lit(a).alias("action"), F.lit(r).alias("role"))
                  for a, roles in spec["access_levels"].items() for r in roles]
        pairs += [F.lit(zone), F.array(*grants)]
    return F.create_map(*pairs)


def table_grants(assignments: DataFrame, zone_col: str = "zone", policy: Mapping | None = None) -> DataFrame:
    """Who may do what on each table: one row per (table row, action, role) of its zone.

    The policy is a fixed document, so the lookup is a literal map inside the
    projection (no join); a table in an unknown zone gets no grants.
    """
    g = F.explode(F.try_element_at(_grant_map(policy), F.col(zone_col))).alias("_g")
    return assignments.select("*", g).select(*assignments.columns, "_g.action", "_g.role")


def _retention(policy: Mapping | None, zone: str) -> tuple[str | None, int | None, int | None]:
    text = _policy(policy)["zones"].get(zone, {}).get("retention_policy")
    m = re.match(r"^(\d+)\s+(day|days|year|years)$", text or "")
    if not m:
        return text, None, None
    n = int(m.group(1))
    return (text, n, None) if m.group(2).startswith("day") else (text, None, 12 * n)


def retention_report(df: DataFrame, ts_col: str, dataset: str, zone: str, as_of: _dt.datetime,
                     policy: Mapping | None = None) -> DataFrame:
    """Rows past the retention of their zone at ``as_of`` (reported, nothing is deleted).

    The zone's retention comes from the fixed policy document; "permanent" never
    expires.  One aggregation counts, flags and bounds the rows.
    """
    text, days, months = _retention(policy, zone)
    asof = F.lit(as_of).cast("timestamp_ntz")
    if days is not None:
        cutoff = F.date_sub(asof, days).cast("timestamp_ntz")
    elif months is not None:
        cutoff = F.add_months(asof, -months).cast("timestamp_ntz")
    else:
        cutoff = F.lit(None).cast("timestamp_ntz")
    ts = F.col(ts_col)
    return df.agg(F.count(F.lit(1)).alias("total_rows"),
                  F.count_if(F.coalesce(ts < cutoff, F.lit(False))).cast("long").alias("expired_rows"),
                  F.min(ts).alias("oldest"), F.max(ts).alias("newest")) \
        .select(F.lit(dataset).alias("dataset"), F.lit(zone).alias("zone"),
                F.lit(text).cast("string").alias("retention_policy"), "total_rows", "expired_rows", "oldest", "newest")


def mask_columns(df: DataFrame, fields: Sequence[str]) -> DataFrame:
    """Replace each present field by the SHA-256 hex digest of its text (null stays null)."""
    present = set(f for f in fields if f in df.columns)
    return df.select(*[F.sha2(F.col(c).cast("string"), 256).alias(c) if c in present else F.col(c)
                       for c in df.columns])
