"""Dataset read / write / publish.

A dataset is one directory per (zone, object); a write replaces it.  Schemas are
declared, never inferred, so a malformed file cannot silently change a type.
"""

from __future__ import annotations

import datetime as _dt
import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.sources.documents import read_csv_records, read_json_array

SUPPORTED_FORMATS = ("csv", "json", "parquet")


# Quotes and blanks of text fields survive a round trip.
CSV_TEXT = {"quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


# A text that is one NUL character reads back as null; an empty field stands for null by itself.
CSV_READ = {**CSV_TEXT, "nullValue": "\u0000"}


def _check_format(fmt: str) -> str:
    fmt = fmt.lower()
    if fmt not in SUPPORTED_FORMATS:
        raise ValueError(f"Unsupported format: {fmt}")
    return fmt


FILE_ORDER = ("_file", "_ord")


def in_file_order(df: DataFrame) -> DataFrame:
    """A frame just read from files with the place of every row: ``_file`` and ``_ord`` (grows in a file)."""
    place = F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))
    return df.select("*", F.col("_metadata.file_path").alias("_file"), place.alias("_ord"))


def read_dataset(spark: SparkSession, path: str, fmt: str = "parquet",
                 schema: T.StructType | str | None = None, multiline: bool = False, placed: bool = False) -> DataFrame:
    """Read one dataset.

    * ``csv``: header row, declared schema, malformed values become null (PERMISSIVE);
      an empty field is null, an empty field in quotes is the empty text, a doubled quote
      is a quote, and blanks are kept.  ``multiline=True`` for texts with line ends.
    * ``json``: declared schema; ``multiline=True`` reads a JSON array of records and
      fails on malformed input (FAILFAST), as a document loader should.

    ``multiline`` reads need a schema; a file is still read by many tasks.  ``placed=True`` adds ``_file`` and ``_ord``.
    * ``parquet``: schema from the files.
    """
    fmt = _check_format(fmt)
    if multiline and fmt != "parquet":
        if schema is None:
            raise ValueError("a multiline read needs a schema")
        schema = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
        rows = read_csv_records(spark, path, schema, CSV_READ) if fmt == "csv" else read_json_array(spark, path, schema)
        return rows if placed else rows.drop(*FILE_ORDER)
    reader = spark.read if schema is None else spark.read.schema(schema)
    if fmt == "csv":
        rows = reader.options(header=True, mode="PERMISSIVE", **CSV_READ).csv(path)
    else:
        rows = reader.json(path) if fmt == "json" else reader.parquet(path)
    return in_file_order(rows) if placed else rows


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: list[str] | None = None) -> None:
    """Write one dataset; ``overwrite`` replaces the object, ``append`` adds files."""
    fmt = _check_format(fmt)
    writer = df.write.mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        writer.options(header=True, **CSV_TEXT).csv(path)
    elif fmt == "json":
        writer.json(path)
    else:
        writer.parquet(path)


METADATA_SCHEMA = T.StructType([
    T.StructField("source_bucket", T.StringType()),
    T.StructField("object_name", T.StringType()),
    T.StructField("uploaded_at", T.TimestampType()),
    T.StructField("format", T.StringType()),
    T.StructField("rows", T.LongType()),
    T.StructField("columns", T.ArrayType(T.StringType())),
    T.StructField("column_types", T.MapType(T.StringType(), T.StringType())),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
])


def utc(moment: _dt.datetime | None = None) -> _dt.datetime:
    """An aware UTC time: now if none is given; a time without a zone is taken as UTC, not as the machine's."""
    if moment is None:
        return _dt.datetime.now(_dt.timezone.utc)
    return moment.replace(tzinfo=_dt.timezone.utc) if moment.tzinfo is None else moment.astimezone(_dt.timezone.utc)


def publish(df: DataFrame, path: str, bucket: str, object_name: str, fmt: str = "parquet",
            properties: Mapping[str, str] | None = None,
            uploaded_at: _dt.datetime | None = None) -> DataFrame:
    """Write ``df`` and return its ``dataset_metadata`` record as a one-row DataFrame.

    The row count is observed on the write job itself (no second pass over the data).
    """
    return publish_observed(df, path, bucket, object_name, [F.count(F.lit(1)).alias("rows")], fmt, properties, uploaded_at)[0]


def publish_observed(df: DataFrame, path: str, bucket: str, object_name: str, metrics: Sequence[Column], fmt: str = "parquet",
                     properties: Mapping[str, str] | None = None, uploaded_at: _dt.datetime | None = None) -> tuple[DataFrame, dict]:
    """``publish`` with further ``metrics`` (``rows`` among them) counted by the write: (metadata record, metrics)."""
    obs = Observation(f"publish-{uuid.uuid4().hex}")
    write_dataset(df.observe(obs, *metrics), path, fmt)
    found = obs.get
    record = (bucket, object_name, utc(uploaded_at),
              fmt, int(found["rows"]), list(df.columns),
              {f.name: f.dataType.simpleString() for f in df.schema.fields},
              dict(properties or {}))
    return df.sparkSession.createDataFrame([record], METADATA_SCHEMA), found


def preview(spark: SparkSession, path: str, fmt: str = "parquet", n: int = 5) -> DataFrame:
    """First ``n`` rows of a dataset for a quick look (a limit is the feature; no order is implied)."""
    return read_dataset(spark, path, fmt).limit(n)


def create_table_as(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """``CREATE TABLE name AS SELECT ...``: replace the catalog table ``name`` with ``df``.

    With ``path`` the table is external (its files live there, e.g. a shared lake folder).
    """
    writer = df.write.mode("overwrite").format("parquet")
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def drop_table(spark: SparkSession, name: str) -> None:
    """``DROP TABLE IF EXISTS name``."""
    spark.sql(f"DROP TABLE IF EXISTS {name}")


def show_tables(spark: SparkSession) -> DataFrame:
    """``SHOW TABLES`` of the current catalog database (temporary views included)."""
    return spark.sql("SHOW TABLES")


def describe(df: DataFrame) -> DataFrame:
    """``DESCRIBE``: one row per column (position, name, type, nullable) of a DataFrame."""
    rows = [(i, f.name, f.dataType.simpleString(), f.nullable) for i, f in enumerate(df.schema.fields)]
    return df.sparkSession.createDataFrame(rows, "position int, col_name string, data_type string, nullable boolean")
