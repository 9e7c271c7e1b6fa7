"""Session construction and the few session-level helpers every job shares."""

from __future__ import annotations

import atexit
import os
import re
import shutil
import tempfile
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

# Settings every zonelake job relies on.  Shuffle width and broadcast threshold are
# deliberately left to the cluster configuration; AQE re-plans both at runtime.
CORE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.localShuffleReader.enabled": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "zonelake", extra: dict | None = None) -> SparkSession:
    """Create (or fetch) a session with the zonelake defaults applied."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    for k, v in CORE_CONF.items():
        builder = builder.config(k, v)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in (extra or {}).items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    apply_core_conf(spark)
    return spark


def apply_core_conf(spark: SparkSession) -> None:
    """Pin the runtime settings results depend on (UTC, AQE) on an existing session."""
    for k, v in CORE_CONF.items():
        spark.conf.set(k, v)


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A cluster must set it (a shared file system).  Only a session that runs in this one
    process (master ``local`` or ``local[...]``) may leave it unset; it gets a folder of
    its own that is deleted when the process ends.
    """
    sc = spark.sparkContext
    root = sc.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
        root = tempfile.mkdtemp(prefix="zonelake-ckpt-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(root)
    return sc.getCheckpointDir() or root


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared checkpoint folder for intermediate tables."""
    root = checkpoint_root(spark).rstrip("/")
    return f"{root}/zonelake-scratch/{name}-{uuid.uuid4().hex}"


def _path_of(spark: SparkSession, path: str):
    """The Hadoop path and its file system, whatever store it is in."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether the path exists; a store that cannot be asked is an error, not a no."""
    hadoop, store = _path_of(spark, path)
    return store.exists(hadoop)


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The Parquet table at ``path``, or None if nothing is there yet; every other error goes through."""
    return spark.read.parquet(path) if path_exists(spark, path) else None


def any_match(spark: SparkSession, pattern: str) -> bool:
    """Whether any path matches the pattern."""
    hadoop, store = _path_of(spark, pattern)
    return bool(store.globStatus(hadoop))


def publish_folder(spark: SparkSession, source: str, target: str) -> bool:
    """Rename a folder of our own to ``target`` in one step; False, and nothing is done, if ``target`` is there already."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    (old, store), (new, _) = _path_of(spark, source), _path_of(spark, target)
    old, new = old.makeQualified(store.getUri(), store.getWorkingDirectory()), new.makeQualified(store.getUri(), store.getWorkingDirectory())
    plain = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(store.getUri(), spark._jsc.hadoopConfiguration()).rename(old, new, plain)
    except Py4JJavaError as e:
        if "FileAlreadyExistsException" not in e.java_exception.toString():
            raise
        return False
    return True


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder of our own."""
    hadoop, store = _path_of(spark, path)
    store.delete(hadoop, True)


def list_files(spark: SparkSession, path: str) -> list[tuple[str, int, int]]:
    """(path, bytes, modification time in ms) of the files in a folder (or of one file), empty ones included."""
    hadoop, store = _path_of(spark, path)
    return [(s.getPath().toString(), s.getLen(), s.getModificationTime()) for s in store.listStatus(hadoop) if s.isFile()]


def named_compressed(spark: SparkSession, path: str) -> bool:
    """Whether the name ends like that of a compressed file, which line readers unpack."""
    codecs = spark._jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark._jsc.hadoopConfiguration())
    return codecs.getCodec(_path_of(spark, path)[0]) is not None


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` reliably (checkpoint into the shared folder) and cut its lineage.

    Used between the levels of the nearest-reference search and before an
    idempotent append counts and writes the rows it computed.
    """
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


def stored_table(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once into the shared scratch folder and read back: cuts lineage like a
    checkpoint, and later joins see the table's real size."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def data_path(sf_dir: str, table: str) -> str:
    return os.path.join(sf_dir, f"{table}.parquet")
