"""Raw-file manifest: SHA-256 and size of every file, computed by Spark tasks.

A file of up to ``WHOLE`` bytes is one row of ``binaryFile`` and hashed by one task.  SHA-256 takes the blocks of a file one after
the other, so a larger file is hashed by a chain of tasks: each reads one split, goes on from the state that the task before it
left (112 bytes) and hands its own on.  Larger files are in step: the first splits of all are one job, the second ones the next.
"""

from __future__ import annotations

import _hashlib
import ctypes
import datetime as _dt
import hashlib
import re
from fnmatch import fnmatch

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from zonelake.session import list_files, named_compressed

LARGEST = 2**31 - 16  # bytes that one row can hold
WHOLE = 2**28         # bytes up to which a file is hashed as one row
LONGEST = 2**28       # bytes of a line that a task of the chain holds at most
BOM = b"\xef\xbb\xbf"  # left out by line readers at the beginning of a file
LISTING = "path string, file_size bigint, modified timestamp"


class _State(ctypes.Structure):
    """OpenSSL's ``SHA256_CTX``: ``hashlib`` is made from the same library, but doesn't give its state away."""

    _fields_ = [("h", ctypes.c_uint32 * 8), ("bits", ctypes.c_uint32 * 2), ("data", ctypes.c_uint32 * 16),
                ("num", ctypes.c_uint), ("length", ctypes.c_uint)]


def _started() -> bytes:
    state = _State()
    ctypes.CDLL(_hashlib.__file__).SHA256_Init(ctypes.byref(state))
    return bytes(state)


def _advanced(before: bytes, pieces) -> bytes:
    """The state after further bytes (buffers)."""
    state, add = _State.from_buffer_copy(before), ctypes.CDLL(_hashlib.__file__).SHA256_Update
    add.argtypes = (ctypes.c_void_p, ctypes.c_void_p, ctypes.c_size_t)
    for address, size in pieces:
        add(ctypes.byref(state), address, size)
    return bytes(state)


def _digest(before: bytes) -> str:
    out, state = ctypes.create_string_buffer(32), _State.from_buffer_copy(before)
    ctypes.CDLL(_hashlib.__file__).SHA256_Final(out, ctypes.byref(state))
    return out.raw.hex()


def _placed(data: bytes):
    return [(ctypes.cast(ctypes.c_char_p(data), ctypes.c_void_p).value, len(data))]


def state_can_pass() -> bool:
    """Whether this Python's ``hashlib`` gives access to OpenSSL's functions that work on a plain state."""
    try:
        return _digest(_advanced(_advanced(_started(), _placed(b"a" * 70)), _placed(b"b"))) == hashlib.sha256(b"a" * 70 + b"b").hexdigest()
    except (OSError, AttributeError):
        return False


def _chained(spark: SparkSession, path: str, size: int, state: bytes, done: int, block: int):
    """The file's splits, each as (path, state, bytes done, block) behind it if it comes after ``done`` bytes and ``block``."""
    def go_on(batches):
        now, so_far, at = state, done, block
        for b in batches:
            for rows in (b.slice(i, 1) for i in range(b.num_rows)) if b.column("block")[0] != b.column("block")[-1] else (b,):
                if not rows.num_rows:
                    continue
                if rows.column("block")[0].as_py() < at:
                    raise RuntimeError(f"the splits of {path} are out of order")
                at = rows.column("block")[0].as_py()
                lines = rows.column("line")
                _, ends, data = lines.buffers()
                width = 8 if str(lines.type).startswith("large") else 4
                first, last = (int.from_bytes(ends[(lines.offset + i) * width:(lines.offset + i + 1) * width].to_pybytes(), "little")
                               for i in (0, len(lines)))
                # a line feed was put behind every line; the last line of the file may have none
                taken = max(0, min(last - first, size - so_far))
                now = _advanced(now, [(data.address + first, taken)])
                so_far += last - first if last - first > taken + 1 else taken
        yield pa.record_batch({"path": [path], "state": [now], "done": pa.array([so_far], pa.int64()), "block": pa.array([at], pa.int64())})

    lines = spark.read.option("lineSep", "\n").option("mapreduce.input.linerecordreader.line.maxlength", str(LONGEST)) \
        .text(re.sub(r"([\[\]{}*?\\])", r"\\\1", path))
    return lines.select(F.concat(F.col("value").cast("binary"), F.lit(b"\n")).alias("line"), F.col("_metadata.file_block_start").alias("block")) \
        .mapInArrow(go_on, "path string, state binary, done bigint, block bigint").rdd


def chained_hashes(spark: SparkSession, sizes: dict[str, int], head: bytes = b"") -> dict[str, str]:
    """SHA-256 of files by a chain of tasks over their splits; a file that isn't read to its last byte is not in the result."""
    sc = spark.sparkContext
    reached = {p: (_advanced(_started(), _placed(head)), len(head), 0) for p in sizes}
    step, going = 0, list(sizes)
    while going:
        rdds = {p: _chained(spark, p, sizes[p], *reached[p]) for p in going}
        counts = {p: r.getNumPartitions() for p, r in rdds.items()}
        going = [p for p in going if step < counts[p]]
        if not going:
            break
        begin, wanted = 0, []
        for p in going:
            wanted.append(begin + step)
            begin += counts[p]
        for r in sc.runJob(sc.union([rdds[p] for p in going]), list, wanted):
            reached[r.path] = (bytes(r.state), r.done, r.block)
        step += 1
    return {p: _digest(state) for p, (state, done, _) in reached.items() if done == sizes[p]}


def file_manifest(spark: SparkSession, path: str, bucket: str, glob: str | None = None,
                  uploaded_at: Column | None = None) -> DataFrame:
    """One row per file of a folder: bucket, object name, original path, upload time, hash, size.

    The rows come from the file system's listing, so empty files are in it (with the hash of no
    bytes).  The hashes are computed by tasks, large files by a chain of tasks.  A file over 2 GB has a null
    hash only where the chain can't read it: with a compression's name ending, lines over 256 MB or no OpenSSL.
    """
    found = [(p, n, _dt.datetime.fromtimestamp(ms / 1000, _dt.timezone.utc)) for p, n, ms in list_files(spark, path)
             if glob is None or fnmatch(p.rsplit("/", 1)[-1], glob)]
    listing = spark.createDataFrame(found, LISTING)
    out = listing.withColumn("file_hash", F.when(F.col("file_size") == 0, F.sha2(F.lit(b""), 256)))
    whole = min(WHOLE, LARGEST)
    large = {p: n for p, n, _ in found if n > whole}
    chained = {}
    if large and state_can_pass():
        plain = {p: n for p, n in large.items() if not named_compressed(spark, p)}
        chained = chained_hashes(spark, plain)
        chained |= chained_hashes(spark, {p: n for p, n in plain.items() if p not in chained}, BOM)
    hashes = []
    if chained:
        hashes.append(spark.createDataFrame(list(chained.items()), "_path string, _hash string"))

    def hashed(reader, source, most):
        return reader.load(source).where(F.col("length") <= most).select(F.col("path").alias("_path"), F.sha2("content", 256).alias("_hash"))

    if any(0 < n <= whole for _, n, _ in found):
        reader = spark.read.format("binaryFile")
        if glob:
            reader = reader.option("pathGlobFilter", glob)
        hashes.append(hashed(reader, path, whole))
    left = [re.sub(r"([\[\]{}*?\\])", r"\\\1", p) for p, n in large.items() if p not in chained and n <= LARGEST]
    if left:
        hashes.append(hashed(spark.read.format("binaryFile"), left, LARGEST))
    if hashes:
        every = hashes[0]
        for more in hashes[1:]:
            every = every.unionByName(more)
        out = out.join(every, F.col("path") == F.col("_path"), "left") \
            .withColumn("file_hash", F.coalesce("file_hash", "_hash"))
    return out.select(
        F.lit(bucket).alias("source_bucket"),
        F.regexp_extract("path", r"([^/]+)$", 1).alias("object_name"),
        F.col("path").alias("original_file_path"),
        (uploaded_at if uploaded_at is not None else F.col("modified")).alias("uploaded_at"),
        "file_hash", "file_size")
