"""Line dedup by a deletion-neighbourhood join (DataFrame functions only).

A line (text between newlines, outer blanks removed) goes if the same line, or one within edit distance 1,
occurs earlier in the corpus; "earlier" is by (id, text hash, line number), null ids last, and holds
whether or not the earlier line stays itself.  Empty lines stay (``min_chars`` is 1); lines under ``near_chars`` (4)
characters go only for an equal line, as one edit makes another word of them.

1. Distinct lines: one pre-aggregated row per MD5 with the first place and the count.
2. Exact filter before variants are made: two lines within one edit share the first or the last
   ``floor(m / 2)`` characters, m being the shorter length.  Only lines whose half is shared by another
   distinct line go on, as digests.  Their texts are picked out of the documents by a bitmap of fixed size (4 MB at
   most, broadcast) followed by the exact join, so other lines never shuffle their text.
3. Deletion neighbourhood: each such line emits the hash of itself with character i deleted, for every i of
   the half that is not shared, and joins equal variants (same position: substitution; the shorter line
   itself: insertion).  A variant hashes a window of about sqrt(m) characters and, once per window, what
   lies outside it, so a line of n characters costs n * sqrt(n), not n * n.
4. A variant group gives each member its earliest partner (one row per member, never all pairs); the
   pair's edit distance is verified on the texts.

Defined results: rows with equal id and text are one document and lose the same lines; a null text stays
null and has no lines; an empty text has one (empty) line, which stays; an empty table gives an empty
result; further columns are kept by ``drop_duplicate_lines`` and not read otherwise.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonelake.llm.common import bitmap, fresh, load, maybe_in, stored

MIN_CHARS, NEAR_CHARS = 1, 4      # lines that are not empty; one edit in less than four characters makes another line
BLANKS = " \t\r"


def _doc_hash(id_col: str, text_col: str) -> Column:
    return F.xxhash64(F.col(id_col).cast("string"), F.col(text_col).cast("string"))


def corpus_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """Lines of ``min_chars`` characters and more: place (id missing, id, doc hash, line number), line, chars."""
    lines = docs.select(F.col(id_col).alias("id"), _doc_hash(id_col, text_col).alias("hash"),
                        F.posexplode(F.split(F.col(text_col).cast("string"), "\n")).alias("line_no", "raw"))
    # trimming goes through every character of a line: only where there is something to trim
    outer = reduce(or_, [F.startswith("raw", F.lit(b)) | F.endswith("raw", F.lit(b)) for b in BLANKS])
    lines = lines.withColumn("line", F.when(outer, F.btrim("raw", F.lit(BLANKS))).otherwise(F.col("raw"))).withColumn("chars", F.char_length("line"))
    return lines.where(F.col("chars") >= min_chars).select(
        F.struct(F.col("id").isNull().alias("no_id"), "id", "hash", "line_no").alias("place"), "line", "chars")


# of the keys in ``_half_keys``: the half's side, and whether the line is the longer one of the pair
HALVES = (("pre", 0), ("pre", 1), ("suf", 0), ("suf", 1))


def _half_keys() -> Column:
    """A key of each half, for a partner of the same or a longer length (m = chars) and for a shorter one."""
    def key(side: str, shorter: int) -> Column:
        m = F.col("chars") - shorter
        half = F.floor(m / 2).cast("int")
        return F.xxhash64(m, F.lit(side), F.left("line", half) if side == "pre" else F.right("line", half))
    return F.array(*[key(*h) for h in HALVES])


def _keyed(distinct: DataFrame, near_chars: int, *columns: str) -> DataFrame:
    """A row for each half key: the columns, key, side and shorter."""
    rows = distinct.where(F.col("chars") >= near_chars).select(*columns, F.posexplode("halves").alias("half", "key"))
    return rows.withColumn("side", F.when(F.col("half") < 2, "pre").otherwise("suf")).withColumn("shorter", F.col("half") % 2).drop("half")


def shared_halves(distinct: DataFrame, near_chars: int) -> DataFrame:
    """Half keys of two or more distinct lines, with the number of lines of length m and m + 1."""
    counts = _keyed(distinct, near_chars).groupBy("key").agg(F.sum(1 - F.col("shorter")).alias("same"), F.sum("shorter").alias("longer"))
    return counts.where((F.col("same") > 1) | (F.col("same") > 0) & (F.col("longer") > 0))


def candidates(lines: DataFrame, distinct: DataFrame, shared: DataFrame, near_chars: int) -> DataFrame:
    """Stored distinct lines that share a half with another: cid (in order of place), line, chars and the
    roles in which they can have a partner (same length, the shorter, the longer; by first or last half).

    Roles are found on digests; the texts of those that have one are fetched last.
    """
    keyed = _keyed(distinct, near_chars, "digest", "first").withColumnRenamed("first", "place")
    own = maybe_in(keyed, "key", bitmap(shared, "key")).join(shared, "key")
    roles = {"sub": (F.col("shorter") == 0) & (F.col("same") > 1), "short": (F.col("shorter") == 0) & (F.col("longer") > 0),
             "long": (F.col("shorter") == 1) & (F.col("same") > 0)}
    names = [f"{r}_{s}" for r in roles for s in ("pre", "suf")]
    flags = [F.max(roles[n[:-4]] & (F.col("side") == n[-3:])).alias(n) for n in names]
    found = own.groupBy("digest").agg(F.min("place").alias("place"), *flags).where(" or ".join(names))
    found = stored(found.withColumn("key", F.xxhash64("digest")), "lines-roles")
    texts = lines.where(F.col("chars") >= near_chars).select(F.unhex(F.md5("line")).alias("digest"), "line", "chars") \
        .withColumn("key", F.xxhash64("digest"))
    texts = maybe_in(texts, "key", bitmap(found, "key")).select("digest", "line", "chars").distinct()
    out = texts.join(found.drop("key"), "digest").drop("digest")
    return stored(out.sort("place").withColumn("cid", F.monotonically_increasing_id()), "lines-near")


def deletion_variants(near: DataFrame) -> DataFrame:
    """Rows (m, key, role, cid): the hashed deletion neighbourhood of the candidate lines.

    Roles: 0 same length (position is part of the key), 1 the shorter line itself, 2 the longer line with one
    character deleted.
    """
    def spread(role: int, name: str, m: str) -> DataFrame:
        rows = near.where(f"{name}_pre or {name}_suf").selectExpr(
            "cid", "line", "chars", f"{name}_pre as pre", f"{name}_suf as suf", f"{m} as m",
            f"cast(greatest(32, ceil(sqrt({m}))) as int) as w")
        last = "chars" if role == 1 else "chars - 1"  # the longer line of a pair has m + 1 characters
        rows = rows.selectExpr("*", f"explode(sequence(0, cast(({last}) div w as int))) as j")
        rows = rows.where("(pre and (j + 1) * w >= m div 2) or (suf and j * w <= m - m div 2 + 1)")
        inside = "w - 1" if role == 1 else "w"
        rows = rows.selectExpr("cid", "pre", "suf", "chars", "m", "w", "j", f"substring(line, j * w + 1, {inside}) as win",
                               f"xxhash64(m, j, left(line, j * w), substring(line, j * w + {inside} + 1)) as outside")
        if role == 1:
            return rows.selectExpr("m", "xxhash64(outside, -1, win) as key", "1 as role", "cid")
        at = "j * w + i" if role == 0 else "-1"
        rows = rows.where("win <> ''").selectExpr(
            "cid", "pre", "suf", "chars", "m",
            "explode(transform(sequence(1, char_length(win)), i -> struct(j * w + i as at, "
            f"xxhash64(outside, {at}, concat(left(win, i - 1), substring(win, i + 1))) as key))) as v")
        return rows.where("(pre and v.at > m div 2) or (suf and v.at <= chars - m div 2)") \
            .selectExpr("m", "v.key as key", f"{role} as role", "cid")

    return spread(0, "sub", "chars").union(spread(1, "short", "chars")).union(spread(2, "long", "chars - 1"))


def near_copies(near: DataFrame) -> DataFrame:
    """cid of the candidate lines that have an earlier line within edit distance 1."""
    group = Window.partitionBy("m", "key")
    earliest = {r: F.min(F.when(F.col("role") == r, F.col("cid"))).over(group) for r in (0, 1, 2)}
    partner = F.when(F.col("role") == 0, earliest[0]).when(F.col("role") == 1, earliest[2]).otherwise(earliest[1])
    pairs = deletion_variants(near).withColumn("partner", partner).where("partner < cid").select("cid", "partner").distinct()
    text = near.select("cid", "line")
    pairs = pairs.join(text, "cid").join(text.select(F.col("cid").alias("partner"), F.col("line").alias("other")), "partner")
    return pairs.where(F.levenshtein("line", "other", 1).between(0, 1)).select("cid").distinct()


def removed_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                  near_chars: int = NEAR_CHARS) -> DataFrame:
    """Stored rows (id, hash, removed): the numbers of the lines that go, per document that loses any."""
    near_chars = max(near_chars, min_chars, 4)
    lines = corpus_lines(docs, id_col, text_col, min_chars)
    digest = F.unhex(F.md5("line")).alias("digest")
    halves = F.when(F.col("chars") >= near_chars, _half_keys()).alias("halves")
    distinct = lines.select(digest, "chars", halves, "place").groupBy("digest", "chars", "halves") \
        .agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"))
    distinct = stored(distinct, "lines-distinct")
    shared = stored(shared_halves(distinct, near_chars), "lines-halves")
    near = candidates(lines, distinct, shared, near_chars)
    copies = near.join(near_copies(near), "cid", "left_semi").select(digest)
    gone = distinct.join(copies.withColumn("near", F.lit(True)), "digest", "left") \
        .where("n > 1 or near").select("digest", F.when(F.col("near").isNull(), F.col("first")).alias("stays"))
    gone = stored(gone, "lines-gone")
    lost = lines.select(digest, "place").join(gone, "digest").where(~F.col("place").eqNullSafe(F.col("stays")))
    # equal rows are one document: a line number counts once
    return stored(lost.groupBy("place.id", "place.hash").agg(F.collect_set("place.line_no").alias("removed")), "lines-removed")


def without_lines(docs: DataFrame, id_col: str, text_col: str, removed: DataFrame) -> tuple[DataFrame, str]:
    """``docs`` with the text shortened, and the name of the added column with the removed line numbers."""
    own, key, gone = fresh(docs, "id", "hash", "removed")
    lost = removed.select(F.col("id").alias(own), F.col("hash").alias(key), F.col("removed").alias(gone))
    hashed = docs.withColumn(key, _doc_hash(id_col, text_col))
    joined = hashed.join(lost, (hashed[key] == lost[key]) & hashed[id_col].eqNullSafe(lost[own]), "left") \
        .drop(own).drop(lost[key]).drop(key)
    parts = F.split(F.col(text_col).cast("string"), "\n")
    stay = F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), F.col(gone))
    shorter = F.array_join(F.transform(stay, lambda i: F.get(parts, i)), "\n")
    return joined.withColumn(text_col, F.when(F.col(gone).isNull(), F.col(text_col)).otherwise(shorter)), gone


def drop_duplicate_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                         near_chars: int = NEAR_CHARS) -> DataFrame:
    """``docs`` without the lines that occur earlier; every row and all other columns unchanged."""
    out, gone = without_lines(docs, id_col, text_col, removed_lines(docs, id_col, text_col, min_chars, near_chars))
    return out.drop(gone)


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                near_chars: int = NEAR_CHARS) -> DataFrame:
    """One row per input row: doc_id, n_lines, n_removed, kept_sha256 (of the remaining text; null as empty)."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    rows = rows.withColumn("n_lines", F.coalesce(F.size(F.split("text", "\n")), F.lit(0)))
    out, gone = without_lines(rows, "doc_id", "text", removed_lines(rows, "doc_id", "text", min_chars, near_chars))
    return out.select("doc_id", F.greatest("n_lines", F.lit(0)).cast("long").alias("n_lines"),
                      F.coalesce(F.size(gone), F.lit(0)).cast("long").alias("n_removed"),
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line dedup of the whole ``documents`` table."""
    return dedup_lines(load(spark, sf_dir, "documents"))


OP7_SQL = """
WITH raw AS (
  SELECT doc_id, text, unnest(string_split(text, chr(10))) AS raw, generate_subscripts(string_split(text, chr(10)), 1) AS line_no
  FROM documents WHERE text IS NOT NULL),
lines AS (
  SELECT doc_id, line_no, trim(raw, ' ' || chr(9) || chr(13)) AS line, raw FROM raw),
firsts AS (
  SELECT line, length(line) AS n, min({'doc': doc_id, 'no': line_no}) AS place FROM lines WHERE line <> '' GROUP BY line),
ends AS (
  SELECT line, n, place, left(line, 8) AS e, 0 AS side FROM firsts WHERE n >= 20
  UNION ALL SELECT line, n, place, right(line, 8), 1 FROM firsts WHERE n >= 20
  UNION ALL SELECT line, n, place, left(line, 2), 2 FROM firsts WHERE n BETWEEN 4 AND 20
  UNION ALL SELECT line, n, place, right(line, 2), 3 FROM firsts WHERE n BETWEEN 4 AND 20),
near AS (
  SELECT DISTINCT b.line
  FROM ends a JOIN ends b ON a.e = b.e AND a.side = b.side AND b.n BETWEEN a.n - 1 AND a.n + 1 AND a.place < b.place
  WHERE CASE WHEN a.n = b.n
    THEN len(list_filter(range(1, a.n + 1), lambda i: substr(a.line, i, 1) <> substr(b.line, i, 1))) <= 1
    ELSE len(list_filter(range(1, greatest(a.n, b.n) + 1), lambda i:
      CASE WHEN a.n < b.n THEN a.line ELSE b.line END =
      left(CASE WHEN a.n > b.n THEN a.line ELSE b.line END, i - 1) || substr(CASE WHEN a.n > b.n THEN a.line ELSE b.line END, i + 1))) > 0 END),
judged AS (
  SELECT l.doc_id, l.line_no, l.raw,
         l.line <> '' AND (l.line IN (SELECT line FROM near) OR f.place <> {'doc': l.doc_id, 'no': l.line_no}) AS gone
  FROM lines l LEFT JOIN firsts f ON f.line = l.line),
docs AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(raw, chr(10) ORDER BY line_no) FILTER (NOT gone), '') AS kept
  FROM judged GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_lines, 0) AS n_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM documents d LEFT JOIN docs USING (doc_id)
"""
