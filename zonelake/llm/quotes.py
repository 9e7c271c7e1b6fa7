"""Chat formatting by quotation linking.

Messages may quote earlier ones of their conversation with ``>`` marks, nested (``>> `` or ``> > ``) to any
depth.  Every line of a message has a quote level; consecutive lines of one level are a passage.  Quoted
passages and original text are normalised (marks removed, white space collapsed, lower-cased) and hashed;
the hashes are joined within a conversation:

* every own (level 0) passage of a message, every own line and every sentence of either is an original,
  whatever its length; of equal ones the earliest turn counts, so a hash has one original and a passage that
  many quote is joined once per quotation;
* a quoted passage links to the earliest message before it that holds it whole, else its lines are
  linked singly; the lines left over are put together again, so that wrapped lines do no harm, and linked by
  sentence.  A sentence ends at ``. ! ?`` before a blank, or at the full stops of Chinese and Japanese.

A message answers the message that its lowest linked quote level points to (most linked characters, then
the latest turn).  Threads are the trees of these links; the thread of a message is its first message, found
by pointer doubling, a logarithmic number of rounds.  The order (thread, turn) lists every message after the
one it answers.  Quotes are taken out of the text, linked or not.

Defined results: a null text stays null and quotes nothing; a message that links to nothing begins a thread
(its depth is 0); messages with a null conversation or turn link to nothing; repeated rows are all returned
and are one message for the links; different texts with one conversation and turn link together; roles without a tag are written as they are, a null role as ``unknown``;
an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from zonelake.llm.common import load, stored

MARKS = r"^[ \t]*((?:>[ \t]?)+)"
SENTENCE_END = r"([.!?]+[\"')\]]*) |([\u3002\uff01\uff1f]+)"
TAGS = {"system": "<|system|>", "user": "<|user|>", "assistant": "<|assistant|>"}
END = "<|end|>"


def _normal(text: Column) -> Column:
    return F.lower(F.btrim(F.regexp_replace(text, r"\s+", " ")))


def _hash(text: Column) -> Column:
    return F.unhex(F.md5(text))


def message_lines(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, copy, line_no, level, line): every line with its quote level, marks removed."""
    lines = messages.select("conv_id", "turn", F.xxhash64("text").alias("copy"), F.posexplode(F.split(F.regexp_replace("text", "\r", ""), "\n")).alias("line_no", "raw"))
    marks = F.regexp_extract("raw", MARKS, 1)
    level = F.length(F.regexp_replace(marks, r"[^>]", ""))
    return lines.select("conv_id", "turn", "copy", "line_no", level.alias("level"),
                        F.when(level > 0, F.regexp_replace("raw", MARKS, "")).otherwise(F.col("raw")).alias("line"))


def passages(lines: DataFrame) -> DataFrame:
    """(conv_id, turn, copy, level, first, normal): runs of lines of one level, as normalised text."""
    order = Window.partitionBy("conv_id", "turn", "copy").orderBy("line_no")
    starts = (F.lag("level").over(order).eqNullSafe(F.col("level"))).cast("int")
    runs = lines.withColumn("opens", 1 - starts).withColumn("run", F.sum("opens").over(order))
    joined = runs.groupBy("conv_id", "turn", "copy", "level", "run").agg(
        F.min("line_no").alias("first"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n").alias("text"))
    return joined.select("conv_id", "turn", "copy", "level", "first", _normal(F.col("text")).alias("normal"))


def _sentences(normal: Column) -> Column:
    """Sentences of a normalised text (which holds no line end)."""
    return F.filter(F.transform(F.split(F.regexp_replace(normal, SENTENCE_END, "$1$2\n"), "\n"), F.btrim), lambda x: x != "")


def quotation_links(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, level, source, chars): quoted characters per level and quoted message."""
    known = messages.where("conv_id is not null and turn is not null and text is not null").distinct()
    lines = message_lines(known)
    parts = stored(passages(lines), "quotes-passages")
    own = parts.where("level = 0").select("conv_id", "turn", "normal") \
        .union(lines.where("level = 0").select("conv_id", "turn", _normal(F.col("line")).alias("normal")))
    texts = F.array_distinct(F.concat(F.array("normal"), _sentences(F.col("normal"))))
    originals = own.where("normal != ''").select("conv_id", "turn", F.explode(texts).alias("normal")) \
        .groupBy("conv_id", _hash(F.col("normal")).alias("hash")).agg(F.min("turn").alias("source"))
    originals = stored(originals, "quotes-originals")
    passage = ["conv_id", "turn", "copy", "level", "first"]
    quoted = parts.where("level > 0 and normal != ''").select(*passage, F.length("normal").alias("chars"), _hash(F.col("normal")).alias("hash"))
    whole = stored(_linked(quoted, originals).select(*passage, "source", "chars"), "quotes-whole")
    single = _lines_of(lines).join(whole.select(passage), passage, "left_anti")
    single = stored(single.join(originals, ["conv_id", "hash"], "left")
                    .withColumn("source", F.when(F.col("source") < F.col("turn"), F.col("source"))), "quotes-lines")
    rest = single.where("source is null").groupBy(passage) \
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "normal"))), lambda x: x["normal"]), " ").alias("text"))
    said = rest.select(*passage, F.explode(_sentences(_normal(F.col("text")))).alias("normal"))
    said = said.select(*passage, F.length("normal").alias("chars"), _hash(F.col("normal")).alias("hash"))
    columns = [*passage, "source", "chars"]
    links = whole.union(single.where("source is not null").select(columns)).union(_linked(said, originals).select(columns))
    return links.groupBy("conv_id", "turn", "level", "source").agg(F.sum("chars").alias("chars"))


def _linked(quoted: DataFrame, originals: DataFrame) -> DataFrame:
    return quoted.join(originals, ["conv_id", "hash"]).where("source < turn")


def _lines_of(lines: DataFrame) -> DataFrame:
    """Quoted lines that are not blank, with the first line of their passage."""
    order = Window.partitionBy("conv_id", "turn", "copy").orderBy("line_no")
    opens = F.when(F.lag("level").over(order).eqNullSafe(F.col("level")), None).otherwise(F.col("line_no"))
    named = lines.withColumn("first", F.max(opens).over(order)).where("level > 0").withColumn("normal", _normal(F.col("line")))
    return named.where("normal != ''").select("conv_id", "turn", "copy", "level", "first", "line_no", "normal",
                                              F.length("normal").alias("chars"), _hash(F.col("normal")).alias("hash"))


def answers(links: DataFrame) -> DataFrame:
    """(conv_id, turn, parent): the message that each linked message answers."""
    best = F.min(F.struct("level", (-F.col("chars")).alias("c"), (-F.col("source")).alias("s"))).alias("best")
    return links.groupBy("conv_id", "turn").agg(best).select("conv_id", "turn", (-F.col("best.s")).alias("parent"))


def threads(parents: DataFrame) -> DataFrame:
    """(conv_id, turn, thread, depth) of the messages that answer another, by pointer doubling."""
    cur = stored(parents.select("conv_id", "turn", F.col("parent").alias("thread"), F.lit(1).alias("depth")), "quotes-threads")
    while True:
        up = cur.select("conv_id", F.col("turn").alias("thread"), F.col("thread").alias("above"), F.col("depth").alias("more"))
        nxt = cur.join(up, ["conv_id", "thread"], "left")
        nxt = stored(nxt.select("conv_id", "turn", F.coalesce("above", "thread").alias("thread"),
                                (F.col("depth") + F.coalesce("more", F.lit(0))).alias("depth"),
                                F.col("above").isNotNull().alias("moved")), "quotes-threads")
        cur = nxt.drop("moved")
        if nxt.where("moved").isEmpty():
            return cur


def without_quotes(text: Column) -> Column:
    """The text without quoted lines; blank lines around removed quotes go as well."""
    kept = F.filter(F.split(F.regexp_replace(text, "\r", ""), "\n"), lambda x: ~x.rlike(MARKS))
    return F.when(text.rlike(r"(?m)^[ \t]*>"), F.btrim(F.array_join(kept, "\n"), F.lit(" \n\t"))).otherwise(text)


def format_chats(messages: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
                 text_col: str = "text", tags: dict | None = None) -> DataFrame:
    """One row per input row: conv_id, turn, role, reply_to, thread, depth, body (without quotes) and chat (the
    formatted message).  Sorted by (conv_id, thread, turn) the ``chat`` values are the conversation."""
    rows = messages.select(F.col(conv_col).alias("conv_id"), F.col(turn_col).alias("turn"), F.col(role_col).cast("string").alias("role"),
                           F.col(text_col).cast("string").alias("text"))
    parents = stored(answers(quotation_links(rows.select("conv_id", "turn", "text"))), "quotes-parents")
    linked = threads(parents).join(parents, ["conv_id", "turn"])
    linked = stored(linked, "quotes-linked")
    out = rows.join(linked, ["conv_id", "turn"], "left")
    role, tag = F.coalesce("role", F.lit("unknown")), None
    for name, mark in (TAGS if tags is None else tags).items():
        tag = (F if tag is None else tag).when(role == name, F.lit(mark))
    tag = F.concat(F.lit("<|"), role, F.lit("|>")) if tag is None else tag.otherwise(F.concat(F.lit("<|"), role, F.lit("|>")))
    body = without_quotes(F.col("text"))
    return out.select("conv_id", "turn", "role", F.col("parent").alias("reply_to"), F.coalesce("thread", "turn").alias("thread"),
                      F.coalesce("depth", F.lit(0)).alias("depth"), body.alias("body"),
                      F.concat(tag, F.lit("\n"), F.coalesce(body, F.lit("")), F.lit(END)).alias("chat"))


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Reply-ordered, formatted messages of the whole ``conversations`` table."""
    return format_chats(load(spark, sf_dir, "conversations"))


OP10_SQL = r"""
WITH RECURSIVE known AS (
  SELECT DISTINCT conv_id, turn, text FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL AND text IS NOT NULL),
raw AS (
  SELECT conv_id, turn, text AS copy, unnest(string_split(replace(text, chr(13), ''), chr(10))) AS raw,
         generate_subscripts(string_split(replace(text, chr(13), ''), chr(10)), 1) AS line_no FROM known),
lines AS (
  SELECT conv_id, turn, copy, line_no, length(regexp_replace(regexp_extract(raw, '^[ \t]*((?:>[ \t]?)+)', 1), '[^>]', '', 'g')) AS level,
         regexp_replace(raw, '^[ \t]*((?:>[ \t]?)+)', '') AS line FROM raw),
marked AS (
  SELECT *, line_no - row_number() OVER (PARTITION BY conv_id, turn, copy, level ORDER BY line_no) AS run,
         lower(trim(regexp_replace(line, '\s+', ' ', 'g'))) AS normal FROM lines),
parts AS (
  SELECT conv_id, turn, copy, level, run, lower(trim(regexp_replace(string_agg(line, chr(10) ORDER BY line_no), '\s+', ' ', 'g'))) AS normal
  FROM marked GROUP BY ALL),
own AS (
  SELECT conv_id, turn, normal FROM parts WHERE level = 0 AND normal <> ''
  UNION SELECT conv_id, turn, normal FROM marked WHERE level = 0 AND normal <> ''),
originals AS (
  SELECT conv_id, normal, min(turn) AS source FROM (
    SELECT * FROM own UNION ALL
    SELECT conv_id, turn, trim(unnest(string_split(regexp_replace(normal, '([.!?]+["'')\]]*) |([。！？]+)', '\1\2' || chr(10), 'g'), chr(10)))) FROM own)
  WHERE normal <> '' GROUP BY ALL),
whole AS (
  SELECT p.conv_id, p.turn, p.copy, p.level, p.run, o.source, length(p.normal) AS chars
  FROM parts p JOIN originals o USING (conv_id, normal) WHERE p.level > 0 AND o.source < p.turn),
apart AS (
  SELECT m.*, o.source, length(m.normal) AS chars
  FROM marked m LEFT JOIN originals o ON o.conv_id = m.conv_id AND o.normal = m.normal AND o.source < m.turn
  WHERE m.level > 0 AND m.normal <> '' AND (m.conv_id, m.turn, m.copy, m.level, m.run) NOT IN (SELECT (conv_id, turn, copy, level, run) FROM whole)),
single AS (SELECT conv_id, turn, copy, level, run, source, chars FROM apart WHERE source IS NOT NULL),
rest AS (
  SELECT conv_id, turn, copy, level, run, string_agg(normal, ' ' ORDER BY line_no) AS normal
  FROM apart WHERE source IS NULL GROUP BY ALL),
said AS (
  SELECT conv_id, turn, level, trim(unnest(string_split(regexp_replace(normal, '([.!?]+["'')\]]*) |([。！？]+)', '\1\2' || chr(10), 'g'), chr(10)))) AS normal
  FROM rest),
sentences AS (
  SELECT s.conv_id, s.turn, s.level, o.source, length(s.normal) AS chars
  FROM said s JOIN originals o USING (conv_id, normal) WHERE o.source < s.turn),
links AS (
  SELECT conv_id, turn, level, source, sum(chars) AS chars FROM (
    SELECT conv_id, turn, level, source, chars FROM whole UNION ALL SELECT conv_id, turn, level, source, chars FROM single
    UNION ALL SELECT * FROM sentences) GROUP BY ALL),
parents AS (
  SELECT conv_id, turn, source AS parent FROM links
  QUALIFY row_number() OVER (PARTITION BY conv_id, turn ORDER BY level, chars DESC, source DESC) = 1),
tree AS (
  SELECT conv_id, turn, turn AS thread, 0 AS depth FROM known WHERE (conv_id, turn) NOT IN (SELECT (conv_id, turn) FROM parents)
  UNION ALL SELECT p.conv_id, p.turn, t.thread, t.depth + 1 FROM parents p JOIN tree t ON t.conv_id = p.conv_id AND t.turn = p.parent),
places AS (SELECT DISTINCT * FROM tree),
bodies AS (
  SELECT conv_id, turn, role, CASE WHEN regexp_matches(text, '(?m)^[ \t]*>') THEN trim(array_to_string(
      list_filter(string_split(replace(text, chr(13), ''), chr(10)), lambda x: NOT regexp_matches(x, '^[ \t]*>')), chr(10)), ' ' || chr(10) || chr(9))
    ELSE text END AS body FROM conversations)
SELECT b.conv_id, b.turn, b.role, p.parent AS reply_to, coalesce(t.thread, b.turn) AS thread, coalesce(t.depth, 0) AS depth, b.body,
       '<|' || coalesce(b.role, 'unknown') || '|>' || chr(10) || coalesce(b.body, '') || '<|end|>' AS chat
FROM bodies b LEFT JOIN places t USING (conv_id, turn) LEFT JOIN parents p USING (conv_id, turn)
"""
