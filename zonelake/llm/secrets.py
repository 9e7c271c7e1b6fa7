"""Secret scan with a random forest that removes false positives.

Candidates are

* the values in credential positions, of any length and with any punctuation: what is assigned to a credential
  name (``password = "..."``, ``api_key_prod: ...``), what follows ``Bearer``, the password of ``://user:...@``;
  a value in quotes goes to the closing quote of the line, another to the next blank, without closing punctuation;
* elsewhere, maximal runs of ``[A-Za-z0-9+/_-]`` (and closing ``=``) of 16 characters and more that hold a
  digit or an upper-case letter after the first character.

Each is described by

* its length, character classes and entropy,
* character transitions: class changes, and the mean log probability of its letter pairs under the pair
  counts of the whole corpus (a table of 128 x 128 at most),
* dictionary coverage: the share of it covered by the ``DICTIONARY`` most frequent words of the corpus,
* its path (parts that speak of tests, examples, configuration or keys) and the neighbouring words.

The forest is trained in numpy on labelled findings, ``PER_CLASS`` of each class at most (those with the
smallest hash of their id and value; the bound is a parameter), and scores every finding.  Where no labels
are given, ``weak_labels`` takes them from the corpus itself: a finding is a secret if it has the exact form
of a provider key or is a mixed value in a credential position; it is none if it is a placeholder, a plain
number, word, path or UUID outside such a position, or follows a name like ``commit``.  What neither rule
decides has no label, and is judged by the forest only.  As position decides some of these labels, those
examples are also learned without their context: a secret of the same make is found in other places.

Defined results: a null text or path is empty; repeated rows and null ids are returned as they are; without
findings of both classes to learn from every finding has score 1 (nothing is removed); an empty table gives
an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.llm.common import bound_batches, load, stored, text_or_empty

CANDIDATE = re.compile(r"[A-Za-z0-9+/_-]{16,}={0,2}")
WANTED = re.compile(r"[0-9]|(?<=.)[A-Z]")
CONTEXT = 48              # characters of context that are looked at on each side
DICTIONARY, LEAST_WORD = 4000, 3
PER_CLASS, TREES, DEPTH, THRESHOLDS = 1500, 40, 8, 16
CREDENTIAL = re.compile(r"(?i)(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key|auth(?:orization)?|bearer|credential)s?")
SET_TO = CREDENTIAL.pattern + r"(?:[_-]\w{1,16})?[\"']?\s*(?:=>|:=|[:=])\s*"
SCHEME = r"(?:(?:bearer|basic)[ \t]+)?"
BEGINS = re.compile(SET_TO + r"|\bbearer[ \t]+")
VALUE = re.compile(r"(?i)([\"'`])" + SCHEME + r"(?P<quoted>[^\n]+?)\1|[\"'`]?" + SCHEME + r"(?P<bare>[^\s\"'`]+)")
USERINFO = re.compile(r"://[^\s/:@]*:([^\s/@]+)@")
CLOSING = ".,;:)]}>"
ASSIGNED = re.compile(SET_TO + r"[\"'`]?" + SCHEME + r"$")
IN_POSITION = re.compile(r"(?i)(?:" + SET_TO.removeprefix("(?i)") + r"[\"'`]?" + SCHEME + r"|\bbearer[ \t]+|://[^\s/:@]*:)$")
PLACEHOLDER = re.compile(r"(?i)(?:change.?me|your.*|my.*|example.*|none|null|nil|true|false|todo|test|x{3,}|\*{3,}|\.{3,}|<.*>?|\$?\{.*\}?|\$\w+|%\w+%?)")
PLAIN = re.compile(r"[0-9]+|[^\W\d_]+|/?(?:[^\W\d_]+[/_-])+[^\W\d_]*|(?i:[0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})")
NO_SECRET_LEFT = re.compile(r"(?i)\b(?:sha-?\d*|md5|commit|checksum|digest|uuid|etag|rev(?:ision)?|hash)\W{1,4}$")
PROVIDER = re.compile(r"AKIA[0-9A-Z]{16}|gh[pousr]_[0-9A-Za-z]{36}|sk-[0-9A-Za-z_-]{20,}|xox[abp]-[0-9A-Za-z-]{10,}")
PATH_WORDS = ("test", "example", "sample", "doc", "config", "env", "key", "secret")
FEATURES = ("length", "digits", "uppers", "others", "entropy", "distinct", "class_changes", "pair_score", "hex_only", "coverage",
            "longest_word", "assigned", "quoted", "userinfo", "digest_left", "credential_left", "credential_right", "left_coverage", "right_coverage",
            "left_prose", "path_depth", *(f"path_{w}" for w in PATH_WORDS))


# --- corpus tables -----------------------------------------------------------------------

def pair_scores(docs: DataFrame, text_col: str) -> np.ndarray:
    """Log probability of the next ASCII character given the last, over all texts (lower-cased, add one)."""
    bound_batches(docs.sparkSession)

    def count(batches):
        total = np.zeros(128 * 128, np.int64)
        for batch in batches:
            raw = np.frombuffer(b"\x80".join(batch.column("text").cast(pa.binary()).to_pylist()).lower(), np.uint8).astype(np.int64)
            both = (raw[:-1] < 128) & (raw[1:] < 128)
            total += np.bincount(raw[:-1][both] * 128 + raw[1:][both], minlength=128 * 128)
        pair = np.flatnonzero(total)
        yield pa.record_batch([pa.array(pair), pa.array(total[pair])], names=["pair", "n"])

    counts = docs.select(text_or_empty(text_col).alias("text")).mapInArrow(count, "pair long, n long")
    table = np.ones((128, 128))
    for r in counts.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # 16384 rows at most
        table[r.pair // 128, r.pair % 128] += r.n
    return np.log(table / table.sum(axis=1, keepdims=True))


def frequent_words(docs: DataFrame, text_col: str, size: int = DICTIONARY) -> frozenset[str]:
    """The ``size`` most frequent words of the corpus, ties in alphabetical order; a bounded dictionary."""
    words = docs.select(F.explode(F.split(F.lower(text_or_empty(text_col)), r"[^\p{L}]+")).alias("word"))
    counts = words.where(F.length("word") >= LEAST_WORD).groupBy("word").count()
    return frozenset(r.word for r in counts.orderBy(F.desc("count"), "word").limit(size).collect())


# --- findings and their features ---------------------------------------------------------

def find(text: str) -> list[tuple[int, int]]:
    """Spans of the candidates of a text, in order; a run that meets a value in a credential position is not one."""
    spans = [m.span(1) for m in USERINFO.finditer(text)]
    for begin in BEGINS.finditer(text):
        m = VALUE.match(text, begin.end())
        if m and m["quoted"]:
            spans.append(m.span("quoted"))
        elif m and (bare := m["bare"].rstrip(CLOSING)):
            spans.append((m.start("bare"), m.start("bare") + len(bare)))
    runs = [m.span() for m in CANDIDATE.finditer(text) if WANTED.search(m.group())]
    out = []
    for a, b, _ in sorted([(a, b, 0) for a, b in spans] + [(a, b, 1) for a, b in _apart(runs, sorted(spans))]):
        if not out or a >= out[-1][1]:
            out.append((a, b))
    return out


def _apart(runs: list, spans: list) -> list:
    """The runs that no span meets; both are sorted."""
    out, at, reach = [], 0, 0
    for a, b in runs:
        while at < len(spans) and spans[at][0] < b:
            reach, at = max(reach, spans[at][1]), at + 1
        if reach <= a:
            out.append((a, b))
    return out


def findings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path_col: str = "source") -> DataFrame:
    """Stored candidates: doc_id, path, start, end, value, left and right context."""
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), text_or_empty(path_col).alias("path"), text_or_empty(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("path", T.StringType()),
                           T.StructField("start", T.LongType()), T.StructField("end", T.LongType()),
                           *(T.StructField(c, T.StringType()) for c in ("value", "left", "right"))])

    def run(batches):
        for batch in batches:
            source, out = [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                for a, b in find(text):
                    source.append(i)
                    out.append((a, b, text[a:b], text[max(0, a - CONTEXT):a], text[b:b + CONTEXT]))
            columns = list(zip(*out)) if out else [()] * 5
            take = pa.array(source, pa.int64())
            yield pa.record_batch([batch.column("doc_id").take(take), batch.column("path").take(take),
                                   *(pa.array(c, pa.int64()) for c in columns[:2]), *(pa.array(c, pa.string()) for c in columns[2:])],
                                  names=schema.names)

    return stored(rows.mapInArrow(run, schema), "secrets-findings")


def covered(text: str, words: frozenset[str]) -> tuple[float, int]:
    """Share of the characters that lie in dictionary words (longest first from the left), and the longest word."""
    low, at, inside, longest = text.lower(), 0, 0, 0
    while at < len(low):
        size = next((n for n in range(min(12, len(low) - at), LEAST_WORD - 1, -1) if low[at:at + n] in words), 0)
        inside, longest, at = inside + size, max(longest, size), at + max(1, size)
    return inside / max(1, len(low)), longest


def describe(value: str, left: str, right: str, path: str, pairs: np.ndarray, words: frozenset[str]) -> list[float]:
    """The features of one finding, in the order of ``FEATURES``."""
    n = len(value)
    kinds = ["d" if c.isdigit() else "u" if c.isupper() else "l" if c.islower() else "o" for c in value]
    share = {c: value.count(c) / n for c in set(value)}
    codes = value.lower().encode("ascii", "replace")
    score = float(np.mean(pairs[list(codes[:-1]), list(codes[1:])])) if len(codes) > 1 else 0.0
    coverage, longest = covered(value, words)
    before, after = re.findall(r"\w+", left)[-3:], re.findall(r"\w+", right)[:3]
    low = path.lower()
    return [n, kinds.count("d") / n, kinds.count("u") / n, kinds.count("o") / n, -sum(p * math.log2(p) for p in share.values()),
            len(share) / n, sum(a != b for a, b in zip(kinds, kinds[1:])) / n, score, float(bool(re.fullmatch(r"[0-9a-f]+", value))),
            coverage, longest, float(bool(re.search(r"[:=]\s*[\"']?$", left))), float(left[-1:] in ("'", '"')),
            float(bool(re.search(r"://[^\s/:@]*:$", left))), float(bool(NO_SECRET_LEFT.search(left))),
            float(any(CREDENTIAL.fullmatch(w) for w in before)), float(any(CREDENTIAL.fullmatch(w) for w in after)),
            float(np.mean([covered(w, words)[0] for w in before] or [0.0])), float(np.mean([covered(w, words)[0] for w in after] or [0.0])),
            float(bool(re.search(r"[a-zà-ÿ]{2,}[.,]?\s$", left))), low.count("/") + low.count("."), *(float(w in low) for w in PATH_WORDS)]


def judge(value: str, left: str) -> int | None:
    """1 for a provider's form or a mixed value in a credential position, 0 for what cannot be a secret, else None."""
    placed = bool(IN_POSITION.search(left))
    if PROVIDER.fullmatch(value):
        return 1
    if PLACEHOLDER.fullmatch(value) or (not placed and (PLAIN.fullmatch(value) or NO_SECRET_LEFT.search(left))):
        return 0
    return 1 if placed and len(value) >= 8 and re.search(r"\d", value) and re.search(r"[^\W\d_]", value) and not re.search(r"\s", value) else None


def weak_labels() -> Column:
    """The label of ``judge``, null where it has none."""
    @F.pandas_udf("int")
    def label(value: pd.Series, left: pd.Series) -> pd.Series:
        return pd.Series([judge(v, x) for v, x in zip(value, left)], dtype="Int32")

    return label("value", "left")


def without_context(sample: list) -> list[tuple]:
    """(value, left, right, path, label) of the weakly labelled findings whose make, not whose context, is to be learned."""
    return [(r.value, "", "", r.path, r.label) for r in sample if r.label == 1 or not NO_SECRET_LEFT.search(r.left)]


# --- random forest -----------------------------------------------------------------------
# A tree is a table of nodes: feature (-1: leaf), threshold, left child, right child, share of secrets.

def grow_tree(x: np.ndarray, y: np.ndarray, rng: np.random.Generator, depth: int = DEPTH) -> np.ndarray:
    """A tree of Gini splits on a bootstrap sample; each split looks at sqrt(features) random features."""
    picked = rng.integers(0, len(x), len(x))
    nodes, todo = [[-1, 0.0, 0, 0, 0.0]], [(0, picked, 0)]
    while todo:
        at, rows, level = todo.pop()
        share = float(y[rows].mean())
        nodes[at][4] = share
        if level == depth or len(rows) < 4 or share in (0.0, 1.0):
            continue
        best = (share * (1 - share) - 1e-9, None, None)
        for f in rng.choice(x.shape[1], max(1, int(math.sqrt(x.shape[1]))), replace=False):
            values = x[rows, f]
            for cut in np.unique(np.quantile(values, np.linspace(0, 1, THRESHOLDS + 2)[1:-1])):
                low = values <= cut
                if low.all():
                    continue
                a, b = y[rows[low]], y[rows[~low]]
                gini = (len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())) / len(rows)
                if gini < best[0]:
                    best = (gini, int(f), float(cut))
        if best[1] is None:
            continue
        low = x[rows, best[1]] <= best[2]
        nodes[at][:4] = [best[1], best[2], len(nodes), len(nodes) + 1]
        todo += [(len(nodes), rows[low], level + 1), (len(nodes) + 1, rows[~low], level + 1)]
        nodes += [[-1, 0.0, 0, 0, 0.0], [-1, 0.0, 0, 0, 0.0]]
    return np.array(nodes)


def grow_forest(x: np.ndarray, y: np.ndarray, trees: int = TREES, seed: int = 3) -> list[np.ndarray]:
    rng = np.random.default_rng(seed)
    return [grow_tree(x, y, rng) for _ in range(trees)]


def forest_scores(forest: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """Mean share of secrets in the leaves that the rows reach."""
    total = np.zeros(len(x))
    for tree in forest:
        at = np.zeros(len(x), np.int64)
        while (inner := tree[at, 0] >= 0).any():
            f = np.maximum(tree[at, 0], 0).astype(np.int64)
            step = np.where(x[np.arange(len(x)), f] <= tree[at, 1], tree[at, 2], tree[at, 3]).astype(np.int64)
            at = np.where(inner, step, at)
        total += tree[at, 4]
    return total / max(1, len(forest))


# --- operator ----------------------------------------------------------------------------

def labelled_sample(labelled: DataFrame, per_class: int = PER_CLASS) -> list:
    """The bounded training sample: ``per_class`` rows of each class, by hash of id and value."""
    share = labelled.where("label in (0, 1)").groupBy("label").agg(F.least(F.lit(1.0), 4.0 * per_class / F.count(F.lit(1))).alias("share"))
    order = F.abs(F.xxhash64("doc_id", "value", "start") / 2.0**63)
    few = labelled.join(F.broadcast(share), "label").withColumn("order", order).where("order <= share")  # two shares
    rank = F.row_number().over(Window.partitionBy("label").orderBy("order", "doc_id", "start", "value"))
    return few.withColumn("k", rank).where(F.col("k") <= per_class).select("path", "value", "left", "right", "label", "order") \
        .orderBy("order", "value", "left").collect()


def scan_secrets(docs: DataFrame, labelled: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text",
                 path_col: str = "source", training=None) -> DataFrame:
    """One row per finding: doc_id, start, end, value_sha256, score, is_secret.

    ``labelled`` has the columns of ``findings`` and ``label`` (0, 1); without it the corpus labels itself, on
    the rows that the condition ``training`` picks (default: all).
    """
    pairs, words = pair_scores(docs, text_col), frequent_words(docs, text_col)
    found = findings(docs, id_col, text_col, path_col)
    weak = labelled is None
    if weak:
        labelled = (found if training is None else found.where(training)).withColumn("label", weak_labels())
    sample = labelled_sample(labelled)
    examples = [(r.value, r.left, r.right, r.path, r.label) for r in sample] + (without_context(sample) if weak else [])
    y = np.array([e[4] for e in examples], float)
    forest = None
    if 0 < y.sum() < len(y):
        forest = grow_forest(np.array([describe(*e[:4], pairs, words) for e in examples]), y)

    @F.pandas_udf("double")
    def score(value: pd.Series, left: pd.Series, right: pd.Series, path: pd.Series) -> pd.Series:
        if forest is None or not len(value):
            return pd.Series(np.ones(len(value)))
        return pd.Series(forest_scores(forest, np.array([describe(*r, pairs, words) for r in zip(value, left, right, path)])))

    scored = found.withColumn("score", score("value", "left", "right", "path"))
    return scored.select("doc_id", "start", "end", F.sha2("value", 256).alias("value_sha256"), "score",
                         (F.col("score") >= 0.5).alias("is_secret"))


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored findings of the whole ``documents`` table; labels come from the rows whose crc32(doc_id) % 4 is not 2."""
    return scan_secrets(load(spark, sf_dir, "documents"), training=F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2)
