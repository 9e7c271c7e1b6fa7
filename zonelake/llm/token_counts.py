"""Token counts per field and section by offset-mapped attribution.

A document is written as one string, its fields one after the other with a newline between them; each line
of the section field is a section, each other field is one section.  The string is encoded once, whole.
The vocabulary is byte-level, so token lengths in bytes give exact character spans; the sorted spans are
interval-joined with the section bounds.  A token that crosses a boundary is allocated by a stated rule:

* ``first``: the section with its first character; ``last``: the one with its last;
* ``longest``: the one with most of its characters, ties to the earlier;
* ``split``: every section gets its share of the token's characters (counts are fractions).

A character that two tokens share belongs to both spans.  A separator belongs to the section before it.
The counts of a document add up to its tokens under every rule.

Defined results: a null field is an empty section; sections without characters have no tokens; repeated
rows and null ids are returned as they are; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import os

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonelake.llm.common import bound_batches, load

VOCABULARY = "byte_bpe_50k.tiktoken"
RULES = ("first", "last", "longest", "split")


class Spans:
    """Whole texts to token spans in characters."""

    def __init__(self, vocabulary: str = VOCABULARY):
        import public_tokenizers
        import tiktoken
        path = vocabulary if os.path.isabs(vocabulary) else public_tokenizers.path(vocabulary)
        with open(path, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.encoding = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.sizes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self.sizes[rank] = len(token)

    def of(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """First character and the one after the last, of every token."""
        ids = self.encoding.encode_ordinary(text)
        raw = np.frombuffer(text.encode(), np.uint8)
        character = np.cumsum((raw & 0xC0) != 0x80) - 1
        stops = np.cumsum(self.sizes[np.array(ids, np.int64)])
        starts = np.concatenate([[0], stops[:-1]]).astype(np.int64)[:len(stops)]
        return character[starts], character[stops - 1] + 1


_SPANS: dict[str, Spans] = {}


def spans_for(vocabulary: str) -> Spans:
    """One encoding per Python worker, kept between tasks."""
    if vocabulary not in _SPANS:
        _SPANS[vocabulary] = Spans(vocabulary)
    return _SPANS[vocabulary]


def sections_of(values: list[str | None], names: list[str], by_line: str) -> tuple[str, list[tuple[str, int]], np.ndarray]:
    """The document's string, its sections (field, number) and the character at which each begins."""
    parts, keys, begins, at = [], [], [], 0
    for name, value in zip(names, values):
        lines = (value or "").split("\n") if name == by_line else [value or ""]
        for k, line in enumerate(lines):
            keys.append((name, k))
            begins.append(at)
            parts.append(line)
            at += len(line) + 1
    return "\n".join(parts), keys, np.array([*begins, max(0, at - 1)], np.int64)


def allocate(first: np.ndarray, stop: np.ndarray, begins: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """Tokens per section under the rule, and the tokens that start in a section and end in a later one.

    ``begins`` holds the sections' first characters and the end of the text.
    """
    n = len(begins) - 1
    own = np.searchsorted(begins[:n], first, "right") - 1
    end = np.searchsorted(begins[:n], stop - 1, "right") - 1
    crossing = np.flatnonzero(end > own)
    crosses = np.bincount(own[crossing], minlength=n)
    if rule == "first":
        return np.bincount(own, minlength=n).astype(float), crosses
    if rule == "last":
        return np.bincount(end, minlength=n).astype(float), crosses
    counts = np.bincount(own[end == own], minlength=n).astype(float)
    bounds = np.append(begins[:n], np.iinfo(np.int64).max)
    for t in crossing.tolist():
        part = np.arange(own[t], end[t] + 1)
        share = np.minimum(bounds[part + 1], stop[t]) - np.maximum(bounds[part], first[t])
        if rule == "longest":
            counts[part[np.argmax(share)]] += 1
        else:
            counts[part] += share / share.sum()
    return counts, crosses


def token_counts(docs: DataFrame, fields: list[str], by_line: str, id_col: str = "doc_id", rule: str = "first",
                 vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per section: doc_id, field, section, start_char, end_char, n_tokens, n_crossing.

    ``by_line`` is the field whose lines are sections; start and end are characters of the whole string, the
    separator after a section included in it.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule}")
    bound_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), *[F.col(c).cast("string").alias(f"f{i}") for i, c in enumerate(fields)])
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("field", T.StringType()),
                           *(T.StructField(c, T.LongType()) for c in ("section", "start_char", "end_char")),
                           T.StructField("n_tokens", T.DoubleType()), T.StructField("n_crossing", T.LongType())])

    def run(batches):
        spans = spans_for(vocabulary)
        for batch in batches:
            columns = [batch.column(f"f{i}").to_pylist() for i in range(len(fields))]
            source, names, numbers, starts, ends, tokens, crossing = [], [], [], [], [], [], []
            for i, values in enumerate(zip(*columns)):
                text, keys, begins = sections_of(list(values), fields, by_line)
                counts, crosses = allocate(*spans.of(text), begins, rule) if text else (np.zeros(len(keys)), np.zeros(len(keys)))
                source += [i] * len(keys)
                names += [k[0] for k in keys]
                numbers += [k[1] for k in keys]
                starts.append(begins[:-1])
                ends.append(begins[1:])
                tokens.append(counts)
                crossing.append(crosses)
            longs = [pa.array(np.concatenate(x).astype(np.int64) if x else [], pa.int64()) for x in (starts, ends)]
            yield pa.record_batch([
                batch.column("doc_id").take(pa.array(source, pa.int64())), pa.array(names, pa.string()), pa.array(numbers, pa.int64()),
                *longs, pa.array(np.concatenate(tokens) if tokens else [], pa.float64()),
                pa.array(np.concatenate(crossing).astype(np.int64) if crossing else [], pa.int64())], names=schema.names)

    return rows.mapInArrow(run, schema)


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of source, language and every line of every whole document."""
    return token_counts(load(spark, sf_dir, "documents"), ["source", "lang", "text"], "text")
