import hashlib

import public_tokenizers
from tokenizers import Tokenizer

import __spark_entry__ as E
import corpus_pipeline as C
from tests.conftest import SF_SMALL
from tests.llm import test_decontam, test_line_dedup, test_packing, test_simhash
from zonelake.llm.common import stored

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, kept string, row_no int"


def documents(spark):
    return [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]


def in_order(spark, docs):
    out = {}
    for name, stage in C.STAGES:
        docs = out[name] = stored(stage(spark, docs, SF_SMALL), "test")
    return out


def test_every_stage_equals_brute_force(spark):
    rows = documents(spark)
    out = in_order(spark, spark.read.parquet(f"{SF_SMALL}/documents.parquet"))
    named = {tuple(r) for r in out["language_id"].collect()}
    assert named == {r for r in rows if r[1] and any(c.isalpha() for c in r[1])}

    lines = {r.doc_id: r for r in out["line_dedup"].collect()}
    want = {d: sha for d, _, _, sha in test_line_dedup.slow(sorted(named))}
    assert {d: hashlib.sha256(r.text.encode()).hexdigest() for d, r in lines.items()} == want
    assert all(r.n_chars == len(r.text) for r in lines.values())

    unique = {r.doc_id: r for r in out["simhash_near_dedup"].collect()}
    assert set(unique) == {c for _, _, c in test_simhash.slow_groups([(d, r.text) for d, r in lines.items()])}

    items = [tuple(r) for r in spark.read.parquet(f"{SF_SMALL}/benchmark.parquet").select("item_id", "text").collect()]
    clean = {r.doc_id: r for r in out["benchmark_decontamination"].collect()}
    dirty = {d for d, hit, *_ in test_decontam.slow_flags([(d, r.text) for d, r in unique.items()], items) if hit}
    assert set(clean) == set(unique) - dirty and len(dirty) > 0
    assert all(tuple(clean[d]) == tuple(unique[d]) == tuple(lines[d]) for d in clean)

    plain = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    test_packing.check([(d, r.text) for d, r in clean.items()], out["packing"].collect(),
                       lambda t: plain.encode(t, add_special_tokens=False).ids)
    assert sorted(map(str, C.run(spark, SF_SMALL).collect())) == sorted(map(str, out["packing"].collect()))


def test_stages_keep_the_columns_and_survive_odd_rows(spark):
    rows = [(1, None, None, None, None, "x", 1), (2, "", "en", "s", 0, None, None), (3, "!! 12", "en", "s", 5, None, None),
            (4, "some english words", "en", None, 18, None, 3), (None, "some english words", None, None, 18, None, 3),
            (4, "some english words", "en", None, 18, None, 3), (5, "wort " * 30_000, "de", "s", None, None, None)]
    for data in (rows, []):
        docs = spark.createDataFrame(data, SCHEMA)
        for name, stage in C.STAGES[:-1]:
            docs = stored(stage(spark, docs, SF_SMALL), "test")
            assert docs.columns == [c.split()[0] for c in SCHEMA.split(", ")], name
        packed = C.packing(spark, docs, SF_SMALL).collect()
        # the row without an id loses its only line to row 4 and stays as an empty text
        assert {r.doc_id for r in packed} == ({4, 5, None} if data else set())


def test_entry_lists_every_query():
    keys = set(E.queries())
    assert {"pipeline", *(k for k in keys if k.startswith("op"))} <= keys
    assert set(E.oracle_sql()) <= keys and [n for n, _ in C.STAGES] == [
        "language_id", "line_dedup", "simhash_near_dedup", "benchmark_decontamination", "packing"]
