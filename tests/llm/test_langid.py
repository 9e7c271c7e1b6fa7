import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_MID
from zonelake.llm import langid as L
from zonelake.llm.queries import QUERIES

SCHEMA = "doc_id bigint, text string, lang string, score string, lang_pred int"
EN = "the house is on the hill and the road goes to the town with the people "
DE = "das haus ist auf dem berg und der weg geht zu der stadt mit den leuten "


def table(n=80):
    return [(i, ((EN, DE)[i % 2] * 3)[i % 7:], ("en", "de")[i % 2], None, None) for i in range(n)]


def plain_probabilities(net, window):
    """One window, one position and one unit at a time."""
    states = []
    for d, order in ((0, window), (1, window[::-1])):
        h, seen = np.zeros(net["Uz"].shape[1]), []
        for byte in order:
            row = int(byte) + 256 * d
            z = np.clip(h @ net["Uz"][d] + net["Ez"][row], 0, 1)
            r = np.clip(h @ net["Ur"][d] + net["Er"][row], 0, 1)
            c = np.clip(r * (h @ net["Un"][d]) + net["En"][row], -1, 1)
            h = h + z * (c - h)
            seen.append(h)
        states.append(seen)
    out = []
    for t in range(len(window)):
        s = states[0][t] @ net["O"][0] + states[1][len(window) - 1 - t] @ net["O"][1] + net["b"]
        out.append(np.exp(s) / np.exp(s).sum())
    return np.array(out)


def test_forward_pass_equals_plain_loop():
    net = L.new_network(["a", "b", "c"], units=4)
    windows = np.random.default_rng(1).integers(0, 256, (5, 20)).astype(np.uint8)
    got = L.position_probabilities(net, windows)
    for k in range(5):
        assert np.allclose(got[:, :, k].T, plain_probabilities(net, windows[k]), atol=1e-4)


def test_gradients_equal_finite_differences():
    net = {k: v if k == "langs" else v.astype(np.float64) for k, v in L.new_network(["a", "b"], units=3).items()}
    rng = np.random.default_rng(2)
    windows, used, label = rng.integers(0, 256, (4, 6)).astype(np.uint8), np.ones((4, 6)), np.array([0, 1, 1, 0])
    grad, _ = L._gradients(net, windows, used, label)
    byte = int(windows[0, 0])
    for name, at in (("Uz", (0, 1, 2)), ("Ur", (1, 0, 1)), ("Un", (0, 2, 0)), ("O", (1, 1, 0)), ("b", (1,)), ("En", (byte, 1)), ("Ez", (byte, 0))):
        keep = net[name][at]
        loss = []
        for step in (1e-3, -1e-3):
            net[name][at] = keep + step
            loss.append(L._gradients(net, windows, used, label)[1])
        net[name][at] = keep
        assert grad[name][at] == pytest.approx((loss[0] - loss[1]) / 2e-3, abs=2e-3)


def test_pooling_covers_whole_texts():
    net = L.new_network(["a", "b"])
    text = bytes(range(1, 256)) * 3
    rows, used, owner = L.cut_windows([b"", text, b"x"])
    assert bytes(np.concatenate([r[:u] for r, u, o in zip(rows, used, owner) if o == 1])) == text
    want = sum(L.position_probabilities(net, rows[:-1])[:, :u, i].sum(axis=1) for i, u in enumerate(used[:-1])) / len(text)
    assert np.allclose(L.pooled(net, [b"", text, b"x"])[1], want, atol=1e-5)


def test_defined_cases(spark):
    rows = table() + [(900, None, "en", None, None), (901, "", "de", None, None), (902, "12 !?", "en", None, 4),
                      (None, EN, None, "s", None), (903, DE * 4000, None, None, None), (5, *table()[5][1:])]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = L.identify(docs).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    assert [by[i].lang_pred for i in (900, 901, 902)] == ["und"] * 3 and by[902].score == 0
    assert by[None].lang_pred == "en" and not by[None].held_out and by[903].lang_pred == "de"
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got if r.doc_id is not None)
    assert all(0 <= r.score <= 1 for r in got)
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns and kept.where("doc_id in (900, 901, 902)").count() == 0 and kept.count() == len(rows) - 3


def test_nothing_to_learn_from(spark):
    assert L.identify(spark.createDataFrame([], SCHEMA)).count() == 0
    got = L.identify(spark.createDataFrame([(1, "some text", None, None, None)], SCHEMA)).collect()
    assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)]


def test_labels_of_held_out_rows_and_other_columns_do_not_matter(spark):
    docs = spark.createDataFrame(table(), SCHEMA)
    wrong = docs.withColumn("lang", F.when(L.held_out("doc_id"), "zz").otherwise(F.col("lang")))
    first, second = (sorted(tuple(r) for r in L.identify(d).collect()) for d in (docs, wrong))
    assert first == second


def test_held_out_accuracy_of_the_query(spark):
    got = QUERIES["op6_language_id"](spark, SF_MID).where("held_out")
    truth = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "lang")
    right = got.join(truth, "doc_id").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.97


def test_keep_identified_goes_by_the_prediction(spark, monkeypatch):
    docs = spark.createDataFrame(table() + [(900, "12 !?", "en", None, None)], SCHEMA)
    assert sorted(r.doc_id for r in L.keep_identified(docs, languages=["en"]).collect()) == list(range(0, 80, 2))
    assert sorted(r.doc_id for r in L.keep_identified(docs).collect()) == list(range(80))
    flat = {**L.new_network([f"l{k}" for k in range(4)]), "O": np.zeros((2, L.UNITS, 4), np.float32)}
    monkeypatch.setattr(L, "learn", lambda *a, **k: flat)  # every language alike: score 0.25
    assert L.keep_identified(docs).count() == 0 and L.keep_identified(docs, least_score=0.2).count() == 80


def test_keep_identified_without_labels_keeps_rows_with_a_letter(spark):
    docs = spark.createDataFrame([(1, "some text", None, None, None), (2, "12 !?", None, None, 3), (3, None, None, "s", None)], SCHEMA)
    kept = L.keep_identified(docs)
    assert kept.columns == docs.columns and [r.doc_id for r in kept.collect()] == [1]
