import csv
import json
import os
import random

import pytest

from zonelake.sources import read_dataset, write_dataset

from tests.conftest import rows

SCHEMA = "id int, a string, b string, c double"


@pytest.fixture()
def small_splits(spark):
    """Splits of a few hundred bytes, so that fields and elements go over many of them."""
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _texts(n, seed=4):
    rng = random.Random(seed)
    bits = ["word", '"', "\n", "\r\n", ",", " ", "é漢", "''", "\\", '""', "\n\n", "x" * 300, "[", "}", "{"]
    return [(i, "".join(rng.choices(bits, k=rng.randrange(0, 12))), rng.choice(["", "plain", "two\nlines", 'a "b"\n', None]), i / 4) for i in range(n)]


def _write_csv(path, data, end):
    with open(path, "w", newline="") as f:
        w = csv.writer(f, lineterminator=end, quoting=csv.QUOTE_MINIMAL)
        w.writerow(["id", "a", "b", "c"])
        for i, a, b, c in data:
            f.write(",".join([str(i), '"' + a.replace('"', '""') + '"', "" if b is None else '"' + b.replace('"', '""') + '"', str(c)]) + end)


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_one_csv_file_read_by_many_tasks(spark, tmp_dir, small_splits, end):
    data = _texts(200)
    path = os.path.join(tmp_dir, "one.csv")
    _write_csv(path, data, end)
    got = read_dataset(spark, path, "csv", SCHEMA, multiline=True, placed=True)
    assert spark.read.text(path).rdd.getNumPartitions() > 20
    assert rows(got.select("id", "a", "b", "c"), "id") == data
    assert [r.id for r in got.orderBy("_file", "_ord").collect()] == [d[0] for d in data]


def test_several_csv_files_written_by_spark(spark, tmp_dir, small_splits):
    data = _texts(120, seed=8)
    df = spark.createDataFrame(data, SCHEMA).repartition(3)
    write_dataset(df, tmp_dir + "/csv", "csv")
    assert rows(read_dataset(spark, tmp_dir + "/csv", "csv", SCHEMA, multiline=True), "id") == data
    write_dataset(df.limit(0), tmp_dir + "/none", "csv")
    assert read_dataset(spark, tmp_dir + "/none", "csv", SCHEMA, multiline=True).count() == 0


def test_csv_that_ends_inside_quotes_and_blank_lines(spark, tmp_dir, small_splits):
    path = os.path.join(tmp_dir, "bad.csv")
    with open(path, "w") as f:
        f.write('id,a,b,c\n1,"open,x,2\n' + "3,y,z,4\n" * 100)
    with pytest.raises(Exception, match="inside a quoted field"):
        read_dataset(spark, path, "csv", SCHEMA, multiline=True).collect()
    with open(path, "w") as f:
        f.write('id,a,b,c\n\n1,"x\n\ny",,bad\n\n2,y')
    assert rows(read_dataset(spark, path, "csv", SCHEMA, multiline=True), "id") == [(1, "x\n\ny", None, None), (2, "y", None, None)]


@pytest.mark.parametrize("layout", ["pretty", "lines", "one line", "several in a line"])
def test_one_json_array_read_by_many_tasks(spark, tmp_dir, small_splits, layout):
    data = [{"id": i, "a": a, "b": b, "c": c, "n": {"x": [i, i + 1], "y": a}} for i, a, b, c in _texts(150, seed=5)]
    body = {"pretty": json.dumps(data, indent=2), "lines": "[\n" + ",\n".join(map(json.dumps, data)) + "\n]\n", "one line": json.dumps(data),
            "several in a line": "﻿ [" + json.dumps(data[:70])[1:-1] + "\n,  " + json.dumps(data[70:])[1:-1].replace("}, {\"id\": 9", "},\n{\"id\": 9") + "]\n\n"}[layout]
    path = os.path.join(tmp_dir, "array.json")
    with open(path, "w") as f:
        f.write(body)
    got = read_dataset(spark, path, "json", SCHEMA + ", n struct<x: array<int>, y: string>", multiline=True, placed=True)
    assert [(r.id, r.a, r.b, r.c, r.n.x, r.n.y) for r in got.orderBy("_file", "_ord").collect()] == \
        [(d["id"], d["a"], d["b"], d["c"], d["n"]["x"], d["n"]["y"]) for d in data]


@pytest.mark.parametrize("body", ['[{"id": 1}, {"id": }]', '[{"id": 1}', '{"id": 1}', '[{"id": "x"}]', '[{"id": 1}]]'])
def test_malformed_json_array_is_an_error(spark, tmp_dir, body):
    path = os.path.join(tmp_dir, "bad.json")
    with open(path, "w") as f:
        f.write(body)
    with pytest.raises(Exception):
        read_dataset(spark, path, "json", SCHEMA, multiline=True).collect()


def test_empty_json_arrays(spark, tmp_dir):
    for name, body in (("a", "[]"), ("b", "[\n]\n"), ("c", "")):
        with open(os.path.join(tmp_dir, name + ".json"), "w") as f:
            f.write(body)
    assert read_dataset(spark, tmp_dir, "json", SCHEMA, multiline=True).count() == 0
