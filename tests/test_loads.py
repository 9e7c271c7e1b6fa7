import datetime as dt
import os

import pytest

from zonelake.operators import loads as L
from zonelake.session import publish_folder

SCHEMA = "id bigint, day date, value string"
KEYS = ["id", "day"]


def day(month, d=1, year=2024):
    return dt.date(year, month, d)


def batch(spark, rows, **more):
    return L.Batch(spark.createDataFrame(rows, SCHEMA), KEYS, "day", **more)


def seen(spark, root, table="a"):
    return sorted(((r.id, r.day, r.value) for r in L.read_loaded(spark, root, table, SCHEMA).collect()), key=str)


def test_loads_are_visible_whole_or_not_at_all(spark, tmp_path):
    root = str(tmp_path)
    assert seen(spark, root) == []
    first, more = [(1, day(1), "x"), (2, day(2), "y")], [(2, day(2), "other"), (3, day(3), "z")]
    assert L.load(spark, root, "1", {"a": batch(spark, first), "b": batch(spark, more)})
    L.write_aside(root, {"a": batch(spark, more), "b": batch(spark, first)})  # dies before it is published
    assert seen(spark, root) == first and seen(spark, root, "b") == more
    assert L.load(spark, root, "2", {"a": batch(spark, more), "b": batch(spark, first)})
    want = [(1, day(1), "x"), (2, day(2), "y"), (3, day(3), "z")]
    assert seen(spark, root) == want and seen(spark, root, "b") == [(1, day(1), "x"), (2, day(2), "other"), (3, day(3), "z")]
    assert not L.load(spark, root, "2", {"a": batch(spark, [(9, day(9), "late")])})
    assert L.load(spark, root, "3", {"a": batch(spark, want)}) and seen(spark, root) == want


def test_published_load_is_not_replaced(spark, tmp_path):
    for name in ("one", "two"):
        os.makedirs(tmp_path / name / name)
    assert publish_folder(spark, str(tmp_path / "one"), str(tmp_path / "load=1"))
    os.makedirs(tmp_path / "load=2")
    (tmp_path / "load=2" / "file").write_text("x")
    assert not publish_folder(spark, str(tmp_path / "two"), str(tmp_path / "load=2"))
    assert sorted(os.listdir(tmp_path / "load=1")) == ["one"] and sorted(os.listdir(tmp_path / "load=2")) == ["file"]


def test_nulls_ties_and_empty_batches(spark, tmp_path):
    root = str(tmp_path)
    rows = [(1, None, "no day"), (None, day(5), "no id"), (None, day(5), "no id"), (4, day(4), "b"), (4, day(4), "a")]
    want = sorted([(1, None, "no day"), (None, day(5), "no id"), (4, day(4), "a")], key=str)
    assert L.load(spark, root, "empty", {"a": batch(spark, [])}) and seen(spark, root) == []
    for name in ("1", "2"):
        assert L.load(spark, root, name, {"a": batch(spark, rows, order_by=["value"])}) and seen(spark, root) == want
    assert L.load(spark, root, "3", {"a": batch(spark, rows[:1])}) and L.load(spark, root, "4", {"a": batch(spark, [])}) and seen(spark, root) == want
    with pytest.raises(ValueError, match="part of the key"):
        L.load(spark, root, "5", {"a": L.Batch(spark.createDataFrame(rows, SCHEMA), ["id"], "day")})


def test_folders_of_years(spark, tmp_path):
    rows = [(1, day(1, year=2023), "x"), (2, day(7, year=2024), "y"), (3, None, "z")]
    for name in ("1", "2"):
        L.load(spark, str(tmp_path), name, {"a": batch(spark, rows, monthly=False)})
    assert sorted(p.name for p in (tmp_path / "zl_load=1" / "zl_table=a").glob("zl_period=*")) == ["zl_period=0", "zl_period=202300", "zl_period=202400"]
    assert seen(spark, str(tmp_path)) == rows


def test_bitmap_keeps_every_key_of_the_batch_and_few_others(spark):
    rows = spark.range(200_000).selectExpr("id", "date_add(date'2024-01-01', cast(id % 300 as int)) as day", "'v' as value")
    new = rows.where("id >= 190000")
    kept = L.thin_out(rows, new, KEYS, 10_000)
    assert kept.join(new, KEYS, "left_semi").count() == 10_000
    assert kept.count() < 40_000


def test_only_the_periods_of_the_batch_are_read(spark, tmp_path):
    root = str(tmp_path)
    L.load(spark, root, "1", {"a": batch(spark, [(m, day(m), "x") for m in range(1, 13)])})
    new = L.absent_rows(root, "a", batch(spark, [(5, day(5), "x"), (77, day(6), "new")]))
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "zl_period#" in plan and "202405" in plan and "202406" in plan and "PartitionFilters: [isnotnull(zl_period" in plan
    assert [(r.id, r.value, r.zl_period) for r in new.collect()] == [(77, "new", 202406)]


def test_batch_of_all_there_is_builds_no_bitmap(spark, tmp_path, monkeypatch):
    calls, thin_out = [], L.thin_out
    monkeypatch.setattr(L, "thin_out", lambda *a: calls.append(1) or thin_out(*a))
    rows = [(i, day(1 + i % 12), "x") for i in range(30)]
    for name, some in (("1", rows[:20]), ("2", rows), ("3", rows)):
        L.load(spark, str(tmp_path), name, {"a": batch(spark, some)})
    assert not calls and seen(spark, str(tmp_path)) == sorted(rows, key=str)
    L.load(spark, str(tmp_path), "4", {"a": batch(spark, [*rows[:2], (99, day(1), "new")])})
    L.load(spark, str(tmp_path), "5", {"a": batch(spark, [(1, day(2), "late"), (98, day(1), "new")])})
    assert calls and seen(spark, str(tmp_path)) == sorted([*rows, (99, day(1), "new"), (98, day(1), "new")], key=str)
