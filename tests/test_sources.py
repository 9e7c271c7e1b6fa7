import hashlib
import json
import os
import random

import pytest
from pyspark.sql import types as T

from zonelake.schemas import DUMP_TABLES
from zonelake.sources import file_manifest, publish, read_dataset, read_sql_dump, write_dataset, write_sql_dump
from zonelake.sources.sqldump import insert_tuples

from tests.conftest import rows

# Invented rows: comments between and inside INSERTs, one tuple per line, an escaped and a doubled quote,
# true/false literals, a schema name, columns in another order, a comment behind a tuple.
DUMP = """-- header comment
DROP TABLE IF EXISTS distritos;

CREATE TABLE distritos (
    id INTEGER PRIMARY KEY,
    nombre TEXT NOT NULL
);

-- data
INSERT INTO distritos (id, nombre, poblacion, superficie_km2, densidad_poblacion, latitud, longitud, codigo_postal_principal) VALUES
(71, 'Ribera Alta', 1200, 1.25, 960.00, 10.5, -20.25, 90001),
-- a comment inside the statement
(72, 'x),(y', 300, 0.5, 600.00, 11.5, -21.25, NULL), -- behind (a tuple)
(73, 'NULL', 1, 2, 3, 4, 5, 6);

INSERT INTO city.distritos (nombre, id) VALUES ('O''Molino, x', 74), ('x), (y', 75);
INSERT INTO zonas_verdes VALUES
(17, 'Prado d\\'Invento, Norte', 'Parque', 15, 400, 40.5, -3.5, 2003, 45, true, false, true);"""


def test_sql_dump_parse(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dump.sql")
    with open(path, "w") as f:
        f.write(DUMP)
    tabs = read_sql_dump(spark, path, DUMP_TABLES)
    d = rows(tabs["distritos"].drop("_file", "_ord", "_pos"), "id")
    assert d == [(71, "Ribera Alta", 1200, 1.25, 960.0, 10.5, -20.25, 90001),
                 (72, "x),(y", 300, 0.5, 600.0, 11.5, -21.25, None), (73, "NULL", 1, 2.0, 3.0, 4.0, 5.0, 6),
                 (74, "O'Molino, x", None, None, None, None, None, None), (75, "x), (y", None, None, None, None, None, None)]
    z = tabs["zonas_verdes"].first()
    assert z.nombre == "Prado d'Invento, Norte" and z.tiene_area_deportiva is False and z["año_creacion"] == 2003
    assert tabs["consumo_energetico"].count() == 0


def test_sql_dump_line_that_does_not_parse_is_an_error(spark, tmp_dir):
    path = os.path.join(tmp_dir, "dump.sql")
    for body, match in (("(1, 'x';\n", "does not parse"), ("(1, 'open\n", "inside a string")):
        with open(path, "w") as f:
            f.write("INSERT INTO distritos (id, nombre) VALUES\n" + body)
        with pytest.raises(Exception, match=match):
            read_sql_dump(spark, path, DUMP_TABLES)


@pytest.mark.parametrize("split", ["128m", "64"])
def test_sql_dump_strings_over_several_lines(spark, tmp_dir, split):
    texts = ["one", "two\nlines", "a\n\n(b), 'c'\n-- no comment's end\nINSERT INTO zonas_verdes VALUES\n(1);", "end\n", "\n--\n", "it's -- here", "x\r\ny",
             "tail -- '", "back\\\n'slash\\"] * 7
    lines = ["-- it's a comment", "INSERT INTO distritos (id, nombre) VALUES"]
    for i, t in enumerate(texts):
        quoted = t.replace("\\", "\\\\").replace("'", "''" if i % 2 else "\\'")
        lines.append(f"({i}, '{quoted}')" + ("," if i + 1 < len(texts) else ";") + (" -- don't (mind)" if i % 3 == 0 else ""))
        if i % 5 == 0:
            lines.append("-- a line's comment")
    path = os.path.join(tmp_dir, "dump.sql")
    with open(path, "w", newline="") as f:
        f.write("\n".join(lines) + "\n")
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        tabs = read_sql_dump(spark, path, DUMP_TABLES)
        got = tabs["distritos"].orderBy("_file", "_ord", "_pos").collect()
        assert tabs["zonas_verdes"].count() == 0
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert [(r.id, r.nombre) for r in got] == list(enumerate(texts))


TEXTS = ["", " lead and trail ", "a\nb\r\nc\rd", 'say "hi", it\'s', "back\\slash\\n \\\\", "NULL", "null", "x),(y", "x), (y", "-- c",
         "tab\there", ";", "é漢🙂", "'", '"', "\\", ",", None, "INSERT INTO t VALUES (1)"]


def test_text_survives_every_round_trip(spark, tmp_dir):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "id int, s string")
    write_dataset(df, tmp_dir + "/csv", "csv")
    write_dataset(df, tmp_dir + "/json", "json")
    write_sql_dump(df, tmp_dir + "/dump", "t")
    want = list(enumerate(TEXTS))
    assert rows(read_dataset(spark, tmp_dir + "/csv", "csv", df.schema, multiline=True), "id") == want
    assert rows(read_dataset(spark, tmp_dir + "/json", "json", df.schema), "id") == want
    assert rows(read_sql_dump(spark, tmp_dir + "/dump", {"t": df.schema})["t"].select("id", "s"), "id") == want


def test_sql_dump_one_insert_spread_over_many_splits(spark, tmp_dir):
    n = 400
    body = ["-- big table", "INSERT INTO lineas_transporte (id, nombre, tipo, longitud_km, num_paradas, "
            "frecuencia_media_min, año_inauguracion) VALUES"]
    body += [f"({i}, 'Línea {i}', 'Metro', {i}.5, {i % 30}, 4.0, {1900 + i % 100})," for i in range(1, n)]
    body += [f"({n}, 'Línea {n}', 'EMT', 1.0, 1, 2.0, 2000);", "",
             "INSERT INTO distritos (id, nombre, poblacion, superficie_km2, densidad_poblacion, latitud, longitud, "
             "codigo_postal_principal) VALUES (1, 'Centro', 1, 1.0, 1.0, 40.0, -3.0, 28013), "
             "(2, 'Retiro', 2, 2.0, 2.0, 41.0, -3.1, NULL);"]
    path = os.path.join(tmp_dir, "big.sql")
    with open(path, "w") as f:
        f.write("\n".join(body))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1024")      # ~25 splits, most without a header
    try:
        tabs = read_sql_dump(spark, path, DUMP_TABLES)
        lines = tabs["lineas_transporte"]
        got = lines.select("id", "tipo", "_ord", "_pos").collect()
        assert sorted(r.id for r in got) == list(range(1, n + 1))
        assert [r.id for r in sorted(got, key=lambda r: (r._ord, r._pos))] == list(range(1, n + 1))
        assert rows(tabs["distritos"].select("id", "codigo_postal_principal"), "id") == [(1, 28013), (2, None)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_sql_dump_roundtrip_with_quotes_and_nulls(spark, tmp_dir):
    df = spark.createDataFrame([(1, "it's", True, None), (2, "back\\slash", False, 2.5)],
                               "id int, s string, b boolean, v double")
    write_sql_dump(df, tmp_dir + "/d", "t")
    back = read_sql_dump(spark, tmp_dir + "/d", {"t": df.schema})["t"].drop("_file", "_ord", "_pos")
    assert rows(back, "id") == rows(df, "id")


def test_csv_json_parquet_roundtrip_and_bad_format(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a,b", 1.5), (2, None, None)], "id int, s string, v double")
    for fmt in ("csv", "json", "parquet"):
        write_dataset(df, f"{tmp_dir}/{fmt}", fmt)
        assert rows(read_dataset(spark, f"{tmp_dir}/{fmt}", fmt, df.schema), "id") == rows(df, "id")
    with pytest.raises(ValueError):
        write_dataset(df, tmp_dir + "/x", "xlsx")
    with pytest.raises(ValueError):
        read_dataset(spark, tmp_dir + "/x", "xlsx")


def test_json_array_document_and_failfast(spark, tmp_dir):
    recs = [{"id": 1, "categoria": "Limpieza", "descripcion": "x", "fecha_reporte": "2024-01-02 10:00:00",
             "fecha_resolucion": None, "latitud": 40.4, "longitud": -3.7},
            {"id": 1, "categoria": "Limpieza", "descripcion": "dup", "fecha_reporte": "bad",
             "fecha_resolucion": None, "latitud": None, "longitud": -3.7}]
    good = os.path.join(tmp_dir, "avisos.json")
    with open(good, "w") as f:
        json.dump(recs, f, indent=2)
    from zonelake.operators.clean import CITY_SPECS, clean_and_check
    from zonelake.schemas import CITIZEN_REPORTS
    df = read_dataset(spark, good, "json", CITIZEN_REPORTS, multiline=True)
    assert df.count() == 2
    cleaned, checks = clean_and_check(df, CITY_SPECS["citizen_reports"])
    assert cleaned.count() == 1
    bad = os.path.join(tmp_dir, "bad.json")
    with open(bad, "w") as f:
        f.write('[{"id": 1, "categoria": ')
    with pytest.raises(Exception):
        read_dataset(spark, bad, "json", CITIZEN_REPORTS, multiline=True).collect()


def test_publish_records_metadata(spark, tmp_dir):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "id int, s string")
    meta = publish(df, tmp_dir + "/p", "access-zone", "x/p.parquet", properties={"purpose": "test"}).first()
    assert meta.rows == 2 and meta.columns == ["id", "s"] and meta.column_types == {"id": "int", "s": "string"}
    assert meta.properties == {"purpose": "test"} and meta.format == "parquet"


def test_sql_dump_keeps_quotes_in_a_row_and_every_character(spark, tmp_dir):
    texts = ["''", "a'''b", "\\''", "\\n\n\\\\n", "\r\\r", "\uffff", "x\\''\\"]
    df = spark.createDataFrame(list(enumerate(texts)), "id int, s string")
    write_sql_dump(df, tmp_dir + "/d", "t")
    assert rows(read_sql_dump(spark, tmp_dir + "/d", {"t": df.schema})["t"].select("id", "s"), "id") == list(enumerate(texts))


def test_sql_dump_of_whole_lines_is_read_where_it_is(spark, tmp_dir):
    def plan(path):
        return insert_tuples(spark, path)._jdf.queryExecution().executedPlan().toString()

    def put(name, text):
        with open(os.path.join(tmp_dir, name), "w") as f:
            f.write(text)

    schema = T.StructType.fromDDL("id int, s string")
    put("a.sql", "-- it's\nINSERT INTO t (id, s) VALUES (1, 'a--\\'('), (2, '');\nINSERT INTO t (id, s) VALUES (3, 'it''s');\n")
    assert "Window" not in plan(tmp_dir) and "Exchange" not in plan(tmp_dir)
    put("b.sql", "INSERT INTO t (id, s) VALUES\n(4, 'x\n(5, y'),\n(6, '-');\n")
    assert "Window" in plan(tmp_dir)
    got = read_sql_dump(spark, tmp_dir, {"t": schema})["t"].orderBy("_file", "_ord", "_pos")
    assert [(r.id, r.s) for r in got.collect()] == [(1, "a--'("), (2, ""), (3, "it's"), (4, "x\n(5, y"), (6, "-")]


def test_file_manifest_hash(spark, tmp_dir):
    for name, body in (("a.csv", b"x,y\n1,2\n"), ("b.csv", b"")):
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(body)
    m = {r.object_name: r for r in file_manifest(spark, tmp_dir, "raw-ingestion-zone", glob="*.csv").collect()}
    assert m["a.csv"].file_hash == hashlib.sha256(b"x,y\n1,2\n").hexdigest() and m["a.csv"].file_size == 8
    assert m["b.csv"].file_hash == hashlib.sha256(b"").hexdigest() and m["b.csv"].file_size == 0


def test_file_manifest_hashes_files_over_a_row_by_bounded_tasks(spark, tmp_dir, monkeypatch):
    from zonelake.sources import binary
    rng = random.Random(5)
    noise = rng.randbytes(900_000)
    files = {"noise.bin": noise, "feeds.bin": b"\n" * 150_000 + b"\r\n\r" * 30_000, "open.bin": noise[:300_000] + b"x", "closed.bin": noise[:300_000] + b"\n",
             "marked.bin": b"\xef\xbb\xbf" + noise[:200_000], "marked twice.bin": b"\xef\xbb\xbf" * 2 + noise[:200_000] + b"\n", "na[m]e{1}.bin": noise[5:250_000],
             "one line.bin": bytes(200_000), "small.bin": b"a\nb", "empty.bin": b""}
    for name, body in files.items():
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(body)
    monkeypatch.setattr(binary, "LARGEST", 100_000)      # more does not fit a row
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "65536")
    try:
        got = {r.object_name: (r.file_hash, r.file_size) for r in file_manifest(spark, tmp_dir, "raw-ingestion-zone").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {name: (hashlib.sha256(body).hexdigest(), len(body)) for name, body in files.items()}


def test_file_manifest_reads_whole_what_line_readers_unpack(spark, tmp_dir, monkeypatch):
    from zonelake.sources import binary
    for name in ("a.csv.gz", "b.csv"):
        with open(os.path.join(tmp_dir, name), "wb") as f:
            f.write(b"no gzip\n" * 100)
    monkeypatch.setattr(binary, "WHOLE", 50)
    assert {r.file_hash for r in file_manifest(spark, tmp_dir, "raw-ingestion-zone").collect()} == {hashlib.sha256(b"no gzip\n" * 100).hexdigest()}


def test_preview_catalog_and_ctas(spark, tmp_dir):
    from zonelake.operators.reports import period_summary
    from zonelake.sources import create_table_as, describe, drop_table, preview, show_tables
    import datetime as dt
    df = spark.createDataFrame([(dt.datetime(2024, 1, 5), 10.0), (dt.datetime(2024, 2, 1), 5.0)], "ts timestamp, a double")
    write_dataset(df, tmp_dir + "/src", "parquet")
    assert preview(spark, tmp_dir + "/src", n=1).count() == 1
    t = create_table_as(period_summary(df, "ts", "a"), "zl_monthly_summary", tmp_dir + "/monthly")
    assert rows(t.select("year", "month", "order_count"), "month") == [(2024, 1, 1), (2024, 2, 1)]
    assert "zl_monthly_summary" in [r.tableName for r in show_tables(spark).collect()]
    d = describe(t).collect()
    assert [(r.col_name, r.data_type) for r in d][:2] == [("year", "int"), ("month", "int")]
    drop_table(spark, "zl_monthly_summary")
    assert "zl_monthly_summary" not in [r.tableName for r in show_tables(spark).collect()]
