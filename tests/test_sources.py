"""Loaders, plugins, generated tables and writers."""

import pytest
from pyspark.sql import functions as F

from ospara.session import fresh_path
from ospara.sources import generator, readers, registry, sinks


def test_unknown_source_and_columns(spark):
    with pytest.raises(ValueError, match="unknown source type"):
        registry.ingest(spark, "nowhere", "x")
    path = fresh_path(spark, "t")
    spark.range(3).write.parquet(path)
    with pytest.raises(ValueError, match="missing feature columns.*'nope'"):
        registry.ingest(spark, "parquet", path, ["id", "nope"])


class Twice:
    def can_handle(self, kind, source):
        return kind == "twice"

    def ingest(self, spark, source, **options):
        return spark.range(source * 2)


def test_plugins_come_first(spark):
    registry.register_loader("twice", lambda spark, source, **_: spark.range(0))
    registry.load_plugin(f"{__name__}.Twice")
    assert registry.ingest(spark, "twice", 4).count() == 8


def test_multi_source_skips_failures(spark):
    sources = [
        registry.DataSource("a", "sql", "SELECT 1 AS x"), registry.DataSource("b", "parquet", "/nowhere/at/all"),
        registry.DataSource("c", "bad", ""), registry.DataSource("d", "sql", "SELECT 2 AS x, 'q' AS y"),
    ]
    assert sorted(r.x for r in registry.ingest_many(spark, sources).collect()) == [1, 2]
    with pytest.raises(ValueError):
        registry.ingest_many(spark, sources[1:3])


def test_json_payload_union_of_keys(spark):
    df = spark.createDataFrame([(1, '{"a":1,"b":"x"}'), (2, '{"c":2.5}'), (3, "{}")], "id int, p string")
    out = registry.ingest(spark, "json", df, column="p")
    assert out.columns == ["id", "a", "b", "c"]
    assert [tuple(r) for r in out.orderBy("id").collect()] == [(1, 1.0, "x", None), (2, None, None, 2.5), (3, None, None, None)]


def test_generated_table(spark):
    spec = {"n": 2000, "fields": {
        "ts": {"type": "date", "start": "2024-01-01", "freq": "H"}, "id": {"type": "id", "start": 5, "step": 2},
        "temp": {"type": "normal", "mean": 30, "std": 5}, "volt": {"type": "uniform", "low": 2, "high": 4},
        "wave": {"type": "sin", "amplitude": 2, "period": 10, "noise": 0.1},
        "status": {"type": "categorical", "categories": ["OK", "BAD"], "weights": [9, 1]}, "zero": {"type": "what"},
        "one": {"type": "categorical", "categories": ["only"]},
    }}
    df = generator.generate(spark, spec, partitions=3).cache()
    assert df.count() == 2000 and df.columns == list(spec["fields"])
    row = df.agg(F.avg("temp"), F.stddev("temp"), F.min("volt"), F.max("volt"), F.count_if(F.col("status") == "OK"),
                 F.max("zero"), F.max("ts").cast("string"), F.max("id"), F.min("one"), F.count("status")).first()
    assert row[0] == pytest.approx(30, abs=0.6) and row[1] == pytest.approx(5, abs=0.5)
    assert 2 <= row[2] and row[3] <= 4 and 1700 < row[4] < 1900 and row[5] == 0.0
    assert row[6] == "2024-03-24 07:00:00" and row[7] == 5 + 1999 * 2 and row[8] == "only" and row[9] == 2000
    with pytest.raises(ValueError, match="non-empty"):
        generator.generate(spark, {"n": 1, "fields": {"c": {"type": "categorical"}}})


def test_csv_with_quotes_and_newlines(spark):
    path = fresh_path(spark, "csv")
    rows = [(1, 'say "hi"\nthere, you'), (2, None)]
    sinks.write_csv(spark.createDataFrame(rows, "id int, t string"), path)
    assert sorted(map(tuple, registry.ingest(spark, "csv", path, multiLine=True).collect())) == rows


def test_json_envelope(spark):
    path = fresh_path(spark, "json")
    sinks.write_json(spark.range(5), path, "2024-01-01")
    assert spark.read.json(f"{path}/manifest").first().record_count == 5


def test_directory_detects_types(spark, tmp_path):
    (tmp_path / "deep" / "er").mkdir(parents=True)
    for name in ("a.txt", "deep/b.CSV", "deep/er/c.html", "deep/d.exe", "noext"):
        (tmp_path / name).write_text("x")
    files = registry.ingest(spark, "directory", str(tmp_path))
    assert sorted(r.content_type for r in files.select("content_type").collect()) == ["csv", "html", "text"]
    texts = registry.ingest(spark, "text", str(tmp_path / "a.txt")).collect()
    assert [r.content for r in texts] == ["x"]


def test_directory_contents_and_what_cannot_be_read(spark, tmp_path):
    (tmp_path / "deep").mkdir()
    (tmp_path / "deep" / "a.TXT").write_text("one\ntwo")
    (tmp_path / "b.json").write_text('{"n":1}\n{"n":\n{"n":2}')
    (tmp_path / "c.csv").write_text("x,y\n1,p\n2,q\n")
    (tmp_path / "d.parquet").write_text("no table")
    (tmp_path / "e.exe").write_text("x")
    rows = registry.ingest_directory(spark, str(tmp_path)).collect()
    assert sorted((r.content_type, r.content) for r in rows if not r.error) == [
        ("csv", '{"x":1,"y":"p"}'), ("csv", '{"x":2,"y":"q"}'), ("json", '{"n":1}'), ("json", '{"n":2}'), ("text", "one\ntwo")]
    assert sorted((r.path.rpartition("/")[2], r.error) for r in rows if r.error) == [
        ("b.json", "malformed record"), ("d.parquet", "unreadable"), ("e.exe", "unknown type")]
    good = spark.range(3).coalesce(1)
    good.write.parquet(str(tmp_path / "good"))
    found = registry.ingest_directory(spark, str(tmp_path)).filter("content_type = 'parquet'").collect()
    assert sorted(r.content or r.error for r in found) == sorted(["unreadable", '{"id":0}', '{"id":1}', '{"id":2}'])


def test_tables_without_rows_are_not_unreadable(spark, tmp_path):
    none = spark.range(0).coalesce(1)
    none.write.parquet(str(tmp_path / "no [r]ows, {1}"))
    none.write.option("header", True).csv(str(tmp_path / "none"))
    spark.range(2).coalesce(1).write.parquet(str(tmp_path / "two"))
    (tmp_path / "head.csv").write_text("x,y\n")
    (tmp_path / "cut.parquet").write_bytes(b"PAR1 cut PAR1")
    rows = registry.ingest_directory(spark, str(tmp_path)).collect()
    assert sorted((r.content, r.path.rpartition("/")[2] if r.error else None, r.error) for r in rows if r.content) == [
        ('{"id":0}', None, None), ('{"id":1}', None, None)]
    assert [(r.path.rpartition("/")[2], r.error) for r in rows if not r.content] == [("cut.parquet", "unreadable")]


def test_plugins_take_their_kind(spark):
    class Numbers:
        def can_handle(self, kind, source):
            return kind == "csv" and source == 4

        def ingest(self, spark, source, **options):
            return spark.range(source)

    plugin = Numbers()
    registry.register_plugin(plugin)
    try:
        assert registry.ingest(spark, "csv", 4).count() == 4
    finally:
        registry.unregister_plugin(plugin)


def test_text_embeddings(spark):
    df = spark.createDataFrame([("one two",), ("two three",), ("",)], "t string")
    out = readers.text_embeddings(df, "t", 8)
    assert out.columns == ["t"] + [f"emb_{i}" for i in range(8)]
    own = readers.text_embeddings(df, "t", 2, encoder=lambda c: F.array(F.length(c).cast("double"), F.lit(1.0)))
    assert own.first().emb_0 == 7.0


def test_json_payload_keeps_types(spark):
    df = spark.createDataFrame([(1, '{"code":"00123","ok":true,"n":7}'), (2, '{"code":"4","n":2.5}'), (3, "no json"), (4, None)], "id int, p string")
    out = registry.ingest(spark, "json", df, column="p")
    assert dict(out.dtypes) == {"id": "int", "code": "string", "n": "double", "ok": "boolean"}
    rows = {r.id: r for r in out.collect()}
    assert rows[1].code == "00123" and rows[1].ok is True and rows[2].n == 2.5 and rows[3].code is None


def test_text_embeddings_read_each_text_once(spark):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def read(text):
        seen.add(1)
        return text

    df = spark.createDataFrame([(i, f"word{i} and {i % 3}") for i in range(20)], "id long, t string")
    out = readers.text_embeddings(df.withColumn("t", read("t")), "t", 4)
    assert out.filter("emb_0 * emb_0 + emb_1 * emb_1 + emb_2 * emb_2 + emb_3 * emb_3 > 0.99").count() > 0
    assert seen.value == 20
