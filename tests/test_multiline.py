"""Multi-line CSV and JSON read in splits, against Spark's readers of whole files."""

import json
import random

import pytest

from offerflow.sources import multiline, tables

SCHEMA = "id string, title string, n int"


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield spark
    for k, v in before.items():
        spark.conf.set(k, v)


def rows_of(seed, n=300):
    r = random.Random(seed)
    pieces = ["a", "é", '"', ",", "\n", "\n\n", " ", "[", "]{", "}", "\\", "'", "long " * 40, "\t", "]\n", "],\n[", '",\n"']
    return [(str(i), "".join(r.choices(pieces, k=r.randrange(0, 12))) or None, r.choice([None, i])) for i in range(n)]


def tuples(df):
    return sorted(map(repr, map(tuple, df.collect())))


def test_csv_in_splits(small_splits, tmp_path):
    spark = small_splits
    for seed in (1, 2):
        spark.createDataFrame(rows_of(seed), SCHEMA).coalesce(1).write.mode("append").option("header", True).option("escape", '"').csv(str(tmp_path / "a.csv"))
    schema = spark.createDataFrame([], SCHEMA).schema
    assert multiline.lines_of(spark, str(tmp_path / "a.csv")).rdd.getNumPartitions() >= 4
    whole = spark.read.schema(schema).option("header", True).option("multiLine", True).option("escape", '"').csv(str(tmp_path / "a.csv"))
    read = tables.read_offers(spark, str(tmp_path / "a.csv"), schema, multi_line=True)
    assert read.count() == 600 and tuples(read) == tuples(whole)


@pytest.mark.parametrize("style", [{"indent": 2}, {"indent": None}, {"indent": 0, "ensure_ascii": False}, "lines"])
def test_json_in_splits(small_splits, tmp_path, style):
    spark, folder = small_splits, tmp_path / "a.json"
    folder.mkdir()
    for seed in (3, 4):
        rows = [dict(zip(("id", "title", "n", "more"), (*r, {"deep": [{"x": "]"}]}), strict=True)) for r in rows_of(seed)]
        if style == "lines":
            text = "[" + ",\n".join(json.dumps(r) for r in rows) + "]\n"
        else:
            text = json.dumps(rows, **style)
        (folder / f"{seed}.json").write_text(text, encoding="utf-8")
    schema = spark.createDataFrame([], SCHEMA).schema
    whole = spark.read.schema(schema).option("multiLine", True).json(str(folder))
    read = tables.read_offers(spark, str(folder), schema, multi_line=True)
    assert read.count() == 600 and tuples(read) == tuples(whole)


def test_json_objects_and_odd_files(spark, tmp_path):
    schema = spark.createDataFrame([], SCHEMA).schema
    (tmp_path / "objects.json").write_text('\n{\n "id": "1",\n "n": 5\n}\n{"id": "2"}\n\n', encoding="utf-8")
    assert tuples(tables.read_offers(spark, str(tmp_path / "objects.json"), schema, multi_line=True)) == ["('1', None, 5)", "('2', None, None)"]
    for name, text in (("empty.json", ""), ("none.json", "[]"), ("blank.json", " \n[\n\n]\n"), ("empty.csv", ""), ("head.csv", "id,title,n\n")):
        (tmp_path / name).write_text(text, encoding="utf-8")
        assert tables.read_offers(spark, str(tmp_path / name), schema, multi_line=True).collect() == [], name
    (tmp_path / "crlf.csv").write_bytes(b'id,title,n\r\n1,"a\r\nb",2\r\n\r\n3,c,4')
    assert tuples(tables.read_offers(spark, str(tmp_path / "crlf.csv"), schema, multi_line=True)) == ["('1', 'a\\r\\nb', 2)", "('3', 'c', 4)"]
