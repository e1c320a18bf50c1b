"""What a task holds at a time stays bounded: texts and pages of a batch, lines of a written file."""

import glob
import os
import random
import unicodedata

import pyarrow as pa
from pyspark.sql import functions as F

from offerflow import workdir
from offerflow.functions import skill_index, skills
from offerflow.operators.key_phrases import corpus_phrases
from offerflow.plans import queries
from offerflow.sources import pages as pg


def test_texts_of_a_batch_are_taken_few_at_a_time():
    values = [None if i % 7 == 0 else f"text {i}" for i in range(1000)]
    slices = list(skill_index.in_slices(pa.array(values)))
    assert [v for some in slices for v in some] == values
    assert max(map(len, slices)) <= skill_index.TEXTS_AT_ONCE


def test_only_runs_that_are_not_ascii_are_decomposed(spark):
    r = random.Random(5)
    pieces = ["a", "ẹ́", "̣́", "é", "ﬁ", " ", "…", "한", "\n", "\n\n", " ", "É b", "\x00", "\x7f", "𝐀", "½", "̈́", "ﷺ"]
    texts = ["", "é", "é a", "a é", "\né\n", *("".join(r.choices(pieces, k=r.randrange(1, 15))) for _ in range(400))]
    rows = spark.createDataFrame(list(enumerate([*texts, None])), "i int, t string")
    found = rows.select("i", F.coalesce(skills._decomposed(F.col("t")), F.col("t")).alias("n")).collect()
    assert {x["i"]: x["n"] for x in found} == {i: t and unicodedata.normalize("NFKD", t) for i, t in enumerate([*texts, None])}


def test_skills_of_more_texts_than_are_taken_at_once(spark):
    rows = spark.range(0, 300, 1, 1).select("id", F.when(F.col("id") % 5 > 0, F.concat(F.lit("Été, Python et "), F.when(
        F.col("id") % 2 == 0, "Docker").otherwise("rien"))).alias("t"))
    found = skills.with_skills(rows, "t").select("id", F.array_sort("skills").alias("s")).collect()
    assert {x["id"]: x["s"] for x in found} == {
        i: [] if i % 5 == 0 else ["Docker", "Python"] if i % 2 == 0 else ["Python"] for i in range(300)}


def test_pages_of_a_batch_are_given_on_few_at_a_time(spark):
    batch = pa.RecordBatch.from_pydict({"html": [None if i == 9 else f"<p>{i}</p>" for i in range(1000)], "n": list(range(1000))})
    taken = list(pg._slices(iter([batch]), "html"))
    assert [n for rest, _ in taken for n in rest.column("n").to_pylist()] == list(range(1000))
    assert max(len(texts) for _, texts in taken) <= pg.PAGES_AT_ONCE and taken[0][1][9] == ""
    rows = spark.createDataFrame([(i, "https://a/", None if i == 9 else f"<p>{i}<a href='/x{i}'>l</a></p>") for i in range(200)], "n int, url string, html string")
    rows = rows.coalesce(1)
    fields = pg.extract_fields(rows, {"p": "p::text", "none": "h1::text"}).collect()
    assert {x["n"]: (x["fields"]["p"], x["fields"]["none"]) for x in fields} == {i: ([] if i == 9 else [str(i)], []) for i in range(200)}
    blocks = pg.extract_blocks(rows, {"block": "p", "fields": {"link": "a::attr(href)"}, "next": "a::attr(href)"}).collect()
    assert sorted((x["n"], x["position"], x["kind"], x["link"]) for x in blocks) == sorted(
        (i, at, kind, f"https://a/x{i}") for i in range(200) if i != 9 for at, kind in ((0, "detail"), (-1, "next")))


def test_large_offers_are_written_as_several_files(spark, tmp_path, monkeypatch):
    rows = [(i, f"line {i}\n\"quoted\", text\n" * 20, ("fr", "en")[i % 2], "web", 400) for i in range(120)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(str(tmp_path / "documents.parquet"))
    whole = sorted(queries.split_files(spark, str(tmp_path)).collect())
    monkeypatch.setattr(queries, "FILE_CHARS", 10_000)
    base = str(tmp_path / "files")
    monkeypatch.setattr(workdir, "new_path", lambda spark, name, new=workdir.new_path: base if name == "split-files" else new(spark, name))
    assert sorted(queries.split_files(spark, str(tmp_path)).collect()) == whole and len(whole) == 240
    for kind in ("csv", "json"):
        sizes = [os.path.getsize(f) for f in glob.glob(f"{base}/offers.{kind}/part-*")]
        assert len(sizes) > 3 and max(sizes) < sum(sizes) / 3


def test_pairs_of_phrases_are_not_exchanged(spark, capsys):
    rows = spark.createDataFrame([("data data engineer. data engineer, data. data data engineer",)], "t string")
    found = corpus_phrases(rows, "t")
    found.explain()
    assert not [line for line in capsys.readouterr().out.splitlines() if "Exchange" in line and "whole" in line]
    assert {x["phrase"]: (x["n"], x["longer"]) for x in found.collect()} == {
        "data data engineer": (2, 0), "data engineer": (3, 1), "data": (6, 2)}
