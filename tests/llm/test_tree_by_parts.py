"""The suffix tree that is too large for a task: the scores of the small one, and no table with a row for every token."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from offerflow import workdir
from offerflow.llm import lm, lm_parts


@pytest.fixture
def docs(spark):
    r = random.Random(3)
    common, rare = [f"w{i}" for i in range(12)], [f"r{i}" for i in range(400)]
    texts = [" ".join(r.choice(rare) if r.random() < 0.1 else common[min(int(r.expovariate(0.4)), 11)] for _ in range(r.randrange(0, 90)))
             for _ in range(400)]
    texts += ["The Same passage\tagain and again é", None, "", "alone"] * 15
    keys = [None if i % 50 == 7 else -i if i % 3 else i // 2 for i in range(len(texts))]
    return spark.createDataFrame(list(zip(keys, texts, strict=True)), "doc_id long, text string").repartition(3)


def found(docs, **settings):
    rows = lm.scores(docs, settings=lm.Settings(least=4, cutoff=0.5, **settings)).collect()
    return sorted((r["key"] is None, r["key"] or 0, r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6), round(r["score"], 6))
                  for r in rows)


@pytest.mark.parametrize("part, spread", [(1 << 20, 1 << 20), (100, 1 << 20), (700, 20), (1, 1)])
def test_scores_by_parts_are_those_of_the_tree_in_one_place(docs, part, spread):
    whole = found(docs)
    assert len(whole) == docs.count() and len({x[-1] for x in whole}) > 100
    assert found(docs, broadcast=0, part=part, spread=spread) == whole


def test_no_table_has_a_row_for_every_token(spark, docs, monkeypatch):
    sizes, write = [], workdir.written

    def counted(df, name):
        made = write(df, name)
        sizes.append(made.count())
        return made

    for module in (workdir, lm):
        monkeypatch.setattr(module, "written", counted)
    tokens = sum(x[3] for x in found(docs.withColumn("text", F.repeat(F.concat(F.coalesce("text", F.lit("")), F.lit(" ")), 20)), broadcast=0))
    assert sizes and max(sizes) * 20 < tokens


def test_shuffle_files_go_when_a_table_is_written_alone(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    rows = workdir.written_alone(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "counts")
    assert sorted((r["k"], r["count"]) for r in rows.collect()) == [(k, 15 if k < 2 else 14) for k in range(7)]
    with pytest.raises(Exception, match="not to be written"):
        workdir.written_alone(spark.range(1).select(F.raise_error(F.lit("not to be written")).cast("string").alias("x")), "none")
    assert spark.conf.get(setting) == before


def test_packed_arrays_come_back():
    arrays = [np.array([], dtype=np.int64), np.array([0, 255, 256, 1 << 40]), np.array([True, False]), np.array([0.1, -1e300, 1.0]), np.array([], dtype=float),
              np.array([-5, 3], dtype=np.int64).view(np.uint64)]
    back = lm_parts.unpacked(lm_parts.packed(*arrays))
    assert [x.tolist() for x in back] == [[], [0, 255, 256, 1 << 40], [1, 0], [0.1, -1e300, 1.0], [], [-5, 3]]


@pytest.mark.parametrize("most", [1, 50, 1 << 61])
def test_ranks_are_those_of_numpy(most):
    for size in (0, 1, 1000):
        keys = np.random.default_rng(4).integers(0, most, size)
        for x, y in zip(lm_parts.ranks(keys), np.unique(keys, return_inverse=True), strict=True):
            assert x.tolist() == y.tolist()
