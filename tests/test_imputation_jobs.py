"""Published runs, selection of candidates and calibrated probabilities."""

import pytest
from pyspark.ml.feature import IDF, HashingTF
from pyspark.sql import functions as F

from offerflow import schemas
from offerflow.operators import impute

AS_OF = "2025-07-01 10:00:00"


def job_tables(spark, complete=50, incomplete=12):
    """As the original's fixture: offers of two kinds, some of them enriched."""
    rows = [(str(i), "Développeur Python" if i % 2 else "Comptable audit", "x" * 60) for i in range(complete + incomplete)]
    offers = schemas.conform(spark.createDataFrame(rows, "id string, title string, description string"), schemas.OFFERS)
    facts = [(f"e{i}", str(i), *(("IT/Tech", "CDI", "Senior", "Full-time") if i % 2 else ("Finance", "CDD", "Junior", "Contract")), ["Python"], 1, 2)
             for i in range(complete)]
    enriched = schemas.conform(spark.createDataFrame(
        facts, "id string, offre_id string, extracted_sector string, extracted_contract_type string, job_level string, job_type string, "
               "extracted_skills array<string>, extracted_salary_min long, extracted_salary_max long"), schemas.ENRICHED)
    return offers, enriched


def config(path, **more):
    return impute.ImputeConfig(models_dir=str(path), max_iter=5, features=1 << 10, **more)


def test_jobs_publish_whole_runs_only(spark, tmp_path, monkeypatch):
    offers, enriched = job_tables(spark)
    models, path = config(tmp_path / "models", candidates=(0.1,), ml_targets=("extracted_sector",)), str(tmp_path / "rows")
    assert not impute.train_job(offers, enriched.where("id <> 'e0'"), models)  # 49 complete rows
    assert impute.published_models(spark, models) == {} and impute.published_rows(spark, path, schemas.ENRICHED) is None
    first = impute.full_job(offers, enriched, models, AS_OF, path)               # 50 of them
    rows = {r.offre_id: r for r in first.collect()}
    assert len(rows) == 62
    assert {k for k, r in rows.items() if str(r.processed_at) == AS_OF} == {str(i) for i in range(50, 62)}  # those without a sector
    assert all(rows[str(i)].extracted_sector == ("IT/Tech" if i % 2 else "Finance") for i in range(62))

    def broken(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as m:
        m.setattr(impute, "save_imputer", broken)
        with pytest.raises(RuntimeError):
            impute.full_job(offers, enriched, models, AS_OF, path)
    assert set(impute.published_models(spark, models)) == {"extracted_sector"}
    kept = impute.published_rows(spark, path, first.schema)
    assert sorted(map(str, kept.collect())) == sorted(map(str, rows.values()))
    again = impute.full_job(offers, enriched, models, AS_OF, path)
    assert sorted(map(str, again.collect())) == sorted(map(str, rows.values()))


def test_the_best_candidate_is_kept_and_calibrated(spark):
    rows = [(i, "alpha beta" if i % 3 else "gamma", "words " * 12, "A" if i % 3 else "B") for i in range(120)]
    complete = spark.createDataFrame(rows, "id int, title string, description string, kind string")
    settings = impute.ImputeConfig(max_iter=10, features=1 << 8, candidates=(0.01, 100000.0))
    features, fits, predictions = impute.validated_fits(complete, ["kind"], "id", settings)
    figures = {r.candidate: r for r in impute.candidate_figures(predictions).collect()}
    assert figures[0.01].rows == 24 and figures[0.01].f1 == 1.0 > figures[100000.0].f1
    model = impute.train_columns(complete, ["kind"], "id", settings)["kind"]
    assert model.metrics["f1"] == 1.0
    found = impute.predict_imputer(model, complete.select("id", "kind", F.concat_ws(" ", "title", "description").alias("_text"))).collect()
    assert all(r.label == r.kind and r.accepted for r in found)
    assert all(r.probability > r.confidence or r.probability > 0.9 for r in found)


def test_probabilities_never_fall_with_confidence():
    worth = impute.worth_of({1: (10, 5, 0.15), 4: (10, 2, 0.45), 5: (1, 1, 0.5), 9: (30, 30, 0.95)}, 10)
    assert worth[0] is None and worth[1] == worth[4] == pytest.approx((5 + 0.15 + 2 + 0.45) / 22)
    assert worth[5] == pytest.approx(0.75) and worth[9] == pytest.approx(30.95 / 31)
    assert impute.worth_of({}, 3) == (None, None, None)


def test_calibrated_confidences(spark):
    df = spark.createDataFrame([(0.05,), (0.15,), (0.999,), (1.0,), (None,)], "c double")
    worth = (None, 0.4, *[None] * 7, 0.8)
    assert [r[0] for r in df.select(impute.calibrated(F.col("c"), worth)).collect()] == [0.05, 0.4, 0.8, 0.8, None]


def test_figures_of_nothing(spark):
    empty = spark.createDataFrame([], "column string, candidate double, actual string, label string, confidence double")
    assert impute.candidate_figures(empty).collect() == [] and impute.reliability(empty, 5).collect() == []
    nothing = spark.createDataFrame([("c", 0.1, None, "a", 0.5)], empty.schema)
    assert impute.candidate_figures(nothing).collect() == []


def test_coefficients_are_those_of_words_that_occur(spark):
    """A score walks through the words of its text, not through a sparse matrix of all buckets; the model is the same."""
    rows = [(i, *((f"alpha w{i % 5}", "always", "A") if i % 3 else (f"delta w{i % 7}", "always", "B") if i % 2 else ("gamma w1", "always", "C")))
            for i in range(90)]
    complete = spark.createDataFrame(rows, "id int, title string, description string, kind string")
    settings = impute.ImputeConfig(max_iter=10, features=1 << 12, candidates=(0.01,))
    features, fits, _ = impute.validated_fits(complete, ["kind"], "id", settings)
    assert fits["kind", 0.01].stages[0].coefficientMatrix.numCols == 10  # alpha, gamma, delta, w0 to w6; "always" weighs nothing
    texts = complete.select("id", "kind", F.concat_ws(" ", "title", "description").alias("_text"))
    slim = impute.with_features(impute.fit_features(texts, "_text", settings), texts)
    assert impute.with_features(features, texts).select("_features").collect() == slim.select("_features").collect()
    whole = IDF(inputCol="_c", outputCol="_features").fit(counted := HashingTF(inputCol="_w", outputCol="_c", numFeatures=1 << 12).transform(
        texts.withColumn("_w", F.split("_text", " ")))).transform(counted)
    found = [{r.id: (r.label, pytest.approx(r.confidence, abs=1e-6)) for r in impute._classified(
        impute.fit_imputer(some, "kind", 0.01, settings), some.select("id", "_features")).collect()} for some in (whole, slim)]
    assert len(found[0]) == 90 and found[0] == {i: (label, c.expected) for i, (label, c) in found[1].items()}


def test_texts_that_are_all_the_same(spark):
    rows = [(i, "alpha", "beta", "A" if i % 3 else "B") for i in range(60)]
    complete = spark.createDataFrame(rows, "id int, title string, description string, kind string")
    settings = impute.ImputeConfig(max_iter=5, features=1 << 8)
    model = impute.train_columns(complete, ["kind"], "id", settings)["kind"]
    found = impute.predict_imputer(model, complete.select("id", F.lit("alpha beta").alias("_text"))).collect()
    assert {r.label for r in found} == {"A"} and len(found) == 60


def test_rules_read_rows_that_lack_a_value_only(spark, monkeypatch):
    rows = [("1", "Python", "salaire 300000 fcfa", ["Sql"], 5, 6), ("2", "Python", "salaire 300000 fcfa", None, None, 6),
            ("3", "Docker", "salaire 400000 fcfa", None, 5, 6), ("4", "Docker", "salaire 400000 fcfa", ["Sql"], 5, None)]
    df = spark.createDataFrame(rows, "id string, title string, description string, extracted_skills array<string>, "
                                     "extracted_salary_min long, extracted_salary_max long")
    read, with_skills, with_salary = {}, impute.with_skills, impute.with_salary

    def spied(name, real):
        def spy(texts, text, *more):
            read[name] = {r.id for r in texts.where(F.col(text).isNotNull()).select("id").collect()}
            return real(texts, text, *more)
        monkeypatch.setattr(impute, name, spy)

    spied("with_skills", with_skills)
    spied("with_salary", with_salary)
    filled, _ = impute.run_full_imputation(df, "id")
    assert read == {"with_skills": {"2", "3"}, "with_salary": {"2", "4"}}
    assert {r.id: (r.extracted_skills, r.extracted_salary_min, r.extracted_salary_max) for r in filled.collect()} == {
        "1": (["Sql"], 5, 6), "2": (["Python"], 300000, 6), "3": (["Docker"], 5, 6), "4": (["Sql"], 5, 400000)}
