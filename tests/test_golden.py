"""Hand-derived rows for every rule family."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from offerflow.functions import contract, dates, salary, semantics, skills
from offerflow.functions import text as tx
from offerflow.operators.keyed import exact_median

AS_OF = "2025-07-01 10:00:00"


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "i int, t string")


def by_order(df):
    return [r for r in df.orderBy("i").collect()]


def test_salary(spark):
    cases = {
        "Salaire 300 000 à 450 000 FCFA par mois": (300000, 450000, "XOF", "monthly", 1.0),
        "Rémunération 1 200 000 FCFA par an.": (100000, 100000, "XOF", "monthly", 1.0),
        "500 USD par jour": (6_600_000_000, 6_600_000_000, "XOF", "monthly", 0.8),
        "2000 EUR par mois": (1311914, 1311914, "XOF", "monthly", 1.0),
        "salaire de 850": (850000, 850000, "XOF", "monthly", 1.0),
        "entre 200 000 et 150 000 FCFA": (150000, 150000, "XOF", "monthly", 1.0),
        "15000 FCFA/jour": (330000, 330000, "XOF", "monthly", 1.0),
        "300 000 - 450 000 FCFA": (300000, 450000, "XOF", "monthly", 1.0),
        "12345678901234567890123 FCFA": (None, None, "XOF", "monthly", 0.4),
        "Développeur Python": (None, None, "EUR", "monthly", 0.4),
        "": (None, None, None, None, 0.0),
    }
    rows = by_order(salary.with_salary(texts(spark, cases), "t"))
    for row, expected in zip(rows, cases.values()):
        found = row["salary_info"]
        assert (found.min_salary, found.max_salary, found.currency, found.period, found.confidence) == expected, row["t"]


def test_salary_scan_is_linear_on_digit_runs(spark):
    row = by_order(salary.with_salary(texts(spark, ["1 " * 200_000]), "t"))[0]
    assert row["salary_info"].min_salary is None


def test_contract(spark):
    cases = {
        "alternance": ("Stage", None), "temporary contract": ("CDD", None), "Comptable": ("CDI", None),
        "formation internationale": ("Stage", None), "CDD 6 mois": ("CDD", 6), "2 ans": ("CDI", 24),
        "40 membres": ("CDI", 40), "mission d'expert": ("Freelance", None),
    }
    df = texts(spark, cases).withColumn("c", contract.extract_contract_info(F.col("t")))
    for row, expected in zip(by_order(df), cases.values()):
        assert (row["c"].contract_type, row["c"].duration_months) == expected, row["t"]


def test_contract_salaries(spark):
    rows = spark.createDataFrame(
        [("CDI", 300000, None), ("Stage", 400000, 500000), ("X", 1, 1), ("CDI", None, 200000), ("CDI", 0, 0)],
        "k string, a bigint, b bigint")
    found = rows.select(
        contract.recommend_contracts(F.col("a"), F.col("b")).alias("r"),
        contract.validate_contract_salary(F.col("k"), F.col("a"), F.col("b")).alias("v")).collect()
    assert [r.r for r in found] == [["CDI", "CDD", "Stage"], ["CDI", "CDD", "Freelance"], ["Stage"],
                                    ["Stage", "Intérim", "Contrat Pro"], []]
    assert [r.v for r in found] == [True, False, True, False, True]


def test_semantics(spark):
    cases = {
        "5 ans d'expérience": (5, 0.0), "35 ans d'expérience": (None, 0.0), "3 animateurs": (3, 0.0),
        "poste urgent risque stress": (None, -1.0), "bon, solide": (None, 1.0), "": (None, None),
    }
    rows = by_order(semantics.analyze_offer_text(texts(spark, cases), "t"))
    for row, expected in zip(rows, cases.values()):
        assert (row["nlp"].experience_years, row["nlp"].sentiment_score) == expected, row["t"]


def test_labels_take_the_first_declared_on_ties(spark):
    row = by_order(texts(spark, ["commercial marketing vente"]).withColumn("s", semantics.sector(F.col("t"))))[0]
    assert row.s == "Sales"
    row = by_order(texts(spark, ["lead"]).withColumn("s", semantics.job_level(F.col("t"))))[0]
    assert row.s == "Senior"


def test_skills(spark):
    cases = {
        "Python, SQL et Docker": [("Python", 2.0), ("Sql", 1.619), ("Docker", 1.286)],
        "c++ c# next.js neo4j": [("C++", 2.0), ("C#", 1.8), ("Next.Js", 1.65), ("Neo4J", 1.25)],
        "adaptability, r, presentation skills": [],
        "  ": [],
    }
    rows = by_order(skills.with_skills(texts(spark, cases), "t", scores="s"))
    for row, expected in zip(rows, cases.values()):
        assert [(s.skill, round(s.score, 3)) for s in row.s] == expected


def test_skill_categories(spark):
    found = spark.range(1).select(skills.categorize_skills(F.lit(
        ["Python", "React Native", "Leadership", "Anglais Courant", "Pmp", "Big Data"])).alias("k")).first().k
    assert found == {"technical": ["Python", "React Native"], "soft_skills": ["Leadership"],
                     "languages": ["Anglais Courant"], "certifications": ["Pmp"], "other": ["Big Data"]}


def test_dates(spark):
    cases = {
        "2025-01-02": datetime(2025, 1, 2), "il y a 3 jours": datetime(2025, 7, 1, 3),
        "il y a 30 jours": datetime(2025, 6, 1, 10), "hier": datetime(2025, 6, 30, 10),
        "hier 1430": datetime(2025, 7, 1, 14, 30), "30. août, 12:19": datetime(2025, 8, 30), "x": None,
    }
    df = texts(spark, cases).withColumn("d", dates.parse_posted_fr(F.col("t"), AS_OF))
    assert [r.d for r in by_order(df)] == list(cases.values())
    cases = {
        "depuis 18 minutes": datetime(2025, 7, 1, 9, 42), "08 juin 2025": datetime(2025, 6, 23, 10),
        "08 mai 2025": datetime(2025, 5, 8), "Aujourd'hui": datetime(2025, 7, 1, 10), "31 mai": None,
    }
    df = texts(spark, cases).withColumn("d", dates.parse_relative_fr(F.col("t"), AS_OF))
    assert [r.d for r in by_order(df)] == list(cases.values())
    df = texts(spark, ["2025-1-2", " 2025-01-02 ", "02/01/2025", "2025-13-01"])
    found = by_order(df.withColumn("d", dates.parse_iso_date(F.col("t"))))
    assert [r.d for r in found] == [date(2025, 1, 2), date(2025, 1, 2), None, None]


def test_cleaning(spark):
    one = spark.range(1)

    def value(c):
        return one.select(c.alias("v")).first().v

    assert value(tx.strip(F.lit(" \n a b \t"))) == "a b"
    assert value(tx.first_text(F.lit([" a ", "b"]))) == "a"
    assert value(tx.first_text(F.array().cast("array<string>"))) is None
    assert value(tx.first_number(F.lit("prix: 1 250.5 F"))) == 1250.5
    assert value(tx.digits_to_int(F.lit("12 postes, 3"))) == 123
    assert value(tx.digits_to_int(F.lit("aucun"))) is None
    assert value(tx.clean_label(F.lit("  Région : Dakar &\n Thiès (été) "))) == "Région  Dakar & Thiès été"
    assert value(tx.strip_colon(F.lit(" Contrat : \n CDI "))) == "Contrat CDI"
    assert value(tx.labels_to_json(F.lit([" é\"a ", "", "b"]))) == '["é\\"a", "b"]'
    assert value(tx.company_from_title(F.lit("Acme SN RECRUTE un chef"))) == "Acme SN"
    assert value(tx.company_from_title(F.lit("Porte-avions recrute"))) is None
    assert value(tx.model_text(F.lit(None).cast("string"), F.lit(None).cast("string"), "vide")) == "vide"


@pytest.mark.parametrize("values, expected", [
    ([1, 3, 10], 3.0), ([1, 2], 1.5), ([5] * 1000 + [7], 5.0), ([], None), ([0, 10**15], 5e14),
])
def test_exact_median(spark, values, expected):
    df = spark.createDataFrame([(v,) for v in values], "v bigint")
    assert exact_median(df, F.col("v"), "m").first().m == expected
