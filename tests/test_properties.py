"""Whole-table properties and brute-force comparisons on small tables."""

import math
import random
import re
import statistics
import unicodedata

from pyspark.sql import functions as F

from offerflow import rules, schemas
from offerflow.functions import skill_index, skills
from offerflow.operators import consolidate, enrich, impute, states, stats, upsert
from offerflow.operators.key_phrases import corpus_phrases, key_phrases
from offerflow.operators.keyed import exact_median, first_per_key, left_join_many
from offerflow.sources import pages, site_rules, tables

AS_OF = "2025-07-01 10:00:00"


def test_exact_median_of_both_signs(spark):
    for values in ([-5, -1, 3, 10, 20], [-(1 << 63), (1 << 63) - 1, 0], [7], [10**17 + i for i in range(1000)]):
        df = spark.createDataFrame([(v,) for v in values], "v bigint")
        assert exact_median(df, F.col("v"), "m").first().m == statistics.median(values)
    assert exact_median(spark.range(0), F.col("id"), "m").first().m is None


def test_exact_median_of_skewed_values(spark):
    rng = random.Random(7)
    values = [rng.choice([0, 1, 4095, 4096, 10**6, rng.randrange(10**12)]) for _ in range(999)] + [4096] * 500
    df = spark.createDataFrame([(v,) for v in values], "v bigint").repartition(4)
    assert exact_median(df, F.col("v"), "m").first().m == statistics.median(values)


def test_left_join_many_equals_left_join(spark):
    left = spark.createDataFrame([(None, 0), ("a", 1), ("b", 2), ("c", 3)], "k string, l int")
    right = spark.createDataFrame([("a", i) for i in range(50)] + [("b", 99), (None, 5)], "k string, r int")
    expected = sorted(map(str, left.join(right, "k", "left").collect()))
    assert sorted(map(str, left_join_many(left, right, "k").collect())) == expected


def test_first_per_key_keeps_one_row(spark):
    rows = spark.range(3000).select((F.col("id") % 3).alias("k"), (-F.col("id")).alias("o"), "id")
    found = first_per_key(rows, ["k"], [F.col("o")]).collect()
    assert sorted((r.k, r.id) for r in found) == [(0, 2997), (1, 2998), (2, 2999)]


def test_stratified_split_sizes(spark):
    rows = spark.range(1003).select("id", F.when(F.col("id") < 700, "hot").when(F.col("id") < 1000, "mid")
                                    .otherwise("rare").alias("label"))
    split = impute.stratified_split(rows, "label", "id")
    assert split.count() == 1003
    counts = {r.label: r.n for r in split.where("is_validation").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert sum(counts.values()) == 201
    assert counts["hot"] in (140, 141) and counts["mid"] in (60, 61)
    again = impute.stratified_split(rows.repartition(3), "label", "id").where("is_validation")
    assert sorted(r.id for r in again.collect()) == sorted(r.id for r in split.where("is_validation").collect())


def test_url_upsert_equals_one_by_one(spark):
    schema = "url string, id string, title string, source string"
    target = [("u1", "i1", "old", "s0")]
    batch = [(0, "u1", "x", "new1", "s1"), (1, "u2", "i2", "a", "s2"), (2, "u2", "i9", "b", "s3"),
             (3, "u1", "y", "new2", "s4"), (4, "u3", "i3", None, "s5")]
    state = {r[0]: list(r) for r in target}
    for _, url, key, title, source in batch:
        if url in state:
            state[url][2] = title
        else:
            state[url] = [url, key, title, source]
    found = upsert.upsert_by_url(
        spark.createDataFrame(target, schema), spark.createDataFrame(batch, "n int, " + schema), [F.col("n")])
    assert sorted(map(list, found.collect())) == sorted(state.values())


def test_consolidation_is_idempotent(spark):
    raw = {name: schemas.conform(spark.range(5).select(
        F.col("id").cast("string").alias("id"), F.lit("t").alias("title")), schema)
        for name, schema in schemas.RAW_SCHEMAS.items()}
    first = consolidate.consolidate(raw, None, AS_OF)
    assert first.count() == 25
    assert first.select("id").distinct().count() == 25
    assert consolidate.consolidate(raw, first, AS_OF).count() == 0


def test_salary_and_confidence_ranges(spark):
    rows = spark.createDataFrame(
        [(str(i), f"offre {i}", f"{i * 37} - {i * 53} FCFA par heure, python") for i in range(200)],
        "id string, title string, description string").withColumn("contract_type", F.lit(None).cast("string"))
    found = enrich.enrich_offers(rows, AS_OF).collect()
    assert len(found) == 200
    for r in found:
        assert 0 <= r.confidence_score <= 1
        if r.extracted_salary_min is not None:
            assert r.extracted_salary_min <= r.extracted_salary_max and r.extracted_salary_currency == "XOF"
        assert "Python" in r.extracted_skills


def _brute_skills(text):
    """Python's own regex engine over the same rules."""
    norm = re.sub("[ ​    ]", " ", unicodedata.normalize("NFKD", text)).lower()

    def pattern(term):
        return re.compile(r"(?<![a-zA-Z0-9])" + re.escape(term).replace(r"\ ", r"[\s\-]+") + r"(?![a-zA-Z0-9])", re.I)

    found = {t.title() for ts in (*rules.TECHNICAL_SKILLS.values(), rules.SOFT_SKILLS) for t in ts
             if pattern(t).search(norm)}
    found |= {m.group(0).title() for p in rules.NAMED_SKILL_PATTERNS.values()
              for m in re.finditer(rf"\b{p}\b", norm, re.I)}
    found |= {label for label, ts in rules.CONTEXT_SKILLS.items() if any(pattern(t).search(norm) for t in ts)}
    kept = [s for s in found if 2 <= len(s) <= 60 and not any(g in s.lower() for g in rules.GENERIC_SKILL_TERMS)]
    scored = []
    for skill in kept:
        hits = list(pattern(skill.lower()).finditer(norm))
        scored.append((skill, len(hits) + 1.0 - hits[0].start() / len(norm) if hits else 0.1))
    return sorted(scored, key=lambda x: (-x[1], x[0]))[:50]


def test_skills_equal_brute_force(spark):
    rng = random.Random(11)
    words = [t for ts in rules.TECHNICAL_SKILLS.values() for t in ts] + list(rules.SOFT_SKILLS) + [
        t for ts in rules.CONTEXT_SKILLS.values() for t in ts] + [
        "AWS  Certified", "Anglais courant", "français avancé", "Anglais avancé", "ISO 9001", "Six-Sigma", "six sigma",
        "é", "œuvre", "ﬁgma", "Ｐython", "pythoné", "épython", "😀", "machine-learning", "rest api", "a_sql_b"]
    texts = [rng.choice([" ", ", ", "\n", "/"]).join(rng.choices(words, k=rng.randrange(1, 25))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    for row in skills.with_skills(df, "t", scores="s").collect():
        expected = _brute_skills(row.t)
        assert [s.skill for s in row.s] == [s for s, _ in expected], row.t
        assert all(abs(s.score - e) < 1e-9 for s, (_, e) in zip(row.s, expected)), row.t


# The separate patterns of currencies and periods.
CURRENCIES = {
    "XOF": (r"[\d\s]+\s*(FCFA|CFA|XOF|Francs? CFA|F CFA)", r"[\d\s]+\s*(francs?|f|F)\s*(CFA|cfa)", r"CFA\s*[\d\s,]+",
            r"XOF\s*[\d\s,]+"),
    "EUR": (r"[\d\s]+\s*(€|EUR|euros?)", r"€\s*[\d\s,]+", r"EUR\s*[\d\s,]+"),
    "USD": (r"[\d\s]+\s*(\$|USD|dollars?)", r"\$\s*[\d\s,]+", r"USD\s*[\d\s,]+"),
    "GBP": (r"[\d\s]+\s*(£|GBP|livres?)", r"£\s*[\d\s,]+", r"GBP\s*[\d\s,]+"),
}
PERIODS = {
    "monthly": (r"(?:par|/|par\s+)mois", r"mensuel|mensuelle", r"monthly", r"/mois|par mois"),
    "yearly": (r"(?:par|/|par\s+)an(?:née)?|(?:par|/|par\s+)ans", r"annuel|annuelle", r"yearly|annual", r"/an|par an"),
    "hourly": (r"(?:par|/|par\s+)heure", r"horaire", r"hourly", r"/h|/heure|par heure"),
    "daily": (r"(?:par|/|par\s+)jour(?:née)?", r"journalier|quotidien", r"daily", r"/jour|par jour"),
}


def test_merged_patterns_accept_what_the_separate_ones_do():
    rng = random.Random(3)
    pieces = ["1", "20", " ", "  ", ",", "f", "F", "franc", "francs", "CFA", "cfa", "fcfa", "XOF", "€", "eur", "euros", "$", "usd",
              "dollar", "£", "gbp", "livres", "par", "/", "mois", "an", "année", "ans", "heure", "h", "jour", "journée", "mensuel",
              "annuel", "annual", "horaire", "hourly", "quotidien", "daily", "x", ".", "\t"]
    for _ in range(20000):
        text = "".join(rng.choices(pieces, k=rng.randrange(1, 6)))
        for separate, merged in ((CURRENCIES, rules.CURRENCY_PATTERNS), (PERIODS, rules.PERIOD_PATTERNS)):
            for name, patterns in separate.items():
                assert any(re.search(p, text, re.I) for p in patterns) == bool(re.search(merged[name], text, re.I)), (name, text)


def test_matching_a_referential_table(spark):
    offers = spark.createDataFrame([(1, "python and c++, machine  learning"), (2, "pythonic")], "id int, t string")
    found = skills.match_skills(offers, "id", "t", tables.default_referential(spark)).collect()
    assert sorted((r.id, r.skill) for r in found) == [(1, "c++"), (1, "machine learning"), (1, "python")]


def test_key_phrases_are_ranked_and_bounded(spark):
    df = spark.createDataFrame([(1, "chef de projet digital, projet digital et projet. " * 3),
                                (2, " ".join(f"mot{i}, " for i in range(40))), (3, "le la les")], "id int, t string")
    found = {r.id: r.key_phrases for r in key_phrases(df, "id", "t").collect()}
    assert found[1][0] == "projet digital" and len(found[2]) == 10 and 3 not in found


def test_backlog_is_disjoint_and_ordered(spark):
    offers = spark.range(30).select(
        F.col("id").cast("string").alias("id"), F.repeat(F.lit("x"), 60).alias("description"),
        F.when(F.col("id") % 5 > 0, F.date_sub(F.lit("2025-07-01").cast("date"), F.col("id").cast("int"))).alias("posted_date"))
    done = spark.createDataFrame([("1",), (None,), ("2",)], "offre_id string")
    found = enrich.backlog(offers, done, limit=10).collect()
    assert [r.id for r in found[:6]] == ["0", "10", "15", "20", "25", "5"]
    assert len(found) == 10 and not {"1", "2"} & {r.id for r in found}


def _imputable(spark):
    rows = [(f"{i}", "Développeur Python" if i % 2 else "Comptable audit", "x" * 60, "IT/Tech" if i % 2 else "Finance",
             "CDI" if i % 2 else "CDD", "Senior" if i % 2 else "Junior", "Full-time" if i % 2 else "Contract",
             ["Python"], 100000, 200000) for i in range(80)]
    rows += [(f"n{i}", "Développeur Python 5000 FCFA" if i % 2 else "Comptable audit", "y" * 60, None, None, None, None,
              None, None, None) for i in range(10)]
    return spark.createDataFrame(rows, "id string, title string, description string, extracted_sector string, "
                                 "extracted_contract_type string, job_level string, job_type string, "
                                 "extracted_skills array<string>, extracted_salary_min bigint, extracted_salary_max bigint")


def test_full_imputation_fills_only_nulls(spark):
    df = _imputable(spark)
    config = impute.ImputeConfig(max_iter=5, features=1 << 10)
    filled, report = impute.run_full_imputation(df, "id", config)
    rows = {r.id: r for r in filled.collect()}
    assert len(rows) == 90
    assert rows["1"].extracted_skills == ["Python"] and rows["1"].extracted_salary_min == 100000
    assert rows["n1"].extracted_sector == "IT/Tech" and rows["n0"].extracted_sector == "Finance"
    assert rows["n1"].extracted_skills == ["Python"] and rows["n1"].extracted_salary_min == 5000
    assert rows["n0"].extracted_skills is None
    assert {r.column: r.improvement for r in report.collect()}["extracted_sector"] == 10
    models = impute.train_columns(df.where("extracted_sector IS NOT NULL"), rules.ML_TARGETS, "id", config)
    assert set(models) == set(rules.ML_TARGETS) and models["job_type"].metrics == {"accuracy": 1.0, "f1": 1.0}


def test_train_predict_jobs(spark, tmp_path):
    df = _imputable(spark)
    offers = df.select("id", "title", "description", F.lit("c").alias("company_name"), F.lit("l").alias("location"),
                       F.lit(None).cast("date").alias("posted_date"),
                       F.lit(AS_OF).cast("timestamp_ntz").alias("created_at"))
    enriched = schemas.conform(df.where("extracted_sector IS NOT NULL").select(
        F.concat(F.lit("e"), "id").alias("id"), F.col("id").alias("offre_id"), *rules.TARGET_COLUMNS), schemas.ENRICHED)
    config = impute.ImputeConfig(models_dir=str(tmp_path), max_iter=5, features=1 << 10)
    assert impute.read_imputer(spark, f"{tmp_path}/job_type") is None
    after = impute.full_job(offers, enriched, config, AS_OF)
    rows = {r.offre_id: r for r in after.collect()}
    assert len(rows) == 90
    assert rows["n1"].extracted_sector == "IT/Tech" and rows["n1"].processing_version == "1.0"
    assert rows["n1"].extracted_salary_min == 5000 and rows["2"].extracted_sector == "Finance"
    few = impute.ImputeConfig(models_dir=str(tmp_path), min_complete_rows=1000)
    assert impute.full_job(offers, enriched, few, AS_OF) is None


def test_completeness_of_the_built_in_fixture(spark):
    df = _imputable(spark).drop("extracted_salary_min", "extracted_salary_max")
    rows = stats.completeness(df).collect()
    assert {r.column for r in rows} == set(rules.TARGET_COLUMNS[:5])
    assert {(r.non_null, r.completeness, r.complete_rows, r.incomplete_rows) for r in rows} == {(80, 88.89, 80, 10)}


def test_statistics_of_empty_tables(spark):
    offers = schemas.conform(spark.range(0), schemas.OFFERS)
    enriched = schemas.conform(spark.range(0), schemas.ENRICHED)
    assert stats.salary_summary(offers, enriched, AS_OF).collect()[0].median_salary is None
    assert stats.avg_salary_range(enriched).first().avg_min_salary == 0.0
    assert stats.totals(offers, enriched, AS_OF).first().total_offers == 0


def test_json_array_and_wrong_extension(spark, tmp_path):
    (tmp_path / "offers.json").write_text('[{"id": "1", "title": "a"}, {"id": "2"}]', encoding="utf-8")
    schema = schemas._schema("id title")
    assert tables.read_offers(spark, str(tmp_path / "offers.json"), schema, multi_line=True).count() == 2
    try:
        tables.read_offers(spark, "offers.xls", schema)
    except ValueError:
        return
    raise AssertionError("unknown formats must be refused")


def test_referential_keeps_missing_parts(spark, tmp_path):
    (tmp_path / "ref.json").write_text('{"technical_skills": {"Langages": ["Cobol"]}}', encoding="utf-8")
    referential = tables.read_skill_referential(spark, str(tmp_path / "ref.json"))
    assert referential.where("kind = 'technical'").select("skill", "category").collect() == [("cobol", "Langages")]
    assert referential.where("kind = 'soft'").count() == len(rules.SOFT_SKILLS)
    df = spark.createDataFrame([(1, "cobol, python, leadership")], "id int, t string")
    found = skills.match_skills(df, "id", "t", referential).collect()
    assert sorted(r.skill for r in found) == ["cobol", "leadership"]


def test_terms_without_a_leading_letter(spark):
    df = spark.createDataFrame([(1, "expert .net et python"), (2, "a.net"), (3, "++ ok"), (4, "")], "id int, t string")
    rows = skills.with_skills(df, "t", "s", technical={"odd": [".net", "++"]}, soft=[]).collect()
    assert [[s for s in r.s if s != "Python"] for r in rows] == [[".Net"], [], ["++"], []]


def test_upsert_keeps_rows_without_a_url(spark):
    schema = "url string, id string, title string"
    target = spark.createDataFrame([("u1", "i1", "old"), (None, "i0", "t0")], schema)
    batch = spark.createDataFrame([(0, None, "i2", "a"), (1, None, "i2", "a"), (2, "u1", "x", "new")], "n int, " + schema)
    found = upsert.upsert_by_url(target, batch, [F.col("n")]).collect()
    assert sorted(map(repr, map(tuple, found))) == sorted(map(repr, [
        ("u1", "i1", "new"), (None, "i0", "t0"), (None, "i2", "a"), (None, "i2", "a")]))


def test_predictions_are_applied_in_order(spark):
    enriched = schemas.conform(spark.createDataFrame([("e", "1")], "id string, offre_id string"), schemas.ENRICHED)
    rows = [(1, "1", "Zeta", None), (2, "1", "Beta", "Junior"), (3, "1", None, None)]
    predicted = spark.createDataFrame(rows, "n int, id string, extracted_sector string, job_level string")
    row = upsert.patch_enrichment(enriched, predicted, AS_OF, [F.col("n")]).first()
    assert (row.extracted_sector, row.job_level) == ("Beta", "Junior")


def test_filling_repeats_no_row(spark):
    df = spark.createDataFrame([("1", None), ("1", "x"), ("2", None)], "id string, job_type string")
    found = impute.fill_missing(df, df.select("id", F.lit("new").alias("job_type")), "id").collect()
    assert sorted(map(tuple, found)) == [("1", "new"), ("1", "x"), ("2", "new")]


def test_tables_are_created_once(spark, tmp_path):
    for _ in range(2):
        assert schemas.ensure_table(spark, "job_statistics", str(tmp_path / "stats")).count() == 0
    assert set(schemas.table_schemas()) >= set(rules.SOURCE_TAGS) | {"offers", "offers_enriched"}


def test_pages_with_traps(spark):
    html = ('<h1 class="entry-title">A &amp; B</h1><!-- <h1>no</h1> --><script>var t="</p><a href=x>";</script>'
            '<span class="meta-category"><a>x</a><a> y </a></span><span class="updated">hier</span>'
            '<div class="entry-content"><p>un<p>deux<ul><li>trois<li>quatre</ul></div>')
    df = spark.createDataFrame([(1, "https://e.org/p", html), (2, "https://e.org/q", None)], "page_id long, url string, html string")
    rows = {r.url: r for r in pages.extract_offers_from_pages(df, "concoursn_stages", AS_OF).collect()}
    row = rows["https://e.org/p"]
    assert row.title == "A & B" and row.categories == '["x", "y"]' and row.tags == "[]"
    assert row.description == "un\ndeux\ntrois\nquatre"
    assert str(row.posted_date) == "2025-06-30 10:00:00"
    assert rows["https://e.org/q"].title is None


def test_numbered_listing_stops_at_its_last_page(spark):
    def page(number):
        return f'<table id="offresenjobs"></table><div class="resultsOffre activepage"><span>{number}</span></div>'

    df = spark.createDataFrame([(n, "https://e.org/sn/x.php", page(n)) for n in (1, 8, 9, 25)],
                               "page_id long, url string, html string")
    listing = site_rules.LISTING_RULES["senjobs"]

    def numbers(rules):
        links = pages.extract_listing_links(df, rules).collect()
        return sorted((r.page_id, r.link.rsplit("=", 1)[1]) for r in links)

    assert numbers(listing) == [(1, "2"), (8, "9"), (9, "10"), (25, "26")]
    assert numbers(listing | {"last_page": 9}) == [(1, "2"), (8, "9")]


def test_terms_of_any_shape_equal_their_regex(spark):
    rng = random.Random(7)
    terms = ["a b", "a-b", "b", "c++", "++", ".x", "a  b", " a", "b ", "-", "a b a", "é a", "x-y z", "", "a.b", "b a", "aa"]
    texts = ["".join(rng.choices(["a", "b", "c", "x", "y", "z", "+", "++", ".", "-", " ", " ", "\n", "  ", " - ", "é", "1"], k=rng.randrange(0, 30)))
             for _ in range(400)] + ["a b a b a", "a" * 50, "a b " * 3000, "c++ c++c++ c+++", "+++"]
    index = skill_index.TermIndex(terms)
    for text in texts:
        found = index.hits(skill_index.Text(text))
        for term in terms:
            hits = [m.start() for m in re.finditer(skills.skill_pattern(term).replace(r"[\s\-]+", skill_index.GAP), text)]
            assert found.get(term) == ((len(hits), hits[0]) if hits else None), (term, text)
            assert skill_index.Text(text).measure(term) == found.get(term)


def test_referentials_of_any_size_match_alike(spark):
    rng = random.Random(8)
    words = ["java", "spring boot", "c++", "ci/cd", "node.js", "scikit-learn", "r", ".net", "Go", "sql"]
    offers = spark.createDataFrame([(i, rng.choice([" ", ", ", " - "]).join(rng.choices(words + ["golang", "sqlite"], k=5))) for i in range(60)]
                                   + [(60, None), (61, "")], "id int, t string")
    terms = spark.createDataFrame([(w, f"k{i % 3}", "technical") for i, w in enumerate(words)] + [("java", "twice", "soft"), (None, "k", "soft")],
                                  "skill string, category string, kind string")
    one, other = (sorted(map(tuple, skills.match_skills(offers, "id", "t", terms, most).collect())) for most in (100, 3))
    assert one == other and len(one) > 200
    many = spark.createDataFrame([(f"term {i}", "c", "technical") for i in range(5000)] + [("sql", "c", "technical")], terms.schema)
    found = skills.match_skills(offers, "id", "t", many).collect()
    assert sorted({r.id for r in found}) == sorted({i for i, s, *_ in one if s == "sql"})
    assert skills.match_skills(offers, "id", "t", terms.limit(0)).collect() == []


def test_states_of_days_add_up(spark, tmp_path):
    offers = spark.createDataFrame([(str(i), f"c{i % 7}", "l", "CDI" if i % 3 else "CDD", f"2025-06-{1 + i % 4:02d}") for i in range(40)] + [("x", "c", "l", "CDI", None)],
                                   "id string, company_name string, location string, contract_type string, d string").withColumn("posted_date", F.col("d").cast("date"))
    enriched = spark.createDataFrame([(str(i), 100 * i, 100 * i + 50, "IT") for i in range(0, 40, 2)],
                                     "offre_id string, extracted_salary_min long, extracted_salary_max long, extracted_sector string")
    for batch in (0, 1, 1):  # the second batch is repeated
        states.append_states(offers.where(F.col("id").try_cast("int") % 2 == batch), enriched, str(tmp_path / "s"), batch)
    found = states.overview_of_states(spark, str(tmp_path / "s"), F.lit("all"), F.col("day") >= "2025-06-02").collect()
    kept = [i for i in range(40) if i % 4]
    paid = [100 * i for i in kept if i % 2 == 0]
    assert len(found) == 1 and found[0].total_offers == len(kept)
    assert found[0].avg_salary_min == sum(paid) / len(paid) and found[0].avg_salary_max == sum(paid) / len(paid) + 50
    assert (found[0].companies, found[0].locations, found[0].most_common_contract, found[0].most_common_sector) == (7, 1, "CDI", "IT")
    assert min(paid) <= found[0].median_salary <= max(paid) + 50


def test_a_phrase_inside_longer_ones_counts_for_itself_only(spark):
    offers = spark.createDataFrame([(t,) for t in ["big data platform"] * 3 + ["big data", "data", None, ""]], "t string")
    found = {r.phrase: (r.n, r.longer, r.value) for r in corpus_phrases(offers, "t").collect()}
    assert found["big data platform"] == (3, 0, 6.0)
    assert found["big data"] == (4, 1, round(math.log2(3) * 1, 6))
    assert found["data"] == (5, 2, round(5 - (3 + 4) / 2, 6))
    assert corpus_phrases(offers.limit(0), "t").collect() == []
