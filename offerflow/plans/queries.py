"""The registered queries: every operator over whole derived tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from offerflow import rules, schemas, workdir
from offerflow.functions import contract, dates, salary, semantics, skills
from offerflow.functions import text as tx
from offerflow.operators import consolidate, enrich, impute, report, states, stats, upsert
from offerflow.operators.key_phrases import corpus_phrases, key_phrases
from offerflow.operators.keyed import exact_median, first_per_key
from offerflow.operators.versions import BucketedTable
from offerflow.plans import fixture as fx
from offerflow.sources import pages as pg
from offerflow.sources import site_rules, tables
from offerflow.streaming import jobs as streaming

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _day(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def _time(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


def _list(c: Column | str) -> Column:
    return F.array_join(c, "|")


def _texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every offer with its whole text."""
    return fx.offers(spark, sf_dir).select("*", tx.offer_text(F.col("title"), F.col("description")).alias("txt"))


def _exploded(rows: DataFrame, column: str) -> DataFrame:
    """Drop the empty rows of an outer explode.

    A plain explode makes the optimizer test the array's size below the scan side, with the
    whole extraction copied into that filter; the outer form computes it once.
    """
    return rows.where(F.col(column).isNotNull())


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its text as a list of lines."""
    return fx.table(spark, sf_dir, "documents").withColumn("lines", F.split("text", "\n"))


# ----------------------------------------------------------- consolidation
def _known(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.labelled(spark, sf_dir, fx.offers(spark, sf_dir))


@query
def consolidate_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = consolidate.consolidate(fx.raw_sources(spark, sf_dir), _known(spark, sf_dir), fx.AS_OF)
    return rows.select(
        "id", "spider_source", "original_id", "title", "url", "location", "company_name", _day("posted_date"),
        "source", F.md5("description").alias("description"), "contract_type", "salary", "category", "sector",
        "experience_level", "education_level", F.col("nb_positions").cast("bigint"), _day("expiration_date"),
        _time("created_at").alias("created_at"))


@query
def consolidation_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return consolidate.consolidation_rejects(fx.raw_sources(spark, sf_dir))


@query
def requires_posted_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept, rejected = consolidate.requires_posted_date(fx.raw_sources(spark, sf_dir)["emplois"])
    return kept.select("id", F.lit("kept").alias("outcome")).unionByName(
        rejected.select("id", F.lit("rejected").alias("outcome")))


@query
def new_record_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.new_record_count(fx.offers(spark, sf_dir), fx.AS_OF)


@query
def consolidation_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.consolidation_stats(fx.offers(spark, sf_dir), fx.AS_OF)


@query
def dedup_by_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies of a document share the URL made from their text."""
    items = fx.table(spark, sf_dir, "documents").withColumn("url", F.concat(F.lit("https://d.example.org/"), F.md5("text")))
    return consolidate.dedup_by_url(items, [F.col("doc_id")]).select("id", "url", "doc_id", "lang", "source")


# ---------------------------------------------------------------- cleaning
@query
def clean_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, text = F.col("lines"), F.col("text")
    return _lines(spark, sf_dir).select(
        "doc_id",
        tx.first_text(lines).alias("first_line"),
        F.md5(tx.first_raw(lines)).alias("first_raw"),
        F.md5(tx.scalar_text(text)).alias("scalar"),
        F.md5(tx.join_fragments(lines, "\n")).alias("joined_lines"),
        F.md5(tx.join_fragments(lines, ", ")).alias("joined_commas"),
        F.md5(tx.clean_label(text)).alias("label"),
        F.md5(tx.collapse_ws(text)).alias("collapsed"),
        F.md5(tx.strip_colon(F.concat(F.lit(" Note : "), text))).alias("without_colon"),
        tx.url_id(F.concat_ws("/", F.lit("https://d.example.org"), "doc_id")).alias("url_id"),
        F.md5(tx.truncate_text(text)).alias("short"))


@query
def labels_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir).select("doc_id", F.md5(tx.labels_to_json(F.col("lines"))).alias("labels"))


@query
def number_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.col("text")
    return fx.table(spark, sf_dir, "documents").select(
        "doc_id", tx.digits_to_int(text).alias("all_digits"), tx.first_number(text).alias("first_number"),
        tx.first_digits(text).alias("first_digits"))


@query
def pick_fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dates, salaries and numbered fragments among the lines of an offer page."""
    postings = fx.postings(spark, sf_dir)
    cells = F.concat(
        F.array(F.lit("  "), F.concat(F.lit(" "), F.col("posted_date").cast("string"), F.lit(" (publiée)"))),
        F.array(F.concat(F.col("n_chars").cast("string"), F.lit(" / Mois "))), F.split("text", "\n"))
    pairs = F.array(
        F.struct(F.lit("Secteur d'activité :").alias("dt"), F.col("lang").alias("dd")),
        F.struct(F.lit("Type de contrat :").alias("dt"), F.col("contract_type").alias("dd")),
        F.struct(F.lit("Employeur").alias("dt"), F.col("company_name").alias("dd")))
    rows = postings.select("doc_id", F.filter(cells, lambda c: c.isNotNull()).alias("cells"), pairs.alias("pairs"))
    return rows.select(
        "doc_id", tx.iso_date_fragment(F.col("cells")).alias("posted"),
        F.md5(tx.salary_fragment(F.col("cells"))).alias("salary"),
        F.md5(tx.nth_fragment(F.col("cells"), 1)).alias("second"),
        tx.property_value(F.col("pairs"), "Secteur d'activité").alias("sector"),
        tx.property_value(F.col("pairs"), "Type de contrat").alias("contract"),
        tx.property_value(F.col("pairs"), "Nombre de postes").alias("positions"))


@query
def company_from_title(spark: SparkSession, sf_dir: str) -> DataFrame:
    verb = F.expr("CASE site WHEN 0 THEN ' recrute ' WHEN 1 THEN '  RECHERCHE ' WHEN 2 THEN ' - recrutement ' "
                  "WHEN 3 THEN ' embauche ' ELSE ' recrutement ' END")
    return fx.postings(spark, sf_dir).select(
        "doc_id", F.md5(tx.company_from_title(F.concat(
            F.coalesce("company_name", F.lit("")), verb, "text"))).alias("company"),
        tx.company_from_title(F.col("title")).alias("from_title"))


@query
def resolve_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    hrefs = ("/a/b.html", "?page=2", "#top", "c/d", "https://o.example.org/z", "//cdn.example.org/i.png", " ")
    rows = fx.table(spark, sf_dir, "pages").select(
        "page_id", "url", F.explode(F.array(*[F.lit(h) for h in hrefs])).alias("href"))
    return rows.select("page_id", "href", tx.resolve_url(F.col("url"), F.col("href")).alias("link"),
                       tx.is_detail_link(F.col("href")).alias("is_detail"))


@query
def parse_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posting dates in the forms found on the sites, from the numbers of every document."""
    rows = fx.postings(spark, sf_dir).select("doc_id", F.expr("""
        CASE doc_id % 9 WHEN 0 THEN CAST(posted_date AS STRING) WHEN 1 THEN 'il y a ' || (n_chars % 95) || ' jours'
        WHEN 2 THEN 'vendredi ' || (n_chars % 24) || ':' || lpad(CAST(n_chars % 60 AS STRING), 2, '0')
        WHEN 3 THEN 'hier' WHEN 4 THEN (24 + n_chars % 5) || '. juil, 13' WHEN 5 THEN 'depuis ' || n_chars || ' minutes'
        WHEN 6 THEN 'il y a ' || (n_chars % 40) || ' heures'
        WHEN 7 THEN '0' || (1 + n_chars % 9) || ' Décembre 2025' ELSE 'inconnu' END""").alias("raw"))
    return rows.select(
        "doc_id", "raw", dates.parse_iso_date(F.col("raw")).cast("string").alias("iso"),
        _time(dates.parse_posted_fr(F.col("raw"), fx.AS_OF)).alias("posted"),
        _time(dates.parse_relative_fr(F.col("raw"), fx.AS_OF)).alias("relative"))


# ------------------------------------------------------- backlog and joins
@query
def backlog(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich.backlog(fx.offers(spark, sf_dir), fx.enriched(spark, sf_dir))
    return rows.select("id", "title", F.md5("description").alias("description"), "contract_type", "location",
                       "company_name", "spider_source", _day("posted_date"))


@query
def backlog_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest open offers, as many as asked for."""
    rows = enrich.backlog(fx.offers(spark, sf_dir), fx.enriched(spark, sf_dir), limit=25)
    return rows.select("id", "title", _day("posted_date"))


@query
def backlog_unlimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich.backlog(fx.offers(spark, sf_dir), fx.enriched(spark, sf_dir), limit=None)
    return rows.select("id", "spider_source", _day("posted_date"))


@query
def offers_left_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich.offers_left_enriched(fx.offers(spark, sf_dir), fx.enriched(spark, sf_dir))
    return rows.select("id", "spider_source", "extracted_sector", "extracted_salary_min", "extracted_salary_max",
                       _list("extracted_skills").alias("skills"), _time("processed_at").alias("processed_at"))


@query
def offers_with_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = enrich.read_offers_with_enrichment(fx.offers(spark, sf_dir), fx.enriched(spark, sf_dir))
    return rows.select("id", "title", F.md5("description").alias("description"), "company_name", "location",
                       _day("posted_date"), "extracted_sector", "extracted_contract_type",
                       _list("extracted_skills").alias("skills"), "extracted_salary_min", "extracted_salary_max",
                       "job_level", "job_type", "confidence_score")


@query
def latest_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = upsert.latest_enrichment(fx.enriched(spark, sf_dir).where("offre_id IS NOT NULL"))
    return rows.select("offre_id", "id", "extracted_salary_min", _time("processed_at").alias("processed_at"))


# -------------------------------------------------------------- statistics
def _both(function) -> Query:
    return lambda spark, sf_dir: function(fx.offers(spark, sf_dir), fx.enriched(spark, sf_dir), fx.AS_OF)


def _metric_rows(rows: DataFrame) -> DataFrame:
    return rows.select("metric_name", "metric_value", _day("period_start"), _day("period_end"), "category")


@query
def offers_by_sector(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric_rows(_both(stats.offers_by_sector)(spark, sf_dir))


@query
def offers_by_contract_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _metric_rows(_both(stats.offers_by_contract_type)(spark, sf_dir))


@query
def salary_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _both(stats.salary_distribution)(spark, sf_dir)
    value = F.from_json("metric_value", "avg_min_salary double, avg_max_salary double, median_salary double")
    return rows.select("metric_name", value.alias("v"), _day("period_start"), _day("period_end"), "category") \
        .select("metric_name", "period_start", "period_end", "category",
                *[F.round(F.col("v")[c], 3).alias(c) for c in ("avg_min_salary", "avg_max_salary", "median_salary")])


@query
def job_market_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _both(stats.job_market_overview)(spark, sf_dir)
    return rows.select(_day("month"), "total_offers", "unique_companies", "unique_locations",
                       F.round("avg_salary_min", 3).alias("avg_salary_min"),
                       F.round("avg_salary_max", 3).alias("avg_salary_max"),
                       "most_common_contract", "most_common_sector")


@query
def overview_of_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The market overview merged from daily states that two batches of offers have left, the second with offers of the same days;
    estimates are held against the offers themselves."""
    offers, enriched, path = fx.offers(spark, sf_dir), fx.enriched(spark, sf_dir), workdir.new_path(spark, "states")
    for batch in (0, 1):
        states.append_states(offers.where(F.col("id").cast("long") % 2 == batch), enriched, path, batch)
    since = stats.posted_since(fx.AS_OF, months=12)
    month = F.trunc("day", "month")
    merged = states.overview_of_states(spark, path, month, F.col("day") >= F.add_months(dates.day(fx.AS_OF), -12))
    exact = stats.job_market_overview(offers, enriched, fx.AS_OF).select(F.col("month").alias("period"), "unique_companies", "unique_locations")
    rows = enrich.offers_left_enriched(offers.where(since).select("id", F.trunc("posted_date", "month").alias("period")), enriched)
    middle = F.expr("(extracted_salary_min + extracted_salary_max) div 2")
    ranks = rows.join(merged.select("period", "median_salary"), "period").groupBy("period").agg(
        F.try_divide(F.count_if(middle < F.col("median_salary")), F.count(middle)).alias("below"),
        F.try_divide(F.count_if(middle <= F.col("median_salary")), F.count(middle)).alias("upto"))

    def close(estimate: str, truth: str) -> Column:
        return F.abs(F.col(estimate) - F.col(truth)) <= F.greatest(F.lit(1), 0.05 * F.col(truth))

    both = merged.join(exact, "period").join(ranks, "period", "left")
    return both.select(
        _day("period"), "total_offers", F.round("avg_salary_min", 3).alias("avg_salary_min"), F.round("avg_salary_max", 3).alias("avg_salary_max"),
        "most_common_contract", "most_common_sector", close("companies", "unique_companies").alias("companies_close"),
        close("locations", "unique_locations").alias("locations_close"),
        F.coalesce((F.col("below") <= 0.53) & (F.col("upto") >= 0.47), F.lit(True)).alias("median_close"))


@query
def exact_median_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same exact median over order prices in whole units."""
    return exact_median(fx.table(spark, sf_dir, "orders"), F.col("o_totalprice").cast("bigint"), "median_price")


@query
def exact_median_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values that share their leading digits: event times in microseconds."""
    times = F.unix_micros(F.col("ts").cast("timestamp"))
    return exact_median(fx.table(spark, sf_dir, "events"), times, "median_micros")


@query
def exact_median_signed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Values of both signs: order prices around a middle price."""
    return exact_median(fx.table(spark, sf_dir, "orders"), F.col("o_totalprice").cast("bigint") - 150000, "median_price")


@query
def totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(stats.totals)(spark, sf_dir)


@query
def avg_salary_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stats.avg_salary_range(fx.enriched(spark, sf_dir))
    return rows.select(*[F.round(c, 3).alias(c) for c in rows.columns])


@query
def top_sectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(stats.top_sectors)(spark, sf_dir)


@query
def top_skills(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _both(stats.top_skills)(spark, sf_dir)


@query
def daily_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = _both(report.daily_report)(spark, sf_dir)
    return row.select(
        "date", "summary.*", *[F.round(F.col("salary_info")[c], 3).alias(c) for c in ("avg_min_salary", "avg_max_salary")],
        F.to_json("top_sectors").alias("top_sectors"), F.to_json("top_skills").alias("top_skills"))


@query
def saved_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = report.save_daily_report(_both(report.daily_report)(spark, sf_dir), fx.AS_OF)
    return rows.select("metric_name", F.get_json_object("metric_value", "$.date").alias("date"),
                       F.get_json_object("metric_value", "$.summary.total_offers").cast("bigint").alias("total_offers"),
                       _day("period_start"), _day("period_end"), "category")


@query
def report_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.report_lines(_both(report.daily_report)(spark, sf_dir))


# ------------------------------------------------------------ completeness
def _extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.read_offers_with_enrichment(fx.offers(spark, sf_dir), fx.enriched(spark, sf_dir))


@query
def completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.completeness(_extract(spark, sf_dir))


@query
def enrichment_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.enrichment_coverage(_extract(spark, sf_dir))


@query
def split_complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    complete, incomplete = impute.split_complete(_extract(spark, sf_dir))
    return complete.select("id", "extracted_salary_min", F.lit("complete").alias("part")).unionByName(
        incomplete.select("id", "extracted_salary_min", F.lit("incomplete").alias("part")))


@query
def not_yet_enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    return impute.not_yet_enriched(_extract(spark, sf_dir)).select("id", "extracted_salary_min")


# ------------------------------------------------------------- enrichment
@query
def salary_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = salary.with_salary(_texts(spark, sf_dir).select("id", "txt"), "txt")
    return rows.select("id", "salary_info.min_salary", "salary_info.max_salary", "salary_info.currency",
                       "salary_info.period", "salary_info.confidence",
                       F.md5(F.col("salary_info")["original_text"]).alias("original_text"))


@query
def contract_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    lowered = F.lower("txt")
    return _texts(spark, sf_dir).select(
        "id", contract.contract_score(lowered).alias("scored"), contract.contract_infer(lowered).alias("inferred"),
        contract.classify_contract(F.col("txt")).alias("classified"))


@query
def contract_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _texts(spark, sf_dir).select("id", contract.extract_contract_info(F.col("txt")).alias("c"))
    return rows.select("id", "c.contract_type", "c.duration_months", "c.is_remote", "c.is_full_time",
                       F.round("c.confidence", 6).alias("confidence"))


@query
def contract_recommendation(spark: SparkSession, sf_dir: str) -> DataFrame:
    low, high = F.col("extracted_salary_min"), F.col("extracted_salary_max")
    return fx.enriched(spark, sf_dir).select(
        "id", _list(contract.recommend_contracts(low, high)).alias("recommended"),
        contract.validate_contract_salary(F.col("extracted_contract_type"), low, high).alias("valid"))


@query
def semantic_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = semantics.analyze_offer_text(_texts(spark, sf_dir).select("id", "txt"), "txt")
    return rows.select("id", F.col("nlp.experience_years").cast("bigint").alias("experience_years"), "nlp.sector",
                       "nlp.job_category", "nlp.job_level", "nlp.job_type", "nlp.sentiment_score",
                       F.round("nlp.confidence_score", 6).alias("confidence_score"))


@query
def cleaned_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _texts(spark, sf_dir).select("id", F.md5(semantics.clean_offer_text(F.col("txt"))).alias("cleaned"))


@query
def key_phrases_of_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = key_phrases(_texts(spark, sf_dir).select("id", "txt"), "id", "txt")
    return rows.select("id", _list("key_phrases").alias("key_phrases"))


@query
def phrases_of_all_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 500 phrases of the highest C-value over all offers."""
    found = corpus_phrases(_texts(spark, sf_dir).select("txt"), "txt")
    return found.orderBy(F.desc("value"), "phrase").limit(500)


@query
def skills_of_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = skills.with_skills(_texts(spark, sf_dir).select("id", "txt"), "txt")
    return _exploded(rows.select("id", F.explode_outer("skills").alias("skill")), "skill")


@query
def skill_ranking(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = skills.with_skills(_texts(spark, sf_dir).select("id", "txt"), "txt", scores="scores")
    ranked = rows.select("id", F.posexplode_outer("scores").alias("position", "s"))
    return _exploded(ranked, "s").select("id", (F.col("position") + 1).cast("bigint").alias("position"), "s.skill",
                         F.round("s.score", 6).alias("score"))


@query
def skill_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = skills.with_skills(_texts(spark, sf_dir).select("id", "txt"), "txt")
    kinds = rows.select("id", F.explode_outer(skills.categorize_skills(F.col("skills"))).alias("kind", "found"))
    return kinds.select("id", "kind", _list(F.array_sort("found")).alias("skills"))


@query
def skill_matches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers per referential skill, matched against the skills as a table."""
    return skills.match_skills(_texts(spark, sf_dir).select("id", "txt"), "id", "txt",
                               tables.default_referential(spark)) \
        .groupBy("skill", "category", "kind").agg(F.count(F.lit(1)).alias("offers"))


@query
def skill_matches_odd_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skills that do not start with a letter or digit, or have none, in every third offer."""
    texts = _texts(spark, sf_dir).select("id", F.concat("txt", F.when(
        F.col("id").cast("bigint") % 3 == 0, " expert .net, ++ et <>").otherwise("")).alias("txt"))
    terms = spark.createDataFrame([(t, "odd", "technical") for t in (".net", "++", "<>")], "skill string, category string, kind string")
    matched = skills.match_skills(texts, "id", "txt", terms).select("id", "skill", F.lit("table").alias("way"))
    listed = skills.with_skills(texts, "txt", technical={"odd": [".net", "++", "<>"]}, soft=[])
    listed = listed.select("id", F.explode_outer("skills").alias("skill"))
    listed = listed.where(F.lower("skill").isin(".net", "++", "<>")).select("id", F.lower("skill").alias("skill"), F.lit("list").alias("way"))
    return matched.unionByName(listed).groupBy("skill", "way").agg(F.count(F.lit(1)).alias("offers"))


@query
def enriched_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole enrichment job over the whole backlog."""
    rows = enrich.enrich_offers(
        enrich.backlog(fx.offers(spark, sf_dir), fx.enriched(spark, sf_dir), limit=None), fx.AS_OF)
    return rows.select(
        "offre_id", "extracted_salary_min", "extracted_salary_max", "extracted_salary_currency",
        "extracted_contract_type", F.col("extracted_experience_years").cast("bigint").alias("experience_years"),
        _list(F.array_sort("extracted_skills")).alias("skills"), "extracted_sector", "extracted_job_category",
        "sentiment_score", _list("key_phrases").alias("key_phrases"), "job_level", "job_type", "processing_version",
        _time("processed_at").alias("processed_at"), F.round("confidence_score", 6).alias("confidence_score"))


@query
def sector_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagship: enrich every described offer, then offers and salaries per sector and contract."""
    rows = enrich.analyze(fx.offers(spark, sf_dir).where(enrich.enrichable()))
    return rows.groupBy(F.col("nlp")["sector"].alias("sector"), F.col("classified").alias("contract_type")).agg(
        F.count(F.lit(1)).alias("offers"),
        F.count(F.col("salary_info")["min_salary"]).alias("with_salary"),
        F.round(F.avg(F.col("salary_info")["min_salary"]), 3).alias("avg_min_salary"),
        F.sum(F.size("skills")).alias("skills_found"))


# ------------------------------------------------------ upserts, retention
def _url_tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Known rows of a raw table, and a batch in which every document occurs under two URLs.

    A third of the batch shares URLs with other rows: documents that are copies of each other.
    """
    items = fx.postings(spark, sf_dir).select(
        "doc_id", F.concat(F.lit("https://d.example.org/"), F.md5("text")).alias("url"), "title", "company_name",
        F.col("lang").alias("company_sectors"), F.md5("description").alias("description"),
        F.col("contract_type").alias("contract"), F.col("location").alias("region"),
        F.lit("Bac+3").alias("education"), F.lit("2 ans").alias("experience"), F.lit("Excel").alias("skills"),
        F.col("posted_date").alias("posted"), F.col("source").alias("source"), F.col("id").alias("job_count"))
    batch = items.withColumn("id", F.md5("url"))
    known = fx.table(spark, sf_dir, "labels").select("doc_id")
    old = items.join(known, "doc_id", "left_semi").select(*items.columns) \
        .withColumn("id", F.md5("url")).withColumn("title", F.concat_ws(" ", F.lit("Ancien"), "title"))
    target = first_per_key(old, ["url"], [F.col("doc_id")]).drop("doc_id")
    return target, batch


@query
def upsert_by_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _url_tables(spark, sf_dir)
    merged = upsert.upsert_by_url(target, batch, [F.col("doc_id")])
    return merged.select("url", "id", "title", "company_name", "description", "contract", "region", _day("posted"),
                         "source", "job_count")


@query
def upsert_without_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch in which every tenth row has no URL: those are inserted as they are."""
    target, batch = _url_tables(spark, sf_dir)
    batch = batch.withColumn("url", F.when(F.col("doc_id") % 10 != 3, F.col("url")))
    merged = upsert.upsert_by_url(target, batch, [F.col("doc_id")])
    return merged.select("url", "title", "description", "job_count")


@query
def upsert_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _url_tables(spark, sf_dir)
    merged = upsert.upsert_by_key(target, batch, "id", [F.col("doc_id")])
    return merged.select("id", "url", "title", "company_name", "description", "contract", _day("posted"), "source",
                         "job_count")


@query
def upsert_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, batch = _url_tables(spark, sf_dir)
    return upsert.upsert_counts(target, batch, "url", "url")


@query
def touched_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = upsert.touch_updated_at(fx.offers(spark, sf_dir), fx.AS_OF, F.col("contract_type") == "CDI")
    return rows.select("id", _time("created_at").alias("created_at"), _time("updated_at").alias("updated_at"))


def _predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions for every offer; some cells stay empty."""
    return fx.offers(spark, sf_dir).select(
        "id", F.when(F.col("title").isNotNull(), F.lit("Finance")).alias("extracted_sector"),
        F.col("contract_type").alias("extracted_contract_type"), F.lit("Lead").alias("job_level"),
        F.when(F.col("location") == "Dakar", F.lit("Remote")).alias("job_type"),
        F.when(F.col("company_name").isNotNull(), F.array(F.lit("Java"), F.col("company_name")))
        .alias("extracted_skills"),
        F.length("description").cast("bigint").alias("extracted_salary_min"),
        F.lit(None).cast("bigint").alias("extracted_salary_max"))


@query
def patch_enrichment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = upsert.patch_enrichment(fx.enriched(spark, sf_dir), _predictions(spark, sf_dir), fx.AS_OF)
    return rows.select("id", "offre_id", "extracted_sector", "extracted_contract_type", "job_level", "job_type",
                       _list("extracted_skills").alias("skills"), "extracted_salary_min", "extracted_salary_max",
                       "processing_version", _time("processed_at").alias("processed_at"))


@query
def patch_in_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two predictions per offer that differ: the last non-NULL value of each column wins."""
    rows = _predictions(spark, sf_dir)
    later = rows.withColumns({
        "turn": F.lit(2), "extracted_sector": F.when(F.col("job_type").isNull(), "Achats"),
        "job_level": F.lit(None).cast("string"), "job_type": F.lit("On-site")})
    both = rows.withColumn("turn", F.lit(1)).unionByName(later)
    patched = upsert.patch_enrichment(fx.enriched(spark, sf_dir), both, fx.AS_OF, [F.col("turn")])
    return patched.select("id", "offre_id", "extracted_sector", "extracted_contract_type", "job_level", "job_type",
                          _time("processed_at").alias("processed_at"))


@query
def retention(spark: SparkSession, sf_dir: str) -> DataFrame:
    offers, enriched = upsert.apply_retention(fx.offers(spark, sf_dir), fx.enriched(spark, sf_dir), fx.AS_OF)
    return offers.select(F.lit("offer").alias("kind"), "id").unionByName(
        enriched.select(F.lit("enrichment").alias("kind"), "id"))


# ------------------------------------------------------------------- pages
PAGE_RULES = {
    "title": "title::text", "heading": "h1::text", "items": "nav li a::attr(href)",
    "paragraphs": "article p::text", "ads": "div.ad::text",
}
NAV_LISTING = {"block": "nav li", "fields": {"link": "a::attr(href)", "label": "a::text"}, "next": None}


@query
def page_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = pg.extract_fields(fx.table(spark, sf_dir, "pages"), PAGE_RULES)
    values = F.col("fields")
    return fields.select(
        "page_id", tx.first_text(values["title"]).alias("title"), tx.first_text(values["heading"]).alias("heading"),
        F.size(values["items"]).cast("bigint").alias("items"),
        tx.first_text(values["ads"]).alias("ad"))


@query
def page_paragraphs(spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = pg.extract_fields(fx.table(spark, sf_dir, "pages"), PAGE_RULES)
    return fields.select("page_id", F.md5(tx.join_fragments(F.col("fields")["paragraphs"], "\n")).alias("paragraphs"))


@query
def listing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pg.extract_listing_links(fx.table(spark, sf_dir, "pages"), NAV_LISTING)


@query
def json_fragment_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as the answer to a listing request; those with a query string were not found."""
    responses = fx.table(spark, sf_dir, "pages").select(
        "page_id", "url", F.to_json(F.struct("html")).alias("body"),
        F.when(F.contains("url", F.lit("?")), 404).otherwise(200).alias("status"))
    return pg.extract_links_from_json(responses, NAV_LISTING)


@query
def numbered_listing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a numbered listing page: the next page follows, whatever the number."""
    pages = fx.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("page_id"), F.lit("https://l.example.org/sn/offres.php").alias("url"), F.concat(
            F.lit('<table id="offresenjobs"></table><div class="resultsOffre activepage"><span>'),
            (F.col("doc_id") % 40 + 1).cast("string"), F.lit("</span></div>")).alias("html"))
    return pg.extract_listing_links(pages, site_rules.LISTING_RULES["senjobs"])


def _escaped(c: Column) -> Column:
    return F.replace(F.replace(F.coalesce(c, F.lit("")), F.lit("&"), F.lit("&amp;")), F.lit("<"), F.lit("&lt;"))


def _page(template: str) -> Column:
    """HTML with ``{column}`` places filled from the offer."""
    pieces = template.replace("}", "{").split("{")
    return F.concat(*[_escaped(F.col(p)) if i % 2 else F.lit(p) for i, p in enumerate(pieces)])


_DETAIL_PAGES = {
    "emplois": """<html><body><h1 class="entry-title">{title}</h1><ul><li class="job-type full">{contract_type}</li>
<li class="location"><a href="/x">{location}</a></li><li class="date-posted"><time datetime="{day}">hier</time></li></ul>
<div class="company_header"><strong>{company_name}</strong></div><div class="company"><img class="company_logo" src="l.png">
</div><div class="job_description"><p>{description}<p>{text}</p><ul><li>{lang}<li>{source}</ul></div></body></html>""",
    "senjobs": """<html><body><table><tr><td><table><tr><td><strong>{contract_type}</strong><table><tr><td>Salaire
<td> {n_chars}/ mois <td>{lang}</table></table></table><div class="view"><p>{description}</p><p>{text}</p></div>
<div class="tagcompt">{source}</div></body></html>""",
    "emploi_expatdakar": """<html><body><h1 class="listing-item__header">  {title} !</h1>
<div class="listing-item__details__date">{day}</div><div class="listing-item__details__ad-id">Ref: {n_chars}</div>
<span class="listing-item__address-location">{location}</span><span class="listing-item__address-region">{lang}</span>
<dl><dt class="listing-item__properties__title">Employeur<dd>{company_name}<dt class="listing-item__properties__title">
Type de contrat</dt><dd>{contract_type}</dd><dt class="listing-item__properties__title">Nombre de <b>postes</b></dt>
<dd>2</dd></dl><div class="listing-item__description"><p>{description}</p><p>{text}</p></div></body></html>""",
    "jobs_emploi_senegal": """<html><body><h1>{title}</h1><div class="card-block-company"><h3><a>{company_name}</a></h3>
</div><time datetime="{day}T08:00">x</time><ul><li class="withicon file-signature">Contrat : <span>: {contract_type} </span>
<li class="withicon location-dot"><span>{location}</span></ul><div class="card-job-description"><p>{description}<br>
{text}</p></div><section><div class="job-description">m</div></section><section><div class="job-qualifications"><p>{lang}
</p></div></section><section><ul class="arrow-list"><li>a<li>b : <span>{n_chars}</span></ul></section></body></html>""",
    "concoursn_stages": """<html><body><h1 class="entry-title">{title}</h1><span class="meta-category"><a>{lang}</a>
<a>"{source}"</a></span><div class="meta-tags"></div><span class="updated">depuis {n_chars} minutes</span>
<div class="entry-content"><p>{description}</p><script>var x = "</p>";</script><p>{text}</p></div></body></html>""",
}


def _site_pages(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Every document as a detail page of one site."""
    rows = fx.postings(spark, sf_dir).withColumn("day", F.col("posted_date").cast("string"))
    return rows.withColumn("n_chars", F.col("n_chars").cast("string")).select(
        F.col("doc_id").alias("page_id"), "url", _page(_DETAIL_PAGES[name]).alias("html"))


def _detail_query(name: str) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        items = pg.extract_offers_from_pages(_site_pages(spark, sf_dir, name), name, fx.AS_OF)
        long_texts = {"description", "description_p", "description_ul"}
        shown = []
        for field in items.schema:
            column = F.col(field.name)
            if field.name in long_texts:
                column = F.md5(column)
            elif field.dataType.typeName() in ("timestamp_ntz", "timestamp"):
                column = _time(field.name)
            elif field.dataType.typeName() == "date":
                column = _day(field.name)
            shown.append(column.alias(field.name))
        return items.select(*shown)

    return run


for _name in _DETAIL_PAGES:
    QUERIES[f"detail_pages_{_name}"] = _detail_query(_name)


@query
def listing_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a row of a table listing of its own page."""
    template = """<table id="offresenjobs"><tr><th>Offre</th></tr><tr><td><a href="../offre/{id}.html"> {title} </a></td>
<td><span><span class="glyphicon glyphicon-map-marker"></span>  {location}
 Sénégal</span></td><td><span><span class="glyphicon glyphicon-calendar"></span> Publiée <b>{day}</b></span></td><td>
<span>Expire<span class="glyphicon glyphicon-time"></span> {lang} </span></td></tr><tr><td><a href="?page=2">2</a></tr>
</table><div class="resultsOffre activepage"><span>3</span></div>"""
    rows = fx.postings(spark, sf_dir).withColumn("day", F.col("posted_date").cast("string"))
    return pg.extract_listing_items(rows.select(
        F.col("doc_id").alias("page_id"), F.lit("https://l.example.org/sn/offres.php").alias("url"),
        _page(template).alias("html")))


@query
def site_listing_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document on a listing page of its site: detail and next-page links."""
    templates = {
        "jobs_emploi_senegal": '<div class="card-job new"><h3><a href="/offre/{id}">{title}</a></h3></div><ul>'
                               '<li class="pager-next"><a href="?p=2">Suivant</a></ul>',
        "concoursn_stages": '<article class="vce-post"><h2 class="entry-title"><a href="stage/{id}">{title}</a></h2>'
                            '</article><nav id="vce-pagination" class="vce-load-more"><a href="/p/2">+</a></nav>',
        "emploi_expatdakar": '<a class="listing-card__inner" href="/annonce/{id}">{title}</a>'
                             '<a class="listing-card__inner" href="/pub/{id}">x</a><a rel="next" href="/l?p=2">></a>',
        "emplois": '<ul><li class="job_listing"><a href=" https://e.example.org/{id} ">{title}</a>'
                   '<li class="job_listing">sans lien</ul>',
    }
    rows = fx.postings(spark, sf_dir)
    parts = []
    for name, template in templates.items():
        site = rows.select(F.col("doc_id").alias("page_id"), F.lit("https://s.example.org/a/b").alias("url"),
                           _page(template).alias("html"))
        links = pg.extract_listing_links(site, site_rules.LISTING_RULES[name])
        parts.append(links.withColumn("site", F.lit(name)))
    merged = parts[0]
    for part in parts[1:]:
        merged = merged.unionByName(part)
    return merged


# ------------------------------------------------------- tables and files
@query
def table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers written as CSV, JSON and Parquet and read back by extension."""
    rows = fx.offers(spark, sf_dir).select("id", "title", "description", "contract_type")
    base = workdir.new_path(spark, "round-trip")
    rows.write.option("header", True).option("escape", '"').csv(f"{base}/offers.csv")
    rows.write.parquet(f"{base}/offers.parquet")
    rows.write.json(f"{base}/offers.json")
    rows.withColumn("description", F.lit("-")).write.option("header", True).option("escape", '"').csv(f"{base}/lines.csv")
    parts = []
    for kind, file in (*((k, f"offers.{k}") for k in tables.FORMATS), ("csv lines", "lines.csv")):
        read = tables.read_offers(spark, f"{base}/{file}", rows.schema, multi_line=file == "offers.csv")
        parts.append(read.select(F.lit(kind).alias("format"), "id", "title", F.md5("description").alias("description")))
    return reduce(DataFrame.unionByName, parts)


#: Characters that one of the files of ``split_files`` holds, which is several splits.
FILE_CHARS = 256_000_000


@query
def split_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers written as CSV with line breaks in its cells and as JSON arrays, one file of each for ``FILE_CHARS``, and read back in splits."""
    rows, base = fx.offers(spark, sf_dir).select("id", "title", "description", "contract_type"), workdir.new_path(spark, "split-files")
    chars = rows.agg(F.sum(F.coalesce(F.length("description"), F.lit(0)).cast("long"))).first()[0] or 0
    files = 1 + chars // FILE_CHARS
    numbered = rows.withColumn("file", F.pmod(F.xxhash64("id"), F.lit(files)).cast("int"))
    numbered.repartitionById(files, "file").drop("file").write.option("header", True).option("escape", '"').csv(f"{base}/offers.csv")
    ends = numbered.groupBy("file").agg(F.min("id").alias("first"))
    first = F.col("id") == F.col("first")
    lines = numbered.join(F.broadcast(ends), "file").select(
        "file", F.concat(F.when(first, "[").otherwise(","), F.to_json(F.struct(*rows.columns))).alias("value"),
        F.when(first, 0).otherwise(1).alias("place"))
    lines = lines.unionByName(ends.select("file", F.lit("]").alias("value"), F.lit(2).alias("place")))
    lines.repartitionById(files, "file").sortWithinPartitions("place").select("value").write.text(f"{base}/offers.json")
    parts = [tables.read_offers(spark, f"{base}/offers.{kind}", rows.schema, multi_line=True).select(
        F.lit(kind).alias("format"), "id", "title", F.md5("description").alias("description"), "contract_type") for kind in ("csv", "json")]
    return reduce(DataFrame.unionByName, parts)


@query
def stored_enrichments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichments appended in two runs to a table that is created once."""
    path = workdir.new_path(spark, "enrichments")
    rows = fx.enriched(spark, sf_dir)
    tables.append_enriched(rows.where("extracted_sector IS NOT NULL"), path)
    tables.append_enriched(rows.where("extracted_sector IS NULL"), path)
    return spark.read.schema(schemas.ENRICHED).parquet(path).select(
        "id", "offre_id", "extracted_sector", _list("extracted_skills").alias("skills"), _time("processed_at").alias("processed_at"))


@query
def training_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training extract kept as CSV and read back."""
    path = workdir.new_path(spark, "snapshot")
    impute.snapshot_training_csv(_extract(spark, sf_dir).drop("description"), path)
    return spark.read.option("header", True).option("escape", '"').csv(path).select(
        "id", "title", "extracted_skills", F.col("extracted_salary_min").cast("bigint").alias("extracted_salary_min"))


@query
def repeated_consolidation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consolidating the raw tables of a folder twice adds every offer once."""
    base, target = workdir.new_path(spark, "raw"), workdir.new_path(spark, "offers")
    for name, raw in fx.raw_sources(spark, sf_dir).items():
        schemas.conform(raw, schemas.RAW_SCHEMAS[name]).write.parquet(f"{base}/{name}")
    sources = tables.read_sources(spark, base)
    tables.append_consolidated(consolidate.consolidate(sources, None, fx.AS_OF), target)
    tables.append_missing(spark, consolidate.consolidate(sources, None, fx.AS_OF), target)
    return spark.read.schema(schemas.OFFERS).parquet(target).groupBy("spider_source").agg(
        F.count(F.lit(1)).alias("offers"), F.count_if(F.col("posted_date").isNotNull()).alias("dated"))


@query
def stored_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics rows appended to the metric log and read back."""
    path = workdir.new_path(spark, "statistics")
    for metric in (stats.offers_by_sector, stats.offers_by_contract_type):
        tables.append_statistics(_both(metric)(spark, sf_dir), path, fx.AS_OF)
    return spark.read.schema(schemas.STATISTICS).parquet(path).select(
        "id", "metric_name", "metric_value", _day("period_end"), "category", _time("created_at").alias("created_at"))


@query
def enriched_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Enrichments written as CSV with arrays as JSON text, and read back."""
    path = workdir.new_path(spark, "enriched-csv")
    tables.write_enriched_csv(fx.enriched(spark, sf_dir).drop("processed_at"), path)
    return spark.read.option("header", True).option("escape", '"').csv(path).select(
        "id", "offre_id", F.col("extracted_salary_min").cast("bigint").alias("extracted_salary_min"),
        "extracted_skills", "extracted_sector")


@query
def skill_referential(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skills found in the offers, stored as a referential and matched again."""
    found = skills_of_offers(spark, sf_dir).select(F.lower("skill").alias("skill")).distinct()
    referential = tables.default_referential(spark).join(found, "skill", "left_semi")
    path = workdir.new_path(spark, "referential")
    tables.write_skill_referential(referential, path, fx.AS_OF)
    return tables.read_skill_referential(spark, path)


# -------------------------------------------------------------- imputation
def _labelled_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents, with the quality label where there is one."""
    labels = fx.table(spark, sf_dir, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    return fx.table(spark, sf_dir, "documents").join(labels, "doc_id", "left").select(
        "doc_id", F.col("source").alias("title"), F.col("text").alias("description"), "lang", "quality")


@query
def stratified_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = fx.table(spark, sf_dir, "documents").select("doc_id", "lang")
    return impute.stratified_split(rows, "lang", "doc_id")


@query
def label_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sectors as training classes, in the order of their index."""
    labels = impute.index_labels(fx.enriched(spark, sf_dir).where("extracted_sector IS NOT NULL"), "extracted_sector").labels
    return spark.createDataFrame([(i, label) for i, label in enumerate(labels)], "position long, label string")


@query
def classification_figures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accuracy and weighted F1 of a rule that takes every third document for English."""
    rows = fx.table(spark, sf_dir, "documents").select(
        "lang", F.when(F.col("doc_id") % 3 == 0, "en").otherwise(F.col("lang")).alias("label"))
    labels = sorted(r[0] for r in rows.select("lang").distinct().collect())
    found = impute.classification_metrics(rows, "lang", labels)
    return spark.createDataFrame([(round(found["accuracy"], 9), round(found["f1"], 9))], "accuracy double, f1 double")


@query
def fill_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = upsert.latest_enrichment(fx.enriched(spark, sf_dir).where("offre_id IS NOT NULL"))
    filled = impute.fill_missing(latest, _predictions(spark, sf_dir).withColumnRenamed("id", "offre_id"), "offre_id")
    return filled.select("offre_id", "extracted_sector", "extracted_contract_type", "job_level", "job_type",
                         _list("extracted_skills").alias("skills"), "extracted_salary_min", "extracted_salary_max")


@query
def fill_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    latest = upsert.latest_enrichment(fx.enriched(spark, sf_dir).where("offre_id IS NOT NULL"))
    filled = impute.fill_missing(latest, _predictions(spark, sf_dir).withColumnRenamed("id", "offre_id"), "offre_id")
    return stats.fill_report(latest, filled)


@query
def impute_by_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Skills and salaries of the offers without a sector, by rules."""
    rows = impute.impute_salary(impute.impute_skills(impute.not_yet_enriched(_extract(spark, sf_dir))))
    return stats.extraction_rate(rows)


@query
def impute_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train on the labelled documents, predict the label of the others."""
    rows = _labelled_documents(spark, sf_dir)
    complete, incomplete = impute.split_complete(rows, ["quality"])
    model, _ = impute.train_column(complete, "quality", "doc_id")
    text = tx.model_text(F.col("title"), F.col("description"), rules.NO_TEXT)
    return impute.predict_imputer(model, incomplete.select("doc_id", text.alias("_text"))).select(
        "doc_id", "label", "confidence", "accepted")


@query
def imputation_contract(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What holds for any model, also after it was stored and read again: who is predicted, by which labels, what is accepted."""
    rows = _labelled_documents(spark, sf_dir)
    complete, incomplete = impute.split_complete(rows, ["quality"])
    config = impute.ImputeConfig(models_dir=workdir.new_path(spark, "models"))
    impute.train_column(complete, "quality", "doc_id", config)
    model = impute.read_imputer(spark, f"{config.models_dir}/quality")
    text = tx.model_text(F.col("title"), F.col("description"), rules.NO_TEXT)
    found = impute.predict_imputer(model, incomplete.select("doc_id", text.alias("_text")))
    return found.agg(
        F.count(F.lit(1)).alias("predicted"), F.countDistinct("doc_id").alias("documents"),
        F.bool_and(F.col("label").isin("0", "1")).alias("known_labels"),
        F.bool_and(F.col("accepted") == (F.col("probability") >= 0.7)).alias("accepted_by_confidence"),
        F.bool_and(F.col("confidence").between(0.5, 1.0)).alias("confidence_of_best"))


@query
def impute_acceptance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stats.acceptance_rate(impute_quality(spark, sf_dir))


@query
def full_imputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole imputation job over the offer extract: cells filled per column."""
    _, figures = impute.run_full_imputation(_extract(spark, sf_dir), "id")
    return figures


@query
def full_imputation_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same job with offers that repeat: rows stay as many, and no column loses a value."""
    extract = _extract(spark, sf_dir)
    filled, figures = impute.run_full_imputation(extract, "id")
    return figures.select("column", "before", (F.col("improvement") >= 0).alias("kept")).withColumn("rows", F.lit(filled.count()))


def _judged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages as three candidates say them: each errs on other documents, and the surer the more often it is right."""
    docs, number = fx.table(spark, sf_dir, "documents"), F.col("doc_id")
    says = [F.struct(F.lit(c).alias("candidate"), F.when(number % every == 0, "en").when(number % 97 < every, "fr").otherwise(F.col("lang")).alias("label"))
            for c, every in ((0.01, 5), (0.1, 9), (1.0, 9))]
    return docs.select(F.lit("lang").alias("column"), F.col("lang").alias("actual"), (number % 97 / 97).alias("confidence"),
                       F.explode(F.array(*says)).alias("said")).select("column", "actual", "confidence", "said.*")


@query
def candidate_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Figures of three candidates from their predictions, and which of them is chosen."""
    figures = impute.candidate_figures(_judged_documents(spark, sf_dir))
    best = impute.best_candidates(figures).select("column", F.col("candidate").alias("best"))
    return figures.join(best, "column").select("column", "candidate", "rows", F.round("accuracy", 9).alias("accuracy"),
                                               F.round("f1", 9).alias("f1"), (F.col("candidate") == F.col("best")).alias("chosen"))


@query
def candidate_reliability(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bins of confidence with their hits, the probability that each is worth, and how many predictions that accepts."""
    rows, bins = _judged_documents(spark, sf_dir).where("candidate = 0.1"), 10
    found = impute.reliability(rows, bins)
    worth = impute.worth_of({r["bin"]: (r["rows"], r["hits"], r["confidence"]) for r in found.collect()}, bins)
    probability = impute.calibrated((F.col("bin") + 0.5) / bins, worth)
    return found.select("bin", "rows", "hits", F.round("confidence", 9).alias("confidence"), F.round(probability, 9).alias("probability"),
                        impute.accepted(probability, 0.7).alias("accepted"))


@query
def acceptance_of_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Share of the predictions of each candidate that reach the threshold."""
    rows = _judged_documents(spark, sf_dir).withColumn("accepted", impute.accepted(F.col("confidence"), rules.MIN_CONFIDENCE))
    shares = [stats.acceptance_rate(rows.where(F.col("candidate") == c)).withColumn("candidate", F.lit(c)) for c in (0.01, 0.1, 1.0)]
    return reduce(DataFrame.unionByName, shares).select("candidate", "accepted", "total", F.round("rate", 9).alias("rate"))


@query
def model_selection(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Classifiers of two columns: size of the stored validation predictions, and whether their figures are those that plain SQL
    finds in them, the best of them chosen, and its accuracy above that of the commonest label by no less than -0.05."""
    complete = impute.split_complete(_labelled_documents(spark, sf_dir), ["quality"])[0].withColumn("language", F.col("lang"))
    config = impute.ImputeConfig(features=1 << 14, max_iter=10)
    _, _, found = impute.validated_fits(complete, ["quality", "language"], "doc_id", config)
    again = spark.sql("""
        WITH p AS (SELECT * FROM {found}), n AS (SELECT column, candidate, actual AS name, count(*) AS there,
          count_if(actual = label) AS hit FROM p GROUP BY ALL),
        s AS (SELECT column, candidate, label AS name, count(*) AS said FROM p GROUP BY ALL)
        SELECT n.column, n.candidate, sum(hit) / sum(there) AS accuracy, max(there) / sum(there) AS commonest,
          sum(there * 2 * hit / (there + coalesce(said, 0))) / sum(there) AS f1
        FROM n LEFT JOIN s USING (column, candidate, name) GROUP BY n.column, n.candidate""", found=found)
    figures = impute.candidate_figures(found)
    best = impute.best_candidates(figures).select("column", F.col("f1").alias("best_f1"), F.col("accuracy").alias("best_accuracy"))
    both = figures.join(again.withColumnsRenamed({"accuracy": "accuracy2", "f1": "f12"}), ["column", "candidate"]).join(best, "column")
    return both.groupBy("column").agg(
        F.count(F.lit(1)).alias("candidates"), F.max("rows").alias("rows"),
        F.bool_and((F.abs(F.col("accuracy") - F.col("accuracy2")) < 1e-9) & (F.abs(F.col("f1") - F.col("f12")) < 1e-9)).alias("agree"),
        (F.max("f12") == F.max("best_f1")).alias("best_is_best"),
        (F.max("best_accuracy") >= F.max("commonest") - 0.05).alias("learned"))


def _quick(spark: SparkSession, least: int) -> impute.ImputeConfig:
    return impute.ImputeConfig(models_dir=workdir.new_path(spark, "models"), min_complete_rows=least, features=1 << 12, max_iter=5,
                               candidates=(0.1,))


@query
def train_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training with as many complete rows as are wanted, and with one too few: what is published, and what is used."""
    offers, enriched = fx.offers(spark, sf_dir), fx.enriched(spark, sf_dir)
    complete = impute.split_complete(_extract(spark, sf_dir))[0].count()
    rows = []
    for least in (complete, complete + 1):
        config = _quick(spark, least)
        trained = impute.train_job(offers, enriched, config)
        models = impute.published_models(spark, config)
        rows.append((least, trained, ",".join(sorted(models)), all(sum(v is not None for v in m.worth) > 0 for m in models.values())))
    return spark.createDataFrame(rows, "least long, trained boolean, models string, calibrated boolean")


def _after_job(rows: DataFrame) -> DataFrame:
    changed = _time("processed_at") == fx.AS_OF
    return rows.select("offre_id", changed.alias("changed"), F.col("processing_version").alias("version"), F.when(
        ~changed, F.col("extracted_sector")).alias("old_sector"), F.when(changed, F.size("extracted_skills")).alias("skills"))


@query
def predict_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prediction without published models: the rows without a sector get what rules find, all others stay."""
    result = impute.predict_job(fx.offers(spark, sf_dir), fx.enriched(spark, sf_dir), _quick(spark, 0), fx.AS_OF)
    return _after_job(result)


@query
def full_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Training, prediction and publication: the published rows as a later job reads them."""
    offers, enriched = fx.offers(spark, sf_dir), fx.enriched(spark, sf_dir)
    config, path = _quick(spark, 1), workdir.new_path(spark, "published")
    impute.full_job(offers, enriched, config, fx.AS_OF, path)
    return _after_job(impute.published_rows(spark, path, enriched.schema))


@query
def ensured_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The offers in a table that is created if it is missing: created once, filled, and asked for again."""
    place = workdir.new_path(spark, "offers-table")
    spark.sql("DROP TABLE IF EXISTS offers")  # what an earlier call in this session has left in the catalog
    schemas.ensure_table(spark, "offers", place)
    schemas.conform(fx.offers(spark, sf_dir), schemas.OFFERS).write.insertInto("offers")
    return schemas.ensure_table(spark, "offers", place).groupBy("spider_source").agg(
        F.count(F.lit(1)).alias("offers"), F.count("posted_date").alias("dated"), F.max(_time("created_at")).alias("newest"))


# --------------------------------------------------------------- streaming
def _document_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = fx.table(spark, sf_dir, "documents").schema
    items = streaming.read_stream(spark, f"{sf_dir}/documents.parque[t]", schema)
    return items.withColumn("url", F.concat(F.lit("https://d.example.org/"), F.md5("text")))


@query
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a stream of items, of which every URL is kept once."""
    path, checkpoint = workdir.new_path(spark, "dedup"), workdir.new_path(spark, "dedup-checkpoint")
    items = streaming.stream_dedup(_document_stream(spark, sf_dir)).select("id", "url")
    streaming.write_stream(items, path, checkpoint).awaitTermination()
    return spark.read.schema("id string, url string").parquet(path)


@query
def stream_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same stream, where the first document of every URL is kept: two arrivals with copies in both."""
    folder, path = workdir.new_path(spark, "documents"), workdir.new_path(spark, "first")
    checkpoint = workdir.new_path(spark, "first-checkpoint")
    docs = fx.table(spark, sf_dir, "documents").select(
        "doc_id", "lang", F.concat(F.lit("https://d.example.org/"), F.md5("text")).alias("url"))
    for part in (1, 0):
        docs.where(F.col("doc_id") % 2 == part).write.mode("append").parquet(folder)
        items = streaming.read_stream(spark, folder, docs.schema)
        streaming.stream_first(items, path, checkpoint, [F.col("doc_id")]).awaitTermination()
    return spark.read.schema("id string, doc_id long, lang string").parquet(path).select("id", "doc_id", "lang")


@query
def stream_first_expiring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views of users in four arrivals, some of them late: a view is kept if the last one kept is four days old, and
    dropped if it is more than five days behind the newest view of an earlier arrival."""
    folder, path = workdir.new_path(spark, "views"), workdir.new_path(spark, "first-views")
    checkpoint = workdir.new_path(spark, "first-views-checkpoint")
    events = fx.table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    late = F.when(F.col("event_id") % 10 == 3, 1).when(F.col("event_id") % 50 == 4, 2).otherwise(0)
    events = events.withColumn("arrival", F.least(F.lit(3), F.floor((F.dayofmonth("ts") - 1) / 8) + late).cast("int"))
    events = events.withColumn("url", F.concat_ws("/", F.lit("https://e.example.org"), "event_type", "user_id"))
    for arrival in range(4):
        events.where(F.col("arrival") == arrival).write.mode("append").parquet(folder)
        items = streaming.read_stream(spark, folder, events.schema)
        streaming.stream_first(items, path, checkpoint, [F.col("event_id")], "ts", "4 days", "5 days").awaitTermination()
    return spark.read.schema(f"id string, {', '.join(f'{f.name} {f.dataType.simpleString()}' for f in events.schema)}").parquet(path).select(
        "id", "url", "event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "value", "props", "arrival")


@query
def stream_dedup_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page views of users as items; a view is kept once within the watermark delay."""
    path, checkpoint = workdir.new_path(spark, "events"), workdir.new_path(spark, "events-checkpoint")
    events = streaming.read_stream(spark, f"{sf_dir}/events.parque[t]", fx.table(spark, sf_dir, "events").schema)
    items = events.select(F.col("ts").cast("timestamp").alias("ts"), F.concat_ws(
        "/", F.lit("https://e.example.org"), "event_type", "user_id").alias("url"))
    kept = streaming.stream_dedup(items, "ts", "60 days").select("id", "url")
    streaming.write_stream(kept, path, checkpoint).awaitTermination()
    return spark.read.schema("id string, url string").parquet(path)


@query
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of raw rows folded into the stored known rows, bucket by bucket: equal to the batch upsert."""
    target, batch = _url_tables(spark, sf_dir)
    folder, log = workdir.new_path(spark, "items"), workdir.new_path(spark, "upserts")
    checkpoint, stored = workdir.new_path(spark, "upserts-checkpoint"), workdir.new_path(spark, "stored")
    middle, order = batch.agg(F.avg("doc_id")).first()[0], [F.col("doc_id")]
    table = BucketedTable(stored, "url", target.schema, buckets=16)
    table.fold(target, lambda nothing, first: first, batch=None)
    for early in (True, False):
        batch.where((F.col("doc_id") < middle) == early).write.mode("append").parquet(folder)
        items = streaming.read_stream(spark, folder, batch.schema)
        streaming.stream_upsert(items, log, checkpoint).awaitTermination()
        streaming.fold_into(table, streaming.read_upserts(spark, log, batch.schema), order)
    merged = table.read(spark)
    return merged.select("url", "id", "title", "company_name", "description", "contract", "region", _day("posted"),
                         "source", "job_count")


@query
def incremental_enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Offers enriched as they arrive: summary per sector and contract."""
    folder, path = workdir.new_path(spark, "arrivals"), workdir.new_path(spark, "enriched")
    schemas.conform(fx.offers(spark, sf_dir), schemas.OFFERS).write.parquet(folder)
    arrivals = streaming.read_stream(spark, folder, schemas.OFFERS)
    streaming.incremental_enrich(arrivals, path, workdir.new_path(spark, "enriched-checkpoint"), fx.AS_OF) \
        .awaitTermination()
    return spark.read.schema(schemas.ENRICHED).parquet(path).groupBy(
        F.col("extracted_sector").alias("sector"), F.col("extracted_contract_type").alias("contract_type")).agg(
        F.count(F.lit(1)).alias("offers"), F.count("extracted_salary_min").alias("with_salary"),
        F.sum(F.size("extracted_skills")).alias("skills_found"))


@query
def incremental_enrich_rest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals over a table in which the batch job has enriched the labelled offers; the second brings offers again."""
    folder, path, stored = (workdir.new_path(spark, name) for name in ("arrivals", "enriched", "stored"))
    checkpoint, schema = workdir.new_path(spark, "enriched-checkpoint"), schemas.ENRICHED
    schemas.conform(fx.enriched(spark, sf_dir), schema).write.parquet(stored)
    offers = schemas.conform(fx.offers(spark, sf_dir), schemas.OFFERS)
    number = F.col("id").cast("long")
    for part in (number % 3 < 2, number % 3 > 0):
        offers.where(part).write.mode("append").parquet(folder)
        arrivals = streaming.read_stream(spark, folder, schemas.OFFERS)
        streaming.incremental_enrich(arrivals, path, checkpoint, fx.AS_OF, lambda: spark.read.schema(schema).parquet(stored)) \
            .awaitTermination()
    return spark.read.schema(schema).parquet(path).select("offre_id", F.col("extracted_sector").alias("sector"), F.col(
        "extracted_contract_type").alias("contract_type"))
