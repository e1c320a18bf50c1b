"""Imputation of missing enrichment fields.

Text classifiers are trained on complete rows and predict the incomplete ones. Of several fits for a column the one that
predicts the validation part best is kept, and its confidences are calibrated there; predictions that are less probable than a
threshold are dropped, and only NULLs are filled. Skills and salaries come from the rule extractors.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.ml import PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import (
    IDF, HashingTF, IndexToString, RegexTokenizer, StringIndexer, StringIndexerModel, VarianceThresholdSelector,
)
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from offerflow import rules
from offerflow.functions.salary import with_salary
from offerflow.functions.skills import with_skills
from offerflow.functions.text import model_text, offer_text
from offerflow.operators import stats
from offerflow.operators.enrich import read_offers_with_enrichment
from offerflow.operators.keyed import last_per_key
from offerflow.operators.upsert import patch_enrichment
from offerflow.operators.versions import Runs
from offerflow.sources.tables import write_enriched_csv
from offerflow.workdir import written


@dataclass(frozen=True)
class ImputeConfig:
    """Settings of the imputation jobs."""

    models_dir: str | None = None
    min_confidence: float = rules.MIN_CONFIDENCE
    min_complete_rows: int = rules.MIN_COMPLETE_ROWS
    targets: tuple[str, ...] = rules.TARGET_COLUMNS
    ml_targets: tuple[str, ...] = rules.ML_TARGETS
    max_iter: int = 20
    features: int = 1 << 18
    candidates: tuple[float, ...] = (0.01, 0.1)
    fits_at_once: int = 2
    bins: int = 10
    validation_share: float = rules.VALIDATION_SHARE
    seed: int = rules.SPLIT_SEED


@dataclass(frozen=True)
class Imputer:
    """A text classifier of one column: features that columns share, the classifier, the probability that a confidence in
    each bin is worth (None where the validation part had none), and the figures of the chosen candidate."""

    features: PipelineModel
    classifier: PipelineModel
    worth: tuple[float | None, ...]
    metrics: dict[str, float]


# ----------------------------------------------------------------- splitting
def split_complete(df: DataFrame, targets: Iterable[str] = rules.TARGET_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """Rows with all target columns filled, and the others."""
    mask = stats.complete_mask(df, targets)
    return df.where(mask), df.where(~mask)


def not_yet_enriched(df: DataFrame) -> DataFrame:
    return df.where("extracted_sector IS NULL")


def stratified_split(
    df: DataFrame, label: str, key: str, share: float = rules.VALIDATION_SHARE, seed: int = rules.SPLIT_SEED,
    out: str = "is_validation",
) -> DataFrame:
    """Mark exactly ceil(share x rows) rows for validation, spread over the labels in proportion.

    Every label gets the whole part of its quota, the rest goes to the largest
    remainders. Within a label the rows with the smallest hash are taken. Rows are
    counted per (label, hash bucket) first; only rows in the one bucket where a label's
    quota ends are ordered, so a label that holds a third of all rows stays distributed.
    """
    hashed = df.withColumn("_hash", F.md5(F.concat_ws(":", F.col(key).cast("string"), F.lit(str(seed)))))
    hashed = hashed.withColumn("_bucket", F.conv(F.substring("_hash", 1, 4), 16, 10).cast("int"))
    counts = hashed.groupBy(label, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    # One row per label from here to the quotas.
    sizes = counts.groupBy(label).agg(F.sum("_n").alias("_size"))
    everything = Window.partitionBy()
    sizes = sizes.withColumn("_wanted", F.ceil(F.sum("_size").over(everything) * F.lit(share))) \
        .withColumn("_exact", F.col("_wanted") * F.col("_size") / F.sum("_size").over(everything)) \
        .withColumn("_whole", F.floor("_exact")) \
        .withColumn("_spare", F.col("_wanted") - F.sum("_whole").over(everything)) \
        .withColumn("_turn", F.row_number().over(Window.orderBy(F.desc(F.col("_exact") - F.col("_whole")), label)))
    quotas = sizes.select(
        F.col(label).alias("_label"),
        (F.col("_whole") + F.when(F.col("_turn") <= F.col("_spare"), 1).otherwise(0)).alias("_quota"))
    # At most 65,536 buckets per label.
    running = F.sum("_n").over(Window.partitionBy(label).orderBy("_bucket"))
    ends = counts.withColumn("_upto", running) \
        .join(quotas, F.col(label).eqNullSafe(F.col("_label")), "inner") \
        .where((F.col("_upto") - F.col("_n") <= F.col("_quota")) & (F.col("_quota") < F.col("_upto"))) \
        .select("_label", F.col("_bucket").alias("_end"),
                (F.col("_quota") - F.col("_upto") + F.col("_n")).alias("_take"))
    # Written, so that its size is known: where it is small, as many rows as labels, no text moves to meet its label.
    ends = written(ends, "quota-ends")
    placed = hashed.join(ends, F.col(label).eqNullSafe(F.col("_label")), "left")
    on_edge = F.col("_bucket") == F.col("_end")
    rank = F.row_number().over(Window.partitionBy("_label", "_bucket").orderBy("_hash", key))
    edge = placed.where(on_edge).withColumn(out, rank <= F.col("_take"))
    # A label whose quota is its whole size has no end bucket.
    rest = placed.where(~F.coalesce(on_edge, F.lit(False))).withColumn(
        out, F.col("_end").isNull() | (F.col("_bucket") < F.col("_end")))
    return rest.unionByName(edge).select(*df.columns, out)


# ---------------------------------------------------------- label and model
def index_labels(df: DataFrame, column: str) -> StringIndexerModel:
    """Labels sorted ascending as 0..k-1."""
    indexer = StringIndexer(inputCol=column, outputCol="_label", stringOrderType="alphabetAsc", handleInvalid="skip")
    return indexer.fit(df.select(column))


def _with_counts(df: DataFrame, text: str, config: ImputeConfig) -> tuple[PipelineModel, DataFrame]:
    """Hashing of the words of a text, and rows with ``_counts`` in place of the text."""
    words = RegexTokenizer(inputCol=text, outputCol="_words", pattern=r"[\p{L}\p{N}]+", gaps=False)
    counts = HashingTF(inputCol="_words", outputCol="_counts", numFeatures=config.features)
    hashing = PipelineModel([words, counts])
    return hashing, hashing.transform(df).drop(text, "_words")


def _fit_weights(counted: DataFrame) -> list:
    """Weights of counted words, and which buckets are features: those whose weight varies, as the others get no coefficient.

    With all buckets most coefficients may be zero. Spark then stores them sparsely, and a score walks through all that are
    not zero, instead of the words of its text.
    """
    weights = IDF(inputCol="_counts", outputCol="_weights", minDocFreq=1).fit(counted)
    varying = VarianceThresholdSelector(featuresCol="_weights", outputCol="_features").fit(weights.transform(counted))
    # Without a varying bucket all stay, as a vector must not be empty.
    return [weights, varying] if varying.selectedFeatures else [weights.setOutputCol("_features")]


def fit_features(rows: DataFrame, text: str, config: ImputeConfig = ImputeConfig()) -> PipelineModel:
    """Hashed TF-IDF over whole texts, fitted once for all columns."""
    hashing, counted = _with_counts(rows.select(text), text, config)
    return PipelineModel([*hashing.stages, *_fit_weights(written(counted, "counts"))])


def with_features(model: PipelineModel, df: DataFrame) -> DataFrame:
    # A selector names each feature in the column's metadata, which would go into every file and plan.
    found = model.transform(df).drop("_words", "_counts", "_weights")
    return found.withColumn("_features", F.col("_features").alias("_features", metadata={"ml_attr": {}}))


def fit_imputer(train: DataFrame, column: str, regularization: float, config: ImputeConfig = ImputeConfig()) -> PipelineModel:
    """Logistic regression for one column on rows with features."""
    return _fit_classifier(train, column, regularization, config, index_labels(train, column))


def _fit_classifier(train: DataFrame, column: str, regularization: float, config: ImputeConfig, indexer: StringIndexerModel) -> PipelineModel:
    classifier = LogisticRegression(
        featuresCol="_features", labelCol="_label", probabilityCol="_probability", predictionCol="_prediction",
        rawPredictionCol="_raw", maxIter=config.max_iter, regParam=regularization)
    names = IndexToString(inputCol="_prediction", outputCol="label", labels=indexer.labels)
    return PipelineModel([classifier.fit(indexer.transform(train.select("_features", column))), names])


def _classified(classifier: PipelineModel, df: DataFrame) -> DataFrame:
    """Rows with features and ``label`` and ``confidence``, the classifier's probability of the label."""
    return classifier.transform(df).withColumn("confidence", F.array_max(vector_to_array("_probability"))).drop(
        "_probability", "_prediction", "_raw")


def predict_imputer(model: Imputer, df: DataFrame, min_confidence: float = rules.MIN_CONFIDENCE) -> DataFrame:
    """Rows with ``label``, ``confidence``, ``probability`` (what that confidence was worth on the validation part) and ``accepted``.

    ``df`` has the texts as ``_text``, or ``_features`` that were computed before.
    """
    rows = df if "_features" in df.columns else with_features(model.features, df)
    found = _classified(model.classifier, rows).withColumn("probability", calibrated(F.col("confidence"), model.worth))
    return found.select(*df.columns, "label", "confidence", "probability",
                        accepted(F.col("probability"), min_confidence).alias("accepted"))


def accepted(probability: Column, threshold: float) -> Column:
    return probability >= F.lit(threshold)


# ------------------------------------------------- selection and calibration
def candidate_figures(predictions: DataFrame, by: tuple[str, ...] = ("column", "candidate")) -> DataFrame:
    """Rows, accuracy and weighted F1 of each candidate, from its predictions (``actual``, ``label``): one aggregate for all."""
    pairs = predictions.where("actual IS NOT NULL").groupBy(*by, "actual", "label").agg(F.count(F.lit(1)).alias("n"))
    actual = pairs.groupBy(*by, F.col("actual").alias("name")).agg(
        F.sum("n").alias("there"), F.sum(F.when(F.col("actual") == F.col("label"), F.col("n")).otherwise(0)).alias("hit"))
    said = pairs.groupBy(*by, F.col("label").alias("name")).agg(F.sum("n").alias("said"))
    both = actual.join(said, [*by, "name"], "left")
    f1 = F.col("there") * 2 * F.col("hit") / (F.col("there") + F.coalesce("said", F.lit(0)))
    return both.groupBy(*by).agg(F.sum("there").alias("rows"), (F.sum("hit") / F.sum("there")).alias("accuracy"),
                                 (F.sum(f1) / F.sum("there")).alias("f1"))


def best_candidates(figures: DataFrame) -> DataFrame:
    """The candidate of each column with the highest weighted F1; ties go to the smaller one."""
    return figures.groupBy("column").agg(F.max_by(F.struct("candidate", "rows", "accuracy", "f1"), F.struct("f1", -F.col("candidate"))).alias("best")) \
        .select("column", "best.*")


def reliability(predictions: DataFrame, bins: int, by: tuple[str, ...] = ("column", "candidate")) -> DataFrame:
    """How often predictions are right, by bins of their confidence: rows, hits and mean confidence."""
    place = F.least(F.floor(F.col("confidence") * bins), F.lit(bins - 1)).cast("int")
    return predictions.where("actual IS NOT NULL AND confidence IS NOT NULL").groupBy(*by, place.alias("bin")).agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(F.col("actual") == F.col("label")).alias("hits"), F.avg("confidence").alias("confidence"))


def worth_of(counts: dict[int, tuple[int, int, float]], bins: int) -> tuple[float | None, ...]:
    """Probability of each bin from (rows, hits, mean confidence): hits with the confidence as one more row, and never falling.

    Neighbouring bins that would fall are pooled. At most ``bins`` numbers are handled.
    """
    pools: list[list] = []
    for bin_ in sorted(counts):
        rows, hits, mean = counts[bin_]
        pools.append([[bin_], rows + 1, hits + mean])
        while len(pools) > 1 and pools[-2][2] / pools[-2][1] > pools[-1][2] / pools[-1][1]:
            names, rows, hits = pools.pop()
            pools[-1] = [pools[-1][0] + names, pools[-1][1] + rows, pools[-1][2] + hits]
    found = {bin_: hits / rows for names, rows, hits in pools for bin_ in names}
    return tuple(found.get(b) for b in range(bins))


def calibrated(confidence: Column, worth: tuple[float | None, ...]) -> Column:
    """The probability of a confidence's bin; the confidence itself where the validation part had no such row."""
    table = F.array(*[F.lit(w).cast("double") for w in worth])
    place = F.least(F.floor(confidence * len(worth)), F.lit(len(worth) - 1)).cast("int")
    return F.when(confidence.isNotNull(), F.coalesce(F.get(table, place), confidence))


def classification_metrics(predictions: DataFrame, column: str, labels: list[str]) -> dict[str, float]:
    """Accuracy and weighted F1 of predicted against true labels."""
    known = predictions.where(F.col(column).isin(*labels)).select(F.col(column).alias("actual"), "label")
    row = candidate_figures(known.withColumn("all", F.lit(0)), ("all",)).first()
    return {name: row[name] if row else 0.0 for name in ("accuracy", "f1")}


# ------------------------------------------------------------ stored models
_ABOUT = "worth array<double>, metrics map<string,double>"


def save_imputer(model: Imputer, path: str) -> None:
    """Store a model; the file that says what it is comes last."""
    model.features.write().overwrite().save(f"{path}/features")
    model.classifier.write().overwrite().save(f"{path}/classifier")
    spark = SparkSession.active()
    spark.createDataFrame([(list(model.worth), model.metrics)], _ABOUT).coalesce(1).write.mode("overwrite").json(
        f"{path}/about", ignoreNullFields=False)


def read_imputer(spark: SparkSession, path: str) -> Imputer | None:
    """The stored model, or None if there is none at the path."""
    try:
        about = spark.read.schema(_ABOUT).json(f"{path}/about").first()
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None
    return Imputer(PipelineModel.load(f"{path}/features"), PipelineModel.load(f"{path}/classifier"), tuple(about["worth"]), about["metrics"])


def validated_fits(complete: DataFrame, columns: Iterable[str], key: str, config: ImputeConfig = ImputeConfig(),
                   ) -> tuple[PipelineModel, dict[tuple[str, float], PipelineModel], DataFrame]:
    """The shared features, a classifier for every column and candidate, and their stored predictions of the validation parts.

    Predictions: ``column``, ``candidate``, ``key``, ``actual``, ``label``, ``confidence``. Labels that the training part lacks
    are not judged. Texts are tokenised and weighted once for all columns; each column has its own stratified split, marked on
    narrow rows, and one written table holds features and all marks.
    """
    columns = list(columns)
    text = model_text(F.col("title"), F.col("description"), rules.NO_TEXT)
    rows = complete.select(F.col(key).alias("_key"), *[F.col(c).cast("string").alias(c) for c in columns], text.alias("_text"))
    hashing, counted = _with_counts(rows.withColumn("_row", F.monotonically_increasing_id()), "_text", config)
    rows = written(counted, "training")
    weights = _fit_weights(rows)
    features, split = PipelineModel([*hashing.stages, *weights]), with_features(PipelineModel(weights), rows)
    for column in columns:
        marked = stratified_split(rows.select("_row", "_key", column), column, "_key", config.validation_share, config.seed, f"_valid_{column}")
        split = split.join(marked.select("_row", f"_valid_{column}"), "_row")
    split = written(split, "training-split")
    parts = {}
    for column in columns:
        valid = F.col(f"_valid_{column}")
        train, check = split.where(~valid), split.where(valid)
        indexer = index_labels(train, column)
        parts[column] = train, indexer, indexer.transform(check.select("_key", column, "_features"))  # drops labels unknown to it
    runs = [(column, candidate) for column in parts for candidate in config.candidates]

    def fit(run: tuple[str, float]) -> PipelineModel:
        train, indexer, _ = parts[run[0]]
        return _fit_classifier(train, *run, config, indexer)

    # The driver holds the optimizer's state of each fit that runs, so few run at once.
    with ThreadPool(config.fits_at_once) as pool:
        fits = dict(zip(runs, pool.map(inheritable_thread_target(complete.sparkSession)(fit), runs, chunksize=1), strict=True))
    found = [_classified(fits[column, candidate], parts[column][2]).select(
        F.lit(column).alias("column"), F.lit(candidate).alias("candidate"), F.col("_key").cast("string").alias("key"),
        F.col(column).alias("actual"), "label", "confidence") for column, candidate in runs]
    return features, fits, written(reduce(DataFrame.unionByName, found), "validation")


def train_columns(complete: DataFrame, columns: Iterable[str], key: str, config: ImputeConfig = ImputeConfig()) -> dict[str, Imputer]:
    """For each column the candidate that predicts its validation part best, calibrated there."""
    features, fits, predictions = validated_fits(complete, columns, key, config)
    # Both tables have a row for each column and candidate, and bin.
    best = {r["column"]: r for r in best_candidates(candidate_figures(predictions)).collect()}
    bins: dict[tuple[str, float], dict[int, tuple[int, int, float]]] = {}
    for r in reliability(predictions, config.bins).collect():
        bins.setdefault((r["column"], r["candidate"]), {})[r["bin"]] = (r["rows"], r["hits"], r["confidence"])
    found = {}
    for column in dict.fromkeys(c for c, _ in fits):
        row = best.get(column)
        candidate = row["candidate"] if row else config.candidates[0]
        metrics = {"accuracy": row["accuracy"], "f1": row["f1"]} if row else {}
        found[column] = Imputer(features, fits[column, candidate], worth_of(bins.get((column, candidate), {}), config.bins), metrics)
    return found


def train_column(complete: DataFrame, column: str, key: str, config: ImputeConfig = ImputeConfig()) -> tuple[Imputer, dict[str, float]]:
    """Model of one column with its figures; stored below ``models_dir`` if that is set."""
    model = train_columns(complete, [column], key, config)[column]
    if config.models_dir:
        save_imputer(model, f"{config.models_dir}/{column}")
    return model, model.metrics


def impute_columns(models: dict[str, Imputer], df: DataFrame, config: ImputeConfig) -> DataFrame:
    """Rows with each column set to its accepted prediction, NULL where there is none.

    Needs only the row itself. Models that were trained together share their features, which are computed once.
    """
    if not models:
        return df
    columns, text = df.columns, model_text(F.col("title"), F.col("description"), rules.NO_TEXT)
    rows, last = df.withColumn("_text", text), None
    for column, model in models.items():
        if last is None or model.features.uid != last:
            rows, last = with_features(model.features, rows.drop("_features")), model.features.uid
        rows = predict_imputer(model, rows.drop(column), config.min_confidence).withColumn(
            column, F.when(F.col("accepted"), F.col("label"))).drop("label", "confidence", "probability", "accepted")
    return rows.select(*columns)


def impute_column(model: Imputer, df: DataFrame, column: str, config: ImputeConfig) -> DataFrame:
    """Rows with ``column`` set to the accepted prediction, NULL where there is none."""
    return impute_columns({column: model}, df, config)


# -------------------------------------------------------------- rule targets
def _rule_text(wanted: Column | None) -> Column:
    """The text of an offer; with a condition NULL where that does not hold, which no rule reads."""
    text = offer_text(F.col("title"), F.col("description"))
    return text if wanted is None else F.when(wanted, text)


def impute_skills(df: DataFrame, out: str = "extracted_skills", wanted: Column | None = None) -> DataFrame:
    """Skills by rules, NULL where none is found or ``wanted`` does not hold."""
    texts = df.withColumn("_offer_text", _rule_text(wanted)).drop(out)
    found = with_skills(texts, "_offer_text", "_skills")
    return found.withColumn(out, F.when(F.size("_skills") > 0, F.col("_skills"))).drop("_offer_text", "_skills")


def impute_salary(df: DataFrame, wanted: Column | None = None) -> DataFrame:
    """Minimum and maximum salary by rules, NULL where ``wanted`` does not hold."""
    texts = df.withColumn("_offer_text", _rule_text(wanted)).drop("extracted_salary_min", "extracted_salary_max")
    found = with_salary(texts, "_offer_text", "_salary")
    return found.withColumns({
        "extracted_salary_min": F.col("_salary")["min_salary"],
        "extracted_salary_max": F.col("_salary")["max_salary"],
    }).drop("_offer_text", "_salary")


def fill_missing(df: DataFrame, predictions: DataFrame, key: str) -> DataFrame:
    """Predictions written where a column is NULL; filled cells never change, and no row of ``df`` is repeated.

    Of several predictions for a key the largest row counts.
    """
    columns = [c for c in predictions.columns if c != key and c in df.columns]
    single = last_per_key(predictions.select(key, *columns), [key], [F.col(c) for c in columns])
    renamed = single.select(F.col(key).alias("_key"), *[F.col(c).alias(f"_new_{c}") for c in columns])
    joined = df.join(renamed, F.col(key) == F.col("_key"), "left")
    return joined.select(*[
        F.coalesce(F.col(c), F.col(f"_new_{c}")).alias(c) if c in columns else F.col(c) for c in df.columns])


# --------------------------------------------------------------------- jobs
def run_full_imputation(df: DataFrame, key: str, config: ImputeConfig = ImputeConfig(),
                        csv_path: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Analyse, split, impute every incomplete column, fill and report: (filled rows, fill report)."""
    figures = {r["column"]: r for r in stats.completeness(df, config.targets).collect()}  # one row per column
    complete, incomplete = split_complete(df, config.targets)
    complete_rows = max((r["complete_rows"] for r in figures.values()), default=0)
    lacking = [c for c in figures if figures[c]["null_count"] > 0]
    # Predictions stay beside the row they are made for, so offers that repeat are filled each and nothing is joined.
    predicted, columns = incomplete.withColumns({f"_given_{c}": F.col(c) for c in figures}), []
    if complete_rows >= config.min_complete_rows:
        columns += [c for c in config.ml_targets if c in lacking]
        if columns:
            predicted = impute_columns(train_columns(complete, columns, key, config), predicted, config)
    # The rules read the texts of rows that lack what they find.
    if "extracted_skills" in lacking:
        wanted = F.col("_given_extracted_skills").isNull()
        predicted, columns = impute_skills(predicted, wanted=wanted), [*columns, "extracted_skills"]
    salaries = [c for c in ("extracted_salary_min", "extracted_salary_max") if c in lacking]
    if salaries:
        wanted = reduce(Column.__or__, [F.col(f"_given_{c}").isNull() for c in salaries])
        predicted, columns = impute_salary(predicted, wanted), [*columns, *salaries]
    filled = df
    if columns:
        # Written once: the report and every later use read the predictions instead of scoring again.
        done = predicted.select(*[
            (F.coalesce(f"_given_{c}", c) if c in columns else F.col(f"_given_{c}" if c in figures else c)).alias(c)
            for c in df.columns])
        filled = written(complete.unionByName(done), "filled")
    report = stats.fill_report(df, filled, config.targets)
    if csv_path:
        write_enriched_csv(filled, csv_path)
    return filled, report


def snapshot_training_csv(df: DataFrame, path: str) -> None:
    """Keep the training extract as CSV."""
    write_enriched_csv(df, path)


def _model_runs(config: ImputeConfig) -> Runs:
    return Runs(config.models_dir, "columns array<string>, complete_rows long")


def train_job(offers: DataFrame, enriched: DataFrame, config: ImputeConfig, snapshot: str | None = None) -> bool:
    """Train a model per classified column and publish them as one run; False without enough complete rows.

    The run is committed when all models are stored: until then, and if it fails, the models of the run before are used.
    """
    extract = read_offers_with_enrichment(offers, enriched)
    if snapshot:
        snapshot_training_csv(extract, snapshot)
    # Written once for the count and all models.
    complete = written(split_complete(extract, config.targets)[0], "complete")
    rows = complete.count()
    if rows < config.min_complete_rows:
        return False

    def write(folder: str) -> dict:
        for column, model in train_columns(complete, config.ml_targets, "id", config).items():
            save_imputer(model, f"{folder}/{column}")
        return {"columns": list(config.ml_targets), "complete_rows": rows}

    _model_runs(config).publish(offers.sparkSession, write)
    return True


def published_models(spark: SparkSession, config: ImputeConfig) -> dict[str, Imputer]:
    """The models of the newest committed run; none if there is no run."""
    runs = _model_runs(config)
    newest = runs.newest(spark)
    return {} if newest is None else {c: read_imputer(spark, f"{runs.folder(newest['number'])}/{c}") for c in newest["columns"]}


def predict_job(offers: DataFrame, enriched: DataFrame, config: ImputeConfig, as_of: str) -> DataFrame:
    """The enrichments after predicting all rows without a sector."""
    extract = not_yet_enriched(read_offers_with_enrichment(offers, enriched))
    # Rule-based columns are recomputed for these rows, whatever they held before.
    predicted = impute_columns(published_models(offers.sparkSession, config), impute_salary(impute_skills(extract)), config)
    return patch_enrichment(enriched, predicted, as_of)


def full_job(offers: DataFrame, enriched: DataFrame, config: ImputeConfig, as_of: str, path: str | None = None) -> DataFrame | None:
    """Train, then predict; None if there was not enough to train on.

    With a ``path`` the enrichments are published there as a run, which counts once it is written as a whole, and read back.
    """
    if not train_job(offers, enriched, config):
        return None
    result = predict_job(offers, enriched, config, as_of)
    if path is None:
        return result
    spark, runs = offers.sparkSession, Runs(path, "rows long")

    def write(folder: str) -> dict:
        result.write.mode("overwrite").parquet(folder)
        return {"rows": spark.read.schema(result.schema).parquet(folder).count()}

    return spark.read.schema(result.schema).parquet(runs.folder(runs.publish(spark, write)))


def published_rows(spark: SparkSession, path: str, schema) -> DataFrame | None:
    """The newest published enrichments, or None."""
    runs = Runs(path, "rows long")
    newest = runs.newest(spark)
    return None if newest is None else spark.read.schema(schema).parquet(runs.folder(newest["number"]))
