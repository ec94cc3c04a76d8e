"""Churn and upgrade models, model comparison, calibration, segmentation and labels (Spark ML)."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import AFTSurvivalRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from constituent360.functions.dates import day
from constituent360.functions.numbers import count_if
from constituent360.operators.calibration import calibrated, isotonic_blocks
from constituent360.operators.evaluation import auc, point_metrics
from constituent360.operators.features import CHURN_FEATURES, UPGRADE_FEATURES, churn_features, upgrade_features
from constituent360.operators.recommend import best_path, churn_tier
from constituent360.operators.totals import previous_values, quantiles
from constituent360.session import cut_lineage

_HASHES = 1 << 52
#: Models that are fitted at a time, and the rows that are worth a task of their own in training.
FITS, TASK_ROWS = 5, 20000
UPGRADE_TARGETS = ("to_sustainer", "sustainer_increase", "to_major")


@dataclass(frozen=True)
class TreeParams:
    trees: int = 100
    depth: int = 6
    step: float = 0.1
    seed: int = 42
    weight_col: str | None = None


UPGRADE_PARAMS = TreeParams(depth=5)


def _hash_column(seed: int, key: str) -> Column:
    """A number in [0, 2^52) that depends only on the key and the seed."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(_HASHES))


def split(df: DataFrame, key: str, share: float = 0.8, stratify: str | None = None, seed: int = 42):
    """(train, validation) by a hash of the key, cut at the exact quantile of the hashes, of each class when
    stratified; a null class is a class. Every row is in one of the two."""
    hashed = df.withColumn("_h", _hash_column(seed, key))
    if stratify is None:
        cut = quantiles(hashed, "_h", [share]).first()["q0"]
        parted = hashed.withColumn("_first", F.coalesce(F.col("_h") <= F.lit(cut), F.lit(False)))
    else:
        cuts = quantiles(hashed, "_h", [share], [stratify]).withColumnsRenamed({stratify: "_class", "q0": "_cut"})
        parted = hashed.join(cuts, F.col(stratify).eqNullSafe(F.col("_class"))).withColumn("_first", F.col("_h") <= F.col("_cut"))
    own = df.columns
    return parted.where("_first").select(own), parted.where(~F.col("_first")).select(own)


def time_split(df: DataFrame, ts: str, share: float = 0.8):
    """(earlier, later): the first share of rows by time, rows of the cut moment included."""
    axis = df.withColumn("_t", F.unix_date(F.col(ts).cast("date")))
    cut = quantiles(axis, "_t", [share]).first()["q0"]
    return axis.where(F.col("_t") <= cut).drop("_t"), axis.where(F.col("_t") > cut).drop("_t")


def with_class_weight(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight positives by (1 - p) / p, where p is their share."""
    row = df.agg(F.avg(F.col(label).cast("double")).alias("p")).first()
    p = row["p"]
    weight = (1 - p) / p if p else 1.0
    return df.withColumn(name, F.when(F.col(label).cast("int") == 1, weight).otherwise(1.0))


def dealt(rows: DataFrame, key: str) -> DataFrame:
    """Rows in even parts by a hash of the key, at most as many as there are cores. A written table may be read by a task or two, and
    training, which makes one pass for every level of every tree, would keep to those; few rows are better off in one task."""
    cores = rows.sparkSession.sparkContext.defaultParallelism
    parts = max(1, min(cores, -(-rows.count() // TASK_ROWS)))
    return rows.repartition(parts, F.xxhash64(key)).sortWithinPartitions(key)


def concurrently(tasks: Sequence[Callable]) -> list:
    """The results of functions that each run jobs one after the other, some of them at a time: one model alone leaves most cores idle."""
    with ThreadPoolExecutor(FITS) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(t)) for t in tasks]]


def _pipeline(features: Sequence[str], classifier) -> Pipeline:
    return Pipeline(
        stages=[
            VectorAssembler(inputCols=list(features), outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="_features", withMean=True, withStd=True),
            classifier,
        ]
    )


def gbt(label: str, params: TreeParams) -> GBTClassifier:
    model = GBTClassifier(
        featuresCol="_features", labelCol=label, predictionCol="_prediction", maxIter=params.trees,
        maxDepth=params.depth, stepSize=params.step, seed=params.seed,
    ).setProbabilityCol("_probability").setRawPredictionCol("_margin")
    return model.setWeightCol(params.weight_col) if params.weight_col else model


def _scored(model: PipelineModel, df: DataFrame, name: str) -> DataFrame:
    helper = ("_raw", "_features", "_margin", "_probability", "_prediction")
    return model.transform(df).withColumn(name, vector_to_array("_probability")[1]).drop(*helper)


def validation_metrics(scored: DataFrame, score: str, label: str) -> DataFrame:
    """(measure, value) rows: auc, precision, recall and f1 at 0.5."""
    out = None
    for df in (
        auc(scored, score, label).select(F.col("auc_roc").alias("auc")),
        point_metrics(scored, score, label).select("precision", "recall", "f1"),
    ):
        part = df.unpivot([], df.columns, "measure", "value")
        out = part if out is None else out.unionByName(part)
    return out


def train_churn(df: DataFrame, label: str, as_of, params: TreeParams = TreeParams()):
    """(model, validation metrics): stratified 80/20 split, scaling, gradient-boosted trees."""
    labels = df.select("constituent_id", F.col(label).cast("double").alias("label"))
    rows = cut_lineage(churn_features(df, as_of).join(labels, "constituent_id"))
    train, valid = split(rows, "constituent_id", 0.8, "label", params.seed)
    model = _pipeline(CHURN_FEATURES, gbt("label", params)).fit(dealt(train, "constituent_id"))
    return model, validation_metrics(_scored(model, valid, "churn_score"), "churn_score", "label")


def predict_churn(model: PipelineModel, df: DataFrame, as_of) -> DataFrame:
    scored = _scored(model, churn_features(df, as_of), "churn_score")
    return scored.select(
        "constituent_id", "churn_score", churn_tier(F.col("churn_score")).alias("churn_tier"),
        day(as_of).alias("prediction_date"),
    )


def feature_importance(model: PipelineModel, features: Sequence[str]) -> DataFrame:
    """(feature, importance), most important first: one row per model input."""
    weights = model.stages[-1].featureImportances.toArray()
    from pyspark.sql import SparkSession

    rows = [(name, float(w)) for name, w in zip(features, weights)]
    spark = SparkSession.getActiveSession()
    return spark.createDataFrame(rows, "feature string, importance double").orderBy(F.col("importance").desc(), "feature")


def train_upgrade(df: DataFrame, as_of, targets: Sequence[str] = UPGRADE_TARGETS, params: TreeParams = UPGRADE_PARAMS):
    """({target: model}, metrics): one model per target over the same written features."""
    labels = df.select("constituent_id", *[F.col(t).cast("double").alias(t) for t in targets])
    rows = cut_lineage(upgrade_features(df, as_of).join(labels, "constituent_id"))
    train, valid = split(rows, "constituent_id", 0.8, None, params.seed)
    train = dealt(train, "constituent_id")
    fits = [lambda target=target: _pipeline(UPGRADE_FEATURES, gbt(target, params)).fit(train) for target in targets]
    models, metrics = dict(zip(targets, concurrently(fits))), None
    for target in targets:
        part = validation_metrics(_scored(models[target], valid, "_s"), "_s", target).withColumn("target", F.lit(target))
        metrics = part if metrics is None else metrics.unionByName(part)
    return models, metrics


def predict_upgrade(models: dict[str, PipelineModel], df: DataFrame, as_of) -> DataFrame:
    out = upgrade_features(df, as_of)
    for target, model in models.items():
        out = _scored(model, out, f"{target}_score")
    names = [f"{t}_score" for t in models]
    return best_path(out.select("constituent_id", *names), list(models))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def classifiers(label: str, params: TreeParams = TreeParams()) -> dict:
    common = dict(featuresCol="_features", labelCol=label, probabilityCol="_probability",
                  rawPredictionCol="_margin", predictionCol="_prediction")
    return {
        "logistic_regression": LogisticRegression(maxIter=100, **common),
        "random_forest": RandomForestClassifier(numTrees=params.trees, maxDepth=params.depth, seed=params.seed, **common),
        "gradient_boosting": gbt(label, params),
    }


def compare_models(df: DataFrame, features: Sequence[str], label: str, key: str, models: dict, folds: int = 5, seed: int = 42) -> DataFrame:
    """(model, mean_auc, std_auc) over folds. Several models are fitted at a time, and all fold scores of
    all models are measured in one pass."""
    rows = cut_lineage(df.withColumn("_fold", F.pmod(_hash_column(seed, key), F.lit(folds))))
    spread, scored = dealt(rows, key), None
    trials = [(name, fold) for name in models for fold in range(folds)]
    fits = [lambda name=name, fold=fold: _pipeline(features, models[name].copy()).fit(spread.where(F.col("_fold") != fold)) for name, fold in trials]
    for (name, fold), model in zip(trials, concurrently(fits)):
        part = _scored(model, rows.where(F.col("_fold") == fold), "_s").select(
            F.lit(name).alias("model"), "_fold", "_s", F.col(label).alias("_y")
        )
        scored = part if scored is None else scored.unionByName(part)
    per_fold = auc(scored, "_s", "_y", ["model", "_fold"])
    return per_fold.groupBy("model").agg(
        F.avg("auc_roc").alias("mean_auc"), F.stddev_pop("auc_roc").alias("std_auc")
    ).orderBy(F.col("mean_auc").desc())


def cross_validate(df, features, label, key, folds: int = 5, params: TreeParams = TreeParams()) -> DataFrame:
    return compare_models(df, features, label, key, {"gradient_boosting": gbt(label, params)}, folds, params.seed)


@dataclass(frozen=True)
class Fold:
    """Train on days up to ``train_to``, test on days after ``after`` up to ``test_to``."""

    fold: int
    train_to: dt.date
    after: dt.date
    test_to: dt.date

    def train(self, ts: str) -> Column:
        return F.col(ts).cast("date") <= F.lit(self.train_to)

    def test(self, ts: str) -> Column:
        return (F.col(ts).cast("date") > F.lit(self.after)) & (F.col(ts).cast("date") <= F.lit(self.test_to))


def time_folds(df: DataFrame, ts: str, folds: int = 5, gap: int = 90) -> list[Fold]:
    """Rolling origins at equal shares of the rows by time. A fold is tested on the days up to the next origin and trained on
    days that lie ``gap`` or more before its own: labels that look ``gap`` days ahead are then known at the origin. Rows
    without a time are in no fold; no rows give no folds."""
    days = df.select(F.unix_date(F.col(ts).cast("date")).alias("_t"))
    cuts = quantiles(days, "_t", [k / (folds + 1) for k in range(1, folds + 2)]).first()
    if cuts is None or cuts["q0"] is None:
        return []
    at = [dt.date(1970, 1, 1) + dt.timedelta(days=int(cuts[f"q{k}"] // 1)) for k in range(folds + 1)]
    return [Fold(k + 1, at[k] - dt.timedelta(days=gap), at[k], at[k + 1]) for k in range(folds)]


def cross_validate_in_time(
    df: DataFrame, features: Sequence[str], label: str, ts: str, classifier=None, folds: int = 5, gap: int = 90
) -> DataFrame:
    """One row per fold: fold, train_rows, train_to (its last day), test_rows, test_from, test_to, auc. Each model is fitted on the
    past of its origin only and all folds are measured in one pass. The area is null where a fold has no rows to train on
    or tests one class only; rows without a label are left out."""
    spark = df.sparkSession
    rows = cut_lineage(df.select(*features, F.col(label).cast("double").alias("_y"), F.col(ts).cast("date").alias("_t")).where("_y IS NOT NULL"))
    plan = time_folds(rows, "_t", folds, gap)
    sizes, boxes = [], []
    for f in plan:
        found = {
            "train_rows": count_if(f.train("_t")), "train_to": F.max(F.when(f.train("_t"), F.col("_t"))), "test_rows": count_if(f.test("_t")),
            "test_from": F.min(F.when(f.test("_t"), F.col("_t"))), "test_to": F.max(F.when(f.test("_t"), F.col("_t"))),
        }
        sizes += [c.alias(f"{name}{f.fold}") for name, c in found.items()]
        boxes.append(F.struct(F.lit(f.fold).alias("fold"), *[F.col(f"{name}{f.fold}").alias(name) for name in found]))
    empty = "fold int, train_rows long, train_to date, test_rows long, test_from date, test_to date"
    table = cut_lineage(rows.agg(*sizes).select(F.inline(F.array(*boxes)))) if plan else spark.createDataFrame([], empty)
    trained = {r["fold"] for r in table.where("train_rows > 0 AND test_rows > 0").select("fold").collect()}
    scored = spark.createDataFrame([], "fold int, _s double, _y double")
    for f in plan:
        if f.fold in trained:
            model = _pipeline(features, classifier or gbt("_y", TreeParams())).fit(rows.where(f.train("_t")))
            part = _scored(model, rows.where(f.test("_t")), "_s")
            scored = scored.unionByName(part.select(F.lit(f.fold).alias("fold"), "_s", "_y"))
    areas = auc(scored, "_s", "_y", ["fold"]).select("fold", F.col("auc_roc").alias("auc"))
    return table.join(areas, "fold", "left")


def calibrate(scored: DataFrame, score: str, label: str):
    """Isotonic calibration fitted on scored rows; returns (blocks of the fit, rows with ``calibrated``)."""
    blocks = isotonic_blocks(scored, score, label)
    return blocks, calibrated(blocks, scored, score)


def segment_kmeans(df: DataFrame, columns: Sequence[str], k: int = 5, seed: int = 42) -> DataFrame:
    """Donor segments from standardised columns."""
    model = Pipeline(
        stages=[
            VectorAssembler(inputCols=list(columns), outputCol="_raw"),
            StandardScaler(inputCol="_raw", outputCol="_features", withMean=True, withStd=True),
            KMeans(featuresCol="_features", predictionCol="segment", k=k, seed=seed),
        ]
    ).fit(df)
    return model.transform(df).drop("_raw", "_features")


def survival_fit(df: DataFrame, columns: Sequence[str], duration: str, event: str):
    """Time-to-churn regression with censoring; a duration under a day counts as a day, so that every row is in."""
    assembled = VectorAssembler(inputCols=list(columns), outputCol="_features").transform(
        df.withColumns({"_d": F.greatest(F.col(duration).cast("double"), F.lit(1.0)), "_e": F.col(event).cast("double")})
    )
    model = AFTSurvivalRegression(featuresCol="_features", labelCol="_d", censorCol="_e", predictionCol="expected_duration").fit(assembled)
    return model, model.transform(assembled).drop("_features", "_d", "_e")


def uplift_scores(
    df: DataFrame, key: str, features: Sequence[str], treatment: str, label: str, params: TreeParams = TreeParams()
) -> DataFrame:
    """A model with the treatment as a feature; uplift is the score with it less the score without. The rows are split in two
    by a hash of the key, and each half is scored by the model of the other."""
    rows = cut_lineage(
        df.withColumns(
            {
                "_treated": F.col(treatment).cast("double"), "_label": F.col(label).cast("double"),
                "_half": F.pmod(_hash_column(params.seed, key), F.lit(2)),
            }
        )
    )
    out = None
    for half in (0, 1):
        model = _pipeline([*features, "_treated"], gbt("_label", params)).fit(rows.where(F.col("_half") != half))
        with_it = _scored(model, rows.where(F.col("_half") == half).withColumn("_treated", F.lit(1.0)), "_with")
        both = _scored(model, with_it.withColumn("_treated", F.lit(0.0)), "_without")
        part = both.withColumn("uplift", F.col("_with") - F.col("_without"))
        out = part if out is None else out.unionByName(part)
    return out.drop("_treated", "_label", "_half", "_with", "_without")


def third_failures(payments: DataFrame) -> DataFrame:
    """(constituent_id, failed_on): dates on which a third payment in a row failed. Payments need
    constituent_id, payment_date, payment_id and failed."""
    rows = payments.select(
        "constituent_id", "payment_date", F.struct("payment_date", "payment_id").alias("_at"),
        F.col("failed").cast("int").alias("failed"),
    )
    seen = previous_values(rows, ["constituent_id"], "_at", "failed", ["before", "before2"])
    return seen.where((F.col("failed") == 1) & (F.col("before") == 1) & (F.col("before2") == 1)).select(
        "constituent_id", F.col("payment_date").alias("failed_on")
    )


def churn_labels(donations: DataFrame, changes: DataFrame, payments: DataFrame, cutoff: dt.date, horizon_days: int = 90) -> DataFrame:
    """Who churns within the horizon after the cutoff. A sustainer does by cancelling or by three failed
    payments in a row; a one-time giver by letting thirteen months pass since the last gift."""
    end = cutoff + dt.timedelta(days=horizon_days)
    date = F.col("donation_date")
    done = donations.where(F.col("donation_status") == "completed")
    givers = done.groupBy("constituent_id").agg(
        F.max(F.when(date <= cutoff, date)).alias("last_gift"),
        F.min(F.when(date > cutoff, date)).alias("next_gift"),
        (count_if((date <= cutoff) & (F.col("donation_type") == "recurring")) > 0).alias("is_sustainer"),
    ).where(F.col("last_gift").isNotNull())
    window = lambda c: (F.col(c) > cutoff) & (F.col(c) <= end)
    left = changes.where((F.col("change_type") == "cancelled") & window("change_date")).select("constituent_id")
    failed = third_failures(payments.where(F.col("payment_date") <= end)).where(window("failed_on")).select("constituent_id")
    gone = left.unionByName(failed).distinct().withColumn("_gone", F.lit(True))
    due = F.add_months("last_gift", 13)
    silent = (due <= end) & (F.col("next_gift").isNull() | (F.col("next_gift") > due))
    churned = F.when(F.col("is_sustainer"), F.coalesce("_gone", F.lit(False))).otherwise(silent)
    return givers.join(gone, "constituent_id", "left").select("constituent_id", "is_sustainer", churned.cast("int").alias("churned"))
