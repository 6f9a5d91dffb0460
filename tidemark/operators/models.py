"""Training, scoring, monitoring and promotion of models."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import GBTRegressor, LinearRegression
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.series import regression_metrics

# fixed values: monitoring and promotion rules
R2_DROP = 1.05
RMSE_RISE = 1.2
R2_GAIN = 0.01


def is_train(ids: Sequence[str], percent: int = 80) -> Column:
    """Stable split by a digest of the row's identity, whatever the partitioning and the engine."""
    digest = F.md5(F.concat_ws("|", *[F.col(i).cast("string") for i in ids]))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long") % 100 < percent


def scale_with(df: DataFrame, train: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Columns minus the training mean, over the training deviation (1 where that is 0)."""
    stats = train.agg(
        F.struct(*[x for c in columns for x in (F.avg(c).alias(f"mean_{c}"), F.stddev_pop(c).alias(f"sd_{c}"))])
    ).scalar()
    with_stats = df.withColumn("_s", stats)

    def scaled(c: str) -> Column:
        sd = F.col(f"_s.sd_{c}")
        return (F.col(c) - F.col(f"_s.mean_{c}")) / F.when(sd == 0, 1.0).otherwise(sd)

    return with_stats.withColumns({c: scaled(c) for c in columns}).drop("_s")


def train_regressor(
    train: DataFrame, features: Sequence[str], target: str, kind: str = "boosted", rounds: int = 20, seed: int = 42
) -> PipelineModel:
    """Scaled features into boosted trees or a linear model.

    Boosting stops early once a tenth of the rows, chosen by a hash and not trained on, gains nothing.
    """
    if kind == "boosted":
        held = "_held_out"
        train = train.withColumn(held, F.pmod(F.xxhash64(*features, target), F.lit(10)) == 0)
        if train.where(held).isEmpty() or train.where(~F.col(held)).isEmpty():
            train, held = train.drop(held), None
        learner = GBTRegressor(featuresCol="scaled", labelCol=target, maxIter=rounds, seed=seed)
        if held:
            learner = learner.setValidationIndicatorCol(held)
    elif kind == "linear":
        learner = LinearRegression(featuresCol="scaled", labelCol=target)
    else:
        raise ValueError(f"kind must be 'boosted' or 'linear', not {kind!r}")
    assembled = VectorAssembler(inputCols=list(features), outputCol="assembled")
    scaler = StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True)
    return Pipeline(stages=[assembled, scaler, learner]).fit(train)


def train_classifier(train: DataFrame, vector: str, label: str, seed: int = 42) -> PipelineModel:
    learner = DecisionTreeClassifier(featuresCol=vector, labelCol=label, seed=seed)
    return Pipeline(stages=[learner]).fit(train)


def score(model: PipelineModel, df: DataFrame, name: str = "prediction") -> DataFrame:
    """Input columns with the model's prediction."""
    return model.transform(df).select(*df.columns, F.col("prediction").alias(name))


def accuracy(df: DataFrame, label: str, prediction: str = "prediction") -> DataFrame:
    return df.agg(F.avg((F.col(label) == F.col(prediction)).cast("int")).alias("accuracy"))


def batch_metrics(scored: DataFrame, keys: Sequence[str], actual: str, predicted: str = "prediction") -> DataFrame:
    """(keys, r2, rmse, observations) of every batch."""
    out = regression_metrics(scored, keys, F.col(actual), F.col(predicted))
    return out.select(*keys, "r2", "rmse", "observations")


def best_and_latest(metrics: DataFrame, version: str = "version", runtime: str = "runtime") -> DataFrame:
    """(version, ref_r2, ref_rmse, latest): best values ever and the last metrics row, one aggregate.

    At the latest row the running best is the best of all rows, so no window is needed.
    """
    row = F.max(F.struct(runtime, *[c for c in metrics.columns if c not in (version, runtime)]))
    return metrics.groupBy(version).agg(
        F.max("r2").alias("ref_r2"), F.min("rmse").alias("ref_rmse"), row.alias("latest")
    )


def merge_best(parts: DataFrame, version: str = "version") -> DataFrame:
    """Combine ``best_and_latest`` rows of several parts of the history."""
    return parts.groupBy(version).agg(
        F.max("ref_r2").alias("ref_r2"), F.min("ref_rmse").alias("ref_rmse"), F.max("latest").alias("latest")
    )


def judge(best: DataFrame, version: str = "version") -> DataFrame:
    """Latest metrics against the best: retrain 0/1 and a message."""
    flat = best.select(version, "ref_r2", "ref_rmse", "latest.*")
    retrain = (F.col("ref_r2") > F.col("r2") * R2_DROP) | (F.col("rmse") > F.col("ref_rmse") * RMSE_RISE)
    flagged = flat.withColumn("retrain", F.coalesce(retrain, F.lit(False)).cast("int"))
    message = F.when(F.col("retrain") == 1, "Need retrain").otherwise("No need retrain")
    return flagged.withColumn("message", message)


def judge_each(metrics: DataFrame, before: DataFrame, version: str = "version", runtime: str = "runtime") -> DataFrame:
    """Every metrics row against the best of its version up to that row.

    ``before`` has the best values of earlier rows, one ``best_and_latest`` row per version.
    """
    upto = Window.partitionBy(version).orderBy(runtime)
    known = before.select(version, F.col("ref_r2").alias("_r2"), F.col("ref_rmse").alias("_rmse"))
    joined = metrics.join(known, version, "left")
    rest = [c for c in metrics.columns if c != version]
    each = joined.select(
        version,
        F.greatest(F.max("r2").over(upto), F.col("_r2")).alias("ref_r2"),
        F.least(F.min("rmse").over(upto), F.col("_rmse")).alias("ref_rmse"),
        F.struct(*rest).alias("latest"),
    )
    return judge(each, version)


def drift_flags(metrics: DataFrame, version: str = "version", runtime: str = "runtime") -> DataFrame:
    """Latest metrics of each version against its best so far."""
    return judge(best_and_latest(metrics, version, runtime), version)


def compare_models(new: PipelineModel, old: PipelineModel, holdout: DataFrame, target: str) -> DataFrame:
    """One row: both models' r2 and rmse on the same held-out rows and the promotion flag."""
    both = score(old, score(new, holdout, "new_prediction"), "old_prediction")
    y = F.col(target)
    sums = both.agg(
        F.avg(F.pow(y - F.col("new_prediction"), 2)).alias("new_mse"),
        F.avg(F.pow(y - F.col("old_prediction"), 2)).alias("old_mse"),
        F.var_pop(y).alias("spread"),
    )
    scored = sums.select(
        (1 - F.try_divide("new_mse", "spread")).alias("new_r2"),
        (1 - F.try_divide("old_mse", "spread")).alias("old_r2"),
        F.sqrt("new_mse").alias("new_rmse"),
        F.sqrt("old_mse").alias("old_rmse"),
    )
    return scored.withColumn("promotion_flag", (F.col("new_r2") > F.col("old_r2") + R2_GAIN).cast("int"))


def promote(model: PipelineModel, comparison: DataFrame, path: str) -> bool:
    """Save the model as the production one when the comparison says so."""
    if comparison.first()["promotion_flag"] != 1:
        return False
    model.write().overwrite().save(path)
    return True


def response(df: DataFrame, features: Sequence[str], weights: Sequence[float], intercept: float) -> Column:
    """Linear response: weighted features plus intercept."""
    total = F.lit(float(intercept))
    for name, weight in zip(features, weights, strict=True):
        total = total + F.col(name) * weight
    return total
