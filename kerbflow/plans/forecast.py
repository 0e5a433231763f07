"""One-horizon-ahead forecast: training set, linear model, evaluation, scoring and live accuracy."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kerbflow.functions.convert import clip, round_to
from kerbflow.functions.timefns import lit_like, local_hour, micros
from kerbflow.operators.dedupe import latest_per_key
from kerbflow.operators.merge import insert_new, new_rows
from kerbflow.session import store
from kerbflow.plans.features import complete

LABEL = "bikes_available_at_target"
CATEGORIES = ["station_uid", "hour_of_day", "day_of_week"]
NUMBERS = ["bikes_available", "docks_available", "total_docks", "fill_ratio", "bikes_change_1", "bikes_change_2"]
FORECAST_KEY = ["station_uid", "feature_ts"]


class NotReadyError(RuntimeError):
    """Too little labelled data to train on."""


def training_set(features: DataFrame, popular: DataFrame, days: int, holdout: float, as_of: datetime) -> DataFrame:
    """Labelled complete rows of popular stations in the span; the last share of the time span is the holdout."""
    labelled = complete(features.where(
        (F.col("feature_ts") >= lit_like(features, "feature_ts", as_of - timedelta(days=days)))
        & F.col(LABEL).isNotNull())).join(popular.select("station_uid"), "station_uid", "left_semi")
    us = micros(F.col("feature_ts"))
    back = F.round(F.lit(holdout) * ((F.max(us) - F.min(us)) / F.lit(1_000_000))).cast("long") * 1_000_000
    start = labelled.agg((F.max(us) - back).alias("start")).scalar()
    return labelled.withColumn("is_holdout", us > start)


def readiness(training: DataFrame) -> DataFrame:
    return training.agg(F.count_if(~F.col("is_holdout")).alias("train_rows"),
                        F.count_if(F.col("is_holdout")).alias("holdout_rows"))


def check_ready(training: DataFrame, min_rows: int = 1000) -> tuple[int, int]:
    """Row counts of both parts; raises when there is too little to train or nothing to evaluate on."""
    row = readiness(training).first()
    if row["train_rows"] < min_rows or row["holdout_rows"] == 0:
        raise NotReadyError(f"{row['train_rows']} training rows (need {min_rows}), {row['holdout_rows']} holdout rows")
    return row["train_rows"], row["holdout_rows"]


def fit_forecaster(training: DataFrame, l2: float = 1.0, rows: int | None = None) -> PipelineModel:
    """Linear regression with an L2 penalty. Unseen categories get a slot of their own instead of failing."""
    rows = rows or training.count()
    stages = [
        StringIndexer(inputCols=CATEGORIES, outputCols=[f"{c}_index" for c in CATEGORIES], handleInvalid="keep",
                      stringOrderType="alphabetAsc"),
        OneHotEncoder(inputCols=[f"{c}_index" for c in CATEGORIES], outputCols=[f"{c}_vector" for c in CATEGORIES],
                      handleInvalid="keep"),
        VectorAssembler(inputCols=[*NUMBERS, "weekend", *[f"{c}_vector" for c in CATEGORIES]], outputCol="inputs"),
        LinearRegression(featuresCol="inputs", labelCol="label", predictionCol="raw_prediction",
                         regParam=l2 / max(rows, 1), elasticNetParam=0.0, solver="auto"),
    ]
    return Pipeline(stages=stages).fit(_model_input(training).withColumn("label", F.col(LABEL).cast("double")))


def _model_input(df: DataFrame) -> DataFrame:
    return df.withColumn("weekend", F.col("is_weekend").cast("double"))


def apply_model(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Rows with the clipped prediction; evaluation and scoring share it."""
    scored = model.transform(_model_input(features))
    return scored.select(*features.columns, clip(F.col("raw_prediction"), F.col("total_docks")).alias("predicted"))


def persistence(features: DataFrame) -> DataFrame:
    """The baseline: the target will be as now."""
    return features.withColumn("predicted", F.col("bikes_available").cast("double"))


def persistence_forecast(features: DataFrame) -> DataFrame:
    """Baseline forecasts in the shape of the forecast table."""
    return features.select(
        "station_uid", "feature_ts", F.col("target_ts").alias("forecast_for"),
        F.col("bikes_available").alias("bikes_available_now"), "total_docks",
        F.col("bikes_available").cast("double").alias("predicted_bikes_available"))


def evaluate(predictions: DataFrame) -> DataFrame:
    """Error of the model and of persistence over holdout rows."""
    actual = F.col(LABEL)
    off, base = F.col("predicted") - actual, F.col("bikes_available") - actual
    return predictions.agg(
        F.count(F.lit(1)).alias("holdout_rows"), F.min("feature_ts").alias("holdout_from"),
        F.avg(F.abs(off)).alias("mae_model"), F.avg(F.abs(base)).alias("mae_baseline"),
        F.sqrt(F.avg(off * off)).alias("rmse_model"), F.sqrt(F.avg(base * base)).alias("rmse_baseline"),
    ).withColumn("improvement_over_baseline", 1 - F.try_divide("mae_model", "mae_baseline"))


def train(training: DataFrame, days: int, as_of: datetime, min_rows: int = 1000,
          l2: float = 1.0) -> tuple[PipelineModel, DataFrame]:
    """Candidate on the training part, evaluated on the holdout; then the final model on all rows.

    The solver passes over the rows many times, so the training set is written once and read from there.
    """
    training = store(training, "training-set")
    train_rows, holdout_rows = check_ready(training, min_rows)
    candidate = fit_forecaster(training.where(~F.col("is_holdout")), l2, train_rows)
    record = evaluate(apply_model(candidate, training.where(F.col("is_holdout")))).select(
        F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp").alias("evaluated_at"),
        F.lit(days).cast("long").alias("training_days"), F.lit(train_rows).cast("long").alias("train_rows"), "*")
    return fit_forecaster(training, l2, train_rows + holdout_rows), record


def append_evaluation(record: DataFrame, path: str) -> None:
    """Add a record to the evaluation table; earlier ones stay."""
    record.write.mode("append").parquet(path)


def latest_evaluation(evaluations: DataFrame) -> DataFrame:
    return evaluations.orderBy(F.col("evaluated_at").desc()).limit(1)


def scoring_rows(features: DataFrame, popular: DataFrame, as_of: datetime, max_age: timedelta) -> DataFrame:
    """Newest complete row of each popular station, unless it is too old to predict from."""
    recent = complete(features).where(F.col("feature_ts") >= lit_like(features, "feature_ts", as_of - max_age))
    return latest_per_key(recent.join(popular.select("station_uid"), "station_uid", "left_semi"),
                          ["station_uid"], ["feature_ts"])


def predict(model: PipelineModel, features: DataFrame, popular: DataFrame, as_of: datetime,
            trained_at: datetime, max_age: timedelta = timedelta(minutes=60)) -> DataFrame:
    """Forecast rows to add to the forecast table."""
    def stamp(value: datetime) -> Column:
        return F.lit(value.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp")
    return apply_model(model, scoring_rows(features, popular, as_of, max_age)).select(
        "station_uid", "feature_ts", F.col("target_ts").alias("forecast_for"),
        F.col("bikes_available").alias("bikes_available_now"), "total_docks",
        round_to(F.col("predicted"), 1).alias("predicted_bikes_available"),
        stamp(trained_at).alias("model_trained_at"), stamp(as_of).alias("predicted_at"))


def add_forecasts(table: DataFrame, fresh: DataFrame, as_of: datetime, whole: bool = True) -> DataFrame:
    """Insert-only merge: a forecast made once is never changed. Only the last day of the table is compared."""
    recent = F.col("forecast_for") >= lit_like(table, "forecast_for", as_of - timedelta(days=1))
    merge = insert_new if whole else new_rows
    return merge(table, fresh, FORECAST_KEY, target_filter=recent)


def accuracy_since(as_of: datetime, lookback: timedelta, horizon: timedelta) -> tuple[datetime, datetime]:
    """Start of the forecasts and of the actuals to compare: answers come one horizon late, plus slack."""
    forecasts = as_of - lookback - horizon - timedelta(hours=1)
    return forecasts.replace(minute=0, second=0, microsecond=0), forecasts - timedelta(hours=2)


def forecast_accuracy(forecasts: DataFrame, features: DataFrame, tz: str, since: datetime | None = None,
                      actuals_since: datetime | None = None) -> DataFrame:
    """Matured forecasts against what happened, per local hour of the target."""
    actuals = features.where(F.col(LABEL).isNotNull())
    if since is not None:
        forecasts = forecasts.where(F.col("forecast_for") >= lit_like(forecasts, "forecast_for", since))
    if actuals_since is not None:
        actuals = actuals.where(F.col("feature_ts") >= lit_like(actuals, "feature_ts", actuals_since))
    both = forecasts.join(actuals.select(*FORECAST_KEY, LABEL), FORECAST_KEY)
    model = F.avg(F.abs(F.col("predicted_bikes_available") - F.col(LABEL)))
    base = F.avg(F.abs(F.col("bikes_available_now") - F.col(LABEL)))
    per_hour = both.groupBy(local_hour(F.col("forecast_for"), tz).alias("hour_local")).agg(
        F.count(F.lit(1)).alias("forecasts"), F.count_distinct("station_uid").alias("stations"),
        model.alias("__model"), base.alias("__base"))
    return per_hour.select(
        "hour_local", F.to_date("hour_local").alias("local_date"), "forecasts", "stations",
        round_to(F.col("__model"), 3).alias("mae_model"), round_to(F.col("__base"), 3).alias("mae_baseline"),
        round_to(1 - F.try_divide("__model", "__base"), 4).alias("improvement_over_baseline"))
