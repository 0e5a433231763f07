"""Features, popular stations, training set, forecasts and their evaluation (D)."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from kerbflow.functions.convert import clip
from kerbflow.functions.timefns import calendar_features
from kerbflow.operators.lagfeatures import exact_lag, exact_lead, last_per_bucket
from kerbflow.plans import forecast as fc
from kerbflow.plans.features import complete, popular_stations, station_features
from kerbflow.plans.marts import store_bucketed
from kerbflow.session import scratch_dir, store
from workload import views as v
from workload.registry import query
from workload.views import BUCKET, EVENTS_AS_OF, HORIZON, TZ, sql_bucket, sql_round

MONTH = timedelta(days=31)
POPULAR_N = 100

POPULAR = f"""
    SELECT *, row_number() OVER (ORDER BY bikes_moved DESC, station_uid) AS popularity_rank
    FROM (SELECT station_uid, CAST(sum(abs(bikes_change_1)) AS BIGINT) AS bikes_moved, count(*) AS observations
          FROM features WHERE feature_ts >= TIMESTAMP '2024-01-31' - INTERVAL 31 DAY AND bikes_change_1 IS NOT NULL
          GROUP BY 1 ORDER BY bikes_moved DESC, station_uid LIMIT {POPULAR_N})"""
LABELLED = """
    SELECT f.* FROM features f SEMI JOIN popular p ON p.station_uid = f.station_uid
    WHERE feature_ts >= TIMESTAMP '2024-01-31' - INTERVAL 31 DAY AND bikes_available_at_target IS NOT NULL
      AND fill_ratio IS NOT NULL AND bikes_change_1 IS NOT NULL AND bikes_change_2 IS NOT NULL"""
TRAINING = """
    SELECT *, epoch_us(feature_ts) > (SELECT max(epoch_us(feature_ts)) - CAST(round(0.2 *
        ((max(epoch_us(feature_ts)) - min(epoch_us(feature_ts))) / 1000000)) AS BIGINT) * 1000000 FROM labelled) AS is_holdout
    FROM labelled"""
SETS = {"popular": POPULAR, "labelled": LABELLED, "training": TRAINING}


def popular(spark, sf):
    return popular_stations(v.features(spark, sf), POPULAR_N, EVENTS_AS_OF, MONTH)


def training(spark, sf):
    return fc.training_set(v.features(spark, sf), popular(spark, sf), 31, 0.2, EVENTS_AS_OF)


@query("d2_last_per_bucket", """
    SELECT station_uid, b AS bucket_ts, bikes_available, docks_available FROM binned""")
def d2(spark, sf):
    facts = v.fact(spark, sf).where("is_in_service")
    return last_per_bucket(facts, "station_uid", "source_updated_at", BUCKET).select(
        "station_uid", "bucket_ts", "bikes_available", "docks_available")


@query("d3_exact_lag_lead", """
    SELECT station_uid, feature_ts, bikes_available - bikes_change_1 AS lag_1, bikes_available - bikes_change_2 AS lag_2,
           bikes_available_at_target AS lead_2 FROM features""")
def d3(spark, sf):
    """Exact offsets; a missing bucket gives null."""
    base = last_per_bucket(v.fact(spark, sf).where("is_in_service"), "station_uid", "source_updated_at", BUCKET)
    at = ("station_uid", "bucket_ts", F.col("bikes_available"))
    return base.select("station_uid", F.col("bucket_ts").alias("feature_ts"), exact_lag(*at, BUCKET).alias("lag_1"),
                       exact_lag(*at, 2 * BUCKET).alias("lag_2"), exact_lead(*at, HORIZON).alias("lead_2"))


@query("d6_calendar_features", """
    SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%H') AS hour_of_day,
           CAST(isodow(ts + INTERVAL 8 HOUR) AS VARCHAR) AS day_of_week, isodow(ts + INTERVAL 8 HOUR) >= 6 AS is_weekend
    FROM events""")
def d6(spark, sf):
    return v.table(spark, sf, "events").select(
        "event_id", *[c.alias(n) for n, c in calendar_features(F.col("ts"), TZ).items()])


@query("d7_station_features", "SELECT * FROM features")
def d7(spark, sf):
    """Totals, fill ratio, trends, calendar and label of every station and bucket."""
    return v.features(spark, sf)


@query("d7_station_features_bucketed", "SELECT * FROM features")
def d7_bucketed(spark, sf):
    """The same from facts that lie bucketed by station: nothing is exchanged."""
    path = scratch_dir(spark, "bucketed-fact")
    fact = store_bucketed(v.fact(spark, sf), "fact_" + path.rsplit("-", 1)[1], path, buckets=8)
    return station_features(fact, TZ, BUCKET, HORIZON)


@query("d7_station_features_lookback", "SELECT * FROM features WHERE feature_ts >= TIMESTAMP '2024-01-10'")
def d7_recent(spark, sf):
    """The incremental form: reads four more buckets than it returns, and equals the full build there."""
    return station_features(v.fact(spark, sf), TZ, BUCKET, HORIZON, since=datetime(2024, 1, 10))


@query("d8_popular_stations", "SELECT * FROM popular", **SETS)
def d8(spark, sf):
    return popular(spark, sf)


@query("d9_complete_rows", """
    SELECT station_uid, feature_ts FROM features
    WHERE fill_ratio IS NOT NULL AND bikes_change_1 IS NOT NULL AND bikes_change_2 IS NOT NULL""")
def d9(spark, sf):
    return complete(v.features(spark, sf)).select("station_uid", "feature_ts")


@query("d10_training_set", "SELECT * FROM training", **SETS)
def d10(spark, sf):
    return training(spark, sf)


@query("d11_readiness", """
    SELECT count(*) FILTER (WHERE NOT is_holdout) AS train_rows, count(*) FILTER (WHERE is_holdout) AS holdout_rows
    FROM training""", **SETS)
def d11(spark, sf):
    return fc.readiness(training(spark, sf))


@query("d12_train_and_evaluate", """
    SELECT CAST(31 AS BIGINT) AS training_days, count(*) FILTER (WHERE NOT is_holdout) AS train_rows,
           count(*) FILTER (WHERE is_holdout) AS holdout_rows, min(feature_ts) FILTER (WHERE is_holdout) AS holdout_from,
           avg(abs(bikes_available - bikes_available_at_target)) FILTER (WHERE is_holdout) AS mae_baseline,
           sqrt(avg(pow(bikes_available - bikes_available_at_target, 2)) FILTER (WHERE is_holdout)) AS rmse_baseline,
           true AS model_is_judged
    FROM training""", **SETS)
def d12(spark, sf):
    """Candidate, evaluation and final model; two records are appended and the latest is read back."""
    path = scratch_dir(spark, "evaluations")
    _, record = fc.train(training(spark, sf), 31, EVENTS_AS_OF, min_rows=100)
    record = store(record, "evaluation")
    fc.append_evaluation(record.withColumn("evaluated_at", F.col("evaluated_at") - F.expr("INTERVAL 1 DAY")), path)
    fc.append_evaluation(record, path)
    judged = (F.col("mae_model") >= 0) & (F.col("rmse_model") >= F.col("mae_model")) & (F.col("rmse_model") < 1000)
    return fc.latest_evaluation(spark.read.parquet(path)).select(
        "training_days", "train_rows", "holdout_rows", "holdout_from", "mae_baseline", "rmse_baseline", judged.alias("model_is_judged"))


@query("d14_clip", """
    SELECT station_uid, feature_ts,
           least(greatest(CAST(bikes_available + coalesce(bikes_change_2, 0) * 2 AS DOUBLE), 0), total_docks) AS clipped
    FROM features""")
def d14(spark, sf):
    raw = (F.col("bikes_available") + F.coalesce("bikes_change_2", F.lit(0)) * 2).cast("double")
    return v.features(spark, sf).select("station_uid", "feature_ts", clip(raw, F.col("total_docks")).alias("clipped"))


@query("d15_evaluate_persistence", """
    SELECT count(*) AS holdout_rows, min(feature_ts) AS holdout_from,
           avg(abs(bikes_available - bikes_available_at_target)) AS mae_model,
           avg(abs(bikes_available - bikes_available_at_target)) AS mae_baseline,
           sqrt(avg(pow(bikes_available - bikes_available_at_target, 2))) AS rmse_model,
           sqrt(avg(pow(bikes_available - bikes_available_at_target, 2))) AS rmse_baseline,
           CAST(0 AS DOUBLE) AS improvement_over_baseline
    FROM training WHERE is_holdout""", **SETS)
def d15(spark, sf):
    return fc.evaluate(fc.persistence(training(spark, sf).where("is_holdout")))


@query("d16_latest_evaluation", """
    SELECT b AS evaluated_at, count(*) AS n FROM binned GROUP BY 1 ORDER BY 1 DESC LIMIT 1""")
def d16(spark, sf):
    """Newest record of an evaluation history (one per bucket)."""
    base = last_per_bucket(v.fact(spark, sf).where("is_in_service"), "station_uid", "source_updated_at", BUCKET)
    return fc.latest_evaluation(base.groupBy(F.col("bucket_ts").alias("evaluated_at")).agg(F.count(F.lit(1)).alias("n")))


@query("d17_scoring_rows", """
    SELECT f.* FROM features f SEMI JOIN popular p ON p.station_uid = f.station_uid
    WHERE feature_ts >= TIMESTAMP '2024-01-31' - INTERVAL 31 DAY
      AND fill_ratio IS NOT NULL AND bikes_change_1 IS NOT NULL AND bikes_change_2 IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY f.station_uid ORDER BY feature_ts DESC) = 1""", **SETS)
def d17_rows(spark, sf):
    return fc.scoring_rows(v.features(spark, sf), popular(spark, sf), EVENTS_AS_OF, MONTH)


@query("d17_predict")
def d17(spark, sf):
    """Forecasts of the newest complete rows by a model trained on the labelled ones.

    Features serve the choice of stations, the training and the scoring, and the solver passes over its rows many times:
    each of these tables is written once.
    """
    features = store(v.features(spark, sf), "features")
    chosen = store(popular_stations(features, POPULAR_N, EVENTS_AS_OF, MONTH), "popular")
    model = fc.fit_forecaster(store(fc.training_set(features, chosen, 31, 0.2, EVENTS_AS_OF), "training-set"))
    return fc.predict(model, features, chosen, EVENTS_AS_OF, EVENTS_AS_OF, MONTH)


@query("d17_forecast_bounds", """
    SELECT f.station_uid, feature_ts, feature_ts + INTERVAL 12 HOUR AS forecast_for, bikes_available AS bikes_available_now, total_docks,
           TRUE AS within_docks, TRUE AS one_decimal, TIMESTAMP '2024-01-31' AS predicted_at
    FROM features f SEMI JOIN popular p ON p.station_uid = f.station_uid
    WHERE feature_ts >= TIMESTAMP '2024-01-31' - INTERVAL 31 DAY
      AND fill_ratio IS NOT NULL AND bikes_change_1 IS NOT NULL AND bikes_change_2 IS NOT NULL
    QUALIFY row_number() OVER (PARTITION BY f.station_uid ORDER BY feature_ts DESC) = 1""", **SETS)
def d17_bounds(spark, sf):
    """Of the same forecasts: for whom and when they are made, and that each lies between no bike and all docks."""
    made = d17(spark, sf)
    value = F.col("predicted_bikes_available")
    return made.select("station_uid", "feature_ts", "forecast_for", "bikes_available_now", "total_docks",
                       value.between(0, F.col("total_docks")).alias("within_docks"),
                       (F.abs(value * 10 - F.round(value * 10)) < 1e-9).alias("one_decimal"), "predicted_at")


def _accuracy(table: str, where: str = "") -> str:
    model = "avg(abs(predicted_bikes_available - bikes_available_at_target))"
    base = "avg(abs(bikes_available_now - bikes_available_at_target))"
    return f"""
    SELECT CAST(date_trunc('hour', forecast_for + INTERVAL 8 HOUR) AS TIMESTAMP) AS hour_local,
           CAST(forecast_for + INTERVAL 8 HOUR AS DATE) AS local_date, count(*) AS forecasts,
           count(DISTINCT station_uid) AS stations, {sql_round(model, 3)} AS mae_model, {sql_round(base, 3)} AS mae_baseline,
           {sql_round(f'1 - {model} / nullif({base}, 0)', 4)} AS improvement_over_baseline
    FROM {table} JOIN (SELECT station_uid, feature_ts, bikes_available_at_target FROM features
                       WHERE bikes_available_at_target IS NOT NULL) a USING (station_uid, feature_ts)
    {where} GROUP BY 1, 2"""


@query("d18_forecast_accuracy", _accuracy("trend_now"), trend_now="""
    SELECT t.*, f.bikes_available AS bikes_available_now FROM trend_forecasts t JOIN features f USING (station_uid, feature_ts)""")
def d18(spark, sf):
    """Trend forecasts against actuals and persistence."""
    now = v.features(spark, sf).select("station_uid", "feature_ts", F.col("bikes_available").alias("bikes_available_now"))
    made = v.trend_forecasts(spark, sf).join(now, ["station_uid", "feature_ts"])
    return fc.forecast_accuracy(made, v.features(spark, sf), TZ)


@query("d18_forecast_accuracy_lookback", _accuracy("forecasts", "WHERE forecast_for >= TIMESTAMP '2024-01-16 23:00:00' AND feature_ts >= TIMESTAMP '2024-01-16 21:00:00'"))
def d18_recent(spark, sf):
    since, actuals = fc.accuracy_since(EVENTS_AS_OF, timedelta(days=13, hours=12), timedelta(seconds=HORIZON))
    return fc.forecast_accuracy(v.forecasts(spark, sf), v.features(spark, sf), TZ, since, actuals)


@query("d19_persistence_forecast", "SELECT * FROM forecasts")
def d19(spark, sf):
    return v.forecasts(spark, sf)
