import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from kerbflow.operators.lagfeatures import exact_lag
from kerbflow.plans import forecast as fc
from kerbflow.plans.features import complete, popular_stations, station_features

AS_OF = datetime(2026, 1, 12)


@pytest.fixture(scope="module")
def fact(spark):
    rnd, rows = random.Random(7), []
    for s in range(6):
        bikes = 10
        for i in range(48 * 11):
            bikes = max(0, min(20, bikes + rnd.choice([-2, -1, 0, 1, 2])))
            if rnd.random() > .05:  # a missed round
                rows.append((f"s{s}", datetime(2026, 1, 1) + timedelta(minutes=30 * i + rnd.randrange(29)), bikes, 20 - bikes, True))
    return spark.createDataFrame(rows, "station_uid string, source_updated_at timestamp, bikes_available long, docks_available long, is_in_service boolean")


@pytest.fixture(scope="module")
def features(fact):
    return station_features(fact, "Asia/Taipei").cache()


def test_gaps_give_null_and_not_an_older_row(spark):
    rows = spark.createDataFrame([("a", datetime(2026, 1, 1, 0, 0), 1), ("a", datetime(2026, 1, 1, 1, 0), 2), ("a", datetime(2026, 1, 1, 1, 30), 3)],
                                 "k string, t timestamp, v long")
    got = [r[0] for r in rows.select("t", exact_lag("k", "t", F.col("v"), 1800).alias("x")).orderBy("t").select("x").collect()]
    assert got == [None, None, 2]


def test_features(features):
    row = features.where("bikes_change_1 is not null and bikes_available_at_target is not null").first()
    assert row["total_docks"] == 20 and row["fill_ratio"] == row["bikes_available"] / 20
    assert row["target_ts"] - row["feature_ts"] == timedelta(hours=1)
    assert features.groupBy("station_uid", "feature_ts").count().where("count > 1").count() == 0
    sunday = features.where("feature_ts = '2026-01-03 18:00:00'").first()  # Sunday 02:00 in Taipei
    assert (sunday["hour_of_day"], sunday["day_of_week"], sunday["is_weekend"]) == ("02", "7", True)


def test_lookback_equals_full_build(fact, features):
    since = datetime(2026, 1, 9)
    part = station_features(fact, "Asia/Taipei", since=since)
    assert sorted(part.collect(), key=str) == sorted(features.where(F.col("feature_ts") >= F.lit(str(since)).cast("timestamp")).collect(), key=str)


def test_train_evaluate_predict(spark, features):
    popular = popular_stations(features, 4, AS_OF)
    assert [r["popularity_rank"] for r in popular.orderBy("popularity_rank").collect()] == [1, 2, 3, 4]
    data = fc.training_set(features, popular, 28, .2, AS_OF).cache()
    assert data.where("is_holdout").agg(F.min("feature_ts")).first()[0] > data.where("not is_holdout").agg(F.max("feature_ts")).first()[0]
    model, record = fc.train(data, 28, AS_OF, min_rows=100)
    row = record.first()
    assert 0 < row["mae_model"] < 5 and row["rmse_model"] >= row["mae_model"]
    assert row["improvement_over_baseline"] == pytest.approx(1 - row["mae_model"] / row["mae_baseline"])
    again, other = fc.train(data, 28, AS_OF, min_rows=100)
    assert other.first() == row
    made = fc.predict(model, features, popular, AS_OF, AS_OF, timedelta(hours=3))
    rows = made.collect()
    assert 0 < len(rows) <= 4 and all(0 <= r["predicted_bikes_available"] <= r["total_docks"] for r in rows)
    table = fc.add_forecasts(made, made.withColumn("predicted_bikes_available", F.lit(-1.0)), AS_OF)
    assert table.count() == len(rows) and table.where("predicted_bikes_available < 0").count() == 0
    unseen = complete(features).limit(5).withColumn("station_uid", F.lit("never seen"))
    assert fc.apply_model(model, unseen).where("predicted between 0 and 20").count() == 5


def test_too_little_data_is_not_trained_on(features):
    data = fc.training_set(features, popular_stations(features, 2, AS_OF), 28, .2, AS_OF)
    with pytest.raises(fc.NotReadyError):
        fc.check_ready(data, 10**6)


def test_persistence_has_no_improvement(features):
    data = fc.training_set(features, popular_stations(features, 4, AS_OF), 28, .2, AS_OF)
    assert fc.evaluate(fc.persistence(data)).first()["improvement_over_baseline"] == 0
