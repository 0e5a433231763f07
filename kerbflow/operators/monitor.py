"""Monitoring of jobs and metrics as DataFrame queries.

`job_runs`: job, state, started_at, ended_at, due_at. `samples`: metric, series, ts, value.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kerbflow.functions.timefns import bucket, lit_like, micros, seconds_between
from kerbflow.operators.sequence import ROWS_PER_SLICE, cut_hot_keys, neighbour


def run_summary(job_runs: DataFrame, as_of: datetime, span: timedelta = timedelta(hours=24)) -> DataFrame:
    """Per job: successes, failures, last success, its age and the mean duration of successes."""
    ok = F.col("state") == "success"
    took = (micros(F.col("ended_at")) - micros(F.col("started_at"))) / F.lit(1_000_000)
    recent = job_runs.where(F.col("due_at") > lit_like(job_runs, "due_at", as_of - span))
    return recent.groupBy("job").agg(
        F.count_if(ok).alias("successes"),
        F.count_if(F.col("state") == "failed").alias("failures"),
        F.max(F.when(ok, F.col("ended_at"))).alias("last_success"),
        F.avg(F.when(ok, took)).alias("mean_seconds"),
    ).withColumn("seconds_since_success", seconds_between(
        F.col("last_success"), lit_like(job_runs, "ended_at", as_of)))


def recent_failures(job_runs: DataFrame, as_of: datetime, span: timedelta = timedelta(hours=1)) -> DataFrame:
    """Failed runs that ended within the span."""
    return job_runs.where(
        (F.col("state") == "failed") & (F.col("ended_at") > lit_like(job_runs, "ended_at", as_of - span))
    ).agg(F.count(F.lit(1)).alias("value"))


def seconds_since_success(job_runs: DataFrame, as_of: datetime, job: str | None = None) -> DataFrame:
    """Age of the last success, of one job or per job."""
    good = job_runs.where(F.col("state") == "success")
    age = seconds_between(F.max("ended_at"), lit_like(job_runs, "ended_at", as_of)).alias("value")
    return good.where(F.col("job") == job).agg(age) if job else good.groupBy("job").agg(age)


def in_range(samples: DataFrame, as_of: datetime, span: timedelta) -> DataFrame:
    """Samples in the half-open range (as_of - span, as_of]."""
    return samples.where(
        (F.col("ts") > lit_like(samples, "ts", as_of - span)) & (F.col("ts") <= lit_like(samples, "ts", as_of)))


def last_over_time(samples: DataFrame, as_of: datetime, span: timedelta, by: list[str]) -> DataFrame:
    """Newest sample of each series within the range."""
    return in_range(samples, as_of, span).groupBy(*by).agg(
        F.max("ts").alias("ts"), F.max_by("value", F.struct("ts", "value")).alias("value"))


def gauge_age(samples: DataFrame, as_of: datetime, span: timedelta, by: list[str]) -> DataFrame:
    """Seconds between the evaluation and the time held by the newest gauge, overall or per label."""
    last = last_over_time(samples, as_of, span, ["metric", "series"])
    now = micros(F.lit(as_of.strftime("%Y-%m-%d %H:%M:%S.%f")).cast("timestamp")) / F.lit(1_000_000)
    return last.groupBy(*by).agg((now - F.max("value")).alias("age_seconds"))


def counter_increase(samples: DataFrame, as_of: datetime, span: timedelta, by: list[str],
                     series: DataFrame | None = None, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Growth of counters within the range. A fall is a restart from zero. Known series without samples give zero."""
    recent = in_range(samples, as_of, span)
    cut = cut_hot_keys(recent.select(*by, "ts", "value"), by, ["ts", "value"], rows_per_slice)
    steps = neighbour(cut, ["ts", "value"], {"value": "__before"}).rows
    grown = F.when(F.col("value") < F.col("__before"), F.col("value")).otherwise(F.col("value") - F.col("__before"))
    total = steps.groupBy(*by).agg(F.coalesce(F.sum(grown), F.lit(0.0)).alias("increase"))
    if series is None:
        return total
    return series.select(*by).distinct().join(total, by, "left").withColumn(
        "increase", F.coalesce("increase", F.lit(0.0)))


def live_targets(samples: DataFrame, as_of: datetime, span: timedelta) -> DataFrame:
    """How many targets are up, from the newest 0/1 sample of each."""
    return last_over_time(samples, as_of, span, ["metric", "series"]).agg(F.sum("value").alias("value"))


def band(value: Column, steps: list[tuple[float, str]], base: str) -> Column:
    """Colour of a value: the last step whose lower bound it reaches."""
    out = F.lit(base)
    for bound, colour in sorted(steps):
        out = F.when(value >= F.lit(float(bound)), F.lit(colour)).otherwise(out)
    return F.when(value.isNotNull(), out)


def event_latency(events: DataFrame, changed: str, detected: str, by: list[str] | None = None,
                  exact: bool = True) -> DataFrame:
    """Median and 95th percentile of seconds from source time to write time.

    Latencies are whole seconds, so the exact percentile keeps one counter per distinct second, not per row.
    """
    delay = seconds_between(F.col(changed), F.col(detected))
    pct = (lambda p: F.percentile(delay, p)) if exact else (lambda p: F.percentile_approx(delay, p, 10_000))
    aggs = [F.count(F.lit(1)).alias("events"), pct(0.5).alias("median_seconds"), pct(0.95).alias("p95_seconds")]
    return events.groupBy(*by).agg(*aggs) if by else events.agg(*aggs)


def evaluate_rules(readings: DataFrame, rules: DataFrame, start: datetime, end: datetime, every: int) -> DataFrame:
    """State of every rule at every tick: `normal`, `pending` (breached, not long enough), `firing` or `no_data`.

    `readings` holds (rule, ts, value); the newest value in a tick counts. `rules` holds (rule, threshold,
    hold_seconds, alert_on_no_data, severity). A rule has one row per tick, so its group is bounded by the time span
    however many readings it has.
    """
    dtype = readings.schema["ts"].dataType.simpleString()
    lo, hi = lit_like(readings, "ts", start), lit_like(readings, "ts", end)
    ticked = readings.where((F.col("ts") >= lo) & (F.col("ts") < hi)).groupBy(
        "rule", bucket(F.col("ts"), every, dtype).alias("tick")).agg(
        F.max_by("value", F.struct("ts", "value")).alias("value"))
    grid = rules.withColumn(
        "tick", F.explode(F.sequence(lo, hi - F.expr(f"INTERVAL {every} SECONDS"), F.expr(f"INTERVAL {every} SECONDS"))))
    at_tick = grid.join(ticked, ["rule", "tick"], "left")
    bad = F.when(F.col("value").isNull(), F.col("alert_on_no_data")).otherwise(F.col("value") > F.col("threshold"))
    upto = Window.partitionBy("rule").orderBy("tick").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # The breach began at the first bad tick after the last good one.
    flagged = at_tick.withColumn("breached", bad).withColumn(
        "__good", F.max(F.when(~F.col("breached"), F.col("tick"))).over(upto))
    island = Window.partitionBy("rule", "__good").orderBy("tick").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    timed = flagged.withColumn("__began", F.min(F.when(F.col("breached"), F.col("tick"))).over(island))
    held = seconds_between(F.col("__began"), F.col("tick"))
    return timed.select(
        "rule", "severity", "tick", "value", "breached",
        F.when(~F.col("breached"), F.when(F.col("value").isNull(), "no_data").otherwise("normal"))
        .when(held >= F.col("hold_seconds"), "firing").otherwise("pending").alias("state"))
