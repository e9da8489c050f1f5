"""Standing questions about runs, stages and quarantines."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAYS = 30
#: Alarm bounds.
QUARANTINE_RATE, ATTEMPTS = 0.05, 10


def _recent(at: Column | str, now: Column | None, days: int) -> Column:
    return (F.col(at) if isinstance(at, str) else at) >= (now if now is not None else F.current_timestamp()) - F.make_dt_interval(F.lit(days))


def duplicate_rate(ledger: DataFrame, now: Column | None = None, days: int = DAYS) -> DataFrame:
    d = F.col("disposition")
    both = F.count_if(d.isin("registered", "duplicate"))
    return ledger.where(_recent("recorded_at", now, days)).groupBy("feed_id").agg(
        F.count_if(d == "duplicate").alias("duplicates"), F.count_if(d == "registered").alias("registered"), (F.count_if(d == "duplicate").cast("double") / F.nullif(both, F.lit(0))).alias("duplicate_rate")
    )


def run_status(runs: DataFrame) -> DataFrame:
    """The latest transition of each (batch, stage)."""
    shown = ("batch_id", "pipeline", "feed_id", "attempt_id", "stage", "outcome", "started_at", "finished_at", "error_type", "error_message")
    return runs.groupBy("batch_id", "stage").agg(F.max_by(F.struct(*shown), F.struct("started_at", "finished_at", "attempt_id")).alias("r")).select("r.*")


def attempts_per_batch(runs: DataFrame) -> DataFrame:
    n = F.count_distinct("attempt_id")
    return runs.groupBy("batch_id", "pipeline", "feed_id").agg(n.alias("attempt_count"), (n > 1).alias("multiple_attempts"))


def stage_durations(runs: DataFrame, now: Column | None = None, days: int = DAYS, exact: bool = False) -> DataFrame:
    """Median and 95th percentile of successful transitions by stage, in milliseconds."""
    ms = F.unix_millis("finished_at") - F.unix_millis("started_at")
    of = (lambda p: F.percentile(ms, F.lit(p))) if exact else (lambda p: F.percentile_approx(ms, F.lit(p)))
    return runs.where(_recent("recorded_at", now, days) & (F.col("outcome") == "ok")).groupBy("stage").agg(of(0.5).alias("p50_ms"), of(0.95).alias("p95_ms"), F.count(F.lit(1)).alias("sample_count"))


def rerun_noop_rate(runs: DataFrame) -> DataFrame:
    """The share of attempts all of whose transitions were skipped by a guard and which appended nothing."""
    per = runs.groupBy("batch_id", "attempt_id").agg((F.bool_and(F.col("outcome") == "skipped-guard") & (F.sum(F.coalesce("facts_appended", F.lit(0))) == 0)).alias("noop"))
    n = F.count(F.lit(1))
    return per.agg(F.count_if("noop").alias("noop_attempts"), n.alias("total_attempts"), (F.count_if("noop").cast("double") / F.nullif(n, F.lit(0))).alias("noop_rate"))


def quarantine_reasons(tables: dict[str, DataFrame], now: Column | None = None, days: int = DAYS) -> DataFrame:
    """Refused rows by pipeline, feed, stage, day and reason, over one quarantine table a pipeline."""
    shown = [t.select(F.lit(p).alias("pipeline"), "feed_id", "check_stage", "quarantined_at", "reason_code") for p, t in sorted(tables.items())]
    rows = reduce(DataFrame.unionByName, shown).where(_recent("quarantined_at", now, days))
    return rows.groupBy("pipeline", "feed_id", "check_stage", F.to_date("quarantined_at").alias("day"), "reason_code").agg(F.count(F.lit(1)).alias("reason_count"))


def quarantine_rate(runs: DataFrame, hours: int = 1) -> DataFrame:
    """Refused over read rows by pipeline and tumbling window, with the alarm."""
    bad = F.sum(F.coalesce("pre_quarantined", F.lit(0)) + F.coalesce("post_quarantined", F.lit(0)))
    rate = bad / F.nullif(F.sum(F.coalesce("raw_count", F.lit(0))), F.lit(0))
    grouped = runs.groupBy("pipeline", F.window("finished_at", f"{hours} hours").alias("w")).agg(bad.alias("quarantined"), F.sum(F.coalesce("raw_count", F.lit(0))).alias("raw"), rate.alias("rate"))
    return grouped.select("pipeline", F.col("w.start").alias("window_start"), "quarantined", "raw", "rate", F.coalesce(F.col("rate") > QUARANTINE_RATE, F.lit(False)).alias("alarm"))


def attempt_alarms(runs: DataFrame, hours: int = 1) -> DataFrame:
    n = F.count_distinct("batch_id", "attempt_id")
    grouped = runs.groupBy("pipeline", F.window("started_at", f"{hours} hours").alias("w")).agg(n.alias("attempts"))
    return grouped.select("pipeline", F.col("w.start").alias("window_start"), "attempts", (F.col("attempts") > ATTEMPTS).alias("alarm"))


def transition_metrics(runs: DataFrame) -> DataFrame:
    """The ledger as (pipeline, stage, metric, value) rows: durations, counts that are set, failures."""
    ms = (F.unix_millis("finished_at") - F.unix_millis("started_at")).cast("long")
    counts = ("raw_count", "pre_quarantined", "post_quarantined", "facts_appended", "rows_merged")
    values = {"duration_ms": ms, "failed": F.when(F.col("outcome") == "failed", F.lit(1)).otherwise(F.lit(0))} | {c: F.col(c) for c in counts}
    pairs = [F.struct(F.lit(k).alias("metric"), v.cast("long").alias("value")) for k, v in values.items()]
    return runs.select("pipeline", "stage", F.explode(F.array(*pairs)).alias("m")).select("pipeline", "stage", "m.*").where("value is not null")


def feed_counts(ledger: DataFrame) -> DataFrame:
    return ledger.groupBy("feed_id", "disposition").agg(F.count(F.lit(1)).alias("rows"))
