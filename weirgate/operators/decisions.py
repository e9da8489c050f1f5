"""Verdicts about deliveries: completeness, candidates, budgets, expectations."""

from __future__ import annotations

import datetime
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions import text as X
from ..functions.casts import full_match
from ..session import durable

LOOKBACK_DAYS = 3
RUN_BYTES = 5 << 30


def manifest_verdicts(declared: DataFrame, observed: DataFrame, feed_id: Column | None = None) -> DataFrame:
    """Per manifest: verdict, reasons and asserted_record_count.

    ``declared`` has a row per listed file (manifest_id, feed_id, place, name, bytes,
    sha256, record_count), ``observed`` one per present object (feed_id, name, bytes,
    sha256).  ``feed_id`` is the feed that should have sent the manifest (its own by
    default).  Wrong feed, then repeated names, then digests that differ make a
    manifest defective; missing files or other sizes make it incomplete."""
    o = observed.select("feed_id", "name", F.col("bytes").alias("o_bytes"), F.col("sha256").alias("o_sha"))
    rows = declared.withColumn("_expected", feed_id if feed_id is not None else F.col("feed_id"))
    rows = rows.join(o, ["feed_id", "name"], "left")
    missing, size = F.col("o_bytes").isNull(), F.col("o_bytes") != F.col("bytes")
    sha = ~missing & ~size & F.col("o_sha").isNotNull() & (F.col("o_sha") != F.col("sha256"))
    fault = F.when(missing, F.concat("name", F.lit(" not present"))).when(size, F.concat("name", F.lit(" byte-size mismatch"))).when(sha, F.concat("name", F.lit(" sha256 mismatch")))
    found = rows.withColumns({"_fault": fault, "_sha": sha}).groupBy("manifest_id", "feed_id").agg(
        F.bool_and(F.col("feed_id").eqNullSafe(F.col("_expected"))).alias("own"),
        (F.count("name") > F.count_distinct("name")).alias("repeated"),
        F.bool_or("_sha").alias("digest"),
        F.count("_fault").alias("faults"),
        F.array_sort(F.collect_list(F.when(F.col("_fault").isNotNull(), F.struct("place", "_sha", "_fault")))).alias("told"),
        F.when(F.count(F.lit(1)) == F.count("record_count"), F.sum("record_count")).alias("asserted_record_count"),
    )
    spoken = F.filter("told", lambda t: t["_sha"] == F.col("digest"))
    reason = (
        F.when(~F.col("own"), F.lit("manifest feed_id does not match"))
        .when(F.col("repeated"), F.lit("duplicate file names"))
        .when(F.col("faults") > 0, F.array_join(F.transform(spoken, lambda t: t["_fault"]), "; "))
    )
    verdict = F.when(~F.col("own") | F.col("repeated") | F.col("digest"), F.lit("defective")).when(F.col("faults") > 0, F.lit("incomplete")).otherwise(F.lit("complete"))
    return found.select("manifest_id", "feed_id", verdict.alias("verdict"), reason.alias("reason"), "asserted_record_count")


def trailer_verdict(tail: Column, pattern: str, count_group: int | str | None = None) -> Column:
    """struct(verdict, asserted_record_count) from the last line of a tail that is not blank;
    the count is in a group of the pattern, given by its number or its name."""
    if isinstance(count_group, str):
        count_group = re.compile(pattern).groupindex[count_group]
    pattern = pattern.replace("(?P<", "(?<")  # the engine writes named groups so
    line = X.last_line(tail)
    met = F.coalesce(full_match(line, pattern), F.lit(False))
    if count_group is None:
        return F.struct(F.when(met, F.lit("complete")).otherwise(F.lit("incomplete")).alias("verdict"), F.lit(None).cast("long").alias("asserted_record_count"))
    told = F.regexp_extract(line, rf"\A(?:{pattern})\z", count_group)
    number = F.when(met & told.rlike(r"\A[0-9]+\z"), told.try_cast("bigint"))
    verdict = F.when(~met, F.lit("incomplete")).when(number.isNull(), F.lit("defective")).otherwise(F.lit("complete"))
    return F.struct(verdict.alias("verdict"), number.alias("asserted_record_count"))


def candidates(listing: DataFrame, seen: DataFrame | None, glob: str, now: Column | None = None, quiet_minutes: int | None = None, force: bool = False) -> DataFrame:
    """Listed objects to acquire, oldest first: clean names that match, not seen
    before at these bytes (unless forced), and quiet for long enough."""
    rows = listing.where(X.clean_name(F.col("name")) & X.matches_glob(F.col("name"), glob))
    if seen is not None and not force:
        keys = ["feed_id", "name", "bytes"] if "feed_id" in listing.columns else ["name", "bytes"]
        rows = rows.join(seen.select(*keys).distinct(), keys, "left_anti")
    if quiet_minutes is not None:
        rows = rows.where(quiet(F.col("mtime"), now if now is not None else F.current_timestamp(), quiet_minutes))
    return rows.select(*listing.columns).orderBy("mtime", "name")


def quiet(mtime: Column, now: Column, minutes: int) -> Column:
    return mtime <= now - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(minutes))


def within(at: Column, start: Column, end: Column) -> Column:
    """The half-open window from start to end."""
    return (at >= start) & (at < end)


def budget_prefix(rows: DataFrame, budget: int = RUN_BYTES, by: tuple[str, ...] = ("mtime", "name"), size: str = "bytes", partition: tuple[str, ...] = ()) -> DataFrame:
    """Rows in order until what came before exceeds the budget; the rest is carried over.

    One prefix per ``partition``.  Rows are cut into ranges, summed range by range and
    inside each, so that no task gathers a whole listing."""
    cut = durable(rows.repartitionByRange(*partition, *by).withColumn("_task", F.spark_partition_id()), "ranges")
    told = cut.groupBy(*partition, "_task").agg(F.sum(size).alias("_sum"))
    earlier = Window.partitionBy(*(partition or (F.lit(1),))).orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)  # as many rows as tasks
    offsets = told.select(*(F.col(c).alias(f"_of_{c}") for c in partition), F.col("_task").alias("_of"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*partition, "_task").orderBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    met = F.col("_task") == F.col("_of")
    for c in partition:
        met = met & F.col(c).eqNullSafe(F.col(f"_of_{c}"))
    before = F.coalesce("_inside", F.lit(0)) + F.col("_offset")
    return cut.withColumn("_inside", F.sum(size).over(inside)).join(offsets, met).where(before <= budget).select(*rows.columns)


def expected_on(rule: Column, day: Column) -> Column:
    """Whether a calendar rule (daily, weekdays, weekly:mon, monthly:15) asks for a delivery on a day."""
    dow = F.element_at(F.array(*map(F.lit, ("mon", "tue", "wed", "thu", "fri", "sat", "sun"))), F.weekday(day) + 1)
    arg = F.substring_index(rule, ":", -1)
    asked = (
        F.when(rule == "daily", F.lit(True))
        .when(rule == "weekdays", F.weekday(day) < 5)
        .when(rule.startswith("weekly:"), arg == dow)
        .when(rule.startswith("monthly:"), arg.try_cast("int") == F.dayofmonth(day))
    )
    return F.coalesce(asked, F.lit(False))


def deadline(day: Column, by: Column, zone: Column) -> Column:
    """The instant of a wall time on a day in a zone, daylight saving included."""
    return F.to_utc_timestamp(F.concat_ws(" ", day.cast("string"), by).cast("timestamp"), zone)


def overdue(feeds: DataFrame, received: DataFrame, now: Column, lookback: int = LOOKBACK_DAYS) -> DataFrame:
    """(feed_id, expected_date, expected_by) of expectations past their deadline with
    nothing received that day in the feed's zone.  ``feeds``: feed_id, expected, by,
    timezone; ``received``: feed_id, received_at.  Timestamps in a UTC session."""
    local = F.to_date(F.from_utc_timestamp(now, F.col("timezone")))
    days = feeds.withColumn("expected_date", F.explode(F.sequence(F.date_sub(local, lookback), local)))
    due = days.withColumn("expected_by", deadline(F.col("expected_date"), F.col("by"), F.col("timezone")))
    due = due.where(expected_on(F.col("expected"), F.col("expected_date")) & (F.col("expected_by") <= now))
    zones = feeds.select("feed_id", "timezone")
    came = received.join(zones, "feed_id").select("feed_id", F.to_date(F.from_utc_timestamp("received_at", F.col("timezone"))).alias("expected_date")).distinct()
    return due.join(came, ["feed_id", "expected_date"], "left_anti").select("feed_id", "expected_date", "expected_by")


def utc(at: datetime.datetime) -> Column:
    return F.lit(at.astimezone(datetime.UTC).replace(tzinfo=None).isoformat(sep=" ")).cast("timestamp")
