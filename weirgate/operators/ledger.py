"""Folds over the delivery ledger: append-only rows, one per disposition of a delivery."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Which disposition wins at equal times, lowest first.
RANKED = ("registered", "incomplete", "duplicate", "superseded", "unreadable")
ACQUIRED = ("registered", "duplicate", "superseded")
DEFECTIVE = ("unreadable", "incomplete")

OBJECTS = "array<struct<name:string,role:string,uri:string,bytes:bigint,sha256:string>>"
COLUMNS = (
    "delivery_id string", "feed_id string", "delivery_key string", "received_at timestamp", "recorded_at timestamp", "driver string", "driver_run_id string", "completeness_mode string",
    "asserted_record_count bigint", "disposition string", "supersedes string", "content_hash string", "batch_id string", "size_bytes bigint", "object_uris array<string>",
    f"objects {OBJECTS}", "manifest_ref string", "notes string",
)
SCHEMA = ", ".join(COLUMNS)


def rank(disposition: str = "disposition") -> Column:
    return F.array_position(F.array(*map(F.lit, RANKED)), F.col(disposition))


def latest(ledger: DataFrame) -> DataFrame:
    """The row with the greatest (recorded_at, rank) of each delivery: a grouped maximum, so repeated rows change nothing."""
    row = F.struct(*(F.col(c) for c in ledger.columns))
    return ledger.groupBy("delivery_id").agg(F.max_by(row, F.struct("recorded_at", rank())).alias("r")).select("r.*")


def registered(ledger: DataFrame) -> DataFrame:
    return latest(ledger).where("disposition = 'registered'")


def registered_in_order(ledger: DataFrame) -> DataFrame:
    return registered(ledger).orderBy("received_at", "delivery_id")


def watermarks(ledger: DataFrame) -> DataFrame:
    """Per feed: latest receipt of a registered delivery, latest activity."""
    return latest(ledger).groupBy("feed_id").agg(F.max(F.when(F.col("disposition") == "registered", F.col("received_at"))).alias("last_registered_received_at"), F.max("recorded_at").alias("last_ledger_activity_at"))


def current(ledger: DataFrame) -> DataFrame:
    return latest(ledger).orderBy("feed_id", "delivery_key")


def _inventory(rows: DataFrame) -> DataFrame:
    return rows.select("feed_id", F.explode("objects").alias("o")).select("feed_id", F.col("o.name").alias("name"), F.col("o.bytes").alias("bytes")).distinct()


def acquired(ledger: DataFrame) -> DataFrame:
    """(feed_id, name, bytes) of every object that is in our hands."""
    return _inventory(latest(ledger).where(F.col("disposition").isin(*ACQUIRED)))


def defective(ledger: DataFrame) -> DataFrame:
    """(feed_id, name, bytes) of single objects last seen defective; manifests are looked at again each run."""
    return _inventory(latest(ledger).where(F.col("disposition").isin(*DEFECTIVE) & (F.col("completeness_mode") != "manifest")))


def for_batch(ledger: DataFrame, batch_id: str) -> DataFrame:
    shown = ("delivery_id", "feed_id", "delivery_key", "disposition", "driver", "driver_run_id", "received_at", "recorded_at", "object_uris", "objects", "notes")
    return ledger.where(F.col("batch_id") == batch_id).select(*shown).orderBy("recorded_at")


def live_duplicates(ledger: DataFrame) -> DataFrame:
    """Registered deliveries of a (feed, key) that has more than one: a window count, no self-join."""
    n = F.count(F.lit(1)).over(Window.partitionBy("feed_id", "delivery_key"))
    return registered(ledger).withColumn("_n", n).where("_n > 1").drop("_n")


def reconciliation(ledger: DataFrame) -> DataFrame:
    """Live duplicates to be superseded: all but the newest (received_at, delivery_id) of each (feed, key)."""
    newest = Window.partitionBy("feed_id", "delivery_key").orderBy(F.desc("received_at"), F.desc("delivery_id"))
    return registered(ledger).withColumn("_place", F.row_number().over(newest)).where("_place > 1").drop("_place").orderBy("delivery_key", "delivery_id")


def superseding_rows(rows: DataFrame, at: Column) -> DataFrame:
    """Accretion rows: identity copied, disposition and time new."""
    return rows.withColumns({"disposition": F.lit("superseded"), "recorded_at": at})


def supersession(ledger: DataFrame) -> DataFrame:
    """For each registered delivery the one that it supersedes: the latest earlier
    registered delivery of its (feed, key), if its content differs."""
    before = Window.partitionBy("feed_id", "delivery_key").orderBy("received_at", "delivery_id")
    rows = registered(ledger).withColumns({"_hash": F.lag("content_hash").over(before), "_id": F.lag("delivery_id").over(before)})
    return rows.select("feed_id", "delivery_key", "delivery_id", F.when(F.col("_hash").isNotNull() & (F.col("_hash") != F.col("content_hash")), F.col("_id")).alias("supersedes"))


def registrations(requests: DataFrame) -> DataFrame:
    """Dispositions of a set of requests (feed_id, batch_id, received_at, delivery_id): the
    first of each (feed, batch) wins its claim, the others are duplicates."""
    first = Window.partitionBy("feed_id", "batch_id").orderBy("received_at", "delivery_id")
    return requests.withColumn("disposition", F.when(F.row_number().over(first) == 1, F.lit("registered")).otherwise(F.lit("duplicate")))


def changed_nondeliveries(ledger: DataFrame, observed: DataFrame) -> DataFrame:
    """Observed non-deliveries (feed_id, delivery_key, disposition, objects) that are
    news: the latest row of their key has another disposition or inventory."""
    inventory = lambda c: F.array_sort(F.transform(c, lambda o: F.struct(o["name"].alias("name"), o["bytes"].alias("bytes"))))
    last = ledger.groupBy("feed_id", "delivery_key").agg(F.max_by(F.struct(F.col("disposition").alias("d"), inventory("objects").alias("i")), F.struct("recorded_at", "delivery_id")).alias("_last"))
    rows = observed.join(last, ["feed_id", "delivery_key"], "left")
    same = (F.col("_last.d") == F.col("disposition")) & (F.col("_last.i") == inventory("objects"))
    return rows.where(~F.coalesce(same, F.lit(False))).select(*observed.columns)
