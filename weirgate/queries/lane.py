"""Queries that go through files and tables: deliveries written, read back, run to facts and state."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F

from ..contract import DeclaredColumn, PipelineSpec, RawContract, ReadSpec
from ..operators import fold
from ..operators.lineage import Lineage
from ..plans import runner
from ..session import scratch
from ..sources import delimited, objects
from ..sources.tables import Table, merge
from .admission import table

CONTRACT = RawContract((DeclaredColumn("domain_id", nullable=False), DeclaredColumn("event_time"), DeclaredColumn("source_ts", "int"), DeclaredColumn("content_hash"), DeclaredColumn("note")))
SPEC = PipelineSpec("pipelines/orders", CONTRACT, ReadSpec(header=False))


def _delivered(spark, sf_dir) -> list[str]:
    """Orders as headerless CSV lines, some of them malformed, in one file a partition."""
    key = F.col("o_orderkey")
    cells = F.concat_ws(",", F.when(key % 41 == 0, F.lit("")).otherwise(F.col("o_custkey").cast("string")), F.date_format("o_orderdate", "yyyy-MM-dd"), F.when(key % 43 == 0, F.lit("x")).otherwise(key.cast("string")), "o_orderstatus", F.concat(F.lit('"a, ""b"""'), F.lit("")))
    line = F.when(key % 37 == 0, F.lit('broken,"line')).otherwise(cells)
    at = scratch(spark, "delivery")
    table(spark, sf_dir, "orders").select(line.alias("value")).write.text(at)
    return [r.uri for r in objects.listing(spark, at, "*.txt").select("uri").collect()]


def delivery_read(spark, sf_dir):
    raw = delimited.read_delivery(spark, _delivered(spark, sf_dir), SPEC.read, CONTRACT)
    return raw.agg(
        F.count(F.lit(1)).alias("records"), F.count("malformed_text").alias("malformed"), F.count("domain_id").alias("with_domain"), F.count_if(F.col("note") == 'a, "b"').alias("notes"),
        (F.count_distinct("source_uri", "row_index") == F.count(F.lit(1))).alias("located"), F.min("row_index").alias("first_row"),
    )


def delivery_rows(spark, sf_dir):
    raw = delimited.read_delivery(spark, _delivered(spark, sf_dir), SPEC.read, CONTRACT)
    return raw.where("malformed_text is null").select("domain_id", "event_time", "source_ts", "content_hash", "note")


def batch_run(spark, sf_dir):
    """A whole batch: delivered, admitted, checked, committed, folded; the state that results."""
    at = scratch(spark, "lake")
    pipe = runner.Pipeline(SPEC, lambda valid, co: valid.withColumn("source_ts", F.lpad(F.col("source_ts").cast("string"), 12, "0")), lambda rows, co: rows.where("content_hash = 'P'").withColumn("reason", F.lit("business/pending")))
    stores = runner.Stores.at(spark, at)
    runner.run(spark, pipe, Lineage("batch", "delivery", "feed/orders", datetime.datetime(2026, 1, 1, tzinfo=datetime.UTC)), _delivered(spark, sf_dir), stores)
    return stores.state.read()[0].select("domain_id", "event_time", "source_ts", "content_hash", "batch_id")


def batch_quarantine(spark, sf_dir):
    """The refused rows of a batch by stage and reason, as its quarantine table has them."""
    at = scratch(spark, "lake")
    pipe = runner.Pipeline(SPEC, lambda valid, co: valid, lambda rows, co: rows.where("content_hash = 'P'").withColumn("reason", F.lit("business/pending")))
    stores = runner.Stores.at(spark, at)
    runner.run(spark, pipe, Lineage("batch", "delivery", "feed/orders", datetime.datetime(2026, 1, 1, tzinfo=datetime.UTC)), _delivered(spark, sf_dir), stores)
    return stores.quarantine.read()[0].groupBy("check_stage", "reason_code").agg(F.count(F.lit(1)).alias("n"), F.count("domain_id").alias("with_domain"), F.count("row_index").alias("with_locator"))


def state_table_merge(spark, sf_dir):
    """Two merges into a stored state table."""
    order = ("o_orderdate", "o_totalprice", "o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_custkey", *order)
    state = Table(spark, scratch(spark, "state"))
    for part in (0, 1):
        merge(state, fold.winners(o.where(F.col("o_orderkey") % 2 == part), "o_custkey", order), "o_custkey", order, batch_id=str(part))
    return state.read()[0].withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))


QUERIES = [delivery_read, delivery_rows, batch_run, batch_quarantine, state_table_merge]

_D = """d AS (SELECT CASE WHEN o_orderkey % 41 > 0 THEN CAST(o_custkey AS VARCHAR) END AS domain_id, strftime(o_orderdate, '%Y-%m-%d') AS event_time,
  CASE WHEN o_orderkey % 43 = 0 THEN 'x' ELSE CAST(o_orderkey AS VARCHAR) END AS source_ts, o_orderstatus AS content_hash, 'a, "b"' AS note, o_orderkey % 37 = 0 AS broken FROM orders)"""

SQL = {
    "delivery_read": f"WITH {_D} SELECT count(*) AS records, count_if(broken) AS malformed, count_if(NOT broken AND domain_id IS NOT NULL) AS with_domain, count_if(NOT broken) AS notes, true AS located, CAST(1 AS BIGINT) AS first_row FROM d",
    "delivery_rows": f"WITH {_D} SELECT domain_id, event_time, source_ts, content_hash, note FROM d WHERE NOT broken",
    "batch_run": f"""WITH {_D} SELECT domain_id, event_time, lpad(source_ts, 12, '0') AS source_ts, content_hash, 'batch' AS batch_id FROM (SELECT *, row_number() OVER (PARTITION BY domain_id ORDER BY event_time DESC, CAST(source_ts AS INTEGER) DESC) AS k
  FROM d WHERE NOT broken AND domain_id IS NOT NULL AND source_ts <> 'x' AND content_hash <> 'P') WHERE k = 1""",
    "batch_quarantine": f"""WITH {_D}, r AS (SELECT *, CASE WHEN broken THEN 'unreadable/malformed-row' WHEN source_ts = 'x' THEN 'contract/cast-failure' WHEN domain_id IS NULL THEN 'contract/null-violation' WHEN content_hash = 'P' THEN 'business/pending' END AS c FROM d)
SELECT CASE WHEN c = 'business/pending' THEN 'post_check' ELSE 'pre_check' END AS check_stage, c AS reason_code, count(*) AS n, count_if(c = 'business/pending') AS with_domain, count_if(c <> 'business/pending') AS with_locator FROM r WHERE c IS NOT NULL GROUP BY ALL""",
    "state_table_merge": "SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_totalprice, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1",
}
