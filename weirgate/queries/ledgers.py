"""Queries over folds, ledgers, verdicts and standing questions.

``events`` stands in for the delivery ledger (a user is a feed, three events in a
row a delivery) and for the run ledger; ``orders`` for facts; ``pages`` and
``documents`` for delivered objects.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import identity
from ..functions import text as X
from ..operators import decisions, fold, ledger, ops
from .admission import table

def _id():
    return F.col("event_id")


def _ledger(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    kind = F.element_at(F.array(*map(F.lit, ("registered", "incomplete", "duplicate", "registered", "unreadable", "registered", "superseded"))), (_id() % 7 + 1).cast("int"))
    name = lambda k: F.concat(F.lit(f"part{k}-"), (_id() % 50).cast("string"))
    obj = lambda k: F.struct(name(k).alias("name"), F.lit("data").alias("role"), F.lit(None).cast("string").alias("uri"), (_id() % 11 + k).cast("long").alias("bytes"), F.sha2(name(k), 256).alias("sha256"))
    return e.select(
        F.concat(F.lit("d"), F.floor(_id() / 3).cast("string")).alias("delivery_id"), F.concat(F.lit("feed"), (F.floor(_id() / 3) % 40).cast("string")).alias("feed_id"),
        F.concat(F.lit("key"), (F.floor(_id() / 3) % 80).cast("string")).alias("delivery_key"), F.date_trunc("hour", "ts").alias("received_at"), F.date_trunc("hour", "ts").alias("recorded_at"),
        F.when(_id() % 4 == 0, F.lit("manifest")).otherwise(F.lit("trailer")).alias("completeness_mode"), kind.alias("disposition"), F.concat(F.lit("h"), (F.floor(_id() / 3) % 5).cast("string")).alias("content_hash"),
        F.concat(F.lit("b"), (F.floor(_id() / 3) % 31).cast("string")).alias("batch_id"), F.array(obj(1), obj(2)).alias("objects"),
    )


_LEDGER = """led AS (
  SELECT 'd' || (event_id // 3) AS delivery_id, 'feed' || (event_id // 3 % 40) AS feed_id, 'key' || (event_id // 3 % 80) AS delivery_key,
    date_trunc('hour', ts) AS received_at, date_trunc('hour', ts) AS recorded_at, CASE WHEN event_id % 4 = 0 THEN 'manifest' ELSE 'trailer' END AS completeness_mode,
    ['registered', 'incomplete', 'duplicate', 'registered', 'unreadable', 'registered', 'superseded'][event_id % 7 + 1] AS disposition,
    'h' || (event_id // 3 % 5) AS content_hash, 'b' || (event_id // 3 % 31) AS batch_id, event_id FROM events),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY delivery_id ORDER BY recorded_at DESC,
    list_position(['registered', 'incomplete', 'duplicate', 'superseded', 'unreadable'], disposition) DESC) AS rn,
    count(*) OVER (PARTITION BY delivery_id, recorded_at, disposition) AS ties FROM led) WHERE rn = 1),
reg AS (SELECT * FROM latest WHERE disposition = 'registered')
"""

#: The questions about the last 30 days are asked here, in the middle of the events' month plus 30 days.
def _now():
    return F.lit("2024-02-15 12:00:00").cast("timestamp")


_RECENT = "TIMESTAMP '2024-01-16 12:00:00'"
_STAGES = ("land", "pre_check", "commit", "fold")


def _runs(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    at = F.date_trunc("second", "ts").cast("timestamp")
    return e.select(
        F.concat(F.lit("b"), F.floor(_id() / 8).cast("string")).alias("batch_id"), F.concat(F.lit("p"), (F.floor(_id() / 8) % 3).cast("string")).alias("pipeline"), F.concat(F.lit("f"), (F.floor(_id() / 8) % 5).cast("string")).alias("feed_id"),
        F.concat(F.lit("a"), F.floor(_id() / F.when(F.floor(_id() / 8) % 2 == 0, 4).otherwise(8)).cast("string")).alias("attempt_id"), F.element_at(F.array(*map(F.lit, _STAGES)), (_id() % 4 + 1).cast("int")).alias("stage"),
        F.when(_id() % 4 == 0, F.lit("skipped-guard")).when(F.floor(_id() / 4) % 3 == 0, F.lit("skipped-guard")).when(_id() % 13 == 0, F.lit("failed")).otherwise(F.lit("ok")).alias("outcome"),
        at.alias("started_at"), (at + F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), _id() % 50)).alias("finished_at"), at.alias("recorded_at"),
        F.when(_id() % 4 == 2, _id() % 3).alias("facts_appended"), F.when(_id() % 4 == 0, F.lit(100)).cast("long").alias("raw_count"), F.when(_id() % 4 == 1, _id() % 9).alias("pre_quarantined"), F.lit(None).cast("long").alias("post_quarantined"),
        F.lit(None).cast("long").alias("rows_merged"), F.lit(None).cast("string").alias("error_type"), F.lit(None).cast("string").alias("error_message"), _id().alias("seq"),
    )


_RUNS = """runs AS (
  SELECT 'b' || (event_id // 8) AS batch_id, 'p' || (event_id // 8 % 3) AS pipeline, 'f' || (event_id // 8 % 5) AS feed_id,
    'a' || (event_id // CASE WHEN event_id // 8 % 2 = 0 THEN 4 ELSE 8 END) AS attempt_id, ['land', 'pre_check', 'commit', 'fold'][event_id % 4 + 1] AS stage,
    CASE WHEN event_id % 4 = 0 THEN 'skipped-guard' WHEN event_id // 4 % 3 = 0 THEN 'skipped-guard' WHEN event_id % 13 = 0 THEN 'failed' ELSE 'ok' END AS outcome,
    date_trunc('second', ts) AS started_at, date_trunc('second', ts) + to_seconds(event_id % 50) AS finished_at,
    CASE WHEN event_id % 4 = 2 THEN event_id % 3 END AS facts_appended, CASE WHEN event_id % 4 = 0 THEN 100 END AS raw_count, CASE WHEN event_id % 4 = 1 THEN event_id % 9 END AS pre_quarantined FROM events)
"""


def _text(*cols):
    return {c: F.date_format(c, "yyyy-MM-dd HH:mm:ss") for c in cols}


def lww_fold(spark, sf_dir):
    return fold.winners(table(spark, sf_dir, "orders").select("o_custkey", "o_orderdate", "o_totalprice", "o_orderkey"), "o_custkey", ("o_orderdate", "o_totalprice", "o_orderkey")).withColumns(_text("o_orderdate"))


def _orders(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_custkey", F.when(F.col("o_orderkey") % 5 > 0, F.col("o_orderdate")).alias("o_orderdate"), "o_totalprice", "o_orderkey")


_ORDER = ("o_orderdate", "o_totalprice", "o_orderkey")


def state_merge(spark, sf_dir):
    """State from a third of the orders, delta from all others."""
    o = _orders(spark, sf_dir)
    state = fold.winners(o.where("o_orderkey % 3 = 0"), "o_custkey", _ORDER)
    return fold.fold(state, o.where("o_orderkey % 3 <> 0"), "o_custkey", _ORDER).withColumns(_text("o_orderdate"))


def merge_noop(spark, sf_dir):
    o = _orders(spark, sf_dir)
    state = fold.winners(o, "o_custkey", _ORDER)
    again = fold.fold(state, o, "o_custkey", _ORDER)
    return again.exceptAll(state).agg(F.count(F.lit(1)).alias("changed"), F.lit(0).alias("zero"))


def repeated_merge_keys(spark, sf_dir):
    return fold.repeated_keys(table(spark, sf_dir, "orders"), "o_custkey").select("o_custkey", F.col("count").alias("n"))


def latest_disposition(spark, sf_dir):
    return ledger.latest(_ledger(spark, sf_dir)).select("delivery_id", "disposition", F.date_format("recorded_at", "yyyy-MM-dd").alias("recorded"))


def registered_deliveries(spark, sf_dir):
    return ledger.registered(_ledger(spark, sf_dir)).groupBy("feed_id").agg(F.count(F.lit(1)).alias("n"))


def feed_watermarks(spark, sf_dir):
    return ledger.watermarks(_distinct_ledger(spark, sf_dir)).withColumns(_text("last_registered_received_at", "last_ledger_activity_at"))


def _distinct_ledger(spark, sf_dir):
    """The ledger with one row a delivery and disposition, so that the row of each fold is determined."""
    rows = _ledger(spark, sf_dir)
    return rows.groupBy(*(c for c in rows.columns if c not in ("received_at", "objects", "completeness_mode"))).agg(F.max("received_at").alias("received_at"), F.max("objects").alias("objects"), F.max("completeness_mode").alias("completeness_mode"))


_DISTINCT = _LEDGER.replace("latest AS (", """one AS (SELECT delivery_id, feed_id, delivery_key, recorded_at, disposition, content_hash, batch_id, max(received_at) AS received_at,
    max([event_id % 50, event_id % 11]) AS o, max(completeness_mode) AS completeness_mode,
    max({'n': 'part1-' || (event_id % 50), 'b': event_id % 11 + 1, 's': sha256('part1-' || (event_id % 50)), 'n2': 'part2-' || (event_id % 50), 'b2': event_id % 11 + 2}) AS obj
  FROM led GROUP BY ALL),
latest AS (""").replace("AS ties FROM led", "AS ties FROM one")


def acquired_set(spark, sf_dir):
    return ledger.acquired(_distinct_ledger(spark, sf_dir))


def defective_set(spark, sf_dir):
    return ledger.defective(_distinct_ledger(spark, sf_dir))


def live_duplicates(spark, sf_dir):
    return ledger.live_duplicates(_distinct_ledger(spark, sf_dir)).select("feed_id", "delivery_key", "delivery_id")


def reconcile(spark, sf_dir):
    return ledger.reconciliation(_distinct_ledger(spark, sf_dir)).select("feed_id", "delivery_key", "delivery_id")


def supersession(spark, sf_dir):
    return ledger.supersession(_distinct_ledger(spark, sf_dir))


def registration_dispositions(spark, sf_dir):
    requests = table(spark, sf_dir, "events").select(F.concat(F.lit("f"), (F.col("user_id") % 20).cast("string")).alias("feed_id"), F.concat(F.lit("b"), (_id() % 37).cast("string")).alias("batch_id"), F.col("ts").alias("received_at"), _id().alias("delivery_id"))
    return ledger.registrations(requests).select("delivery_id", "disposition")


def nondelivery_changes(spark, sf_dir):
    led = _distinct_ledger(spark, sf_dir).where("disposition in ('incomplete', 'unreadable')")
    keys = led.select("feed_id", "delivery_key").distinct()
    objects = F.array(*(F.struct(F.concat(F.lit(f"part{k}-"), F.lit("1")).alias("name"), F.lit("data").alias("role"), F.lit(None).cast("string").alias("uri"), F.lit(2 + k).cast("long").alias("bytes"), F.lit(None).cast("string").alias("sha256")) for k in (1, 2)))
    news = keys.select("feed_id", "delivery_key", F.lit("incomplete").alias("disposition"), objects.alias("objects"))
    return ledger.changed_nondeliveries(led, news).select("feed_id", "delivery_key")


def candidate_select(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    listing = p.select(F.concat(F.lit("f"), (F.col("page_id") % 60).cast("string"), F.when(F.col("page_id") % 3 == 0, F.lit(".csv")).when(F.col("page_id") % 7 == 0, F.lit("/x.csv")).otherwise(F.lit(".txt"))).alias("name"), F.length("html").cast("long").alias("bytes"), (F.lit("2026-01-01 00:00:00").cast("timestamp") + F.make_dt_interval(F.lit(0), F.lit(0), (F.col("page_id") % 100).cast("int"))).alias("mtime"), "page_id")
    seen = listing.where("page_id % 5 = 0").select("name", "bytes")
    return decisions.candidates(listing, seen, "f*.csv", F.lit("2026-01-01 02:00:00").cast("timestamp"), 60).select("page_id", "name")


def content_hashes(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select((F.col("doc_id") % 100).alias("delivery"), F.concat(F.lit("o"), F.col("doc_id").cast("string")).alias("name"), F.sha2("text", 256).alias("sha"))
    return d.groupBy("delivery").agg(identity.content_hash_agg(F.col("name"), F.col("sha")).alias("content_hash"))


def mint_batch_id(spark, sf_dir):
    feed = F.concat(F.lit("feed/ü"), (F.col("page_id") % 3).cast("string"))
    content = F.concat(F.lit("sha256:"), F.sha2(F.coalesce("html", F.lit("")), 256))
    return table(spark, sf_dir, "pages").select("page_id", identity.batch_id_of(feed, content).alias("batch_id"), X.is_batch_uuid(identity.batch_id_of(feed, content)).alias("is_v5"))


def manifest_verdict(spark, sf_dir):
    """Orders as manifests that declare their lines; what is present differs by arithmetic."""
    line = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(F.max("l_suppkey").alias("s"))
    key, n = F.col("l_orderkey"), F.col("l_linenumber")
    declared = line.select(key.alias("manifest_id"), key.alias("feed_id"), n.alias("place"), F.when(key % 13 == 0, F.lit("same")).otherwise(F.concat(F.lit("f"), n.cast("string"))).alias("name"), F.col("s").alias("bytes"), F.lit("aa").alias("sha256"), F.when(key % 4 > 0, n).cast("long").alias("record_count"))
    observed = line.where(~((key % 5 == 0) & (n == 2))).select(key.alias("feed_id"), F.concat(F.lit("f"), n.cast("string")).alias("name"), (F.col("s") + F.when((key % 7 == 0) & (n == 1), 1).otherwise(0)).alias("bytes"), F.when((key % 11 == 0) & (n == 3), F.lit("bb")).otherwise(F.lit("aa")).alias("sha256"))
    return decisions.manifest_verdicts(declared, observed, F.when(F.col("feed_id") % 17 > 0, F.col("feed_id")).otherwise(F.lit(-1))).select("manifest_id", "verdict", "reason", "asserted_record_count")


def trailer_verdict(spark, sf_dir):
    tail = F.concat(F.lit("a,b\n"), F.when(_id() % 4 == 0, F.concat(F.lit("TOTAL:"), _id().cast("string"))).when(_id() % 4 == 1, F.lit("TOTAL:x1")).when(_id() % 4 == 2, F.lit("")).otherwise(F.lit("TOTAL:7")), F.lit("\n \n"))
    v = decisions.trailer_verdict(tail, "TOTAL:([0-9a-z]+)", 1)
    return table(spark, sf_dir, "events").select("event_id", v["verdict"].alias("verdict"), v["asserted_record_count"].alias("asserted_record_count"))


_FEED_ROWS = [("f0", "daily", "09:00", "UTC"), ("f1", "weekdays", "06:30", "UTC"), ("f2", "weekly:wed", "23:00", "UTC"), ("f3", "monthly:31", "12:00", "UTC"), ("f4", "daily", "09:00", "America/New_York")]


def overdue_dates(spark, sf_dir):
    e = table(spark, sf_dir, "events")
    feeds = spark.createDataFrame(_FEED_ROWS, "feed_id string, expected string, by string, timezone string")
    # one receipt a feed and ten days, so that some days have none
    received = e.select(F.concat(F.lit("f"), (_id() % 5).cast("string")).alias("feed_id"), (F.lit("2026-03-01 15:00:00").cast("timestamp") + F.make_dt_interval((_id() % 4 * 10).cast("int"))).alias("received_at"))
    out = decisions.overdue(feeds, received, F.lit("2026-04-02 10:00:00").cast("timestamp"), 33)
    return out.select("feed_id", F.col("expected_date").cast("string").alias("expected_date"), F.date_format("expected_by", "yyyy-MM-dd HH:mm:ss").alias("expected_by"))


def duplicate_rate(spark, sf_dir):
    return ops.duplicate_rate(_ledger(spark, sf_dir), _now())


def run_status(spark, sf_dir):
    return ops.run_status(_runs(spark, sf_dir)).select("batch_id", "stage", F.date_format("started_at", "yyyy-MM-dd HH:mm:ss").alias("started"))


def attempts_per_batch(spark, sf_dir):
    return ops.attempts_per_batch(_runs(spark, sf_dir))


def stage_durations(spark, sf_dir):
    return ops.stage_durations(_runs(spark, sf_dir), _now(), exact=True)


def rerun_noop_rate(spark, sf_dir):
    return ops.rerun_noop_rate(_runs(spark, sf_dir))


def quarantine_reasons(spark, sf_dir):
    e = table(spark, sf_dir, "events").select(F.concat(F.lit("f"), (_id() % 4).cast("string")).alias("feed_id"), F.when(_id() % 2 == 0, F.lit("pre_check")).otherwise(F.lit("post_check")).alias("check_stage"), F.date_trunc("second", "ts").cast("timestamp").alias("quarantined_at"), F.concat(F.lit("business/"), "event_type").alias("reason_code"), "event_id")
    out = ops.quarantine_reasons({name: e.where(f"event_id % 3 = {i}") for i, name in enumerate(("one", "two", "three"))}, _now())
    return out.withColumn("day", F.col("day").cast("string"))


def quarantine_rate(spark, sf_dir):
    return ops.quarantine_rate(_runs(spark, sf_dir), 24).withColumns(_text("window_start"))


def attempt_alarms(spark, sf_dir):
    return ops.attempt_alarms(_runs(spark, sf_dir), 24).withColumns(_text("window_start"))


def transition_metrics(spark, sf_dir):
    return ops.transition_metrics(_runs(spark, sf_dir)).groupBy("pipeline", "stage", "metric").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))


def feed_counts(spark, sf_dir):
    return ops.feed_counts(_ledger(spark, sf_dir))


def budget_prefix(spark, sf_dir):
    """The first documents of each source, up to a budget of characters a run."""
    d = table(spark, sf_dir, "documents").select("source", "doc_id", "n_chars")
    return decisions.budget_prefix(d, 20_000, ("doc_id",), "n_chars", ("source",)).select("source", "doc_id")


def name_functions(spark, sf_dir):
    url = F.col("url")
    uri = X.split_uri(url)
    return table(spark, sf_dir, "pages").select(
        "page_id", X.clean_name(url).alias("clean"), X.matches_glob(url, "http*[0-9]").alias("globbed"), uri["bucket"].alias("bucket"), X.slug(url).alias("slug"), (X.unslug(X.slug(F.concat(F.lit("a/b-"), (F.col("page_id") % 10).cast("string")))) == F.concat(F.lit("a/b-"), (F.col("page_id") % 10).cast("string"))).alias("slug_round_trip")
    )


QUERIES = [
    lww_fold, state_merge, merge_noop, repeated_merge_keys, latest_disposition, registered_deliveries, feed_watermarks, acquired_set, defective_set, live_duplicates, reconcile, supersession,
    registration_dispositions, nondelivery_changes, candidate_select, content_hashes, mint_batch_id, manifest_verdict, trailer_verdict, overdue_dates, duplicate_rate, run_status, attempts_per_batch,
    stage_durations, rerun_noop_rate, quarantine_reasons, quarantine_rate, attempt_alarms, transition_metrics, feed_counts, budget_prefix, name_functions,
]

_O = """o AS (SELECT o_custkey, CASE WHEN o_orderkey % 5 > 0 THEN o_orderdate END AS o_orderdate, o_totalprice, o_orderkey FROM orders)"""
_WIN = "ORDER BY o_orderdate DESC NULLS LAST, o_totalprice DESC, o_orderkey DESC"

SQL = {
    "lww_fold": "SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_totalprice, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1",
    "state_merge": f"WITH {_O} SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_totalprice, o_orderkey FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey {_WIN}) AS rn FROM o) WHERE rn = 1",
    "merge_noop": "SELECT CAST(0 AS BIGINT) AS changed, 0 AS zero",
    "repeated_merge_keys": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) > 1",
    "latest_disposition": f"WITH {_LEDGER} SELECT delivery_id, disposition, strftime(recorded_at, '%Y-%m-%d') AS recorded FROM latest",
    "registered_deliveries": f"WITH {_LEDGER} SELECT feed_id, count(*) AS n FROM reg GROUP BY 1",
    "feed_watermarks": f"WITH {_DISTINCT} SELECT feed_id, strftime(max(received_at) FILTER (disposition = 'registered'), '%Y-%m-%d %H:%M:%S') AS last_registered_received_at, strftime(max(recorded_at), '%Y-%m-%d %H:%M:%S') AS last_ledger_activity_at FROM latest GROUP BY 1",
    "acquired_set": f"WITH {_DISTINCT} SELECT feed_id, obj.n AS name, obj.b AS bytes FROM latest WHERE disposition IN ('registered', 'duplicate', 'superseded') UNION SELECT feed_id, obj.n2, obj.b2 FROM latest WHERE disposition IN ('registered', 'duplicate', 'superseded')",
    "defective_set": f"WITH {_DISTINCT}, x AS (SELECT * FROM latest WHERE disposition IN ('unreadable', 'incomplete') AND completeness_mode <> 'manifest') SELECT feed_id, obj.n AS name, obj.b AS bytes FROM x UNION SELECT feed_id, obj.n2, obj.b2 FROM x",
    "live_duplicates": f"WITH {_DISTINCT} SELECT feed_id, delivery_key, delivery_id FROM reg JOIN (SELECT feed_id, delivery_key FROM reg GROUP BY ALL HAVING count(*) > 1) USING (feed_id, delivery_key)",
    "reconcile": f"WITH {_DISTINCT} SELECT feed_id, delivery_key, delivery_id FROM (SELECT *, row_number() OVER (PARTITION BY feed_id, delivery_key ORDER BY received_at DESC, delivery_id DESC) AS k FROM reg) WHERE k > 1",
    "supersession": f"WITH {_DISTINCT}, x AS (SELECT *, lag(content_hash) OVER w AS ph, lag(delivery_id) OVER w AS pid FROM reg WINDOW w AS (PARTITION BY feed_id, delivery_key ORDER BY received_at, delivery_id)) SELECT feed_id, delivery_key, delivery_id, CASE WHEN ph <> content_hash THEN pid END AS supersedes FROM x",
    "registration_dispositions": "SELECT event_id AS delivery_id, CASE WHEN row_number() OVER (PARTITION BY user_id % 20, event_id % 37 ORDER BY ts, event_id) = 1 THEN 'registered' ELSE 'duplicate' END AS disposition FROM events",
    "nondelivery_changes": f"""WITH {_DISTINCT}, x AS (SELECT * FROM one WHERE disposition IN ('incomplete', 'unreadable')),
l AS (SELECT *, row_number() OVER (PARTITION BY feed_id, delivery_key ORDER BY recorded_at DESC, delivery_id DESC, disposition DESC, obj DESC) AS k FROM x)
SELECT feed_id, delivery_key FROM l WHERE k = 1 AND NOT (disposition = 'incomplete' AND obj.n = 'part1-1' AND obj.b = 3 AND obj.n2 = 'part2-1' AND obj.b2 = 4)""",
    "candidate_select": """
WITH l AS (SELECT 'f' || (page_id % 60) || CASE WHEN page_id % 3 = 0 THEN '.csv' WHEN page_id % 7 = 0 THEN '/x.csv' ELSE '.txt' END AS name, length(html) AS bytes, page_id % 100 AS m, page_id FROM pages)
SELECT page_id, name FROM l WHERE name LIKE 'f%.csv' AND name NOT LIKE '%/%' AND m <= 60 AND (name, bytes) NOT IN (SELECT (name, bytes) FROM l WHERE page_id % 5 = 0)""",
    "content_hashes": "SELECT doc_id % 100 AS delivery, 'sha256:' || sha256(string_agg(sha256(text) || '  o' || doc_id, chr(10) ORDER BY sha256(text) || '  o' || doc_id)) AS content_hash FROM documents GROUP BY 1",
    "mint_batch_id": """
WITH h AS (SELECT page_id, sha1(unhex('6ba7b8119dad11d180b400c04fd430c8') || encode('feed/ü' || (page_id % 3) || chr(10) || 'sha256:' || sha256(coalesce(html, '')))) AS h FROM pages)
SELECT page_id, h[1:8] || '-' || h[9:12] || '-5' || h[14:16] || '-' || ['8', '9', 'a', 'b'][(strpos('0123456789abcdef', h[17:17]) - 1) % 4 + 1] || h[18:20] || '-' || h[21:32] AS batch_id, true AS is_v5 FROM h""",
    "manifest_verdict": """
WITH l AS (SELECT l_orderkey AS k, l_linenumber AS n, max(l_suppkey) AS s FROM lineitem GROUP BY 1, 2),
d AS (SELECT k, n, CASE WHEN k % 13 = 0 THEN 'same' ELSE 'f' || n END AS name, s AS bytes FROM l),
ob AS (SELECT k, 'f' || n AS name, s + CASE WHEN k % 7 = 0 AND n = 1 THEN 1 ELSE 0 END AS bytes, CASE WHEN k % 11 = 0 AND n = 3 THEN 'bb' ELSE 'aa' END AS sha FROM l WHERE NOT (k % 5 = 0 AND n = 2)),
j AS (SELECT d.k, d.n, d.name, CASE WHEN ob.bytes IS NULL THEN d.name || ' not present' WHEN ob.bytes <> d.bytes THEN d.name || ' byte-size mismatch' WHEN ob.sha <> 'aa' THEN d.name || ' sha256 mismatch' END AS fault,
  ob.bytes = d.bytes AND ob.sha <> 'aa' IS TRUE AS sha FROM d LEFT JOIN ob ON ob.k = d.k AND ob.name = d.name),
g AS (SELECT k, k % 17 > 0 AS own, count(name) > count(DISTINCT name) AS rep, bool_or(coalesce(sha, false)) AS dig, count(fault) AS faults,
  string_agg(fault, '; ' ORDER BY n) FILTER (sha) AS shas, string_agg(fault, '; ' ORDER BY n) AS allf, CASE WHEN k % 4 > 0 THEN CAST(sum(n) AS BIGINT) END AS asserted_record_count FROM j GROUP BY k)
SELECT k AS manifest_id, CASE WHEN NOT own OR rep OR dig THEN 'defective' WHEN faults > 0 THEN 'incomplete' ELSE 'complete' END AS verdict,
  CASE WHEN NOT own THEN 'manifest feed_id does not match' WHEN rep THEN 'duplicate file names' WHEN dig THEN shas WHEN faults > 0 THEN allf END AS reason, asserted_record_count FROM g""",
    "trailer_verdict": "SELECT event_id, ['complete', 'defective', 'incomplete', 'complete'][event_id % 4 + 1] AS verdict, CASE event_id % 4 WHEN 0 THEN event_id WHEN 3 THEN 7 END AS asserted_record_count FROM events",
    "overdue_dates": """
WITH f AS (SELECT * FROM (VALUES ('f0', 'daily', '09:00', 'UTC'), ('f1', 'weekdays', '06:30', 'UTC'), ('f2', 'weekly:wed', '23:00', 'UTC'), ('f3', 'monthly:31', '12:00', 'UTC'), ('f4', 'daily', '09:00', 'NY')) t(feed_id, expected, b, z)),
d AS (SELECT *, DATE '2026-02-28' + CAST(i AS INTEGER) AS day FROM f, range(34) t(i)),
e AS (SELECT *, CAST(day AS TIMESTAMP) + to_hours(CAST(b[1:2] AS INTEGER)) + to_minutes(CAST(b[4:5] AS INTEGER)) + CASE WHEN z = 'UTC' THEN INTERVAL 0 HOUR WHEN day < DATE '2026-03-08' THEN INTERVAL 5 HOUR ELSE INTERVAL 4 HOUR END AS due FROM d
  WHERE expected = 'daily' OR expected = 'weekdays' AND isodow(day) < 6 OR expected = 'weekly:wed' AND isodow(day) = 3 OR expected = 'monthly:31' AND day(day) = 31),
r AS (SELECT DISTINCT 'f' || (event_id % 5) AS feed_id, DATE '2026-03-01' + CAST(event_id % 4 * 10 AS INTEGER) AS day FROM events)
SELECT feed_id, CAST(day AS VARCHAR) AS expected_date, strftime(due, '%Y-%m-%d %H:%M:%S') AS expected_by FROM e WHERE due <= TIMESTAMP '2026-04-02 10:00:00' AND (feed_id, day) NOT IN (SELECT (feed_id, day) FROM r)""",
    "duplicate_rate": f"WITH {_LEDGER} SELECT feed_id, count_if(disposition = 'duplicate') AS duplicates, count_if(disposition = 'registered') AS registered, CAST(count_if(disposition = 'duplicate') AS DOUBLE) / nullif(count_if(disposition IN ('registered', 'duplicate')), 0) AS duplicate_rate FROM led WHERE recorded_at >= {_RECENT} GROUP BY 1",
    "run_status": f"WITH {_RUNS} SELECT batch_id, stage, strftime(max(started_at), '%Y-%m-%d %H:%M:%S') AS started FROM runs GROUP BY 1, 2",
    "attempts_per_batch": f"WITH {_RUNS} SELECT batch_id, pipeline, feed_id, count(DISTINCT attempt_id) AS attempt_count, count(DISTINCT attempt_id) > 1 AS multiple_attempts FROM runs GROUP BY ALL",
    "stage_durations": f"WITH {_RUNS}, d AS (SELECT stage, epoch_ms(finished_at) - epoch_ms(started_at) AS ms FROM runs WHERE outcome = 'ok' AND started_at >= {_RECENT}) SELECT stage, quantile_cont(ms, 0.5) AS p50_ms, quantile_cont(ms, 0.95) AS p95_ms, count(*) AS sample_count FROM d GROUP BY 1",
    "rerun_noop_rate": f"WITH {_RUNS}, a AS (SELECT batch_id, attempt_id, bool_and(outcome = 'skipped-guard') AND sum(coalesce(facts_appended, 0)) = 0 AS noop FROM runs GROUP BY 1, 2) SELECT count_if(noop) AS noop_attempts, count(*) AS total_attempts, CAST(count_if(noop) AS DOUBLE) / nullif(count(*), 0) AS noop_rate FROM a",
    "quarantine_reasons": "SELECT CASE event_id % 3 WHEN 0 THEN 'one' WHEN 1 THEN 'two' ELSE 'three' END AS pipeline, 'f' || (event_id % 4) AS feed_id, CASE WHEN event_id % 2 = 0 THEN 'pre_check' ELSE 'post_check' END AS check_stage, strftime(ts, '%Y-%m-%d') AS day, 'business/' || event_type AS reason_code, count(*) AS reason_count FROM events WHERE date_trunc('second', ts) >= TIMESTAMP '2024-01-16 12:00:00' GROUP BY ALL",
    "quarantine_rate": f"WITH {_RUNS}, w AS (SELECT pipeline, date_trunc('day', finished_at) AS d, CAST(sum(coalesce(pre_quarantined, 0)) AS BIGINT) AS quarantined, CAST(sum(coalesce(raw_count, 0)) AS BIGINT) AS raw FROM runs GROUP BY 1, 2) SELECT pipeline, strftime(d, '%Y-%m-%d %H:%M:%S') AS window_start, quarantined, raw, quarantined / nullif(raw, 0) AS rate, coalesce(quarantined / nullif(raw, 0) > 0.05, false) AS alarm FROM w",
    "attempt_alarms": f"WITH {_RUNS} SELECT pipeline, strftime(date_trunc('day', started_at), '%Y-%m-%d %H:%M:%S') AS window_start, count(DISTINCT (batch_id, attempt_id)) AS attempts, count(DISTINCT (batch_id, attempt_id)) > 10 AS alarm FROM runs GROUP BY pipeline, date_trunc('day', started_at)",
    "transition_metrics": f"""WITH {_RUNS}, m AS (
  SELECT pipeline, stage, 'duration_ms' AS metric, epoch_ms(finished_at) - epoch_ms(started_at) AS value FROM runs UNION ALL SELECT pipeline, stage, 'failed', CASE WHEN outcome = 'failed' THEN 1 ELSE 0 END FROM runs
  UNION ALL SELECT pipeline, stage, 'raw_count', raw_count FROM runs UNION ALL SELECT pipeline, stage, 'pre_quarantined', pre_quarantined FROM runs UNION ALL SELECT pipeline, stage, 'facts_appended', facts_appended FROM runs)
SELECT pipeline, stage, metric, count(*) AS n, CAST(sum(value) AS BIGINT) AS total FROM m WHERE value IS NOT NULL GROUP BY ALL""",
    "feed_counts": f"WITH {_LEDGER} SELECT feed_id, disposition, count(*) AS rows FROM led GROUP BY 1, 2",
    "budget_prefix": "SELECT source, doc_id FROM (SELECT source, doc_id, coalesce(sum(n_chars) OVER (PARTITION BY source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM documents) WHERE before <= 20000",
    "name_functions": "SELECT page_id, NOT regexp_matches(url, '[/%]') AND url <> '' AS clean, regexp_matches(url, '^http.*[0-9]$') AS globbed, nullif(regexp_extract(url, '^[a-z][a-z0-9+.-]*://([^/]+)/(.+)$', 1), '') AS bucket, replace(url, '/', '--') AS slug, true AS slug_round_trip FROM pages",
}
