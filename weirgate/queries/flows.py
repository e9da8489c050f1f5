"""Queries over files, tables, claims and names: each goes through the library as a caller would.

Where a step works on a few values by nature (names, arguments, claims), the
values are made from whole tables and the result is compared row by row.
"""

from __future__ import annotations

import datetime
import json
import tempfile

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..contract import ColumnType, ContractError, DeclaredColumn, PipelineSpec, RawContract, ReadSpec
from ..functions import text as X
from ..operators import checks, decisions, fold, ledger, subtract
from ..operators.lineage import Lineage
from ..plans import acquisition, purity, runner
from ..session import scratch
from ..sinks import events
from ..sources import delimited, objects
from ..sources.files import LocalFiles, SharedFiles
from ..sources.tables import Table, merge
from . import lane
from .admission import CONTRACT, raw_lineitem, table
from .ledgers import _DISTINCT, _distinct_ledger

UTC = datetime.UTC
NOW = datetime.datetime(2026, 1, 1, tzinfo=UTC)

# -- delivered files


def _written(spark, folder, name, head, rows, compression="uncompressed", tail=()):
    """One file: the lines of ``head``, those of ``rows`` (k, line) in the order of k, the lines of ``tail``."""
    at = f"{folder}/{name}"
    around = [(0, i, x) for i, x in enumerate(head)] + [(2, i, x) for i, x in enumerate(tail)]
    lines = spark.createDataFrame(around, "part int, k long, line string").unionByName(rows.select(F.lit(1).alias("part"), F.col("k").cast("long").alias("k"), "line"))
    lines.repartition(1).sortWithinPartitions("part", "k").select("line").write.option("compression", compression).text(at)
    return [r.uri for r in objects.listing(spark, at, "part-*").select("uri").collect()]


def _headed(spark, sf_dir, compression="uncompressed"):
    """Three objects with a preamble line, a header each, extras, blank and ragged lines."""
    at, key = scratch(spark, "headed"), F.col("o_orderkey")
    o = table(spark, sf_dir, "orders").where("o_orderkey is not null")
    domain, price = F.col("o_custkey").cast("string"), F.when(key % 7 > 0, key.cast("string")).otherwise(F.lit(""))
    shapes = (
        ("a", "﻿made by hand", "domain_id,payload,Extra Col", F.concat_ws(",", domain, price, "o_orderstatus")),
        ("b", "", "payload,domain_id", F.concat_ws(",", price, domain)),
        ("c", "made, too", 'Extra Col,"domain_id",other', F.concat_ws(",", F.lit('"x, ""y"""'), domain, "o_orderpriority")),
    )
    uris = []
    for i, (name, preamble, header, line) in enumerate(shapes):
        rows = o.where(key % 3 == i).select(key.alias("k"), F.when(key % 37 == 0, F.lit("short")).when(key % 41 == 0, F.lit("")).otherwise(line).alias("line"))
        uris += _written(spark, at, name, [preamble, header], rows, compression)
    return uris


_HEADED = RawContract((DeclaredColumn("domain_id", required=True), DeclaredColumn("payload")))


def _headed_rows(spark, sf_dir, spec, compression):
    raw = delimited.read_delivery(spark, _headed(spark, sf_dir, compression), spec, _HEADED)
    extra = F.col("extras")
    return raw.select("object_seq", "row_index", "domain_id", "payload", "malformed_text", extra["Extra Col"].alias("extra_col"), extra["other"].alias("other"), F.size("extras").alias("extras"))


def delivery_headers(spark, sf_dir):
    """Headers bound by name, extras, ragged lines, a byte order mark and a preamble, objects in order."""
    return _headed_rows(spark, sf_dir, ReadSpec(skip_leading_lines=1), "uncompressed")


def delivery_gzip(spark, sf_dir):
    return _headed_rows(spark, sf_dir, ReadSpec(skip_leading_lines=1, compression="gzip"), "gzip")


def delivery_defects(spark, sf_dir):
    """What the probe of headers says before a body is read."""
    at, out = scratch(spark, "defects"), []
    body = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("k"), F.concat_ws(",", "n_name", F.col("n_nationkey").cast("string")).alias("line"))
    cases = {"fine": ["domain_id,payload"], "missing": ["payload,other"], "repeated": ["domain_id,x,x"], "open": ['domain_id,"payl'], "none": []}
    SharedFiles(spark).put(f"{at}/nothing/part-0", b"")
    for name, head in cases.items():
        uris = _written(spark, at, name, head, body) if head else [f"{at}/nothing/part-0"]
        try:
            out.append((name, delimited.read_delivery(spark, uris, ReadSpec(), _HEADED).count(), None))
        except ContractError as e:
            out.append((name, None, str(e)))
    for name, spec, uri in (("gzip stated", ReadSpec(compression="gzip"), "x.csv"), ("none stated", ReadSpec(), "x.csv.zst")):
        try:
            delimited.check_names([uri], spec)
        except ContractError as e:
            out.append((name, None, str(e)))
    return spark.createDataFrame(out, "case string, records long, fault string")


def multiline_rows(spark, sf_dir):
    """Records whose quoted fields span lines, text after a closing quote, ragged records; the last quote never closes."""
    key = F.col("o_orderkey")
    line = (
        F.when(key % 11 == 0, F.concat(F.lit('broken,"a\nb",'), key.cast("string")))
        .when(key % 13 == 0, F.concat(key.cast("string"), F.lit(',"x"y')))
        .when(key % 17 == 0, F.lit(""))
        .otherwise(F.concat(key.cast("string"), F.lit(',"two\nlines ""'), F.col("o_orderstatus"), F.lit('"""')))
    )
    rows = table(spark, sf_dir, "orders").select(key.alias("k"), line.alias("line"))
    uris = _written(spark, scratch(spark, "multiline"), "m", [], rows, tail=['end,"open', "and, on"])
    contract = RawContract((DeclaredColumn("domain_id"), DeclaredColumn("payload")))
    return delimited.read_delivery(spark, uris, ReadSpec(header=False, multiline=True), contract).select("row_index", "domain_id", "payload", "malformed_text")


def _statuses(spark, sf_dir):
    """One object a status, of ordered lines."""
    at, found = scratch(spark, "objects"), {}
    for status in "FOP":
        rows = table(spark, sf_dir, "orders").where(F.col("o_orderstatus") == status).select(F.col("o_orderkey").alias("k"), F.concat_ws(",", F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string")).alias("line"))
        found[status] = _written(spark, at, status, ["start"], rows)[0]
    return found


def object_digests(spark, sf_dir):
    found = _statuses(spark, sf_dir)
    rows = objects.digests(spark, list(found.values()))
    return rows.select(F.element_at(F.split("uri", "/"), -2).alias("status"), "bytes", "sha256", F.right("tail", F.lit(40)).alias("tail"), F.length("tail").alias("tail_length"))


def copied_objects(spark, sf_dir):
    """Objects copied as they are, and what the copies hold."""
    at, told = scratch(spark, "copies"), []
    for status, uri in _statuses(spark, sf_dir).items():
        n, sha = objects.copied(spark, uri, f"{at}/{status}")
        told.append((status, n, sha, objects.streamed(spark, f"{at}/{status}")[1] == sha))
    listed = objects.listing(spark, at).select(F.col("name").alias("status"), F.col("bytes").alias("listed"))
    return spark.createDataFrame(told, "status string, bytes long, sha256 string, equal boolean").join(listed, "status")


def manifest_parse(spark, sf_dir):
    """Manifests with faults by arithmetic."""
    key = F.col("o_orderkey")
    good = F.concat(
        F.lit('{"manifest_version":'), F.when(key % 9 == 1, F.lit("2")).otherwise(F.lit("1")), F.lit(',"manifest_id":"'), F.when(key % 9 == 2, F.lit("")).otherwise(key.cast("string")),
        F.lit('","feed_id":"f","more":[1],"files":['), F.when(key % 9 == 3, F.lit("")).otherwise(F.concat(F.lit('{"name":"a","bytes":'), F.when(key % 9 == 4, F.lit("-1")).otherwise(F.lit("5")), F.lit(',"sha256":"'), F.when(key % 9 == 5, F.lit("xyz")).otherwise(F.sha2(key.cast("string"), 256)), F.lit('","record_count":7}'))), F.lit("]}"),
    )
    text = F.when(key % 9 == 6, F.substring(good, 1, 30)).when(key == 7, F.rpad(good, objects.MANIFEST_BYTES + 1, " ")).otherwise(good)
    rows = table(spark, sf_dir, "orders").select("o_orderkey", objects.parse_manifests(text).alias("p"))
    fine = F.col("p.fault").isNull()
    return rows.select("o_orderkey", F.col("p.fault").alias("fault"), F.when(fine, F.col("p.manifest.manifest_id")).alias("manifest_id"), F.when(fine, F.size("p.manifest.files")).alias("files"), F.when(fine, F.col("p.manifest.files")[0]["record_count"]).alias("record_count"))


def feed_registry(spark, sf_dir):
    """A registry file, read through its cache; reserved drivers are refused."""
    feeds = [{"feed_id": f"feed/{r.n_name.lower().replace(' ', '-')}", "driver": "pull", "region": r.n_regionkey} for r in table(spark, sf_dir, "nation").collect()]
    with tempfile.TemporaryDirectory() as at:
        LocalFiles().put(f"{at}/feeds.json", json.dumps({"feeds": feeds}).encode())
        LocalFiles().put(f"{at}/odd.json", json.dumps([{"feed_id": "x", "driver": "db-unload"}]).encode())
        registry = objects.FeedRegistry(f"{at}/feeds.json")
        first = registry.feeds(0.0)
        kept = registry.feeds(59.0) is first and registry.feeds(60.0) is not first
        try:
            objects.feed_registry(f"{at}/odd.json")
            refused = False
        except NotImplementedError:
            refused = True
        rows = [(f["feed_id"], f["region"], kept, refused) for f in registry.feeds(61.0)]
    return spark.createDataFrame(rows, "feed_id string, region int, cached boolean, reserved_refused boolean")


# -- tables


def pinned_version(spark, sf_dir):
    """An old version of a table after later appends and a compaction."""
    o, t = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.concat(F.lit("b"), (F.col("o_orderkey") % 3).cast("string")).alias("batch_id")), Table(spark, scratch(spark, "pinned"), ("batch_id",))
    for i in range(3):
        t.append(o.where(F.col("o_orderkey") % 3 == i), batch_id=f"b{i}", stage="land")
    t.compact(2)
    counts = [t.read(v)[0].groupBy("batch_id").agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("keys")).withColumn("version", F.lit(v)) for v in range(4)]
    return counts[0].unionByName(counts[1]).unionByName(counts[2]).unionByName(counts[3])


def own_commits(spark, sf_dir):
    """The version that each batch's own commit made, found by its stamp; a repeated append makes none."""
    t, made = Table(spark, scratch(spark, "own"), ("batch_id",)), []
    for r in table(spark, sf_dir, "region").orderBy("r_regionkey").collect():
        rows = table(spark, sf_dir, "nation").where(F.col("n_regionkey") == r.r_regionkey).select("n_nationkey", F.lit(r.r_name).alias("batch_id"))
        t.append_if_absent(rows, r.r_name, stage="land")
        made.append((r.r_name, t.append_if_absent(rows, r.r_name, stage="land") is None))
    found = [(name, again, t.find(batch_id=name, stage="land"), t.batch(name).count(), t.find(batch_id=name, stage="fold")) for name, again in made]
    return spark.createDataFrame(found, "batch_id string, repeated_left_out boolean, version long, rows long, other_stage long")


def vacuumed_table(spark, sf_dir):
    """A compacted table after vacuum; the parts of a writer at work stay."""
    o, t = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), Table(spark, scratch(spark, "vacuum"))
    for i in range(2):
        t.append(o.where(F.col("o_orderkey") % 2 == i))
    t.compact(1)
    in_flight, _ = t._write(o.limit(0))
    young = len(t.vacuum())
    kept = t.files.fs(t.path).exists(t.files._path(f"{t.path}/data/{in_flight[0]}"))
    gone = len(t.vacuum(older_than_s=0))
    return t.read()[0].agg(F.count(F.lit(1)).alias("n"), F.sum("o_custkey").alias("keys")).withColumns({"young_removed": F.lit(young), "in_flight_kept": F.lit(kept), "old_removed": F.lit(gone)})


def table_ddl(spark, sf_dir):
    """The raw table that a contract asks for, then one with more columns; rows of both."""
    t = scratch(spark, "ddl")
    stores = runner.Stores.at(spark, t)
    pipe = lambda *names: runner.Pipeline(PipelineSpec("pipelines/x", RawContract(tuple(DeclaredColumn(n) for n in names)), ReadSpec(header=False)), lambda valid, co: valid)
    runner.prepare(spark, pipe("a", "b"), stores)
    runner.prepare(spark, pipe("a", "b"), stores)  # changes nothing
    first = stores.raw.version()
    runner.prepare(spark, pipe("a", "b", "c"), stores)
    shown = [(f.name, f.dataType.simpleString(), first, stores.raw.version()) for f in stores.raw.schema().fields]
    return spark.createDataFrame(shown, "name string, type string, before int, after int")


def bucketed_merge(spark, sf_dir):
    """Small merges into a state table with buckets; only touched buckets are written anew."""
    order = ("o_orderdate", "o_totalprice", "o_orderkey")
    o = table(spark, sf_dir, "orders").select("o_custkey", *order)
    state = Table(spark, scratch(spark, "bucketed"), buckets=("o_custkey", 16))
    merge(state, fold.winners(o.where(F.col("o_custkey") % 5 > 0), "o_custkey", order), "o_custkey", order)
    before = {p for p, _ in state._parts(state.version())}
    one = o.where(F.col("o_custkey") % 5 == 0)
    least = one.agg(F.min("o_custkey")).first()[0]
    merge(state, fold.winners(one.where(F.col("o_custkey") == least), "o_custkey", order), "o_custkey", order)
    after = {p for p, _ in state._parts(state.version())}
    merge(state, fold.winners(one, "o_custkey", order), "o_custkey", order)
    version, _ = merge(state, fold.winners(one, "o_custkey", order), "o_custkey", order)  # nothing new, no commit
    rows = state.read()[0].withColumn("o_orderdate", F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss"))
    return rows.withColumns({"rewritten": F.lit(len(after - before)), "version": F.lit(version)})


# -- runs


def _lane(spark, sf_dir, times=1):
    pipe = runner.Pipeline(lane.SPEC, lambda valid, co: valid, lambda rows, co: rows.where("content_hash = 'P'").withColumn("reason", F.lit("business/pending")))
    told: list = []
    stores = runner.Stores.at(spark, scratch(spark, "lake"), lambda kind, event: told.append((kind, event)))
    uris = lane._delivered(spark, sf_dir)
    for _ in range(times):
        runner.run(spark, pipe, Lineage("batch", "delivery", "feed/orders", NOW), uris, stores)
    return stores, told


def run_ledger(spark, sf_dir):
    """Two runs of one batch as the run ledger has them: the second finds everything done."""
    stores, _ = _lane(spark, sf_dir, 2)
    shown = ("stage", "outcome", "raw_count", "pre_quarantined", "post_quarantined", "facts_appended", "rows_merged")
    return stores.runs.read()[0].groupBy(*shown).agg(F.count(F.lit(1)).alias("runs"))


def run_events(spark, sf_dir):
    """What a batch tells when it starts and when it is complete."""
    _, told = _lane(spark, sf_dir)
    names = ("raw_count", "pre_quarantined", "post_quarantined", "fact_count")
    return spark.createDataFrame([(kind, event["pipeline"], event["batch_id"], *(event.get(n) for n in names)) for kind, event in told], "kind string, pipeline string, batch_id string, " + ", ".join(f"{n} long" for n in names))


def publish_counts(spark, sf_dir):
    """Refused rows of a batch by stage and its facts, counted from the tables as a publishing stage does."""
    stores, _ = _lane(spark, sf_dir)
    refused = stores.quarantine.batch("batch").groupBy("check_stage").count().select(F.col("check_stage").alias("what"), F.col("count").alias("n"))
    return refused.unionByName(stores.facts.batch("batch").agg(F.lit("facts").alias("what"), F.count(F.lit(1)).alias("n"))).unionByName(stores.raw.batch("batch").agg(F.lit("raw").alias("what"), F.count(F.lit(1)).alias("n")))


def row_locators(spark, sf_dir):
    """Rows of a delivery by locator: every one once, numbered in its object without a gap."""
    raw = delimited.read_delivery(spark, lane._delivered(spark, sf_dir), lane.SPEC.read, lane.CONTRACT)
    per = raw.groupBy("object_seq", "source_uri").agg(F.count(F.lit(1)).alias("n"), F.min("row_index").alias("lo"), F.max("row_index").alias("hi"), F.count_distinct("row_index").alias("d"))
    return per.agg(F.sum("n").alias("records"), F.bool_and((F.col("lo") == 1) & (F.col("hi") == F.col("n")) & (F.col("d") == F.col("n"))).alias("without_gap"), (F.count_distinct("object_seq") == F.max("object_seq")).alias("objects_numbered"))


def set_once(spark, sf_dir):
    """What a stage has set cannot be set again."""
    stage, rows = runner.Batch(None, None, (), "a"), []
    for r in table(spark, sf_dir, "region").orderBy("r_regionkey").collect():
        n = stage.plus(raw_count=r.r_regionkey)
        try:
            n.plus(raw_count=r.r_regionkey)
            rows.append((r.r_name, n.raw_count, True))
        except ValueError:
            rows.append((r.r_name, n.raw_count, False))
    return spark.createDataFrame(rows, "name string, raw_count int, again boolean")


def run_messages(spark, sf_dir):
    """Messages of failed runs hold no cell: only contract faults are quoted."""
    rows = []
    for r in table(spark, sf_dir, "region").orderBy("r_regionkey").collect():
        for kind, make in (("contract", lambda x: ContractError(f"column {x.r_regionkey}\nsecond line")), ("value", lambda x: int(x.r_name))):
            try:
                found = make(r)
                raise found
            except Exception as e:
                message = runner.safe_message(e)
                rows.append((r.r_name, kind, message if kind == "contract" else "hidden" if r.r_name not in message else message))
    return spark.createDataFrame(rows, "name string, kind string, message string")


# -- checks


def structural_check(spark, sf_dir):
    """The faults of facts without domain ids and with other columns than a table has."""
    facts = raw_lineitem(spark, sf_dir).select("domain_id", "price", "flag")
    cases = {"as expected": (facts.where("domain_id is not null"), ("domain_id", "price", "flag")), "nulls": (facts, ("domain_id", "price", "flag")), "both": (facts, ("domain_id", "price", "more"))}
    return spark.createDataFrame([(name, "; ".join(checks.structural_faults(rows, "domain_id", expected))) for name, (rows, expected) in cases.items()], "name string, faults string")


def contract_probe(spark, sf_dir):
    """Contracts that the engine can or cannot run, found out when they are bound."""
    cases = {
        "fine": DeclaredColumn("a", "date(yyyy-MM-dd)", min="2024-01-01", max="2024-12-31"), "bound": DeclaredColumn("a", "date(yyyy-MM-dd)", min="x"), "order": DeclaredColumn("a", "date(yyyy-MM-dd)", min="2024-02-01", max="2024-01-01"),
        "pattern": DeclaredColumn("a", pattern="(?P<x>a)"), "plain": DeclaredColumn("a", pattern="[a-z]+"),
    }
    out = []
    for name, column in cases.items():
        try:
            checks.probe(RawContract((column,)), spark)
            out.append((name, True))
        except ContractError:
            out.append((name, False))
    return spark.createDataFrame(out, "name string, runs boolean")


def detail_cut(spark, sf_dir):
    """Rows with up to 40 failures: 32 are told, then their number."""
    c = RawContract(tuple(DeclaredColumn(f"c{i}", "int") for i in range(40)))
    rows = table(spark, sf_dir, "events").select("event_id", *(F.when(F.col("event_id") % 41 > i, F.lit("x")).otherwise(F.lit("1")).alias(f"c{i}") for i in range(40)), F.lit(None).cast("string").alias("malformed_text"), F.create_map(F.lit("k"), F.lit("v")).alias("extras"))
    return checks.violations(rows, checks.compile_contract(c)).select("event_id", "reason_code", "reason_detail")


def empty_shapes(spark, sf_dir):
    """An empty delivery, and post-checks that refuse nothing, keep their shape."""
    raw = delimited.empty_raw(spark, CONTRACT)
    compiled = checks.compile_contract(CONTRACT)
    bad = checks.violations(raw, compiled)
    good = checks.admitted(raw, compiled)
    rows = [("raw", raw.count(), len(raw.columns)), ("refused", bad.count(), len(bad.columns)), ("admitted", good.count(), len(good.columns)), ("left", subtract.bag_subtract(good, good).count(), len(good.columns))]
    return spark.createDataFrame(rows, "frame string, rows long, columns int")


# -- registration


def _requests(spark, sf_dir):
    """Deliveries of five feeds: nations in order; two in a row bring the same content."""
    out = []
    for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect():
        day = datetime.datetime(2026, 1, 1, 12, tzinfo=UTC) + datetime.timedelta(hours=r.n_nationkey)
        content = f"{r.n_nationkey // 10:064x}"
        out.append(acquisition.Request(f"feed/{r.n_regionkey}", "pipelines/x", f"d{r.n_nationkey:02d}", "key", day, (acquisition.Observed("p.csv", 5, content, uri=f"s3://lake/feed/{r.n_regionkey}/p.csv"),), run_id=f"run{r.n_nationkey}"))
    return out


def _registrar(spark, emit=None):
    at = scratch(spark, "registrar")
    files = SharedFiles(spark)
    return acquisition.Registrar(spark, Table(spark, f"{at}/ledger"), events.Claims(f"{at}/claims", files), emit or events.EventFolder(files, f"{at}/events")), at


def registration_run(spark, sf_dir):
    """Registrations carried out one after the other: the ledger's latest rows."""
    reg, _ = _registrar(spark)
    for r in _requests(spark, sf_dir):
        reg.register(r, r.received_at)
    return ledger.latest(reg.table.read()[0]).select("feed_id", "delivery_id", "disposition", "supersedes", F.size("object_uris").alias("uris"))


def registration_events(spark, sf_dir):
    """The events that registrations put into a shared folder."""
    reg, at = _registrar(spark)
    for r in _requests(spark, sf_dir):
        reg.register(r, r.received_at)
    return spark.read.json(f"{at}/events").select("type", "feed_id", "delivery_id", "schema_version", "received_at", F.size("object_uris").alias("uris"))


def feed_scan(spark, sf_dir):
    """The ledger rows of each feed since noon of the day."""
    reg, _ = _registrar(spark, lambda *_: None)
    asked = _requests(spark, sf_dir)
    for r in asked:
        reg.register(r, r.received_at)
    since = datetime.datetime(2026, 1, 1, 22, tzinfo=UTC)
    frames = [reg.feed(f, since).select("feed_id", "delivery_id", "disposition") for f in sorted({r.feed_id for r in asked})]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def ledger_table(spark, sf_dir):
    """A ledger of all events appended by disposition, and its registered deliveries in order."""
    rows = _distinct_ledger(spark, sf_dir)
    have = set(rows.columns)
    shaped = rows.select(*((F.col(n) if n in have else F.lit(None)).cast(k).alias(n) for n, k in (c.split(" ", 1) for c in ledger.COLUMNS)))
    t = Table(spark, scratch(spark, "ledger"))
    t.create(spark.createDataFrame([], ledger.SCHEMA).schema)
    for d in ledger.RANKED:
        t.append(shaped.where(F.col("disposition") == d))
    ordered = ledger.registered_in_order(t.read()[0]).select("feed_id", "delivery_id", F.monotonically_increasing_id().alias("at"))
    return ordered.select("feed_id", "delivery_id", F.row_number().over(Window.orderBy("at")).alias("place"))


def ledger_current(spark, sf_dir):
    """Latest rows in the order in which operators see them."""
    shown = ledger.current(_distinct_ledger(spark, sf_dir)).select("feed_id", "delivery_key", F.monotonically_increasing_id().alias("at"))
    return shown.select("feed_id", "delivery_key", F.row_number().over(Window.orderBy("at")).alias("place"))


def ledger_for_batch(spark, sf_dir):
    """All rows of each of three batches, in order of time."""
    rows = _distinct_ledger(spark, sf_dir)
    for name in ("driver", "driver_run_id", "notes"):
        rows = rows.withColumn(name, F.lit(None).cast("string"))
    rows = rows.withColumn("object_uris", F.array().cast("array<string>"))
    out = None
    for b in ("b0", "b7", "b30"):
        one = ledger.for_batch(rows, b).select("delivery_id", "disposition", "recorded_at", F.monotonically_increasing_id().alias("at"))
        late = F.max("recorded_at").over(Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
        one = one.select(F.lit(b).alias("batch_id"), "delivery_id", "disposition", (F.col("recorded_at") == late).alias("in_order"))
        out = one if out is None else out.unionByName(one)
    return out


def claim_outcomes(spark, sf_dir):
    """Claims of one batch a region by its nations, a quarter of an hour apart; some go stale and are taken over."""
    claims, out = events.Claims(f"{scratch(spark, 'claims')}/c", SharedFiles(spark)), []
    for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect():
        now = 1000.0 * r.n_nationkey
        kind, held = claims.claim(f"feed/{r.n_regionkey % 2}", "b", r.n_name, {"by": r.n_name}, now)
        done = claims.complete(f"feed/{r.n_regionkey % 2}", "b", r.n_name) if kind == "TAKEN_OVER" else False
        out.append((r.n_nationkey, kind, held["by"] if held else None, done))
    return spark.createDataFrame(out, "n_nationkey int, outcome string, holder string, completed boolean")


def stuck_claims(spark, sf_dir):
    """Claims left open, as a sweep tells them."""
    told: list = []
    reg, _ = _registrar(spark, lambda kind, event: told.append((kind, event["batch_id"], event["owner"], event["claimed_at"])))
    for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect():
        reg.claims.claim("feed/x", f"b{r.n_nationkey}", r.n_name, {}, 100.0 * r.n_nationkey)
        if r.n_nationkey % 3 == 0:
            reg.claims.complete("feed/x", f"b{r.n_nationkey}", r.n_name)
    reg.stuck(2700.0)
    return spark.createDataFrame(told, "kind string, batch_id string, owner string, claimed_at string")


def overdue_sweep(spark, sf_dir):
    """Events of a sweep; a second sweep tells nothing again."""
    told: list = []
    reg, _ = _registrar(spark, lambda kind, event: told.append((kind, event["feed_id"], event["expected_date"], event["expected_by"])) if kind == "delivery-overdue" else None)
    for r in _requests(spark, sf_dir):
        reg.register(r, r.received_at)
    feeds = table(spark, sf_dir, "region").select(F.concat(F.lit("feed/"), F.col("r_regionkey").cast("string")).alias("feed_id"), F.lit("daily").alias("expected"), F.lit("09:00").alias("by"), F.lit("UTC").alias("timezone"))
    marked: set = set()
    for _ in range(2):
        reg.overdue(feeds, datetime.datetime(2026, 1, 4, 10, tzinfo=UTC), marked)
    return spark.createDataFrame(told, "kind string, feed_id string, expected_date string, expected_by string")


def pulled_feed(spark, sf_dir):
    """A folder pulled in three runs: by a budget of bytes, then the rest, then nothing new."""
    at, out = scratch(spark, "pull"), []
    for status, uri in _statuses(spark, sf_dir).items():
        objects.copied(spark, uri, f"{at}/in/{status}.csv")
    reg, _ = _registrar(spark, lambda *_: None)
    feed = acquisition.Feed("feed/orders", "pipelines/orders", "*.csv")
    for run, budget in enumerate((0, 1 << 40, 1 << 40)):
        found = acquisition.pull(reg, feed, f"{at}/in", f"{at}/stage", budget=budget)
        out.append((run, len(found.plans), found.carried))
    rows = ledger.registered(reg.table.read()[0]).select(F.col("delivery_key").alias("name"), "size_bytes", F.col("object_uris")[0].alias("uri"))
    copies = objects.digests(spark, [r.uri for r in rows.collect()]).select(F.element_at(F.split("uri", "/"), -1).alias("name"), F.col("bytes").alias("copied"))
    runs = spark.createDataFrame(out, "run int, registered int, carried int")
    told = F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", F.col("run").cast("string"), F.col("registered").cast("string"), F.col("carried").cast("string")))), " ")
    return rows.join(copies, "name").select("name", "size_bytes", "copied").crossJoin(runs.agg(told.alias("runs")))  # one row


def pulled_manifests(spark, sf_dir):
    """Manifests of complete, incomplete and defective deliveries in one folder."""
    at, found = scratch(spark, "manifests"), _statuses(spark, sf_dir)
    files, shas = SharedFiles(spark), {}
    for status, uri in found.items():
        shas[status] = objects.copied(spark, uri, f"{at}/in/{status}.csv")
    entry = lambda s, **more: {"name": f"{s}.csv", "bytes": shas[s][0], "sha256": shas[s][1]} | more
    texts = {"good": ("feed/orders", [entry("F"), entry("O")]), "size": ("feed/orders", [entry("P", bytes=1)]), "sha": ("feed/orders", [entry("P", sha256="0" * 64)]), "gone": ("feed/orders", [entry("F", name="Z.csv")]), "foreign": ("feed/other", [entry("P")])}
    for name, (feed_id, entries) in texts.items():
        files.put(f"{at}/in/{name}.manifest.json", json.dumps({"manifest_version": 1, "manifest_id": name, "feed_id": feed_id, "files": entries}).encode())
    files.put(f"{at}/in/odd.manifest.json", b"{")
    reg, _ = _registrar(spark, lambda *_: None)
    acquisition.pull(reg, acquisition.Feed("feed/orders", "pipelines/orders", "*.manifest.json", "manifest"), f"{at}/in", f"{at}/stage")
    return ledger.latest(reg.table.read()[0]).select("delivery_key", "disposition", "notes", F.size(F.filter("objects", lambda o: o["role"] == "data")).alias("files"))


def routed_runs(spark, sf_dir):
    """Events routed to runs: each batch starts once, other pipelines are ignored."""
    started: dict = {}
    out = []
    for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect():
        event = {"pipeline": f"pipelines/p{r.n_regionkey}", "feed_id": "f", "delivery_id": r.n_name, "batch_id": f"b{r.n_nationkey % 4}", "object_uris": ["u"], "received_at": "t", "secret": "x"}
        out.append((r.n_nationkey, acquisition.route(event, [f"pipelines/p{i}" for i in range(4)], lambda name, payload: started.setdefault(name, payload) is payload)))
    names = {name for name in started}
    return spark.createDataFrame([(k, how, len(names), all("secret" not in p for p in started.values())) for k, how in out], "n_nationkey int, how string, runs int, payloads_clean boolean")


# -- names and values


def object_paths(spark, sf_dir):
    """Where the objects of a delivery are put, and which addresses are not of it."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("at"))
    feed, delivery = F.concat(F.lit("feed/"), (F.col("o_orderkey") % 5).cast("string")), F.col("o_orderkey").cast("string")
    prefix = X.object_prefix("s3://lake/land/", feed, F.col("at"), delivery)
    parts = X.split_uri(F.concat(prefix, F.lit("x.csv")))
    return o.select("o_orderkey", prefix.alias("prefix"), parts["bucket"].alias("bucket"), F.length(parts["key"]).alias("key_length"))


def consistent_addresses(spark, sf_dir):
    out = []
    for r in table(spark, sf_dir, "nation").orderBy("n_nationkey").collect():
        uri = f"s3://lake/feed/{r.n_regionkey}/received_at=20260101T000000000000Z/dl-d{r.n_nationkey}/x.csv"
        odd = {0: uri, 1: uri.replace("/dl-", "/dx-"), 2: uri + "/y", 3: uri.replace("Z/", "/"), 4: uri.replace("x.csv", "a%20b.csv")}[r.n_nationkey % 5]
        out.append((r.n_nationkey, not acquisition.consistent_uris([odd], f"feed/{r.n_regionkey}", f"d{r.n_nationkey}")))
    return spark.createDataFrame(out, "n_nationkey int, consistent boolean")


def _tried(action, *values):
    out = []
    for v in values:
        try:
            out.append((str(v), str(action(v))))
        except ValueError:
            out.append((str(v), None))
    return out


def identifiers(spark, sf_dir):
    return spark.createDataFrame(_tried(X.identifier, "a.b", "t1", "lake.x.y_z", "a b", "1a", "a..b", "a;drop", "", "`a`"), "name string, quoted string")


def type_grammar(spark, sf_dir):
    return spark.createDataFrame(_tried(lambda t: ColumnType.parse(t).spark, "string", "int", "long", "bool", "decimal(5,2)", "decimal(38,0)", "date(yyyy-MM-dd)", "timestamp(yyyy-MM-dd'T'HH:mm)", "decimal(39,1)", "decimal(2,3)", "date()", "date(bbb)", "array<int>", "Int"), "type string, engine string")


def run_arguments(spark, sf_dir):
    cases = ("--a 1 --b=2", "--a=", "x", "--a", "--a --b", "--a=1 --a=2", "--a=x=y")
    return spark.createDataFrame(_tried(lambda t: json.dumps(acquisition.arguments(t.split()), sort_keys=True), *cases), "argv string, parsed string")


def half_open_window(spark, sf_dir):
    """Orders of the years from 1996 to 1998, the end left out."""
    at = lambda x: F.lit(x).cast("timestamp")
    return table(spark, sf_dir, "orders").select("o_orderkey", decisions.within(F.col("o_orderdate").cast("timestamp"), at("1996-01-01"), at("1998-01-01")).alias("inside"))


def author_findings(spark, sf_dir):
    """What the check of authors' functions says about one-line transforms."""
    cases = {
        "sum": "valid.groupBy('a').agg(F.sum('b'))", "group count": "valid.groupBy('a').count()", "count": "valid.count()", "plus": "valid.where('a = ' + x)", "percent": "valid.where('a = %s' % x)", "f": "valid.where(f'a = {x}')",
        "format": "valid.where('a = {}'.format(x))", "plain": "valid.where('a = 1')", "columns": "valid.where((F.col('a') > 1) & (F.col('b') == 'x'))", "collect": "valid.collect()", "open": "open('x')",
    }
    return spark.createDataFrame([(k, "; ".join(w for _, w in purity.findings(f"def apply(valid, co):\n    return {v}\n"))) for k, v in cases.items()], "name string, findings string")


QUERIES = [
    delivery_headers, delivery_gzip, delivery_defects, multiline_rows, object_digests, copied_objects, manifest_parse, feed_registry, pinned_version, own_commits, vacuumed_table, table_ddl, bucketed_merge, run_ledger, run_events,
    publish_counts, row_locators, set_once, run_messages, structural_check, contract_probe, detail_cut, empty_shapes, registration_run, registration_events, feed_scan, ledger_table, ledger_current, ledger_for_batch, claim_outcomes,
    stuck_claims, overdue_sweep, pulled_feed, pulled_manifests, routed_runs, object_paths, consistent_addresses, identifiers, type_grammar, run_arguments, half_open_window, author_findings,
]

_HEADED_SQL = """
WITH x AS (SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS s, o_orderpriority AS p, o_orderkey % 37 = 0 AS short, CAST(o_orderkey % 3 + 1 AS INTEGER) AS seq FROM orders),
y AS (SELECT *, row_number() OVER (PARTITION BY seq ORDER BY k) AS row_index FROM x WHERE short OR k % 41 > 0)
SELECT seq AS object_seq, row_index, CASE WHEN NOT short THEN CAST(c AS VARCHAR) END AS domain_id, CASE WHEN NOT short AND seq < 3 AND k % 7 > 0 THEN CAST(k AS VARCHAR) END AS payload,
  CASE WHEN short THEN 'short' END AS malformed_text, CASE WHEN NOT short THEN CASE seq WHEN 1 THEN s WHEN 3 THEN 'x, "y"' END END AS extra_col, CASE WHEN NOT short AND seq = 3 THEN p END AS other,
  CAST(CASE WHEN short THEN 0 ELSE [1, 0, 2][seq] END AS INTEGER) AS extras FROM y"""
_OBJECTS = "o AS (SELECT o_orderstatus AS status, 'start' || chr(10) || string_agg(o_orderkey || ',' || o_custkey, chr(10) ORDER BY o_orderkey) || chr(10) AS body FROM orders GROUP BY 1)"
_Q = """q AS (SELECT n_nationkey AS k, n_regionkey AS g, 'feed/' || n_regionkey AS feed_id, 'd' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') AS id, n_nationkey // 10 AS c, TIMESTAMP '2026-01-01 12:00:00' + to_hours(n_nationkey) AS came FROM nation),
f AS (SELECT *, row_number() OVER (PARTITION BY feed_id, c ORDER BY k) = 1 AS won FROM q),
w AS (SELECT *, lag(id) OVER (PARTITION BY feed_id ORDER BY k) AS p, lead(id) OVER (PARTITION BY feed_id ORDER BY k) AS nx FROM f WHERE won)"""
_LANE = f"""WITH {lane._D}, r AS (SELECT *, broken OR source_ts = 'x' OR domain_id IS NULL AS pre FROM d), c AS (
  SELECT count(*) AS n, count_if(pre) AS q1, count_if(NOT pre AND content_hash = 'P') AS q2, count(DISTINCT domain_id) FILTER (NOT pre AND content_hash <> 'P') AS m FROM r)"""


def _values(names: str, *rows: tuple) -> str:
    shown = lambda v: "NULL" if v is None else str(v).lower() if isinstance(v, bool) else str(v) if isinstance(v, int) else "'" + v.replace("'", "''") + "'"
    return f"SELECT * FROM (VALUES {', '.join('(' + ', '.join(map(shown, r)) + ')' for r in rows)}) t({names})"


SQL = {
    "delivery_headers": _HEADED_SQL,
    "delivery_gzip": _HEADED_SQL,
    "delivery_defects": _values(
        "\"case\", records, fault", ("fine", 25, None), ("missing", None, "object 1: required columns are missing: domain_id"), ("repeated", None, "object 1: 1 header names repeat"), ("open", None, "object 1: no readable header"),
        ("none", None, "object 1: no readable header"), ("gzip stated", None, "object 1: gzip is stated but the name has no such suffix"), ("none stated", None, "object 1: no compression is stated but the name has the suffix of one"),
    ),
    "multiline_rows": """
WITH x AS (SELECT o_orderkey AS k, o_orderstatus AS s, o_orderkey % 11 = 0 AS ragged FROM orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 17 > 0)
SELECT row_number() OVER (ORDER BY k) AS row_index, CASE WHEN NOT ragged THEN CAST(k AS VARCHAR) END AS domain_id,
  CASE WHEN ragged THEN NULL WHEN k % 13 = 0 THEN 'xy' ELSE 'two' || chr(10) || 'lines "' || s || '"' END AS payload, CASE WHEN ragged THEN 'broken,"a' || chr(10) || 'b",' || k || chr(10) END AS malformed_text FROM x
UNION ALL SELECT count(*) + 1, 'end', 'open' || chr(10) || 'and, on' || chr(10), NULL FROM x""",
    "object_digests": f"WITH {_OBJECTS} SELECT status, octet_length(encode(body)) AS bytes, sha256(body) AS sha256, right(body, 40) AS tail, CAST(least(length(body), 4096) AS INTEGER) AS tail_length FROM o",
    "copied_objects": f"WITH {_OBJECTS} SELECT status, octet_length(encode(body)) AS bytes, sha256(body) AS sha256, true AS equal, octet_length(encode(body)) AS listed FROM o",
    "manifest_parse": """
WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey = 7 THEN 'too-large' ELSE [NULL, 'manifest_version', 'manifest_id', 'files', 'files.entry', 'files.entry', 'unparseable', NULL, NULL][o_orderkey % 9 + 1] END AS fault FROM orders)
SELECT o_orderkey, fault, CASE WHEN fault IS NULL THEN CAST(o_orderkey AS VARCHAR) END AS manifest_id, CAST(CASE WHEN fault IS NULL THEN 1 END AS INTEGER) AS files, CAST(CASE WHEN fault IS NULL THEN 7 END AS BIGINT) AS record_count FROM x""",
    "feed_registry": "SELECT 'feed/' || replace(lower(n_name), ' ', '-') AS feed_id, CAST(n_regionkey AS INTEGER) AS region, true AS cached, true AS reserved_refused FROM nation",
    "pinned_version": "SELECT 'b' || (o_orderkey % 3) AS batch_id, count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys, CAST(v AS INTEGER) AS version FROM orders, range(4) t(v) WHERE o_orderkey % 3 <= v GROUP BY 1, v",
    "own_commits": "SELECT r_name AS batch_id, true AS repeated_left_out, CAST(r_regionkey AS BIGINT) AS version, (SELECT count(*) FROM nation WHERE n_regionkey = r_regionkey) AS rows, CAST(NULL AS BIGINT) AS other_stage FROM region",
    "vacuumed_table": "SELECT count(*) AS n, CAST(sum(o_custkey) AS BIGINT) AS keys, 0 AS young_removed, true AS in_flight_kept, 3 AS old_removed FROM orders",
    "table_ddl": _values("name, type, before, after", *((n, k, 0, 1) for n, k in (
        ("batch_id", "string"), ("delivery_id", "string"), ("feed_id", "string"), ("received_at", "timestamp"), ("source_uri", "string"), ("object_seq", "int"), ("row_index", "bigint"), ("read_spec_version", "string"),
        ("malformed_text", "string"), ("a", "string"), ("b", "string"), ("extras", "map<string,string>"), ("c", "string")))),
    "bucketed_merge": "SELECT o_custkey, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS o_orderdate, o_totalprice, o_orderkey, 1 AS rewritten, 3 AS version FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_totalprice DESC, o_orderkey DESC) AS k FROM orders) WHERE k = 1",
    "run_ledger": _LANE + """ SELECT stage, outcome, raw_count, pre_quarantined, post_quarantined, facts_appended, rows_merged, runs FROM c, LATERAL (VALUES
  ('land', 'ok', n, NULL, NULL, NULL, NULL, 1), ('land', 'skipped-guard', n, NULL, NULL, NULL, NULL, 1), ('pre_check', 'ok', NULL, q1, NULL, NULL, NULL, 1), ('pre_check', 'skipped-guard', NULL, q1, NULL, NULL, NULL, 1),
  ('pull', 'ok', NULL, NULL, NULL, NULL, NULL, 2), ('apply', 'ok', NULL, NULL, NULL, NULL, NULL, 2), ('post_check', 'ok', NULL, NULL, q2, NULL, NULL, 1), ('post_check', 'skipped-guard', NULL, NULL, q2, NULL, NULL, 1),
  ('commit', 'ok', NULL, NULL, NULL, n - q1 - q2, NULL, 1), ('commit', 'skipped-guard', NULL, NULL, NULL, 0, NULL, 1), ('fold', 'ok', NULL, NULL, NULL, NULL, m, 1), ('fold', 'ok', NULL, NULL, NULL, NULL, 0, 1),
  ('publish', 'ok', NULL, NULL, NULL, NULL, NULL, 2)) t(stage, outcome, raw_count, pre_quarantined, post_quarantined, facts_appended, rows_merged, runs)""",
    "run_events": _LANE + """ SELECT 'batch-started' AS kind, 'pipelines/orders' AS pipeline, 'batch' AS batch_id, n AS raw_count, CAST(NULL AS BIGINT) AS pre_quarantined, CAST(NULL AS BIGINT) AS post_quarantined, CAST(NULL AS BIGINT) AS fact_count FROM c
UNION ALL SELECT 'batch-completed', 'pipelines/orders', 'batch', n, q1, q2, n - q1 - q2 FROM c""",
    "publish_counts": _LANE + " SELECT 'raw' AS what, n FROM c UNION ALL SELECT 'pre_check', q1 FROM c UNION ALL SELECT 'post_check', q2 FROM c UNION ALL SELECT 'facts', n - q1 - q2 FROM c",
    "row_locators": "SELECT count(*) AS records, true AS without_gap, true AS objects_numbered FROM orders",
    "set_once": "SELECT r_name AS name, CAST(r_regionkey AS INTEGER) AS raw_count, false AS again FROM region",
    "run_messages": "SELECT r_name AS name, kind, CASE kind WHEN 'contract' THEN 'ContractError: column ' || r_regionkey ELSE 'hidden' END AS message FROM region, (VALUES ('contract'), ('value')) t(kind)",
    "structural_check": """
WITH x AS (SELECT count(*) AS n FROM lineitem WHERE l_orderkey % 97 = 0 OR l_orderkey % 89 = 0 AND l_linenumber = 1)
SELECT 'as expected' AS name, '' AS faults UNION ALL SELECT 'nulls', n || ' rows without domain_id' FROM x UNION ALL SELECT 'both', n || ' rows without domain_id; columns differ: missing [''more''], added [''flag'']' FROM x""",
    "contract_probe": _values("name, runs", ("fine", True), ("bound", False), ("order", False), ("pattern", False), ("plain", True)),
    "detail_cut": """
WITH x AS (SELECT event_id, CAST(event_id % 41 AS INTEGER) AS n FROM events WHERE event_id % 41 > 0)
SELECT event_id, 'contract/cast-failure' AS reason_code, '[' || array_to_string(list_transform(range(least(n, 32)), lambda i: '{"code":"contract/cast-failure","column":"c' || i || '","expected":"int"}'), ',')
  || CASE WHEN n > 32 THEN ',{"truncated":' || n || '}' ELSE '' END || ']' AS reason_detail FROM x""",
    "empty_shapes": _values("frame, rows, columns", ("raw", 0, 11), ("refused", 0, 13), ("admitted", 0, 6), ("left", 0, 6)),
    "registration_run": f"WITH {_Q} SELECT feed_id, id AS delivery_id, CASE WHEN nx IS NULL THEN 'registered' ELSE 'superseded' END AS disposition, p AS supersedes, 1 AS uris FROM w UNION ALL SELECT feed_id, id, 'duplicate', NULL, 0 FROM f WHERE NOT won",
    "registration_events": f"WITH {_Q} SELECT 'delivery-registered' AS type, feed_id, id AS delivery_id, CAST(1 AS BIGINT) AS schema_version, strftime(came, '%Y-%m-%dT%H:%M:%SZ') AS received_at, 1 AS uris FROM w",
    "feed_scan": f"WITH {_Q} SELECT feed_id, id AS delivery_id, 'registered' AS disposition FROM w WHERE k >= 10 UNION ALL SELECT feed_id, id, 'superseded' FROM w WHERE k >= 10 AND nx IS NOT NULL UNION ALL SELECT feed_id, id, 'duplicate' FROM f WHERE k >= 10 AND NOT won",
    "ledger_table": f"WITH {_DISTINCT} SELECT feed_id, delivery_id, CAST(row_number() OVER (ORDER BY received_at, delivery_id) AS INTEGER) AS place FROM reg",
    "ledger_current": f"WITH {_DISTINCT} SELECT feed_id, delivery_key, CAST(row_number() OVER (ORDER BY feed_id, delivery_key) AS INTEGER) AS place FROM latest",
    "ledger_for_batch": f"WITH {_DISTINCT} SELECT batch_id, delivery_id, disposition, true AS in_order FROM one WHERE batch_id IN ('b0', 'b7', 'b30')",
    "claim_outcomes": """
WITH x AS (SELECT n_nationkey AS k, n_name, min(n_nationkey) OVER (PARTITION BY n_regionkey % 2) AS first, first_value(n_name) OVER (PARTITION BY n_regionkey % 2 ORDER BY n_nationkey) AS held,
  min(CASE WHEN n_nationkey >= f + 2 THEN n_nationkey END) OVER (PARTITION BY n_regionkey % 2) AS took FROM (SELECT *, min(n_nationkey) OVER (PARTITION BY n_regionkey % 2) AS f FROM nation))
SELECT k AS n_nationkey, CASE WHEN k = first THEN 'WON' WHEN k < took THEN 'LOST_IN_PROGRESS' WHEN k = took THEN 'TAKEN_OVER' ELSE 'LOST_COMPLETED' END AS outcome, CASE WHEN k > first THEN held END AS holder, coalesce(k = took, false) AS completed FROM x""",
    "stuck_claims": "SELECT 'claim-stuck' AS kind, 'b' || n_nationkey AS batch_id, n_name AS owner, strftime(TIMESTAMP '1970-01-01' + to_seconds(100 * n_nationkey), '%Y-%m-%dT%H:%M:%SZ') AS claimed_at FROM nation WHERE n_nationkey < 15 AND n_nationkey % 3 > 0",
    "overdue_sweep": f"""WITH {_Q}, days AS (SELECT 'feed/' || r_regionkey AS feed_id, DATE '2026-01-01' + CAST(i AS INTEGER) AS day FROM region, range(4) t(i))
SELECT 'delivery-overdue' AS kind, feed_id, CAST(day AS VARCHAR) AS expected_date, day || 'T09:00:00Z' AS expected_by FROM days WHERE (feed_id, day) NOT IN (SELECT (feed_id, CAST(came AS DATE)) FROM w WHERE nx IS NULL)""",
    "pulled_feed": f"WITH {_OBJECTS} SELECT status || '.csv' AS name, octet_length(encode(body)) AS size_bytes, octet_length(encode(body)) AS copied, '0:1:2 1:2:0 2:0:0' AS runs FROM o",
    "pulled_manifests": _values(
        "delivery_key, disposition, notes, files", ("good", "registered", None, 2), ("size", "incomplete", "P.csv byte-size mismatch", 1), ("sha", "unreadable", "P.csv sha256 mismatch", 1), ("gone", "incomplete", "Z.csv not present", 0),
        ("foreign", "unreadable", "manifest feed_id does not match", 1), ("odd.manifest.json", "unreadable", "unparseable", 0),
    ),
    "routed_runs": """
SELECT n_nationkey, CASE WHEN n_regionkey = 4 THEN 'ignored' WHEN row_number() OVER (PARTITION BY n_regionkey, n_nationkey % 4 ORDER BY n_nationkey) = 1 THEN 'started' ELSE 'exists' END AS how,
  (SELECT CAST(count(DISTINCT (n_regionkey, n_nationkey % 4)) AS INTEGER) FROM nation WHERE n_regionkey < 4) AS runs, true AS payloads_clean FROM nation""",
    "object_paths": """
WITH x AS (SELECT o_orderkey, 's3://lake/land/feed/' || (o_orderkey % 5) || '/received_at=' || strftime(o_orderdate, '%Y%m%dT%H%M%S%fZ') || '/dl-' || o_orderkey || '/' AS prefix FROM orders)
SELECT o_orderkey, prefix, 'lake' AS bucket, CAST(length(prefix) - 5 AS INTEGER) AS key_length FROM x""",
    "consistent_addresses": "SELECT n_nationkey, n_nationkey % 5 = 0 AS consistent FROM nation",
    "identifiers": _values("name, quoted", ("a.b", "`a`.`b`"), ("t1", "`t1`"), ("lake.x.y_z", "`lake`.`x`.`y_z`"), *((n, None) for n in ("a b", "1a", "a..b", "a;drop", "", "`a`"))),
    "type_grammar": _values(
        "type, engine", ("string", "string"), ("int", "int"), ("long", "bigint"), ("bool", "boolean"), ("decimal(5,2)", "decimal(5,2)"), ("decimal(38,0)", "decimal(38,0)"), ("date(yyyy-MM-dd)", "date"), ("timestamp(yyyy-MM-dd'T'HH:mm)", "timestamp"),
        *((n, None) for n in ("decimal(39,1)", "decimal(2,3)", "date()", "date(bbb)", "array<int>", "Int")),
    ),
    "run_arguments": _values("argv, parsed", ("--a 1 --b=2", '{"a": "1", "b": "2"}'), ("--a=", '{"a": ""}'), *((n, None) for n in ("x", "--a", "--a --b", "--a=1 --a=2")), ("--a=x=y", '{"a": "x=y"}')),
    "half_open_window": "SELECT o_orderkey, o_orderdate >= TIMESTAMP '1996-01-01' AND o_orderdate < TIMESTAMP '1998-01-01' AS inside FROM orders",
    "author_findings": _values(
        "name, findings", ("sum", ""), ("group count", ""), ("count", ".count"), *((n, "composed string in .where") for n in ("plus", "percent", "f", "format")), ("plain", ""), ("columns", ""), ("collect", ".collect"), ("open", "open()")
    ),
}
