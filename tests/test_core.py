"""Contracts, readers, canonical JSON, identities, tables, claims, registration and the check compiler."""

import csv
import datetime
import gzip
import hashlib
import io
import random
import time
import uuid
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirgate import contract as C
from weirgate.functions import canonical, identity
from weirgate.functions import text as X
from weirgate.operators import checks, decisions, fold, quarantine, subtract
from weirgate.operators.lineage import Lineage
from weirgate.plans import acquisition, purity
from weirgate.sinks import events
from weirgate.sources import delimited, objects
from weirgate.sources.tables import NO_VERSION, CommitConflict, Table, check_exact, merge, plan_ddl
from weirgate.streaming.admission import admission_stream

UTC = datetime.UTC


# ---------------------------------------------------------------- contracts


@pytest.mark.parametrize("text,spark", [("string", "string"), ("int", "int"), ("long", "bigint"), ("bool", "boolean"), ("decimal(38,38)", "decimal(38,38)"), ("date(yyyy-MM-dd)", "date"), ("timestamp(yyyy-MM-dd'T'HH:mm:ss)", "timestamp")])
def test_types_parse(text, spark):
    t = C.ColumnType.parse(text)
    assert t.spark == spark and str(t) == text


@pytest.mark.parametrize("text", ["float", "decimal(39,1)", "decimal(2,3)", "decimal(0,0)", "date()", "date(yyyy-bb)", "date(yyyy'x)", "array<int>", "Int"])
def test_other_types_are_refused(text):
    with pytest.raises(C.ContractError):
        C.ColumnType.parse(text)


def test_contract_rules():
    col = C.DeclaredColumn
    bad = [lambda: col("1x"), lambda: col("batch_id"), lambda: col("_weirgate_x"), lambda: col("x" * 129), lambda: col("a", allowed_values=()), lambda: col("a", pattern="("), lambda: col("a", min="1"), lambda: col("a", "int", min="5", max="4"), lambda: col("a", "int", min="x"), lambda: C.RawContract(()), lambda: C.RawContract((col("a"), col("a")))]
    bad += [lambda: C.ReadSpec(delimiter=",,"), lambda: C.ReadSpec(quote=","), lambda: C.ReadSpec(skip_leading_lines=5000), lambda: C.ReadSpec(compression="zstd"), lambda: C.ReadSpec(charset="latin-1"), lambda: C.ReadSpec(format="json")]
    bad += [lambda: C.PipelineSpec("p", C.RawContract((col("a", required=True),)), C.ReadSpec(header=False)), lambda: C.PipelineSpec("p", C.RawContract((col("a", nullable=False),)))]
    for make in bad:
        with pytest.raises(C.ContractError):
            make()
    raw = {"name": "p", "raw": {"columns": [{"name": "a", "type": "int", "allowed_values": ["1"]}]}, "read": {"delimiter": "|"}}
    a, b = C.from_mapping(raw), C.from_mapping({**raw, "read": {"delimiter": ";"}})
    assert C.check_version(a) == C.check_version(b) and C.read_spec_version(a) != C.read_spec_version(b) and len(C.check_version(a)) == 64
    with pytest.raises(C.ContractError):
        C.from_mapping({**raw, "colour": 1})


# ---------------------------------------------------------------- canonical JSON and identities


def test_canonical_column_equals_value(spark):
    rows = [
        (1, "a\"\\\b\f\n\r\t\x00\x1f/é𝄞�", Decimal("1.20"), datetime.date(2024, 2, 29), datetime.datetime(2024, 1, 2, 3, 4, 5, 6, tzinfo=UTC), {"b": "1", "a": None, "é": "\n"}, True, ["x", None], Decimal("0E-20")),
        (None, None, None, None, None, None, None, None, None),
        (-5, "", Decimal("-0.01"), datetime.date(1, 1, 1), datetime.datetime(1970, 1, 1, tzinfo=UTC), {}, False, [], Decimal("123456789012345678.00000000000000000001")),
    ]
    schema = "i long, s string, d decimal(10,2), day date, at timestamp, m map<string,string>, b boolean, l array<string>, e decimal(38,20)"
    df = spark.createDataFrame(rows, schema)
    out = df.select(canonical.row_snapshot(df).alias("s"), canonical.row_hash(canonical.row_snapshot(df)).alias("h")).collect()
    names = ["i", "s", "d", "day", "at", "m", "b", "l", "e"]
    for r, got in zip(rows, out, strict=True):
        value = dict(zip(names, r, strict=True))
        if value["e"] == 0 and value["e"] is not None:
            value["e"] = Decimal("0." + "0" * 20)
        want = canonical.canonical_text(value)
        assert got.s == want and got.h == hashlib.sha256(want.encode()).hexdigest()


def test_canonical_snapshot_vectors(spark):
    rows = [("abc-123", None, "PENDING", {"Order ID": "99", "notes": "n/a"}, None), (None, None, None, {}, 'abc-123,,PEND"ING,extra,tokens')]
    df = spark.createDataFrame(rows, "domain_id string, amount string, status string, extras map<string,string>, malformed_text string")
    got = [r[0] for r in df.select(canonical.row_hash(canonical.row_snapshot(df))).collect()]
    assert got == ["139bb895648d553da24a2bc76a56a51666d1e46e5b46768845d71f4354d50d1b", "26a0f4a83ca5d4d73dda95fa1eafda07c12a58b7a123e4490ce01f438ce80180"]
    for odd in (1.5, float("nan"), {1: 2}, datetime.datetime(2024, 1, 1), Decimal("NaN")):
        with pytest.raises(ValueError):
            canonical.canonical_text(odd)
    with pytest.raises(ValueError):
        canonical.row_snapshot(spark.createDataFrame([(1.5,)], "x double"))


def test_identities(spark):
    pairs = [("b", "2" * 64), ("a", "1" * 64), ("ü", "3" * 64)]
    h = identity.content_hash(pairs)
    assert h == identity.content_hash(reversed(pairs)) != identity.content_hash(pairs[:2])
    df = spark.createDataFrame(pairs, "name string, sha string")
    assert df.agg(identity.content_hash_agg(F.col("name"), F.col("sha"))).first()[0] == h
    for feed in ("feed/x", "feed/ü", ""):
        want = str(uuid.uuid5(identity.BATCH_NAMESPACE, f"{feed}\n{h}"))
        assert identity.batch_id(feed, h) == want == spark.range(1).select(identity.batch_id_of(F.lit(feed), F.lit(h))).first()[0]


# ---------------------------------------------------------------- reading


@pytest.mark.parametrize("d,q", [(",", '"'), ("|", "'"), ("^", '"')])
def test_tokenizer_equals_a_strict_reader(spark, d, q):
    dice = random.Random(7)
    lines = sorted({"".join(dice.choice([d, q, q + q, "a", " ", "é", "\t", "\\"]) for _ in range(dice.randrange(12))) for _ in range(3000)})

    def strict(line):
        try:
            return next(csv.reader(io.StringIO(line), delimiter=d, quotechar=q, strict=True), [])
        except csv.Error:
            return None

    df = spark.createDataFrame([(x,) for x in lines], "line string")
    ok = X.well_formed(F.col("line"), d, q)
    for r in df.select("line", ok.alias("ok"), F.when(ok, X.tokens(F.col("line"), d, q)).alias("t")).collect():
        want = strict(r.line)
        assert (r.t if r.ok else None) == want, r.line


def contract(*names, **more):
    return C.RawContract(tuple(C.DeclaredColumn(n, required=n == "domain_id") for n in names), **more)


def test_delivery_with_extras_ragged_lines_and_locators(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes(b"\xef\xbb\xbfdomain_id,payload,Extra Col\nx1,p1,e1\n\nx2,,\n\"x3\",\"q\"\"q\",z\nshort\nx4,\"open,1\nx5,a\xffb,y\n")
    (tmp_path / "b.csv").write_bytes(b"payload,domain_id\r\np9,x9\r\n")
    uris = [str(tmp_path / "b.csv"), str(tmp_path / "a.csv")]
    rows = delimited.read_delivery(spark, uris, C.ReadSpec(), contract("domain_id", "payload", "absent")).orderBy("object_seq", "row_index").collect()
    got = [(r.object_seq, r.row_index, r.domain_id, r.payload, r.absent, r.extras, r.malformed_text) for r in rows]
    assert got == [
        (1, 1, "x1", "p1", None, {"Extra Col": "e1"}, None), (1, 2, "x2", None, None, {"Extra Col": ""}, None), (1, 3, "x3", 'q"q', None, {"Extra Col": "z"}, None),
        (1, 4, None, None, None, {}, "short"), (1, 5, None, None, None, {}, 'x4,"open,1'), (1, 6, "x5", "a�b", None, {"Extra Col": "y"}, None), (2, 1, "x9", "p9", None, {}, None),
    ]
    assert [r.source_uri for r in rows][-1] == uris[0]


def test_preamble_gzip_headerless_and_split_files(spark, tmp_path):
    with gzip.open(tmp_path / "g.csv.gz", "wt") as f:
        f.write("preamble\ndomain_id;n\na;1\n")
    spec = C.ReadSpec(delimiter=";", compression="gzip", skip_leading_lines=1)
    assert [(r.domain_id, r.n) for r in delimited.read_delivery(spark, [str(tmp_path / "g.csv.gz")], spec, contract("domain_id", "n")).collect()] == [("a", "1")]
    flat = C.RawContract((C.DeclaredColumn("domain_id"), C.DeclaredColumn("n")))
    (tmp_path / "big.csv").write_text("".join(f"k{i},{i}\n" + ("\n" if i % 5 == 0 else "") for i in range(20000)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        df = delimited.read_delivery(spark, [str(tmp_path / "big.csv")], C.ReadSpec(header=False), flat)
        assert df.where("row_index <> cast(n as bigint) + 1").count() == 0 and df.count() == 20000
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    with pytest.raises(C.ContractError):
        delimited.read_delivery(spark, ["x.csv.gz"], C.ReadSpec(), flat)
    with pytest.raises(C.ContractError):
        delimited.read_delivery(spark, ["x.csv"], C.ReadSpec(compression="gzip"), flat)
    assert delimited.read_delivery(spark, [], C.ReadSpec(), flat).count() == 0


def test_multiline_records(spark, tmp_path):
    (tmp_path / "m.csv").write_text('domain_id,payload\na,"two\nlines"\n\nb,x\nc,"open\nrest\n')
    rows = delimited.read_delivery(spark, [str(tmp_path / "m.csv")], C.ReadSpec(multiline=True), contract("domain_id", "payload")).orderBy("row_index").collect()
    assert [(r.domain_id, r.payload) for r in rows] == [("a", "two\nlines"), ("b", "x"), ("c", "open\nrest\n")]  # a quote that never closes takes the rest
    flat = C.RawContract((C.DeclaredColumn("domain_id"), C.DeclaredColumn("n")))
    (tmp_path / "n.csv").write_bytes(b'1,2\r\n3,"x"y\r5,6\n7,8,"a\r\nb"\n' + b"9," + b"z" * 300_000 + b"\n")
    rows = delimited.read_delivery(spark, [str(tmp_path / "n.csv")], C.ReadSpec(header=False, multiline=True), flat).orderBy("row_index").collect()
    assert [(r.domain_id, r.n, r.malformed_text) for r in rows] == [("1", "2", None), ("3", "xy", None), ("5", "6", None), (None, None, '7,8,"a\r\nb"\n'), ("9", "z" * 300_000, None)]
    (tmp_path / "many.csv").write_text("skipped\n" + "".join(f'{i},"v\n{i}"\n' for i in range(5000)))
    df = delimited.read_delivery(spark, [str(tmp_path / "many.csv")], C.ReadSpec(header=False, multiline=True, skip_leading_lines=1), flat)
    assert df.count() == 5000 and df.where("row_index <> cast(domain_id as bigint) + 1").count() == 0


def test_manifests_listings_and_tails(spark, tmp_path):
    good = '{"manifest_version":1,"manifest_id":"m","feed_id":"f","files":[{"name":"a","bytes":1,"sha256":"' + "a" * 64 + '"}],"more":1}'
    texts = [good, "{", '{"manifest_version":2}', good.replace('"m"', '""'), good.replace('"bytes":1', '"bytes":-1'), good.replace('"files":[', '"files":[],"x":['), None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = {r.i: r.p for r in df.select("i", objects.parse_manifests(F.col("t")).alias("p")).collect()}
    assert [got[i].fault for i in range(7)] == [None, "unparseable", "manifest_version", "manifest_id", "files.entry", "files", "unparseable"]
    (tmp_path / "one.bin").write_bytes(b"x" * 5000 + b"\nTOTAL:7\n")
    assert objects.listing(spark, str(tmp_path), "*.bin").first().bytes == 5009
    r = objects.digests(spark, [str(tmp_path / "one.bin")]).first()
    assert r.sha256 == hashlib.sha256((tmp_path / "one.bin").read_bytes()).hexdigest() and len(r.tail) == 4096
    v = decisions.trailer_verdict(F.lit(r.tail), r"TOTAL:(\d+)", 1)
    named = decisions.trailer_verdict(F.lit("x\nEND a 12\n"), r"END (?P<tag>\w) (?P<rows>\d+)", "rows")
    assert tuple(spark.range(1).select(v).first()[0]) == ("complete", 7) and tuple(spark.range(1).select(named).first()[0]) == ("complete", 12)


# ---------------------------------------------------------------- checks, subtraction, folds


def test_detail_is_cut_at_32(spark):
    c = C.RawContract(tuple(C.DeclaredColumn(f"c{i}", "int") for i in range(40)))
    df = spark.createDataFrame([("x",) * 40], ", ".join(f"c{i} string" for i in range(40))).withColumns({"malformed_text": F.lit(None).cast("string"), "extras": F.create_map(F.lit("a"), F.lit("b"))})
    r = checks.violations(df, checks.compile_contract(c)).first()
    assert r.reason_detail.count('"code"') == 32 and r.reason_detail.endswith('{"truncated":40}]')


def test_each_cell_is_cast_once(spark):
    c = checks.compile_contract(C.RawContract((C.DeclaredColumn("n", "decimal(9,2)", min="2", max="45"), C.DeclaredColumn("day", "date(yyyy-MM-dd)", min="2024-01-01"), C.DeclaredColumn("s", pattern="a+"))))
    raw = spark.range(3).select(F.col("id").cast("string").alias("n"), F.lit("2024-02-0").alias("day"), F.lit("a").alias("s"), F.lit(None).cast("string").alias("malformed_text"), F.create_map(F.lit("k"), F.lit("v")).alias("extras"))
    stored = spark.createDataFrame(raw.collect(), raw.schema)
    for df in (checks.admitted(stored, c), checks.violations(stored, c), checks.counts(stored, c)):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        casts = [line for line in plan.splitlines() if "gettimestamp(day" in line or "cast(n#" in line]
        assert len(casts) == 1 and casts[0].count("gettimestamp(day") == 1 == casts[0].count("cast(n#"), plan


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts_are_the_same_under_ansi(spark, ansi):
    from weirgate.functions.casts import typed

    cases = [("int", " 42 ", "42"), ("int", "007", "7"), ("int", "1.5", None), ("int", "99999999999", None), ("int", "-5", "-5"), ("int", "+6\t", "6"), ("long", "12x", None), ("long", "x", None), ("int", "", None), ("long", "99999999999", "99999999999"), ("decimal(5,2)", "1.239", "1.24"), ("decimal(5,2)", "9999.99", None), ("decimal(5,2)", "1.5e2", "150.00"), ("bool", "Yes", "true"), ("bool", "maybe", None), ("date(yyyy-MM-dd)", "2024-02-30", None), ("date(yyyy-MM-dd)", "2024-2-3", None), ("timestamp(yyyy-MM-dd HH:mm)", "2024-01-02 03:04", "2024-01-02 03:04:00")]
    old = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        got = spark.range(1).select(*(typed(F.lit(t), C.ColumnType.parse(k)).cast("string").alias(str(i)) for i, (k, t, _) in enumerate(cases))).first()
        assert list(got) == [w for *_, w in cases]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", old)


def test_bound_contract_probe(spark):
    checks.probe(C.RawContract((C.DeclaredColumn("a", "date(yyyy-MM-dd)", min="2024-01-01"),)), spark)
    for bad in (C.DeclaredColumn("a", "date(yyyy-MM-dd)", min="x"), C.DeclaredColumn("a", "date(yyyy-MM-dd)", min="2024-01-02", max="2024-01-01"), C.DeclaredColumn("a", pattern="(?P<x>a)")):
        with pytest.raises(C.ContractError):
            checks.probe(C.RawContract((bad,)), spark)


def test_bag_subtraction_is_null_safe_and_keeps_multiplicity(spark):
    rows = spark.createDataFrame([("a", None)] * 3 + [("b", 1)], "x string, y int")
    taken = spark.createDataFrame([("a", None)], "x string, y int")
    assert sorted(map(tuple, subtract.bag_subtract(rows, taken).collect()), key=str) == [("a", None), ("a", None), ("b", 1)]
    assert subtract.bag_subtract(rows, taken.select("x")).count() == 3
    maps = rows.withColumn("m", F.create_map(F.lit("k"), F.col("x")))
    assert subtract.bag_subtract(maps, maps.limit(2)).count() == 2 and subtract.bag_subtract(rows, spark.range(3)).count() == 4


def test_fold_ties_nulls_and_order_of_batches(spark):
    schema = "domain_id string, event_time string, source_ts string, content_hash string, v string"
    rows = [("a", "1", None, "h", "old"), ("a", "1", "0", "h", "new"), ("b", None, "9", "z", "null is lowest"), ("b", "0", None, None, "wins"), ("c", "1", "1", "1", "x"), ("c", "1", "1", "1", "y")]
    facts = spark.createDataFrame(rows, schema)
    assert {r.domain_id: r.v for r in fold.winners(facts, "domain_id").collect()} == {"a": "new", "b": "wins", "c": "y"}
    one, two = facts.where("v in ('old', 'wins')"), facts.where("v in ('new', 'null is lowest')")
    empty = facts.limit(0)
    ends = [{r.domain_id: r.v for r in fold.fold(fold.fold(empty, a, "domain_id"), b, "domain_id").collect()} for a, b in ((one, two), (two, one))]
    assert ends[0] == ends[1] == {"a": "new", "b": "wins"}


def test_quarantine_shapes(spark):
    lin = Lineage("b", "d", "f", datetime.datetime(2026, 1, 1, tzinfo=UTC))
    rows = spark.createDataFrame([(1, "x", "business/late"), (2, "y", "Business/late"), (3, "z", None)], "domain_id int, v string, reason string")
    out = quarantine.post_check(rows, lin, "cv", lin.received_at, "domain_id")
    assert out.columns == list(quarantine.NAMES) and {r.domain_id for r in out.collect()} == {"1", "2", "3"}
    assert {r.domain_id for r in quarantine.bad_reasons(rows).collect()} == {2, 3}
    hashes = {r.row_hash for r in quarantine.candidate_hashes(rows.drop("reason")).collect()}
    assert hashes == {r.row_hash for r in out.collect()}


def test_approximate_durations_are_near_the_exact_ones(spark):
    from weirgate.operators import ops

    at = F.timestamp_millis(F.col("id"))
    runs = spark.range(5000).select(F.lit("fold").alias("stage"), F.lit("ok").alias("outcome"), F.timestamp_millis(F.lit(0)).alias("started_at"), at.alias("finished_at"), F.current_timestamp().alias("recorded_at"))
    near, exact = (ops.stage_durations(runs, exact=e).first() for e in (False, True))
    assert near.sample_count == exact.sample_count == 5000 and abs(near.p50_ms - exact.p50_ms) <= 1 and abs(near.p95_ms - exact.p95_ms) <= 1


# ---------------------------------------------------------------- tables


def test_versions_stamps_and_conflicts(spark, tmp_path):
    t = Table(spark, str(tmp_path / "t"), ("batch_id",))
    assert t.version() == NO_VERSION and not t.has_batch("b1")
    df = spark.createDataFrame([("b1", 1), ("b1", 2)], "batch_id string, v int")
    assert t.append(df, batch_id="b1", stage="land") == (0, 2)
    assert t.append_if_absent(df, "b1", stage="land") is None and t.append_if_absent(df.withColumn("batch_id", F.lit("b2")), "b2", stage="land") == (1, 2)
    pinned, v = t.read(0)
    assert (pinned.count(), v) == (2, 0) and t.read()[0].count() == 4 and t.batch("b2").count() == 2
    assert t.find(batch_id="b2") == 1 and t.find(batch_id="no") is None and [h["rows"] for h in t.history()] == [2, 2]
    assert "PartitionFilters: [isnotnull(batch_id" in t.batch("b1")._jdf.queryExecution().toString()
    with pytest.raises(CommitConflict):
        t.rewrite(df, 0)
    with pytest.raises(ValueError):
        t.append(df.withColumn("more", F.lit(1)))
    t.add_columns([T.StructField("note", T.StringType())])
    t.append(df.withColumn("note", F.lit("n")).select("batch_id", "v", "note"))
    assert t.read()[0].where("note is null").count() == 4
    t.compact(1)
    at_work, _ = t._write(df)
    assert t.read()[0].count() == 6 and t.vacuum() == []  # young parts may belong to a writer at work
    assert at_work[0] in t.vacuum(older_than_s=0) and t.read()[0].count() == 6


def test_appends_after_conflicts(spark, tmp_path, monkeypatch):
    df = spark.createDataFrame([("b1", 1)], "batch_id string, v int")
    t, other = Table(spark, str(tmp_path / "t"), ("batch_id",)), Table(spark, str(tmp_path / "t"), ("batch_id",))
    t.append(df.where("v = 0"))
    write = t._write

    def meanwhile(action):
        def slow(rows):
            out = write(rows)
            action()
            monkeypatch.setattr(t, "_write", write)
            return out

        monkeypatch.setattr(t, "_write", slow)

    meanwhile(lambda: other.add_columns([T.StructField("note", T.StringType())]))
    assert t.append(df, batch_id="b1", stage="land") == (2, 1)
    assert t.schema().fieldNames() == ["batch_id", "v", "note"]  # added meanwhile, still there
    both = df.select(F.lit("b2").alias("batch_id"), "v", F.lit(None).cast("string").alias("note"))
    meanwhile(lambda: other.append(both, batch_id="b2", stage="land"))
    assert t.append_if_absent(both, "b2", stage="land") is None and t.batch("b2").count() == 1  # the other run was first
    assert t.find(batch_id="b2", stage="land") == 3 and len(t.batch("b1").inputFiles()) == 1  # a batch is read from its own parts
    assert [t.attributed(*x[:1], stage=x[1]) for x in (("b2", "land"), ("b1", "fold"), ("none", "land"))] == [("own", 3), ("unattributable", None), ("absent", None)]
    for i in range(110):
        other.append(both.limit(0), batch_id=f"x{i}", stage="land")
    assert t.find(batch_id="b1") == 2 and t.find(batch_id="x60") == 64 and t.batch("b2").count() == 1


def test_merges_rewrite_touched_buckets(spark, tmp_path):
    t = Table(spark, str(tmp_path / "s"), buckets=("id", 8))
    merge(t, spark.range(200).select(F.col("id").cast("string").alias("id"), F.lit(1).alias("o")), "id", ("o",))
    before = set(t._parts(t.version()))
    v, n = merge(t, spark.createDataFrame([("7", 2)], "id string, o int"), "id", ("o",))
    assert n["updated"] == 1 and len(set(t._parts(v)) - before) == 1 and len(before - set(t._parts(v))) == 1
    assert t.read()[0].agg(F.count("*"), F.sum("o")).first()[:] == (200, 201)
    assert merge(t, spark.createDataFrame([], "id string, o int"), "id", ("o",))[0] == v
    t.compact(3)
    merge(t, spark.createDataFrame([("7", 3), ("new", 1)], "id string, o int"), "id", ("o",))
    assert t.read()[0].agg(F.count("*"), F.sum("o")).first()[:] == (201, 203)


def test_merge_counts_noop_and_repeated_keys(spark, tmp_path):
    t = Table(spark, str(tmp_path / "s"))
    rows = lambda *r: spark.createDataFrame(list(r), "id string, o int, v string")
    v, n = merge(t, rows(("a", 1, "x"), ("b", 1, "y")), "id", ("o",))
    assert n == {"inserted": 2, "updated": 0, "added-records": 2}
    w, n = merge(t, rows(("a", 2, "z"), ("b", 1, "again"), ("c", None, "n")), "id", ("o",))
    assert n == {"inserted": 1, "updated": 1, "added-records": 2} and {r.id: r.v for r in t.read()[0].collect()} == {"a": "z", "b": "y", "c": "n"}
    assert merge(t, rows(("a", 2, "z")), "id", ("o",)) == (w, {"inserted": 0, "updated": 0, "added-records": 0})
    with pytest.raises(ValueError):
        merge(t, rows(("a", 3, "p"), ("a", 4, "q")), "id", ("o",))


def test_ddl_plans():
    f = lambda n, k="string": T.StructField(n, T._parse_datatype_string(k))
    have, want = T.StructType([f("batch_id"), f("a")]), T.StructType([f("batch_id"), f("a"), f("b")])
    assert [x.name for x in plan_ddl(have, want, ("a", "b"))] == ["b"]
    with pytest.raises(ValueError, match="a: .*batch_id: framework"):
        plan_ddl(T.StructType([f("a", "int")]), want, ("a", "b"))
    with pytest.raises(ValueError):
        check_exact(have, want)


# ---------------------------------------------------------------- claims, registration, sweeps


def test_claims(tmp_path):
    c = events.Claims(str(tmp_path / "claims"))
    assert c.claim("f/1", "b", "one", {"x": 1}, 0)[0] == "WON" and c.claim("f/1", "b", "two", {}, 1200) == ("LOST_IN_PROGRESS", {"x": 1})
    assert [s["owner"] for s in c.stuck(1201)] == ["one"]
    assert c.claim("f/1", "b", "two", {}, 1201) == ("TAKEN_OVER", {"x": 1}) and not c.complete("f/1", "b", "one") and c.complete("f/1", "b", "two")
    assert c.claim("f/1", "b", "three", {}, 9999) == ("LOST_COMPLETED", {"x": 1}) and not c.stuck(99999)
    # a taker that dies goes stale as well
    assert [c.claim("f", "d", o, {"x": o}, t)[0] for o, t in (("a", 0), ("b", 2000), ("c", 2100), ("c", 4000))] == ["WON", "TAKEN_OVER", "LOST_IN_PROGRESS", "TAKEN_OVER"]
    assert not c.complete("f", "d", "b") and c.complete("f", "d", "c") and c.claim("f", "d", "e", {}, 9999) == ("LOST_COMPLETED", {"x": "a"})
    # two takers that saw the same claim: one wins
    c.claim("f", "r", "a", {}, 0)
    put = c.files.put

    def late(path, data):
        c.files.put = put
        c.claim("f", "r", "first", {}, 5000)
        return put(path, data)

    c.files.put = late
    assert c.claim("f", "r", "second", {}, 5000)[0] == "LOST_IN_PROGRESS" and c.complete("f", "r", "first")


def request(key, day, sha, delivery=None, run=""):
    at = datetime.datetime(2026, 1, day, 12, tzinfo=UTC)
    return acquisition.Request("feed/a", "pipelines/x", delivery or f"d-{key}-{day}", key, at, (acquisition.Observed("p.csv", 5, sha * 64, source="in/p.csv", uri="s3://l/p.csv"), acquisition.Observed("m.json", 1, "f" * 64, "manifest", "in/m", "s3://l/m")), run_id=run)


def test_registration_flow(spark, tmp_path):
    told, copied = [], []
    counted = []
    reg = acquisition.Registrar(spark, Table(spark, str(tmp_path / "ledger")), events.Claims(str(tmp_path / "c")), lambda k, e: told.append((k, e)), lambda a, b: copied.append((a, b)), lambda *x: counted.append(x))
    assert reg.register(request("k", 1, "a")).disposition == "registered" and copied == [("in/p.csv", "s3://l/p.csv"), ("in/m", "s3://l/m")]
    assert counted == [("deliveries", 1, {"feed_id": "feed/a", "disposition": "registered"}), ("bytes", 5, {"feed_id": "feed/a"})]
    assert told[0][1]["object_uris"] == ["s3://l/p.csv"] and told[0][1]["received_at"] == "2026-01-01T12:00:00Z" and list(told[0][1])[:3] == ["schema_version", "feed_id", "delivery_id"]
    assert reg.register(request("k", 2, "a")).disposition == "duplicate"
    plan = reg.register(request("k", 3, "b"))
    assert plan.rows[0]["supersedes"] == "d-k-1" and plan.rows[1]["disposition"] == "superseded"
    from weirgate.operators import ledger

    now = {r.delivery_id: r.disposition for r in ledger.latest(reg.table.read()[0]).collect()}
    assert now == {"d-k-1": "superseded", "d-k-2": "duplicate", "d-k-3": "registered"}
    bad = request("n", 4, "c")
    assert len(reg.nondelivery(bad, "incomplete").rows) == 1 and len(reg.nondelivery(bad, "incomplete").rows) == 0 and len(reg.nondelivery(bad, "unreadable").rows) == 1
    # a dead run is taken over with its own identity
    dead = request("t", 5, "d", "dead", "dead-run")
    reg.claims.claim(dead.feed_id, dead.batch_id, "dead-run", dead.item(), time.time() - 5000)
    plan = reg.register(request("t", 6, "d", "alive", "alive-run"))
    assert plan.rows[0]["delivery_id"] == "dead" and plan.rows[0]["driver_run_id"] == "dead-run"
    # concurrent corrections are reconciled once
    reg.table.append(reg.frame([{**plan.rows[0], "delivery_id": "other", "received_at": datetime.datetime(2026, 1, 9, tzinfo=UTC)}]))
    assert reg.reconcile() == 1 and reg.reconcile() == 0
    feeds = spark.createDataFrame([("feed/a", "daily", "09:00", "UTC")], "feed_id string, expected string, by string, timezone string")
    marked = set()
    late = reg.overdue(feeds, datetime.datetime(2026, 1, 11, 10, tzinfo=UTC), marked)
    assert late == [("feed/a", d) for d in ("2026-01-08", "2026-01-10", "2026-01-11")] and reg.overdue(feeds, datetime.datetime(2026, 1, 11, 11, tzinfo=UTC), marked) == []


def test_pull_stops_by_time_and_push_takes_one(spark, tmp_path):
    from weirgate.operators import ledger

    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"f{i}.csv").write_text(f"a,{i}\nTOTAL:{'x' if i == 2 else 1}\n")
    reg = acquisition.Registrar(spark, Table(spark, str(tmp_path / "ledger")), events.Claims(str(tmp_path / "c")), lambda *_: None)
    feed = acquisition.Feed("feed/t", "pipelines/x", "*.csv", "trailer", r"TOTAL:(\w+)", 1)
    ticks = iter([0.0, 1.0, 601.0])
    found = acquisition.pull(reg, feed, str(tmp_path / "in"), str(tmp_path / "stage"), clock=lambda: next(ticks))
    assert (len(found.plans), found.carried) == (1, 2)  # the time was up after the first
    found = acquisition.pull(reg, feed, str(tmp_path / "in"), str(tmp_path / "stage"))
    assert (len(found.plans), found.carried) == (2, 0) and acquisition.pull(reg, feed, str(tmp_path / "in"), str(tmp_path / "stage")).plans == ()
    latest = {r.delivery_key: r for r in ledger.latest(reg.table.read()[0]).collect()}
    assert {k: r.disposition for k, r in latest.items()} == {"f0.csv": "registered", "f1.csv": "registered", "f2.csv": "unreadable"} and latest["f0.csv"].asserted_record_count == 1
    uri = latest["f0.csv"].object_uris[0]
    assert open(uri.removeprefix("file:")).read() == "a,0\nTOTAL:1\n" and "/feed/t/received_at=" in uri
    (tmp_path / "in" / "late.csv").write_text("b\nTOTAL:2\n")
    assert acquisition.push(reg, feed, str(tmp_path / "in" / "late.csv"), str(tmp_path / "stage")).disposition == "registered"
    assert acquisition.push(reg, feed, str(tmp_path / "in" / "late.csv"), str(tmp_path / "stage")).disposition == "duplicate"
    with pytest.raises(FileNotFoundError):
        acquisition.push(reg, feed, str(tmp_path / "in" / "none.csv"), str(tmp_path / "stage"))
    with pytest.raises(ValueError):
        acquisition.Feed("f", "p", mode="trailer")


def test_large_objects_are_streamed(spark, tmp_path, monkeypatch):
    (tmp_path / "a.bin").write_bytes(b"x" * 9000 + b"\nend\n")
    (tmp_path / "b.bin").write_bytes(b"")
    uris = [str(tmp_path / n) for n in ("a.bin", "b.bin")]
    whole = {r.uri: tuple(r)[1:] for r in objects.digests(spark, uris).collect()}
    monkeypatch.setattr(objects, "WHOLE_BYTES", 100)
    assert {r.uri: tuple(r)[1:] for r in objects.digests(spark, uris).collect()} == whole
    n, sha = objects.copied(spark, uris[0], str(tmp_path / "out" / "copy.bin"))
    assert n == 9005 and (tmp_path / "out" / "copy.bin").read_bytes() == (tmp_path / "a.bin").read_bytes() and hashlib.sha256((tmp_path / "a.bin").read_bytes()).hexdigest() == sha


def test_registry_is_rendered_and_cached(tmp_path):
    for name in "ba":
        (tmp_path / f"{name}.yaml").write_text(f"feed_id: feed/{name}\ndriver: pull\n")
    text = objects.render_registry([str(tmp_path / f"{n}.yaml") for n in "ba"])
    (tmp_path / "feeds.json").write_text(text)
    registry = objects.FeedRegistry(str(tmp_path / "feeds.json"))
    assert [f["feed_id"] for f in registry.feeds(0)] == ["feed/a", "feed/b"] and registry.feed("feed/x", 1) is None
    (tmp_path / "feeds.json").write_text('{"feeds": []}')
    assert registry.feed("feed/a", 59) is not None and registry.feed("feed/a", 60) is None
    with pytest.raises(ValueError):
        objects.render_registry([str(tmp_path / "a.yaml")] * 2)


def test_files_are_put_once_and_only_where_that_is_safe(spark, tmp_path, monkeypatch):
    from weirgate.sources import files

    for store in (files.LocalFiles(), files.SharedFiles(spark)):
        at = str(tmp_path / type(store).__name__ / "x.json")
        assert store.put(at, b"1") and not store.put(at, b"2") and store.read(at) == b"1" and store.names(str(tmp_path / type(store).__name__)) == ["x.json"]
        assert store.names(str(tmp_path / "none")) == []
    monkeypatch.setattr(files, "ATOMIC", ())
    shared = files.SharedFiles(spark)

    class Odd:
        def getScheme(self):
            return "s3a"

    class Store:
        def getUri(self):
            return Odd()

    monkeypatch.setattr(shared, "fs", lambda path: Store())
    with pytest.raises(ValueError, match="single_writer"):
        shared.put("s3a://b/x", b"")


def test_messages_quote_contract_faults_only():
    from weirgate.plans import runner

    def message(make):
        try:
            raise make()
        except Exception as e:
            return runner.safe_message(e)

    assert "123-45-6789" not in message(lambda: ValueError("invalid literal for int() with base 10: '123-45-6789'")) and "123" not in message(lambda: KeyError("123-45-6789"))
    assert message(lambda: C.ContractError("column a\nrow text")) == "ContractError: column a"


def test_router_arguments_and_names():
    assert acquisition.arguments(["--a", "1", "--b=2"]) == {"a": "1", "b": "2"}
    for bad in (["x"], ["--a"], ["--a", "--b"], ["--a=1", "--a=2"]):
        with pytest.raises(ValueError):
            acquisition.arguments(bad)
    event = {"pipeline": "pipelines/x", "feed_id": "f", "delivery_id": "d", "batch_id": "b", "object_uris": ["u"], "received_at": "t", "extra": 1}
    started = {}
    start = lambda name, payload: started.setdefault(name, payload) is payload
    assert [acquisition.route(event, ["pipelines/x"], start) for _ in range(2)] == ["started", "exists"] and "extra" not in started["pipelines-x-b"]
    assert acquisition.route({**event, "pipeline": "q"}, ["pipelines/x"], start) == "ignored"
    with pytest.raises(ValueError):
        acquisition.route({**event, "object_uris": ["u" * 9000]}, ["pipelines/x"], start)
    assert acquisition.run_name("p", "b", 2) == "p-b--r2"
    good = "s3://lake/feed/a/received_at=20260101T000000000000Z/dl-d1/x.csv"
    assert acquisition.consistent_uris([good, good.replace("dl-d1", "dl-d2"), good + "/y"], "feed/a", "d1") == [good.replace("dl-d1", "dl-d2"), good + "/y"]


def test_candidates_globs_and_budget(spark):
    at = datetime.datetime(2026, 1, 1, tzinfo=UTC)
    rows = [("a.csv", 1, 0), ("b.csv", 2, 50), ("../x.csv", 3, 0), ("c.txt", 4, 0), ("a%.csv", 5, 0), ("d.csv", 6, 0)]
    df = spark.createDataFrame([(n, b, at + datetime.timedelta(minutes=m)) for n, b, m in rows], "name string, bytes long, mtime timestamp")
    now = decisions.utc(at + datetime.timedelta(minutes=60))
    pick = lambda **k: [r.name for r in decisions.candidates(df, df.where("name = 'd.csv'"), "*.csv", now, **k).collect()]
    assert pick() == ["a.csv", "b.csv"] and pick(quiet_minutes=30) == ["a.csv"] and pick(force=True) == ["a.csv", "d.csv", "b.csv"]
    assert [r.name for r in decisions.budget_prefix(df, 3, ("name",)).orderBy("name").collect()] == ["../x.csv", "a%.csv"]
    many = spark.range(2000).select((F.col("id") % 997).alias("k"), F.when(F.col("id") % 3 > 0, "a").alias("g"), F.lit(1).alias("bytes"), "id").repartition(7)
    kept = decisions.budget_prefix(many, 99, ("k", "id"), partition=("g",)).groupBy("g").agg(F.count("*").alias("n"), F.max("k").alias("k")).collect()
    want = {g: sorted((i % 997, i) for i in range(2000) if (i % 3 > 0) == (g == "a"))[:100] for g in ("a", None)}
    assert {r.g: (r.n, r.k) for r in kept} == {g: (100, rows[-1][0]) for g, rows in want.items()}
    import fnmatch

    names = ["a.csv", "A.csv", "b1", "b[1]", "x\ny", "", "ab^"]
    for glob in ("*", "a*", "b?", "b[0-9]", "[!a]*", "b[[]1]", "*[^]"):
        got = spark.createDataFrame([(n,) for n in names], "n string").where(X.matches_glob(F.col("n"), glob)).collect()
        assert {r.n for r in got} == {n for n in names if fnmatch.fnmatchcase(n, glob)}, glob


def test_author_functions_are_checked():
    assert purity.findings("from pyspark.sql import functions as F\n\ndef apply(valid, co):\n    return valid.groupBy('a').agg(F.count('*'), F.first('b'))\n") == []
    bad = "import os\n\ndef apply(valid, co):\n    global x\n    valid.collect()\n    open('f')\n    return valid.where(f\"a = {co}\")\n"
    odd = "def apply(valid, co):\n    valid.where('a = ' + co)\n    valid.where('a = %s' % co)\n    valid.where((F.col('a') > 1) & (F.col('b') == 'x'))\n    return valid.groupBy('a').count()\n"
    assert [n for n, _ in purity.findings(odd)] == [2, 3]
    assert [what for _, what in purity.findings(bad)] == ["import os", "global state", ".collect", "open()", "composed string in .where"]


def test_admission_stream(spark, tmp_path):
    schema = "domain_id string, n string, malformed_text string, extras map<string,string>"
    spark.createDataFrame([("a", "1", None, {}), ("b", "x", None, {})], schema).write.parquet(str(tmp_path / "in"))
    raw = spark.readStream.schema(schema).parquet(str(tmp_path / "in"))
    good, bad = [], []
    c = C.RawContract((C.DeclaredColumn("domain_id"), C.DeclaredColumn("n", "int")))
    q = admission_stream(raw, c, lambda df, _: good.extend(df.collect()), lambda df, _: bad.extend(df.collect())).trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(60)
    assert [tuple(r) for r in good] == [("a", 1)] and [r.reason_code for r in bad] == ["contract/cast-failure"]
