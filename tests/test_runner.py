"""End-to-end batches: clean, refused, all refused, header only, and restarts after a failure at any stage."""

import datetime

import pytest
from pyspark.sql import functions as F

from weirgate import contract as C
from weirgate.operators.lineage import Lineage
from weirgate.plans import runner

HEADER = "domain_id,event_time,source_ts,content_hash,payload\n"


def spec(**more):
    columns = (C.DeclaredColumn("domain_id", required=True, nullable=False), *(C.DeclaredColumn(n) for n in ("event_time", "source_ts", "content_hash", "payload")))
    return C.PipelineSpec("pipelines/plain", C.RawContract(columns), **more)


def plain(valid, co):
    return valid.select("domain_id", "event_time", "source_ts", "content_hash", "payload")


def no_invalid(candidate, co):
    return candidate.where("payload = 'INVALID'").withColumn("reason", F.lit("business/invalid-payload"))


def deliver(tmp_path, name, *files):
    out = []
    for i, body in enumerate(files):
        p = tmp_path / f"{name}-{i}.csv"
        p.write_text(HEADER + body)
        out.append(str(p))
    return out


def line(d, n, payload="x"):
    return f"{d},2026-01-0{n}T00:00:00Z,2026-01-0{n}T00:00:01Z,h{n},{payload}\n"


def lineage(batch):
    return Lineage(batch, f"delivery-{batch}", "feed/one", datetime.datetime(2026, 1, 1, tzinfo=datetime.UTC))


def facts(stores):
    return sorted((r.domain_id, r.payload) for r in stores.facts.read()[0].collect())


def state(stores):
    return {r.domain_id: r.event_time[:10] for r in stores.state.read()[0].collect()}


def test_batches_fold_and_rerun(spark, tmp_path):
    told = []
    stores = runner.Stores.at(spark, str(tmp_path / "lake"), lambda k, e: told.append((k, e)))
    pipe = runner.Pipeline(spec(), plain, no_invalid)
    b1 = deliver(tmp_path, "one", line("a", 2) + line("b", 1), line("c", 1, "INVALID") + line("", 1) + 'd,"open\n')
    done = runner.run(spark, pipe, lineage("batch-1"), b1, stores)
    assert (done.raw_count, done.pre_quarantined, done.post_quarantined, done.facts_appended) == (5, 2, 1, 2)
    assert state(stores) == {"a": "2026-01-02", "b": "2026-01-01"}
    assert [k for k, _ in told] == ["batch-started", "batch-completed"]
    assert told[1][1]["fact_count"] == 2 and told[1][1]["pre_quarantined"] == 2
    # an older batch later does not move the state back; a newer one does
    runner.run(spark, pipe, lineage("batch-2"), deliver(tmp_path, "two", line("a", 1) + line("b", 3)), stores)
    assert state(stores) == {"a": "2026-01-02", "b": "2026-01-03"}
    before = (stores.raw.version(), stores.quarantine.version(), stores.facts.version(), stores.state.version())
    again = runner.run(spark, pipe, lineage("batch-1"), b1, stores)
    assert before == (stores.raw.version(), stores.quarantine.version(), stores.facts.version(), stores.state.version())
    assert set(again.skipped) == {"land", "pre_check", "post_check", "commit"} and again.pre_drift is None and again.post_drift is None
    q = {(r.check_stage, r.reason_code): r for r in stores.quarantine.read()[0].collect()}
    assert set(q) == {("pre_check", "contract/null-violation"), ("pre_check", "unreadable/malformed-row"), ("post_check", "business/invalid-payload")}
    assert '"payload":"INVALID"' in q["post_check", "business/invalid-payload"].row_snapshot
    runs = stores.runs.read()[0]
    assert runs.count() == 24 and runs.where("outcome = 'skipped-guard'").count() == 4


def test_header_only_and_all_refused(spark, tmp_path):
    stores = runner.Stores.at(spark, str(tmp_path / "lake"))
    pipe = runner.Pipeline(spec(), plain)
    done = runner.run(spark, pipe, lineage("empty"), deliver(tmp_path, "e", ""), stores)
    assert (done.raw_count, done.facts_appended) == (0, 0) and "fold" in done.skipped
    done = runner.run(spark, pipe, lineage("bad"), deliver(tmp_path, "b", line("", 1) + line("", 2)), stores)
    assert (done.raw_count, done.pre_quarantined, done.facts_appended) == (2, 2, 0)


@pytest.mark.parametrize("at", ["land", "pre_check", "post_check", "commit", "fold", "publish"])
def test_restart_after_a_failure(spark, tmp_path, at, monkeypatch):
    stores = runner.Stores.at(spark, str(tmp_path / "lake"))
    pipe = runner.Pipeline(spec(), plain, no_invalid)
    uris = deliver(tmp_path, "k", line("a", 1) + line("b", 1, "INVALID") + line("", 1))

    def broken(name, stage):
        def fail(*a):
            stage(*a)  # its writes are there, its result is lost
            raise RuntimeError("killed")

        return (name, fail if name == at else stage)

    whole = runner.STAGES
    monkeypatch.setattr(runner, "STAGES", tuple(broken(n, s) for n, s in whole))
    with pytest.raises(RuntimeError):
        runner.run(spark, pipe, lineage("k"), uris, stores)
    monkeypatch.setattr(runner, "STAGES", whole)
    done = runner.run(spark, pipe, lineage("k"), uris, stores)
    assert facts(stores) == [("a", "x")] and state(stores) == {"a": "2026-01-01"}
    assert stores.quarantine.read()[0].count() == 2 and stores.raw.read()[0].count() == 3
    assert done.pre_drift is None and done.post_drift is None


def test_header_faults_are_found_before_bodies(spark, tmp_path):
    stores = runner.Stores.at(spark, str(tmp_path / "lake"))
    p = tmp_path / "x.csv"
    p.write_text("event_time,payload,payload\n1,2,3\n")
    with pytest.raises(C.ContractError, match="required columns are missing: domain_id"):
        runner.run(spark, runner.Pipeline(spec(), plain), lineage("h"), [str(p)], stores)


def test_binding_and_entry_point(spark, tmp_path, monkeypatch):
    import json
    import sys

    from weirgate import contract as C
    from weirgate.plans import binding

    (tmp_path / "pipelines" / "mine").mkdir(parents=True)
    for at in ("pipelines", "pipelines/mine"):
        (tmp_path / at / "__init__.py").write_text("")
    code = tmp_path / "pipelines" / "mine" / "transforms.py"
    code.write_text("from pyspark.sql import functions as F\n\n\ndef apply(valid, co):\n    return valid.withColumn('v', F.upper('v'))\n\n\ndef fold(state, facts):\n    return facts\n")
    monkeypatch.syspath_prepend(str(tmp_path))
    (tmp_path / "spec.json").write_text(json.dumps({"name": "pipelines/mine", "raw": {"columns": [{"name": "domain_id", "required": True, "nullable": False}, {"name": "v"}]}, "fold_order": ["v"]}))
    (tmp_path / "in.csv").write_text("domain_id,v\na,x\nb,y\n")
    argv = ["--spec", str(tmp_path / "spec.json"), "--root", str(tmp_path / "lake"), "--batch_id=b1", "--delivery_id", "d1", "--feed_id", "f", "--received_at", "2026-01-01T00:00:00+00:00", "--uris", str(tmp_path / "in.csv")]
    done = binding.main(spark, argv)
    assert done.facts_appended == 2 and {r.v for r in done.facts.collect()} == {"X", "Y"}
    for bad in (argv[2:], [*argv[:-1], "s3://l/other/x.csv"]):
        with pytest.raises(C.ContractError):
            binding.main(spark, bad)
    spec = C.load(str(tmp_path / "spec.json"))
    for name in ("other/mine", "pipelines", "pipelines/x;y"):
        with pytest.raises(C.ContractError):
            binding.bind(C.PipelineSpec(name, spec.raw))
    for text in ("def apply(valid):\n    return valid\n", "def other(a, b):\n    return a\n", "def apply(valid, co):\n    return valid.where('a = ' + co)\n"):
        code.write_text(text)
        sys.modules.pop("pipelines.mine.transforms", None)
        import importlib

        importlib.invalidate_caches()
        with pytest.raises(C.ContractError):
            binding.bind(spec)
