"""One batch from delivered objects to facts and state.

Stages in order: land, pre_check, pull, apply, post_check, commit, fold, publish.
Each takes the batch so far and returns it with more set; the frames in it are
plans until a stage writes.  Guards look at data, not at logs: a batch that is
already in a table is read back instead of written again, so a run that died
anywhere is repeated from the start and ends in the same tables.
"""

from __future__ import annotations

import dataclasses
import datetime
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..contract import ContractError, PipelineSpec, check_version, read_spec_version, utc_now
from ..operators import checks, fold, quarantine, subtract
from ..operators.lineage import Lineage, stamp
from ..session import durable as stored
from ..sinks import events
from ..sources import delimited
from ..sources.tables import Table, merge, plan_ddl

RUN_COLUMNS = (
    "batch_id string", "pipeline string", "feed_id string", "attempt_id string", "retry_count int", "redrive_count int", "stage string", "outcome string", "started_at timestamp",
    "finished_at timestamp", "rows_in bigint", "raw_count bigint", "pre_quarantined bigint", "post_quarantined bigint", "facts_appended bigint", "rows_merged bigint", "snapshot_id bigint",
    "state_read_snapshot_id bigint", "co_effect_snapshot_ids map<string,bigint>", "merge_summary map<string,string>", "error_type string", "error_message string", "recorded_at timestamp",
)


#: Buckets of a state table: a merge rewrites those that its batch touches.
STATE_BUCKETS = 64


@dataclasses.dataclass(frozen=True)
class Pipeline:
    """A specification and the pure functions of its author."""

    spec: PipelineSpec
    apply: Callable[[DataFrame, dict[str, DataFrame]], DataFrame]
    post_check: Callable[[DataFrame, dict[str, DataFrame]], DataFrame] | None = None
    fold: Callable[[DataFrame, DataFrame], DataFrame] | None = None


@dataclasses.dataclass(frozen=True)
class Stores:
    """Where a pipeline's tables are."""

    raw: Table
    quarantine: Table
    facts: Table
    state: Table
    runs: Table
    emit: Callable[[str, dict], None]

    @staticmethod
    def at(spark: SparkSession, root: str, emit: Callable[[str, dict], None] | None = None, domain_id: str = "domain_id", buckets: int = STATE_BUCKETS) -> Stores:
        table = lambda name, *by: Table(spark, f"{root}/{name}", by)
        return Stores(table("raw", "batch_id"), table("quarantine", "batch_id"), table("facts", "batch_id"), Table(spark, f"{root}/state", buckets=(domain_id, buckets)), table("runs"), emit or (lambda *_: None))


@dataclasses.dataclass(frozen=True)
class Batch:
    """What is known of a batch; frames are plans."""

    pipeline: Pipeline
    lineage: Lineage
    uris: tuple[str, ...]
    attempt_id: str
    raw: DataFrame | None = None
    raw_count: int | None = None
    land_version: int | None = None
    valid: DataFrame | None = None
    pre_quarantined: int | None = None
    pre_version: int | None = None
    pre_drift: str | None = None
    co_effects: dict[str, DataFrame] | None = None
    co_versions: dict[str, int] | None = None
    candidate: DataFrame | None = None
    admitted: DataFrame | None = None
    post_quarantined: int | None = None
    post_version: int | None = None
    post_drift: str | None = None
    facts: DataFrame | None = None
    facts_appended: int | None = None
    fact_version: int | None = None
    state_read: int | None = None
    state_version: int | None = None
    merge_summary: dict[str, int] | None = None
    skipped: tuple[str, ...] = ()

    def plus(self, **more) -> Batch:
        """A copy with more set; what is set stays as it is."""
        if again := [k for k in more if k != "skipped" and getattr(self, k) is not None]:
            raise ValueError(f"set twice: {again}")
        return dataclasses.replace(self, **more)


def prepare(spark: SparkSession, pipeline: Pipeline, stores: Stores) -> None:
    """Tables in the shape that the contract asks for; additions only."""
    spec = pipeline.spec
    fields = [T.StructField(n, {"received_at": T.TimestampType(), "object_seq": T.IntegerType(), "row_index": T.LongType()}.get(n, T.StringType())) for n in ("batch_id", "delivery_id", "feed_id", "received_at", "source_uri", "object_seq", "row_index", "read_spec_version", "malformed_text")]
    want = T.StructType([*fields, *(T.StructField(n, T.StringType()) for n in spec.raw.names), T.StructField("extras", T.MapType(T.StringType(), T.StringType()))])
    if stores.raw.version() < 0:
        stores.raw.create(want)
    elif add := plan_ddl(stores.raw.schema(), want, spec.raw.names):
        stores.raw.add_columns(add)
    stores.quarantine.create(spark.createDataFrame([], ", ".join(quarantine.COLUMNS)).schema)
    stores.runs.create(spark.createDataFrame([], ", ".join(RUN_COLUMNS)).schema)
    checks.probe(spec.raw, spark)


def land(spark: SparkSession, b: Batch, s: Stores) -> Batch:
    spec, batch = b.pipeline.spec, b.lineage.batch_id
    raw = stamp(delimited.read_delivery(spark, list(b.uris), spec.read, spec.raw), b.lineage, read_spec_version(spec))
    for missing in set(s.raw.schema().fieldNames()) - set(raw.columns):  # of an older contract
        raw = raw.withColumn(missing, F.lit(None).cast("string"))
    done = s.raw.append_if_absent(raw, batch, stage="land")
    back = s.raw.batch(batch)
    n = done[1] if done else back.count()
    version = done[0] if done else s.raw.find(batch_id=batch, stage="land")
    s.emit("batch-started", events.batch_started(pipeline=spec.name, feed_id=b.lineage.feed_id, batch_id=batch, delivery_id=b.lineage.delivery_id, raw_count=n, land_snapshot_id=version if version is not None else -1, started_at=utc_now()))
    return b.plus(raw=back, raw_count=n, land_version=version, skipped=(*b.skipped, *["land"] * (not done)))


def pre_check(spark: SparkSession, b: Batch, s: Stores) -> Batch:
    spec, batch = b.pipeline.spec, b.lineage.batch_id
    compiled = checks.compile_contract(spec.raw)
    refused = checks.violations(b.raw, compiled)
    if s.quarantine.has_batch(batch, check_stage="pre_check"):
        durable = s.quarantine.batch(batch, check_stage="pre_check")
        left = subtract.locator_subtract(b.raw, durable)
        counts = subtract.drift(durable, refused, left.where(checks.any_cast_failure(compiled))).first()
        return b.plus(valid=checks.typed_projection(left, compiled), pre_quarantined=counts.durable, pre_version=s.quarantine.find(batch_id=batch, check_stage="pre_check"), pre_drift=subtract.drift_text(counts), skipped=(*b.skipped, "pre_check"))
    if s.facts.has_batch(batch):  # the batch was admitted without a refusal
        left = b.raw.where("malformed_text is null")
        n = refused.count()
        text = f"drift: durable=0 recomputed={n} only_durable=0 only_recomputed={n} admitted_cast_failures={left.where(checks.any_cast_failure(compiled)).count()}" if n else None
        return b.plus(valid=checks.typed_projection(left, compiled), pre_quarantined=0, pre_drift=text)
    sizes = checks.counts(b.raw, compiled).first()
    checks.Counts(b.raw_count, sizes.admitted, sizes.refused).demand("pre_check")
    version = None
    if sizes.refused:
        shaped = quarantine.pre_check(refused, b.lineage, check_version(spec), utc_now())
        version, _ = s.quarantine.append(shaped, batch_id=batch, check_stage="pre_check")
    return b.plus(valid=checks.admitted(b.raw, compiled), pre_quarantined=sizes.refused, pre_version=version)


def pull(spark: SparkSession, b: Batch, s: Stores) -> Batch:
    found = {name: Table(spark, path) for name, path in b.pipeline.spec.co_effects}
    pinned = {name: t.read() for name, t in found.items()}
    return b.plus(co_effects={n: df for n, (df, _) in pinned.items()}, co_versions={n: v for n, (_, v) in pinned.items()})


def apply(spark: SparkSession, b: Batch, s: Stores) -> Batch:
    """The author's rows, written once: checks, subtraction and commit all see the same ones."""
    return b.plus(candidate=stored(b.pipeline.apply(b.valid, b.co_effects), "candidate"))


def post_check(spark: SparkSession, b: Batch, s: Stores) -> Batch:
    spec, batch, candidate = b.pipeline.spec, b.lineage.batch_id, b.candidate
    if b.pipeline.post_check:
        refused = stored(b.pipeline.post_check(candidate, b.co_effects), "refused")
    else:
        refused = spark.createDataFrame([], T.StructType([*candidate.schema.fields, T.StructField("reason", T.StringType())]))
    if s.quarantine.has_batch(batch, check_stage="post_check"):
        durable = s.quarantine.batch(batch, check_stage="post_check")
        hashed = quarantine.candidate_hashes(candidate, "_weirgate_hash")
        left = subtract.hash_subtract(hashed, durable.select(F.col("row_hash").alias("_weirgate_hash")), "_weirgate_hash").drop("_weirgate_hash")
        n, all_rows, kept = durable.count(), candidate.count(), left.count()
        text = None if all_rows == kept + n else f"drift: candidate={all_rows} admitted={kept} durable={n}"
        return b.plus(admitted=left, post_quarantined=n, post_version=s.quarantine.find(batch_id=batch, check_stage="post_check"), post_drift=text, skipped=(*b.skipped, "post_check"))
    if s.facts.has_batch(batch):
        n = refused.count()
        return b.plus(admitted=candidate, post_quarantined=0, post_drift=f"drift: recomputed={n} durable=0" if n else None)
    if not (bad := quarantine.bad_reasons(refused)).isEmpty():
        raise ContractError(f"post_check: {bad.count()} rows have a reason outside business/...")
    n = refused.count()
    if not n:
        return b.plus(admitted=candidate, post_quarantined=0)
    left = subtract.bag_subtract(candidate, refused.drop("reason"))
    checks.Counts(candidate.count(), left.count(), n).demand("post_check")
    shaped = quarantine.post_check(refused, b.lineage, check_version(spec), utc_now(), spec.domain_id)
    version, _ = s.quarantine.append(shaped, batch_id=batch, check_stage="post_check")
    return b.plus(admitted=left, post_quarantined=n, post_version=version)


def commit(spark: SparkSession, b: Batch, s: Stores) -> Batch:
    batch = b.lineage.batch_id
    facts = stamp(b.admitted, dataclasses.replace(b.lineage, source_uri=None))
    have = s.facts.schema()
    if faults := checks.structural_faults(facts, b.pipeline.spec.domain_id, tuple(have.fieldNames()) if have else None):
        raise ContractError("commit: " + "; ".join(faults))
    if have is None:
        s.facts.create(facts.schema)
    done = s.facts.append_if_absent(facts, batch, stage="commit")
    version = done[0] if done else s.facts.find(batch_id=batch, stage="commit")
    return b.plus(facts=s.facts.batch(batch), facts_appended=done[1] if done else 0, fact_version=version, skipped=(*b.skipped, *["commit"] * (not done)))


def fold_stage(spark: SparkSession, b: Batch, s: Stores) -> Batch:
    spec = b.pipeline.spec
    if b.facts.limit(1).isEmpty():
        return b.plus(state_version=s.state.version(), skipped=(*b.skipped, "fold"))
    s.state.create(b.facts.schema)
    state, at = s.state.read()
    if b.pipeline.fold:
        source = b.pipeline.fold(subtract.touched_slice(state, b.facts, spec.domain_id), b.facts)
    else:
        source = fold.winners(b.facts, spec.domain_id, spec.fold_order)
    version, summary = merge(s.state, source, spec.domain_id, spec.fold_order, unique=b.pipeline.fold is None, batch_id=b.lineage.batch_id, stage="fold")
    return b.plus(state_read=at, state_version=version, merge_summary=summary)


def publish(spark: SparkSession, b: Batch, s: Stores) -> Batch:
    batch, spec = b.lineage.batch_id, b.pipeline.spec
    refused = {r.check_stage: r["count"] for r in s.quarantine.batch(batch).groupBy("check_stage").count().collect()}
    s.emit("batch-completed", events.batch_completed(
        pipeline=spec.name, feed_id=b.lineage.feed_id, batch_id=batch, delivery_id=b.lineage.delivery_id, raw_count=b.raw_count, pre_quarantined=refused.get("pre_check", 0), post_quarantined=refused.get("post_check", 0),
        fact_count=s.facts.batch(batch).count(), fact_snapshot_id=b.fact_version if b.fact_version is not None else -1, state_snapshot_id=b.state_version, completed_at=utc_now(),
    ))
    return b


STAGES = (("land", land), ("pre_check", pre_check), ("pull", pull), ("apply", apply), ("post_check", post_check), ("commit", commit), ("fold", fold_stage), ("publish", publish))

#: What each stage tells the run ledger: column -> attribute of the batch.
TOLD = {
    "land": {"raw_count": "raw_count", "snapshot_id": "land_version"},
    "pre_check": {"pre_quarantined": "pre_quarantined", "snapshot_id": "pre_version", "error_message": "pre_drift"},
    "pull": {"co_effect_snapshot_ids": "co_versions"},
    "post_check": {"post_quarantined": "post_quarantined", "snapshot_id": "post_version", "error_message": "post_drift"},
    "commit": {"facts_appended": "facts_appended", "snapshot_id": "fact_version"},
    "fold": {"snapshot_id": "state_version", "state_read_snapshot_id": "state_read"},
}


def safe_message(error: BaseException) -> str:
    """A message without row values: contract faults by their first line, others,
    whose text may quote a cell, by where they arose."""
    if isinstance(error, ContractError):
        return f"{type(error).__name__}: {str(error).splitlines()[0] if str(error) else ''}"[:256]
    tb = error.__traceback__
    while tb is not None and tb.tb_next is not None:
        tb = tb.tb_next
    return f"{tb.tb_frame.f_globals.get('__name__', '?')}:{tb.tb_lineno}" if tb else "?:0"


def run_fact(stage: str, before: Batch, after: Batch | None, began: datetime.datetime, error: BaseException | None, retry: int = 0, redrive: int = 0) -> dict:
    b = after or before
    row = {c.split()[0]: None for c in RUN_COLUMNS} | {
        "batch_id": b.lineage.batch_id, "pipeline": b.pipeline.spec.name, "feed_id": b.lineage.feed_id, "attempt_id": b.attempt_id, "retry_count": retry, "redrive_count": redrive,
        "stage": stage, "started_at": began, "finished_at": utc_now(), "recorded_at": utc_now(),
    }
    if error is not None:
        return row | {"outcome": "failed", "error_type": type(error).__name__, "error_message": safe_message(error)}
    row |= {column: getattr(b, name) for column, name in TOLD.get(stage, {}).items()}
    if stage == "fold" and b.merge_summary is not None:
        row |= {"merge_summary": {k: str(v) for k, v in b.merge_summary.items()}, "rows_merged": b.merge_summary["added-records"]}
    elif stage == "fold":
        row["rows_merged"] = 0
    return row | {"outcome": "skipped-guard" if set(b.skipped) - set(before.skipped) else "ok"}


def run(spark: SparkSession, pipeline: Pipeline, lineage: Lineage, uris: list[str], stores: Stores, retry: int = 0, redrive: int = 0) -> Batch:
    """Runs every stage; each transition becomes a row of the run ledger, whose failure fails nothing."""
    prepare(spark, pipeline, stores)
    b = Batch(pipeline, lineage, tuple(uris), uuid.uuid4().hex)
    schema = ", ".join(RUN_COLUMNS)

    def note(fact: dict) -> None:
        events.quietly(lambda: stores.runs.append(spark.createDataFrame([tuple(fact.values())], schema), batch_id=lineage.batch_id, stage=fact["stage"]))

    for name, stage in STAGES:
        began = utc_now()
        try:
            after = stage(spark, b, stores)
        except Exception as error:
            note(run_fact(name, b, None, began, error, retry, redrive))
            raise
        note(run_fact(name, b, after, began, None, retry, redrive))
        b = after
    return b
