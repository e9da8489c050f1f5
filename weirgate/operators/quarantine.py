"""The quarantine table: one shape for every pipeline and both check stages."""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import RESERVED_COLUMNS
from ..functions.canonical import row_hash, row_snapshot
from .lineage import Lineage

COLUMNS = (
    "batch_id string", "delivery_id string", "feed_id string", "check_stage string", "source_uri string", "object_seq int", "row_index bigint", "domain_id string", "record_key string",
    "row_hash string", "reason_code string", "reason_detail string", "check_version string", "quarantined_at timestamp", "row_snapshot string",
)
NAMES = tuple(c.split()[0] for c in COLUMNS)
BUSINESS = r"\A(?:business/[a-z0-9][a-z0-9-]*)\z"


def _shaped(df: DataFrame, lineage: Lineage, stage: str, snapshot: Column, check_version: str, at: datetime.datetime, own: dict[str, Column]) -> DataFrame:
    null = lambda kind: F.lit(None).cast(kind)
    values = {name: null(kind) for name, kind in (c.split() for c in COLUMNS)} | {
        "batch_id": F.lit(lineage.batch_id), "delivery_id": F.lit(lineage.delivery_id), "feed_id": F.lit(lineage.feed_id), "check_stage": F.lit(stage),
        "check_version": F.lit(check_version), "quarantined_at": F.lit(at).cast("timestamp"), "row_snapshot": F.col("_weirgate_snapshot"), "row_hash": row_hash(F.col("_weirgate_snapshot")),
    } | own
    return df.withColumn("_weirgate_snapshot", snapshot).select(*(values[n].alias(n) for n in NAMES))


def pre_check(violating: DataFrame, lineage: Lineage, check_version: str, at: datetime.datetime) -> DataFrame:
    """Refused raw rows: locators pass, the snapshot holds the declared cells, the extras and the malformed text."""
    declared = [c for c in violating.columns if c not in RESERVED_COLUMNS]
    own = {c: F.col(c) for c in ("source_uri", "object_seq", "row_index", "reason_code", "reason_detail")}
    return _shaped(violating, lineage, "pre_check", row_snapshot(violating, [*declared, "extras", "malformed_text"]), check_version, at, own)


def post_check(violating: DataFrame, lineage: Lineage, check_version: str, at: datetime.datetime, domain_id: str) -> DataFrame:
    """Refused candidates: the snapshot is the candidate without its reason."""
    if "reason" not in violating.columns:
        raise ValueError("a refused candidate carries its reason")
    own = {"reason_code": F.col("reason")}
    if domain_id in violating.columns:
        own["domain_id"] = F.col(domain_id).cast("string")
    return _shaped(violating, lineage, "post_check", row_snapshot(violating, [c for c in violating.columns if c != "reason"]), check_version, at, own)


def candidate_hashes(candidates: DataFrame, name: str = "row_hash") -> DataFrame:
    return candidates.withColumn(name, row_hash(row_snapshot(candidates)))


def bad_reasons(violating: DataFrame) -> DataFrame:
    """Rows whose reason is null or outside the business grammar."""
    return violating.where(~F.coalesce(F.col("reason").rlike(BUSINESS), F.lit(False)))
