"""Last-writer-wins folds and the merge of winners into state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

DEFAULT_ORDER = ("event_time", "source_ts", "content_hash")


def _comparable(f: T.StructField) -> Column:
    value = F.col(f"`{f.name}`")
    return F.array_sort(F.map_entries(value)) if isinstance(f.dataType, T.MapType) else value


def _rank(df: DataFrame, order: tuple[str, ...]) -> Column:
    """The ordering tuple, then every other column so that ties have one winner; nulls are lowest."""
    by_name = {f.name: f for f in df.schema.fields}
    rest = [c for c in df.columns if c not in order]
    return F.struct(*(_comparable(by_name[c]).alias(f"o{i}") for i, c in enumerate((*order, *rest))))


def winners(facts: DataFrame, domain_id: str, order: tuple[str, ...] = DEFAULT_ORDER) -> DataFrame:
    """The row with the greatest ordering tuple for each domain id.

    A grouped maximum: partial results are combined before the shuffle, so a
    domain id with very many facts sends one row a task."""
    best = facts.groupBy(F.col(domain_id).alias("_weirgate_domain")).agg(F.max_by(F.struct(*(F.col(f"`{c}`") for c in facts.columns)), _rank(facts, order)).alias("w"))
    return best.select("w.*")


def merged(state: DataFrame, source: DataFrame, domain_id: str, order: tuple[str, ...] = DEFAULT_ORDER, change: str | None = None) -> DataFrame:
    """``state`` after ``source`` (one row a domain id): a source row replaces a
    state row only with a strictly greater ordering tuple, new ids are added.
    ``change`` names a column that says inserted, updated or kept."""
    keep = F.struct(*(F.col(f"`{c}`") for c in state.columns))
    s = state.select(F.col(domain_id).alias("id"), keep.alias("s"), F.struct(*(F.col(c) for c in order)).alias("so"))
    w = source.select(F.col(domain_id).alias("id"), keep.alias("w"), F.struct(*(F.col(c) for c in order)).alias("wo"))
    newer = F.col("w").isNotNull() & (F.col("wo") > F.col("so"))
    what = F.when(F.col("s").isNull(), F.lit("inserted")).when(newer, F.lit("updated")).otherwise(F.lit("kept"))
    rows = s.join(w, "id", "full_outer").select(F.when(F.col("s").isNull() | newer, F.col("w")).otherwise(F.col("s")).alias("r"), *([what.alias(change)] if change else []))
    return rows.select("r.*", *([change] if change else []))


def repeated_keys(source: DataFrame, domain_id: str) -> DataFrame:
    """Domain ids with more than one row: a defect of a custom fold."""
    return source.groupBy(domain_id).count().where("count > 1")


def fold(state: DataFrame, facts: DataFrame, domain_id: str, order: tuple[str, ...] = DEFAULT_ORDER) -> DataFrame:
    return merged(state, winners(facts, domain_id, order), domain_id, order)
