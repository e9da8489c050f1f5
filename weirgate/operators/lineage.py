"""Lineage columns of raw and fact rows."""

from __future__ import annotations

import dataclasses
import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclasses.dataclass(frozen=True)
class Lineage:
    batch_id: str
    delivery_id: str
    feed_id: str
    received_at: datetime.datetime
    source_uri: str | None = None


def stamp(df: DataFrame, lineage: Lineage, read_spec_version: str | None = None) -> DataFrame:
    """``df`` with its batch, delivery, feed and time of receipt; raw rows also
    carry the version of the read specification."""
    extra = {
        "batch_id": F.lit(lineage.batch_id), "delivery_id": F.lit(lineage.delivery_id), "feed_id": F.lit(lineage.feed_id),
        "received_at": F.lit(lineage.received_at).cast("timestamp"),
    }
    if lineage.source_uri is not None:
        extra["source_uri"] = F.lit(lineage.source_uri)
    if read_spec_version is not None:
        extra["read_spec_version"] = F.lit(read_spec_version)
    return df.withColumns(extra)
