"""Deterministic identities: content hashes and batch ids, on the driver and as columns."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: the namespace of batch ids (the URL namespace of RFC 4122).
BATCH_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")


def content_hash(objects: Iterable[tuple[str, str]]) -> str:
    """sha256 over the sorted ``<sha256>  <name>`` lines of (name, sha256) pairs."""
    lines = sorted(f"{sha}  {name}" for name, sha in objects)
    return "sha256:" + hashlib.sha256("\n".join(lines).encode()).hexdigest()


def content_hash_agg(name: Column, sha: Column) -> Column:
    """The same as a grouped aggregate over a delivery's data objects (bounded: a delivery lists at most 1000)."""
    lines = F.array_sort(F.collect_list(F.concat(sha, F.lit("  "), name)))
    return F.concat(F.lit("sha256:"), F.sha2(F.array_join(lines, "\n"), 256))


def batch_id(feed_id: str, content: str) -> str:
    return str(uuid.uuid5(BATCH_NAMESPACE, f"{feed_id}\n{content}"))


def batch_id_of(feed_id: Column, content: Column) -> Column:
    """A version 5 UUID made of SQL functions only."""
    name = F.concat(F.unhex(F.lit(BATCH_NAMESPACE.hex)), F.encode(F.concat(feed_id, F.lit("\n"), content), "UTF-8"))
    h = F.sha1(name)
    variant = F.lower(F.hex(F.conv(F.substring(h, 17, 1), 16, 10).cast("int").bitwiseAND(3).bitwiseOR(8)))
    return F.concat_ws("-", F.substring(h, 1, 8), F.substring(h, 9, 4), F.concat(F.lit("5"), F.substring(h, 14, 3)), F.concat(variant, F.substring(h, 18, 3)), F.substring(h, 21, 12))
