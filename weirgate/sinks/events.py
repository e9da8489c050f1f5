"""Events as JSON lines, with the fields and the order in which consumers expect them."""

from __future__ import annotations

import datetime
import hashlib
import json
import os
import time
import uuid
from collections.abc import Callable

from ..sources.files import LocalFiles


def instant(at: datetime.datetime) -> str:
    at = at.astimezone(datetime.UTC)
    return at.strftime("%Y-%m-%dT%H:%M:%S.%fZ" if at.microsecond else "%Y-%m-%dT%H:%M:%SZ")


def delivery_registered(*, feed_id: str, delivery_id: str, batch_id: str, delivery_key: str, content_hash: str, size_bytes: int, object_uris: list[str], received_at: datetime.datetime, pipeline: str) -> dict:
    return {"schema_version": 1, "feed_id": feed_id, "delivery_id": delivery_id, "batch_id": batch_id, "delivery_key": delivery_key, "content_hash": content_hash, "size_bytes": size_bytes, "object_uris": object_uris, "received_at": instant(received_at), "pipeline": pipeline}


def delivery_overdue(*, feed_id: str, expected_date: datetime.date, expected_by: datetime.datetime) -> dict:
    return {"schema_version": 1, "feed_id": feed_id, "expected_date": expected_date.isoformat(), "expected_by": instant(expected_by)}


def batch_started(*, pipeline: str, feed_id: str, batch_id: str, delivery_id: str, raw_count: int, land_snapshot_id: int, started_at: datetime.datetime) -> dict:
    return {"schema_version": 1, "pipeline": pipeline, "feed_id": feed_id, "batch_id": batch_id, "delivery_id": delivery_id, "raw_count": raw_count, "land_snapshot_id": land_snapshot_id, "started_at": instant(started_at)}


def batch_completed(*, pipeline: str, feed_id: str, batch_id: str, delivery_id: str, raw_count: int, pre_quarantined: int, post_quarantined: int, fact_count: int, fact_snapshot_id: int, state_snapshot_id: int | None, completed_at: datetime.datetime) -> dict:
    return {"schema_version": 1, "pipeline": pipeline, "feed_id": feed_id, "batch_id": batch_id, "delivery_id": delivery_id, "raw_count": raw_count, "pre_quarantined": pre_quarantined, "post_quarantined": post_quarantined, "fact_count": fact_count, "fact_snapshot_id": fact_snapshot_id, "state_snapshot_id": state_snapshot_id, "completed_at": instant(completed_at)}


class JsonLines:
    """Events appended to a file, one line each."""

    def __init__(self, path: str):
        self.path = path

    def __call__(self, kind: str, event: dict) -> None:
        os.makedirs(os.path.dirname(self.path) or ".", exist_ok=True)
        with open(self.path, "a", encoding="utf-8") as f:
            f.write(json.dumps({"type": kind, **event}) + "\n")


def quietly(action: Callable[[], object], tries: int = 2, most_s: float = 2.0) -> bool:
    """Runs a best-effort write that never fails its caller; whether it succeeded."""
    for i in range(tries):
        try:
            action()
            return True
        except Exception:
            if i + 1 < tries:
                time.sleep(min(most_s, 0.2 * 2**i))
    return False


class EventFolder:
    """Events as one JSON file each, in a folder that all nodes see."""

    def __init__(self, files, folder: str):
        self.files, self.folder = files, folder.rstrip("/")

    def __call__(self, kind: str, event: dict) -> None:
        self.files.put(f"{self.folder}/{time.time_ns():020d}-{uuid.uuid4().hex}.json", json.dumps({"type": kind, **event}).encode())


# -- claims: one owner for each (feed, batch)


class Claims:
    """An exclusive claim for each (feed, batch): a row of generations, each a file
    that is put in place once.

    ``claim`` gives WON, LOST_COMPLETED, LOST_IN_PROGRESS, or TAKEN_OVER for a claim
    left open for longer than ``stale_s``; the last returns what the dead owner had
    claimed.  A taker puts the next generation in place, with its own time, so one
    that dies as well goes stale in its turn.  Completion is fenced: it marks the
    owner's generation and counts while that is the newest.  ``files`` is
    `LocalFiles` or, for a store that several machines see, `SharedFiles`."""

    STALE_S = 1200

    def __init__(self, folder: str, files=None, stale_s: float = STALE_S):
        self.folder, self.files, self.stale_s = folder.rstrip("/"), files or LocalFiles(), stale_s

    def _key(self, feed_id: str, batch_id: str) -> str:
        return hashlib.sha256(f"{feed_id}\n{batch_id}".encode()).hexdigest()[:40]

    def _newest(self, key: str) -> tuple[int, dict] | None:
        names = self.files.names(f"{self.folder}/{key}")
        made = [int(n[:-5]) for n in names if n.endswith(".json")]
        if not made:
            return None
        at = max(made)
        held = json.loads(self.files.read(f"{self.folder}/{key}/{at:06d}.json"))
        return at, held | {"done": f"{at:06d}.done" in names}

    def claim(self, feed_id: str, batch_id: str, owner: str, item: dict, now: float | None = None) -> tuple[str, dict | None]:
        now, key = time.time() if now is None else now, self._key(feed_id, batch_id)
        own = {"owner": owner, "claimed_at": now, "item": item, "feed_id": feed_id, "batch_id": batch_id}

        def put(generation: int, claim: dict) -> bool:
            return self.files.put(f"{self.folder}/{key}/{generation:06d}.json", json.dumps(claim).encode())

        if (newest := self._newest(key)) is None:
            if put(0, own):
                return "WON", None
            newest = self._newest(key)
        at, held = newest
        if held["done"]:
            return "LOST_COMPLETED", held["item"]
        if now - held["claimed_at"] <= self.stale_s or not put(at + 1, own | {"item": held["item"]}):
            return "LOST_IN_PROGRESS", held["item"]
        return "TAKEN_OVER", held["item"]

    def complete(self, feed_id: str, batch_id: str, owner: str) -> bool:
        key = self._key(feed_id, batch_id)
        newest = self._newest(key)
        if newest is None or newest[1]["owner"] != owner:
            return False
        at, _ = newest
        self.files.put(f"{self.folder}/{key}/{at:06d}.done", b"")
        return self._newest(key)[0] == at

    def stuck(self, now: float | None = None) -> list[dict]:
        """Open claims that have gone stale, oldest first."""
        now = time.time() if now is None else now
        found = [newest[1] for key in self.files.names(self.folder) if (newest := self._newest(key))]
        return sorted((c for c in found if not c["done"] and now - c["claimed_at"] > self.stale_s), key=lambda c: c["claimed_at"])
