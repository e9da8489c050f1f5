"""From observed objects to ledger rows: pulls, registration, non-deliveries, sweeps and the run router.

Decisions are values (`Plan`), made without side effects and then carried out in
one order: copies, ledger rows, event, completion of the claim.
"""

from __future__ import annotations

import dataclasses
import datetime
import json
import re
import time
import uuid
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import utc_now
from ..functions import identity
from ..operators import decisions, ledger
from ..sinks import events
from ..sources import objects
from ..sources.tables import Table

#: Fixed value: how far back a pull looks for what it has seen.
LOOKBACK_DAYS = 45
#: Seconds after which a pull leaves the rest to the next run.
RUN_S = 600
PAYLOAD_BYTES = 8192


@dataclasses.dataclass(frozen=True)
class Observed:
    """An object of a delivery, with where it came from and where it goes."""

    name: str
    bytes: int
    sha256: str | None
    role: str = "data"
    source: str | None = None
    uri: str | None = None


@dataclasses.dataclass(frozen=True)
class Request:
    feed_id: str
    pipeline: str
    delivery_id: str
    delivery_key: str
    received_at: datetime.datetime
    objects: tuple[Observed, ...]
    driver: str = "push"
    run_id: str = ""
    completeness_mode: str = "manifest"
    asserted_record_count: int | None = None
    notes: str | None = None

    def item(self) -> dict:
        """The request as a claim remembers it."""
        return dataclasses.asdict(self) | {"received_at": self.received_at.isoformat()}

    @staticmethod
    def from_item(item: dict) -> Request:
        return Request(**item | {"received_at": datetime.datetime.fromisoformat(item["received_at"]), "objects": tuple(Observed(**o) for o in item["objects"])})

    @property
    def content_hash(self) -> str:
        return identity.content_hash((o.name, o.sha256) for o in self.objects if o.role == "data")

    @property
    def batch_id(self) -> str:
        return identity.batch_id(self.feed_id, self.content_hash)


@dataclasses.dataclass(frozen=True)
class Plan:
    rows: tuple[dict, ...]
    copies: tuple[tuple[str, str], ...] = ()
    event: dict | None = None
    complete: tuple[str, str] | None = None
    disposition: str = ""


def _row(r: Request, disposition: str, at: datetime.datetime, supersedes: str | None = None, identified: bool = True) -> dict:
    data = [o for o in r.objects if o.role == "data"]
    staged = disposition == "registered"
    return {
        "delivery_id": r.delivery_id, "feed_id": r.feed_id, "delivery_key": r.delivery_key, "received_at": r.received_at, "recorded_at": at, "driver": r.driver, "driver_run_id": r.run_id,
        "completeness_mode": r.completeness_mode, "asserted_record_count": r.asserted_record_count, "disposition": disposition, "supersedes": supersedes,
        "content_hash": r.content_hash if identified else None, "batch_id": r.batch_id if identified else None, "size_bytes": sum(o.bytes for o in data) if identified else None,
        "object_uris": [o.uri for o in data if o.uri] if staged else [], "objects": [(o.name, o.role, o.uri if staged else o.source, o.bytes, o.sha256) for o in r.objects],
        "manifest_ref": next((o.uri if staged else o.source for o in r.objects if o.role == "manifest"), None), "notes": r.notes,
    }


def plan_registration(kind: str, held: dict | None, prior: Iterable[dict], r: Request, at: datetime.datetime) -> Plan:
    """What a registration does, by how its claim ended.

    A winner registers, and supersedes the latest registered delivery of its key
    if the content differs.  A loser notes a duplicate.  Who takes over a stale claim
    does what the dead owner had claimed, nothing derived anew."""
    if kind.startswith("LOST"):
        return Plan((_row(r, "duplicate", at),), disposition="duplicate")
    if kind == "TAKEN_OVER":
        r = Request.from_item(held)
    before = [p for p in prior if p["delivery_key"] == r.delivery_key and p["delivery_id"] != r.delivery_id]
    last = max(before, key=lambda p: (p["received_at"], p["delivery_id"]), default=None)
    replaced = last is not None and last["content_hash"] != r.content_hash
    rows = [_row(r, "registered", at, last["delivery_id"] if replaced else None)]
    if replaced:
        rows.append({**last, "disposition": "superseded", "recorded_at": at})
    event = events.delivery_registered(
        feed_id=r.feed_id, delivery_id=r.delivery_id, batch_id=r.batch_id, delivery_key=r.delivery_key, content_hash=r.content_hash, size_bytes=rows[0]["size_bytes"],
        object_uris=rows[0]["object_uris"], received_at=r.received_at, pipeline=r.pipeline,
    )
    copies = tuple((o.source, o.uri) for o in r.objects if o.source and o.uri)
    return Plan(tuple(rows), copies, event, (r.feed_id, r.batch_id), "registered")


class Registrar:
    """Carries plans out against a ledger table and claims."""

    def __init__(self, spark: SparkSession, table: Table, claims: events.Claims, emit: Callable[[str, dict], None], copy: Callable[[str, str], None] | None = None, count: Callable[[str, int, dict], None] | None = None):
        """``count`` receives a metric's name, value and labels; it may fail without harm."""
        self.spark, self.table, self.claims, self.emit = spark, table, claims, emit
        self.count = count or (lambda *_: None)
        self.copy = copy or (lambda source, target: objects.copied(spark, source, target))
        table.create(spark.createDataFrame([], ledger.SCHEMA).schema)

    def frame(self, rows: Iterable[dict]) -> DataFrame:
        names = [c.split()[0] for c in ledger.COLUMNS]
        return self.spark.createDataFrame([tuple(r[n] for n in names) for r in rows], ledger.SCHEMA)

    def feed(self, feed_id: str, since: datetime.datetime | None = None) -> DataFrame:
        df = self.table.read()[0].where(F.col("feed_id") == feed_id)
        return df if since is None else df.where(F.col("received_at") >= decisions.utc(since))

    def register(self, r: Request, at: datetime.datetime | None = None, now: float | None = None) -> Plan:
        at = at or utc_now()
        owner = r.run_id or uuid.uuid4().hex
        kind, held = self.claims.claim(r.feed_id, r.batch_id, owner, r.item(), now)
        prior: list[dict] = []
        if not kind.startswith("LOST"):
            key = r.delivery_key if kind == "WON" else held["delivery_key"]
            # few rows: the registered deliveries of one key
            prior = [p.asDict(recursive=False) for p in ledger.registered(self.feed(r.feed_id).where(F.col("delivery_key") == key)).collect()]
            prior = [p | {"received_at": p["received_at"].astimezone(datetime.UTC), "recorded_at": p["recorded_at"].astimezone(datetime.UTC), "objects": [tuple(o) for o in p["objects"]]} for p in prior]
        plan = plan_registration(kind, held, prior, r, at)
        self.execute(plan, owner)
        return plan

    def execute(self, plan: Plan, owner: str) -> None:
        for source, target in plan.copies:
            self.copy(source, target)
        if plan.rows:
            self.table.append(self.frame(plan.rows))
        if plan.event is not None:
            self.emit("delivery-registered", plan.event)
        if plan.complete is not None:
            self.claims.complete(*plan.complete, owner)
        for row in plan.rows:
            events.quietly(lambda row=row: self.count("deliveries", 1, {"feed_id": row["feed_id"], "disposition": row["disposition"]}), tries=1)
            if row["size_bytes"] is not None and row["disposition"] == "registered":
                events.quietly(lambda row=row: self.count("bytes", row["size_bytes"], {"feed_id": row["feed_id"]}), tries=1)

    def nondelivery(self, r: Request, disposition: str, at: datetime.datetime | None = None) -> Plan:
        """An incomplete or unreadable delivery: a row only if it is news."""
        hashed = disposition == "unreadable" and bool(r.objects) and all(o.sha256 for o in r.objects)
        row = _row(r, disposition, at or utc_now(), identified=hashed)
        news = ledger.changed_nondeliveries(self.feed(r.feed_id), self.frame([row]).select("feed_id", "delivery_key", "disposition", "objects"))
        plan = Plan((row,) if not news.isEmpty() else (), disposition=disposition)
        self.execute(plan, "")
        return plan

    def stuck(self, now: float | None = None) -> list[dict]:
        """Emits an event for each claim that was left open."""
        found = self.claims.stuck(now)
        for c in found:
            self.emit("claim-stuck", {"schema_version": 1, **{k: c[k] for k in ("feed_id", "batch_id", "owner")}, "claimed_at": events.instant(datetime.datetime.fromtimestamp(c["claimed_at"], datetime.UTC))})
        return found

    def reconcile(self, at: datetime.datetime | None = None) -> int:
        """Supersedes all but the newest of live duplicates; how many."""
        found = ledger.superseding_rows(ledger.reconciliation(self.table.read()[0]), F.lit(at or utc_now()).cast("timestamp"))
        if found.isEmpty():
            return 0
        return self.table.append(found)[1]

    def overdue(self, feeds: DataFrame, now: datetime.datetime, marked: set[tuple[str, str]]) -> list[tuple[str, str]]:
        """Emits an event for each overdue date not marked yet, then marks it (at least once)."""
        received = ledger.registered(self.table.read()[0]).select("feed_id", "received_at")
        told = []
        for r in decisions.overdue(feeds, received, decisions.utc(now)).orderBy("feed_id", "expected_date").collect():  # a few dates a feed
            key = (r.feed_id, r.expected_date.isoformat())
            if key not in marked:
                self.emit("delivery-overdue", events.delivery_overdue(feed_id=r.feed_id, expected_date=r.expected_date, expected_by=r.expected_by.replace(tzinfo=datetime.UTC)))
                marked.add(key)
                told.append(key)
        return told


# -- pulls


@dataclasses.dataclass(frozen=True)
class Feed:
    """What a pull looks for and how it tells that a delivery is complete."""

    feed_id: str
    pipeline: str
    glob: str = "*"
    mode: str = "none"
    trailer: str | None = None
    count_group: int | None = None
    quiet_minutes: int | None = None

    def __post_init__(self) -> None:
        if self.mode not in ("none", "trailer", "manifest") or (self.mode == "trailer") != (self.trailer is not None):
            raise ValueError("mode is none, trailer (with a pattern) or manifest")


@dataclasses.dataclass(frozen=True)
class Pulled:
    plans: tuple[Plan, ...]
    carried: int


def pull(reg: Registrar, feed: Feed, folder: str, stage: str, now: datetime.datetime | None = None, budget: int = decisions.RUN_BYTES, seconds: float = RUN_S, force: bool = False, clock: Callable[[], float] = time.monotonic, run_id: str = "") -> Pulled:
    """Registers what a folder holds and the ledger does not know, oldest first.

    What exceeds the budget of bytes or time is carried over: it is not in the
    ledger, so the next run finds it.  In manifest mode the glob names the manifests,
    and those seen defective are looked at again."""
    spark, began, now = reg.spark, clock(), now or utc_now()
    run_id = run_id or uuid.uuid4().hex
    known = reg.feed(feed.feed_id, now - datetime.timedelta(days=LOOKBACK_DAYS))
    seen = ledger.acquired(known) if feed.mode == "manifest" else ledger.acquired(known).unionByName(ledger.defective(known))
    listing = objects.listing(spark, folder).withColumn("feed_id", F.lit(feed.feed_id))
    found = decisions.candidates(listing, seen, feed.glob, decisions.utc(now), feed.quiet_minutes, force)
    todo = decisions.budget_prefix(found, budget).orderBy("mtime", "name").collect()  # names of one run, bounded by its budget
    plans: list[Plan] = []
    for at, item in enumerate(todo):
        if clock() - began > seconds:
            return Pulled(tuple(plans), found.count() - at)
        look = _by_manifest if feed.mode == "manifest" else _alone
        plans.append(look(reg, feed, item, listing, stage, now, run_id))
    return Pulled(tuple(plans), found.count() - len(todo))


def _request(feed: Feed, key: str, now: datetime.datetime, found: list[Observed], stage: str, **more) -> Request:
    delivery = uuid.uuid4().hex
    prefix = f"{stage.rstrip('/')}/{feed.feed_id}/received_at={now.astimezone(datetime.UTC):%Y%m%dT%H%M%S%fZ}/dl-{delivery}/"
    return Request(feed.feed_id, feed.pipeline, delivery, key, now, tuple(dataclasses.replace(o, uri=prefix + o.name) for o in found), "pull", completeness_mode=feed.mode, **more)


def _alone(reg: Registrar, feed: Feed, item, listing: DataFrame, stage: str, now: datetime.datetime, run_id: str) -> Plan:
    """An object that is a delivery by itself."""
    told = objects.digests(reg.spark, [item.uri])
    if feed.trailer is not None:
        told = told.withColumn("v", decisions.trailer_verdict(F.col("tail"), feed.trailer, feed.count_group))
    told = told.drop("tail").first()
    verdict, count = (told.v.verdict, told.v.asserted_record_count) if feed.trailer is not None else ("complete", None)
    r = _request(feed, item.name, now, [Observed(item.name, told.bytes, told.sha256, source=item.uri)], stage, run_id=run_id, asserted_record_count=count)
    if verdict == "complete":
        return reg.register(r, now)
    return reg.nondelivery(r, "incomplete" if verdict == "incomplete" else "unreadable", now)


def _by_manifest(reg: Registrar, feed: Feed, item, listing: DataFrame, stage: str, now: datetime.datetime, run_id: str) -> Plan:
    """A manifest and the objects that it declares."""
    spark = reg.spark
    own = Observed(item.name, item.bytes, None, "manifest", item.uri)
    text = spark.read.format("binaryFile").load(item.uri).where(F.col("length") <= objects.MANIFEST_BYTES).select(F.decode("content", "UTF-8").alias("t"), F.sha2("content", 256).alias("sha")).first()
    told = spark.createDataFrame([(text.t if text else None,)], "t string").select(objects.parse_manifests(F.col("t")).alias("m")).first().m
    if told.fault is not None:
        fault = told.fault if text else "too-large"
        return reg.nondelivery(_request(feed, item.name, now, [own], stage, run_id=run_id, notes=fault), "unreadable", now)
    own = dataclasses.replace(own, sha256=text.sha)
    m = told.manifest
    declared = spark.createDataFrame([(m.manifest_id, m.feed_id, i, f.name, f.bytes, f.sha256, f.record_count) for i, f in enumerate(m.files)], "manifest_id string, feed_id string, place int, name string, bytes long, sha256 string, record_count long")
    here = listing.join(declared.select("name").distinct(), "name").select("name", "bytes", "uri").collect()  # at most `objects.MANIFEST_FILES`
    shas = {r.uri: r.sha256 for r in objects.digests(spark, [h.uri for h in here]).select("uri", "sha256").collect()} if here else {}
    observed = spark.createDataFrame([(m.feed_id, h.name, h.bytes, shas[h.uri]) for h in here], "feed_id string, name string, bytes long, sha256 string")
    verdict = decisions.manifest_verdicts(declared, observed, F.lit(feed.feed_id)).first()
    r = _request(feed, m.manifest_id, now, [*(Observed(h.name, h.bytes, shas[h.uri], source=h.uri) for h in here), own], stage, run_id=run_id, asserted_record_count=verdict.asserted_record_count, notes=verdict.reason)
    if verdict.verdict == "complete":
        return reg.register(r, now)
    return reg.nondelivery(r, "incomplete" if verdict.verdict == "incomplete" else "unreadable", now)


def push(reg: Registrar, feed: Feed, uri: str, stage: str, now: datetime.datetime | None = None, run_id: str = "") -> Plan:
    """One object that a store announces."""
    now = now or utc_now()
    folder, _, name = uri.rpartition("/")
    found = objects.listing(reg.spark, folder).where(F.col("name") == name)
    item = found.first()
    if item is None:
        raise FileNotFoundError("the announced object is not there")
    look = _by_manifest if feed.mode == "manifest" else _alone
    return look(reg, feed, item, objects.listing(reg.spark, folder), stage, now, run_id or uuid.uuid4().hex)


# -- the router of batch runs


def arguments(argv: list[str]) -> dict[str, str]:
    """--name value and --name=value pairs as a map; anything else is refused."""
    out, left = {}, list(argv)
    while left:
        head = left.pop(0)
        if not head.startswith("--") or len(head) < 3:
            raise ValueError("arguments are --name value")
        name, eq, value = head[2:].partition("=")
        if not eq:
            if not left or left[0].startswith("--"):
                raise ValueError(f"--{name} has no value")
            value = left.pop(0)
        if name in out:
            raise ValueError(f"--{name} repeats")
        out[name] = value
    return out


def run_name(pipeline: str, batch_id: str, rerun: int = 0) -> str:
    """The name under which a batch runs once; deliberate reruns are numbered."""
    clean = re.sub(r"[^A-Za-z0-9-]+", "-", pipeline).strip("-")
    name = f"{clean[:40]}-{batch_id}"
    return f"{name}--r{rerun}" if rerun else name


#: Fields of an event that a run may receive.
PAYLOAD = ("feed_id", "delivery_id", "batch_id", "object_uris", "received_at", "pipeline")


def route(event: dict, pipelines: Iterable[str], start: Callable[[str, dict], bool]) -> str:
    """Starts the run of a registered delivery: started, exists (the same success) or ignored."""
    if event.get("pipeline") not in set(pipelines):
        return "ignored"
    payload = {k: event[k] for k in PAYLOAD}
    if len(json.dumps(payload).encode()) > PAYLOAD_BYTES:
        raise ValueError(f"the run's payload is over {PAYLOAD_BYTES} bytes")
    return "started" if start(run_name(event["pipeline"], event["batch_id"]), payload) else "exists"


def consistent_uris(uris: Iterable[str], feed_id: str, delivery_id: str) -> list[str]:
    """Addresses that do not belong to the delivery they are said to be of."""
    shape = re.compile(rf"[a-z][a-z0-9+.-]*://[^/]+/(?:.+/)?{re.escape(feed_id)}/received_at=\d{{8}}T\d{{12}}Z/dl-{re.escape(delivery_id)}/[^/\\%]+")
    return [u for u in uris if not shape.fullmatch(u)]
