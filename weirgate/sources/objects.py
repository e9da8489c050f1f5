"""Listings, digests, tails and manifests of delivered objects, and the feed registry."""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TAIL_BYTES = 4096
#: Larger objects are not read as one value but streamed.
WHOLE_BYTES = 1 << 30
REGISTRY_S = 60
MANIFEST_BYTES, MANIFEST_FILES = 1 << 20, 1000
MANIFEST = "manifest_version int, manifest_id string, feed_id string, files array<struct<name:string,bytes:bigint,sha256:string,record_count:bigint>>, created_at string, _bad string"


def listing(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """name, bytes, mtime and uri of the objects below a path; contents are not read."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    read = read.option("pathGlobFilter", glob) if glob else read
    return read.load(path).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("bytes"), F.col("modificationTime").alias("mtime"), F.col("path").alias("uri"))


def digests(spark: SparkSession, uris: list[str]) -> DataFrame:
    """uri, bytes, sha256 and the tail of each object, hashed on the executors;
    objects over `WHOLE_BYTES` are streamed."""
    read = spark.read.format("binaryFile").load(uris)
    tail = F.decode(F.substring(F.col("content"), -TAIL_BYTES, TAIL_BYTES), "UTF-8")
    small = read.where(F.col("length") <= WHOLE_BYTES).select(F.col("path").alias("uri"), F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), tail.alias("tail"))
    large = [r.path for r in read.where(F.col("length") > WHOLE_BYTES).select("path").collect()]  # of one delivery's objects
    return small.unionByName(spark.createDataFrame([(u, *streamed(spark, u)) for u in large], small.schema)) if large else small


def _opened(spark: SparkSession, uri: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def streamed(spark: SparkSession, uri: str) -> tuple[int, str, str]:
    """bytes, sha256 and tail of an object of any size, read in small pieces."""
    fs, path = _opened(spark, uri)
    n, sha = copied(spark, uri, None)
    stream = fs.open(path)
    try:
        stream.seek(max(0, n - TAIL_BYTES))
        return n, sha, bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode("utf-8", "replace")
    finally:
        stream.close()


def copied(spark: SparkSession, source: str, target: str | None) -> tuple[int, str]:
    """Copies an object as it is, in small pieces and hashed on the way: its bytes
    and sha256.  Without a target it is only hashed."""
    jvm = spark._jvm
    fs, path = _opened(spark, source)
    sha = jvm.java.security.MessageDigest.getInstance("SHA-256")
    stream = jvm.java.security.DigestInputStream(fs.open(path), sha)
    try:
        if target is None:
            out = jvm.org.apache.commons.io.output.NullOutputStream.INSTANCE
        else:
            store, to = _opened(spark, target)
            out = store.create(to, True)
        try:
            n = jvm.org.apache.commons.io.IOUtils.copyLarge(stream, out)
        finally:
            out.close()
    finally:
        stream.close()
    return n, bytes(sha.digest()).hex()


def parse_manifests(text: Column) -> Column:
    """A manifest, or the reason why the text is none; extra keys are tolerated."""
    m = F.from_json(text, MANIFEST, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    file_fault = F.exists(m["files"], lambda f: f["name"].isNull() | (f["name"] == "") | f["bytes"].isNull() | (f["bytes"] < 0) | ~F.coalesce(f["sha256"].rlike(r"\A[0-9a-f]{64}\z"), F.lit(False)))
    fault = (
        F.when(F.octet_length(text) > MANIFEST_BYTES, F.lit("too-large"))
        .when(m.isNull() | m["_bad"].isNotNull(), F.lit("unparseable"))
        .when(F.coalesce(m["manifest_version"], F.lit(0)) != 1, F.lit("manifest_version"))
        .when(F.coalesce(m["manifest_id"], F.lit("")) == "", F.lit("manifest_id"))
        .when(F.coalesce(m["feed_id"], F.lit("")) == "", F.lit("feed_id"))
        .when(~F.coalesce(F.size(m["files"]).between(1, MANIFEST_FILES), F.lit(False)), F.lit("files"))
        .when(file_fault, F.lit("files.entry"))
    )
    return F.struct(m.dropFields("_bad").alias("manifest"), fault.alias("fault"))


def feed_registry(path: str) -> list[dict]:
    """Feeds from a YAML or JSON file: a list, or a mapping with the key ``feeds``."""
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        found = json.loads(text)
    else:
        import yaml

        found = yaml.safe_load(text)
    feeds = found["feeds"] if isinstance(found, dict) else found
    ids = [f["feed_id"] for f in feeds]
    if len(set(ids)) < len(ids):
        raise ValueError("feed ids repeat")
    for f in feeds:
        if f.get("driver") in ("api-pull", "db-unload"):
            raise NotImplementedError(f"driver {f['driver']} is reserved")
    return feeds


def render_registry(sources: list[str]) -> str:
    """One registry, as JSON, from the files that describe a source each; feeds are ordered by their id."""
    feeds: list[dict] = []
    for path in sources:
        with open(path, encoding="utf-8") as f:
            text = f.read()
        if path.endswith(".json"):
            found = json.loads(text)
        else:
            import yaml

            found = yaml.safe_load(text)
        feeds += found["feeds"] if isinstance(found, dict) and "feeds" in found else [found]
    if len({f["feed_id"] for f in feeds}) < len(feeds):
        raise ValueError("feed ids repeat")
    return json.dumps({"feeds": sorted(feeds, key=lambda f: f["feed_id"])}, sort_keys=True)


class FeedRegistry:
    """Feeds of a registry file, read again after `REGISTRY_S` seconds."""

    def __init__(self, path: str, ttl_s: float = REGISTRY_S):
        self.path, self.ttl_s, self._read_at, self._feeds = path, ttl_s, None, []

    def feeds(self, now: float | None = None) -> list[dict]:
        now = time.monotonic() if now is None else now
        if self._read_at is None or now - self._read_at >= self.ttl_s:
            self._feeds, self._read_at = feed_registry(self.path), now
        return self._feeds

    def feed(self, feed_id: str, now: float | None = None) -> dict | None:
        return next((f for f in self.feeds(now) if f["feed_id"] == feed_id), None)
