"""Approximate nearest neighbours by cross-polytope hashing.

A vector is scaled to length 1, padded to a power of two and turned by three
rounds of random signs and a fast Hadamard transform; its hash is the nearest
signed axis (Andoni et al., 2015).  Each of several tables has its own
rotation.  The index holds every row once in each table; a query looks into its
nearest axes of each table.  Rows and queries meet by (table, bucket); parts of
rows and of queries follow from the measured size of each bucket, and queries go to
the parts of their own buckets only.  A row carries its buckets in all tables, so
a pair that an earlier table has compared is not compared again.  Each meeting
returns a query's nearest rows by the exact distance, and a grouped top-k ends
the search.  Queries that find fewer than ``k`` rows look into all axes of one
table, that is at every row.

How many tables, probes and hashes in a bucket are needed depends on the data:
near neighbours need few, vectors that lie far apart many.  They are fitted on a
sample of at most `SAMPLE` rows and `SAMPLE_BYTES`, up to `ASKED` of them as
queries: the settings that compare the smallest share of rows at a recall of
`RECALL` there.  Of a row's k neighbours a sample holds its own share, so recall is
that of so many nearest, at least one.  Several hashes are tried from `JOINED_FROM`
rows on.  Where nothing reaches the recall, every row is compared.

Of rows with equal vectors only the k + 1 smallest ids can be answers, so the
others, however many, stay out of the index; queries with equal vectors are
searched once.

Defined results: vectors that are null, zero, empty or hold a null or
non-finite component are left out, as rows and as queries; so are null ids.
Vectors are compared with those of the same length only.  Repeated rows (equal
id and vector) count once.  Ties go to the smaller id.  Extra columns are
ignored.  Distances are Euclidean, in double precision, on the vectors as given;
recall is measured in the tests and rests on lengths that do not vary much.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import shared

MOST_TABLES, ROTATIONS = 20, 3
SAMPLE, SAMPLE_BYTES, ASKED, RECALL = 20_000, 32 << 20, 256, 0.96
JOINED_FROM = 1 << 18
#: Rows and queries of a bucket that meet in one group; queries computed at once.
PART, ASK, AT_ONCE = 20_000, 2048, 32
#: Buckets whose sizes are sent to every task; more are joined.
MOST_SENT = 1_000_000


@dataclass(frozen=True)
class Settings:
    """``share`` of the rows that a query is compared with and ``recall``, both in the sample."""

    tables: int
    probes: int
    hashes: int = 1
    share: float | None = None
    recall: float | None = None


def hadamard(x: np.ndarray) -> np.ndarray:
    """The fast Walsh-Hadamard transform of each row, scaled to keep lengths."""
    n, h = x.shape[1], 1
    x = x.copy()
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], 2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def rotated(unit: np.ndarray, table: int) -> np.ndarray:
    """``unit`` under the pseudo-rotation of a table."""
    size = 1 << max(0, unit.shape[1] - 1).bit_length()
    x = np.zeros((len(unit), size))
    x[:, : unit.shape[1]] = unit
    signs = np.random.default_rng([table, size]).choice([-1.0, 1.0], (ROTATIONS, size))
    for s in signs:
        x = hadamard(x * s)
    return x


def axes(turned: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` nearest signed axes of each row, nearest first."""
    both = np.concatenate([turned, -turned], 1)
    probes = min(probes, both.shape[1])
    best = np.argpartition(-both, probes - 1, axis=1)[:, :probes]
    return np.take_along_axis(best, np.argsort(-np.take_along_axis(both, best, 1), 1, kind="stable"), 1)


def probed(unit: np.ndarray, table: int, probes: int, hashes: int) -> np.ndarray:
    """The ``probes`` best buckets of each row in a table: with one hash a signed
    axis, with more the combinations of axes that lie nearest in sum."""
    first = rotated(unit, table * hashes)
    if hashes == 1:
        return axes(first, probes).astype(np.int64)
    width, out, score = 2 * first.shape[1], np.zeros((len(unit), 1), np.int64), np.zeros((len(unit), 1))
    for i in range(hashes):
        turned = first if i == 0 else rotated(unit, table * hashes + i)
        own = axes(turned, probes)
        near = np.take_along_axis(np.concatenate([turned, -turned], 1), own, 1)
        out = (out[:, :, None] * width + own[:, None, :]).reshape(len(unit), -1)
        score = (score[:, :, None] + near[:, None, :]).reshape(len(unit), -1)
        best = np.argsort(-score, 1, kind="stable")[:, :probes]
        out, score = np.take_along_axis(out, best, 1), np.take_along_axis(score, best, 1)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    unit = x / np.abs(x).max(1, keepdims=True)
    return unit / np.linalg.norm(unit, axis=1, keepdims=True)


def fitted(x: np.ndarray, k: int, n: int) -> Settings:
    """The cheapest settings that reach `RECALL` within the sample ``x`` of ``n`` rows."""
    exhaustive = Settings(1, 1 << 30, 1, 1.0, 1.0)
    if len(x) <= 4 * k:
        return exhaustive
    k = max(1, min(k, round(k * len(x) / n)))
    at = np.unique(np.linspace(0, len(x) - 1, min(ASKED, len(x))).astype(int))
    norms = (x * x).sum(1)
    d = norms[None, :] + norms[at][:, None] - 2 * x[at] @ x.T
    d[np.arange(len(at)), at] = np.inf
    near = np.argpartition(d, k - 1, axis=1)[:, :k]
    unit, best = _unit(x), exhaustive
    for hashes in (1, 2) if n >= JOINED_FROM else (1,):
        width = 2 * (1 << max(0, x.shape[1] - 1).bit_length())
        if width**hashes > 1 << 16:
            break
        least = np.full((len(at), len(x)), np.iinfo(np.int32).max, np.int32)  # probes after which a pair meets in some table
        for t in range(MOST_TABLES):
            code, score = np.zeros(len(x), np.int64), np.zeros((len(at), 1))
            for i in range(hashes):
                turned = rotated(unit, t * hashes + i)
                both = np.concatenate([turned, -turned], 1)
                code = code * width + both.argmax(1)
                score = (score[:, :, None] + both[at][:, None, :]).reshape(len(at), -1)
            place = np.argsort(np.argsort(-score, 1, kind="stable"), 1).astype(np.int32)
            np.minimum(least, place[:, code], out=least)
            found = np.take_along_axis(least, near, 1)
            needed = int(np.sort(found, axis=None)[int(np.ceil(RECALL * found.size)) - 1]) + 1
            share = float((least < needed).mean())
            if share * (1 + 0.02 * (t + 1)) < best.share * (1 + 0.02 * best.tables):
                best = Settings(t + 1, needed, hashes, share, float((found < needed).mean()))
    return best


def _codes(vectors: DataFrame, asking: bool, of: Settings, kind: str) -> DataFrame:
    """``vectors`` (key, v) with their bucket in each table, or their buckets in order of nearness."""
    one = pa.list_(pa.int64())

    def enter(batches):
        for batch in batches:
            raw, rows = batch.column(1).to_pylist(), []
            for size in sorted({len(v) for v in raw}):
                every = np.array([i for i, v in enumerate(raw) if len(v) == size])
                few = max(1, (1 << 22) // (size // np.dtype(kind).itemsize * 4) ** of.hashes)  # bounds the work arrays
                for at in (every[i : i + few] for i in range(0, len(every), few)):
                    unit = _unit(np.frombuffer(b"".join(raw[i] for i in at), kind).astype(float).reshape(len(at), -1))
                    found = [probed(unit, t, of.probes if asking else 1, of.hashes) + ((np.int64(size) << 40) | (t << 32)) for t in range(of.tables)]
                    rows += zip(at.tolist(), ([f[j].tolist() if asking else int(f[j, 0]) for f in found] for j in range(len(at))), strict=True)
            rows.sort()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c for _, c in rows], pa.list_(one) if asking else one)], names=["key", "v", "codes"])

    return vectors.mapInArrow(enter, f"key long, v binary, codes array<{'array<long>' if asking else 'long'}>")


def _meeting(index: DataFrame, asked: DataFrame, k: int, of: Settings, kind: str) -> DataFrame:
    """(q, vec_id, score): each query's k + 1 nearest in each meeting with rows of a bucket."""
    index, asked = shared.durable(_codes(index, False, of, kind), "entries"), shared.durable(_codes(asked, True, of, kind), "probes")
    sizes = index.select(F.explode("codes").alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("n"))
    asks = asked.select(F.explode(F.flatten("codes")).alias("bucket")).groupBy("bucket").agg(F.count(F.lit(1)).alias("m"))
    cut = shared.durable(sizes.join(asks, "bucket").select("bucket", F.ceil(F.col("n") / PART).cast("int").alias("parts"), F.ceil(F.col("m") / ASK).cast("int").alias("asks")), "buckets")
    cut = F.broadcast(cut) if cut.count() <= MOST_SENT else cut
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    left = index.select("key", "v", "codes", F.explode("codes").alias("bucket")).join(cut, "bucket").withColumns({"part": F.pmod(F.xxhash64("key"), F.col("parts")).cast("int"), "ask": every("asks")})
    right = asked.select("key", "v", "codes", F.explode(F.flatten("codes")).alias("bucket")).join(cut, "bucket").withColumns({"ask": F.pmod(F.xxhash64("key"), F.col("asks")).cast("int"), "part": every("parts")})
    shape = ["bucket", "part", "ask", "key", "v", "codes"]

    def nearest(left: pa.Table, right: pa.Table) -> pa.Table:
        out: list[tuple] = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
        if left.num_rows and right.num_rows:
            table = (left.column("bucket")[0].as_py() >> 32) & 0xFF
            ids, keys = left.column("key").to_numpy(), right.column("key").to_numpy()
            x, y = (np.frombuffer(b"".join(s.column("v").to_pylist()), kind).astype(float).reshape(s.num_rows, -1) for s in (left, right))
            codes = left.column("codes").combine_chunks().flatten().to_numpy().reshape(len(ids), -1) & 0xFFFFFFFF
            looked = right.column("codes").to_pylist()
            norms = (x * x).sum(1)
            seen = []  # the rows' codes of earlier tables, as places among those that occur here
            for t in range(table):
                own, place = np.unique(codes[:, t], return_inverse=True)
                seen.append((own, place))
            for at in range(0, len(keys), AT_ONCE):
                some = range(at, min(len(keys), at + AT_ONCE))
                d = norms[None, :] + (y[at : at + AT_ONCE] ** 2).sum(1)[:, None] - 2 * y[at : at + AT_ONCE] @ x.T
                for t, (own, place) in enumerate(seen):
                    met = np.stack([np.isin(own, np.array(looked[i][t], np.int64) & 0xFFFFFFFF) for i in some])
                    d[met[:, place]] = np.inf  # compared in table t
                for i, row in zip(some, d, strict=True):
                    edge = np.partition(row, k)[k] if len(row) > k + 1 else np.inf
                    near = np.flatnonzero((row <= edge + 1e-9 * (norms.max() + 1)) & (row < np.inf))
                    exact = np.sqrt(((x[near] - y[i]) ** 2).sum(1))
                    best = np.lexsort((ids[near], exact))[: k + 1]
                    out.append((np.full(len(best), keys[i]), ids[near][best], exact[best]))
        q, ids, score = (np.concatenate(c) for c in zip(*out, strict=True))
        return pa.table({"q": pa.array(q, pa.int64()), "vec_id": pa.array(ids, pa.int64()), "score": pa.array(score, pa.float64())})

    return left.select(*shape).groupBy("bucket", "part", "ask").cogroup(right.select(*shape).groupBy("bucket", "part", "ask")).applyInArrow(nearest, "q long, vec_id long, score double")


def _top(rows: DataFrame, by: str, k: int) -> DataFrame:
    return rows.withColumn("rank", F.row_number().over(Window.partitionBy(by).orderBy("score", "vec_id"))).where(F.col("rank") <= k)


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", settings: Settings | None = None) -> DataFrame:
    """(query_id, rank, vec_id, score) for each row of ``queries`` (same columns as
    ``vectors``): its k nearest rows, the query's own id left out."""
    shared.share_code(vectors.sparkSession)
    v = F.col(vector_col)

    def usable(df: DataFrame) -> DataFrame:
        x = F.transform(v, lambda e: e.cast("double"))
        fine = F.col(id_col).isNotNull() & (F.size(v) > 0) & F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))) & F.exists(x, lambda e: e != 0)
        return df.where(fine).select(F.col(id_col).cast("long").alias("id"), x.alias("x"))

    kind = "<f4" if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else "<f8"

    def packed(batches):
        for batch in batches:
            raw = [np.asarray(x, kind) + np.zeros((), kind) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([x.tobytes() for x in raw], pa.binary())], names=["id", "v"])

    def rows(df: DataFrame) -> DataFrame:
        return usable(df).mapInArrow(packed, "id long, v binary")

    first = Window.partitionBy("v").orderBy("id")
    held = rows(vectors).withColumn("copy", F.dense_rank().over(first)).where(F.col("copy") <= k + 1).select("id", "v").distinct()
    held = shared.durable(held, "vectors")
    asked_rows = shared.durable(rows(queries).distinct(), "asked")
    asked = shared.durable(asked_rows.select("v").distinct().withColumn("q", F.monotonically_increasing_id()), "queries")
    index, looked = held.select(F.col("id").alias("key"), "v"), asked.select(F.col("q").alias("key"), "v")
    n = held.count()
    of = settings or _fit(held, n, k, kind)
    found = shared.durable(_top(_meeting(index, looked, k, of, kind), "q", k + 1).select("q", "vec_id", "score"), "found")
    short = asked.join(found.groupBy("q").count().where(F.col("count") > min(k, n - 1)).select("q"), "q", "left_anti")
    if of.probes < 1 << 30 and not short.isEmpty():
        short = shared.durable(short, "short")
        more = _top(_meeting(index, short.select(F.col("q").alias("key"), "v"), k, Settings(1, 1 << 30), kind), "q", k + 1).select("q", "vec_id", "score")
        found = found.join(short.select("q"), "q", "left_anti").unionByName(more)
    answers = asked_rows.withColumnRenamed("id", "query_id").join(asked, "v").join(found, "q").where(F.col("vec_id") != F.col("query_id"))
    place = F.row_number().over(Window.partitionBy("query_id", "q").orderBy("score", "vec_id"))
    return answers.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _fit(held: DataFrame, n: int, k: int, kind: str) -> Settings:
    """Settings from a bounded sample of the vectors of the most frequent length."""
    if not n:
        return Settings(1, 1)
    common = held.groupBy(F.octet_length("v").alias("size")).count().orderBy(F.desc("count"), "size").first()
    rows, parts = max(1, min(SAMPLE, SAMPLE_BYTES // common.size)), 1 << 20
    some = held.where((F.octet_length("v") == common.size) & (F.pmod(F.xxhash64("id"), F.lit(parts)) < -(-parts * rows // max(rows, common["count"]))))
    raw = [bytes(r.v) for r in some.orderBy("id", "v").collect()]  # about ``rows`` of them
    return fitted(np.frombuffer(b"".join(raw), kind).astype(float).reshape(len(raw), -1), k, n) if raw else Settings(1, 1 << 30)
