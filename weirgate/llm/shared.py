"""Helpers shared by the training-data operators: durable tables in the shared
folder, connected components over edge tables, and vectorised word hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, durable, scratch, share_code

__all__ = ["durable", "scratch"]

#: Rows and bytes per Arrow batch for text columns; bound what a Python worker holds.
TEXT_ROWS_PER_BATCH, TEXT_BYTES_PER_BATCH = 500, 32 << 20

#: Bytes of text hashed at once; bounds the work arrays (about 40 x this).
HASH_CHUNK = 1 << 18


def text_session(spark: SparkSession) -> None:
    """Keeps Arrow batches of texts small enough for a worker's memory, and the package
    importable there.  The settings stay with the session, as plans read them when they run."""
    share_code(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(TEXT_BYTES_PER_BATCH))
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")) > TEXT_ROWS_PER_BATCH:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(TEXT_ROWS_PER_BATCH))


def fold_of(doc_id: Column | str) -> Column:
    """crc32 of the id as text, modulo 4: remainder 2 is the held-out fold (null for a null id)."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string")) % 4


def kept_row(df: DataFrame) -> Column:
    """The whole row as one struct, so that its columns clash with no column added beside it."""
    return F.struct(*(F.col(f"`{c}`") for c in df.columns)).alias("kept")


# ---------------------------------------------------------------- bit filters

#: Bits of a filter for each value that it holds, at least and at most (1 MB, 64 MB).
FILTER_SHARE, LEAST_FILTER_BITS, MOST_FILTER_BITS = 64, 1 << 23, 1 << 29


def filter_bits(values: int) -> int:
    """Bits of a filter for so many values: a power of two within fixed bounds."""
    return max(LEAST_FILTER_BITS, min(MOST_FILTER_BITS, 1 << (FILTER_SHARE * max(1, values) - 1).bit_length()))


def bit_filter(values: DataFrame, column: str, bits: int) -> np.ndarray:
    """A bit for each remainder of the 64-bit ``column`` modulo ``bits``, packed; of bounded
    size whatever the number of values, and made on the executors."""
    out, slot = np.zeros(bits // 8, np.uint8), F.pmod(F.col(column), F.lit(bits))
    filled = values.select((slot + 1).alias("at")).groupBy(F.bitmap_bucket_number("at").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("at")).alias("bits"))
    for row in filled.toLocalIterator():  # 32768 bits a row
        piece = np.frombuffer(row.bits, np.uint8)
        at = (row.bucket - 1) * 4096  # buckets count from 1, as do the places in them
        out[at : at + len(piece)] |= piece[: len(out) - at]
    return out


def in_filter(packed: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Which signed 64-bit ``values`` a filter may hold."""
    at = values & np.int64(len(packed) * 8 - 1)
    return (packed[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0


# ---------------------------------------------------------------- components


def _stars(edges: DataFrame) -> bool:
    """Whether each node of the (larger, smaller) edges is a root or has one edge, to its root."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionAll(edges.select("b", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def components(edges: DataFrame, tag: str) -> DataFrame:
    """(node, root) for each node of the undirected ``edges`` (a, b): root is the
    smallest node of its component.

    Alternates large-star and small-star steps (Kiveris et al., 2014), each a
    grouped minimum (combined before the shuffle, so a hub is no burden) and a
    join back.  Every round is written to the shared folder and replaces the one before.
    """
    now = durable(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), tag)
    while not _stars(now):
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        following = durable(small.unionByName(least.select("a", F.col("m").alias("b"))).distinct(), tag)
        discard(now)
        now = following
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())


# ------------------------------------------------------------- word hashing

_P = np.uint64(0x9E3779B97F4A7C55)
_PINV = np.uint64(pow(int(_P), -1, 1 << 64))
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_POWERS.get("up", ())) < n:
        n = max(n, HASH_CHUNK * 2)
        for name, base in (("up", _P), ("down", _PINV)):
            x = np.full(n, base, np.uint64)
            x[0] = 1
            _POWERS[name] = np.multiply.accumulate(x)
    return _POWERS["up"], _POWERS["down"]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over unsigned 64-bit values."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """Word splitting over UTF-8 bytes: ``wordy`` marks the bytes of words, after
    ``fold`` (256 bytes) has been applied."""

    def __init__(self, fold: bytes, wordy: np.ndarray):
        self.fold = np.frombuffer(fold, np.uint8)
        self.wordy = wordy

    def hashes(self, raw: np.ndarray) -> np.ndarray:
        """The 64-bit hashes of the words of one text, in order."""
        out, at = [], 0
        while at < len(raw):
            end = min(len(raw), at + HASH_CHUNK)
            while end < len(raw) and self.wordy[self.fold[raw[end]]]:
                end += 1
            out.append(self._chunk(raw[at:end], np.array([0, end - at]))[0])
            at = end
        return out[0] if len(out) == 1 else np.concatenate(out) if out else np.empty(0, np.uint64)

    def _chunk(self, raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all words in ``raw`` and, for each bound, how many words start before it."""
        n = len(raw)
        if not n:
            return np.empty(0, np.uint64), np.zeros(len(bounds), np.int64)
        b = self.fold[raw]
        w = self.wordy[b]
        prev = np.empty(n, bool)
        prev[0] = False
        prev[1:] = w[:-1]
        inner = bounds[(bounds > 0) & (bounds < n)]
        prev[inner] = False
        following = np.empty(n, bool)
        following[-1] = False
        following[:-1] = w[1:]
        following[inner - 1] = False
        starts = np.flatnonzero(w & ~prev)
        ends = np.flatnonzero(w & ~following) + 1
        up, down = _powers(n)
        h = np.zeros(n + 1, np.uint64)
        np.cumsum((b.astype(np.uint64) + np.uint64(1)) * up[:n], out=h[1:])
        return mix((h[ends] - h[starts]) * down[starts] + (ends - starts).astype(np.uint64)), np.searchsorted(starts, bounds)

    def column(self, col: pa.Array) -> Iterator[np.ndarray | None]:
        """For each text of an Arrow column its word hashes (None for null)."""
        col = col.cast(pa.large_string()) if not pa.types.is_large_string(col.type) else col
        n = len(col)
        if not n:
            return
        offsets = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + n + 1]
        data = np.frombuffer(col.buffers()[2], np.uint8) if col.buffers()[2] else np.empty(0, np.uint8)
        valid = np.ones(n, bool) if not col.null_count else ~np.asarray(col.is_null())
        i = 0
        while i < n:
            j = i + 1
            while j < n and offsets[j + 1] - offsets[i] <= HASH_CHUNK:
                j += 1
            if j == i + 1:
                yield self.hashes(data[offsets[i] : offsets[j]]) if valid[i] else None
            else:
                got, at = self._chunk(data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
                for k in range(i, j):
                    yield got[at[k - i] : at[k - i + 1]] if valid[k] else None
            i = j


_LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def spaced_words() -> Words:
    """Lower-cased A-Z; words are runs of bytes other than x20 and x09-x0D."""
    wordy = np.ones(256, bool)
    wordy[[32, *range(9, 14)]] = False
    return Words(_LOWER, wordy)


def alnum_words() -> Words:
    """Lower-cased A-Z; words are runs of 0-9, a-z and anything beyond ASCII."""
    wordy = np.zeros(256, bool)
    wordy[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
    return Words(_LOWER, wordy)


def shingle_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hashes of every run of ``k`` words; of the whole sequence if it is shorter."""
    if not len(words):
        return words
    k = min(k, len(words))
    n = len(words) - k + 1
    x = np.full(n, np.uint64(k), np.uint64)
    for i in range(k):
        x = mix(x * np.uint64(0x9E3779B97F4A7C15) + words[i : i + n])
    return x
