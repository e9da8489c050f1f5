"""Benchmark decontamination: which words of a document lie inside an occurrence
of an item-sized window of a benchmark.

A prefix-filtered join.  Windows are the runs of ``size`` words of an item (an
item of fewer words is one window).  Each window is a set of short shingles,
ordered by rarity within the whole benchmark; for exact containment the necessary
prefix is one shingle, the rarest, so windows are joined by it alone together
with its position.  A match fixes where the window would have to start, the length
bound drops starts before the first or ends after the last word, and the rest is
verified word by word.

Windows, their shingles' counts and the choice of the rarest are made on the
executors.  Where the windows and their items number no more than `SENT`, they are
sent to every task and documents never move.  Beyond that the join is dealt by
shingle: documents send the shingles that pass a bit filter, with the words
around them, and what is found comes back by a digest of the text.  Both ways
read the documents' texts once and give the same rows.  Words are compared as
64-bit hashes; a window matches only if all its words do.

Defined results: a null text has no words; null items, and items without words
or id, have no windows; repeated items count once by id; a document without
words is not contaminated; empty tables give no hits or no rows.  Extra columns
are ignored, a null doc_id is kept.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared

SIZE = 13
#: Words of the shingles by which windows are found.
SHINGLE = 3
#: Windows, and pairs of window and item, that are sent to every task: about 13 * 8 bytes each.
SENT = 200_000
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


class WindowIndex:
    """Windows found by their rarest shingle."""

    def __init__(self, windows: list[tuple[bytes, int, int, int]], owned: list[tuple[bytes, str]]):
        """``windows``: words, words of a shingle, the rarest shingle and its place; ``owned``: words and item."""
        place = {w: i for i, (w, *_) in enumerate(windows)}
        self.windows = [np.frombuffer(w, np.uint64) for w, *_ in windows]
        self.owners: list[list[str]] = [[] for _ in windows]
        for w, item in owned:
            self.owners[place[w]].append(item)
        found: dict[int, dict[int, list[tuple[int, int]]]] = defaultdict(lambda: defaultdict(list))
        for i, (_, k, shingle, offset) in enumerate(windows):
            found[k][shingle & (1 << 64) - 1].append((i, offset))
        self.by_shingle = {k: dict(x) for k, x in found.items()}
        self.keys = {k: np.array(sorted(x), np.uint64) for k, x in self.by_shingle.items()}
        self.filter = {}
        for k, x in self.keys.items():
            self.filter[k] = np.zeros(1 << 20, bool)
            self.filter[k][(x & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def hits(self, words: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(start, length, window) of every occurrence in a document's words."""
        for k, keys in self.keys.items():
            if len(words) < k:
                continue
            s = shared.shingle_hashes(words, k)
            maybe = np.flatnonzero(self.filter[k][(s & np.uint64((1 << 20) - 1)).astype(np.int64)])
            if not len(maybe):
                continue
            at = np.searchsorted(keys, s[maybe])
            maybe = maybe[keys[np.minimum(at, len(keys) - 1)] == s[maybe]]
            for p in maybe.tolist():
                for w, offset in self.by_shingle[k][int(s[p])]:
                    window = self.windows[w]
                    start = p - offset
                    if start >= 0 and start + len(window) <= len(words) and np.array_equal(words[start : start + len(window)], window):
                        yield start, len(window), w


def _windows(benchmark: DataFrame, id_col: str, text_col: str, size: int) -> tuple[DataFrame, DataFrame]:
    """(words, k, shingle, offset) of each window, found by its rarest shingle, and (words, item) of its items."""

    def cut(batches):
        split = shared.alnum_words()
        for batch in batches:
            items, windows = [], []
            for item, words in zip(batch.column(0).to_pylist(), split.column(batch.column(1)), strict=True):
                n = min(size, len(words))
                own = {words[i : i + n].tobytes() for i in range(len(words) - n + 1)} if n else set()
                items += [item] * len(own)
                windows += own
            yield pa.RecordBatch.from_arrays([pa.array(windows, pa.binary()), pa.array(items, pa.string())], names=["words", "item"])

    def shingled(batches):
        for batch in batches:
            cols: tuple[list, ...] = ([], [], [], [])
            for raw in batch.column(0).to_pylist():
                words = np.frombuffer(raw, np.uint64)
                k = min(SHINGLE, len(words))
                for offset, shingle in enumerate(shared.shingle_hashes(words, k).view(np.int64).tolist()):
                    for c, v in zip(cols, (raw, k, shingle, offset), strict=True):
                        c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int32())], names=["words", "k", "shingle", "offset"])

    rows = benchmark.where(F.col(id_col).isNotNull() & F.col(text_col).isNotNull()).select(F.col(id_col).cast("string"), text_col)
    owned = shared.durable(rows.mapInArrow(cut, "words binary, item string").distinct(), "owned")
    each = owned.select("words").distinct().mapInArrow(shingled, "words binary, k int, shingle long, offset int")
    often = each.groupBy("k", "shingle").agg(F.count_distinct("words").alias("often"))
    first = F.min(F.struct("often", F.col("shingle").alias("s"), F.col("offset").alias("o")))
    windows = each.join(often, ["k", "shingle"]).groupBy("words", "k").agg(first.alias("f")).select("words", "k", F.col("f.s").alias("shingle"), F.col("f.o").alias("offset"))
    return shared.durable(windows, "windows"), owned


_SPAN = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
_ARROW_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def _merged(spans: list[tuple[int, int]]) -> list[dict]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [{"start": s, "end": e} for s, e in out]


def contamination(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", size: int = SIZE, keep: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, items (ids of occurring
    items, sorted as strings) and spans (merged word ranges that are hit), and,
    if asked, the whole row as ``kept``."""
    shared.text_session(docs.sparkSession)
    windows, owned = _windows(benchmark, item_col, item_text_col, size)
    way = _sent if owned.count() <= SENT else _dealt
    found, more = way(docs, windows, owned, id_col, text_col, size, keep)
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return found.select("doc_id", "n_words", hit.alias("n_hit"), "items", "spans", *more)


def _sent(docs: DataFrame, windows: DataFrame, owned: DataFrame, id_col: str, text_col: str, size: int, keep: bool) -> tuple[DataFrame, list[str]]:
    """Documents look windows up that every task holds."""
    more = docs.select(*[shared.kept_row(docs)] * keep)
    index = docs.sparkSession.sparkContext.broadcast(WindowIndex([tuple(map(_plain, r)) for r in windows.collect()], [tuple(map(_plain, r)) for r in owned.collect()]))  # at most SENT rows
    shape = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("n_words", T.LongType()), T.StructField("items", T.ArrayType(T.StringType())), T.StructField("spans", _SPAN), *more.schema])

    def look(batches):
        split = shared.alnum_words()
        for batch in batches:
            counts, items, spans = [], [], []
            for words in split.column(batch.column(1)):
                found = list(index.value.hits(words)) if words is not None else []
                counts.append(0 if words is None else len(words))
                items.append(sorted({o for _, _, w in found for o in index.value.owners[w]}))
                spans.append(_merged([(s, s + n) for s, n, _ in found]))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(spans, _ARROW_SPAN), *(batch.column(i) for i in range(2, batch.num_columns))], names=[f.name for f in shape])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), *more.columns and [shared.kept_row(docs)])
    return rows.mapInArrow(look, shape), more.columns


def _plain(value):
    return bytes(value) if isinstance(value, bytearray) else value


def _dealt(docs: DataFrame, windows: DataFrame, owned: DataFrame, id_col: str, text_col: str, size: int, keep: bool) -> tuple[DataFrame, list[str]]:
    """Documents send the shingles that may be a window's rarest, with the words
    around them, and are joined with the windows by shingle."""
    lengths = sorted({r.k for r in windows.select("k").distinct().collect()})  # at most SHINGLE values
    may = docs.sparkSession.sparkContext.broadcast(shared.bit_filter(windows, "shingle", shared.filter_bits(windows.count())))

    def sending(batches):
        split = shared.alnum_words()
        for batch in batches:
            cols: tuple[list, ...] = ([], [], [], [], [], [])
            for key, words in zip(batch.column(0).to_pylist(), split.column(batch.column(1)), strict=True):
                for k in lengths:
                    if len(words) < k:
                        continue
                    s = shared.shingle_hashes(words, k).view(np.int64)
                    for p in np.flatnonzero(shared.in_filter(may.value, s)).tolist():
                        start = max(0, p - size + 1)
                        for c, v in zip(cols, (key, k, int(s[p]), p, p - start, words[start : p + size].tobytes()), strict=True):
                            c.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.binary()), pa.array(cols[1], pa.int32()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int32()), pa.array(cols[5], pa.binary())], names=["key", "k", "shingle", "p", "before", "around"])

    key = F.unhex(F.sha2(F.col(text_col), 256))
    sent = docs.where(F.col(text_col).isNotNull()).select(key.alias("key"), text_col).mapInArrow(sending, "key binary, k int, shingle long, p long, before int, around binary")
    begin = F.col("before") - F.col("offset")
    same = (begin >= 0) & (F.col("around").substr(begin * 8 + 1, F.octet_length("words")) == F.col("words"))
    met = sent.distinct().join(windows, ["k", "shingle"]).where(same).select("key", "words", (F.col("p") - F.col("offset")).alias("start"), (F.octet_length("words") / 8).cast("long").alias("n"))
    met = shared.durable(met, "met")
    spans = met.select("key", F.struct("start", (F.col("start") + F.col("n")).alias("end")).alias("span")).groupBy("key").agg(F.collect_set("span").alias("spans"))

    def merging(batches):
        for batch in batches:
            merged = [_merged([(x["start"], x["end"]) for x in spans]) for spans in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(merged, _ARROW_SPAN)], names=["key", "spans"])

    shape = T.StructType([T.StructField("key", T.BinaryType()), T.StructField("spans", _SPAN)])
    items = met.select("key", "words").distinct().join(owned, "words").groupBy("key").agg(F.sort_array(F.collect_set("item")).alias("items"))
    found = shared.durable(spans.mapInArrow(merging, shape).join(items, "key"), "found")
    n_words = F.coalesce(F.regexp_count(F.col(text_col), F.lit(WORD)), F.lit(0)).cast("long")
    rows = docs.select(F.col(id_col).alias("doc_id"), n_words.alias("n_words"), key.alias("key"), *[shared.kept_row(docs)] * keep)
    told = rows.join(found, "key", "left").withColumns({"items": F.coalesce("items", F.array().cast("array<string>")), "spans": F.coalesce("spans", F.array().cast(_SPAN))})
    return told, ["kept"] * keep


def contaminated(n_hit="n_hit", n_words="n_words"):
    """At least a twentieth of the words are hit."""
    return (F.col(n_hit) > 0) & (20 * F.col(n_hit) >= F.col(n_words))
