"""Exact n-gram Jaccard self-join with set-relation skipping.

Sets are the distinct k-word shingles of whole texts, as 64-bit hashes.  The
join follows the prefix-filter family with the two relations of Wang et al.
(2017): index lists are cut into blocks that whole-block bounds can skip, and
the answers of a set are derived from those of a highly similar set.

1. One pass counts every shingle into a table of fixed size (`SKETCH`), which
   gives the global order "rarest first".  Counts go to 4 * 10^9; the order is
   sent out by their logarithm, so that frequent shingles stay apart however many
   there are.
2. One pass writes for each document its size, set id and prefix: the
   `n - ceil(t n) + 1` first shingles in that order.  Equal sets share an id and
   are one entry from here on, so exact copies cost nothing more.
3. Prefix shingles held by one set only are dropped.  In each other index list
   one set is the pivot: that with the fewest rarer shingles, which in a group of
   variants is the one that the others vary, so that lists of one group tend to
   have the same one.  Every set of the list
   is paired with the pivot unless size or position bounds exclude the pair;
   fixed-size signatures drop pairs that differ too much for sure, and the rest
   are verified on the full sets.
4. Verified links give components.  A pair inside one component derives its
   answer (same component) from the answers already computed and is skipped.
   Only pairs across components remain: lists are cut into blocks by size, a
   block joins itself and the next one.  An entry's position bounds the size of its
   partners, so that blocks beyond are skipped whole; the bounds of the pair cut
   the rest.  Survivors are verified too, and the links of both steps give the result.

No step of the components emits the pairs of a group: step 3 is linear in the lists, step 4
leaves out what is already connected.

Defined results: null, empty or word-less texts have an empty set and stay
alone; texts of fewer than k words are one shingle; repeated rows and equal
texts share a component; a null id keeps its row and never names a component
(the component of rows with null ids only is null).  Extra columns are ignored.
Hash equality stands for shingle equality; for 10^9 distinct sets the chance
that any two share an id is about 3 %.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared

#: Counters of the shingle-frequency table: fixed size, 4 bytes each, 2 as they are sent out.
SKETCH = 1 << 21
MOST_COUNT, OCTAVE = (1 << 32) - 1, 2047
#: Pieces in which the counters are merged, and groups of tasks merged first.
PIECES, FAN_IN = 64, 64
#: Bits of a set's parity signature: each shingle flips one, so two signatures
#: differ in no more bits than the sets differ in shingles.
SIGNATURE = 1024
#: Longer index lists are joined in so many cuts of this many sets when links are counted.
LIST = 256


def _sets(col: pa.Array, k: int) -> Iterator[np.ndarray]:
    for words in shared.spaced_words().column(col):
        yield np.empty(0, np.uint64) if words is None else np.unique(shared.shingle_hashes(words, k))


def set_id(hashes: np.ndarray) -> int:
    """A signed 64-bit id of a sorted set of hashes."""
    with np.errstate(over="ignore"):
        x = shared.mix(hashes + np.uint64(0x2545F4914F6CDD1D)).sum(dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(len(hashes))
    return int(shared.mix(np.array([x], np.uint64)).view(np.int64)[0])


def signature(hashes: np.ndarray) -> np.ndarray:
    """Parities of the set's shingles over `SIGNATURE` cells, as 64-bit words."""
    odd = np.bincount((hashes >> np.uint64(64 - 10)).astype(np.int64), minlength=SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _small(counts: np.ndarray) -> bytes:
    """Counts in two bytes each where that is enough, else in four."""
    return counts.astype("<u2" if counts.max() < 1 << 16 else "<u4").tobytes()


def _counts(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, "<u2" if len(raw) == SKETCH // PIECES * 2 else "<u4").astype(np.int64)


def shingle_counts(docs: DataFrame, text_col: str, k: int) -> np.ndarray:
    """A rank for each counter, higher for shingles that more documents hold: a table of fixed size."""

    def count(batches):
        table = np.zeros(SKETCH, np.int64)
        for batch in batches:
            held = [s & np.uint64(SKETCH - 1) for s in _sets(batch.column(0), k)]
            if held:
                table += np.bincount(np.concatenate(held).astype(np.int64), minlength=SKETCH)
        parts = np.minimum(table, MOST_COUNT).reshape(PIECES, -1)
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() % FAN_IN
        yield pa.RecordBatch.from_pydict(
            {"piece": pa.array(range(PIECES), pa.int32()), "fan": pa.array([at] * PIECES, pa.int32()), "n": pa.array(map(_small, parts), pa.binary())}
        )

    def merge(batches):
        """Sums runs of equal (piece, fan); one piece is held at a time."""
        at, total = None, None

        def row():
            return pa.RecordBatch.from_pydict({"piece": pa.array([at[0]], pa.int32()), "fan": pa.array([at[1]], pa.int32()), "n": pa.array([_small(np.minimum(total, MOST_COUNT))], pa.binary())})

        for batch in batches:
            for piece, fan, n in zip(*batch.columns, strict=True):
                key, x = (piece.as_py(), fan.as_py()), _counts(n.as_py())
                if key != at:
                    if at is not None:
                        yield row()
                    at, total = key, x
                else:
                    total = total + x
        if at is not None:
            yield row()

    shape = "piece int, fan int, n binary"
    parts = docs.select(text_col).mapInArrow(count, shape).repartition("piece", "fan").sortWithinPartitions("piece", "fan").mapInArrow(merge, shape)
    parts = parts.withColumn("fan", F.lit(0)).repartition("piece").sortWithinPartitions("piece").mapInArrow(merge, shape)  # at most FAN_IN rows a piece
    table = np.zeros((PIECES, SKETCH // PIECES), np.int64)
    for row in parts.toLocalIterator():
        table[row.piece] += _counts(row.n)
    return (np.log2(np.minimum(table, MOST_COUNT) + 1.0) * OCTAVE).astype(np.uint16).reshape(-1)


def prefixes(docs: DataFrame, id_col: str, text_col: str, k: int, threshold: float, counts: np.ndarray) -> DataFrame:
    """(doc_id, n_shingles, sid, prefix, signature): the necessary prefix in the order rarest first."""
    table = docs.sparkSession.sparkContext.broadcast(counts)  # SKETCH * 2 bytes, whatever the input

    def shape(batches):
        for batch in batches:
            n, sid, prefix, lengths, signs = [], [], [], [0], []
            for s in _sets(batch.column(1), k):
                n.append(len(s))
                sid.append(set_id(s) if len(s) else None)
                signs.append(signature(s))
                if len(s):
                    keep = len(s) - required_size(threshold, len(s)) + 1
                    often = table.value[(s & np.uint64(SKETCH - 1)).astype(np.int64)]
                    prefix.append(s[np.lexsort((s, often))[:keep]].view(np.int64))
                lengths.append(lengths[-1] + (len(prefix[-1]) if len(s) else 0))
            flat = pa.array(np.concatenate(prefix) if prefix else np.empty(0, np.int64), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n, pa.int64()), pa.array(sid, pa.int64()), pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), flat), pa.array(signs, pa.list_(pa.int64()))],
                names=["doc_id", "n_shingles", "sid", "prefix", "signature"],
            )

    id_type = docs.schema[id_col].dataType
    out = T.StructType([T.StructField("doc_id", id_type), T.StructField("n_shingles", T.LongType()), T.StructField("sid", T.LongType()), T.StructField("prefix", T.ArrayType(T.LongType())), T.StructField("signature", T.ArrayType(T.LongType()))])
    return docs.select(id_col, text_col).mapInArrow(shape, out)


def required_size(threshold: float, n: int) -> int:
    """Least size of a set that can reach the threshold with one of n elements."""
    return -(-round(threshold * 1000) * n // 1000)


def _need(p: int, n, m):
    """Least intersection of sets of n and m elements that reach p thousandths."""
    return F.ceil((F.lit(p) * (n + m)) / F.lit(1000 + p))


def _full_sets(docs: DataFrame, text_col: str, k: int, nodes: DataFrame) -> DataFrame:
    """(sid, items) for the set ids of ``nodes``.

    Sets are made again from the texts, for ids in a bit filter of ``nodes`` only,
    sized by their number, so sets nobody asks for hardly ever reach a shuffle."""
    table = docs.sparkSession.sparkContext.broadcast(shared.bit_filter(nodes, "sid", shared.filter_bits(nodes.count())))

    def asked(batches):
        for batch in batches:
            sids, sets, lengths = [], [], [0]
            for s in _sets(batch.column(0), k):
                sid = set_id(s) if len(s) else None
                if sid is not None and shared.in_filter(table.value, np.array([sid])).item():
                    sids.append(sid)
                    sets.append(s.view(np.int64))
                    lengths.append(lengths[-1] + len(s))
            yield pa.RecordBatch.from_arrays(
                [pa.array(sids, pa.int64()), pa.ListArray.from_arrays(pa.array(lengths, pa.int32()), pa.array(np.concatenate(sets) if sets else np.empty(0, np.int64), pa.int64()))], names=["sid", "items"]
            )

    full = docs.select(text_col).mapInArrow(asked, "sid long, items array<long>").groupBy("sid").agg(F.any_value("items").alias("items"))
    return shared.durable(full, "sets")


def _verified(docs: DataFrame, text_col: str, k: int, threshold: float, signs: DataFrame, pairs: DataFrame, differences: bool = False) -> DataFrame:
    """The candidate ``pairs`` (a, b) of set ids whose full sets reach the threshold,
    if asked with the shingles that only one of them has.

    Signatures drop pairs that differ in too many shingles for sure; full sets
    are made for what is left."""
    p = round(threshold * 1000)
    signed = pairs.join(signs.select(F.col("sid").alias("a"), F.col("n").alias("an"), F.col("signature").alias("ax")), "a")
    signed = signed.join(signs.select(F.col("sid").alias("b"), F.col("n").alias("bn"), F.col("signature").alias("bx")), "b")
    apart = F.aggregate(F.zip_with("ax", "bx", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda a, x: a + x)
    both_sizes = F.col("an") + F.col("bn")
    pairs = shared.durable(signed.where(apart <= both_sizes - 2 * _need(p, F.col("an"), F.col("bn"))).select("a", "b"), "pairs")
    shown = ["a", "b", *[F.array_union(F.array_except("x", "y"), F.array_except("y", "x")).alias("diff")] * differences]
    if pairs.isEmpty():
        return pairs.select("a", "b", *[F.array().cast("array<long>").alias("diff")] * differences)
    full = _full_sets(docs, text_col, k, pairs.select(F.col("a").alias("sid")).union(pairs.select("b")))
    both = pairs.join(full.withColumnsRenamed({"sid": "a", "items": "x"}), "a").join(full.withColumnsRenamed({"sid": "b", "items": "y"}), "b")
    same = F.size(F.array_intersect("x", "y")).cast("long")
    found = both.select(*shown, (F.size("x") + F.size("y")).alias("all"), same.alias("same")).where(F.lit(1000) * F.col("same") >= F.lit(p) * (F.col("all") - F.col("same")))
    return found.drop("all", "same")


def _fits(p: int, n, pos, m, pos2):
    """Size and position bounds of two sets that share a token at these places."""
    return (F.least(n, m) * 1000 >= F.greatest(n, m) * p) & (1 + F.least(n - pos - 1, m - pos2 - 1) >= _need(p, n, m))


def _width(p: int) -> float:
    return 1.000001 * math.log(1000 / p)  # a shade wide, for rounding


def _block(p: int):
    return F.floor(F.log(F.col("n").cast("double")) / F.lit(_width(p))).cast("int")


def _reached(p: int):
    """The size blocks in which an entry can have a partner of its own size or more:
    from its position on, so many shingles are left for the pair to share."""
    left = (F.col("n") - F.col("pos")) * F.lit(1000 + p)
    most = ((left - F.pmod(left, F.lit(p))) / F.lit(p)).cast("long") - F.col("n")
    following = F.exp((F.col("block") + 1) * F.lit(_width(p))) * F.lit(1 - 1e-9) <= most
    return F.when(most < F.col("n"), F.array().cast("array<int>")).when(following, F.array(F.col("block"), F.col("block") + 1)).otherwise(F.array("block"))


def _indexed(docs: DataFrame, id_col: str, text_col: str, k: int, threshold: float) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The rows with their prefixes, the signature of each set, and the index lists with their pivots."""
    base = shared.durable(prefixes(docs, id_col, text_col, k, threshold, shingle_counts(docs, text_col, k)), "prefixes")

    # each set once; the prefixes are read for the lists only, the signatures for candidates only
    sets = base.where("sid is not null").groupBy("sid")
    signs = sets.agg(F.any_value("n_shingles").alias("n"), F.any_value("signature").alias("signature"))
    entries = sets.agg(F.any_value("n_shingles").alias("n"), F.any_value("prefix").alias("prefix")).select("sid", "n", F.posexplode("prefix").alias("pos", "token"))
    own = F.struct(F.col("pos").alias("pp"), F.col("sid").alias("pivot"), F.col("n").alias("pn"))  # a set id is a hash: ties fall at random
    lists = entries.groupBy("token").agg(F.count(F.lit(1)).alias("c"), F.min(own).alias("pivot")).where("c > 1").select("token", "pivot.*")
    return base, signs, shared.durable(entries.join(lists, "token"), "lists")


def _starred(shown: DataFrame, p: int) -> DataFrame:
    """Every set of a list with the list's pivot."""
    c = F.col
    return shown.where((c("sid") != c("pivot")) & _fits(p, c("n"), c("pos"), c("pn"), c("pp"))).select(F.greatest("sid", "pivot").alias("a"), F.least("sid", "pivot").alias("b")).distinct()


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, n_links (the other rows of
    similarity >= threshold, rows with an equal set included; exact).

    Every pair of a list is answered once.  Sets whose difference to the list's
    pivot is known derive their answer from it: the sum of the two differences
    bounds theirs, and where that is not enough, what the two differences share
    makes it exact.  Only pairs without such a pivot are verified on full sets.
    Unlike the components this lists the pairs of a group."""
    shared.text_session(docs.sparkSession)
    p, c = round(threshold * 1000), F.col
    base, signs, shown = _indexed(docs, id_col, text_col, k, threshold)
    starred = shared.durable(_starred(shown, p), "starred")
    links = shared.durable(_verified(docs, text_col, k, threshold, signs, starred, differences=True), "links")
    near = shared.durable(links.select(c("a").alias("sid"), c("b").alias("pivot"), "diff").unionByName(links.select(c("b").alias("sid"), c("a").alias("pivot"), "diff")), "near")

    known = near.select("sid", "pivot", F.size("diff").cast("long").alias("d"))
    long = shown.groupBy("token").agg(F.count(F.lit(1)).alias("c")).where(c("c") > LIST).select("token", F.ceil(c("c") / LIST).cast("int").alias("cuts"))
    rows = shown.where("sid <> pivot").join(known, ["sid", "pivot"], "left").join(long, "token", "left")
    rows = shared.durable(rows.select("token", "sid", "n", "pos", "pivot", "d", F.coalesce("cuts", F.lit(1)).alias("cuts"), _block(p).alias("block")), "open")
    left = rows.withColumns({"cut": F.pmod("sid", "cuts").cast("int"), "block": F.explode(_reached(p))})
    right = rows.select("token", "block", c("sid").alias("sid2"), c("n").alias("n2"), c("pos").alias("pos2"), c("d").alias("d2"), "cuts")
    right = right.withColumn("cut", F.explode(F.sequence(F.lit(0), c("cuts") - 1))).drop("cuts")
    pairs = left.join(right, ["token", "block", "cut"]).where(((c("n2") > c("n")) | ((c("n2") == c("n")) & (c("sid") < c("sid2")))) & _fits(p, c("n"), c("pos"), c("n2"), c("pos2")))
    apart = c("d") + c("d2")
    pairs = pairs.groupBy(F.greatest("sid", "sid2").alias("a"), F.least("sid", "sid2").alias("b"), (c("n") + c("n2") - 2 * _need(p, c("n"), c("n2"))).alias("most")).agg(F.min(apart).alias("apart"), F.min(F.when(apart.isNotNull(), c("pivot"))).alias("pivot"))
    pairs = shared.durable(pairs.join(starred, ["a", "b"], "left_anti"), "candidates")
    sure = pairs.where("apart <= most").select("a", "b")
    unsure = pairs.where("apart > most").join(near.withColumnsRenamed({"sid": "a", "diff": "x"}), ["a", "pivot"]).join(near.withColumnsRenamed({"sid": "b", "diff": "y"}), ["b", "pivot"])
    derived = unsure.where(F.size("x") + F.size("y") - 2 * F.size(F.array_intersect("x", "y")) <= c("most")).select("a", "b")
    verified = _verified(docs, text_col, k, threshold, signs, pairs.where("apart is null").select("a", "b"))
    links = links.select("a", "b").unionByName(sure).unionByName(derived).unionByName(verified)

    held = shared.durable(base.where("sid is not null").groupBy("sid").agg(F.count(F.lit(1)).alias("rows")), "held")
    ends = links.unionByName(links.select(c("b").alias("a"), c("a").alias("b")))
    others = ends.join(held.withColumnRenamed("sid", "b"), "b").groupBy(c("a").alias("sid")).agg(F.sum("rows").alias("others"))
    counted = held.join(others, "sid", "left").select("sid", (c("rows") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return base.select("doc_id", "n_shingles", "sid").join(counted, "sid", "left").select("doc_id", "n_shingles", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"))


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: float = 0.8) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id (smallest id
    reachable by links of similarity >= threshold, the row's own included)."""
    shared.text_session(docs.sparkSession)
    p = round(threshold * 1000)
    base, signs, shown = _indexed(docs, id_col, text_col, k, threshold)
    c = F.col
    starred = _starred(shown, p)
    links = shared.durable(_verified(docs, text_col, k, threshold, signs, starred), "links")
    first = shared.durable(shared.components(links, "stars"), "components")

    labelled = shown.select("token", "sid", "n", "pos").join(first.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    open_lists = labelled.groupBy("token").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("token")
    labelled = shared.durable(labelled.join(open_lists, "token").withColumn("block", _block(p)), "open")
    right = labelled.select("token", "block", c("sid").alias("sid2"), c("n").alias("n2"), c("pos").alias("pos2"), c("root").alias("root2"))
    across = labelled.withColumn("block", F.explode(_reached(p))).join(right, ["token", "block"]).where((c("root") != c("root2")) & ((c("n2") > c("n")) | ((c("n2") == c("n")) & (c("sid") < c("sid2")))) & _fits(p, c("n"), c("pos"), c("n2"), c("pos2")))
    across = across.select(F.greatest("sid", "sid2").alias("a"), F.least("sid", "sid2").alias("b")).distinct()
    late = _verified(docs, text_col, k, threshold, signs, across)
    everything = first.select(c("node").alias("a"), c("root").alias("b")).unionByName(late)
    final = shared.components(everything, "stars")

    smallest = base.where("sid is not null").groupBy("sid").agg(F.min("doc_id").alias("own"))
    smallest = smallest.join(final.withColumnRenamed("node", "sid"), "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    smallest = shared.durable(smallest, "smallest")
    # written first, so that the join below has an exchange of its own that splits a large component
    groups = shared.durable(smallest.groupBy("root").agg(F.min("own").alias("component_id")), "groups")
    named = smallest.select("sid", "root").join(groups, "root").select("sid", "component_id")
    out = base.select("doc_id", "n_shingles", "sid").join(named, "sid", "left")
    alone = F.when(c("sid").isNull(), c("doc_id")).otherwise(c("component_id"))
    return out.select("doc_id", "n_shingles", alone.alias("component_id"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, threshold: float = 0.8) -> DataFrame:
    """The rows of ``docs`` that name their own component, repeated rows once;
    rows without an id or without words are all kept."""
    found = shared.durable(jaccard_components(docs, id_col, text_col, k, threshold).where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull()), "found")
    ids = found.groupBy(F.col("doc_id").alias(id_col)).agg(F.bool_and(F.col("doc_id") != F.col("component_id")).alias("gone"), F.count(F.lit(1)).alias("n"))
    kept = docs.join(ids.where("gone").select(id_col), id_col, "left_anti")
    repeated = ids.where("not gone and n > 1").select(id_col)
    if repeated.isEmpty():
        return kept
    return kept.join(repeated, id_col, "left_anti").unionByName(kept.join(repeated, id_col, "left_semi").dropDuplicates([id_col, text_col]))
