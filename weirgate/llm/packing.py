"""Packing of tokenised documents into fixed-length sequences by a grouping
genetic algorithm on distributed islands.

A document is its byte-level BPE ids and an end id.  Documents of more than
``capacity`` ids are cut into pieces of ``capacity``, the first of which may be
shorter.  Full pieces are sequences of their own.  The others are dealt to blocks of
bounded size, and several islands evolve packings of each block (Falkenauer's
grouping algorithm): crossover injects whole well-filled bins of one parent into
another, removes the bins that hold duplicates of injected pieces, and best-fits
the displaced pieces, longest first, singly and in pairs.  Parents win tournaments; packings count by their bins, then by
how unevenly these are filled.  After some generations each island sends copies of
its elite, its best packings, to the next island, which takes them into its
population; the best packing of all islands stands for the block.  Bins with at most
`SETTLED_FREE` free ids settle; what the others hold is dealt once more, bin by bin,
to new blocks, whose islands start from these bins, and then every bin settles.

An island stops early once it needs no more bins than its pieces need at least:
their ids over the capacity, or those too long to share a bin.

Defined results: a null text is an empty one and gives the end id only; repeated
rows are packed each for themselves; a null id is kept as null; extra columns are
ignored; an empty table gives no rows.  Texts are never cut before tokenising.
"""

from __future__ import annotations

import random
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared

VOCABULARY = "byte_bpe_50k"
CAPACITY = 1024
END_ID = 2
#: Pieces per block, at most about 1.2 x this; rounds of dealing.
BLOCK, ROUNDS = 4096, 2
#: Islands of a block, packings that each keeps, generations before and after the elite travels, and its size.
ISLANDS, POPULATION, GENERATIONS, ELITE = 3, 4, 8, 2
#: A bin settles early with at most this many ids left free.
SETTLED_FREE = 8

#: Characters on whose classes both tokenising libraries agree in every Unicode version.
_PLAIN = re.compile("[^\t\n\r -~¡-ɏ]")


class Tokens:
    """Ids of texts.  Plain texts take the faster of two libraries with the same
    vocabulary; texts with other characters, or with the text of a special token,
    take ``tokenizers`` itself."""

    def __init__(self, vocabulary: str):
        import base64
        import os

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        with open(public_tokenizers.path(f"{vocabulary}.tiktoken"), "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.fast = tiktoken.Encoding("plain", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._load = lambda: Tokenizer.from_file(public_tokenizers.path(f"{vocabulary}.json"))
        self._whole = None

    @property
    def whole(self):
        """Loaded only where a text needs it."""
        if self._whole is None:
            self._whole = self._load()
        return self._whole

    def ids(self, text: str) -> np.ndarray:
        if _PLAIN.search(text) or "<|" in text:
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4")
        return np.asarray(self.fast.encode_to_numpy(text, disallowed_special=()), "<u4")


_LOADED: dict[str, Tokens] = {}


def tokens(vocabulary: str = VOCABULARY) -> Tokens:
    if vocabulary not in _LOADED:
        _LOADED[vocabulary] = Tokens(vocabulary)
    return _LOADED[vocabulary]


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids."""
    first = n % capacity or capacity
    return [(0, first), *((at, capacity) for at in range(first, n, capacity))] if n > capacity else [(0, n)]


def pieces(docs: DataFrame, id_col: str, text_col: str, capacity: int, vocabulary: str) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32) for every piece of every document."""

    def cut(batches):
        encode = tokens(vocabulary).ids
        for batch in batches:
            rows, which = [], []
            for i, text in enumerate(batch.column(1).to_pylist()):
                ids = np.append(encode(text or ""), np.uint32(END_ID)).astype("<u4")
                for k, (at, length) in enumerate(cuts(len(ids), capacity)):
                    which.append(i)
                    rows.append((k, at, length, zlib.crc32(ids[at : at + length].tobytes())))
            piece, start, length, crc = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(which, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    shape = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("piece", T.IntegerType()), *(T.StructField(c, T.LongType()) for c in ("start", "length", "ids_crc32"))])
    return docs.select(id_col, text_col).mapInArrow(cut, shape)


# ------------------------------------------------------------------ one island


class Bins:
    """A packing under construction; finds the fullest bin that takes a piece.  Lists
    of members are never changed in place, so packings share them."""

    def __init__(self, capacity: int):
        self.capacity, self.bins, self.fill = capacity, [], []
        # where bins with so many free ids are, some of them no longer
        self.by_free: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.mask = 0

    def add_bin(self, members: list[int], fill: int) -> None:
        if fill < self.capacity:
            self._file(len(self.bins), self.capacity - fill)
        self.bins.append(members)
        self.fill.append(fill)

    def _file(self, at: int, free: int) -> None:
        self.by_free[free].append(at)
        self.mask |= 1 << free

    def exchanged(self, at: int, place: int, piece: int, lengths: list[int]) -> int:
        """Puts a longer piece, which fills the bin, in the place of the one returned."""
        members = list(self.bins[at])
        old, members[place] = members[place], piece
        self.bins[at] = members
        self.fill[at] += lengths[piece] - lengths[old]
        return old

    def best_fit(self, piece: int, length: int) -> None:
        while fits := self.mask >> length:
            free = length + (fits & -fits).bit_length() - 1
            at = self.by_free[free].pop()
            if not self.by_free[free]:
                self.mask &= ~(1 << free)
            if self.capacity - self.fill[at] == free:
                self.bins[at] = [*self.bins[at], piece]
                self.fill[at] += length
                if free > length:
                    self._file(at, free - length)
                return
        self.add_bin([piece], length)


def fitness(packing: Bins) -> tuple[int, float]:
    """Fewer bins, then Falkenauer's measure: full bins count more than the same ids spread evenly."""
    return -len(packing.bins), sum((f / packing.capacity) ** 2 for f in packing.fill) / max(1, len(packing.fill))


def placed(child: Bins, loose: list[int], lengths: list[int]) -> None:
    """Best-fits loose pieces.  Each is first offered to a bin that it fills in
    exchange for a shorter piece.  Then the longest that is left takes the one or two
    pieces that fill its bin best, again and again; what stays alone goes to the
    fullest bin with room."""
    want: dict[int, list[tuple[int, int]]] = {}
    for b in sorted((b for b, f in enumerate(child.fill) if f < child.capacity), key=lambda b: child.fill[b])[: 2 * len(loose) + 8]:
        for place, p in enumerate(child.bins[b]):
            want.setdefault(lengths[p] + child.capacity - child.fill[b], []).append((b, place))
    swapped: set[int] = set()
    by_length: dict[int, list[int]] = {}
    for p in loose:
        for b, place in want.get(lengths[p], ()):
            if b not in swapped:
                swapped.add(b)
                old = child.exchanged(b, place, p, lengths)
                p = old
                break
        by_length.setdefault(lengths[p], []).append(p)
    # lengths on offer as bits, and counted from the capacity down, so that one shift and one AND find all pairs of a sum
    offer, downward = sum(1 << n for n in by_length), sum(1 << child.capacity - n for n in by_length)

    def take(n: int) -> int:
        nonlocal offer, downward
        piece = by_length[n].pop()
        if not by_length[n]:
            offer ^= 1 << n
            downward ^= 1 << child.capacity - n
        return piece

    def filling(gap: int) -> list[int]:
        """The one or two lengths that fill a gap best; one on ties."""
        fits = offer & ((2 << gap) - 1)
        if not fits:
            return []
        longest = fits.bit_length() - 1
        for total in range(gap, longest, -1):
            pairs = fits & (downward >> child.capacity - total)
            if total % 2 == 0 and pairs >> total // 2 & 1 and len(by_length[total // 2]) < 2:
                pairs ^= 1 << total // 2
            if pairs:
                one = pairs.bit_length() - 1
                return [one, total - one]
        return [longest]

    while offer:
        n = offer.bit_length() - 1
        members, fill = [take(n)], n
        while more := filling(child.capacity - fill):
            members += map(take, more)
            fill += sum(more)
        if len(members) == 1:
            child.best_fit(members[0], n)
        else:
            child.add_bin(members, fill)


def bred(keep: Bins, give: Bins | None, lengths: list[int], dice: random.Random) -> Bins:
    """A child of ``keep``: well-filled bins of ``give`` are injected, bins that hold
    duplicates of their pieces are removed, and the emptiest bins and some others are
    dissolved; all pieces that lost their bin are placed again."""
    child, loose, taken = Bins(keep.capacity), [], set()
    if give is not None:
        order = sorted(range(len(give.bins)), key=give.fill.__getitem__, reverse=True)
        good = order[: max(1, len(order) // 2)]
        for b in [b for b in good if dice.random() < 0.5] or good[:1]:
            taken.update(give.bins[b])
            child.add_bin(give.bins[b], give.fill[b])
    order = sorted(range(len(keep.bins)), key=keep.fill.__getitem__)
    gone = {*order[: 1 + len(order) // 20], *(b for b in order if dice.random() < 0.03)}
    for b, members in enumerate(keep.bins):
        if not taken.isdisjoint(members):
            loose += [p for p in members if p not in taken]
        elif b in gone:
            loose += members
        else:
            child.add_bin(members, keep.fill[b])
    placed(child, loose, lengths)
    return child


def least_bins(lengths: list[int], capacity: int) -> int:
    """No packing has fewer bins: by the ids, and by pieces too long to meet (Martello and Toth's bound)."""
    x = np.sort(np.asarray(lengths, np.int64))
    if not len(x):
        return 0
    edges = np.unique(np.concatenate([[0], x[2 * x <= capacity]]))
    sums = np.concatenate([[0], np.cumsum(x)])
    half, long = np.searchsorted(x, capacity // 2, "right"), np.searchsorted(x, capacity - edges, "right")
    middle = sums[long] - sums[half]  # longer than half, but with room for the edge
    small = sums[half] - sums[np.searchsorted(x, edges, "left")]
    more = -(-(small - ((long - half) * capacity - middle)) // capacity)
    return int((len(x) - half + np.maximum(0, more)).max())


def packed(order: list[int], lengths: list[int], capacity: int) -> Bins:
    """Best fit in this order."""
    out = Bins(capacity)
    for p in order:
        out.best_fit(p, lengths[p])
    return out


def evolve(lengths: list[int], capacity: int, seed: int, given: list[list[list[int]]] = (), elite: int = ELITE, generations: int = GENERATIONS) -> list[Bins]:
    """The best packings of an island, which starts from ``given`` ones (lists of bins)."""
    dice, least = random.Random(seed), least_bins(lengths, capacity)
    by_length = sorted(range(len(lengths)), key=lambda p: -lengths[p])
    people: list[tuple[tuple[int, float], Bins]] = []

    def join(packing: Bins) -> None:
        people.append((fitness(packing), packing))

    for bins in given:
        join(Bins(capacity))
        for members in bins:
            people[-1][1].add_bin(members, sum(lengths[p] for p in members))
        people[-1] = (fitness(people[-1][1]), people[-1][1])
    if len(people) < POPULATION:
        join(packed(by_length, lengths, capacity))
    rank = lambda x: x[0]
    if len(people) < POPULATION and -max(people, key=rank)[0][0] > least:
        alone = Bins(capacity)
        placed(alone, by_length, lengths)
        join(alone)
    while len(people) < POPULATION and -max(people, key=rank)[0][0] > least:
        join(packed(sorted(by_length, key=lambda p: -lengths[p] * (0.8 + 0.4 * dice.random())), lengths, capacity))
    for _ in range(generations):
        people = sorted(people, key=rank, reverse=True)[:POPULATION]
        if -people[0][0][0] <= least:
            break
        parents = [max(dice.sample(people, min(2, len(people))), key=rank)[1] for _ in range(2)]
        join(bred(*parents, lengths, dice))
        join(bred(people[0][1], None, lengths, dice))
    return [x for _, x in sorted(people, key=rank, reverse=True)[:elite]]


# ------------------------------------------------------------ blocks and islands

_BLOCK = "block int, uids binary, lengths binary, bins binary"


def _told(packing: Bins, n: int) -> bytes:
    """The bin of each piece."""
    out = np.empty(n, "<i4")
    for b, members in enumerate(packing.bins):
        out[members] = b
    return out.tobytes()


def _bins(told: bytes) -> list[list[int]]:
    found: dict[int, list[int]] = {}
    for p, b in enumerate(np.frombuffer(told, "<i4").tolist()):
        if b >= 0:
            found.setdefault(b, []).append(p)
    return list(found.values())


def _evolved(blocks: DataFrame, capacity: int, salt: int) -> DataFrame:
    """(block, uids, lengths, bins) with the best packing that the islands of each block find."""

    def island(first: bool):
        def grow(batches):
            for batch in batches:
                elites = []
                for block, at, lengths, given in zip(*(batch.column(c).to_pylist() for c in ("block", "island", "lengths", "given")), strict=True):
                    sizes = np.frombuffer(lengths, "<i4").tolist()
                    start = [_bins(x) for x in given]
                    if first:  # bins that came together, and the pieces that came alone in bins of their own
                        start = [[*x, *([p] for p in set(range(len(sizes))) - {p for m in x for p in m})] for x in start if x]
                    best = evolve(sizes, capacity, ((block * 31 + at) * 31 + salt) * 2 + first, start)
                    elites.append([{"fewest": len(x.bins), "even": 1 - fitness(x)[1], "bins": _told(x, len(sizes))} for x in best])
                kind = pa.list_(pa.struct([("fewest", pa.int32()), ("even", pa.float64()), ("bins", pa.binary())]))
                yield pa.RecordBatch.from_arrays([batch.column("block"), batch.column("island"), pa.array(elites, kind)], names=["block", "island", "elite"])

        return grow

    shape = "block int, island int, elite array<struct<fewest:int,even:double,bins:binary>>"
    islands = blocks.select("block", "lengths", F.array("bins").alias("given"), F.explode(F.sequence(F.lit(0), F.lit(ISLANDS - 1))).alias("island"))
    tasks = max(1, min(blocks.count(), 4096))
    one = shared.durable(islands.repartition(tasks, "block", "island").mapInArrow(island(True), shape), "islands")
    # copies of an island's elite join the population of the next one
    both = one.select("block", "island", "elite").unionByName(one.select("block", ((F.col("island") + 1) % ISLANDS).alias("island"), "elite"))
    met = both.select("block", "island", F.explode("elite").alias("e")).groupBy("block", "island").agg(F.sort_array(F.collect_set("e"))["bins"].alias("given"))  # 2 * ELITE packings
    two = met.join(blocks.select("block", "lengths"), "block").repartition(tasks, "block", "island").mapInArrow(island(False), shape)
    best = two.select("block", F.explode("elite").alias("e")).groupBy("block").agg(F.min("e")["bins"].alias("best"))
    return shared.durable(blocks.join(best, "block").select("block", "uids", "lengths", F.col("best").alias("bins")), "best")


def _round(rows: DataFrame, size: int, salt: int, capacity: int, last: bool) -> DataFrame:
    """(uid, sequence_id, offset, bin) of ``rows`` (uid, length, bin): a place for pieces whose bin settles,
    and for the others the bin in which they travel on."""
    n = max(1, round(size / BLOCK))
    together = F.coalesce(F.col("bin"), F.xxhash64("uid", F.lit(salt)))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64(together, F.lit(salt)), F.lit(n)).cast("int"))

    def gather(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table.column("uid").to_numpy(), kind="stable")))
        bins = table.column("bin").to_pylist()
        place = {b: i for i, b in enumerate(sorted({b for b in bins if b is not None}))}
        came = np.array([-1 if b is None else place[b] for b in bins], "<i4")
        return pa.table({"block": table.column("block").slice(0, 1), "uids": pa.array([table.column("uid").to_numpy().astype("<i8").tobytes()], pa.binary()), "lengths": pa.array([table.column("length").to_numpy().astype("<i4").tobytes()], pa.binary()), "bins": pa.array([came.tobytes()], pa.binary())})

    blocks = shared.durable(dealt.select("block", "uid", "length", "bin").groupBy("block").applyInArrow(gather, _BLOCK), "blocks")

    def settle(batches):
        for batch in batches:
            cols: tuple[list, ...] = ([], [], [], [])
            for block, uids, lengths, told in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, sizes = np.frombuffer(uids, "<i8").tolist(), np.frombuffer(lengths, "<i4").tolist()
                for b, members in enumerate(_bins(told)):
                    name, at = (salt << 58) | (block << 22) | b, 0
                    done = last or capacity - sum(sizes[p] for p in members) <= SETTLED_FREE
                    for p in members:
                        for c, v in zip(cols, (ids[p], name if done else None, at if done else None, None if done else name), strict=True):
                            c.append(v)
                        at += sizes[p]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["uid", "sequence_id", "offset", "bin"])

    return shared.durable(_evolved(blocks, capacity, salt).mapInArrow(settle, "uid long, sequence_id long, offset long, bin long"), "packed")


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = CAPACITY, vocabulary: str = VOCABULARY) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    shared.text_session(docs.sparkSession)
    cut = shared.durable(pieces(docs, id_col, text_col, capacity, vocabulary).withColumn("uid", F.monotonically_increasing_id()), "pieces")
    full = cut.where(F.col("length") == capacity).select("uid", (-F.col("uid") - 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    open_rows, settled = cut.where(F.col("length") < capacity).select("uid", "length", F.lit(None).cast("long").alias("bin")), full
    for salt in range(1, ROUNDS + 1):
        size = open_rows.count()
        if not size:
            break
        after = _round(open_rows, size, salt, capacity, salt == ROUNDS)
        settled = settled.unionByName(after.where("sequence_id is not null").select("uid", "sequence_id", "offset"))
        open_rows = after.where("sequence_id is null").select("uid", "bin").join(cut.select("uid", "length"), "uid").select("uid", "length", "bin")
    return cut.join(settled, "uid").select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
