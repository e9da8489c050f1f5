"""Toxicity by a weighted lexicon, matched with Aho-Corasick after folding.

Folding: case, accents and compatibility forms, letters of other scripts that
look Latin, and digits or signs that stand for letters inside a word; whatever
is no letter then becomes one space.  Terms are whole words or word beginnings,
learned with their weights (log odds of documents with label 1 against 0) from
labelled rows outside the held-out fold, at most about ``TRAIN_ROWS`` of them (a
hash of the id decides; what is learned is bounded by these rows' words).  A term
has to pass a significance test, so that rare words of single documents stay
out, and of terms that begin alike the most telling one is kept.

A text's weight is the sum over matches, less matches covered by an exception
phrase (given by the caller, or learned: a term with the word before or after it
that clean documents hold and toxic ones never do), divided by a root of the
length in words.  A logistic curve fitted on the same rows turns weights into
scores.

Defined results: null, empty and letterless texts have weight 0 and the score of
weight 0; without labels of both kinds nothing is learned and every score is 0.
Rows with null ids teach nothing and are not held out.  Several labels of one id
count as the largest.  Repeated rows are scored each for themselves; extra
columns are ignored; whole texts are scored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from dataclasses import dataclass, field
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared

TRAIN_ROWS = 20_000
#: Clean rows that a learned exception phrase needs.
SPARED = 5
STEM = range(4, 9)
LENGTH_POWER = 0.25
CUT = 0.3
#: Copies in the training rows, by the least hash of their runs of so many words, count once.
SHINGLE = 5

#: Letters of other scripts by the Latin letter that they look like.
LOOKALIKES = {
    "a": "аαɑ", "b": "ЬвΒ", "c": "сϲ", "d": "ԁ", "e": "еεҽ", "g": "ɡց", "h": "һнΗ", "i": "іιıΙ", "j": "јʝ", "k": "кκΚ",
    "l": "ӏⅼ", "m": "мΜ", "n": "ոηΝ", "o": "оοσօ", "p": "рρ", "q": "ԛ", "r": "гᴦ", "s": "ѕꜱ", "t": "тτΤ", "u": "υսц",
    "v": "ѵν", "w": "ԝω", "x": "хχ", "y": "уγү", "z": "ᴢΖ",
}
#: Digits and signs by the letter that they stand for.
STANDINS = str.maketrans("0134578@$", "oieastbas")

_FOLD: list[dict[int, str]] = []
_FOLD_CODES: list[np.ndarray] = []
_WITH_DIGIT = re.compile(r"[^\W_]*[0134578][^\W_]*")
_SIGN = re.compile(r"[@$](?=[^\W\d_])")
_GAP = re.compile(r"[\W\d_]+")


def _fold_table() -> dict[int, str]:
    if not _FOLD:
        table = {ord(c): latin for latin, alike in LOOKALIKES.items() for c in alike.lower()}
        for cp in (*range(0xC0, 0x250), *range(0x1E00, 0x1F00), *range(0x2100, 0x2150), *range(0xFF21, 0xFF5B), *range(0x1D400, 0x1D800)):
            base = "".join(c for c in unicodedata.normalize("NFKD", chr(cp)) if not unicodedata.combining(c)).lower()
            if base != chr(cp) and base.isascii() and base.isalpha():
                table.setdefault(cp, base)
        for cp in (*range(0x300, 0x370), 0xAD, *range(0x200B, 0x2010), 0x2060, 0xFEFF):
            table[cp] = ""
        _FOLD.append(table)
    return _FOLD[0]


_ODD = 0xFFFF_FFFF
_LEFT = re.compile(r"[0-9@$]+")


def _fold_codes() -> np.ndarray:
    """Code point -> the folded one, a space for what is no letter, ASCII digits and
    the signs that may stand for letters as they are, `_ODD` for what needs the longer way."""
    if not _FOLD_CODES:
        table, folded = np.full(0x110000, 32, np.uint32), _fold_table()
        for cp in range(0x110000):
            c = chr(cp)
            low = c.lower()
            one = low.translate(folded).lower() if cp >= 128 else low
            if len(low) != 1 or len(one) != 1 or c == "Σ" or cp >= 128 and one.isdecimal():  # a sigma's small form depends on its place
                table[cp] = _ODD
            elif one.isascii() and one.isdigit() or one in "@$" or not _GAP.match(one):
                table[cp] = ord(one)
        _FOLD_CODES.append(table)
    return _FOLD_CODES[0]


def fold(text: str) -> str:
    """The words of a text, folded, with one space before, between and after them."""
    codes = _fold_codes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")]
    if (codes == _ODD).any():
        text = text.lower()
        if not text.isascii():
            text = text.translate(_fold_table()).lower()
        odd = True
    else:
        text, odd = codes.astype("<u4").tobytes().decode("utf-32-le", "surrogatepass"), False
    if any(d in text for d in "0134578") and _WITH_DIGIT.search(text):
        text = _WITH_DIGIT.sub(lambda m: m[0].translate(STANDINS) if not m[0].isdigit() else m[0], text)
    if "@" in text or "$" in text:
        text = _SIGN.sub(lambda m: m[0].translate(STANDINS), text)
    if odd:
        return f" {_GAP.sub(' ', text).strip()} "
    return f" {' '.join(x for x in _LEFT.sub(' ', text).split(' ') if x)} "


@dataclass
class Lexicon:
    """``terms``: folded text with a leading space (and a closing one for whole words) -> weight."""

    terms: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = ()
    slope: float = 0.0
    offset: float = -1e9

    def machine(self):
        import ahocorasick

        found = ahocorasick.Automaton()
        for term, weight in self.terms.items():
            found.add_word(term, (len(term), weight))
        for phrase in self.exceptions:
            found.add_word(phrase, (len(phrase), None))
        if len(found):
            found.make_automaton()
        return found

    def weight(self, machine, text: str | None) -> float:
        """The text's weight: matches outside exception phrases over the rooted length."""
        if not text or not len(machine):
            return 0.0
        folded = fold(text)
        spans, free = [], []
        for end, (length, weight) in machine.iter(folded):
            if weight is None:
                free.append((end - length + 1, end))
            else:
                spans.append((end - length + 1, end, weight))
        if not spans:
            return 0.0
        if free:
            free.sort()
            starts = [a for a, _ in free]
            reach = list(accumulate((b for _, b in free), max))  # how far phrases that begin up to here go
            spans = [s for s in spans if not (i := bisect_right(starts, s[0])) or reach[i - 1] < s[1]]
        return sum(w for *_, w in spans) / max(1, folded.count(" ") - 1) ** LENGTH_POWER

    def score(self, weight: float) -> float:
        if not self.terms:
            return 0.0
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, self.offset + self.slope * weight))))


def _training(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, rows: int) -> DataFrame:
    """(text, label) of a bounded number of labelled rows."""
    known = labels.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & (shared.fold_of(id_col) != 2)).groupBy(id_col).agg(F.max(label_col).cast("int").alias("label"))
    n = known.count()
    parts = 1 << 20
    known = known.where(F.pmod(F.xxhash64(id_col), F.lit(parts)) < -(-parts * rows // max(n, rows)))  # about ``rows`` rows
    texts = docs.select(id_col, text_col).where(F.col(text_col).isNotNull()).join(F.broadcast(known), id_col).select(F.col(text_col).alias("text"), "label")

    def kind(batches):
        split = shared.spaced_words()
        for batch in batches:
            least = [int(shared.shingle_hashes(w, SHINGLE).min().view(np.int64)) if len(w) else 0 for w in split.column(batch.column(0))]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(least, pa.int64())], names=["text", "label", "kind"])

    # copies of one text would make its rare words look telling
    return texts.mapInArrow(kind, "text string, label int, kind long").dropDuplicates(["kind", "label"]).select("text", "label")


def _features(text: str) -> set[str]:
    found = set()
    for w in set(fold(text).split()):
        found.add(f" {w} ")
        found.update(f" {w[:n]}" for n in STEM if len(w) >= n)
    return found


def learn(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", rows: int = TRAIN_ROWS, exceptions: tuple[str, ...] = ()) -> Lexicon:
    """A lexicon from labelled rows outside the held-out fold, about ``rows`` of them."""
    shared.text_session(docs.sparkSession)
    taught = shared.durable(_training(docs, labels, id_col, text_col, label_col, rows), "labelled")
    kinds = {r.label: r["count"] for r in taught.groupBy("label").count().collect()}
    toxic, clean = kinds.get(1, 0), kinds.get(0, 0)
    if not toxic or not clean:
        return Lexicon()

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for f in _features(text):
                    seen[f, label] += 1
                if len(seen) > 100_000:
                    yield flush(seen)
                    seen = Counter()
        yield flush(seen)

    def flush(seen):
        return pa.RecordBatch.from_arrays([pa.array([f for f, _ in seen], pa.string()), pa.array([n if k == 1 else 0 for (_, k), n in seen.items()], pa.int64()), pa.array([n if k != 1 else 0 for (_, k), n in seen.items()], pa.int64())], names=["term", "t", "c"])

    counted = taught.mapInArrow(count, "term string, t long, c long").groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    p = toxic / (toxic + clean)
    terms = shared.durable(counted.where((F.col("t") >= 3) & (F.col("t") * (1 - p) > 4 * p * F.col("c"))), "terms")
    # an expected number of chance finds far below one among the terms tested
    bar = 2 * math.log(max(10, terms.count())) + 12
    p_term = (F.col("t") + F.col("c")) * p
    telling = F.col("t") * F.log(F.col("t") / p_term) + F.coalesce(F.col("c") * F.log(F.nullif(F.col("c"), F.lit(0)) / ((F.col("t") + F.col("c")) * (1 - p))), F.lit(0.0))
    got = terms.withColumn("g", F.round(2 * telling, 9)).where(F.col("g") >= bar).toPandas()  # terms of the bounded rows that pass the test
    got["n"] = got.term.str.len()
    chosen: dict[str, float] = {}
    stems: set[str] = set()
    begun: set[str] = set()  # beginnings of chosen stems
    for r in got.sort_values(["g", "n", "term"], ascending=[False, False, True]).itertuples():
        stem = r.term.rstrip(" ")
        if stem not in begun and not any(stem[:i] in stems for i in range(2, len(stem) + 1)):
            chosen[r.term] = math.log((r.t + 0.5) / (toxic + 1)) - math.log((r.c + 0.5) / (clean + 1))
            stems.add(stem)
            begun.update(stem[:i] for i in range(2, len(stem) + 1))
    lexicon = Lexicon(chosen, tuple(sorted(fold(x) for x in exceptions)))
    if not chosen:
        return lexicon

    def contexts(batches):
        machine, seen = lexicon.machine(), Counter()
        for batch in batches:
            for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                folded, around = fold(text), set()
                for end, (length, weight) in machine.iter(folded):
                    if weight is None:
                        continue
                    start = end - length + 1
                    close = folded.index(" ", end)
                    before = folded.rfind(" ", 0, start)
                    after = folded.find(" ", close + 1)
                    if before >= 0:
                        around.add(folded[before : close + 1])
                    if after >= 0:
                        around.add(folded[start : after + 1])
                for a in around:
                    seen[a, label] += 1
        yield flush(seen)

    around = taught.mapInArrow(contexts, "term string, t long, c long").groupBy("term").agg(F.sum("t").alias("t"), F.sum("c").alias("c"))
    spared = around.where((F.col("t") == 0) & (F.col("c") >= SPARED))
    lexicon.exceptions = tuple(sorted({*lexicon.exceptions, *(r.term for r in spared.collect())}))

    def weigh(batches):
        machine = lexicon.machine()
        for batch in batches:
            w = [round(lexicon.weight(machine, x), 2) for x in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(w, pa.float64()), batch.column(1)], names=["weight", "label"])

    weights = taught.mapInArrow(weigh, "weight double, label int").groupBy("weight", "label").count().toPandas()
    lexicon.slope, lexicon.offset = _logistic(weights["weight"].to_numpy(), (weights["label"] == 1).to_numpy(float), weights["count"].to_numpy(float))
    return lexicon


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray) -> tuple[float, float]:
    """Slope and offset by damped Newton steps, with a small ridge on the slope."""
    a = b = 0.0
    for _ in range(60):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -50, 50)))
        w = n * p * (1 - p) + 1e-9
        grad = np.array([(n * (y - p) * x).sum() - 0.1 * a, (n * (y - p)).sum()])
        hess = np.array([[(w * x * x).sum() + 0.1, (w * x).sum()], [(w * x).sum(), w.sum()]])
        step = np.linalg.solve(hess, grad)
        step *= min(1.0, 4 / max(1e-9, np.abs(step).max()))
        a, b = a + step[0], b + step[1]
        if np.abs(step).max() < 1e-6:
            break
    return float(a), float(b)


def scored(docs: DataFrame, lexicon: Lexicon, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted and, if asked, the whole row as ``kept``."""
    shared.text_session(docs.sparkSession)
    more = docs.select(*[shared.kept_row(docs)] * keep)
    known = docs.sparkSession.sparkContext.broadcast(lexicon)  # bounded by the words of the rows learned from

    def score(batches):
        machine, of = known.value.machine(), known.value
        for batch in batches:
            s = pa.array([of.score(of.weight(machine, t)) for t in batch.column(2).to_pylist()], pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), s, *(batch.column(i) for i in range(3, batch.num_columns))], names=[f.name for f in shape])

    shape = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType()), *more.schema])
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(shared.fold_of(id_col) == 2, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"), *more.columns and [shared.kept_row(docs)])
    found = rows.mapInArrow(score, shape)
    return found.select("doc_id", "held_out", "score", F.when(F.col("score") >= CUT, 1).otherwise(0).alias("predicted"), *more.columns)
