"""Language identification by rank-order profiles (Cavnar and Trenkle, 1994).

A profile is the list of the ``PROFILE`` most frequent n-grams (n = 1 to 3, over
letters and word boundaries, case folded).  A document is given the language
whose profile has the least out-of-place distance to its own: the sum, over the
document's n-grams, of how far their ranks differ, an n-gram unknown to the
language counting ``PROFILE``.

Profiles are learned from at most about ``TRAIN_ROWS`` rows a language (a hash
of the id decides, by a fraction found from exact counts); every text is scored
whole.  An n-gram is up to three code points of 21 bits in one 64-bit number, so
letters of all scripts count as themselves.  Marks that combine with letters
(vowel signs, accents) belong to the word.

Defined results: ``und`` and score 0 for null texts, texts without a letter, and
if nothing was learned.  Ties go to the alphabetically first language.  Rows
with a null id teach nothing and are not held out.  Repeated rows are scored
each for themselves.  Extra columns are ignored.
"""

from __future__ import annotations

import unicodedata
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from . import shared

PROFILE = 400
TRAIN_ROWS = 4000

_LETTERS: list[np.ndarray] = []
_BITS = 21


def letters() -> np.ndarray:
    """Code point -> its small letter's code point, a mark's own with the sign reversed, 0 for all else."""
    if not _LETTERS:
        table = np.zeros(0x110000, np.int32)
        for cp in range(0x110000):
            c = chr(cp)
            if c.isalpha():
                table[cp] = ord(c.lower()[0])
            elif unicodedata.category(c)[0] == "M":
                table[cp] = -cp
        _LETTERS.append(table)
    return _LETTERS[0]


def ngrams(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-gram codes of a text, sorted, and how often each occurs."""
    x = letters()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not (x > 0).any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    x = np.abs(np.concatenate([[0], x, [0]])).astype(np.int64)
    x = x[np.concatenate([[True], (x[1:] != 0) | (x[:-1] != 0)])]  # runs of boundaries are one
    one = x[x > 0]
    two = ((x[:-1] + 1) << _BITS) + x[1:]
    three = ((((x[:-2] + 1) << _BITS) + x[1:-1]) << _BITS) + x[2:]
    return np.unique(np.concatenate([one, two, three[(x[1:-1] > 0)]]), return_counts=True)


def ranked(codes: np.ndarray, counts: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, most frequent first, ties by code."""
    if len(codes) > size:
        edge = np.partition(counts, len(counts) - size)[len(counts) - size]
        keep = counts >= edge
        codes, counts = codes[keep], counts[keep]
    return codes[np.lexsort((codes, -counts))][:size]


class Profiles:
    def __init__(self, by_language: dict[str, list[int]], size: int):
        self.size = size
        self.languages = sorted(by_language)
        self.codes = np.array(sorted({c for p in by_language.values() for c in p}), np.int64)
        self.ranks = np.full((len(self.codes) + 1, len(self.languages)), -1, np.int32)
        for j, name in enumerate(self.languages):
            self.ranks[np.searchsorted(self.codes, by_language[name]), j] = np.arange(len(by_language[name]))

    def guess(self, text: str | None) -> tuple[str, float]:
        codes, counts = ngrams(text) if text else (np.empty(0), np.empty(0))
        if not len(codes) or not self.languages:
            return "und", 0.0
        own = ranked(codes, counts, self.size)
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        known = self.codes[at] == own
        theirs = self.ranks[np.where(known, at, len(self.codes))]
        far = np.where(theirs < 0, self.size, np.abs(theirs - np.arange(len(own))[:, None])).sum(0)
        best = int(far.argmin())
        return self.languages[best], float(1 - far[best] / (self.size * len(own)))


def learn(docs: DataFrame, id_col: str, text_col: str, lang_col: str, size: int = PROFILE, rows: int = TRAIN_ROWS) -> Profiles:
    """Profiles from the rows outside the held-out fold whose language is known."""
    shared.text_session(docs.sparkSession)
    usable = docs.where((shared.fold_of(id_col) != 2) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    counts = {r[0]: r[1] for r in usable.groupBy(lang_col).count().collect()}  # a row a language
    if not counts:
        return Profiles({}, size)
    parts = 1 << 20
    share = F.create_map(*(x for name, n in counts.items() for x in (F.lit(name), F.lit(-(-parts * rows // max(n, rows))))))
    taught = usable.where(F.pmod(F.xxhash64(id_col), F.lit(parts)) < share[F.col(lang_col)])

    def count(batches):
        total: dict[str, list] = defaultdict(list)
        for batch in batches:
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                total[name].append(ngrams(text))
                if len(total[name]) >= 500:
                    total[name] = [_summed(total[name])]
        for name, each in total.items():
            codes, n = _summed(each)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(codes), pa.string()), pa.array(codes, pa.int64()), pa.array(n, pa.int64())], names=["lang", "code", "n"])

    found = taught.select(F.col(lang_col).cast("string"), text_col).mapInArrow(count, "lang string, code long, n long").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    top: dict[str, list[int]] = defaultdict(list)
    for r in found.withColumn("place", place).where(F.col("place") <= size).orderBy("lang", "place").collect():  # size rows a language
        top[r.lang].append(r.code)
    return Profiles(top, size)


def _summed(each: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, inverse = np.unique(np.concatenate([c for c, _ in each]), return_inverse=True)
    return codes, np.bincount(inverse, np.concatenate([n for _, n in each]), len(codes)).astype(np.int64)


def identify(docs: DataFrame, profiles: Profiles, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score."""
    shared.text_session(docs.sparkSession)
    known = docs.sparkSession.sparkContext.broadcast(profiles)  # PROFILE codes a language

    def guess(batches):
        for batch in batches:
            got = [known.value.guess(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([g for g, _ in got], pa.string()), pa.array([s for _, s in got], pa.float64())], names=["doc_id", "held_out", "lang_pred", "score"])

    shape = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    return docs.select(id_col, F.coalesce(shared.fold_of(id_col) == 2, F.lit(False)).alias("held_out"), text_col).mapInArrow(guess, shape)
