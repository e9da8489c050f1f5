"""Format-preserving pseudonyms for personal data.

Validated values are replaced by a keyed permutation within their format, so
equal values have equal pseudonyms in every document, different values different
ones, and nothing else of the text changes:

* card numbers (13 to 19 digits, Luhn check): all digits but the check digit are
  permuted and the check digit is made again;
* account numbers in IBAN form (mod 97): permuted and checked again;
* social security numbers, telephone numbers: their digits;
* IPv4 addresses: within all addresses;
* dates (ISO, or day.month.year and day/month/year, month first where only that
  is a date): within 1900 to 2099;
* e-mail addresses: letters and digits of the local part, each within its kind;
* secrets: hexadecimal ones of 32 digits or more, cloud access keys, and values
  with a digit that a label such as ``password=`` announces: their digits and
  letters, each within its kind.

A Feistel network on two unequal halves, with keyed BLAKE2b as round function and
cycle walking (Black and Rogaway, 2002), orders the values of a format as one
cycle; a value's pseudonym is its successor, the next valid one where the format
has invalid ones.  So no value keeps its own form, however few there are.  Long
values are permuted in chunks, each tweaked by all that stands before it.
Separators, case and country prefixes stay; a value written with other
separators has the same pseudonym.

Defined results: null texts stay null with no spans; empty texts stay empty;
repeated rows give the same result; overlapping finds keep the first and then
the longest; the whole row is passed on if asked.  Whole texts are searched.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import shared

ROUNDS = 10
#: Characters that are permuted together; longer values have several chunks.
CHUNK = 48


class Permutation:
    """A keyed permutation of 0 .. size - 1 that is one cycle, so with two values or
    more none stays, and walking on from a value meets every other one.  ``tweak``
    names the format."""

    def __init__(self, key: bytes, tweak: str, size: int):
        self.size = size
        self.a = 1 << ((size - 1).bit_length() + 1) // 2
        self.b = -(-size // self.a)
        own = key if len(key) <= 64 else hashlib.blake2b(key).digest()
        self.key = hashlib.blake2b(tweak.encode() + b"/" + str(size).encode(), key=own, digest_size=32).digest()

    def _round(self, i: int, half: int) -> int:
        return int.from_bytes(hashlib.blake2b(i.to_bytes(1, "big") + half.to_bytes(-(-half.bit_length() // 8) or 1, "big"), key=self.key).digest(), "big")

    def _there(self, m: int) -> int:
        while True:
            left, right = m % self.a, m // self.a
            for i in range(ROUNDS):
                if i % 2:
                    right = (right + self._round(i, left)) % self.b
                else:
                    left = (left + self._round(i, right)) % self.a
            m = right * self.a + left
            if m < self.size:
                return m

    def _back(self, m: int) -> int:
        while True:
            left, right = m % self.a, m // self.a
            for i in reversed(range(ROUNDS)):
                if i % 2:
                    right = (right - self._round(i, left)) % self.b
                else:
                    left = (left - self._round(i, right)) % self.a
            m = right * self.a + left
            if m < self.size:
                return m

    def __call__(self, m: int) -> int:
        return self._back((self._there(m) + 1) % self.size)

    def inverse(self, m: int) -> int:
        return self._back((self._there(m) - 1) % self.size)


def luhn_digit(digits: str) -> str:
    """The check digit that makes ``digits`` plus it pass the Luhn test."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (2 if i % 2 == 0 else 1)
        total += n - 9 if n > 9 else n
    return str(-total % 10)


def iban_rest(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text[4:] + text[:4])) % 97


def _put_back(shape: str, values: str, kind: Callable[[str], bool]) -> str:
    """``shape`` with its characters of ``kind`` replaced, in order, by ``values``."""
    new = iter(values)
    return "".join(next(new) if kind(c) else c for c in shape)


def _digit(c: str) -> bool:
    return "0" <= c <= "9"


_EPOCH, _DAYS = datetime.date(1900, 1, 1), (datetime.date(2100, 1, 1) - datetime.date(1900, 1, 1)).days

#: The alphabets within which letters of an address are permuted.
_ALPHABETS = ("0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "àáâãäåæçèéêëìíîïðñòóôõöøùúûüýþÿß", "ÀÁÂÃÄÅÆÇÈÉÊËÌÍÎÏÐÑÒÓÔÕÖØÙÚÛÜÝÞ")
_PLACE = {c: (a, i) for a in _ALPHABETS for i, c in enumerate(a)}
_HEX = "0123456789abcdef"


def _given_out(ssn: str) -> bool:
    """Whether nine digits can be a social security number."""
    return ssn[:3] not in ("000", "666") and ssn[3:5] != "00" and ssn[5:] != "0000"


_NUMBERS = re.compile(
    r"""(?P<date>(?<![\w-])(?<!\d[.])(?:(?:19|20)\d\d-\d\d-\d\d|\d\d([./])\d\d\2(?:19|20)\d\d)(?!(?!T\d)[\w-]|[.]\d))
      |(?P<ipv4>(?<!\w)(?<!\d[.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|[.]\d))
      |(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))
      |(?P<phone>(?<![\w+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?![\w]|-\d)
                |(?<![\w(+])\(\d{3}\)[ ]?\d{3}[-.]\d{4}(?![\w]|-\d)
                |(?<![\w.+-])\d{3}[-.]\d{3}[-.]\d{4}(?![\w]|[-.]\d))
      |(?P<secret>(?<![\w])(?=[0-9A-Fa-f]*\d)(?:[0-9a-f]{32,}+|[0-9A-F]{32,}+)(?![\w]))
      |(?P<key>(?<!\w)(?:AKIA|ASIA)[0-9A-Z]{16}(?!\w))
      |(?P<iban>(?<![\w])[A-Z]{2}\d{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![\w]))
      |(?P<card>(?<!\w)(?<!\d[.])\d(?:[ -]?\d){12,18}(?![\w]))""",
    re.X,
)
_RUN = re.compile(r"\d(?:[ -]?\d)*")
_GROUP = re.compile(r"(?<!\w)\w")
#: Group lengths in which card numbers are written.
_GROUPED = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), *((n,) for n in range(13, 20))}
_LABELLED = re.compile(r"(?<![^\W_])(?:pass(?:word|wd|phrase)?|pwd|secret|token|api[_-]?key|access[_-]?key)[\"']?\s{0,3}[=:]\s{0,3}[\"']?(?P<value>(?=[A-Za-z0-9_.+/-]*[0-9])[A-Za-z0-9_.+/-]{6,}+)", re.I)
_LOCAL = re.compile(r"[\w.%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9](?:[A-Za-z0-9-]{0,62})(?:\.[A-Za-z0-9][A-Za-z0-9-]{0,62})*\.[A-Za-z]{2,24}(?![A-Za-z0-9])")
_ANY = re.compile(r"[0-9@]|[A-Fa-f]{32}|A[KS]IA")


class Pseudonyms:
    def __init__(self, key: bytes):
        self.key = key
        self._made: dict[tuple[str, int], Permutation] = {}

    def _permuted(self, tweak: str, m: int, size: int, fits: Callable[[int], bool] = lambda x: True) -> int:
        """The first value after ``m`` in its format's cycle that fits."""
        p = self._made.get((tweak, size)) or self._made.setdefault((tweak, size), Permutation(self.key, tweak, size))
        x = p(m)
        while not fits(x):
            x = p(x)
        return x

    def _digits(self, tweak: str, digits: str, fits: Callable[[str], bool] = lambda x: True) -> str:
        n = len(digits)
        return f"{self._permuted(tweak, int(digits), 10**n, lambda x: fits(f'{x:0{n}d}')):0{n}d}"

    def _by_kind(self, tweak: str, text: str, alphabets: tuple[str, ...] = _ALPHABETS) -> str:
        """Characters permuted together in chunks, each place within its own alphabet."""
        place = _PLACE if alphabets is _ALPHABETS else {c: (a, i) for a in alphabets for i, c in enumerate(a)}
        at = [i for i, c in enumerate(text) if c in place]
        out, before, chunks = list(text), hashlib.blake2b(), -(-len(at) // CHUNK)
        for k in range(chunks):
            own = at[len(at) * k // chunks : len(at) * (k + 1) // chunks]
            m, size = 0, 1
            for i in own:
                alphabet, j = place[text[i]]
                m, size = m + j * size, size * len(alphabet)
            new = self._permuted(tweak, m, size) if chunks == 1 else Permutation(self.key, f"{tweak}/{len(at)}/{k}/{before.hexdigest()}", size)(m)
            for i in own:
                alphabet = place[text[i]][0]
                out[i] = alphabet[new % len(alphabet)]
                new //= len(alphabet)
            before.update("".join(text[i] for i in own).encode())
        return "".join(out)

    def replaced(self, kind: str, text: str) -> str | None:
        """The pseudonym of a find, or None if it fails validation."""
        digits = "".join(filter(_digit, text))
        if kind == "card":
            if luhn_digit(digits[:-1]) != digits[-1]:
                return None
            body = self._digits("card", digits[:-1])
            return _put_back(text, body + luhn_digit(body), _digit)
        if kind == "iban":
            plain = text.replace(" ", "")
            if iban_rest(plain) != 1:
                return None
            number = self._by_kind("iban", plain[4:])
            check = 98 - iban_rest(f"{plain[:2]}00{number}")
            return _put_back(text, f"{plain[:2]}{check:02d}{number}", lambda c: c != " ")
        if kind == "ipv4":
            parts = [int(x) for x in text.split(".")]
            if max(parts) > 255:
                return None
            x = self._permuted("ipv4", int.from_bytes(bytes(parts), "big"), 1 << 32)
            return ".".join(map(str, x.to_bytes(4, "big")))
        if kind == "ssn":
            return _put_back(text, self._digits("ssn", digits, _given_out), _digit) if _given_out(digits) else None
        if kind == "phone":
            at = len(re.match(r"\+\d{1,3}(?=[ .(-])|\+1(?=\d{10})|\+|", text)[0])
            head, tail = text[:at], text[at:]
            own = "".join(filter(_digit, tail))
            fits = len(own) == 10 if head == "+1" else 7 <= len(own) <= 15 - max(0, len(head) - 1)
            return head + _put_back(tail, self._digits("phone", own), _digit) if fits else None
        if kind == "date":
            iso = text[4] == "-"
            y, m, d = (int(text[:4]), int(text[5:7]), int(text[8:])) if iso else (int(text[6:]), int(text[3:5]), int(text[:2]))
            month_first = not iso and m > 12
            if month_first:
                m, d = d, m
            try:
                day = (datetime.date(y, m, d) - _EPOCH).days
            except ValueError:
                return None
            # days that only one reading can have stay such days, so every form has its own dates
            new = _EPOCH + datetime.timedelta(self._permuted("date", day, _DAYS, lambda x: ((_EPOCH + datetime.timedelta(x)).day > 12) == (d > 12)))
            return new.isoformat() if iso else new.strftime(f"%m{text[2]}%d{text[2]}%Y" if month_first else f"%d{text[2]}%m{text[2]}%Y")
        if kind == "key":
            return text[:4] + self._by_kind("key", text[4:])
        if kind == "secret" and re.fullmatch("[0-9a-f]+|[0-9A-F]+", text):
            new = self._by_kind("secret", text.lower(), (_HEX,))
            return new if text == text.lower() else new.upper()
        if kind == "secret":
            return self._by_kind("secret", text)
        local, _, domain = text.rpartition("@")
        return f"{self._by_kind('email', local)}@{domain}"

    def _cards(self, text: str, start: int, end: int) -> list[tuple[int, int, str, str]]:
        """The card numbers among the groups of a run of digits: the whole run,
        then usual groupings, then the longest; none overlapping, in order."""
        groups = [m.span() for m in re.finditer(r"\d+", text[start:end])]
        valid = []
        for i, (a, _) in enumerate(groups):
            lengths: tuple[int, ...] = ()
            for x, b in groups[i:]:
                lengths += (b - x,)
                if (n := sum(lengths)) > 19:
                    break
                if n < 13 or re.match(r"\w", text[start + b : start + b + 1]):
                    continue
                if (new := self.replaced("card", text[start + a : start + b])) is not None:
                    valid.append((len(lengths) < len(groups), lengths not in _GROUPED, -n, start + a, start + b, new))
        kept: dict[int, tuple[int, int, str, str]] = {}
        for *_, a, b, new in sorted(valid):
            if not any(at in kept and kept[at][1] > a for at in range(a - 40, b)):  # a number with its separators has at most 37 characters
                kept[a] = (a, b, "card", new)
        return [kept[a] for a in sorted(kept)]

    def _numbers(self, text: str) -> list[tuple[int, int, str, str]]:
        """The finds of `_NUMBERS`.  A find that fails validation is tried shorter
        where it has groups, and the search goes on at its next group."""
        out: list[tuple[int, int, str, str]] = []
        cards: list[tuple[int, int, str, str]] = []  # those of the run of digits up to ``seen``
        at, seen = 0, 0
        while True:
            m = _NUMBERS.search(text, at, cards[0][0] if cards else len(text))
            if m is None:
                if not cards:
                    return out
                out.append(cards.pop(0))
                at = out[-1][1]
                continue
            kind, start, end, new = m.lastgroup, m.start(), m.end(), None
            if kind == "card":
                if start >= seen:
                    seen = _RUN.match(text, start).end()
                    cards = self._cards(text, start, seen)
                    if cards:
                        at = start
                        continue
            else:
                new = self.replaced(kind, m[0])
                while new is None and kind == "iban" and (cut := text.rfind(" ", start, end)) - start - text.count(" ", start, cut) >= 15:
                    end, new = cut, self.replaced(kind, text[start:cut])
                if new is None and kind == "phone" and not self._cards(text, start + 1, end):
                    while new is None and (cut := max(text.rfind(c, start, end) for c in " .-")) > start:
                        end, new = cut, self.replaced(kind, text[start:cut])
            if new is not None:
                out.append((start, end, kind, new))
                at = end
            else:
                following = _GROUP.search(text, start + 1, m.end())
                at = following.start() if following else m.end()

    def finds(self, text: str) -> list[tuple[int, int, str, str]]:
        """(start, end, kind, pseudonym) of all finds, in order, none overlapping."""
        if not _ANY.search(text):
            return []
        out, at = [], text.find("@")
        while at >= 0:
            if right := _DOMAIN.match(text, at):
                start = at
                while start and _LOCAL.match(text[start - 1]):
                    start -= 1
                while start < at and not text[start].isalnum():
                    start += 1
                if start < at:
                    out.append((start, right.end(), "email", self.replaced("email", text[start : right.end()])))
            at = text.find("@", at + 1)
        out += self._numbers(text)
        for m in _LABELLED.finditer(text):
            out.append((*m.span("value"), "secret", self.replaced("secret", m["value"])))
        out.sort(key=lambda x: (x[0], -x[1]))
        kept, end = [], 0
        for x in out:
            if x[0] >= end:
                kept.append(x)
                end = x[1]
        return kept

    def apply(self, text: str) -> tuple[str, list[tuple[int, int, str, str]]]:
        finds = self.finds(text)
        if not finds:
            return text, finds
        out, at = [], 0
        for start, end, _, new in finds:
            out += [text[at:start], new]
            at = end
        return "".join([*out, text[at:]]), finds


def pseudonymised(docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """One row per document: doc_id, text with pseudonyms, n_found, spans (kind
    and place in the text as it was), and, if asked, the whole row as it was as ``kept``."""
    if not key:
        raise ValueError("pseudonyms need a key")
    shared.text_session(docs.sparkSession)
    secret = key.encode()
    more = docs.select(*[shared.kept_row(docs)] * keep)
    span = T.ArrayType(T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))

    def replace(batches):
        of = Pseudonyms(secret)
        for batch in batches:
            texts, spans = [], []
            for text in batch.column(1).to_pylist():
                new, found = of.apply(text) if text is not None else (None, [])
                texts.append(new)
                spans.append([{"kind": k, "start": s, "end": e} for s, e, k, _ in found])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.string()), pa.array([len(s) for s in spans], pa.int32()), pa.array(spans, pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))), *(batch.column(i) for i in range(2, batch.num_columns))],
                names=[f.name for f in shape],
            )

    shape = T.StructType([T.StructField("doc_id", docs.schema[id_col].dataType), T.StructField("text", T.StringType()), T.StructField("n_found", T.IntegerType()), T.StructField("spans", span), *more.schema])
    return docs.select(F.col(id_col), F.col(text_col), *more.columns and [shared.kept_row(docs)]).mapInArrow(replace, shape)
