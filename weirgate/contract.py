"""Admission contracts: declared columns, how files are read, and their versions.

A contract names the columns of a delivered table in a small type grammar and
states what each cell must satisfy.  Everything here runs on the driver over
values of bounded size and fails early with messages that name the field.
"""

from __future__ import annotations

import dataclasses
import datetime
import hashlib
import json
import re
from decimal import Decimal, InvalidOperation

#: Columns that the engine adds to raw tables; a contract cannot declare them.
RAW_LINEAGE = ("batch_id", "delivery_id", "feed_id", "received_at", "source_uri", "object_seq", "row_index", "read_spec_version", "malformed_text")
FRAMEWORK_COLUMNS = (*RAW_LINEAGE, "extras")
RESERVED_COLUMNS = (*FRAMEWORK_COLUMNS, "reason_code", "reason_detail")
INTERNAL_PREFIX = "_weirgate_"
MOST_COLUMNS, MOST_NAME, MOST_VALUE, MOST_SKIP = 1024, 128, 1024, 4096

#: Pattern letters that the engine's date parser supports.
DATE_LETTERS = "GyMLdDahKkHmsSVzOXxZ"

_NAME = re.compile(r"[A-Za-z_][A-Za-z0-9_]*")
_TYPE = re.compile(r"(?P<plain>string|int|long|bool)|decimal\((?P<p>\d{1,2}),\s*(?P<s>\d{1,2})\)|(?P<when>date|timestamp)\((?P<fmt>.+)\)", re.S)


class ContractError(ValueError):
    """A contract, a read specification or a delivery breaks a stated rule."""


@dataclasses.dataclass(frozen=True)
class ColumnType:
    kind: str
    precision: int | None = None
    scale: int | None = None
    fmt: str | None = None

    @staticmethod
    def parse(text: str) -> ColumnType:
        m = _TYPE.fullmatch(text.strip())
        if not m:
            raise ContractError(f"type {text!r}: expected string, int, long, bool, decimal(p,s), date(fmt) or timestamp(fmt)")
        if m["plain"]:
            return ColumnType(m["plain"])
        if m["p"]:
            p, s = int(m["p"]), int(m["s"])
            if not 1 <= p <= 38 or s > p:
                raise ContractError(f"type {text!r}: needs 1 <= p <= 38 and s <= p")
            return ColumnType("decimal", p, s)
        bare = re.sub(r"'(?:[^']|'')*'", "", m["fmt"])
        if not m["fmt"].strip() or "'" in bare or any(c.isalpha() and c not in DATE_LETTERS for c in bare):
            raise ContractError(f"type {text!r}: pattern uses letters outside {DATE_LETTERS} or an open quote")
        return ColumnType(m["when"], fmt=m["fmt"])

    def __str__(self) -> str:
        if self.kind == "decimal":
            return f"decimal({self.precision},{self.scale})"
        return f"{self.kind}({self.fmt})" if self.fmt else self.kind

    @property
    def spark(self) -> str:
        return {"int": "int", "long": "bigint", "bool": "boolean", "string": "string", "date": "date", "timestamp": "timestamp"}.get(self.kind) or f"decimal({self.precision},{self.scale})"

    def bound(self, text: str) -> object:
        """An ordered value of a bound that can be judged without an engine."""
        try:
            return int(text) if self.kind in ("int", "long") else Decimal(text)
        except (ValueError, InvalidOperation):
            raise ContractError(f"bound {text!r} is no {self}") from None


@dataclasses.dataclass(frozen=True)
class DeclaredColumn:
    name: str
    type: str = "string"
    required: bool = False
    nullable: bool = True
    allowed_values: tuple[str, ...] | None = None
    pattern: str | None = None
    min: str | None = None
    max: str | None = None

    def __post_init__(self) -> None:
        at = f"column {self.name!r}"
        if not _NAME.fullmatch(self.name) or len(self.name) > MOST_NAME:
            raise ContractError(f"{at}: name is no identifier of at most {MOST_NAME} characters")
        if self.name in RESERVED_COLUMNS or self.name.startswith(INTERNAL_PREFIX):
            raise ContractError(f"{at}: name is reserved")
        parsed = self.parsed
        if self.allowed_values is not None and (not self.allowed_values or any(len(v) > MOST_VALUE for v in self.allowed_values)):
            raise ContractError(f"{at}: allowed_values is empty or holds a value over {MOST_VALUE} characters")
        if self.pattern is not None:
            try:
                re.compile(self.pattern)
            except re.error as e:
                raise ContractError(f"{at}: pattern does not compile: {e}") from None
        if self.min is not None or self.max is not None:
            if parsed.kind in ("string", "bool"):
                raise ContractError(f"{at}: bounds need an ordered type")
            if parsed.kind in ("int", "long", "decimal"):
                low, high = (None if b is None else parsed.bound(b) for b in (self.min, self.max))
                if low is not None and high is not None and low > high:
                    raise ContractError(f"{at}: min is above max")

    @property
    def parsed(self) -> ColumnType:
        return ColumnType.parse(self.type)


@dataclasses.dataclass(frozen=True)
class RawContract:
    columns: tuple[DeclaredColumn, ...]
    check_encoding: bool = True

    def __post_init__(self) -> None:
        if not 1 <= len(self.columns) <= MOST_COLUMNS:
            raise ContractError(f"a contract declares 1 to {MOST_COLUMNS} columns")
        names = [c.name for c in self.columns]
        if len(set(names)) < len(names):
            raise ContractError("column names repeat")

    @property
    def names(self) -> tuple[str, ...]:
        return tuple(c.name for c in self.columns)


@dataclasses.dataclass(frozen=True)
class ReadSpec:
    format: str = "csv"
    delimiter: str = ","
    quote: str = '"'
    header: bool = True
    skip_leading_lines: int = 0
    multiline: bool = False
    compression: str = "none"
    charset: str = "utf-8"

    def __post_init__(self) -> None:
        if self.format != "csv":
            raise ContractError(f"format {self.format!r} is reserved")
        if self.charset.lower() not in ("utf-8", "utf8"):
            raise ContractError(f"charset {self.charset!r} is reserved")
        if self.compression not in ("none", "gzip"):
            raise ContractError(f"compression {self.compression!r} is reserved")
        if len(self.delimiter) != 1 or len(self.quote) != 1 or self.delimiter == self.quote or {self.delimiter, self.quote} & set("\r\n"):
            raise ContractError("delimiter and quote are two different characters, no line ends")
        if not 0 <= self.skip_leading_lines <= MOST_SKIP:
            raise ContractError(f"skip_leading_lines is 0 to {MOST_SKIP}")


@dataclasses.dataclass(frozen=True)
class PipelineSpec:
    name: str
    raw: RawContract
    read: ReadSpec = ReadSpec()
    domain_id: str = "domain_id"
    fold_order: tuple[str, ...] = ("event_time", "source_ts", "content_hash")
    co_effects: tuple[tuple[str, str], ...] = ()

    def __post_init__(self) -> None:
        for c in self.raw.columns:
            if not self.read.header and c.required:
                raise ContractError(f"column {c.name!r}: required needs a header")
            if self.read.header and not c.nullable and not c.required:
                raise ContractError(f"column {c.name!r}: nullable false needs required with a header")


def _plain(value: object) -> object:
    if dataclasses.is_dataclass(value) and not isinstance(value, type):
        return {f.name: _plain(getattr(value, f.name)) for f in dataclasses.fields(value)}
    return [_plain(v) for v in value] if isinstance(value, (tuple, list)) else value


def version(*parts: object) -> str:
    """sha256 over the canonical JSON of parsed models: equal models, equal version."""
    from .functions.canonical import canonical_text

    return hashlib.sha256("\n".join(canonical_text(_plain(p)) for p in parts).encode()).hexdigest()


def read_spec_version(spec: PipelineSpec) -> str:
    return version(spec.read)


def check_version(spec: PipelineSpec) -> str:
    return version(spec.raw)


def from_mapping(raw: dict) -> PipelineSpec:
    """A specification from parsed YAML or JSON; unknown keys are errors."""

    def build(kind, values: dict):
        known = {f.name for f in dataclasses.fields(kind)}
        if extra := sorted(set(values) - known):
            raise ContractError(f"{kind.__name__}: unknown keys {extra}")
        return kind(**values)

    raw = dict(raw)
    contract = dict(raw.pop("raw"))
    columns = tuple(build(DeclaredColumn, {k: tuple(v) if isinstance(v, list) else v for k, v in c.items()}) for c in contract.pop("columns"))
    out = {"raw": build(RawContract, {"columns": columns, **contract}), "read": build(ReadSpec, raw.pop("read", {}))}
    if "co_effects" in raw:
        out["co_effects"] = tuple(sorted(dict(raw.pop("co_effects")).items()))
    if "fold_order" in raw:
        out["fold_order"] = tuple(raw.pop("fold_order"))
    return build(PipelineSpec, {**raw, **out})


def load(path: str) -> PipelineSpec:
    with open(path, encoding="utf-8") as f:
        text = f.read()
    if path.endswith(".json"):
        return from_mapping(json.loads(text))
    import yaml

    return from_mapping(yaml.safe_load(text))


def utc_now() -> datetime.datetime:
    return datetime.datetime.now(datetime.UTC)
