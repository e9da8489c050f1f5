"""Admission checks: a contract compiled to ordered predicates, evaluated in one pass.

Order is by kind of check, then by column.  Null cells belong to the not-nullable
check alone.  Nothing here runs a job.  Every expression is one that the engine
compiles (no lambdas): each cell is cast once, rows are split by a disjunction that
stops at the first failure, and only refused rows build their reasons, from texts
known beforehand.
"""

from __future__ import annotations

import dataclasses
import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..contract import INTERNAL_PREFIX, ContractError, DeclaredColumn, RawContract
from ..functions.casts import full_match, typed

FAILURES = f"{INTERNAL_PREFIX}failures"
TYPED = f"{INTERNAL_PREFIX}typed"
#: Failures kept per row in reason_detail, before a marker with their number.
KEPT = 32
REPLACEMENT = "�"
BREAK = "\x01"


@dataclasses.dataclass(frozen=True)
class Check:
    code: str
    column: str | None
    expected: str
    fails: Column


@dataclasses.dataclass(frozen=True)
class CompiledContract:
    """``checks`` speak about rows with their cells cast (`cast_once`)."""

    contract: RawContract
    checks: tuple[Check, ...]
    typed: dict[str, Column]

    @property
    def cast(self) -> tuple[str, ...]:
        """The columns that are no text."""
        return tuple(c.name for c in self.contract.columns if c.parsed.kind != "string")

    def value(self, name: str) -> Column:
        return F.col(TYPED)[name] if name in self.cast else F.col(name)


def _encoding(contract: RawContract) -> Column:
    # keys and values are joined, not walked by a lambda, so that the check is compiled
    odd = F.coalesce(F.col("malformed_text").contains(REPLACEMENT), F.lit(False))
    for c in (*map(F.col, contract.names), F.array_join(F.map_keys("extras"), " "), F.array_join(F.map_values("extras"), " ")):
        odd = odd | F.coalesce(c.contains(REPLACEMENT), F.lit(False))
    return odd


def _bounds(c: DeclaredColumn, value: Column) -> Column:
    outside = F.lit(False)
    for text, beyond in ((c.min, lambda v, b: v < b), (c.max, lambda v, b: v > b)):
        if text is not None:
            bound = typed(F.lit(text), c.parsed)
            outside = outside | bound.isNull() | F.coalesce(beyond(value, bound), F.lit(False))
    return value.isNotNull() & outside


def compile_contract(contract: RawContract) -> CompiledContract:
    out = CompiledContract(contract, (), {c.name: typed(F.col(c.name), c.parsed) for c in contract.columns})
    values = {c.name: out.value(c.name) for c in contract.columns}
    checks = [Check("unreadable/malformed-row", None, f"record(width={len(contract.columns)})", F.col("malformed_text").isNotNull())]
    if contract.check_encoding:
        checks.append(Check("unreadable/encoding-suspect", None, "no-replacement-char", _encoding(contract)))
    for c in contract.columns:
        if c.parsed.kind != "string":
            checks.append(Check("contract/cast-failure", c.name, str(c.parsed), F.col(c.name).isNotNull() & values[c.name].isNull()))
    for c in contract.columns:
        if not c.nullable:
            checks.append(Check("contract/null-violation", c.name, "non-null", F.col(c.name).isNull()))
    for c in contract.columns:
        if c.allowed_values is not None:
            checks.append(Check("contract/value-not-allowed", c.name, "allowed-values", F.coalesce(~F.col(c.name).isin(*c.allowed_values), F.lit(False))))
    for c in contract.columns:
        if c.pattern is not None:
            checks.append(Check("contract/pattern-mismatch", c.name, "pattern", F.coalesce(~full_match(F.col(c.name), c.pattern), F.lit(False))))
    for c in contract.columns:
        if c.min is not None or c.max is not None:
            checks.append(Check("contract/out-of-bounds", c.name, "bounds", _bounds(c, values[c.name])))
    return dataclasses.replace(out, checks=tuple(checks))


def cast_once(raw: DataFrame, compiled: CompiledContract) -> DataFrame:
    """``raw`` with its cells cast, in one struct.  A generator stands between the
    casts and what uses them; the optimizer would copy them into every use otherwise."""
    if not compiled.cast:
        return raw
    return raw.withColumn(TYPED, F.explode(F.array(F.struct(*(compiled.typed[n].alias(n) for n in compiled.cast)))))


def failed(compiled: CompiledContract) -> Column:
    """Whether any check fails, in order and only as far as needed."""
    out = F.lit(False)
    for check in compiled.checks:
        out = out | check.fails
    return out


def _fragment(check: Check) -> str:
    """One failure as JSON; its text is known when the contract is compiled."""
    told = {"code": check.code, "column": check.column, "expected": check.expected}
    return json.dumps({k: v for k, v in told.items() if v is not None}, ensure_ascii=False, separators=(",", ":"))


def failures(compiled: CompiledContract) -> Column:
    """The ordered failures of a row as JSON objects, joined by ``BREAK``; empty if none."""
    return F.concat_ws(BREAK, *(F.when(c.fails, F.lit(_fragment(c))) for c in compiled.checks))


def counts(raw: DataFrame, compiled: CompiledContract) -> DataFrame:
    """One row: candidate, admitted and refused rows."""
    bad = failed(compiled)
    return cast_once(raw, compiled).agg(F.count(F.lit(1)).alias("candidate"), F.count_if(~bad).alias("admitted"), F.count_if(bad).alias("refused"))


def typed_projection(rows: DataFrame, compiled: CompiledContract, also: tuple[str, ...] = ()) -> DataFrame:
    """The declared columns with their types, and the named others; drops no row."""
    return rows.select(*also, *(compiled.typed[c].alias(c) for c in compiled.contract.names))


def admitted(raw: DataFrame, compiled: CompiledContract, also: tuple[str, ...] = ()) -> DataFrame:
    """The rows without a failure, typed."""
    return cast_once(raw, compiled).where(~failed(compiled)).select(*also, *(compiled.value(c).alias(c) for c in compiled.contract.names))


def violations(raw: DataFrame, compiled: CompiledContract) -> DataFrame:
    """Rows with a failure: first code as reason_code, all of them, in order, as
    the JSON array reason_detail, which ends after ``KEPT`` with their number.

    A malformed row has no cells, so beside its own failure only the checks for
    suspect encoding and for nulls can speak about it."""
    bad = cast_once(raw, compiled).where(failed(compiled))
    told = bad.withColumn(FAILURES, failures(compiled))
    code = F.substring_index(F.substring(FAILURES, len('{"code":"') + 1, 1 << 20), '"', 1)  # codes hold no quote
    every = F.replace(F.col(FAILURES), F.lit(BREAK), F.lit(","))
    if len(compiled.checks) > KEPT:
        each = F.split(FAILURES, BREAK)
        cut = F.concat(F.array_join(F.slice(each, 1, KEPT), ","), F.lit(',{"truncated":'), F.size(each).cast("string"), F.lit("}"))
        every = F.when(F.size(each) > KEPT, cut).otherwise(every)
    return told.withColumns({"reason_code": code, "reason_detail": F.concat(F.lit("["), every, F.lit("]"))}).drop(FAILURES, TYPED)


def any_cast_failure(compiled: CompiledContract) -> Column:
    """Whether a cell of a raw row is no value of its type."""
    bad = F.lit(False)
    for name in compiled.cast:
        bad = bad | (F.col(name).isNotNull() & compiled.typed[name].isNull())
    return bad


@dataclasses.dataclass(frozen=True)
class Counts:
    """What a check stage saw; the identity is asserted on integers."""

    candidate: int
    admitted: int
    refused: int

    def holds(self) -> bool:
        return self.candidate == self.admitted + self.refused

    def demand(self, stage: str) -> Counts:
        if not self.holds():
            raise ContractError(f"{stage}: {self.candidate} candidate rows are not {self.admitted} admitted + {self.refused} refused")
        return self


def structural_faults(facts: DataFrame, domain_id: str, expected: tuple[str, ...] | None = None) -> list[str]:
    """Reasons why a fact table may not be committed: null domain ids, other columns than expected."""
    faults = []
    if domain_id not in facts.columns:
        faults.append(f"no column {domain_id}")
    elif n := facts.agg(F.count_if(F.col(domain_id).isNull()).alias("n")).first().n:
        faults.append(f"{n} rows without {domain_id}")
    if expected is not None and set(expected) != set(facts.columns):
        faults.append(f"columns differ: missing {sorted(set(expected) - set(facts.columns))}, added {sorted(set(facts.columns) - set(expected))}")
    return faults


def probe(contract: RawContract, spark) -> None:
    """One row that runs every pattern, format and temporal bound of a contract
    in the engine, so that a contract which cannot run fails when it is bound."""
    tests: dict[str, Column] = {}
    for c in contract.columns:
        if c.pattern is not None:
            # only that it runs counts; a test for null would be folded away unevaluated
            tests[f"{c.name}: pattern"] = F.struct(full_match(F.lit(""), c.pattern))
        if c.parsed.fmt:
            tests[f"{c.name}: format"] = F.coalesce(typed(F.lit("x"), c.parsed).isNull(), F.lit(True))
            low, high = (None if b is None else typed(F.lit(b), c.parsed) for b in (c.min, c.max))
            for name, b in (("min", low), ("max", high)):
                if b is not None:
                    tests[f"{c.name}: {name} parses"] = b.isNotNull()
            if low is not None and high is not None:
                tests[f"{c.name}: min <= max"] = F.coalesce(low <= high, F.lit(True))
    if not tests:
        return
    try:
        row = spark.range(1).select(*(t.alias(str(i)) for i, t in enumerate(tests.values()))).first()
    except Exception as e:
        raise ContractError(f"the contract does not run: {type(e).__name__}") from None
    if bad := [name for name, ok in zip(tests, row, strict=True) if not ok]:
        raise ContractError(f"the contract does not hold in the engine: {bad}")
