"""Admission over a stream: raw rows split into admitted and refused, a batch a trigger.

An extension of the batch lane.  The same compiled checks run on a streaming
frame; ``foreachBatch`` hands each trigger's rows to the two sinks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql.streaming import DataStreamWriter

from ..contract import RawContract
from ..operators import checks


def admission_stream(raw: DataFrame, contract: RawContract, admitted: Callable[[DataFrame, int], None], refused: Callable[[DataFrame, int], None]) -> DataStreamWriter:
    compiled = checks.compile_contract(contract)

    def split(rows: DataFrame, batch: int) -> None:
        rows = rows.persist()  # both sinks read it
        try:
            admitted(checks.admitted(rows, compiled), batch)
            refused(checks.violations(rows, compiled), batch)
        finally:
            rows.unpersist()

    return raw.writeStream.foreachBatch(split)
