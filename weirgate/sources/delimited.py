"""Delivered delimited files as raw rows, tokenised by native expressions.

All objects of a delivery are one scan.  Line order inside a file comes from the
blocks that Spark read, so large files are split between tasks, and rows are
numbered without moving them; headers are bounded reads of the first lines.
Records that span lines take the multiline reader, which parses a file (of up to
2 GB, what one value can hold) in one executor task, never on the driver.
"""

from __future__ import annotations

import csv
import dataclasses
import io
import re
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..contract import ContractError, RawContract, ReadSpec
from ..functions import text as X
from ..session import durable, share_code

BOM = "﻿"
_CODECS = (".gz", ".gzip", ".bz2", ".lz4", ".snappy", ".deflate", ".zst", ".zstd", ".xz")
MOST_OBJECTS, MOST_URI = 256, 1024
#: Bytes in which the header of an object has to end.
OPENING_BYTES = 64 << 20
#: Block offsets that are sent to every task; more are joined.
MOST_BLOCKS = 100_000
#: Rows and characters of a batch of multiline records.
BATCH_ROWS, BATCH_CHARS = 1000, 4 << 20


@dataclasses.dataclass(frozen=True)
class Binding:
    """Where a file's fields go: positions of declared columns (from 0), names and positions of extras."""

    width: int
    declared: dict[str, int]
    extras: dict[str, int]
    missing_required: tuple[str, ...] = ()
    repeated: tuple[tuple[str, int], ...] = ()


def bind_header(header: list[str] | None, contract: RawContract, spec: ReadSpec) -> Binding:
    """Names are matched exactly; without a header columns are positional."""
    if not spec.header:
        return Binding(len(contract.columns), {n: i for i, n in enumerate(contract.names)}, {})
    header = header or []
    repeated = tuple((h, header.count(h)) for h in dict.fromkeys(header) if header.count(h) > 1)
    place = {h: i for i, h in reversed(list(enumerate(header)))}
    declared = {n: place[n] for n in contract.names if n in place}
    missing = tuple(c.name for c in contract.columns if c.required and c.name not in place)
    return Binding(len(header), declared, {h: i for h, i in place.items() if h not in declared}, missing, repeated)


def check_names(uris: list[str], spec: ReadSpec) -> None:
    """The stated compression is what the names say."""
    if len(uris) > MOST_OBJECTS or any(len(u) > MOST_URI for u in uris):
        raise ContractError(f"a delivery has at most {MOST_OBJECTS} objects with addresses of at most {MOST_URI} characters")
    for i, u in enumerate(sorted(uris), 1):
        low = u.lower()
        if spec.compression == "gzip" and not low.endswith((".gz", ".gzip")):
            raise ContractError(f"object {i}: gzip is stated but the name has no such suffix")
        if spec.compression == "none" and low.endswith(_CODECS):
            raise ContractError(f"object {i}: no compression is stated but the name has the suffix of one")


def _strict(line: str, spec: ReadSpec) -> list[str] | None:
    d, q = re.escape(spec.delimiter), re.escape(spec.quote)
    f = f"(?:{q}[^{q}]*(?:{q}{q}[^{q}]*)*{q}|[^{q}{d}][^{d}]*|)"
    if not re.fullmatch(f"{f}(?:{d}{f})*", line, re.S):
        return None
    return [t[1:-1].replace(spec.quote * 2, spec.quote) if t.startswith(spec.quote) else t for t in re.findall(f"{d}({f})", spec.delimiter + line, re.S)]


def _lines(spark: SparkSession, uris: list[str]) -> DataFrame:
    """(uri, block, line): every line that is not blank, in the order of its block."""
    read = spark.read.text(uris).select(F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_block_start").alias("block"), F.col("value").alias("line"))
    return read.where(F.col("line") != "")


def _opening(spark: SparkSession, uri: str, spec: ReadSpec, n: int) -> list[str]:
    """The first ``n`` lines of an object, as far as they end in `OPENING_BYTES`."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(uri)
    stream = path.getFileSystem(spark._jsc.hadoopConfiguration()).open(path)
    try:
        plain = jvm.java.util.zip.GZIPInputStream(stream) if spec.compression == "gzip" else stream
        reader = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(jvm.org.apache.commons.io.input.BoundedInputStream(plain, OPENING_BYTES), "UTF-8"))
        lines = []
        while len(lines) < n and (line := reader.readLine()) is not None:
            lines.append(line if lines else line.removeprefix(BOM))
        return lines
    finally:
        stream.close()


def _headers(openings: dict[str, list[str]], spec: ReadSpec, contract: RawContract) -> dict[str, Binding]:
    """One binding per object; every object is judged before any body is read."""
    if not spec.header:
        return {u: bind_header(None, contract, spec) for u in openings}
    out, faults, n = {}, [], spec.skip_leading_lines
    for i, (u, lines) in enumerate(openings.items(), 1):
        fields = _strict(lines[n], spec) if len(lines) > n else None
        if fields is None:
            faults.append(f"object {i}: no readable header")
            continue
        b = bind_header(fields, contract, spec)
        if b.repeated:
            faults.append(f"object {i}: {len(b.repeated)} header names repeat")
        if b.missing_required:
            faults.append(f"object {i}: required columns are missing: {', '.join(b.missing_required)}")
        out[u] = b
    if faults:
        raise ContractError("; ".join(faults))
    return out


def _plain(uri: str) -> str:
    """An address as both the caller and the scan may write it."""
    return re.sub(r"\Afile:/+", "/", uri)


def _shaped(lines: DataFrame, contract: RawContract, bindings: dict[str, Binding]) -> DataFrame:
    """Raw rows from (source_uri, object_seq, row_index, binding, ok, tokens, line)."""
    kinds = sorted(set(map(_key, bindings.values())))
    good = F.col("ok") & (F.size("tokens") == F.element_at(F.array(*(F.lit(k[0]) for k in kinds)), F.col("binding")))

    def cell(name: str):
        value = F.lit(None).cast("string")
        for i, (_, declared, _) in enumerate(kinds, 1):
            at = dict(declared).get(name)
            if at is not None:
                value = F.when(F.col("binding") == i, F.get("tokens", F.lit(at))).otherwise(value)
        return F.when(good, F.nullif(value, F.lit("")))

    empty = F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))
    extras = empty
    for i, (_, _, more) in enumerate(kinds, 1):
        if more:
            pairs = [x for name, at in more for x in (F.lit(name), F.get("tokens", F.lit(at)))]
            extras = F.when(F.col("binding") == i, F.create_map(*pairs)).otherwise(extras)
    return lines.select(
        "source_uri", "object_seq", "row_index", F.when(~good, F.col("line")).alias("malformed_text"), *(cell(n).alias(n) for n in contract.names), F.when(good, extras).otherwise(empty).alias("extras")
    )


def _key(b: Binding) -> tuple:
    return (b.width, tuple(sorted(b.declared.items())), tuple(sorted(b.extras.items())))


def empty_raw(spark: SparkSession, contract: RawContract) -> DataFrame:
    names = ", ".join(f"`{n}` string" for n in contract.names)
    return spark.createDataFrame([], f"source_uri string, object_seq int, row_index bigint, malformed_text string, {names}, extras map<string,string>")


def read_delivery(spark: SparkSession, uris: list[str], spec: ReadSpec, contract: RawContract) -> DataFrame:
    """Raw rows of a delivery: locators, malformed_text, declared columns as text, extras.

    Objects are numbered in code-point order; row_index counts the records of an
    object from 1, blank lines left out.  Ragged and unreadable lines keep their
    text in malformed_text and have no cells.  Empty fields are null in declared
    columns and empty in extras."""
    check_names(uris, spec)
    if not uris:
        return empty_raw(spark, contract)
    ordered = sorted(uris)
    first = spec.skip_leading_lines + spec.header
    openings = {u: _opening(spark, u, spec, first) if first else [] for u in ordered}
    bindings = _headers(openings, spec, contract)
    kinds = sorted(set(map(_key, bindings.values())))

    def place(i: int, u: str):
        told = sum(line != "" for line in openings[u])  # lines before the body that count as rows of the file
        return F.struct(F.lit(u).alias("u"), F.lit(i).alias("seq"), F.lit(kinds.index(_key(bindings[u])) + 1).alias("b"), F.lit(told).alias("told"))

    places = F.create_map(*(x for i, u in enumerate(ordered, 1) for x in (F.lit(_plain(u)), place(i, u))))
    if spec.multiline:
        return _shaped(_multiline(spark, ordered, spec, places), contract, bindings)
    rows = _numbered(_lines(spark, ordered)).withColumn("p", places[F.regexp_replace("uri", "^file:/+", "/")])
    rows = rows.withColumn("row_index", F.col("row_index") - F.col("p.told")).where(F.col("row_index") > 0)
    ok = X.well_formed(F.col("line"), spec.delimiter, spec.quote)
    shaped = rows.select(
        F.col("p.u").alias("source_uri"), F.col("p.seq").alias("object_seq"), "row_index", F.col("p.b").alias("binding"), ok.alias("ok"),
        F.when(ok, X.tokens(F.col("line"), spec.delimiter, spec.quote)).otherwise(F.array().cast("array<string>")).alias("tokens"), "line",
    )
    return _shaped(shaped, contract, bindings)


def _numbered(lines: DataFrame) -> DataFrame:
    """row_index within a file, from 1.  The rows of a block are consecutive in one
    task, so a row's number is its id less the least of its block, plus the rows of
    the blocks before; rows are joined with one small row a block and never move."""
    told = lines.withColumn("id", F.monotonically_increasing_id())
    blocks = told.groupBy("uri", "block").agg(F.min("id").alias("least"), F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("uri").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    shifts = durable(blocks.select("uri", "block", (before - F.col("least") + 1).alias("shift")), "blocks")
    if shifts.count() <= MOST_BLOCKS:
        shifts = F.broadcast(shifts)
    return told.join(shifts, ["uri", "block"]).withColumn("row_index", F.col("id") + F.col("shift"))


def _records(text: str, spec: ReadSpec):
    """(tokens, text as it stands) of each record of a file whose quoted fields may
    span lines, blank ones left out.  Read leniently: text after a closing quote
    belongs to the field, and a quote that never closes takes what is left."""
    csv.field_size_limit(sys.maxsize)
    source = io.StringIO(text.removeprefix(BOM), newline="")
    for _ in range(spec.skip_leading_lines):
        source.readline()
    begin = source.tell()
    for fields in csv.reader(iter(source.readline, ""), delimiter=spec.delimiter, quotechar=spec.quote, doublequote=True):
        end = source.tell()
        if fields:
            source.seek(begin)
            yield fields, source.read(end - begin)
        begin = end


def _multiline(spark: SparkSession, uris: list[str], spec: ReadSpec, places) -> DataFrame:
    share_code(spark)

    shape = T.StructType([T.StructField("uri", T.StringType()), T.StructField("row_index", T.LongType()), T.StructField("ok", T.BooleanType()), T.StructField("tokens", T.ArrayType(T.StringType())), T.StructField("line", T.StringType())])

    def whole(batches):
        import gzip

        import pyarrow as pa

        def batch_of(uri, rows):
            at, tokens, lines = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array([uri] * len(rows), pa.string()), pa.array(at, pa.int64()), pa.array([True] * len(rows), pa.bool_()), pa.array(tokens, pa.list_(pa.string())), pa.array(lines, pa.string())], names=["uri", "row_index", "ok", "tokens", "line"])

        for batch in batches:
            for i in range(batch.num_rows):
                uri, content = batch.column(0)[i].as_py(), batch.column(1)[i].as_py()
                text = (gzip.decompress(content) if spec.compression == "gzip" else content).decode("utf-8", "replace")
                rows, size = [], 0
                for at, (fields, line) in enumerate(_records(text, spec), 1 - spec.header):
                    if at:
                        rows.append((at, fields, line))
                        size += len(line)
                    if len(rows) >= BATCH_ROWS or size >= BATCH_CHARS:
                        yield batch_of(uri, rows)
                        rows, size = [], 0
                if rows:
                    yield batch_of(uri, rows)

    files = spark.read.format("binaryFile").load(uris).select(F.col("path").alias("uri"), "content").mapInArrow(whole, shape)
    p = places[F.regexp_replace("uri", "^file:/+", "/")]
    return files.withColumn("p", p).select(F.col("p.u").alias("source_uri"), F.col("p.seq").alias("object_seq"), "row_index", F.col("p.b").alias("binding"), "ok", "tokens", "line")
