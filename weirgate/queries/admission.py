"""Queries over the admission lane, with faults laid into ``lineitem`` by arithmetic that SQL can repeat."""

from __future__ import annotations

import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..contract import ColumnType, DeclaredColumn, RawContract
from ..functions import canonical, casts
from ..functions import text as X
from ..operators import checks, lineage, quarantine, subtract
from ..session import durable

NOW = datetime.datetime(2026, 1, 1, tzinfo=datetime.UTC)
LINEAGE = lineage.Lineage("b-1", "d-1", "feed/lineitem", NOW)

CONTRACT = RawContract(
    (
        DeclaredColumn("domain_id", required=True, nullable=False),
        DeclaredColumn("quantity", "int", min="2", max="45"),
        DeclaredColumn("price", "decimal(12,2)", max="50000.00"),
        DeclaredColumn("flag", allowed_values=("A", "N")),
        DeclaredColumn("shipdate", "date(yyyy-MM-dd)", min="1992-06-01"),
        DeclaredColumn("status", pattern="[OF]"),
    )
)

RAW_SQL = """
raw AS (
  SELECT 'lineitem/' || (l_orderkey % 7) AS source_uri, CAST(l_orderkey % 7 + 1 AS INTEGER) AS object_seq, l_orderkey * 10 + l_linenumber AS row_index,
    CASE WHEN bad THEN 'bad|' || l_orderkey END AS malformed_text,
    CASE WHEN NOT bad AND NOT (l_orderkey % 89 = 0 AND l_linenumber = 1) THEN CAST(l_orderkey AS VARCHAR) END AS domain_id,
    CASE WHEN NOT bad THEN CASE WHEN l_linenumber = 7 THEN 'garbage' ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END END AS quantity,
    CASE WHEN NOT bad THEN CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) END AS price,
    CASE WHEN NOT bad THEN l_returnflag END AS flag,
    CASE WHEN NOT bad THEN CASE WHEN l_orderkey % 53 = 0 THEN '2024-02-30' ELSE strftime(l_shipdate, '%Y-%m-%d') END END AS shipdate,
    CASE WHEN NOT bad THEN CASE WHEN l_orderkey % 61 = 0 THEN l_linestatus || chr(10) ELSE l_linestatus END END AS status,
    CASE WHEN NOT bad AND l_orderkey % 101 = 0 THEN 'x' || chr(65533) WHEN NOT bad THEN 'plain' END AS note
  FROM (SELECT *, l_orderkey % 97 = 0 AS bad FROM lineitem)),
typed AS (
  SELECT *, CASE WHEN regexp_full_match(quantity, '[+-]?[0-9]+') THEN try_cast(quantity AS INTEGER) END AS q,
    try_cast(price AS DECIMAL(12,2)) AS p, CAST(try_strptime(shipdate, '%Y-%m-%d') AS DATE) AS s FROM raw),
seen AS (
  SELECT *, list_filter([
    CASE WHEN malformed_text IS NOT NULL THEN {'code': 'unreadable/malformed-row', 'col': NULL, 'expected': 'record(width=6)'} END,
    CASE WHEN note LIKE '%' || chr(65533) || '%' THEN {'code': 'unreadable/encoding-suspect', 'col': NULL, 'expected': 'no-replacement-char'} END,
    CASE WHEN quantity IS NOT NULL AND q IS NULL THEN {'code': 'contract/cast-failure', 'col': 'quantity', 'expected': 'int'} END,
    CASE WHEN price IS NOT NULL AND p IS NULL THEN {'code': 'contract/cast-failure', 'col': 'price', 'expected': 'decimal(12,2)'} END,
    CASE WHEN shipdate IS NOT NULL AND s IS NULL THEN {'code': 'contract/cast-failure', 'col': 'shipdate', 'expected': 'date(yyyy-MM-dd)'} END,
    CASE WHEN domain_id IS NULL THEN {'code': 'contract/null-violation', 'col': 'domain_id', 'expected': 'non-null'} END,
    CASE WHEN flag NOT IN ('A', 'N') THEN {'code': 'contract/value-not-allowed', 'col': 'flag', 'expected': 'allowed-values'} END,
    CASE WHEN status IS NOT NULL AND status NOT IN ('O', 'F') THEN {'code': 'contract/pattern-mismatch', 'col': 'status', 'expected': 'pattern'} END,
    CASE WHEN q < 2 OR q > 45 THEN {'code': 'contract/out-of-bounds', 'col': 'quantity', 'expected': 'bounds'} END,
    CASE WHEN p > 50000.00 THEN {'code': 'contract/out-of-bounds', 'col': 'price', 'expected': 'bounds'} END,
    CASE WHEN s < DATE '1992-06-01' THEN {'code': 'contract/out-of-bounds', 'col': 'shipdate', 'expected': 'bounds'} END
  ], lambda x: x IS NOT NULL) AS f FROM typed)
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    key, n = F.col("l_orderkey"), F.col("l_linenumber")
    bad = key % 97 == 0
    cell = lambda c: F.when(~bad, c)
    return table(spark, sf_dir, "lineitem").select(
        F.concat(F.lit("lineitem/"), (key % 7).cast("string")).alias("source_uri"), (key % 7 + 1).cast("int").alias("object_seq"), (key * 10 + n).cast("long").alias("row_index"),
        F.when(bad, F.concat(F.lit("bad|"), key.cast("string"))).alias("malformed_text"),
        cell(F.when(~((key % 89 == 0) & (n == 1)), key.cast("string"))).alias("domain_id"),
        cell(F.when(n == 7, F.lit("garbage")).otherwise(F.col("l_quantity").cast("int").cast("string"))).alias("quantity"),
        cell(F.col("l_extendedprice").cast("decimal(12,2)").cast("string")).alias("price"),
        cell(F.col("l_returnflag")).alias("flag"),
        cell(F.when(key % 53 == 0, F.lit("2024-02-30")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))).alias("shipdate"),
        cell(F.when(key % 61 == 0, F.concat("l_linestatus", F.lit("\n"))).otherwise(F.col("l_linestatus"))).alias("status"),
        F.when(bad, F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<string>"))).otherwise(F.create_map(F.lit("note"), F.when(key % 101 == 0, F.lit("x�")).otherwise(F.lit("plain")))).alias("extras"),
    )


def landed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows as a stored table, which is what checks see in the lane."""
    return durable(raw_lineitem(spark, sf_dir), "raw")


def _raw(spark, sf_dir):
    return landed(spark, sf_dir), checks.compile_contract(CONTRACT)


def admission_valid(spark, sf_dir):
    rows = checks.admitted(*_raw(spark, sf_dir), ("row_index",))
    return rows.withColumns({"price": F.col("price").cast("string"), "shipdate": F.col("shipdate").cast("string")})


def admission_violations(spark, sf_dir):
    return checks.violations(*_raw(spark, sf_dir)).groupBy("reason_code").agg(F.count(F.lit(1)).alias("n"), F.min("row_index").alias("first_row"))


def admission_reason_detail(spark, sf_dir):
    return checks.violations(*_raw(spark, sf_dir)).select("row_index", "reason_code", "reason_detail")


def admission_counts(spark, sf_dir):
    return checks.counts(*_raw(spark, sf_dir))


def encoding_suspect(spark, sf_dir):
    return checks.violations(*_raw(spark, sf_dir)).where("reason_code = 'unreadable/encoding-suspect'").select("row_index", "reason_detail")


def pattern_fullmatch(spark, sf_dir):
    t = table(spark, sf_dir, "part")
    return t.select("p_partkey", casts.full_match(F.col("p_brand"), "Brand#[1-3]\\d?").alias("brand_ok"), casts.full_match(F.concat("p_brand", F.lit("\n")), "Brand#.*").alias("with_line_end"))


def allowed_values(spark, sf_dir):
    c = RawContract((DeclaredColumn("status", allowed_values=("F", "O")), DeclaredColumn("priority", allowed_values=("1-URGENT", "2-HIGH"))))
    rows = table(spark, sf_dir, "orders").select(F.col("o_orderkey"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"), F.lit(None).cast("string").alias("malformed_text"), F.create_map(F.lit("k"), F.lit("v")).alias("extras"))
    return checks.violations(rows, checks.compile_contract(c)).select("o_orderkey", "reason_code", "reason_detail")


def bounds(spark, sf_dir):
    c = RawContract((DeclaredColumn("size", "int", min="5", max="40"), DeclaredColumn("price", "decimal(10,2)", min="1000.00")))
    rows = table(spark, sf_dir, "part").select("p_partkey", F.col("p_size").cast("string").alias("size"), F.col("p_retailprice").cast("decimal(10,2)").cast("string").alias("price"), F.lit(None).cast("string").alias("malformed_text"), F.create_map(F.lit("k"), F.lit("v")).alias("extras"))
    return checks.violations(rows, checks.compile_contract(c)).select("p_partkey", "reason_detail")


def _cast(name, kind, text):
    def query(spark, sf_dir):
        rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", text().alias("raw"))
        value = casts.typed(F.col("raw"), ColumnType.parse(kind))
        return rows.select("l_orderkey", "l_linenumber", "raw", value.cast("string").alias("value"))

    query.__name__ = name
    return query


_N = F.col


def _int_text():
    n = _N("l_linenumber")
    return F.when(n == 1, F.concat(F.lit(" "), _N("l_quantity").cast("int").cast("string"), F.lit(" "))).when(n == 2, F.lit("007")).when(n == 3, F.lit("1.5")).when(n == 4, F.lit("1e2")).when(n == 5, F.lit("99999999999")).when(n == 6, F.lit("")).otherwise(_N("l_orderkey").cast("string"))


def _decimal_text():
    n = _N("l_linenumber")
    return F.when(n == 1, F.lit("1.239")).when(n == 2, F.lit("1.245")).when(n == 3, F.lit("9999.99")).when(n == 4, F.lit("x")).otherwise(_N("l_discount").cast("decimal(5,2)").cast("string"))


def _bool_text():
    return F.element_at(F.array(*map(F.lit, ("t", "F", "yes", "no", "1", "0", "maybe"))), _N("l_linenumber"))


def _date_text():
    n = _N("l_linenumber")
    return F.when(n == 1, F.lit("2024-02-30")).when(n == 2, F.lit("2024-2-3")).when(n == 3, F.lit("")).otherwise(F.date_format("l_shipdate", "yyyy-MM-dd"))


def lineage_stamp(spark, sf_dir):
    rows = lineage.stamp(table(spark, sf_dir, "orders").select("o_orderkey"), LINEAGE, "v1")
    return rows.withColumn("received_at", F.date_format("received_at", "yyyy-MM-dd HH:mm:ss"))


def bag_subtract(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", F.col("l_linenumber"), F.when(F.col("l_linenumber") > 3, F.col("l_suppkey")).alias("supp"))
    left = subtract.bag_subtract(rows, rows.where("l_linenumber % 2 = 0 and coalesce(supp, 0) % 2 = 0"))
    return left.groupBy("l_returnflag", "l_linenumber").agg(F.count(F.lit(1)).alias("n"), F.count("supp").alias("with_supp"))


def hash_subtract(spark, sf_dir):
    rows = quarantine.candidate_hashes(table(spark, sf_dir, "orders").select("o_custkey", "o_orderstatus"))
    return subtract.hash_subtract(rows, rows.where("o_orderstatus = 'F'")).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.min("row_hash").alias("first_hash"))


def locator_subtract(spark, sf_dir):
    raw = landed(spark, sf_dir)
    return subtract.locator_subtract(raw, raw.where("quantity = 'garbage'")).groupBy("source_uri").agg(F.count(F.lit(1)).alias("n"), F.sum("row_index").alias("rows"))


def drift_probe(spark, sf_dir):
    raw, compiled = _raw(spark, sf_dir)
    refused = checks.violations(raw, compiled)
    durable = raw.where("row_index % 3 = 0")
    left = subtract.locator_subtract(raw, durable).where(checks.any_cast_failure(compiled))
    return subtract.drift(durable, refused, left)


def touched_state_slice(spark, sf_dir):
    return subtract.touched_slice(table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "domain"), table(spark, sf_dir, "orders").where("o_totalprice > 100000").withColumnRenamed("o_custkey", "domain"), "domain").select("domain", "c_name")


def quarantine_pre(spark, sf_dir):
    refused = checks.violations(*_raw(spark, sf_dir))
    return quarantine.pre_check(refused, LINEAGE, "cv", NOW).select("row_index", "check_stage", "reason_code", "domain_id", "row_hash", "row_snapshot")


def quarantine_post(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("domain_id"), "o_orderkey", F.concat(F.lit("business/status-"), F.lower("o_orderstatus")).alias("reason"))
    return quarantine.post_check(rows, LINEAGE, "cv", NOW, "domain_id").select("domain_id", "check_stage", "reason_code", "row_hash", "row_snapshot", F.col("object_seq").isNull().alias("no_locator"))


def business_reasons(spark, sf_dir):
    e = table(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("business/"), "event_type")).when(F.col("event_id") % 3 == 1, F.lit("Business/x")).alias("reason"))
    return quarantine.bad_reasons(e).select("event_id", F.coalesce("reason", F.lit("none")).alias("reason"))


def canonical_json_hash(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", F.col("c_acctbal").cast("decimal(12,2)").alias("balance"), F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit('q"\t\\'), "c_mktsegment")).alias("seg"))
    snapshot = canonical.row_snapshot(rows)
    return rows.select("c_custkey", snapshot.alias("snapshot"), canonical.row_hash(snapshot).alias("row_hash"))


def canonical_temporal(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderdate").cast("timestamp").alias("at"), F.to_date("o_orderdate").alias("day"), F.create_map(F.lit("z"), F.col("o_orderstatus"), F.lit("a"), F.lit(None).cast("string")).alias("m"))
    return rows.select("o_orderkey", canonical.row_snapshot(rows).alias("snapshot"))


def csv_tokenize(spark, sf_dir):
    """Whole texts as quoted fields, line breaks included."""
    line = F.concat_ws(",", F.col("conv_id").cast("string"), "role", F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"')))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", line.alias("line"))
    t = X.tokens(F.col("line"))
    return rows.select("conv_id", "turn", F.size(t).alias("fields"), F.get(t, F.lit(1)).alias("role"), F.get(t, F.lit(2)).alias("body"))


def csv_malformed(spark, sf_dir):
    n = F.col("event_id") % 6
    line = F.when(n == 0, F.lit('a,"open')).when(n == 1, F.lit('a,"x"y')).when(n == 2, F.lit('a,"x ""y"" z",')).when(n == 3, F.lit("")).when(n == 4, F.concat(F.lit('a,b"c,'), "event_type")).otherwise(F.lit("a,,"))
    rows = table(spark, sf_dir, "events").select("event_id", line.alias("line"))
    ok = X.well_formed(F.col("line"))
    return rows.select("event_id", ok.alias("ok"), F.when(ok, F.size(X.tokens(F.col("line")))).otherwise(-1).alias("fields"))


QUERIES = [
    admission_valid, admission_violations, admission_reason_detail, admission_counts, encoding_suspect, pattern_fullmatch, allowed_values, bounds,
    _cast("cast_int", "int", _int_text), _cast("cast_decimal", "decimal(5,2)", _decimal_text), _cast("cast_bool", "bool", _bool_text), _cast("cast_date", "date(yyyy-MM-dd)", _date_text),
    lineage_stamp, bag_subtract, hash_subtract, locator_subtract, drift_probe, touched_state_slice, quarantine_pre, quarantine_post, business_reasons, canonical_json_hash, canonical_temporal,
    csv_tokenize, csv_malformed,
]

_DETAIL = """'[' || array_to_string(list_transform({f}, lambda x: '{{"code":"' || x.code || '",' || CASE WHEN x.col IS NULL THEN '' ELSE '"column":"' || x.col || '",' END || '"expected":"' || x.expected || '"}}'), ',') || ']'"""
_W = "WITH " + RAW_SQL
_Q = """'"' || replace(replace(replace({0}, chr(92), chr(92) || chr(92)), '"', chr(92) || '"'), chr(10), chr(92) || 'n') || '"'"""


def _js(x: str) -> str:
    return "coalesce(" + _Q.format(x) + ", 'null')"


_SNAP = " || ".join(
    ["'{\"domain_id\":'", _js("domain_id"), "',\"extras\":'", "CASE WHEN note IS NULL THEN '{}' ELSE '{\"note\":\"' || note || '\"}' END", "',\"flag\":'", _js("flag"), "',\"malformed_text\":'", _js("malformed_text"), "',\"price\":'", _js("price"), "',\"quantity\":'", _js("quantity"), "',\"shipdate\":'", _js("shipdate"), "',\"status\":'", _js("status"), "'}'"]
)
_ONE = "'[{\"code\":\"{0}\",\"column\":\"{1}\",\"expected\":\"{2}\"}]'"


def _entry(code: str, column: str, expected: str) -> str:
    return f"""'{{"code":"{code}","column":"{column}","expected":"{expected}"}}'"""


SQL = {
    "admission_valid": _W + "SELECT row_index, domain_id, q AS quantity, CAST(p AS VARCHAR) AS price, flag, CAST(s AS VARCHAR) AS shipdate, status FROM seen WHERE len(f) = 0",
    "admission_violations": _W + "SELECT f[1].code AS reason_code, count(*) AS n, min(row_index) AS first_row FROM seen WHERE len(f) > 0 GROUP BY 1",
    "admission_reason_detail": _W + f"SELECT row_index, f[1].code AS reason_code, {_DETAIL.format(f='f')} AS reason_detail FROM seen WHERE len(f) > 0",
    "admission_counts": _W + "SELECT count(*) AS candidate, count_if(len(f) = 0) AS admitted, count_if(len(f) > 0) AS refused FROM seen",
    "encoding_suspect": _W + f"SELECT row_index, {_DETAIL.format(f='f')} AS reason_detail FROM seen WHERE f[1].code = 'unreadable/encoding-suspect'",
    "pattern_fullmatch": "SELECT p_partkey, regexp_full_match(p_brand, 'Brand#[1-3][0-9]?') AS brand_ok, false AS with_line_end FROM part",
    "allowed_values": f"""
WITH r AS (SELECT o_orderkey, list_filter([CASE WHEN o_orderstatus NOT IN ('F', 'O') THEN {_entry("contract/value-not-allowed", "status", "allowed-values")} END,
  CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN {_entry("contract/value-not-allowed", "priority", "allowed-values")} END], lambda x: x IS NOT NULL) AS f FROM orders)
SELECT o_orderkey, 'contract/value-not-allowed' AS reason_code, '[' || array_to_string(f, ',') || ']' AS reason_detail FROM r WHERE len(f) > 0""",
    "bounds": f"""
WITH r AS (SELECT p_partkey, list_filter([CASE WHEN p_size NOT BETWEEN 5 AND 40 THEN {_entry("contract/out-of-bounds", "size", "bounds")} END,
  CASE WHEN CAST(p_retailprice AS DECIMAL(10,2)) < 1000 THEN {_entry("contract/out-of-bounds", "price", "bounds")} END], lambda x: x IS NOT NULL) AS f FROM part)
SELECT p_partkey, '[' || array_to_string(f, ',') || ']' AS reason_detail FROM r WHERE len(f) > 0""",
    "cast_int": """
WITH r AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN ' ' || CAST(l_quantity AS INTEGER) || ' ' WHEN 2 THEN '007' WHEN 3 THEN '1.5' WHEN 4 THEN '1e2'
  WHEN 5 THEN '99999999999' WHEN 6 THEN '' ELSE CAST(l_orderkey AS VARCHAR) END AS raw FROM lineitem)
SELECT *, CAST(CASE WHEN regexp_full_match(trim(raw), '[+-]?[0-9]+') THEN try_cast(trim(raw) AS INTEGER) END AS VARCHAR) AS value FROM r""",
    "cast_decimal": """
WITH r AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN '1.239' WHEN 2 THEN '1.245' WHEN 3 THEN '9999.99' WHEN 4 THEN 'x'
  ELSE CAST(CAST(l_discount AS DECIMAL(5,2)) AS VARCHAR) END AS raw FROM lineitem)
SELECT *, CAST(try_cast(raw AS DECIMAL(5,2)) AS VARCHAR) AS value FROM r""",
    "cast_bool": """
WITH r AS (SELECT l_orderkey, l_linenumber, ['t', 'F', 'yes', 'no', '1', '0', 'maybe'][l_linenumber] AS raw FROM lineitem)
SELECT *, CASE WHEN lower(raw) IN ('t', 'yes', '1') THEN 'true' WHEN lower(raw) IN ('f', 'no', '0') THEN 'false' END AS value FROM r""",
    "cast_date": """
WITH r AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber WHEN 1 THEN '2024-02-30' WHEN 2 THEN '2024-2-3' WHEN 3 THEN '' ELSE strftime(l_shipdate, '%Y-%m-%d') END AS raw FROM lineitem)
SELECT *, CASE WHEN l_linenumber > 3 THEN raw END AS value FROM r""",
    "lineage_stamp": "SELECT o_orderkey, 'b-1' AS batch_id, 'd-1' AS delivery_id, 'feed/lineitem' AS feed_id, '2026-01-01 00:00:00' AS received_at, 'v1' AS read_spec_version FROM orders",
    "bag_subtract": """
WITH r AS (SELECT l_returnflag, l_linenumber, CASE WHEN l_linenumber > 3 THEN l_suppkey END AS supp FROM lineitem),
x AS (SELECT * FROM r EXCEPT ALL SELECT * FROM r WHERE l_linenumber % 2 = 0 AND coalesce(supp, 0) % 2 = 0)
SELECT l_returnflag, l_linenumber, count(*) AS n, count(supp) AS with_supp FROM x GROUP BY 1, 2""",
    "hash_subtract": """
WITH r AS (SELECT o_orderstatus, sha256('{"o_custkey":' || o_custkey || ',"o_orderstatus":"' || o_orderstatus || '"}') AS h FROM orders)
SELECT o_orderstatus, count(*) AS n, min(h) AS first_hash FROM r WHERE o_orderstatus <> 'F' GROUP BY 1""",
    "locator_subtract": _W + """SELECT source_uri, count(*) AS n, CAST(sum(row_index) AS BIGINT) AS rows FROM raw r WHERE malformed_text IS NULL
  AND NOT EXISTS (SELECT 1 FROM raw g WHERE g.quantity = 'garbage' AND g.source_uri = r.source_uri AND g.object_seq = r.object_seq AND g.row_index = r.row_index) GROUP BY 1""",
    "drift_probe": _W + """, d AS (SELECT row_index FROM raw WHERE row_index % 3 = 0), v AS (SELECT row_index FROM seen WHERE len(f) > 0)
SELECT count_if(d.row_index IS NOT NULL) AS durable, count_if(v.row_index IS NOT NULL) AS recomputed, count_if(v.row_index IS NULL) AS only_durable, count_if(d.row_index IS NULL) AS only_recomputed,
  (SELECT count(*) FROM seen WHERE malformed_text IS NULL AND row_index % 3 <> 0 AND len(list_filter(f, lambda x: x.code = 'contract/cast-failure')) > 0) AS admitted_cast_failures
FROM d FULL JOIN v ON d.row_index = v.row_index""",
    "touched_state_slice": "SELECT c_custkey AS domain, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 100000)",
    "quarantine_pre": _W + f"""SELECT row_index, 'pre_check' AS check_stage, f[1].code AS reason_code, CAST(NULL AS VARCHAR) AS domain_id, sha256({_SNAP}) AS row_hash, {_SNAP} AS row_snapshot FROM seen WHERE len(f) > 0""",
    "quarantine_post": """
WITH r AS (SELECT CAST(o_custkey AS VARCHAR) AS domain_id, '{"domain_id":' || o_custkey || ',"o_orderkey":' || o_orderkey || '}' AS s, 'business/status-' || lower(o_orderstatus) AS c FROM orders)
SELECT domain_id, 'post_check' AS check_stage, c AS reason_code, sha256(s) AS row_hash, s AS row_snapshot, true AS no_locator FROM r""",
    "business_reasons": """
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN 'business/' || event_type WHEN event_id % 3 = 1 THEN 'Business/x' ELSE 'none' END AS reason FROM events
WHERE event_id % 3 > 0 OR NOT regexp_full_match('business/' || event_type, 'business/[a-z0-9][a-z0-9-]*')""",
    "canonical_json_hash": """
WITH r AS (SELECT c_custkey, '{"balance":"' || CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) || '","c_custkey":' || c_custkey || ',"c_name":"' || c_name || '","seg":'
  || CASE WHEN c_custkey % 2 = 0 THEN '"q' || chr(92) || '"' || chr(92) || 't' || chr(92) || chr(92) || c_mktsegment || '"' ELSE 'null' END || '}' AS s FROM customer)
SELECT c_custkey, s AS snapshot, sha256(s) AS row_hash FROM r""",
    "canonical_temporal": """SELECT o_orderkey, '{"at":"' || strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S.%fZ') || '","day":"' || strftime(o_orderdate, '%Y-%m-%d') || '","m":{"a":null,"z":"' || o_orderstatus || '"},"o_orderkey":' || o_orderkey || '}' AS snapshot FROM orders""",
    "csv_tokenize": """SELECT conv_id, turn, 3 AS fields, role, text AS body FROM conversations""",
    "csv_malformed": """SELECT event_id, event_id % 6 NOT IN (0, 1) AS ok, CASE event_id % 6 WHEN 0 THEN -1 WHEN 1 THEN -1 WHEN 2 THEN 3 WHEN 3 THEN 0 ELSE 3 END AS fields FROM events""",
}
