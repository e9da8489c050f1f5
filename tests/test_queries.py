"""Registered queries that cover whole tables, against DuckDB and small fixtures."""

from collections import Counter

import duckdb
import pytest

import __spark_entry__
from weirgate.queries import flows

SF = "/root/testdata/sf0.001"


def by_sql(name, sf_dir=SF):
    with duckdb.connect() as db:
        db.execute("SET TimeZone = 'UTC'")
        for t in ("conversations", "orders", "events", "documents", "lineitem", "nation", "region", "customer"):
            db.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
        found = db.execute(__spark_entry__.oracle_sql()[name])
        names = [c[0] for c in found.description]
        return Counter(tuple(r[names.index(n)] for n in sorted(names)) for r in found.fetchall())


def rows(spark, name, sf_dir=SF):
    return Counter(tuple(r[n] for n in sorted(r.asDict())) for r in __spark_entry__.queries()[name](spark, sf_dir).collect())


def test_csv_tokenize_keeps_long_fields(spark, tmp_path):
    texts = ["x" * 59 + '",", "" and\nmore', '"', "", "a,b\r\n" * 40_000, '""' * 50_000 + "end"]
    spark.createDataFrame([(i, 0, "user", t) for i, t in enumerate(texts)], "conv_id long, turn int, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    got = __spark_entry__.queries()["csv_tokenize"](spark, str(tmp_path)).collect()
    assert sorted((r.conv_id, r.fields, r.role, r.body) for r in got) == [(i, 3, "user", t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("name", ["csv_tokenize", "state_merge", "quarantine_reasons", *(f.__name__ for f in flows.QUERIES)])
def test_whole_tables_equal_sql(spark, name):
    assert rows(spark, name) == by_sql(name)
