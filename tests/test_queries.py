"""Every query against its SQL on the smallest tables."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tessera.plans import queries

SF = "/root/testdata/sf0.001"
NAMES = sorted(k for k in entry.queries() if k.startswith("q_"))


@pytest.fixture(scope="module")
def oracle():
    c = duckdb.connect()
    for f in glob.glob(f"{SF}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS FROM '{f}'")
    return c


def table(df):
    df = df[sorted(df.columns)]
    df = df.astype(object).where(df.notna(), None)
    return list(df.columns), sorted(repr([x.item() if hasattr(x, "item") else x for x in r]) for r in df.itertuples(index=False))


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", NAMES)
def test_query(spark, oracle, name):
    got = table(entry.queries()[name](spark, SF).toPandas())
    sql = entry.oracle_sql().get(name)
    if sql:
        assert got == table(oracle.sql(sql).df())
    else:
        assert got[1]


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
def test_archive_in_a_store_that_only_spark_reads(spark, oracle, tmp_path, monkeypatch):
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.texts.link./shared", f"file://{tmp_path}")
    monkeypatch.setattr(queries, "shared_dir", lambda spark: "viewfs://texts/shared")
    assert table(entry.queries()["q_archive"](spark, SF).toPandas()) == table(oracle.sql(entry.oracle_sql()["q_archive"]).df())
