import datetime as dt
import random
import re
from collections import Counter

import pytest

from tessera import errors
from tessera.sources import digests, tables

SCHEMA = "id long, name string, x double, at timestamp"
AT = dt.datetime(2026, 1, 1)


def some(seed, n=400):
    deal = random.Random(seed)
    return [(deal.choice([None, *range(30)]), deal.choice([None, "", "a", 'q"\n', "é"]), deal.choice([None, 0.5, float("inf"), 1e-9]), deal.choice([None, AT, AT + dt.timedelta(microseconds=1)])) for _ in range(n)]


def table(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def counted(df):
    return Counter({tuple(r)[:-2]: (r["n_first"], r["n_second"]) for r in df.collect()})


def by_hand(a, b):
    x, y = Counter(a), Counter(b)
    return {k: (x[k], y[k]) for k in {*x, *y} if x[k] != y[k]}


def test_differences_of_any_and_of_stored_tables(spark, tmp_path):
    a, b = some(1), some(2)
    hot = [(7, "hot", 1.0, AT)]
    a, b = a + hot * 500, b + hot * 501
    assert counted(digests.differences(table(spark, a), table(spark, b).select("x", "at", "name", "id"))) == by_hand(a, b)
    for k, rows in enumerate((a, b, a[::-1], [])):
        digests.write(table(spark, rows, 1 + k), f"{tmp_path}/{k}", 16)
    got = lambda i, k: counted(digests.stored_differences(spark, f"{tmp_path}/{i}", f"{tmp_path}/{k}"))
    assert got(0, 1) == by_hand(a, b) and got(0, 2) == {} and got(3, 3) == {}
    assert got(0, 3) == by_hand(a, []) and got(3, 1) == by_hand([], b)
    assert Counter(map(tuple, digests.read(spark, f"{tmp_path}/1").collect())) == Counter(b)
    digests.write(table(spark, b), f"{tmp_path}/other", 5)
    assert counted(digests.stored_differences(spark, f"{tmp_path}/0", f"{tmp_path}/other")) == by_hand(a, b)


def test_a_changed_row_is_found_in_its_buckets(spark, tmp_path):
    df = spark.range(50_000).selectExpr("id", "id % 7 AS k")
    digests.write(df, f"{tmp_path}/a", 64)
    digests.write(df.selectExpr("id", "CASE WHEN id = 31007 THEN 99 ELSE k END AS k"), f"{tmp_path}/b", 64)
    found = digests.stored_differences(spark, f"{tmp_path}/a", f"{tmp_path}/b")
    assert sorted(tuple(r) for r in found.collect()) == [(31007, 4, 1, 0), (31007, 99, 0, 1)]
    plan = found._jdf.queryExecution().executedPlan().toString()
    named = re.findall(r"PartitionFilters: \[_bucket#\d+ IN \((\d+,\d+)\)\]", plan)
    assert named and len(set(named)) == 1, plan  # two of 64 buckets, on both sides


def test_clashing_and_other_columns(spark, tmp_path):
    df = spark.range(3)
    with pytest.raises(errors.OutputError):
        digests.write(df.withColumnRenamed("id", "_times"), f"{tmp_path}/x")
    with pytest.raises(errors.OutputError):
        digests.differences(df, df.withColumnRenamed("id", "other"))
    assert tables.table_digest(df) == tables.table_digest(df.repartition(2))
