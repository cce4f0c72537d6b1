import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import names, values


def one(spark, expr, *args):
    df = spark.createDataFrame([tuple(args)], ", ".join(f"c{i} string" for i in range(len(args))))
    return df.select(expr(*[F.col(f"c{i}") for i in range(len(args))]).alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("name", "norm"),
    [
        ("ABC Holdings Group Limited", "abc"), ("Tech Corp UK Ltd", "tech"), ("A.B.C. Corp", "a b c"), ("Foo & Bar Ltd.", "foo bar"),
        ("Ltd", ""), ("", ""), ("snake_case Co", "snake_case"), ("Émile  Père\tSARL", "émile père sarl"), ("Cooper Co", "cooper"), ("coé", "coé"),
        ("private limited company", ""), ("Private  Limited Company", "private"),
    ],
)
def test_normalise(spark, name, norm):
    assert one(spark, names.normalise, name) == norm


def test_normalise_null_and_idempotence(spark):
    assert one(spark, names.normalise, None) == ""
    df = spark.createDataFrame([("The Ltd Group of PLC Things (UK)",)], "n string").withColumn("a", names.normalise(F.col("n"))).withColumn("b", names.normalise(F.col("a")))
    r = df.first()
    assert r["a"] == r["b"] == "the of things"


def test_trading_and_brackets(spark):
    assert one(spark, names.trading_name, "ABC Holdings T/A Tech Corp") == "Tech Corp"
    assert one(spark, names.trading_name, "ABC trading  as Foo") == "Foo"
    assert one(spark, names.trading_name, "ABC T/A") is None
    assert one(spark, names.bracketed, "Acme (Software) Ltd") == ["Acme  Ltd", "Software"]
    assert one(spark, names.bracketed, "Acme (UK)") == ["Acme"]
    assert one(spark, names.split_parts, "a - b / c|d | e") == ["a", "b", "c|d", "e"]


def test_variants(spark):
    assert one(spark, names.variants, "ABC Ltd T/A Tech Corp") == ["ABC Ltd T/A Tech Corp", "Tech Corp", "ABC Ltd"]
    assert one(spark, names.variants, "  ") == []
    assert one(spark, names.variants, "Acme (Acme) Ltd") == ["Acme (Acme) Ltd", "Acme  Ltd"]
    assert len(one(spark, names.variants, "a1 - b2 - c3 - d4 - e5 - f6")) == 5


def test_tokens_and_buckets(spark):
    assert one(spark, names.tokens, "Beta Acme b Acme Ltd") == ["acme", "beta"]
    assert [one(spark, names.bucket, t) for t in ("acme", "9lives", "éa", "", "_x")] == ["a", "0-9", "_", "_", "_"]


def plain_similarity(a, b):
    if not a or not b:
        return 0.0
    x, y = set(a.split(" ")), set(b.split(" "))
    shared = sum(min(a.count(c), b.count(c)) for c in set(a))
    return 0.6 * (len(x & y) / max(1, len(x | y))) + 0.4 * (shared / max(len(a), len(b)))


@given(st.lists(st.tuples(st.text("abcé😀 d", max_size=12), st.text("abcé😀 d", max_size=12)), min_size=1, max_size=30))
def _pairs(spark, rows):
    keys = [(" ".join(sorted(a.split())), " ".join(sorted(b.split()))) for a, b in rows]
    df = spark.createDataFrame(keys, "a string, b string").coalesce(1)
    got = [r["s"] for r in names.similarities(df, "a", "b", "s").collect()]
    assert got == pytest.approx([plain_similarity(a, b) for a, b in keys])


def test_similarity(spark):
    from hypothesis import settings

    settings(max_examples=5, deadline=None)(_pairs)(spark)
    assert one(spark, names.similarity, "Acme Ltd", "Acme Limited") == pytest.approx(1.0)


def test_values(spark):
    assert one(spark, values.slug, "Limited (Private) Company") == "limited-private-company"
    assert one(spark, values.slug, " -- ") == ""
    assert one(spark, values.parsed_date, "11/09/2012") == "2012-09-11"
    assert one(spark, values.parsed_date, "2012-09-11 ") == "2012-09-11"
    assert one(spark, values.parsed_date, "") == "" and one(spark, values.parsed_date, "2012") is None and one(spark, values.parsed_date, "31/02/2012") is None
    with pytest.raises(Exception, match="not a date"):
        one(spark, values.strict_date, "soon")
    assert one(spark, values.sic_codes, "62020 - IT", " ", "7 -8", "62020 - IT") == "62020;7 -8;62020"
    assert one(spark, values.sic_list, "62020; 1,,2;") == ["62020", "1", "2"]
    assert [one(spark, values.positive_int, x) for x in ("007", "0", "-1", "x", "12")] == [7, None, None, None, 12]
    assert one(spark, values.na_to_blank, "N/A") == "" and one(spark, values.na_to_blank, "Nil") == "Nil"
    assert one(spark, lambda a: values.cache_key("search", a), "acme").startswith("search:")
    assert one(spark, lambda a: values.snapshot_date(a, F.lit("2026-03-04").cast("timestamp")), "register-2026-02-06.csv") == "2026-02-06"
    import random

    r = random.Random(1)
    some = [r.random() * r.choice([1, 2, 100]) for _ in range(3000)] + [k / 32768 for k in range(200)] + [0.87655, 0.00005, 0.0, 1.0, 2.9999999999]
    got = spark.createDataFrame([(x,) for x in some], "x double").coalesce(1).select(values.round_half_even(F.col("x"))).collect()
    assert [x[0] for x in got] == [round(x, 4) for x in some]
    df = spark.createDataFrame([(n,) for n in (1, 10, 11, 50, 250, 251, 999, 1000, None)], "n int")
    assert [r[0] for r in df.select(values.size_band(F.col("n"))).collect()] == ["micro", "micro", "small", "small", "medium", "large", "large", "mega", "unknown"]


def test_strip_column(spark):
    texts = ["", " ", "a", " a", "a ", "a b", "\u00a0a", "a\u2003", "\ta\n", "\u00e9t\u00e9", "\u00e9 ", "x\x7f", "\x7f ", "\u2003", "~", "!", None]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", names.strip(F.col("t")).alias("a"), names.strip_column(F.col("t")).alias("b"))
    assert all(r["a"] == r["b"] for r in df.collect())
