from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from siltworks.functions.casts import squash, strip, to_double, to_int, to_money, to_time
from siltworks.functions.measures import elapsed_days, mean_money, no_later_than, total


def values(df, column):
    return [r[0] for r in df.select(column).collect()]


def test_int_keeps_the_whole_part(texts):
    cases = {
        "40.0": 40, "12.7": 12, ".5": 0, "5.": 5, "-.5": 0, ".": 0, "1e3": None, "": None,
        "abc": None, "99999999999": None, " 7 ": 7, "\t7\n": 7, "+5": 5, "-3.9": -3,
        "1.2.3": None, "--1": None, "-": None, "2147483648": None, "-2147483648": -2147483648,
        "1_000": None, None: None,
    }
    assert values(texts("v", *[(c,) for c in cases]), to_int("v")) == list(cases.values())


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_casts_do_not_depend_on_ansi(spark, texts, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        row = texts("v", "x").select(to_int("v"), to_double("v"), to_money("v"), to_time("v"))
        assert tuple(row.first()) == (None, None, None, None)
        assert values(texts("v", "12.7"), to_int("v")) == [12]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_int_matches_the_permissive_cast(spark, texts):
    """The rule equals Spark's own cast with ANSI off on generated text."""
    import random

    random.seed(5)
    rows = ["".join(random.choices("0123456789+-. ex\t", k=random.randint(0, 6))) for _ in range(3000)]
    df = texts("v", *rows)
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        wrong = df.select("v", to_int("v").alias("a"), F.col("v").cast("int").alias("b"))
        assert wrong.filter(~F.col("a").eqNullSafe(F.col("b"))).collect() == []
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_money(texts):
    df = texts("v", "1.005", "-1.005", "123456789.99", "0.004", "n/a", "")
    assert values(df, to_money("v")) == [
        Decimal("1.01"), Decimal("-1.01"), None, Decimal("0.00"), None, None,
    ]


def test_double(texts):
    got = values(texts("v", "90.5", "x", "", "Infinity"), to_double("v"))
    assert got == [90.5, None, None, float("inf")]
    assert str(values(texts("v", "NaN"), to_double("v"))[0]) == "nan"


def test_time(texts):
    df = texts("v", "2017-10", "2017", "10/02/2017", "2017-02-30 00:00:00", "", "2017-10-02 10:56:33")
    assert values(df, to_time("v")) == [
        datetime(2017, 10, 1), datetime(2017, 1, 1), None, None, None,
        datetime(2017, 10, 2, 10, 56, 33),
    ]


def test_text(texts):
    df = texts("v", "  Sao PAULO ", None)
    assert values(df, squash("v")) == ["sao paulo", None]
    assert values(df, strip("v")) == ["Sao PAULO", None]


def test_elapsed_days_counts_whole_days(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (timestamp'2017-10-02 23:00:00', timestamp'2017-10-04 01:00:00'),"
        "(timestamp'2017-10-04 01:00:00', timestamp'2017-10-02 23:00:00'),"
        "(timestamp'2017-10-04 01:00:00', null) AS t(a, b)"
    )
    assert values(df, elapsed_days("a", "b")) == [1, -1, None]


def test_no_later_than(spark):
    df = spark.sql("SELECT * FROM VALUES (1, 1), (2, 1), (null, 1), (1, null), (0, 1) AS t(a, b)")
    assert values(df, no_later_than("a", "b")) == [True, False, False, False, True]


def test_mean_money_rounds_once(spark):
    df = spark.sql(
        "SELECT k, CAST(v AS DECIMAL(10,2)) v FROM VALUES "
        "('a', 0.01), ('a', 0.02), ('b', -0.01), ('b', -0.02), ('c', 1.00), ('c', 1.00), "
        "('c', 1.01), ('d', null) AS t(k, v)"
    )
    got = {r.k: r.m for r in df.groupBy("k").agg(mean_money("v").alias("m")).collect()}
    assert got == {"a": Decimal("0.02"), "b": Decimal("-0.02"), "c": Decimal("1.00"), "d": None}


def test_total_is_wide(spark):
    df = spark.sql("SELECT CAST(99999999.99 AS DECIMAL(10,2)) v FROM range(1000)")
    assert df.agg(total("v")).dtypes[0][1] == "decimal(38,2)"
    assert df.agg(total("v")).first()[0] == Decimal("99999999990.00")
