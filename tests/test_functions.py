"""Column helpers on hand-made edge rows."""

import re
from datetime import date

from conftest import rows
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from pricewright import values
from pricewright.functions import codes, dates, numbers, text


def one(spark, value, kind, expr):
    return spark.createDataFrame([(value,)], f"c {kind}").select(expr).first()[0]


def test_norm_key_folds_accents_and_punctuation(spark):
    assert one(spark, "  São João d'Água-Branca ", "string", text.norm_key("c")) == "SAOJOAODAGUABRANCA"
    assert one(spark, "a/b`c  d", "string", text.norm_key("c")) == "ABCD"
    assert one(spark, None, "string", text.norm_key("c")) is None
    assert one(spark, "Água Fria", "string", text.norm_key("c", fold=False, strip=" ")) == "ÁGUAFRIA"


def test_codes_lose_leading_zeros_and_letters_are_null(spark):
    df = spark.createDataFrame([("000123",), ("12A",), (None,), (" 7 ",)], "c string")
    assert [r[0] for r in df.select(text.code_int("c")).collect()] == [123, None, None, 7]
    nine = spark.createDataFrame([("0123456789",), ("123456789",), ("12345678",), ("ABC456789",), (None,)], "c string")
    assert [r[0] for r in nine.select(text.has_digits("c", 9)).collect()] == [True, True, False, False, False]


def test_contains_any_takes_underscore_literally(spark):
    df = spark.createDataFrame([("CORTE_DOBRA",), ("CORTEXDOBRA",), ("X CORTE_DOBRA Y",), ("B&P",), (None,)], "c string")
    got = [r[0] for r in df.select(text.contains_any("c", ["CORTE_DOBRA", "B&P"])).collect()]
    assert got == [True, False, True, True, None]


def test_contains_any_equals_a_chain_of_tests(spark):
    names = [f"x {n} y" for n in values.PRODUCT_GROUPS] + ["BR", "", "BR-", "OTHER"]
    df = spark.createDataFrame([(n,) for n in names], "c string")
    got = {r[0]: r[1] for r in df.select("c", text.contains_any("c", values.PRODUCT_GROUPS)).collect()}
    assert got == {n: any(t in n for t in values.PRODUCT_GROUPS) for n in names}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text("AB-.", min_size=1, max_size=4), min_size=1, max_size=6), st.text("AB-. ", max_size=10))
def test_minimal_terms_never_change_a_match(terms, sample):
    kept = text.minimal_terms(terms)
    assert any(t in sample for t in terms) == any(t in sample for t in kept)
    assert re.search("|".join(map(re.escape, kept)), sample) is not None or not any(t in sample for t in terms)


def test_numbers(spark):
    df = spark.createDataFrame([(" 1 234,50 ",), ("7.5",), ("x",), ("",), (None,)], "c string")
    assert [r[0] for r in df.select(numbers.parse_number("c")).collect()] == [1234.5, 7.5, None, None, None]
    assert one(spark, 0.0, "double", numbers.ratio(F.lit(1.0), "c")) is None
    pair = spark.createDataFrame([(1.0, 2.0), (None, 3.0)], "a double, b double")
    assert [r[0] for r in pair.select(numbers.signed_sum("-a +b -b")).collect()] == [-1.0, None]


def test_total_does_not_depend_on_order(spark):
    values_ = [0.1, 1e8, -1e8, 0.2, 0.3, 123456.789012] * 50
    a = spark.createDataFrame([(v,) for v in values_], "v double").repartition(7)
    b = spark.createDataFrame([(v,) for v in reversed(values_)], "v double").repartition(3)
    assert a.agg(numbers.total("v")).first()[0] == b.agg(numbers.total("v")).first()[0]


def test_remap_default_group_and_channel(spark):
    df = spark.createDataFrame([("BRCO",), ("BRCG",), (None,)], "c string")
    assert [r[0] for r in df.select(codes.remap_codes("c")).collect()] == ["BRCC", "BRCG", None]
    assert [r[0] for r in df.select(codes.default_label("c", "x")).collect()] == ["BRCO", "BRCG", "x"]
    groups = spark.createDataFrame([(None, "A"), (values.GENERIC_CUSTOMER_GROUP, "B"), ("G", "C")], "g string, n string")
    assert [r[0] for r in groups.select(codes.customer_group("g", "n")).collect()] == ["A", "B", "G"]
    orgs = spark.createDataFrame([("BRCC",), ("BRCG",), ("BRDI",)], "c string")
    labels = [r[0] for r in orgs.select(codes.channel_label(codes.price_type("c"))).collect()]
    assert labels == [
        "Sell-in 1: Usina-Construtora/Industria", "Sell-in 2: Distribuição-Revenda", "Sell-in 1: Usina-Distribuição",
    ]


def test_short_org(spark):
    df = spark.createDataFrame(
        [("BRCC", "x", "1"), ("BRDO", "x", "1"), ("BRIN", "x", "1"), (None, "xDI", "1"), (None, None, "1"), ("BRIN", "x", "A61")],
        "o string, f string, a string",
    )
    assert [r[0] for r in df.select(codes.short_org("o", "f", "a")).collect()] == ["CC", "DI", "IN", "DI", "CC", "DI"]


def test_display_key_is_null_with_a_null_part(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert [r[0] for r in df.select(text.display_key("x", "y")).collect()] == ["a_b", None]


def test_strip_dashes(spark):
    assert one(spark, "ACO --- CA50 -- 10-MM", "string", text.strip_dashes("c")) == "ACO  CA50  10-MM"


def test_dates(spark):
    layouts = [("2019.05.13", "yyyy/MM/dd"), ("2019-05-13 10:11:12", "yyyy/MM/dd"), ("13/05/2019", "dd/MM/yyyy"), ("20190513", "yyyyMMdd")]
    for value, fmt in layouts:
        assert one(spark, value, "string", dates.parse_date("c", fmt)) == date(2019, 5, 13)
    assert one(spark, "31/31/2019", "string", dates.parse_date("c", "dd/MM/yyyy")) is None
    assert one(spark, date(2019, 7, 1), "date", dates.month_label("c")) == "07-2019"


def test_iso_week_at_the_year_ends(spark):
    days = [date(2018, 12, 31), date(2019, 1, 1), date(2021, 1, 1), date(2021, 1, 3), date(2020, 12, 29)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = rows(df.select(dates.iso_year("d"), dates.iso_week("d")))
    assert got == [tuple(d.isocalendar()[:2]) for d in days]


def test_month_progress_edges(spark):
    days = [date(2020, 2, 1), date(2020, 2, 29), date(2020, 1, 31), date(2019, 2, 5)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    got = rows(df.select(dates.days_elapsed("d", "2020-02-10"), dates.days_remaining("d", "2020-02-10")))
    assert got == [(9, 20), (9, 20), (31, 0), (28, 0)]


def test_totals_are_exact_and_independent_of_order(spark):
    """Totals beyond 1e13 and means with ten digits, bit-equal under three partitionings."""
    rows = spark.range(200_000).selectExpr(
        "id % 3 AS k", "cast(pmod(id * 7919, 99991) * 1234.567891 + 90000000 AS double) AS v", "1D / (id + 1) AS w"
    )
    got = set()
    for n in (1, 7, 64):
        out = rows.repartition(n).groupBy("k").agg(
            numbers.total("v").alias("v"), numbers.exact_mean("w", 10).alias("m"), numbers.total(-F.col("v")).alias("minus")
        ).orderBy("k").collect()
        got.add(tuple((r.v, r.m, r.minus) for r in out))
    assert len(got) == 1
    want = rows.groupBy("k").agg(F.sum(F.rint(F.col("v") * 1e6).cast("decimal(20,0)")).alias("u")).orderBy("k").collect()
    for (v, _, minus), r in zip(next(iter(got)), want):
        assert v == float(r.u) / 1e6 and minus == -v and v > 5e12


def test_totals_of_large_and_bad_values(spark):
    rows = spark.createDataFrame([(9e15,), (9e15,), (0.25,), (float("nan"),), (None,)], "v double")
    assert rows.agg(numbers.total("v")).first()[0] == 1.8e16
    assert rows.where("v IS NULL").agg(numbers.total("v")).first()[0] is None


def test_pad_code_keeps_the_end(spark):
    rows = spark.createDataFrame([("123456789",), ("12345678901",), ("12",)], "c string")
    assert [r[0] for r in rows.select(text.pad_code("c")).collect()] == ["0123456789", "2345678901", "012"]


def test_parse_time_keeps_the_time_of_day(spark):
    rows = spark.createDataFrame([("2020-01-02 20:00:01",), ("2020/01/02",), ("2020.01.02T08:00:00",), ("x",)], "c string")
    got = [str(r[0]) for r in rows.select(dates.parse_time("c")).collect()]
    assert got == ["2020-01-02 20:00:01", "2020-01-02 00:00:00", "2020-01-02 08:00:00", "None"]


def test_deviation_has_the_same_bits_at_every_partitioning(spark):
    import random
    import statistics
    from fractions import Fraction

    rng = random.Random(4)
    values = {k: [base + round(rng.uniform(-1, 1), 6) for _ in range(500)] for k, base in enumerate([0, 1e9, -1e9, 7.5, -0.001])}
    values |= {10: [3.25], 11: [], 12: [2.0, 2.0, 2.0], 13: [1e-6, 0.0], 14: [float("nan"), 1.0, 2.0], 15: [-1.0, 1.0], 16: [9e9, 9e9 + 1e-6]}
    data = [(k, v) for k, vs in values.items() for v in vs] + [(11, None)]
    seen = set()
    for parts in (1, 3, 7, 16):
        rng.shuffle(data)
        df = spark.createDataFrame(data, "k int, v double").repartition(parts)
        got = df.groupBy("k").agg(*[a.alias(n) for n, a in numbers.moments("v").items()])
        seen.add(tuple(sorted((r.k, r.d) for r in got.select("k", numbers.sample_deviation("n", "s1", "s2").alias("d")).collect())))
    assert len(seen) == 1
    for k, d in seen.pop():
        own = [Fraction(round(v * 1e6), 10**6) for v in values[k] if v == v]
        if len(own) < 2:
            assert d is None
        else:
            want = float(statistics.variance(own)) ** 0.5
            assert abs(d - want) <= 1e-14 * max(want, 1e-9), (k, d, want)


def test_total_by_name_and_by_column_are_the_same(spark):
    data = [(1, 0.1), (1, -0.3), (1, None), (1, float("nan")), (2, 9e15), (2, 9e15), (2, 0.5), (3, -1e12), (3, -7.25), (4, None)]
    df = spark.createDataFrame(data, "k int, v double")
    for digits in (2, 6, 10):
        got = df.where("k <> 2 OR 6 >= " + str(digits)).groupBy("k").agg(numbers.total("v", digits).alias("a"), numbers.total(F.col("v"), digits).alias("b"))
        assert all(r.a == r.b for r in got.collect())
    assert spark.range(1).agg(numbers.total("id").alias("x")).schema == spark.range(1).agg(numbers.total(F.col("id")).alias("x")).schema
