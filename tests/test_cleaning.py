import datetime

from pyspark.sql import functions as F

from panelwise.functions import cleaning, derive
from panelwise.operators import clean


def values(df, column):
    return [r[column] for r in df.collect()]


def test_numbers_from_text(rows):
    texts = ["1.5", " 2 ", "", "NA", "None", "nan", "1e3", "abc", "1.5d", "2F", None, "-999"]
    df = rows([(t,) for t in texts], "t string").select(cleaning.to_number(F.col("t")).alias("v"))
    assert values(df, "v") == [1.5, 2.0, None, None, None, None, 1000.0, None, None, None, None, -999.0]


def test_days(rows):
    days = rows([("20240229",), ("20230229",), ("20101301",), ("-999.0",), (None,)], "d string")
    df = days.select(cleaning.parse_day(F.col("d")).alias("v"))
    assert values(df, "v") == [datetime.date(2024, 2, 29), None, None, None, None]
    assert clean.with_day(days, "d").select("year", "month").collect() == [(2024, 2)]


def test_sentinels_drop_or_null(rows):
    df = rows([(20.0, 1.0), (-999.0, 1.0), (20.0, -999.0), (None, 1.0), (20.0, 0.0)], "temp double, precip double")
    assert clean.drop_sentinel_rows(df, "temp", "precip").count() == 2
    nulled = clean.null_sentinels(df, ["temp", "precip"])
    assert values(nulled, "temp") == [20.0, None, 20.0, None, 20.0]
    assert values(nulled, "precip") == [1.0, 1.0, None, 1.0, 0.0]


def test_validation_splits_all_rows(rows):
    df = rows([("2001", "KEN"), (" 2001 ", " UGA "), ("KEN", "2001"), ("20011", "KEN"), (None, "KEN"), ("2001", "KE1")], "y string, c string")
    valid, rejected = clean.split_valid(df, "y", "c")
    assert [tuple(r) for r in valid.collect()] == [("2001", "KEN"), ("2001", "UGA")]
    assert rejected.count() == 4


def test_names_and_fallback(rows):
    df = rows([(1, 2.0)], "`Cases (Total)` int, `Incidence per 1000` double")
    named = clean.normalize_names(df)
    assert named.columns == ["cases_total", "incidence_per_1000"]
    assert clean.first_present(named, ["incidence"], parts=["incidence", "1000"]) == "incidence_per_1000"
    assert clean.numeric_columns(named, exclude=["cases_total"]) == ["incidence_per_1000"]


def test_rounding_modes(rows):
    df = rows([(0.125, 2.5)], "a double, b double")
    assert tuple(clean.round_columns(df, 2).first()) == (0.13, 2.5)
    assert tuple(clean.round_columns(df, 0, half_even=True).first()) == (0.0, 2.0)


def test_bands_at_their_limits(rows):
    df = rows([(49.99,), (50.0,), (80.0,), (120.0,), (None,)], "v double")
    assert values(df.select(derive.risk_band(F.col("v")).alias("b")), "b") == ["LOW", "MODERATE", "HIGH", "VERY HIGH", None]
    res = rows([(-5.0,), (-4.9,), (5.0,), (5.1,), (None,)], "v double")
    assert values(res.select(derive.residual_band(F.col("v")).alias("b")), "b") == ["over", "close", "close", "under", None]


def test_null_stays_null(rows):
    df = rows([(None, 1.0), (2.0, None), (2.0, 1.0)], "a double, b double")
    low, high = derive.band_between(F.col("a"), F.col("b"))
    assert [tuple(r) for r in df.select(low, high).collect()] == [(None, None), (None, None), (1.0, 2.0)]
    assert values(df.select(derive.clip(F.col("a"), 0, 1).alias("c")), "c") == [None, 1.0, 1.0]
