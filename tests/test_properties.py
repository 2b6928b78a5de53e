"""Property tests of the exact arithmetic helpers against Python."""

import datetime as dt
from fractions import Fraction

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from wardwatch.functions.rounding import half_up_div, rounded_mean
from wardwatch.functions.time import boundaries_between

pairs = st.lists(st.tuples(st.integers(0, 10**12), st.integers(1, 10**6)), min_size=1, max_size=200)


@settings(max_examples=8, deadline=None)
@given(pairs)
def test_half_up_div(spark, data):
    df = spark.createDataFrame(data, "n long, d long")
    got = [r[0] for r in df.select(half_up_div(F.col("n"), F.col("d"))).collect()]
    want = [int(Fraction(n, d) + Fraction(1, 2)) for n, d in data]
    assert got == want


@settings(max_examples=5, deadline=None)
@given(st.lists(st.integers(300, 450), min_size=1, max_size=50))
def test_rounded_mean_of_tenths(spark, tenths):
    df = spark.createDataFrame([(t,) for t in tenths], "t long")
    got = df.agg(rounded_mean(F.sum("t"), F.count("t"), 1, 2)).first()[0]
    exact = Fraction(sum(tenths), 10 * len(tenths))
    want = int(exact * 100 + Fraction(1, 2)) / 100
    assert got == want


stamps = st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2040, 1, 1))


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(stamps, stamps), min_size=1, max_size=100))
def test_boundaries(spark, data):
    df = spark.createDataFrame(data, "a timestamp_ntz, b timestamp_ntz")
    for unit, secs in (("second", 1), ("minute", 60), ("hour", 3600)):
        got = [r[0] for r in df.select(boundaries_between(unit, "a", "b")).collect()]
        epoch = dt.datetime(1970, 1, 1)
        want = [int((b - epoch).total_seconds() // secs) - int((a - epoch).total_seconds() // secs)
                for a, b in data]
        assert got == want, unit
