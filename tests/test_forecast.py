"""Forecasts: short histories, ties in time, and symbols too long for one task."""

import random
from datetime import datetime, timedelta

import pytest

from lantern.operators.forecast import forecast, last_rows_per_symbol, rolling_forecast
from lantern.sources.tables import read_prices


def history(spark, closes, symbol="X"):
    start = datetime(2024, 1, 1)
    rows = [(symbol, start + timedelta(days=i), float(c)) for i, c in enumerate(closes)]
    return spark.createDataFrame(rows, "symbol string, ts timestamp, close double")


@pytest.mark.parametrize(
    "closes,want", [([1, 2, 3, 4, 5], 3.0), ([100, 1, 2, 3, 4, 5], 3.0), ([7, 8], 7.5), ([1, 1, 2], 1.33)]
)
def test_forecast(spark, closes, want):
    r = forecast(history(spark, closes)).first()
    assert r.prediction == want
    assert r.summary == f"Predicted price for X is ${want}"
    assert [d.close for d in r.details] == [float(c) for c in closes[-5:]]


def test_price_source(spark, tmp_path):
    path = str(tmp_path / "prices")
    history(spark, [1, 2], "A").unionByName(history(spark, [5], "B")).write.parquet(path)
    assert read_prices(spark, path).count() == 3
    r = forecast(read_prices(spark, path, ["B"])).first()
    assert r.summary == "Predicted price for B is $5.0"
    wanted = spark.createDataFrame([("B",), ("B",), (None,), ("Z",)], "symbol string")
    assert [tuple(r) for r in read_prices(spark, path, wanted).select("symbol", "close").collect()] == [("B", 5.0)]
    spark.range(1).write.parquet(str(tmp_path / "none"))
    with pytest.raises(ValueError, match="close"):
        read_prices(spark, str(tmp_path / "none"))


def test_no_history_no_row(spark):
    assert forecast(history(spark, [1]).limit(0)).count() == 0


def test_large_prices_without_exponent(spark):
    assert forecast(history(spark, [12345678.0])).first().summary == f"Predicted price for X is ${12345678.0}"


def events(n=2400):
    rng = random.Random(5)
    start = datetime(2024, 1, 1)
    return [
        ("hot" if i % 3 == 0 else f"s{rng.randint(0, 30)}", start + timedelta(hours=rng.randint(0, 700)), i, rng.random())
        for i in range(n)
    ]


def slow_rolling(rows, n=5):
    out = {}
    for s in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == s), key=lambda r: (r[1], r[2]))
        for k, r in enumerate(own):
            part = [x[3] for x in own[max(0, k - n + 1) : k + 1]]
            out[r[2]] = sum(part) / len(part)
    return out


@pytest.mark.parametrize("hot_rows", [1_000_000, 500, 1])
@pytest.mark.parametrize("block_rows", [1, 7, 300, 100_000])
def test_rolling(spark, hot_rows, block_rows):
    """Also one symbol whose rows all have one time, and blocks shorter than what is carried over."""
    rows = events()
    rows += [("same", rows[0][1], len(rows) + i, i / 7) for i in range(600)]
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, id int, close double").repartition(5)
    out = rolling_forecast(df, order=("ts", "id"), hot_rows=hot_rows, block_rows=block_rows).collect()
    assert {r.id: pytest.approx(r.forecast) for r in out} == slow_rolling(rows)
    assert len(out) == len(rows)


def test_last_rows(spark):
    rows = events()
    df = spark.createDataFrame(rows, "symbol string, ts timestamp, id int, close double")
    got = {(r.symbol, r.id) for r in last_rows_per_symbol(df, "symbol", ("ts", "id")).collect()}
    want = set()
    for s in {r[0] for r in rows}:
        own = sorted((r for r in rows if r[0] == s), key=lambda r: (r[1], r[2]))
        want |= {(s, r[2]) for r in own[-5:]}
    assert got == want
