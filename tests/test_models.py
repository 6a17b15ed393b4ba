"""Scaling, selection, metrics and forecasts against numpy."""

import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.functions import linear
from newsflow.operators import forecast, metrics, prep, series
from newsflow.schema import PREDICTIONS, date_column, require

DAY = dt.date(2024, 1, 1)


def frame(spark, columns: dict, symbol="A"):
    names = list(columns)
    rows = [(symbol, DAY + dt.timedelta(i), *map(float, values))
            for i, values in enumerate(zip(*columns.values()))]
    return spark.createDataFrame(rows, "symbol string, date date, " + ", ".join(f"{n} double" for n in names))


def test_minmax_fits_on_train_only(spark):
    df = frame(spark, {"x": [1, 3, 5, 9], "c": [2, 2, 2, 3]}).withColumn("is_train", F.col("x") < 6)
    got = prep.minmax_scale(df, ["x", "c"]).orderBy("date").collect()
    assert [r.x for r in got] == [0, 0.5, 1, 2]
    assert [r.c for r in got] == [0, 0, 0, 1]
    back = prep.minmax_scale(df, ["x"]).orderBy("date").select(
        prep.unscaled(F.col("x"), F.col("x_min"), F.col("x_max")).alias("x")).collect()
    assert [r.x for r in back] == [1, 3, 5, 9]


def test_scale_sequences(spark):
    values = np.arange(12.0) ** 2
    df = frame(spark, {"x": values, "y0": -values}).withColumn("is_train", F.col("x") < 60)
    cut = series.sequences(df, ["x", "y0"], "x", 3, ["symbol", "is_train"])
    got = prep.scale_sequences(cut, 2).orderBy("date").collect()
    train = values[:8]
    low, high = train[:7].min(), train[:7].max()
    first = [r for r in got if r.is_train][0]
    np.testing.assert_allclose(first.X, [[(v - low) / (high - low), (-v + high) / (high - low)]
                                         for v in train[:3]])
    assert first.y == pytest.approx((train[3] - train[3]) / 1)


def test_select_features(spark):
    rng = np.random.default_rng(0)
    close = rng.normal(size=200)
    columns = {"close": close, "flat": np.ones(200), "near": close + rng.normal(size=200) * 0.1,
               "far": -close + rng.normal(size=200), "noise": (np.arange(200) % 2) * 2.0 - 1}
    columns["noise"] -= close * np.dot(columns["noise"], close) / np.dot(close, close)
    names = ["flat", "far", "near", "noise"]
    got = prep.select_features(frame(spark, columns), names).orderBy("rank").collect()
    assert [r.feature for r in got] == ["close", "near", "far"]
    assert got[1].abs_corr == pytest.approx(abs(np.corrcoef(close, columns["near"])[0, 1]))
    none = prep.select_features(frame(spark, columns), ["flat", "noise"]).orderBy("rank").collect()
    assert [(r.rank, r.feature) for r in none] == [(0, "close"), (1, "flat"), (2, "noise")]


def test_select_features_keeps_six(spark):
    close = np.arange(50.0)
    columns = {"close": close} | {f"f{i}": close + np.cos(np.arange(50) * (i + 1)) * i for i in range(9)}
    got = prep.select_features(frame(spark, columns), [f"f{i}" for i in range(9)])
    assert got.count() == 7


def test_augment_noise(spark):
    df = frame(spark, {"x": np.zeros(500)})
    out = prep.augment_noise(df, ["x"], ["symbol", "date"], std=0.01)
    again = prep.augment_noise(df.repartition(5), ["x"], ["symbol", "date"], std=0.01)
    assert sorted(map(str, out.collect())) == sorted(map(str, again.collect()))
    assert out.filter("NOT is_noisy AND x = 0").count() == 500
    noise = np.array([r.x for r in out.filter("is_noisy").collect()])
    assert len(noise) == 500 and 0.008 < noise.std() < 0.012


def test_metrics(spark):
    rng = np.random.default_rng(3)
    y, p, prev = rng.normal(10, 2, 50), rng.normal(10, 2, 50), rng.normal(10, 2, 50)
    rows = [("A", DAY, "m", float(a), float(b), float(c)) for a, b, c in zip(y, p, prev)]
    rows.append(("A", DAY, "m", 1.0, 1.0, None))
    y, p = np.append(y, 1.0), np.append(p, 1.0)
    got = metrics.forecast_metrics(spark.createDataFrame(rows, PREDICTIONS), digits=None).first()
    assert got.MSE == pytest.approx(((y - p) ** 2).mean())
    assert got.RMSE == pytest.approx(((y - p) ** 2).mean() ** 0.5)
    assert got.MAE == pytest.approx(abs(y - p).mean())
    assert got.MAPE == pytest.approx((abs(y - p) / abs(y)).mean())
    assert got.R2 == pytest.approx(1 - ((y - p) ** 2).sum() / ((y - y.mean()) ** 2).sum())
    right = np.sign(y[:-1] - prev) == np.sign(p[:-1] - prev)
    assert got.DirAcc == pytest.approx(right.sum() / 51)


@pytest.mark.parametrize("predicted, want", [([2.0, 2.0], 1.0), ([2.0, 3.0], 0.0)])
def test_r2_of_constant_truth(spark, predicted, want):
    rows = [("A", DAY, "m", 2.0, p, float("nan")) for p in predicted]
    got = metrics.forecast_metrics(spark.createDataFrame(rows, PREDICTIONS)).first()
    assert (got.R2, got.DirAcc) == (want, 0.0)


def brute_ar(y, p, k, exog):
    """Conditional least squares on differences and the recursion, written out."""
    z, dx = np.diff(y), np.diff(exog, axis=0)
    rows = [np.concatenate([z[t - p:t][::-1], dx[t]]) for t in range(p, k - 1)]
    coef = np.linalg.lstsq(np.array(rows), z[p:k - 1], rcond=None)[0]
    recent, level, out = list(z[k - 1 - p:k - 1][::-1]), y[k - 1], []
    for t in range(k, len(y)):
        step = float(np.concatenate([recent, dx[t - 1]]) @ coef)
        recent = [step, *recent[:-1]]
        level += step
        out.append(level)
    return out


@pytest.mark.parametrize("p, columns", [(1, []), (5, []), (3, ["open", "volume"])])
def test_fit_ar(spark, p, columns):
    rng = np.random.default_rng(5)
    n, k = 60, 48
    y = np.cumsum(rng.normal(size=n)) + 100
    exog = {"open": y + rng.normal(size=n), "volume": rng.integers(1, 9, n) * 1e6}
    df = frame(spark, {"close": y, **exog}).unionByName(frame(spark, {"close": y * 2, **exog}, "B"))
    out = forecast.fit_ar(df, p=p, exog=columns).filter("symbol = 'A'").orderBy("date").collect()
    x = np.array([exog[c] for c in columns]).T.reshape(n, len(columns))
    assert {r.status for r in out} == {"ok"}
    np.testing.assert_allclose([r.predicted for r in out], brute_ar(y, p, k, x), rtol=1e-6)
    np.testing.assert_allclose([r.actual for r in out], y[k:])
    np.testing.assert_allclose([r.prev_close for r in out], y[k - 1:-1])


def test_second_difference(spark):
    y = np.arange(40.0) ** 2 + np.sin(np.arange(40))
    out = forecast.fit_ar(frame(spark, {"close": y}), p=2, d=2).orderBy("date").collect()
    z = np.diff(y[:32], 2)
    coef = np.linalg.lstsq(np.array([z[t - 2:t][::-1] for t in range(2, 30)]), z[2:], rcond=None)[0]
    recent, slope, level, want = list(z[-2:][::-1]), y[31] - y[30], y[31], []
    for _ in range(8):
        step = float(np.dot(coef, recent))
        recent = [step, recent[0]]
        slope += step
        level += slope
        want.append(level)
    np.testing.assert_allclose([r.predicted for r in out], want, rtol=1e-6)


def test_two_rows_of_a_day_are_an_error(spark):
    df = frame(spark, {"close": np.arange(30.0) ** 2})
    with pytest.raises(Exception, match="more than one row of A on 2024-01-01"):
        forecast.fit_ar(df.unionByName(df.limit(1)), p=1).collect()


def test_elimination_solves_and_leaves_out_combinations(spark):
    rng = np.random.default_rng(9)
    for aliased in (False, True):
        u = rng.normal(size=(60, 4)) * [1, 1e4, 1e-3, 1]
        u[:, 3] = u[:, 0] * 2 - u[:, 1] / 1e4 if aliased else u[:, 3]
        z = u[:, :3] @ [1.0, 2e-4, 3e3] + rng.normal(size=60)
        gram, moment = u.T @ u, u.T @ z
        row = ([float(gram[i, j]) for i in range(4) for j in range(i, 4)], [float(m) for m in moment])
        df = spark.createDataFrame([row], "gram array<double>, moment array<double>")
        got = df.select(linear.solve(F.col("gram"), F.col("moment"), 4)).first()[0]
        want = np.linalg.solve(gram[:3, :3], moment[:3]).tolist() + [0.0] if aliased else np.linalg.solve(gram, moment)
        np.testing.assert_allclose(got, want, rtol=1e-6)


def test_one_bad_symbol_does_not_stop_the_others(spark):
    rng = np.random.default_rng(7)
    good = frame(spark, {"close": np.cumsum(rng.normal(size=60)) + 50})
    bad = frame(spark, {"close": [1, 2, 3, 4]}, "B")
    out = forecast.fit_ar(good.unionByName(bad))
    status = {r.symbol: r.status for r in out.select("symbol", "status").distinct().collect()}
    assert status["A"] == "ok" and status["B"] != "ok"
    assert out.filter("symbol = 'B' AND predicted IS NOT NULL").isEmpty()
    per_symbol = metrics.forecast_metrics(out.withColumn("model", F.lit("AR")))
    rows = {r.symbol: r for r in per_symbol.collect()}
    assert rows["A"].status == "ok" and rows["A"].MAE is not None
    assert rows["B"].status != "ok" and rows["B"].MAE is None and rows["B"].n == 0
    assert {r.symbol for r in metrics.model_comparison(per_symbol, ["AR"]).collect()} == {"A", "B"}


def test_days_before_the_first_price_do_not_count(spark):
    rng = np.random.default_rng(7)
    known = frame(spark, {"close": np.cumsum(rng.normal(size=60)) + 50})
    padded = known.unionByName(known.select(
        "symbol", F.date_sub("date", 100).alias("date"), F.lit(None).cast("double").alias("close")))
    a, b = (sorted(map(str, forecast.fit_ar(x, p=2).collect())) for x in (known, padded))
    assert a == b


def test_compare_regressors_learns_a_line(spark):
    df = frame(spark, {"close": np.arange(100.0), "s": np.ones(100)}).unionByName(
        frame(spark, {"close": 500 - 2 * np.arange(100.0), "s": np.ones(100)}, "B"))
    df = series.split_date(df, train_end=DAY + dt.timedelta(69))
    out = forecast.compare_regressors(df, {"one": ["close"], "two": ["close", "s"]})
    assert out.count() == 2 * 2 * 25
    got = metrics.forecast_metrics(out).collect()
    assert all(r.MAE < 0.5 and r.DirAcc == 1.0 for r in got)


def test_symbols_have_models_and_features_of_their_own(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=200), rng.normal(size=200)
    rising = frame(spark, {"close": np.roll(x, 1), "u": x, "v": y}, "GOOGL")
    falling = frame(spark, {"close": -np.roll(y, 1), "u": x, "v": y}, "NVDA")
    short = frame(spark, {"close": [1, 2, 3], "u": [1, 2, 1], "v": [2, 1, 2]}, "TINY")
    late = short.select("symbol", F.date_add("date", 180).alias("date"), "close", "u", "v")
    df = series.split_date(rising.unionByName(falling).unionByName(short).unionByName(late),
                           train_end=DAY + dt.timedelta(149))
    out = forecast.compare_regressors(df, {"m": ["close", "u", "v"]}, window=2)
    got = {r.symbol: r for r in metrics.forecast_metrics(out).collect()}
    assert got["GOOGL"].MAE < 1e-3 and got["NVDA"].MAE < 1e-3
    assert got["TINY"].MAE is None and got["TINY"].status.startswith("too few rows")
    chosen = forecast.compare_regressors(df, {"m": ["close", "u", "v"]}, window=2, selected=["m"],
                                         noise={"m": 0.001})
    features = {r.symbol: r.features for r in chosen.select("symbol", "features").distinct().collect()}
    assert set(features) == {"GOOGL", "NVDA", "TINY"} and all(f.startswith("close") for f in features.values())
    again = forecast.compare_regressors(df.repartition(3), {"m": ["close", "u", "v"]}, window=2,
                                        selected=["m"], noise={"m": 0.001})
    assert sorted(map(str, chosen.collect())) == sorted(map(str, again.collect()))


def test_schema_helpers(spark):
    df = frame(spark, {"close": [1]})
    assert require(df, "symbol", "close") is df
    with pytest.raises(ValueError, match="volume"):
        require(df, "volume")
    assert date_column(df.withColumn("datetime", F.lit(""))) == "datetime"
    with pytest.raises(ValueError):
        date_column(df)
