"""Queries of preparation, metrics and forecasts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.operators import forecast, metrics, prep, report, series
from newsflow.plans.features import (SQL_DAILY, SQL_FEATURES, SQL_FILLED, _DAYS, daily, features,
                                     filled, rounded, sql_round)
from newsflow.plans.registry import query
from newsflow.plans.views import view
from newsflow.session import written

TRAIN_END = "1995-10-31"
CANDIDATES = series.SENTIMENT_FEATURES


def joined(spark, d) -> DataFrame:
    """Prices with daily article features, split by date."""
    prices = view(spark, d, "prices_v").select("symbol", "date", "close")
    return series.split_date(series.join_sentiment(prices, features(spark, d)), train_end=TRAIN_END)


SQL_JOINED = f"""{SQL_FEATURES.strip()},
joined AS (SELECT p.symbol, p.date, close, p.date <= date '{TRAIN_END}' AS is_train, {', '.join(
    f'coalesce("{c}", 0) AS "{c}"' for c in CANDIDATES)}
FROM prices_v p LEFT JOIN daily_features f ON p.symbol = f.symbol AND p.date = f.date)"""


@query("minmax_scale", f"""
WITH {SQL_JOINED}, stats AS (SELECT symbol, min(close) AS a, max(close) AS b, min("Neutral") AS na,
  max("Neutral") AS nb FROM joined WHERE is_train GROUP BY symbol)
SELECT j.symbol, date, is_train,
  {sql_round('(close - a) / CASE WHEN b = a THEN 1 ELSE b - a END', 'close')},
  {sql_round('("Neutral" - na) / CASE WHEN nb = na THEN 1 ELSE nb - na END', '"Neutral"')}
FROM joined j LEFT JOIN stats s ON j.symbol = s.symbol""", "senti_v prices_v")
def minmax_scale(spark, d) -> DataFrame:
    scaled = prep.minmax_scale(joined(spark, d), ["close", "Neutral"])
    return rounded(scaled.select("symbol", "date", "is_train", "close", "Neutral"), ["close", "Neutral"])


_CORRS = " UNION ALL ".join(
    f"""SELECT symbol, '{c}' AS feature, {i} AS place, CASE WHEN min("{c}") <> max("{c}")
    AND min(close) <> max(close) THEN abs(corr("{c}", close)) END AS abs_corr
    FROM joined WHERE is_train GROUP BY symbol""" for i, c in enumerate(CANDIDATES))


@query("select_features", f"""
WITH {SQL_JOINED}, raw AS ({_CORRS}),
corrs AS (SELECT symbol, feature, place, CASE WHEN isnan(abs_corr) THEN NULL ELSE abs_corr END
  AS abs_corr FROM raw),
flagged AS (SELECT *, coalesce(abs_corr >= 0.1, false) AS passes,
  bool_or(coalesce(abs_corr >= 0.1, false)) OVER (PARTITION BY symbol) AS found FROM corrs),
ranked AS (SELECT *, row_number() OVER (PARTITION BY symbol ORDER BY
  CASE WHEN found THEN -abs_corr END, place) AS rank FROM flagged WHERE passes OR NOT found)
SELECT symbol, CAST(rank AS INTEGER) AS rank, feature, {sql_round('abs_corr', 'abs_corr')}
FROM ranked WHERE rank <= 6 OR NOT found
UNION ALL SELECT DISTINCT symbol, CAST(0 AS INTEGER), 'close', CAST(NULL AS DOUBLE) FROM corrs""",
       "senti_v prices_v")
def select_features(spark, d) -> DataFrame:
    train = joined(spark, d).filter("is_train")
    return rounded(prep.select_features(train, CANDIDATES), ["abs_corr"])


def sql_noise(column: str) -> str:
    """Box-Muller on two parts of the hash of the row's name, as the operator does it."""
    digest = f"md5(concat_ws('|', symbol, CAST(date AS VARCHAR), '{column}', '42'))"
    one, two = (f"((CAST('0x' || substr({digest}, {i}, 12) AS BIGINT) + 0.5) / 281474976710656.0)" for i in (1, 13))
    return f"sqrt(-2 * ln({one}::DOUBLE)) * cos(2 * pi() * {two}::DOUBLE) * 0.01"


@query("augment_noise", f"""
WITH {SQL_JOINED} SELECT symbol, date, is_train, {sql_round('close', 'close')},
  {sql_round('"Sentiment"', '"Sentiment"')}, false AS is_noisy FROM joined
UNION ALL SELECT symbol, date, is_train, {sql_round(f"close + {sql_noise('close')}", 'close')},
  {sql_round(f'"Sentiment" + {sql_noise("Sentiment")}', '"Sentiment"')}, true FROM joined""",
       "senti_v prices_v")
def augment_noise(spark, d) -> DataFrame:
    rows = joined(spark, d).select("symbol", "date", "is_train", "close", "Sentiment")
    return rounded(prep.augment_noise(rows, ["close", "Sentiment"], ["symbol", "date"]),
                   ["close", "Sentiment"])


# Simple forecasts as input of the metrics: the last close and the mean of the last three -----------

SIMPLE = ["last", "mean3"]


def simple_predictions(spark, d) -> DataFrame:
    prices = view(spark, d, "prices_v")
    w = Window.partitionBy("symbol").orderBy("date")
    base = prices.select("symbol", "date", F.col("close").alias("actual"),
                         F.lag("close", 1).over(w).alias("prev_close"),
                         F.avg("close").over(w.rowsBetween(-3, -1)).alias("mean3"))
    models = F.explode(F.array(
        F.struct(F.lit("last").alias("model"), F.col("prev_close").alias("predicted")),
        F.struct(F.lit("mean3").alias("model"), F.col("mean3").alias("predicted"))))
    return (base.withColumn("m", models)
            .select("symbol", "date", "m.model", "actual", "m.predicted", "prev_close"))


SQL_SIMPLE = f"""
base AS (SELECT symbol, date, close AS actual, lag(close) {_DAYS}) AS prev_close,
  avg(close) {_DAYS} ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING) AS mean3 FROM prices_v),
preds AS (SELECT symbol, date, 'last' AS model, actual, prev_close AS predicted, prev_close FROM base
  UNION ALL SELECT symbol, date, 'mean3', actual, mean3, prev_close FROM base),
errors AS (SELECT *, actual - predicted AS e FROM preds WHERE predicted IS NOT NULL),
metrics AS (SELECT symbol, model, avg(e * e) AS MSE, sqrt(avg(e * e)) AS RMSE, avg(abs(e)) AS MAE,
  avg(abs(e) / greatest(abs(actual), 2.220446049250313e-16)) AS MAPE,
  1 - avg(e * e) / var_pop(actual) AS R2,
  avg(CASE WHEN sign(actual - prev_close) = sign(predicted - prev_close) THEN 1.0 ELSE 0.0 END) AS DirAcc,
  count(*) AS n FROM errors GROUP BY symbol, model)"""
# squares of prices are large: fewer digits keep the sums of both engines equal
DIGITS = {"MSE": 0, "RMSE": 4, "MAE": 4, "MAPE": 6, "R2": 6, "DirAcc": 6}


def _rounded_metrics(df: DataFrame) -> DataFrame:
    return df.withColumns({m: F.round(m, k) for m, k in DIGITS.items()})


def simple_metrics(spark, d) -> DataFrame:
    return metrics.forecast_metrics(simple_predictions(spark, d), digits=None)


@query("forecast_metrics", f"""
WITH {SQL_SIMPLE.strip()} SELECT symbol, model,
  {', '.join(sql_round(m, f'"{m}"', k) for m, k in DIGITS.items())}, n FROM metrics""", "prices_v")
def forecast_metrics(spark, d) -> DataFrame:
    return _rounded_metrics(simple_metrics(spark, d))


@query("model_comparison", f"""
WITH {SQL_SIMPLE.strip()} SELECT symbol, {', '.join(sql_round(
    f"max(CASE WHEN model = '{x}' THEN {m} END)", f'"{x}_{m}"', k)
    for x in SIMPLE for m, k in DIGITS.items())} FROM metrics GROUP BY symbol""", "prices_v")
def model_comparison(spark, d) -> DataFrame:
    wide = metrics.model_comparison(simple_metrics(spark, d), SIMPLE)
    return wide.withColumns({f"{x}_{m}": F.round(f"{x}_{m}", k)
                             for x in SIMPLE for m, k in DIGITS.items()})


@query("metric_rows", f"""
WITH {SQL_SIMPLE.strip()} SELECT model, round(avg(DirAcc), 6) AS "DirAcc", 'mean' AS symbol FROM metrics
GROUP BY model UNION ALL SELECT model, round(DirAcc, 6), symbol FROM metrics""", "prices_v")
def metric_rows(spark, d) -> DataFrame:
    per_symbol = simple_metrics(spark, d).select("model", "DirAcc", "symbol")
    overall = (per_symbol.groupBy("model").agg(F.avg("DirAcc").alias("DirAcc"))
               .withColumn("symbol", F.lit("mean")))
    return rounded(metrics.union_metrics([overall, per_symbol]), ["DirAcc"])


@query("predictions_table", f"""
WITH {SQL_SIMPLE.strip()} SELECT symbol, date, actual, prev_close AS "Pred_last",
  {sql_round('mean3', '"Pred_mean3"')} FROM base ORDER BY symbol, date""", "prices_v")
def predictions_table(spark, d) -> DataFrame:
    table = metrics.predictions_table(simple_predictions(spark, d), SIMPLE)
    return rounded(table, ["Pred_mean3"]).orderBy("symbol", "date")


@query("report_sentiment_vs_prediction", f"""
WITH {SQL_SIMPLE.strip()}, {SQL_DAILY.strip()} SELECT p.symbol, p.date, p.model, actual,
  {sql_round('predicted', 'predicted')}, {sql_round('coalesce(avg_positive - avg_negative, 0)', 'sentiment')}
FROM preds p LEFT JOIN daily s ON p.symbol = s.symbol AND p.date = s.date""", "senti_v prices_v")
def report_sentiment_vs_prediction(spark, d) -> DataFrame:
    out = report.sentiment_vs_prediction(daily(spark, d), simple_predictions(spark, d))
    return rounded(out.drop("prev_close"), ["predicted", "sentiment"])


# Autoregression ----------------------------------------------------------------------------------

@query("ar1_coefficients", f"""
WITH {SQL_FILLED}, z AS (SELECT symbol, date, close - lag(close) {_DAYS}) AS z,
  row_number() {_DAYS}) AS t, floor(count(*) OVER (PARTITION BY symbol) * 0.8::DOUBLE) AS k FROM filled
  WHERE close IS NOT NULL),
l AS (SELECT *, lag(z) {_DAYS}) AS l FROM z)
SELECT symbol, count(*) AS n, {sql_round('regr_intercept(z, l)', 'intercept', 3)},
  {sql_round('regr_slope(z, l)', 'slope')} FROM l
WHERE t <= k AND z IS NOT NULL AND l IS NOT NULL GROUP BY symbol""", "prices_v")
def ar1_coefficients(spark, d) -> DataFrame:
    rows = forecast.regression_rows(filled(spark, d).filter("close IS NOT NULL"), p=1, intercept=True)
    found = forecast.coefficients(forecast.normal_equations(rows, 2), 2)
    return found.select("symbol", "n", F.round(F.col("coef")[0], 3).alias("intercept"),
                        F.round(F.col("coef")[1], 6).alias("slope"))


# With one lag the forecast has a closed form: the h-th step is phi^h times the last difference.
@query("ar1_forecast", f"""
WITH {SQL_FILLED}, z AS (SELECT symbol, date, close, close - lag(close) {_DAYS}) AS z,
  lag(close) {_DAYS}) AS prev_close, row_number() {_DAYS}) AS t,
  floor(count(*) OVER (PARTITION BY symbol) * 0.8::DOUBLE) AS k FROM filled WHERE close IS NOT NULL),
l AS (SELECT *, lag(z) {_DAYS}) AS l FROM z),
phi AS (SELECT symbol, sum(z * l) / sum(l * l) AS phi FROM l
  WHERE t <= k AND z IS NOT NULL AND l IS NOT NULL GROUP BY symbol),
ends AS (SELECT symbol, close AS y, z AS d FROM z WHERE t = k)
SELECT z.symbol, date, 'AR1' AS model, close AS actual,
  {sql_round('y + d * phi * (1 - pow(phi, t - k)) / (1 - phi)', 'predicted', 4)}, prev_close, 'ok' AS status
FROM z JOIN phi ON z.symbol = phi.symbol JOIN ends ON z.symbol = ends.symbol WHERE t > k""", "prices_v")
def ar1_forecast(spark, d) -> DataFrame:
    return rounded(forecast.fit_ar(filled(spark, d), p=1, model="AR1"), ["predicted"], 4)


OHLCV = ["open", "high", "low", "volume"]
SENTIMENT = ["Sentiment", "Sentiment_Diff", "Sentiment_Volatility"]


def sql_ar(name: str, source: str, model: str, exog: list[str], lags: int = 5) -> str:
    """The table `name`: sums of products, elimination pivot by pivot and the recursion over the test days."""
    size = lags + len(exog)
    z = ", ".join([f"close - lag(close) {_DAYS}) AS z", *[f"{_quoted(c)} - lag({_quoted(c)}) {_DAYS}) AS e{i}"
                                                          for i, c in enumerate(exog)]])
    u = ", ".join([*[f"lag(z, {i}) {_DAYS})" for i in range(1, lags + 1)], *[f"e{i}" for i in range(len(exog))]])
    gram = ", ".join("[" + ", ".join(f"sum(u[{i}] * u[{j}])" for j in range(1, size + 1)) + "]"
                     for i in range(1, size + 1))
    moment = ", ".join(f"sum(u[{i}] * z)" for i in range(1, size + 1))
    n = name
    return f"""
{n}_z AS (SELECT symbol, date, close, {z}, lag(close) {_DAYS}) AS prev_close, row_number() {_DAYS}) AS t,
  floor(count(*) OVER (PARTITION BY symbol) * 0.8::DOUBLE)::BIGINT AS k FROM {source} WHERE close IS NOT NULL),
{n}_u AS (SELECT *, [{u}]::DOUBLE[] AS u FROM {n}_z),
{n}_g AS (SELECT symbol, [{gram}] AS g, [{moment}] AS b FROM {n}_u
  WHERE t <= k AND z IS NOT NULL AND len(list_filter(u, lambda x: x IS NULL)) = 0 GROUP BY symbol),
{n}_s AS (SELECT *, list_transform(g, lambda r, i: CASE WHEN r[i] > 0 THEN sqrt(r[i]) ELSE 1 END) AS s FROM {n}_g),
{n}_e AS (SELECT symbol, s, 1 AS step, list_transform(g, lambda r, i:
    list_append(list_transform(r, lambda v, j: v / (s[i] * s[j])), b[i] / s[i])) AS m FROM {n}_s
  UNION ALL SELECT symbol, s, step + 1, list_transform(m, lambda r, i: CASE WHEN i = step THEN p
    ELSE list_transform(r, lambda v, j: v - r[step] * p[j]) END)
  FROM (SELECT *, list_transform(m[step], lambda v: CASE WHEN m[step][step] > 1e-10
    THEN v / m[step][step] ELSE 0 END) AS p FROM {n}_e WHERE step <= {size})),
{n}_c AS (SELECT symbol, list_transform(m, lambda r, i: r[{size + 1}] / s[i]) AS c FROM {n}_e WHERE step = {size + 1}),
{n}_f AS (SELECT symbol, t, close AS y, list_prepend(z, u[:{lags - 1}]) AS recent FROM {n}_u WHERE t = k
  UNION ALL SELECT symbol, t, y + v, list_prepend(v, recent[:{lags - 1}]) FROM (
    SELECT f.symbol, w.t, y, recent, list_sum(list_transform(list_concat(recent, w.u[{lags + 1}:]),
      lambda x, i: x * c[i])) AS v
    FROM {n}_f f JOIN {n}_u w ON w.symbol = f.symbol AND w.t = f.t + 1 JOIN {n}_c c ON c.symbol = f.symbol)),
{n} AS (SELECT w.symbol, date, '{model}' AS model, close AS actual, y AS predicted, prev_close
  FROM {n}_u w JOIN {n}_f f ON f.symbol = w.symbol AND f.t = w.t WHERE w.t > w.k)"""


def _quoted(column: str) -> str:
    return f'"{column}"'


def _shown(name: str) -> str:
    return (f"SELECT symbol, date, model, actual, {sql_round('predicted', 'predicted', 2)}, prev_close, "
            f"'ok' AS status FROM {name}")


@query("ar_forecast", f"WITH RECURSIVE {SQL_FILLED.strip()}, {sql_ar('ar', 'filled', 'AR', []).strip()} {_shown('ar')}",
       "prices_v")
def ar_forecast(spark, d) -> DataFrame:
    return rounded(forecast.fit_ar(filled(spark, d), model="AR"), ["predicted"], 2)


@query("arx_forecast_ohlcv", f"WITH RECURSIVE {SQL_FILLED.strip()}, "
       f"{sql_ar('arx', 'filled', 'StockExog', OHLCV).strip()} {_shown('arx')}", "prices_v")
def arx_forecast_ohlcv(spark, d) -> DataFrame:
    return rounded(forecast.fit_ar(filled(spark, d), exog=OHLCV, model="StockExog"), ["predicted"], 2)


def combined(spark, d) -> DataFrame:
    """Filled prices with daily sentiment: that of price days, 0 on all other business days."""
    prices = view(spark, d, "prices_v").select("symbol", "date")
    sentiment = features(spark, d).select("symbol", "date", *SENTIMENT)
    on_price_days = sentiment.join(prices, ["symbol", "date"], "left_semi")
    return series.join_sentiment(filled(spark, d), on_price_days)


SQL_COMBINED = f"""{SQL_FILLED.strip()}, {SQL_FEATURES.strip()},
combined AS (SELECT f.symbol, f.date, open, high, low, close, volume, {', '.join(
    f'coalesce("{c}", 0) AS "{c}"' for c in SENTIMENT)}
FROM filled f LEFT JOIN (SELECT * FROM daily_features SEMI JOIN prices_v USING (symbol, date)) s
  ON s.symbol = f.symbol AND s.date = f.date)"""


@query("arx_forecast_combined", f"WITH RECURSIVE {SQL_COMBINED}, "
       f"{sql_ar('arx', 'combined', 'Combined', [*OHLCV, *SENTIMENT]).strip()} {_shown('arx')}", "senti_v prices_v")
def arx_forecast_combined(spark, d) -> DataFrame:
    found = forecast.fit_ar(combined(spark, d), exog=[*OHLCV, *SENTIMENT], model="Combined")
    return rounded(found, ["predicted"], 2)


COMPARED = {"AR": [], "StockExog": OHLCV, "Combined": [*OHLCV, *SENTIMENT]}


@query("ar_model_comparison", f"""
WITH RECURSIVE {SQL_COMBINED}, {', '.join(sql_ar(f'fit_{m}'.lower(), 'combined', m, x).strip() for m, x in COMPARED.items())},
found AS ({' UNION ALL '.join(f'SELECT *, actual - predicted AS e FROM fit_{m.lower()}' for m in COMPARED)}),
scored AS (SELECT symbol, model, avg(e * e) AS MSE, sqrt(avg(e * e)) AS RMSE, avg(abs(e)) AS MAE,
  avg(abs(e) / greatest(abs(actual), 2.220446049250313e-16)) AS MAPE, 1 - avg(e * e) / var_pop(actual) AS R2,
  avg(CASE WHEN sign(actual - prev_close) = sign(predicted - prev_close) THEN 1.0 ELSE 0.0 END) AS DirAcc
  FROM found GROUP BY symbol, model)
SELECT symbol, {', '.join(sql_round(f"max(CASE WHEN model = '{m}' THEN {x} END)", f'"{m}_{x}"', k)
                          for m in COMPARED for x, k in DIGITS.items())} FROM scored GROUP BY symbol""",
       "senti_v prices_v")
def ar_model_comparison(spark, d) -> DataFrame:
    base = written(combined(spark, d), "series")
    found = metrics.union_metrics([forecast.fit_ar(base, exog=exog, model=m) for m, exog in COMPARED.items()])
    wide = metrics.model_comparison(metrics.forecast_metrics(found, digits=None), list(COMPARED))
    return wide.withColumns({f"{m}_{x}": F.round(f"{m}_{x}", k) for m in COMPARED for x, k in DIGITS.items()})


@query("seq_regression_compare")
def seq_regression_compare(spark, d) -> DataFrame:
    """The comparison in full: selection per symbol on training rows, a disturbed copy of the training
    sequences for the combined model, and a model per symbol."""
    sets = {"StockOnly": ["close"], "StockSentiment": ["close", *CANDIDATES]}
    predictions = forecast.compare_regressors(
        joined(spark, d), sets, noise={"StockSentiment": 0.01}, selected=["StockSentiment"])
    return metrics.forecast_metrics(predictions)


# One step of one feature is a simple regression on scaled closes. A symbol with one training pair has no
# line: its rows stay, without predictions.
@query("seq_regression_line", f"""
WITH split AS (SELECT symbol, date, close, date <= date '{TRAIN_END}' AS is_train FROM prices_v),
few AS (SELECT * FROM (SELECT *,
  row_number() OVER (PARTITION BY symbol, is_train ORDER BY date) AS day FROM split)
  WHERE symbol <> 'AAPL' OR NOT is_train OR day <= 2),
pairs AS (SELECT *, lag(close) OVER (PARTITION BY symbol, is_train ORDER BY date) AS x FROM few),
line AS (SELECT symbol, regr_slope(close, x) AS m, regr_intercept(close, x) AS c, count(x) AS n FROM pairs
  WHERE is_train AND x IS NOT NULL GROUP BY symbol)
SELECT p.symbol, date, 'Line' AS model, {sql_round('close', 'actual', 4)},
  {sql_round('CASE WHEN n > 2 THEN m * x + c END', 'predicted', 4)}, x AS prev_close, 'close' AS features,
  CASE WHEN n > 2 THEN 'ok' ELSE 'too few rows: ' || CAST(n AS VARCHAR) END AS status
FROM pairs p JOIN line l ON p.symbol = l.symbol WHERE NOT is_train AND x IS NOT NULL""", "prices_v")
def seq_regression_line(spark, d) -> DataFrame:
    prices = view(spark, d, "prices_v").select("symbol", "date", "close")
    split = series.split_date(prices, train_end=TRAIN_END)
    w = Window.partitionBy("symbol", "is_train").orderBy("date")
    # one symbol keeps two training days only
    few = (split.withColumn("day", F.row_number().over(w))
           .filter((F.col("symbol") != "AAPL") | ~F.col("is_train") | (F.col("day") <= 2)).drop("day"))
    found = forecast.compare_regressors(few, {"Line": ["close"]}, window=1, ridge=0.0)
    return rounded(found, ["actual", "predicted"], 4)
