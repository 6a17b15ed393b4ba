"""Forecast errors by symbol and model."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.operators.news import union_feeds

# Names of the metrics and the least denominator of the relative error.
METRICS = ["MSE", "RMSE", "MAE", "MAPE", "R2", "DirAcc"]
EPSILON = 2.220446049250313e-16


def _sign(value: Column) -> Column:
    """Sign, null for null and NaN."""
    return F.when(~F.isnan(value), F.signum(value))


def forecast_metrics(df: DataFrame, keys: list[str] = ["symbol", "model"],
                     digits: int | None = 6) -> DataFrame:
    """Errors of `predicted` against `actual`, and the share of right directions from `prev_close`.

    A direction without a base counts as a miss. For constant truth R2 is 1 when every prediction is
    right, else 0. Rows without a prediction count in no metric; where none has one, the metrics are
    null and `n` is 0, and the row stays. With a column `status` the last one by name comes along.
    """
    df = df.withColumn("actual", F.when(F.col("predicted").isNotNull(), F.col("actual")))
    error = F.col("actual") - F.col("predicted")
    relative = F.abs(error) / F.greatest(F.abs("actual"), F.lit(EPSILON))
    right = F.coalesce(_sign(F.col("actual") - F.col("prev_close"))
                       == _sign(F.col("predicted") - F.col("prev_close")), F.lit(False))
    spread = F.var_pop("actual")
    constant = F.when(F.max(F.abs(error)) == 0, 1.0).otherwise(0.0)
    status = [F.max("status").alias("status")] if "status" in df.columns else []
    out = df.groupBy(*keys).agg(
        F.avg(error * error).alias("MSE"),
        F.sqrt(F.avg(error * error)).alias("RMSE"),
        F.avg(F.abs(error)).alias("MAE"),
        F.avg(relative).alias("MAPE"),
        F.when(F.min("actual") == F.max("actual"), constant)
        .otherwise(1 - F.try_divide(F.avg(error * error), spread)).alias("R2"),
        F.avg(F.when(F.col("predicted").isNotNull(), right.cast("double"))).alias("DirAcc"),
        F.count("predicted").alias("n"),
        *status,
    )
    if digits is None:
        return out
    return out.withColumns({m: F.round(m, digits) for m in METRICS})


def model_comparison(metrics: DataFrame, models: list[str]) -> DataFrame:
    """One row per symbol with columns `<model>_<metric>`; models without a result are null."""
    return (metrics.groupBy("symbol").pivot("model", models)
            .agg(*[F.first(m).alias(m) for m in METRICS]))


def predictions_table(predictions: DataFrame, models: list[str]) -> DataFrame:
    """One row per symbol and date: `actual` and `Pred_<model>` for every model."""
    wide = predictions.groupBy("symbol", "date").agg(
        F.first("actual").alias("actual"),
        *[F.max(F.when(F.col("model") == m, F.col("predicted"))).alias(f"Pred_{m}") for m in models])
    return wide


def union_metrics(tables: list[DataFrame]) -> DataFrame:
    return union_feeds(tables)
