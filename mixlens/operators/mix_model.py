"""Regression of sales on transformed spend, per series, and what follows from it.

A fit needs one pass: means and covariances of the features, which Spark
combines inside map tasks. Only that small matrix, one row per series, goes
through a solver.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixlens.functions.ratios import safe_ratio
from mixlens.operators.mix import CHANNELS, Channel, adstock_over, hill

SEASON = ("season_sin", "season_cos")
TARGET = "total_sales"

# Directions of the features' correlation matrix below this share of the largest are not told apart.
LEAST_SHARE = 1e-10


def model_features(channels: Sequence[Channel] = CHANNELS) -> list[str]:
    """Transformed spend of every channel and the seasonal pair."""
    return [c.transformed for c in channels] + list(SEASON)


def series_moments(df: DataFrame, features: Sequence[str], target: str, by: Sequence[str]) -> DataFrame:
    """Row count, means and population covariances per series, over the rows that have every feature and the target."""
    names = [*features, target]
    complete = F.lit(True)
    for name in names:
        complete = complete & F.col(name).isNotNull()
    value = {x: F.when(complete, F.col(x)) for x in names}
    aggs = [F.count_if(complete).alias("n")]
    aggs += [F.avg(value[x]).alias(f"mean_{i}") for i, x in enumerate(names)]
    aggs += [
        F.covar_pop(value[names[i]], value[names[j]]).alias(f"cov_{i}_{j}")
        for i in range(len(names))
        for j in range(i, len(names))
    ]
    return df.groupBy(*by).agg(*aggs)


def _moment_solver() -> Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
    """Make ``solve_moments``.

    A function made inside another is sent to the executors whole, so they need
    NumPy and pandas but not this package.
    """
    least_share = LEAST_SHARE

    def solve_moments(mean: np.ndarray, cov: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Intercepts and coefficients of a stack of problems from means and covariances; the target comes last.

        Features are scaled to unit variance first. A constant feature gets the
        coefficient 0. Features that can't be told apart share the effect: of all
        least squares the smallest scaled coefficients are taken. The status tells
        either case; without a complete row it is ``incomplete`` and nothing is
        estimated.
        """
        k = mean.shape[1] - 1
        beta = np.full((len(mean), k + 1), np.nan)
        status = np.full(len(mean), "incomplete", dtype=object)
        usable = np.isfinite(mean).all(axis=1) & np.isfinite(cov).all(axis=(1, 2))
        if not usable.any():
            return beta, status
        mean, cov = mean[usable], cov[usable]
        scale = np.sqrt(np.maximum(np.diagonal(cov, axis1=1, axis2=2)[:, :k], 0.0))
        constant = scale <= 1e-12 * np.maximum(1.0, np.abs(mean[:, :k]))
        inverse = np.where(constant, 0.0, 1.0 / np.where(constant, 1.0, scale))
        correlation = cov[:, :k, :k] * inverse[:, :, None] * inverse[:, None, :]
        values, vectors = np.linalg.eigh(correlation)
        kept = values > least_share * np.maximum(values[:, -1:], 0.0)
        pull = np.einsum("bij,bi->bj", vectors, cov[:, :k, k] * inverse)
        pull = np.where(kept, pull / np.where(kept, values, 1.0), 0.0)
        coef = np.einsum("bij,bj->bi", vectors, pull) * inverse
        beta[usable] = np.column_stack([mean[:, k] - (coef * mean[:, :k]).sum(axis=1), coef])
        collinear = kept.sum(axis=1) < (~constant).sum(axis=1)
        status[usable] = np.where(
            constant.any(axis=1), "constant feature", np.where(collinear, "collinear features", "ok")
        )
        return beta, status

    return solve_moments


solve_moments = _moment_solver()


def fit_ols(
    df: DataFrame,
    features: Sequence[str] | None = None,
    target: str = TARGET,
    by: Sequence[str] = ("series",),
    digits: int | None = None,
) -> DataFrame:
    """Least squares with intercept, one model row per series.

    Columns: the series, ``intercept``, one ``coef_<feature>`` each, ``n`` (the
    rows that have every feature and the target) and ``status``: ``ok``,
    ``constant feature`` (its coefficient is 0), ``collinear features`` (they share
    the effect) or ``incomplete`` (no model). ``digits`` rounds the coefficients, for models that are published.
    """
    features = list(features or model_features())
    names = [*features, target]
    moments = series_moments(df, features, target, by)
    width = len(names)
    keys, outputs = list(by), ["intercept"] + [f"coef_{f}" for f in features]
    fields = [moments.schema[c] for c in by]
    fields += [T.StructField(c, T.DoubleType()) for c in outputs]
    fields += [T.StructField("n", T.LongType()), T.StructField("status", T.StringType())]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        upper = np.triu_indices(width)
        for pdf in batches:
            means = pdf[[f"mean_{i}" for i in range(width)]].to_numpy(float)
            covs = pdf[[f"cov_{i}_{j}" for i, j in zip(*upper)]].to_numpy(float)
            cov = np.zeros((len(pdf), width, width))
            cov[:, upper[0], upper[1]] = covs
            cov[:, upper[1], upper[0]] = covs
            rows, status = solve_moments(means, cov)
            out = pdf[keys].copy()
            for i, name in enumerate(outputs):
                out[name] = rows[:, i]
            out["n"] = pdf["n"]
            out["status"] = status
            yield out

    model = moments.mapInPandas(solve, T.StructType(fields))
    rounded = [
        (F.round(c, digits) if digits is not None else F.col(c)).alias(c) for c in outputs
    ]
    # NaN marks a missing coefficient inside numpy; SQL wants null.
    solved = F.col("status") != "incomplete"
    return model.select(
        *by, *[F.when(solved, c).alias(name) for c, name in zip(rounded, outputs)], "n", "status"
    )


def predict(
    df: DataFrame,
    model: DataFrame,
    features: Sequence[str] | None = None,
    by: Sequence[str] = ("series",),
    output: str = "y_pred",
) -> DataFrame:
    """Add the model's prediction."""
    features = list(features or model_features())
    coefs = model.select(*by, "intercept", *[f"coef_{f}" for f in features])
    joined = df.join(coefs, list(by))
    value = F.col("intercept")
    for f in features:
        value = value + F.col(f"coef_{f}") * F.col(f)
    return joined.select(*[joined[c] for c in df.columns], value.alias(output))


def fit_metrics(
    df: DataFrame, y: str = TARGET, yhat: str = "y_pred", by: Sequence[str] = ("series",)
) -> DataFrame:
    """R-squared and mean absolute percentage error per series.

    The target's spread comes from its variance, which Spark merges without
    the cancellation of a sum of squares.
    """
    error = F.col(y) - F.col(yhat)
    # The floor under |y| keeps weeks without sales finite.
    relative = F.abs(error) / F.greatest(F.abs(F.col(y)), F.lit(2.220446049250313e-16))
    sums = df.groupBy(*by).agg(
        F.avg(error * error).alias("mse"), F.var_pop(y).alias("spread"), F.avg(relative).alias("mape")
    )
    return sums.select(*by, (F.lit(1.0) - safe_ratio("mse", "spread")).alias("r2"), "mape")


def decompose(
    df: DataFrame,
    model: DataFrame,
    channels: Sequence[Channel] = CHANNELS,
    by: Sequence[str] = ("series",),
    order: str = "week_start",
    target: str = TARGET,
) -> DataFrame:
    """Split each week's prediction into baseline, channels and season."""
    features = model_features(channels)
    coefs = model.select(*by, "intercept", *[f"coef_{f}" for f in features])
    joined = df.join(coefs, list(by))
    contributions = [(F.col(c.beta) * F.col(c.transformed)).alias(c.contribution) for c in channels]
    sine, cosine = SEASON
    seasonal = F.col(f"coef_{sine}") * F.col(sine) + F.col(f"coef_{cosine}") * F.col(cosine)
    prediction = F.col("intercept")
    for f in features:
        prediction = prediction + F.col(f"coef_{f}") * F.col(f)
    return joined.select(
        *by,
        order,
        target,
        F.col("intercept").alias("contrib_baseline"),
        *contributions,
        seasonal.alias("contrib_seasonality"),
        prediction.alias("y_pred"),
    )


def _parts(channels: Sequence[Channel]) -> list[str]:
    return ["contrib_baseline", *[c.contribution for c in channels], "contrib_seasonality"]


def decomposition_residual(
    parts: DataFrame, channels: Sequence[Channel] = CHANNELS, by: Sequence[str] = ("series",)
) -> DataFrame:
    """Largest difference between the sum of the parts and the prediction, and whether it is below 1."""
    whole = sum((F.col(c) for c in _parts(channels)[1:]), F.col("contrib_baseline"))
    largest = parts.groupBy(*by).agg(F.max(F.abs(whole - F.col("y_pred"))).alias("max_residual"))
    return largest.select(*by, "max_residual", (F.col("max_residual") < 1).alias("ok"))


def contribution_shares(
    parts: DataFrame,
    channels: Sequence[Channel] = CHANNELS,
    by: Sequence[str] = ("series",),
    target: str = TARGET,
) -> DataFrame:
    """Share of every part in total sales, one row per series and part."""
    names = _parts(channels)
    sums = parts.groupBy(*by).agg(F.sum(target).alias("total"), *[F.sum(c).alias(c) for c in names])
    shares = sums.select(
        *by, *[safe_ratio(c, "total").alias(c.removeprefix("contrib_")) for c in names]
    )
    return shares.unpivot(list(by), [c.removeprefix("contrib_") for c in names], "source", "share")


def steady_factor(decay: float, periods: int = 10) -> float:
    """Adstock per unit of constant spend after ``periods`` periods, in closed form."""
    return float(periods) if decay == 1 else (1 - decay**periods) / (1 - decay)


def steady_adstock(spend: Column, decay: float, periods: int = 10) -> Column:
    """Adstock after ``periods`` periods of constant spend."""
    return spend * F.lit(steady_factor(decay, periods))


def steady_response(
    beta: Column, spend: Column, channel: Channel, periods: int = 10, form: str = "spend"
) -> Column:
    """Sales contribution of constant spend."""
    saturation = hill(
        steady_adstock(spend, channel.decay, periods), channel.half_saturation, channel.exponent
    )
    return beta * saturation * spend if form == "spend" else beta * saturation


def average_spend(
    weekly: DataFrame, channels: Sequence[Channel] = CHANNELS, by: Sequence[str] = ("series",)
) -> DataFrame:
    """Mean and maximum spend per series and channel, wide: ``mean_<name>``, ``max_<name>``."""
    return weekly.groupBy(*by).agg(
        *[F.avg(c.spend).alias(f"mean_{c.name}") for c in channels],
        *[F.max(c.spend).alias(f"max_{c.name}") for c in channels],
    )


def _per_channel(
    model: DataFrame, spend: DataFrame, channels: Sequence[Channel], by: Sequence[str]
) -> DataFrame:
    """One row per series and channel with its coefficient, mean and maximum spend."""
    wide = model.select(*by, *[c.beta for c in channels]).join(spend, list(by))
    rows = F.array(
        *[
            F.struct(
                F.lit(c.name).alias("channel"),
                F.col(c.beta).alias("beta"),
                F.col(f"mean_{c.name}").cast("double").alias("mean_spend"),
                F.col(f"max_{c.name}").cast("double").alias("max_spend"),
            )
            for c in channels
        ]
    )
    return wide.select(*by, F.inline(rows))


def _by_channel(channels: Sequence[Channel], value) -> Column:
    """The expression ``value(channel)`` of the row's channel."""
    first, *rest = channels
    out = F.when(F.col("channel") == first.name, value(first))
    for c in rest:
        out = out.when(F.col("channel") == c.name, value(c))
    return out


def steady_state_response(
    model: DataFrame,
    weekly: DataFrame,
    channels: Sequence[Channel] = CHANNELS,
    by: Sequence[str] = ("series",),
    periods: int = 10,
    form: str = "spend",
) -> DataFrame:
    """Response of every channel at its average weekly spend, held for ``periods`` weeks."""
    rows = _per_channel(model, average_spend(weekly, channels, by), channels, by)
    spend = F.col("mean_spend")
    return rows.select(
        *by,
        "channel",
        "mean_spend",
        _by_channel(channels, lambda c: steady_adstock(spend, c.decay, periods)).alias("adstock"),
        _by_channel(
            channels, lambda c: steady_response(F.col("beta"), spend, c, periods, form)
        ).alias("response"),
    )


def marginal_return(
    model: DataFrame,
    weekly: DataFrame,
    channels: Sequence[Channel] = CHANNELS,
    by: Sequence[str] = ("series",),
    periods: int = 10,
    step: float = 0.01,
    form: str = "spend",
) -> DataFrame:
    """Extra response per extra unit of spend at the average, by a forward difference.

    The step is added to the adstock level itself, not to the spend that built it up.
    """
    rows = _per_channel(model, average_spend(weekly, channels, by), channels, by)
    spend = F.col("mean_spend")
    delta = spend * F.lit(step)

    def moved(c: Channel) -> Column:
        level = steady_adstock(spend, c.decay, periods) + delta
        saturation = hill(level, c.half_saturation, c.exponent)
        return F.col("beta") * saturation * (spend + delta if form == "spend" else F.lit(1.0))

    at_mean = _by_channel(channels, lambda c: steady_response(F.col("beta"), spend, c, periods, form))
    compared = rows.select(
        *by,
        "channel",
        "mean_spend",
        delta.alias("delta"),
        at_mean.alias("response"),
        _by_channel(channels, moved).alias("response_up"),
    )
    return compared.select(
        *by,
        "channel",
        "mean_spend",
        safe_ratio(F.col("response_up") - F.col("response"), "delta").alias("marginal_return"),
    )


def response_curve(
    model: DataFrame,
    weekly: DataFrame,
    channels: Sequence[Channel] = CHANNELS,
    by: Sequence[str] = ("series",),
    points: int = 300,
    periods: int = 10,
    mode: str = "steady",
    form: str = "spend",
) -> DataFrame:
    """Response of every channel for ``points`` spend levels from 0 to twice the maximum.

    ``mode="steady"`` holds each level for ``periods`` weeks. ``mode="sequence"``
    feeds the levels through adstock one after the other, as if they were weeks.
    """
    if mode not in ("steady", "sequence"):
        raise ValueError(f"mode must be 'steady' or 'sequence', not {mode!r}")
    rows = _per_channel(model, average_spend(weekly, channels, by), channels, by)
    step = F.col("max_spend") * 2 / F.lit(points - 1)
    grid = rows.select(
        *by, "channel", "beta", step.alias("step"), F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("point")
    ).withColumn("spend", F.col("point") * F.col("step"))
    spend = F.col("spend")
    if mode == "steady":
        response = _by_channel(
            channels, lambda c: steady_response(F.col("beta"), spend, c, periods, form)
        )
    else:
        # Each window holds the grid points of one channel of one series.
        along = Window.partitionBy(*by, "channel").orderBy("point")

        def through(c: Channel) -> Column:
            saturation = hill(adstock_over("spend", c.decay, along), c.half_saturation, c.exponent)
            return F.col("beta") * saturation * (spend if form == "spend" else F.lit(1.0))

        response = _by_channel(channels, through)
    return grid.select(*by, "channel", "point", "spend", response.alias("response"))


def parameter_recovery(
    model: DataFrame,
    truth: DataFrame,
    channels: Sequence[Channel] = CHANNELS,
    by: Sequence[str] = ("series",),
) -> DataFrame:
    """Estimated beside true parameters and the relative error; ``truth`` has param and value."""
    named = model.select(
        *by,
        *[F.col(c.beta).alias(f"beta_{c.name}") for c in channels],
        F.col("intercept").alias("baseline"),
    )
    params = [f"beta_{c.name}" for c in channels] + ["baseline"]
    long = named.unpivot(list(by), params, "param", "estimate")
    error = safe_ratio(F.abs(F.col("estimate") - F.col("value")), F.abs(F.col("value")))
    return long.join(truth.select("param", "value"), "param").select(
        *by, "param", F.col("value").alias("true_value"), "estimate", error.alias("relative_error")
    )
