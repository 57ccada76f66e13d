"""Searches and resampling over many fits per series.

A series has one row per week, so it is bounded by the calendar. What is many
are combinations and replicates: both are spread over tasks, each solves a stack
of small problems at once, and the results are combined by aggregates.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixlens.functions.dates import season
from mixlens.operators.mix import CHANNELS, FORMS, Channel
from mixlens.operators.mix_model import SEASON, TARGET, model_features, solve_moments

# Decays and half-saturation factors that the search tries by default.
DECAYS = (0.3, 0.5, 0.7)
K_FACTORS = (0.5, 1.0, 2.0)

# Combinations that a task solves in one stack.
STACK = 4096


def _one_row_per_week(
    weekly: DataFrame, channels: Sequence[Channel], by: Sequence[str], order: str, week: str, target: str
) -> DataFrame:
    # Unknown spend counts as none; a week without a target stays without one.
    summed = weekly.groupBy(*by, order, week).agg(
        *[F.coalesce(F.sum(F.col(c.spend).cast("double")), F.lit(0.0)).alias(c.spend) for c in channels],
        F.sum(F.col(target).cast("double")).alias(target),
    )
    sine, cosine = season(week)
    return summed.select("*", sine.alias(SEASON[0]), cosine.alias(SEASON[1]))


def grid_search(
    weekly: DataFrame,
    channels: Sequence[Channel] = CHANNELS,
    by: Sequence[str] = ("series",),
    decays: Mapping[str, Sequence[float]] | None = None,
    half_saturations: Mapping[str, Sequence[float]] | None = None,
    keep: str = "best",
    form: str = "spend",
    order: str = "week_start",
    week: str = "week",
    target: str = TARGET,
) -> DataFrame:
    """Fit every combination of decay and half-saturation, per series.

    The features of all settings of all channels are built once per series and
    their joint covariance is computed once. The combinations are numbered; each
    task takes a range of numbers, solves the small parts of the covariance they
    stand for in one stack and reports its best. ``keep="best"`` returns the
    combination with the least squared error, the first of equal ones;
    ``keep="all"`` every one. A channel that a series never uses gets no weight
    in any combination, so each series has a result.
    """
    if keep not in ("best", "all"):
        raise ValueError(f"keep must be 'best' or 'all', not {keep!r}")
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}, not {form!r}")
    settings = []
    for c in channels:
        ds = (decays or {}).get(c.name, DECAYS)
        ks = (half_saturations or {}).get(c.name, [c.half_saturation * f for f in K_FACTORS])
        settings.append([(float(d), float(k)) for d in ds for k in ks])
    sizes = [len(s) for s in settings]
    starts = np.cumsum([0, *sizes])
    total, combinations = int(starts[-1]), math.prod(sizes)

    panel = _one_row_per_week(weekly, channels, by, order, week, target)
    key_fields = [panel.schema[c] for c in by]
    # What goes to the executors is plain data, so they do not need this package.
    keys, shapes = list(by), [(c.spend, c.exponent) for c in channels]

    def carry_over(x: np.ndarray, rates: np.ndarray) -> np.ndarray:
        """Adstock of one series for several decays at once: shape (weeks, decays)."""
        out = np.empty((len(x), len(rates)))
        level = np.zeros(len(rates))
        for t, value in enumerate(x):
            level = value + rates * level
            out[t] = level
        return out

    def moments(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order)
        blocks = []
        for (spend, exponent), options in zip(shapes, settings):
            x = pdf[spend].to_numpy(float)
            unique = sorted({d for d, _ in options})
            stocked = carry_over(x, np.array(unique))
            for d, k in options:
                powered = stocked[:, unique.index(d)] ** exponent
                saturation = powered / (k**exponent + powered)
                blocks.append(saturation * x if form == "spend" else saturation)
        data = np.column_stack([*blocks, *[pdf[s].to_numpy(float) for s in SEASON], pdf[target].to_numpy(float)])
        # Weeks without a target still carry spend over, but are not fitted.
        data = data[~np.isnan(data[:, -1])]
        row = [pdf[c].iloc[0] for c in keys]
        if not len(data):
            row += [0, [np.nan] * data.shape[1], [np.nan] * data.shape[1] ** 2]
        else:
            row += [len(data), data.mean(axis=0).tolist(), np.cov(data, rowvar=False, bias=True).ravel().tolist()]
        return pd.DataFrame([row], columns=[*keys, "n", "means", "covs"])

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        common = np.array([total, total + 1, total + 2])
        for pdf in batches:
            for at in range(len(pdf)):
                r = pdf.iloc[at]
                mean = np.array(r["means"], float)
                cov = np.array(r["covs"], float).reshape(len(mean), len(mean))
                number = np.arange(r["block"] * STACK, min(combinations, (r["block"] + 1) * STACK))
                picks = np.unravel_index(number, sizes)
                index = np.column_stack([*[s + p for s, p in zip(starts, picks)], np.tile(common, (len(number), 1))])
                stack = cov[index[:, :, None], index[:, None, :]]
                beta, _ = solve_moments(mean[index], stack)
                spread = cov[-1, -1]
                mse = np.maximum(spread - (beta[:, 1:] * stack[:, :-1, -1]).sum(axis=1), 0.0)
                if keep == "best":
                    best = [int(np.argmin(np.where(np.isnan(mse), np.inf, mse)))]
                    number, mse, picks = number[best], mse[best], [p[best] for p in picks]
                out = pd.DataFrame({c: [r[c]] * len(number) for c in keys})
                for name, options, pick in zip(names, settings, picks):
                    out[f"decay_{name}"] = np.array([d for d, _ in options])[pick]
                    out[f"half_saturation_{name}"] = np.array([k for _, k in options])[pick]
                out["sse"] = r["n"] * mse
                out["r2"] = 1 - mse / spread if spread > 0 else np.nan
                out["number"] = number
                yield out

    names = [c.name for c in channels]
    moment_fields = [
        T.StructField("n", T.LongType()),
        T.StructField("means", T.ArrayType(T.DoubleType())),
        T.StructField("covs", T.ArrayType(T.DoubleType())),
    ]
    fields = [*key_fields]
    for name in names:
        fields += [T.StructField(f"{p}_{name}", T.DoubleType()) for p in ("decay", "half_saturation")]
    fields += [T.StructField(n, T.DoubleType()) for n in ("sse", "r2")]
    results = [f.name for f in fields[len(by):]]
    numbered = T.StructType([*fields, T.StructField("number", T.LongType())])

    per_series = panel.groupBy(*by).applyInPandas(moments, T.StructType([*key_fields, *moment_fields]))
    blocks = per_series.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit((combinations - 1) // STACK))))
    # A key for each range of numbers: the ranges of one series go to different tasks.
    found = blocks.repartition(*by, "block").mapInPandas(search, numbered)
    found = found.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("sse", "r2")})
    if keep == "all":
        return found.drop("number")
    first = F.struct(F.coalesce("sse", F.lit(float("inf"))).alias("least"), "number", *results)
    return found.groupBy(*by).agg(F.min(first).alias("best")).select(*by, *[f"best.{c}" for c in results])


# Replicates that a task draws and solves in one stack.
REPLICATES = 50


def poisson_steps() -> list[float]:
    """Cumulative probabilities of Poisson(1): a draw is how many of them a uniform number has reached.

    They end where the rest is below the step of a 52-bit uniform number, so no
    draw is cut off.
    """
    density = cumulative = math.exp(-1.0)
    steps = []
    while 1.0 - cumulative > 2.0**-53:
        steps.append(cumulative)
        density = density / (len(steps))
        cumulative = cumulative + density
    return steps


def roi_intervals(
    df: DataFrame,
    channels: Sequence[Channel] = CHANNELS,
    by: Sequence[str] = ("series",),
    replicates: int = 500,
    ci: float = 0.9,
    order: str = "week_start",
    target: str = TARGET,
) -> DataFrame:
    """Return on spend and share of sales per channel with bootstrap intervals.

    ``df`` has the transformed and seasonal features. Each replicate draws a
    Poisson weight per week from the MD5 of series, week and replicate, so a
    repeated task draws the same. A series is one row of lists, bounded by the
    calendar; its replicates are spread over tasks in blocks, and each task
    solves a block's models in one stack. This is not a Bayesian posterior:
    there are no priors, and its intervals differ from those of a sampled model.
    ``replicates_used`` counts the replicates with more weeks than features and
    features that can be told apart; rows that lack a feature or the target are
    not drawn.
    """
    features = model_features(channels)
    names = [*features, target, *[c.spend for c in channels]]
    complete = F.lit(True)
    for name in (*features, target):
        complete = complete & F.col(name).isNotNull()
    key = F.concat_ws("|", *[F.col(c).cast("string") for c in (*by, order)])
    rows = df.where(complete).select(
        *by, F.struct(key.alias("key"), *[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(names)]).alias("week")
    )
    series = rows.groupBy(*by).agg(F.sort_array(F.collect_list("week")).alias("weeks"))
    lists = series.select(
        *by, F.col("weeks.key").alias("keys"), *[F.col(f"weeks.x{i}").alias(f"x{i}") for i in range(len(names))]
    )
    blocks = lists.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit((replicates - 1) // REPLICATES))))
    blocks = blocks.repartition(*by, "block")
    # What goes to the executors is plain data, so they do not need this package.
    ids, width, count, size = list(by), len(features) + 1, len(channels), REPLICATES
    steps = np.array(poisson_steps())
    fields = [lists.schema[c] for c in by]
    fields += [T.StructField(c, T.DoubleType()) for i in range(count) for c in (f"roi_{i}", f"share_{i}")]

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from hashlib import md5

        for pdf in batches:
            for at in range(len(pdf)):
                r = pdf.iloc[at]
                data = np.column_stack([np.asarray(r[f"x{i}"], float) for i in range(width + count)])
                numbers = range(r["block"] * size, min(replicates, (r["block"] + 1) * size))
                digests = [[md5(f"{k}|{n}".encode()).hexdigest() for k in r["keys"]] for n in numbers]
                uniform = np.array([[int(d[:13], 16) for d in row] for row in digests]) / 2.0**52
                weights = np.searchsorted(steps, uniform, side="right").astype(float)
                weights = weights[weights.sum(axis=1) > width - 1]
                share = weights / weights.sum(axis=1, keepdims=True)
                # Moments around the series' own means: far from zero their differences would cancel.
                centre = data[:, :width].mean(axis=0)
                near = data[:, :width] - centre
                mean = share @ near
                cov = np.einsum("rw,wi,wj->rij", share, near, near, optimize=True) - mean[:, :, None] * mean[:, None, :]
                beta, status = solve_moments(mean, cov)
                whole, spend = mean + centre, share @ data[:, width:]
                out = pd.DataFrame({c: [r[c]] * len(share) for c in ids})
                with np.errstate(divide="ignore", invalid="ignore"):
                    for i in range(count):
                        part = beta[:, 1 + i] * whole[:, i]
                        out[f"roi_{i}"] = part / spend[:, i]
                        out[f"share_{i}"] = 100 * part / whole[:, -1]
                yield out[status == "ok"]

    solved = blocks.mapInPandas(solve, T.StructType(fields))
    long = solved.select(
        *by,
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c.name).alias("channel"), F.col(f"roi_{i}").alias("roi"), F.col(f"share_{i}").alias("share"))
                    for i, c in enumerate(channels)
                ]
            )
        ),
    )
    tail = (1 - ci) / 2
    stats = []
    for column, label in (("roi", "roi"), ("share", "contribution_pct")):
        finite = F.when(~F.isnan(column), F.col(column))
        stats.append(F.avg(finite).alias(f"{label}_mean"))
        stats += [
            F.percentile(finite, F.lit(q)).alias(f"{label}_{name}")
            for name, q in (("median", 0.5), ("ci_lo", tail), ("ci_hi", 1 - tail))
        ]
    return long.groupBy(*by, "channel").agg(*stats, F.count("*").alias("replicates_used"))
