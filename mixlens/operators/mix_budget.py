"""Allocation of a fixed budget over channels."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mixlens.functions.ratios import safe_ratio
from mixlens.operators.mix import CHANNELS, FORMS, Channel
from mixlens.operators.mix_model import average_spend, steady_factor, steady_response

Bounds = Mapping[str, tuple[float, float]]


def optimize_budget(
    model: DataFrame,
    weekly: DataFrame,
    channels: Sequence[Channel] = CHANNELS,
    by: Sequence[str] = ("series",),
    budget: float | None = None,
    step: float = 0.01,
    bounds: Bounds | None = None,
    periods: int = 10,
    form: str = "spend",
) -> DataFrame:
    """The best allocation of the budget in parts of ``step``, one row per series.

    The budget is the average weekly total unless given; ``bounds`` limits a
    channel's share of it. Contributions add up over channels, so the best
    split of every smaller budget is carried from channel to channel: the
    result is the best of all combinations, without listing them. Ties go to
    the earlier channels. Series without a model or without an allowed
    combination have null allocations.
    """
    steps = round(1 / step)
    if steps < 1 or abs(steps * step - 1) > 1e-9:
        raise ValueError("1 must be a multiple of step")
    if form not in FORMS:
        raise ValueError(f"form must be one of {FORMS}, not {form!r}")
    if "spend_total" in weekly.columns:
        spent = F.col("spend_total")
    else:
        spent = sum((F.col(c.spend) for c in channels[1:]), F.col(channels[0].spend))
    amount = F.lit(float(budget)) if budget is not None else F.avg(spent)
    budgets = weekly.groupBy(*by).agg(amount.cast("double").alias("budget"))
    known = model.select(*by, *[c.beta for c in channels]).join(budgets, list(by))

    # What goes to the executors is plain data, so they do not need this package.
    keys, columns = list(by), [f"optimal_{c.name}" for c in channels]
    shapes = [
        (c.beta, steady_factor(c.decay, periods), c.half_saturation, c.exponent, *(bounds or {}).get(c.name, (0, 1)))
        for c in channels
    ]
    share = np.arange(steps + 1) / steps

    def allocate(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            spend = pdf["budget"].to_numpy(float)[:, None] * share
            best, taken = None, []
            for beta, factor, k, n, low, high in shapes:
                powered = (spend * factor) ** n
                own = pdf[beta].to_numpy(float)[:, None] * (powered / (k**n + powered))
                if form == "spend":
                    own = own * spend
                own[:, (share < low - 1e-12) | (share > high + 1e-12)] = -np.inf
                if best is None:
                    best = own
                    continue
                # Give this channel 0, 1, 2 ... parts and the channels before it the rest.
                joint, parts = np.full_like(best, -np.inf), np.zeros(best.shape, int)
                for j in range(steps + 1):
                    value = best[:, : steps + 1 - j] + own[:, j : j + 1]
                    better = value > joint[:, j:]
                    joint[:, j:][better] = value[better]
                    parts[:, j:][better] = j
                best = joint
                taken.append(parts)
            response = best[:, steps]
            feasible = np.isfinite(response)
            # Walk back from the last channel: what it takes leaves the rest to those before.
            rows, left, allotted = np.arange(len(pdf)), np.full(len(pdf), steps), []
            for parts in reversed(taken):
                allotted.insert(0, parts[rows, left])
                left = left - allotted[0]
            allotted.insert(0, left)
            out = pdf[[*keys, "budget"]].copy()
            for name, parts in zip(columns, allotted):
                out[name] = np.where(feasible, spend[rows, parts], np.nan)
            out["optimal_response"] = np.where(feasible, response, np.nan)
            yield out

    fields = [known.schema[c] for c in keys]
    fields += [T.StructField(c, T.DoubleType()) for c in ("budget", *columns, "optimal_response")]
    return known.mapInPandas(allocate, T.StructType(fields))


def allocation_report(
    optimum: DataFrame,
    model: DataFrame,
    weekly: DataFrame,
    channels: Sequence[Channel] = CHANNELS,
    by: Sequence[str] = ("series",),
    periods: int = 10,
    form: str = "spend",
) -> DataFrame:
    """Current and optimal spend per channel, the change, and the uplift of the whole allocation."""
    means = average_spend(weekly, channels, by)
    joined = optimum.join(model.select(*by, *[c.beta for c in channels]), list(by)).join(means, list(by))
    current = [
        steady_response(F.col(c.beta), F.col(f"mean_{c.name}").cast("double"), c, periods, form)
        for c in channels
    ]
    rows = F.array(
        *[
            F.struct(
                F.lit(c.label).alias("channel"),
                F.col(f"mean_{c.name}").cast("double").alias("current_spend"),
                F.col(f"optimal_{c.name}").alias("optimal_spend"),
            )
            for c in channels
        ]
    )
    long = joined.withColumn("current_response", sum(current[1:], current[0])).select(
        *by, "current_response", "optimal_response", F.inline(rows)
    )
    change = safe_ratio(F.col("optimal_spend") - F.col("current_spend"), "current_spend") * 100
    return long.select(
        *by,
        "channel",
        "current_spend",
        "optimal_spend",
        change.alias("change_pct"),
        "current_response",
        "optimal_response",
        (F.col("optimal_response") - F.col("current_response")).alias("uplift"),
        (safe_ratio("optimal_response", "current_response") - 1).alias("uplift_pct"),
    )
