"""Mix operators on an invented series, against NumPy, and properties."""

from __future__ import annotations

import datetime as dt
import itertools
import math
import random
from hashlib import md5

import numpy as np
import pytest
from support import rows
from pyspark.sql import functions as F

from mixlens.operators import mix, mix_budget, mix_model, mix_search


TRUE = {"baseline": 8000.0, "beta_sp": 3.5, "beta_sb": 2.0, "beta_dsp": 1.2}
SCHEMA = (
    "series string, week_start date, year int, week int, spend_sp double, spend_sb double, spend_dsp double, "
    "spend_total double, impressions_total long, clicks_total long, ad_sales double, ad_orders long, "
    "total_sales double, organic_sales double"
)


def invented(name="national", weeks=104, seed=3):
    """Weekly rows whose sales follow the model with the true parameters and some noise."""
    rng = np.random.default_rng(seed)
    start, spend = dt.date(2023, 1, 2), {}
    days = [start + dt.timedelta(weeks=i) for i in range(weeks)]
    week = np.array([d.isocalendar()[1] for d in days])
    for c, level in zip(mix.CHANNELS, (2600.0, 1300.0, 800.0)):
        spend[c] = np.round(level * (1 + 0.5 * np.sin(week / 4 + level)) * rng.uniform(0.6, 1.4, weeks), 2)
    sales = TRUE["baseline"] + 700 * np.sin(2 * np.pi * week / 52) + rng.normal(0, 150, weeks)
    for c in mix.CHANNELS:
        stocked = np.array(loop_adstock(spend[c], c.decay))
        sales = sales + TRUE[f"beta_{c.name}"] * stocked**2 / (c.half_saturation**2 + stocked**2) * spend[c]
    out = []
    for i, d in enumerate(days):
        parts = [float(spend[c][i]) for c in mix.CHANNELS]
        total, value = round(sum(parts), 2), round(float(sales[i]), 2)
        ads = round(0.4 * value, 2)
        out.append((name, d, d.year, int(week[i]), *parts, total, int(total * 90), int(total * 0.8), ads, int(ads / 30), value, round(value - ads, 2)))
    return out


@pytest.fixture(scope="module")
def weekly(spark):
    return spark.createDataFrame(invented(), SCHEMA).cache()


@pytest.fixture(scope="module")
def solved(features):
    """The same fit by NumPy: coefficients, features and target."""
    pdf = features.toPandas().sort_values("week_start")
    x, y = pdf[mix_model.model_features()].to_numpy(), pdf["total_sales"].to_numpy()
    return lstsq(x, y)[0], x, y


@pytest.fixture(scope="module")
def features(weekly):
    return mix.season_features(mix.transform_channels(weekly)).cache()


@pytest.fixture(scope="module")
def model(features):
    return mix_model.fit_ols(features).cache()


def series_of(spark, values, name="s", start=dt.date(2024, 1, 1)):
    return spark.createDataFrame(
        [(name, start + dt.timedelta(weeks=i), v) for i, v in enumerate(values)], "series string, week_start date, spend double"
    )


def loop_adstock(x, decay):
    out, level = [], 0.0
    for v in x:
        level = v + decay * level
        out.append(level)
    return out


@pytest.mark.parametrize("decay", [0.0, 0.3, 0.5, 0.7, 0.95])
def test_adstock_is_the_recurrence(spark, decay):
    rnd = random.Random(1)
    values = [rnd.uniform(0, 3000) for _ in range(500)]
    other = [rnd.uniform(0, 10) for _ in range(3)]
    df = series_of(spark, values).unionByName(series_of(spark, other, "t"))
    got = mix.adstock(df, "spend", decay, ["series"], "week_start").orderBy("series", "week_start").collect()
    want = loop_adstock(values, decay) + loop_adstock(other, decay)
    assert np.allclose([r["adstock_spend"] for r in got], want, rtol=1e-14)


def test_adstock_null_is_zero_and_bad_decay_fails(spark):
    df = series_of(spark, [8.0, None, 4.0])
    got = mix.adstock(df, "spend", 0.5, ["series"], "week_start").orderBy("week_start").collect()
    assert [r["adstock_spend"] for r in got] == [8.0, 4.0, 6.0]
    with pytest.raises(ValueError):
        mix.memory_length(1.0)


def test_hill(spark):
    df = spark.createDataFrame([(0.0,), (3000.0,), (6000.0,), (1e9,)], "x double")
    got = [r[0] for r in df.select(mix.hill("x", 3000)).collect()]
    assert got[:3] == [0.0, 0.5, 0.8] and 0.999 < got[3] <= 1


def test_coefficients(model, solved):
    m = model.first()
    got = [m["intercept"], *[m[f"coef_{f}"] for f in mix_model.model_features()]]
    assert np.allclose(got, solved[0], rtol=1e-9) and m["status"] == "ok" and m["n"] == 104


def test_metrics(features, model, solved):
    beta, x, y = solved
    error = y - beta[0] - x @ beta[1:]
    got = mix_model.fit_metrics(mix_model.predict(features, model)).first()
    assert np.allclose([got["r2"], got["mape"]], [1 - (error**2).mean() / y.var(), np.abs(error / y).mean()], atol=1e-9)
    assert got["r2"] > 0.98


def test_decomposition(features, model, solved):
    beta, x, y = solved
    parts = mix_model.decompose(features, model)
    check = mix_model.decomposition_residual(parts).first()
    assert check["ok"] and check["max_residual"] < 1e-6
    shares = {r["source"]: r["share"] for r in mix_model.contribution_shares(parts).collect()}
    want = {"baseline": beta[0] * len(y), **{c.name: beta[1 + i] * x[:, i].sum() for i, c in enumerate(mix.CHANNELS)}}
    assert all(abs(shares[k] - v / y.sum()) < 1e-9 for k, v in want.items())


def test_returns_at_the_average(weekly, model):
    m = model.first()
    got = {r["channel"]: r["marginal_return"] for r in mix_model.marginal_return(model, weekly).collect()}
    steady = {r["channel"]: r for r in mix_model.steady_state_response(model, weekly).collect()}
    for c in mix.CHANNELS:
        mean = weekly.agg(F.avg(c.spend)).first()[0]
        row = steady[c.name]
        assert abs(row["mean_spend"] - mean) < 1e-9
        assert abs(row["adstock"] - loop_adstock([mean] * 10, c.decay)[-1]) < 1e-9
        saturation = row["adstock"] ** 2 / (c.half_saturation**2 + row["adstock"] ** 2)
        assert abs(row["response"] - m[c.beta] * saturation * mean) < 1e-6

        def response(level, spend, c=c):
            return m[c.beta] * level**2 / (c.half_saturation**2 + level**2) * spend

        step = 0.01 * mean
        moved = response(row["adstock"] + step, mean + step) - row["response"]
        assert abs(got[c.name] - moved / step) < 1e-6


def test_response_curves(weekly, model):
    m = model.first()
    peak = weekly.agg(F.max("spend_sb")).first()[0]
    grid = np.linspace(0, 2 * peak, 300)
    curve = mix_model.response_curve(model, weekly, mode="sequence").where("channel = 'sb'").orderBy("point").collect()
    stocked = np.array(loop_adstock(grid, 0.3))
    want = m["coef_transformed_spend_sb"] * stocked**2 / (1500**2 + stocked**2) * grid
    assert np.allclose([r["spend"] for r in curve], grid) and np.allclose([r["response"] for r in curve], want)
    steady = mix_model.response_curve(model, weekly).where("channel = 'sb'").orderBy("point").collect()
    level = grid * (1 - 0.3**10) / 0.7
    assert np.allclose([r["response"] for r in steady], m["coef_transformed_spend_sb"] * level**2 / (1500**2 + level**2) * grid)


def test_budget(weekly, model):
    best = mix_budget.optimize_budget(model, weekly)
    got = best.first()
    parts = [got["optimal_sp"], got["optimal_sb"], got["optimal_dsp"]]
    assert abs(got["budget"] - weekly.agg(F.avg("spend_total")).first()[0]) < 1e-6 and abs(sum(parts) - got["budget"]) < 1e-6
    report = {r["channel"]: r for r in mix_budget.allocation_report(best, model, weekly).collect()}
    current = sum(r["response"] for r in mix_model.steady_state_response(model, weekly).collect())
    assert abs(report["DSP"]["uplift"] - (got["optimal_response"] - current)) < 1e-6 and report["DSP"]["uplift"] > 0


@pytest.mark.parametrize("bounds", [{}, {"sp": (0.1, 0.4), "dsp": (0.2, 0.6)}, {"sp": (0.9, 1.0), "sb": (0.5, 1.0)}])
@pytest.mark.parametrize("form", ["spend", "saturating"])
def test_budget_equals_exhaustive_search(spark, bounds, form):
    rnd = random.Random(5)
    series = [f"s{i}" for i in range(6)]
    spends = spark.createDataFrame([(s, *[rnd.uniform(100, 4000) for _ in range(3)]) for s in series], "series string, spend_sp double, spend_sb double, spend_dsp double")
    betas = {s: [rnd.uniform(-1, 4) * (1000 if form == "saturating" else 1) for _ in range(3)] for s in series}
    model = spark.createDataFrame([(s, *b) for s, b in betas.items()], "series string, " + ", ".join(f"{c.beta} double" for c in mix.CHANNELS))
    got = {r["series"]: r for r in mix_budget.optimize_budget(model, spends, step=0.05, bounds=bounds, form=form).collect()}
    for row in spends.collect():
        budget, best = row["spend_sp"] + row["spend_sb"] + row["spend_dsp"], None
        for parts in itertools.product(range(21), repeat=3):
            ok = sum(parts) == 20 and all(bounds.get(c.name, (0, 1))[0] - 1e-9 <= p / 20 <= bounds.get(c.name, (0, 1))[1] + 1e-9 for c, p in zip(mix.CHANNELS, parts))
            if ok:
                value = 0.0
                for c, p, b in zip(mix.CHANNELS, parts, betas[row["series"]]):
                    x = budget * p / 20
                    level = loop_adstock([x] * 10, c.decay)[-1]
                    value += b * level**2 / (c.half_saturation**2 + level**2) * (x if form == "spend" else 1)
                if best is None or value > best:
                    best = value
        found = got[row["series"]]
        if best is None:
            assert found["optimal_response"] is None and found["optimal_sp"] is None
        else:
            assert abs(found["optimal_response"] - best) < 1e-9 * max(1, abs(best))
            assert abs(found["optimal_sp"] + found["optimal_sb"] + found["optimal_dsp"] - budget) < 1e-6


def test_budget_step_must_divide_one(weekly, model):
    with pytest.raises(ValueError):
        mix_budget.optimize_budget(model, weekly, step=0.3)


def test_recovery(spark, model):
    truth = spark.createDataFrame([(k, v, "") for k, v in TRUE.items()], "param string, value double, description string")
    m = model.first()
    got = {r["param"]: r["relative_error"] for r in mix_model.parameter_recovery(model, truth).collect()}
    assert abs(got["baseline"] - abs(m["intercept"] / 8000 - 1)) < 1e-9 and len(got) == 4
    assert got["baseline"] < 0.1 and got["beta_sp"] < 0.1


def test_kpis(weekly):
    both = {r["week_start"]: r for r in mix.weekly_kpis(weekly).collect()}
    for r in weekly.collect():
        assert abs(both[r["week_start"]]["roas"] - r["ad_sales"] / r["spend_total"]) < 1e-3
        assert abs(both[r["week_start"]]["tacos"] - r["spend_total"] / r["total_sales"]) < 1e-3
    spend, sales = weekly.agg(F.sum("spend_total"), F.sum("total_sales")).first()
    assert abs(mix.kpi_total(weekly).first()["tacos"] - spend / sales) < 1e-9
    cards = rows(mix.scorecard_yoy(weekly).select("year", "spend_yoy", "roas_yoy"), "year")
    assert cards[0][1:] == (None, None) and cards[1][0] == 2024 and cards[1][1] is not None


def test_mix_shares_add_up(spark, weekly):
    from mixlens.operators.facts import channel_spend_long

    shares = mix.channel_mix(channel_spend_long(weekly))
    assert all(abs(r[0] - 1) < 1e-12 for r in shares.groupBy("period").agg(F.sum("share")).select("sum(share)").collect())
    split = mix.ads_organic_split(weekly).collect()
    assert all(abs(r["ad_share"] + r["organic_share"] - 1) < 1e-4 for r in split)


def test_constant_and_equal_features_still_give_a_model(spark, features, solved):
    flat = features.withColumn("series", F.lit("flat")).withColumn("transformed_spend_sp", F.lit(0.0))
    twin = features.withColumn("series", F.lit("twin")).withColumn("transformed_spend_sb", F.col("transformed_spend_sp") * 2)
    none = features.withColumn("series", F.lit("none")).withColumn("total_sales", F.lit(None).cast("double"))
    every = features.unionByName(flat).unionByName(twin).unionByName(none)
    got = {r["series"]: r for r in mix_model.fit_ols(every).collect()}
    assert {k: r["status"] for k, r in got.items()} == {
        "national": "ok", "flat": "constant feature", "twin": "collinear features", "none": "incomplete",
    }
    assert got["none"]["intercept"] is None and got["none"]["n"] == 0
    _, x, y = solved
    rest, _ = lstsq(x[:, 1:], y)
    names = mix_model.model_features()
    assert got["flat"]["coef_transformed_spend_sp"] == 0
    assert np.allclose([got["flat"]["intercept"], *[got["flat"][f"coef_{f}"] for f in names[1:]]], rest, rtol=1e-7)
    one, _ = lstsq(np.delete(x, 1, axis=1), y)
    both = got["twin"]["coef_transformed_spend_sp"] + 2 * got["twin"]["coef_transformed_spend_sb"]
    assert abs(both - one[1]) < 1e-7 * abs(one[1])


def test_rows_without_sales_or_a_feature_are_left_out(spark, features, solved):
    hole = (F.col("week_start") == "2023-03-06") | (F.col("week_start") == "2024-01-01")
    gaps = features.withColumn("total_sales", F.when(~hole, F.col("total_sales")))
    gaps = gaps.withColumn("transformed_spend_sb", F.when(F.col("week_start") != "2023-05-01", F.col("transformed_spend_sb")))
    m = mix_model.fit_ols(gaps).first()
    left = features.where(~hole & (F.col("week_start") != "2023-05-01"))
    want = mix_model.fit_ols(left).first()
    assert m["n"] == want["n"] == 101
    assert all(abs(m[c] - want[c]) < 1e-7 * abs(want[c]) for c in ("intercept", "coef_transformed_spend_sp"))


def test_search_keeps_series_without_a_channel_and_weeks_without_sales(spark, weekly):
    odd = weekly.withColumn("series", F.lit("odd")).withColumn("spend_dsp", F.lit(0.0))
    odd = odd.withColumn("total_sales", F.when(F.col("week_start") != "2023-03-06", F.col("total_sales")))
    got = {r["series"]: r for r in mix_search.grid_search(weekly.unionByName(odd)).collect()}
    assert set(got) == {"national", "odd"} and got["odd"]["r2"] > 0.5
    assert got["odd"]["decay_dsp"] == mix_search.DECAYS[0]


def test_search_over_many_combinations_of_one_series(spark, weekly):
    decays = {c.name: [0.2, 0.4, 0.6] for c in mix.CHANNELS}
    ks = {c.name: [c.half_saturation * f for f in (0.4, 0.6, 0.8, 1.0, 1.2, 1.5, 2.0, 3.0)] for c in mix.CHANNELS}
    every = mix_search.grid_search(weekly, decays=decays, half_saturations=ks, keep="all")
    assert every.count() == 24**3 and 24**3 > 3 * mix_search.STACK
    best = mix_search.grid_search(weekly, decays=decays, half_saturations=ks).first()
    assert best["sse"] == every.agg(F.min("sse")).first()[0]


def many_series(spark, weekly, n=5):
    rnd = random.Random(11)
    out = None
    for i in range(n):
        part = weekly.withColumn("series", F.lit(f"s{i}")).withColumn("spend_sp", F.col("spend_sp") * rnd.uniform(0.5, 2))
        out = part if out is None else out.unionByName(part)
    return out


def lstsq(x, y):
    a = np.column_stack([np.ones(len(x)), x])
    beta = np.linalg.lstsq(a, y, rcond=None)[0]
    return beta, ((y - a @ beta) ** 2).sum()


def test_many_series_equal_numpy(spark, weekly):
    series = many_series(spark, weekly)
    f = mix.season_features(mix.transform_channels(series))
    models = {r["series"]: r for r in mix_model.fit_ols(f).collect()}
    pdf = f.toPandas().sort_values(["series", "week_start"])
    for name, part in pdf.groupby("series"):
        beta, _ = lstsq(part[mix_model.model_features()].to_numpy(), part["total_sales"].to_numpy())
        got = [models[name]["intercept"], *[models[name][f"coef_{c}"] for c in mix_model.model_features()]]
        assert np.allclose(got, beta, rtol=1e-8)


def test_grid_search_equals_one_fit_per_combination(spark, weekly):
    series = many_series(spark, weekly, 2)
    decays = {"sp": [0.4, 0.5], "sb": [0.3], "dsp": [0.6, 0.7]}
    ks = {"sp": [3000.0], "sb": [1500.0, 2500.0], "dsp": [1000.0]}
    every = mix_search.grid_search(series, decays=decays, half_saturations=ks, keep="all").toPandas()
    best = mix_search.grid_search(series, decays=decays, half_saturations=ks).toPandas()
    assert len(every) == 16 and len(best) == 2
    pdf = series.select("series", "week_start", "week", "spend_sp", "spend_sb", "spend_dsp", "total_sales").toPandas().sort_values(["series", "week_start"])
    for _, row in every.iterrows():
        part = pdf[pdf["series"] == row["series"]]
        x = []
        for c in mix.CHANNELS:
            stocked = np.array(loop_adstock(part[c.spend], row[f"decay_{c.name}"]))
            x.append(stocked**2 / (row[f"half_saturation_{c.name}"] ** 2 + stocked**2) * part[c.spend].to_numpy())
        angle = 2 * np.pi * part["week"].to_numpy() / 52
        _, sse = lstsq(np.column_stack([*x, np.sin(angle), np.cos(angle)]), part["total_sales"].to_numpy())
        assert abs(row["sse"] - sse) < 1e-6 * sse
    for _, row in best.iterrows():
        assert row["sse"] == every[every["series"] == row["series"]]["sse"].min()


def test_grid_contains_the_default_model(weekly, features, model):
    best = mix_search.grid_search(weekly).first()
    default = mix_model.fit_metrics(mix_model.predict(features, model)).first()["r2"]
    assert best["r2"] >= default - 1e-9


def test_poisson_steps():
    steps = mix_search.poisson_steps()
    draws = np.searchsorted(steps, np.random.default_rng(1).random(200_000), side="right")
    assert abs(draws.mean() - 1) < 0.01 and abs(draws.var() - 1) < 0.02 and abs((draws == 0).mean() - np.exp(-1)) < 0.01
    assert len(steps) > 15 and 1 - steps[-1] < 1e-13


def test_intervals_equal_weighted_fits(spark, weekly, features):
    n = 40
    got = {r["channel"]: r for r in mix_search.roi_intervals(features, replicates=n).collect()}
    pdf = features.toPandas().sort_values("week_start")
    x, y = pdf[mix_model.model_features()].to_numpy(), pdf["total_sales"].to_numpy()

    def draw(*keys):
        u, k, passed = int(md5("|".join(map(str, keys)).encode()).hexdigest()[:13], 16) / 16**13, 0, math.exp(-1)
        p = passed
        while u >= p:
            k += 1
            passed /= k
            p += passed
        return k

    w = np.array([[draw("national", d, r) for r in range(n)] for d in pdf["week_start"]], float)
    roi = []
    for r in range(n):
        root = np.sqrt(w[:, r])
        a = np.column_stack([np.ones(len(x)), x])
        beta = np.linalg.lstsq(a * root[:, None], y * root, rcond=None)[0]
        roi.append([beta[i + 1] * (w[:, r] @ x[:, i]) / (w[:, r] @ pdf[c.spend].to_numpy()) for i, c in enumerate(mix.CHANNELS)])
    roi = np.array(roi)
    for i, c in enumerate(mix.CHANNELS):
        r = got[c.name]
        assert np.allclose([r["roi_mean"], r["roi_median"], r["roi_ci_lo"], r["roi_ci_hi"]], [roi[:, i].mean(), *np.quantile(roi[:, i], [0.5, 0.05, 0.95])], rtol=1e-6)
        assert r["replicates_used"] == n and r["roi_ci_lo"] <= r["roi_median"] <= r["roi_ci_hi"]


def test_saturating_form_drops_the_spend_factor(weekly):
    a = mix.transform_channels(weekly, form="saturating").select(F.max("transformed_spend_sp")).first()[0]
    assert 0 < a < 1
    with pytest.raises(ValueError):
        mix.transform_channels(weekly, form="linear")


def test_rows_of_one_week_are_summed_before_a_search(spark, weekly):
    split = weekly.withColumn("spend_sp", F.col("spend_sp") / 2).withColumn("spend_sb", F.col("spend_sb") / 2)
    split = split.withColumn("spend_dsp", F.col("spend_dsp") / 2).withColumn("total_sales", F.col("total_sales") / 2)
    once = mix_search.grid_search(weekly).first().asDict()
    twice = mix_search.grid_search(split.unionByName(split)).first().asDict()
    assert all(abs(once[k] - twice[k]) <= 1e-6 * abs(once[k]) for k in once if k != "series")
