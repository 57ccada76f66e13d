"""The standing questions against plain Python over small random facts."""

from __future__ import annotations

import datetime as dt
import random
from collections import defaultdict
from decimal import ROUND_HALF_UP, Decimal

import pytest
from support import rows
from pyspark.sql import functions as F

from mixlens.operators import derived
from mixlens.operators import performance as perf


def half_up(x, n):
    if x is None:
        return None
    return float(Decimal(repr(round(float(x), 9))).quantize(Decimal(1).scaleb(-n), ROUND_HALF_UP))


def ratio(a, b, n):
    return None if a is None or not b else half_up(float(a) / float(b), n)


@pytest.fixture(scope="module")
def data(spark):
    rnd = random.Random(7)
    campaigns = [(f"c{i}", f"Name {i % 9}", f"P{i % 3}", "AUTO" if i % 2 else "MANUAL") for i in range(12)]
    money = lambda top: Decimal(rnd.randrange(0, top * 100)).scaleb(-2)
    days = [dt.date(2025, 1, 1) + dt.timedelta(d) for d in range(40) if d not in (9, 10, 17)]
    ads, terms = [], []
    for _ in range(1500):
        # A third of the rows belong to one campaign.
        c = "c0" if rnd.random() < 0.34 else f"c{rnd.randrange(14)}"
        zero = rnd.random() < 0.3
        ads.append((rnd.choice(days), c, rnd.choice([None, *[f"a{i}" for i in range(15)]]), Decimal(0) if c == "c5" else money(30), Decimal(0) if zero else money(90), 0 if zero else rnd.randrange(4)))
        zero = rnd.random() < 0.6
        terms.append((rnd.choice(days), c, f"term {rnd.randrange(12)}", rnd.choice(["BROAD", "PHRASE", "EXACT", "-"]), rnd.randrange(99), rnd.randrange(6), money(12), Decimal(0) if zero else money(90), 0 if zero else 1))
    business = [(f"a{i}", Decimal(i * 900), i * 3, None if i == 3 else i / 7) for i in range(20)]
    products = [(f"a{i}", f"title {i} " + "x" * 80) for i in range(0, 20, 2)]
    return {
        "campaigns": campaigns,
        "ads": ads,
        "terms": terms,
        "business": business,
        "products": products,
        "dim": spark.createDataFrame(campaigns, "campaign_id string, campaign_name string, portfolio_name string, targeting_type string"),
        "fact_ads": spark.createDataFrame(ads, "date_id date, campaign_id string, asin string, spend decimal(18,4), sales_7d decimal(18,4), orders_7d bigint"),
        "fact_terms": spark.createDataFrame(terms, "date_id date, campaign_id string, customer_search_term string, match_type string, impressions bigint, clicks bigint, spend decimal(18,4), sales_7d decimal(18,4), orders_7d bigint"),
        "fact_business": spark.createDataFrame(business, "asin string, ordered_product_sales decimal(18,4), sessions_total bigint, unit_session_pct double"),
        "dim_product": spark.createDataFrame(products, "asin string, title string"),
    }


def sums(rows_, key, values):
    out = defaultdict(lambda: [Decimal(0)] * len(values))
    for r in rows_:
        k = key(r)
        if k is not None:
            out[k] = [a + r[i] for a, i in zip(out[k], values)]
    return out


def test_campaign_roas_tacos(data):
    dim = {c[0]: c for c in data["campaigns"]}
    total = sum(b[1] for b in data["business"])
    want = []
    for cid, (s, a, o) in sums(data["ads"], lambda r: r[1] if r[1] in dim else None, [3, 4, 5]).items():
        if s > 0:
            want.append((*dim[cid][1:], float(s), float(a), int(o), ratio(a, s, 2), ratio(s, a, 4), ratio(s, total, 4)))
    got = [tuple(float(v) if isinstance(v, Decimal) else v for v in r) for r in perf.campaign_roas_tacos(data["fact_ads"], data["dim"], data["fact_business"]).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert [r[6] for r in got] == sorted([r[6] for r in got], reverse=True)
    assert not any(r[0] == "Name 5" and r[1] == "P2" for r in got)


def term_groups(data, match):
    dim = {c[0]: c for c in data["campaigns"]}

    def key(r):
        if r[1] not in dim or (match and r[3] not in ("BROAD", "PHRASE")):
            return None
        c = dim[r[1]]
        return (r[2], c[1], c[3], r[3]) if match else (r[2], c[1], c[3])

    return sums(data["terms"], key, [4, 5, 6, 7, 8])


@pytest.mark.parametrize("options", [{}, {"min_orders": 1, "max_acos": 0.9, "top": 2}])
def test_harvestable_terms(data, options):
    o = {"min_orders": 2, "max_acos": 0.30, "top": 5, **options}
    ranked = defaultdict(list)
    for (term, name, targeting, match), v in term_groups(data, True).items():
        if v[4] >= o["min_orders"] and v[2] > 0:
            ranked[name].append((-v[3], term, match, targeting, v))
    want = []
    for name, found in ranked.items():
        for rank, (_, term, match, targeting, v) in enumerate(sorted(found), 1):
            acos = ratio(v[2], v[3], 4)
            if rank <= o["top"] and acos is not None and acos < o["max_acos"]:
                want.append((term, name, targeting, match, int(v[0]), int(v[1]), v[2], v[3], int(v[4]), ratio(v[3], v[2], 2), acos, ratio(v[4], v[1], 4), rank))
    got = rows(perf.harvestable_terms(data["fact_terms"], data["dim"], **options))
    assert want and sorted(map(repr_row, got)) == sorted(map(repr_row, want))


def repr_row(r):
    return tuple(repr(float(v)) if isinstance(v, (int, float, Decimal)) else str(v) for v in r)


def test_harvest_without_existing_exact(data):
    dim = {c[0]: c for c in data["campaigns"]}
    exact = {(dim[r[1]][1], r[2]) for r in data["terms"] if r[3] == "EXACT" and r[1] in dim}
    got = perf.harvestable_terms(data["fact_terms"], data["dim"], min_orders=1, max_acos=9, top=99, exclude_existing_exact=True)
    everything = perf.harvestable_terms(data["fact_terms"], data["dim"], min_orders=1, max_acos=9, top=99)
    pairs = {(r["campaign_name"], r["customer_search_term"]) for r in got.collect()}
    assert not pairs & exact
    assert pairs == {(r["campaign_name"], r["customer_search_term"]) for r in everything.collect()} - exact


@pytest.mark.parametrize("limit", [50, 7])
def test_wasted_spend(data, limit):
    want = []
    for (term, name, targeting), v in term_groups(data, False).items():
        if v[1] >= 15 and (v[4] == 0 or v[2] > v[3]):
            reason = "no_conversions" if v[4] == 0 else "unprofitable"
            want.append((reason, term, name, targeting, int(v[1]), v[2], v[3], int(v[4]), ratio(v[2], v[3], 4)))
    want.sort(key=lambda r: (-r[5], r[1], r[2], r[3]))
    got = rows(perf.wasted_spend(data["fact_terms"], data["dim"], limit=limit))
    assert list(map(repr_row, got)) == list(map(repr_row, want[:limit])) and got


def test_ads_vs_organic(data):
    titles = dict(data["products"])
    per = sums(data["ads"], lambda r: r[2], [3, 4])
    want = []
    for asin, total, sessions, conversion in data["business"]:
        if total > 0:
            spend, sales = per.get(asin, (Decimal(0), Decimal(0)))
            share = ratio(sales, total, 4)
            name = "ad_dependent" if share >= 0.8 else "balanced" if share >= 0.4 else "organic_strong" if share > 0 else "no_ads"
            title = titles.get(asin)
            want.append((asin, title and title[:60], total, sales, total - sales, spend, sessions, half_up(conversion, 2), share, ratio(spend, total, 4), name))
    got = rows(perf.ads_vs_organic(data["fact_ads"], data["fact_business"], data["dim_product"]))
    assert sorted(map(repr_row, got)) == sorted(map(repr_row, want))
    assert len({r[-1] for r in got}) == 4
    health = rows(derived.health_distribution(perf.ads_vs_organic(data["fact_ads"], data["fact_business"], data["dim_product"])))
    assert sum(n for _, n in health) == len(want) and len(health) == 4


def test_daily_trend(data):
    per_day = sorted(sums(data["ads"], lambda r: r[0], [3, 4, 5]).items())
    want = []
    for i, (day, (s, a, o)) in enumerate(per_day):
        window = [v for _, v in per_day[max(0, i - 6) : i + 1]]
        ws, wa = sum(v[0] for v in window), sum(v[1] for v in window)
        roas, rolling = ratio(a, s, 2), ratio(wa, ws, 2)
        before = per_day[i - 7][1][0] if i >= 7 else None
        flag = "roas_anomaly" if roas is not None and rolling and abs(roas - rolling) / rolling > 0.5 else None
        want.append((day, s, half_up(ws / len(window), 2), a, int(o), roas, rolling, before, None if before is None else ratio(s - before, before, 4), flag))
    got = rows(perf.daily_trend(data["fact_ads"]))
    assert list(map(repr_row, got)) == list(map(repr_row, want))
    assert rows(derived.anomalous_days(perf.daily_trend(data["fact_ads"])).select("date_id"), "date_id") == [(w[0],) for w in want if w[-1]]


def test_daily_trend_by_campaign_equals_one_campaign_alone(data):
    by = perf.daily_trend(data["fact_ads"], by="campaign_id").where("campaign_id = 'c3'").drop("campaign_id")
    alone = perf.daily_trend(data["fact_ads"].where("campaign_id = 'c3'"))
    assert rows(by, "date_id") == rows(alone, "date_id")


def test_zero_spend_day_has_no_roas(spark):
    fact = spark.createDataFrame([(dt.date(2025, 1, d), Decimal(0 if d == 2 else 5), Decimal(10), 1) for d in (1, 2, 3)], "date_id date, spend decimal(18,4), sales_7d decimal(18,4), orders_7d bigint")
    got = rows(perf.daily_trend(fact).select("daily_roas", "rolling_7d_roas", "anomaly_flag"))
    assert got == [(2.0, 2.0, None), (None, 4.0, None), (2.0, 3.0, None)]


def test_histogram_matches_numpy(spark):
    import numpy as np

    rnd = random.Random(3)
    values = [round(rnd.lognormvariate(0.5, 0.8), 2) for _ in range(400)]
    df = spark.createDataFrame([(60.0, v) for v in values] + [(10.0, 999.0), (70.0, None)], "spend double, roas double")
    got = derived.roas_histogram(df).collect()
    counts, edges = np.histogram(values, bins=30)
    assert [r["campaigns"] for r in got] == counts.tolist()
    assert np.allclose([r["bin_start"] for r in got], edges[:-1]) and got[0]["median_roas"] == float(np.median(values))
    one = derived.roas_histogram(spark.createDataFrame([(60.0, 2.0)] * 3, "spend double, roas double"), bins=4).collect()
    assert [r["campaigns"] for r in one] == np.histogram([2.0] * 3, bins=4)[0].tolist()
    assert derived.roas_histogram(df.where("false")).count() == 0


def test_small_tables(data, spark):
    q3 = perf.wasted_spend(data["fact_terms"], data["dim"])
    by_reason = rows(derived.waste_by_reason(q3))
    assert sum(r[2] for r in by_reason) == q3.count() and [r[1] for r in by_reason] == sorted([r[1] for r in by_reason], reverse=True)
    q1 = perf.campaign_roas_tacos(data["fact_ads"], data["dim"], data["fact_business"])
    totals = derived.query_totals(q1, q3).first()
    assert totals["campaigns"] == q1.count() and totals["total_wasted_spend"] == q3.agg(F.sum("spend")).first()[0]
    q2 = perf.harvestable_terms(data["fact_terms"], data["dim"], min_orders=1, max_acos=9, top=99)
    top = [r["sales"] for r in derived.top_harvest(q2, 5).collect()]
    assert top == sorted([r["sales"] for r in q2.collect()], reverse=True)[:5]
