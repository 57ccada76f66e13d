"""Plain SQL for the registered queries, to be run by another engine on the same tables.

Written on its own from the meaning of each query. ``_sql`` puts the common
table expressions a statement names in front of it.
"""

from __future__ import annotations

import math
import re

from mixlens.plans.oracle_values import (
    ADS,
    ADS_GRAIN_CHECK,
    ADS_IDS,
    ADS_OPTIONAL,
    BULK,
    BULK_IDS,
    BUSINESS,
    BUSINESS_IDS,
    MART_CHECKS,
    MIX_CHECKS,
    PREFIXES,
    STAR_CHECKS,
    TERM_IDS,
    TERMS,
    TEXT_COLUMNS,
)


def ratio(num: str, den: str) -> str:
    return f"(cast({num} as double) / nullif(cast({den} as double), 0))"


def rnd(x: str, digits: int) -> str:
    return f"cast(round(cast({x} as decimal(38,9)), {digits}) as double)"


def dbl(x: str) -> str:
    return f"cast({x} as double)"


def pid(key: str) -> str:
    return f"printf('B0%08d', {key})"


CLOSED = "l_linestatus = 'F'"
SOLD = "l_linestatus = 'F' and l_returnflag <> 'R'"
SALES = (
    f"case when {SOLD} then cast(l_extendedprice * (case when l_partkey % 11 = 0 then 0.3::double "
    "else 0.1::double end) as decimal(18,4)) else 0::decimal(18,4) end"
)
PERFORMANCE = f"""
    cast(l_quantity * 1000 as bigint) as impressions,
    case when {CLOSED} then cast(l_quantity as bigint) else 0 end as clicks,
    cast(l_tax as double) as ctr,
    cast(l_discount as decimal(18,4)) as cpc,
    case when {CLOSED} then cast(l_extendedprice * l_discount as decimal(18,4)) else 0::decimal(18,4) end as spend,
    {SALES} as total_sales_7d,
    cast(null as double) as acos,
    cast(null as double) as roas,
    case when {SOLD} then 1::bigint else 0::bigint end as total_orders_7d,
    case when {SOLD} then cast(l_quantity as bigint) else 0::bigint end as total_units_7d,
    cast(null as double) as conversion_rate_7d"""
PLACE = """
    cast(l_shipdate as date) as start_date, cast(l_shipdate as date) as end_date,
    cast(null as varchar) as portfolio_name, printf('Supplier#%09d', l_suppkey) as campaign_name,
    'AG' || l_linenumber as ad_group_name"""

_NONE = "cast(null as varchar)"
_BULK_COLUMNS = [*BULK.values(), "portfolio_name", "ingest_seq"]


def _bulk_select(values: dict[str, str], source: str) -> str:
    return "select " + ", ".join(f"{values.get(c, _NONE)} as {c}" for c in _BULK_COLUMNS) + f" from {source}"


_CAMPAIGN_ROWS = {
    "product": "case s_suppkey % 4 when 0 then 'Sponsored Products' when 1 then 'Sponsored Brands' when 2 then 'Sponsored Display' end",
    "entity": "case when s_suppkey % 10 = 9 then 'Ad Group' else 'Campaign' end",
    "campaign_id": "'C' || s_suppkey",
    "ad_group_id": "'AG' || s_nationkey",
    "portfolio_id": "'P' || r_regionkey",
    "campaign_name": "s_name",
    "ad_group_name": "n_name",
    "targeting_type": "case when s_suppkey % 2 = 0 then 'AUTO' else 'MANUAL' end",
    "state": "case when s_acctbal < 0 then 'paused' else 'enabled' end",
    "daily_budget": "cast(cast(s_acctbal as decimal(18,2)) as varchar)",
    "bidding_strategy": "case when s_acctbal > 5000 then 'Dynamic bids' else 'Fixed bid' end",
    "portfolio_name": "r_name",
    "ingest_seq": "cast(s_suppkey as bigint)",
}
_PRODUCT_ROWS = {
    "product": "'Sponsored Products'",
    "entity": "case p_partkey % 3 when 0 then 'Product Ad' when 1 then 'Keyword' else 'Product Targeting' end",
    "campaign_id": "'C' || p_size",
    "ad_group_id": "'AG' || p_size",
    "ad_id": "case when p_partkey % 3 = 0 then 'A' || p_partkey end",
    "keyword_id": "case when p_partkey % 3 = 1 then 'K' || p_partkey end",
    "product_targeting_id": "case when p_partkey % 3 = 2 then 'T' || p_partkey end",
    "campaign_name": "case when p_partkey % 3 = 1 then printf('Supplier#%09d', p_size) end",
    "ad_group_name": "p_brand",
    "state": "'enabled'",
    "sku": "p_name",
    "asin": f"case when p_partkey % 5 = 0 then null else {pid('p_partkey')} end",
    "bid": "cast(cast(p_retailprice as decimal(18,2)) as varchar)",
    "keyword_text": "p_type",
    "match_type": "'BROAD'",
    "product_targeting_expression": f"'asin=' || {pid('p_partkey')} || ' x' || {pid('p_partkey')}",
    "impressions": "cast(p_size * 1000 as varchar)",
    "ingest_seq": "1000000000000 + p_partkey",
}

_STOCK = {"sp": (0.5, 3000.0), "sb": (0.3, 1500.0), "dsp": (0.7, 1000.0)}
_MEMORY = {0.5: 57, 0.3: 33, 0.7: 110}


def _stock(column: str, decay: float, window: str) -> str:
    frame = f"rows between {_MEMORY[decay] - 1} preceding and current row"
    return (
        f"list_reduce(list_prepend(0::double, list({column}) over ({window} {frame})), "
        f"lambda a, x: a * {decay}::double + x)"
    )


def _hill(x: str, k: float) -> str:
    return f"(pow({x}, 2) / (pow({k}::double, 2) + pow({x}, 2)))"


_SERIES = "partition by series order by week_start"
_X = ["transformed_spend_sp", "transformed_spend_sb", "transformed_spend_dsp", "season_sin", "season_cos"]


def _solve(source: str, keys: str, prefix: str) -> dict[str, str]:
    """Least squares by elimination on the covariance matrix, one step per expression.

    The last step has the coefficients as ``a<i>_5``, the means ``m<i>``, the
    covariances with the target ``c<i>`` and the target's variance ``c5``.
    """
    n = len(_X)
    names = [*_X, "total_sales"]
    moments = ", ".join(
        [f"avg({x}) as m{i}" for i, x in enumerate(names)]
        + [f"covar_pop({x}, total_sales) as c{i}" for i, x in enumerate(names)]
        + [f"covar_pop({names[i]}, {names[j]}) as a{i}_{j}" for i in range(n) for j in range(n + 1)]
    )
    complete = " and ".join(f"{x} is not null" for x in names)
    steps = {f"{prefix}step0": f"select {keys}, count(*) as n, {moments} from {source} where {complete} group by {keys}"}
    steps |= _eliminate(keys, prefix, f"m{n}, c{n}, " + ", ".join(f"m{i}, c{i}" for i in range(n)))
    intercept = f"m{n} - (" + " + ".join(f"a{i}_{n} * m{i}" for i in range(n)) + ")"
    coefs = ", ".join(f"round(a{i}_{n}, 6) as coef_{x}" for i, x in enumerate(_X))
    explained = " + ".join(f"a{i}_{n} * c{i}" for i in range(n))
    steps[f"{prefix}model"] = (
        f"select {keys}, round({intercept}, 6) as intercept, {coefs}, n, "
        f"case when least({', '.join(f's{i}' for i in range(n))}) = 0 then 'constant feature' else 'ok' end as status, "
        f"({explained}) / c{n} as r2 from {prefix}step{n}"
    )
    return steps


def _eliminate(keys: str, prefix: str, carried: str) -> dict[str, str]:
    """The elimination alone, from moments in ``<prefix>step0``; a feature that never varies gets the coefficient 0.

    ``s<i>`` carries the variance of feature i.
    """
    n, steps = len(_X), {}
    for p in range(n):
        cells = []
        for i in range(n):
            for j in range(n + 1):
                step = f"coalesce(a{p}_{j} / nullif(a{p}_{p}, 0), 0)"
                cells.append(f"{step} as a{i}_{j}" if i == p else f"a{i}_{j} - a{i}_{p} * {step} as a{i}_{j}")
        spread = ", ".join(f"a{i}_{i} as s{i}" if p == 0 else f"s{i}" for i in range(n))
        steps[f"{prefix}step{p + 1}"] = (
            f"select {keys}, n, {carried}, {spread}, {', '.join(cells)} from {prefix}step{p}"
        )
    return steps


def _poisson() -> str:
    """The Poisson(1) draw at u: how many cumulative probabilities it has passed, down to the step of u."""
    terms, density, k = [], math.exp(-1.0), 0
    cumulative = density
    while 1.0 - cumulative > 2.0**-53:
        terms.append(f"(u >= {cumulative!r}::double)::int")
        k += 1
        density = density / k
        cumulative = cumulative + density
    return " + ".join(terms)


def _replicates() -> dict[str, str]:
    """Fits of weighted weeks, one per series and replicate."""
    n, names = len(_X), [*_X, "total_sales"]
    moments = [f"sum(w * x{i}) / sum(w) as m{i}" for i in range(n + 1)]
    moments += [
        f"sum(w * x{i} * x{j}) / sum(w) - (sum(w * x{i}) / sum(w)) * (sum(w * x{j}) / sum(w)) as a{i}_{j}"
        for i in range(n)
        for j in range(n + 1)
    ]
    spends = [f"sum(w * spend_{c}) / sum(w) as spend{i}" for i, c in enumerate(_STOCK)]
    centres = [f"any_value(centre{i}) as centre{i}" for i in range(n + 1)]
    carried = [f"m{i}, centre{i}" for i in range(n + 1)] + [f"spend{i}" for i in range(len(_STOCK))]
    hashed = "substr(md5(series || '|' || cast(week_start as varchar) || '|' || r), 1, 13)"
    centred = ", ".join(f"{x} - centre{i} as x{i}, centre{i}" for i, x in enumerate(names))
    return {
        "centres": f"select series, {', '.join(f'avg({x}) as centre{i}' for i, x in enumerate(names))} from features group by 1",
        "drawn": f"""select series, week_start, r, {centred}, {', '.join(f'spend_{c}' for c in _STOCK)},
            ('0x' || {hashed})::bigint::double / 4503599627370496::double as u
            from features join centres using (series), (select unnest(range(500)) as r) k""",
        "weighted": f"select *, {_poisson()} as w from drawn",
        "repstep0": f"select series, r, sum(w) as n, {', '.join(moments + spends + centres)} from weighted group by 1, 2 having sum(w) > {n}",
        **_eliminate("series, r", "rep", ", ".join(carried)),
        "rois": " union all ".join(
            f"""select series, '{c}' as channel, a{i}_{n} * (m{i} + centre{i}) / spend{i} as roi,
            100 * a{i}_{n} * (m{i} + centre{i}) / (m{n} + centre{n}) as share from repstep{n}"""
            for i, c in enumerate(_STOCK)
        ),
    }


_GRID = {"sp": (1500.0, 3000.0, 6000.0), "sb": (750.0, 1500.0, 3000.0), "dsp": (500.0, 1000.0, 2000.0)}
_GRID_KEYS = "series, " + ", ".join(f"decay_{c}, half_saturation_{c}" for c in _GRID)


def _setting(c: str) -> str:
    """One channel's feature for every decay and half-saturation."""
    stocks = " union all ".join(
        f"select series, week_start, spend_{c} as x, {d}::double as decay_{c}, {_stock(f'spend_{c}', d, _SERIES)} as level from weekly"
        for d in _MEMORY
    )
    ks = ", ".join(f"{k}::double" for k in _GRID[c])
    return f"""select series, week_start, decay_{c}, half_saturation_{c},
        pow(level, 2) / (pow(half_saturation_{c}, 2) + pow(level, 2)) * x as transformed_spend_{c}
        from ({stocks}) s, (select unnest([{ks}]) as half_saturation_{c}) k"""


_YHAT = "intercept + " + " + ".join(f"coef_{x} * {x}" for x in _X)


def _steady(beta: str, spend: str, ch: str) -> str:
    decay, k = _STOCK[ch]
    return f"({beta} * {_hill(f'({spend} * {(1 - decay**10) / (1 - decay)!r}::double)', k)} * {spend})"


_FACT_SUMS = "impressions, clicks, spend, sales_7d, orders_7d, units_7d, advertised_sku_sales_7d, other_sku_sales_7d"

CTES: dict[str, str] = {
    "bulk": _bulk_select(
        _CAMPAIGN_ROWS,
        "supplier join nation on s_nationkey = n_nationkey join region on n_regionkey = r_regionkey",
    )
    + " union all "
    + _bulk_select(_PRODUCT_ROWS, "part"),
    "ads": f"""select {PLACE}, 'US' as country, 'SKU-' || l_partkey as advertised_sku,
        case when l_partkey % 7 = 0 then null else {pid('l_partkey')} end as advertised_asin, {PERFORMANCE},
        case when l_tax > 0.04 then {SALES} else 0 end as advertised_sku_sales_7d,
        case when l_tax > 0.04 then 0 else {SALES} end as other_sku_sales_7d
        from lineitem""",
    "terms": f"""select {PLACE}, p_brand as targeting,
        case l_linenumber % 4 when 0 then 'BROAD' when 1 then 'PHRASE' when 2 then 'EXACT' else '-' end as match_type,
        p_name as customer_search_term, {PERFORMANCE}
        from lineitem join part on l_partkey = p_partkey""",
    "business": f"""select case when p_size = 13 then null else {pid('p_partkey')} end as parent_asin,
        p_name as product_title, cast(qty * 3 as bigint) as sessions_total, p_size || '%' as session_pct_total,
        cast(qty * 5 as bigint) as page_views_total, p_size || '.5%' as page_views_pct_total,
        case when p_size % 2 = 0 then p_size || '.25%' else 'n/a' end as buy_box_pct,
        case when p_size % 2 = 0 then p_size + 0.25 end as buy_box, cast(qty as bigint) as units_ordered,
        cast(round(cast(cast(tax as double) * 100 / items as decimal(38,9)), 2) as decimal(18,2)) as unit_session,
        cast(round(sales, 2) as decimal(18,2)) as sales, cast(items as bigint) as items
        from (select l_partkey, sum(cast(l_extendedprice * 0.1::double as decimal(18,4))) as sales,
              sum(cast(l_quantity as bigint)) as qty, sum(cast(l_tax as decimal(18,4))) as tax, count(*) as items
              from lineitem group by l_partkey) s join part on l_partkey = p_partkey""",
    "lookup": """select campaign_name, campaign_id from (select campaign_name, campaign_id,
        row_number() over (partition by campaign_name order by ingest_seq, campaign_id) as rn
        from bulk where entity = 'Campaign' and campaign_name is not null) q where rn = 1""",
    "dim_campaign": """select * exclude (rn) from (select campaign_id, campaign_name, portfolio_id, portfolio_name,
        targeting_type, bidding_strategy, state, cast(daily_budget as double) as daily_budget,
        row_number() over (partition by campaign_id order by ingest_seq) as rn
        from bulk where entity = 'Campaign' and campaign_id is not null) q where rn = 1""",
    "dim_campaign_name": """select * exclude (rn) from (select campaign_id, campaign_name, product as ad_product,
        targeting_type, state, cast(daily_budget as double) as daily_budget, bidding_strategy,
        row_number() over (partition by campaign_id order by campaign_name nulls last,
            (case when entity = 'Campaign' then 0 else 1 end), product nulls last, targeting_type nulls last,
            state nulls last, bulk.daily_budget nulls last, bidding_strategy nulls last) as rn
        from bulk where campaign_id is not null) q where rn = 1""",
    "dim_product": """select coalesce(a.asin, b.asin) as asin, sku, title from
        (select advertised_asin as asin, min(advertised_sku) as sku from ads where advertised_asin is not null group by 1) a
        full outer join
        (select parent_asin as asin, min(product_title) as title from business where parent_asin is not null group by 1) b
        on a.asin = b.asin""",
    "dim_product_sku": "select sku, min(asin) as asin from bulk where sku is not null group by sku",
    "fact_ads": """select start_date as date_id, campaign_id, advertised_asin as asin, advertised_sku as sku,
        cast(sum(impressions) as bigint) as impressions, cast(sum(clicks) as bigint) as clicks,
        sum(spend) as spend, sum(total_sales_7d) as sales_7d, cast(sum(total_orders_7d) as bigint) as orders_7d,
        cast(sum(total_units_7d) as bigint) as units_7d, sum(advertised_sku_sales_7d) as advertised_sku_sales_7d,
        sum(other_sku_sales_7d) as other_sku_sales_7d
        from ads join lookup using (campaign_name) group by 1, 2, 3, 4""",
    "fact_terms": """select start_date as date_id, campaign_id, customer_search_term, targeting, match_type,
        impressions, clicks, spend, total_sales_7d as sales_7d, total_orders_7d as orders_7d
        from terms join lookup using (campaign_name)""",
    "fact_business": """select date '2025-03-11' as snapshot_date, parent_asin as asin, sessions_total, page_views_total,
        cast(buy_box as double) as buy_box_pct, units_ordered, cast(unit_session as double) as unit_session_pct,
        sales as ordered_product_sales, items as total_order_items
        from business where parent_asin is not null""",
    "ads_by_name": """select start_date as date_id, campaign_name, advertised_asin as asin, advertised_sku as sku,
        cast(sum(impressions) as bigint) as impressions, cast(sum(clicks) as bigint) as clicks, sum(spend) as spend,
        sum(total_sales_7d) as sales, cast(sum(total_orders_7d) as bigint) as orders, cast(sum(total_units_7d) as bigint) as units
        from ads where start_date is not null and advertised_asin is not null group by 1, 2, 3, 4""",
    "terms_by_name": """select start_date as date_id, campaign_name, customer_search_term, match_type,
        cast(sum(impressions) as bigint) as impressions, cast(sum(clicks) as bigint) as clicks, sum(spend) as spend,
        sum(total_sales_7d) as sales, cast(sum(total_orders_7d) as bigint) as orders, cast(sum(total_units_7d) as bigint) as units
        from terms where start_date is not null and customer_search_term is not null group by 1, 2, 3, 4""",
    "dim_date": """select d as date_id, cast(year(d) as int) as year, cast(month(d) as int) as month,
        cast(week(d) as int) as week, cast(isodow(d) as int) as day_of_week,
        cast(isodow(d) >= 6 as int) as is_weekend, cast(isoyear(d) as int) as iso_year
        from (select distinct start_date as d from ads where start_date is not null) q""",
    "weekly": """select r as series, w as week_start, cast(year(w) as int) as year, cast(week(w) as int) as week,
        sp as spend_sp, sb as spend_sb, dsp as spend_dsp, sp + sb + dsp as spend_total,
        impressions_total, clicks_total, ad_sales, ad_orders, total_sales, total_sales - ad_sales as organic_sales
        from (select portfolio_name as r, cast(date_trunc('week', l_shipdate) as date) as w,
              cast(sum(case when product = 'Sponsored Products' then spend else 0 end) as double) as sp,
              cast(sum(case when product = 'Sponsored Brands' then spend else 0 end) as double) as sb,
              cast(sum(case when product = 'Sponsored Display' then spend else 0 end) as double) as dsp,
              cast(sum(impressions) as bigint) as impressions_total, cast(sum(clicks) as bigint) as clicks_total,
              cast(sum(total_sales_7d) as double) as ad_sales, cast(sum(total_orders_7d) as bigint) as ad_orders,
              cast(sum(ts) as double) as total_sales
              from (select l_shipdate, printf('Supplier#%09d', l_suppkey) as campaign_name,
                    cast(l_extendedprice * 0.2::double as decimal(18,4)) as ts, """
    + PERFORMANCE
    + """ from lineitem) l
              join (select campaign_name, product, portfolio_name from bulk where entity = 'Campaign') b using (campaign_name)
              group by 1, 2) q""",
    "stocked": "select *, "
    + ", ".join(f"{_stock(f'spend_{c}', d, _SERIES)} as adstock_{c}" for c, (d, _) in _STOCK.items())
    + ", sin(2 * pi() * week / 52) as season_sin, cos(2 * pi() * week / 52) as season_cos from weekly",
    "features": "select *, "
    + ", ".join(
        f"{_hill(f'adstock_{c}', k)} * spend_{c} as transformed_spend_{c}, {_hill(f'adstock_{c}', k)} as saturated_{c}"
        for c, (_, k) in _STOCK.items()
    )
    + " from stocked",
    **_solve("features", "series", ""),
    **_replicates(),
    "pooled": "select 'all' as pool, * from features",
    **_solve("pooled", "pool", "all"),
    **{f"setting_{c}": _setting(c) for c in _GRID},
    "grid": f"""select {_GRID_KEYS}, total_sales, season_sin, season_cos, {', '.join(_X[:3])} from stocked
        join setting_sp using (series, week_start) join setting_sb using (series, week_start)
        join setting_dsp using (series, week_start)""",
    **_solve("grid", _GRID_KEYS, "grid"),
    "parts": f"""select series, week_start, total_sales, intercept as contrib_baseline,
        coef_{_X[0]} * {_X[0]} as contrib_sp, coef_{_X[1]} * {_X[1]} as contrib_sb, coef_{_X[2]} * {_X[2]} as contrib_dsp,
        coef_season_sin * season_sin + coef_season_cos * season_cos as contrib_seasonality, {_YHAT} as y_pred
        from features join model using (series)""",
    "spends": "select series, "
    + ", ".join(f"avg(spend_{c}) as mean_{c}, max(spend_{c}) as max_{c}" for c in _STOCK)
    + ", avg(spend_total) as mean_total from weekly group by 1",
    "channels": " union all ".join(
        f"select series, '{c}' as channel, coef_transformed_spend_{c} as beta, mean_{c} as mean_spend, max_{c} as max_spend "
        "from model join spends using (series)"
        for c in _STOCK
    ),
    "daily_all": """select cast(ts as date) as date_id, count(*) filter (where event_type = 'view') as impressions,
        count(*) filter (where event_type = 'click') as clicks, count(*) filter (where event_type = 'purchase') as orders,
        cast(sum(case when event_type = 'click' then cast(value as decimal(18,4)) else 0 end) as double) as spend,
        cast(sum(case when event_type = 'purchase' then cast(value as decimal(18,4)) else 0 end) as double) as sales
        from events group by 1""",
    "daily_in_time": """select cast(ts as date) as date_id, count(*) filter (where event_type = 'view') as impressions,
        count(*) filter (where event_type = 'click') as clicks, count(*) filter (where event_type = 'purchase') as orders,
        cast(sum(case when event_type = 'click' then cast(value as decimal(18,4)) else 0 end) as double) as spend,
        cast(sum(case when event_type = 'purchase' then cast(value as decimal(18,4)) else 0 end) as double) as sales
        from events where event_id % 20 <> 10 or cast(ts as date) + interval 1 day > (select max(ts) from events where event_id % 10 <> 0)
        - interval 3 day group by 1""",
    "daily_early": """select cast(ts as date) as date_id, count(*) filter (where event_type = 'view') as impressions,
        count(*) filter (where event_type = 'click') as clicks, count(*) filter (where event_type = 'purchase') as orders,
        cast(sum(case when event_type = 'purchase' then cast(value as decimal(18,4)) else 0 end) as double) as sales
        from events where value < 50 group by 1""",
}

# A name used twice per week and channel would be counted twice; the first campaign id keeps it.
CTES["weekly_channel"] = """select cast(date_id - cast(dayofweek(date_id) as int) as date) as week,
    coalesce(ad_product, 'unknown') as ad_product, sum(spend) as total_spend, sum(sales) as total_sales,
    cast(sum(clicks) as bigint) as total_clicks, cast(sum(orders) as bigint) as total_orders
    from ads_by_name left join (select campaign_name, ad_product from
        (select *, row_number() over (partition by campaign_name order by campaign_id) as rn from dim_campaign_name
         where campaign_name is not null) q where rn = 1) c using (campaign_name)
    group by 1, 2"""

CTES["q1"] = f"""select campaign_name, portfolio_name, targeting_type, spend, ad_sales, orders, roas, acos, tacos from (
    select campaign_name, portfolio_name, targeting_type, round(s, 2) as spend, round(a, 2) as ad_sales, orders,
    {rnd(ratio('a', 's'), 2)} as roas, {rnd(ratio('s', 'a'), 4)} as acos, {rnd(ratio('s', 'total'), 4)} as tacos
    from (select campaign_id, campaign_name, portfolio_name, targeting_type, sum(spend) as s, sum(sales_7d) as a,
          cast(sum(orders_7d) as bigint) as orders from fact_ads join dim_campaign using (campaign_id) group by 1, 2, 3, 4) p,
         (select sum(ordered_product_sales) as total from fact_business) b) q where spend > 0"""

# One series that never uses a channel, and a week of it without sales.
CTES["odd_weekly"] = """select * replace (case when series = 'ASIA' then 0 else spend_dsp end as spend_dsp,
    case when series = 'ASIA' and week_start = (select min(week_start) from weekly where series = 'ASIA') then null
    else total_sales end as total_sales) from weekly"""
CTES["odd_stocked"] = CTES["stocked"].replace("from weekly", "from odd_weekly")
CTES["odd_features"] = CTES["features"].replace("from stocked", "from odd_stocked")
CTES |= _solve("odd_features", "series", "odd")
CTES |= {f"odd_setting_{c}": _setting(c).replace("from weekly", "from odd_weekly") for c in _GRID}
CTES["odd_grid"] = re.sub(r"\b(stocked|setting_\w+)\b", r"odd_\1", CTES["grid"])
CTES |= _solve("odd_grid", _GRID_KEYS, "oddgrid")


def _harvest(extra: str = "") -> str:
    return f"""select customer_search_term, campaign_name, targeting_type, match_type, impressions, clicks,
    round(s, 2) as spend, round(a, 2) as sales, orders, roas, acos, conversion_rate, rank_in_campaign from (
    select *, {rnd(ratio('a', 's'), 2)} as roas, {rnd(ratio('s', 'a'), 4)} as acos, {rnd(ratio('orders', 'clicks'), 4)} as conversion_rate,
    cast(row_number() over (partition by campaign_name order by a desc, customer_search_term, match_type, targeting_type) as int) as rank_in_campaign
    from (select customer_search_term, campaign_name, targeting_type, match_type, cast(sum(impressions) as bigint) as impressions,
          cast(sum(clicks) as bigint) as clicks, sum(spend) as s, sum(sales_7d) as a, cast(sum(orders_7d) as bigint) as orders
          from fact_terms join dim_campaign using (campaign_id)
          where targeting_type in ('AUTO', 'MANUAL') and match_type in ('BROAD', 'PHRASE') {extra} group by 1, 2, 3, 4) g
    where orders >= 2 and s > 0) r where acos < 0.30 and rank_in_campaign <= 5"""


CTES["q2"] = _harvest()
CTES["q2_new"] = _harvest(
    """and not exists (select 1 from fact_terms x join dim_campaign y using (campaign_id) where x.match_type = 'EXACT'
       and x.customer_search_term = fact_terms.customer_search_term and y.campaign_name = dim_campaign.campaign_name)"""
)
CTES["q3"] = f"""select case when orders = 0 then 'no_conversions' when s > a then 'unprofitable' else 'review' end as waste_reason,
    customer_search_term, campaign_name, targeting_type, clicks, round(s, 2) as spend, round(a, 2) as sales, orders,
    {rnd(ratio('s', 'a'), 4)} as acos
    from (select customer_search_term, campaign_name, targeting_type, cast(sum(clicks) as bigint) as clicks, sum(spend) as s,
          sum(sales_7d) as a, cast(sum(orders_7d) as bigint) as orders from fact_terms join dim_campaign using (campaign_id)
          group by 1, 2, 3) g
    where clicks >= 15 and (orders = 0 or s > a)
    order by round(s, 2) desc, customer_search_term, campaign_name, targeting_type limit 50"""
CTES["q4"] = f"""select asin, substr(title, 1, 60) as title_short, round(t, 2) as total_sales, round(a, 2) as ad_sales,
    round(t - a, 2) as organic_sales, round(s, 2) as ad_spend, sessions, {rnd('conv', 2)} as avg_conversion_pct,
    ad_sales_share, {rnd(ratio('s', 't'), 4)} as tacos_asin,
    case when ad_sales_share >= 0.8 then 'ad_dependent' when ad_sales_share >= 0.4 then 'balanced'
         when ad_sales_share > 0 then 'organic_strong' else 'no_ads' end as health_label
    from (select asin, title, t, coalesce(a, 0) as a, coalesce(s, 0) as s, sessions, conv,
          {rnd(ratio('coalesce(a, 0)', 't'), 4)} as ad_sales_share
          from (select asin, sum(ordered_product_sales) as t, cast(sum(sessions_total) as bigint) as sessions,
                avg(unit_session_pct) as conv from fact_business group by 1) b
          left join (select asin, sum(spend) as s, sum(sales_7d) as a from fact_ads where asin is not null group by 1) f using (asin)
          left join dim_product using (asin) where t > 0) q"""


def _trend(key: str) -> str:
    keys = f"{key}, " if key else ""
    part = f"partition by {key}" if key else ""
    w = f"({part} order by date_id rows between 6 preceding and current row)"
    return f"""select {keys}date_id, daily_spend, rolling_7d_spend, daily_sales, daily_orders, daily_roas, rolling_7d_roas,
    round(lag7, 2) as spend_one_week_ago, {rnd(ratio('daily_spend - lag7', 'lag7'), 4)} as spend_wow_change,
    case when abs(daily_roas - rolling_7d_roas) / nullif(rolling_7d_roas, 0) > 0.5 then 'roas_anomaly' end as anomaly_flag
    from (select {keys}date_id, round(s, 2) as daily_spend, round(a, 2) as daily_sales, orders as daily_orders,
          {rnd(ratio('a', 's'), 2)} as daily_roas,
          {rnd(ratio(f'(sum(s) over {w})', f'(count(s) over {w})'), 2)} as rolling_7d_spend,
          {rnd(ratio(f'(sum(a) over {w})', f'(sum(s) over {w})'), 2)} as rolling_7d_roas,
          lag(s, 7) over ({part} order by date_id) as lag7
          from (select {keys}date_id, sum(spend) as s, sum(sales_7d) as a, cast(sum(orders_7d) as bigint) as orders
                from fact_ads group by {keys}date_id) d) q"""


CTES["q5"] = _trend("")
CTES["q5_by"] = _trend("campaign_id")
CTES["actuals"] = """select year, week, sum(case when upper(targeting_type) = 'AUTO' then spend else 0 end) as spend_auto,
    sum(case when upper(targeting_type) = 'MANUAL' then spend else 0 end) as spend_manual, sum(spend) as spend_total,
    cast(sum(impressions) as bigint) as impressions_total, cast(sum(clicks) as bigint) as clicks_total,
    sum(sales_7d) as ad_sales, cast(sum(orders_7d) as bigint) as ad_orders
    from fact_ads join dim_date using (date_id) join dim_campaign using (campaign_id) group by 1, 2"""


def _lattice(bounds: str = "true") -> str:
    i, j, k = "cast(i as double) / 100", "cast(j as double) / 100", "cast(k as double) / 100"
    r = [_steady(f"beta_{c}", f"(budget * ({x}))", c) for c, x in (("sp", i), ("sb", j), ("dsp", k))]
    return f"""select series, budget, budget * ({i}) as optimal_sp, budget * ({j}) as optimal_sb,
    budget * ({k}) as optimal_dsp, value as optimal_response from (
    select *, row_number() over (partition by series order by value desc, k, j) as rn from (
    select *, ({r[0]} + {r[1]}) + {r[2]} as value from (
        select series, mean_total as budget, {", ".join(f"coef_transformed_spend_{c} as beta_{c}" for c in _STOCK)},
        100 - j - k as i, j, k
        from model join spends using (series), (select unnest(range(101)) as j) a, (select unnest(range(101)) as k) b
        where j + k <= 100) c where {bounds}) v) q where rn = 1"""


CTES["optimum"] = _lattice()
CTES["optimum_bounded"] = _lattice("i between 20 and 60 and j between 10 and 50 and k between 5 and 40")


def _sql(body: str) -> str:
    """``body`` preceded by the expressions it uses, directly or through others."""
    order: list[str] = []

    def need(sql: str) -> None:
        for name in CTES:
            if name not in order and re.search(rf"\b(?:from|join)\s+{name}\b", sql):
                need(CTES[name])
                order.append(name)

    need(body)
    return "with " + ", ".join(f"{n} as ({CTES[n]})" for n in order) + " " + body if order else body


def _decimals(columns: str, names: set[str]) -> str:
    return ", ".join(f"{dbl(c)} as {c}" if c in names else c for c in columns.replace("\n", " ").split(", "))


_MONEY = {
    "spend", "sales", "sales_7d", "advertised_sku_sales_7d", "other_sku_sales_7d", "cpc", "total_sales_7d",
    "ordered_product_sales", "total_spend", "total_sales", "ad_sales", "organic_sales", "ad_spend", "daily_spend",
    "daily_sales", "spend_one_week_ago", "spend_auto", "spend_manual", "spend_total", "daily_budget",
}


def _pick(columns: str, source: str) -> str:
    return _sql(f"select {_decimals(columns, _MONEY)} from {source}")


def _scrub(x: str) -> str:
    # Longest first; the replacement's "$" is literal here.
    for term, repl in [("the supplier", "Brand_A_Group"), ("supplier", "Brand_A"), ("nation_1", "Place_$1"),
                       ("ring", "Brand_B_Item"), ("que", "Brand_C")]:
        x = f"regexp_replace({x}, '{term}', '{repl}', 'gi')"
    return x


def _embedded(x: str, pattern: str = "B0[A-Z0-9]{8}", prefix: str = "ASIN_") -> str:
    ids = f"list_distinct(regexp_extract_all({x}, '\\b{pattern}\\b'))"
    return (
        f"list_reduce(list_prepend({x}, {ids}), lambda acc, m: "
        f"regexp_replace(acc, '\\b' || m || '\\b', '{prefix}' || upper(substr(sha1(m), 1, 8)), 'g'))"
    )


def _hashed(x: str, prefix: str) -> str:
    return f"'{prefix}_' || substr(sha1(cast({x} as varchar)), 1, 10)"


def _masked(report, ids, source: str, optional: dict[str, str] | None = None, special: dict[str, str] | None = None) -> str:
    out = []
    for header, column in {**report, **(optional or {})}.items():
        value = (special or {}).get(column, dbl(column) if column in _MONEY and source in ("ads", "terms") else column)
        if header in TEXT_COLUMNS and source != "business":
            value = _embedded(f"({_scrub(column)})")
        elif header in TEXT_COLUMNS:
            value = _embedded(f"({_scrub(value)})")
        if header in ids:
            value = _hashed(value, PREFIXES[header])
        out.append(f'{value} as "{header}"')
    return _sql(f"select {', '.join(out)} from {source}")


_BUSINESS_STRINGS = {
    "sessions_total": "cast(sessions_total as varchar)",
    "page_views_total": "cast(page_views_total as varchar)",
    "units_ordered": "cast(units_ordered as varchar)",
    "unit_session_pct": "unit_session || '%'",
    "ordered_product_sales": (
        "'$' || format('{:,}', cast(floor(sales) as bigint)) || '.' || "
        "lpad(cast(cast(round((sales - floor(sales)) * 100) as int) as varchar), 2, '0')"
    ),
    "total_order_items": "cast(items as varchar)",
}


def _business_staged(
    rename: dict[str, str] | None = None, where: str = "", strings: dict[str, str] | None = None
) -> str:
    values = {**_BUSINESS_STRINGS, **(strings or {})}
    cols = ", ".join(f"{values.get(c, c)} as {(rename or {}).get(c, c)}" for c in BUSINESS.values())
    return _sql(f"select {cols} from business {where}")


_MART_TABLES = {
    "dim_date": "dim_date",
    "dim_campaign": "dim_campaign_name",
    "dim_product": "dim_product_sku",
    "fact_ads_daily": "ads_by_name",
    "fact_search_term": "terms_by_name",
    "fact_business_report": "(select * from business where parent_asin is not null)",
    "fact_weekly_channel_performance": "weekly_channel",
    "fct_mmm_weekly": "weekly",
    "fct_mmm_channel_spend_weekly": "(select week_start, unnest(['sp', 'sb', 'dsp']) as channel from weekly)",
}
_STAR_TABLES = {
    "dim_date": "dim_date",
    "dim_campaign": "dim_campaign",
    "dim_product": "dim_product",
    "fact_ads_daily": "fact_ads",
    "fact_search_term": "fact_terms",
    "fact_business_report": "fact_business",
}


def _checks(checks, sources: dict[str, str]) -> str:
    rows = []
    for c in checks:
        src, cols = sources[c.table], ", ".join(c.columns)
        if c.kind == "not_null":
            count = f"select count(*) from {src} x where {c.columns[0]} is null"
        elif c.kind == "relationship":
            parent = f"select {c.parent[1]} from {sources[c.parent[0]]} p where {c.parent[1]} is not null"
            count = f"select count(*) from {src} x where {cols} is not null and {cols} not in ({parent})"
        else:
            where = f"where {cols} is not null" if c.kind == "unique" else ""
            count = f"select count(*) from (select 1 from {src} x {where} group by {cols} having count(*) > 1) g"
        rows.append(
            f"select '{c.name}' as \"check\", '{c.table}' as \"table\", '{cols}' as \"columns\", "
            f"'{c.severity}' as severity, ({count}) as failing_rows"
        )
    return _sql(" union all ".join(rows))


def _by_channel(value) -> str:
    return "case channel " + " ".join(f"when '{c}' then {value(c)}" for c in _STOCK) + " end"


def _marginal(c: str) -> str:
    decay, k = _STOCK[c]
    level = f"(mean_spend * {(1 - decay**10) / (1 - decay)!r}::double + mean_spend * 0.01::double)"
    up = f"beta * {_hill(level, k)} * (mean_spend + mean_spend * 0.01::double)"
    return f"({up} - {_steady('beta', 'mean_spend', c)}) / nullif(mean_spend * 0.01::double, 0)"


def _r(columns: str, digits: int) -> str:
    return ", ".join(f"round({c}, {digits}) as {c}" for c in columns.split(", "))


def _curve(response: str) -> str:
    return f"""select series, channel, point, round(spend, 4) as spend, round({response}, 4) as response
    from (select *, point * (max_spend * 2 / 299) as spend from channels, (select cast(unnest(range(300)) as int) as point) p) g"""


_CURVE_WINDOW = "partition by series, channel order by point"
_SEQUENCE = _by_channel(
    lambda c: f"beta * {_hill(f'stock_{c}', _STOCK[c][1])} * spend"
)

_COUNTS = " union all ".join(
    f"select '{name}' as table_name, (select count(*) from {source} x) as row_count" for name, source in _STAR_TABLES.items()
)
_MONTHS = {"fact_ads_daily": "fact_ads", "fact_search_term": "fact_terms"}


def oracle_sql() -> dict[str, str]:
    out: dict[str, str] = {}
    masked_fact = f"""select snapshot_date, {_hashed('asin', 'ASIN')} as asin, sessions_total, page_views_total, buy_box_pct,
        units_ordered, unit_session_pct, {dbl('ordered_product_sales')} as ordered_product_sales, total_order_items from fact_business"""
    out["s1_k1_report_round_trip"] = _sql(masked_fact)
    out["s2_read_raw_landing"] = _sql(
        "select "
        + ", ".join(f"{_BUSINESS_STRINGS.get(c, c)} as {c}" for c in BUSINESS.values())
        + " from business"
    )
    odd = "parent_asin is not null and cast(right(parent_asin, 1) as int) % 2 = 1"
    out["s1_two_headers"] = _business_staged(
        strings={"product_title": f"product_title || case when {odd} then chr(10) || '\"two\"' else '' end"}
    )
    out["s3a_stage_bulk"] = _sql(f"select {', '.join(BULK.values())} from bulk")
    out["s3b_stage_ads"] = _pick(", ".join(ADS.values()), "ads")
    out["s3c_stage_terms"] = _pick(", ".join(TERMS.values()), "terms")
    out["s3d_stage_business"] = _business_staged()
    mix_columns = (
        "series, week_start, spend_sp, spend_sb, spend_dsp, spend_total, impressions_total, clicks_total, "
        "ad_sales, ad_orders, total_sales, organic_sales"
    )
    staged = _sql(f"select {mix_columns} from weekly")
    out["s3e_stage_mmm"] = out["k3_write_mmm"] = out["f8_mmm_weekly"] = staged
    out["k2_load_warehouse"] = out["k6_table_counts"] = _sql(_COUNTS)
    out["k4_materialize"] = _sql(
        "select campaign_name, cast(sum(spend) as double) as spend, cast(sum(orders) as bigint) as orders from ads_by_name group by 1"
    )
    out["k5_refresh_incremental"] = _sql(
        "select date_id, impressions, clicks, orders, spend, sales from daily_all where date_id >= date '2024-01-25' "
        "union all select date_id, impressions, clicks, orders, null as spend, sales from daily_early "
        "where date_id < date '2024-01-25' or date_id not in (select date_id from daily_all)"
    )
    out["k5_refresh_with_new_types"] = _sql(
        "select date_id, impressions, clicks, orders, spend, sales from daily_all where date_id >= date '2024-01-25' "
        "union all select date_id, impressions, clicks, orders, null as spend, floor(sales) as sales from daily_early "
        "where date_id < date '2024-01-25' or date_id not in (select date_id from daily_all)"
    )
    out["k2_load_by_day"] = out["x1_stream_daily"] = _sql("select date_id, impressions, clicks, orders, spend, sales from daily_all")
    # A day that ended three days before the first batch's last event is closed.
    out["x1_stream_late_rows"] = _sql(
        "select date_id, impressions, clicks, orders, spend, sales from daily_in_time"
    )

    out["p1_scrub_terms"] = f"select doc_id, {_scrub('text')} as text from documents"
    out["p2_hash_embedded_ids"] = _sql(
        f'select keyword_id as "Keyword ID", {_embedded("product_targeting_expression")} as expression from bulk'
    )
    out["p2_hash_numbers_in_texts"] = f"select doc_id, {_embedded('text', '[0-9]{3,}', 'N_')} as text from documents"
    out["p3_hash_id"] = (
        f"select c_custkey, {_hashed('c_custkey', 'Campaign_ID')} as campaign_hash, {_hashed('c_name', 'ASIN')} as asin_hash, "
        f"{_hashed('(case when c_acctbal > 0 then c_mktsegment end)', 'SKU')} as sku_hash from customer"
    )
    out["p5_hash_url"] = (
        "select page_id, case when page_id % 9 = 0 then '  ' when page_id % 10 = 0 then null "
        "else 'https://hashed-url.example/' || substr(sha1(url), 1, 12) end as url from pages"
    )
    out["p6_anonymize"] = (
        f"""select {_hashed('page_id', 'Campaign_ID')} as "Campaign ID", 'https://hashed-url.example/' || substr(sha1(url), 1, 12) """
        f"""as "Image URL", {_embedded(f"({_scrub('html')})")} as "Description", cast(length(html) as int) as "Impressions" from pages"""
    )
    bulk_extra = {"Portfolio Name (Informational only)": "portfolio_name", "ingest_seq": "ingest_seq"}
    out["p7_anonymize_bulk"] = _masked(BULK, BULK_IDS, "bulk", bulk_extra)
    out["p8_anonymize_terms"] = _masked(TERMS, TERM_IDS, "terms")
    out["p9_anonymize_ads"] = _masked(ADS, ADS_IDS, "ads", ADS_OPTIONAL)
    out["p10_anonymize_business"] = _masked(BUSINESS, BUSINESS_IDS, "business", special=_BUSINESS_STRINGS)
    overlap = (
        "(select count(distinct advertised_asin) from ads) as ids_a, (select count(distinct parent_asin) from business) as ids_b, "
        "(select count(*) from (select advertised_asin from ads intersect select parent_asin from business) i "
        "where advertised_asin is not null) as ids_both"
    )
    out["p11_id_overlap"] = _sql(f"select {overlap}, 'before' as state union all select {overlap}, 'after' as state")

    out["c1_c6_cleaning"] = """select l_orderkey,
        case l_returnflag when 'R' then 0 else cast(l_quantity as bigint) end as c1_count,
        case l_returnflag when 'A' then cast(cast(l_extendedprice as decimal(18,2)) as double) else 0 end as c2_money,
        case l_returnflag when 'A' then cast(cast(l_extendedprice as decimal(18,2)) as double) end as c3_money,
        case l_returnflag when 'R' then null else trunc(l_tax * 100) + 0.5 end::double as c4_pct,
        case l_returnflag when 'R' then 0 else cast(cast(l_extendedprice as decimal(18,2)) as double) end as c5_currency,
        case l_returnflag when 'R' then null else cast(l_shipdate as date) end as c6_date from lineitem"""
    price, tax = "cast(l_extendedprice as decimal(18,4))", "cast(l_tax as decimal(18,4))"
    out["c7_c13_scalars"] = f"""select l_orderkey, {rnd(ratio(price, 'l_quantity'), 2)} as c7_rounded,
        {rnd(ratio(price, tax), 4)} as c8_ratio,
        round(cast({price} as double) / (l_quantity + 1e-9::double), 3) as c9_eps,
        case when l_quantity > 25 then l_quantity else 0 end as c10_default,
        case when l_quantity >= 40 then 'high' when l_quantity >= 20 then 'mid' else 'low' end as c11_label,
        substr(l_returnflag, 1, 60) as c12_cut, abs(l_quantity - 25) as c13_abs from lineitem"""
    out["c6_report_dates"] = (
        "select o_orderkey, case when o_orderkey % 17 = 0 then null else cast(o_orderdate as date) end as day, "
        "(select count(*) from orders where o_orderkey % 17 = 0) as unreadable from orders"
    )
    out["c12_cut_texts"] = "select doc_id, substr(text, 1, 60) as start from documents"
    out["c14_c19_calendar"] = """select d, orders, cast(year(d) as int) as year, cast(month(d) as int) as month,
        cast(week(d) as int) as week, cast(isodow(d) as int) as iso_dow, cast(isodow(d) >= 6 as int) as is_weekend,
        cast(isoyear(d) as int) as iso_year, cast(day(d) as int) as day, cast(quarter(d) as int) as quarter,
        cast(dayofweek(d) + 1 as int) as sunday_dow, dayname(d) as day_name, monthname(d) as month_name,
        cast(d - cast(dayofweek(d) as int) as date) as sunday_week, cast(date_trunc('week', d) as date) as monday_week,
        round(sin(2 * pi() * week(d) / 52), 9) as season_sin, round(cos(2 * pi() * week(d) / 52), 9) as season_cos,
        cast(week(d) * week(d) as double) as c19_power
        from (select cast(o_orderdate as date) as d, count(*) as orders from orders group by 1) q"""

    out["d1_dim_date_observed"] = _sql("select * from dim_date")
    out["d2_dim_date_spine"] = """select d as date_id, d as full_date, cast(year(d) as int) as year, cast(month(d) as int) as month,
        cast(day(d) as int) as day, cast(quarter(d) as int) as quarter, cast(dayofweek(d) + 1 as int) as day_of_week,
        dayname(d) as day_name, monthname(d) as month_name
        from (select cast(unnest(generate_series(min(cast(o_orderdate as date))::timestamp, max(cast(o_orderdate as date))::timestamp,
              interval 1 day)) as date) as d from orders) q"""
    out["d3_dim_campaign_entity"] = _sql("select * from dim_campaign")
    out["d4_dim_campaign_dedup"] = _sql("select * from dim_campaign_name")
    out["d5_dim_product_outer"] = _sql("select * from dim_product")
    out["d6_dim_product_dedup"] = _sql("select * from dim_product_sku")
    out["d7_campaign_lookup"] = _sql("select * from lookup")
    out["d8_parent_products"] = _sql(
        f"""select coalesce(parent_asin, asin) as asin, cast(sum(spend) as double) as spend, cast(sum(sales) as double) as sales
        from ads_by_name left join (select {pid('p_partkey')} as asin,
            printf('B0%08d', min(p_partkey) over (partition by p_name, p_brand)) as parent_asin from part) b using (asin)
        group by 1"""
    )

    fact = f"date_id, campaign_id, asin, sku, {_FACT_SUMS}"
    out["f1_fact_ads_by_id"] = _pick(fact, "fact_ads")
    out["f1_ads_by_product"] = _sql(
        "select date_id, campaign_id, asin, "
        + ", ".join(
            f"cast(sum({m}) as {'double' if m in _MONEY else 'bigint'}) as {m}" for m in _FACT_SUMS.split(", ")
        )
        + " from fact_ads group by 1, 2, 3"
    )
    out["f2_fact_terms_by_id"] = _pick(
        "date_id, campaign_id, customer_search_term, targeting, match_type, impressions, clicks, spend, sales_7d, orders_7d",
        "fact_terms",
    )
    out["f3_fact_business_snapshot"] = _pick(
        "snapshot_date, asin, sessions_total, page_views_total, buy_box_pct, units_ordered, unit_session_pct, "
        "ordered_product_sales, total_order_items",
        "fact_business",
    )
    sums = "impressions, clicks, spend, sales, orders, units"
    out["f4_fact_ads_by_name"] = _pick(f"date_id, campaign_name, asin, sku, {sums}", "ads_by_name")
    out["f5_fact_terms_by_name"] = _pick(
        f"date_id, campaign_name, customer_search_term, match_type, {sums}", "terms_by_name"
    )
    out["f6_fact_business"] = _business_staged(
        {"ordered_product_sales": "sales", "total_order_items": "orders"}, "where parent_asin is not null"
    )
    channel = "week, ad_product, total_spend, total_sales, total_clicks, total_orders"
    out["f7_weekly_channel"] = _pick(channel, "weekly_channel")
    out["f7_weekly_channel_all_names"] = _sql(
        """select cast(date_id - cast(dayofweek(date_id) as int) as date) as week, coalesce(ad_product, 'unknown') as ad_product,
        cast(sum(spend) as double) as total_spend, cast(sum(sales) as double) as total_sales,
        cast(sum(clicks) as bigint) as total_clicks, cast(sum(orders) as bigint) as total_orders
        from ads_by_name left join dim_campaign_name using (campaign_name) group by 1, 2"""
    )
    labels = {"sp": "Sponsored Products", "sb": "Sponsored Brands", "dsp": "DSP"}
    out["f9_channel_spend_long"] = _sql(
        " union all ".join(f"select series, week_start, '{n}' as channel, spend_{c} as spend from weekly" for c, n in labels.items())
    )
    out["f10_weekly_actuals"] = _pick(
        "year, week, spend_auto, spend_manual, spend_total, impressions_total, clicks_total, ad_sales, ad_orders", "actuals"
    )
    out["f11_allocate_snapshot"] = _sql(
        """select year, week, round(share, 6) as organic_sales_est, round(cast(ad_sales as double) + share, 6) as total_sales_est,
        round(share, 6) as total_sales_alloc from (select *, (select cast(sum(ordered_product_sales) as double) from fact_business)
        / greatest(count(*) over (), 1) as share from actuals) q"""
    )
    panel = {"sp": "Sponsored_Products", "sb": "Sponsored_Brands", "dsp": "DSP"}
    out["f12_mmm_panel"] = _sql(
        " union all ".join(
            f"select series as geo, week_start as time, '{n}' as channel, spend_{c} as media, spend_{c} as spend from weekly"
            for c, n in panel.items()
        )
    )
    out["f12_mmm_panel_kpi"] = _sql(
        "select series as geo, week_start as time, total_sales as kpi, 1.0::double as population from weekly"
    )

    q1 = "campaign_name, portfolio_name, targeting_type, spend, ad_sales, orders, roas, acos, tacos"
    q2 = (
        "customer_search_term, campaign_name, targeting_type, match_type, impressions, clicks, spend, sales, orders, "
        "roas, acos, conversion_rate, rank_in_campaign"
    )
    q5 = (
        "date_id, daily_spend, rolling_7d_spend, daily_sales, daily_orders, daily_roas, rolling_7d_roas, "
        "spend_one_week_ago, spend_wow_change, anomaly_flag"
    )
    out["q1_campaign_roas_tacos"] = out["k2_q1_from_warehouse"] = _pick(q1, "q1")
    out["q2_harvestable_terms"] = _pick(q2, "q2")
    out["q2_harvestable_without_exact"] = _pick(q2, "q2_new")
    out["q3_wasted_spend"] = _pick(
        "waste_reason, customer_search_term, campaign_name, targeting_type, clicks, spend, sales, orders, acos", "q3"
    )
    out["q4_ads_vs_organic"] = _pick(
        "asin, title_short, total_sales, ad_sales, organic_sales, ad_spend, sessions, avg_conversion_pct, ad_sales_share, "
        "tacos_asin, health_label",
        "q4",
    )
    out["q5_daily_trend"] = _pick(q5, "q5")
    out["q5_daily_trend_by_campaign"] = _pick(f"campaign_id, {q5}", "q5_by")
    out["n1_roas_histogram"] = _sql(
        """select cast(b as int) as bin, round(low + b * ((high - low) / 30), 9) as bin_start,
        round(low + (b + 1) * ((high - low) / 30), 9) as bin_end,
        (select count(*) from q1 where spend >= 50 and roas is not null
            and least(cast(floor((roas - low) * 30 / (high - low)) as int), 29) = b) as campaigns, round(median_roas, 9) as median_roas
        from (select case when lo = hi then lo - 0.5 else lo end as low, case when lo = hi then hi + 0.5 else hi end as high, median_roas
              from (select min(roas) as lo, max(roas) as hi, median(roas) as median_roas from q1 where spend >= 50) m) e,
             (select unnest(range(30)) as b) bins"""
    )
    out["n2_top_harvest"] = _sql(
        f"select substr(customer_search_term, 1, 50) as term, campaign_name, match_type, {dbl('sales')} as sales from q2 "
        "order by q2.sales desc, customer_search_term, campaign_name, match_type limit 15"
    )
    out["n3_waste_by_reason"] = _sql(
        "select waste_reason, cast(sum(spend) as double) as total_spend, count(spend) as n_search_terms from q3 group by 1"
    )
    out["n4_health_distribution"] = _sql("select health_label, count(*) as products from q4 group by 1")
    out["n5_anomalous_days"] = _pick(q5, "q5 where anomaly_flag = 'roas_anomaly'")
    out["n6_query_totals"] = _sql(
        "select (select count(*) from q1) as campaigns, count(*) as wasted_terms, cast(sum(spend) as double) as total_wasted_spend from q3"
    )
    out["n7_mmm_overview"] = _sql(
        """select *, round(avg(tacos) over (partition by series), 9) as mean_tacos from (select series, week_start, spend_sp, spend_sb,
        spend_dsp, spend_total, total_sales, organic_sales, round(spend_total / (total_sales + 1e-9::double), 3) as tacos from weekly) q"""
    )

    out["t1_t4_mart_checks"] = _checks([*MART_CHECKS, ADS_GRAIN_CHECK], _MART_TABLES)
    out["t1_t4_mix_checks"] = _checks(MIX_CHECKS, _MART_TABLES)
    out["t5_failing_warnings"] = _sql(
        """select * from (select 'relationship_fact_ads_daily_campaign_name_to_dim_campaign' as "check", 'fact_ads_daily' as "table",
        'campaign_name' as "columns", 'warn' as severity, (select count(*) from ads_by_name where campaign_name not in
        (select campaign_name from dim_campaign)) as failing_rows) q where failing_rows > 0"""
    )
    out["t6_checks_from_schema"] = _checks(STAR_CHECKS, _STAR_TABLES)
    out["t7_schema_drift"] = """select * from (values
        ('o_channel', 'missing', 'string', null::bigint), ('o_orderpriority', 'unexpected', 'string', null),
        ('o_custkey', 'type', 'string -> bigint', null)) v("column", problem, detail, failing_rows)
        union all select * from (select 'o_totalprice', 'range', 'outside [1000.0, 400000.0]',
            count(*) filter (where o_totalprice < 1000 or o_totalprice > 400000) as n from orders) q where n > 0
        union all select * from (select 'o_custkey', 'range', 'outside [0.0, ]',
            count(*) filter (where o_custkey < 0) as n from orders) q where n > 0"""

    stocks = ", ".join(f"round(adstock_{c}, 6) as adstock_spend_{c}" for c in _STOCK)
    out["m1_adstock"] = _sql(f"select series, week_start, {stocks} from stocked")
    out["m2_hill"] = _sql(
        "select series, week_start, "
        + ", ".join(f"round({_hill(f'spend_{c}', k)}, 9) as hill_{c}" for c, (_, k) in _STOCK.items())
        + " from weekly"
    )
    out["m3_transform_channels"] = _sql(f"select series, week_start, {_r(', '.join(_X[:3]), 5)} from features")
    out["m4_season_features"] = _sql(f"select series, week_start, {_r(', '.join(_X[3:]), 9)} from features")
    out["m5_fit_ols"] = _sql("select * exclude (r2) from model")
    out["m6_predict"] = _sql(f"select series, week_start, round({_YHAT}, 3) as y_pred from features join model using (series)")
    out["m7_fit_metrics"] = _sql(
        """select series, round(1 - avg((total_sales - y_pred) * (total_sales - y_pred)) / nullif(var_pop(total_sales), 0), 9) as r2,
        round(avg(abs(total_sales - y_pred) / greatest(abs(total_sales), 2.220446049250313e-16::double)), 9) as mape from parts group by 1"""
    )
    contribs = "contrib_baseline, contrib_sp, contrib_sb, contrib_dsp, contrib_seasonality"
    out["m8_decompose"] = _sql(f"select series, week_start, total_sales, {_r(contribs + ', y_pred', 3)} from parts")
    out["m9_decomposition_residual"] = _sql(
        f"""select series, round(x, 6) as max_residual, x < 1 as ok from (select series, max(abs({contribs.replace(', ', ' + ')} - y_pred)) as x
        from parts group by 1) q"""
    )
    out["m10_contribution_shares"] = _sql(
        " union all ".join(
            f"select series, '{c.removeprefix('contrib_')}' as source, round(sum({c}) / nullif(sum(total_sales), 0), 9) as share from parts group by 1"
            for c in contribs.split(", ")
        )
    )
    out["m11_response_curve"] = _sql(_curve(_by_channel(lambda c: _steady("beta", "spend", c))))
    stocked_grid = ", ".join(f"{_stock('spend', d, _CURVE_WINDOW)} as stock_{c}" for c, (d, _) in _STOCK.items())
    out["m11_response_curve_sequence"] = _sql(
        f"""select series, channel, point, round(spend, 4) as spend, round({_SEQUENCE}, 4) as response from (select *, {stocked_grid}
        from (select *, point * (max_spend * 2 / 299) as spend from channels, (select cast(unnest(range(300)) as int) as point) p) g) h"""
    )
    steady = _by_channel(lambda c: f"mean_spend * {(1 - _STOCK[c][0] ** 10) / (1 - _STOCK[c][0])!r}::double")
    out["m12_steady_state_response"] = _sql(
        f"""select series, channel, round(mean_spend, 4) as mean_spend, round({steady}, 4) as adstock,
        round({_by_channel(lambda c: _steady('beta', 'mean_spend', c))}, 4) as response from channels"""
    )
    out["m13_marginal_return"] = _sql(
        f"select series, channel, round(mean_spend, 6) as mean_spend, round({_by_channel(_marginal)}, 6) as marginal_return from channels"
    )
    allocation = _r("budget, optimal_sp, optimal_sb, optimal_dsp, optimal_response", 3)
    out["m14_optimize_budget"] = _sql(f"select series, {allocation} from optimum")
    out["m14_optimize_budget_bounded"] = _sql(f"select series, {allocation} from optimum_bounded")
    current = " + ".join(_steady(f"coef_transformed_spend_{c}", f"mean_{c}", c) for c in _STOCK)
    out["m15_allocation_report"] = _sql(
        "select series, channel, "
        + _r("current_spend, optimal_spend, change_pct, current_response, optimal_response, uplift, uplift_pct", 3)
        + " from ("
        + " union all ".join(
            f"""select series, '{n}' as channel, mean_{c} as current_spend, optimal_{c} as optimal_spend,
            (optimal_{c} - mean_{c}) / nullif(mean_{c}, 0) * 100 as change_pct, {current} as current_response, optimal_response,
            optimal_response - ({current}) as uplift, optimal_response / nullif({current}, 0) - 1 as uplift_pct
            from optimum join model using (series) join spends using (series)"""
            for c, n in labels.items()
        )
        + ") q"
    )
    params = {f"beta_{c}": f"coef_transformed_spend_{c}" for c in _STOCK} | {"baseline": "intercept"}
    out["m16_parameter_recovery"] = _sql(
        " union all ".join(
            f"""select m.series, '{p}' as param, round(a.{c}, 6) as true_value, round(m.{c}, 6) as estimate,
            round(abs(m.{c} - a.{c}) / nullif(abs(a.{c}), 0), 6) as relative_error from model m cross join allmodel a"""
            for p, c in params.items()
        )
    )
    eps = "cast({} as double) / (cast({} as double) + 1e-9::double)"
    kpis = {"roas": ("ad_sales", "spend_total", 3), "tacos": ("spend_total", "total_sales", 3), "ctr": ("clicks_total", "impressions_total", 4)}
    out["m17_weekly_kpis"] = _sql(
        "select series, week_start, " + ", ".join(f"round({eps.format(a, b)}, {n}) as {k}" for k, (a, b, n) in kpis.items()) + " from weekly"
    )
    out["m17_kpi_total"] = _sql(
        """select series, round(sum(spend_total), 4) as spend, round(sum(ad_sales), 4) as ad_sales, round(sum(total_sales), 4) as total_sales,
        round(sum(ad_sales) / nullif(sum(spend_total), 0), 6) as roas, round(sum(spend_total) / nullif(sum(total_sales), 0), 6) as tacos,
        round(sum(clicks_total)::double / nullif(sum(impressions_total)::double, 0), 6) as ctr from weekly group by 1"""
    )
    cards = ("spend", "total_sales", "roas", "tacos")
    out["m18_scorecard_yoy"] = _sql(
        f"""select t.series, t.year, {", ".join(f"round(t.{c}, {4 if c in _MONEY else 6}) as {c}" for c in cards)},
        {", ".join(f"round(t.{c} / nullif(b.{c}, 0) - 1, 6) as {c}_yoy" for c in cards)}
        from yearly t left join yearly b on t.series = b.series and b.year = t.year - 1"""
    )
    out["m19_channel_mix"] = _sql(
        "select series, period, channel, round(spend, 4) as spend, round(spend / nullif(sum(spend) over (partition by series, period), 0), 6) as share from ("
        + " union all ".join(
            f"select series, cast(year(week_start) as int) as period, '{n}' as channel, sum(spend_{c}) as spend from weekly group by 1, 2"
            for c, n in labels.items()
        )
        + ") q"
    )
    out["m19_ads_organic_split"] = _sql(
        """select series, period, round(a, 4) as ad_sales, round(o, 4) as organic_sales, round(t, 4) as total_sales,
        round(a / nullif(t, 0), 6) as ad_share, round(o / nullif(t, 0), 6) as organic_share
        from (select series, cast(year(week_start) as int) as period, sum(ad_sales) as a, sum(organic_sales) as o,
              sum(total_sales) as t from weekly group by 1, 2) q"""
    )
    out["m20_grid_search"] = _sql(
        f"""select {_GRID_KEYS}, round(r2, 6) as r2 from (select *, row_number() over (partition by series order by r2 desc) as rn
        from gridmodel) q where rn = 1"""
    )
    out["m5_fit_incomplete"] = _sql("select * exclude (r2) from oddmodel")
    # Settings of a channel without spend all fit alike; the first combination of the grid wins.
    out["m20_grid_search_incomplete"] = _sql(
        f"""select {_GRID_KEYS}, r2 from (select {_GRID_KEYS}, round(r2, 6) as r2, row_number() over (partition by series
        order by round(r2, 9) desc, {", ".join(f"decay_{c}, half_saturation_{c}" for c in _GRID)}) as rn from oddgridmodel) q where rn = 1"""
    )
    stats = ", ".join(
        f"round(avg({x}), 6) as {n}_mean, round(quantile_cont({x}, 0.5), 6) as {n}_median, "
        f"round(quantile_cont({x}, {(1 - 0.9) / 2!r}), 6) as {n}_ci_lo, round(quantile_cont({x}, {1 - (1 - 0.9) / 2!r}), 6) as {n}_ci_hi"
        for x, n in (("roi", "roi"), ("share", "contribution_pct"))
    )
    out["m22_roi_intervals"] = _sql(f"select series, channel, {stats}, count(*) as replicates_used from rois group by 1, 2")
    out["m21_saturating_form"] = _sql(
        "select series, week_start, " + ", ".join(f"round(saturated_{c}, 9) as transformed_spend_{c}" for c in _STOCK) + " from features"
    )
    return out


CTES["yearly"] = """select series, cast(year(week_start) as int) as year, sum(spend_total) as spend, sum(total_sales) as total_sales,
    sum(ad_sales) / nullif(sum(spend_total), 0) as roas, sum(spend_total) / nullif(sum(total_sales), 0) as tacos from weekly group by 1, 2"""
