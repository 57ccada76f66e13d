"""What the SQL counterparts take as given, stated again so that they do not depend on what they check."""

from __future__ import annotations

from typing import NamedTuple

# Headers of the exported reports and the staged column names.
BULK = {
    "Product": "product",
    "Entity": "entity",
    "Campaign ID": "campaign_id",
    "Ad Group ID": "ad_group_id",
    "Portfolio ID": "portfolio_id",
    "Ad ID": "ad_id",
    "Keyword ID": "keyword_id",
    "Product Targeting ID": "product_targeting_id",
    "Campaign Name": "campaign_name",
    "Ad Group Name": "ad_group_name",
    "Targeting Type": "targeting_type",
    "State": "state",
    "Daily Budget": "daily_budget",
    "SKU": "sku",
    "ASIN (Informational only)": "asin",
    "Ad Group Default Bid": "ad_group_default_bid",
    "Bid": "bid",
    "Keyword Text": "keyword_text",
    "Match Type": "match_type",
    "Bidding Strategy": "bidding_strategy",
    "Placement": "placement",
    "Percentage": "percentage",
    "Product Targeting Expression": "product_targeting_expression",
    "Impressions": "impressions",
    "Clicks": "clicks",
    "Click-through Rate": "ctr",
    "Spend": "spend",
    "Sales": "sales",
    "Orders": "orders",
    "Units": "units",
    "Conversion Rate": "conversion_rate",
    "ACOS": "acos",
    "CPC": "cpc",
    "ROAS": "roas",
}

ADS = {
    "Start Date": "start_date",
    "End Date": "end_date",
    "Portfolio name": "portfolio_name",
    "Campaign Name": "campaign_name",
    "Ad Group Name": "ad_group_name",
    "Country": "country",
    "Advertised SKU": "advertised_sku",
    "Advertised ASIN": "advertised_asin",
    "Impressions": "impressions",
    "Clicks": "clicks",
    "Click-Thru Rate (CTR)": "ctr",
    "Cost Per Click (CPC)": "cpc",
    "Spend": "spend",
    "7 Day Total Sales ": "total_sales_7d",
    "Total Advertising Cost of Sales (ACOS) ": "acos",
    "Total Return on Advertising Spend (ROAS)": "roas",
    "7 Day Total Orders (#)": "total_orders_7d",
    "7 Day Total Units (#)": "total_units_7d",
    "7 Day Conversion Rate": "conversion_rate_7d",
}

ADS_OPTIONAL = {
    "7 Day Advertised SKU Sales ": "advertised_sku_sales_7d",
    "7 Day Other SKU Sales ": "other_sku_sales_7d",
}

TERMS = {
    "Start Date": "start_date",
    "End Date": "end_date",
    "Portfolio name": "portfolio_name",
    "Campaign Name": "campaign_name",
    "Ad Group Name": "ad_group_name",
    "Targeting": "targeting",
    "Match Type": "match_type",
    "Customer Search Term": "customer_search_term",
    "Impressions": "impressions",
    "Clicks": "clicks",
    "Click-Thru Rate (CTR)": "ctr",
    "Cost Per Click (CPC)": "cpc",
    "Spend": "spend",
    "7 Day Total Sales ": "total_sales_7d",
    "Total Advertising Cost of Sales (ACOS) ": "acos",
    "Total Return on Advertising Spend (ROAS)": "roas",
    "7 Day Total Orders (#)": "total_orders_7d",
    "7 Day Total Units (#)": "total_units_7d",
    "7 Day Conversion Rate": "conversion_rate_7d",
}

BUSINESS = {
    "(Parent) ASIN": "parent_asin",
    "Title": "product_title",
    "Sessions - Total": "sessions_total",
    "Session Percentage - Total": "session_pct_total",
    "Page Views - Total": "page_views_total",
    "Page Views Percentage - Total": "page_views_pct_total",
    "Featured Offer (Buy Box) Percentage": "buy_box_pct",
    "Units Ordered": "units_ordered",
    "Unit Session Percentage": "unit_session_pct",
    "Ordered Product Sales": "ordered_product_sales",
    "Total Order Items": "total_order_items",
}

# Headers that hold free text, and the id columns of each report.
TEXT_COLUMNS = (
    "Campaign Name",
    "Campaign Name (Informational only)",
    "Ad Group Name",
    "Ad Group Name (Informational only)",
    "Portfolio Name (Informational only)",
    "Portfolio name",
    "Keyword Text",
    "Customer Search Term",
    "Targeting",
    "Product Targeting Expression",
    "Resolved Product Targeting Expression (Informational only)",
    "Title",
    "Product Name",
    "Description",
)
BULK_IDS = (
    "Campaign ID",
    "Ad Group ID",
    "Portfolio ID",
    "Ad ID",
    "Keyword ID",
    "Product Targeting ID",
    "ASIN (Informational only)",
    "SKU",
)
TERM_IDS = (
    "Campaign ID",
    "Ad Group ID",
    "Advertised ASIN",
    "ASIN",
)
ADS_IDS = (
    "Campaign ID",
    "Ad Group ID",
    "Advertised ASIN",
    "Advertised SKU",
    "ASIN",
    "SKU",
)
BUSINESS_IDS = (
    "(Parent) ASIN",
    "(Child) ASIN",
    "ASIN",
)

# The prefix of each masked id.
PREFIXES = {
    "Campaign ID": "Campaign_ID",
    "Ad Group ID": "Ad_Group_ID",
    "Portfolio ID": "Portfolio_ID",
    "Ad ID": "Ad_ID",
    "Keyword ID": "Keyword_ID",
    "Product Targeting ID": "Product_Targeting_ID",
    "ASIN (Informational only)": "ASIN",
    "SKU": "SKU",
    "Advertised ASIN": "ASIN",
    "ASIN": "ASIN",
    "Advertised SKU": "SKU",
    "(Parent) ASIN": "ASIN",
    "(Child) ASIN": "ASIN",
}


class Check(NamedTuple):
    kind: str
    table: str
    columns: tuple[str, ...]
    severity: str = "error"
    parent: tuple[str, str] | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}_{self.table}_{'_'.join(self.columns)}" + (f"_to_{self.parent[0]}" if self.parent else "")


# The checks that the marts declare, then those that the star schema's keys imply.
MART_CHECKS = (
    Check("not_null", "dim_date", ("date_id",)),
    Check("unique", "dim_date", ("date_id",)),
    Check("not_null", "dim_campaign", ("campaign_id",)),
    Check("not_null", "dim_campaign", ("campaign_name",)),
    Check("unique", "dim_campaign", ("campaign_id",)),
    Check("not_null", "dim_product", ("sku",)),
    Check("unique", "dim_product", ("sku",)),
    Check("not_null", "fact_ads_daily", ("date_id",)),
    Check("not_null", "fact_ads_daily", ("asin",)),
    Check("not_null", "fact_ads_daily", ("campaign_name",)),
    Check("not_null", "fact_ads_daily", ("impressions",)),
    Check("relationship", "fact_ads_daily", ("asin",), "error", ("dim_product", "asin")),
    Check("relationship", "fact_ads_daily", ("campaign_name",), "warn", ("dim_campaign", "campaign_name")),
    Check("unique_combination", "fact_ads_daily", ("date_id", "campaign_name", "asin")),
    Check("not_null", "fact_search_term", ("date_id",)),
    Check("not_null", "fact_search_term", ("campaign_name",)),
    Check("not_null", "fact_search_term", ("customer_search_term",)),
    Check("relationship", "fact_search_term", ("campaign_name",), "warn", ("dim_campaign", "campaign_name")),
    Check("not_null", "fact_business_report", ("parent_asin",)),
    Check("unique", "fact_business_report", ("parent_asin",)),
    Check("relationship", "fact_business_report", ("parent_asin",), "warn", ("dim_product", "asin")),
    Check("not_null", "fact_weekly_channel_performance", ("week",)),
    Check("not_null", "fact_weekly_channel_performance", ("ad_product",)),
    Check("not_null", "fact_weekly_channel_performance", ("total_spend",)),
    Check("not_null", "fact_weekly_channel_performance", ("total_sales",)),
    Check("unique_combination", "fact_weekly_channel_performance", ("week", "ad_product")),
)
ADS_GRAIN_CHECK = Check("unique_combination", "fact_ads_daily", ("date_id", "campaign_name", "asin", "sku"))
MIX_CHECKS = (
    Check("not_null", "fct_mmm_weekly", ("week_start",)),
    Check("unique", "fct_mmm_weekly", ("week_start",)),
    Check("not_null", "fct_mmm_channel_spend_weekly", ("week_start",)),
    Check("unique_combination", "fct_mmm_channel_spend_weekly", ("week_start", "channel")),
)
STAR_CHECKS = (
    Check("not_null", "dim_date", ("date_id",)),
    Check("not_null", "dim_date", ("year",)),
    Check("not_null", "dim_date", ("month",)),
    Check("not_null", "dim_date", ("week",)),
    Check("not_null", "dim_date", ("day_of_week",)),
    Check("not_null", "dim_date", ("is_weekend",)),
    Check("unique", "dim_date", ("date_id",)),
    Check("not_null", "dim_campaign", ("campaign_id",)),
    Check("not_null", "dim_campaign", ("campaign_name",)),
    Check("unique", "dim_campaign", ("campaign_id",)),
    Check("not_null", "dim_product", ("asin",)),
    Check("unique", "dim_product", ("asin",)),
    Check("not_null", "fact_ads_daily", ("date_id",)),
    Check("not_null", "fact_ads_daily", ("campaign_id",)),
    Check("unique_combination", "fact_ads_daily", ("date_id", "campaign_id", "asin")),
    Check("relationship", "fact_ads_daily", ("date_id",), "error", ("dim_date", "date_id")),
    Check("relationship", "fact_ads_daily", ("campaign_id",), "error", ("dim_campaign", "campaign_id")),
    Check("relationship", "fact_ads_daily", ("asin",), "error", ("dim_product", "asin")),
    Check("not_null", "fact_search_term", ("date_id",)),
    Check("not_null", "fact_search_term", ("campaign_id",)),
    Check("not_null", "fact_search_term", ("customer_search_term",)),
    Check("relationship", "fact_search_term", ("date_id",), "error", ("dim_date", "date_id")),
    Check("relationship", "fact_search_term", ("campaign_id",), "error", ("dim_campaign", "campaign_id")),
    Check("not_null", "fact_business_report", ("snapshot_date",)),
    Check("not_null", "fact_business_report", ("asin",)),
    Check("unique_combination", "fact_business_report", ("snapshot_date", "asin")),
    Check("relationship", "fact_business_report", ("asin",), "error", ("dim_product", "asin")),
)
