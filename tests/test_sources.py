from __future__ import annotations

import datetime as dt
import os

import pytest
from support import rows
from pyspark.sql import functions as F

from mixlens.plans import tables as t
from mixlens.session import scratch_path
from mixlens.sources import reports as rep
from mixlens.sources import warehouse as wh


def test_staging_accepts_raw_and_warehouse_headers(spark):
    raw = [(h, "v") for h in rep.ADS.columns]
    headers = [h for h, _ in raw]
    sanitised = [h.replace("(", "_").replace(")", "_").replace("#", "_") for h in headers]
    for names in (headers, sanitised, [h.strip() for h in headers]):
        df = spark.createDataFrame([tuple(f"v{i}" for i in range(len(names)))], names)
        staged = rep.stage_ads(df)
        assert staged.columns == list(rep.ADS.columns.values())
        assert rows(staged) == [tuple(f"v{i}" for i in range(len(names)))]


def test_staging_names_missing_columns(spark):
    with pytest.raises(ValueError, match="Customer Search Term"):
        rep.stage_terms(spark.createDataFrame([("a",)], ["Campaign Name"]))


def test_column_counts():
    assert [len(r.columns) for r in (rep.BULK, rep.ADS, rep.TERMS, rep.BUSINESS)] == [34, 19, 19, 11]


def test_csv_round_trip_keeps_quotes_commas_and_nulls(spark, tmp_path):
    headers = list(rep.BUSINESS.columns)
    values = ['id "x", y', "Title, with comma", None, "45.2%", "7", "1%", "2%", "3", "4%", "$1,234.50", "9"]
    df = spark.createDataFrame([tuple(values)], ", ".join(f"`{h}` string" for h in headers))
    path = str(tmp_path / "report")
    wh.write_report(df, path)
    wh.write_report(df, path)
    assert rows(rep.read_report(spark, path, rep.BUSINESS.schema)) == [tuple(values)]
    assert rows(rep.read_raw(spark, path, "business_report")) == [tuple(values)]
    with pytest.raises(ValueError):
        rep.read_raw(spark, path, "unknown")


def test_read_report_by_name_and_type(spark, tmp_path):
    path = str(tmp_path / "weekly")
    spark.createDataFrame([("2.5", "2025-01-06", "x")], ["spend_sp", "week_start", "other"]).write.option("header", True).csv(path)
    got = rep.read_report(spark, path, "week_start date, spend_sp double, spend_sb double")
    assert got.dtypes == [("week_start", "date"), ("spend_sp", "double")]
    assert rows(got) == [(dt.date(2025, 1, 6), 2.5)]


def test_warehouse_is_the_same_when_loaded_twice(spark, small, tmp_path):
    from mixlens.plans.star import star_by_id

    tables = star_by_id(t.bulk(spark, small), t.ads(spark, small), t.terms(spark, small), t.business(spark, small))
    path = str(tmp_path / "warehouse")
    counts = []
    for _ in range(2):
        wh.load_warehouse(tables, path, partitions={})
        counts.append(rows(wh.table_counts(wh.read_warehouse(spark, path)), "table_name"))
    assert counts[0] == counts[1] and len(counts[0]) == 6
    with pytest.raises(ValueError):
        wh.load_warehouse({"other": tables["dim_date"]}, path)


def test_partitioned_load_and_hot_day(spark, tmp_path):
    fact = spark.range(3000).select(
        F.when(F.col("id") < 2000, F.lit("2025-01-01")).otherwise(F.lit("2025-01-02")).cast("date").alias("date_id"),
        F.col("id").alias("campaign_id"),
    )
    paths = wh.load_warehouse({"fact_ads_daily": fact}, str(tmp_path / "w"))
    assert sorted(f for f in os.listdir(paths["fact_ads_daily"]) if "=" in f) == ["date_id=2025-01-01", "date_id=2025-01-02"]
    assert spark.read.parquet(paths["fact_ads_daily"]).count() == 3000


def test_materialize(spark):
    df = spark.range(5)
    assert wh.materialize("mixlens_test_view", df).count() == 5
    assert wh.materialize("mixlens_test_table", df, "table").count() == 5
    assert wh.materialize("mixlens_test_table", spark.range(3), "table").count() == 3
    with pytest.raises(ValueError):
        wh.materialize("x", df, "index")


def fact(spark, rows_, extra=False):
    ddl = "date_id date, k string, spend double" + (", clicks bigint" if extra else "")
    return spark.createDataFrame([(dt.date(2025, 1, d), *r) for d, *r in rows_], ddl)


def test_incremental_refresh(spark, tmp_path):
    path = str(tmp_path / "fact")
    wh.write_incremental_base(fact(spark, [(1, "a", 1.0), (5, "a", 1.0), (8, "a", 1.0), (9, "a", 1.0)]), path)
    # Day 8 is corrected, day 10 is new, day 1 comes too late, day 9 has no rows in this delivery.
    late = fact(spark, [(1, "a", 99.0), (8, "a", 2.0), (8, "b", 3.0), (10, "a", 4.0)], extra=False)
    for _ in range(2):
        got = wh.refresh_incremental(late, path, "2025-01-10", lookback_days=3)
        assert [(r["date_id"].day, r["k"], r["spend"]) for r in got.orderBy("date_id", "k").collect()] == [
            (1, "a", 1.0), (5, "a", 1.0), (8, "a", 2.0), (8, "b", 3.0), (9, "a", 1.0), (10, "a", 4.0),
        ]


def test_incremental_refresh_takes_on_new_columns_and_drops_old_ones(spark, tmp_path):
    path = str(tmp_path / "fact")
    wh.write_incremental_base(fact(spark, [(1, "a", 1.0)]), path)
    wider = fact(spark, [(9, "a", 2.0, 7)], extra=True).drop("spend")
    got = wh.refresh_incremental(wider, path, "2025-01-10")
    assert got.columns == ["k", "clicks", "date_id"] or set(got.columns) == {"k", "clicks", "date_id"}
    assert [(r["date_id"].day, r["clicks"]) for r in got.orderBy("date_id").collect()] == [(1, None), (9, 7)]
    assert wh.read_incremental(spark, path).columns == got.columns


def test_refresh_equals_rebuild_when_changes_are_recent(spark, tmp_path):
    old = fact(spark, [(d, "a", 1.0) for d in range(1, 11)])
    new = fact(spark, [(d, "a", 1.0 if d < 8 else 2.0) for d in range(1, 12)])
    wh.write_incremental_base(old, str(tmp_path / "a"))
    wh.write_incremental_base(new, str(tmp_path / "b"))
    refreshed = wh.refresh_incremental(new, str(tmp_path / "a"), "2025-01-11")
    assert rows(refreshed, "date_id") == rows(wh.read_incremental(spark, str(tmp_path / "b")), "date_id")


def test_scratch_is_below_the_configured_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    a, b = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert a.startswith(root) and a != b


def two_exports(spark, path, headers, first, second, swapped):
    """Two files of one folder; the second has two columns the other way round."""
    order = list(headers)
    i, j = order.index(swapped[0]), order.index(swapped[1])
    order[i], order[j] = order[j], order[i]
    schema = ", ".join(f"`{h}` string" for h in headers)
    for rows_, columns in ((first, headers), (second, order)):
        df = spark.createDataFrame(rows_, schema).select(*[f"`{c}`" for c in columns])
        df.coalesce(1).write.mode("append").option("header", True).option("escape", '"').csv(path)


def test_files_of_a_folder_are_read_by_their_own_headers(spark, tmp_path):
    path, headers = str(tmp_path / "in put"), list(rep.BUSINESS.columns)
    first = [tuple(f"a{i}" for i in range(len(headers)))]
    second = [tuple([f"b{i}" if headers[i] != "Title" else 'two "lines"\nof, text' for i in range(len(headers))])]
    two_exports(spark, path, headers, first, second, ("(Parent) ASIN", "Title"))
    assert sorted(rows(rep.stage_business(rep.read_raw(spark, path, "business_report")))) == sorted(first + second)
    assert sorted(rows(rep.read_report(spark, path, rep.BUSINESS.schema))) == sorted(first + second)


def test_no_raw_id_survives_another_column_order(spark, tmp_path):
    from mixlens.operators.anonymize import anonymize_bulk

    path, headers = str(tmp_path / "bulk"), [*rep.BULK.columns, "Title"]

    def row(sku):
        return tuple(sku if h == "SKU" else "a name" if h == "Title" else None for h in headers)

    two_exports(spark, path, headers, [row("SECRET-1")], [row("SECRET-2")], ("SKU", "Title"))
    masked = anonymize_bulk(rep.read_raw(spark, path, "bulk_campaigns"), [])
    out = str(tmp_path / "out")
    wh.write_report(masked, out)
    text = "\n".join(r[0] for r in spark.read.text(out).collect())
    assert "SECRET" not in text and text.count("a name") == 2 and text.count("SKU_") == 2


def test_refresh_with_another_type(spark, tmp_path):
    path = str(tmp_path / "daily")
    old = spark.createDataFrame([("2025-01-01", 5, "x"), ("2025-01-09", 7, "y")], "day string, sales long, gone string")
    new = spark.createDataFrame([("2025-01-09", 7.5, 1), ("2025-01-01", 9.5, 1)], "day string, sales double, more int")
    dated = [df.withColumn("date_id", F.col("day").cast("date")).drop("day") for df in (old, new)]
    wh.write_incremental_base(dated[0], path)
    got = wh.refresh_incremental(dated[1], path, "2025-01-10")
    want = [(dt.date(2025, 1, 1), 5.0, None), (dt.date(2025, 1, 9), 7.5, 1)]
    assert rows(got.select("date_id", "sales", "more"), "date_id") == want
    again = wh.refresh_incremental(dated[1], path, "2025-01-10")
    assert rows(again.select("date_id", "sales", "more"), "date_id") == want


def test_warehouse_tables_are_written_at_once(spark):
    import threading

    both = threading.Barrier(2, timeout=20)

    class Waiting:
        """A table whose write ends only while another one is being written."""

        sparkSession = spark

        @property
        def write(self):
            return self

        def mode(self, _mode):
            return self

        def parquet(self, path):
            both.wait()
            if path.endswith("dim_product"):
                raise ValueError(path)

    wh.load_warehouse({"dim_date": Waiting(), "dim_campaign": Waiting()}, "w", partitions={})
    with pytest.raises(ValueError, match="w/dim_product"):
        wh.load_warehouse({"dim_date": Waiting(), "dim_product": Waiting()}, "w", partitions={})


def shuffle_files(spark):
    """Names of the shuffle files that lie on this machine's disk now."""
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = (files.apply(i).getName() for i in range(files.size()))
    return {n for n in names if n.startswith("shuffle_") and n.endswith(".data")}


def sliced_fact(spark, path):
    """A fact that is summed, read from files: two rows a key, some without a date or sku."""
    spark.range(4000).select(
        F.when(F.col("id") % 7 > 0, F.date_add(F.lit(dt.date(2025, 1, 1)), (F.col("id") % 2000 % 50).cast("int"))).alias("date_id"),
        F.when(F.col("id") % 5 > 0, F.concat(F.lit("s"), F.col("id") % 2000)).alias("sku"),
        F.col("id").alias("clicks"),
    ).write.parquet(path)
    return spark.read.parquet(path).groupBy("date_id", "sku").agg(F.sum("clicks").alias("clicks"))


@pytest.mark.parametrize("partitions", [{}, {"fact_ads_daily": "date_id"}])
def test_a_fact_in_slices_is_whole_and_loads_again(spark, tmp_path, monkeypatch, partitions):
    tables = {"fact_ads_daily": sliced_fact(spark, str(tmp_path / "report")), "dim_date": spark.range(3)}
    want = rows(tables["fact_ads_daily"], "date_id", "sku")
    monkeypatch.setattr(wh, "SLICE_BYTES", 1)
    assert wh._slices(tables["fact_ads_daily"]) == wh.SLICES > 1
    for _ in range(2):
        paths = wh.load_warehouse(tables, str(tmp_path / "w"), partitions)
        got = spark.read.parquet(paths["fact_ads_daily"]).select("date_id", "sku", "clicks")
        assert rows(got, "date_id", "sku") == want
        assert os.path.exists(f"{paths['fact_ads_daily']}/_SUCCESS") and spark.read.parquet(paths["dim_date"]).count() == 3


def test_shuffles_of_a_slice_are_gone_before_the_next_one(spark, tmp_path, monkeypatch):
    fact = sliced_fact(spark, str(tmp_path / "report"))
    monkeypatch.setattr(wh, "SLICE_BYTES", 1)
    wh.release(spark)
    before, left, free = shuffle_files(spark), [], wh.release

    def watched(session):
        made = shuffle_files(session) - before
        for _ in range(20):
            free(session)
            if not made & shuffle_files(session):
                break
        left.append((len(made), len(made & shuffle_files(session))))

    monkeypatch.setattr(wh, "release", watched)
    wh.load_warehouse({"fact_ads_daily": fact}, str(tmp_path / "w"), {})
    assert len(left) == wh.SLICES and all(made and not still for made, still in left), left


def test_small_facts_and_facts_without_shuffles_are_written_at_once(spark, tmp_path, monkeypatch):
    summed = sliced_fact(spark, str(tmp_path / "report"))
    assert wh._slices(summed) == 1
    monkeypatch.setattr(wh, "SLICE_BYTES", 1)
    report = spark.read.parquet(str(tmp_path / "report"))
    assert wh._slices(report) == 1
    # A folder per day needs the rows of a day together.
    assert wh._slices(report, "date_id") == wh.SLICES
