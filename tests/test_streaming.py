from __future__ import annotations

import datetime as dt

from support import rows

from mixlens.plans import queries
from mixlens.streaming.daily import daily_from_events, stream_daily


def test_stream_equals_batch_and_takes_corrections(spark, tmp_path):
    ddl = "ts timestamp, event_type string, value double"
    first = [(dt.datetime(2025, 1, 1, h), k, 1.5) for h in range(3) for k in ("view", "click", "purchase", "error")]
    late = [(dt.datetime(2025, 1, 1, 5), "click", 2.0), (dt.datetime(2025, 1, 2, 1), "purchase", 4.0)]
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    for batch in (first, late):
        spark.createDataFrame(batch, ddl).write.mode("append").parquet(source)
        stream_daily(spark, source, target, state).awaitTermination()
        whole = daily_from_events(spark.read.schema(ddl).parquet(source))
        stored = spark.read.schema(whole.schema).parquet(target)
        assert rows(stored.select(*whole.columns), "date_id") == rows(whole, "date_id")
    # Nothing new: nothing changes.
    stream_daily(spark, source, target, state).awaitTermination()
    assert spark.read.parquet(target).count() == 2


def test_batch_numbers(spark):
    events = spark.createDataFrame(
        [(dt.datetime(2025, 1, 1, 23, 59), "click", 1.25), (dt.datetime(2025, 1, 2), "purchase", 9.0), (dt.datetime(2025, 1, 2), "view", 7.0)],
        "ts timestamp, event_type string, value double",
    )
    got = [(r["date_id"].day, r["impressions"], r["clicks"], r["orders"], float(r["spend"]), float(r["sales"])) for r in daily_from_events(events).orderBy("date_id").collect()]
    assert got == [(1, 0, 1, 0, 1.25, 0.0), (2, 1, 0, 1, 0.0, 9.0)]


def test_late_rows_keep_their_parallelism(spark, small, tmp_path, monkeypatch):
    spark.read.parquet(f"{small}/events.parquet").repartition(4).write.parquet(str(tmp_path / "events.parquet"))
    monkeypatch.setattr(queries, "scratch_path", lambda *_: str(tmp_path / "stream"))
    assert queries.x1_stream_late_rows(spark, str(tmp_path)).count() > 0
    assert len(list((tmp_path / "stream/events").glob("*.parquet"))) == 12
