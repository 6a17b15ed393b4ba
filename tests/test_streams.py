"""Streams over several increments: equal to the batch result, and nothing twice."""

import datetime as dt
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from newsflow.operators import news
from newsflow.schema import NEWS
from newsflow.session import scratch_path
from newsflow.sources import writers
from newsflow.streaming import ingest

SCORED = "symbol string, ts timestamp, positive_prob double, neutral_prob double, negative_prob double"


def add(spark, path, name, rows, schema=NEWS):
    spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{path}/in/{name}")


def take(spark, path):
    stream = ingest.ingest_stream(spark, f"{path}/in/*", NEWS)
    ingest.append_files(stream, f"{path}/out", f"{path}/cp")
    return sorted(r.headline for r in spark.read.schema(NEWS).parquet(f"{path}/out").collect())


def test_files_are_taken_once(spark):
    path = scratch_path(spark, "s")
    add(spark, path, "a", [("A", "x", "2025-01-01", "h1", "s")])
    assert take(spark, path) == ["h1"]
    assert take(spark, path) == ["h1"]
    add(spark, path, "b", [("A", "x", "2025-01-01", "h2", "s")])
    assert take(spark, path) == ["h1", "h2"]


def test_duplicates_across_increments(spark):
    path = scratch_path(spark, "s")
    schema = "symbol string, ts timestamp, headline string"
    t = dt.datetime(2025, 1, 1, 12)
    for name, hours in (("a", 0), ("b", 2)):
        add(spark, path, name, [("A", t + dt.timedelta(hours=hours), "h"), ("A", t, f"only {name}")], schema)
        stream = ingest.ingest_stream(spark, f"{path}/in/*", spark.read.parquet(f"{path}/in/a").schema)
        ingest.append_files(ingest.dedup_stream(stream, ["symbol", "headline"], "ts", "1 day"),
                            f"{path}/out", f"{path}/cp")
    got = spark.read.parquet(f"{path}/out").select("headline").collect()
    assert sorted(r.headline for r in got) == ["h", "only a", "only b"]


def test_days_come_out_once_and_late_rows_are_left(spark):
    path = scratch_path(spark, "s")
    day = dt.datetime(2025, 1, 1)
    batches = [
        [("A", day + dt.timedelta(hours=1), .2, .3, .5), ("A", day + dt.timedelta(hours=30), .4, .3, .3)],
        [("A", day + dt.timedelta(hours=2), .4, .3, .3), ("A", day + dt.timedelta(hours=60), .1, .1, .8)],
        [("A", day + dt.timedelta(hours=3), 1., 0., 0.), ("A", day + dt.timedelta(hours=90), .1, .1, .8)],
    ]
    for i, rows in enumerate(batches):
        add(spark, path, f"b{i}", rows, SCORED)
        schema = spark.read.parquet(f"{path}/in/b0").schema
        stream = ingest.ingest_stream(spark, f"{path}/in/*", schema)
        ingest.append_files(ingest.daily_stream(stream, "ts", "12 hours"), f"{path}/out", f"{path}/cp")
    got = {r.date.day: r for r in spark.read.parquet(f"{path}/out").collect()}
    assert sorted(got) == [1, 2, 3]
    assert (got[1].news_count, got[1].avg_positive) == (2, pytest.approx(0.3))


def run_upsert(spark, path, batch, number):
    upsert = ingest.upsert_months(f"{path}/table", "wire")
    upsert(news.with_months(batch), number)
    got = writers.read_months(spark, f"{path}/table", days=True).collect()
    return sorted((r.datetime, r.headline, r.summary) for r in got)


def rows(spark, *items):
    return spark.createDataFrame([("A", "x", *i) for i in items], NEWS)


def test_upsert_leaves_what_is_stored(spark):
    path = scratch_path(spark, "s")
    run_upsert(spark, path, rows(spark, ("2025-01-01", "h1", "first"), ("2025-02-01", "h", "feb")), 0)
    got = run_upsert(spark, path, rows(spark, ("2025-01-01", "h1", "again"), ("2025-01-02", "h2", "new"),
                                       (None, "undated", "")), 1)
    assert got == [("2025-01-01", "h1", "again"), ("2025-01-01", "h1", "first"), ("2025-01-02", "h2", "new"),
                   ("2025-02-01", "h", "feb")]


def test_batch_that_runs_again_replaces_its_rows(spark):
    path = scratch_path(spark, "s")
    first = rows(spark, ("2025-01-01", "h1", "a"), ("2025-01-01", "h1", "a"))
    want = run_upsert(spark, path, first, 0)
    assert len(want) == 2
    run_upsert(spark, path, rows(spark, ("2025-01-02", "h2", "b")), 1)
    assert run_upsert(spark, path, first, 0) == [*want, ("2025-01-02", "h2", "b")]


def test_late_rows_are_found_and_their_days_counted_anew(spark):
    path = scratch_path(spark, "s")
    day = dt.datetime(2025, 1, 1)
    items = [("A", day + dt.timedelta(hours=h), .2, .3, .5) for h in (1, 30, 60, 90)]
    late = [("A", day + dt.timedelta(hours=3), 1., 0., 0.), ("B", day + dt.timedelta(hours=31), 0., 0., 1.),
            ("C", None, 0., 0., 1.)]
    for i, batch in enumerate((items, late)):
        add(spark, path, f"b{i}", batch, SCORED)
        stream = ingest.ingest_stream(spark, f"{path}/in/*", spark.read.parquet(f"{path}/in/b0").schema)
        ingest.append_files(ingest.daily_stream(stream, "ts", "12 hours"), f"{path}/out", f"{path}/cp")
    stored, daily = spark.read.parquet(f"{path}/in/*"), spark.read.parquet(f"{path}/out")
    days = ingest.incomplete_days(daily, stored, "ts", until=dt.date(2025, 1, 4))
    assert sorted(r.date.day for r in days.collect()) == [1, 2]
    got = ingest.rebuild_days(daily, stored, "ts", days).collect()
    assert {(r.symbol, r.date.day, r.news_count) for r in got} == {
        ("A", 1, 2), ("A", 2, 1), ("B", 2, 1), ("A", 3, 1)}


def test_table_of_many_files_is_read_whole(spark):
    from newsflow.plans.streams import event_stream
    path = scratch_path(spark, "s")
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    events.repartition(7).write.parquet(f"{path}/events.parquet")
    ingest.append_files(event_stream(spark, path), f"{path}/out", f"{path}/cp")
    assert spark.read.parquet(f"{path}/out").count() == events.count()


def test_taken_files_can_be_archived(spark):
    path = scratch_path(spark, "s")
    add(spark, path, "a", [("A", "x", "2025-01-01", "h1", "s")])
    for headline in ("h1", "h2"):
        # the files of a run are moved by the runs after it
        stream = ingest.ingest_stream(spark, f"{path}/in/*", NEWS, archive=f"{path}/archive")
        ingest.append_files(stream.withColumn("n", F.lit(1)), f"{path}/out", f"{path}/cp")
        assert spark.read.parquet(f"{path}/out").count() == (1 if headline == "h1" else 2)
        add(spark, path, headline, [("A", "x", "2025-01-01", headline, "s")])
    moved = [p for p in Path(f"{path}/archive").rglob("*.parquet")]
    assert len(moved) == 1 and "/in/a/" in str(moved[0])
