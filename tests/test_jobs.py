"""The daily jobs end to end on files made from the given tables."""

from pathlib import Path

import pytest
from pyspark.sql import functions as F

from newsflow.functions.scores import Lexicon
from newsflow.operators import scoring
from newsflow.plans import jobs
from newsflow.plans.sentiment import WordPieces
from newsflow.plans.views import view
from newsflow.schema import RAW_ARCHIVE, RAW_ARTICLES, RAW_WIRE
from newsflow.session import scratch_path
from newsflow.sources import writers

FOLDER = "/root/testdata/sf0.001"
LEX = Lexicon(("the", "les"), ("and", "un"))


@pytest.fixture(scope="module")
def layers(spark):
    path = scratch_path(spark, "jobs")
    for feed, name, schema in (("articles", "articles_v", RAW_ARTICLES),
                               ("archive", "archive_v", RAW_ARCHIVE), ("wire", "wire_v", RAW_WIRE)):
        view(spark, FOLDER, name).select(*schema.names).write.parquet(f"{path}/raw/{feed}")
        jobs.cleanse(spark, feed, [f"{path}/raw/{feed}"], f"{path}/staging")
    counts = jobs.merge(spark, f"{path}/staging", f"{path}/news", f"{path}/quarantine")
    return path, counts.collect()


def test_merge_loses_no_row(spark, layers):
    path, counts = layers
    staged = spark.read.parquet(f"{path}/staging").count()
    kept, bad = spark.read.parquet(f"{path}/news").count(), spark.read.parquet(f"{path}/quarantine").count()
    assert kept + bad == staged == sum(r.rows for r in counts)
    assert bad == sum(r.rows for r in counts if r.year is None) > 0


def test_cleanse_again_changes_nothing(spark, layers):
    path, _ = layers
    before = spark.read.parquet(f"{path}/staging/feed=wire").count()
    jobs.cleanse(spark, "wire", [f"{path}/raw/wire"], f"{path}/staging")
    assert spark.read.parquet(f"{path}/staging/feed=wire").count() == before


def test_merge_and_quarantine_again(spark, layers):
    path, counts = layers
    again = jobs.merge(spark, f"{path}/staging", f"{path}/news", f"{path}/quarantine")
    assert sorted(map(str, again.collect())) == sorted(map(str, counts))
    kept, bad = spark.read.parquet(f"{path}/news").count(), spark.read.parquet(f"{path}/quarantine").count()
    assert kept + bad == sum(r.rows for r in counts)


def test_days_give_what_a_merge_gives(spark):
    path = scratch_path(spark, "days")
    items = {"20250317": [("A", "x", "1742169600", "same", "s"), ("A", "x", "1742169601", "same", "s"),
                          ("A", "x", "", "undated", "s")],
             "20250318": [("A", "x", "1742256000", "same", "s"), ("A", "x", "1742169600", "same", "s"),
                          ("A", "x", "1743500000", "april", "s")]}
    for day, rows in items.items():
        spark.createDataFrame(rows, RAW_WIRE).write.parquet(f"{path}/raw/{day}")
        jobs.cleanse(spark, "wire", [f"{path}/raw/{day}"], f"{path}/staging", day)
    for day in ("20250318", "20250317", "20250318"):
        counts = jobs.add_day(spark, f"{path}/staging", day, f"{path}/news", f"{path}/bad")
        assert sum(r.rows for r in counts.collect()) == 3
    jobs.merge(spark, f"{path}/staging", f"{path}/merged", f"{path}/worse")
    tables = [sorted(map(str, spark.read.parquet(f"{path}/{t}").collect())) for t in ("news", "merged")]
    assert tables[0] == tables[1] and len(tables[0]) == 5
    assert spark.read.parquet(f"{path}/bad").count() == spark.read.parquet(f"{path}/worse").count() == 1
    # a day that is staged anew takes the place of what it was; its staging can go
    spark.createDataFrame(items["20250318"][:1], RAW_WIRE).write.mode("overwrite").parquet(f"{path}/raw/x")
    jobs.cleanse(spark, "wire", [f"{path}/raw/x"], f"{path}/staging", "20250318")
    jobs.add_day(spark, f"{path}/staging", "20250318", f"{path}/news", f"{path}/bad", remove=True)
    got = sorted((r.month, r.headline) for r in spark.read.parquet(f"{path}/news").collect())
    assert got == [(3, "same")] * 3
    assert [p.name for p in Path(f"{path}/staging/feed=wire").iterdir()] == ["day=20250317"]


def staged(spark, path, items):
    for (feed, day), rows in items.items():
        df = spark.createDataFrame(rows, "symbol string, source string, datetime string, headline string, summary string")
        writers.write_staging(df, f"{path}/staging/feed={feed}/day={day}")


def stored(spark, path):
    rows = spark.read.parquet(f"{path}/news").select("feed", "day", "headline").collect()
    return sorted((r.feed, str(r.day), r.headline) for r in rows)


def test_a_merge_keeps_days_that_are_no_longer_staged(spark):
    path = scratch_path(spark, "kept")
    row = ("A", "x", "2025-03-17", "h", "s")
    staged(spark, path, {("wire", "1"): [row], ("wire", "2"): [row, ("A", "x", "2025-04-01", "april", "s")],
                         ("articles", "2"): [("A", "x", None, "undated", "s")]})
    args = (f"{path}/news", f"{path}/bad")
    jobs.add_day(spark, f"{path}/staging", "1", *args, remove=True)
    jobs.add_day(spark, f"{path}/staging", "2", *args)
    assert spark.read.parquet(f"{path}/bad").count() == 1
    # day 2 loses its row of April and becomes clean; another feed of day 1 comes late
    staged(spark, path, {("wire", "2"): [row], ("articles", "2"): [("A", "x", "2025-03-17", "dated", "s")],
                         ("articles", "1"): [("A", "x", "2025-03-17", "late", "s")], ("wire", "3"): []})
    counts = jobs.merge(spark, f"{path}/staging", *args).collect()
    assert stored(spark, path) == [("articles", "1", "late"), ("articles", "2", "dated"), ("wire", "1", "h"), ("wire", "2", "h")]
    assert sum(r.rows for r in counts) == 4 and not list(Path(f"{path}/bad").glob("day=*/feed=*"))
    jobs.add_day(spark, f"{path}/staging", "1", *args)
    assert len(stored(spark, path)) == 4
    # a staged day without rows empties its place
    staged(spark, path, {("wire", "2"): []})
    jobs.merge(spark, f"{path}/staging", *args)
    assert [r[:2] for r in stored(spark, path)] == [("articles", "1"), ("articles", "2"), ("wire", "1")]


def test_a_write_that_fails_leaves_the_table(spark, monkeypatch):
    path = scratch_path(spark, "failing")
    staged(spark, path, {("wire", "1"): [("A", "x", "2025-03-17", "h", "s")]})
    jobs.merge(spark, f"{path}/staging", f"{path}/news", f"{path}/bad")
    before = stored(spark, path)
    broken = F.raise_error(F.lit("no disk")).cast("string")
    monkeypatch.setattr(jobs, "split_undated", lambda rows: (rows.withColumn("headline", broken), rows.limit(0)))
    staged(spark, path, {("wire", "1"): [("A", "x", "2025-03-17", "new", "s")]})
    for run in (lambda: jobs.merge(spark, f"{path}/staging", f"{path}/news", f"{path}/bad"),
                lambda: jobs.add_day(spark, f"{path}/staging", "1", f"{path}/news", f"{path}/bad")):
        with pytest.raises(Exception, match="no disk"):
            run()
        assert stored(spark, path) == before


def test_score_and_features(spark, layers):
    path, _ = layers
    jobs.score(spark, f"{path}/news", f"{path}/scored", lexicon=LEX)
    jobs.score(spark, f"{path}/news", f"{path}/model", load=lambda: scoring.LexiconScorer(LEX))
    a, b = spark.read.parquet(f"{path}/scored"), spark.read.parquet(f"{path}/model")
    assert a.count() == b.count() == spark.read.parquet(f"{path}/news").count()
    totals = [df.agg(F.sum("positive_prob"), F.sum("negative_prob")).first() for df in (a, b)]
    assert tuple(totals[0]) == pytest.approx(tuple(totals[1]))
    jobs.score(spark, f"{path}/news", f"{path}/tokens", load=lambda: WordPieces(LEX), tokens=True)
    assert spark.read.parquet(f"{path}/tokens").filter("sentiment_label IS NOT NULL").count() > 0.9 * a.count()
    daily = jobs.features(spark, f"{path}/scored")
    assert daily.agg(F.sum("news_count")).first()[0] == a.count()


def test_evaluation_files(spark, layers):
    path, _ = layers
    prices = view(spark, FOLDER, "prices_v")
    jobs.score(spark, f"{path}/news", f"{path}/scored", lexicon=LEX)
    joined = jobs.price_features(spark, f"{path}/scored", prices.withColumnRenamed("date", "Date"))
    assert joined.count() == prices.count()
    errors = jobs.evaluate(joined, {"Stock": ["close"], "Both": ["close", "Sentiment"]}, "1996-12-31",
                           f"{path}/result")
    assert errors.count() == 2 * prices.select("symbol").distinct().count()
    stored = spark.read.option("header", True).csv(f"{path}/result/predictions")
    assert {"Pred_Stock", "Pred_Both"} <= set(stored.columns)
