"""A third of the rows on one key: the joins split it, and the answers stay right."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from hammerline.llm import components, exact_dedup, simhash_vp, warc
from hammerline.session import scratch_path

LOW = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.coalescePartitions.enabled": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "2k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.2",
    "spark.sql.adaptive.localShuffleReader.enabled": "false",
}


@pytest.fixture
def low_thresholds(spark):
    before = {key: spark.conf.get(key, None) for key in LOW}
    for key, value in LOW.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def final_plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def split(plan):
    return "skew=true" in plan or "skewed=true" in plan


def docs(spark, n=6000):
    text = F.when(F.col("id") % 3 == 0, F.lit("the hot text of many")).otherwise(F.concat(F.lit("text "), F.col("id").cast("string")))
    copies = F.when(F.col("id") % 9 == 1, F.lit("another text")).otherwise(text)
    return spark.range(n, numPartitions=8).select(F.col("id").alias("doc_id"), copies.alias("text"), F.repeat("text", 20).alias("more"))


def test_keep_first_spreads_a_hot_text(spark, low_thresholds):
    kept = exact_dedup.keep_first(docs(spark))
    rows = kept.collect()
    # The winner's id is part of the join, which spreads the rows of one text by their ids.
    assert "hashpartitioning(coalesce(id" in final_plan(kept)
    partial = final_plan(kept).count("partial_first")
    assert partial >= 1  # what is left of a text is reduced in each task first
    last = {r.text: r.doc_id for r in docs(spark).orderBy("doc_id").collect()}
    assert {r.text: r.doc_id for r in rows} == last and len(rows) == len(last)


def test_components_split_a_hub(spark, low_thresholds, monkeypatch):
    plans, once = [], components.materialise

    def watched(df):
        done = once(df)
        df.collect()
        plans.append(final_plan(df))
        return done

    monkeypatch.setattr(components, "materialise", watched)
    wide = spark.range(9000, numPartitions=8).select(F.col("id").alias("b"), F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") - 1).alias("a"))
    found = {r.node: r.root for r in components.components(wide.select("a", "b")).collect()}
    assert set(found.values()) == {0} and len(found) == 8999 and any(map(split, plans))


def test_archive_splits_a_hot_payload(spark, low_thresholds):
    pages = docs(spark).select(F.col("doc_id").alias("page_id"), F.lit("http://a.b/").alias("url"), F.col("text").alias("html"))
    path = scratch_path(spark, "archive")
    warc.write(pages, path)
    found = warc.summary(spark, path)
    rows = found.collect()
    assert split(final_plan(found)) and len(rows) == 6000
    assert Counter(r.record_type for r in rows)["response"] == docs(spark).select("text").distinct().count()


def test_near_dedup_keeps_one_of_many_equal_rows(spark):
    base = docs(spark, 900).withColumn("doc_id", F.when(F.col("doc_id") % 3 == 0, 0).otherwise(F.col("doc_id")))
    rows = simhash_vp.keep_one(base).collect()
    groups = simhash_vp.near_components(base).collect()
    assert sorted(r.doc_id for r in rows) == sorted({r.component_id for r in groups})


def test_record_ids_do_not_depend_on_the_partitioning(spark):
    page = "page_id long, url string, html string"
    rows = [(i % 40, None if i % 5 == 0 else f"http://h/{i % 7}", f"page {i % 11}" if i % 4 else None) for i in range(400)]
    rows += [(None, None, None)] * 50 + [(1, "u", "x")] * 60
    ids = []
    for parts, order in ((1, rows), (7, rows[::-1])):
        path = scratch_path(spark, "archive")
        warc.write(spark.createDataFrame(order, page).repartition(parts), path)
        headers = [r.header for r in spark.read.parquet(f"{path}/headers").collect()]
        assert len(set(headers)) == len(headers) == len(rows)
        ids.append(sorted(headers))
    assert ids[0] == ids[1]
