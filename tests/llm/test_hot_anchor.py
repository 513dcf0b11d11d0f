"""An anchor that half of all places share is dealt over several parts."""

from pyspark.sql import functions as F

from txrisk.llm import repeats


def test_totals_of_a_heavy_anchor_reach_all_its_rows(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 2 == 0, 7).otherwise(F.col("id")).cast("long").alias("anchor"),
        F.when(F.col("id") % 3 > 0, F.col("id")).alias("doc_id"), F.lit(0).alias("th"), (F.col("id") % 5).alias("start"), "id")
    counts = rows.groupBy("anchor").agg(F.count("*").alias("m"))
    heavy = repeats.heavy_anchors(counts)
    assert [r.anchor for r in heavy.collect()] == [7]
    got = repeats.with_anchor_totals(rows, counts, heavy, "doc_id", "th", "start")
    assert got.columns == ["anchor", "doc_id", "th", "start", "id", "m"]
    assert got.select("id").distinct().count() == got.count() == 20_000
    assert got.where(F.col("m") != F.when(F.col("anchor") == 7, 10_001).otherwise(1)).count() == 0


def test_heavy_anchors_are_few_at_any_size(spark):
    for n in (1, 999, 5000):
        counts = spark.range(n).select(F.col("id").alias("anchor"), (F.col("id") % 3 + 2).alias("m"))
        assert repeats.heavy_anchors(counts).count() <= repeats.HEAVY
    assert repeats.heavy_anchors(counts.limit(0)).count() == 0


def test_parts_of_a_heavy_anchor_are_even(spark):
    rows = spark.range(64_000).select(F.lit(1).cast("long").alias("anchor"), F.col("id").alias("doc_id"), F.lit(0).alias("th"),
                                      F.lit(0).alias("start"))
    part = F.pmod(F.xxhash64("doc_id", "th", "start"), F.lit(repeats.PARTS))
    sizes = [r["count"] for r in rows.groupBy(part.alias("p")).count().collect()]
    assert len(sizes) == repeats.PARTS and max(sizes) < 2 * min(sizes)
