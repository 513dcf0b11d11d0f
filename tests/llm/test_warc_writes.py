"""WARC archives over several writes, and what a filtered read inflates."""

import json

import pytest
from pyspark.sql import functions as F

from txrisk.llm import warc


def records(spark, first):
    pages = spark.createDataFrame([(first + i, f"u{first + i}", f"<p>{first + i}</p>" * 50) for i in range(3)],
                                  "page_id long, url string, html string")
    return warc.page_records(pages)


def test_append_keeps_and_overwrite_replaces(spark, tmp_path):
    warc.register(spark)
    path = str(tmp_path / "archive")

    def ids():
        return sorted(r[0] for r in spark.read.format("warc").option("path", path).load().select(warc.page_id_of(F.col("record_id"))).collect())
    for first in (0, 3):
        records(spark, first).write.format("warc").option("path", path).mode("append").save()
    assert ids() == [0, 1, 2, 3, 4, 5]
    bad = records(spark, 20).withColumn("target_uri", F.when(F.col("target_uri") == "u22", F.raise_error(F.lit("stop"))).otherwise(F.col("target_uri")))
    with pytest.raises(Exception, match="stop"):
        bad.write.format("warc").option("path", path).mode("append").save()
    assert ids() == [0, 1, 2, 3, 4, 5]
    records(spark, 10).write.format("warc").option("path", path).mode("overwrite").save()
    assert ids() == [10, 11, 12]
    records(spark, 13).write.format("warc").option("path", path).mode("append").save()
    assert ids() == [10, 11, 12, 13, 14, 15]
    named = sum((json.loads(p.read_text()) for p in (tmp_path / "archive").glob(warc.MANIFEST + "*")), [])
    assert len([n for n, _ in named]) == len(set(n for n, _ in named)) > 0


def test_filters_are_pushed_down(spark, tmp_path):
    warc.register(spark)
    path = str(tmp_path / "archive")
    records(spark, 0).write.format("warc").option("path", path).mode("append").save()
    back = spark.read.format("warc").option("path", path).option("payload", "true").load().where("target_uri = 'u1'")
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "Filter (" not in plan or "target_uri" not in plan.split("Filter (")[1].split("\n")[0].replace("isnotnull(target_uri", "")
    assert [r.target_uri for r in back.collect()] == ["u1"]
