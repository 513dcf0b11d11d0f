"""SQL of the document operators on awkward rows: nulls, empties, repeats, marks."""

import duckdb
import pytest

from txrisk.llm import debruijn, licenses, oracles, quality_rules, suffix_dedup, warc
from txrisk.llm.common import prepare

PASSAGE = " ".join(f"w{i}" for i in range(60))
TEXTS = [None, "", " \n\t ", PASSAGE, f"lead in {PASSAGE} tail", "a b c d e " * 9, "Ünï çödé\nline\nline\n" + PASSAGE[:250],
         "MIT License MIT License under the Apache License, Version 2.0", "CC BY-SA 4.0 and GNU General\n * Public License v3",
         "licensed under the MIT license or the GNU Lesser General Public License version 2.1 or later", "##### $$$ !!! ...\n...\n…",
         "x" * 1200, "SHOUT " * 20, "\x01 bell \x02 " * 12]


def both(spark, got, sql, name, rows, schema):
    table = spark.createDataFrame(rows, schema).toArrow()
    con = duckdb.connect()
    con.register(name, table)
    result = con.sql(sql)
    columns = sorted(result.columns)
    assert columns == sorted(got.columns)
    order = lambda found: sorted(map(repr, found))
    return (order(tuple(r[c] for c in columns) for r in got.collect()),
            order(tuple(r[result.columns.index(c)] for c in columns) for r in result.fetchall()))


@pytest.mark.parametrize("digest, sql", [
    (licenses.digest, oracles.license_sql()), (quality_rules.digest, oracles.QUALITY),
    (suffix_dedup.digest, oracles.BYTES), (debruijn.digest, oracles.SUBSTRINGS)])
def test_documents(spark, digest, sql):
    prepare(spark)
    rows = list(enumerate(TEXTS))
    ours, theirs = both(spark, digest(spark.createDataFrame(rows, "doc_id long, text string")), sql, "documents",
                        rows, "doc_id long, text string")
    assert ours == theirs and len(ours) == len(TEXTS)


def test_policy(spark):
    assert oracles.POLICY == quality_rules.policy_mask(quality_rules.PRODUCTION)


def test_pages(spark):
    prepare(spark)
    rows = [(1, "u", None), (2, "u", ""), (3, "u", "<p>ä</p>"), (4, None, "<p>ä</p>"), (5, "u", "z" * 5000)]
    schema = "page_id long, url string, html string"
    ours, theirs = both(spark, warc.round_trip(spark.createDataFrame(rows, schema)), oracles.WARC, "pages", rows, schema)
    assert ours == theirs and len(ours) == 5
