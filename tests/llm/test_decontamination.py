"""Containment search: items as a table, a filter of any fullness, hot items."""

import random
import re

import pytest

from txrisk.llm import decontaminate

WORD = re.compile(r"[0-9A-Za-z\x80-\U0010ffff]+")


def _words(text):
    return [w.lower() if w.isascii() else w for w in WORD.findall(text or "")]


def _brute(docs, items, threshold=0.8):
    """(doc_id, item_id, n_shared, n_item) per pair of rows."""
    out = []
    for doc_id, text in docs:
        have = _words(text)
        for item_id, item in items:
            w = _words(item)
            n = min(len(w), 5)
            if not n:
                continue
            mine = {tuple(w[i: i + n]) for i in range(len(w) - n + 1)}
            shared = len(mine & {tuple(have[i: i + n]) for i in range(len(have) - n + 1)})
            if shared >= threshold * len(mine):
                out.append((doc_id, item_id, shared, len(mine)))
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def planted():
    """Items of 1 to 200 words, whole, with a lost end, in two pieces, in one document many times."""
    r = random.Random(17)
    items = [(f"i{k}", " ".join(f"q{r.randrange(4000)}" for _ in range(n)))
             for k, n in enumerate([1, 2, 3, 4, 5, 6, 8, 9, 12, 13, 20, 21, 36, 37, 60, 100, 200] * 4)]
    items += [("same", items[10][1]), ("same", items[10][1]), ("null", None), ("none", "... !"), (None, "Né é ÉÉ x y z")]

    def noise(n):
        return " ".join(f"w{r.randrange(10 ** 6)}" for _ in range(n))
    docs = []
    for k, (_, item) in enumerate(items):
        w = (item or "").split()
        cut = len(w) // 2
        docs += [(k, f"{noise(50)}\n{item or ''} {noise(30)}"), (k, f"{noise(9)} {' '.join(w[: -max(len(w) // 10, 1)])} {noise(9)}"),
                 (1000 + k, f"{' '.join(w[:cut + 2])} {noise(70)} {' '.join(w[cut - 2 if cut > 2 else 0:])}")]
    docs += [(None, items[15][1].upper()), (None, None), (5, ""), (5, " "), (7, noise(40_000) + " " + items[30][1])]
    docs += [(2000 + k, f"{items[14][1]} {noise(5)}") for k in range(400)] + [(1, f"{items[16][1]}. " * 300)] * 2
    return docs, items


def _rows(df):
    return sorted(((r.doc_id, r.item_id, r.n_shared, r.n_item) for r in df.collect()), key=str)


def _frames(spark, docs, items):
    return (spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
            spark.createDataFrame(items, "item_id string, text string").repartition(3))


def test_pairs_equal_brute_force(spark, planted):
    docs, items = planted
    got = _rows(decontaminate.contaminated(*_frames(spark, docs, items)))
    assert got == _brute(docs, items)
    assert {n for *_, n in got} >= {1, 2, 4, 5, 8, 9, 16, 17, 32, 33, 56, 96, 196}


def test_a_full_filter_costs_rows_but_no_results(spark, planted, monkeypatch):
    docs, items = planted
    few = docs[::4]
    monkeypatch.setattr(decontaminate, "BITS_PER_HASH", 0)
    monkeypatch.setattr(decontaminate.Filter, "has", lambda self, x: x == x)
    assert _rows(decontaminate.contaminated(*_frames(spark, few, items))) == _brute(few, items)


def test_filter_has_all_hashes_of_the_items(spark, planted):
    import numpy as np
    table = decontaminate.item_table(_frames(spark, *planted)[1])
    known = decontaminate.item_filter(table)
    mine = np.unique(np.concatenate([np.array(r.shingles + r.keys, np.int64) for r in table.collect()])).view(np.uint64)
    assert known.has(mine).all()
    other = np.random.default_rng(1).integers(0, 2**63, 200_000, dtype=np.uint64)
    assert known.has(other[~np.isin(other, mine)]).mean() < 1e-3
    assert known.sizes == [8, 16, 32, 64, 128, 256] and known.widths == [1, 2, 3, 4] and known.few


def test_filter_keeps_rows_and_columns_of_clashing_names(spark, planted):
    docs, items = planted
    rows = [(i, "k", t, i, [1], "s", "u") for i, t in docs]
    df = spark.createDataFrame(rows, "row long, keys string, text string, hit long, shingles array<int>, salt string, item string")
    _, bench = _frames(spark, docs, items)
    clean = decontaminate.drop_contaminated(df.repartition(4), bench)
    assert clean.schema == df.schema
    bad = {t for _, t in docs if _brute([(0, t)], items)}
    assert sorted((r.row, r.text) for r in clean.where("row is not null").collect()) == sorted(
        (i, t) for i, t in docs if i is not None and t not in bad)
    assert clean.where("row is null").count() == sum(i is None and t not in bad for i, t in docs)


def test_empty_tables(spark, planted):
    docs, bench = _frames(spark, *planted)
    assert decontaminate.contaminated(docs.limit(0), bench).collect() == []
    assert decontaminate.contaminated(docs, bench.limit(0)).collect() == []
    assert decontaminate.drop_contaminated(docs, bench.limit(0)).count() == docs.count()
    assert decontaminate.drop_contaminated(docs.limit(0), bench).count() == 0
