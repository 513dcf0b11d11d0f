"""Conversation prefix trie against brute force over rebuilt texts."""

import collections
import hashlib
import random
import zlib

from pyspark.sql import functions as F

from txrisk.llm import prefix_trie
from txrisk.llm.common import prepare

SCHEMA = "conv_id long, turn long, role string, text string, depth int, hi string, code string, n string, length string"


def brute(rows, salt=""):
    convs = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            code = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append(((turn is not None, turn or 0), code, (role, text)))
    own = {c: [t for *_, t in sorted(v, key=lambda x: x[:2])] for c, v in convs.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c > 0 else -1)
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = collections.defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    children = collections.Counter(k[:-1] for k in members if k)
    leaves, saved = collections.Counter(), collections.Counter()
    for k, v in members.items():
        for d in range(len(k) + 1):
            leaves[k[:d]] += not children[k]
            saved[k[:d]] += (len(v) - 1) * (len(k[-1][1].encode()) if k else 0)
    out = []
    for k, v in members.items():
        ends = ",".join(str(c) for c in sorted(v) if len(rebuilt[c]) == len(k))
        out.append((min(v), len(k), min(members[k[:-1]]) if k else None, len(v), children[k], leaves[k], saved[k],
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def cases():
    r = random.Random(4)
    words = ["yes", "no", "é", "", None, "why so", "a" * 3000]
    rows = []
    for c in range(-12, 120):
        if c % 11 == 3:
            continue
        for t in range(r.randint(1, 14)):
            rows.append((c, r.choice([t, t, t, None, 3]), r.choice(["user", "user", "assistant", None, ""]), r.choice(words)))
    rows += [(c, t, "user", f"same {t}") for c in range(200, 320) for t in range(5)]          # one conversation many times
    rows += [(400, t, "user", f"long {t % 7}") for t in range(300)]                           # spans partitions
    rows += [(401, t, "user", f"long {t % 7}") for t in range(200)]
    rows += [(None, 0, "user", "lost"), (500, 0, "a", "bc"), (505, 0, "ab", "c"), (12, 0, "user", "x"), (12, 0, "user", "x")]
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(*x, 1, "h", "c", "n", "l") for x in rows], SCHEMA).repartition(5)


def test_against_rebuilt_texts(spark, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(prefix_trie, "ENDS_AT_ONCE", 7)
    rows = cases()
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")   # the long conversation spans partitions
    try:
        parts = prefix_trie.folded(prefix_trie.rows_of(frame(spark, rows)).withColumn("code", prefix_trie.turn_code(
            F.col("role"), F.col("text"), 0)).withColumn("size", F.octet_length("text").cast("long")), prefix_trie.Fold(0))
        assert parts.where("conv_id = 400").select(F.spark_partition_id()).distinct().count() > 1
        assert parts.where("conv_id = 400").agg(F.max("pos")).first()[0] == 300
        got = prefix_trie.digest(frame(spark, rows))
        assert sorted((tuple(x) for x in got.collect()), key=repr) == brute(rows)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    got = prefix_trie.digest(frame(spark, rows))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert sorted((tuple(x) for x in got.collect()), key=repr) == brute(rows)
    assert prefix_trie.digest(frame(spark, rows[:1]).limit(0)).collect() == []


def test_colliding_codes_start_over(spark):
    """Seed 0 gives turns of one first letter the same code."""
    prepare(spark)
    rows = [(c, t, "user", x) for c in range(0, 40, 5) for t, x in enumerate(["ab", "ac" if c % 2 else "ad", "b"])]
    seen = []

    def weak(role, text, seed):
        seen.append(seed)
        return prefix_trie.turn_code(role, text if seed else F.substring(text, 1, 1), seed)
    got = prefix_trie.trie(frame(spark, rows), code=weak).collect()
    assert seen == [0, 1]
    assert sorted((tuple(x) for x in got), key=repr) == brute(rows)
