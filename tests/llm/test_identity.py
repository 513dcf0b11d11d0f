"""Different texts are never taken for one another, whatever their hashes do."""

import collections
import hashlib
import zlib

import numpy as np
from pyspark.sql import functions as F

from txrisk.llm import debruijn, ngram_join, packing, repeats, suffix_dedup
from txrisk.llm import tokens as K
from txrisk.llm.common import prepare


def thue_morse(n, zero, one):
    return "".join(one if bin(i).count("1") % 2 else zero for i in range(n))


A, B = thue_morse(2048, "a", "b"), thue_morse(2048, "b", "a")


def test_thue_morse_words_are_different_words(spark):
    prepare(spark)
    docs = spark.createDataFrame([(1, A), (2, B)], "doc_id long, text string")
    tokenizer = packing.Encoder(*packing.default_tokenizer()).tokenizer
    got = {r.doc_id: r.ids_crc32 for r in packing.digest(docs).collect() if r.piece == 0}
    for d, t in ((1, A), (2, B)):
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], "<u4")
        assert got[d] == zlib.crc32(ids[: (len(ids) - 1) % 2048 + 1].tobytes())
    words = [f"{A} w{i}" for i in range(3)]
    same = spark.createDataFrame([(1, " ".join([A, *words])), (2, " ".join([B, *words]).replace(A, B))], "doc_id long, text string")
    assert {r.class_id for r in ngram_join.digest(same).collect()} == {1, 2}
    tail = " ".join(f"x{i}" for i in range(25))
    near = spark.createDataFrame([(1, f"{tail} {A} {tail[::-1]}"), (2, f"y {A[:9]} " + " ".join([B] * 3))], "doc_id long, text string")
    assert {r.n_removed for r in debruijn.digest(near).collect()} == {0}
    texts = [A[:512], thue_morse(512, "c", "d"), thue_morse(512, "d", "c"), thue_morse(300, "d", "c")]
    apart = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    count = collections.Counter(t[i:i + 200] for t in texts for i in range(len(t) - 199))
    want = {d: len({j for i in range(len(t) - 199) if count[t[i:i + 200]] > 1 for j in range(i, i + 200)}) for d, t in enumerate(texts)}
    assert {r.doc_id: r.n_removed for r in suffix_dedup.digest(apart).collect()} == want


def test_colliding_chunk_hashes_keep_their_bytes(monkeypatch):
    monkeypatch.setattr(packing.Encoder, "hashes", staticmethod(lambda data, start, end: (end - start).astype(np.uint64)))
    encoder = packing.Encoder(*packing.default_tokenizer())
    texts = [b"the cat sat", b"one two", b"", b"owt eno the"]
    ids, at = encoder.encode(np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)]))
    for k, t in enumerate(texts):
        assert ids[at[k]: at[k + 1]].tolist() == encoder.tokenizer.encode(t.decode(), add_special_tokens=False).ids


def test_texts_of_one_doc_id_stay_apart(spark):
    """Null and repeated doc_ids, with a 32-bit text hash made to collide."""
    prepare(spark)
    shared = "".join(chr(97 + (i * i + i // 7) % 26) for i in range(400))
    lone = "".join(chr(65 + (i * 7 + i // 11 + i * i // 13) % 26) for i in range(608))
    rows = [(None, shared), (None, lone), (7, shared + "!"), (7, lone.lower()), (8, "x"), (7, lone.lower())]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    seen = []

    def weak(text, seed):
        seen.append(seed)
        return F.lit(5) if not seed else F.xxhash64(F.lit(seed), text)
    known = repeats.identified(docs, weak)
    assert seen == [0, 1]
    count = collections.Counter(t.encode()[i:i + 200] for _, t in rows for i in range(len(t) - 199))
    got = suffix_dedup.remove(known, suffix_dedup.repeated_spans(known)).collect()

    def want(t):
        raw = t.encode()
        gone = {j for i in range(len(raw) - 199) if count[raw[i:i + 200]] > 1 for j in range(i, i + 200)}
        return len(raw), len(gone), hashlib.sha256(bytes(c for j, c in enumerate(raw) if j not in gone)).hexdigest()
    assert sorted((r.n_bytes, r.n_removed, hashlib.sha256(r.kept).hexdigest()) for r in got) == sorted(want(t) for _, t in rows)
    assert repeats.identified(docs.where("doc_id = 8")).collect() == [(8, 0, "x")]


def test_window_hashes_tell_windows_apart():
    r = np.random.default_rng(1)
    symbols = K.BYTE_VALUE[r.integers(0, 2, 5000)]
    for size, got in zip((1, 6, 20, 48, 200), K.window_hashes(symbols, 1, 6, 20, 48, 200), strict=True):
        windows = [symbols[i:i + size].tobytes() for i in range(5001 - size)]
        assert len(got) == len(windows) and len(set(windows)) == len(set(got.tolist())) == len(set(zip(windows, got.tolist(), strict=True)))
    assert [len(x) for x in K.window_hashes(symbols[:10], 6, 20)] == [5, 0]
