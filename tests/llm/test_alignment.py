"""Cross-tokenizer alignment against the tokenizers themselves."""

import collections
import hashlib
import random

import numpy as np
import pytest

from txrisk.llm import alignment
from txrisk.llm.common import prepare

SCHEMA = "doc_id long, text string, pair string, block string, n_a string"


@pytest.fixture(scope="module")
def both():
    import public_tokenizers as P
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))
    # the byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    of = {chr(x): x for x in plain} | {chr(256 + k): x for k, x in enumerate(x for x in range(256) if x not in plain)}

    def tokens(text):
        if not text:
            return [], []
        ta = [(i, bytes(of[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        tb = []
        for i in b.encode(text):
            p = b.id_to_piece(i)
            tb.append((i, bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()))
        raw = (" " + text).encode()
        return (ta, tb) if b"".join(x for _, x in ta) == raw == b"".join(x for _, x in tb) else ([], [])
    return tokens


def brute(tokens, texts):
    found, counts = [], collections.Counter()
    for text in texts:
        ta, tb = tokens(text)
        ends = [np.cumsum([len(x) for _, x in t]).tolist() for t in (ta, tb)]
        common = sorted(set(ends[0]) & set(ends[1]))
        groups, last = [], 0
        for c in common:
            groups.append("|".join(",".join(str(i) for (i, _), e in zip(t, ee, strict=True) if last < e <= c)
                                   for t, ee in ((ta, ends[0]), (tb, ends[1]))))
            last = c
        links = [(i, j) for (i, _), e in zip(ta, ends[0], strict=True) for (j, _), f in zip(tb, ends[1], strict=True) if e == f] \
            if len(ta) < 3000 else [(dict(zip(ends[0], (i for i, _ in ta), strict=True))[c],
                                     dict(zip(ends[1], (i for i, _ in tb), strict=True))[c]) for c in common[:0]]
        counts.update(links)
        found.append((len(ta), len(tb), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if ta else ""))
    most = collections.Counter()
    for (_, j), n in counts.items():
        most[j] = max(most[j], n)
    return [(*x[:3], len(x[3]), sum(counts[p] == most[p[1]] for p in x[3]), sum(counts[p] for p in x[3]), x[4]) for x in found]


def texts():
    r = random.Random(9)
    odd = ["", None, " ", "a", " a", "a ", "  ", "a  b", "a \n b", "\n\nx", "tab\there", "a b c", "x  y", "a▁b", "▁",
           "<|endoftext|> and <s> <unk> <0x0A>", "it's we'll", "漢字 é́ \U0001f600\U0001f600", "\x00 \x1c a", "é ﬁ",
           "word " * 400, "x" * 700, "1234567890 12 3", "a\r\n\r\nb ;\r x", "\t", "\x0b x", "﻿a b", " \n", "x \n", "　a b", "a\u0085 b"]
    alphabet = [" ", " ", "\n", "\t", "\r\n", "a", "the", "ing", "é", " ", "9", ".", "'s", "▁", "漢", ")", "{"]
    made = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 25))) for _ in range(300)]
    return odd + made + odd


def test_digest(spark, both, monkeypatch):
    prepare(spark)
    monkeypatch.setattr(alignment, "BLOCK_BYTES", 600)
    rows = texts()
    df = spark.createDataFrame([(i if i else None, t, "p", "b", "n") for i, t in enumerate(rows)], SCHEMA).repartition(3)
    got = {r.doc_id or 0: tuple(r)[1:] for r in alignment.digest(df).collect()}
    want = brute(both, rows)
    assert [(t, got[i], w) for i, (t, w) in enumerate(zip(rows, want, strict=True)) if got[i] != w] == []
    assert alignment.digest(df.limit(0)).collect() == []


def test_links_of_all_kinds(spark, both):
    prepare(spark)
    rows = ["alignment of unbelievable words", "a 漢字 b", "", "antidisestablishmentarianism  x"]
    df = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    for kind in ("overlap", "together", "grouped"):
        got = sorted(tuple(r) for r in alignment.links(df, kind).collect())
        want = []
        for d, t in enumerate(rows):
            ta, tb = both(t)
            ea, eb = (np.cumsum([0] + [len(x) for _, x in y]) for y in (ta, tb))
            common = sorted(set(ea) & set(eb))
            for i, (x, _) in enumerate(ta):
                for j, (y, _) in enumerate(tb):
                    shared = min(ea[i + 1], eb[j + 1]) - max(ea[i], eb[j])
                    same = np.searchsorted(common, ea[i + 1]) == np.searchsorted(common, eb[j + 1])
                    value = {"overlap": max(shared, 0), "together": int(ea[i + 1] == eb[j + 1]), "grouped": int(same)}[kind]
                    if value:
                        want.append((d, i, j, x, y, int(value)))
        assert got == sorted(want)


def test_very_long_word():
    aligner = alignment.Aligner(*alignment.default_tokenizers())
    found = aligner.documents([("ab" * 200_000).encode()])
    assert len(found[0]) == 1 and aligner.sizes[1].at[found[0][0]] > 100_000 and not aligner.known


def test_aligner_remembers_a_bounded_number_of_chunks(monkeypatch):
    monkeypatch.setattr(alignment, "REMEMBERED", 60)
    monkeypatch.setattr(alignment, "LEARN_CHUNKS", 7)
    rng = random.Random(5)
    words = ["".join(rng.choices("abcdefgh", k=5)) for _ in range(400)]
    long = ["x" * 150 + str(i) for i in range(20)]
    odd = [f"one\u00a0two {i} three" for i in range(20)]
    texts = [" ".join(["the", "same", *rng.sample(words, 12), "words"]).encode() for _ in range(80)] + [x.encode() for x in long + odd]
    paths = alignment.default_tokenizers()
    aligner, sizes = alignment.Aligner(*paths), []

    def seen(a, numbers):
        return [[(*(int(g.at[c]) for g in a.sizes), a.texts[c], a.pairs.at[a.ends.at[c] - a.sizes[3].at[c]: a.ends.at[c]].tolist()) for c in some] for some in numbers]

    for i in range(0, len(texts), 4):
        numbers = aligner.documents(texts[i: i + 4])
        fresh = alignment.Aligner(*paths) if i == 0 else fresh
        fresh.forget()
        assert seen(aligner, numbers) == seen(fresh, fresh.documents(texts[i: i + 4]))
        sizes.append(len(aligner.texts))
    assert max(sizes) <= 60 + 2 * 4 * 15 and b" the" in aligner.known
    aligner.documents([])
    assert len(aligner.texts) == aligner.kept == aligner.ends.n == aligner.uses.n and not any("x" * 9 in p.decode() for p in aligner.known)
    assert len(aligner.texts) <= 60 + 4 * 15
