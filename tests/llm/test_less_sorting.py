"""Steps of op6 and op11 that sorted or computed more than they need."""

import numpy as np

from txrisk.llm import alignment, repeats, suffix_dedup, tokens


def _repeats(strings, depth):
    """(previous, following) of every position, by the bytes themselves."""
    places = {}
    for group, s in strings:
        for i in range(len(s) - depth + 1):
            places.setdefault((group, s[i: i + depth]), []).append((len(places), i))
    seen, previous, following = {}, [], []
    for group, s in strings:
        for i in range(len(s)):
            part = (group, s[i: i + depth])
            whole = i + depth <= len(s)
            count = seen.get(part, 0)
            previous.append(whole and count > 0)
            following.append(whole and count + 1 < len(places[part]))
            if whole:
                seen[part] = count + 1
    return previous, following


def test_block_factors_against_the_bytes():
    rng = np.random.default_rng(3)
    for _ in range(200):
        depth, letters = int(rng.integers(1, 30)), int(rng.integers(1, 4))
        strings = sorted((int(g), rng.integers(97, 97 + letters, int(rng.integers(0, 60))).astype(np.uint8).tobytes())
                         for g in rng.integers(0, 3, int(rng.integers(1, 10))))
        bounds = np.concatenate(([0], np.cumsum([len(s) for _, s in strings])))
        text = np.frombuffer(b"".join(s for _, s in strings), np.uint8)
        found = suffix_dedup._block_factors(text, bounds, np.array([g for g, _ in strings]), depth)
        assert [x.tolist() for x in found] == list(_repeats(strings, depth))


def test_positions_alone_in_their_rank_are_not_sorted_again(monkeypatch):
    sizes = []
    order = suffix_dedup._order
    monkeypatch.setattr(suffix_dedup, "_order", lambda a, b: sizes.append(len(a)) or order(a, b))
    text = np.random.default_rng(4).integers(0, 256, 20_000).astype(np.uint8)
    text[10_000: 10_300] = text[:300]
    suffix_dedup.full_factors(text, 200)
    assert 0 < max(sizes) <= 2 * 300


def test_wide_numbers_are_ordered_too():
    first, second = np.array([1 << 38, 0, 1 << 38]), np.array([5, 1 << 22, 4])
    assert suffix_dedup._order(first, second).tolist() == [1, 2, 0]


def test_anchors_are_those_of_the_places(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join(words[:200])), (3, None), (None, " ".join(words[100:])), (2, "x" * 500), (2, "x" * 500)]
    docs = repeats.identified(spark.createDataFrame(rows, "doc_id long, text string"))
    places = repeats.places(docs, suffix_dedup.byte_symbols, 200, 48).groupBy("anchor").count()
    alone = repeats.anchors(docs, suffix_dedup.byte_symbols, 200, 48).groupBy("anchor").sum("times")
    assert sorted(map(tuple, alone.collect())) == sorted(map(tuple, places.collect()))


def test_anchors_without_contents():
    data = np.frombuffer(b"the quick brown fox " * 40, np.uint8)
    bounds = np.array([0, len(data)])
    runs = tokens.runs(tokens.BYTE_VALUE[data], bounds, 200, 48)
    alone = tokens.runs(tokens.BYTE_VALUE[data], bounds, 200, 48, contents=False)
    assert "content" not in alone and all(np.array_equal(runs[c], alone[c]) for c in alone)
    assert len(tokens.runs(tokens.BYTE_VALUE[data[:9]], np.array([0, 9]), 200, 48, contents=False)["anchor"]) == 0


def test_links_need_no_product_over_all_bytes(monkeypatch):
    """Of tokens that end together only, and a digest's text without a join per group."""
    monkeypatch.setattr(alignment, "overlaps", None)
    aligner = alignment.Aligner(*alignment.default_tokenizers())
    texts = ["lorem unhappinesses, 12345!", "a", "naïve 東京 café", "  two  spaces ", "\n\ttab"]
    chunks = aligner.documents([t.encode() for t in texts])
    for text, numbers in zip(texts, chunks, strict=True):
        a, b = aligner.tokens([b" " + text.encode()], whole=True)[0]
        ends_a, ends_b = np.cumsum(aligner.length_a[a]).tolist(), np.cumsum(aligner.length_b[b]).tolist()
        groups, at_a, at_b = [], 0, 0
        for end in sorted({*ends_a} & {*ends_b}):
            to_a, to_b = ends_a.index(end) + 1, ends_b.index(end) + 1
            groups.append(",".join(map(str, a[at_a:to_a])) + "|" + ",".join(map(str, b[at_b:to_b])))
            at_a, at_b = to_a, to_b
        assert ";".join(aligner.texts[c] for c in numbers) == ";".join(groups)
        assert sum(int(aligner.sizes[3].at[c]) for c in numbers) == len({*ends_a} & {*ends_b})


def test_tokens_that_do_not_join_are_found_among_others():
    aligner = alignment.Aligner(*alignment.default_tokenizers())
    parts = [b" one", " ▁x".encode(), b" two", " é".encode(), b" a\x00b"]
    each = [aligner.tokens([p])[0] for p in parts]
    assert aligner.tokens(parts) == each and each[0] is not None
    # equal bytes in all, but other lengths of the parts
    assert not alignment._join([b" o", b"ne"], [[0], []], [b" one"].__getitem__, np.array([4]))
    assert alignment._join([b" one", b""], [[0], []], [b" one"].__getitem__, np.array([4]))
