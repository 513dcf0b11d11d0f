"""Cross-tokenizer alignment through sparse incidence products.

Two tokenizers cut one text (a space and the text) into tokens A and B.  Each
side is a token-by-byte incidence matrix in compressed rows (``Csr``), and a
product of two of them by Gustavson's row method gives links:

* ``A · Bᵀ`` over bytes: overlapping tokens, the value counts shared bytes;
* the same over last bytes only: tokens that end together;
* over groups (the stretches between offsets where both sides end a token):
  tokens of one group.

Texts are cut in chunks before a space that follows a character which is no
white space.  Neither tokenizer has a token across such a place (for B this is
checked against its pieces when it is loaded), so a chunk's tokens and links do
not depend on its text, and each distinct chunk (compared as bytes) is
tokenized and multiplied once per worker, as long as it remembers the chunk
(``REMEMBERED``).  Texts with white space outside ASCII
or with the special token's string are one chunk and go to the tokenizers whole.

Corpus-wide counts: documents go in blocks of at most ``BLOCK_BYTES`` of text
(or one document) with a dictionary of the pairs that the block links, so the
shuffles carry distinct pairs of a block, not links.

Defined cases: null and empty texts, and texts whose tokens of one side do not
join to a space and the text, have no tokens: zeros and an empty digest.  Very
long words are tokenized each time instead of remembered.  Repeated rows count
each.  A null doc_id is kept.  Further columns are not read.  An empty table
gives an empty result.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Callable
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txrisk.llm import tokens as K
from txrisk.llm.common import stored

#: Text bytes of one block of documents (a longer document is one block).
BLOCK_BYTES = K.STEP_BYTES
#: Chunks a worker remembers (beyond it those used most stay, half as many at
#: most), and the longest of them in bytes.
REMEMBERED = 200_000
REMEMBERED_BYTES = 100
#: Chunks that are tokenized and multiplied at once.
LEARN_CHUNKS = 1024
#: A block is a row of a megabyte or so: pages and row groups end after a few.
SMALL_PAGES = {"parquet.page.size.row.check.min": "1", "parquet.block.size.row.check.min": "1", "parquet.block.size": str(16 << 20)}

#: A chunk: white space and what follows it up to a space after another
#: character; white space that ends the text belongs to its last chunk.
CHUNK = re.compile(rb"[ \t-\r]*[^ \t-\r]+(?:[\t-\r][ \t-\r]*[^ \t-\r]+)*(?:[ \t-\r]+\Z)?|[ \t-\r]+")
_ODD = re.compile(rb"\xc2[\xa0\x85]|\xe1\x9a\x80|\xe1\xa0\x8e|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|[\x1c-\x1f]|<\|endoftext\|>")

#: FIXED VALUE: pre-token pattern of the byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


class Csr(NamedTuple):
    """Sparse matrix in compressed rows: row i holds ``column[first[i]:first[i+1]]``."""

    first: np.ndarray
    column: np.ndarray
    value: np.ndarray
    columns: int

    def transposed(self) -> Csr:
        order = np.argsort(self.column, kind="stable")
        rows = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        first = np.concatenate(([0], np.cumsum(np.bincount(self.column, minlength=self.columns))))
        return Csr(first, rows[order], self.value[order], len(self.first) - 1)

    def product(self, other: Csr) -> Csr:
        """Gustavson: row i of the result adds the rows of ``other`` that row i
        of this matrix names, here for all rows at once."""
        count = np.diff(other.first)[self.column]
        row = np.repeat(np.repeat(np.arange(len(self.first) - 1), np.diff(self.first)), count)
        at = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count) + np.repeat(other.first[self.column], count)
        key = row * max(other.columns, 1) + other.column[at]
        cell, place = np.unique(key, return_inverse=True)
        value = np.bincount(place, weights=np.repeat(self.value, count) * other.value[at], minlength=len(cell)).astype(np.int64)
        first = np.searchsorted(cell, np.arange(len(self.first)) * max(other.columns, 1))
        return Csr(first, cell % max(other.columns, 1), value, other.columns)

    def pairs(self) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first)), self.column


def incidence(ends: np.ndarray, size: int) -> Csr:
    """Token-by-byte matrix of tokens that end at the given offsets."""
    return Csr(np.concatenate(([0], ends)), np.arange(size), np.ones(size, np.int64), size)


def marks(at: np.ndarray, columns: int) -> Csr:
    """Matrix with a one per row, in the given column."""
    return Csr(np.arange(len(at) + 1), at, np.ones(len(at), np.int64), columns)


def overlaps(ends_a: np.ndarray, ends_b: np.ndarray) -> Csr:
    """A · Bᵀ over bytes: shared bytes of two cuts of the same bytes."""
    size = int(ends_a[-1]) if len(ends_a) else 0
    return incidence(ends_a, size).product(incidence(ends_b, size).transposed())


def together(ends_a: np.ndarray, ends_b: np.ndarray) -> Csr:
    """The same over last bytes only: tokens that end together."""
    size = int(ends_a[-1]) if len(ends_a) else 0
    return marks(ends_a - 1, size).product(marks(ends_b - 1, size).transposed())


def groups(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ends of the groups, and the group of each A and B token."""
    both = np.intersect1d(ends_a, ends_b, assume_unique=True)
    return both, np.searchsorted(both, ends_a), np.searchsorted(both, ends_b)


def grouped(ends_a: np.ndarray, ends_b: np.ndarray) -> Csr:
    """Group incidence: tokens of one group."""
    both, group_a, group_b = groups(ends_a, ends_b)
    return marks(group_a, len(both)).product(marks(group_b, len(both)).transposed())


KINDS = {"overlap": overlaps, "together": together, "grouped": grouped}


class Grown:
    """Numbers in an array that doubles as it fills."""

    def __init__(self) -> None:
        self.n, self.at = 0, np.zeros(1 << 12, np.int64)

    def extend(self, values: np.ndarray) -> None:
        while self.n + len(values) > len(self.at):
            self.at = np.concatenate([self.at, np.zeros(len(self.at), np.int64)])
        self.at[self.n: self.n + len(values)] = values
        self.n += len(values)


def default_tokenizers() -> tuple[str, str, str]:
    """Paths of A, of A's vocabulary as ranks, and of B."""
    import public_tokenizers
    return tuple(public_tokenizers.path(x) for x in ("byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"))


@functools.lru_cache(maxsize=2)
def aligner_of(paths: tuple[str, str, str]) -> Aligner:
    """One aligner for all tasks of a worker, so that it learns a chunk once."""
    return Aligner(*paths)


def _join(parts: list[bytes], ids: list[list[int]], of: Callable[[int], bytes], length: np.ndarray) -> bool:
    """Do the tokens of every part join to it?  (All bytes at once, and each part's length.)"""
    flat = list(chain.from_iterable(ids))
    ends = np.concatenate(([0], np.cumsum(length[np.array(flat, np.int64)])))[np.cumsum([*map(len, ids)])]
    return np.array_equal(ends, np.cumsum([*map(len, parts)])) and b"".join(map(of, flat)) == b"".join(parts)


class Aligner:
    """Chunks of texts in both tokenizers."""

    def __init__(self, a: str, ranks: str, b: str) -> None:
        import base64

        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer
        self.whole_a = Tokenizer.from_file(a)
        self.whole_a.encode_special_tokens = True
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(t): int(i) for t, i in map(bytes.split, lines)}
        self.bytes_a = {i: t for t, i in table.items()}
        self.encode_a = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
        self.bytes_a = [b""] * (max(table.values()) + 2)
        for token, i in table.items():
            self.bytes_a[i] = token
        self.b = sentencepiece.SentencePieceProcessor(model_file=b)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        self.length_a, self.length_b = (np.array([len(x) for x in y]) for y in (self.bytes_a, self.bytes_b))
        #: each id with each mark that follows it in a digest's text
        self.names = np.array([*(f"{i}{mark}" for i in range(len(self.bytes_a)) for mark in ",|"),
                               *(f"{i}{mark}" for i in range(len(self.bytes_b)) for mark in (",", ";", ""))], object)
        #: no piece goes on with a space after another character
        self.separable = not any(re.search("[^▁]▁", p) for p in pieces)
        self.forget()

    def forget(self) -> None:
        """Chunk k has the sizes ``sizes[:, k]`` (tokens A, B, groups, links),
        its groups as text, and the linked pairs up to ``ends[k]``."""
        self.known: dict[bytes, int] = {}
        self.kept = 0                  # chunks that are remembered; those after them serve one call
        self.texts: list[str] = []
        self.sizes = [Grown() for _ in range(4)]
        self.ends, self.pairs, self.uses = Grown(), Grown(), Grown()

    def drop(self) -> None:
        """Forgets the chunks that only the last call needed."""
        del self.texts[self.kept:]
        for grown in (*self.sizes, self.ends, self.uses):
            grown.n = self.kept
        self.pairs.n = int(self.ends.at[self.kept - 1]) if self.kept else 0

    def thin(self) -> None:
        """Keeps the chunks that were used again since the last time, the most
        used first, up to half of what is remembered."""
        self.drop()
        known, texts, sizes, ends, pairs, uses = self.known, self.texts, self.sizes, self.ends, self.pairs, self.uses
        used = uses.at[:self.kept]
        keep = np.flatnonzero(used > 1)
        if len(keep) > REMEMBERED // 2:
            keep = np.sort(keep[np.argsort(-used[keep], kind="stable")[: REMEMBERED // 2]])
        place = np.full(self.kept + 1, -1)
        place[keep] = np.arange(len(keep))
        place = place.tolist()
        self.forget()
        self.known = {p: place[i] for p, i in known.items() if place[i] >= 0}
        self.texts, self.kept = [texts[i] for i in keep.tolist()], len(keep)
        for grown, old in zip((*self.sizes, self.uses), (*sizes, uses), strict=True):
            grown.extend(old.at[keep])
        self.uses.at[:self.kept] //= 2
        count = self.sizes[3].at[:self.kept]
        upto = np.cumsum(count)
        self.ends.extend(upto)
        self.pairs.extend(pairs.at[np.arange(int(count.sum())) + np.repeat(ends.at[keep] - upto, count)])

    def tokens(self, parts: list[bytes], whole: bool = False) -> list[tuple[list[int], list[int]] | None]:
        """Ids of each part (bytes that begin with a space); None where the
        tokens of a side do not join to it."""
        texts = [p.decode() for p in parts]
        a = [self.whole_a.encode(t, add_special_tokens=False).ids for t in texts] if whole else list(map(self.encode_a, texts))
        b = self.b.encode([t[1:] for t in texts], num_threads=1)
        of_a, of_b = self.bytes_a.__getitem__, self.bytes_b.__getitem__
        if all(_join(parts, ids, of, length) for ids, of, length in ((a, of_a, self.length_a), (b, of_b, self.length_b))):
            return list(zip(a, b, strict=True))
        return [(x, y) if b"".join(map(of_a, x)) == p == b"".join(map(of_b, y)) else None for p, x, y in zip(parts, a, b, strict=True)]

    def learn(self, tokens: list[tuple[list[int], list[int]]]) -> None:
        """Adds chunks of these tokens: one block-diagonal product for all."""
        if not tokens:
            return
        ids_a, ids_b = (np.array(list(chain.from_iterable(pair[side] for pair in tokens)), np.int64) for side in (0, 1))
        n_a, n_b = (np.array([len(pair[side]) for pair in tokens]) for side in (0, 1))
        ends_a, ends_b = np.cumsum(self.length_a[ids_a]), np.cumsum(self.length_b[ids_b])
        i, j = together(ends_a, ends_b).pairs()
        both, group_a, group_b = groups(ends_a, ends_b)
        last = np.cumsum(n_a)
        cuts = np.concatenate(([0], np.searchsorted(both, ends_a[last - 1], "right")))
        # a token's name with the mark that follows it: a comma within its side of
        # a group, a bar after A, a semicolon after B, nothing after a chunk's last group
        end_a, end_b = np.diff(group_a, append=-1) != 0, np.diff(group_b, append=-1) != 0
        mark_b = end_b.astype(np.int64)
        mark_b[np.cumsum(n_b) - 1] = 2
        order = np.argsort(np.concatenate([2 * group_a, 2 * group_b + 1]), kind="stable")
        names = self.names[np.concatenate([2 * ids_a + end_a, len(self.bytes_a) * 2 + 3 * ids_b + mark_b])[order]].tolist()
        upto = [0, *np.cumsum(n_a + n_b).tolist()]
        self.texts += ["".join(names[p:q]) for p, q in zip(upto, upto[1:], strict=False)]
        links = np.searchsorted(i, last)
        for grown, values in zip(self.sizes, (n_a, n_b, np.diff(cuts), np.diff(links, prepend=0)), strict=True):
            grown.extend(values)
        self.ends.extend(self.pairs.n + links)
        self.uses.extend(np.zeros(len(tokens), np.int64))
        self.pairs.extend(ids_a[i] << 32 | ids_b[j])

    def documents(self, texts: list[bytes]) -> list[list[int]]:
        """Numbers of the chunks of each text, good until the next call; none
        for no tokens."""
        self.drop()
        if len(self.known) > REMEMBERED:
            self.thin()
        known, alone = self.known, []
        parts = [None if not t or not self.separable or _ODD.search(t) else CHUNK.findall(b" " + t) for t in texts]
        new = [p for p in dict.fromkeys(chain.from_iterable(some for some in parts if some)) if p not in known]
        long = [p for p in new if len(p) > REMEMBERED_BYTES]
        self._know([p for p in new if len(p) <= REMEMBERED_BYTES])
        self.kept = len(self.texts)
        self._know(long)
        out: list[list[int]] = []
        for d, some in enumerate(parts):
            numbers = list(map(known.__getitem__, some)) if some else []
            if texts[d] and (not numbers or -1 in numbers):
                alone.append(d)
                numbers = []
            out.append(numbers)
        for p in long:
            del known[p]
        for d in alone:
            one = self.tokens([b" " + texts[d]], whole=True)[0]
            if one is not None:
                out[d] = [len(self.texts)]
                self.learn([one])
        used = np.fromiter(chain.from_iterable(out), np.int64)
        self.uses.at[:self.kept] += np.bincount(used[used < self.kept], minlength=self.kept)
        return out

    def _know(self, parts: list[bytes]) -> None:
        """Tokenizes and adds chunks, some at a time; -1: cannot stand alone."""
        for at in range(0, len(parts), LEARN_CHUNKS):
            some = parts[at: at + LEARN_CHUNKS]
            found, first = self.tokens(some), len(self.texts)
            self.learn([t for t in found if t is not None])
            for p, t in zip(some, found, strict=True):
                self.known[p] = first if t is not None else -1
                first += t is not None


def _blocks(docs: DataFrame, paths: tuple[str, str, str]) -> DataFrame:
    """Documents in blocks: their columns of the digest, and the block's
    dictionary of linked pairs with each document's links as places in it."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = (f"array<struct<doc_id:{kind},n_a:bigint,n_b:bigint,n_groups:bigint,n_links:bigint,groups_sha256:string>>")

    def run(batches):
        aligner, seq = aligner_of(paths), TaskContext.get().partitionId() << 32
        for batch in batches:
            data, offsets = K.column_bytes(batch.column(1))
            for lo, hi in K.steps(offsets, BLOCK_BYTES):
                chunks = aligner.documents([data[offsets[d]: offsets[d + 1]].tobytes() for d in range(lo, hi)])
                flat = np.fromiter(chain.from_iterable(chunks), np.int64)
                cuts = np.cumsum([0, *map(len, chunks)])
                sums = [np.diff(np.concatenate(([0], np.cumsum(g.at[flat])))[cuts]) for g in aligner.sizes]
                count = aligner.sizes[3].at[flat]
                at = np.arange(int(count.sum())) + np.repeat(aligner.ends.at[flat] - np.cumsum(count), count)
                pairs, every = np.unique(aligner.pairs.at[at], return_inverse=True)
                sizes = np.concatenate(([0], np.cumsum(sums[3])))
                text = aligner.texts.__getitem__
                hashes = [hashlib.sha256(";".join(map(text, some)).encode()).hexdigest() if some else "" for some in chunks]
                struct = pa.StructArray.from_arrays(
                    [batch.column(0).slice(lo, hi - lo), *map(pa.array, sums), pa.array(hashes, pa.string())],
                    ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256"])
                used = np.bincount(every, minlength=len(pairs)).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([seq]), pa.ListArray.from_arrays(pa.array([0, hi - lo], pa.int32()), struct),
                     pa.array([sizes.astype("<i8").tobytes()], pa.binary()), pa.array([every.astype("<i4").tobytes()], pa.binary()),
                     pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(pairs)),
                     pa.ListArray.from_arrays(pa.array([0, len(pairs)], pa.int32()), pa.array(used))],
                    ["block", "docs", "sizes", "links", "pairs", "used"])
                seq += 1
    return docs.select("doc_id", "text").mapInArrow(
        run, f"block long, docs {rows}, sizes binary, links binary, pairs array<long>, used array<long>")


def digest(docs: DataFrame, tokenizers: tuple[str, str, str] | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    blocks = stored(_blocks(docs, tokenizers or default_tokenizers()), **SMALL_PAGES)
    entries = blocks.select("block", F.posexplode(F.arrays_zip("pairs", "used")).alias("at", "e")) \
        .select("block", "at", F.col("e.pairs").alias("pair"), F.col("e.used").alias("used"))
    counts = entries.groupBy("pair").agg(F.sum("used").alias("count")).withColumn("b", F.col("pair").bitwiseAND(0xFFFFFFFF))
    best = counts.groupBy("b").agg(F.max("count").alias("most"))
    judged = counts.join(best, "b").select("pair", "count", (F.col("count") == F.col("most")).alias("best"))
    per_block = entries.join(judged, "pair").groupBy("block").agg(F.sort_array(F.collect_list(F.struct("at", "count", "best"))).alias("known"))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(batches):
        for batch in batches:
            for i in range(len(batch)):
                row = {c: batch.column(c)[i] for c in batch.schema.names}
                docs_of = row["docs"].values
                sizes = np.frombuffer(row["sizes"].as_py(), "<i8")
                every = np.frombuffer(row["links"].as_py(), "<i4")
                count, best_of = np.zeros(0, np.int64), np.zeros(0, bool)
                if row["known"].is_valid:
                    known = row["known"].values
                    count = known.field("count").to_numpy(zero_copy_only=False)
                    best_of = known.field("best").to_numpy(zero_copy_only=False)
                sums = np.concatenate(([0], np.cumsum(count[every] if len(every) else np.zeros(0, np.int64))))
                bests = np.concatenate(([0], np.cumsum(best_of[every] if len(every) else np.zeros(0, np.int64))))
                yield pa.RecordBatch.from_arrays(
                    [*(docs_of.field(c) for c in names[:5]), pa.array(np.diff(bests[sizes]).astype(np.int64)),
                     pa.array(np.diff(sums[sizes]).astype(np.int64)), docs_of.field("groups_sha256")], names)
    return blocks.select("block", "docs", "sizes", "links").join(per_block, "block", "left").mapInArrow(
        run, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in names[1:7]) + ", groups_sha256 string")


def links(docs: DataFrame, kind: str = "overlap", tokenizers: tuple[str, str, str] | None = None) -> DataFrame:
    """(doc_id, a_at, b_at, a_id, b_id, value): every link of each document;
    ``kind``: overlap (value: shared bytes), together or grouped (value: 1)."""
    paths, id_type = tokenizers or default_tokenizers(), docs.schema["doc_id"].dataType.simpleString()
    names = ["doc_id", "a_at", "b_at", "a_id", "b_id", "value"]

    def run(batches):
        aligner = aligner_of(paths)
        for batch in batches:
            data, offsets = K.column_bytes(batch.column(1))
            for d in range(len(batch)):
                raw = data[offsets[d]: offsets[d + 1]].tobytes()
                found = aligner.tokens([b" " + raw], whole=True)[0] if raw else None
                if found is None:
                    continue
                a, b = (np.array(x, np.int64) for x in found)
                linked = KINDS[kind](np.cumsum(aligner.length_a[a]), np.cumsum(aligner.length_b[b]))
                i, j = linked.pairs()
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(pa.array(np.full(len(i), d))), pa.array(i), pa.array(j), pa.array(a[i]), pa.array(b[j]),
                     pa.array(linked.value)], names)
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, " + ", ".join(f"{c} long" for c in names[1:]))
