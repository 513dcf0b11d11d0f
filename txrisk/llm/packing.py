"""Best-fit packing of tokenized documents by minimum bin slack.

Tokens: chunks of a text are told apart in array form (by hash, then byte by
byte), each distinct chunk is tokenized once per worker (from the ranks of the tokenizer's
vocabulary, which give the tokenizer's ids), and the ids of a document are
gathered from its chunks.  Chunks begin and end where pre-tokens of the
byte-level BPE do: a word with the one space before it, and white space, of
which the last character before a word stands apart (the BPE's ``\\s+(?!\\S)``
gives it back).  So this gives the tokenizer's own ids; texts with white space
outside ASCII or with the special token's string go to the tokenizer whole.

Packing: pieces of equal length are interchangeable, so the bins are planned
on the histogram of lengths (at most ``SIZE`` numbers, whatever the corpus).
Per bin the longest waiting length is set, and a bitset subset-sum over the
available lengths finds the fullest feasible combination; it is taken out as
often as its lengths allow, so there are at most as many patterns as
lengths.  Spark then deals ranks to pieces per length (a two-level rank, so
one frequent length is no single task) and looks up each rank's pattern.

Null and empty texts give one piece (the closing id 0).  Repeated rows are
documents of their own.  An empty table gives an empty result.  A null
doc_id is kept.  Further columns are not read.
"""

from __future__ import annotations

import base64
import functools
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from txrisk.llm import tokens as K
from txrisk.llm.common import cut

SIZE = 2048
END = 0
#: Ranks of one length are dealt in so many independent runs.
RUNS = 64
#: Distinct chunks a worker remembers.
REMEMBERED = 700_000

_ODD = re.compile(rb"\xc2[\xa0\x85]|\xe1\x9a\x80|\xe2\x80[\x80-\x8a\xa8\xa9\xaf]|\xe2\x81\x9f|\xe3\x80\x80|[\x1c-\x1f]|<\|endoftext\|>")


def default_tokenizer() -> tuple[str, str]:
    """Paths of the tokenizer and of the same vocabulary as ranks."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


#: FIXED VALUE: pre-token pattern of the byte-level BPE.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


@functools.lru_cache(maxsize=2)
def encoder_of(tokenizer: str, ranks: str | None) -> Encoder:
    """One encoder for all tasks of a worker, so that it learns a chunk once."""
    return Encoder(tokenizer, ranks)


class Encoder:
    """Ids of whole batches of texts; see the module's text."""

    hashes = staticmethod(K.span_hashes)

    def __init__(self, tokenizer: str, ranks: str | None = None) -> None:
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(tokenizer)
        self.chunk_ids = lambda chunk: self.tokenizer.encode(chunk, add_special_tokens=False).ids
        if ranks:  # the same ids for ordinary text, with far less work for a short string
            import tiktoken
            with open(ranks, "rb") as lines:
                table = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
            self.chunk_ids = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=table, special_tokens={}).encode_ordinary
        self._forget()

    def _forget(self) -> None:
        self.number: dict[bytes, int] = {}
        self.known, self.first = 0, np.zeros(REMEMBERED + 1, np.int64)  # chunk k has ids first[k] to first[k + 1]
        self.ids = np.zeros(1 << 16, np.uint32)

    def whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def _learn(self, keys: list[bytes]) -> None:
        a, every, ends, encode = int(self.first[self.known]), [], [], self.chunk_ids
        for key in keys:
            every += encode(key.decode())
            self.number[key] = self.known + len(ends)
            ends.append(a + len(every))
        if self.known + len(ends) >= len(self.first):  # one step alone may have more chunks
            self.first = np.concatenate([self.first, np.zeros(self.known + len(ends), np.int64)])
        self.first[self.known + 1: self.known + 1 + len(ends)] = ends
        self.known += len(ends)
        if a + len(every) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.zeros(max(len(self.ids), len(every)), np.uint32)])
        self.ids[a: a + len(every)] = every

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all documents in a row, and their offsets (no end ids)."""
        if not len(data):
            return np.zeros(0, np.uint32), np.zeros(len(offsets), np.int64)
        white = K.WHITE[data]
        begins = np.zeros(len(data), bool)
        begins[offsets[:-1][offsets[:-1] < len(data)]] = True
        begins[1:] |= white[:-1] & ~white[1:]          # a word after white space
        begins[1:] |= ~white[:-1] & white[1:]          # white space after a word
        last = white[:-1] & ~white[1:]                 # the last white space before a word is no part of its run
        edges = offsets[1:-1]
        last[edges[(edges > 0) & (edges < len(data))] - 1] = False
        begins[:-1] |= last
        begins[1:][last & (data[:-1] == 0x20)] = False  # one space before a word belongs to it
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(data))
        hashes = self.hashes(data, start, end)
        raw = data.tobytes()
        _, index, inverse = np.unique(hashes, return_index=True, return_inverse=True)
        if not K.same_spans(data, start, end, start[index][inverse], end[index][inverse]):  # one hash, different bytes
            seen: dict[bytes, int] = {}
            inverse = np.array([seen.setdefault(raw[a:b], len(seen)) for a, b in zip(start, end, strict=True)])
            _, index = np.unique(inverse, return_index=True)
        if len(self.number) + len(index) > REMEMBERED:
            self._forget()
        keys = [raw[a:b] for a, b in zip(start[index].tolist(), end[index].tolist(), strict=True)]
        self._learn([k for k in keys if k not in self.number])
        number = np.array([self.number[k] for k in keys])[inverse]
        first = self.first
        count = first[number + 1] - first[number]
        at = np.concatenate(([0], np.cumsum(count)))
        ids = self.ids[np.arange(int(at[-1])) + np.repeat(first[number] - at[:-1], count)]
        return ids, at[np.searchsorted(start, offsets)]


def _documents(encoder: Encoder, column: pa.Array) -> Iterator[np.ndarray]:
    """Ids of each text, with the closing id."""
    data, offsets = K.column_bytes(column)
    end = np.array([END], np.uint32)
    for i, j in K.steps(offsets):
        part, at = data[offsets[i]: offsets[j]], offsets[i: j + 1] - offsets[i]
        odd = {int(np.searchsorted(at, m.start(), "right")) - 1 for m in _ODD.finditer(part)}
        ids, first = encoder.encode(part, at)
        for d in range(j - i):
            if d in odd:
                yield np.append(encoder.whole(part[at[d]: at[d + 1]].tobytes().decode()), end)
            else:
                yield np.append(ids[first[d]: first[d + 1]], end)


def pieces(docs: DataFrame, tokenizer: tuple[str, str | None] | None = None, size: int = SIZE,
           with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids]): documents in ids, only
    those longer than ``size`` cut, their first piece the shorter one.
    ``tokenizer``: paths of a byte-level BPE and of its ranks (or None)."""
    paths = tokenizer or default_tokenizer()
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids

    def run(batches):
        encoder = encoder_of(*paths)
        for batch in batches:
            row, piece, start, length, crc, kept = [], [], [], [], [], []
            for r, ids in enumerate(_documents(encoder, batch.column(1))):
                head = (len(ids) - 1) % size + 1
                cuts = [0, *range(head, len(ids) + 1, size)]
                for p, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    row.append(r)
                    piece.append(p)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(ids[a:b].astype("<u4", copy=False)))
                    if with_ids:
                        kept.append(ids[a:b].astype(np.int64))
            columns = [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
                       pa.array(length, pa.int64()), pa.array(crc, pa.int64())]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int64())))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(columns, names)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def fullest(seed: int, counts: dict[int, int], size: int) -> list[int]:
    """Lengths, the seed among them, with the largest sum of at most ``size``.

    Bit s of ``reached`` says that the lengths so far can add up to s; the
    lengths are offered from the longest down, and as soon as the capacity
    itself is reached, the rest need not be offered.
    """
    room = size - seed
    reached, mask, trail = 1, (1 << (room + 1)) - 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        for _ in range(min(counts[length] - (length == seed), room // length)):
            more = (reached | reached << length) & mask
            if more == reached:
                break
            trail.append((length, reached))
            reached = more
        if reached >> room & 1:
            break
    total, chosen = reached.bit_length() - 1, [seed]
    for length, before in reversed(trail):
        if not before >> total & 1:
            chosen.append(length)
            total -= length
    return chosen


def plan(counts: dict[int, int], size: int = SIZE) -> list[tuple[list[int], int]]:
    """Patterns (lengths of one sequence) and how often each is used."""
    left, out = {k: v for k, v in counts.items() if v > 0}, []
    while left:
        chosen = fullest(max(left), left, size)
        need: dict[int, int] = {}
        for length in chosen:
            need[length] = need.get(length, 0) + 1
        times = min(left[k] // n for k, n in need.items())
        for k, n in need.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        out.append((chosen, times))
    return out


def _slots(counts: dict[int, int], size: int) -> dict[int, tuple[np.ndarray, ...]]:
    """Per length: first rank of each slot, the first sequence of its pattern
    and its offset in the sequence."""
    out: dict[int, list] = {}
    used: dict[int, int] = {}
    sequence = 0
    for chosen, times in plan(counts, size):
        at = 0
        for length in chosen:
            rank = used.get(length, 0)
            out.setdefault(length, []).append((rank, sequence, at))
            used[length] = rank + times
            at += length
        sequence += times
    return {k: tuple(np.array(x) for x in zip(*v, strict=True)) for k, v in out.items()}


def pack(cut_pieces: DataFrame, size: int = SIZE) -> DataFrame:
    """The pieces with ``sequence_id`` and ``offset``; needs a stable input."""
    order = [c for c in ("doc_id", "piece", "start", "ids_crc32") if c in cut_pieces.columns]
    rows = cut_pieces.withColumn("_run", F.pmod(F.xxhash64(*order), F.lit(RUNS)))
    per_run = rows.groupBy("length", "_run").agg(F.count("*").alias("_n"))
    before = per_run.withColumn("_before", F.sum("_n").over(
        Window.partitionBy("length").orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)))
    counts = {r["length"]: r["n"] for r in per_run.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    slots = _slots(counts, size)
    ranked = rows.withColumn("_rank", F.row_number().over(Window.partitionBy("length", "_run").orderBy(*order)) - 1) \
        .join(before.select("length", "_run", F.coalesce("_before", F.lit(0)).alias("_before")), ["length", "_run"]) \
        .select(*[F.col(c) for c in cut_pieces.columns], (F.col("_rank") + F.col("_before")).alias("_rank"))

    def place(batches):
        for batch in batches:
            length, rank = batch.column("length").to_numpy(), batch.column("_rank").to_numpy()
            sequence, offset = np.zeros(len(length), np.int64), np.zeros(len(length), np.int64)
            for value in np.unique(length):
                at = np.flatnonzero(length == value)
                first, start, place_in = slots[int(value)]
                k = np.searchsorted(first, rank[at], "right") - 1
                sequence[at], offset[at] = start[k] + rank[at] - first[k], place_in[k]
            kept = batch.columns[:-1]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequence), pa.array(offset)],
                                             [*batch.schema.names[:-1], "sequence_id", "offset"])
    schema = cut_pieces.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.mapInArrow(place, schema)


def digest(docs: DataFrame, tokenizer: tuple[str, str | None] | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    return pack(cut(pieces(docs, tokenizer)))
