"""Trie of rebuilt conversations from composable prefix fingerprints.

A conversation is rebuilt from the first turns of a base conversation (the
head) and its own turns after as many (the suffix).  No rebuilt text is made:
a sequence of turns has the fingerprint ``sum(code_i * B**(n-i)) mod 2**127-1``,
an element of a monoid with ``fp(x + y) = fp(x) * B**len(y) + fp(y)``, and the
fingerprint of every rebuilt prefix follows from the prefix products of the
stored conversations: ``fp(head + own[h:p]) = own_p + (head - own_h) * B**(p-h)``.

The turns are sorted by range over the cluster, so a conversation of any
length may span partitions; each partition folds its rows and one total a
partition (its last conversation) is folded on the driver and carried on.

A node of the trie is a group of equal (depth, fingerprint).  Its members are
verified: all must refer to last turns of one code, and where they refer to
several stored turns, the turns' role and text are fetched by reference and
compared; parents are then equal by the fingerprint's algebra and by induction.
A collision starts over with another seed.

Sums over subtrees need no walk.  The smallest member of a node is also the
smallest of those nodes below that it reaches, so it stands for a node from
some depth on (``first``), and every node of a subtree is counted at exactly
one member of the subtree's top.  All sums are one aggregate over the
(conversation, depth) rows.

Defined cases: rows without conv_id are left out.  Null role or text is empty.
Turns are ordered by turn (null first), then by the MD5 of role and text; rows
that repeat all of them are turns of their own.  Base ids follow SQL's ``%``,
which keeps the sign.  Further columns are not read.  An empty table gives no
node.  Very long texts only pass as their code; texts are read again where a
node's turns are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txrisk.llm.common import stored

P = (1 << 127) - 1
#: Longest head taken from a base.
MOST = 8
#: Conversation ids that one piece of an ends list holds.
ENDS_AT_ONCE = 4096
#: Seeds that are tried before a collision is an error.
SEEDS = 4

NODE = ["depth", "hi", "lo"]
_ZERO = bytes(16)


def turn_code(role: Column, text: Column, seed: int) -> Column:
    """128-bit code of a turn; the length keeps role and text apart."""
    return F.unhex(F.md5(F.concat(F.lit("" if not seed else f"{seed}/"), F.octet_length(role).cast("string"), F.lit(":"), role, text)))


def default_base(conv_id: Column) -> Column:
    return conv_id - conv_id % 5


def default_head(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % 9


class Fold:
    """Arithmetic of the fingerprint for one seed."""

    def __init__(self, seed: int) -> None:
        self.base = int.from_bytes(hashlib.sha256(f"prefix {seed}".encode()).digest(), "big") % P
        self.inverse = pow(self.base, -1, P)
        self.small = [1]
        for _ in range(64):
            self.small.append(self.small[-1] * self.base % P)

    def power(self, n: int) -> int:
        return self.small[n] if n < len(self.small) else pow(self.base, n, P)

    def add(self, fp: int, code: bytes) -> int:
        return (fp * self.base + int.from_bytes(code, "big")) % P

    def parent(self, fp: int, code: int) -> int:
        return (fp - code) * self.inverse % P


def _long(value: int, part: int) -> int:
    """High (0) or low (1) half of a 128-bit number as a signed long."""
    return int.from_bytes(value.to_bytes(16, "big")[8 * part: 8 * part + 8], "big", signed=True)


def _whole(hi: int, lo: int) -> int:
    return (hi % (1 << 64)) << 64 | lo % (1 << 64)


def rows_of(conversations: DataFrame) -> DataFrame:
    return conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"))


def folded(rows: DataFrame, fold: Fold) -> DataFrame:
    """(conv_id, turn, code, size, pos, fp, upto): every turn with its place,
    the fingerprint and the bytes of its conversation up to it."""
    order = ["conv_id", F.asc_nulls_first("turn"), "code"]
    kind = rows.schema["turn"].dataType.simpleString()
    schema = f"conv_id long, turn {kind}, code binary, size long, pos long, fp binary, upto long"

    def local(batches):
        part, conv, pos, fp, upto = TaskContext.get().partitionId(), None, 0, 0, 0
        for batch in batches:
            places, fps, sums = [], [], []
            for c, code, size in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if c != conv:
                    conv, pos, fp, upto = c, 0, 0, 0
                pos, fp, upto = pos + 1, fold.add(fp, code), upto + size
                places.append(pos)
                fps.append(fp.to_bytes(16, "big"))
                sums.append(upto)
            if places:
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places), pa.array(fps, pa.binary()), pa.array(sums),
                                                  pa.array([part] * len(places), pa.int32())], [*names, "part"])
    names = ["conv_id", "turn", "code", "size", "pos", "fp", "upto"]
    mine = stored(rows.select("conv_id", "turn", "code", "size").repartitionByRange(*order).sortWithinPartitions(*order)
                  .mapInArrow(local, schema + ", part int"))
    # one row a partition: the conversation that may go on in the next one
    last = mine.groupBy("part").agg(F.max(F.struct("conv_id", "pos", "fp", "upto")).alias("last")).orderBy("part").collect()
    carry, state = {}, None
    for r in last:
        carry[r["part"]] = state
        conv, pos, fp, upto = r["last"]
        fp = int.from_bytes(fp, "big")
        if state and state[0] == conv:
            state = (conv, state[1] + pos, (state[2] * fold.power(pos) + fp) % P, state[3] + upto)
        else:
            state = (conv, pos, fp, upto)

    def carried(batches):
        for batch in batches:
            table = pa.Table.from_batches([batch])
            place, fps, sums = (table.column(c).to_pylist() for c in ("pos", "fp", "upto"))
            for i, (c, part) in enumerate(zip(table.column("conv_id").to_pylist(), table.column("part").to_pylist(), strict=True)):
                before = carry[part]
                if before and before[0] == c:
                    fps[i] = ((before[2] * fold.power(place[i]) + int.from_bytes(fps[i], "big")) % P).to_bytes(16, "big")
                    place[i], sums[i] = place[i] + before[1], sums[i] + before[3]
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(place, pa.int64()), pa.array(fps, pa.binary()),
                                              pa.array(sums, pa.int64())], names)
    return mine.mapInArrow(carried, schema)


def members(turns: DataFrame, fold: Fold, base: Callable[[Column], Column], head: Callable[[Column], Column]) -> DataFrame:
    """(conv_id, length, bytes, depth, hi, lo, chi, clo, size, upto, ref_conv,
    ref_turn): every prefix of every rebuilt conversation with the reference
    to its last stored turn."""
    entry = F.struct("pos", "turn", "code", "size", "fp", "upto")
    convs = stored(turns.groupBy("conv_id").agg(
        F.max("pos").alias("n"), F.max("upto").alias("all_bytes"),
        F.sort_array(F.collect_list(F.when(F.col("pos") <= MOST, entry))).alias("first")))
    none = F.lit(_ZERO)

    def at(entries: str, n: Column, field: str, empty: Column) -> Column:
        return F.when(n > 0, F.get(F.col(entries), (n - 1).cast("int"))[field]).otherwise(empty)

    h = F.least(head(F.col("c.conv_id")), F.lit(MOST))
    plan = convs.alias("c").join(convs.alias("b"), base(F.col("c.conv_id")) == F.col("b.conv_id"), "left").select(
        F.col("c.conv_id"), "c.n", "c.all_bytes", F.col("c.first").alias("own"), F.col("b.conv_id").alias("base"),
        F.coalesce(F.col("b.first"), F.array().cast(convs.schema["first"].dataType)).alias("theirs"), h.alias("h"))
    plan = plan.withColumn("taken", F.least("h", F.size("theirs"))).withColumn("skipped", F.least("h", "n")).select(
        "conv_id", "base", "h", "taken", "theirs", (F.col("taken") + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("length"),
        at("theirs", F.col("taken"), "fp", none).alias("head_fp"), at("own", F.col("skipped"), "fp", none).alias("own_fp"),
        at("theirs", F.col("taken"), "upto", F.lit(0)).alias("head_bytes"), at("own", F.col("skipped"), "upto", F.lit(0)).alias("own_bytes"),
        "all_bytes").withColumn("bytes", F.col("head_bytes") + F.col("all_bytes") - F.col("own_bytes"))
    plan = stored(plan)
    common = ["conv_id", "length", "bytes"]
    heads = plan.select(*common, "base", F.explode(F.slice("theirs", F.lit(1), F.col("taken"))).alias("e")).select(
        *common, F.col("e.pos").alias("depth"), F.col("e.fp").alias("fp"), none.alias("head_fp"), none.alias("own_fp"), F.lit(0).cast("long").alias("after"),
        F.col("e.code").alias("code"), F.col("e.size").alias("size"), F.col("e.upto").alias("upto"), F.col("base").alias("ref_conv"),
        F.col("e.turn").alias("ref_turn"))
    after = F.col("pos") - F.col("h")
    tails = turns.join(plan.drop("theirs", "base"), "conv_id").where(after > 0).select(
        *common, (F.col("taken") + after).alias("depth"), "fp", "head_fp", "own_fp", after.alias("after"), "code", "size",
        (F.col("upto") - F.col("own_bytes") + F.col("head_bytes")).alias("upto"), F.col("conv_id").alias("ref_conv"),
        F.col("turn").alias("ref_turn"))
    roots = plan.select(*common, F.lit(0).cast("long").alias("depth"), none.alias("fp"), none.alias("head_fp"), none.alias("own_fp"),
                        F.lit(0).cast("long").alias("after"), none.alias("code"), F.lit(0).cast("long").alias("size"),
                        F.lit(0).cast("long").alias("upto"), F.lit(None).cast("long").alias("ref_conv"),
                        F.lit(None).cast(turns.schema["turn"].dataType).alias("ref_turn"))
    every = heads.unionByName(tails).unionByName(roots)
    kept = [*common, "depth", "size", "upto", "ref_conv", "ref_turn"]
    types = {f.name: f.dataType.simpleString() for f in every.schema}
    schema = ", ".join(f"{c} {types[c]}" for c in kept) + ", hi long, lo long, chi long, clo long"

    def compose(batches):
        for batch in batches:
            fp, head_fp, own_fp, after, code = (batch.column(c).to_pylist() for c in ("fp", "head_fp", "own_fp", "after", "code"))
            fps = []
            for f, a, b, n in zip(fp, head_fp, own_fp, after, strict=True):
                value = int.from_bytes(f, "big")
                if n and a != b:
                    value = (value + (int.from_bytes(a, "big") - int.from_bytes(b, "big")) * fold.power(n)) % P
                fps.append(value)
            codes = [int.from_bytes(c, "big") for c in code]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), *(pa.array([_long(v, k) for v in values], pa.int64())
                                                     for values in (fps, codes) for k in (0, 1))],
                [*kept, "hi", "lo", "chi", "clo"])
    return stored(every.mapInArrow(compose, schema))


def nodes_of(rows: DataFrame) -> DataFrame:
    """One row per (depth, fingerprint); ``several``: its members refer to
    different stored turns; ``torn``: to turns of different codes."""
    below = F.col("bytes") - F.col("upto") + F.col("size")
    differ = [F.min(c) != F.max(c) for c in ("ref_conv", "ref_turn")]
    codes = [F.min(c) != F.max(c) for c in ("chi", "clo")]
    return stored(rows.groupBy(*NODE).agg(
        F.min("conv_id").alias("conv_id"), F.count("*").alias("n_convs"), F.max("length").alias("reach"), F.max("size").alias("size"),
        F.min_by(below, "conv_id").alias("below"), F.max("chi").alias("chi"), F.max("clo").alias("clo"),
        F.coalesce(differ[0] | differ[1] | (F.count("ref_turn") != F.count("ref_conv")), F.lit(False)).alias("several"),
        (codes[0] | codes[1]).alias("torn")))


def collides(rows: DataFrame, nodes: DataFrame, texts: DataFrame) -> bool:
    """Some node holds turns that are not the same (see the module's text)."""
    if nodes.where("torn").limit(1).count():
        return True
    refs = rows.join(nodes.where("several").select(*NODE), NODE, "left_semi").select(*NODE, "ref_conv", "ref_turn", "chi", "clo").distinct()
    turns = texts.select("conv_id", "turn", "role", "text", *[
        F.conv(F.hex(F.substring("code", a, 8)), 16, -10).cast("long").alias(c) for a, c in ((1, "ci"), (9, "cl"))])
    found = refs.join(turns, (F.col("ref_conv") == F.col("conv_id")) & F.col("ref_turn").eqNullSafe(F.col("turn"))
                      & (F.col("chi") == F.col("ci")) & (F.col("clo") == F.col("cl")))
    pair = F.struct("role", "text")
    return found.groupBy(*NODE).agg(F.min(pair).alias("a"), F.max(pair).alias("z")).where(F.col("a") != F.col("z")).limit(1).count() > 0


def ends_of(rows: DataFrame) -> DataFrame:
    """(node, ends_sha256): digest of the ids that end at a node, ascending.

    The ids are sorted by range, joined to pieces in parallel, and only the
    pieces of a node meet in one stream, which is hashed piece by piece."""
    order = [*NODE, "conv_id"]

    def pieces(batches):
        part, seq, key, ids = TaskContext.get().partitionId(), 0, None, []
        out = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != key or len(ids) == ENDS_AT_ONCE:
                    if ids:
                        out.append((*key, part, seq, ",".join(map(str, ids))))
                        seq += 1
                    key, ids = row[:3], []
                ids.append(row[3])
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(names, r, strict=True)) for r in out], schema=types)
                out = []
        if ids:
            yield pa.RecordBatch.from_pylist([dict(zip(names, (*key, part, seq, ",".join(map(str, ids))), strict=True))], schema=types)
    names = [*NODE, "part", "seq", "ids"]
    types = pa.schema([(c, pa.int64()) for c in names[:5]] + [("ids", pa.string())])
    joined = rows.where(F.col("depth") == F.col("length")).select(*order).repartitionByRange(*order).sortWithinPartitions(*order) \
        .mapInArrow(pieces, "depth long, hi long, lo long, part long, seq long, ids string")

    def digests(batches):
        key, state = None, None
        for batch in batches:
            out = []
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if row[:3] != key:
                    if state:
                        out.append((*key, state.hexdigest()))
                    key, state = row[:3], hashlib.sha256(row[5].encode())
                else:
                    state.update(b"," + row[5].encode())
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip([*NODE, "ends_sha256"], r, strict=True)) for r in out], schema=done)
        if state:
            yield pa.RecordBatch.from_pylist([dict(zip([*NODE, "ends_sha256"], (*key, state.hexdigest()), strict=True))], schema=done)
    done = pa.schema([(c, pa.int64()) for c in NODE] + [("ends_sha256", pa.string())])
    return joined.repartition(*NODE).sortWithinPartitions(*NODE, "part", "seq") \
        .mapInArrow(digests, "depth long, hi long, lo long, ends_sha256 string")


def with_parents(nodes: DataFrame, fold: Fold) -> DataFrame:
    """The nodes with ``parent_conv_id``."""
    kept = ["conv_id", *NODE, "n_convs"]

    def run(batches):
        for batch in batches:
            depth, hi, lo, chi, clo = (batch.column(c).to_pylist() for c in (*NODE, "chi", "clo"))
            up = [fold.parent(_whole(a, b), _whole(c, d)) if n else None for n, a, b, c, d in zip(depth, hi, lo, chi, clo, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in kept), pa.array([n - 1 if n else None for n in depth], pa.int64()),
                 *(pa.array([None if v is None else _long(v, k) for v in up], pa.int64()) for k in (0, 1))], [*kept, "pd", "ph", "pl"])
    children = nodes.mapInArrow(run, "conv_id long, depth long, hi long, lo long, n_convs long, pd long, ph long, pl long")
    parents = nodes.select(F.col("conv_id").alias("parent_conv_id"), *[F.col(c).alias(f"p_{c}") for c in NODE])
    return children.join(parents, (F.col("pd") == F.col("p_depth")) & (F.col("ph") == F.col("p_hi")) & (F.col("pl") == F.col("p_lo")), "left") \
        .select(*kept, "parent_conv_id")


def trie(conversations: DataFrame, base: Callable[[Column], Column] = default_base, head: Callable[[Column], Column] = default_head,
         code: Callable[[Column, Column, int], Column] = turn_code) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256 of every node; ``head`` gives at most ``MOST``."""
    rows = rows_of(conversations)
    for seed in range(SEEDS):
        fold = Fold(seed)
        coded = rows.withColumn("code", code(F.col("role"), F.col("text"), seed)).withColumn("size", F.octet_length("text").cast("long"))
        parts = members(folded(coded, fold), fold, base, head)
        nodes = nodes_of(parts)
        if not collides(parts, nodes, coded):
            break
    else:
        raise ValueError("turn codes collide under every seed")
    firsts = nodes.groupBy("conv_id").agg(F.min("depth").alias("first"), F.min_by("below", "depth").alias("first_below"),
                                          F.max(F.col("reach") == F.col("depth")).alias("leaf"))
    below = F.col("bytes") - F.col("upto") + F.col("size")
    counted = parts.join(firsts, "conv_id", "left").select(
        *NODE, F.when(F.col("depth") >= F.col("first"), 0).otherwise(below - F.coalesce("first_below", F.lit(0))).alias("saved"),
        F.when((F.col("first") <= F.col("depth") + 1) & (F.col("depth") < F.col("length")), 1).otherwise(0).alias("child"),
        F.when(F.col("leaf"), 1).otherwise(0).alias("leaf"))
    sums = counted.groupBy(*NODE).agg(F.sum("saved").alias("saved_tokens"), F.sum("child").alias("n_children"), F.sum("leaf").alias("n_leaves"))
    return with_parents(nodes, fold).join(sums, NODE).join(ends_of(parts), NODE, "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))


def digest(conversations: DataFrame) -> DataFrame:
    return trie(conversations)


#: DuckDB SQL for ``digest``'s rows (a CRC-32 is a fold of shifts over the id's digits).
SQL = """
WITH own AS (
  SELECT conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} ORDER BY turn NULLS FIRST,
           md5(octet_length(encode(coalesce(role, '')))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS turns
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
sized AS (
  SELECT conv_id, turns, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(1, length(conv_id::VARCHAR) + 1), lambda i: ascii(substr(conv_id::VARCHAR, i, 1))::BIGINT)),
           lambda crc, b: list_reduce([xor(crc, b), 0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[],
             lambda x, z: xor(x >> 1, 3988292384 * (x & 1))))) % 9 AS h
  FROM own),
rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns[1:c.h], []), c.turns[c.h + 1:]) AS turns
  FROM sized c LEFT JOIN own b ON b.conv_id = c.conv_id - c.conv_id % 5),
member AS (
  SELECT conv_id, len(turns) AS l, d, turns[1:d] AS k, CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(turns[d].t)) END AS size
  FROM rebuilt, unnest(range(0, len(turns) + 1)) AS u(d)),
node AS (
  SELECT d, k, min(conv_id) AS conv_id, count(*) AS n_convs, max(l) AS reach, max(size) AS size,
         string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (l = d) AS ends
  FROM member GROUP BY d, k),
up AS (
  SELECT a, k[1:a] AS ak, count(*) FILTER (a = d - 1) AS n_children, count(*) FILTER (reach = d) AS n_leaves,
         sum((n_convs - 1) * size) AS saved
  FROM node, unnest(range(0, d + 1)) AS u(a) GROUP BY ALL)
SELECT n.conv_id, n.d AS depth, p.conv_id AS parent_conv_id, n.n_convs, up.n_children, up.n_leaves,
       CAST(up.saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM node n JOIN up ON up.a = n.d AND up.ak = n.k LEFT JOIN node p ON p.d = n.d - 1 AND p.k = n.k[1:n.d - 1] AND n.d > 0
"""
