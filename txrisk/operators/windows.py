"""Behavioural features: per-customer time-range windows and totals.

A frame aggregate is the difference of two running sums, at the row's time
and at the beginning of its frame.  Both are looked up in sorted arrays, so a
partition costs one sort and one linear pass whatever the frames hold, and no
row is added per frame.

The customer's totals come from the same pass, which sees all its rows: one
shuffle of the rows serves both.

A customer is one group, unless it is dense: then its time is cut in slices of
about ``SLICE_ROWS`` rows.  A row of a dense customer goes to its own slice and
as halo, without payload, to the one slice per frame length in which it leaves
the frames (a slice needs single rows only where its frames begin).  What lies
between is the carry: rows before the slice less the rows that have left before
it, two running sums over the slices' totals.

:func:`range_window_features_prefix` computes the same features by running
sums over one range-partitioned sort of (key, time): a task has a stretch of
the sorted rows instead of hashed keys, the slices are as long as the stretches,
and sums of any size are exact.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from txrisk.functions.calendar import epoch_micros
from txrisk.functions.fixedpoint import nan_to_null
from txrisk.functions.numeric import cents
from txrisk.schema import ONLINE_CHANNELS
from txrisk.session import cut_lineage

DAY_US = 86_400_000_000
WEEK_US = 7 * DAY_US
FRAMES = {"1": DAY_US, "7": WEEK_US}

#: Rows of a slice of a dense key; at most about ``SLICES`` slices in all (the
#: broadcast tables of slices and carries hold one row each).
SLICE_ROWS = 1 << 15
SLICES = 1 << 16
#: Dense keys are cut between ticks of this length.
TICK_US = 60_000_000
#: Rows that one array step takes at least (whole groups).
STEP_ROWS = 1 << 16
#: Rows of a range of the sorted rows, about: a task sorts them without spilling.
RANGE_ROWS = 1 << 17
#: Rows that a slice has at least, however many ranges there are.
SHORT_SLICE = 1 << 12

_LOW = 20  # a squared amount is split in parts of so many bits
_MEASURES = ("n", "m", "s", "hi", "lo")
_WIDE = ("sx", "hx")  # what s and hi have beyond _WORD bits
_WORD = 62
_TOTALS = {"tx_count_total": "int", "_total_cents": "long", "_amounts": "long", "amount_std_total": "double",
           "channel_diversity": "int", "location_diversity": "int", "_online": "long"}


def dense_slices(rows: DataFrame, slice_rows: int) -> DataFrame | None:
    """(_dense, starts): keys with more rows than two slices and the times at
    which their slices begin, stored; None if there are none.  Runs one job
    over the keys, and a second one if there are."""
    counts = rows.groupBy("_key").agg(F.count("*").alias("n"))
    total, most = counts.agg(F.sum("n"), F.max("n")).first()
    limit = max(slice_rows, (total or 0) // SLICES)
    if (most or 0) <= 2 * limit:
        return None
    dense = counts.where(F.col("n") > 2 * limit).select(F.col("_key").alias("_dense"))
    tick = F.floor(F.col("_t") / TICK_US) * TICK_US
    ticks = rows.where(F.col("_t").isNotNull()).join(F.broadcast(dense), F.col("_key").eqNullSafe(F.col("_dense"))) \
        .groupBy("_dense", tick.alias("tick")).agg(F.count("*").alias("c"))
    before = Window.partitionBy("_dense").orderBy("tick").rowsBetween(Window.unboundedPreceding, -1)
    return cut_lineage(ticks.withColumn("cut", F.floor(F.coalesce(F.sum("c").over(before), F.lit(0)) / limit))
                       .groupBy("_dense", "cut").agg(F.min("tick").alias("start"))
                       .groupBy("_dense").agg(F.sort_array(F.collect_list("start")).alias("starts")))


def _slice(time: Column) -> Column:
    """Number of the slice that holds a time: from 1 for dense keys, 0 for
    others, -1 for rows without time (they are peers of each other)."""
    return F.when(time.isNull(), -1).when(F.col("starts").isNull(), 0).otherwise(F.size(F.filter("starts", lambda x: x <= time)))


def _stays(us: int) -> Column:
    """Whether a row leaves a frame in its own slice (``_end``: the next one's start)."""
    return F.coalesce(F.col("_t") + us < F.col("_end"), F.lit(True))


def _sliced(rows: DataFrame) -> DataFrame:
    """Rows with the number of their slice (_part) and its _end."""
    return rows.withColumn("_part", _slice(F.col("_t"))).withColumn("_end", F.get("starts", "_part"))


def _leaving(rows: DataFrame) -> DataFrame:
    """Timed rows of dense keys with their slice and those in which they leave the frames (_out<frame>)."""
    return _sliced(rows.where(F.col("starts").isNotNull() & F.col("_t").isNotNull())).withColumns({
        f"_out{f}": F.when(_stays(us), F.col("_part")).otherwise(_slice(F.col("_t") + us)) for f, us in FRAMES.items()})


def _carries(rows: DataFrame, wide: bool = False) -> DataFrame:
    """(_dense, _part, <measure><frame>): what a slice's frames hold of the
    rows before it that neither it nor its halo shows."""
    square = F.col("_cents").cast("decimal(38,0)") * F.col("_cents").cast("decimal(38,0)")
    amount = F.col("_cents").cast("decimal(38,0)") if wide else F.col("_cents")
    entries = [F.struct(F.lit(f).alias("frame"), F.lit(sign).alias("sign"), F.col(part).alias("part"))
               for f in FRAMES for sign, part in ((1, "_part"), (-1, f"_out{f}"))]
    some = _leaving(rows).select(
        "_dense", "_cents", square.alias("square"), F.explode(F.array(*entries)).alias("e"))
    sign = F.col("e.sign")
    totals = some.groupBy("_dense", F.col("e.part").alias("_part"), F.col("e.frame").alias("frame")).agg(
        F.sum(sign).alias("n"), F.sum(F.when(F.col("_cents").isNotNull(), sign)).alias("m"), F.sum(sign * amount).alias("s"),
        F.sum(sign * F.col("square")).alias("ss"))
    before = Window.partitionBy("_dense", "frame").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    running = totals.select("_dense", "_part", "frame", *[F.coalesce(F.sum(x).over(before), F.lit(0)).alias(x) for x in ("n", "m", "s", "ss")])
    return running.groupBy("_dense", "_part").agg(*[
        F.max(F.when(F.col("frame") == f, F.col(x))).alias(f"_c{x}{f}") for f in FRAMES for x in ("n", "m", "s", "ss")])


def _running(values: np.ndarray) -> np.ndarray:
    return np.concatenate([np.zeros(1, values.dtype), np.cumsum(values)])


def _squares(amounts: np.ndarray) -> tuple[list[np.ndarray], bool]:
    """Running sums from which a frame's sum of squares follows exactly."""
    if len(amounts) and max(abs(int(amounts.min())), abs(int(amounts.max()))) >= 1 << 40:
        return [_running(np.array([int(x) * int(x) for x in amounts], object))], False
    low, high = amounts & ((1 << _LOW) - 1), amounts >> _LOW
    return [_running(high * high), _running(high * low), _running(low * low)], True


def _high_low(parts: list[np.ndarray], plain: bool, wide: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """A sum of squares as ``high * 2**40 + low``."""
    if not plain:
        return (np.array([int(x) >> 40 for x in parts[0]], object if wide else np.int64),
                np.array([int(x) & ((1 << 40) - 1) for x in parts[0]], np.int64))
    twice = 2 * parts[1]
    return parts[0] + (twice >> _LOW), ((twice & ((1 << _LOW) - 1)) << _LOW) + parts[2]


def _words(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whole numbers of any size as ``high * 2**_WORD + low``."""
    if values.dtype != object:
        return np.zeros(len(values), np.int64), values
    return (np.array([int(x) >> _WORD for x in values], np.int64),
            np.array([int(x) & ((1 << _WORD) - 1) for x in values], np.int64))


def _frames(group: np.ndarray, time: np.ndarray, amount: np.ndarray, there: np.ndarray, kind: np.ndarray,
            leaves: dict[str, np.ndarray], wide: bool = False) -> dict[str, np.ndarray]:
    """Measures of the frames of the rows of kind 0 (rows by group and time).
    ``wide``: sums may not fit 64 bits (else they must)."""
    span = int(time.max()) - int(time.min()) + WEEK_US + DAY_US
    at = group * span + (time - time.min())
    own = kind == 0
    ends = np.searchsorted(at[own], at[own], "right")
    starts = np.searchsorted(at[own], group[own] * span, "left")
    out: dict[str, np.ndarray] = {}

    def sums(rows: np.ndarray, a: np.ndarray, b: np.ndarray) -> list:
        value = np.where(there[rows], amount[rows], 0)
        squares, plain = _squares(value)
        if wide and len(value) and max(abs(int(value.min())), abs(int(value.max()))) * len(value) >= 1 << _WORD:
            value = np.array([int(x) for x in value], object)
        return [b - a, *(r[b] - r[a] for r in (_running(there[rows].astype(np.int64)), _running(value))),
                [r[b] - r[a] for r in squares], plain]

    now = sums(own, starts, ends)
    for f, us in FRAMES.items():
        rows = leaves[f]
        gone_to = np.searchsorted(at[rows], at[own] - us, "left")
        gone_from = np.searchsorted(at[rows], group[own] * span, "left")
        gone = sums(rows, gone_from, gone_to)
        if now[4] != gone[4]:  # one side needs whole numbers of any size
            now[3], gone[3] = ([_whole(x)] if plain else x for x, plain in ((now[3], now[4]), (gone[3], gone[4])))
        both = now[4] and gone[4]
        high, low = _high_low([x - y for x, y in zip(now[3], gone[3], strict=True)], both, wide)
        now[4] = both
        out |= {f"n{f}": now[0] - gone[0], f"m{f}": now[1] - gone[1], f"s{f}": now[2] - gone[2], f"hi{f}": high, f"lo{f}": low}
        if wide:
            for whole, beyond in (("s", "sx"), ("hi", "hx")):
                out[f"{beyond}{f}"], out[f"{whole}{f}"] = _words(out[f"{whole}{f}"])
    return out


def _whole(parts: list[np.ndarray]) -> np.ndarray:
    high, cross, low = (x.astype(object) for x in parts)
    return high * (1 << 2 * _LOW) + cross * (1 << _LOW + 1) + low


def _groups(table: pa.Table, part: str) -> np.ndarray:
    """Number of each row's key and part in a sorted table."""
    key = pc.dictionary_encode(table.column("_key").combine_chunks(), null_encoding="encode").indices.to_numpy()
    part = table.column(part).to_numpy()
    return np.cumsum(np.append(0, (key[1:] != key[:-1]) | (part[1:] != part[:-1]))) if len(key) else np.zeros(0, np.int64)


def _diversity(values: pa.ChunkedArray, group: np.ndarray, groups: int) -> np.ndarray:
    """Distinct values that are there, per group."""
    codes = pc.dictionary_encode(values.combine_chunks(), null_encoding="mask").indices
    there = codes.is_valid().to_numpy(zero_copy_only=False)
    pairs = np.unique((group[there].astype(np.int64) << 32) | codes.drop_null().to_numpy().astype(np.int64))
    return np.bincount(pairs >> 32, minlength=groups)


def _group_totals(table: pa.Table, amount: str, channel: str, location: str) -> dict[str, np.ndarray]:
    """The totals of each row's group of (_key, _part), for every row."""
    group = _groups(table, "_part")
    groups = int(group[-1]) + 1
    cents_there = table.column("_cents").is_valid().to_numpy()
    total = np.zeros(groups, np.int64)
    np.add.at(total, group, table.column("_cents").fill_null(0).to_numpy())
    x = table.column(amount).cast(pa.float64()).to_numpy()
    there = ~np.isnan(x)
    x, of = x[there], group[there]
    n = np.bincount(of, minlength=groups)
    mean = np.bincount(of, x, groups) / np.maximum(n, 1)
    spread = np.sqrt(np.bincount(of, (x - mean[of]) ** 2, groups) / np.maximum(n - 1, 1))
    channels = table.column(channel)
    online = pc.is_in(channels, value_set=pa.array(ONLINE_CHANNELS, channels.type)).to_numpy()
    found = {"tx_count_total": np.bincount(group, minlength=groups).astype(np.int32), "_total_cents": total,
             "_amounts": np.bincount(group[cents_there], minlength=groups), "amount_std_total": np.where(n > 1, spread, 0.0),
             "channel_diversity": _diversity(channels, group, groups).astype(np.int32),
             "location_diversity": _diversity(table.column(location), group, groups).astype(np.int32),
             "_online": np.bincount(group[online], minlength=groups)}
    return {name: values[group] for name, values in found.items()}


def _measures(wide: bool) -> tuple[str, ...]:
    return (*_MEASURES, *_WIDE) if wide else _MEASURES


def _measured(table: pa.Table, payload: list[str], totals: tuple[str, str, str] | None, wide: bool = False) -> Iterator[pa.RecordBatch]:
    group = _groups(table, "_slice")
    if totals:
        for name, values in _group_totals(table, *totals).items():
            table = table.append_column(f"_total{name}", pa.array(values))
        payload = [*payload, *(f"_total{name}" for name in _TOTALS)]
    time = table.column("_t")
    least = pc.min(time).as_py() or 0
    time = time.fill_null(least).to_numpy()
    there = table.column("_cents").is_valid().to_numpy()
    amount = table.column("_cents").fill_null(0).to_numpy()
    kind = table.column("_kind").to_numpy()
    leaves = {f: table.column(f"_leaves{f}").to_numpy() for f in FRAMES}
    at_once = max(1, (1 << 62) // (int(time.max()) - int(time.min()) + WEEK_US + DAY_US))
    for first in range(0, int(group[-1]) + 1, at_once):
        a, b = np.searchsorted(group, [first, first + at_once])
        found = _frames(group[a:b] - first, time[a:b], amount[a:b], there[a:b], kind[a:b], {f: x[a:b] for f, x in leaves.items()}, wide)
        rows = table.slice(a, b - a)
        if kind[a:b].any():
            rows = rows.filter(pa.array(kind[a:b] == 0))
        rows = rows.select([*payload, "_key", "_part"])
        for name in (f"{x}{f}" for f in FRAMES for x in _measures(wide)):
            rows = rows.append_column(name, pa.array(found[name]))
        yield from rows.combine_chunks().to_batches(max_chunksize=20_000)


def _linear_pass(payload: list[str], totals: tuple[str, str, str] | None, wide: bool = False):
    """mapInArrow function over rows sorted by (_key, _part, _slice, _t); a step
    takes whole groups of (_key, _part)."""
    def run(batches):
        waiting, size, target = [], 0, STEP_ROWS
        for batch in batches:
            waiting.append(batch)
            size += len(batch)
            if size >= target:
                table = pa.Table.from_batches(waiting)
                group = _groups(table, "_part")
                edge = int(np.searchsorted(group, group[-1]))  # the last group may go on
                if edge:
                    yield from _measured(table.slice(0, edge), payload, totals, wide)
                waiting, size = table.slice(edge).to_batches(), size - edge
                target = max(STEP_ROWS, 2 * size)
        if size:
            yield from _measured(pa.Table.from_batches(waiting), payload, totals, wide)
    return run


def range_window_features(df: DataFrame, key: str = "customer_id", ts: str = "timestamp", amount: str = "amount",
                          slice_rows: int = SLICE_ROWS, totals: tuple[str, str] | None = None,
                          stored: bool = False) -> DataFrame:
    """Adds tx_count_24h, amount_sum_24h, amount_mean_7d, amount_std_7d.

    ``totals``, the names of the channel and location columns, also adds the
    columns of :func:`customer_totals` to every row of the key.

    Frames are ``RANGE BETWEEN <span> PRECEDING AND CURRENT ROW`` on the
    event time (both ends inclusive, peers of the current row included).
    Counts are of rows; sums, mean and deviation are of the amounts that are
    there (NULL and NaN are not), exact in integer cents.  A NULL key is a
    key like others; rows without time are each other's peers.  A key of any
    density is cut in slices (see the module's text); finding dense keys
    takes one job over the key column.  The frame is read up to five times, so
    it is stored once, unless it is a ``stored`` table already.
    """
    return _windows(df if stored else cut_lineage(df), key, ts, amount, slice_rows, totals)


def _windows(df: DataFrame, key: str, ts: str, amount: str, slice_rows: int, totals: tuple[str, str] | None = None,
             ranges: int | None = None) -> DataFrame:
    """The features of a stored frame.  ``ranges``: the rows are dealt out in so
    many ranges of (key, slice), not by hash, and sums of any size are exact."""
    dec, wide = "decimal(38,0)", ranges is not None
    payload = [f"_p{i}" for i in range(len(df.columns))]
    place = dict(zip(df.columns, payload, strict=True))

    def dealt(rows: DataFrame) -> DataFrame:
        return rows.repartition("_key", "_part") if ranges is None else rows.repartitionByRange(ranges, "_key", "_part")

    def keyed(rows: DataFrame, *also: str) -> DataFrame:
        return rows.select(F.col(key).alias("_key"), epoch_micros(F.col(ts)).alias("_t"), cents(F.col(amount)).alias("_cents"),
                           *[F.col(c).alias(p) for c, p in place.items()], *also)

    base = keyed(df)
    slices = dense_slices(base.select("_key", "_t"), slice_rows)
    plain = ["_key", "_t", "_cents"]
    if slices is None:
        # a key is one part; what is derived from a row is added after the shuffle
        rows = dealt(df.withColumns({"_key": F.col(key), "_part": F.col(key).isNull().cast("int")}))
        rows = keyed(rows, "_part").select(
            *plain, *payload, "_part", F.when(F.col("_t").isNull(), -1).otherwise(0).alias("_slice"), F.lit(0).alias("_kind"),
            *[F.lit(True).alias(f"_leaves{f}") for f in FRAMES])
    else:
        own = _sliced(base.join(F.broadcast(slices), F.col("_key").eqNullSafe(F.col("_dense")), "left")).select(
            *plain, *payload, F.col("_part").alias("_slice"), F.when(F.col("starts").isNull(), 0).otherwise(F.col("_part")).alias("_part"),
            F.lit(0).alias("_kind"), *[_stays(us).alias(f"_leaves{f}") for f, us in FRAMES.items()])
        dense_rows = base.select(*plain).join(F.broadcast(slices), F.col("_key").eqNullSafe(F.col("_dense")))
        copies = F.array(*[F.when(F.col(f"_out{f}") != F.col("_part"), F.struct(F.lit(int(f)).alias("kind"), F.col(f"_out{f}").alias("part"))) for f in FRAMES])
        halo = _leaving(dense_rows).select(*plain, F.explode(F.filter(copies, lambda x: x.isNotNull())).alias("_e")).select(
            *plain, *[F.lit(None).cast(base.schema[p].dataType).alias(p) for p in payload], F.col("_e.part").alias("_slice"),
            F.col("_e.part").alias("_part"), F.col("_e.kind").alias("_kind"), *[(F.col("_e.kind") == int(f)).alias(f"_leaves{f}") for f in FRAMES])
        rows = own.unionByName(halo)
    schema = ", ".join(f"{p} {f.dataType.simpleString()}" for p, f in zip(payload, df.schema, strict=True)) \
        + (", " + ", ".join(f"_total{x} {t}" for x, t in _TOTALS.items()) if totals else "") \
        + f", _key {base.schema['_key'].dataType.simpleString()}, _part int, " + ", ".join(f"{x}{f} long" for f in FRAMES for x in _measures(wide))
    if slices is not None:
        # (key, slice): by the key alone a dense key would lie in one task
        rows = dealt(rows)
    found = rows.sortWithinPartitions("_key", "_part", "_slice", "_t").mapInArrow(
        _linear_pass(payload, (place[amount], *(place[c] for c in totals)) if totals else None, wide), schema)
    whole = [F.col(f"_total{x}").alias(x) for x in _TOTALS] if totals else []
    def whole_number(low: str, beyond: str) -> Column:
        if not wide:
            return F.col(low)
        some = (F.col(beyond).cast(dec) * F.lit(1 << _WORD).cast("decimal(19,0)")).cast(dec) + F.col(low)
        return F.when(F.col(beyond) == 0, F.col(low).cast(dec)).otherwise(some.cast(dec))

    measure = {f"{x}{f}": F.col(f"{x}{f}") for f in FRAMES for x in ("n", "m")} | {f"s{f}": whole_number(f"s{f}", f"sx{f}") for f in FRAMES}
    measure["ss7"] = (whole_number("hi7", "hx7").cast(dec) * F.lit(1 << 40).cast("decimal(13,0)")).cast(dec) + F.col("lo7")
    if slices is not None:
        carry = _carries(dense_rows, wide)
        if totals:  # a slice does not see the whole of its key
            dense = df.join(F.broadcast(slices.select("_dense")), F.col(key).eqNullSafe(F.col("_dense")), "left_semi")
            sums = _sums(dense, key, amount, *totals).select(F.col(key).alias("_owner"), F.struct(*_TOTALS).alias("_sums"))
            found = found.join(F.broadcast(sums), F.col("_key").eqNullSafe(F.col("_owner")), "left")
            whole = [F.coalesce(F.col(f"_sums.{x}"), F.col(f"_total{x}")).alias(x) for x in _TOTALS]
        found = found.join(F.broadcast(carry.withColumnRenamed("_part", "_of")), F.col("_key").eqNullSafe(F.col("_dense"))
                           & (F.col("_part") == F.col("_of")), "left")
        measure = {x: (c + F.coalesce(F.col(f"_c{x}"), F.lit(0))).cast(dec if x == "ss7" or wide and x[0] == "s" else "long") for x, c in measure.items()}
    found = found.select(*[F.col(p).alias(c) for c, p in zip(df.columns, payload, strict=True)], *[c.alias(f"_{x}") for x, c in measure.items()],
                         *whole)
    n7, s7 = F.col("_m7"), F.col("_s7")
    spread7 = (n7.cast(dec) * F.col("_ss7").cast(dec) - s7.cast(dec) * s7.cast(dec)).cast("double")
    return found.select(
        *df.columns,
        F.col("_n1").cast("double").alias("tx_count_24h"),
        F.when(F.col("_m1") > 0, F.col("_s1").cast("double") / F.lit(100.0)).alias("amount_sum_24h"),
        F.when(n7 > 0, s7.cast("double") / n7 / F.lit(100.0)).alias("amount_mean_7d"),
        F.when(n7 > 1, F.sqrt(spread7 / (n7 * (n7 - 1)).cast("double")) / F.lit(100.0)).otherwise(F.lit(0.0))
        .alias("amount_std_7d"),
        *(_shares() if totals else []),
    )


def _sums(df: DataFrame, key: str, amount: str, channel: str, location: str) -> DataFrame:
    return df.groupBy(key).agg(
        F.count(F.lit(1)).cast("int").alias("tx_count_total"),
        F.sum(cents(F.col(amount))).alias("_total_cents"),
        F.count(cents(F.col(amount))).alias("_amounts"),
        F.coalesce(F.stddev_samp(nan_to_null(F.col(amount).cast("double"))), F.lit(0.0)).alias("amount_std_total"),
        F.countDistinct(F.col(channel)).cast("int").alias("channel_diversity"),
        F.countDistinct(F.col(location)).cast("int").alias("location_diversity"),
        F.count_if(F.col(channel).isin(*ONLINE_CHANNELS)).alias("_online"),
    )


def _shares() -> list[Column | str]:
    """The columns of ``customer_totals`` from a customer's sums."""
    return [
        "tx_count_total",
        F.when(F.col("_amounts") > 0, F.col("_total_cents").cast("double") / F.col("_amounts") / F.lit(100.0))
        .alias("amount_mean_total"),
        "amount_std_total", "channel_diversity", "location_diversity",
        (F.col("_online").cast("double") / F.col("tx_count_total")).alias("online_channel_ratio"),
    ]


def customer_totals(df: DataFrame, key: str = "customer_id", amount: str = "amount",
                    channel: str = "channel", location: str = "location") -> DataFrame:
    """One row per customer: totals, diversity and online share.

    A plain group-by (partial aggregation before the shuffle, so a hot
    customer costs one row per map task); distinct counts are planned by
    Catalyst as a two-level aggregate over (customer, value).
    """
    return _sums(df, key, amount, channel, location).select(key, *_shares())


def range_window_features_prefix(df: DataFrame, key: str = "customer_id", ts: str = "timestamp",
                                 amount: str = "amount", partitions: int | None = None) -> DataFrame:
    """Same four features as :func:`range_window_features`, for keys of any density.

    Frame aggregates are differences of prefix sums: for a row at time t,
    ``count_24h = N(<= t) - N(< t - 24h)`` and likewise for sums of cents and
    squared cents (exact decimals).  The prefix values come from ONE sort:
    the rows are range-partitioned on (key, time), so a dense key is split
    across tasks by time, and summed inside each partition, where a row's own
    points (t after its peers, t - 24h and t - 7d before theirs) are looked up
    and are no rows of their own.  A point that lies in an earlier partition is
    answered by the rows that leave the frames in this one, which come along
    without payload, and by the totals of the key's earlier partitions (a table
    of slices of dense keys).  Every row is so stored once and shuffled once.
    Rows of one key and minute, or of one key without time, stay together.
    The input is frozen by a stored table; there are as many partitions as the
    session's shuffles have, more where they would exceed ``RANGE_ROWS`` rows.
    """
    df = cut_lineage(df)
    rows = df.count()
    ranges = partitions or max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-rows // RANGE_ROWS))
    share = -(-rows // ranges)
    return _windows(df, key, ts, amount, max(share, 1 if partitions else SHORT_SLICE), ranges=ranges)
