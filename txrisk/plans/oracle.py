"""Reference SQL (DuckDB dialect) for the correctness checks.

Every layer of the Spark chain has a plain-SQL twin written as a CTE, so a
report's oracle is ``WITH <layers up to its input> SELECT ...``.  Float
arithmetic is written in the same order as the Spark expressions so both
engines produce the same doubles; money sums run on integer cents.
"""

from __future__ import annotations

import math

from txrisk.functions.bins import (
    AMOUNT_BINS, AMOUNT_DEFAULT, DRY_SEASON, HOUR_CATEGORY_BINS, HOUR_CATEGORY_DEFAULT,
    MONTH_CATEGORIES, RAINY_SEASON, RISK_BINS, RISK_DEFAULT, TIME_BUCKETS, UNKNOWN, WEEKDAY, WEEKEND,
)
from txrisk.operators.windows import DAY_US, WEEK_US
from txrisk.schema import (
    ANALYSIS_DROP_FIRST, ANALYSIS_DROP_SECOND, COMPOSITE_WEIGHTS, DATA_QUALITY_SCORE,
    DRY_SEASON_MONTHS, FRAUD_TECHNIQUE_FILL, GOLD_CATEGORICAL, GOLD_LEADING, GOLD_NUMERIC,
    HIGH_FREQUENCY_COUNT, MODE_FALLBACK, ONLINE_CHANNELS, PEAK_HOURS, RAINY_SEASON_MONTHS,
    SILVER_UNSCALED, SOURCE_COLUMNS,
)

TWO_PI = repr(2.0 * math.pi)
QUOTED = {"timestamp", "time", "day", "month", "hour", "year", "count", "column", "value", "min", "max"}


def q(name: str) -> str:
    """Quote identifiers that are also type/function names."""
    return f'"{name}"' if name in QUOTED else name


def d(x: float) -> str:
    """A DOUBLE literal (plain decimals are DECIMAL in DuckDB)."""
    return f"CAST({float(x)!r} AS DOUBLE)"


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_list(values) -> str:
    return ", ".join(sql_str(v) if isinstance(v, str) else str(v) for v in values)


# --------------------------------------------------------------------------
# sources
# --------------------------------------------------------------------------

BASE_LINE = f"""
SELECT 'TXN_' || CAST(l.l_orderkey AS VARCHAR) || '_' || CAST(l.l_linenumber AS VARCHAR) AS transaction_id,
       o.o_custkey AS customer_id,
       l.l_shipdate + to_minutes(CAST(l.l_orderkey % 24 * 60 + (l.l_orderkey * 7 + l.l_linenumber * 13) % 60 AS BIGINT))
           AS "timestamp",
       CASE l.l_linenumber WHEN 1 THEN l.l_quantity * {d(1000)} WHEN 2 THEN l.l_quantity
            WHEN 3 THEN l.l_quantity * {d(10)} WHEN 4 THEN l.l_quantity * {d(40)} ELSE l.l_extendedprice END AS amount,
       CASE o.o_orderpriority WHEN '1-URGENT' THEN 'Mobile' WHEN '2-HIGH' THEN 'Web' WHEN '3-MEDIUM' THEN 'POS'
            WHEN '4-NOT SPECIFIED' THEN 'ECOM' WHEN '5-LOW' THEN 'ATM' ELSE o.o_orderpriority END AS channel,
       p.p_type AS merchant_category,
       n.n_name AS bank,
       r.r_name AS location,
       c.c_mktsegment AS age_group,
       CAST(l.l_returnflag = 'R' AS INTEGER) AS is_fraud,
       CASE WHEN l.l_returnflag = 'R' THEN p.p_brand END AS fraud_technique,
       l.l_discount * {d(10.0)} AS merchant_risk_score
FROM lineitem l
JOIN part p ON l.l_partkey = p.p_partkey
JOIN orders o ON l.l_orderkey = o.o_orderkey
JOIN customer c ON o.o_custkey = c.c_custkey
JOIN nation n ON c.c_nationkey = n.n_nationkey
JOIN region r ON n.n_regionkey = r.r_regionkey
"""

# NaN amounts count as NULL everywhere
BASE_GAPS = f"""
SELECT * EXCLUDE (_k) REPLACE (
       CASE WHEN customer_id % 10 <> 0 THEN customer_id END AS customer_id,
       CASE WHEN _k % 7 <> 0 AND _k % 211 <> 1 THEN amount END AS amount,
       CASE WHEN _k % 5 <> 2 THEN bank END AS bank,
       CASE WHEN _k % 3 <> 1 THEN location END AS location,
       CASE WHEN _k % 11 <> 4 THEN merchant_category END AS merchant_category,
       CAST(NULL AS VARCHAR) AS age_group)
FROM (SELECT *, CAST(floor(amount) AS BIGINT) AS _k FROM ({BASE_LINE}))
"""

_K = "CAST(json_extract_string(props, '$.k') AS INTEGER)"
BASE_EVENT = f"""
SELECT 'TXN_' || CAST(event_id AS VARCHAR) AS transaction_id,
       user_id AS customer_id,
       ts AS "timestamp",
       value AS amount,
       event_type AS channel,
       CAST(NULL AS VARCHAR) AS merchant_category,
       CAST(NULL AS VARCHAR) AS bank,
       CAST(NULL AS VARCHAR) AS location,
       CAST(NULL AS VARCHAR) AS age_group,
       CAST({_K} >= 90 AS INTEGER) AS is_fraud,
       CASE WHEN {_K} >= 90 THEN event_type END AS fraud_technique,
       ({_K} % 10) / {d(10.0)} AS merchant_risk_score
FROM events
"""

DOC_LABEL_NULLS = """
SELECT d.doc_id, d.lang, d.source, d.n_chars, l.quality, l.toxic
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""


def cents(x: str) -> str:
    return f"CAST(round(CAST({x} AS DOUBLE) * {d(100.0)}) AS BIGINT)"


def _norm(x: str) -> str:
    return f"(CASE WHEN _max_{x} > _min_{x} THEN ({x} - _min_{x}) / (_max_{x} - _min_{x}) ELSE {d(0.0)} END)"


def _cyclic(x: str, period: int, fn: str) -> str:
    return f"{fn}(CAST({TWO_PI} AS DOUBLE) * CAST({q(x)} AS DOUBLE) / {d(period)})"


def feature_ctes(src: str) -> list[tuple[str, str]]:
    base = {"line": BASE_LINE, "event": BASE_EVENT, "gaps": BASE_GAPS}[src]
    # deviations from exact integer sums
    w = f"""
SELECT * EXCLUDE (_n7, _s7, _ss7),
       CASE WHEN _n7 > 1 THEN sqrt(CAST(_n7 * _ss7 - _s7 * _s7 AS DOUBLE) / CAST(_n7 * (_n7 - 1) AS DOUBLE)) / {d(100.0)}
            ELSE {d(0.0)} END AS amount_std_7d
FROM (SELECT b.*,
       CAST(COUNT(*) OVER w24 AS DOUBLE) AS tx_count_24h,
       SUM(_cents) OVER w24 / {d(100.0)} AS amount_sum_24h,
       CAST(SUM(_cents) OVER w7 AS DOUBLE) / COUNT(_cents) OVER w7 / {d(100.0)} AS amount_mean_7d,
       COUNT(_cents) OVER w7 AS _n7, SUM(_cents) OVER w7 AS _s7, SUM(_cents * _cents) OVER w7 AS _ss7
FROM (SELECT *, epoch_us("timestamp") AS _t, {cents('amount')} AS _cents FROM base) b
WINDOW w24 AS (PARTITION BY customer_id ORDER BY _t RANGE BETWEEN {DAY_US} PRECEDING AND CURRENT ROW),
       w7 AS (PARTITION BY customer_id ORDER BY _t RANGE BETWEEN {WEEK_US} PRECEDING AND CURRENT ROW))
"""
    tot = f"""
SELECT customer_id,
       CAST(COUNT(*) AS INTEGER) AS tx_count_total,
       CAST(SUM({cents('amount')}) AS DOUBLE) / NULLIF(COUNT(amount), 0) / {d(100.0)} AS amount_mean_total,
       COALESCE(STDDEV_SAMP(amount), {d(0.0)}) AS amount_std_total,
       CAST(COUNT(DISTINCT channel) AS INTEGER) AS channel_diversity,
       CAST(COUNT(DISTINCT location) AS INTEGER) AS location_diversity,
       CAST(COUNT_IF(channel IN ({sql_list(ONLINE_CHANNELS)})) AS DOUBLE) / CAST(COUNT(*) AS INTEGER) AS online_channel_ratio
FROM base GROUP BY customer_id
"""
    rows = f"""
SELECT w.* EXCLUDE (_t, _cents),
       tot.tx_count_total, tot.amount_mean_total, tot.amount_std_total, tot.channel_diversity,
       tot.location_diversity, tot.online_channel_ratio,
       CAST(hour(w."timestamp") AS INTEGER) AS "hour",
       CAST(isodow(w."timestamp") - 1 AS INTEGER) AS day_of_week,
       CAST(month(w."timestamp") AS INTEGER) AS "month",
       isodow(w."timestamp") >= 6 AS is_weekend,
       hour(w."timestamp") IN ({sql_list(PEAK_HOURS)}) AS is_peak_hour,
       w.amount / NULLIF(tot.amount_mean_total, 0) AS amount_vs_mean_ratio,
       w.tx_count_24h * w.amount_sum_24h / (tot.amount_mean_total + {d(1.0)}) AS velocity_score
FROM w JOIN tot ON w.customer_id IS NOT DISTINCT FROM tot.customer_id
"""
    st = """
SELECT MIN(amount_vs_mean_ratio) AS _min_amount_vs_mean_ratio, MAX(amount_vs_mean_ratio) AS _max_amount_vs_mean_ratio,
       MIN(velocity_score) AS _min_velocity_score, MAX(velocity_score) AS _max_velocity_score
FROM r
"""
    wm, wr, wv, wf = COMPOSITE_WEIGHTS
    derived = {
        "hour_sin": _cyclic("hour", 24, "sin"), "hour_cos": _cyclic("hour", 24, "cos"),
        "day_sin": _cyclic("day_of_week", 7, "sin"), "day_cos": _cyclic("day_of_week", 7, "cos"),
        "month_sin": _cyclic("month", 12, "sin"), "month_cos": _cyclic("month", 12, "cos"),
        "amount_log": f"ln({d(1.0)} + CAST(amount AS DOUBLE))",
        "amount_rounded": f"CASE WHEN CAST(amount AS DOUBLE) % {d(1000.0)} = 0 THEN 1 ELSE 0 END",
        "composite_risk": (f"{d(wm)} * merchant_risk_score + {d(wr)} * {_norm('amount_vs_mean_ratio')}"
                           f" + {d(wv)} * {_norm('velocity_score')}"
                           f" + {d(wf)} * (CASE WHEN tx_count_24h > {HIGH_FREQUENCY_COUNT} THEN {d(1.0)} ELSE {d(0.0)} END)"),
    }
    feat = "SELECT " + ",\n       ".join(
        f"{derived[c]} AS {q(c)}" if c in derived else q(c) for c in SOURCE_COLUMNS) + "\nFROM r, st"
    return [("base", base), ("w", w), ("tot", tot), ("r", rows), ("st", st), ("feat", feat)]


def _enc(c: str) -> str:
    v = f"CAST({q(c)} AS DOUBLE)"
    return f"CAST(round(CASE WHEN isnan({v}) THEN NULL ELSE {v} END * {d(100.0)}) AS BIGINT)"


def silver_ctes(src: str) -> list[tuple[str, str]]:
    cols = []
    for c in SOURCE_COLUMNS:
        if c == "fraud_technique":
            cols.append(f"COALESCE(fraud_technique, {sql_str(FRAUD_TECHNIQUE_FILL)}) AS fraud_technique")
        elif c in SILVER_UNSCALED:
            cols.append(q(c))
        else:
            cols.append(f"{_enc(c)} AS {q(c)}")
    silver = "SELECT DISTINCT " + ",\n       ".join(cols) + "\nFROM feat"
    return feature_ctes(src) + [("silver", silver)]


def _ge_chain(x: str, bins, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} >= {b} THEN {sql_str(lab)}" for b, lab in bins) + f" ELSE {sql_str(default)} END"


def _lt_chain(x: str, bins, default: str) -> str:
    return "CASE " + " ".join(f"WHEN {x} < {b} THEN {sql_str(lab)}" for b, lab in bins) + f" ELSE {sql_str(default)} END"


def _range_chain(x: str, bins, default: str) -> str:
    return ("CASE " + " ".join(f"WHEN {x} BETWEEN {lo} AND {hi} THEN {sql_str(lab)}" for lo, hi, lab in bins)
            + f" ELSE {sql_str(default)} END")


def gold_ctes(src: str) -> list[tuple[str, str]]:
    dec = "SELECT " + ",\n       ".join(
        f"CAST({q(c)} AS DOUBLE) / {d(100.0)} AS {q(c)}" if c in GOLD_NUMERIC else q(c)
        for c in SOURCE_COLUMNS) + "\nFROM silver"
    stats = [f"COALESCE(quantile_disc({q(c)}, 0.5), {d(0.0)}) AS _med_{c}" for c in GOLD_NUMERIC]
    for c in GOLD_CATEGORICAL:
        stats.append(
            f"COALESCE((SELECT {c} FROM dec WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, {c} LIMIT 1),"
            f" {sql_str(MODE_FALLBACK)}) AS _mode_{c}")
    gst = "SELECT " + ",\n       ".join(stats) + "\nFROM dec"
    imp_cols = []
    for c in SOURCE_COLUMNS:
        if c in GOLD_NUMERIC:
            imp_cols.append(f"COALESCE({q(c)}, _med_{c}) AS {q(c)}")
        elif c in GOLD_CATEGORICAL:
            imp_cols.append(f"COALESCE({c}, _mode_{c}) AS {c}")
        else:
            imp_cols.append(q(c))
    imp = "SELECT " + ",\n       ".join(imp_cols) + "\nFROM dec, gst"
    derived = {
        "amount_category": _lt_chain("amount", AMOUNT_BINS, AMOUNT_DEFAULT),
        "is_fraudulent": "COALESCE(is_fraud = 1, false)",
        "risk_category": _ge_chain("composite_risk", RISK_BINS, RISK_DEFAULT),
        "transaction_hour_category": _range_chain('"hour"', HOUR_CATEGORY_BINS, HOUR_CATEGORY_DEFAULT),
    }
    rest = [c for c in SOURCE_COLUMNS if c not in GOLD_LEADING]
    gold_cols = [f"{derived[c]} AS {c}" if c in derived else q(c) for c in GOLD_LEADING]
    gold_cols += [q(c) for c in rest]
    gold_cols.append(f"{d(DATA_QUALITY_SCORE)} AS data_quality_score")
    gold = "SELECT " + ",\n       ".join(gold_cols) + "\nFROM imp"
    return silver_ctes(src) + [("dec", dec), ("gst", gst), ("imp", imp), ("gold", gold)]


GOLD_COLUMNS_NO_TS = GOLD_LEADING + [c for c in SOURCE_COLUMNS if c not in GOLD_LEADING] + ["data_quality_score"]


def analysis_columns() -> list[str]:
    """Analysis-view columns in order (without the processing timestamp)."""
    dropped = set(ANALYSIS_DROP_FIRST) | set(ANALYSIS_DROP_SECOND)
    cols = [c for c in GOLD_COLUMNS_NO_TS if c not in dropped]
    return cols + ["year", "time", "day", "DayClassification", "season", "time_bucket", "month_category"]


def av_ctes(src: str) -> list[tuple[str, str]]:
    ts = '"timestamp"'
    over = {
        "month": f"monthname({ts})",
        "hour": f"CAST(hour({ts}) AS INTEGER)",
        "day_of_week": f"dayname({ts})",
        "year": f"CAST(year({ts}) AS INTEGER)",
        "time": f"strftime({ts}, '%H:%M:%S')",
        "day": f"CAST(day({ts}) AS INTEGER)",
        "DayClassification": f"CASE WHEN isodow({ts}) >= 6 THEN {sql_str(WEEKEND)} ELSE {sql_str(WEEKDAY)} END",
        "season": (f"CASE WHEN monthname({ts}) IN ({sql_list(DRY_SEASON_MONTHS)}) THEN {sql_str(DRY_SEASON)}"
                   f" WHEN monthname({ts}) IN ({sql_list(RAINY_SEASON_MONTHS)}) THEN {sql_str(RAINY_SEASON)}"
                   f" ELSE {sql_str(UNKNOWN)} END"),
        "time_bucket": _range_chain(f"hour({ts})", TIME_BUCKETS, UNKNOWN),
        "month_category": _range_chain(f"day({ts})", MONTH_CATEGORIES, UNKNOWN),
    }
    av = "SELECT " + ",\n       ".join(
        f"{over[c]} AS {q(c)}" if c in over else q(c) for c in analysis_columns()) + "\nFROM gold"
    return gold_ctes(src) + [("av", av)]


QCUT_PROBS = "[" + ", ".join(repr(i / 10) for i in range(11)) + "]"


def qcut_sql(x: str, edges: str, base: int) -> str:
    terms = [f"(CASE WHEN {edges}[1] < {x} THEN 1 ELSE 0 END)"]
    for i in range(2, 12):
        terms.append(f"(CASE WHEN {edges}[{i}] < {x} AND {edges}[{i}] > {edges}[{i - 1}] THEN 1 ELSE 0 END)")
    return f"CASE WHEN {x} IS NOT NULL THEN CAST(greatest({' + '.join(terms)} - 1, 0) + {base} AS INTEGER) END"


def avd_ctes(src: str) -> list[tuple[str, str]]:
    qe = (f"SELECT quantile_cont(velocity_score, {QCUT_PROBS}) AS _ev, quantile_cont(composite_risk, {QCUT_PROBS}) AS _er,"
          f" quantile_cont(amount, {QCUT_PROBS}) AS _ea FROM av")
    avd = (f"SELECT av.*, {qcut_sql('velocity_score', '_ev', 1)} AS velocity_decile,"
           f" {qcut_sql('composite_risk', '_er', 1)} AS risk_decile,"
           f" {qcut_sql('amount', '_ea', 0)} AS amount_decile FROM av, qe")
    return av_ctes(src) + [("qe", qe), ("avd", avd)]


LAYERS = {
    "base": lambda s: feature_ctes(s)[:1],
    "feat": feature_ctes,
    "silver": silver_ctes,
    "gold": gold_ctes,
    "av": av_ctes,
    "avd": avd_ctes,
}


def with_layers(layer: str, src: str, select: str, extra: list[tuple[str, str]] | None = None) -> str:
    """``WITH <ctes up to layer> [, extra] <select>``."""
    ctes = LAYERS[layer](src) + list(extra or [])
    body = ",\n".join(f"{name} AS (\n{sql.strip()}\n)" for name, sql in ctes)
    return f"WITH {body}\n{select.strip()}"
