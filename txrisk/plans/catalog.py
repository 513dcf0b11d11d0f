"""Query catalogue: every operator of the blueprint as a named query.

Each entry is a Spark callable ``(spark, sf_dir) -> DataFrame`` reading the
driver's tables through an adapter and the layer chain, plus (where the
result is deterministic) the DuckDB SQL computing the same rows.
Float results of non-exact arithmetic (means of amounts, correlations,
densities, standard deviations) are presented rounded to 6 decimals on
both sides.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txrisk.functions import calendar
from txrisk.functions.fixedpoint import nan_to_null
from txrisk.operators import correlation, distribution, profile, rates, windows
from txrisk.operators.clean import (
    dedup_full_row, drop_columns, fill_null_constant, fixed_point_decode, fixed_point_encode, reorder_columns,
)
from txrisk.operators.fingerprint import row_fingerprint
from txrisk.operators.impute import impute_median, impute_mode
from txrisk.operators.quantile import add_qcuts
from txrisk.plans import layers
from txrisk.plans import oracle as O
from txrisk.schema import (
    ANALYSIS_DROP_FIRST, ANALYSIS_DROP_SECOND, BOX_FEATURES, CORR_TOP_K, DISTINCT_PROFILE_COLUMNS,
    FIVE_KEYS, GOLD_LEADING, GOLD_NUMERIC, LABEL, PAIRPLOT_FEATURES, RESCUED_DATA, SCATTER_SAMPLE_CAP, SEGMENTS,
    SILVER_UNSCALED, SOURCE_COLUMNS,
)
from txrisk.sources import testdata
from txrisk.sources.sinks import materialize, read_back, write_csv, write_parquet
from txrisk.sources.tables import raw_transactions
from txrisk.session import table_path

ROUND = 6
# Means and ratios of integer cents are the same doubles in both engines and are
# not rounded (a mean can lie on a rounding tie).
FEATURE_DOUBLES = [
    "amount", "tx_count_24h", "amount_sum_24h", "amount_std_7d", "amount_std_total", "online_channel_ratio", "hour_sin", "hour_cos", "day_sin",
    "day_cos", "month_sin", "month_cos", "amount_log", "velocity_score", "merchant_risk_score", "composite_risk",
]
DECILES = [("velocity_score", "velocity_decile", 1), ("composite_risk", "risk_decile", 1), ("amount", "amount_decile", 0)]


@dataclass
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def register(key: str, run, sql: str | None) -> None:
    REGISTRY[key] = Query(run, sql)


# --------------------------------------------------------------------------
# layer access
#
# bronze (the feature table, whose last columns are projected on reading) and
# gold are pipeline tables: the first query that needs one writes it as parquet under the session's checkpoint folder,
# later queries of the same application read the stored table while the
# source's files are the same (as the notebook reads the stored gold table).
# silver and the analysis views are lazy plans over the stored tables.
# --------------------------------------------------------------------------

_STORED: dict[tuple, str] = {}


def _stored(spark: SparkSession, sf: str, src: str, layer: str, build) -> str:
    """Path of a layer's stored table."""
    key = (spark.sparkContext.applicationId, _source_state(spark, sf, src), src, layer)
    if key not in _STORED:
        _STORED[key] = write_parquet(build(), table_path(spark, f"{layer}-{src}"))
    return _STORED[key]


def _source_state(spark: SparkSession, sf: str, src: str) -> tuple:
    """Number, size and state of a source's files, so that a changed source
    is not answered from the tables of the old one."""
    paths = [f"{sf.rstrip('/')}/{t}.parquet" for t in testdata.SOURCE_TABLES[src]]
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(paths)
    seen = files.agg(F.count("*").alias("n"), F.sum("length").alias("size"),
                     F.bit_xor(F.xxhash64("path", "modificationTime", "length")).alias("state")).first()
    return sf.rstrip("/"), seen["n"], seen["size"], seen["state"]


def base(spark, sf, src):
    return testdata.transactions(spark, sf, src)


def bronze(spark, sf, src):
    return layers.scored(spark.read.parquet(_stored(spark, sf, src, "bronze", lambda: layers.feature_rows(base(spark, sf, src)))))


def silver(spark, sf, src):
    return layers.silver(bronze(spark, sf, src))


def gold(spark, sf, src):
    # medians that fill real gaps are exact, so that the oracle can follow
    return spark.read.parquet(_stored(spark, sf, src, "gold", lambda: layers.gold(
        silver(spark, sf, src), exact_median=src == "gaps")))


def raw_table(spark, sf):
    """The line transactions as a raw table: timestamps as text and a rescue column."""
    def build():
        rescued = F.when(F.col(LABEL) == 1, F.concat(F.lit('{"technique": "'), F.col("fraud_technique"), F.lit('"}')))
        text = F.date_format("timestamp", calendar.TIMESTAMP_FORMAT)
        return bronze(spark, sf, "line").withColumns({"timestamp": text, RESCUED_DATA: rescued, "_file": F.lit("x")})
    return raw_transactions(spark, _stored(spark, sf, "line", "raw", build))


def gold_nots(spark, sf, src):
    return gold(spark, sf, src).drop("gold_processed_timestamp")


def av(spark, sf, src):
    return layers.analysis_view(gold(spark, sf, src))


def avd(spark, sf, src):
    return add_qcuts(av(spark, sf, src), DECILES)


VIEW = {"base": base, "feat": bronze, "silver": silver, "gold": gold, "av": av, "avd": avd}


def rnd(c: str) -> F.Column:
    return (F.round(F.col(c), ROUND) + F.lit(0.0)).alias(c)


def sql_rnd(c: str) -> str:
    return f"(round({O.q(c)}, {ROUND}) + 0.0) AS {O.q(c)}"


def _sel(cols, doubles=()):
    return ", ".join(sql_rnd(c) if c in doubles else O.q(c) for c in cols)


# --------------------------------------------------------------------------
# A: scans, layers, sinks
# --------------------------------------------------------------------------

def _features_rounded(src):
    def run(spark, sf):
        f = bronze(spark, sf, src)
        return f.select(*[rnd(c) if c in FEATURE_DOUBLES else F.col(c) for c in f.columns])
    return run


_TEXT_TS = "strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S') AS \"timestamp\""


def bronze_scan(spark, sf):
    raw = raw_table(spark, sf)
    return raw.select(*[rnd(c) if c in FEATURE_DOUBLES else F.col(c) for c in raw.columns])


register("bronze_scan", bronze_scan, O.with_layers(
    "feat", "line", f"SELECT {_sel([c for c in SOURCE_COLUMNS if c != 'timestamp'], FEATURE_DOUBLES)}, {_TEXT_TS},"
    " CASE WHEN is_fraud = 1 THEN '{\"technique\": \"' || fraud_technique || '\"}' END AS _rescued_data FROM feat"))
register("silver_rescued", lambda s, sf: layers.silver(raw_table(s, sf)),
         O.with_layers("silver", "line", f"SELECT * REPLACE ({_TEXT_TS}) FROM silver"))
register("features_line", _features_rounded("line"),
         O.with_layers("feat", "line", f"SELECT {_sel(SOURCE_COLUMNS, FEATURE_DOUBLES)} FROM feat"))
register("features_nulls", _features_rounded("gaps"),
         O.with_layers("feat", "gaps", f"SELECT {_sel(SOURCE_COLUMNS, FEATURE_DOUBLES)} FROM feat"))
register("silver_nulls", lambda s, sf: silver(s, sf, "gaps"), O.with_layers("silver", "gaps", "SELECT * FROM silver"))
register("gold_nulls", lambda s, sf: gold_nots(s, sf, "gaps"), O.with_layers("gold", "gaps", "SELECT * FROM gold"))
register("features", _features_rounded("event"),
         O.with_layers("feat", "event", f"SELECT {_sel(SOURCE_COLUMNS, FEATURE_DOUBLES)} FROM feat"))
register("silver", lambda s, sf: silver(s, sf, "line"), O.with_layers("silver", "line", "SELECT * FROM silver"))
register("silver_event", lambda s, sf: silver(s, sf, "event"), O.with_layers("silver", "event", "SELECT * FROM silver"))
register("gold", lambda s, sf: gold_nots(s, sf, "line"), O.with_layers("gold", "line", "SELECT * FROM gold"))
register("gold_event", lambda s, sf: gold_nots(s, sf, "event"), O.with_layers("gold", "event", "SELECT * FROM gold"))
register("analysis_view", lambda s, sf: av(s, sf, "line").drop("gold_processed_timestamp"),
         O.with_layers("av", "line", "SELECT * FROM av"))
register("analysis_view_event", lambda s, sf: av(s, sf, "event").drop("gold_processed_timestamp"),
         O.with_layers("av", "event", "SELECT * FROM av"))
register("analysis_deciles", lambda s, sf: avd(s, sf, "line").drop("gold_processed_timestamp"),
         O.with_layers("avd", "line", "SELECT * FROM avd"))


def materialize_layers(spark, sf):
    """bronze -> silver -> gold as stored tables; each layer reads the
    previous stored table (what the declared pipeline tables do).  Bronze is
    a projection of the table that ``features`` stores."""
    root = table_path(spark, "layers")
    b = layers.features(materialize(base(spark, sf, "line"), f"{root}/source"), stored=True)
    s = materialize(layers.silver(b), f"{root}/silver")
    return materialize(layers.gold(s), f"{root}/gold").drop("gold_processed_timestamp")


register("materialize_layers", materialize_layers, O.with_layers("gold", "line", "SELECT * FROM gold"))

_TS_OPTS = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def export_csv(spark, sf):
    df = av(spark, sf, "event").drop("gold_processed_timestamp")
    path = table_path(spark, "csv")
    write_csv(df, path, **_TS_OPTS)
    return read_back(spark, path, "csv", df.schema, **_TS_OPTS)


def export_parquet(spark, sf):
    df = av(spark, sf, "line").drop("gold_processed_timestamp")
    path = table_path(spark, "parquet")
    write_parquet(df, path)
    return read_back(spark, path)


register("export_csv", export_csv, O.with_layers("av", "event", "SELECT * FROM av"))
register("export_parquet", export_parquet, O.with_layers("av", "line", "SELECT * FROM av"))

# --------------------------------------------------------------------------
# B: cleaning
# --------------------------------------------------------------------------

BASE_COLS = layers.BASE_COLUMNS
register("null_fill_constant",
         lambda s, sf: fill_null_constant(base(s, sf, "event"), "fraud_technique", "unknown"),
         O.with_layers("base", "event", "SELECT " + ", ".join(
             "COALESCE(fraud_technique, 'unknown') AS fraud_technique" if c == "fraud_technique" else O.q(c)
             for c in BASE_COLS) + " FROM base"))

_ENC_EXCLUDE = [*SILVER_UNSCALED, "fraud_technique"]
_ENCODED = [c for c in BASE_COLS if c not in _ENC_EXCLUDE]
register("fixed_point_encode",
         lambda s, sf: fixed_point_encode(base(s, sf, "line"), _ENC_EXCLUDE),
         O.with_layers("base", "line", "SELECT " + ", ".join(
             f"{O._enc(c)} AS {O.q(c)}" if c in _ENCODED else O.q(c) for c in BASE_COLS) + " FROM base"))
register("fixed_point_decode",
         lambda s, sf: fixed_point_decode(fixed_point_encode(base(s, sf, "line"), _ENC_EXCLUDE), _ENCODED),
         O.with_layers("base", "line", "SELECT " + ", ".join(
             f"CAST({O._enc(c)} AS DOUBLE) / {O.d(100.0)} AS {O.q(c)}" if c in _ENCODED else O.q(c)
             for c in BASE_COLS) + " FROM base"))

_DROPPED = ANALYSIS_DROP_FIRST + ANALYSIS_DROP_SECOND
register("drop_columns",
         lambda s, sf: drop_columns(gold_nots(s, sf, "line"), _DROPPED),
         O.with_layers("gold", "line", "SELECT " + ", ".join(
             O.q(c) for c in O.GOLD_COLUMNS_NO_TS if c not in _DROPPED) + " FROM gold"))
register("dedup_full_row",
         lambda s, sf: dedup_full_row(testdata.event_type_pairs(s, sf), row_fingerprint),
         "SELECT DISTINCT event_type, user_id FROM events")
register("reorder_columns",
         lambda s, sf: reorder_columns(base(s, sf, "line"), GOLD_LEADING),
         O.with_layers("base", "line", "SELECT " + ", ".join(
             O.q(c) for c in [c for c in GOLD_LEADING if c in BASE_COLS] + [c for c in BASE_COLS if c not in GOLD_LEADING])
             + " FROM base"))

_DOC_NUM = ["n_chars", "quality", "toxic"]
register("impute_median",
         lambda s, sf: impute_median(testdata.doc_label_nulls(s, sf), _DOC_NUM),
         f"WITH x AS ({O.DOC_LABEL_NULLS}), m AS (SELECT "
         + ", ".join(f"quantile_disc({c}, 0.5) AS m_{c}" for c in _DOC_NUM)
         + " FROM x) SELECT doc_id, lang, source, "
         + ", ".join(f"COALESCE({c}, CAST(m_{c} AS {'BIGINT' if c == 'n_chars' else 'INTEGER'})) AS {c}" for c in _DOC_NUM)
         + " FROM x, m")
register("impute_mode",
         lambda s, sf: impute_mode(testdata.doc_label_nulls(s, sf), ["quality", "toxic"]),
         f"WITH x AS ({O.DOC_LABEL_NULLS}), m AS (SELECT "
         + ", ".join(f"(SELECT {c} FROM x WHERE {c} IS NOT NULL GROUP BY {c} ORDER BY COUNT(*) DESC, CAST({c} AS VARCHAR) LIMIT 1) AS m_{c}"
                     for c in ["quality", "toxic"])
         + ") SELECT doc_id, lang, source, n_chars, COALESCE(quality, m_quality) AS quality, COALESCE(toxic, m_toxic) AS toxic FROM x, m")
register("audit_columns",
         lambda s, sf: gold(s, sf, "line").groupBy("data_quality_score").agg(
             F.count(F.lit(1)).alias("n"), F.count("gold_processed_timestamp").alias("n_stamped")),
         O.with_layers("gold", "line", "SELECT data_quality_score, COUNT(*) AS n, COUNT(*) AS n_stamped FROM gold GROUP BY 1"))

# --------------------------------------------------------------------------
# C: derived columns
# --------------------------------------------------------------------------


def _cols(layer, src, cols, doubles=()):
    def run(spark, sf):
        df = VIEW[layer](spark, sf, src)
        return df.select(*[rnd(c) if c in doubles else F.col(c) for c in cols])
    return run, O.with_layers(layer, src, f"SELECT {_sel(cols, doubles)} FROM {layer}")


for key, layer, src, cols, dbl in [
    ("risk_category", "gold", "line", ["composite_risk", "risk_category"], ()),
    ("is_fraudulent", "gold", "line", ["is_fraud", "is_fraudulent"], ()),
    ("hour_category", "gold", "event", ["hour", "transaction_hour_category"], ()),
    ("amount_category", "gold", "line", ["amount", "amount_category"], ()),
    ("time_bucket", "av", "event", ["hour", "time_bucket"], ()),
    ("month_category", "av", "line", ["day", "month_category"], ()),
    ("season", "av", "line", ["month", "season"], ()),
    ("day_classification", "av", "line", ["timestamp", "DayClassification"], ()),
    ("date_parts", "av", "event", ["timestamp", "year", "day", "hour", "time"], ()),
    ("date_names", "av", "line", ["timestamp", "month", "day_of_week"], ()),
    ("calendar_ints", "feat", "event", ["timestamp", "hour", "day_of_week", "month", "is_weekend", "is_peak_hour"], ()),
    ("cyclic_encoding", "gold", "event",
     ["hour", "day_of_week", "month", "hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin", "month_cos"], ()),
    ("amount_log", "gold", "line", ["amount", "amount_log"], ()),
    ("amount_rounded", "gold", "line", ["amount", "amount_rounded"], ()),
    ("amount_ratio", "gold", "line", ["customer_id", "amount", "amount_mean_total", "amount_vs_mean_ratio"], ()),
    ("velocity_score", "gold", "event",
     ["customer_id", "timestamp", "tx_count_24h", "amount_sum_24h", "amount_mean_total", "velocity_score"], ()),
    ("composite_risk", "gold", "event",
     ["merchant_risk_score", "amount_vs_mean_ratio", "velocity_score", "tx_count_24h", "composite_risk"], ()),
    ("tx_count_24h", "feat", "event", ["customer_id", "timestamp", "tx_count_24h", "amount_sum_24h"], ("amount_sum_24h",)),
    ("amount_sum_24h", "feat", "line", ["customer_id", "timestamp", "amount", "amount_sum_24h"],
     ("amount", "amount_sum_24h")),
    ("amount_stats_7d", "feat", "event", ["customer_id", "timestamp", "amount_mean_7d", "amount_std_7d"],
     ("amount_mean_7d", "amount_std_7d")),
    ("customer_totals", "feat", "line", ["customer_id", "tx_count_total", "amount_mean_total", "amount_std_total"],
     ("amount_std_total",)),
    ("customer_diversity", "feat", "line", ["customer_id", "channel_diversity", "location_diversity"], ()),
    ("online_ratio", "feat", "line", ["customer_id", "online_channel_ratio"], ("online_channel_ratio",)),
]:
    register(key, *_cols(layer, src, cols, dbl))


def _window_nulls(method):
    def run(spark, sf):
        out = method(base(spark, sf, "gaps").select(*BASE_COLS))
        return out.select("transaction_id", "customer_id", nan_to_null(F.col("amount")).alias("amount"), "tx_count_24h",
                          rnd("amount_sum_24h"), rnd("amount_mean_7d"), rnd("amount_std_7d"))
    return run


for _key, _method in [("window_nulls", windows.range_window_features),
                      ("window_nulls_prefix", windows.range_window_features_prefix)]:
    register(_key, _window_nulls(_method), O.with_layers(
        "feat", "gaps", "SELECT transaction_id, customer_id, amount, tx_count_24h,"
        f" {sql_rnd('amount_sum_24h')}, {sql_rnd('amount_mean_7d')}, {sql_rnd('amount_std_7d')} FROM w"))


def window_prefix_q(spark, sf):
    """Prefix-sum window method on the line source."""
    out = windows.range_window_features_prefix(base(spark, sf, "line").select(*BASE_COLS))
    return out.select("customer_id", "timestamp", "amount", "tx_count_24h", "amount_sum_24h", "amount_mean_7d",
                      rnd("amount_std_7d"))


register("window_features_prefix", window_prefix_q, O.with_layers(
    "feat", "line", "SELECT customer_id, \"timestamp\", amount, tx_count_24h, amount_sum_24h, amount_mean_7d,"
    f" {sql_rnd('amount_std_7d')} FROM w"))


def parse_timestamp_q(spark, sf):
    b = base(spark, sf, "event")
    text = F.date_format(F.col("timestamp"), calendar.TIMESTAMP_FORMAT)
    t = b.select("transaction_id", text.alias("timestamp_text"))
    return t.select("transaction_id", "timestamp_text",
                    calendar.parse_timestamp(F.col("timestamp_text"), t.schema["timestamp_text"].dataType)
                    .cast("timestamp_ntz").alias("parsed"))


register("parse_timestamp", parse_timestamp_q, O.with_layers(
    "base", "event",
    "SELECT transaction_id, strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S') AS timestamp_text,"
    " strptime(strftime(\"timestamp\", '%Y-%m-%d %H:%M:%S'), '%Y-%m-%d %H:%M:%S') AS parsed FROM base"))


def format_percent_q(spark, sf):
    r = rates.rate_by(av(spark, sf, "line"), ["channel"], order="none")
    return r.select("channel", F.format_string("%.2f%%", F.round("fraud_rate", 2)).alias("fraud_rate_text"))


register("format_percent", format_percent_q, O.with_layers(
    "av", "line",
    "SELECT channel, printf('%.2f%%', round(avg(CAST(is_fraud AS DOUBLE)) * 100.0, 2)) AS fraud_rate_text"
    " FROM av WHERE channel IS NOT NULL GROUP BY channel"))

# --------------------------------------------------------------------------
# D2-D4: counts and rates
# --------------------------------------------------------------------------


def _where_keys(keys):
    return " AND ".join(f"{O.q(k)} IS NOT NULL" for k in keys)


def _fixed_mean_sql(x: str, fp: int = 100) -> str:
    units = f"CAST(round(CAST({x} AS DOUBLE) * {O.d(fp)}) AS BIGINT)"
    return f"CAST(SUM({units}) AS DOUBLE) / COUNT({units}) / {O.d(fp)}"


def rate_query(layer, src, keys, value=LABEL, scale=100.0, alias="fraud_rate", order="key", rounded=False,
               fixed_point=None):
    def run(spark, sf):
        df = VIEW[layer](spark, sf, src)
        okeys = None
        if order == "key" and "month" in keys and layer in ("av", "avd"):
            okeys = [calendar.month_num_of_name(F.col(k)) if k == "month" else F.col(k) for k in keys]
        out = rates.rate_by(df, keys, value, scale, alias, order, okeys, fixed_point=fixed_point)
        return out.select(*keys, rnd(alias)) if rounded else out
    k = ", ".join(O.q(x) for x in keys)
    mean = _fixed_mean_sql(O.q(value), fixed_point) if fixed_point else f"avg(CAST({O.q(value)} AS DOUBLE))"
    expr = mean + (f" * {O.d(scale)}" if scale != 1 else "")
    if rounded:
        expr = f"(round({expr}, {ROUND}) + 0.0)"
    sql = O.with_layers(layer, src, f"SELECT {k}, {expr} AS {alias} FROM {layer} WHERE {_where_keys(keys)} GROUP BY {k}")
    return run, sql


def count_query(layer, src, keys, alias="count", where=None):
    def run(spark, sf):
        df = VIEW[layer](spark, sf, src)
        if where is not None:
            df = df.where(F.col(where[0]) == where[1])
        return rates.count_by(df, keys, alias)
    k = ", ".join(O.q(x) for x in keys)
    cond = _where_keys(keys) + (f" AND {O.q(where[0])} = {where[1]}" if where else "")
    sql = O.with_layers(layer, src, f"SELECT {k}, COUNT(*) AS {O.q(alias)} FROM {layer} WHERE {cond} GROUP BY {k}")
    return run, sql


for key, layer, src, keys in [
    ("count_by_season", "av", "line", ["season"]),
    ("count_by_time_bucket", "av", "event", ["time_bucket"]),
    ("count_by_month_category", "av", "line", ["month_category"]),
    ("volume_by_season_month", "av", "line", ["season", "month"]),
    ("count_by_channel", "av", "line", ["channel"]),
    ("count_by_bank", "av", "line", ["bank"]),
    ("value_counts_label", "gold", "line", [LABEL]),
]:
    register(key, *count_query(layer, src, keys))
register("fraud_funnel", *count_query("av", "line", ["channel"], "fraud_transactions", where=(LABEL, 1)))

register("label_counts", lambda s, sf: rates.label_counts(av(s, sf, "line")), O.with_layers(
    "av", "line",
    f"SELECT {LABEL}, COUNT(*) AS \"count\", COUNT(*) * {O.d(100.0)} / SUM(COUNT(*)) OVER () AS percent"
    f" FROM av WHERE {LABEL} IS NOT NULL GROUP BY {LABEL}"))
register("daily_volume", lambda s, sf: rates.daily_volume(av(s, sf, "line")), O.with_layers(
    "av", "line",
    "SELECT CAST(\"timestamp\" AS DATE) AS date, COUNT(*) AS transaction_count FROM av"
    " WHERE \"timestamp\" IS NOT NULL GROUP BY 1"))

RATE_REPORTS = [
    # key, layer, source, keys, extra kwargs
    ("rate_by_channel", "av", "line", ["channel"], {"order": "desc"}),
    ("rate_by_channel_event", "av", "event", ["channel"], {"order": "desc"}),
    ("rate_by_merchant", "av", "line", ["merchant_category"], {"order": "desc"}),
    ("rate_by_bank", "av", "line", ["bank"], {"order": "desc"}),
    ("rate_by_location", "av", "line", ["location"], {"order": "desc"}),
    ("rate_by_age", "av", "line", ["age_group"], {}),
    ("rate_by_hour", "av", "event", ["hour"], {}),
    ("rate_by_dow", "av", "line", ["day_of_week"], {}),
    ("rate_by_dow_event", "av", "event", ["day_of_week"], {}),
    ("rate_by_month", "av", "line", ["month"], {}),
    ("rate_by_season", "av", "line", ["season"], {}),
    ("rate_by_velocity_decile", "avd", "line", ["velocity_decile"], {}),
    ("rate_by_risk_decile", "avd", "line", ["risk_decile"], {}),
    ("rate_by_amount_decile", "avd", "line", ["amount_decile"], {}),
    ("rate_by_merchant_score", "av", "line", ["merchant_risk_score"], {}),
    ("rate_by_composite", "av", "line", ["composite_risk"], {}),
    ("rate_by_day_class", "av", "line", ["DayClassification"], {}),
    ("rate_by_day_class_event", "av", "event", ["DayClassification"], {}),
    ("rate_by_customer", "gold", "line", ["customer_id"], {}),
    ("rate_by_hour_weekend", "av", "event", ["hour", "is_weekend"], {}),
    ("rate_by_age_channel", "av", "line", ["age_group", "channel"], {}),
    ("rate_by_bucket_channel", "av", "event", ["time_bucket", "channel"], {}),
    ("rate_by_season_decile", "avd", "line", ["season", "amount_decile"], {}),
    ("rate_by_month_bank", "av", "line", ["month", "bank"], {}),
    ("rate_by_month_channel", "av", "line", ["month", "channel"], {}),
    ("rate_by_hour_dow", "av", "event", ["hour", "day_of_week"], {}),
    ("rate_by_location_channel", "av", "line", ["location", "channel"], {}),
    ("rate_by_five_keys", "gold", "line", FIVE_KEYS, {"scale": 1.0, "order": "desc"}),
    ("mean_risk_by_customer", "gold", "line", ["customer_id"],
     {"value": "composite_risk", "scale": 1.0, "alias": "mean_composite_risk", "fixed_point": 100}),
    ("mean_log_by_velocity", "av", "line", ["velocity_score"],
     {"value": "amount_log", "scale": 1.0, "alias": "mean_amount_log", "fixed_point": 100}),
]
for seg in SEGMENTS:
    short = "merchant" if seg == "merchant_category" else seg
    RATE_REPORTS.append((f"rate_day_class_by_{short}", "av", "line", ["DayClassification", seg], {}))
    RATE_REPORTS.append((f"rate_time_bucket_by_{short}", "av", "line", ["time_bucket", seg], {}))

for key, layer, src, keys, kw in RATE_REPORTS:
    register(key, *rate_query(layer, src, keys, **kw))

register("fraud_rate_overall", lambda s, sf: profile.overall_rate(av(s, sf, "line"), LABEL), O.with_layers(
    "av", "line", f"SELECT avg(CAST({LABEL} AS DOUBLE)) * {O.d(100.0)} AS fraud_rate FROM av"))

# --------------------------------------------------------------------------
# D5: pivots
# --------------------------------------------------------------------------


# FIXED VALUES: the columns that the pivots always have (banks are nations, merchant categories are part types)
PIVOT_VALUES = {"bank": [f"NATION_{i}" for i in range(25)],
                "merchant_category": ["ECONOMY", "LARGE", "MEDIUM", "PROMO", "SMALL", "STANDARD"]}


def pivot_values(df, rows, cols):
    """The fixed columns, then those of all other values in the table."""
    fixed, bound = PIVOT_VALUES[cols], int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    other = df.where(F.col(rows).isNotNull() & ~F.col(cols).isin(fixed)).select(cols).distinct().limit(bound + 1).collect()
    if len(fixed) + len(other) > bound:
        raise ValueError(f"the pivot by {cols} has more than {bound} columns (spark.sql.pivotMaxValues)")
    return fixed + sorted(r[0] for r in other)


def pivot_query(src, rows, cols):
    def run(spark, sf):
        df = av(spark, sf, src)
        okeys = [calendar.month_num_of_name(F.col(rows))] if rows == "month" else None
        return rates.pivot_rate(df, rows, cols, values=pivot_values(df, rows, cols), order_keys=okeys)
    cells = ", ".join(
        f"COALESCE(AVG(CASE WHEN {O.q(cols)} = '{v}' THEN CAST({LABEL} AS DOUBLE) END) * {O.d(100.0)}, 0) AS {O.q(v)}"
        for v in PIVOT_VALUES[cols])
    sql = O.with_layers("av", src, f"SELECT {O.q(rows)}, {cells} FROM av WHERE {O.q(rows)} IS NOT NULL"
                                   f" AND {O.q(cols)} IS NOT NULL GROUP BY {O.q(rows)}")
    return run, sql


register("pivot_merchant_bank", *pivot_query("line", "merchant_category", "bank"))
register("pivot_location_merchant", *pivot_query("line", "location", "merchant_category"))
register("pivot_month_bank", *pivot_query("line", "month", "bank"))
register("grid_hour_dow", *rate_query("av", "event", ["hour", "day_of_week"], alias="fraud_rate"))

# --------------------------------------------------------------------------
# D1: profile and correlation
# --------------------------------------------------------------------------

register("table_shape", lambda s, sf: profile.table_shape(gold(s, sf, "line")), O.with_layers(
    "gold", "line", f"SELECT COUNT(*) AS n_rows, {len(O.GOLD_COLUMNS_NO_TS) + 1} AS n_cols FROM gold"))

GOLD_TYPES = {
    "transaction_id": "string", "customer_id": "bigint", "timestamp": "timestamp_ntz",
    "channel": "string", "merchant_category": "string", "bank": "string", "location": "string",
    "age_group": "string", "fraud_technique": "string", "is_weekend": "boolean", "is_peak_hour": "boolean",
    "amount_category": "string", "is_fraudulent": "boolean", "risk_category": "string",
    "transaction_hour_category": "string", "gold_processed_timestamp": "timestamp",
}
GOLD_ORDER = O.GOLD_COLUMNS_NO_TS[:-1] + ["gold_processed_timestamp", "data_quality_score"]


def _schema_sql():
    meta = ", ".join(f"({i}, '{c}', '{GOLD_TYPES.get(c, 'double')}')" for i, c in enumerate(GOLD_ORDER))
    counts = ", ".join(("COUNT(*)" if c == "gold_processed_timestamp" else f"COUNT({O.q(c)})") + f" AS {O.q(c)}"
                       for c in GOLD_ORDER)
    return O.with_layers(
        "gold", "line",
        f"SELECT m.position, m.\"column\", m.dtype, u.non_null FROM (VALUES {meta}) m(position, \"column\", dtype)"
        f" JOIN (UNPIVOT (SELECT {counts} FROM gold) ON COLUMNS(*) INTO NAME \"column\" VALUE non_null) u"
        f" ON m.\"column\" = u.\"column\"")


register("schema_profile", lambda s, sf: profile.schema_profile(gold(s, sf, "line")), _schema_sql())

_DOC_COLS = ["doc_id", "lang", "source", "n_chars", "quality", "toxic"]
_NULLS_SQL = (f"WITH x AS ({O.DOC_LABEL_NULLS}) SELECT \"column\", null_count FROM (UNPIVOT (SELECT "
              + ", ".join(f"CAST(COUNT_IF({c} IS NULL) AS BIGINT) AS {c}" for c in _DOC_COLS)
              + " FROM x) ON COLUMNS(*) INTO NAME \"column\" VALUE null_count)")
register("null_counts", lambda s, sf: profile.null_counts(testdata.doc_label_nulls(s, sf)), _NULLS_SQL)
register("null_total", lambda s, sf: profile.null_total(testdata.doc_label_nulls(s, sf)),
         f"WITH n AS ({_NULLS_SQL}) SELECT CAST(SUM(null_count) AS BIGINT) AS null_total FROM n")
register("null_counts_gold_event", lambda s, sf: profile.null_counts(gold_nots(s, sf, "event")), O.with_layers(
    "gold", "event",
    "SELECT \"column\", null_count FROM (UNPIVOT (SELECT "
    + ", ".join(f"CAST(COUNT_IF({O.q(c)} IS NULL{' OR isnan(' + O.q(c) + ')' if c not in GOLD_TYPES else ''}) AS BIGINT) AS {O.q(c)}"
                for c in O.GOLD_COLUMNS_NO_TS)
    + " FROM gold) ON COLUMNS(*) INTO NAME \"column\" VALUE null_count)"))
register("duplicate_count", lambda s, sf: profile.duplicate_count(testdata.event_type_pairs(s, sf)),
         "SELECT CAST(COALESCE(SUM(n - 1), 0) AS BIGINT) AS duplicate_rows FROM "
         "(SELECT event_type, user_id, COUNT(*) AS n FROM events GROUP BY ALL)")

DESCRIBE_COLS = GOLD_NUMERIC + ["data_quality_score"]
_DESC_STATS = ["mean", "std", "min", "p25", "p50", "p75", "max"]


def describe_q(spark, sf):
    out = profile.describe(gold(spark, sf, "line"), DESCRIBE_COLS)
    return out.select("column", "count", *[rnd(c) for c in _DESC_STATS])


def _describe_sql():
    parts = []
    for c in DESCRIBE_COLS:
        x = f"CAST({O.q(c)} AS DOUBLE)"
        parts.append(
            f"SELECT '{c}' AS \"column\", COUNT({x}) AS \"count\", (round(AVG({x}), {ROUND}) + 0.0) AS mean,"
            f" (round(STDDEV_SAMP({x}), {ROUND}) + 0.0) AS std, (round(MIN({x}), {ROUND}) + 0.0) AS \"min\","
            f" (round(quantile_cont({x}, 0.25), {ROUND}) + 0.0) AS p25, (round(quantile_cont({x}, 0.5), {ROUND}) + 0.0) AS p50,"
            f" (round(quantile_cont({x}, 0.75), {ROUND}) + 0.0) AS p75, (round(MAX({x}), {ROUND}) + 0.0) AS \"max\" FROM gold")
    return O.with_layers("gold", "line", " UNION ALL ".join(parts))


register("describe", describe_q, _describe_sql())
def _describe_dt_sql(layer, src, col):
    u = f"epoch_us({O.q(col)})"
    qs = ", ".join(f"make_timestamp(CAST(floor(quantile_cont(CAST({u} AS DOUBLE), {p})) AS BIGINT)) AS {n}"
                   for p, n in [(0.25, "p25"), (0.5, "p50"), (0.75, "p75")])
    return O.with_layers(layer, src, (
        f"SELECT '{col}' AS \"column\", COUNT({O.q(col)}) AS \"count\","
        f" make_timestamp(CAST(SUM(CAST({u} AS HUGEINT)) // COUNT({O.q(col)}) AS BIGINT)) AS mean,"
        f" MIN({O.q(col)}) AS \"min\", {qs}, MAX({O.q(col)}) AS \"max\" FROM {layer}"))


register("describe_datetime", lambda s, sf: profile.describe_datetime(gold(s, sf, "event"), ["timestamp"]),
         _describe_dt_sql("gold", "event", "timestamp"))
register("describe_datetime_line", lambda s, sf: profile.describe_datetime(gold(s, sf, "line"), ["timestamp"]),
         _describe_dt_sql("gold", "line", "timestamp"))
register("amount_quality", lambda s, sf: profile.amount_quality(gold(s, sf, "line")), O.with_layers(
    "gold", "line",
    f"SELECT MIN(amount) AS \"min\", MAX(amount) AS \"max\", CAST(COUNT_IF(amount < 0) AS BIGINT) AS negative,"
    f" COUNT_IF(amount < 0) * {O.d(100.0)} / COUNT(*) AS negative_pct FROM gold"))
register("time_range", lambda s, sf: profile.time_range(av(s, sf, "event")), O.with_layers(
    "av", "event", "SELECT MIN(\"time\") AS min_time, MAX(\"time\") AS max_time FROM av"))

_DV_SQL = " UNION ".join(
    f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS \"value\" FROM gold WHERE {c} IS NOT NULL"
    for c in DISTINCT_PROFILE_COLUMNS)
register("distinct_values", lambda s, sf: profile.distinct_values(gold(s, sf, "line"), DISTINCT_PROFILE_COLUMNS),
         O.with_layers("gold", "line", _DV_SQL))
register("distinct_cardinality",
         lambda s, sf: profile.distinct_cardinality(gold(s, sf, "line"), DISTINCT_PROFILE_COLUMNS),
         O.with_layers("gold", "line", f"SELECT \"column\", COUNT(*) AS n_distinct FROM ({_DV_SQL}) GROUP BY 1"))

AV_NUMERIC = ["amount", "is_fraud", "composite_risk", "hour", "online_channel_ratio", "amount_log",
              "velocity_score", "merchant_risk_score", "data_quality_score", "year", "day"]
RANK_FEATURES = ["amount", "is_fraudulent", "composite_risk", "hour", "is_weekend", "is_peak_hour",
                 "online_channel_ratio", "amount_log", "velocity_score", "merchant_risk_score",
                 "data_quality_score", "year", "day", "amount_decile"]


def _corr_sql(x: str, y: str) -> str:
    both = f"{x} IS NOT NULL AND {y} IS NOT NULL"
    return (f"COVAR_POP({x}, {y}) / NULLIF(STDDEV_POP(CASE WHEN {both} THEN {x} END)"
            f" * STDDEV_POP(CASE WHEN {both} THEN {y} END), 0)")


def corr_matrix_q(spark, sf):
    out = correlation.corr_matrix(av(spark, sf, "line"), AV_NUMERIC)
    return out.select("col1", "col2", rnd("corr"))


def _corr_matrix_sql():
    prep = ", ".join(f"CAST({O.q(c)} AS DOUBLE) AS {O.q(c)}" for c in AV_NUMERIC)
    parts = []
    for i, a in enumerate(AV_NUMERIC):
        for b in AV_NUMERIC[i:]:
            e = f"(round({_corr_sql(O.q(a), O.q(b))}, {ROUND}) + 0.0)"
            parts.append(f"SELECT '{a}' AS col1, '{b}' AS col2, {e} AS corr FROM p")
            if a != b:
                parts.append(f"SELECT '{b}' AS col1, '{a}' AS col2, {e} AS corr FROM p")
    return O.with_layers("av", "line", " UNION ALL ".join(parts), [("p", f"SELECT {prep} FROM av")])


register("corr_matrix", corr_matrix_q, _corr_matrix_sql())


def corr_with_label_q(spark, sf):
    df = av(spark, sf, "line").select(*AV_NUMERIC)
    return correlation.corr_with_label(df, LABEL).select("feature", rnd("correlation"))


def _corr_label_sql(layer, feats, top=None, absval=False):
    prep = ", ".join(f"CAST({O.q(c)} AS DOUBLE) AS {O.q(c)}" for c in [LABEL, *feats])
    parts = []
    for f in feats:
        e = _corr_sql(O.q(f), LABEL)
        e = f"(round(abs({e}), {ROUND}) + 0.0) AS abs_correlation" if absval else f"(round({e}, {ROUND}) + 0.0) AS correlation"
        parts.append(f"SELECT '{f}' AS feature, {e} FROM p")
    body = " UNION ALL ".join(parts)
    if top:
        body = f"SELECT * FROM ({body}) ORDER BY abs_correlation DESC NULLS LAST, feature LIMIT {top}"
    return O.with_layers(layer, "line", body, [("p", f"SELECT {prep} FROM {layer}")])


register("corr_with_label", corr_with_label_q, _corr_label_sql("av", [c for c in AV_NUMERIC if c != LABEL]))


def corr_rank_abs_q(spark, sf):
    df = avd(spark, sf, "line").select(LABEL, *RANK_FEATURES)
    return correlation.corr_rank_abs(df, LABEL, CORR_TOP_K).select("feature", rnd("abs_correlation"))


register("corr_rank_abs", corr_rank_abs_q, _corr_label_sql("avd", RANK_FEATURES, CORR_TOP_K, True))

# --------------------------------------------------------------------------
# E: quantile bins (as columns)
# --------------------------------------------------------------------------

for key, col_in, col_out in [("velocity_decile", "velocity_score", "velocity_decile"),
                             ("risk_decile", "composite_risk", "risk_decile"),
                             ("amount_decile", "amount", "amount_decile")]:
    register(key, *_cols("avd", "line", [col_in, col_out]))
register("velocity_decile_event", *_cols("avd", "event", ["velocity_score", "velocity_decile"]))

# --------------------------------------------------------------------------
# D6, D7: distributions and samples
# --------------------------------------------------------------------------

_HIST_OUT = ["bin", "bin_lo", "bin_hi", "count", "density"]


def hist_query(layer, src, column, nbins, by=None, pre=None, pre_sql=None):
    def run(spark, sf):
        df = VIEW[layer](spark, sf, src)
        if pre is not None:
            df = pre(df)
        out = distribution.histogram(df, column, nbins, by)
        return out.select(*([by] if by else []), "bin", rnd("bin_lo"), rnd("bin_hi"), "count", rnd("density"))
    by_sel = f"{by}, " if by else ""
    by_where = f" AND {by} IS NOT NULL" if by else ""
    src_sql = pre_sql or f"SELECT {by_sel}CAST({O.q(column)} AS DOUBLE) AS _x FROM {layer}"
    w = "CASE WHEN _hi > _lo THEN (_hi - _lo) / " + O.d(nbins) + " ELSE " + O.d(1.0) + " END"
    b = (f"CAST(CASE WHEN _hi > _lo THEN least(floor((_x - _lo) / (_hi - _lo) * {nbins}), {nbins - 1}) ELSE 0 END AS INTEGER)")
    sql = O.with_layers(layer, src, f"""
SELECT {by_sel}bin, (round(_lo + bin * _w, {ROUND}) + 0.0) AS bin_lo, (round(_lo + (bin + 1) * _w, {ROUND}) + 0.0) AS bin_hi,
       COUNT(*) AS "count", (round(COUNT(*) / _w, {ROUND}) + 0.0) AS density
FROM (SELECT {by_sel}{b} AS bin, _lo, {w} AS _w FROM hx, (SELECT MIN(_x) AS _lo, MAX(_x) AS _hi FROM hx))
GROUP BY {by_sel}bin, _lo, _w
""", [("hsrc", src_sql), ("hx", f"SELECT * FROM hsrc WHERE _x IS NOT NULL AND NOT isnan(_x){by_where}")])
    return run, sql


register("hist_amount_by_label", *hist_query("av", "line", "amount", 50, LABEL))
register("hist_amount_log", *hist_query("av", "line", "amount_log", 50))
register("hist_amount_log_by_label", *hist_query("av", "line", "amount_log", 20, LABEL))
register("hist_velocity_by_label", *hist_query("av", "line", "velocity_score", 50, LABEL))
register("hist_merchant_risk_by_label", *hist_query("av", "line", "merchant_risk_score", 50, LABEL))
register("hist_composite_by_label", *hist_query("av", "line", "composite_risk", 50, LABEL))
register("hist_ratio_by_label", *hist_query("gold", "line", "amount_vs_mean_ratio", 50, LABEL))
register("hist_customer_risk", *hist_query(
    "gold", "line", "composite_risk", 30,
    pre=lambda g: g.groupBy("customer_id").agg(rates.fixed_mean(F.col("composite_risk"), 100).alias("composite_risk")),
    pre_sql=f"SELECT {_fixed_mean_sql('composite_risk')} AS _x FROM gold GROUP BY customer_id"))
register("hist_customer_rate", *hist_query(
    "gold", "line", "is_fraud", 30,
    pre=lambda g: g.groupBy("customer_id").agg((F.avg("is_fraud") * F.lit(100.0)).alias("is_fraud")),
    pre_sql=f"SELECT AVG(is_fraud) * {O.d(100.0)} AS _x FROM gold GROUP BY customer_id"))

_BOX_OUT = ["q1", "median", "q3", "iqr", "lower_fence", "upper_fence", "whisker_low", "whisker_high"]


def box_query(column, src="line"):
    def run(spark, sf):
        out = distribution.box_stats(av(spark, sf, src), column, LABEL)
        return out.select(LABEL, *[rnd(c) for c in _BOX_OUT], "n_outliers", rnd("min"), rnd("max"), "n")
    x = f"CAST({O.q(column)} AS DOUBLE)"
    st = (f"SELECT {LABEL}, quantile_cont(_x, 0.25) AS q1, quantile_cont(_x, 0.5) AS median, quantile_cont(_x, 0.75) AS q3"
          f" FROM bx GROUP BY {LABEL}")
    fen = "SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM bst"
    sql = O.with_layers("av", src, f"""
SELECT f.{LABEL}, {', '.join(f'(round(f.{c}, {ROUND}) + 0.0) AS {c}' for c in _BOX_OUT[:6])},
       (round(MIN(CASE WHEN _x >= lower_fence AND _x <= upper_fence THEN _x END), {ROUND}) + 0.0) AS whisker_low,
       (round(MAX(CASE WHEN _x >= lower_fence AND _x <= upper_fence THEN _x END), {ROUND}) + 0.0) AS whisker_high,
       CAST(COUNT_IF(NOT (_x >= lower_fence AND _x <= upper_fence)) AS BIGINT) AS n_outliers,
       (round(MIN(_x), {ROUND}) + 0.0) AS "min", (round(MAX(_x), {ROUND}) + 0.0) AS "max", COUNT(*) AS n
FROM bx JOIN fen f ON bx.{LABEL} = f.{LABEL}
GROUP BY ALL
""", [("bx", f"SELECT {LABEL}, {x} AS _x FROM av WHERE {LABEL} IS NOT NULL AND {x} IS NOT NULL AND NOT isnan({x})"),
      ("bst", st), ("fen", fen)])
    return run, sql


for c in BOX_FEATURES:
    short = {"amount": "amount", "velocity_score": "velocity", "merchant_risk_score": "merchant_risk",
             "composite_risk": "composite"}[c]
    register(f"box_{short}", *box_query(c))


def box_outliers_q(spark, sf):
    return distribution.box_outliers(av(spark, sf, "line"), "amount", LABEL)


register("box_outliers_amount", box_outliers_q, O.with_layers("av", "line", f"""
SELECT bx.{LABEL}, bx.amount FROM bx JOIN fen f ON bx.{LABEL} = f.{LABEL}
WHERE bx.amount < f.lower_fence OR bx.amount > f.upper_fence
""", [("bx", f"SELECT {LABEL}, CAST(amount AS DOUBLE) AS amount FROM av WHERE {LABEL} IS NOT NULL AND amount IS NOT NULL"),
      ("bst", f"SELECT {LABEL}, quantile_cont(amount, 0.25) AS q1, quantile_cont(amount, 0.75) AS q3 FROM bx GROUP BY {LABEL}"),
      ("fen", "SELECT *, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM bst")]))

KDE_POINTS = 64


def kde_q(spark, sf):
    out = distribution.kde(av(spark, sf, "line"), "velocity_score", LABEL, KDE_POINTS)
    return out.select(LABEL, "point", rnd("x"), rnd("density"))


_KDE_SQL = O.with_layers("av", "line", f"""
SELECT {LABEL}, point,
       (round(_lo + point * (_hi - _lo) / {O.d(KDE_POINTS - 1)}, {ROUND}) + 0.0) AS x,
       (round(_s * {O.d(1.0 / (2.0 * 3.141592653589793) ** 0.5)} / (_n * _h), {ROUND}) + 0.0) AS density
FROM (
  SELECT v.{LABEL}, g.point, s._lo, s._hi, s._n, s._h,
         SUM(v._c * exp(-0.5 * ((s._lo + g.point * ((s._hi - s._lo) / {O.d(KDE_POINTS - 1)}) - v._x) / s._h)
                             * ((s._lo + g.point * ((s._hi - s._lo) / {O.d(KDE_POINTS - 1)}) - v._x) / s._h))) AS _s
  FROM kv v JOIN ks s ON v.{LABEL} = s.{LABEL} CROSS JOIN (SELECT CAST(range AS INTEGER) AS point FROM range({KDE_POINTS})) g
  GROUP BY v.{LABEL}, g.point, s._lo, s._hi, s._n, s._h
)
""", [("kx", f"SELECT {LABEL}, CAST(velocity_score AS DOUBLE) AS _x FROM av WHERE {LABEL} IS NOT NULL AND velocity_score IS NOT NULL"),
      ("ks0", f"SELECT {LABEL}, MIN(_x) AS _lo, MAX(_x) AS _hi, STDDEV_SAMP(_x) AS _sd, COUNT(*) AS _n FROM kx GROUP BY {LABEL}"),
      ("ks", f"SELECT {LABEL}, _lo, _hi, _n, CASE WHEN 1.06 * _sd * pow(CAST(_n AS DOUBLE), -0.2) > 0"
             f" THEN 1.06 * _sd * pow(CAST(_n AS DOUBLE), -0.2) ELSE 1.0 END AS _h FROM ks0"),
      ("kv", f"SELECT {LABEL}, _x, COUNT(*) AS _c FROM kx GROUP BY ALL")])
register("kde_velocity_by_label", kde_q, _KDE_SQL)

register("scatter_sample", lambda s, sf: layers.analysis_view(distribution.sample_rows(gold(s, sf, "line"), SCATTER_SAMPLE_CAP, 42)).drop("gold_processed_timestamp"),
         O.with_layers("av", "line", "SELECT * FROM av").replace(
             "\nFROM gold", f"\nFROM (SELECT * FROM gold ORDER BY md5('42/' || coalesce(transaction_id, '')) LIMIT {SCATTER_SAMPLE_CAP})"))
_PAIR_COLS = [*PAIRPLOT_FEATURES, LABEL]
register("pairplot_points", lambda s, sf: av(s, sf, "line").select(*_PAIR_COLS),
         O.with_layers("av", "line", f"SELECT {_sel(_PAIR_COLS)} FROM av"))
register("rug_velocity", lambda s, sf: av(s, sf, "line").select(LABEL, "velocity_score").where("velocity_score is not null"),
         O.with_layers("av", "line", f"SELECT {LABEL}, velocity_score FROM av WHERE velocity_score IS NOT NULL"))

# --------------------------------------------------------------------------
# F: head rows
# --------------------------------------------------------------------------

register("head_rows", lambda s, sf: gold_nots(s, sf, "event").orderBy("transaction_id").limit(5), O.with_layers(
    "gold", "event", "SELECT * FROM gold ORDER BY transaction_id LIMIT 5"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: v.run for k, v in REGISTRY.items()}


def oracle_sql() -> dict[str, str]:
    return {k: v.sql for k, v in REGISTRY.items() if v.sql is not None}
