"""Column lists and category labels of the transaction data model.

Everything below the FIXED VALUES marker must equal the specification the
engine reproduces (column dictionary, medallion layers and notebook); the
values are stated plainly, in their natural order.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the specification exactly)
# ---------------------------------------------------------------------------

# The 38 source columns in dictionary order.
SOURCE_COLUMNS = [
    "transaction_id", "customer_id", "timestamp", "amount", "channel",
    "merchant_category", "bank", "location", "age_group", "hour",
    "day_of_week", "month", "is_weekend", "is_peak_hour", "tx_count_24h",
    "amount_sum_24h", "amount_mean_7d", "amount_std_7d", "tx_count_total",
    "amount_mean_total", "amount_std_total", "channel_diversity",
    "location_diversity", "amount_vs_mean_ratio", "online_channel_ratio",
    "is_fraud", "fraud_technique", "hour_sin", "hour_cos", "day_sin",
    "day_cos", "month_sin", "month_cos", "amount_log", "amount_rounded",
    "velocity_score", "merchant_risk_score", "composite_risk",
]

# Column of values that did not fit the schema; silver drops it.
RESCUED_DATA = "_rescued_data"

# Silver keeps these columns as they are; every other column except
# fraud_technique and _rescued_data is stored as fixed point (x 100).
SILVER_UNSCALED = [
    "transaction_id", "customer_id", "channel", "merchant_category", "bank",
    "location", "age_group", "is_weekend", "is_peak_hour", "timestamp",
]

# Gold decodes and median-imputes these 27 numeric columns.
GOLD_NUMERIC = [
    "amount", "hour", "day_of_week", "month", "tx_count_24h",
    "amount_sum_24h", "amount_mean_7d", "amount_std_7d",
    "tx_count_total", "amount_mean_total", "amount_std_total",
    "channel_diversity", "location_diversity",
    "amount_vs_mean_ratio", "online_channel_ratio", "is_fraud",
    "hour_sin", "hour_cos", "day_sin", "day_cos", "month_sin",
    "month_cos", "amount_log", "amount_rounded",
    "velocity_score", "merchant_risk_score", "composite_risk",
]

# Gold's median imputation is approximate with this relative rank error.
MEDIAN_RELATIVE_ERROR = 0.01

# Gold mode-imputes these categorical columns; fallback when no value exists.
GOLD_CATEGORICAL = ["merchant_category", "bank", "location", "age_group"]
MODE_FALLBACK = "Unknown"

# Silver replaces a NULL fraud technique with this constant.
FRAUD_TECHNIQUE_FILL = "unknown"

# Leading gold columns, in order; the rest follow in their existing order.
GOLD_LEADING = [
    "transaction_id", "customer_id", "timestamp", "amount", "amount_category",
    "is_fraud", "is_fraudulent", "fraud_technique", "risk_category",
    "composite_risk", "channel", "merchant_category", "bank", "location",
    "age_group", "transaction_hour_category", "month", "hour", "day_of_week",
    "is_weekend", "is_peak_hour",
]

# Gold audit constant.
DATA_QUALITY_SCORE = 100.0

# Analysis view drops these gold columns (two passes in the notebook).
ANALYSIS_DROP_FIRST = [
    "fraud_technique", "tx_count_24h", "amount_sum_24h",
    "amount_mean_7d", "amount_std_7d", "tx_count_total",
    "amount_mean_total", "amount_std_total",
    "channel_diversity", "location_diversity",
    "hour_sin", "hour_cos", "day_sin", "day_cos",
    "month_sin", "month_cos", "amount_rounded",
]
ANALYSIS_DROP_SECOND = [
    "transaction_hour_category", "amount_vs_mean_ratio", "transaction_id",
    "customer_id",
]

# Online channels (Mobile + Web + ECOM) for online_channel_ratio.
ONLINE_CHANNELS = ["Mobile", "Web", "ECOM"]

# Banking peak hours: 10-11 AM and 2-4 PM.
PEAK_HOURS = [10, 11, 14, 15, 16]

# Composite risk weights: merchant risk, normalized amount ratio,
# normalized velocity, high-frequency indicator (tx_count_24h > 5).
COMPOSITE_WEIGHTS = (0.3, 0.3, 0.2, 0.2)
HIGH_FREQUENCY_COUNT = 5

# Calendar names (English, full).
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June", "July",
    "August", "September", "October", "November", "December",
]
DRY_SEASON_MONTHS = ["November", "December", "January", "February", "March"]
RAINY_SEASON_MONTHS = ["April", "May", "June", "July", "August", "September", "October"]

# Label columns used by the reports.
LABEL = "is_fraud"

# Notebook report inputs.
BOX_FEATURES = ["amount", "velocity_score", "merchant_risk_score", "composite_risk"]
PAIRPLOT_FEATURES = ["amount", "velocity_score", "merchant_risk_score", "composite_risk"]
DISTINCT_PROFILE_COLUMNS = ["bank", "merchant_category", "channel", "location", "age_group"]
FIVE_KEYS = ["channel", "bank", "merchant_category", "age_group", "location"]
SEGMENTS = ["bank", "location", "channel", "merchant_category"]
SCATTER_SAMPLE_CAP = 10000
CORR_TOP_K = 14
