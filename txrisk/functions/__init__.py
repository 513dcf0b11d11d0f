"""Column expressions (pure ``Column -> Column`` builders, all JVM-side)."""

from txrisk.functions.bins import (  # noqa: F401
    amount_category, day_classification, hour_category, is_fraudulent,
    month_category, risk_category, season, time_bucket,
)
from txrisk.functions.calendar import (  # noqa: F401
    calendar_ints, day_name, epoch_micros, is_peak_hour, is_weekend,
    month_name, month_num_of_name, parse_timestamp, time_of_day,
)
from txrisk.functions.fixedpoint import decode, encode, nan_to_null  # noqa: F401
from txrisk.functions.numeric import (  # noqa: F401
    amount_log, amount_rounded, cents, cyclic, velocity_score,
)
