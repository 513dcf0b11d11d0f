"""Layer plans and the query catalogue."""

from txrisk.plans.layers import analysis_view, features, gold, silver  # noqa: F401
