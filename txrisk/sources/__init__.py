"""Sources (table scans, test-data adapters) and sinks."""

from txrisk.sources.sinks import materialize, read_back, write_csv, write_parquet  # noqa: F401
from txrisk.sources.tables import raw_transactions  # noqa: F401
from txrisk.sources.testdata import (  # noqa: F401
    doc_label_nulls, event_type_pairs, read_table, transactions, txn_event, txn_gaps, txn_line,
)
