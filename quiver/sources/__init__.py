"""Scans: symbol directory, price CSVs, vector text, canopy tables, cluster text,
plus adapters that derive bars / vectors / symbol lists from the test tables."""

from quiver.sources.files import (  # noqa: F401
    read_symbol_directory, read_price_csv, read_vector_text, read_canopies, read_cluster_text, read_assignments,
)
from quiver.sources.tables import (  # noqa: F401
    load_table, events_bars, lineitem_bars, embedding_vectors, customer_symbols,
)
