"""Writers for the pipeline's file formats (overwrite-before-write)."""

from quiver.sinks.files import (  # noqa: F401
    write_symbol_directory, write_price_csv, append_price_rows, write_vector_text, write_canopies,
    write_assignments, write_cluster_text, cluster_text_lines,
)
