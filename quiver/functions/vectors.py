"""Vector text format ``SYM v1,v2,...`` (write and parse) and vectors inside Arrow batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, functions as F


def format_vector_line(symbol: Column | str, v: Column | str) -> Column:
    """``SYM v1,v2,...,vn``; doubles written with Spark's shortest round-trip text."""
    symbol = F.col(symbol) if isinstance(symbol, str) else symbol
    v = F.col(v) if isinstance(v, str) else v
    return F.concat(symbol, F.lit(" "), F.concat_ws(",", F.transform(v, lambda x: x.cast("string"))))


def parse_vector_line(line: Column | str) -> tuple[Column, Column]:
    """Split a vector line into (symbol, array<double>): name up to the first space."""
    line = F.col(line) if isinstance(line, str) else line
    symbol = F.substring_index(line, " ", 1)
    rest = F.substr(line, F.instr(line, " ") + 1)
    values = F.transform(F.split(rest, ","), lambda s: F.trim(s).cast("double"))
    return symbol, values


def arrow_matrix(column: pa.Array) -> np.ndarray:
    """A column of equally long lists as an (n x d) matrix; a null element becomes NaN."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64, copy=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def has_nan(v: Column | str) -> Column:
    """Whether a vector holds a NaN or null element, so that no distance to it is a number."""
    return F.exists(v, lambda x: x.isNull() | F.isnan(x))
