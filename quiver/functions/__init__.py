"""Column-level building blocks (JVM-side expressions)."""

from quiver.functions.distance import mean_l1  # noqa: F401
from quiver.functions.scaling import minmax_scale  # noqa: F401
from quiver.functions.vectors import format_vector_line, parse_vector_line  # noqa: F401
from quiver.functions.ranking import global_row_number  # noqa: F401
