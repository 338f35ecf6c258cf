"""Column-level helpers (X1-X9): all built on pyspark.sql.functions, so they
stay inside whole-stage codegen."""

from tallystar.functions.strings import (  # noqa: F401
    decode_map,
    leading_int,
    replace_chain,
    safe_int,
    strict_int,
    strip_ws,
)
from tallystar.functions.paths import file_year, in_year  # noqa: F401
