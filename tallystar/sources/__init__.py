"""Scans (S1-S8) and sinks (K1-K3)."""

from tallystar.sources.readers import (  # noqa: F401
    list_inputs,
    read_csv_by_name,
    read_csv_exact,
    read_csv_strings,
    read_keyed_json,
    read_parquet,
    read_section_ranges,
    read_sections,
    with_file_year,
)
from tallystar.sources.sinks import write_by_year, write_csv  # noqa: F401
