from loadwright.sources.csv import read_csv
from loadwright.sources.deliveries import (
    list_files, parse_delivery_names, plan_deliveries, plan_list, unprocessed_deliveries,
)
from loadwright.sources.textscan import (
    good_rows, line_counts, parse_delimited, parse_fixed_width, read_lines, skip_lines,
)

__all__ = [
    "read_csv", "list_files", "parse_delivery_names", "plan_deliveries", "plan_list",
    "unprocessed_deliveries", "good_rows", "line_counts", "parse_delimited",
    "parse_fixed_width", "read_lines", "skip_lines",
]
