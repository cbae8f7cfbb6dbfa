from loadwright.functions.keys import all_keys_present, any_key_null, parse_keys
from loadwright.functions.names import base_name, file_date_ts, name_field
from loadwright.functions.render import delimited_line, fixed_width_line
from loadwright.functions.tokens import as_struct, split_fields

__all__ = [
    "all_keys_present", "any_key_null", "parse_keys", "base_name", "file_date_ts",
    "name_field", "delimited_line", "fixed_width_line", "as_struct", "split_fields",
]
