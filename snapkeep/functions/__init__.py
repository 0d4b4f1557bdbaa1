"""Column expressions: code prefixes, casts, JSON decoding, name helpers."""

from .casts import envelope_columns, to_date_column, with_date_from
from .codes import code_prefix, first_code, truncate_codes
from .json import parse_json, flatten_struct
from .naming import quote, lowercase_partitions, resolve_name

__all__ = [
    "envelope_columns", "to_date_column", "with_date_from",
    "code_prefix", "first_code", "truncate_codes",
    "parse_json", "flatten_struct",
    "quote", "lowercase_partitions", "resolve_name",
]
