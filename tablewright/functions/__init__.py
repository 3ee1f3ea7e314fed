from .cells import (
    base_name,
    double_text,
    full_match,
    int_value,
    is_bool_text,
    is_float_text,
    is_int_text,
    is_missing,
    parse_collection,
    render_cell,
    table_name_of,
    type_tag,
    typed_key,
)
from .patterns import NA_TOKENS, TYPE_TAGS

__all__ = [
    "NA_TOKENS",
    "TYPE_TAGS",
    "base_name",
    "double_text",
    "full_match",
    "int_value",
    "is_bool_text",
    "is_float_text",
    "is_int_text",
    "is_missing",
    "parse_collection",
    "render_cell",
    "table_name_of",
    "type_tag",
    "typed_key",
]
