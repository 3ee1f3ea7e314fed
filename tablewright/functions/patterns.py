"""Fixed values shared by every operator and by the SQL oracle.

These are stated once, in natural order, and used as-is. They describe
pandas ``read_csv`` defaults (public library behaviour) that the
inference must reproduce, and the key-value type tags of the load target.
"""

# --- fixed values: pandas default missing-cell tokens (``None`` left out,
# --- it is text in pandas 1.x; pass ``na_tokens`` to change the list) ----
NA_TOKENS = (
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "n/a",
    "nan",
    "null",
)

# --- fixed values: cell patterns (full match; blanks and tabs around numbers
# --- are allowed, none around booleans) ------------------------------------
INT_PATTERN = r"[ \t]*[+-]?[0-9]+[ \t]*"
FLOAT_PATTERN = (
    r"[ \t]*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|(?i:inf(inity)?))[ \t]*"
)
BOOL_PATTERN = r"(True|TRUE|true|False|FALSE|false)"

# --- fixed values: inferred dtype -> type tag -------------------------------
TYPE_TAGS = {
    "object": "S",
    "int64": "N",
    "float64": "N",
    "datetime64": "S",
    "bool": "BOOL",
}
# Our addition: unsigned 64-bit integers also load as numbers.
EXTRA_TYPE_TAGS = {"uint64": "N"}

# --- fixed values: integer bounds and exact-double limit --------------------
INT64_MIN = -9223372036854775808
INT64_MAX = 9223372036854775807
UINT64_MAX = 18446744073709551615
EXACT_DOUBLE_INT = 9007199254740992  # 2**53

# --- fixed values: profile sidecar column names -----------------------------
META_COLUMNS = (
    "column_name",
    "AWS_column_dtype",
    "pandas_column_dtype",
    "example_item_list",
    "mixed_datatype_flag_list",
    "missing_data_flag_list",
    "duplicate_data_flag_list",
)

# --- fixed values: key warning names, in report order -----------------------
KEY_FLAG_NAMES = ("mixed_datatype_flag", "missing_data_flag", "duplicate_data_flag")

# --- fixed values: multi-part file naming -----------------------------------
SPLIT_SUFFIX_PATTERN = r"(_split__[0-9]{3,})?\.csv$"
SPLIT_NAME_FORMAT = "%s_split__%03d.csv"
METADATA_PREFIX = "metadata_"
TABLE_NAME_PATTERN = r"^[A-Za-z0-9_.-]{3,255}$"
DEFAULT_SPLIT_THRESHOLD = 10000
ROW_KEY_NAME = "Row_Number"


def all_type_tags() -> dict:
    tags = dict(TYPE_TAGS)
    tags.update(EXTRA_TYPE_TAGS)
    return tags
