"""Column expressions over text cells.

Every function here returns a ``Column`` built from Spark built-ins, so it
runs inside whole-stage codegen; none of them needs a Python UDF.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .patterns import (
    BOOL_PATTERN,
    EXACT_DOUBLE_INT,
    FLOAT_PATTERN,
    INT64_MAX,
    INT64_MIN,
    INT_PATTERN,
    NA_TOKENS,
    SPLIT_SUFFIX_PATTERN,
    UINT64_MAX,
    all_type_tags,
)


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def sql_string(s: str) -> str:
    """A Spark SQL string literal holding ``s`` exactly."""
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def full_match(col, pattern: str) -> Column:
    """Whole-string regex match (``rlike`` only searches)."""
    return _c(col).rlike("^(?:" + pattern + ")$")


def is_missing(col, na_tokens: Iterable[str] = NA_TOKENS) -> Column:
    """O-18: a cell is missing when null or equal to one of the NA tokens.

    Tokens are matched exactly, without trimming, as pandas does.
    """
    c = _c(col)
    tokens = list(na_tokens)
    if not tokens:
        return c.isNull()
    return c.isNull() | c.isin(tokens)


def is_int_text(col) -> Column:
    return full_match(col, INT_PATTERN)


def is_float_text(col) -> Column:
    """Integers, decimals, exponents and the infinities."""
    return full_match(col, FLOAT_PATTERN)


def is_bool_text(col) -> Column:
    return full_match(col, BOOL_PATTERN)


def stripped(col) -> Column:
    return F.btrim(_c(col), F.lit(" \t"))


# Every numeric cast below is guarded by its pattern: under ANSI mode a
# ``try_cast`` of non-numeric text is several times slower than the regex.


def int_value(col) -> Column:
    """Exact integer value of an integer cell (null above 38 digits)."""
    return F.when(is_int_text(col), stripped(col).try_cast("decimal(38,0)"))


def long_value(col) -> Column:
    """Integer value when it fits 64-bit signed (the fast, common path)."""
    return F.when(is_int_text(col), stripped(col).try_cast("bigint"))


def double_value(col) -> Column:
    """Double value of a number cell (integers, decimals, infinities)."""
    return F.when(is_float_text(col), stripped(col).try_cast("double"))


def is_inexact(col) -> Column:
    """An integer cell that a double would round (15 digits never are)."""
    c = _c(col)
    return F.when(F.char_length(c) > 15, F.coalesce(double_value(c).cast("decimal(38,0)") != int_value(c), F.lit(False))).otherwise(F.lit(False))


def int_text(col) -> Column:
    """Canonical text of an integer cell; decimals only beyond int64."""
    lv = long_value(col)
    return F.when(lv.isNotNull(), lv.cast("string")).otherwise(int_value(col).cast("string"))


def fits_int64(dec: Column) -> Column:
    return dec.between(F.lit(INT64_MIN).cast("decimal(38,0)"), F.lit(INT64_MAX).cast("decimal(38,0)"))


def fits_uint64(dec: Column) -> Column:
    return dec.between(F.lit(0).cast("decimal(38,0)"), F.lit(str(UINT64_MAX)).cast("decimal(38,0)"))


def double_text(d: Column) -> Column:
    """Text of a double: whole numbers within 2**53 print as integers."""
    whole = (F.abs(d) <= F.lit(float(EXACT_DOUBLE_INT))) & (d == F.floor(d))
    return F.when(whole, d.cast("bigint").cast("string")).otherwise(d.cast("string"))


def float_text(d: Column, text: Column | None = None) -> Column:
    """Text of a double as Python prints it: plain decimals from 1e-4 up to
    1e16, a two-digit exponent beyond. Spark's own text (``text``, where it is
    a column already) holds the same digits with an exponent from 1e7 on and
    below 1e-3."""
    text = d.cast("string") if text is None else text
    plain = F.regexp_replace(text.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    plain = F.when(plain.endswith("."), F.concat(plain, F.lit("0"))).otherwise(plain)
    mantissa = F.regexp_replace(F.substring_index(text, "E", 1), r"\.0$", "")
    power = F.substring_index(text, "E", -1)
    exponent = F.concat(F.when(power.startswith("-"), F.lit("e-")).otherwise(F.lit("e+")), F.lpad(F.replace(power, F.lit("-"), F.lit("")), 2, "0"))
    size = F.abs(d)
    return (
        F.when(F.isnan(d), F.lit("nan"))
        .when(size == F.lit(float("inf")), F.when(d > 0, F.lit("inf")).otherwise(F.lit("-inf")))
        .when(~text.contains("E"), text)
        .when((size >= F.lit(1e-4)) & (size < F.lit(1e16)), plain)
        .otherwise(F.concat(mantissa, exponent))
    )


def typed_key(col, na_tokens: Iterable[str] = NA_TOKENS) -> Column:
    """Canonical text that is equal for two cells exactly when the cells are
    equal under the type their column turns out to have.

    Integers -> exact integer text; other numbers -> value text (whole values
    as integers so ``1`` and ``1.0`` meet); booleans -> lower case; other
    text -> itself; missing -> null. The function is idempotent on its output.
    """
    c = _c(col)
    it = int_text(c)
    return (
        F.when(is_missing(c, na_tokens), F.lit(None).cast("string"))
        .when(is_int_text(c) & it.isNotNull(), it)
        .when(is_float_text(c), double_text(double_value(c)))
        .when(is_bool_text(c), F.lower(c))
        .otherwise(c)
    )


def render_cell(col, dtype) -> Column:
    """O-13: text of a cell as the inferred column type prints it.

    Integers print without ``.0`` (decision D3), floats as Python prints
    them, booleans as ``True``/``False``, text unchanged.
    """
    c = _c(col)
    t = _c(dtype) if not isinstance(dtype, str) or dtype not in _DTYPES else F.lit(dtype)
    return (
        F.when(c.isNull(), F.lit(None).cast("string"))
        .when(t.isin("int64", "uint64"), int_text(c))
        .when(t == "float64", float_text(double_value(c)))
        .when(t == "bool", F.when(F.lower(c) == "true", F.lit("True")).otherwise(F.lit("False")))
        .otherwise(c)
    )


_DTYPES = ("object", "int64", "uint64", "float64", "bool", "datetime64")


def type_tag(dtype) -> Column:
    """O-16: dtype name -> type tag, as a literal map lookup."""
    tags = all_type_tags()
    m = F.create_map(*[x for k, v in tags.items() for x in (F.lit(k), F.lit(v))])
    d = F.lit(dtype) if isinstance(dtype, str) and dtype in tags else _c(dtype)
    return F.element_at(m, d)


def table_name_of(col) -> Column:
    """O-06: file name -> table name (strip ``_split__###`` and ``.csv``)."""
    return F.regexp_replace(_c(col), SPLIT_SUFFIX_PATTERN, "")


def base_name(col) -> Column:
    """Last path segment of a file path or URI."""
    return F.regexp_extract(_c(col), r"([^/]*)$", 1)


def parse_collection(col, tag: str) -> Column:
    """O-15: declared collection tags from their text form.

    ``SS``/``NS``/``BS``: quoted list ``'one','two'`` (commas inside quotes
    belong to the item) or bare comma list -> distinct array; ``NS`` elements
    become doubles, ``BS`` elements binary. ``L``: JSON array of strings.
    ``M``: JSON object -> map<string,string>.
    """
    c = _c(col)
    if tag in ("SS", "NS", "BS"):
        quoted = F.regexp_extract_all(c, F.lit("'([^']*)'"), F.lit(1))
        bare = F.transform(F.split(c, ","), lambda x: F.trim(x))
        items = F.when(c.contains("'"), quoted).otherwise(bare)
        items = F.filter(items, lambda x: x != "")
        if tag == "NS":
            items = F.transform(items, lambda x: x.try_cast("double"))
        if tag == "BS":
            items = F.transform(items, lambda x: x.cast("binary"))
        return F.array_distinct(items)
    if tag == "L":
        return F.from_json(c, "array<string>")
    if tag == "M":
        return F.from_json(c, "map<string,string>")
    raise ValueError(f"not a collection tag: {tag}")
