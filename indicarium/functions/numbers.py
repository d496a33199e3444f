"""Number parsing, typing and code mapping expressions (Column -> Column).

Casts use ``try_cast`` so that ANSI mode never fails a whole job on one
dirty cell; a bad value becomes null and is caught by the contract check.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from indicarium import schema as S
from indicarium.functions.text import _c, ColumnOrName

SPARK_TYPE_OF_TAG = {"int": "bigint", "float": "double", "str": "string", "bool": "boolean"}


def decimal_comma(c: ColumnOrName, to: str = "double") -> Column:
    """Decimal comma to dot, then cast."""
    return F.replace(_c(c), F.lit(","), F.lit(".")).try_cast(to)


def strip_thousands(c: ColumnOrName) -> Column:
    """Drop the thousands dots (``'401.192'`` -> ``'401192'``)."""
    return F.replace(_c(c), F.lit("."), F.lit(""))


def parse_br_number(c: ColumnOrName, to: str = "double") -> Column:
    """``'1.210,5'`` -> 1210.5 (thousands dots out, decimal comma in)."""
    return decimal_comma(strip_thousands(c), to)


def dash_zero_int(c: ColumnOrName) -> Column:
    """E5: a lone dash means zero; everything else cast to integer."""
    col = _c(c)
    return F.when(col == "-", F.lit(0).cast("bigint")).otherwise(col.try_cast("bigint"))


def cast_by_tag(value: ColumnOrName, tag: ColumnOrName | str) -> Column:
    """Cast a text value by its type tag; the result is the canonical
    text of the typed value (so one column can carry every tag)."""
    v = _c(value)
    t = F.lit(tag) if isinstance(tag, str) and tag in SPARK_TYPE_OF_TAG else _c(tag)
    return (F.when(t == "int", F.coalesce(v.try_cast("bigint"), v.try_cast("double").try_cast("bigint")).cast("string"))
             .when(t == "float", v.try_cast("double").cast("string"))
             .when(t == "bool", v.try_cast("boolean").cast("string"))
             .otherwise(v.cast("string")))


def unit_inference(unit: ColumnOrName) -> Column:
    """Infer (multiplier, type tag, inferred flag) from a unit text.

    Multiplier: first of 'mil' (1000), 'cem' (100) found, else 1.
    Type: first of 'reais'/'real' (float), 'pessoas'/'unidades' (int)
    found, else 'str'. The flag is true when a type was found.
    """
    low = F.lower(_c(unit))
    mult = F.lit(1)
    for key, m in reversed(S.UNIT_MULTIPLIERS):
        mult = F.when(low.contains(key), F.lit(m)).otherwise(mult)
    tipo = F.lit("str")
    for key, t in reversed(S.UNIT_TYPES):
        tipo = F.when(low.contains(key), F.lit(t)).otherwise(tipo)
    found = F.lit(False)
    for key, _ in S.UNIT_TYPES:
        found = found | low.contains(key)
    return F.struct(mult.alias("multiplicador"), tipo.alias("tipo_dado"), found.alias("inferido"))


def scale_by_unit(raw: ColumnOrName, mult: ColumnOrName, tipo: ColumnOrName) -> Column:
    """Value x multiplier for int/float tags (as DOUBLE); other tags
    give null (their text is kept as is elsewhere). ``12.0`` is a whole
    number; a text that is no number of its type gives null."""
    r, m, t = _c(raw), _c(mult), _c(tipo)
    whole = F.when(r.try_cast("double") == F.floor(r.try_cast("double")), r.try_cast("double").try_cast("bigint"))
    return (F.when(t == "int", F.coalesce(r.try_cast("bigint"), whole) * m)
             .when(t == "float", r.try_cast("double") * m))


def special_code(raw: ColumnOrName) -> Column:
    """Statistical-office special codes.

    ``'-'`` -> value '0' typed int; ``'..'``, ``'...'``, ``'X'`` -> null typed
    NULL; any other text -> (null, null) meaning "not special".
    """
    r = _c(raw)
    is_zero = r == S.SPECIAL_CODE_ZERO
    is_null = r.isin(*S.SPECIAL_CODES_NULL)
    return F.struct(
        F.when(is_zero, F.lit(0).cast("bigint")).alias("valor"),
        F.when(is_zero, F.lit("int")).when(is_null, F.lit("NULL")).alias("tipo_dado"),
    )


def binary_answer(c: ColumnOrName) -> Column:
    """Categorical survey answer -> 1 / 0; unmapped answers -> null."""
    col = _c(c)
    return (F.when(col.isin(*S.BINARY_POSITIVE), F.lit(1))
             .when(col.isin(*S.BINARY_NEGATIVE), F.lit(0)))


def year_from_iso(c: ColumnOrName) -> Column:
    """Year of a ``YYYY-MM-DD`` text (text before the first '-')."""
    return F.substring_index(_c(c), "-", 1).try_cast("int")


def seven_digit(c: ColumnOrName) -> Column:
    """True when a municipality code already has seven digits."""
    col = _c(c)
    return (col >= S.SMALLEST_CITY_CODE) & (col <= S.HIGHEST_CITY_CODE)
