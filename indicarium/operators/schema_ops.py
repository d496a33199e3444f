"""Projection and schema operators (2.C). Column-name work happens on the
driver over ``df.columns`` (catalogue-sized); data never leaves Spark."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicarium import schema as S


def keep_columns(df: DataFrame, keep: list[str]) -> DataFrame:
    """Keep-list projection (prunes the scan)."""
    return df.select(*keep)


def drop_columns(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop columns; missing names are ignored."""
    return df.drop(*cols)


def rename_columns(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by map; names not present are ignored."""
    present = {k: v for k, v in mapping.items() if k in df.columns}
    return df.withColumnsRenamed(present) if present else df


def harmonise_editions(editions: dict[int, DataFrame], renames: dict[int, dict[str, str]],
                       drops: dict[int, list[str]] | None = None,
                       year_col: str | None = S.YEAR_COL) -> DataFrame:
    """C4: per-edition rename/drop tables, then one union by name
    (missing columns become null). A single ``unionByName`` chain is
    flattened by the optimizer into one Union node."""
    drops = drops or {}
    frames = []
    for year, df in sorted(editions.items()):
        out = rename_columns(df, renames.get(year, {}))
        out = out.drop(*drops.get(year, []))
        if year_col and year_col not in out.columns:
            out = out.withColumn(year_col, F.lit(year).cast("int"))
        frames.append(out)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def harmonise_by_table(df: DataFrame, edition_col: str, renames: list[tuple[int, str, str]], keep: list[str],
                       drops: list[tuple[int, str]] | None = None) -> DataFrame:
    """C4 over one scan that holds all editions (files read together, with the
    columns of all of them): the rename table is rows (edition, column, common
    name), the drop table rows (edition, column). Each common name is read, row by
    row, from the column that the row's edition has it in. However many
    editions there are, the plan is one scan and one projection.

    Gives the edition, the columns of ``keep`` and the common names; null where
    an edition has none. A column keeps its own name in the editions that
    neither rename nor drop it. As in any Spark scan, names that differ in
    case alone are one column."""
    edition = F.col(edition_col)
    there = {c.lower() for c in df.columns}
    taken: dict[str, set[int]] = {}
    sources: dict[str, dict[str, list[int]]] = {c: {} for c in keep}
    for e, column, *common in [*renames, *(drops or [])]:
        column = column.lower()
        taken.setdefault(column, set()).add(e)
        for name in common:
            sources.setdefault(name, {}).setdefault(column, []).append(e)

    def value(name: str) -> Column:
        low, column = name.lower(), F.col(f"`{name}`")
        own = [F.when(~edition.isin(sorted(taken[low])), column) if low in taken else column] if low in there else []
        renamed = [F.when(edition.isin(es), F.col(f"`{c}`")) for c, es in sources[name].items() if c in there]
        return F.coalesce(*own, *renamed) if own or renamed else F.lit(None)

    return df.select(edition_col, *[value(n).alias(n) for n in sources if n != edition_col])


def _norm_name(name: str, style: str) -> str:
    if style == "compact":      # lower + no spaces/newlines
        return name.lower().replace(" ", "").replace("\n", "")
    if style == "spaced":       # lower + '_' -> ' '
        return name.lower().replace("_", " ")
    if style == "upper":
        return name.upper()
    raise ValueError(f"unknown style {style}")


def normalise_column_names(df: DataFrame, style: str = "compact") -> DataFrame:
    """Column-name normalisers."""
    return df.toDF(*[_norm_name(c, style) for c in df.columns])


def resolve_column(df: DataFrame, alternatives: list[str], target: str) -> DataFrame:
    """The first present alternative is renamed to ``target``; none
    present is an error."""
    for alt in alternatives:
        if alt in df.columns:
            return df.withColumnRenamed(alt, target)
    raise KeyError(f"none of {alternatives} in {df.columns}")


def resolve_by_fragment(df: DataFrame, fragment: str, target: str,
                        tie_break: str | None = None) -> DataFrame:
    """The single column containing ``fragment``; when several do, the
    one equal to the fragment or containing ``tie_break``; anything but
    exactly one is an error."""
    found = [c for c in df.columns if fragment in c]
    if len(found) > 1:
        found = [c for c in found if len(c) == len(fragment) or (tie_break and tie_break in c)]
    if len(found) != 1:
        raise KeyError(f"expected one column with '{fragment}', got {found}")
    return df.withColumnRenamed(found[0], target)


def positional_value(df: DataFrame, position: int = 1, name: str = S.VALUE_COL) -> DataFrame:
    """The column at ``position`` is the value column."""
    return df.withColumnRenamed(df.columns[position], name)


def columns_matching(df: DataFrame, pattern: str) -> list[str]:
    """Names matching a regular expression (search semantics)."""
    rx = re.compile(pattern)
    return [c for c in df.columns if rx.search(c)]


def select_by_pattern(df: DataFrame, pattern: str, keep: list[str] | None = None) -> DataFrame:
    """Keep ``keep`` plus every column whose name matches ``pattern``."""
    keep = keep or []
    return df.select(*keep, *[c for c in columns_matching(df, pattern) if c not in keep])


def year_named_columns(df: DataFrame, pattern: str = r"(\d{4})") -> DataFrame:
    """Rename columns whose name holds a year to that year."""
    mapping = {}
    for c in df.columns:
        m = re.search(pattern, c)
        if m:
            mapping[c] = m.group(1)
    return rename_columns(df, mapping)


def add_metadata(df: DataFrame, **values) -> DataFrame:
    """C11: literal metadata columns (dado_identificador, tipo_dado, ano)."""
    cols = {}
    for k, v in values.items():
        lit = F.lit(v)
        if k == S.YEAR_COL:
            lit = lit.cast("int")
        cols[k] = lit
    return df.withColumns(cols)


def to_fact_order(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Reorder (and restrict) to the fact column order."""
    return df.select(*(columns or S.FACT_COLUMNS))


def shifted_header_repair(df: DataFrame) -> DataFrame:
    """A header shifted by one: drop the last column, drop the first
    name and re-assign the remaining names in order."""
    names = df.columns
    body = df.select(*names[:-1])
    return body.toDF(*names[1:])
