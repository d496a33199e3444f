"""Release discovery on a table of fetched pages (2.M): link extraction,
file-type patterns, link -> year -> best release, reader choice."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from indicarium.functions.text import _c, ColumnOrName, corrected_release_year, year_from_text
from indicarium.operators.ordering import fill_missing_year, latest_per_key

HREF = r'href="([^"]*)"'


def links(df: DataFrame, html: str = "html", pattern: str = HREF, keep: list[str] | None = None,
          out: str = "link") -> DataFrame:
    """M1: one row per link matching ``pattern`` (group 1) in the page."""
    return df.select(*(keep or []), F.explode(F.regexp_extract_all(F.col(html), F.lit(pattern), 1)).alias(out))


def quoted_link_with(fragment_regex: str) -> str:
    """M2: pattern for the whole quoted link around a match."""
    return r'"([^"]*' + fragment_regex + r'[^"]*)"'


def file_type_pattern(prefix: str = "base", exts: tuple[str, ...] = ("zip", "xlsx"), gap: int = 70) -> str:
    """M3: case-insensitive ``base.{0,70}\\.(zip|xlsx)``."""
    return rf"(?i)({prefix}.{{0,{gap}}}\.(?:{'|'.join(exts)}))"


def link_years(df: DataFrame, link: str, pos: str, partition: list[str] | None = None,
               out: str = "ano") -> DataFrame:
    """M4 steps: year from the link (last stand-alone 4 digits, < 2050),
    corrected releases shift back one year, missing years filled from the
    previous listed link."""
    y = year_from_text(link)
    df = df.withColumn(out, corrected_release_year(link, y))
    return fill_missing_year(df, out, pos, partition)


def best_release_per_year(df: DataFrame, year: str, pos: str, partition: list[str] | None = None) -> DataFrame:
    """M4: per (partition, year) the last listed link wins."""
    return latest_per_key(df, [*(partition or []), year], pos)


def reader_kind(link: ColumnOrName) -> Column:
    """M5: which reader a link needs: csv, xlsx, or unsupported."""
    col = _c(link)
    return (F.when(col.contains("csv"), F.lit("csv"))
             .when(col.contains(".xlsx"), F.lit("xlsx"))
             .otherwise(F.lit("erro")))
