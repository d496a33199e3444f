"""Text expressions (Column -> Column). All run inside the JVM.

The ASCII fold is driven by tables derived at runtime from the Unicode
database (``unicodedata``), so no character table is written by hand.
"""

from __future__ import annotations

import functools
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from indicarium import schema as S

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# Python's str.strip() whitespace: Unicode White_Space plus \x1c-\x1f
_PY_WS = r"[\s\x1c-\x1f]"


def py_strip(c: ColumnOrName) -> Column:
    """Strip leading/trailing whitespace the way Python's ``str.strip`` does."""
    return F.regexp_replace(_c(c), rf"(?U)^{_PY_WS}+|{_PY_WS}+$", "")


def digits_only(c: ColumnOrName) -> Column:
    """Keep only the digits (``'110001 ALTA FLORESTA'`` -> ``'110001'``)."""
    return F.regexp_replace(_c(c), r"[^0-9]", "")


def printable_clean(c: ColumnOrName) -> Column:
    """Drop quotes, newlines, tabs; strip; keep characters of Unicode
    categories L, M, N, P, Z, S only."""
    no_quotes = F.regexp_replace(_c(c), r'["\n\t\r]', "")
    return F.regexp_replace(py_strip(no_quotes), r"[^\p{L}\p{M}\p{N}\p{P}\p{Z}\p{S}]", "")


@functools.lru_cache(maxsize=1)
def _fold_tables() -> tuple[str, str, dict[str, str]]:
    """Compatibility-decomposition folds of every non-ASCII code point.

    Returns (sources, targets) for characters folding to exactly one ASCII
    character and a dict for characters folding to several.
    """
    src, dst, multi = [], [], {}
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        folded = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode("ascii")
        if len(folded) == 1:
            src.append(ch)
            dst.append(folded)
        elif len(folded) > 1:
            multi[ch] = folded
    return "".join(src), "".join(dst), multi


def has_any_char(col: Column, chars: str) -> Column:
    """True when ``col`` holds any of ``chars`` (one translate pass, a
    hash lookup per character; far cheaper than a large regex class)."""
    return F.length(F.translate(col, chars, "")) < F.length(col)


def ascii_fold(c: ColumnOrName) -> Column:
    """NFKD compatibility fold, then drop everything outside ASCII.

    One ``translate`` handles every character that folds to a single ASCII
    letter; the rare rows holding a character that folds to several letters
    (ligatures, fractions, ...) take a per-character map lookup branch.
    The final ``regexp_replace`` removes what has no ASCII form.
    """
    src, dst, multi = _fold_tables()
    col = _c(c)
    mapping = F.create_map(*[x for k, v in multi.items() for x in (F.lit(k), F.lit(v))])
    per_char = F.array_join(
        F.transform(F.regexp_extract_all(col, F.lit(r"(?s)."), 0),
                    lambda ch: F.coalesce(F.element_at(mapping, ch), ch)),
        "")
    expanded = F.when(has_any_char(col, "".join(multi)), per_char).otherwise(col)
    return F.regexp_replace(F.translate(expanded, src, dst), r"[^\x00-\x7F]", "")


def text_key(c: ColumnOrName) -> Column:
    """Fold, keep printable ASCII, remove spaces, lower case."""
    folded = ascii_fold(c)
    printable = F.regexp_replace(folded, r"[^\x20-\x7E\t\n\r\x0B\x0C]", "")
    return F.lower(F.replace(printable, F.lit(" "), F.lit("")))


def name_key(c: ColumnOrName) -> Column:
    """Lighter key used for names and requests: lower case, no spaces."""
    return F.replace(F.lower(_c(c)), F.lit(" "), F.lit(""))


def topic_slug(c: ColumnOrName, cut: int = S.TOPIC_CUT) -> Column:
    """Fact-table name of a topic: cut to ``cut`` characters, fold,
    space and '-' to '_', lower, strip, keep [a-zA-Z0-9_], cut to 63,
    prefix ``fato_topico_``."""
    t = F.substring(_c(c), 1, cut) if cut else _c(c)
    t = ascii_fold(t)
    t = F.translate(t, " -", "__")
    t = py_strip(F.lower(t))
    t = F.regexp_replace(t, r"[^a-zA-Z0-9_]", "")
    return F.concat(F.lit(S.SLUG_PREFIX), F.substring(t, 1, S.SLUG_MAX))


def lower_cut(c: ColumnOrName, n: int = S.LOAD_STRING_CUT) -> Column:
    """Lower case and cut to ``n`` characters (string columns on load)."""
    return F.substring(F.lower(_c(c)), 1, n)


def split_name_state(c: ColumnOrName) -> tuple[Column, Column]:
    """``'Vila Alta (AA)'`` -> (``'Vila Alta '``, ``'AA'``)."""
    col = _c(c)
    name = F.substring_index(col, "(", 1)
    state = F.regexp_extract(col, r"\((..)", 1)
    return name, state


def years_in_text(c: ColumnOrName) -> Column:
    """E18 helper: every stand-alone run of exactly four digits, as INT."""
    # an array cast (not a lambda) keeps the expression inside codegen
    return F.regexp_extract_all(_c(c), F.lit(r"(?<!\d)(\d{4})(?!\d)"), 1).cast("array<int>")


def year_from_text(c: ColumnOrName, ceiling: int = S.YEAR_CEILING) -> Column:
    """The last stand-alone four-digit number; values at or above
    ``ceiling`` are not years (null)."""
    years = years_in_text(c)
    last = F.when(F.size(years) > 0, F.element_at(years, -1))
    return F.when(last < ceiling, last)


def corrected_release_year(name: ColumnOrName, year: ColumnOrName) -> Column:
    """A corrected release (``corrigido`` in the name) refers to the
    previous year."""
    return F.when(_c(name).contains("corrigido"), _c(year) - 1).otherwise(_c(year))


def code_from_header(c: ColumnOrName) -> Column:
    """Indicator code is the text before the first '-'."""
    return F.trim(F.substring_index(_c(c), "-", 1))


def name_with_code(name: ColumnOrName, code: ColumnOrName) -> Column:
    """``name - code``."""
    return F.concat_ws(" - ", _c(name), _c(code))


def numbers_in_label(c: ColumnOrName, pattern: str = r"\d+") -> Column:
    """E22 (long form): all numbers found in a label, as INT array."""
    return F.regexp_extract_all(_c(c), F.lit(f"({pattern})"), 1).try_cast("array<int>")


def years_text(c: ColumnOrName) -> Column:
    """An INT array written as ``'2018, 2019'``."""
    return F.array_join(_c(c).cast("array<string>"), ", ")


def log_timestamp(c: ColumnOrName) -> Column:
    """Timestamp written as ``%Y-%m-%d %H:%M:%S``."""
    return F.date_format(_c(c), "yyyy-MM-dd HH:mm:ss")


def month_label_pt(ts: ColumnOrName) -> Column:
    """``'dez/1997'`` style label of a timestamp's month."""
    months = F.array(*[F.lit(m) for m in S.MONTHS_PT])
    return F.concat(F.element_at(months, F.month(_c(ts))), F.lit("/"), F.year(_c(ts)).cast("string"))


def extract_links(html: ColumnOrName, pattern: str) -> Column:
    """M1: every capture of ``pattern`` (group 1) in an HTML text."""
    return F.regexp_extract_all(_c(html), F.lit(pattern), 1)
