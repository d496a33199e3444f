"""Row predicates and null-token handling (Column -> Column)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from indicarium import schema as S
from indicarium.functions.text import _c, ColumnOrName


def not_total_row(c: ColumnOrName) -> Column:
    """D3: drop the 'Total' line and any 'IGNORADO' line."""
    col = _c(c)
    return (col != "Total") & ~col.contains("IGNORADO")


def all_digits(c: ColumnOrName, min_len: int = 1) -> Column:
    """The key is only digits, at least ``min_len`` of them."""
    return _c(c).rlike(f"^[0-9]{{{min_len},}}$")


def non_empty(c: ColumnOrName) -> Column:
    """Key neither empty nor a single blank."""
    col = _c(c)
    return (col != "") & (col != " ")


def null_token(c: ColumnOrName, tokens=None) -> Column:
    """A null token becomes null, other values pass through."""
    col = _c(c)
    return F.when(~col.isin(*(tokens or S.NULL_TOKENS)), col)


def both_total(a: ColumnOrName, b: ColumnOrName) -> Column:
    """Location and dependency are both 'Total'."""
    return (_c(a) == "Total") & (_c(b) == "Total")


def state_network(uf: ColumnOrName | None, network: ColumnOrName,
                  special_state: str = "DF", special_network: str = "Pública",
                  default_network: str = "Municipal") -> Column:
    """In the special state keep the special network, elsewhere the
    default one; with no state column keep the default network. One
    predicate, no union."""
    if uf is None:
        return _c(network) == default_network
    wanted = F.when(_c(uf) == special_state, F.lit(special_network)).otherwise(F.lit(default_network))
    return _c(network) == wanted


def not_raw_zero(c: ColumnOrName) -> Column:
    """Drop the exact text '0' (text compare: '0.0' stays)."""
    return _c(c) != "0"


def not_sentinel(c: ColumnOrName, sentinel) -> Column:
    """Drop a sentinel ('---' year, code 0)."""
    return _c(c) != sentinel


def december_option(label: ColumnOrName) -> Column:
    """Monthly option labels: keep the December ones."""
    return F.lower(_c(label)).contains("dez")


def year_after_slash(label: ColumnOrName) -> Column:
    """Year of a ``'dez/1997'`` label."""
    return F.substring_index(_c(label), "/", -1).try_cast("int")
