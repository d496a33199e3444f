"""DataFrame -> DataFrame operators (2.C, 2.D, 2.F-2.K, 2.M)."""

from indicarium.operators import (  # noqa: F401
    aggregates, filters, joins, ordering, release, reshape, schema_ops, sets, validate,
)
