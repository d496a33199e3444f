"""Sources (2.A) and sinks (2.B)."""

from indicarium.sources import readers, sinks  # noqa: F401
from indicarium.sources.readers import read_table  # noqa: F401
