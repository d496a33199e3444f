"""Column expressions (2.D predicates, 2.E scalar expressions)."""

from indicarium.functions.text import *  # noqa: F401,F403
from indicarium.functions.numbers import *  # noqa: F401,F403
from indicarium.functions.predicates import *  # noqa: F401,F403
