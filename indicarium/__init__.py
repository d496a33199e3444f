"""indicarium — municipal indicator pipelines as Spark DataFrame jobs.

Layout:
  functions/  Column -> Column expressions (cleaning, parsing, typing)
  operators/  DataFrame -> DataFrame operators (schema, filters, joins,
              aggregates, reshape, ordering, sets, validation, releases)
  sources/    readers for landed files and the driver's tables, sinks
  plans/      indicator pipelines, incremental load, run audit and the
              registered queries used by the correctness gate
  streaming/  the incremental load as an availableNow stream
"""

from indicarium.session import get_spark, checkpoint_dir

__all__ = ["get_spark", "checkpoint_dir"]
