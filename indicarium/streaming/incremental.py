"""L1 as a stream: new fact files landing in a folder are loaded with
``trigger(availableNow=True)``.

Micro-batches only copy the new files' rows to a staging folder, one
folder for each batch number, so a retried batch rewrites its own. What is
loaded already is decided once a run, over everything staged: however the
files were dealt out over batches, the store gets the same rows. Rows of a
year that the store has are merged by city, so a late file adds what is new in it. The
stream's checkpoint records which files were taken; staged rows of a run
that stopped before its load are loaded by the next one, and those of a run
that stopped after it are there already.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from indicarium.plans.load import load_incremental
from indicarium.session import shared_folder
from indicarium.sources.versions import NO_STORE

LANDED_FACT_SCHEMA = T.StructType([
    T.StructField("codigo_municipio", T.LongType()),
    T.StructField("ano", T.IntegerType()),
    T.StructField("dado_identificador", T.StringType()),
    T.StructField("tipo_dado", T.StringType()),
    T.StructField("valor", T.StringType()),
])


def stream_incremental_load(spark: SparkSession, landing: str, store: str, indicator_dim: DataFrame,
                            municipality_dim: DataFrame, name: str = "carga_incremental",
                            checkpoint: str | None = None, max_files_per_batch: int = 1000) -> dict:
    """Load every fact file present in ``landing`` that was not loaded
    yet, then stop. ``max_files_per_batch`` bounds what one micro-batch
    stages; it does not change the result. ``checkpoint`` (by default a
    folder of the stream's name in the shared folder the session names)
    keeps the stream's progress and must outlive the application.
    Returns the inserted rows, those of them in years that the store had (late), the rows
    that were there (present), the staged batches of this run and the indicator dimension."""
    root = checkpoint or f"{shared_folder(spark)}/streams/{name}"
    staged = f"{root}/staged"
    batches = []

    def stage(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{staged}/batch={batch_id}")
        batches.append(batch_id)

    stream = (spark.readStream.schema(LANDED_FACT_SCHEMA)
              .option("maxFilesPerTrigger", max_files_per_batch).parquet(landing)
              .writeStream.foreachBatch(stage)
              .option("checkpointLocation", f"{root}/progress")
              .trigger(availableNow=True)
              .start())
    stream.awaitTermination()
    try:
        facts = spark.read.schema(LANDED_FACT_SCHEMA).parquet(staged)
    except AnalysisException as e:
        if e.getCondition() in NO_STORE:
            return {"rows": 0, "late": 0, "present": 0, "batches": 0, "indicator_dim": indicator_dim}
        raise
    out = load_incremental(facts.select(*LANDED_FACT_SCHEMA.names), indicator_dim, municipality_dim, store)
    path = spark._jvm.org.apache.hadoop.fs.Path(staged)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
    return {k: out[k] for k in ("rows", "late", "present", "indicator_dim")} | {"batches": len(batches)}
