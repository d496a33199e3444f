"""Helpers shared by the training-data operators: scratch tables, row keys, Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of input that one Arrow batch carries to a Python worker, at most (one longer row goes alone).
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder that ``spark.checkpoint.dir`` names.

    A local session that names none gets a folder of its own; any other
    session must name one, as its executors share no local disk.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="indicarium-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"


def staged(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: cuts the lineage and survives lost executors.

    Also for a key's totals before they are joined to its rows: AQE splits a
    hot key of a join only between two shuffles, not above an aggregation.
    """
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a ``staged`` table that nothing reads any more."""
    spark = df.sparkSession
    paths = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for p in paths:
        if "/llm-" in p:
            path = spark._jvm.org.apache.hadoop.fs.Path(p)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def shipped(spark: SparkSession) -> None:
    """Give the executors this package, as ``--py-files`` would; once a session."""
    sc = spark.sparkContext
    if getattr(sc, "_indicarium_shipped", False):
        return
    top = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="indicarium-py-")) / "indicarium_llm.zip"
    with zipfile.ZipFile(archive, "w") as z:
        for f in [*top.glob("*.py"), *(top / "llm").glob("*.py")]:
            z.write(f, f.relative_to(top.parent))
    sc.addPyFile(str(archive))
    sc._indicarium_shipped = True


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Keep Arrow batches of whole texts small, whatever the texts' lengths."""
    shipped(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def content_key(*cols: Column) -> tuple[Column, Column]:
    """128 bits that stand for the columns' values, nulls included, as two longs."""
    flags = F.concat(*[F.when(c.isNull(), F.lit("0")).otherwise(F.lit("1")) for c in cols])
    return F.xxhash64(flags, *cols), F.xxhash64(F.lit(7), *reversed(cols), flags)


def in_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[dict] | dict], schema: str) -> DataFrame:
    """``mapInArrow`` of a function from one batch to columns by name."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    out = to_arrow_schema(_parse_datatype_string(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                made = fn(batch)
                yield pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for f in out for x in (made[f.name],)], schema=out)

    return df.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The column's texts as UTF-8, null as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]
