"""What the operators share: written tables, the bound of Arrow batches, tables by name."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructField, StructType

from curaloom.storage import fresh_path, shared_folder, written

__all__ = ["bound_batches", "free_name", "fresh_path", "map_in_arrow", "shared_folder", "table", "written"]

#: Arrow batches end at this many bytes, so that very long texts don't pile up in a Python worker.
BATCH_BYTES = "4m"


def bound_batches(spark: SparkSession) -> None:
    """For the session, not for a call: plans run long after they are built."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, base: str, *others: str) -> str:
    """A column name that neither df nor others have, whatever their case."""
    taken = {x.lower() for x in (*df.columns, *others)}
    while base.lower() in taken:
        base = f"_{base}"
    return base


def map_in_arrow(rows: DataFrame, run, schema: StructType) -> DataFrame:
    """mapInArrow for columns of any name, dots included: run maps a batch's list of columns to a new one, of schema."""
    names = [f"c{i}" for i in range(len(schema.fields))]

    def mapped(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays(run(list(batch.columns)), names=names)

    plain = rows.toDF(*(f"c{i}" for i in range(len(rows.columns))))
    safe = StructType([StructField(n, f.dataType) for n, f in zip(names, schema.fields, strict=True)])
    return plain.mapInArrow(mapped, safe).toDF(*schema.names)
