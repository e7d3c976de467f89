"""Session settings and small column helpers shared by the operators of this subpackage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from opsignal.session import materialise, prepare

#: Rows per Arrow batch: texts may be long, so few of them travel together.
BATCH_ROWS = 1000


def ready(spark: SparkSession) -> SparkSession:
    prepare(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(column: str, modulus: int) -> Column:
    """``crc32`` of the number as text, modulo ``modulus``."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % modulus


def fresh(name: str, taken: list[str]) -> str:
    """``name``, with underscores in front until no column is called so (names ignore case)."""
    lower = {t.lower() for t in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name


def with_columns(schema: StructType, added: list[tuple[str, str]]) -> StructType:
    """A copy of ``schema`` with further columns."""
    out = StructType(list(schema.fields))
    for name, kind in added:
        out.add(name, kind)
    return out


__all__ = ["BATCH_ROWS", "fresh", "materialise", "ready", "remainder", "table", "with_columns"]
