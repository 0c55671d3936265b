"""Spark helpers shared by the operators: lineage cuts and Arrow passes."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.session import checkpoint_root


class Scratch:
    """Written intermediate tables of one operator call.

    They live in a folder of their own under the session's shared checkpoint
    folder, so a lost executor never loses them.  ``drop`` removes a table
    that a later one has replaced; ``drop_all`` removes what all operators of
    the application have left, once their results are written elsewhere.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"
        self._n = 0
        self._paths: dict[int, tuple[DataFrame, str]] = {}  # holds the frame, so that its id stays its own

    def write(self, df: DataFrame, by: str | None = None) -> DataFrame:
        """``by``: a column whose values get folders of their own."""
        self._n += 1
        path = f"{self.root}/{self._n}"
        (df.write.partitionBy(by) if by else df.write).parquet(path)
        out = self.spark.read.schema(_nullable(df.schema)).parquet(path)
        self._paths[id(out)] = out, path
        return out

    def drop(self, df: DataFrame) -> None:
        _, path = self._paths.pop(id(df), (None, None))
        if path:
            _delete(self.spark, path)


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/llm/{spark.sparkContext.applicationId}"


def _delete(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def drop_all(spark: SparkSession) -> None:
    _delete(spark, _folder(spark))


def _nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_BATCH_CONF, _BATCH_DEFAULT, BATCH_BYTES = (
    "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "8m")


def bound_batches(spark: SparkSession) -> None:
    """Texts are long: Arrow batches of 8 MB instead of the default 64 MB, which
    the JVM and a Python worker would hold for every core.  A value that the
    session's owner has chosen stays."""
    if spark.conf.get(_BATCH_CONF) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH_CONF, BATCH_BYTES)


def arrow_map(df: DataFrame, fn: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch]],
              schema: str | T.StructType) -> DataFrame:
    """``fn`` applied to every Arrow batch; batches without rows are skipped."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield from fn(b)
    bound_batches(df.sparkSession)
    return df.mapInArrow(run, schema)


BROADCAST_BYTES = 16 << 20


def small(df: DataFrame, rows: int, row_bytes: int) -> DataFrame:
    """Hint a broadcast behind a check of the size; beyond it the planner
    shuffles as usual.  ``df`` is a written table of ``rows`` rows."""
    return F.broadcast(df) if rows * row_bytes <= BROADCAST_BYTES else df


def crc_mod(df_col, m: int):
    """crc32(id as text) mod ``m``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(df_col.cast("string"), F.lit("")).cast("binary")) % m
