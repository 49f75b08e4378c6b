"""Small helpers of the operators: batches of Arrow rows, folders for written tables, class ids, one row per key."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oslogs.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def map_batches(df: DataFrame, rows: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: str) -> DataFrame:
    """mapInArrow with columns given as lists or arrays by name."""
    arrow = arrow_schema(df.sparkSession, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for columns in rows(batches):
            yield pa.RecordBatch.from_arrays([pa.array(columns[f.name], f.type, from_pandas=False) for f in arrow], schema=arrow)

    return df.mapInArrow(run, schema)


def filter_batches(df: DataFrame, column: str, keep: Callable[[list], list[bool]]) -> DataFrame:
    """The rows whose value of a column is kept, with all their columns."""
    at = df.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(keep(batch.column(at).to_pylist()), pa.bool_()))

    return df.mapInArrow(run, df.schema)


_ARROW = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_(), "string": pa.string(), "binary": pa.binary(), "float": pa.float32()}


def arrow_schema(spark: SparkSession, schema: str) -> pa.Schema:
    def kind(t: T.DataType) -> pa.DataType:
        return pa.list_(kind(t.elementType)) if isinstance(t, T.ArrayType) else _ARROW[t.simpleString()]

    return pa.schema([(f.name, kind(f.dataType)) for f in T.StructType.fromDDL(schema)])


def written(df: DataFrame, name: str, codec: str = "snappy") -> DataFrame:
    """The rows as a table in the cluster's checkpoint folder: lineage ends there and lost executors re-read it."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", codec).parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._folder = path
    return out


def discard(*tables: DataFrame) -> None:
    """Deletes tables of ``written``; nothing that is yet to run may read them."""
    for t in tables:
        hadoop = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._folder)
        hadoop.getFileSystem(t.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(hadoop, True)


def fold(column, parts: int):
    """crc32 of an id as text, modulo parts; an id that is null counts as fold 0."""
    return F.coalesce(F.pmod(F.crc32(column.cast("string").cast("binary")), F.lit(parts)), F.lit(0))
