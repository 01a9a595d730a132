"""Shared helpers: durable materialisation, text columns, batch-wise Arrow functions."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of every word rule here; a word is a run of anything else.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"
#: Rows an Arrow batch may hold, so that a batch of long texts stays small.
BATCH_ROWS = 1000


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder; where none is set, a temporary one if the executors are on this machine."""
    where = spark.conf.get("spark.checkpoint.dir", None)
    if not where:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        where = "file://" + tempfile.mkdtemp(prefix="juncture-")
        spark.conf.set("spark.checkpoint.dir", where)
    return where.rstrip("/")


def materialise(df: DataFrame, name: str, by: str | None = None) -> DataFrame:
    """Write df as Parquet under the shared folder, by the values of a column if one is given, and read it back: short
    lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/juncture/{name}-{uuid.uuid4().hex}"
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(by) if by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove tables that `materialise` wrote (not by a column) and that no plan will read again."""
    for t in tables:
        files = t.inputFiles()
        if files:
            spark = t.sparkSession
            path = spark._jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Bound the rows of an Arrow batch; texts may be long."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def text_or_empty(col: str | Column = "text") -> Column:
    return F.coalesce(F.col(col) if isinstance(col, str) else col, F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def unique_ids(df: DataFrame, by: str = "doc_id") -> bool:
    """Whether each row has an id of its own."""
    ids = df.select(F.col(by).cast("long").alias("id"))
    return ids.groupBy("id").count().filter("id is null or count > 1").isEmpty()


def keyed(df: DataFrame, name: str, by: str = "doc_id") -> DataFrame:
    """df with a long column that differs between all rows and orders them by `by`, null ids last.

    Where ids are there and unique, as they should be, it is the id. Else the rows are sorted (rows of one id by their
    other columns) and numbered by partition and place, and the numbers are kept in a table.
    """
    if unique_ids(df, by):
        return df.withColumn(name, F.col(by).cast("long"))
    row = F.xxhash64(*[F.col(f"`{c}`").cast("string") if str(t).startswith("map") else F.col(f"`{c}`") for c, t in df.dtypes])
    order = [F.col(by).cast("long").asc_nulls_last(), *([F.col("text")] if "text" in df.columns else []), row]
    return materialise(df.sort(*order).withColumn(name, F.monotonically_increasing_id()), "keyed")


def words_count(col: str | Column = "text") -> Column:
    """Number of words; null has none."""
    return F.regexp_count(text_or_empty(col), F.lit(WORD)).cast("long")


def map_arrow(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: str) -> DataFrame:
    """mapInArrow with a function from one batch to one batch (or none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                out = fn(batch)
                if out is not None and out.num_rows:
                    yield out

    return df.mapInArrow(run, schema)


def joined_batches(batches: Iterator[pa.RecordBatch], most: int = 16 << 20) -> Iterator[pa.RecordBatch]:
    """Batches put together up to about `most` bytes."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= most:
            yield pa.concat_batches(held)
            held, size = [], 0
    if held:
        yield pa.concat_batches(held)


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of splitmix64 over uint64 arrays."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def uniform(x: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) from mixed uint64 values."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def binaries(arrays: list[np.ndarray]) -> pa.Array:
    return pa.array([a.tobytes() for a in arrays], type=pa.binary())
