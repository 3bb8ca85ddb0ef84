"""Working tables in the cluster's shared folder, and joins that broadcast only after a size check."""

from __future__ import annotations

import json
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: A side of a join is broadcast only if it has at most this many rows, and at most this many bytes.
BROADCAST_ROWS, BROADCAST_BYTES = 2_000_000, 32 << 20

#: Rows of an Arrow batch at most, and bytes from which on a batch is closed.
BATCH_ROWS, BATCH_BYTES = 1000, 16 << 20

_own: list[str] = []
_tracked: list[list[Work]] = []


def shared_root(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``; where it is unset, on one machine, one temporary folder a process.

    A cluster must name a folder that all its machines share.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a shared folder")
        if not _own:
            _own.append("file://" + tempfile.mkdtemp(prefix="genoframe-"))
        base = _own[0]
    return base.rstrip("/")


class Work:
    """A folder of Parquet tables that one call of an operator writes and rereads, which cuts lineage."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_root(spark)}/{name}-{uuid.uuid4().hex}"
        self._n = 0
        # An Arrow batch ends at either limit; only a single longer text goes beyond the bytes.
        # Results are lazy and read them when they run, so the session keeps them.
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
        if not 0 < int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) <= BATCH_ROWS:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        for works in _tracked:
            works.append(self)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and return a DataFrame that reads it back."""
        self._n += 1
        path = f"{self.root}/{self._n}-{name}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._work_path = path
        return out

    def delete(self, path: str) -> None:
        hadoop = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hadoop.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop, True)

    def drop(self, df: DataFrame) -> None:
        """Delete a table that nothing reads any more."""
        path = getattr(df, "_work_path", None)
        if path:
            self.delete(path)

    def close(self) -> None:
        """Delete all tables; what was made from them must have been written before."""
        self.delete(self.root)


def read_records(spark: SparkSession, log: str, schema: str) -> list:
    """The commit records (one small row a commit) under ``log``, by number."""
    path = spark._jvm.org.apache.hadoop.fs.Path(log)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return []
    return spark.read.schema(schema).json(f"{log}/*.json").orderBy("n").collect()


def write_record(spark: SparkSession, log: str, n: int, record: dict) -> None:
    """Commit number ``n``: one small file that appears whole; raises if that number is taken."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    made, named = hadoop(f"{log}-making-{n}-{uuid.uuid4().hex}"), hadoop(f"{log}/{n:012d}.json")
    fs = made.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(named.getParent())
    out = fs.create(made, True)
    out.write(bytearray(json.dumps(record).encode()))
    out.close()
    if fs.exists(named) or not fs.rename(made, named):
        fs.delete(made, False)
        raise RuntimeError(f"commit {n} of {log} was made by someone else")


@contextmanager
def tracked() -> Iterator[list[Work]]:
    """Collects the working folders that are made inside, for ``close`` once the results have been written."""
    works: list[Work] = []
    _tracked.append(works)
    try:
        yield works
    finally:
        _tracked.remove(works)


def join_checked(left: DataFrame, right: DataFrame, on, how: str, weight: Column | None = None) -> DataFrame:
    """Join with ``right`` broadcast if its rows and bytes are within the limits, else a sort-merge join.

    ``right`` should be a saved table: it is measured here.  ``weight`` is the
    bytes of a row; by default eight for each column, which must be numbers.
    """
    weight = F.lit(8 * len(right.columns)) if weight is None else weight
    size = right.agg(F.count("*").alias("rows"), F.coalesce(F.sum(weight.cast("long")), F.lit(0)).alias("bytes")).first()
    small = size["rows"] <= BROADCAST_ROWS and size["bytes"] <= BROADCAST_BYTES
    return left.join(F.broadcast(right) if small else right.hint("merge"), on, how)


def pack(docs: DataFrame) -> DataFrame:
    """doc_id (long), text, and ``row``, a struct of all columns but the text, whatever their names."""
    rest = F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns if c != "text"])
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", rest.alias("row"))


def unpack(packed: DataFrame, like: DataFrame, changed) -> DataFrame:
    """The columns of ``like`` from a packed table with new texts; n_chars, where there is one, follows a changed text."""
    columns = []
    for f in like.schema.fields:
        old = F.col("row").getField(f.name) if f.name != "text" else F.col("text")
        columns.append((F.when(changed, F.length("text")).otherwise(old).cast(f.dataType) if f.name == "n_chars" else old).alias(f.name))
    return packed.select(*columns)
