"""What the operators share: reading tables, checkpoints, packed Arrow blobs."""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: UTF-8 bytes of A-Z to a-z; every other byte stays, so offsets stay too.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that the driver and all executors share: spark.checkpoint.dir, or the warehouse where it is unset.

    A warehouse in a local file system is shared by one process only, so on a
    cluster the setting must be there.
    """
    context = spark.sparkContext
    if given := spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir():
        return given
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    scheme = context._jvm.org.apache.hadoop.fs.Path(warehouse).getFileSystem(context._jsc.hadoopConfiguration()).getScheme()
    if scheme == "file" and not (context.master == "local" or context.master.startswith("local[")):
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    return f"{warehouse}/_checkpoints-{uuid.uuid4().hex[:8]}"


def checkpointed(df: DataFrame) -> DataFrame:
    """df, cut from its lineage by a copy in the shared checkpoint folder."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint(eager=True)


def apart(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """docs with columns named c0, c1, ... that clash with nothing, and the new name of each column."""
    names = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names


def text_volume(docs: DataFrame, column: str = "text") -> tuple[int, int]:
    """Rows and UTF-8 bytes of a text column."""
    row = docs.agg(F.count(F.lit(1)).alias("n"), F.sum(F.octet_length(column)).alias("b")).first()
    return row["n"], row["b"] or 0


def byte_rows(batch: pa.RecordBatch, column: str = "text") -> list[bytes | None]:
    return batch.column(column).cast(pa.large_binary()).to_pylist()


def pack(arrays: dict[str, pa.Array]) -> bytes:
    """One compressed Arrow stream, cheap to shuffle as a single binary value."""
    batch = pa.RecordBatch.from_pydict(arrays)
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(blob: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(pa.py_buffer(blob)) as stream:
        return stream.read_next_batch()


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser of 64-bit words (xor-shift and multiply)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xA0761D6478BD642F)
    return x ^ (x >> np.uint64(32))
