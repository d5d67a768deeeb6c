"""Optional HDF5 source: ``spark.read.format("hdf5_rows")`` (needs h5py on the executors).

Reads row-aligned datasets of a file, or of each of its groups in string
order, in slabs of rows that go to Spark as Arrow batches; a slab is a
partition, so files of any size spread over tasks.  Parquet is the native format; convert once and go on from there.
"""

from __future__ import annotations

from pyspark.sql import SparkSession

SLAB_ROWS = 1 << 18


def register(spark: SparkSession) -> None:
    try:
        import h5py  # noqa: F401
    except ImportError as error:
        raise RuntimeError("the HDF5 source needs h5py") from error
    from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

    class Slab(InputPartition):
        def __init__(self, path: str, group: str, start: int, end: int):
            self.path, self.group, self.start, self.end = path, group, start, end

    class Reader(DataSourceReader):
        def __init__(self, path: str, columns: list[str]):
            self.path, self.columns = path, columns

        def partitions(self):
            import h5py

            slabs = []
            with h5py.File(self.path, "r") as handle:
                groups = [g for g in sorted(handle) if isinstance(handle[g], h5py.Group)] or ["/"]
                for group in groups:
                    n = len(next(iter(handle[group].values())))
                    slabs += [Slab(self.path, group, a, min(n, a + SLAB_ROWS)) for a in range(0, n, SLAB_ROWS)]
            return slabs

        def read(self, partition):
            import h5py
            import pyarrow as pa

            def column(values):
                flat = pa.array(values.reshape(-1))
                return flat if values.ndim == 1 else pa.FixedSizeListArray.from_arrays(flat, values.shape[1]).cast(pa.list_(flat.type))

            n = partition.end - partition.start
            with h5py.File(partition.path, "r") as handle:
                node = handle[partition.group]
                data = [column(node[c][partition.start : partition.end]) for c in self.columns]
            keys = [pa.array([partition.group] * n), pa.array(range(partition.start, partition.end), pa.int64())]
            yield pa.RecordBatch.from_arrays([*keys, *data], names=["core_group", "row_in_group", *self.columns])

    class Rows(DataSource):
        @classmethod
        def name(cls):
            return "hdf5_rows"

        def schema(self):
            return "core_group string, row_in_group long, " + self.options["columns"]

        def reader(self, schema):
            return Reader(self.options["path"], [f.name for f in schema.fields[2:]])

    spark.dataSource.register(Rows)
