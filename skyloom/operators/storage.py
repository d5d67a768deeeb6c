"""Storage policy: advice by column, and writer options."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed value: integers of a smaller spread are worth compressing.
SMALL_SPREAD = 1 << 16
#: Width of the blocks of 2-D histories, and rows of a spectrum block.
HISTORY_WIDTH, SPECTRUM_ROWS = 3, 64
_CODECS = {"blosc": "zstd", "blosc-lz4": "lz4", "gzip": "gzip", "lzf": "snappy", "none": "uncompressed"}


def compress_advice(df: DataFrame) -> DataFrame:
    """(column, spread, compress): arrays and booleans yes, integers if their spread is small, others no."""
    integral = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
    spreads, always = [], {}
    for f in df.schema.fields:
        if isinstance(f.dataType, integral):
            wide = F.col(f.name).cast("decimal(20,0)")
            spreads.append((f.name, F.max(wide) - F.min(wide)))
        else:
            always[f.name] = isinstance(f.dataType, T.ArrayType | T.BooleanType)
    one = df.agg(*[c.cast("long").alias(n) for n, c in spreads]) if spreads else df.sparkSession.range(1).drop("id")
    rows = [F.struct(F.lit(n).alias("column"), F.col(f"`{n}`").alias("spread"), F.coalesce(F.col(f"`{n}`") < SMALL_SPREAD, F.lit(False)).alias("compress")) for n, _ in spreads]
    rows += [F.struct(F.lit(n).alias("column"), F.lit(None).cast("long").alias("spread"), F.lit(yes).alias("compress")) for n, yes in always.items()]
    return one.select(F.inline(F.array(*rows)))


def chunk_shape(rows: int, width: int | None, item_bytes: int, chunk_bytes: int) -> tuple[int, ...]:
    """Rows (and width) of a block of about chunk_bytes; 8-byte matrices are cut to narrow widths."""
    if width is None:
        return (max(1, min(rows, chunk_bytes // item_bytes)),)
    cut = min(width, HISTORY_WIDTH) if item_bytes == 8 else width
    return max(1, min(rows, chunk_bytes // (item_bytes * cut))), cut


def spectrum_shape(rows: int, width: int, chunk_rows: int = SPECTRUM_ROWS) -> tuple[int, int]:
    return max(1, min(chunk_rows, rows)), width


def item_bytes(kind: T.DataType) -> int:
    """Bytes of a fixed-width value, 8 for any other."""
    return {"tinyint": 1, "boolean": 1, "smallint": 2, "int": 4, "float": 4}.get(kind.simpleString(), 8)


def page_rows(schema: T.StructType, widths: dict[str, int], rows: int, chunk_bytes: int = 1 << 20, chunk_rows: int = SPECTRUM_ROWS) -> int:
    """Rows of a page, by the narrowest of the columns' block shapes; a spectrum's is that of chunk_rows.

    widths: elements of array columns, as far as they are known.
    """
    shapes = []
    for f in schema.fields:
        if f.name == "SED":
            shapes.append(spectrum_shape(rows, widths.get("SED", 1), chunk_rows))
        elif isinstance(f.dataType, T.ArrayType):
            shapes.append(chunk_shape(rows, widths.get(f.name, 1), item_bytes(f.dataType.elementType), chunk_bytes))
        else:
            shapes.append(chunk_shape(rows, None, item_bytes(f.dataType), chunk_bytes))
    return max(1, min((s[0] for s in shapes), default=rows))


def writer_options(codec: str = "blosc", level: int = 5, chunk_bytes: int = 1 << 20, rows_of_page: int | None = None) -> dict[str, str]:
    """Parquet options for a codec name, level and block size; pages are small so that narrow ranges read little."""
    limit = {"parquet.page.row.count.limit": str(rows_of_page)} if rows_of_page else {}
    if codec not in _CODECS:
        raise ValueError(f"codec {codec!r} is not one of {sorted(_CODECS)}")
    return limit | {"compression": _CODECS[codec], "parquet.compression.codec.zstd.level": str(level), "parquet.page.size": str(chunk_bytes), "parquet.block.size": str(max(chunk_bytes, 64 << 20))}
