"""Bins and pixels on a stream (an extension: the batch pipeline has no stream).

Edges are computed beforehand from a batch, so both are plain projections:
they need no state and work on ``readStream`` as on ``read``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyloom.functions import healpix
from skyloom.functions.numeric import bin_of, is_key


def assign(stream: DataFrame, edges: list[float], level: int, key: str = "redshift", ra: str = "ra", dec: str = "dec") -> DataFrame:
    """The rows with a usable key, their partition_index and pixel."""
    binned = stream.where(is_key(F.col(key))).withColumn("partition_index", bin_of(F.col(key), edges).cast("int"))
    return healpix.add_pixel(binned, ra, dec, level)
