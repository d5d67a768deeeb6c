"""Names: bands, groups and files."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

from skyloom.errors import LayoutError

GROUP_PREFIX = "core_"


def sanitized_band(name: str) -> str:
    """A band label as a column suffix: one trailing ``.txt`` goes, dots and hyphens become underscores."""
    return re.sub(r"\.txt\Z", "", name).translate(str.maketrans(".-", "__"))


def sanitized_band_column(name: Column) -> Column:
    return F.translate(F.regexp_replace(name, r"\.txt\z", ""), ".-", "__")


def listed_bands(attribute: str | bytes | None, fallback: list[str]) -> list[str]:
    """The comma-separated first token of a ``bands`` attribute, or the fallback."""
    if attribute is None:
        return fallback
    text = attribute.decode() if isinstance(attribute, bytes) else str(attribute)
    return text.split()[0].split(",")


def listed_bands_column(attribute: Column) -> Column:
    return F.split(F.split(F.trim(attribute), r"\s+", 2)[0], ",")


def group_number(group: Column) -> Column:
    """The integer of ``core_<n>``; anything else raises."""
    return F.regexp_replace(group, f"^{GROUP_PREFIX}", "").cast("int")


def partition_name(prefix: str, low: Column, high: Column, index: Column) -> Column:
    """A published name; the index keeps names apart where the bounds print alike."""
    return F.format_string(f"{prefix}_%04d_z_%05.2f_%05.2f", index, low, high)


def number_in(pattern: str, text: Column, group: int = 1) -> Column:
    """An integer captured by a pattern, NULL where it doesn't match."""
    found = F.regexp_extract(text, pattern, group)
    return F.when(found != "", found.cast("long"))


def check_new_names(columns: dict[str, str], name: str, origin: str) -> None:
    """Registers an output column; a second one of that name raises with both origins."""
    if name in columns:
        raise LayoutError(f"output column {name!r} would come from both {columns[name]} and {origin}")
    columns[name] = origin
