"""Proof that no row was lost, doubled or changed: a sum of row hashes that does not hang on their order.

Each row has 128 bits of hash over all given columns; these are summed over the
rows, in limbs that do not overflow, with the count.  Two tables with the same
sums hold the same rows, save for a chance of 2**-128 or so.  The sums are
plain aggregates, so a plan that writes a table can observe them on its way.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from skyloom.errors import LayoutError

#: Widths of the limbs of a 64-bit hash, lowest first: sums of 2**41 rows fit a long.
LIMBS = (21, 21, 22)
_SALT = "second"


def _whole(columns: list[str], df: DataFrame) -> list[Column]:
    """The columns as they are hashed: integers of one width, and a NULL told apart by its place."""
    out: list[Column] = []
    for i, c in enumerate(columns):
        kind = df.schema[c].dataType.simpleString()
        value = F.col(f"`{c}`")
        out += [value.cast("long") if kind in ("tinyint", "smallint", "int") else value, F.when(value.isNull(), F.lit(i))]
    return out


def row_sums(df: DataFrame, columns: list[str]) -> list[Column]:
    """Aggregates over df: the rows, and the summed limbs of both hashes of each row."""
    whole = _whole(columns, df)
    out = [F.count(F.lit(1)).alias("n")]
    for k, h in enumerate((F.xxhash64(*whole), F.xxhash64(F.lit(_SALT), *whole))):
        at = 0
        for width in LIMBS:
            limb = F.shiftrightunsigned(h, at).bitwiseAND(F.lit((1 << width) - 1).cast("long"))
            out.append(F.coalesce(F.sum(limb), F.lit(0)).alias(f"h{k}_{at}"))
            at += width
    return out


def digest_sums(digest: Column) -> list[Column]:
    """The same from an MD5 in hexadecimal, in four limbs of 32 bits: the rows and h0 to h3."""
    part = lambda k: F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long")
    return [F.count(F.lit(1)).alias("n"), *[F.coalesce(F.sum(part(k)), F.lit(0)).alias(f"h{k}") for k in range(4)]]


def of(df: DataFrame, columns: list[str]) -> dict[str, int]:
    """The sums of a table, by a pass over these columns."""
    return df.agg(*row_sums(df, columns)).first().asDict()


class Proof:
    """Pairs of tables that must hold the same rows, watched while they are computed.

    ``source()`` and ``result()`` return their table with its sums observed;
    once an action has computed the result, ``require()`` compares them.  A sum
    that differs is taken again by a pass of its own before it counts: a task
    that ran twice after a lost executor may have been observed twice.
    """

    def __init__(self) -> None:
        self.columns: dict[str, list[str]] = {}
        self.before: dict[str, tuple[DataFrame, Observation | None, dict[str, int] | None]] = {}
        self.after: dict[str, Observation] = {}

    def expect(self, name: str, df: DataFrame, columns: list[str]) -> None:
        """A source that is counted at once, by a pass over these columns."""
        self.columns[name], self.before[name] = columns, (df, None, of(df, columns))

    def source(self, name: str, df: DataFrame, columns: list[str]) -> DataFrame:
        seen = Observation()
        self.columns[name], self.before[name] = columns, (df, seen, None)
        return df.observe(seen, *row_sums(df, columns))

    def result(self, df: DataFrame) -> DataFrame:
        for name, columns in self.columns.items():
            self.after[name] = Observation()
            df = df.observe(self.after[name], *row_sums(df, columns))
        return df

    def require(self, written: DataFrame) -> None:
        """Raises unless the result, which now lies in ``written``, has the rows of every source."""
        wrong = []
        for name, (df, seen, known) in self.before.items():
            if (known or seen.get) != self.after[name].get:
                own, other = of(df, self.columns[name]), of(written, self.columns[name])
                if own != other:
                    wrong.append(f"{name} ({own['n']} and {other['n']} rows)")
        if wrong:
            raise LayoutError("rows written differ from those of " + ", ".join(wrong))
