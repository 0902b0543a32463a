"""JN1 / JN2: joining a small, fitted lookup table back onto the fact rows.

A lookup table (category -> frequency, group -> statistics, ...) is the output
of an aggregate, so its size is the number of distinct keys, which grows with
the data in principle.  It is broadcast only if its values, as measured in one
aggregate over it, have at most ``DEFAULT_BROADCAST_BYTES``; above the limit
the join stays a shuffle join (sort-merge, AQE may still demote it and split
skewed partitions).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import cut_lineage

DEFAULT_BROADCAST_BYTES = 32 << 20


def _bytes_of(name: str, kind: T.DataType) -> Column:
    """Bytes of a value: 8, and the text's own for anything of variable length."""
    if isinstance(kind, (T.NumericType, T.BooleanType, T.DateType, T.TimestampType)):
        return F.lit(8)
    value = F.col(f"`{name}`")
    if not isinstance(kind, (T.StringType, T.BinaryType)):
        value = value.cast("string")
    return F.lit(24) + F.coalesce(F.octet_length(value), F.lit(0))


def measured(df: DataFrame) -> tuple[int, int]:
    """Rows of a table, and bytes of their values."""
    size = F.lit(0)
    for f in df.schema.fields:
        size = size + _bytes_of(f.name, f.dataType)
    row = df.agg(F.count(F.lit(1)), F.sum(size.cast("bigint"))).first()
    return int(row[0]), int(row[1] or 0)


@dataclass
class Lookup:
    """A materialised small table with its exact row count and the bytes of its values."""

    df: DataFrame
    rows: int
    bytes: int

    @classmethod
    def of(cls, df: DataFrame) -> "Lookup":
        """A table that is stored already, measured."""
        return cls(df, *measured(df))

    @classmethod
    def materialise(cls, df: DataFrame) -> "Lookup":
        """Checkpoint (reliable, lineage cut) and measure once."""
        return cls.of(cut_lineage(df))

    def part(self, df: DataFrame) -> "Lookup":
        """A selection of this table, which isn't larger."""
        return Lookup(df, self.rows, self.bytes)

    @property
    def small(self) -> bool:
        return self.bytes <= DEFAULT_BROADCAST_BYTES

    def join_to(self, facts: DataFrame, on, how: str = "left") -> DataFrame:
        return facts.join(F.broadcast(self.df) if self.small else self.df, on, how)


def join_small(facts: DataFrame, small: DataFrame, on, how: str = "left") -> DataFrame:
    """Join ``small`` onto ``facts``; broadcast only when its measured bytes are under the limit."""
    return Lookup.of(small).join_to(facts, on, how)
