"""Columns that pass through an Arrow function untouched, whatever their names."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from .arrays import free_name


def named(column: str) -> Column:
    """The column of exactly this name, dots included."""
    return F.col("`" + column.replace("`", "``") + "`")


class Carried:
    """``keep`` columns (None: all) of ``docs`` packed into one struct, so that clashing and dotted names do no harm."""

    def __init__(self, docs: DataFrame, keep: list[Column] | None):
        keep = [named(c) for c in docs.columns] if keep is None else list(keep)
        self.docs, self.names = docs, docs.select(*keep).columns
        self.pack = F.struct(*keep) if keep else F.struct(F.lit(0).alias("none"))

    def narrow(self, *inputs: Column) -> DataFrame:
        """The struct, then ``inputs``."""
        return self.docs.select(self.pack.alias("kept"), *inputs)

    @staticmethod
    def schema(narrow: DataFrame, added: str) -> StructType:
        """What the Arrow function returns: the struct and the columns that it adds."""
        first = narrow.schema.fields[0]
        return StructType([StructField(first.name, first.dataType, first.nullable), *StructType.fromDDL(added).fields])

    def restored(self, out: DataFrame) -> DataFrame:
        """The kept columns, then the added ones; an added one gets underscores before it where a kept one bears its name."""
        added, given = out.columns[1:], list(self.names)
        for c in added:
            given.append(free_name(c, given))
        every = [F.col("kept.*")] if self.names else []
        return out.select(*every, *[F.col(c).alias(n) for c, n in zip(added, given[len(self.names) :])])
