"""Ids that last: a versioned table of values and their numbers (M9).

``dense_ids`` numbers one frame; a later load would number the same value anew.  An ``IdTable`` keeps
what it has given: a load finds its new values by an anti-join, numbers them in order after the last
id (range partitions, no single task), and publishes them as one more version.  Old ids never
change, every value has one, and there are no gaps.  A version that was not finished is not listed
and leaves nothing behind.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.operators.positional import with_global_index
from quarry.sources.batch_table import BatchTable


class IdTable:
    """Ids of the distinct values loaded so far; ``value`` names the column and its type is kept."""

    def __init__(self, spark, path: str, value: str, id_col: str = "id"):
        self.value, self.id_col = value, id_col
        self.table = BatchTable(spark, path, [value])

    def load(self, values: DataFrame) -> int:
        """Give ids to the values that have none (nulls get none); returns how many are new."""
        new = values.select(self.value).where(F.col(self.value).isNotNull()).distinct()
        known = self.table.read()
        first = 0
        if known is not None:
            first = (known.agg(F.max(self.id_col)).first()[0] + 1) if not known.isEmpty() else 0
            new = new.join(known.select(self.value), self.value, "left_anti")
        numbered = with_global_index(new, [F.col(self.value)], self.id_col).withColumn(self.id_col, (F.col(self.id_col) + first).cast("long"))
        number = self.table.manifest()["last"] + 1
        self.table.write(numbered.select(self.value, self.id_col), number)
        return self.table.batch(number).count()

    def read(self) -> DataFrame:
        """``(value, id)``."""
        return self.table.read()

    def encode(self, df: DataFrame, column: str, out: str) -> DataFrame:
        """``df`` with the id of ``column`` as ``out``; null where the value has none."""
        ids = self.read().select(F.col(self.value).alias("_value"), F.col(self.id_col).alias(out))
        return df.join(ids, df[column] == F.col("_value"), "left").drop("_value")
