"""Which side of a join travels, decided by a measured size.

A lookup derived from a catalog (one row per persona, say) may be tiny although the catalog is large, which the
optimizer cannot know before it runs.  Where its own estimate is no use, one counted pass settles it: a small lookup is broadcast and the large side stays
where it is; any other is shuffled, where adaptive joins split a persona with very many rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType, StructType


class Sides:
    #: Largest lookup that is broadcast, in bytes of its values.
    broadcast_bytes = 64 << 20


def _bytes(column: Column, kind: DataType) -> Column:
    if isinstance(kind, StructType):
        return sum((_bytes(column.getField(f.name), f.dataType) for f in kind), F.lit(8))
    if isinstance(kind, StringType):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, ArrayType):
        return F.aggregate(F.coalesce(column, F.array().cast(kind)), F.lit(16), lambda size, x: size + _bytes(x, kind.elementType).cast("int"))
    return F.lit(8)


def value_bytes(table: DataFrame) -> int:
    size = sum((_bytes(F.col(f.name), f.dataType) for f in table.schema), F.lit(16))
    return table.agg(F.sum(size.cast("bigint"))).first()[0] or 0


def _left_to_the_optimizer(lookup: DataFrame) -> bool:
    """Its estimate, an upper bound from the sizes of the files, is already small enough for it to broadcast."""
    threshold = lookup.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    return lookup._jdf.queryExecution().optimizedPlan().stats().sizeInBytes() <= threshold


def beside(lookup: DataFrame) -> DataFrame:
    """``lookup`` as the side of a join that travels whole if it is small enough for that."""
    if _left_to_the_optimizer(lookup) or value_bytes(lookup) > Sides.broadcast_bytes:
        return lookup
    return F.broadcast(lookup)
