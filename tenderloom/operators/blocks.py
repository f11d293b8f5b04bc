"""Order-dependent work on keys of any size.

An id, link or field may own a third of all rows, so an ordered pass over a key is never
one window. Rows are cut into blocks by their order value, each (key, block) is worked
on with a window bounded by the block size, and only one summary row per block meets
again under the key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 16


def block_of(order: Column | str, bits: int = BLOCK_BITS) -> Column:
    """Block number of a whole-number order value: at most 2**bits distinct values each."""
    c = F.col(order) if isinstance(order, str) else order
    return F.shiftright(c.cast("bigint"), bits)


def blocked_lag(
    df: DataFrame, keys: list[str], order: list[str], block: Column, value: str, out: str
) -> DataFrame:
    """``lag(value)`` over (keys, order) without ever holding a whole key in one task.

    ``block`` must not decrease along ``order``.
    """
    rows = df.withColumn("_block", block)
    inside = Window.partitionBy(*keys, "_block").orderBy(*order)
    rows = rows.withColumns({
        "_rn": F.row_number().over(inside),
        "_prev": F.lag(F.struct(value)).over(inside),
    })
    ends = rows.groupBy(*keys, "_block").agg(
        F.max_by(F.struct(value), F.struct(*order)).alias("_last")
    )
    across = Window.partitionBy(*keys).orderBy("_block")
    carried = ends.select(*keys, "_block", F.lag("_last").over(across).alias("_carry"), F.lit(1).alias("_rn"))
    # only the first row of a block looks back, so each summary meets one row
    joined = rows.join(carried, [*keys, "_block", "_rn"], "left")
    return joined.withColumn(
        out, F.coalesce(F.col("_prev"), F.col("_carry"))[value]
    ).drop("_block", "_rn", "_prev", "_carry")
