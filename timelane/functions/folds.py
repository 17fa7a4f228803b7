"""Sequential rules with a small state, cut into bounded pieces that Spark spreads over tasks.

A rule such as "start a new line when five words are full" depends on where the previous line started, so it
is no running sum.  Its state at a chunk boundary is one small integer, though.  Each chunk can therefore be
reduced on its own to a table "state on entry -> state on exit", the tables of one key are chained level by level, and
a second pass solves every chunk with its real entry state.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from timelane.functions.scalars import floor_div
from timelane.session import stage

#: Chunks that are chained at once.
FAN = 64


def whole_groups(batches: Iterator[pd.DataFrame], keys: Sequence[str]) -> Iterator[pd.DataFrame]:
    """Regroup sorted batches so that no bounded group is torn between two frames."""
    keys = list(keys)
    held: list[pd.DataFrame] = []
    for batch in batches:
        if batch.empty:
            continue
        last = batch[keys].iloc[-1]
        same = (batch[keys] == last).all(axis=1).to_numpy()
        cut = len(batch) - int(np.argmin(same[::-1])) if not same.all() else 0
        if cut == 0:
            if held and not (held[-1][keys].iloc[-1] == last).all():
                yield pd.concat(held, ignore_index=True)
                held = []
            held.append(batch)
            continue
        yield pd.concat([*held, batch.iloc[:cut]], ignore_index=True)
        held = [batch.iloc[cut:]]
    if held:
        yield pd.concat(held, ignore_index=True)


def group_starts(frame: pd.DataFrame, keys: Sequence[str]) -> np.ndarray:
    """Row positions where a new group starts, with the frame length appended."""
    values = [frame[k].to_numpy() for k in keys]
    changed = np.zeros(len(frame), dtype=bool)
    changed[0] = True
    for v in values:
        changed[1:] |= v[1:] != v[:-1]
    return np.append(np.flatnonzero(changed), len(frame))


def chain_entries(steps: DataFrame, key: str, index: str = "chunk") -> DataFrame:
    """Entry state of every chunk from the tables ``steps(key, index, step array)`` of its predecessors.

    A key starts in state 0 and its tables are numbered from 0 without gaps.  Composing tables is associative, so they
    are chained in a tree: ``FAN`` neighbours become one table, those are chained the same way, and what enters a group
    is then led through its own tables.  No task meets more than ``FAN`` chunks of a key at once.
    """
    fan = FAN
    steps = stage(steps.select(key, F.col(index).cast("bigint").alias(index), "step"), "steps")
    group = floor_div(F.col(index), fan)
    tables = steps.groupBy(key, group.alias("_group")).agg(F.array_sort(F.collect_list(F.struct(index, "step"))).alias("_tables"))
    if (steps.agg(F.max(index)).first()[0] or 0) < fan:
        entered = tables.withColumn("entry", F.lit(0).cast("bigint"))
    else:
        through = F.aggregate(F.slice("_tables", 2, fan), F.col("_tables")[0]["step"], lambda whole, t: F.transform(whole, lambda state: F.get(t["step"], state.cast("int"))))
        above = chain_entries(tables.select(key, F.col("_group").alias(index), through.alias("step")), key, index)
        entered = tables.join(above.withColumnRenamed(index, "_group"), [key, "_group"], "left").withColumn("entry", F.coalesce("entry", F.lit(0).cast("bigint")))
    states = F.aggregate(
        "_tables",
        F.array(F.struct((F.col("_group") * fan).alias(index), F.col("entry").alias("entry"))),
        lambda found, t: F.concat(found, F.array(F.struct((t[index] + 1).alias(index), F.get(t["step"], F.element_at(found, -1)["entry"].cast("int")).alias("entry")))),
    )
    # The state on a group's first chunk comes from the group before it.
    return entered.select(key, F.explode(F.slice(states, 2, fan)).alias("_state")).select(key, f"_state.{index}", "_state.entry")
