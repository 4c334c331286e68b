"""MERGE semantics as a DataFrame plan.

``WHEN MATCHED THEN UPDATE SET <subset>`` + ``WHEN NOT MATCHED THEN INSERT
ROW``, target-only rows kept. Plain parquet has no MERGE, so the merge is a
full outer join on the key with literal presence markers:

* matched   → listed columns from the source (a NULL source value overwrites),
              every other column from the target;
* source only → the whole source row;
* target only → the whole target row.

NULL keys never match (SQL equality), so such rows pass through as
unmatched. A source key that matches a target row more than once fails the
job (``MERGE_CARDINALITY_VIOLATION``) from inside the plan: the check costs
no extra pass and nothing is written when it trips.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickerlake.schema import KEY_COLUMNS

_S, _T, _N = "_src_present", "_tgt_present", "_src_copies"


def merge_plan(
    target: DataFrame,
    source: DataFrame,
    update_columns: Sequence[str],
    keys: Sequence[str] = tuple(KEY_COLUMNS),
    check_cardinality: bool = True,
    dealt: bool = False,
) -> DataFrame:
    """The merged rows, in the target's column order.

    ``source`` must carry every target column (extra columns are dropped) and
    should be de-duplicated (R5), after which it has one row per key, NULL keys
    included.
    The join and the per-key copy count share one hash partitioning on the
    keys, so the plan has exactly one shuffle per side. With ``dealt`` both sides are hashed by some of
    the keys, into as many partitions, already: then the plan has none, and merged rows stay where their sides were dealt to.
    """
    keys = list(keys)
    cols = target.columns
    missing = [c for c in cols if c not in source.columns]
    if missing:
        raise ValueError(f"source lacks target columns: {missing}")
    unknown = [c for c in update_columns if c not in cols or c in keys]
    if unknown:
        raise ValueError(f"cannot update {unknown}: not a non-key target column")

    s = source.select(*[F.col(f"`{c}`") for c in cols]).withColumn(_S, F.lit(True))
    if check_cardinality:
        s = s.withColumn(_N, F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    # Target rows without a whole key match nothing: they bypass the join, where
    # all of a date's would meet in one task. (Where sides are dealt, these are dealt too.)
    no_key = F.greatest(*[F.col(f"`{k}`").isNull() for k in keys])
    t = (target if dealt else target.where(~no_key)).withColumn(_T, F.lit(True))

    sa, ta = s.alias("s"), t.alias("t")
    cond = None
    for k in keys:
        eq = F.col(f"s.`{k}`") == F.col(f"t.`{k}`")
        cond = eq if cond is None else cond & eq
    joined = sa.join(ta, cond, "full_outer")

    matched = F.col(f"s.{_S}").isNotNull() & F.col(f"t.{_T}").isNotNull()
    src_only = F.col(f"t.{_T}").isNull()
    update = set(update_columns)
    out = []
    for c in cols:
        sc, tc = F.col(f"s.`{c}`"), F.col(f"t.`{c}`")
        if c in update:
            expr = F.when(F.col(f"s.{_S}").isNotNull(), sc).otherwise(tc)
        else:
            expr = F.when(src_only, sc).otherwise(tc)
        out.append(expr)
    if check_cardinality:
        violation = matched & (F.col(f"s.{_N}") > 1)
        message = F.concat(
            F.lit("MERGE_CARDINALITY_VIOLATION: source key matched more than once: "),
            F.to_json(F.struct(*[F.col(f"s.`{k}`") for k in keys])),
        )
        # The check rides on the first key column so it can never be pruned.
        k0 = cols.index(keys[0])
        out[k0] = F.when(violation, F.raise_error(message)).otherwise(out[k0])
    merged = joined.select(*[e.alias(c) for e, c in zip(out, cols)])
    return merged if dealt else merged.unionByName(target.where(no_key))
