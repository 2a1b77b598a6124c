"""Keyed merge helpers: dedupe, insert-if-absent, upsert, combine.

Design for skew: "first/last writer wins" is an aggregation
``min/max(struct(order..., payload...))`` grouped by the key, not a
``row_number()`` window. The aggregate (sort-based: a struct is no mutable
buffer type) combines map-side, so a key that holds a third of all rows is
reduced inside every map task before the shuffle, and no task ever holds a
whole group.

No lookup is broadcast by hand: Spark's own byte threshold and AQE decide from
measured sizes, and no job runs while a plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_ORD = "__ord"


def pick_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], *,
                 last: bool = False, count: str | None = None) -> DataFrame:
    """One row per key: the first (or last) row under ``order``. ``count`` names
    a number column that is summed up over the key's rows.

    ``order`` must be a total order within a key for a deterministic pick
    (add the remaining columns as tie-breakers).
    """
    order_cols = [F.col(o) if isinstance(o, str) else o for o in order]
    wanted = [c for c in df.columns if c not in keys and c != count]
    # a column that orders is carried once, as such
    at = {o: f"o{i}" for i, o in enumerate(order) if isinstance(o, str)}
    packed = F.struct(*[o.alias(f"o{i}") for i, o in enumerate(order_cols)],
                      *[F.col(c).alias(c) for c in wanted if c not in at])
    agg = F.max(packed) if last else F.min(packed)
    out = df.groupBy(*keys).agg(agg.alias(_ORD), *([F.sum(count).alias(count)] if count else []))
    kept = [*keys, *([count] if count else [])]
    return out.select(*kept, *[F.col(f"{_ORD}.{at.get(c, c)}").alias(c) for c in wanted]).select(*df.columns)


def total_order(df: DataFrame, leading: Sequence[str]) -> list[str]:
    """leading columns, then every remaining column: a total order over distinct rows."""
    return list(leading) + [c for c in df.columns if c not in leading]


def insert_if_absent(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str],
                     order: Sequence[Column | str], *, null_safe: bool = False) -> DataFrame:
    """Rows of ``incoming`` whose key is not in ``existing``; in-batch
    duplicates collapse to the first under ``order`` (ON CONFLICT DO NOTHING)."""
    fresh = pick_per_key(incoming, keys, order)
    if existing is None:
        return fresh
    ex = existing.select(*keys).distinct() if not null_safe else existing.select(*keys)
    if null_safe:
        cond = None
        for k in keys:
            p = fresh[k].eqNullSafe(ex[k])
            cond = p if cond is None else cond & p
        return fresh.join(ex, cond, "left_anti")
    return fresh.join(ex, list(keys), "left_anti")


def upsert(existing: DataFrame, incoming: DataFrame, keys: Sequence[str],
           replace_cols: Sequence[str], *, mark: str | None = None) -> DataFrame:
    """Incoming rows replace ``replace_cols`` of matching keys; other columns
    of existing rows are kept; new keys are inserted (missing columns NULL).
    ``mark`` names a column that says what became of a row: inserted, updated
    or kept.

    A full outer join on the key: one shuffle, no per-key state.
    """
    e = existing.alias("e")
    i = incoming.alias("i")
    j = e.join(i, [F.col(f"e.{k}") == F.col(f"i.{k}") for k in keys], "full_outer")
    matched = F.col(f"i.{keys[0]}").isNotNull()
    cols = []
    for c in existing.columns:
        if c in keys:
            cols.append(F.coalesce(F.col(f"i.{c}"), F.col(f"e.{c}")).alias(c))
        elif c in replace_cols and c in incoming.columns:
            cols.append(F.when(matched, F.col(f"i.{c}")).otherwise(F.col(f"e.{c}")).alias(c))
        else:
            cols.append(F.col(f"e.{c}").alias(c))
    if mark:
        cols.append(F.when(F.col(f"e.{keys[0]}").isNull(), "inserted").when(matched, "updated").otherwise("kept")
                    .alias(mark))
    return j.select(*cols)


def combine(existing: DataFrame | None, incoming: DataFrame, keys: Sequence[str],
            aggs: dict[str, str], *, mark: str | None = None) -> DataFrame:
    """Merge with a combining function per column (e.g. {'first': 'min'});
    ``mark`` as in ``upsert``."""
    fns = {"min": F.min, "max": F.max, "sum": F.sum}
    cols = [fns[f](c).alias(c) for c, f in aggs.items()]
    if mark:
        incoming = incoming.withColumn("_came", F.lit(True))
        existing = existing if existing is None else existing.withColumn("_came", F.lit(False))
        cols.append(F.when(~F.bool_or("_came"), "kept").when(F.bool_and("_came"), "inserted").otherwise("updated")
                    .alias(mark))
    u = incoming if existing is None else existing.select(*incoming.columns).unionByName(incoming)
    return u.groupBy(*keys).agg(*cols)
