"""Keyed merges: in-batch de-duplication, upsert, insert-if-absent, truncate-load.

Semantics kept from the row-by-row original:

* An update replaces every *mapped* column, also with NULL; target columns
  the batch does not map keep their old value.
* Several batch rows with one key: the last (by ``_seq``) wins under
  update, the first under insert-if-absent; ``keep='error'`` raises.
* A NULL in a conflict key never matches (UNIQUE-constraint semantics):
  such rows are always inserted and never de-duplicated.

Physical shape: target and batch meet in one full outer join on the keys,
each scanned once; flags tell which side a row has. Keys are unique after
de-duplication, so the join has no hot keys; rows with a NULL key, which never
match, are hashed to one partition, so keep them few (readers reject them).
``KeyedTable.merge`` hands in only the days of the target that the batch has.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


class DuplicateKeyError(ValueError):
    pass


class EmptyInputError(ValueError):
    pass


def _any_null(keys) -> Column:
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def _no_null(keys) -> Column:
    return ~_any_null(keys)


def dedupe(batch: DataFrame, keys, order: str = "_seq", keep: str = "last") -> DataFrame:
    """One row per non-NULL key: the last or first by ``order``.

    ``max_by``/``min_by`` over the row struct aggregates partially on the
    map side, so a key holding a third of the batch is reduced to one row
    per task before the shuffle (a window over the key would instead put
    all of its rows into one task). Rows with a NULL key are never merged:
    they carry their own (unique) ``order`` value as an extra grouping
    column, which is NULL for every other row. One pass, no union, so the
    batch's upstream plan runs once.
    """
    keys = list(keys)
    if keep == "error":
        assert_unique(batch, keys)
        return batch
    if keep not in ("last", "first"):
        raise ValueError(f"keep must be 'last', 'first' or 'error', not {keep!r}")
    cols = batch.columns
    others = [c for c in cols if c not in keys]
    bypass = F.when(_any_null(keys), F.col(order)).alias("_nullkey_row")
    pick = F.max_by if keep == "last" else F.min_by
    picked = (batch.groupBy(*keys, bypass)
                   .agg(pick(F.struct(*others), F.col(order)).alias("_row"))
                   .select(*keys, "_row.*"))
    return picked.select(*cols)


def assert_unique(batch: DataFrame, keys) -> None:
    dup = (batch.where(_no_null(keys)).groupBy(*keys).count()
                .where(F.col("count") > 1).limit(1))
    if not dup.isEmpty():
        raise DuplicateKeyError(f"duplicate conflict keys in batch: {dup.first()}")


def align(df: DataFrame, schema) -> DataFrame:
    """The columns of ``schema`` in its order and types; missing ones as NULLs."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[(F.col(f.name) if have[f.name] == f.dataType else F.col(f.name).cast(f.dataType)).alias(f.name)
                       if f.name in have else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


def _meet(target: DataFrame, batch: DataFrame, keys) -> DataFrame:
    """Full outer join: keys, structs ``_t`` and ``_b`` (NULL where the side has no row)."""
    t = target.select(*keys, F.struct(*target.columns).alias("_t"))
    b = batch.select(*keys, F.struct(*batch.columns).alias("_b"))
    return t.join(b, list(keys), "full_outer")


def _prepared(target: DataFrame, batch: DataFrame, keys, order, keep, mapped) -> tuple[DataFrame, list]:
    mapped = list(mapped) if mapped else [c for c in batch.columns if c in target.columns]
    if order and order in batch.columns:
        batch = dedupe(batch, keys, order, keep)
    types = {f.name: f.dataType for f in target.schema.fields}
    return batch.select(*[F.col(c).cast(types[c]).alias(c) for c in mapped]), mapped


def upsert_update(target: DataFrame, batch: DataFrame, keys, order: str | None = "_seq",
                  keep: str = "last", mapped=None) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO UPDATE SET <mapped> as a new table.

    ``mapped`` defaults to the batch columns that exist in the target.
    """
    keys = list(keys)
    b, mapped = _prepared(target, batch, keys, order, keep, mapped)
    new = F.col("_b").isNotNull()
    return _meet(target, b, keys).select(*[
        (F.when(new, F.col("_b")[c]).otherwise(F.col("_t")[c]) if c in mapped else F.col("_t")[c]).alias(c)
        for c in target.columns])


def upsert_nothing(target: DataFrame, batch: DataFrame, keys, order: str | None = "_seq",
                   keep: str = "first", mapped=None) -> DataFrame:
    """INSERT ... ON CONFLICT (keys) DO NOTHING as a new table.

    Target rows never change; batch rows whose key exists are dropped. To
    store the result, let ``KeyedTable.merge`` append the new rows instead.
    """
    keys = list(keys)
    b, mapped = _prepared(target, batch, keys, order, keep, mapped)
    old = F.col("_t").isNotNull()
    return _meet(target, b, keys).select(*[
        (F.when(old, F.col("_t")[c]).otherwise(F.col("_b")[c]) if c in mapped else F.col("_t")[c]).alias(c)
        for c in target.columns])


def check_policy(policy: str) -> None:
    if policy not in ("update", "nothing"):
        raise ValueError(f"policy must be 'update' or 'nothing', not {policy!r}")


def upsert(target: DataFrame, batch: DataFrame, keys, policy: str = "update", **kw) -> DataFrame:
    """Switchable conflict policy: 'update' or 'nothing'."""
    check_policy(policy)
    return (upsert_update if policy == "update" else upsert_nothing)(target, batch, keys, **kw)


def merge_counts(target: DataFrame, batch: DataFrame, keys, order: str | None = "_seq",
                 keep: str = "last") -> DataFrame:
    """(inserted, updated, total) for merging ``batch`` into ``target``."""
    keys = list(keys)
    if order and order in batch.columns:
        batch = dedupe(batch, keys, order, keep)
    flagged = batch.select(*keys).join(target.select(*keys, F.lit(1).alias("_m")), keys, "left")
    return flagged.agg(F.sum(F.when(F.col("_m").isNull(), 1).otherwise(0)).cast("long").alias("inserted"),
                       F.count("_m").cast("long").alias("updated"),
                       F.count(F.lit(1)).cast("long").alias("total"))


def check_empty(batch: DataFrame, on_empty: str = "skip") -> bool:
    """True when the batch is empty; raises under ``on_empty='error'``."""
    if on_empty not in ("skip", "error"):
        raise ValueError(f"on_empty must be 'skip' or 'error', not {on_empty!r}")
    empty = batch.isEmpty()
    if empty and on_empty == "error":
        raise EmptyInputError("input batch is empty")
    return empty


def truncate_load(batch: DataFrame, keys=None, order: str | None = "_seq",
                  columns=None) -> DataFrame:
    """Truncate, then load: the new table is the (de-duplicated) batch.

    As in the original, the truncate does not depend on the batch being
    non-empty: an empty load yields an empty table.
    """
    if keys and order and order in batch.columns:
        batch = dedupe(batch, keys, order, "last")
    return batch.select(*(columns or [c for c in batch.columns if c != order]))
