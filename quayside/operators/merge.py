"""Row-level change without a merge-capable table format: every function
returns the new table content, to be written as a new version."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

AUDIT = ["first_time_inserted", "last_modified"]


def _on(keys: Sequence[str], when: Column | None) -> Column:
    on = F.lit(True)
    for key in keys:
        on = on & (F.col(f"t.{key}") == F.col(f"s.{key}"))
    return on if when is None else on & when


def merge_upsert(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update: Sequence[str] | None = None,
    insert: Sequence[str] | None = None,
    matched_when: Column | None = None,
    as_of: Column | None = None,
) -> DataFrame:
    """Matched rows take ``update`` columns from the source, unmatched source rows
    are inserted with ``insert`` columns, other target rows stay. ``matched_when``
    may refer to ``t.<column>`` and ``s.<column>``. Audit columns of the target are
    kept up to date from ``as_of``. Source keys must be unique."""
    columns = [c for c in target.columns if c not in AUDIT]
    update = [c for c in columns if c in source.columns and c not in keys] if update is None else update
    insert = [c for c in columns if c in source.columns] if insert is None else insert
    t = target.withColumn("_t", F.lit(True)).alias("t")
    s = source.withColumn("_s", F.lit(True)).alias("s")
    joined = t.join(s, _on(keys, matched_when), "full")
    in_target, in_source = F.col("t._t").isNotNull(), F.col("s._s").isNotNull()

    out = []
    for c in columns:
        value = F.col(f"t.{c}")
        if c in update:
            value = F.when(in_target & in_source, F.col(f"s.{c}")).otherwise(value)
        if c in insert:
            value = F.when(~in_target, F.col(f"s.{c}")).otherwise(value)
        out.append(value.alias(c))
    if as_of is not None:
        if "first_time_inserted" in target.columns:
            first = F.coalesce(F.col("t.first_time_inserted"), F.when(in_source, as_of))
            out.append(first.alias("first_time_inserted"))
        if "last_modified" in target.columns:
            out.append(F.when(in_source, as_of).otherwise(F.col("t.last_modified")).alias("last_modified"))
    return joined.select(*out)


def sync_actions(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """What :func:`merge_sync` will do, per key: INSERT, UPDATE or DISABLE."""
    t = target.select(*keys).withColumn("_t", F.lit(True))
    s = source.select(*keys).withColumn("_s", F.lit(True))
    action = F.when(F.col("_s").isNull(), "DISABLE").when(F.col("_t").isNull(), "INSERT").otherwise("UPDATE")
    return t.join(s, list(keys), "full").select(*keys, action.alias("action"))


def merge_sync(target: DataFrame, source: DataFrame, keys: Sequence[str], as_of: Column) -> DataFrame:
    """The target made equal to the source: new rows in, changed rows updated,
    rows absent from the source dropped. The first insert time survives."""
    first = target.select(*keys, F.col("first_time_inserted").alias("_first"))
    return (
        source.join(first, list(keys), "left")
        .withColumn("first_time_inserted", F.coalesce("_first", as_of))
        .withColumn("last_modified", as_of)
        .drop("_first")
    )


def count_actions(actions: DataFrame) -> DataFrame:
    return actions.groupBy("action").agg(F.count(F.lit(1)).alias("n_rows"))


def conform(df: DataFrame, schema: Mapping[str, str]) -> DataFrame:
    """Rows under a new schema: shared columns are cast (bad values to NULL), new
    columns are NULL, columns that are gone are left out. Names match without case."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(have[name.lower()]).try_cast(kind) if name.lower() in have else F.lit(None).cast(kind)).alias(name)
            for name, kind in schema.items()
        ]
    )


def schema_changes(old: Mapping[str, str], new: Mapping[str, str]) -> list[tuple[str, str, str | None, str | None]]:
    """``(column, added|removed|retyped, old type, new type)`` between two schemas."""
    before = {k.lower(): v for k, v in old.items()}
    after = {k.lower(): v for k, v in new.items()}
    changes: list[tuple[str, str, str | None, str | None]] = []
    for name, kind in new.items():
        if name.lower() not in before:
            changes.append((name, "added", None, kind))
        elif before[name.lower()] != kind:
            changes.append((name, "retyped", before[name.lower()], kind))
    changes += [(name, "removed", kind, None) for name, kind in old.items() if name.lower() not in after]
    return changes


def schema_of(df: DataFrame) -> dict[str, str]:
    return dict(df.dtypes)
