"""Keyed upserts and updates on immutable tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..config import checked_identifier
from ..functions.text import is_blank


def last_wins(df: DataFrame, keys: list[str], seq: list[str], drop_seq: bool = False) -> DataFrame:
    """Keep the row with the greatest ``seq`` per key.

    An aggregate, so each map task sends at most one row per key however many
    copies it holds.  ``seq`` is compared as a struct: NULL sorts first.
    """
    rest = [c for c in df.columns if c not in keys]
    newest = F.max_by(F.struct(*rest), F.struct(*seq)).alias("_row")
    kept = [c for c in rest if not (drop_seq and c in seq)]
    picked = df.groupBy(*keys).agg(newest).select(*keys, *[F.col(f"_row.{c}").alias(c) for c in kept])
    return picked.select([c for c in df.columns if c in keys or c in kept])


def keyed_union(old: DataFrame, new: DataFrame, keys: list[str], seq: list[str]) -> DataFrame:
    """Union of two keyed sets where a new row replaces the old one."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    return last_wins(both, keys, ["_new", *seq]).drop("_new")


def usable_key(df: DataFrame, keys: list[str]) -> Column:
    """Whether a row can be found by its key: no part is NULL, no text part is blank."""
    usable = F.lit(True)
    for key in keys:
        usable = usable & F.col(key).isNotNull()
        if isinstance(df.schema[key].dataType, StringType):
            usable = usable & ~is_blank(F.col(key))
    return usable


def merge(
    target: DataFrame,
    updates: DataFrame,
    keys: list[str],
    set_columns: list[str] | None = None,
    insert: bool = True,
    touch: dict[str, Column] | None = None,
) -> DataFrame:
    """Target after the updates: matched rows get every set column (also NULLs),
    other columns stay, unmatched updates are inserted when ``insert``.

    ``updates`` has one row per key (see ``last_wins``).  ``touch`` gives columns
    set on matched rows only.  Keys are unique, so no partition of the join is
    hot.  Rows without a usable key (NULL or blank) match nothing: those of the
    target stay as they are and never reach the join, those of the updates are
    inserted, whatever their number.
    """
    columns = target.columns
    present = [c for c in updates.columns if c not in keys and c in columns]
    changed = present if set_columns is None else set_columns
    found = usable_key(target, keys)
    new = updates.filter(usable_key(updates, keys)).select(
        *keys,
        *[F.col(c).alias(f"_new_{c}") for c in changed],
        F.lit(True).alias("_updated"),
    )
    old = target.filter(found).select("*", F.lit(True).alias("_existing"))
    joined = old.join(new, keys, "full_outer" if insert else "left_outer")
    updated = F.col("_updated").isNotNull()
    matched = updated & F.col("_existing").isNotNull()

    def value(name: str) -> Column:
        current = F.col(name)
        if name in changed:
            kind = target.schema[name].dataType
            return F.when(updated, F.col(f"_new_{name}").cast(kind)).otherwise(current)
        if touch and name in touch:
            return F.when(matched, touch[name]).otherwise(current)
        return current

    merged = joined.select([value(c).alias(c) for c in columns])
    aside = target.filter(~found)
    if insert:
        keyless = updates.filter(~usable_key(updates, keys))
        given = [c for c in columns if c in keys or c in changed]
        keyless = keyless.select(*[F.col(c).cast(target.schema[c].dataType).alias(c) for c in given])
        aside = aside.unionByName(keyless, allowMissingColumns=True)
    return merged.unionByName(aside)


def merge_into_table(
    updates: DataFrame,
    table: str,
    keys: list[str],
    set_columns: list[str],
    insert: bool = True,
    touch: dict[str, Column] | None = None,
) -> None:
    """The same merge on a catalog table whose format has row-level updates, so that
    only the files holding matched rows are rewritten."""
    name = ".".join(checked_identifier(part) for part in table.split("."))
    on = [F.col(f"{name}.{k}") == F.col(f"updates.{k}") for k in keys]
    condition = on[0]
    for part in on[1:]:
        condition = condition & part
    values = {c: F.col(f"updates.{c}") for c in set_columns}
    writer = updates.alias("updates").mergeInto(name, condition)
    writer = writer.whenMatched().update({**values, **(touch or {})})
    if insert:
        writer = writer.whenNotMatched().insert(
            {**{k: F.col(f"updates.{k}") for k in keys}, **values}
        )
    writer.merge()
