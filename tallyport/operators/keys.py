"""Key checks: duplicates, orphans, excluded parents and consistent subsets.

Child rows are counted per key value before any join, or together with the parent's keys.  A key
value that a third of the rows share is thus one row per map task when it is shuffled.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyport.functions.canon import split_columns
from tallyport.runtime import default_partitions, settle_table
from tallyport.specs import ForeignKey


# Status and reason of an item that depends on something excluded.
NEEDS_REVIEW = "NEEDS_REVIEW"
DEPENDENT_REASON = "References excluded table(s): "


def _names(columns: Sequence[str] | str) -> list[str]:
    names = [columns] if isinstance(columns, str) else list(columns)
    if not names:
        raise ValueError("key columns must not be empty")
    return names


def all_set(columns: Sequence[str]) -> Column:
    return reduce(and_, [F.col(c).isNotNull() for c in columns])


def partly_set(columns: Sequence[str]) -> Column:
    """True where some but not all key columns are null."""
    return reduce(or_, [F.col(c).isNull() for c in columns]) & reduce(
        or_, [F.col(c).isNotNull() for c in columns]
    )


# --- duplicates --------------------------------------------------------------------


def duplicate_groups(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values that occur more than once, with their counts; keys with a null do not
    count as equal."""
    keys = _names(keys)
    return df.where(all_set(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The number of such key values, in one row."""
    return duplicate_groups(df, keys).agg(F.count(F.lit(1)).alias("duplicate_groups"))


def key_candidates(df: DataFrame, table: str, candidates: Sequence[Sequence[str]]) -> DataFrame:
    """For each set of columns: rows, rows with a null, distinct values, and whether the
    set could be the primary key.

    One aggregation per set, which reads only its columns.
    """
    result = None
    for candidate in candidates:
        columns = _names(candidate)
        complete = all_set(columns)
        one = (
            df.groupBy(*columns)
            .agg(F.count(F.lit(1)).alias("_rows"))
            .agg(
                F.coalesce(F.sum("_rows"), F.lit(0)).alias("row_count"),
                F.coalesce(F.sum(F.when(~complete, F.col("_rows"))), F.lit(0)).alias("null_rows"),
                F.count_if(complete).alias("distinct_keys"),
                F.coalesce(F.max(F.when(complete, F.col("_rows"))), F.lit(0)).alias("most_copies"),
            )
            .select(
                F.lit(table).alias("table_name"),
                F.lit(", ".join(columns)).alias("key_columns"),
                "*",
                ((F.col("null_rows") == 0) & (F.col("most_copies") <= 1)).alias("is_key"),
            )
        )
        result = one if result is None else result.unionByName(one)
    if result is None:
        raise ValueError("no candidate keys given")
    return result


# --- foreign keys ------------------------------------------------------------------


def _aligned(columns: Sequence[str] | str, parent_columns: Sequence[str] | str):
    columns, parent_columns = _names(columns), _names(parent_columns)
    if len(columns) != len(parent_columns):
        raise ValueError("foreign key columns and referenced columns must be aligned")
    return columns, parent_columns


def _counted(child: DataFrame, columns: Sequence[str]) -> DataFrame:
    return child.groupBy(*columns).agg(F.count(F.lit(1)).alias("_rows"))


def _as_key(parent: DataFrame, parent_columns: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """The parent's distinct keys under the child's column names.

    Distinct although a parent key ought to be: a value that occurs very often is combined
    before the shuffle, and the join uses the shuffle that this makes.
    """
    named = [F.col(p).alias(c) for p, c in zip(parent_columns, columns, strict=True)]
    return parent.where(all_set(parent_columns)).select(*named).distinct()


def _matched(
    child: DataFrame, parent: DataFrame, columns: Sequence[str], parent_columns: Sequence[str], joined: bool
) -> DataFrame:
    """Key values of the child with ``child_rows``, and whether the parent has them, ``_known``.

    Keys of the same types are one aggregation over both tables: a task holds each key value once,
    and nothing is sorted.  Keys whose types differ are compared as a join compares them.
    """
    if joined or any(child.schema[c].dataType != parent.schema[p].dataType for c, p in zip(columns, parent_columns, strict=True)):
        known = _as_key(parent, parent_columns, columns).withColumn("_known", F.lit(True))
        joined = _counted(child, columns).join(known, columns, "left").withColumnRenamed("_rows", "child_rows")
        return joined.withColumn("_known", F.coalesce("_known", F.lit(False)))
    named = [F.col(p).alias(c) for p, c in zip(parent_columns, columns, strict=True)]
    one, none = F.lit(1).cast("bigint").alias("_rows"), F.lit(0).cast("bigint").alias("_rows")
    held = parent.where(all_set(parent_columns)).select(*named, none, F.lit(True).alias("_known"))
    united = child.select(*columns, one, F.lit(False).alias("_known")).unionByName(held)
    found = united.groupBy(*columns).agg(F.sum("_rows").alias("child_rows"), F.max("_known").alias("_known"))
    return found.where("child_rows > 0")


def orphan_keys(
    child: DataFrame, parent: DataFrame, columns: Sequence[str], parent_columns: Sequence[str]
) -> DataFrame:
    """Foreign-key values without a parent, with the number of child rows that hold them."""
    columns, parent_columns = _aligned(columns, parent_columns)
    return (
        _counted(child.where(all_set(columns)), columns)
        .join(_as_key(parent, parent_columns, columns), columns, "left_anti")
        .withColumnRenamed("_rows", "child_rows")
    )


def fk_orphans(
    child: DataFrame, parent: DataFrame, columns: Sequence[str], parent_columns: Sequence[str]
) -> DataFrame:
    """Child rows without a parent under MATCH SIMPLE, in one row."""
    found = orphan_keys(child, parent, columns, parent_columns)
    return found.agg(F.coalesce(F.sum("child_rows"), F.lit(0)).alias("orphans"))


def fk_orphans_full(
    child: DataFrame,
    parent: DataFrame,
    columns: Sequence[str],
    parent_columns: Sequence[str],
    joined: bool = False,
) -> DataFrame:
    """Orphans under MATCH SIMPLE and MATCH FULL in one row, from one scan of the child.

    FULL also counts composite keys that are partly null; for a single column both rules
    agree.  ``joined`` counts each table's keys apart and joins them, with several times the memory.
    """
    columns, parent_columns = _aligned(columns, parent_columns)
    rows = _matched(child.where(all_set(columns) | partly_set(columns)), parent, columns, parent_columns, joined)
    missing = F.when(all_set(columns) & ~F.col("_known"), F.col("child_rows"))
    partial = F.when(partly_set(columns), F.col("child_rows"))
    return rows.agg(
        F.coalesce(F.sum(missing), F.lit(0)).alias("simple_orphans"),
        F.coalesce(F.sum(F.coalesce(missing, partial)), F.lit(0)).alias("full_orphans"),
    )


def orphans_by_rule(child: DataFrame, parent: DataFrame, key: ForeignKey, joined: bool = True) -> DataFrame:
    """The ``orphans`` of a foreign key under its own match rule; ``joined`` as for :func:`fk_orphans_full`."""
    if key.match == "full" and len(key.columns) > 1:
        both = fk_orphans_full(child, parent, key.columns, key.parent_columns, joined=joined)
        return both.select(F.col("full_orphans").alias("orphans"))
    return fk_orphans(child, parent, key.columns, key.parent_columns)


# --- exclusion ---------------------------------------------------------------------


def excluded_parent_impact(
    child: DataFrame, excluded_parents: DataFrame, columns: Sequence[str], parent_columns: Sequence[str]
) -> DataFrame:
    """Child rows per key value of an excluded parent: rows that cannot keep their parent."""
    columns, parent_columns = _aligned(columns, parent_columns)
    return (
        _counted(child.where(all_set(columns)), columns)
        .join(_as_key(excluded_parents, parent_columns, columns), columns, "left_semi")
        .withColumnRenamed("_rows", "child_rows")
    )


def excluded_dependents(
    dependencies: DataFrame, item: str, dependency: str, excluded: Sequence[str], position: str | None = None
) -> DataFrame:
    """Items that depend on something excluded, with the reason in words.

    ``excluded`` is the caller's list of names, compared in any letter case.  An item's
    dependencies are made distinct before they are gathered, so a list never outgrows
    ``excluded``.  They come in order of ``position`` where one is given.
    """
    if not excluded:
        raise ValueError("no excluded names given")
    names = sorted({name.lower() for name in excluded})
    place = F.min(position) if position else F.lit(0)
    hits = (
        dependencies.where(F.lower(dependency).isin(names))
        .groupBy(F.col(item), F.col(dependency).alias("_dependency"))
        .agg(place.alias("_place"))
    )
    listed = F.sort_array(F.collect_list(F.struct("_place", "_dependency")))
    return (
        hits.groupBy(item)
        .agg(listed.alias("_hits"))
        .select(
            item,
            F.lit(NEEDS_REVIEW).alias("status"),
            F.concat(F.lit(DEPENDENT_REASON), F.array_join(F.col("_hits._dependency"), ", ")).alias("reason"),
        )
    )


# --- consistent subsets ------------------------------------------------------------


def parent_first(tables: Sequence[str], keys: Sequence[ForeignKey]) -> list[str]:
    """Table names with every parent before its children.

    References of a table to itself and to tables outside the list do not matter; a
    circle among the tables is an error.
    """
    waiting = {t.upper(): set() for t in tables}
    for key in keys:
        child, parent = key.child.upper(), key.parent.upper()
        if child in waiting and parent in waiting and child != parent:
            waiting[child].add(parent)
    named = {t.upper(): t for t in tables}
    ordered: list[str] = []
    while waiting:
        free = [t for t, parents in waiting.items() if not parents]
        if not free:
            raise ValueError(f"circular foreign keys among tables: {', '.join(waiting)}")
        ordered.extend(named[t] for t in free)
        for table in free:
            del waiting[table]
        for parents in waiting.values():
            parents.difference_update(free)
    return ordered


def fk_closed_subset(tables: Mapping[str, DataFrame], keys: Sequence[ForeignKey]) -> dict[str, DataFrame]:
    """Cut every table down to rows whose parents are in the (already cut) parent tables.

    Rows with a null in the foreign key have no parent to lose and stay.  Where a table refers
    to itself, rows that lose their parent go in rounds until none does; each round's table is
    written to the shared folder.
    """
    cut: dict[str, DataFrame] = {}
    given = {name.upper(): df for name, df in tables.items()}
    for name in parent_first(list(tables), keys):
        df = given[name.upper()]
        for key in keys:
            parent = key.parent.upper()
            if key.child.upper() == name.upper() and parent != name.upper() and parent in cut:
                df = _with_parent(df, cut[parent], key)
        own = [k for k in keys if k.child.upper() == k.parent.upper() == name.upper()]
        cut[name.upper()] = _closed_on_itself(df, own) if own else df
    return {name: cut[name.upper()] for name in tables}


def _closed_on_itself(df: DataFrame, keys: Sequence[ForeignKey]) -> DataFrame:
    rows = df.count()
    while True:
        for key in keys:
            df = _with_parent(df, df, key)
        df = settle_table(df, "closed")
        left = df.count()
        if left == rows:
            return df
        rows = left


def _with_parent(child: DataFrame, parent: DataFrame, key: ForeignKey) -> DataFrame:
    """Child rows that have a parent or need none, by one semi join.

    Rows that need none look for one of a few open slots instead of a parent, so nulls
    spread over as many tasks as there are slots.  Both sides of the join are plain
    shuffles, which lets AQE split the child rows of a frequent key.
    """
    spark = child.sparkSession
    slots = default_partitions(spark)
    complete = all_set(key.columns)
    free = F.pmod(F.xxhash64(*split_columns(child.schema)[0]), F.lit(slots))
    sought = child.select(
        "*",
        F.when(complete, F.lit(-1).cast("bigint")).otherwise(free).alias("_slot"),
        *[F.when(complete, F.col(c)).alias(f"_child{i}") for i, c in enumerate(key.columns)],
    )
    names = [f"_parent{i}" for i in range(len(key.columns))]
    known = _as_key(parent, key.parent_columns, names).select(F.lit(-1).cast("bigint").alias("_open"), "*")
    open_slots = spark.range(slots).select(
        F.col("id").alias("_open"), *[F.lit(None).cast(f.dataType).alias(f.name) for f in known.schema[1:]]
    )
    match = [F.col("_slot") == F.col("_open")]
    match += [F.col(f"_child{i}").eqNullSafe(F.col(f"_parent{i}")) for i in range(len(key.columns))]
    kept = sought.join(known.unionByName(open_slots), reduce(and_, match), "left_semi")
    return kept.select(*child.columns)
