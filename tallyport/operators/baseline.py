"""Stored fingerprints of a table: a tree of digests with the settings that it was made by.

Leaves are digests of key ranges (:func:`~tallyport.operators.compare.chunk_digests`).  A node
above holds the SHA-256 of its ``fanout`` children, up to one root.  Two tables are compared
from the root down: only children of nodes that differ are looked at, so equal tables cost
one comparison, and one changed row costs ``fanout`` of them per level.  The rows behind a
tree are read once, when it is made; trees can be made in different places and compared.

A baseline is only as good as the question it answers, so key, range size, first key, columns
with their types, scales, method and fanout are stored with it, with their own SHA-256.  A
comparison with other settings, or with a description that was changed, is an error.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import asdict, dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyport.functions.canon import PORTABLE, split_columns
from tallyport.operators.chunks import chunk_id, whole_div
from tallyport.operators.compare import FINGERPRINT_VERSION, chunk_digests
from tallyport.runtime import settle_table
from tallyport.sources.tables import path_exists, remove_rows

FANOUT = 64
_DIGEST = ("row_count", "hash_xor", "hash_sum")


class BaselineMismatch(ValueError):
    """The stored baseline was made by other settings than those asked for."""


@dataclass(frozen=True)
class Description:
    """The settings of a digest tree.  ``low`` is the key at which range 1 starts, as text."""

    table: str
    key: str
    size: int
    low: str | None
    columns: tuple[tuple[str, str], ...]
    scales: tuple[tuple[str, int], ...] = ()
    method: str = PORTABLE
    fanout: int = FANOUT
    version: str = FINGERPRINT_VERSION

    def text(self) -> str:
        return json.dumps(asdict(self), sort_keys=True)

    def sha256(self) -> str:
        return hashlib.sha256(self.text().encode()).hexdigest()

    @staticmethod
    def parse(text: str) -> Description:
        held = json.loads(text)
        for name in ("columns", "scales"):
            held[name] = tuple(tuple(pair) for pair in held[name])
        return Description(**held)

    def require(self, other: Description) -> None:
        """Raise unless ``other`` has the same settings; each has its own first key."""
        mine, theirs = asdict(replace(self, low=None)), asdict(replace(other, low=None))
        different = sorted(name for name in mine if mine[name] != theirs[name])
        if different:
            said = ", ".join(f"{name} {mine[name]!r} / {theirs[name]!r}" for name in different)
            raise BaselineMismatch(f"the baseline of {self.table} has other settings: {said}")


@dataclass(frozen=True)
class DigestTree:
    """``nodes`` holds ``level, node, row_count, hash_xor, hash_sum, digest``; leaves are level 0
    and the root is node 0 of level ``height``."""

    description: Description
    nodes: DataFrame
    height: int

    def level(self, number: int) -> DataFrame:
        return self.nodes.where(F.col("level") == number)

    def root(self) -> str | None:
        """The digest of the whole table."""
        row = self.level(self.height).select("digest").first()
        return row and row["digest"]


def describe(
    df: DataFrame,
    table: str,
    key: str,
    size: int,
    columns: Sequence[str] | None = None,
    scales: Mapping[str, int] | None = None,
    method: str = PORTABLE,
    fanout: int = FANOUT,
) -> Description:
    """The settings for a tree of ``df``, whose smallest key becomes the start of range 1."""
    if fanout < 2:
        raise ValueError("a node needs at least two children")
    columns = list(columns or split_columns(df.schema)[0])
    low = df.agg(F.min(key).cast("string")).first()[0]
    kinds = tuple((c, df.schema[c].dataType.simpleString()) for c in columns)
    wanted = tuple(sorted((c, int(s)) for c, s in (scales or {}).items() if c in columns))
    return Description(table, key, size, low, kinds, wanted, method, fanout)


def _leaf_digest() -> Column:
    return F.sha2(F.concat_ws(":", *(F.col(c).cast("string") for c in _DIGEST)), 256)


def _parents(nodes: DataFrame, fanout: int) -> DataFrame:
    """The level above; a node collects at most ``fanout`` digests."""
    children = F.array_sort(F.collect_list(F.struct("node", "digest")))
    said = F.transform(children, lambda c: F.concat(c["node"].cast("string"), F.lit("="), c["digest"]))
    total = F.sum(F.col("hash_sum").cast("decimal(38,0)")).cast("string")
    return nodes.groupBy(whole_div(F.col("node"), fanout).alias("node")).agg(
        F.sum("row_count").alias("row_count"),
        F.bit_xor("hash_xor").alias("hash_xor"),
        total.alias("hash_sum"),
        F.sha2(F.array_join(said, ","), 256).alias("digest"),
    )


def digest_tree(df: DataFrame, description: Description) -> DigestTree:
    """The tree of ``df``, by a description that may be that of another state of the table.

    Keys below the description's first key, and rows without a key, are range 0.
    """
    d = description
    kind = dict(d.columns).get(d.key) or df.schema[d.key].dataType.simpleString()
    low = F.lit(d.low).cast(kind)
    names = [c for c, _ in d.columns]
    given = tuple((c, df.schema[c].dataType.simpleString()) for c in names if c in df.columns)
    d.require(replace(d, columns=given))
    found = chunk_digests(df, d.table, d.key, d.size, names, dict(d.scales), low, d.method)
    leaves = settle_table(found.select(F.col("chunk_no").alias("node"), *_DIGEST, _leaf_digest().alias("digest")), "leaves")
    last, height = leaves.agg(F.max("node")).first()[0] or 0, 0
    above, inner = leaves, None
    while last > 0:
        above, last, height = _parents(above, d.fanout), last // d.fanout, height + 1
        numbered = above.select(F.lit(height).alias("level"), "*")
        inner = numbered if inner is None else inner.unionByName(numbered)
    nodes = leaves.select(F.lit(0).alias("level"), "*")
    return DigestTree(d, nodes.unionByName(settle_table(inner, "inner")) if height else nodes, height)


def save(tree: DigestTree, path: str) -> None:
    """Store a tree.  Its nodes go to a folder of their own, and the description, which names
    that folder, is written last: a run that stops halfway leaves the former baseline."""
    spark = tree.nodes.sparkSession
    folder = f"nodes-{uuid.uuid4().hex}"
    former = _stored(spark, path)
    tree.nodes.write.partitionBy("level").parquet(f"{path}/{folder}")
    row = (tree.description.text(), tree.description.sha256(), tree.height, folder)
    kinds = "settings string, sha256 string, height int, folder string"
    spark.createDataFrame([row], kinds).coalesce(1).write.mode("overwrite").parquet(f"{path}/description")
    if former is not None:
        remove_rows(spark, f"{path}/{former['folder']}")


def _stored(spark: SparkSession, path: str):
    if not path_exists(spark, f"{path}/description"):
        return None
    return spark.read.parquet(f"{path}/description").first()


def load(spark: SparkSession, path: str, wanted: Description | None = None) -> DigestTree | None:
    """The stored tree, None where there is none.  With ``wanted``, its settings must be those."""
    row = _stored(spark, path)
    if row is None:
        return None
    if hashlib.sha256(row["settings"].encode()).hexdigest() != row["sha256"]:
        raise BaselineMismatch(f"the description of baseline {path} was changed")
    description = Description.parse(row["settings"])
    if description.version != FINGERPRINT_VERSION:
        raise BaselineMismatch(f"baseline {path} was made by another fingerprint version")
    if wanted is not None:
        description.require(wanted)
    kinds = "node long, row_count long, hash_xor long, hash_sum string, digest string, level int"
    nodes = spark.read.schema(kinds).parquet(f"{path}/{row['folder']}")
    return DigestTree(description, nodes, row["height"])


def _raised(tree: DigestTree, height: int) -> DigestTree:
    """The tree with further roots above its own, so that it is as high as another."""
    nodes, top = tree.nodes, tree.level(tree.height).drop("level")
    for number in range(tree.height + 1, height + 1):
        top = _parents(top, tree.description.fanout)
        nodes = nodes.unionByName(top.select(F.lit(number).alias("level"), "*"))
    return DigestTree(tree.description, nodes, max(height, tree.height))


def drift(old: DigestTree, new: DigestTree, with_same: bool = False) -> DataFrame:
    """``table_name, chunk_id, baseline_rows, current_rows, drift`` of the key ranges that are
    CHANGED, MISSING or NEW; ``with_same`` adds the others as SAME.

    One step per level; what differs on a level is a table, joined with the level below.
    """
    old.description.require(new.description)
    if old.description.low != new.description.low:
        raise BaselineMismatch(f"the ranges of {old.description.table} start at different keys")
    height = max(old.height, new.height)
    old, new = _raised(old, height), _raised(new, height)
    parents = None
    for number in range(height, -1, -1):
        sides = []
        for name, tree in (("_old", old), ("_new", new)):
            level = tree.level(number)
            if parents is not None:
                above = whole_div(F.col("node"), tree.description.fanout)
                level = level.withColumn("_parent", above).join(parents, "_parent", "left_semi")
            sides.append(level.select("node", F.struct("row_count", "digest").alias(name)))
        differing = sides[0].join(sides[1], "node", "full_outer")
        differing = differing.where(~F.col("_old.digest").eqNullSafe(F.col("_new.digest")))
        differing = settle_table(differing, "differing")
        parents = differing.select(F.col("node").alias("_parent"))
    found = differing.select(
        "node",
        F.col("_old.row_count").alias("baseline_rows"),
        F.col("_new.row_count").alias("current_rows"),
        F.when(F.col("_old").isNull(), "NEW").when(F.col("_new").isNull(), "MISSING").otherwise("CHANGED").alias("drift"),
    )
    if with_same:
        same = old.level(0).join(differing.select("node"), "node", "left_anti")
        found = found.unionByName(same.select(
            "node", F.col("row_count").alias("baseline_rows"), F.col("row_count").alias("current_rows"), F.lit("SAME").alias("drift")
        ))
    table = old.description.table
    return found.select(
        F.lit(table).alias("table_name"), chunk_id(table, F.col("node")).alias("chunk_id"), "baseline_rows", "current_rows", "drift"
    )


def drift_against_baseline(
    df: DataFrame,
    path: str,
    table: str,
    key: str,
    size: int,
    columns: Sequence[str] | None = None,
    scales: Mapping[str, int] | None = None,
    method: str = PORTABLE,
    fanout: int = FANOUT,
    fail_if_missing: bool = True,
    with_same: bool = False,
) -> DataFrame:
    """Compare a table with its stored baseline; a missing one is an error, or is stored anew."""
    wanted = describe(df, table, key, size, columns, scales, method, fanout)
    stored = load(df.sparkSession, path, wanted)
    if stored is None:
        if fail_if_missing:
            raise ValueError(f"no baseline at {path}")
        stored = digest_tree(df, wanted)
        save(stored, path)
    return drift(stored, digest_tree(df, stored.description), with_same)
