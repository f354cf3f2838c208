"""Column names on the target side."""

from __future__ import annotations

from collections import Counter
from collections.abc import Collection, Sequence

from pyspark.sql import DataFrame

# Words that cannot be a bare column name on the target.
RESERVED_WORDS = frozenset(
    (
        "LIMIT", "USER", "ORDER", "GROUP", "SELECT", "WHERE",
        "TABLE", "INDEX", "CONSTRAINT", "PRIMARY", "FOREIGN", "UNIQUE",
    )
)


def target_name(name: str, policy: str = "RENAME", reserved: Collection[str] = RESERVED_WORDS) -> str:
    """Lower case for ordinary names.  A reserved word gets a trailing underscore under
    RENAME, and keeps its upper-case form (to be quoted) under QUOTE."""
    if policy not in ("RENAME", "QUOTE"):
        raise ValueError(f"unknown name policy {policy}")
    if name.upper() not in reserved:
        return name.lower()
    return name.upper() if policy == "QUOTE" else f"{name.lower()}_"


def target_names(
    columns: Sequence[str], policy: str = "RENAME", reserved: Collection[str] = RESERVED_WORDS
) -> list[str]:
    """Target names of all columns; two columns that would share one name are an error."""
    names = [target_name(c, policy, reserved) for c in columns]
    clashes = sorted(n for n, times in Counter(n.lower() for n in names).items() if times > 1)
    if clashes:
        raise ValueError(f"columns share a target name: {', '.join(clashes)}")
    return names


def rename_reserved(
    df: DataFrame, policy: str = "RENAME", reserved: Collection[str] = RESERVED_WORDS
) -> DataFrame:
    """All columns under their target names; ``reserved`` are upper-case words."""
    return df.toDF(*target_names(df.columns, policy, reserved))
