"""Merging of column pairs of which one or the other is filled."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.functions.names import check_case_collisions, col, family
from strata.operators.union import common_type


def merge_pairs(
    df: DataFrame, pairs: list[tuple[str, str, str]], strict: bool = True
) -> DataFrame:
    """Replace each pair ``(first, second, name)`` by the first value that is not NULL.

    The inputs disappear, the merged columns follow all others. With
    ``strict=False`` a missing input reads as NULL, and a pair with both inputs
    missing gives a NULL text column. Inputs of different type families raise.
    """
    used = {n for first, second, _ in pairs for n in (first, second)}
    missing = sorted(used - set(df.columns))
    if strict and missing:
        raise ValueError(f"columns to merge are missing: {missing}")
    rest = [n for n in df.columns if n not in used]
    names = rest + [name for _, _, name in pairs]
    check_case_collisions(names)
    if len(set(names)) < len(names):
        raise ValueError(f"merged names collide with other columns: {names}")
    return df.select(
        *[col(n) for n in rest],
        *[_merged(df, first, second).alias(name) for first, second, name in pairs],
    )


def _merged(df: DataFrame, first: str, second: str) -> Column:
    present = [n for n in (first, second) if n in df.columns]
    if not present:
        return F.lit(None).cast("string")
    types = [df.schema[n].dataType for n in present]
    common = common_type(types)
    if any(family(t) != family(common) for t in types):
        raise ValueError(
            f"cannot merge {first!r} ({types[0].simpleString()}) "
            f"with {second!r} ({types[-1].simpleString()})"
        )
    return F.coalesce(*[col(n).cast(common) for n in present])
