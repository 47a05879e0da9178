"""One rule for group keys: null is a group like any other.

Inside an operator the key columns travel as one struct that is never null. So equality joins and aggregates on it meet
null with null, and a join on the key that was just aggregated by needs no further shuffle.
"""

from __future__ import annotations

import inspect
from collections.abc import Callable, Sequence
from functools import wraps

from pyspark.sql import Column, DataFrame, functions as F

PACKED = "_by"


def group_key(by: Sequence[str]) -> Column:
    """One key for a group; it is never null, so rows with null parts meet each other."""
    return F.struct(F.lit(0).alias("_0"), *[F.col(c) for c in by])


def _packed(df: DataFrame, by: Sequence[str]) -> DataFrame:
    key = group_key(by).alias(PACKED)
    return df.select(key, *[F.col(f"`{c}`") for c in df.columns if c not in by])


def _unpacked(df: DataFrame, by: Sequence[str]) -> DataFrame:
    if PACKED not in df.columns:
        return df
    out: list[Column] = []
    for c in df.columns:
        out += [F.col(PACKED)[b].alias(b) for b in by] if c == PACKED else [F.col(f"`{c}`")]
    return df.select(*out)


def null_groups(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Run an operator that takes ``by`` with its key columns packed into one; its other arguments must not use them."""
    signature = inspect.signature(fn)

    @wraps(fn)
    def run(*args, **kwargs):
        bound = signature.bind(*args, **kwargs)
        bound.apply_defaults()
        by = list(bound.arguments["by"])
        if not by or by == [PACKED]:
            return fn(*args, **kwargs)
        whole = lambda v: isinstance(v, DataFrame) and set(by) <= set(v.columns)
        given = {n: _packed(v, by) if whole(v) else v for n, v in bound.arguments.items()}
        return _unpacked(fn(**{**given, "by": [PACKED]}), by)

    return run
