"""Key-list helpers shared by the gates and the load modes."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def parse_keys(keys: str | list[str] | tuple[str, ...] | None) -> list[str]:
    """``"a, b"`` or ``["a", "b"]`` -> ``["a", "b"]``; empty -> ``[]``."""
    if keys is None:
        return []
    if isinstance(keys, str):
        return [k.strip() for k in keys.split(",") if k.strip()]
    return [k.strip() for k in keys if k and k.strip()]


def any_key_null(keys: list[str]) -> Column:
    """True when at least one key column is NULL (such a row never matches)."""
    return reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])


def all_keys_present(keys: list[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])


BUCKET_COLUMN = "_bucket"


def bucket_of(keys: list[str], n_buckets: int) -> Column:
    """Stable hash bucket of a key tuple: ``pmod(xxhash64(keys), n)`` (NULL keys share one bucket)."""
    return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(int(n_buckets))).cast("int")
