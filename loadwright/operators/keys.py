"""Key tests and key-based deletes.

* ``anti_by_key``   rows of the target whose key is not staged (what survives
                    ``DELETE .. WHERE key IN (SELECT key FROM stage)``)
* ``matched_by_key`` the complement: the rows such a delete removes
* ``key_profile``   rows / distinct key tuples / duplicated tuples, one pass
* ``assert_unique`` the duplicate-key gate
* ``pk_violations`` primary-key check: NULL in a key column, or a repeated key

Composite keys are compared as tuples.  The original tool compared nested
string concatenations, under which ('a','bc') equals ('ab','c'); that
collision is not reproduced.  A NULL in any key column never matches, so such
target rows survive an update, as they do under SQL ``IN``.

Scale notes.  The staged key set is deduplicated with a partial aggregate
before it is shuffled.  It is broadcast only behind the byte size that the
duplicate gate measured; otherwise the join is a shuffle join, which AQE may
still convert or split (a hot key, many NULL keys on the target).  The key profile is one ``groupBy`` whose map side collapses a hot key to one row per
task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwright.functions.keys import all_keys_present, any_key_null, parse_keys


# Staged key sets of at most so many measured bytes are broadcast.
BROADCAST_KEYSET_BYTES = 64 * 1024 * 1024
# Bytes that a key tuple takes in the hash relation besides its text.
KEY_ROW_OVERHEAD_BYTES = 64


class DuplicateKeys(RuntimeError):
    pass


def _keys(keys) -> list[str]:
    ks = parse_keys(keys)
    if not ks:
        raise ValueError("at least one key column is required")
    return ks


def staged_keys(stage: DataFrame, keys, key_bytes: int | None = None) -> DataFrame:
    """Distinct non-NULL key tuples of the stage, broadcast when ``key_bytes`` proves them small.

    ``key_bytes`` is what the duplicate gate measured (see :func:`assert_unique`).
    A broadcast key set spares the target a shuffle, which AQE could not: it
    decides only after both sides have been shuffled.
    """
    ks = _keys(keys)
    keyset = stage.select(*ks).where(all_keys_present(ks)).distinct()
    return F.broadcast(keyset) if key_bytes is not None and key_bytes <= BROADCAST_KEYSET_BYTES else keyset


def anti_by_key(target: DataFrame, stage: DataFrame, keys, key_bytes: int | None = None) -> DataFrame:
    """Target rows that a delete by the staged keys leaves in place."""
    ks = _keys(keys)
    return target.join(staged_keys(stage, ks, key_bytes), ks, "left_anti").select(*target.columns)


def matched_by_key(target: DataFrame, stage: DataFrame, keys) -> DataFrame:
    """Target rows that a delete by the staged keys removes."""
    ks = _keys(keys)
    return target.join(staged_keys(stage, ks), ks, "left_semi").select(*target.columns)


def key_profile(df: DataFrame, keys, with_null_rows: bool = False) -> DataFrame:
    """One row: ``n_rows, n_keys, n_dup_keys, n_dup_rows`` (and ``n_null_rows`` on request).

    ``n_keys`` counts distinct key *tuples* with a NULL tuple counted once, as
    ``SELECT DISTINCT`` does; ``count(DISTINCT ..)`` would skip NULLs.
    ``n_null_rows`` counts rows with a NULL key part, and ``key_bytes`` bounds
    the size of the distinct keys, both from the same groups.
    """
    ks = _keys(keys)
    per_key = df.groupBy(*ks).agg(F.count(F.lit(1)).alias("_n"))
    measures = [
        F.coalesce(F.sum("_n"), F.lit(0)).cast("bigint").alias("n_rows"),
        F.count(F.lit(1)).alias("n_keys"),
        F.count_if(F.col("_n") > 1).alias("n_dup_keys"),
        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n"))), F.lit(0)).cast("bigint").alias("n_dup_rows"),
    ]
    if with_null_rows:
        measures.append(F.coalesce(F.sum(F.when(any_key_null(ks), F.col("_n"))), F.lit(0))
                        .cast("bigint").alias("n_null_rows"))
        text = sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in ks), F.lit(KEY_ROW_OVERHEAD_BYTES))
        measures.append(F.coalesce(F.sum(text), F.lit(0)).cast("bigint").alias("key_bytes"))
    return per_key.agg(*measures)


def distinct_key_count(df: DataFrame, keys) -> int:
    return key_profile(df, keys).first()["n_keys"]


def duplicate_keys(df: DataFrame, keys) -> DataFrame:
    """Key tuples that occur more than once, with their row count ``n``."""
    ks = _keys(keys)
    return (df.groupBy(*ks).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


@dataclass(frozen=True)
class UniquenessResult:
    n_rows: int
    n_keys: int
    n_dup_keys: int
    n_dup_rows: int
    n_null_rows: int = 0
    key_bytes: int | None = None

    @property
    def passed(self) -> bool:
        return self.n_rows == self.n_keys


def assert_unique(df: DataFrame, keys, raise_on_fail: bool = True) -> UniquenessResult:
    """The duplicate-key gate: distinct key tuples must equal the row count."""
    row = key_profile(df, keys, with_null_rows=True).first()
    result = UniquenessResult(row["n_rows"], row["n_keys"], row["n_dup_keys"], row["n_dup_rows"],
                              row["n_null_rows"], row["key_bytes"])
    if raise_on_fail and not result.passed:
        raise DuplicateKeys(
            f"{result.n_dup_keys} key values occur more than once "
            f"({result.n_rows} rows, {result.n_keys} distinct keys)")
    return result


def pk_violations(df: DataFrame, keys) -> DataFrame:
    """Key tuples that break a primary key: a NULL part, or more than one row."""
    ks = _keys(keys)
    return (df.groupBy(*ks).agg(F.count(F.lit(1)).alias("n"))
            .where((F.col("n") > 1) | any_key_null(ks)))
