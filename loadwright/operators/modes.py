"""Load modes: how a staged delivery changes the target.

* FULL  the target becomes the stage (an empty stage empties it)
* UPDT  target rows whose key is staged are removed, then the stage is added
* INST  the stage is added, no key test (UPDT without a key list runs as INST)

These are pure ``DataFrame -> DataFrame`` functions; :mod:`loadwright.plans.store`
writes the result as a new snapshot and switches the table to it, so a
failure between "truncate" and "insert" can no longer leave an empty table.

``apply_deliveries`` folds several deliveries in plan order.  ``merge_deliveries``
computes the same result in one pass: for each non-NULL key the rows of the
last source holding that key survive, all NULL-key rows survive.  The winner
per key is found among the deliveries only (a partial aggregate, joined back
with a semi join); the target meets the delivered keys in one anti join.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loadwright.functions.keys import all_keys_present, any_key_null, parse_keys
from loadwright.functions.names import MODE_FULL, MODE_INSERT, MODE_UPDATE
from loadwright.functions.tokens import sql_ident
from loadwright.operators.keys import anti_by_key

MODES = (MODE_FULL, MODE_UPDATE, MODE_INSERT)


def conform(stage: DataFrame, target: DataFrame) -> DataFrame:
    """Stage columns in target order (by name), cast to the target types."""
    have = {f.name: f.dataType for f in stage.schema.fields}
    return stage.selectExpr(*[
        sql_ident(f.name) if have.get(f.name) == f.dataType
        else f"CAST({sql_ident(f.name)} AS {f.dataType.simpleString()}) AS {sql_ident(f.name)}"
        for f in target.schema.fields])


def load_full(target: DataFrame, stage: DataFrame) -> DataFrame:
    return conform(stage, target)


def load_update(target: DataFrame, stage: DataFrame, keys) -> DataFrame:
    stage = conform(stage, target)
    return anti_by_key(target, stage, keys).unionByName(stage)


def load_insert(target: DataFrame, stage: DataFrame) -> DataFrame:
    return target.unionByName(conform(stage, target))


def effective_mode(mode: str, keys) -> str:
    """UPDT without keys is applied as INST."""
    if mode not in (MODE_FULL, MODE_UPDATE, MODE_INSERT):
        raise ValueError(f"load mode {mode!r} is not available")
    if mode == MODE_UPDATE and not parse_keys(keys):
        return MODE_INSERT
    return mode


def apply_mode(target: DataFrame, stage: DataFrame, mode: str, keys=None) -> DataFrame:
    mode = effective_mode(mode, keys)
    if mode == MODE_FULL:
        return load_full(target, stage)
    if mode == MODE_UPDATE:
        return load_update(target, stage, keys)
    return load_insert(target, stage)


def apply_deliveries(target: DataFrame, deliveries: Iterable[tuple[str, DataFrame]], keys=None,
                     checkpoint_every: int = 4) -> DataFrame:
    """Fold ``(mode, stage)`` pairs over the target in the given order.

    Every ``checkpoint_every`` steps the lineage is cut with a reliable
    checkpoint (written below ``spark.checkpoint.dir``).
    """
    from loadwright.session import checkpoint_root

    current = target
    for i, (mode, stage) in enumerate(deliveries, start=1):
        current = apply_mode(current, stage, mode, keys)
        if checkpoint_every and i % checkpoint_every == 0:
            checkpoint_root(current.sparkSession)     # the session's shared folder, set only if unset
            current = current.checkpoint(eager=True)
    return current


def merge_deliveries(target: DataFrame, deliveries: list[tuple[str, DataFrame]], keys=None,
                     key_bytes: int | None = None) -> DataFrame:
    """One-pass equivalent of :func:`apply_deliveries` for a planned delivery list.

    The plan holds at most one FULL and it comes first (see
    :func:`loadwright.sources.deliveries.plan_deliveries`); a FULL discards the
    target.  Within each delivery the keys are unique (the duplicate gate ran).

    A target row survives when no delivery holds its key; a delivered row
    survives when no later delivery holds its key.  So the latest delivery per
    key is found among the deliveries alone (a partial ``max`` and a semi join
    over delivered rows), and the target meets only the delivered key set in
    the same anti join as a single UPDT: broadcast when ``key_bytes`` (measured
    by the gates of all deliveries) proves it small.  The
    target is scanned once and, in the common case, never shuffled.  Rows
    with a NULL key part never match and pass through.
    """
    modes = [effective_mode(m, keys) for m, _ in deliveries]
    if MODE_FULL in modes[1:]:
        raise ValueError("a FULL delivery may only come first in a plan")
    ks = parse_keys(keys)
    full_first = bool(modes) and modes[0] == MODE_FULL
    stages = [conform(stage, target) for _, stage in deliveries]
    if not ks or all(m == MODE_INSERT for m in modes):
        return reduce(DataFrame.unionByName, ([] if full_first else [target]) + stages)
    if len(stages) == 1:
        delivered = stages[0]
    else:
        tagged = reduce(DataFrame.unionByName,
                        [df.withColumn("_ord", F.lit(order)) for order, df in enumerate(stages)])
        keyed = tagged.where(all_keys_present(ks))
        latest = keyed.groupBy(*ks).agg(F.max("_ord").alias("_ord"))
        delivered = (keyed.join(latest, ks + ["_ord"], "left_semi")
                     .unionByName(tagged.where(any_key_null(ks))).drop("_ord"))
    if full_first:
        return delivered
    every = reduce(DataFrame.unionByName, [st.select(*ks) for st in stages])
    return anti_by_key(target, every, ks, key_bytes).unionByName(delivered)
