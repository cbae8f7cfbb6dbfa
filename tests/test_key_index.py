"""Key index: the guard of a primary key other than the delivery key reads the buckets of staged keys only."""

import os

import pytest
from pyspark.sql import functions as F

from loadwright.plans import LoadSpec, TableStore, keyindex, run_load
from loadwright.plans.load import PrimaryKeyViolation
from tests.test_load import COLS, RUN_TS, env, table_rows, write  # noqa: F401


def spec_of(table, **kw):
    return LoadSpec("src.base.acct", COLS, delimiter="|", **{"column_id": "id", "table_key": "name", "key_index": True, **kw}, custom_table_name=table)


def lines(numbers):
    return [f"{i}|n{i}|{i}.5" for i in numbers]


def test_bucket_counts_are_powers_of_two_that_grow_with_the_rows(monkeypatch):
    monkeypatch.setattr(keyindex, "ROWS_PER_BUCKET", 10)
    assert [keyindex.buckets_for(n) for n in (0, 1, 10, 11, 20, 21, 80, 81)] == [1, 1, 1, 2, 2, 4, 8, 16]
    assert keyindex.buckets_for(10**9) == keyindex.MAX_BUCKETS
    with pytest.raises(ValueError):
        LoadSpec("a.b.c", COLS, delimiter="|", key_index=True)


@pytest.mark.parametrize("buckets", [None, 2])
def test_guard_through_the_index(spark, tmp_path, monkeypatch, buckets):
    from loadwright.plans import Journal

    monkeypatch.setattr(keyindex, "ROWS_PER_BUCKET", 8)
    store = TableStore(spark, str(tmp_path / "wh"))
    table = f"KX_{buckets or 0}"
    journal, target, spec = Journal(store, prefix=f"JKX{buckets or 0}_"), store.target(table), spec_of(table, buckets=buckets)
    turn = iter(range(100))

    def apply(mode, body, spec=spec, bulk=False):
        folder = tmp_path / f"IN{next(turn)}"
        for i, b in enumerate(body if bulk else [body]):
            write(folder, mode, f"202101{i + 1:02d}-000000", b)
        return run_load(spark, spec, str(folder), store, journal, run_ts=RUN_TS, bulk=bulk)

    apply("FULL", lines(range(200)))
    one = spark.sql("SELECT 'n17' AS name")
    read = lambda: target.key_rows(target.snapshot().segments, one, ["name"], ["id"])
    small = read().count()
    assert 1 <= small <= 30 and read().where("name = 'n17'").count() == 1              # one bucket of 32, not 200 rows
    apply("UPDT", lines(range(1000, 2600)))                                              # no key met: the target is nine times as large
    assert read().count() <= small + 30 and target.snapshot().rows == 1800
    before = table_rows(store, table)
    with pytest.raises(PrimaryKeyViolation):
        apply("UPDT", ["9000|n17|1.0"])                                                  # held by a row that stays
    with pytest.raises(PrimaryKeyViolation):
        apply("UPDT", ["9000|n9|1.0", "9001|n2400|1.0"])                                 # .. in another segment
    with pytest.raises(PrimaryKeyViolation):
        apply("UPDT", [["9000|new|1.0"], ["9001|n1700|1.0"]], bulk=True)
    assert table_rows(store, table) == before
    apply("UPDT", ["17|moved|1.0", "9000|n17|2.0"])                                      # its holder goes in the same delivery
    with pytest.raises(PrimaryKeyViolation):
        apply("UPDT", ["9001|moved|1.0"])                                                # the rewritten segment is indexed too
    target.compact()
    store.vacuum(table, keep=1)
    kept = os.listdir(target.key_index.base)
    assert kept == [f"_segment={s.name}" for s in target.snapshot().segments] and len(kept) == 1
    with pytest.raises(PrimaryKeyViolation):
        apply("UPDT", ["9001|n2599|1.0"])
    assert store.read(table).groupBy("name").count().where("count > 1").count() == 0


def test_appends_and_segments_without_an_index(spark, env, monkeypatch, tmp_path):  # noqa: F811
    """Segments written before the index was declared are read from the target: the guard stays exact."""
    monkeypatch.setattr(keyindex, "ROWS_PER_BUCKET", 8)
    store, journal, table, _ = env
    run = lambda i, body, **kw: (write(tmp_path / f"I{i}", "UPDT", "20210101-000000", body),
                                 run_load(spark, spec_of(table, column_id=None, **kw), str(tmp_path / f"I{i}"), store, journal, run_ts=RUN_TS))
    run(0, lines(range(50)), key_index=False)
    run(1, lines(range(50, 100)))
    target = store.target(table)
    segments = target.snapshot().segments
    assert list(target.key_index.counts(store, segments)) == [segments[1].name]
    rows = target.key_rows(segments, spark.sql("SELECT 'n60' AS name"), ["name"])
    assert rows.where("name = 'n60'").count() == 1 and 50 < rows.count() < 75
    for i, held in ((2, "n3"), (3, "n60")):
        with pytest.raises(PrimaryKeyViolation):
            run(i, [f"900|{held}|1.0"])
    with pytest.raises(PrimaryKeyViolation):
        run(4, ["900||1.0"])                                                             # NULL key
    run(5, [])                                                                           # an empty delivery adds no index
    run(6, ["900|fresh|1.0"])
    assert store.read(table).count() == 101 and target.read().agg(F.countDistinct("name")).first()[0] == 101
