from loadwright.plans import Journal, LoadSpec, TableStore
from loadwright.streaming import watch_deliveries


def test_watch_applies_new_deliveries_once(spark, tmp_path):
    inbox = tmp_path / "IN"
    inbox.mkdir()
    (inbox / "SRC.BASE.W.J.00.MFT.FULL.ALL.000.20210101-000000.x").write_text("1|a\n2|b\n")
    spec = LoadSpec("src.base.w", "id BIGINT, name STRING", delimiter="|", column_id="id",
                    custom_table_name="WATCHED")
    store = TableStore(spark, str(tmp_path / "wh"))
    journal = Journal(store, prefix="JW_")
    ckpt = str(tmp_path / "ckpt")
    r1 = watch_deliveries(spark, spec, str(inbox), store, journal, checkpoint=ckpt, run_ts="2021-01-01 00:00:00")
    assert sum(len(r.files) for r in r1) == 1
    (inbox / "SRC.BASE.W.J.00.MFT.UPDT.ALL.000.20210102-000000.x").write_text("2|bb\n3|c\n")
    r2 = watch_deliveries(spark, spec, str(inbox), store, journal, checkpoint=ckpt, run_ts="2021-01-02 00:00:00")
    assert [f.file_name for r in r2 for f in r.files] == ["SRC.BASE.W.J.00.MFT.UPDT.ALL.000.20210102-000000.x"]
    assert sorted((r.id, r.name) for r in store.read("WATCHED").collect()) == [(1, "a"), (2, "bb"), (3, "c")]
    assert watch_deliveries(spark, spec, str(inbox), store, journal, checkpoint=ckpt) == []


def test_replayed_batch_is_not_applied_twice(spark, tmp_path):
    import hashlib
    import os

    inbox = tmp_path / "IN"
    inbox.mkdir()
    (inbox / "SRC.BASE.W.J.00.MFT.UPDT.ALL.000.20210101-000000.x").write_text("1|a\n2|b\n")
    spec = LoadSpec("src.base.w", "id BIGINT, name STRING", delimiter="|",   # no key: INST
                    custom_table_name="WATCHED_INST")
    store = TableStore(spark, str(tmp_path / "wh"))
    journal = Journal(store, prefix="JR_")
    ckpt = str(tmp_path / "ckpt")
    watch_deliveries(spark, spec, str(inbox), store, journal, checkpoint=ckpt, run_ts="2021-01-01 00:00:00")
    assert store.read("WATCHED_INST").count() == 2
    process = f"GOVERNED_LOAD_STREAM_{hashlib.sha1(ckpt.encode()).hexdigest()[:10]}_0"
    assert journal.finished(process, spec.object_name)
    assert not journal.finished(process + "_other", spec.object_name)
    # a crash after the batch was applied but before it was committed: the
    # restarted query runs batch 0 again, and the journal makes it a no-op
    for marker in ("0", ".0.crc"):       # the local file system keeps a checksum beside it
        if os.path.exists(os.path.join(ckpt, "commits", marker)):
            os.remove(os.path.join(ckpt, "commits", marker))
    assert watch_deliveries(spark, spec, str(inbox), store, journal, checkpoint=ckpt) == []
    assert os.path.exists(os.path.join(ckpt, "commits", "0"))      # batch 0 did run again
    assert store.read("WATCHED_INST").count() == 2
