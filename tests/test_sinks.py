"""Sinks: keyed merge, JDBC, checkpoint inspection, Kafka options."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from tideline.plans import catalog
from tideline.session import scratch_path, ship
from tideline.sources import kafka_options, kafka_sink_options
from tideline.streaming import JdbcWriter, MergeWriter, checkpoint_offsets, merge, merge_into, progress_frame, read_merged, run


def _counts(spark, rows):
    return spark.createDataFrame(rows, "item STRING, count BIGINT")


ADD = {"count": "target.count + source.count"}
INSERT = {"item": "source.item", "count": "source.count"}


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _merged(spark, target, source, update=ADD, insert=INSERT, **kw):
    return _rows(merge(_counts(spark, target), _counts(spark, source), ["item"], update, insert, **kw))


def test_merge_updates_inserts_and_keeps(spark):
    got = _merged(spark, [("a", 1), ("b", 2)], [("b", 5), ("c", 1), ("d", None)])
    assert got == [("a", 1), ("b", 7), ("c", 1), ("d", None)]


def test_merge_of_a_present_row_with_a_null_value(spark):
    assert _merged(spark, [("a", None)], [("a", 3)]) == [("a", None)]
    assert _merged(spark, [("a", None)], [("a", 3)], {"count": "coalesce(target.count, 0) + source.count"}) == [("a", 3)]


def test_merge_without_inserts_or_updates(spark):
    assert _merged(spark, [("a", 1)], [("a", 1), ("new", 1)], ADD, None) == [("a", 2)]
    assert _merged(spark, [("a", 1)], [("a", 9), ("b", 1)], None) == [("a", 1), ("b", 1)]
    assert _merged(spark, [], [("b", 1)]) == [("b", 1)]
    assert _merged(spark, [("a", 1)], []) == [("a", 1)]


def test_merge_null_keys(spark):
    two = [(None, 1), (None, 2)]
    assert _merged(spark, [(None, 5)], two) == [(None, 1), (None, 2), (None, 5)]
    assert _merged(spark, [(None, 5)], two, ADD, None) == [(None, 5)]
    assert _merged(spark, [(None, 5)], [(None, 2)], null_safe=True) == [(None, 7)]


def test_merge_refuses_repeated_keys_and_changed_keys(spark):
    with pytest.raises(Exception, match="more than one source row"):
        _merged(spark, [("a", 1)], [("a", 1), ("a", 2)])
    with pytest.raises(Exception, match="more than one source row"):
        _merged(spark, [], [(None, 1), (None, 2)], null_safe=True)
    with pytest.raises(ValueError):
        _merged(spark, [("a", 1)], [("a", 1)], {"item": "upper(source.item)"})
    with pytest.raises(ValueError):
        merge(_counts(spark, []), _counts(spark, []), [])


def test_merge_does_not_depend_on_settings(spark):
    target = spark.range(200).select(F.col("id").cast("string").alias("item"), F.lit(1).cast("long").alias("count"))
    source = spark.range(190, 220).select(F.col("id").cast("string").alias("item"), F.lit(2).cast("long").alias("count"))
    settings = ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")
    before = {k: spark.conf.get(k) for k in settings}
    results = []
    try:
        for values in (("2", "-1", "false"), ("7", "10485760", "true")):
            for k, v in zip(settings, values, strict=True):
                spark.conf.set(k, v)
            results.append(_rows(merge(target, source, ["item"], ADD, INSERT)))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert results[0] == results[1] and len(results[0]) == 220
    assert sum(c for _, c in results[0]) == 200 + 30 * 2


def test_merge_writer_replays_and_keeps_two_results(spark):
    from tideline.streaming.files import list_names

    path = scratch_path(spark, "table")
    w = MergeWriter(path, "w", ["item"], ADD, INSERT)
    for batch in (0, 1, 1, 2, 3, 3):
        w(_counts(spark, [("a", 1), (f"k{batch}", 1)]), batch)
    assert _rows(read_merged(spark, path)) == [("a", 4), ("k0", 1), ("k1", 1), ("k2", 1), ("k3", 1)]
    assert len(list_names(w.path)) == 2
    # another object of the same query goes on; a batch before the newest is refused
    again = MergeWriter(path, "w", ["item"], ADD, INSERT)
    again(_counts(spark, [("a", 1)]), 4)
    with pytest.raises(RuntimeError):
        w(_counts(spark, [("a", 1)]), 2)
    assert ("a", 5) in _rows(read_merged(spark, path))


def test_merge_writer_refuses_other_writers(spark):
    path = scratch_path(spark, "table")
    MergeWriter(path, "first", ["item"], ADD, INSERT)(_counts(spark, [("a", 1)]), 0)
    with pytest.raises(RuntimeError):
        MergeWriter(path, "second", ["item"], ADD, INSERT)(_counts(spark, [("b", 1)]), 0)
    assert _rows(read_merged(spark, path)) == [("a", 1)]
    with pytest.raises(ValueError):
        MergeWriter(path, "", ["item"], ADD, INSERT)
    with pytest.raises(ValueError):
        MergeWriter(scratch_path(spark, "table"), "w", ["item"], ADD)(_counts(spark, [("a", 1)]), 0)


def test_merge_into_needs_a_format_with_row_level_operations(spark):
    name = "plain_" + scratch_path(spark, "x").rsplit("/", 1)[1][:12]
    location = scratch_path(spark, "plain")
    spark.sql(f"CREATE TABLE {name} (item STRING, count BIGINT) USING parquet LOCATION '{location}'")
    with pytest.raises(Exception, match="(?i)merge"):
        merge_into(name, _counts(spark, [("a", 1)]), ["item"], ADD, INSERT)


def test_jdbc_sink_with_embedded_derby(spark):
    parsed, st = catalog.stream_transactions(spark, SF_SMALL, keep=())
    url = "jdbc:derby:memory:tideline_jdbc;create=true"
    props = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    run(parsed.select("item", "quantity"), "foreach_batch", "append",
        target=JdbcWriter(url, "PARSED", props), checkpoint=scratch_path(spark, "ck"))
    back = spark.read.jdbc(url, "PARSED", properties=props)
    assert back.count() == 1000
    assert back.select("BATCH_ID").distinct().count() == 4


def test_checkpoint_offsets_and_progress(spark):
    df, st = catalog._windowed(spark, SF_SMALL, "1 hour", None, [F.count("item").alias("n")], delay="10 minutes")
    ck = scratch_path(spark, "ck")
    q = run(df, "parquet", "append", path=scratch_path(spark, "out"), checkpoint=ck)
    offs = checkpoint_offsets(spark, ck).orderBy("batch_id").collect()
    assert [r.batch_id for r in offs] == [0, 1, 2, 3, 4]
    assert all(r.committed for r in offs)
    assert offs[0].watermark_ms == 0 and offs[4].watermark_ms > offs[1].watermark_ms
    prog = progress_frame(spark, q)
    assert prog.agg(F.sum("num_input_rows")).first()[0] == 1000


def test_kafka_options():
    o = kafka_options("broker:9092", "shopping_transaction ", username="k", password="s")
    assert o["subscribe"] == "shopping_transaction"
    assert o["startingOffsets"] == "earliest" and o["failOnDataLoss"] == "false"
    assert o["kafka.security.protocol"] == "SASL_SSL" and o["kafka.sasl.mechanism"] == "PLAIN"
    assert 'username="k"' in o["kafka.sasl.jaas.config"]
    assert "s" not in repr(o).split("jaas")[1][:8]
    with pytest.raises(ValueError):
        kafka_options("broker:9092", " ")
    with pytest.raises(ValueError):
        kafka_options("broker:9092", "t", username="only-user")
    assert kafka_sink_options("b:1", "out ")["topic"] == "out"


def test_kafka_source_needs_connector(spark):
    from tideline.sources import read_kafka

    with pytest.raises(Exception):
        read_kafka(spark, kafka_options("localhost:1", "t"))


def test_kafka_offsets_from_a_checkpoint_log(spark, tmp_path):
    from tideline.streaming import kafka_offsets

    # An offsets log in the Kafka source's format: version, metadata, one line per source.
    offsets = tmp_path / "ck" / "offsets"
    offsets.mkdir(parents=True)
    (tmp_path / "ck" / "commits").mkdir()
    meta = '{"batchWatermarkMs":0,"batchTimestampMs":1,"conf":{}}'
    (offsets / "0").write_text(f'v1\n{meta}\n{{"shopping_transaction":{{"2":707,"1":742,"0":739}}}}')
    (tmp_path / "ck" / "commits" / "0").write_text('v1\n{"nextBatchWatermarkMs":0}')
    rows = kafka_offsets(checkpoint_offsets(spark, str(tmp_path / "ck"))).collect()
    got = sorted((r.topic, r.partition, r.end_offset) for r in rows)
    assert got == [("shopping_transaction", 0, 739), ("shopping_transaction", 1, 742),
                   ("shopping_transaction", 2, 707)]
    assert sum(r.end_offset for r in rows) == 2188


def test_state_store_provider_default(spark):
    from tideline.streaming import state_store_provider

    assert state_store_provider(spark).endswith("HDFSBackedStateStoreProvider")


def test_credentials_from_env(monkeypatch):
    from tideline.sources import credentials_from_env

    monkeypatch.setenv("TL_TEST_USER", "u")
    monkeypatch.setenv("TL_TEST_PASS", "p")
    assert credentials_from_env("TL_TEST_USER", "TL_TEST_PASS") == ("u", "p")
    monkeypatch.delenv("TL_TEST_PASS")
    with pytest.raises(KeyError):
        credentials_from_env("TL_TEST_USER", "TL_TEST_PASS")


def test_checkpoint_pins_state_partitions_and_store(spark):
    from tideline.sources.replay import EVEN, read_replay, stage_topic
    from tideline.functions import decode, parse_json
    from tideline.operators import count_by
    from tideline.streaming import ChangelogWriter

    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    path, ck, out = (scratch_path(spark, k) for k in ("stage", "ck", "out"))
    for batches, parts, store in ((range(0, 2), 3, "hdfs"), (range(2, 4), 5, "rocksdb")):
        st = stage_topic(spark, ev, path, EVEN, batches=batches, n=1000, files_per_batch=2)
        counts = count_by(parse_json(decode(read_replay(spark, st), key=False)), "item")
        run(counts, "foreach_batch", "complete", target=ChangelogWriter(out), checkpoint=ck,
            shuffle_partitions=parts, state_store=store)
    confs = {r.batch_id: r.conf for r in checkpoint_offsets(spark, ck).collect()}
    assert sorted(confs) == [0, 1, 2, 3]
    for conf in confs.values():
        assert conf["spark.sql.shuffle.partitions"] == "3"
        assert conf["spark.sql.streaming.stateStore.providerClass"].endswith("HDFSBackedStateStoreProvider")


def test_foreach_row_writer_flushes_in_bounded_chunks(spark):
    from tideline.plans.common import stream_transactions
    from tideline.streaming import RowFileWriter
    from tideline.streaming.files import list_names
    from tideline.streaming.sinks import read_rows

    ship(spark)
    parsed, _ = stream_transactions(spark, SF_SMALL)
    out = scratch_path(spark, "rows")
    ddl = "offset BIGINT, item STRING"
    run(parsed.select("offset", "item"), "foreach", "append", target=RowFileWriter(out, ddl, chunk_rows=20),
        checkpoint=scratch_path(spark, "ck"))
    back = read_rows(spark, out, ddl)
    assert back.count() == 1000 and back.select("offset").distinct().count() == 1000
    import pyarrow.parquet as pq

    from tideline.streaming.files import arrow_target

    groups = 0
    for e in list_names(out):
        for n in list_names(f"{out}/{e}"):
            if n.endswith(".parquet"):
                system, inner = arrow_target(f"{out}/{e}/{n}")
                groups += pq.ParquetFile(inner, filesystem=system).num_row_groups
    assert groups >= 1000 // 20


def test_foreach_row_writer_replays_an_epoch(spark):
    from tideline.streaming import RowFileWriter
    from tideline.streaming.sinks import read_rows

    out = scratch_path(spark, "rows")
    for error, rows in ((RuntimeError("lost"), range(3)), (None, range(5)), (None, range(5))):
        w = RowFileWriter(out, "n BIGINT", chunk_rows=2)
        w.open(0, 7)
        for i in rows:
            w.process({"n": i})
        w.close(error)
    assert sorted(r.n for r in read_rows(spark, out).collect()) == [0, 1, 2, 3, 4]


def test_kafka_sink_needs_connector(spark):
    from tideline.functions import to_kv_json
    from tideline.plans.common import stream_transactions
    from tideline.streaming import start

    parsed, _ = stream_transactions(spark, SF_SMALL, keep=())
    records = to_kv_json(parsed, "item", ["item", "quantity"])
    with pytest.raises(Exception, match="(?i)kafka"):
        q = start(records, "kafka", "append", checkpoint=scratch_path(spark, "ck"),
                  options=kafka_sink_options("localhost:1", "out"))
        q.stop()
