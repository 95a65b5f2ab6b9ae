import pytest

from terrace.operators.tables import append, quoted
from terrace.sources.spec import SourceSpec
from terrace.streaming import streams
from terrace.streaming.progress import ProgressLog, live_lag, positions
from terrace.streaming.streams import (
    compact_changes, consumer_lag, current_rows, decode_framed, decode_json, finish, fold_epochs, read_stream,
    register_stream_type, stream_changes, stream_files, stream_ingest)


@pytest.fixture
def feed(spark, ns, tmp_path):
    spec = SourceSpec("feed", {"path": f"{tmp_path}/in", "format": "json"}, namespace=ns)

    class Feed:
        table, path = quoted(ns, "feed"), spec.options["path"]

        @staticmethod
        def add(*ids):
            spark.createDataFrame([(i,) for i in ids], "id int").coalesce(1).write.mode("append").json(
                spec.options["path"])

        @staticmethod
        def run():
            stream = stream_files(spark, spec, "id int", max_files=1)
            return finish(stream_ingest(stream, spec, f"{tmp_path}/ck", "r"), spark, Feed.table)
    return Feed


def test_restart_reads_only_new_files(feed, rows):
    feed.add(1, 2)
    feed.add(3)
    first = feed.run()
    assert rows.of(first.select("id")) == [(1,), (2,), (3,)]
    assert rows.of(first.select("_batch_id").distinct()) == [("r:0",), ("r:1",)]
    assert first.where("_source_file like '%/in/part-%'").count() == 3
    feed.add(4)
    assert rows.of(feed.run().select("id", "_batch_id").where("id = 4")) == [(4, "r:2")]
    assert feed.run().count() == 4


def test_replayed_epoch_adds_nothing(spark, feed, rows, monkeypatch):
    feed.add(1, 2)
    feed.run()
    feed.add(3)
    real = streams.append

    def write_and_die(*args, **options):
        real(*args, **options)
        raise RuntimeError("driver lost")
    monkeypatch.setattr(streams, "append", write_and_die)
    with pytest.raises(Exception, match="driver lost"):
        feed.run()
    monkeypatch.undo()
    spark.catalog.refreshTable(feed.table)
    assert spark.table(feed.table).count() == 3
    assert rows.of(feed.run().select("id", "_batch_id")) == [(1, "r:0"), (2, "r:0"), (3, "r:1")]


def test_stream_joins_rows_loaded_in_batches(spark, ns, feed, rows):
    append(rows.make([(9, "b")], "id int, _batch_id string"), ns, "feed", partition_by=["_batch_id"])
    feed.add(1)
    assert rows.of(feed.run().select("id", "_batch_id")) == [(1, "r:0"), (9, "b")]


def test_changes_keep_tombstones_across_epochs(spark, ns, rows, tmp_path):
    path = f"{tmp_path}/log"
    for i, batch in enumerate([[(1, 1, "i"), (2, 5, "d")], [(1, 2, "u"), (2, 4, "u")], [(3, 1, "i"), (1, 3, "d")]]):
        rows.make(batch, "k int, seq int, op string").coalesce(1).write.mode("append").json(path)
        log = stream_files(spark, SourceSpec("log", {"path": path, "format": "json"}), "k int, seq int, op string")
        table = finish(stream_changes(log, ns, "state", ["k"], "seq", "op", f"{tmp_path}/ck"), spark,
                       quoted(ns, "state"))
    changes = [(1, 1, "i"), (1, 2, "u"), (1, 3, "d"), (2, 4, "u"), (2, 5, "d"), (3, 1, "i")]
    assert rows.of(table.select("k", "seq", "op")) == changes
    assert rows.of(current_rows(table, ["k"], "seq", "op")) == [(3, 1)]
    compact_changes(spark, quoted(ns, "state"), ["k"], "seq", "op")
    table = spark.table(quoted(ns, "state"))
    assert rows.of(table.select("k", "seq", "op")) == [(1, 3, "d"), (2, 5, "d"), (3, 1, "i")]
    assert rows.of(current_rows(table, ["k"], "seq", "op")) == [(3, 1)]


def test_a_repeated_epoch_of_changes_replaces_itself(spark, ns, rows, tmp_path):
    path, schema = f"{tmp_path}/log", "k int, seq int, op string"
    rows.make([(1, 1, "i")], schema).write.json(path)
    log = stream_files(spark, SourceSpec("log", {"path": path, "format": "json"}), schema)
    for checkpoint in ("a", "b"):  # the second start has lost its checkpoint: epoch 0 again
        table = finish(stream_changes(log, ns, "state", ["k"], "seq", "op", f"{tmp_path}/{checkpoint}"), spark, quoted(ns, "state"))
    assert table.count() == 1


def test_framed_payloads(rows):
    frame = bytes([0, 0, 0, 0, 7])
    df = rows.make([("a", bytearray(frame + b'{"x":1}')), ("b", bytearray(b'{"x":2}')), ("c", bytearray(frame[:4])), ("d", None),
                    ("e", bytearray(bytes([0, 0, 0, 1, 44]) + b'{"x":3,"y":"z"}'))], "k string, value binary")
    assert rows.of(decode_framed(df, {7: "x int", 300: "x int, y string"})) == [
        ("a", 7, 1, None), ("b", None, None, None), ("c", None, None, None), ("d", None, None, None), ("e", 300, 3, "z")]
    with pytest.raises(ValueError, match="two types"):
        decode_framed(df, {1: "x int", 2: "x string"})


@pytest.mark.parametrize("layout", [[], ["id"]])
def test_epochs_of_a_finished_run_can_be_folded(spark, ns, rows, layout):
    for batch, ids in (("r:0", [1, 2]), ("r:1", [2, 3]), ("r2:0", [1]), ("other", [9])):
        append(rows.make([(i, batch, "x") for i in ids], "id int, _batch_id string, v string"), ns, "t", partition_by=[*layout, "_batch_id"])
    fqn = quoted(ns, "t")
    for _ in range(2):
        fold_epochs(spark, fqn, "r")
        assert rows.of(spark.table(fqn).select("id", "_batch_id")) == [
            (1, "r"), (1, "r2:0"), (2, "r"), (2, "r"), (3, "r"), (9, "other")]
    assert len({r[0] for r in spark.sql(f"SHOW PARTITIONS {fqn}").collect() if "r%3A" in r[0]}) == 0


def test_decode_json(rows):
    df = rows.make([("k", '{"a":1,"b":{"c":"x"}}'), ("l", "bad")], "key string, value string")
    assert rows.of(decode_json(df, "a int, b struct<c:string>").select("key", "a", "b.c")) == [
        ("k", 1, "x"), ("l", None, None)]


def test_lag(rows):
    schema = "partition int, offset bigint"
    produced = rows.make([(0, 5), (0, 9), (1, 3), (2, 4)], schema)
    consumed = rows.make([(0, 7), (0, 2), (2, 6)], schema)
    assert rows.of(consumer_lag(produced, consumed)) == [(0, 2), (1, 4), (2, 0)]


def test_positions_of_offsets():
    assert positions('{"t": {"0": 5, "1": 7}, "u": {"0": 1}}') == {"t/0": 5, "t/1": 7, "u/0": 1}
    assert positions('{"logOffset": 3}') == {"logOffset": 3} and positions("12") == {"": 12}
    assert positions(None) == positions("None") == positions("null") == positions('{"a": "x", "b": true, "c": null}') == {}


def test_live_lag(rows):
    schema = "query string, source int, partition string, epoch bigint, end bigint, latest bigint"
    progress = rows.make([("q", 0, "p", 0, 3, 9), ("q", 0, "p", 1, 6, 9), ("q", 1, "p", 1, 2, 2), ("q", 0, "new", 1, None, 4),
                          ("f", 0, "logOffset", 0, 1, None)], schema)
    assert rows.of(live_lag(progress)) == [("f", 0, "logOffset", None, 0), ("q", 0, "new", 4, 1), ("q", 0, "p", 3, 1), ("q", 1, "p", 0, 1)]


def test_progress_of_a_file_stream_is_logged(spark, ns, feed, rows):
    feed.add(1, 2)
    feed.add(3)
    log = ProgressLog(spark, ns, latest=lambda name: {"logOffset": 4})
    spark.streams.addListener(log)
    try:
        stream = stream_files(spark, SourceSpec("feed", {"path": feed.path, "format": "json"}), "id int", max_files=1)
        checkpoint = f"{feed.path}-lag"
        progress = log.wait(stream.writeStream.queryName("lagging").foreachBatch(lambda df, epoch: df.count())
                            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
        assert rows.of(progress.select("epoch", "partition", "start", "end", "latest", "rows").where("rows > 0")) == [
            (0, "logOffset", None, 0, 4, 2), (1, "logOffset", 0, 1, 4, 1)]
        assert rows.of(live_lag(progress).select("query", "lag")) == [("lagging", 3)]
        log.latest = lambda name: 1 / 0
        feed.add(4)
        with pytest.raises(RuntimeError, match="not written"):
            log.wait(stream.writeStream.foreachBatch(lambda df, epoch: None).option("checkpointLocation", checkpoint)
                     .trigger(availableNow=True).start())
    finally:
        spark.streams.removeListener(log)


def test_a_stream_of_an_unknown_type_is_refused(spark):
    with pytest.raises(KeyError, match="no stream of type 'nope'"):
        read_stream(spark, SourceSpec("x", {}, "nope"))
    with pytest.raises(ValueError, match="schema"):
        read_stream(spark, SourceSpec("x", {"path": "p", "format": "json"}))
    with pytest.raises(ValueError, match="lower-case"):
        register_stream_type("Mixed", None)
