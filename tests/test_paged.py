import datetime

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from terrace.operators.tables import quoted
from terrace.sources.paged import PagedSource, Pages, _expression, page_path, pages_available, read_paged, stream_paged
from terrace.sources.readers import READERS, register_type
from terrace.sources.spec import SourceSpec
from terrace.streaming.streams import finish, stream_ingest
from terrace.plans.ingest import ingest_source
from pyspark.sql import types as T
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNull, LessThanOrEqual, StringContains

PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


@pytest.fixture
def folder(ns, tmp_path):
    class Folder:
        path, count = str(tmp_path), 0
        spec = SourceSpec("pages", {"path": str(tmp_path), "schema": "id bigint, word string, x double"}, "paged", ns)

        @staticmethod
        def add(*rows, **options):
            pq.write_table(pa.table({"id": pa.array([r[0] for r in rows], pa.int64()), "word": pa.array([r[1] for r in rows], pa.string()),
                                     "x": pa.array([r[2] for r in rows], pa.float64())}), page_path(Folder.path, Folder.count), **options)
            Folder.count += 1
    return Folder


@pytest.mark.parametrize("pages", [0, 1, 2, 3, 7, 8, 9])
def test_pages_are_counted_up_to_the_first_gap(tmp_path, pages):
    for k in range(pages):
        open(page_path(str(tmp_path), k), "w").close()
    assert pages_available(str(tmp_path)) == pages
    assert pages_available(f"file://{tmp_path}") == pages


def test_a_batch_reads_all_pages(spark, folder, rows):
    assert read_paged(spark, folder.spec).count() == 0
    given = [(1, "a", 0.5), (2, None, float("nan")), (None, "", None)]
    folder.add(*given[:2])
    folder.add()
    folder.add(given[2], given[2])
    assert repr(rows.of(read_paged(spark, folder.spec))) == repr(sorted([*given, given[2]], key=repr))
    register_type("paged", read_paged)
    try:
        assert ingest_source(spark, folder.spec, "b1")[1] == 4
    finally:
        READERS.pop("paged")


@pytest.mark.parametrize("condition, left", [
    ("id >= 2", [2, 3, 4]), ("id IN (1, 4, NULL)", [1, 4]), ("word = 'a'", [1, 4]), ("word IS NULL", [2]), ("id < 3 AND x > 1", [2]),
    ("x > 5", [2]), ("word LIKE '%b%'", [3]), ("NOT (id = 3)", [1, 2, 4]), ("id > 100", []), ("word <=> NULL", [2]), ("id <> 2 OR word = 'a'", [1, 3, 4])])
def test_pushed_conditions_give_the_same_rows(spark, folder, condition, left):
    folder.add((1, "a", 1.0), (2, None, float("nan")))
    folder.add((3, "bb", None), (4, "a", -1.0))
    found = {}
    for pushing in ("false", "true"):
        spark.conf.set(PUSHDOWN, pushing)
        try:
            found[pushing] = sorted(r.id for r in read_paged(spark, folder.spec).where(condition).collect())
        finally:
            spark.conf.unset(PUSHDOWN)
    assert found == {"false": left, "true": left}  # NaN is above all numbers in Spark


def test_conditions_reach_the_pages(folder):
    folder.add(*[(i, "w", 0.0) for i in range(1000)], row_group_size=100)
    schema = T.StructType().add("id", "long").add("word", "string").add("x", "double")
    reader = PagedSource({"path": folder.path, "pushdown": "true"}).reader(schema)
    kept = list(reader.pushFilters([GreaterThan(("id",), 949), LessThanOrEqual(("x",), 1.0), StringContains(("word",), "w")]))
    assert kept == [LessThanOrEqual(("x",), 1.0), StringContains(("word",), "w")]
    assert [b.num_rows for b in reader.read(Pages(0, 1))] == [50]
    kinds = {"d": T.DateType(), "s": T.StructType()}
    assert _expression(EqualTo(("d",), datetime.date(2024, 1, 1)), kinds) is not None
    assert _expression(IsNull(("s",)), kinds) is None and _expression(EqualTo(("s", "d"), 1), kinds) is None
    assert _expression(In(("d",), (None,)), kinds) is None and _expression(EqualTo(("gone",), 1), kinds) is None


def test_a_stream_goes_on_behind_its_checkpoint(spark, folder, rows, tmp_path):
    def run():
        loading = stream_ingest(stream_paged(spark, folder.spec), folder.spec, f"{tmp_path}-ck", "r", include_source_file=False)
        return finish(loading, spark, quoted(folder.spec.namespace, "pages"))
    for i in range(3):
        folder.add((i, "a", 0.0))
    assert rows.of(run().select("id", "_batch_id")) == [(0, "r:0"), (1, "r:0"), (2, "r:0")]
    folder.add((3, "b", 0.0), (3, "b", 0.0))
    assert run().where("_batch_id = 'r:1'").count() == 2
    assert run().count() == 5


def test_tasks_take_several_pages(folder):
    reader = PagedSource({"path": folder.path, "pages_per_task": "2"}).streamReader(T.StructType().add("id", "long"))
    assert [p.value for p in reader.partitions({"page": 1}, {"page": 6})] == [(1, 3), (3, 5), (5, 6)]
    assert reader.partitions({"page": 6}, {"page": 6}) == []
    with pytest.raises(ValueError, match="pages_per_task"):
        PagedSource({"path": folder.path, "pages_per_task": "0"}).streamReader(T.StructType())


def test_needed_options(spark):
    with pytest.raises(ValueError, match="schema"):
        read_paged(spark, SourceSpec("p", {"path": "x"}, "paged"))
