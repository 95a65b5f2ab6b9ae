import pytest
import yaml

from terrace.sources.registry import (
    check_registry, choose, load_registry, registry_frame, select_enabled, shared_targets)
from terrace.sources.spec import SourceSpec, spec_from


def entry(name="sales_raw", **changes):
    return {"name": name, "type": "file", "target": {"namespace": "bronze", "table": name},
            "options": {"path": "/in", "format": "csv"}, **changes}


def jdbc_entry(name="orders_db", **options):
    return entry(name, type="jdbc", options={
        "url": "jdbc:x", "driver": "d", "user_env": "U", "password_env": "P", **options})


@pytest.fixture
def registry(tmp_path):
    def write(*entries, **top):
        path = tmp_path / "sources.yml"
        path.write_text(yaml.safe_dump({"version": 1, "defaults": {"layer": "x"},
                                        "sources": list(entries), **top}))
        return str(path)
    return write


def test_enabled_sources_in_order(registry):
    specs = load_registry(registry(entry("one"), entry("two", enabled=False), entry("three", tags=["a"])))
    assert [s.name for s in choose(specs)] == ["one", "three"]
    assert [s.name for s in choose(specs, ["three"])] == ["three"]
    assert choose(specs, ["two"]) == []
    assert specs[2].tags == ("a",) and specs[0].target == "bronze.one"
    with pytest.raises(ValueError, match="nope"):
        choose(specs, ["nope", "one"])


def test_entry_shape_is_checked(registry):
    for bad in (entry(owner_team="x"), {k: v for k, v in entry().items() if k != "options"},
                entry(target={"namespace": "bronze"})):
        with pytest.raises(ValueError):
            load_registry(registry(bad))
    for top in ({"version": 2}, {"extra": 1}, {"sources": []}):
        with pytest.raises(ValueError):
            load_registry(registry(entry(), **top))
    with pytest.raises(FileNotFoundError):
        load_registry("/no/such/file.yml")


@pytest.mark.parametrize("entries, broken", [
    ([entry(), jdbc_entry(dbtable="t"), jdbc_entry("more_db", query="q", num_partitions=4)], None),
    ([entry(), entry()], "name:unique"),
    ([entry(options={"path": "/in"})], "options.format:required"),
    ([entry(options={"path": "", "format": "csv"})], "options.path:required"),
    ([entry(options={"path": "/in", "format": "xml"})], "options.format:enum"),
    ([jdbc_entry()], "one_of"),
    ([jdbc_entry(dbtable="a", query="b")], "one_of"),
    ([jdbc_entry(dbtable="a", num_partitions=0)], "num_partitions:minimum"),
    ([jdbc_entry(dbtable="a", fetch_size="many")], "fetch_size:minimum"),
    ([entry("BadName", target={"namespace": "bronze", "table": "ok"})], "name:pattern"),
    ([entry(target={"namespace": "B", "table": "ok"})], "target.namespace:pattern"),
    ([entry(tags=["a", "a"])], "tags:unique_items"),
    ([entry(partition_by=["d", "d"])], "partition_by:unique_items"),
    ([entry(type="ftp")], "type:enum"),
])
def test_contract(spark, registry, entries, broken):
    specs = load_registry(registry(*entries))
    if broken is None:
        check_registry(spark, specs)
    else:
        with pytest.raises(ValueError, match=broken.replace("|", r"\|")):
            check_registry(spark, specs)


def test_registry_as_a_frame(spark, rows):
    specs = [SourceSpec("one", {}, table="shared"), SourceSpec("two", {}, table="shared", enabled=False),
             SourceSpec("three", {"n": 1})]
    frame = registry_frame(spark, specs)
    assert rows.of(select_enabled(frame).select("name")) == [("one",), ("three",)]
    only = rows.make([("three",), ("three",), ("two",)], "name string")
    assert rows.of(select_enabled(frame, only).select("name")) == [("three",)]
    assert rows.of(shared_targets(frame)) == [("bronze", "shared", 2)]


@pytest.mark.parametrize("wrong", [
    {"partition_by": "day"}, {"tags": "a"}, {"tags": [1]}, {"enabled": "yes"}, {"enabled": 1}, {"name": 5}, {"options": []},
    {"options": {"path": "p", "format": "csv", "recursive_lookup": "true"}}, {"options": {"path": "p", "format": "csv", "reader_options": "x"}},
    {"options": {"path": "p", "format": "csv", "reader_options": {"sep": ["|"]}}}, {"options": {"path": 7, "format": "csv"}},
    {"options": {"num_partitions": 1.5}}, {"options": {"fetch_size": True}}, {"options": {"lower_bound": 1.5}}])
def test_values_of_the_wrong_type_are_refused(wrong):
    assert spec_from(entry()).partition_by == ()
    with pytest.raises(ValueError, match="wrong type"):
        spec_from(entry() | wrong)
