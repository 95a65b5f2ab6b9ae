"""The Merkle manifest against a plain tree in Python."""

import hashlib
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from terrace.llm import manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def record(doc, more=0):
    values = [doc[f] if f != "n_chars" or doc[f] is None else doc[f] + more for f in manifest.FIELDS]
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def tree(leaves):
    levels = [list(leaves)]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i:i + 2]) for i in range(0, len(levels[-1]), 2)])
    return levels


def siblings(levels, place):
    for level in levels[:-1]:
        other = place ^ 1
        yield (level[other] if other < len(level) else None), place & 1
        place >>= 1


def plain(docs):
    by = {}
    for doc in docs:
        by.setdefault(doc["lang"], []).append(doc)
    langs = sorted(by, key=lambda x: (x is not None, (x or "").encode()))
    for rows in by.values():
        rows.sort(key=lambda d: (d["doc_id"] is not None, d["doc_id"] or 0, record(d)))
    trees = [tree(map(record, by[lang])) for lang in langs]
    top = tree([t[-1][0] for t in trees])
    out = []
    for k, lang in enumerate(langs):
        for place, doc in enumerate(by[lang]):
            proof = [*siblings(trees[k], place), *siblings(top, k)]
            bad = doc["doc_id"] is not None and zlib.crc32(str(doc["doc_id"]).encode()) % 7 == 0
            at = record(doc, int(bad))
            for sibling, side in proof:
                at = h(at) if sibling is None else h(sibling, at) if side else h(at, sibling)
            out.append((doc["doc_id"], record(doc), trees[k][-1][0], top[-1][0],
                        h(*(s for s, _ in proof if s)), at, at == top[-1][0]))
    return sorted(out, key=repr)


def check(docs, levels):
    assert sorted(map(tuple, manifest.digests(docs, levels).collect()), key=repr) == plain([r.asDict() for r in docs.collect()])


@settings(max_examples=200, deadline=None)
@given(size=st.integers(1, 70), more=st.integers(0, 3))
def test_sweeps_of_one_block(size, more):
    leaves = [h(str(i)) for i in range(size)]
    levels = tree(leaves)
    for _ in range(more):
        levels.append([h(levels[-1][0])])
    nodes, height, counts = manifest.sweep(leaves, len(levels) - 1 if more else None)
    assert height == len(levels) - 1 and counts == list(map(len, levels))
    assert nodes == {(k, i): d for k, level in enumerate(levels) for i, d in enumerate(level)}
    found = list(manifest.proofs(leaves, height, ("<.", "s" * 64)))
    assert [p for p, _, _ in found] == list(range(size))[::-1]
    for place, sides, given_siblings in found:
        assert manifest.fold(leaves[place], sides[:-2], given_siblings[:-64]) == levels[-1][0]
        assert sides[-2:] == "<." and given_siblings[-64:] == "s" * 64


@pytest.mark.parametrize("levels", [2, 12])
def test_tables_in_several_rounds(spark, levels):
    check(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(90), levels)


def test_odd_rows(spark):
    rows = [(1, "a", "x", "s", 1), (2, "", "x", "s", 0), (2, None, "x", "s", None), (None, "b", "x", None, 1), (None, "c", "x", "s", 1),
            (3, "long " * 300_000, None, "s", 2 ** 63 - 1), (4, "ü", "ä", "s", 1), (5, "u", "", "s", 1)]
    docs = spark.createDataFrame(rows + [(7, "same", "x", "s", 4)] * 9, DOCS)
    check(docs, 2)
    clash = docs.selectExpr("*", "1 AS place", "2 AS tree", "'x' AS digest", "0 AS levels", "0 AS id")
    assert sorted(map(tuple, manifest.digests(clash).collect()), key=repr) == plain([r.asDict() for r in docs.collect()])
    assert manifest.digests(docs.where("false")).count() == 0
    check(docs.limit(1), 12)


def test_a_changed_sibling_is_noticed():
    leaves = [h(str(i)) for i in range(5)]
    (place, sides, found), *_ = manifest.proofs(leaves, None, ("", ""))
    nodes, height, _ = manifest.sweep(leaves)
    assert manifest.fold(leaves[place], sides, found) == nodes[height, 0]
    assert manifest.fold(leaves[place], sides, h("other") + found[64:]) != nodes[height, 0]
