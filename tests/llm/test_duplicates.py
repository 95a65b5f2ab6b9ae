"""Jaccard join, embedding near-dedup, substring dedup and components against brute force."""

import collections
import random
import re

import numpy as np
import pytest

from terrace.llm import components, jaccard, memory, substrings, vamana

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def joined(links, nodes):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text, n=4):
    words = WORD.findall((text or "").translate(LOWER))
    return frozenset(tuple(words[k:k + n]) for k in range(max(1, len(words) - n + 1))) if words else frozenset()


def brute_jaccard(docs, n=4, percent=85):
    sets = {i: shingles(t, n) for i, t in docs}
    names = sorted(sets)
    links = [(a, b) for k, a in enumerate(names) for b in names[k + 1:]
             if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])]
    return joined(links, names), {i: len(s) for i, s in sets.items()}


def corpus(rng, groups=12, alone=40):
    words = [f"w{k}" for k in range(400)]
    docs = [" ".join(rng.choices(words, k=rng.randrange(1, 90))) for _ in range(alone)]
    for _ in range(groups):
        base = rng.choices(words, k=rng.randrange(30, 120))
        for _ in range(rng.randrange(2, 9)):
            copy = list(base)
            for _ in range(rng.randrange(0, 4)):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            docs.append(" ".join(copy))
    rng.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_agrees_with_brute_force(spark, seed, monkeypatch):
    if seed == 2:  # blocks and the last rounds, which small data would not reach
        monkeypatch.setattr(jaccard, "BLOCK", 3)
        monkeypatch.setattr(jaccard, "CHEAP", 0)
    docs = corpus(random.Random(seed))
    components_, sizes = brute_jaccard(docs)
    rows = jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == components_
    assert {r.doc_id: r.n_shingles for r in rows} == sizes
    assert len(set(components_.values())) < len(docs)


def test_jaccard_hot_bucket(spark, monkeypatch):
    """A bucket that is dealt out by hash still links all its documents."""
    monkeypatch.setattr(jaccard, "HOT", 4)
    base = [f"w{k}" for k in range(60)]
    docs = [(k, " ".join([*base[:30], f"own{k}", *base[31:]])) for k in range(40)]
    expected, _ = brute_jaccard(docs)
    rows = jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == expected == dict.fromkeys(range(40), 0)


def test_jaccard_threshold_is_exact(spark):
    """Sets of 20 and 17 shared n-grams: 17 of 20 is 85 per cent and links, 16 of 19 is less and does not."""
    words = [f"w{k}" for k in range(60)]
    full, part = " ".join(words[:23]), " ".join(words[:20])
    shorter, less = " ".join(words[30:52]), " ".join(words[30:49])
    rows = jaccard.jaccard_components(spark.createDataFrame(
        [(1, full), (2, part), (3, shorter), (4, less)], "doc_id long, text string")).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in rows} == {1: (20, 1), 2: (17, 1), 3: (19, 3), 4: (16, 4)}


def test_jaccard_odd_rows(spark):
    long = " ".join(f"v{k}" for k in range(30_000))
    docs = spark.createDataFrame(
        [(9, "one two", "x"), (3, "ONE\ttwo ", "x"), (4, None, "x"), (5, "", "x"), (6, " \n ", "x"), (None, "one two", "x"), (9, "one two", "x"),
         (7, long, "x"), (8, long + " end", "x"), (10, "Été A", "x"), (11, "été a", "x")], "doc_id long, text string, component_id string")
    rows = jaccard.jaccard_components(docs).collect()
    assert sorted(((r.doc_id or -1), r.n_shingles, r.component_id) for r in rows) == [
        (-1, 1, None), (3, 1, 3), (4, 0, 4), (5, 0, 5), (6, 0, 6), (7, 29997, 7), (8, 29998, 7), (9, 1, 3), (9, 1, 3), (10, 1, 10), (11, 1, 11)]
    kept = jaccard.keep_representatives(docs)
    assert kept.columns == docs.columns and sorted(r.doc_id or -1 for r in kept.collect()) == [-1, 3, 4, 5, 6, 7, 10, 11]
    assert jaccard.jaccard_components(docs.where("false")).count() == 0


def test_sketch_bounds_set_differences():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 1 << 62, n, "u8")) for n in (3, 40, 40, 200, 3000)]
    sets += [np.unique(np.r_[s[: len(s) * 9 // 10], rng.integers(0, 1 << 62, 5, "u8")]) for s in sets]
    counts = [jaccard.unpacked(jaccard.sketch(s)) for s in sets]
    for a, one in enumerate(sets):
        least = jaccard.apart(counts[a], counts)
        assert all(n <= len(np.setxor1d(one, other)) for n, other in zip(least, sets, strict=True))
        assert least[a] == 0
    assert jaccard.apart(counts[4], [counts[3]])[0] > 2000


@pytest.mark.parametrize("percent", [85, 80])
def test_sketch_keeps_supersets_across_powers_of_two(percent):
    """A set and one that has it and is similar by exactly ``percent``: their sketches are of two widths."""
    rng = np.random.default_rng(7)
    for power in (512, 2048, 8192):
        for less in np.linspace(power * percent // 100 + 1, power - 1, 5).astype(int) // 20 * 20:
            more = int(less) * 100 // percent
            whole = rng.integers(0, 1 << 63, more, "u8") * np.uint64(2)
            one, other = (jaccard.unpacked(jaccard.sketch(s)) for s in (whole[:less], whole))
            allowed = less + more - 2 * jaccard.overlap_needed(percent, int(less), more)
            assert jaccard.apart(one, [other])[0] <= more - less <= allowed
            assert jaccard.apart(other, [one])[0] <= more - less


def test_forest_pairs_supersets_across_powers_of_two():
    """The rounds that must find every link left pair a set with a superset of it."""
    whole = np.random.default_rng(8).integers(0, 1 << 63, 1176, "u8")
    sets = [whole[:1000], whole]
    pairs = jaccard.forest(np.arange(2), np.array([1000, 1176]), np.zeros(2, "i8"), np.arange(2), np.zeros(2, "i8"),
                           [jaccard.sketch(s).tobytes() for s in sets], [()] * 2, 0, 0, 85, 1)
    assert [tuple(map(int, p)) for p in pairs] == [(0, 1)]


@pytest.mark.parametrize("block", [components.BLOCK, 7])
def test_components(spark, block, monkeypatch):
    monkeypatch.setattr(components, "BLOCK", block)
    rng = random.Random(3)
    links = [(k, k + 1) for k in range(60)] + [(100, k) for k in range(101, 160)] + [(rng.randrange(200, 260), rng.randrange(200, 260)) for _ in range(40)]
    frame = spark.createDataFrame([*links, (5, 4), (7, 7), (None, 3)], "a long, b long")
    found = {r.node: r.component for r in components.components(frame).collect()}
    assert found == joined(links, {n for link in links for n in link})
    assert components.components(frame.where("false")).count() == 0


def brute_vectors(rows, similarity=0.93):
    good = {}
    for name, vector, label in rows:
        if name is not None and label is not None and vector and None not in vector and np.isfinite(vector).all() and np.any(vector):
            good[name] = np.array(vector, "f8") / np.linalg.norm(np.array(vector, "f8")), label
    names = sorted(good)
    links = [(a, b) for k, a in enumerate(names) for b in names[k + 1:]
             if good[a][1] == good[b][1] and good[a][0] @ good[b][0] >= similarity]
    every = {r[0] for r in rows if r[0] is not None}
    counts = dict.fromkeys(every, 0)
    for a, b in links:
        counts[a] += 1
        counts[b] += 1
    return joined(links, every), counts


def vectors(seed, n=300, size=12, groups=10):
    rng = np.random.default_rng(seed)
    base = rng.normal(size=(groups, size))
    out = []
    for k in range(n):
        v = base[rng.integers(groups)] + rng.normal(size=size) * 0.12 if rng.random() < 0.6 else rng.normal(size=size)
        out.append((k, [float(x) for x in v * rng.uniform(0.5, 3)], int(rng.integers(2))))
    return out


@pytest.mark.parametrize("block", [vamana.BLOCK, 40])
def test_vectors_agree_with_brute_force(spark, block, monkeypatch):
    monkeypatch.setattr(vamana, "BLOCK", block)
    monkeypatch.setattr(vamana, "PER_SHARD", 60)
    rows = vectors(block) + [(1000 + k, [1.0] * 12, 0) for k in range(30)]
    expected, counts = brute_vectors(rows)
    found = vamana.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert found[0].audit_recall >= 0.995
    total = sum(counts.values())
    assert sum(r.n_links for r in found) >= 0.99 * total and all(r.n_links <= counts[r.vec_id] for r in found)
    assert np.mean([r.component_id == expected[r.vec_id] for r in found]) > 0.98
    assert all(r.kept == (r.vec_id == r.component_id) for r in found)


def spread_pairs(seed, pairs=150, size=64):
    """Pairs at cosine 0.935 in all directions: many share none of their nearest clusters."""
    rng = np.random.default_rng(seed)
    out = []
    for k in range(pairs):
        one, other = vamana.unit(rng.normal(size=(2, size)))
        other = vamana.unit([other - (other @ one) * one])[0]
        for v in (one, 0.935 * one + (1 - 0.935 ** 2) ** 0.5 * other):
            out.append((len(out), [float(x) for x in v], k % 2))
    return out


@pytest.mark.parametrize("probes", [vamana.AUDIT_MOST, 20])
def test_vectors_lost_by_the_shards_are_found(spark, probes, monkeypatch):
    """Small clusters lose pairs, beside a hot group whose links all are found; rare links cannot be audited."""
    monkeypatch.setattr(vamana, "PER_SHARD", 4)
    monkeypatch.setattr(vamana, "OVERLAP", 1)
    monkeypatch.setattr(vamana, "REPEATS", 0)
    monkeypatch.setattr(vamana, "EXACT", 40)
    monkeypatch.setattr(vamana, "AUDIT_MOST", probes)
    monkeypatch.setattr(vamana, "AUDIT_FIRST", probes)
    rng = np.random.default_rng(9)
    hot = [(1000 + k, [1.0 + float(x) for x in rng.normal(size=64) * 0.05], 0) for k in range(100)]
    rows = spread_pairs(3) + hot
    expected, counts = brute_vectors(rows)
    found = vamana.near_duplicates(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect()
    assert {r.vec_id: r.n_links for r in found} == counts
    assert {r.vec_id: r.component_id for r in found} == expected


def test_vectors_odd_rows(spark):
    v, w = [1.0, 0.0, 0.0], [0.0, 1.0, 0.0]
    rows = [(1, v, 0), (2, [2.0, 0.0, 0.0], 0), (3, v, 1), (4, v, None), (5, None, 0), (6, [0.0] * 3, 0), (7, [1.0, None, 0.0], 0),
            (8, [float("nan"), 1.0, 0.0], 0), (9, [float("inf"), 0.0, 0.0], 0), (10, [], 0), (11, w, 0), (2, [2.0, 0.0, 0.0], 0), (None, v, 0),
            (12, [1e200, 0.0, 0.0], 0), (13, [-1.0, 0.0, 0.0], 0)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, n_links int")
    found = sorted(((r.vec_id or -1), r.n_links, r.component_id, r.kept) for r in vamana.near_duplicates(frame).collect())
    assert found == [(-1, 0, None, True), (1, 2, 1, True), (2, 2, 1, False), (2, 2, 1, False), *((k, 0, k, True) for k in (3, 4, 5, 6, 7, 8, 9, 10, 11)),
                     (12, 2, 1, False), (13, 0, 13, True)]
    assert vamana.near_duplicates(frame.where("false")).count() == 0
    assert [r.n_links for r in vamana.near_duplicates(frame.where("vec_id = 5")).collect()] == [0]


def test_vectors_of_several_lengths(spark):
    """Vectors meet those of their own length alone, and a label cannot pass for a component."""
    rows = [(k, [float(x) for x in v], "a") for k, v in enumerate(np.random.default_rng(8).normal(size=(40, 6)))]
    rows += [(100 + k, r[1][:n], "a") for k, (r, n) in enumerate(zip(rows, [3, 3, 2, 5, 1, 4] * 6))]
    rows += [(200 + k, [x * 2 for x in r[1]], "a") for k, r in enumerate(rows[::3])]
    rows += [(300, [1.0], "2.0,a"), (301, [1.0, 2.0], "a"), (302, [1.0, 0.0], "b"), (303, [1.0], "b")]
    expected, counts = {}, {}
    for n in range(1, 7):
        e, c = brute_vectors([r for r in rows if len(r[1]) == n])
        expected |= e
        counts |= c
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    found = vamana.near_duplicates(frame).collect()
    assert {r.vec_id: r.n_links for r in found} == counts
    assert {r.vec_id: r.component_id for r in found} == expected


def test_flat_graph_search_reaches_all_of_a_shard():
    rng = np.random.default_rng(2)
    points = vamana.unit(np.r_[rng.normal(size=(400, 24)), rng.normal(size=(1, 24)) + rng.normal(size=(150, 24)) * 0.1])
    pairs = vamana.search(points, vamana.build(points, rng))
    true = points @ points.T >= vamana.SIMILARITY
    np.fill_diagonal(true, False)
    assert len(pairs) == true.sum() and true[tuple(pairs.T)].all()


def passage(rng, n):
    return " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 9))) for _ in range(n))


def test_substrings_find_planted_passages(spark):
    rng = random.Random(4)
    shared = [passage(rng, 60) for _ in range(6)]
    docs, planted = [], {}
    for k in range(60):
        parts = [passage(rng, rng.randrange(10, 200))]
        if k % 3 == 0:
            planted[k] = k // 3 % 6
            parts.append(shared[planted[k]])
        docs.append((k, " ".join([*parts, passage(rng, 30)])))
    docs.append((100, docs[0][1][:40] + "é" + docs[0][1][40:]))  # an insertion
    first = {p: min(k for k, q in planted.items() if q == p) for p in planted.values()}
    rows = {r.doc_id: r for r in substrings.repeated_spans(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert set(rows) == {k for k, p in planted.items() if first[p] != k} | {100}
    text = dict(docs)
    for k, r in rows.items():
        data = text[k].encode()
        for s in r.spans:
            assert data[s.start:s.end].decode() in text[0 if k == 100 else first[planted[k]]]
        if k != 100:
            assert r.sources == [first[planted[k]]] and r.repeated_bytes >= len(shared[planted[k]]) - 130
        else:
            assert r.repeated_bytes >= len(data) - 250
    left = {r.doc_id: r.text for r in substrings.remove_repeats(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    for k, t in docs:
        assert (left[k] == t) == (k not in rows) and len(left[k].encode()) == len(t.encode()) - (rows[k].repeated_bytes if k in rows else 0)


def test_substrings_find_passages_of_short_words(spark):
    """Of shared passages of short words, all those of 51 words are found and none of 45."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefghij", k=3))
    docs, long = [], set()
    for k in range(0, 80, 2):
        shared = " ".join(word() for _ in range(51 if k % 4 else 45))
        docs += [(k + d, " ".join([*(word() for _ in range(30)), shared, *(word() for _ in range(30))])) for d in (0, 1)]
        long |= {k + 1} if k % 4 else set()
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    rows = {r.doc_id: r for r in substrings.repeated_spans(frame).collect()}
    assert set(rows) == long
    text = dict(docs)
    for k, r in rows.items():
        assert r.sources == [k - 1] and all(text[k].encode()[s.start:s.end].decode() in text[k - 1] for s in r.spans)
    assert sum(r.repeated_bytes >= 51 * 4 - 1 for r in rows.values()) >= 0.9 * len(rows)


def brute_spans(docs):
    """``{id: (spans, sources)}`` by the definition: document by document, whole texts compared, no filter and no window."""
    runs = {k: substrings.runs([t])[1:] for k, t in docs}
    first = {}
    for k in sorted(runs):
        for d in runs[k][0].tolist():
            first.setdefault(d, k)
    data, out = {k: t.encode() for k, t in docs}, {}
    for k, (digests, starts, ends) in runs.items():
        groups = []
        for d, a, b in zip(digests.tolist(), starts.tolist(), ends.tolist()):
            if first[d] != k:
                if groups and a <= groups[-1][1]:
                    groups[-1][1] = max(groups[-1][1], b)
                    groups[-1][2].append((d, a))
                else:
                    groups.append([a, b, [(d, a)]])
        found = set()
        for a, b, members in groups:
            votes = collections.Counter(first[d] for d, _ in members)
            source = min(votes, key=lambda s: (-votes[s], s))
            if b - a >= substrings.LEAST:
                found.add((a, b, source))
                continue
            d, at = next(m for m in members if first[m[0]] == source)
            mine, other = data[k], data[source]
            for there in (s for e, s in zip(runs[source][0].tolist(), runs[source][1].tolist()) if e == d):
                low, high, back, on = at, at, there, there
                while low and back and mine[low - 1] == other[back - 1]:
                    low, back = low - 1, back - 1
                while high < len(mine) and on < len(other) and mine[high] == other[on]:
                    high, on = high + 1, on + 1
                words = [w for w in re.finditer(rb"[^\x20\x09-\x0D]+", mine) if w.start() >= min(a, low) and w.end() <= max(b, high)]
                if len(words) > substrings.WORDS:
                    found.add((words[0].start(), words[-1].end(), source))
        if found:
            spans = []
            for a, b, _ in sorted(found):
                if spans and a <= spans[-1][1]:
                    spans[-1] = spans[-1][0], max(spans[-1][1], b)
                else:
                    spans.append((a, b))
            out[k] = spans, sorted({s for *_, s in found})
    return out


@pytest.mark.parametrize("asks", [substrings.ASKS, 2])
def test_substrings_agree_with_brute_force(spark, asks, monkeypatch):
    """Passages of long and short words, also one that a third of the documents have from one source."""
    monkeypatch.setattr(substrings, "ASKS", asks)
    monkeypatch.setattr(substrings, "SHOWN", 3)
    rng = random.Random(12)
    short = lambda n: " ".join("".join(rng.choices("abcdefghij", k=rng.randrange(2, 5))) for _ in range(n))
    hot, pool = short(52), [short(rng.randrange(40, 60)) for _ in range(8)] + [passage(rng, rng.randrange(30, 90)) for _ in range(6)]
    docs = []
    for k in range(72):
        parts = [short(25), hot if k % 3 == 0 else rng.choice(pool), passage(rng, 20)]
        rng.shuffle(parts)
        docs.append((k, " ".join(parts)))
    docs += [(100, docs[5][1]), (101, docs[5][1]), (102, docs[9][1][:150] + "ü" + docs[9][1][150:])]  # ties and a near copy
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: ([(s.start, s.end) for s in r.spans], r.sources) for r in substrings.repeated_spans(frame).collect()}
    assert found == brute_spans(docs)
    assert sum(0 in sources for _, sources in found.values()) >= 20


def test_substrings_spans_of_one_source_are_dealt_out(spark, monkeypatch):
    monkeypatch.setattr(substrings, "ASKS", 20)
    spans = [(d, 5, 100, 0, 7, 5, False) for d in range(1, 1001)] + [(2000, 5, 100, 3, 8, 5, False)]
    rows = substrings._dealt(spark.createDataFrame(spans, substrings.SPAN)).collect()
    of = {}
    for r in rows:
        of.setdefault(r.owner, []).append(len(r.asks))
    assert sum(of[0]) == 1000 and len(of[0]) >= 45 and max(of[0]) <= 60
    assert of[3] == [2]
    assert of[2000] == [1] and len(of) == 1002


def test_substrings_odd_rows(spark):
    rng = random.Random(5)
    text = passage(rng, 80)
    docs = spark.createDataFrame([(2, text, "a"), (1, text, "b"), (1, text, "b"), (None, text, "c"), (3, None, "d"), (4, "", "e"),
                                  (5, "é" * 50_000, "f"), (6, text[:100], "g")], "doc_id long, text string, spans string")
    rows = substrings.repeated_spans(docs).collect()
    assert [(r.doc_id, r.sources) for r in rows] == [(2, [1])]
    out = substrings.remove_repeats(docs)
    assert out.columns == docs.columns and out.count() == 8
    kept = {r.doc_id: r.text for r in out.collect()}
    assert kept[1] == kept[None] == text and len(kept[2]) < 120 and kept[3] is None and kept[5] == "é" * 50_000
    assert substrings.repeated_spans(docs.where("false")).count() == 0


def test_chunks_resist_insertions():
    rng = random.Random(6)
    text = passage(rng, 400)
    same = set(substrings.runs([text])[1].tolist()) & set(substrings.runs([text[:300] + "xyz" + text[300:]])[1].tolist())
    assert len(same) >= 0.9 * len(substrings.runs([text])[1])
    alone = substrings.runs([text])
    beside = substrings.runs(["other", text, "é"])
    assert set(alone[1].tolist()) <= set(beside[1].tolist())


@pytest.mark.parametrize("percent", [80, 85, 100])
def test_jaccard_blocks_of_a_mixed_bucket(spark, monkeypatch, percent):
    """Every pair that can be similar meets once; many rows of one component are not copied to all blocks."""
    monkeypatch.setattr(jaccard, "BLOCK", 10)
    rng = np.random.default_rng(percent)
    rows = [(1, d, int(size), 0, 0 if d < 300 else d) for d, size in enumerate(np.r_[rng.integers(90, 130, 300), rng.integers(1, 400, 30)])]
    rows += [(2, d, int(size), 0, d % 7) for d, size in enumerate(rng.integers(1, 60, 60))]
    rows += [(3, d, 50, 0, 5) for d in range(40)] + [(4, d, 50, 0, d) for d in range(9)]
    cut = jaccard._cut(spark.createDataFrame(rows, "token long, doc long, size int, place int, component long"), percent).collect()
    blocks, met = {}, {}
    for r in cut:
        blocks.setdefault((r.token, r.i, r.j), []).append(r)
    for (token, i, j), held in blocks.items():
        for x in held:
            for y in held:
                if x.doc < y.doc and (i == j or x.mine != y.mine):
                    met[token, x.doc, y.doc] = met.get((token, x.doc, y.doc), 0) + 1
    assert set(met.values()) == {1}
    for a in rows:
        for b in rows:
            if a[0] == b[0] and a[1] < b[1] and a[4] != b[4] and 100 * min(a[2], b[2]) >= percent * max(a[2], b[2]):
                assert (a[0], a[1], b[1]) in met
    assert 3 not in {r.token for r in cut} and sum(r.token == 4 for r in cut) == 9
    assert max(collections.Counter(r.doc for r in cut if r.token == 1 and r.doc < 300).values()) <= 4


@pytest.mark.parametrize("most", [1, 3])
def test_jaccard_buckets_of_any_size_agree_with_brute_force(spark, most, monkeypatch):
    """Whether a bucket gives all its pairs or goes through the forests changes nothing."""
    monkeypatch.setattr(jaccard, "SMALL", most)
    docs = corpus(random.Random(5), groups=6, alone=10)
    docs += [(100 + k, text) for k, text in docs[:10]] + [(3, "another text with this id"), (None, docs[0][1]), (90, None)]
    expected, _ = brute_jaccard([d for d in docs if d[0] is not None and d != docs[-3]])
    rows = jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows if r.doc_id not in (None, 3)} == {k: v for k, v in expected.items() if k != 3}
    assert len(rows) == len(docs)


def test_jaccard_makes_no_sets_of_pairs_that_sketches_tell_apart(spark, monkeypatch):
    tried, verified = [], jaccard._verified

    def spy(docs, pairs, *rest):
        tried.extend((r.a, r.b) for r in pairs.collect())
        return verified(docs, pairs, *rest)

    monkeypatch.setattr(jaccard, "_verified", spy)
    # Two documents each share a rare passage, four each a longer and more frequent one.
    texts = [" ".join([f"p{i // 2}w{k}" for k in range(40)] + [f"b{i % 5}w{k}" for k in range(80)]) for i in range(20)]
    texts.append(texts[0].replace("b0w9 ", "other "))
    rows = jaccard.jaccard_components(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    assert {r.doc_id: r.component_id for r in rows} == {**dict(enumerate(range(20))), 20: 0}
    assert tried == [(0, 20)]


def test_jaccard_pairs_that_fail_do_not_take_a_round_each(spark, monkeypatch):
    """24 texts share 367 of 400 shingles (368 are needed): most pairs pass the sketches, and none is similar."""
    looks, forests = [], jaccard._forests

    def spy(*rest):
        looks.append(forests(*rest))
        return looks[-1]

    monkeypatch.setattr(jaccard, "_forests", spy)
    docs = [(i, " ".join([f"c{k}" for k in range(370)] + [f"p{i}w{k}" for k in range(33)])) for i in range(24)]
    rows = jaccard.jaccard_components(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {(r.doc_id, r.n_shingles, r.component_id) for r in rows} == {(i, 400, i) for i in range(24)}
    assert 2 <= len(looks) <= 4
    assert len({(r.a, r.b) for look in looks for r in look.collect()}) > 100


def test_forest_merges_only_after_its_free_pairs():
    sets = [np.unique(np.random.default_rng(3).integers(0, 1 << 63, 50, "u8"))] * 10
    given = np.arange(10), np.full(10, 50), np.zeros(10, "i8"), np.arange(10), np.zeros(10, "i8"), [jaccard.sketch(s).tobytes() for s in sets], [()] * 10
    assert len(jaccard.forest(*given, 0, 0, 85, 8)) == 9
    assert len(jaccard.forest(*given, 0, 0, 85, 8, 100)) == len(set(jaccard.forest(*given, 0, 0, 85, 8, 100))) == 45
    assert len(jaccard.forest(*given, 0, 0, 85, 8, 9)) == 9 + 8


def test_substrings_texts_without_repeats_are_not_joined(spark):
    rng = random.Random(9)
    docs = [(i, passage(rng, 60)) for i in range(300)]
    docs += [(300, docs[7][1]), (None, docs[7][1]), (301, None)]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    let = frame.where(substrings._among(spark.createDataFrame([(7,), (300,)], "id long"))("doc_id"))
    assert {7, 300} <= {r.doc_id for r in let.collect()} and let.count() < 10
    out = substrings.remove_repeats(frame)
    branches = out._jdf.queryExecution().optimizedPlan()
    assert branches.nodeName() == "Union" and "Join" not in branches.children().apply(0).toString()
    kept = {r.doc_id: r.text for r in out.collect()}
    assert out.count() == len(docs) and len(kept[300]) < 60
    assert {k: v for k, v in kept.items() if k != 300} == {k: v for k, v in docs if k != 300}


def test_substrings_give_back_what_other_operators_keep():
    memory.remembered("jaccard", "some", list)
    substrings.runs(["a text"])
    assert memory._owner == "substrings" and not memory._kept
