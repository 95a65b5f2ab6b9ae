"""Substring dedup (operator 10): content-defined chunking with a gear rolling hash.

A gear hash ``h = 2 h + G[byte]`` runs over the bytes of a text; its lowest nine bits depend on the
last nine bytes alone. A chunk ends where they fall below ``CUT`` (about every ``512 / CUT`` bytes)
and after each line, or ``LONGEST`` bytes on where neither comes (periodic texts), never inside a
character, so an insertion moves only the chunks around it.
The unit of deduplication is a run of ``RUN`` chunks, by its 64-bit digest: two texts that share a
passage share all runs between its first and its last boundary. A digest that several documents
have belongs to the one with the smallest id; elsewhere its bytes are repeated, and overlapping or
touching repeated runs of ``LEAST`` bytes together are a span. Runs are shorter than that, so
shared phrases and single lines leave a text alone. Shorter ones, of short words, are a span where
over ``WORDS`` words are shared: those that may be (``MARGIN`` bytes more on both sides, as a passage
goes on beyond its first and last boundary) are compared with the text of their source, byte by byte.

Digests are pre-aggregated in each task. Texts are read a second time for the places of repeated
digests; a bit filter of fixed size (``FILTER_BITS``) keeps runs that are certainly unique out of
that join, and what it lets through wrongly the join removes. Texts are shuffled only where spans are
to be compared or cut, by another such filter of their ids; all others are passed on where they are read.

Defined cases: NULL and empty texts have no spans. Repetition inside one document is not counted,
nor are rows that share an id (repeated rows). Rows with a NULL id take no part and stay as they
are.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F

from terrace.llm.jaccard import BYTE, INSIDE, ODD, chunks, id_bits, in_bits, mix
from terrace.llm.memory import release_others
from terrace.llm.registry import query, table
from terrace.workspace import materialise

CUT, LONGEST, RUN, LEAST = 48, 64, 6, 200
WORDS, MARGIN, WINDOW = 50, 112, 512
FILTER_BITS = 1 << 27
GAP = 16
#: Spans in one row of those that a text is compared for, and windows of texts in one batch.
ASKS, SHOWN = 512, 4096

GEAR = np.random.default_rng(10).integers(0, 1 << 16, 256).astype("u2")


def boundaries(flat):
    """Whether a chunk ends after each byte."""
    h = GEAR[flat]
    for k in (1, 2, 4, 8):  # sums over the last 2, 4, 8 and 16 bytes, each byte shifted by its distance
        earlier = h[:-k] << np.uint16(k)
        h = h.copy()
        h[k:] += earlier
    cut = ((h & np.uint16(511)) < CUT) | (flat == 10)
    cut[:-1] &= (flat[1:] & 0xC0) != 0x80
    return cut


def runs(texts):
    """Runs of chunks of all texts: arrays (text, digest, first byte, byte after)."""
    release_others("substrings")
    data = [(t or "").encode("utf-8", "replace") for t in texts]
    gap = b"\0" * GAP
    flat = np.frombuffer(gap + gap.join(data) + gap, "u1")
    sizes = np.array([len(d) for d in data], "i8")
    start = GAP + np.r_[0, np.cumsum(sizes + GAP)[:-1]]
    cut = boundaries(flat)
    cut[start - 1] = True
    cut[start + sizes - 1] = True
    ends = np.flatnonzero(cut) + 1  # every chunk lies between two of these
    long = np.flatnonzero(np.diff(ends) > LONGEST)
    if len(long):
        times = (np.diff(ends)[long] - 1) // LONGEST
        more = np.repeat(ends[long], times) + LONGEST * (1 + np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times))
        for _ in range(3):
            more += (flat[more] & 0xC0) == 0x80
        ends = np.union1d(ends, more)
    text = np.searchsorted(start, ends[:-1], "right") - 1
    inside = (text >= 0) & (ends[1:] <= (start + sizes)[np.maximum(text, 0)])
    begin, end, text = ends[:-1][inside], ends[1:][inside], text[inside]
    if len(begin) < RUN:
        return tuple(np.zeros(0, t) for t in ("i8", "u8", "i8", "i8"))
    length = end - begin
    with np.errstate(over="ignore"):
        powers = np.cumprod(np.full(int(length.max()), ODD, "u8"))
        offset = np.r_[0, np.cumsum(length)[:-1]]
        place = np.arange(int(length.sum())) - np.repeat(offset, length)
        chunk = mix(np.add.reduceat(BYTE[flat[np.repeat(begin, length) + place]] * powers[place], offset))
        n = len(begin) - RUN + 1
        digest = np.zeros(n, "u8")
        for k, factor in enumerate(mix(np.arange(1, RUN + 1, dtype="u8") * ODD) | np.uint64(1)):
            digest += chunk[k:k + n] * factor
        digest = mix(digest)
    same = text[:n] == text[RUN - 1:]
    base = start[text[:n]]
    return text[:n][same], digest[same], (begin[:n] - base)[same], (end[RUN - 1:] - base)[same]


def _rows(docs, id_column, text_column):
    return docs.select(F.col(id_column).cast("long").alias("doc"), F.col(text_column).alias("text")).where("doc IS NOT NULL")


def _shared(rows):
    """``digest, first`` of the runs that several documents have."""
    def read(parts):
        for part in parts:
            ids = part.column(0).to_numpy()
            for a, b, texts in chunks(part.column(1)):
                text, digest, _, _ = runs(texts)
                yield pa.RecordBatch.from_arrays([pa.array(digest.view("i8")), pa.array(ids[a:b][text])], names=["digest", "doc"])

    found = rows.mapInArrow(read, "digest long, doc long").groupBy("digest").agg(F.min("doc").alias("first"), F.max("doc").alias("last"))
    return materialise(found.where("first < last").select("digest", "first"), "shared")


def _filter(shared):
    """A bit per hashed digest, set where a shared digest falls: of one size whatever the corpus."""
    def bits(parts):
        found = np.zeros(FILTER_BITS // 8, "u1")
        for part in parts:
            slot = part.column(0).to_numpy().view("u8") % np.uint64(FILTER_BITS)
            np.bitwise_or.at(found, (slot >> np.uint64(3)).astype("i8"), (1 << (slot & np.uint64(7)).astype("i8")).astype("u1"))
        yield from shown({k: b for k, b in enumerate(found.reshape(64, -1)) if b.any()})

    def unite(parts):
        total = {}
        for part in parts:
            for k, data in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                total[k] = total.get(k, 0) | np.frombuffer(data, "u1")
        yield from shown(total)

    def shown(total):
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.int32()), pa.array([v.tobytes() for v in total.values()], pa.binary())],
                                         names=["k", "bits"])

    out = np.zeros((64, FILTER_BITS // 512), "u1")
    schema = "k int, bits binary"
    for r in shared.select("digest").coalesce(12).mapInArrow(bits, schema).repartition(64, "k").mapInArrow(unite, schema).toLocalIterator():
        out[r.k] |= np.frombuffer(r.bits, "u1")
    return out.ravel()


def _words(data):
    """Where the words of a text start and end, in bytes."""
    inside = np.r_[False, INSIDE[np.frombuffer(data, "u1")], False]
    edge = np.flatnonzero(inside[1:] != inside[:-1])
    return edge[::2], edge[1::2]


def _common(mine, at, other, there):
    """How many bytes before and from two places on are the same."""
    out = []
    for x, y in ((mine[:at][::-1], other[:there][::-1]), (mine[at:], other[there:])):
        n = min(len(x), len(y))
        unlike = np.flatnonzero(np.frombuffer(x[:n], "u1") != np.frombuffer(y[:n], "u1"))
        out.append(int(unlike[0]) if len(unlike) else n)
    return out


def _among(ids):
    """A condition on an id column: whether it may be one of these ids (the first column); NULL is taken as 0."""
    shared = ids.sparkSession.sparkContext.broadcast(id_bits(ids))

    @F.pandas_udf("boolean")
    def among(column: pd.Series) -> pd.Series:
        return pd.Series(in_bits(shared.value, column.to_numpy()))

    return lambda column: among(F.coalesce(F.col(column).cast("long"), F.lit(0).cast("long")))


SPAN = "doc long, start int, end int, source long, digest long, at int, sure boolean"


def _dealt(doubtful):
    """``owner, asks``: whose texts the doubtful spans are compared in, at most about ``ASKS`` spans in a row.

    A passage that a third of all documents share makes one document the source of as many spans, so
    these are dealt out by hash; each row meets the source's text in a task of its own.
    """
    ask = F.struct("doc", "start", "end", "source", "digest", "at")
    asks = doubtful.select(F.col("doc").alias("owner"), ask.alias("ask")).union(doubtful.select("source", ask.alias("ask")))
    hot = materialise(asks.groupBy(F.col("owner").alias("hot")).agg(F.ceil(F.count("*") / ASKS).alias("parts")).where("parts > 1"), "hot")
    part = F.pmod(F.xxhash64("ask.doc", "ask.start"), F.coalesce("parts", F.lit(1)))
    return asks.join(hot, F.col("owner") == F.col("hot"), "left").groupBy("owner", part.alias("part")).agg(F.collect_list("ask").alias("asks"))


def _verified(rows, doubtful):
    """The doubtful spans that share over ``WORDS`` words with their source, as far as the shared words go."""
    asks = materialise(_dealt(doubtful), "asks")
    schema = "doc long, start int, end int, source long, mine boolean, base int, at int, whole boolean, data binary"
    names = [c.split()[0] for c in schema.split(", ")]

    def shown(out):
        columns = list(zip(*out, strict=True)) or [()] * len(names)
        types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.bool_(), pa.int32(), pa.int32(), pa.bool_(), pa.binary())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)

    def windows(parts):
        out = []
        for part in parts:
            for owner, text, wanted in zip(*(part.column(k) for k in range(3)), strict=True):
                owner, text = owner.as_py(), text.as_py()
                data = (text or "").encode("utf-8", "replace")
                _, digest, start, _ = runs([text])
                digest = digest.view("i8")
                for a in wanted.as_py():
                    mine = a["doc"] == owner
                    for at in [a["at"]] if mine else start[digest == a["digest"]].tolist():
                        base = max(0, at - WINDOW)
                        out.append((a["doc"], a["start"], a["end"], a["source"], mine, base, at - base, at + WINDOW >= len(data), data[base:at + WINDOW]))
                        if len(out) >= SHOWN:
                            yield shown(out)
                            out = []
        yield shown(out)

    def compare(parts):
        for part in parts:
            out = []
            for r in part.to_pylist():
                data, base = r["data"], r["base"]
                before, after = _common(data, r["at"], r["other"], r["there"])
                low = min(r["start"] - base, r["at"] - before)
                high = max(r["end"] - base, r["at"] + after)
                begin, stop = _words(data)
                # words that the window cuts off are not whole
                inside = (begin >= low) & (stop <= high) & ((begin > 0) | (base == 0)) & ((stop < len(data)) | r["whole"])
                if inside.sum() > WORDS:
                    out.append((r["doc"], base + int(begin[inside][0]), base + int(stop[inside][-1]), r["source"], 0, 0, True))
            columns = list(zip(*out, strict=True)) or [()] * 7
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in SPAN.split(", ")])

    owners = rows.where(_among(asks.select("owner"))("doc"))
    found = materialise(owners.join(asks, F.col("doc") == F.col("owner")).select("doc", "text", "asks").mapInArrow(windows, schema), "windows")
    theirs = found.where("NOT mine").select("doc", "start", F.col("at").alias("there"), F.col("data").alias("other"))
    return found.where("mine").join(theirs, ["doc", "start"]).mapInArrow(compare, SPAN)


def repeated_spans(docs, id_column="doc_id", text_column="text", least=LEAST):
    """``doc_id, spans, repeated_bytes, sources`` of every document that repeats another one.

    ``spans`` are ranges of bytes of the UTF-8 text, ``sources`` the documents that have them first
    (of each span the one with most of its runs).
    """
    rows = _rows(docs, id_column, text_column)
    shared = _shared(rows)
    bits = docs.sparkSession.sparkContext.broadcast(_filter(shared))

    def places(parts):
        for part in parts:
            ids = part.column(0).to_numpy()
            for a, b, texts in chunks(part.column(1)):
                text, digest, start, end = runs(texts)
                slot = digest % np.uint64(FILTER_BITS)
                likely = (bits.value[(slot >> np.uint64(3)).astype("i8")] >> (slot & np.uint64(7)).astype("u1") & 1).astype(bool)
                text, digest, start, end = text[likely], digest[likely], start[likely], end[likely]
                low, high = np.zeros(len(text), "i4"), np.zeros(len(text), "i4")
                for k in np.unique(text):  # words that begin before the run and its margin, and that end after both
                    here = slice(*np.searchsorted(text, [k, k + 1]))
                    begin, stop = _words((texts[k] or "").encode("utf-8", "replace"))
                    low[here] = np.searchsorted(begin, start[here] - MARGIN)
                    high[here] = np.searchsorted(stop, end[here] + MARGIN, "right")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(digest.view("i8")), pa.array(ids[a:b][text]), pa.array(start.astype("i4")), pa.array(end.astype("i4")),
                     pa.array(low), pa.array(high)], names=["digest", "doc", "start", "end", "low", "high"])

    def merge(parts):
        for part in parts:
            out = []
            for doc, found in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                start, end, first, digest, low, high = (found.values.field(i).to_numpy() for i in range(6))
                order = np.argsort(start, kind="stable")
                start, end, first, digest, low, high = (x[order] for x in (start, end, first, digest, low, high))
                reach = np.maximum.accumulate(end)
                new = np.r_[True, start[1:] > reach[:-1]]
                begin = np.flatnonzero(new)
                last = np.r_[begin[1:], len(start)]
                for x, y in zip(begin, last, strict=True):
                    sure = reach[y - 1] - start[x] >= least
                    if sure or high[y - 1] - low[x] > WORDS:
                        names, times = np.unique(first[x:y], return_counts=True)
                        source = names[times.argmax()]
                        at = x + int((first[x:y] == source).argmax())
                        out.append((doc, int(start[x]), int(reach[y - 1]), int(source), int(digest[at]), int(start[at]), bool(sure)))
            columns = list(zip(*out, strict=True)) or [()] * 7
            types = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=[c.split()[0] for c in SPAN.split(", ")])

    def gather(parts):
        for part in parts:
            out = []
            for doc, found in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                spans = []
                for f in sorted(found, key=lambda f: (f["start"], f["end"])):
                    if spans and f["start"] <= spans[-1]["end"]:
                        spans[-1]["end"] = max(spans[-1]["end"], f["end"])
                    else:
                        spans.append({"start": f["start"], "end": f["end"]})
                out.append((doc, spans, sum(s["end"] - s["start"] for s in spans), sorted({f["source"] for f in found})))
            columns = list(zip(*out, strict=True)) or [()] * 4
            types = (pa.int64(), pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])), pa.int64(), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)],
                                             names=["doc_id", "spans", "repeated_bytes", "sources"])

    found = rows.mapInArrow(places, "digest long, doc long, start int, end int, low int, high int").join(shared, "digest").where("doc <> first")
    lists = found.groupBy("doc").agg(F.collect_list(F.struct("start", "end", "first", "digest", "low", "high")).alias("found"))
    spans = materialise(lists.mapInArrow(merge, SPAN), "spans")
    doubtful = spans.where("NOT sure")
    sure = spans.where("sure")
    if not doubtful.isEmpty():
        sure = sure.union(_verified(rows, doubtful))
    by_doc = sure.groupBy("doc").agg(F.collect_set(F.struct("start", "end", "source")).alias("found"))
    return by_doc.mapInArrow(gather, "doc_id long, spans array<struct<start:int,end:int>>, repeated_bytes long, sources array<long>")


def remove_repeats(docs, id_column="doc_id", text_column="text", least=LEAST):
    """The documents without their repeated spans (the first document keeps them), all columns and rows."""
    new = "_" * (1 + max(map(len, docs.columns)))  # longer than any column, so no name clashes
    spans = materialise(repeated_spans(docs, id_column, text_column, least)
                        .select(F.col("doc_id").alias(new + "doc"), F.col("spans").alias(new + "spans")), "spans")
    concerned = _among(spans.select(new + "doc"))(id_column)
    joined = docs.where(concerned).join(spans, F.col(id_column).cast("long") == F.col(new + "doc"), "left").drop(new + "doc")
    place, last = joined.columns.index(text_column), len(joined.columns) - 1

    def cut(parts):
        for part in parts:
            for start, stop, texts in chunks(part.column(place)):
                rows = part.slice(start, stop - start)
                for i, found in enumerate(rows.column(last).to_pylist()):
                    if found:
                        data, at, kept = texts[i].encode("utf-8"), 0, []
                        for s in found:
                            kept.append(data[at:s["start"]])
                            at = s["end"]
                        texts[i] = b"".join([*kept, data[at:]]).decode("utf-8", "ignore")
                columns = [pa.array(texts, rows.column(k).type) if k == place else rows.column(k) for k in range(last)]
                yield pa.RecordBatch.from_arrays(columns, schema=pa.schema([rows.schema.field(k) for k in range(last)]))

    return docs.where(~concerned).union(joined.mapInArrow(cut, docs.schema))


@query("op10_substring_dedup")
def op10_substring_dedup(spark, sf):
    return repeated_spans(table(spark, sf, "documents"))
