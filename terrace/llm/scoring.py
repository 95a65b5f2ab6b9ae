"""LM scoring (operator 1): Stupid Backoff over n-gram counts of the whole corpus.

A word's score is its share after the longest context that was seen with it, times ``ALPHA`` for
every word of context given up; a document's is the mean of the logarithms. The counts for a
document leave out its own n-grams, so no text vouches for itself.

The count tables are relations partitioned by the hash of the n-gram, one for each order.
Documents are laid out in blocks of bounded text. A block's exploded n-grams (distinct, with their
number) go to the partitions as sorted arrays, one per block and hash range; a partition adds up the
counts of all blocks and answers each block's array with the totals; a block joins the answers with
its n-grams again and sums by document. So an n-gram that every document has is one entry per
block, no partition grows with a frequent n-gram, and what is shuffled follows the distinct n-grams
of the blocks. N-grams are 56-bit hashes, stored by byte planes because sorted hashes compress so.
Orders are counted one after the other: only one's shuffle is on disk at a time.

Defined cases: words are those of the n-gram join. NULL and empty texts have no words and a NULL
score. A word that no other document has counts as one word after three times ``ALPHA``. Rows
with a NULL id are scored; repeated rows are documents of their own, so each vouches for the other.
"""

import gc

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import functions as F

from terrace.llm.jaccard import ODD, mix, word_hashes
from terrace.llm.registry import query, table
from terrace.workspace import materialise

ORDER, ALPHA = 3, 0.4
#: Bytes of text in a block, and n-grams of all blocks that a hash range is meant to hold.
BLOCK_BYTES, RANGE_NGRAMS = 4 << 20, 1 << 20
BITS = 56


def packed(numbers, width):
    """Unsigned integers as byte planes."""
    return np.ascontiguousarray(numbers.astype("<u8").view("u1").reshape(-1, 8)[:, :width].T).tobytes()


def unpacked(data, width):
    out = np.zeros((len(data) // width, 8), "u1")
    out[:, :width] = np.frombuffer(data, "u1").reshape(width, -1).T
    return out.view("<u8").ravel()


def places(counts):
    """The place of each word in its text."""
    return np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)


def ngrams(words, place, n):
    """56-bit hashes of the n-grams of one order that end at the words far enough into their text."""
    factors = mix(np.arange(1, n + 1, dtype="u8") * ODD) | np.uint64(1)
    with np.errstate(over="ignore"):
        total = np.full(len(words), n, "u8")
        for k in range(n):
            total[k:] += words[:len(words) - k] * factors[k]
        return mix(total[place >= n - 1]) >> np.uint64(64 - BITS)


def folded(texts):
    """Texts as one compressed value, which is what every later step reads and shuffles."""
    data = [None if t is None else t.encode("utf-8", "replace") for t in texts]
    sizes = np.array([-1 if d is None else len(d) for d in data], "<i4").tobytes()
    return len(data).to_bytes(4, "little") + zstandard.ZstdCompressor(level=3).compress(sizes + b"".join(d or b"" for d in data))


def unfolded(data):
    count = 4 * int.from_bytes(data[:4], "little")
    data = zstandard.ZstdDecompressor().decompress(data[4:])
    out, at = [], count
    for n in np.frombuffer(data[:count], "<i4"):
        out.append(None if n < 0 else data[at:at + n].decode())
        at += max(0, int(n))
    return out


def _blocks(docs, id_column, text_column):
    """One row per block: ``block, ids, size, texts`` (texts as ``folded`` makes them)."""
    def lay_out(parts):
        first = TaskContext.get().partitionId() << 32
        ids, texts, size, number = [], [], 0, 0

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([first + number]), pa.array([ids], pa.list_(pa.int64())), pa.array([size], pa.int64()),
                 pa.array([folded(texts)], pa.binary())], names=["block", "ids", "size", "texts"])

        for part in parts:
            for name, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                ids.append(name)
                texts.append(text)
                size += len(text or "")
                if size >= BLOCK_BYTES:
                    yield row()
                    ids, texts, size, number = [], [], 0, number + 1
        if ids:
            yield row()

    return materialise(docs.select(F.col(id_column).cast("long"), F.col(text_column))
                       .mapInArrow(lay_out, "block long, ids array<long>, size long, texts binary"), "blocks")


def _exploded(blocks, n, ranges):
    """``range, block, grams, counts`` of the distinct n-grams of one order in every block."""
    shift = np.uint64(BITS - (ranges.bit_length() - 1))

    def explode(parts):
        for part in parts:
            for block, texts in zip(part.column(0).to_pylist(), part.column(1), strict=True):
                words, counts = word_hashes(unfolded(texts.as_py()))
                found, count = np.unique(ngrams(words, places(counts), n), return_counts=True)
                slot = (found >> shift).astype("i8")
                starts = np.flatnonzero(np.r_[True, slot[1:] != slot[:-1]]) if len(slot) else np.zeros(0, "i8")
                ends = np.r_[starts[1:], len(slot)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(slot[starts].astype("i4")), pa.array(np.full(len(starts), block, "i8")),
                     pa.array([packed(found[a:b], BITS // 8) for a, b in zip(starts, ends)], pa.binary()),
                     pa.array([packed(count[a:b], 4) for a, b in zip(starts, ends)], pa.binary())],
                    names=["range", "block", "grams", "counts"])

    return blocks.select("block", "texts").mapInArrow(explode, "range int, block long, grams binary, counts binary")


def _totals(frame):
    """All blocks' n-grams of one hash range: the corpus's counts, in the order of each block's array."""
    grams = [unpacked(g, BITS // 8) for g in frame.grams]
    every, back = np.unique(np.concatenate(grams), return_inverse=True)
    totals = np.bincount(back, weights=np.concatenate([unpacked(c, 4) for c in frame.counts]), minlength=len(every)).astype("u8")
    mine = np.split(totals[back], np.cumsum([len(g) for g in grams])[:-1])
    return pd.DataFrame({"block": frame.block, "range": frame["range"], "totals": [packed(t, 5) for t in mine]})


def _elsewhere(grams, doc, totals):
    """How often each n-gram of a block occurs in other documents: the corpus's totals less the document's own."""
    order = np.argsort(grams)
    ranked = grams[order]
    number = np.cumsum(np.r_[False, ranked[1:] != ranked[:-1]])  # of the distinct n-gram
    at = np.empty(len(grams), "i8")
    at[order] = number
    pair = at * np.int64(doc[-1] + 1) + doc
    own = np.ones(len(grams), "i8")
    every = np.sort(pair)
    starts = np.flatnonzero(np.r_[True, every[1:] != every[:-1]])
    times = np.diff(np.r_[starts, len(every)])
    more = times > 1
    if more.any():  # few n-grams come more than once in a text
        again, times = every[starts[more]], times[more]
        k = np.minimum(np.searchsorted(again, pair), len(again) - 1)
        own = np.where(again[k] == pair, times[k], 1)
    return totals[at] - own


def _scored(texts, totals, words_in_all):
    """Sum of log scores and words of each text, from the totals of the block's distinct n-grams by order."""
    words, counts = word_hashes(texts)
    if not len(words):
        return np.zeros(len(texts)), counts
    place, doc = places(counts), np.repeat(np.arange(len(texts)), counts)
    others = []  # by order: how often the n-gram ending at a word occurs in other documents
    for n in range(1, ORDER + 1):
        there = place >= n - 1
        found = np.zeros(len(words))
        if there.any():
            found[there] = _elsewhere(ngrams(words, place, n), doc[there], totals[n - 1])
        others.append(found)
    rest = np.maximum(words_in_all - counts[doc], 1).astype("f8")
    longest = np.minimum(place + 1, ORDER)
    score = ALPHA ** longest / rest
    done = np.zeros(len(doc), bool)
    for n in range(ORDER, 0, -1):
        # The context of the n-gram ending here is the shorter one that ends a word earlier.
        context = rest if n == 1 else np.r_[0.0, others[n - 2][:-1]]
        ok = ~done & (others[n - 1] > 0)
        score[ok] = ALPHA ** (longest[ok] - n) * others[n - 1][ok] / context[ok]
        done |= ok
    return np.bincount(doc, weights=np.log(score), minlength=len(texts)), counts


def score_documents(docs, id_column="doc_id", text_column="text"):
    """``doc_id, n_words, log_score`` (mean of the words' log scores, 9 decimals) of every row."""
    spark = docs.sparkSession
    blocks = _blocks(docs, id_column, text_column)
    size = blocks.agg(F.sum("size")).first()[0] or 0
    ranges = 1 << max(0, (size // 6 // RANGE_NGRAMS)).bit_length()
    answers = None
    for n in range(1, ORDER + 1):
        found = materialise(_exploded(blocks, n, ranges).groupBy("range").applyInPandas(
            _totals, "block long, range int, totals binary"), "totals").withColumn("order", F.lit(n))
        answers = found if answers is None else answers.union(found)
        # The totals are stored; collecting garbage lets Spark's cleaner drop the shuffle behind them.
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    words_in_all = _words(blocks)

    def score(block, answer):
        """One block and the answers to it, so a task holds one block at a time."""
        answer = answer.sort_by([("order", "ascending"), ("range", "ascending")])
        order, data = answer["order"].to_pylist(), answer["totals"]
        totals = [np.concatenate([unpacked(data[i].as_py(), 5) for i, of in enumerate(order) if of == n] or [np.zeros(0, "u8")]).astype("i8")
                  for n in range(1, ORDER + 1)]
        sums, counts = _scored(unfolded(block["texts"][0].as_py()), totals, words_in_all)
        mean = np.round(sums / np.maximum(counts, 1), 9)
        return pa.Table.from_arrays([block["ids"][0].values, pa.array(counts.astype("i8")), pa.array(mean, mask=counts == 0)],
                                    names=["doc_id", "n_words", "log_score"])

    return blocks.select("block", "ids", "texts").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        score, "doc_id long, n_words long, log_score double")


def _words(blocks):
    def count(parts):
        for part in parts:
            yield pa.RecordBatch.from_arrays([pa.array([int(word_hashes(unfolded(t.as_py()))[1].sum()) for t in part.column(0)], pa.int64())], names=["n"])

    return blocks.select("texts").mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0


SQL = """
    WITH split AS (
        SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(
            translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS ws
        FROM documents),
    places AS (SELECT r, ws, unnest(range(1, len(ws) + 1)) AS i FROM split),
    words AS (SELECT r, i, ws[i] AS w, CASE WHEN i > 1 THEN ws[i - 1] END AS v, CASE WHEN i > 2 THEN ws[i - 2] END AS u FROM places),
    total AS (SELECT count(*) AS n FROM words),
    one AS (SELECT w, count(*) AS c FROM words GROUP BY ALL),
    two AS (SELECT v, w, count(*) AS c FROM words WHERE i > 1 GROUP BY ALL),
    three AS (SELECT u, v, w, count(*) AS c FROM words WHERE i > 2 GROUP BY ALL),
    mine AS (SELECT r, count(*) AS n FROM words GROUP BY ALL),
    one_in AS (SELECT r, w, count(*) AS c FROM words GROUP BY ALL),
    two_in AS (SELECT r, v, w, count(*) AS c FROM words WHERE i > 1 GROUP BY ALL),
    three_in AS (SELECT r, u, v, w, count(*) AS c FROM words WHERE i > 2 GROUP BY ALL),
    counted AS (
        SELECT x.r, x.i, greatest(total.n - mine.n, 1) AS n,
               a.c - ai.c AS w1, b.c - bi.c AS w2, d.c - di.c AS w3, e.c - ei.c AS context1, f.c - fi.c AS context2
        FROM words x, total
        JOIN mine ON mine.r = x.r
        JOIN one a ON a.w = x.w JOIN one_in ai ON ai.r = x.r AND ai.w = x.w
        LEFT JOIN two b ON b.v = x.v AND b.w = x.w LEFT JOIN two_in bi ON bi.r = x.r AND bi.v = x.v AND bi.w = x.w
        LEFT JOIN three d ON d.u = x.u AND d.v = x.v AND d.w = x.w
        LEFT JOIN three_in di ON di.r = x.r AND di.u = x.u AND di.v = x.v AND di.w = x.w
        LEFT JOIN one e ON e.w = x.v LEFT JOIN one_in ei ON ei.r = x.r AND ei.w = x.v
        LEFT JOIN two f ON f.v = x.u AND f.w = x.v LEFT JOIN two_in fi ON fi.r = x.r AND fi.v = x.u AND fi.w = x.v),
    scored AS (
        SELECT r, ln(CASE WHEN w3 > 0 THEN w3 / context2
                          WHEN w2 > 0 THEN 0.4 ** (least(i, 3) - 2) * w2 / context1
                          WHEN w1 > 0 THEN 0.4 ** (least(i, 3) - 1) * w1 / n
                          ELSE 0.4 ** least(i, 3) / n END) AS s
        FROM counted)
    SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, round(m, 6) AS log_score
    FROM split LEFT JOIN (SELECT r, avg(s) AS m FROM scored GROUP BY r) USING (r)"""


@query("op1_lm_scoring", SQL)
def op1_lm_scoring(spark, sf):
    return score_documents(table(spark, sf, "documents")).withColumn("log_score", F.round("log_score", 6))
