"""Toxicity (operator 2): a bidirectional gated recurrent network with attention pooling, scoring windows.

A step of the network is a word. Its input is a learnt word vector (words share ``WORDS`` hashed
rows) plus the mean of learnt character vectors (hashed byte triples, with the word's edges), so
unseen spellings still say something. Attention over the states of a window pools it into one
logit; the windows of a text overlap by half, all of them are scored, and the text has the score of
its worst window. Trained in numpy by backpropagation through time on a bounded sample
(``PER_CLASS`` documents of each label, at most ``PER_TEXT`` windows of each), in which a document
learns through its worst window.

Defined cases: NULL and empty texts, or texts without a word, have one window without words: its
logit is the network's bias. NULL ids are scored like others (``held_out`` false). Repeated rows are
scored one by one; a document with several labels is learnt once with each. Without labelled rows
of both classes every score is 0.
"""

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from terrace.llm.jaccard import chunks
from terrace.llm.language import sample
from terrace.llm.memory import release_others
from terrace.llm.recurrent import Adam, back, batches, new_direction, run, sum_by, windows
from terrace.llm.registry import query, remainder, table

THRESHOLD = 0.3
PER_CLASS, PER_TEXT = 1200, 16
WORDS, TRIPLES = 1 << 13, 1 << 13
UNITS, EPOCHS, BATCH, RATE, DECAY = 8, 6, 64, 0.02, 0.002
CLEAN_WINDOWS = 2
#: A word vector is learnt only if so many training texts have the word; others have their characters.
LEAST_TEXTS = 4
WINDOW, STRIDE, ROWS = 32, 16, 2048
#: Longer runs of non-blanks are read in parts of this length.
LONGEST_WORD = 40
#: Words whose characters are looked up at a time.
TOGETHER = 4096
#: Bytes of text that are scored together (a longer text alone): the words they share are looked up once.
PART = 2_000_000

WORD = re.compile(r"\S{1,%d}" % LONGEST_WORD)
SHELL = "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum()) + "«»¿¡…“”’‘"


def words_of(text):
    return WORD.findall((text or "").lower())


class Features:
    """Numbers the words of some texts and gives the hashed rows of each word and its byte triples."""

    def __init__(self):
        self.number, self.words = {}, []

    def add(self, text):
        number, out = self.number, []
        for word in words_of(text):
            k = number.get(word)
            if k is None:
                k = number[word] = len(self.words)
                self.words.append(word.strip(SHELL) or word)
            out.append(k)
        return np.array(out, "i4")

    def rows(self):
        """(hashed word row, hashed triples of all words in one array, where each word's begin)."""
        parts = [self._hashed(self.words[i:i + TOGETHER]) for i in range(0, len(self.words), TOGETHER)]
        none = np.zeros(0, "i8")
        shift = np.cumsum([0, *(len(p[1]) for p in parts)])
        return (np.concatenate([none, *(p[0] for p in parts)]), np.concatenate([none.astype("i4"), *(p[1] for p in parts)]),
                np.concatenate([none, *(p[2] + at for p, at in zip(parts, shift))]))

    @staticmethod
    def _hashed(words):
        data = [f"^{w}$".encode("utf-8", "replace") for w in words]
        lengths = np.array([len(d) for d in data], "i8")
        flat = np.frombuffer(b"".join(data), "u1").astype("u4")
        begin = np.r_[0, np.cumsum(lengths)[:-1]].astype("i8")
        nearby = (flat * 257 + np.roll(flat, -1)) * 257 + np.roll(flat, -2)
        nearby[begin + lengths - 2] = nearby[begin + lengths - 1] = 0
        triples = nearby * np.uint32(2654435761) >> np.uint32(19)
        place = np.arange(len(flat)) - np.repeat(begin, lengths)
        with np.errstate(over="ignore"):
            power = np.cumprod(np.full(LONGEST_WORD * 4 + 2, 0x9E3779B97F4A7C15, "u8"))
            mixed = np.add.reduceat((flat.astype("u8") + 1) * power[place], begin)
            mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
        return (mixed >> np.uint64(64 - 13)).astype("i8"), (triples % TRIPLES).astype("i4"), begin


def inputs(params, side, rows):
    """Input projections of every numbered word: (words + 1, 3 * units); the last row is 'no word'."""
    word, triples, begin = rows
    width = params["word_" + side].shape[1]
    if not len(word):
        return np.zeros((1, width), "f4")
    ends = np.r_[begin, len(triples)]
    known = np.r_[params["word_" + side], np.zeros((1, width), "f4")]
    out = np.zeros((len(word) + 1, width), "f4")
    for i in range(0, len(word), TOGETHER):
        some = ends[i:i + TOGETHER + 1]
        x = np.add.reduceat(params["triple_" + side][triples[some[0]:some[-1]]], some[:-1] - some[0], axis=0) / np.diff(some)[:, None]
        out[i:i + len(x)] = x + known[word[i:i + len(x)]]
    return out


def pool(params, ahead, behind, inside):
    """Attention over the states: logits of the windows, attention weights, pooled states."""
    states = np.concatenate([ahead, behind], axis=1)
    scores = np.matmul(params["v"], states)
    scores = np.where(inside, scores, -1e9)
    scores -= scores.max(axis=0)
    attention = np.exp(scores) * inside
    attention /= np.maximum(attention.sum(axis=0), 1e-9)
    pooled = (attention[:, None].astype("f4") * states).sum(axis=0)
    return params["w"] @ pooled + params["b"][0], attention, pooled, states


def gradients(params, rows, steps, inside, labels, weights):
    """Weighted mean of the log loss of windows, and its gradients."""
    units = params["u_f"].shape[1]
    mask = inside.astype("f4")
    ahead, kept_f = run(inputs(params, "f", rows), params["u_f"], steps, mask, keep=True)
    behind, kept_b = run(inputs(params, "b", rows), params["u_b"], steps[::-1], mask[::-1], keep=True)
    logits, attention, pooled, states = pool(params, ahead, behind[::-1], inside)
    p = 1 / (1 + np.exp(-logits))
    share = (weights / weights.sum()).astype("f4")
    loss = -(share * np.where(labels, np.log(p + 1e-9), np.log(1 - p + 1e-9))).sum()
    d = (share * (p - labels)).astype("f4")
    grads = {"w": pooled @ d, "b": np.array([d.sum()], "f4")}
    along = np.matmul(params["w"], states)
    d_scores = attention * (along - (attention * along).sum(axis=0)) * d
    grads["v"] = np.einsum("tb,tub->u", d_scores, states)
    d_states = (attention[:, None] * params["w"][:, None] * d + d_scores[:, None] * params["v"][:, None]).astype("f4")
    word, triples, begin = rows
    counts = np.diff(np.r_[begin, len(triples)])
    for side, kept, part, order in (("f", kept_f, d_states[:, :units], 1), ("b", kept_b, d_states[:, units:], -1)):
        grads["u_" + side], d_in = back(params["u_" + side], kept, part[::order], mask[::order])
        by_word = sum_by(steps[::order].ravel(), d_in.transpose(0, 2, 1).reshape(-1, 3 * units), len(word) + 1)[:-1]
        grads["word_" + side] = sum_by(word, by_word, WORDS + 1)[:-1]
        grads["triple_" + side] = sum_by(triples, np.repeat(by_word / counts[:, None], counts, axis=0), TRIPLES)
    return loss, grads


def train(rows, seed=2):
    """A model from ``[(text, 0 or 1)]``; ``None`` without rows of both classes."""
    rows = [(text or "", int(label)) for text, label in rows if label in (0, 1)]
    if len({label for _, label in rows}) < 2:
        return None
    rng = np.random.default_rng(seed)
    features = Features()
    texts, labels = [], []
    for text, label in rows:
        numbers = features.add(text)
        texts.append(numbers)
        labels.append(label)
    found = windows(np.array([len(t) for t in texts]), WINDOW, STRIDE)
    keep = rng.random(found.shape[1]) < PER_TEXT / np.maximum(1, np.bincount(found[0], minlength=len(texts)))[found[0]]
    positive = np.array(labels)[found[0]] == 1
    found = found[:, keep | positive]
    every = features.rows()
    rows_word, rows_triples, begin = every
    ends = np.r_[begin[1:], len(rows_triples)]
    flat = np.concatenate([*texts, [0]]).astype("i8")
    base = np.r_[0, np.cumsum([len(t) for t in texts])]
    labels = np.array(labels)
    params = {"word_f": np.zeros((WORDS, 3 * UNITS)), "word_b": np.zeros((WORDS, 3 * UNITS)),
              "triple_f": rng.normal(size=(TRIPLES, 3 * UNITS)) * 0.05, "triple_b": rng.normal(size=(TRIPLES, 3 * UNITS)) * 0.05,
              "u_f": new_direction(rng, UNITS), "u_b": new_direction(rng, UNITS),
              "v": rng.normal(size=2 * UNITS) * 0.3, "w": rng.normal(size=2 * UNITS) * 0.3, "b": np.full(1, -1.0)}
    params = {k: v.astype("f4") for k, v in params.items()}
    adam = Adam(params, RATE)
    at = np.arange(WINDOW)[:, None]
    # A document learns through its worst window so far; the others of a toxic one are not held against it.
    by_doc = _grouped(found[0], len(texts))
    docs = np.array([i for i, w in enumerate(by_doc) if len(w)])
    frequent, odds = _word_odds(texts, labels, len(features.words))
    rows_word = np.where(frequent, rows_word, WORDS)
    rounds = max(EPOCHS, -(-EPOCHS * 12 * BATCH // max(1, len(docs))))
    for epoch in range(rounds):
        adam.rate = RATE * (1 - epoch / rounds) + 0.001
        order = rng.permutation(docs)
        worst = _window_logits(params, every, flat, base, found) if epoch else _window_odds(odds, texts, found)
        chosen = np.array([by_doc[i][worst[by_doc[i]].argmax()] for i in order])
        # Clean documents also learn from windows drawn at random.
        clean = np.repeat(order[labels[order] == 0], CLEAN_WINDOWS)
        chosen = np.r_[chosen, [by_doc[i][rng.integers(len(by_doc[i]))] for i in clean]].astype("i8")
        chosen = chosen[rng.permutation(len(chosen))]
        for i in range(0, len(chosen), BATCH):
            part = found[:, chosen[i:i + BATCH]]
            inside = at < part[2]
            steps = flat[np.minimum(base[part[0]] + part[1] + at, len(flat) - 1)]
            used, steps = np.unique(np.where(inside, steps, -1), return_inverse=True)
            steps = steps.reshape(inside.shape)
            if used[0] == -1:
                used, steps = used[1:], np.where(inside, steps - 1, len(used) - 1)
            sizes = ends[used] - begin[used]
            places = np.repeat(begin[used] - np.r_[0, np.cumsum(sizes)[:-1]], sizes) + np.arange(sizes.sum())
            small = (rows_word[used], rows_triples[places], np.r_[0, np.cumsum(sizes)[:-1]].astype("i8"))
            y = labels[part[0]]
            grads = gradients(params, small, steps, inside, y, np.ones(len(y)))[1]
            adam.step(grads)
            for k in ("word_f", "word_b", "triple_f", "triple_b"):
                params[k] *= 1 - DECAY
    return params


def _word_odds(texts, labels, words):
    """Whether a word is in enough texts to be learnt, and the log odds that a text with it is toxic."""
    seen = np.zeros((2, words))
    for numbers, label in zip(texts, labels, strict=True):
        seen[label, np.unique(numbers)] += 1
    share = (np.bincount(labels, minlength=2) + 1)[:, None]
    odds = np.log((seen[1] + 0.5) / share[1]) - np.log((seen[0] + 0.5) / share[0])
    return seen.sum(axis=0) >= LEAST_TEXTS, odds


def _window_odds(odds, texts, found):
    return np.array([odds[texts[i][a:a + n]].max() for i, a, n, _ in found.T])


def _grouped(index, size):
    order = np.argsort(index, kind="stable")
    return np.split(order, np.searchsorted(index[order], np.arange(1, size)))


def _window_logits(params, rows, flat, base, found):
    table_f, table_b = inputs(params, "f", rows), inputs(params, "b", rows)
    nothing = len(table_f) - 1
    logits = np.empty(found.shape[1], "f4")
    for chosen, at, inside in batches(found, WINDOW, ROWS):
        doc, start = found[0, chosen], found[1, chosen]
        steps = np.where(inside, flat[np.minimum(base[doc] + start + at, len(flat) - 1)], nothing)
        mask = None if inside.all() else inside.astype("f4")
        ahead = run(table_f, params["u_f"], steps, mask)
        behind = run(table_b, params["u_b"], steps[::-1], None if mask is None else mask[::-1])[::-1]
        logits[chosen] = pool(params, ahead, behind, inside)[0]
    return logits


def scores(model, texts):
    """Score of each text: that of its worst window."""
    if model is None:
        return np.zeros(len(texts))
    out = np.full(len(texts), model["b"][0], "f8")
    features = Features()
    numbers = [features.add(t) for t in texts]
    lengths = np.array([len(n) for n in numbers], "i8")
    found = windows(lengths, WINDOW, STRIDE)
    if found.shape[1]:
        flat = np.concatenate([*numbers, [0]]).astype("i8")
        logits = _window_logits(model, features.rows(), flat, np.r_[0, np.cumsum(lengths)], found)
        out[lengths > 0] = -np.inf
        np.maximum.at(out, found[0], logits)
    return 1 / (1 + np.exp(-np.clip(out, -50, 50)))


def window_scores(model, text):
    """(first word, words, score) of all windows of one text."""
    features = Features()
    numbers = features.add(text)
    found = windows([len(numbers)], WINDOW, STRIDE)
    if model is None or not found.shape[1]:
        return []
    logits = _window_logits(model, features.rows(), np.r_[numbers, 0].astype("i8"), np.array([0, len(numbers)]), found)
    return [(int(a), int(n), float(1 / (1 + np.exp(-x)))) for a, n, x in zip(found[1], found[2], logits, strict=True)]


def learn(docs, labels, id_column="doc_id", text_column="text", label_column="toxic"):
    """Train on labelled documents outside the held-out fold (crc32 of the id modulo 4 is 2)."""
    marked = labels.select(F.col(id_column).alias("id"), F.col(label_column).alias("label")).where("label IN (0, 1)").distinct()
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    marked = rows.select("id").where(remainder("id", 4) != 2).distinct().join(marked, "id")
    return train(sample(rows, marked, PER_CLASS))


def _scored(model, part, place):
    """``scores`` over a text column, in slices of bounded length: (slice, scores)."""
    release_others("toxicity")
    for start, stop, texts in chunks(part.column(place), PART):
        yield part.slice(start, stop - start), scores(model, texts)


def score_documents(docs, model, id_column="doc_id", text_column="text"):
    """``doc_id, score`` of every row."""
    def score(parts):
        for part in parts:
            for rows, found in _scored(model, part, 1):
                yield pa.RecordBatch.from_arrays([rows.column(0), pa.array(found, pa.float64())], names=["doc_id", "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(score, f"doc_id {kind}, score double")


def keep_clean(docs, model, text_column="text", threshold=THRESHOLD):
    """The documents that score below the threshold, all columns as they are."""
    place = docs.columns.index(text_column)

    def kept(parts):
        for part in parts:
            for rows, found in _scored(model, part, place):
                yield rows.filter(pa.array(found < threshold, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


@query("op2_toxicity")
def op2_toxicity(spark, sf):
    docs = table(spark, sf, "documents")
    found = score_documents(docs, learn(docs, table(spark, sf, "labels")))
    return found.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"),
                        "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
