"""Language ID (operator 4): a bidirectional gated recurrent network over UTF-8 bytes.

Trained in numpy by backpropagation through time on a bounded sample (``PER_CLASS`` documents of
each language, ``SEGMENTS`` segments of each, drawn from anywhere in their texts). Scoring reads
every byte of every text: the network labels each position, and a document's probabilities are the
mean over its positions.

Defined cases: NULL text, empty text and text without a letter give ``und`` with score 0. NULL ids
are scored like others (``held_out`` false). Repeated rows are scored one by one. With no labelled
row (an empty table, say) every text is ``und``.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from terrace.llm.jaccard import chunks
from terrace.llm.memory import release_others
from terrace.llm.recurrent import Adam, back, batches, new_direction, run, sum_by, windows
from terrace.llm.registry import query, remainder, table
from terrace.workspace import materialise

UNKNOWN = "und"
#: Documents of each language the network learns from at most, languages, and characters of a document.
PER_CLASS, CLASSES, LEARNT = 180, 1000, 50_000
SEGMENTS, SEGMENT = 4, 96
UNITS, EPOCHS, BATCH, RATE = 8, 6, 128, 0.03
WINDOW, ROWS = 256, 2048
#: The pipeline's stage keeps documents that score this many times what a guess would.
MARGIN = 1.2
#: Bytes of text that are scored together (a longer text alone).
PART = 500_000


def has_letter(text):
    return text is not None and any(map(str.isalpha, text))


def sample(docs, marked, per_class=PER_CLASS):
    """Labelled documents for training, as many of each class: ``[(text, label)]`` on the driver.

    ``marked`` has ``id, label`` of the rows that may be learnt from, ``docs`` has ``id, text`` (and may have
    ``label``, which then has to be the same). Of every class the ``per_class`` rows with the smallest hash of
    the id are taken, all if there are fewer, so no class is lost at any size and the order of rows does not
    matter. Ids and labels alone decide, and of a large class only ids with small hashes are ranked; the texts
    of the chosen are looked up afterwards. At most ``CLASSES`` classes, the most frequent, are learnt. A text of more
    than ``LEARNT`` characters gives that many from a place that its hash names (for training alone).
    """
    turn = F.pmod(F.xxhash64("id"), F.lit(1 << 62)).alias("_turn")
    marked = marked.where("id IS NOT NULL AND label IS NOT NULL").select("id", "label", turn)
    classes = (marked.groupBy("label").agg(F.count("*").alias("_n"), F.approx_count_distinct("id").alias("_ids"))
               .orderBy(F.desc("_n"), "label").limit(CLASSES))
    classes = F.broadcast(materialise(classes, "classes"))  # CLASSES rows at most
    # Four times as many ids as wanted lie below this cut (all, in a small class), so few rows are ranked.
    below = F.col("_turn") / F.lit(float(1 << 62)) < F.lit(4.0 * per_class) / F.col("_ids")
    rank = F.row_number().over(Window.partitionBy("label").orderBy("_turn"))
    chosen = (marked.join(classes, "label").where(below).select("id", "label", "_turn").distinct()
              .withColumn("_rank", rank).where(F.col("_rank") <= per_class).drop("_rank"))
    chosen = F.broadcast(materialise(chosen, "sample"))  # CLASSES * per_class rows at most
    taken = docs.join(chosen, ["id", "label"] if "label" in docs.columns else "id")
    full = F.row_number().over(Window.partitionBy("label").orderBy("_turn", "id", "text"))  # repeated ids share a turn
    start = (F.pmod(F.col("_turn"), F.greatest(F.length("text") - LEARNT + 1, F.lit(1))) + 1).cast("int")
    found = (taken.withColumn("text", F.substring("text", start, F.lit(LEARNT))).withColumn("_rank", full)
             .where(F.col("_rank") <= per_class).select("id", "text", "label").collect())
    return [(r.text, r.label) for r in sorted(found, key=lambda r: (r.id, r.text or "", str(r.label)))]


def forward(params, steps, mask):
    """Logits (time, classes, batch) and what ``gradients`` needs."""
    ahead, kept_f = run(params["in_f"], params["u_f"], steps, mask, keep=True)
    behind, kept_b = run(params["in_b"], params["u_b"], steps[::-1], mask[::-1], keep=True)
    states = np.concatenate([ahead, behind[::-1]], axis=1)
    return params["w"] @ states + params["b"][:, None], (states, kept_f, kept_b)


def gradients(params, steps, mask, labels):
    """Mean cross-entropy over all positions, and its gradients."""
    logits, (states, kept_f, kept_b) = forward(params, steps, mask)
    logits = logits - logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    weight = (mask / mask.sum()).astype("f4")
    at = np.arange(len(labels))
    loss = -(np.log(p[:, labels, at] + 1e-9) * weight).sum()
    p[:, labels, at] -= 1
    d = (p * weight[:, None]).astype("f4")
    d_states = params["w"].T @ d
    units = params["u_f"].shape[1]
    grads = {"w": np.einsum("tkb,tub->ku", d, states), "b": d.sum(axis=(0, 2))}
    for side, kept, part, order in (("f", kept_f, d_states[:, :units], 1), ("b", kept_b, d_states[:, units:], -1)):
        grads["u_" + side], d_in = back(params["u_" + side], kept, part[::order], mask[::order])
        rows = d_in.transpose(0, 2, 1).reshape(-1, 3 * units)
        grads["in_" + side] = sum_by(steps[::order].ravel(), rows, len(params["in_" + side]))
    return loss, grads


def train(rows, seed=4):
    """A model from ``[(text, label)]``; ``None`` without a usable row."""
    rng = np.random.default_rng(seed)
    rows = [(text.encode("utf-8", "replace"), label) for text, label in rows if has_letter(text)]
    if not rows:
        return None
    classes = sorted({label for _, label in rows})
    number = {label: k for k, label in enumerate(classes)}
    steps, mask, labels = [], [], []
    for data, label in rows:
        for _ in range(min(SEGMENTS, -(-len(data) // SEGMENT))):
            start = int(rng.integers(0, max(1, len(data) - SEGMENT + 1)))
            part = np.frombuffer(data[start:start + SEGMENT], "u1")
            steps.append(np.pad(part, (0, SEGMENT - len(part))))
            mask.append(np.arange(SEGMENT) < len(part))
            labels.append(number[label])
    steps, mask, labels = np.array(steps).T.astype("i8"), np.array(mask).T.astype("f4"), np.array(labels)
    params = {"in_f": rng.normal(size=(256, 3 * UNITS)) * 0.5, "in_b": rng.normal(size=(256, 3 * UNITS)) * 0.5,
              "u_f": new_direction(rng, UNITS), "u_b": new_direction(rng, UNITS),
              "w": rng.normal(size=(len(classes), 2 * UNITS)) * 0.3, "b": np.zeros(len(classes))}
    params = {k: v.astype("f4") for k, v in params.items()}
    adam = Adam(params, RATE)
    rounds = max(EPOCHS, -(-EPOCHS * 20 * BATCH // len(labels)))
    for epoch in range(rounds):
        adam.rate = RATE * (1 - epoch / rounds) + 0.001
        order = rng.permutation(len(labels))
        for i in range(0, len(order), BATCH):
            part = order[i:i + BATCH]
            adam.step(gradients(params, steps[:, part], mask[:, part], labels[part])[1])
    return {"classes": classes, **params}


def position_probabilities(model, texts):
    """Class probabilities of every byte position of each text: arrays (bytes, classes)."""
    out = [np.zeros((len((t or "").encode("utf-8", "replace")), len(model["classes"])), "f4") for t in texts]

    def put(doc, start, fresh, p):
        for b in range(len(doc)):
            here = p[fresh[b]:, :, b]
            at = start[b] + fresh[b]
            room = out[doc[b]][at:at + len(here)]
            room[:] = here[:len(room)]

    _each(model, texts, put)
    return out


def document_probabilities(model, texts):
    """Mean of the position probabilities of each text: (texts, classes)."""
    total = np.zeros((len(texts), len(model["classes"])), "f8")
    count = np.zeros(len(texts))

    def add(doc, sums, positions):
        np.add.at(total, doc, sums)
        np.add.at(count, doc, positions)

    _each(model, texts, None, add)
    return total / np.maximum(count, 1)[:, None]


def _each(model, texts, positions, sums=None):
    data = [(t or "").encode("utf-8", "replace") for t in texts]
    lengths = np.array([len(d) for d in data], "i8")
    flat = np.frombuffer(b"".join(data) + b"\0", "u1")
    base = np.r_[0, np.cumsum(lengths)]
    found = windows(lengths, WINDOW, WINDOW)
    units = model["u_f"].shape[1]
    w_f, w_b, bias = model["w"][:, :units], model["w"][:, units:], model["b"][:, None]
    for chosen, at, inside in batches(found, WINDOW, ROWS):
        doc, start, _, fresh = found[:, chosen]
        steps = flat.take(np.minimum(base[doc] + start + at, len(flat) - 1))
        mask = None if inside.all() else inside.astype("f4")
        ahead = run(model["in_f"], model["u_f"], steps, mask)
        behind = run(model["in_b"], model["u_b"], steps[::-1], None if mask is None else mask[::-1])[::-1]
        counted = (inside & (at >= fresh)).astype("f4")
        total = np.zeros((len(bias), len(doc)), "f4")
        every = [] if positions else None
        for t in range(len(steps)):
            p = w_f @ ahead[t]
            p += w_b @ behind[t]
            p += bias
            p -= p.max(axis=0)
            np.exp(p, p)
            p /= p.sum(axis=0)
            if positions:
                every.append(p)
            else:
                p *= counted[t]
                total += p
        if positions:
            positions(doc, start, fresh, np.stack(every))
        else:
            sums(doc, total.T, counted.sum(axis=0))


def predict(model, texts):
    """Language and score of each text."""
    known = [i for i, t in enumerate(texts) if model is not None and has_letter(t)]
    langs, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
    if known:
        p = document_probabilities(model, [texts[i] for i in known])
        for i, row in zip(known, p, strict=True):
            k = int(row.argmax())
            langs[i], scores[i] = model["classes"][k], float(min(1.0, row[k]))
    return langs, scores


def _predicted(model, part, place):
    """``predict`` over a text column, in slices of bounded length: (slice, languages, scores)."""
    release_others("language")
    for start, stop, texts in chunks(part.column(place), PART):
        yield part.slice(start, stop - start), *predict(model, texts)


def learn(docs, id_column="doc_id", text_column="text", label_column="lang"):
    """Train on the rows outside the held-out fold (crc32 of the id modulo 3 is 1)."""
    rows = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"),
                       F.col(label_column).alias("label"))
    return train(sample(rows, rows.where(remainder("id", 3) != 1).select("id", "label")))


def identify(docs, model, id_column="doc_id", text_column="text"):
    """``doc_id, lang_pred, score`` of every row."""
    def score(parts):
        for part in parts:
            for rows, langs, scores in _predicted(model, part, 1):
                yield pa.RecordBatch.from_arrays(
                    [rows.column(0), pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=["doc_id", "lang_pred", "score"])

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(
        score, f"doc_id {kind}, lang_pred string, score double")


def keep_identified(docs, model, text_column="text", margin=MARGIN):
    """The documents whose language is known well enough, all columns as they are.

    Those stay whose pooled probability is at least ``margin`` times that of a guess among the model's
    languages (every document with a letter, where there is one language or, with no row to learn from, no
    model); the others, and those without a letter, go.
    """
    place = docs.columns.index(text_column)

    least = margin / len(model["classes"]) if model is not None and len(model["classes"]) > 1 else 0

    def kept(parts):
        for part in parts:
            for rows, langs, scores in _predicted(model, part, place):
                if model is None:
                    keep = [has_letter(t) for t in rows.column(place).to_pylist()]
                else:
                    keep = [lang != UNKNOWN and score >= least for lang, score in zip(langs, scores, strict=True)]
                yield rows.filter(pa.array(keep, pa.bool_()))

    return docs.mapInArrow(kept, docs.schema)


@query("op4_language_id")
def op4_language_id(spark, sf):
    docs = table(spark, sf, "documents")
    found = identify(docs, learn(docs))
    return found.select("doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"),
                        "lang_pred", "score")
