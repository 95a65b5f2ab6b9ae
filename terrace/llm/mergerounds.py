"""BPE with word ends, encoded by batched merge rounds (operator 13), and decoding.

Texts are cut at ASCII blanks, which the normaliser and the pre-tokenizer of such a vocabulary never
look across. The words a worker does not remember yet are normalised and cut into pieces, and the
symbols of all their pieces are laid into one flat array. A round looks up every pair of neighbours
by binary search over the sorted keys of the merge rules and joins the pairs of lowest rank: in a
short piece the lowest of the piece, in a long one the lowest within the length of the longest token
to both sides. No token formed by a better rank can reach further, so this is what single merges in
order of rank would do, and a long piece needs no more rounds than a short one needs. Pieces in
which no pair is left leave the array.

A merge rule has to come after the rules that form its two sides, as in every trained vocabulary;
a definition that breaks this, or has parts that are not read here (a decoder, dropout, byte
fallback), is refused.

Defined cases: NULL and empty texts have no ids and decode to the empty text. Repeated rows and rows
with NULL ids are encoded like others. Strings of the added tokens inside a text are those tokens.
"""

import hashlib
import json
import os
import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

from terrace.llm.memory import remembered
from terrace.llm.packing import SHOWN
from terrace.llm.registry import query, table

VOCABULARY = "word_bpe_49k.json"
#: Words that a worker remembers, and the bytes of ids they may take, before it starts anew.
WORDS_KEPT, BYTES_KEPT = 800_000, 64_000_000
#: Symbols laid out for one run of rounds; a longer piece is laid out alone.
BATCH = 1 << 20
#: Bytes of text taken at once (a longer text is taken alone).
CHUNK = 4_000_000
#: Pieces of more symbols than this take the lowest rank of every neighbourhood.
SHORT = 64
BLANKS = "[ \t-\r]+"
#: Words of printable ASCII and Latin letters, which no normal form changes.
latin = re.compile("[!-~À-ÖØ-öø-ÿ]+").fullmatch
NONE = np.iinfo("i4").max


def places(counts):
    """Positions 0, 1, ... within runs of the given lengths, laid out one after another."""
    ends = np.cumsum(counts)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - counts, counts)


def slices(column, limit=CHUNK):
    """Rows of a text column that hold about ``limit`` bytes together, one row at least: (first, row after)."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False).astype("i8")
    part = np.cumsum(sizes) // limit
    edges = np.r_[0, np.flatnonzero(np.diff(part)) + 1, len(sizes)]
    return [(int(a), int(b)) for a, b in zip(edges, edges[1:]) if a < b]


class Rules:
    """Merge rules as arrays sorted by pair key."""

    def __init__(self, merges, vocabulary, size):
        self.size = size
        pairs = np.array([(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in merges], "i8").reshape(-1, 3)
        formed = np.full(size, -1)
        formed[pairs[:, 2]] = np.arange(len(pairs))
        if (formed[pairs[:, :2]].max(axis=1, initial=-1) >= np.arange(len(pairs))).any():
            raise ValueError("a merge rule comes before the rules that form its sides")
        keys = pairs[:, 0] * size + pairs[:, 1]
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.joined = keys[order], order.astype("i4"), pairs[:, 2]

    def rank(self, left, right):
        """Rank of every pair, ``NONE`` where there is no rule."""
        if not len(self.keys):
            return np.full(len(left), NONE, "i4")
        wanted = left * self.size + right
        at = np.minimum(np.searchsorted(self.keys, wanted), len(self.keys) - 1)
        return np.where(self.keys[at] == wanted, self.ranks[at], NONE).astype("i4")


def around(ranks, reach):
    """The lowest of every value and its ``reach`` neighbours (at least) to both sides."""
    out, width = ranks.copy(), 1
    while width <= reach:
        ahead = np.r_[out[width:], np.full(min(width, len(out)), NONE, "i4")]
        back = np.r_[np.full(min(width, len(out)), NONE, "i4"), out[:-width]]
        out = np.minimum(out, np.minimum(ahead, back))
        width *= 2
    return out


def merge_rounds(rules, symbols, lengths, reach):
    """Symbols of many pieces, laid end to end, after all merges: ``(symbols, lengths)``.

    ``reach`` is the number of symbols that the longest token is made of.
    """
    out_lengths = lengths.copy()
    piece = np.repeat(np.arange(len(lengths)), lengths)
    kept_symbols, kept_pieces = [symbols[:0]], [piece[:0]]
    while len(symbols):
        inside = piece[:-1] == piece[1:]
        ranks = np.full(len(symbols), NONE, "i4")  # of the pair that starts here
        ranks[:-1][inside] = rules.rank(symbols[:-1][inside], symbols[1:][inside])
        starts = np.flatnonzero(np.r_[True, piece[1:] != piece[:-1]])
        counts = np.diff(np.r_[starts, len(symbols)])
        low = np.minimum.reduceat(ranks, starts)
        going = low < NONE
        if not going.all():
            keep = np.repeat(~going, counts)
            kept_symbols.append(symbols[keep])
            kept_pieces.append(piece[keep])
            out_lengths[piece[starts[~going]]] = counts[~going]
            symbols, piece, ranks = symbols[~keep], piece[~keep], ranks[~keep]
            counts, low = counts[going], low[going]
            if not len(symbols):
                break
        least = np.repeat(low, counts)
        long = np.repeat(counts > SHORT, counts)
        if long.any():  # the last pair of a piece has no rank, so a piece's neighbourhood ends with a gap
            edges = np.r_[0, np.cumsum(counts)]
            for k in np.flatnonzero(counts > SHORT):
                least[edges[k]:edges[k + 1]] = around(ranks[edges[k]:edges[k + 1]], reach)
        take = (ranks < NONE) & (ranks == least)
        # A run of pairs that overlap is one symbol repeated: every second pair of it is taken, from its
        # first on, and only once its whole run may be taken.
        follows = np.r_[False, (ranks[1:] == ranks[:-1]) & (ranks[1:] < NONE) & (symbols[1:] == symbols[:-1])
                        & (piece[1:] == piece[:-1])]
        if follows.any():
            first = np.flatnonzero(~follows)
            size = np.diff(np.r_[first, len(symbols)])
            whole = np.repeat(np.logical_and.reduceat(take, first), size)
            take &= whole & (places(size) % 2 == 0)
        at = np.flatnonzero(take)
        symbols[at] = rules.joined[ranks[at]]
        stay = np.ones(len(symbols), bool)
        stay[at + 1] = False
        symbols, piece = symbols[stay], piece[stay]
    symbols, piece = np.concatenate(kept_symbols), np.concatenate(kept_pieces)
    order = np.argsort(piece, kind="stable")
    return symbols[order], out_lengths


class Codec:
    """Encodes and decodes by the definition (JSON text) of a vocabulary."""

    def __init__(self, definition):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        parts = json.loads(definition)
        model = parts["model"]
        if (model["type"] != "BPE" or parts["decoder"] or model.get("dropout") or model.get("byte_fallback")
                or model.get("continuing_subword_prefix") or model.get("ignore_merges")):
            raise ValueError("only plain BPE vocabularies without a decoder are read")
        tool = Tokenizer.from_str(definition)
        self.normalised, self.cut = tool.normalizer.normalize_str, tool.pre_tokenizer.pre_tokenize_str
        steps = parts["pre_tokenizer"].get("pretokenizers", [])
        self.split = None  # the same cut for words that the normaliser only writes in lower case
        if [(s["type"], s.get("behavior"), s.get("invert"), s.get("use_regex")) for s in steps] == [
                ("Split", "Removed", True, None), ("ByteLevel", None, None, False)]:
            self.split = regex.compile(steps[0]["pattern"]["Regex"]).findall
        vocabulary, end = model["vocab"], model.get("end_of_word_suffix") or ""
        self.added = {t["content"]: t["id"] for t in parts["added_tokens"]}
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] or t["normalized"] for t in parts["added_tokens"]):
            raise ValueError("added tokens are found as they are written")
        self.split_added = re.compile("(" + "|".join(map(re.escape, self.added)) + ")").split if self.added else None
        names = {**vocabulary, **self.added}
        self.tokens = [""] * (max(names.values(), default=-1) + 1)
        for token, number in names.items():
            self.tokens[number] = token
        self.tokens = np.array(self.tokens, object)
        self.decimal = np.array([str(k) for k in range(len(self.tokens))], object)
        self.rules = Rules([m.split(" ") if isinstance(m, str) else m for m in model["merges"]], vocabulary, len(self.tokens))
        self.reach = max((len(t) - len(end) * t.endswith(end) for t in vocabulary), default=1)
        codes = [ord(t) for t in vocabulary if len(t) == 1]
        self.inner = np.full(max(codes, default=0) + 2, -1)
        self.last = self.inner.copy()
        for code in codes:
            self.inner[code] = vocabulary[chr(code)]
            self.last[code] = vocabulary.get(chr(code) + end, -1)
        self._forget()

    def _forget(self):
        self.words = {"": 0}
        self.ids, self.used = np.zeros(1 << 16, "u4"), 0
        self.starts, self.counts = np.zeros(1, "i8"), np.zeros(1, "i8")

    def _pieces(self, word):
        """Pieces of a word in the vocabulary's characters; an added token is its id."""
        if self.split_added and "<" in word and len(parts := self.split_added(word)) > 1:
            return [p for k, part in enumerate(parts) for p in ([self.added[part]] if k % 2 else self._pieces(part))]
        if self.split and latin(word):
            pieces = self.split(word.lower())
            return pieces if word.isascii() else [p.encode().decode("latin-1").translate(SHOWN) for p in pieces]
        return [piece for piece, _ in self.cut(self.normalised(word))]

    def _learn(self, words):
        """Encode words and remember their ids."""
        flat, owner = [], []
        for k, word in enumerate(words):
            pieces = self._pieces(word)
            flat += pieces
            owner += [k] * len(pieces)
        owner = np.array(owner, "i8")
        known = {}  # pieces of this call by place
        place = np.array([known.setdefault(p, len(known)) for p in flat], "i8")
        ids, counts = self._merged(list(known))
        begins = np.cumsum(counts) - counts
        sizes = counts[place]
        found = ids[np.repeat(begins[place], sizes) + places(sizes)]
        per_word = np.bincount(owner, sizes, len(words)).astype("i8") if len(owner) else np.zeros(len(words), "i8")
        if self.used + len(found) > len(self.ids):
            self.ids = np.r_[self.ids[:self.used], np.zeros(max(len(found), self.used), "u4")]
        self.ids[self.used:self.used + len(found)] = found
        self.words.update(zip(words, range(len(self.counts), len(self.counts) + len(words)), strict=True))
        self.starts = np.r_[self.starts, self.used + np.cumsum(per_word) - per_word]
        self.counts = np.r_[self.counts, per_word]
        self.used += len(found)

    def _merged(self, pieces):
        """Ids of different pieces, end to end, and how many each has."""
        ids, counts, waiting, held = [], [], [], 0
        for k, piece in enumerate(pieces):
            waiting.append(piece)
            held += 1 if isinstance(piece, int) else len(piece)
            if held >= BATCH or k + 1 == len(pieces):
                symbols, lengths = self._symbols(waiting)
                symbols, lengths = merge_rounds(self.rules, symbols, lengths, self.reach)
                ids.append(symbols)
                counts.append(lengths)
                waiting, held = [], 0
        return (np.concatenate(a) if a else np.zeros(0, "i8") for a in (ids, counts))

    def _symbols(self, pieces):
        lengths = np.array([1 if isinstance(p, int) else len(p) for p in pieces], "i8")
        text = "".join("\0" if isinstance(p, int) else p for p in pieces)
        codes = np.frombuffer(text.encode("utf-32-le"), "<u4").astype("i8")
        symbols = self.inner[codes]
        ends = np.cumsum(lengths) - 1
        symbols[ends] = self.last[codes[ends]]
        for k, piece in enumerate(pieces):
            if isinstance(piece, int):
                symbols[ends[k]] = piece
        if (symbols < 0).any():
            raise ValueError("a byte is missing from the vocabulary")
        return symbols, lengths

    def encode(self, texts):
        """Ids of an Arrow array of texts: ``(ids, offsets)`` as numpy arrays, the texts end to end."""
        lists = pc.split_pattern_regex(texts.fill_null("").cast(pa.large_string()), BLANKS)
        bounds = lists.offsets.to_numpy().astype("i8")
        words = lists.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        bounds -= bounds[0]
        names = words.dictionary.to_pylist()
        if len(self.words) > WORDS_KEPT or 4 * self.used > BYTES_KEPT:
            self._forget()
        new = [w for w in names if w not in self.words]
        if new:
            self._learn(new)
        number = np.fromiter(map(self.words.__getitem__, names), "i8", len(names))[words.indices.to_numpy()]
        sizes = self.counts[number]
        ids = self.ids[np.repeat(self.starts[number], sizes) + places(sizes)]
        return ids, np.r_[0, np.cumsum(sizes)][bounds]

    def decode(self, ids):
        """The text of one document's ids: tokens as the vocabulary writes them, a blank between two."""
        return " ".join(self.tokens[ids])


def codec(definition):
    """One codec for each vocabulary in a Python worker."""
    key = hashlib.sha256(definition.encode()).digest()
    return remembered("mergerounds", key, lambda: Codec(definition))


def encode_documents(docs, path, id_column="doc_id", text_column="text"):
    """``doc_id, n_tokens, ids, decoded``: ids as a list and the text they decode to."""
    return _mapped(docs, path, id_column, text_column, "ids array<int>, decoded string",
                   lambda tool, ids: (ids.astype("i4"), tool.decode(ids)))


def digest_documents(docs, path, id_column="doc_id", text_column="text"):
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: the same without carrying ids and texts on."""
    return _mapped(docs, path, id_column, text_column, "ids_sha256 string, decoded_sha256 string",
                   lambda tool, ids: (hashlib.sha256(" ".join(tool.decimal[ids]).encode()).hexdigest(),
                                      hashlib.sha256(tool.decode(ids).encode()).hexdigest()))


def _mapped(docs, path, id_column, text_column, shown, show):
    with open(path, encoding="utf-8") as file:  # a few megabytes, read by the driver alone
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    names = ["doc_id", "n_tokens", *(part.split()[0] for part in shown.split(", "))]
    types = [pa.list_(pa.int32()) if "array" in part else pa.string() for part in shown.split(", ")]

    def run(parts):
        tool = codec(definition.value)
        for part in parts:
            for a, b in slices(part.column(1)):
                ids, bounds = tool.encode(part.column(1).slice(a, b - a))
                found = [show(tool, ids[i:j]) for i, j in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).slice(a, b - a), pa.array(np.diff(bounds)),
                     *(pa.array([f[k] for f in found], kind) for k, kind in enumerate(types))], names=names)

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(run, f"doc_id {kind}, n_tokens long, {shown}")


@query("op13_word_bpe")
def op13_word_bpe(spark, sf):
    import public_tokenizers as public

    return digest_documents(table(spark, sf, "documents"), public.path(VOCABULARY))
