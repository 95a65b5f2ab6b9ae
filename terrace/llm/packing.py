"""Cost-balanced packing (operator 9): token sequences of equal length and similar attention cost.

A document's cost is linear plus quadratic in its tokens, because attention stays within a
document. Documents of a block are taken in descending length; each goes to the cheapest sequence
that still has room for all of it, else it is cut and its front fills the cheapest sequence that
has any room. A block holds as many sequences as its tokens fill completely, so nothing is padded;
what is left over moves on to the next block. The leftover of a task's last block (less than one
sequence) is cut into sequences of falling powers of two, which need no padding either.

Blocks are formed from a task's own rows in order, so nothing is shuffled, memory is bounded by
``BLOCK`` sequences and the longest single text, and a repeated task gives the same pieces.

Words between blanks are encoded once and remembered: the normaliser and the pre-tokenizer of a
vocabulary whose tokens hold no white space treat them independently.

Defined cases: NULL and empty texts are one piece of the end id alone. Repeated rows and rows with
NULL or equal ids are packed as documents of their own.
"""

import array
import hashlib
import heapq
import os
import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext

from terrace.llm.memory import remembered
from terrace.llm.registry import query, table

VOCABULARY, END = "word_bpe_49k.json", 2
CAPACITY = 4096
#: Sequences packed together.
BLOCK = 256
#: Cost of n tokens of one document: LINEAR * n + QUADRATIC * n * n (a model 1,024 wide: 24 w^2 and 4 w).
LINEAR, QUADRATIC = 24 * 1024 ** 2, 4 * 1024
WORDS_KEPT = 400_000

PROBES = ("The", "Été,", "straße.", "ÑANDÚ!?", "x", "ÿ;")
#: Latin letters, then stops.
simple = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([.,;:!?]*)").fullmatch
#: How byte-level vocabularies write bytes: those that can be shown as themselves, others from 256 on.
_shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
SHOWN = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _shown)}


def cost(tokens):
    return LINEAR * tokens + QUADRATIC * tokens * tokens


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers, word by word.

    A new word of Latin letters with stops behind it goes to the merges directly, in lower case and
    in two parts, which is what the normaliser and the pre-tokenizer make of it (checked on
    ``PROBES``); every other word goes through the whole tokenizer.
    """

    def __init__(self, definition):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tool = Tokenizer.from_str(definition)
        self.words = {}
        self.direct = all(self._direct(simple(w)) == self._whole(w) for w in PROBES)

    def _whole(self, word):
        return array.array("I", self.tool.encode(word, add_special_tokens=False).ids).tobytes()

    def _keep(self, word, ids):
        if len(self.words) >= 2 * WORDS_KEPT:  # words, and the parts of words
            self.words.clear()
        self.words[word] = ids
        return ids

    def _part(self, part):
        """Ids of letters in lower case or of stops, kept as those of a word: they are words of their own."""
        key = part.encode()
        ids = self.words.get(key)
        if ids is None:
            found = self.tool.model.tokenize(part if part.isascii() else key.decode("latin-1").translate(SHOWN))
            ids = self._keep(key, array.array("I", [t.id for t in found]).tobytes())
        return ids

    def _direct(self, match):
        letters, stops = match.groups()
        ids = self._part(letters.lower())
        return ids + self._part(stops) if stops else ids

    def _new(self, data):
        word = data.decode()
        if len(word) > 64:
            return self._whole(word)
        match = self.direct and simple(word)
        return self._keep(data, self._direct(match) if match else self._whole(word))

    def encode(self, text):
        words = text.encode().split()  # bytes are split at the six ASCII blanks alone
        ids = list(map(self.words.get, words))
        if None in ids:
            for k, known in enumerate(ids):
                if known is None:
                    ids[k] = self.words.get(words[k]) or self._new(words[k])
        return b"".join(ids)


def encoder(definition):
    """One encoder for each vocabulary in a Python worker."""
    key = hashlib.sha256(definition.encode()).digest()
    return remembered("packing", key, lambda: Encoder(definition))


def pack(lengths, sequences, capacity=CAPACITY):
    """Pack documents into ``sequences`` full sequences: (pieces, left over).

    ``lengths`` is ``[(tokens, document, first token)]``. Pieces are ``(document, first token, tokens,
    sequence, offset)``; what is left over has the form of ``lengths``.
    """
    waiting = [(-n, doc, start) for n, doc, start in lengths]
    heapq.heapify(waiting)
    costs, room = np.zeros(sequences), np.full(sequences, capacity)
    pieces, free = [], sequences * capacity
    while waiting and free:
        n, doc, start = heapq.heappop(waiting)
        n = -n
        fits = room >= n
        if not fits.any():
            fits = room > 0
        k = int(np.where(fits, costs, np.inf).argmin())
        taken = min(n, int(room[k]))
        pieces.append((doc, start, taken, k, capacity - int(room[k])))
        costs[k] += cost(taken)
        room[k] -= taken
        free -= taken
        if taken < n:
            heapq.heappush(waiting, (taken - n, doc, start + taken))
    return pieces, [(-n, doc, start) for n, doc, start in waiting]


def tail(lengths, capacity=CAPACITY):
    """Pack less than one sequence of tokens into sequences of falling powers of two."""
    total = sum(n for n, _, _ in lengths)
    sizes = [1 << b for b in range(capacity.bit_length(), -1, -1) if total >> b & 1]
    pieces, k, used = [], 0, 0
    for n, doc, start in sorted(lengths, reverse=True):
        while n:
            taken = min(n, sizes[k] - used)
            pieces.append((doc, start, taken, k, used))
            n, start, used = n - taken, start + taken, used + taken
            if used == sizes[k]:
                k, used = k + 1, 0
    return pieces


def pack_documents(docs, path, end=END, capacity=CAPACITY, block=BLOCK, id_column="doc_id", text_column="text",
                   with_ids=False):
    """One row per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset`` (and ``ids``).

    A sequence number holds the task in its upper half, so tasks need not agree on anything.
    """
    with open(path, encoding="utf-8") as file:  # a few megabytes, read by the driver alone
        definition = docs.sparkSession.sparkContext.broadcast(file.read())
    kind = docs.schema[id_column].dataType.simpleString()

    def run(parts):
        tool = encoder(definition.value)
        context = TaskContext.get()
        first = (context.partitionId() if context else 0) << 32
        last_id = int(end).to_bytes(4, "little")
        held, waiting, tokens, number, kind_of_id = {}, [], 0, 0, None

        def rows(pieces, sequence):
            columns = [[] for _ in range(8)]
            for doc, start, n, k, offset in pieces:
                name, ids = held[doc]
                part = ids[4 * start:4 * (start + n)]
                for column, value in zip(columns, (name, start, n, zlib.crc32(part), len(ids) // 4,
                                                   first + sequence + k, offset, part), strict=True):
                    column.append(value)
            names = "doc_id start length ids_crc32 doc_tokens sequence_id offset".split()
            arrays = [pa.array(columns[0], kind_of_id), *(pa.array(c, pa.int64()) for c in columns[1:7])]
            if with_ids:
                names, arrays = [*names, "ids"], [*arrays, pa.array(columns[7], pa.binary())]
            return pa.RecordBatch.from_arrays(arrays, names=names)

        count = 0
        for batch in parts:
            kind_of_id = batch.column(0).type
            for name, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids = tool.encode(text or "") + last_id
                held[count] = name, ids
                waiting.append((len(ids) // 4, count, 0))
                tokens += len(ids) // 4
                count += 1
                if tokens >= block * capacity:
                    full = tokens // capacity
                    pieces, waiting = pack(waiting, full, capacity)
                    yield rows(pieces, number)
                    number += full
                    tokens -= full * capacity
                    held = {doc: held[doc] for _, doc, _ in waiting}
        if waiting:
            full = tokens // capacity
            pieces, waiting = pack(waiting, full, capacity)
            yield rows(pieces, number)
            yield rows(tail(waiting, capacity), number + full)

    schema = (f"doc_id {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
              "offset long" + ", ids binary" * with_ids)
    return docs.select(id_column, text_column).mapInArrow(run, schema)


@query("op9_packing")
def op9_packing(spark, sf):
    import public_tokenizers as public

    return pack_documents(table(spark, sf, "documents"), public.path(VOCABULARY))
