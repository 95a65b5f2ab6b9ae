"""Byte-level BPE encoding and decoding (operator 7).

Bytes are mapped to Latin-1 characters, so a prefix tree tells how long an entry of the vocabulary
can be at a position. The encoder takes the longest entry that is compatible with
its left neighbour and backtracks where none is. Two tokens are compatible when the merge rules,
applied to their joined bytes, leave exactly these two; a sequence whose neighbours are all
compatible is the one that the merge rules give, so a position from which no encoding goes on is
never visited twice and the work is linear in the piece. Compatibility is memoised by pair, whole
pieces by their text; both memories are bounded and emptied when full.

Defined cases: NULL and empty texts have no ids. Repeated rows and NULL ids are encoded like others.
"""

import array
import base64
import hashlib

import ahocorasick
import pyarrow as pa
import regex

from terrace.llm.memory import remembered
from terrace.llm.registry import query, table

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
PAIRS_KEPT, PIECES_KEPT = 500_000, 500_000


def ranks_of(data):
    """Ranks by token bytes from the lines of a rank file."""
    return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, data.splitlines()) if token}


def merge(ranks, data, least=1):
    """The plain merge rules: join the neighbours of lowest rank, leftmost first, while any are in the ranks.

    With ``least`` they stop when so many parts are left.
    """
    parts = [data[i:i + 1] for i in range(len(data))]
    while len(parts) > least:
        best, place = None, 0
        for i in range(len(parts) - 1):
            rank = ranks.get(parts[i] + parts[i + 1])
            if rank is not None and (best is None or rank < best):
                best, place = rank, i
        if best is None:
            break
        parts[place:place + 2] = [parts[place] + parts[place + 1]]
    return parts


class Codec:
    def __init__(self, ranks, pattern):
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        parts = {token: merge(ranks, token, 2) for token in ranks}
        # Other tokens occur only as whole pieces.
        self.entries = {token: rank for token, rank in ranks.items() if len(parts[token]) <= 2}
        #: The two parts that the last merge of a token joined.
        self.halves = {rank: tuple(ranks[p] for p in parts[token]) for token, rank in self.entries.items()
                       if len(token) > 1 and all(p in ranks for p in parts[token])}
        self.ordered = all(rank in self.halves for token, rank in self.entries.items() if len(token) > 1) and all(
            rank > half for rank, pair in self.halves.items() for half in pair if half in self.halves)
        self.longest = max(map(len, self.entries), default=0)
        self.starts = ahocorasick.Automaton()
        for token in self.entries:
            self.starts.add_word(token.decode("latin-1"), True)
        self.pairs, self.pieces = {}, {}

    def compatible(self, left, right):
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.pairs[left, right] = self._stay(left, right)
        return known

    def _stay(self, left, right):
        """Whether the merge rules leave the two tokens, joined, as they are.

        Their merges are undone, latest first: at no time may the parts that meet have a merge of their own
        that comes before the one undone last.
        """
        bytes_of, halves = self.bytes_of, self.halves
        if not self.ordered:
            a, b = bytes_of[left], bytes_of[right]
            return merge(self.ranks, a + b) == [a, b]
        before = None
        while True:
            rank = self.ranks.get(bytes_of[left] + bytes_of[right])
            if rank is not None and (before is None or rank < before):
                return False
            if left in halves and (right not in halves or left > right):
                before, left = left, halves[left][1]
            elif right in halves:  # of equal merges the left one comes first
                before, right = right + 1, halves[right][0]
            else:
                return True

    def encode_piece(self, data):
        """Ids of one piece of bytes."""
        whole = self.ranks.get(data)
        if whole is not None:
            return [whole]
        size, entry, pairs, reach = len(data), self.entries.get, self.pairs.get, self.starts.longest_prefix
        shown, longest = data.decode("latin-1"), self.longest
        out, lengths, closed = [], [], bytearray(size + 1)
        place, length = 0, reach(shown[:longest])  # no entry from here is longer
        while place < size:
            while length:
                if not closed[place + length]:
                    token = entry(data[place:place + length])
                    if token is not None:
                        if not out:
                            break
                        fits = pairs((out[-1], token))
                        if self.compatible(out[-1], token) if fits is None else fits:
                            break
                length -= 1
            if length:
                out.append(token)
                lengths.append(length)
                place += length
                length = reach(shown[place:place + longest])
            elif out:
                closed[place] = 1
                out.pop()
                length = lengths.pop()
                place -= length
                length -= 1
            else:
                raise ValueError("a byte is missing from the vocabulary")
        return out

    def encode(self, text):
        """Ids of a text as little-endian unsigned 32-bit integers."""
        pieces = self.split(text)
        out = list(map(self.pieces.get, pieces))
        if None in out:
            for k, ids in enumerate(out):
                if ids is None:
                    out[k] = self._new_piece(pieces[k])
        return b"".join(out)

    def _new_piece(self, piece):
        ids = self.pieces.get(piece)
        if ids is None:
            ids = array.array("I", self.encode_piece(piece.encode("utf-8", "replace"))).tobytes()
            if len(piece) <= 64:
                if len(self.pieces) >= PIECES_KEPT:
                    self.pieces.clear()
                self.pieces[piece] = ids
        return ids

    def decode(self, ids):
        """Bytes of ids packed as ``encode`` packs them."""
        numbers = array.array("I", ids)
        return b"".join(map(self.bytes_of.__getitem__, numbers))


def codec(data, pattern):
    """One codec for each vocabulary and pattern in a Python worker."""
    key = hashlib.sha256(data).digest(), pattern
    return remembered("bytepair", key, lambda: Codec(ranks_of(data), pattern))


def encode_documents(docs, path, pattern, id_column="doc_id", text_column="text"):
    """``doc_id, n_tokens, ids, decoded``: ids as packed integers and the bytes they decode to."""
    return _mapped(docs, path, pattern, id_column, text_column, "doc_id {}, n_tokens long, ids binary, decoded binary",
                   lambda ids, decoded: (ids, decoded))


def digest_documents(docs, path, pattern, id_column="doc_id", text_column="text"):
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: the same without carrying ids and texts on."""
    return _mapped(docs, path, pattern, id_column, text_column,
                   "doc_id {}, n_tokens long, ids_sha256 string, decoded_sha256 string",
                   lambda ids, decoded: (hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()))


def _mapped(docs, path, pattern, id_column, text_column, schema, shown):
    with open(path, "rb") as file:  # about a megabyte, read by the driver alone
        ranks = docs.sparkSession.sparkContext.broadcast(file.read())
    names = [part.split()[0] for part in schema.split(",")]
    kinds = {"binary": pa.binary(), "string": pa.string()}
    types = [kinds[part.split()[1]] for part in schema.split(",")[2:]]

    def encode(parts):
        tool = codec(ranks.value, pattern)
        for part in parts:
            counts, first, second = [], [], []
            for text in part.column(1).to_pylist():
                ids = tool.encode(text or "")
                a, b = shown(ids, tool.decode(ids))
                counts.append(len(ids) // 4)
                first.append(a)
                second.append(b)
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(counts, pa.int64()), pa.array(first, types[0]), pa.array(second, types[1])],
                names=names)

    kind = docs.schema[id_column].dataType.simpleString()
    return docs.select(id_column, text_column).mapInArrow(encode, schema.format(kind))


@query("op7_byte_bpe")
def op7_byte_bpe(spark, sf):
    import public_tokenizers as public

    return digest_documents(table(spark, sf, "documents"), public.path(VOCABULARY), public.PATTERN)
