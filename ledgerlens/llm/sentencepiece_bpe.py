"""SentencePiece encoding and decoding with merge-type (BPE) vocabularies.

A text is normalised as the model says (a space in front, spaces as U+2581),
cut where no piece can reach across (before a U+2581 that follows another
character, if no piece holds such a place), and each segment is merged by a
score-ordered agenda of its adjacent symbol pairs: the pair whose joined piece
scores highest is merged, the leftmost of equals first, until no pair joins to
a piece.  Short segments of a batch run their agendas in step, a row each, in
numpy; long ones use a heap.  Symbols that are no piece become byte pieces, or
the unknown piece where the model has none.

Segments recur, so each worker remembers a bounded number of them.  Every
newly met segment of an Arrow batch is also encoded by the sentencepiece
library, and a difference stops the job; texts of a batch are whole joins of
such segments.

Edge cases.  Null and empty texts have no ids and decode to "".  Rows with
null or repeated ids are encoded like others; only the id and text columns are
read; an empty table gives an empty result.  Models that aren't BPE, change
characters, drop extra spaces, or hold user-defined or unused pieces are
refused.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import tokens as tk
from .ship import map_arrow

SPACE = "▁"
#: Segments of up to so many characters run in numpy and are remembered.
SHORT = 40
#: Remembered segments of a worker: at most twice this many.
REMEMBERED = 200_000


def _fields(data: bytes):
    """(number, value) of the fields of a protocol buffer message."""
    def varint(i):
        value = shift = 0
        while True:
            value |= (data[i] & 127) << shift
            shift += 7
            i += 1
            if data[i - 1] < 128:
                return value, i

    i = 0
    while i < len(data):
        tag, i = varint(i)
        kind = tag & 7
        if kind == 0:
            value, i = varint(i)
        elif kind == 2:
            n, i = varint(i)
            value, i = data[i:i + n], i + n
        else:
            n = 8 if kind == 1 else 4
            value, i = data[i:i + n], i + n
        yield tag >> 3, value


class Vocabulary:
    """Pieces, merge table and flags of a model file."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        sp = self.library
        with open(path, "rb") as f:
            parts = dict(x for x in _fields(f.read()) if x[0] in (2, 3))
        trainer, normalizer = dict(_fields(parts[2])), dict(_fields(parts.get(3, b"")))
        size = sp.get_piece_size()
        if trainer.get(3, 1) != 2:
            raise ValueError("not a merge-type (BPE) model")
        if normalizer.get(1, b"identity") != b"identity" or normalizer.get(2) or not normalizer.get(3, 1) \
                or normalizer.get(4, 1) or not normalizer.get(5, 1) or trainer.get(24):
            raise ValueError("the model's normalisation isn't supported")
        if any(sp.is_unused(i) for i in range(size)):
            raise ValueError("unused pieces aren't supported")
        self.text = [sp.id_to_piece(i) for i in range(size)]
        self.unknown = sp.unk_id()
        self.byte_value = {i: int(self.text[i][3:5], 16) for i in range(size) if sp.is_byte(i)}
        self.byte_id = {v: i for i, v in self.byte_value.items()}
        self.silent = {i for i in range(size) if sp.is_control(i)}
        plain = {self.text[i]: i for i in range(size)
                 if i not in self.byte_value and i not in self.silent and i != self.unknown}
        self.cut = not any(re.search(f"[^{SPACE}]{SPACE}", p) for p in plain)
        #: symbols: pieces, then characters that only occur inside pieces, then any other character
        symbols = dict(plain)
        for p in plain:
            for c in p:
                symbols.setdefault(c, size + len(symbols) - len(plain))
        self.other = size + len(symbols) - len(plain)
        self.wide = self.other + 1
        self.symbol = symbols
        self.is_piece = np.zeros(self.wide, bool)
        self.is_piece[list(plain.values())] = True
        pairs = {}
        for p, i in plain.items():
            score = sp.get_score(i)
            for k in range(1, len(p)):
                a, b = symbols.get(p[:k]), symbols.get(p[k:])
                if a is not None and b is not None:
                    pairs[a * self.wide + b] = (score, i)
        self.pairs = pairs
        self._table(pairs)
        silent = self.silent | self.byte_value.keys() | {self.unknown}
        #: text of each ordinary piece, and each id in decimal
        self.shown = [None if i in silent else t.replace(SPACE, " ") for i, t in enumerate(self.text)]
        self.digits = [str(i) for i in range(size)]
        self.chars = np.array(sorted(ord(c) for c in symbols if len(c) == 1), np.uint32)
        self.char_symbols = np.array([symbols[chr(c)] for c in self.chars], np.int64)

    # -- agendas ---------------------------------------------------------------

    def _table(self, pairs: dict[int, tuple[float, int]]) -> None:
        """A hash table of the merges: keys (-1: free), scores and joined pieces by slot, at most an eighth full."""
        self.bits = max(4, (8 * len(pairs)).bit_length())
        size = 1 << self.bits
        self.keys, self.scores, self.joined = np.full(size, -1, np.int64), np.full(size, -np.inf), np.zeros(size, np.int64)
        todo = np.array(list(pairs), np.int64)
        slot = self._slot(todo)
        while len(todo):
            free = self.keys[slot] < 0
            self.keys[slot[free]] = todo[free]  # of several keys for one slot the last stays
            left = self.keys[slot] != todo
            todo, slot = todo[left], (slot[left] + 1) & (size - 1)
        used = np.flatnonzero(self.keys >= 0)
        self.scores[used] = [pairs[k][0] for k in self.keys[used].tolist()]
        self.joined[used] = [pairs[k][1] for k in self.keys[used].tolist()]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return (key.view(tk.U) * tk.U(0x9E3779B97F4A7C15) >> tk.U(64 - self.bits)).view(np.int64)

    def _spell(self, symbol: int, char: str) -> list[int]:
        if symbol < self.wide and self.is_piece[symbol]:
            return [symbol]
        if self.byte_id:
            return [self.byte_id[b] for b in char.encode()]
        return [self.unknown]

    def _one_unknown(self, ids: list[int]) -> list[int]:
        if self.byte_id:
            return ids
        return [x for k, x in enumerate(ids) if not (x == self.unknown and k and ids[k - 1] == x)]

    def agenda(self, segment: str) -> list[int]:
        """Ids of a segment of any length, by a heap of its adjacent pairs."""
        n = len(segment)
        symbol = [self.symbol.get(c, self.other) for c in segment]
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        heap = []

        def offer(i, j):
            if i >= 0 and j >= 0 and (found := self.pairs.get(symbol[i] * self.wide + symbol[j])):
                heapq.heappush(heap, (-found[0], i, j, symbol[i], symbol[j], found[1]))

        for i in range(n - 1):
            offer(i, i + 1)
        while heap:
            _, i, j, a, b, joined = heapq.heappop(heap)
            if symbol[i] != a or symbol[j] != b or after[i] != j:
                continue
            symbol[i], symbol[j] = joined, -1
            after[i] = after[j]
            if after[j] >= 0:
                before[after[j]] = i
            offer(before[i], i)
            offer(i, after[i])
        return self._one_unknown([x for s, c in zip(symbol, segment) if s >= 0 for x in self._spell(s, c)])

    def _pair(self, a: np.ndarray, b: np.ndarray):
        """Score of joining a and b (minus infinity: no merge), and the joined piece."""
        key = a * self.wide + b
        slot = self._slot(key)
        found = self.keys[slot]
        off = np.flatnonzero((found != key) & (found >= 0))
        while len(off):
            slot[off] = (slot[off] + 1) & (len(self.keys) - 1)
            found[off] = self.keys[slot[off]]
            off = off[(found[off] != key[off]) & (found[off] >= 0)]
        return np.where(found == key, self.scores[slot], -np.inf), self.joined[slot]

    def in_step(self, segments: list[str]) -> list[list[int]]:
        """Ids of segments of up to SHORT characters, one agenda a row, all taking a step at a time."""
        size = np.fromiter(map(len, segments), np.int64, len(segments))
        n, wide = len(segments), int(size.max(initial=0))
        if not n or not wide:
            return [[] for _ in segments]
        code = np.frombuffer("".join(segments).encode("utf-32-le"), np.uint32)
        at = np.minimum(np.searchsorted(self.chars, code), len(self.chars) - 1)
        flat = np.where(self.chars[at] == code, self.char_symbols[at], self.other)
        cell = np.arange(wide)[None, :] < size[:, None]
        symbol = np.full((n, wide + 1), -1, np.int64)
        symbol[:, :wide][cell] = flat
        score = np.full((n, wide + 1), -np.inf)
        joined = np.zeros((n, wide + 1), np.int64)
        both = np.zeros((n, wide + 1), bool)
        both[:, :wide - 1] = cell[:, 1:]
        r, c = np.nonzero(both)
        score[r, c], joined[r, c] = self._pair(symbol[r, c], symbol[r, c + 1])
        after = np.tile(np.arange(1, wide + 2), (n, 1))
        after[np.arange(n), np.maximum(size - 1, 0)] = wide
        before = np.tile(np.arange(-1, wide), (n, 1))
        rows = np.arange(n)
        while len(rows):
            i = score[rows].argmax(1)
            live = score[rows, i] > -np.inf
            rows, i = rows[live], i[live]
            if not len(rows):
                break
            j = after[rows, i]
            symbol[rows, i] = joined[rows, i]
            symbol[rows, j], score[rows, j] = -1, -np.inf
            k = after[rows, j]
            after[rows, i] = k
            before[rows, k] = i  # column ``wide`` takes what has no successor
            score[rows, i] = -np.inf
            for left, right in ((i, k), (before[rows, i], i)):
                on = (left >= 0) & (right < wide)
                x, a, b = rows[on], left[on], right[on]
                score[x, a], joined[x, a] = self._pair(symbol[x, a], symbol[x, b])
        alive = symbol[:, :wide] >= 0
        ids, chars = symbol[:, :wide][alive], np.zeros((n, wide), np.uint32)
        chars[cell] = code
        chars = chars[alive]
        cuts = np.concatenate([[0], np.cumsum(alive.sum(1))]).tolist()
        odd = ~self.is_piece[ids]
        odd_rows = set(np.searchsorted(cuts, np.flatnonzero(odd), "right").tolist()) if odd.any() else ()
        ids, out = ids.tolist(), []
        for row in range(n):
            own = ids[cuts[row]:cuts[row + 1]]
            if row + 1 in odd_rows:
                own = self._one_unknown(
                    [x for s, c in zip(own, chars[cuts[row]:cuts[row + 1]].tolist()) for x in self._spell(s, chr(c))])
            out.append(own)
        return out

    # -- texts -----------------------------------------------------------------

    def segments(self, text: str) -> list[str]:
        """Segments of a text that isn't empty, each without the U+2581 in front and with spaces for others."""
        text = text.replace(SPACE, " ")
        if not self.cut:
            return [text]
        if "  " not in text and text[0] != " " and text[-1] != " ":
            return text.split(" ")
        return [x[1:] for x in re.findall(" +[^ ]*", " " + text)]

    def encode_segments(self, keys: list[str], check: bool = True) -> list[list[int]]:
        """Ids of segments as ``segments`` gives them; checked against the library."""
        out: list = [None] * len(keys)
        order = sorted(range(len(keys)), key=lambda i: len(keys[i]))
        full = [SPACE + k.replace(" ", SPACE) for k in keys]
        short = [i for i in order if len(full[i]) <= SHORT]
        for a in range(0, len(short), 4096):
            part = short[a:a + 4096]
            for i, ids in zip(part, self.in_step([full[i] for i in part])):
                out[i] = ids
        for i in order[len(short):]:
            out[i] = self.agenda(full[i])
        if check:
            asked = [i for i in range(len(keys)) if keys[i]]
            for i, ids in zip(asked, self.library.encode([keys[i] for i in asked], num_threads=1)):
                if ids != out[i]:
                    raise ValueError(f"the agenda and the library differ on {keys[i][:80]!r}: {out[i][:20]} and {ids[:20]}")
        return out

    def encode(self, text: str | None, check: bool = False) -> list[int]:
        if not text:
            return []
        return [x for ids in self.encode_segments(self.segments(text), check) for x in ids]

    def decode(self, ids, strip: bool = True) -> str:
        """Text of ids; ``strip``: drop the space that encoding puts in front."""
        shown = self.shown
        pieces = [shown[i] for i in ids]
        if None not in pieces:
            text = "".join(pieces)
            return text[1:] if strip and text[:1] == " " else text
        out, raw, first = [], bytearray(), strip
        for i in ids:
            if i in self.byte_value:
                raw.append(self.byte_value[i])
                first = False
                continue
            if raw:
                out.append(_utf8(bytes(raw)))
                raw.clear()
            if i in self.silent:
                continue
            if i == self.unknown:
                out.append(" ⁇ ")
            else:
                piece = self.text[i].replace(SPACE, " ")
                out.append(piece[1:] if first and piece[:1] == " " else piece)
            first = False
        if raw:
            out.append(_utf8(bytes(raw)))
        return "".join(out)


def _utf8(raw: bytes) -> str:
    """UTF-8, with U+FFFD for each byte that belongs to no character."""
    try:
        return raw.decode()
    except UnicodeDecodeError as e:
        return raw[:e.start].decode() + "�" + _utf8(raw[e.start + 1:])


@lru_cache(maxsize=4)
def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of a model file, read once in each worker."""
    return Vocabulary(path)


class Memory:
    """Segments met lately: key -> (number of ids, ids as text, decoded text)."""

    def __init__(self, vocab: Vocabulary):
        self.vocab, self.young, self.old = vocab, {}, {}

    def entries(self, keys: set[str]) -> dict:
        new = keys - self.young.keys()
        kept = {k: self.old[k] for k in new & self.old.keys()}
        long = {}
        fresh, digits = list(new - kept.keys()), self.vocab.digits
        for key, ids in zip(fresh, self.vocab.encode_segments(fresh)):
            entry = (len(ids), ",".join([digits[i] for i in ids]), self.vocab.decode(ids, strip=False))
            (kept if len(key) < SHORT else long)[key] = entry
        if len(self.young) + len(kept) > REMEMBERED:
            self.old, self.young = self.young, {}
            kept |= {k: self.old[k] for k in keys & self.old.keys()}
        self.young.update(kept)
        return self.young if not long else {k: long.get(k) or self.young[k] for k in keys}


@lru_cache(maxsize=4)
def memory(path: str) -> Memory:
    return Memory(vocabulary(path))


def encoded(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 and, if asked for, ids and decoded of every document.

    ``model_path`` is read by each worker, so every node must have the file.
    """
    source = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    fields = [source.schema["doc_id"], T.StructField("n_tokens", T.LongType()), T.StructField("ids_sha256", T.StringType()),
              T.StructField("decoded_sha256", T.StringType())]
    if with_ids:
        fields += [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    schema = T.StructType(fields)

    def run(batches):
        from ledgerlens.llm import sentencepiece_bpe as own  # the worker's module keeps its memory between tasks

        remembered = own.memory(model_path)
        for part in tk.slices(batches):
            texts = part.column(1).to_pylist()
            cut = [remembered.vocab.segments(t) if t else [] for t in texts]
            known = remembered.entries(set().union(*cut))
            n, ids_sha, decoded_sha, ids_out, decoded_out = [], [], [], [], []
            for keys in cut:
                found = [known[k] for k in keys]
                n.append(sum(e[0] for e in found))
                ids = ",".join([e[1] for e in found])
                decoded = "".join([e[2] for e in found])[1:]
                ids_sha.append(hashlib.sha256(ids.encode()).hexdigest())
                decoded_sha.append(hashlib.sha256(decoded.encode()).hexdigest())
                if with_ids:
                    ids_out.append(np.array(ids.split(","), np.int32) if ids else np.zeros(0, np.int32))
                    decoded_out.append(decoded)
            columns = [part.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(decoded_sha, pa.string())]
            if with_ids:
                columns += [pa.array(ids_out, pa.list_(pa.int32())), pa.array(decoded_out, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_arrow(source, run, schema)
