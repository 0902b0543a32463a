"""Token counts of byte-level BPE vocabularies, without making ids.

A text is cut at the vocabulary's special strings (one token each) and into
pre-tokens by the vocabulary's pattern.  The bytes of a pre-token form a linked
list; a heap holds the rank of every adjacent pair that the vocabulary joins.
The lowest rank is popped and joined, the leftmost of equals first, until the
heap is empty.  Each join leaves one symbol less, so a pre-token's count is its
bytes minus its joins.

The pattern's classes (letters, numbers, white space) are those of the library:
code points on which its Unicode tables and those of ``regex`` differ are found
once, on the driver, and go to the workers with the pattern.

Edge cases.  Null and empty texts have 0 bytes and 0 tokens.  Rows with null or
repeated ids are counted like others; only the id and text columns are read; an
empty table gives an empty result.  A text of one very long pre-token takes
memory in proportion to its length.  Files with a normaliser, a prefix space,
another pre-tokeniser, or options of the merges (dropout, affixes, byte
fallback) are refused, and so are special strings that strip their surroundings.
"""

from __future__ import annotations

import heapq
import json
import re
from functools import lru_cache
from itertools import chain

import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from . import tokens as tk
from .ship import map_arrow

#: Fixed value: the byte-level pre-tokens, by classes of letters, numbers and white space.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?{L}+| ?{N}+| ?[^{S}{l}{n}]+|{S}+(?!{NS})|{S}+"
ASCII = re.compile(PATTERN.format(L="[A-Za-z]", l="A-Za-z", N="[0-9]", n="0-9", S=r"\s", NS=r"\S"), re.ASCII)
#: Pre-tokens of up to so many characters are remembered.
SHORT = 48
#: Remembered pre-tokens of a worker: at most twice this many.
REMEMBERED = 200_000
LIMIT = 512


def byte_names() -> list[str]:
    """The character by which byte-level vocabularies write each byte: itself if printable, else the next from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = iter(range(256, 512))
    return [chr(b if b in shown else next(hidden)) for b in range(256)]


def odd_characters(cut) -> str:
    """Code points that ``regex`` takes for a letter, number, space or other, and the library for another of these."""
    classes = {"a": regex.compile(r"\p{L}"), "1": regex.compile(r"\p{N}"), "\n": regex.compile(r"\s")}
    odd = []
    for c in map(chr, chain(range(0xD800), range(0xE000, 0x110000))):
        kind = next((k for k, p in classes.items() if p.match(c)), "!")
        # beyond the older planes only what ``regex`` knows: its tables are the newer
        if (kind != "!" or c < "\u3400") and len(cut(kind + c)) != 1:
            odd.append(c)
    return "".join(odd)


def as_set(characters) -> str:
    """Ranges of a character class, for ascending characters."""
    points = [ord(c) for c in characters]
    first = [i for i, p in enumerate(points) if not i or points[i - 1] != p - 1]
    last = [i - 1 for i in first[1:]] + [len(points) - 1]
    return "".join(f"\\U{points[a]:08x}-\\U{points[b]:08x}" for a, b in zip(first, last))


def set_pattern(odd: str, cut) -> regex.Pattern:
    """The pattern for texts that hold any of the ``odd`` characters."""
    own = {k: as_set([c for c in odd if len(cut(k + c)) == 1]) for k in ("a", "1", "\n")}
    letter, number, space = (f"[[{p}--[{as_set(odd)}]]{own[k]}]" for k, p in (("a", r"\p{L}"), ("1", r"\p{N}"), ("\n", r"\s")))
    return regex.compile(PATTERN.format(L=letter, N=number, l=letter, n=number, S=space, NS=f"[^{space}]"), regex.V1)


class Vocabulary:
    """Merge ranks, special strings and patterns of a vocabulary file."""

    def __init__(self, path: str, odd: str | None = None):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            file = json.load(f)
        model, before = file["model"], file["pre_tokenizer"] or {}
        options = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
        if model["type"] != "BPE" or any(model.get(o) for o in options) or file["normalizer"] \
                or before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError("not a plain byte-level BPE vocabulary")
        special = file["added_tokens"]
        if any(t["single_word"] or t["lstrip"] or t["rstrip"] for t in special):
            raise ValueError("special strings that look at their surroundings aren't supported")
        ids = model["vocab"]
        self.wide = max(ids.values()) + 1
        self.first = [ids[c] for c in byte_names()]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {ids[a] * self.wide + ids[b]: rank for rank, (a, b) in enumerate(pairs)}
        self.joined = [ids[a + b] for a, b in pairs]
        names = sorted((t["content"] for t in special), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, names))) if names else None
        cut = Tokenizer.from_file(path).pre_tokenizer.pre_tokenize_str
        self.odd = odd_characters(cut) if odd is None else odd
        self.plain = regex.compile(PATTERN.format(L=r"\p{L}", l=r"\p{L}", N=r"\p{N}", n=r"\p{N}", S=r"\s", NS=r"\S"))
        self.other = set_pattern(self.odd, cut) if self.odd else self.plain
        self.odd_set = frozenset(self.odd)
        self.young, self.old = {}, {}

    def merged(self, data: bytes) -> int:
        """Symbols that the bytes of a pre-token are joined to."""
        n, ranks, wide = len(data), self.ranks, self.wide
        symbol = [self.first[b] for b in data]
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = []
        for i in range(n - 1):
            rank = ranks.get(symbol[i] * wide + symbol[i + 1])
            if rank is not None:
                heap.append(rank * n + i)
        heapq.heapify(heap)
        left = n
        while heap:
            rank, i = divmod(heapq.heappop(heap), n)
            j = after[i]
            # out of date: the place was joined to its left, or holds another pair by now
            if symbol[i] < 0 or j >= n or ranks.get(symbol[i] * wide + symbol[j]) != rank:
                continue
            symbol[i], symbol[j] = self.joined[rank], -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                rank = ranks.get(symbol[i] * wide + symbol[k])
                if rank is not None:
                    heapq.heappush(heap, rank * n + i)
            h = before[i]
            if h >= 0:
                rank = ranks.get(symbol[h] * wide + symbol[i])
                if rank is not None:
                    heapq.heappush(heap, rank * n + h)
        return left

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of a text without special strings."""
        if text.isascii():
            return ASCII.findall(text)
        return (self.plain if self.odd_set.isdisjoint(set(text)) else self.other).findall(text)

    def pieces(self, text: str) -> tuple[list[str], int]:
        """The pre-tokens of a text, and the number of its special strings."""
        if self.special is None or not self.special.search(text):
            return self.cut(text), 0
        parts = self.special.split(text)
        return [x for part in parts for x in self.cut(part)], len(parts) - 1

    def counts(self, texts: list[str | None]) -> list[int]:
        """Tokens of each text."""
        cut = [self.pieces(t) if t else ([], 0) for t in texts]
        wanted = set().union(*(pieces for pieces, _ in cut))
        known = {k: n for k in wanted if (n := self.young.get(k) or self.old.get(k))}
        for k in wanted - known.keys():
            known[k] = self.merged(k.encode())
        fresh = {k: n for k, n in known.items() if len(k) <= SHORT and k not in self.young}
        if len(self.young) + len(fresh) > REMEMBERED:
            self.old, self.young = self.young, {}
        self.young.update(fresh)
        return [sum(map(known.__getitem__, pieces)) + special for pieces, special in cut]


@lru_cache(maxsize=4)
def vocabulary(path: str, odd: str | None = None) -> Vocabulary:
    """The vocabulary of a file, read once in each process."""
    return Vocabulary(path, odd)


def counted(docs: DataFrame, path: str, limit: int = LIMIT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every document.

    ``path`` is read by the driver and each worker, so every node must have the file.
    """
    odd = vocabulary(path).odd
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    source = docs.select(F.col(id_col).alias("doc_id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("n_bytes", T.LongType()),
                           T.StructField("n_tokens", T.LongType()), T.StructField("over_limit", T.BooleanType())])

    def run(batches):
        from ledgerlens.llm import token_counts as own  # the worker's module keeps its memory between tasks

        known = own.vocabulary(path, odd)
        for part in tk.slices(batches):
            n = known.counts(part.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())], names=schema.names)

    return map_arrow(source, run, schema)
