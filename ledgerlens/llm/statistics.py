"""Counts and shares of whole texts, vectorised over a slice of rows."""

from __future__ import annotations

import numpy as np

from . import tokens as tk

U = np.uint64
CONTINUATION = np.zeros(256, bool)
CONTINUATION[0x80:0xC0] = True


def _class(chars: bytes) -> np.ndarray:
    table = np.zeros(256, bool)
    table[list(chars)] = True
    return table


SYMBOLS = _class(b"#*$%&|<>")
UPPER = _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")
LETTER = _class(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz") | (np.arange(256) >= 0x80)
DIGIT = _class(b"0123456789")
BANG = _class(b"!?")
BAR = _class(b"|")
STOP = _class(b".!?")
PUNCT = _class(b",.;:!?\"'()-")
LINE = np.ones(256, bool)
LINE[10] = False

#: What ``shares`` gives of each text, in this order.
SHARES = ("log_words", "word_length", "symbols", "bars", "bangs", "upper", "digits", "punctuation", "dup_lines",
          "repeated", "distinct", "common_word", "line_words", "letters", "stop_lines", "short_words")


def _per_text(flags: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def counts(column) -> dict[str, np.ndarray]:
    """Exact counts of each text.

    n_words (runs of other than ASCII white space), word_chars (code points in
    words), n_symbols (characters of #*$%&|<>), n_dup_lines (lines with a word
    that equal an earlier line), n_repeat_words (words in three-word windows
    that the text holds twice or more), and more for ``shares``.
    """
    data, offsets = tk.text_buffer(column)
    n = len(offsets) - 1
    starts, ends, doc, h, at = tk.words(data, offsets)
    out = {"n_words": np.diff(at), "n_symbols": _per_text(SYMBOLS[data], offsets)}
    out["word_chars"] = _per_text(tk.NOT_SPACE[data] & ~CONTINUATION[data], offsets)
    for name, table in (("upper", UPPER), ("letters", LETTER & ~CONTINUATION), ("digits", DIGIT), ("bangs", BANG), ("bars", BAR), ("punct", PUNCT)):
        out[name] = _per_text(table[data], offsets)

    s, e, line_doc = tk.runs(data, offsets, LINE)
    worded = np.zeros(len(data) + 1, np.int64)
    np.cumsum(tk.NOT_SPACE[data], out=worded[1:])
    full = worded[e] > worded[s]
    s, e, line_doc = s[full], e[full], line_doc[full]
    out["lines"] = np.bincount(line_doc, minlength=n)
    different = tk.counted(line_doc, tk.span_hashes(data, s, e))[0]
    out["n_dup_lines"] = out["lines"] - np.bincount(different, minlength=n)
    out["stop_lines"] = np.bincount(line_doc, weights=STOP[data[e - 1]] if len(e) else None, minlength=n).astype(np.int64)

    w = tk.windows(h, 3)
    own = np.flatnonzero(at[doc[:len(w)] + 1] - np.arange(len(w)) >= 3)
    order = own[np.lexsort((w[own], doc[own]))]
    same = (w[order[1:]] == w[order[:-1]]) & (doc[order[1:]] == doc[order[:-1]])
    twice = np.zeros(len(order), bool)
    twice[1:] |= same
    twice[:-1] |= same
    covered = np.zeros(len(h), bool)
    for k in range(3):
        covered[order[twice] + k] = True
    out["n_repeat_words"] = np.bincount(doc[covered], minlength=n)

    d, _, c = tk.counted(doc, h)
    out["distinct"] = np.bincount(d, minlength=n)
    out["common"] = np.zeros(n, np.int64)
    np.maximum.at(out["common"], d, c)
    out["short"] = np.bincount(doc[ends - starts <= 3], minlength=n)
    return out


def shares(c: dict[str, np.ndarray]) -> np.ndarray:
    """SHARES of each text (rows), from its counts; zeros for texts without words."""
    words, chars, lines = (np.maximum(c[k], 1).astype(float) for k in ("n_words", "word_chars", "lines"))
    return np.stack([
        np.log1p(c["n_words"]), c["word_chars"] / words, c["n_symbols"] / words, c["bars"] / words, c["bangs"] / words,
        c["upper"] / np.maximum(c["letters"], 1), c["digits"] / chars, c["punct"] / chars, c["n_dup_lines"] / lines,
        c["n_repeat_words"] / words, c["distinct"] / words, c["common"] / words, c["n_words"] / lines, c["letters"] / chars,
        c["stop_lines"] / lines, c["short"] / words], 1)
