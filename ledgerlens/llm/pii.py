"""Personal data: fixed patterns, widened by a skip-chain conditional random field.

Base spans come from four patterns (email, ip, card, phone) over the whole
text.  The field then labels a text's candidate tokens, the words that hold a
digit or an @ (other words can't be labelled).  Potentials: each token's shape
features; chain edges between candidates that are neighbouring words; and skip
edges between candidates that recur anywhere in the text, equal or similar
(the same digits, or the same letters and digits whatever the case and
punctuation).  Each occurrence is tied to the one before it, and each outside
base spans also to the nearest one inside a base span on either side, however
far away: of all pairs of occurrences these carry the evidence, at a cost
linear in their number.  Tokens inside base spans are evidence; loopy message
passing carries it to the others until no message moves by ``STILL`` (messages
that rest cost nothing; ``ROUNDS`` ends what circles without settling), and
tokens with a label's marginal of at least ``MARGINAL`` become added spans
where they touch no base span.

The weights are learnt by pseudo-likelihood from base spans of a bounded
sample of documents (about ``SAMPLE_DOCS``, at most ``SAMPLE_TOKENS`` tokens,
in one task); half of the training copies have features masked, so that the
model learns to trust neighbours and repetitions.  Skip weights are drawn
towards agreement (``SKIP_PRIOR``).

Edge cases.  Null and empty texts have no spans.  Offsets count code points,
ends exclusive.  Rows with null or repeated ids are read like others; only
the id and text columns are used (``redacted`` keeps all columns).  Empty
tables give empty results.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from . import tokens as tk
from .labelled import plain_sample
from .ship import map_arrow

KINDS = ("email", "ip", "card", "phone")
LABELS = 1 + len(KINDS)  # 0: none
SAMPLE_DOCS, SAMPLE_TOKENS = 4000, 200_000
MARGINAL = 0.7
SKIP_PRIOR, CHAIN_PRIOR = 2.0, 0.0
STILL, ROUNDS = 1e-7, 1000

# Fixed patterns.  The look-behind and the possessive repeats match the same spans as plain
# repeats would, in linear time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_ANY = re.compile(r"[0-9@]")
_WORD = re.compile(r"[^ \t-\r]+")
#: Words before a token that name a kind of data.
CUES = (("email", "mail", "e-mail"), ("ip", "host", "server"), ("card", "visa", "credit"), ("phone", "tel", "call", "mobile"))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d if d < 5 else 2 * d - 9)
    return total % 10 == 0


def _small(part: str) -> bool:
    part = part.lstrip("0")
    return len(part) < 3 or len(part) == 3 and int(part) <= 255


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind number, start, end) of the fixed patterns, by kind and start."""
    out = []
    at, from_ = text.find("@"), 0
    while at >= 0:
        start = at
        while start > from_ and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            out.append((0, start, m.end()))
            from_ = m.end()
        at = text.find("@", max(at + 1, from_))
    for m in _IP.finditer(text):
        if all(map(_small, m.group().split("."))):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if 13 <= m.end() - m.start():
            digits = m.group().replace(" ", "").replace("-", "")
            if 13 <= len(digits) <= 19 and luhn(digits):
                out.append((2, *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= sum("0" <= c <= "9" for c in m.group()) <= 15:
            out.append((3, *m.span()))
    return out


# -- the field -----------------------------------------------------------------

_TRIM = ".,;:!?\"'[]<>{}"
FEATURES = 34


def _shape(core: str, before: str) -> tuple[np.ndarray, str]:
    """Features of a token and its key for skip edges ("" if it has none)."""
    x = np.zeros(FEATURES, np.float32)
    digits = "".join(c for c in core if "0" <= c <= "9")
    letters = sum(c.isalpha() for c in core)
    n = len(digits)
    x[0] = 1
    x[1 + (0 if n == 0 else 1 if n < 3 else 2 if n == 3 else 3 if n < 7 else 4 if n == 7 else 5 if n < 13 else 6 if n < 20 else 7)] = 1
    dots = core.count(".")
    x[9 + min(dots, 4)] = 1
    x[14] = "@" in core
    x[15] = letters > 0
    x[16] = letters > 0 and n > 0 and "@" not in core
    x[17] = core[:1] == "+"
    x[18] = core[:1] == "("
    x[19] = core[-1:] == ")"
    x[20] = "-" in core
    x[21] = 13 <= n <= 19 and letters == 0 and luhn(digits)
    x[22] = 13 <= n <= 19 and not x[21]
    x[23] = bool(_IP.fullmatch(core)) and all(map(_small, core.split(".")))
    x[24] = dots == 3 and not x[23]
    x[25] = "=" in core or "_" in core
    x[26] = bool(re.search(r"@[^@]*\.[^@]", core))
    x[27] = letters == 0 and n == len(core)
    x[28] = core[:1] == "+" and n <= 3
    for k, words in enumerate(CUES):
        x[29 + k] = before in words
    x[33] = "/" in core
    key = "".join(c for c in core.lower() if c.isalnum())
    return x, (digits if letters == 0 and n >= 7 else key if len(key) >= 6 and letters else "")


def candidates(text: str, spans: list[tuple[int, int, int]]):
    """Tokens (start, end, word number), features, keys, base labels of one text."""
    tokens, shapes, keys = [], [], []
    before = ""
    for number, m in enumerate(_WORD.finditer(text)):
        word = m.group()
        if _ANY.search(word):
            core = word.strip(_TRIM) or word
            start = m.start() + word.index(core)
            x, key = _shape(core, before.lower().strip(_TRIM))
            tokens.append((start, start + len(core), number))
            shapes.append(x)
            keys.append(key)
        before = word
    labels = np.zeros(len(tokens), np.int64)
    starts = np.array([t[0] for t in tokens])
    ends = np.array([t[1] for t in tokens])
    for kind, s, e in spans:
        a, b = np.searchsorted(ends, s, "right"), np.searchsorted(starts, e, "left")
        labels[a:b] = kind + 1
    return tokens, shapes, keys, labels


class Graph:
    """Candidate tokens of many texts with their chain and skip edges."""

    def __init__(self):
        self.tokens, self.shapes, self.labels, self.text = [], [], [], []
        self.chain, self.skip = [], []
        self.far = []  # skip edges to evidence beyond the neighbouring occurrences; training must not see labels by them

    def add(self, number: int, text: str, spans) -> None:
        tokens, shapes, keys, labels = candidates(text, spans)
        first, last = len(self.tokens), {}
        for i, (token, key) in enumerate(zip(tokens, keys)):
            if i and tokens[i - 1][2] + 1 == token[2]:
                self.chain.append((first + i - 1, first + i))
            if key:
                if key in last:
                    self.skip.append((last[key], first + i))
                last[key] = first + i
        forward = range(len(tokens))
        for order in (forward, reversed(forward)):
            near, evidence = {}, {}
            for i in order:
                if key := keys[i]:
                    if labels[i]:
                        evidence[key] = i
                    elif key in evidence and evidence[key] != near[key]:
                        self.far.append((first + evidence[key], first + i))
                    near[key] = i
        self.tokens += tokens
        self.shapes += shapes
        self.labels += labels.tolist()
        self.text += [number] * len(tokens)

    def arrays(self):
        x = np.stack(self.shapes) if self.shapes else np.zeros((0, FEATURES), np.float32)
        edges = [np.array(e, np.int64).reshape(-1, 2) for e in (self.chain, self.skip)]
        return x, np.array(self.labels, np.int64), *edges


def train(x: np.ndarray, y: np.ndarray, chain: np.ndarray, skip: np.ndarray, steps: int = 150) -> dict:
    """Weights by pseudo-likelihood: each token's label given its features and its neighbours' labels."""
    eye = np.eye(LABELS)
    unary = np.zeros((FEATURES, LABELS))
    links = np.zeros((LABELS, LABELS))
    same = SKIP_PRIOR * eye
    if not len(y):
        unary[0, 0] = 2.0
        return {"unary": unary, "chain": links, "skip": same}
    n = len(y)
    hot = eye[y]
    left, right, other = np.zeros((n, LABELS)), np.zeros((n, LABELS)), np.zeros((n, LABELS))
    np.add.at(left, chain[:, 1], hot[chain[:, 0]])
    np.add.at(right, chain[:, 0], hot[chain[:, 1]])
    np.add.at(other, skip[:, 1], hot[skip[:, 0]])
    np.add.at(other, skip[:, 0], hot[skip[:, 1]])
    mask = np.random.default_rng(1).random((n, FEATURES)) < 0.5
    mask[:, 0] = True
    xs = np.concatenate([x, x * mask]).astype(np.float64)
    double = lambda a: np.concatenate([a, a])
    left, right, other, hot = map(double, (left, right, other, hot))
    prior, params = [0.0, CHAIN_PRIOR * eye, same.copy()], [unary, links, same]
    square = [np.zeros_like(p) for p in params]
    for _ in range(steps):
        score = xs @ unary + left @ links + right @ links.T + other @ same
        score -= score.max(1, keepdims=True)
        p = np.exp(score)
        g = (p / p.sum(1, keepdims=True) - hot) / len(hot)
        grads = [xs.T @ g, left.T @ g + g.T @ right, (other.T @ g + g.T @ other) / 2]
        for k, (param, grad) in enumerate(zip(params, grads)):
            grad = grad + (1e-4 if k == 0 else 1e-3) * (param - prior[k])
            square[k] += grad * grad
            param -= 0.5 * grad / (np.sqrt(square[k]) + 1e-8)
    return {"unary": unary, "chain": links, "skip": same}


def marginals(model: dict, x: np.ndarray, y: np.ndarray, chain: np.ndarray, skip: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Label probabilities of each token by loopy message passing; tokens with a base label are evidence."""
    unary = x.astype(np.float64) @ model["unary"]
    seen = y > 0
    unary[seen] = np.where(np.eye(LABELS, dtype=bool)[y[seen]], 0.0, -50.0)
    # each edge both ways: messages from a to b
    a = np.concatenate([chain[:, 0], chain[:, 1], skip[:, 0], skip[:, 1]])
    b = np.concatenate([chain[:, 1], chain[:, 0], skip[:, 1], skip[:, 0]])
    table = np.concatenate([np.broadcast_to(t, (len(e), LABELS, LABELS)) for t, e in (
        (model["chain"], chain), (model["chain"].T, chain), (model["skip"], skip), (model["skip"].T, skip))])
    nc, ns = len(chain), len(skip)
    back = np.concatenate([np.arange(nc) + nc, np.arange(nc), np.arange(ns) + 2 * nc + ns, np.arange(ns) + 2 * nc])
    message = np.zeros((len(a), LABELS))
    total = unary.copy()
    live = np.arange(len(a))
    for _ in range(rounds):
        if not len(live):
            break
        held = (total[a[live]] - message[back[live]])[:, :, None] + table[live]
        top = held.max(1)
        new = top + np.log(np.exp(held - top[:, None, :]).sum(1))
        new -= new.max(1, keepdims=True)
        step = 0.7 * (new - message[live])
        message[live] += step
        np.add.at(total, b[live], step)
        moved = np.zeros(len(a), bool)
        moved[live] = np.abs(step).max(1) > STILL
        touched = np.zeros(len(total), bool)
        touched[b[moved]] = True
        # a message depends on what its source hears from others than its target
        live = np.flatnonzero(touched[a] | moved)
    p = np.exp(total - total.max(1, keepdims=True))
    return p / p.sum(1, keepdims=True)


def spans_of(texts: list[str | None], model: dict) -> list[tuple[list, list]]:
    """(base spans, all spans) of each text, each by kind and start."""
    base = [base_spans(t) if t and _ANY.search(t) else [] for t in texts]
    graph = Graph()
    for i, t in enumerate(texts):
        if t and _ANY.search(t):
            graph.add(i, t, base[i])
    every = [list(b) for b in base]
    if graph.tokens:
        x, y, chain, skip = graph.arrays()
        p = marginals(model, x, y, chain, np.concatenate([skip, np.array(graph.far, np.int64).reshape(-1, 2)]))
        label = p.argmax(1)
        new = (y == 0) & (label > 0) & (p[np.arange(len(p)), label] >= MARGINAL)
        last = None  # (text, word, kind, position in every)
        for i in np.flatnonzero(new).tolist():
            (start, end, word), number, kind = graph.tokens[i], graph.text[i], int(label[i]) - 1
            if last and last[:3] == (number, word - 1, kind):
                s = every[number][last[3]]
                every[number][last[3]] = (kind, s[1], end)
                last = (number, word, kind, last[3])
            else:
                every[number].append((kind, start, end))
                last = (number, word, kind, len(every[number]) - 1)
    return [(b, sorted(e)) for b, e in zip(base, every)]


# -- Spark -----------------------------------------------------------------------

def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", sample_docs: int = SAMPLE_DOCS) -> dict:
    """Weights of the field, learnt from base spans of a bounded sample of documents."""
    picked = plain_sample(docs, sample_docs, id_col, text_col, F.col("text").rlike("[0-9@]"))
    schema = T.StructType([T.StructField("w", T.ArrayType(T.DoubleType()))])

    def run(batches):
        rows = [r for batch in batches for r in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
        graph = Graph()
        for i, (_, text) in enumerate(sorted(rows)):
            if len(graph.tokens) < SAMPLE_TOKENS:
                graph.add(i, text, base_spans(text))
        model = train(*graph.arrays())
        flat = np.concatenate([model[k].ravel() for k in ("unary", "chain", "skip")])
        yield pa.RecordBatch.from_pylist([{"w": flat.tolist()}], schema=pa.schema([("w", pa.list_(pa.float64()))]))

    # one task, of at most sample_docs texts that hold a digit or an @
    row = map_arrow(picked.repartition(1), run, schema).first()
    if row is None:
        return train(*Graph().arrays())
    w = np.array(row.w)
    cut = FEATURES * LABELS, FEATURES * LABELS + LABELS * LABELS
    return {"unary": w[:cut[0]].reshape(FEATURES, LABELS), "chain": w[cut[0]:cut[1]].reshape(LABELS, LABELS),
            "skip": w[cut[1]:].reshape(LABELS, LABELS)}


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for k, s, e in spans)


def found(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone and base_sha256 of the base spans, and spans (all of them)."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([source.schema["doc_id"], *(T.StructField(f"n_{k}", T.LongType()) for k in KINDS),
                           T.StructField("base_sha256", T.StringType()), T.StructField("spans", T.StringType())])

    def run(batches):
        for part in tk.slices(batches):
            got = spans_of(part.column(1).to_pylist(), model)
            counts = [pa.array([sum(s[0] == k for s in b) for b, _ in got], pa.int64()) for k in range(len(KINDS))]
            digest = pa.array([hashlib.sha256(_joined(b).encode()).hexdigest() for b, _ in got], pa.string())
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *counts, digest, pa.array([_joined(e) for _, e in got], pa.string())], names=schema.names)

    return map_arrow(source, run, schema)


def redact(text: str, spans) -> str:
    """The text with every span, or run of overlapping spans, replaced by its first kind in brackets."""
    out, at = [], 0
    for s, e, k in sorted((s, e, k) for k, s, e in spans):
        if s >= at:
            out += [text[at:s], f"[{KINDS[k].upper()}]"]
        at = max(at, e)
    return "".join([*out, text[at:]])


def redacted(docs: DataFrame, model: dict, text_col: str = "text", length_col: str | None = "n_chars") -> DataFrame:
    """All documents and columns, the text without personal data and ``length_col`` (if there is one) in step with it."""
    at = docs.columns.index(text_col)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])

    def run(batches):
        for part in tk.slices(batches, (f"c{at}",)):
            texts = part.column(at).to_pylist()
            if any(t and _ANY.search(t) for t in texts):
                texts = [redact(t, e) if e else t for t, (_, e) in zip(texts, spans_of(texts, model))]
                part = part.set_column(at, f"c{at}", pa.array(texts, part.column(at).type))
            yield part

    out = map_arrow(plain, run, plain.schema).toDF(*docs.columns)
    if length_col in docs.columns and docs.columns.count(length_col) == 1:
        out = out.withColumn(length_col, F.char_length(text_col).cast(docs.schema[length_col].dataType))
    return out
