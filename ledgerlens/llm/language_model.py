"""Language-model scoring by cross-entropy difference.

Two bigram models share one vocabulary: the background model counts every
document of the corpus, the target model every document labelled good.  A
document's score is the mean over its words of target loss minus background
loss, in bits: the lower, the more the text is like the target.

Words are runs of ASCII letters, digits and bytes from 0x80 up, with A-Z
lower-cased.  The vocabulary is the words that the corpus holds at least
``LEAST`` times; a word outside it costs the same under both models.  A word's
probability is its pair's share of the word before (``PAIR_WEIGHT``; not at a
text's start or after a word that the model hasn't met), interpolated with its
own share, add-one smoothed over the vocabulary.

Words and pairs are counted exactly over all rows, by 63 bits of a hash (the
64th tells words from pairs): inside each task, then by Spark's aggregation on
the hash, into a table in the checkpoint folder.  The most frequent of them, at
most ``HEAD``, are collected and broadcast; the documents are dealt into slices
of ``SLICE_BYTES``, whose other words and pairs are joined to the table.  With N words in the corpus a key outside the
head occurs at most about 2.1 N / ``HEAD`` times, so no key is hot in the join.
Pairs that occur once aren't written: a pair of the corpus that the table lacks
has occurred once, in the document being scored.  A bitmap of fixed size
(2^``SIEVE_BITS``) spares most such pairs the join.  So ``scored`` takes the
corpus itself; for other documents, fit with ``others``, which writes all pairs.

Edge cases.  Null and empty texts have no words: n_words 0 and null losses and
score.  Rows with null or repeated ids count and are scored like others.
Without target documents the target model is uniform over the vocabulary.
Labels with null ids or values count for nothing; an id with several labels is
good if one says so.  Only the named columns are read; an empty table gives
an empty result.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from . import tokens as tk
from .scratch import Scratch
from .ship import map_arrow, ship

U = np.uint64
LEAST = 2
PAIR_WEIGHT = 0.5
#: Words and pairs whose counts are broadcast at most (24 bytes each).
HEAD = 1 << 20
#: Bits of the bitmap of what the table holds beyond the head; when it fills up, only more rows go to the join.
SIEVE_BITS = 27
#: Classes of counts for each doubling, by which the head is cut.
STEPS = 16
#: Bits of the smaller of two packed counts (of the target's, which the corpus' includes).
PACKED = 31
#: Bytes of text of a slice (a longer document is a slice of its own).
SLICE_BYTES = 1 << 18
#: Occurrences that a task counts at once.
HELD = 1 << 21
#: Up to so many ids of target documents are broadcast; beyond, documents and labels are joined by shuffle.
BROADCAST_IDS = 1_000_000


def hashed(column) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Keys of each word (odd) and of the pair it ends (even; 0 at a text's start), text numbers, word offsets."""
    data, offsets = tk.text_buffer(column)
    _, _, doc, h, at = tk.words(data, offsets, tk.ALNUM, tk.FOLDED)
    pair = np.zeros(len(h), U)
    if len(h) > 1:
        pair[1:] = tk.mix(h[:-1] * U(0x9E3779B97F4A7C15) + h[1:]) & ~U(1)
        pair[at[:-1][at[:-1] < len(h)]] = 0
    return (h | U(1)).view(np.int64), pair.view(np.int64), doc, at


def _marked(docs: DataFrame, ids: DataFrame | None, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, and t: whether it is a target document."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    if ids is None:
        return rows.withColumn("t", F.lit(False))
    return rows.join(ids, rows["doc_id"] == ids["id"], "left").select("doc_id", "text", F.coalesce("t", F.lit(False)).alias("t"))


def _ids(target: DataFrame, id_col: str) -> DataFrame:
    ids = target.select(F.col(id_col).alias("id")).where("id is not null").distinct().withColumn("t", F.lit(True))
    return F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids.hint("shuffle_hash")


def _counts(rows: DataFrame) -> DataFrame:
    """(key, b, t): how often the corpus and the target documents hold each word and pair."""
    schema = T.StructType([T.StructField(c, T.LongType()) for c in ("key", "b", "t")])

    def counted(held):
        every, chosen = (np.concatenate(x) for x in zip(*held))
        keys, b = np.unique(every, return_counts=True)
        some, n = np.unique(chosen, return_counts=True)
        t = np.zeros(len(keys), np.int64)
        t[np.searchsorted(keys, some)] = n
        for i in range(0, len(keys), 1 << 18):
            j = slice(i, i + (1 << 18))
            yield pa.RecordBatch.from_arrays([pa.array(keys[j]), pa.array(b[j]), pa.array(t[j])], names=schema.names)

    def run(batches):
        held, size = [], 0
        for part in tk.slices(batches):
            word, pair, doc, _ = hashed(part.column(0))
            good = part.column(1).to_numpy(zero_copy_only=False)[doc]
            held.append((np.concatenate([word, pair[pair != 0]]), np.concatenate([word[good], pair[good & (pair != 0)]])))
            size += len(held[-1][0])
            if size >= HELD:
                yield from counted(held)
                held, size = [], 0
        if size:
            yield from counted(held)

    # a task's keys hardly repeat: they are summed after the shuffle, not before it as well
    return map_arrow(rows.select("text", "t"), run, schema).repartition("key").groupBy("key").agg(F.sum("b").alias("b"), F.sum("t").alias("t"))


def fit(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", others: bool = False) -> dict:
    """Both models: the written table of counts, its head as arrays ordered by key, and the words' totals."""
    spark, ids = docs.sparkSession, _ids(target, id_col)
    word = F.col("key").bitwiseAND(1) == 1
    kept = F.lit(True) if others else word | (F.col("b") > 1)
    scratch = Scratch(spark, "language-model")
    counts = scratch.write(_counts(_marked(docs, ids, id_col, text_col)).where(kept), "counts")
    step = F.floor(F.log2("b") * STEPS)
    b, t, kinds = counts.where(word).agg(F.sum("b"), F.sum("t"), F.count_if(F.col("b") >= LEAST)).first()
    cut, size = 64 * STEPS, 0
    for r in sorted(counts.groupBy(step.alias("s")).count().collect(), reverse=True):
        size += r["count"]
        if size > HEAD:
            break
        cut = r["s"]
    head = counts.where(step >= cut).toArrow()
    head = [head.column(c).to_numpy() for c in ("key", "b", "t")]
    order = np.argsort(head[0])
    tail = counts.where(step < cut)
    bit = F.shiftrightunsigned("key", 64 - SIEVE_BITS)
    marks = tail.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), bit.bitwiseAND(63).cast("int"))).alias("bits")).toArrow()
    sieve = np.zeros(1 << SIEVE_BITS - 6, np.int64)
    sieve[marks.column("at").to_numpy()] = marks.column("bits").to_numpy()
    head = [np.ascontiguousarray(x[order]) for x in head]
    return {"tail": tail, "sieve": sieve.view(U), "head": head, "places": tk.Places(head[0]), "total": (b or 0, t or 0), "kinds": kinds,
            "ids": None if others else ids, "counts": counts, "scratch": scratch}


def _at(keys: np.ndarray, sought: np.ndarray) -> np.ndarray:
    """Where ``sought`` stand among the ordered ``keys``; -1: nowhere."""
    if not len(keys):
        return np.full(len(sought), -1)
    at = np.minimum(np.searchsorted(keys, sought), len(keys) - 1)
    return np.where(keys[at] == sought, at, -1)


def _sifted(sieve: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """False where the table holds no such key beyond the head."""
    bit = keys.view(U) >> U(64 - SIEVE_BITS)
    return (sieve[bit >> U(6)] >> (bit & U(63)) & U(1)).astype(bool)


def losses(model: dict, column, keys: np.ndarray, packed: np.ndarray, own: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
    """Number of words, and each model's mean loss in bits (rows: target, background), of each text.

    keys, packed: those of the texts' words and pairs that the table holds beyond the head, and their packed counts.
    own: whether each text is a target document, if the texts are of the corpus.
    """
    word, pair, doc, at = hashed(column)
    n = np.diff(at)
    order = np.argsort(keys)
    tail, packed = keys[order], packed[order]
    counts = [[model["head"][1], packed >> PACKED], [model["head"][2], packed & ((1 << PACKED) - 1)]]

    def looked_up(keys):
        out = np.zeros((2, len(keys)))
        if own is not None:  # what the table lacks has occurred once, here
            out[0], out[1] = 1, own[doc]
        place = model["places"].find(keys)
        hit = place >= 0
        rest = np.flatnonzero(~hit)
        late = _at(tail, keys[rest])
        late, rest = late[late >= 0], rest[late >= 0]
        place = place[hit]
        for k in (0, 1):
            out[k, hit] = counts[k][0][place]
            out[k, rest] = counts[k][1][late]
        return out

    single, pairs = looked_up(word), looked_up(pair)
    out = []
    for which in (1, 0):
        p = (single[which] + 1) / (model["total"][which] + model["kinds"] + 1)
        met = np.where(pair != 0, np.concatenate([[0], single[which][:-1]]) if len(word) else 0, 0)
        p = np.where(met > 0, PAIR_WEIGHT * pairs[which] / np.maximum(met, 1) + (1 - PAIR_WEIGHT) * p, p)
        p = np.where(single[0] >= LEAST, p, 1 / (model["kinds"] + 1))
        out.append(np.bincount(doc, weights=-np.log2(p), minlength=len(n)) / np.maximum(n, 1))
    return n, np.stack(out)


def _slices(rows: DataFrame) -> DataFrame:
    """One row for each slice of up to ``SLICE_BYTES`` of text (or one document): its number, ids, texts and t."""
    schema = T.StructType([T.StructField("slice", T.LongType()), T.StructField("ids", T.ArrayType(rows.schema["doc_id"].dataType)),
                           T.StructField("texts", T.ArrayType(T.StringType())), T.StructField("marks", T.ArrayType(T.BooleanType()))])

    def run(batches):
        number = TaskContext.get().partitionId() << 33
        for part in tk.slices(batches, limit=SLICE_BYTES):
            whole = pa.array([0, part.num_rows], pa.int32())
            lists = [pa.ListArray.from_arrays(whole, part.column(part.schema.get_field_index(c))) for c in ("doc_id", "text", "t")]
            yield pa.RecordBatch.from_arrays([pa.array([number]), *lists], names=schema.names)
            number += 1

    return map_arrow(rows, run, schema)


def scored(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", last: bool = False) -> DataFrame:
    """doc_id, n_words, target_loss, background_loss, score of every document.

    The documents are written in numbered slices; a slice asks once for each
    of its keys, and the answers are written, too.  Each table's shuffles end
    with it.  ``last``: the model is of no more use, so its counts are deleted
    before the texts are shuffled to their counts.
    """
    spark, scratch = docs.sparkSession, model["scratch"]
    # written, so that each slice keeps its number
    slices = scratch.write(_slices(_marked(docs, model["ids"], id_col, text_col)), "slices")
    corpus = model["ids"] is not None
    ship(spark)
    sent = spark.sparkContext.broadcast({k: v for k, v in model.items() if k in ("sieve", "head", "places", "total", "kinds")})
    wanted = T.StructType([T.StructField("slice", T.LongType()), T.StructField("key", T.LongType())])

    def seek(batches):
        places = sent.value["places"]
        for batch in batches:
            for i in range(batch.num_rows):
                word, pair, _, _ = hashed(batch.column(1).slice(i, 1).flatten())
                keys = np.concatenate([word, pair[pair != 0]])
                keys = keys[_sifted(sent.value["sieve"], keys)]
                keys = np.unique(keys[places.find(keys) < 0])
                number = np.full(len(keys), batch.column(0)[i].as_py())
                for k in range(0, len(keys), 1 << 18):
                    j = slice(k, k + (1 << 18))
                    yield pa.RecordBatch.from_arrays([pa.array(number[j], pa.int64()), pa.array(keys[j], pa.int64())], names=wanted.names)

    # keys beyond the head occur at most about 2.1 N / HEAD times, so that both counts fit one number
    packed = model["tail"].select("key", (F.shiftleft("b", PACKED) + F.col("t")).alias("n"))
    answers = scratch.write(map_arrow(slices.select("slice", "texts"), seek, wanted).join(packed, "key").select("slice", "key", "n"), "answers")
    if last:
        scratch.drop(model["counts"])
    # both lists of a slice are in one order: they take the same rows one by one
    found = answers.groupBy("slice").agg(F.collect_list("key").alias("keys"), F.collect_list("n").alias("counts"))
    schema = T.StructType([T.StructField("doc_id", slices.schema["ids"].dataType.elementType), T.StructField("n_words", T.LongType()),
                           *(T.StructField(c, T.DoubleType()) for c in ("target_loss", "background_loss", "score"))])

    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                ids, texts, marks, keys, counts = (batch.column(c).slice(i, 1).flatten() for c in range(5))
                n, (t, b) = losses(sent.value, texts, keys.to_numpy(), counts.to_numpy(), marks.to_numpy(zero_copy_only=False) if corpus else None)
                none = n == 0
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(n.astype(np.int64)), pa.array(t, mask=none), pa.array(b, mask=none), pa.array(t - b, mask=none)],
                    names=schema.names)

    return map_arrow(slices.join(found, "slice", "left").select("ids", "texts", "marks", "keys", "counts"), run, schema)
