"""Near-duplicate documents by DartMinHash signatures and banded joining.

A document is the weighted set of its five-word shingles (weight: how often a
shingle occurs).  Darts, numbered by hashes, fall on each element's plane of
weight x rank as a Poisson process of unit intensity; a set keeps the darts
inside its elements' weights, and the earliest dart of each coordinate is its
signature.  Two sets agree in a coordinate with a probability of their
weighted Jaccard similarity, sum(min) / sum(max).  Signature coordinates are
joined in bands; every pair that a band proposes is settled exactly on whole
texts, and classes are the connected components of the pairs at or above the
threshold.

Edge cases.  Words are runs of bytes other than ASCII white space.  A text of
one to four words has a single shingle.  Texts with the same words are copies.
Null and empty texts (and texts of white space) belong to no class but their
own row's: class_id is the row's own doc_id and class_size 1.  Null doc_ids
are ignored by the minimum that names a class; a class of null doc_ids only
has a null class_id.  Repeated rows are copies of each other.  Only the id and
text columns are read, so other columns may have any names.  An empty table
gives an empty result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from . import tokens as tk
from .components import components
from .scratch import Scratch
from .ship import map_arrow

U = np.uint64
SHINGLE = 5
SIMILARITY = 0.8
#: 0.8 ** 6 = 0.262; 40 bands miss a pair at 0.8 with probability 5e-6.
BANDS, ROWS = 40, 6
#: Share of the rows from which on a class is joined by broadcast.
HEAVY = 0.001
_CELLS = 1 << 20
#: Cumulative Poisson(1) probabilities of 0, 1, 2, ... darts in a unit cell.
_POISSON = np.cumsum([math.exp(-1) / math.factorial(i) for i in range(20)])


def _unit(x: np.ndarray) -> np.ndarray:
    return (x >> U(11)).astype(np.float64) * 2.0**-53


def _darts(elem, weight, theta, owner, k):
    """Darts of each element with rank below its owner's theta: (owner, coordinate, rank, dart)."""
    rows = np.ceil(weight).astype(np.int64)
    cols = np.ceil(theta).astype(np.int64)
    cells = rows * cols
    at = np.repeat(np.arange(len(elem)), cells)
    inner = np.arange(len(at)) - np.repeat(np.cumsum(cells) - cells, cells)
    across = inner // cols[at]
    along = inner - across * cols[at]
    cell = tk.mix(elem[at] ^ tk.mix((across.astype(U) << U(32)) + along.astype(U) + U(1)))
    hit = np.searchsorted(_POISSON, _unit(cell), "right")
    i = np.repeat(np.arange(len(at)), hit)
    nth = np.arange(len(i)) - np.repeat(np.cumsum(hit) - hit, hit)
    dart = tk.mix(cell[i] + (nth.astype(U) + U(1)) * U(0xD1B54A32D192ED03))
    rank = along[i] + _unit(dart)
    keep = rank < theta[at[i]]
    if not np.array_equal(rows, weight):  # a cell's upper part may lie above the weight
        keep &= across[i] + _unit(tk.mix(dart ^ U(0x5851F42D4C957F2D))) < weight[at[i]]
    dart, rank, who = dart[keep], rank[keep], owner[at[i[keep]]]
    return who, (tk.mix(dart ^ U(0x2545F4914F6CDD1D)) % U(k)).astype(np.int64), rank, dart


def dart_signatures(doc, elem, weight, n_docs: int, k: int) -> np.ndarray:
    """k darts for each weighted set; ``doc`` ascending, ``elem`` distinct hashes, ``weight`` > 0.

    Sets without elements get zeros.  Expected work is the set's total weight
    plus k ln k, whatever the weights.
    """
    best = np.full(n_docs * k, np.inf)
    out = np.zeros(n_docs * k, U)
    total = np.bincount(doc, weights=weight, minlength=n_docs)
    darts = k * math.log(k) + 2 * k
    todo = total > 0
    while todo.any():
        theta = np.where(todo, darts / np.maximum(total, 1e-300), 0)
        pick = np.flatnonzero(todo[doc])
        cells = np.cumsum(np.ceil(weight[pick]) * np.ceil(theta[doc[pick]]))
        i = 0
        while i < len(pick):
            j = max(i + 1, int(np.searchsorted(cells, (cells[i - 1] if i else 0) + _CELLS, "right")))
            own = pick[i:j]
            who, coord, rank, dart = _darts(elem[own], weight[own], theta[doc[own]], doc[own], k)
            slot = who * k + coord
            np.minimum.at(best, slot, rank)
            first = best[slot] == rank
            out[slot[first]] = dart[first]
            i = j
        todo = todo & ~np.isfinite(best).reshape(n_docs, k).all(1)
        darts *= 2
    return out.reshape(n_docs, k)


def shingle_sets(column) -> tuple:
    """Of each text: distinct shingles with counts, and a 16-byte key of its word sequence (None: no words)."""
    data, offsets = tk.text_buffer(column)
    _, _, doc, h, at = tk.words(data, offsets)
    place = (np.arange(len(h)) - at[doc]).astype(U)
    n = len(offsets) - 1
    sums = np.zeros((2, n), U)
    for row, step in zip(sums, (0xA24BAED4963EE407, 0x9FB21C651E98DF25)):
        np.add.at(row, doc, tk.mix(h ^ tk.mix(place * U(step) + U(step))))
    raw = np.ascontiguousarray(sums.T.astype(">u8")).tobytes()
    keys = [raw[16 * i:16 * i + 16] if at[i + 1] > at[i] else None for i in range(n)]
    return *tk.counted(*tk.shingles(h, at, SHINGLE)), keys


def _bands(doc, elem, count, keys, bands: int, rows: int) -> pa.Array:
    """A list of one hash for each band of the sets' signatures."""
    sig = dart_signatures(doc, elem, count.astype(np.float64), len(keys), bands * rows).reshape(len(keys), bands, rows)
    band = np.broadcast_to(tk.mix(np.arange(1, bands + 1, dtype=U)), (len(keys), bands))
    for r in range(rows):
        band = tk.mix(band ^ sig[:, :, r])
    flat = pa.array(np.ascontiguousarray(band).reshape(-1).view(np.int64))
    return pa.ListArray.from_arrays(np.arange(0, len(flat) + 1, bands, dtype=np.int32), flat)


def sketch(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, text_hash, node (key of its words, null without words), bands."""
    source = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"),
                         F.col(text_col).cast("string").alias("text"))
    schema = T.StructType([source.schema["doc_id"], T.StructField("text_hash", T.LongType()),
                           T.StructField("node", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])

    def run(batches):
        for part in tk.slices(batches):
            sets = shingle_sets(part.column(2))
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(sets[3], pa.binary()), _bands(*sets, bands, rows)],
                names=["doc_id", "text_hash", "node", "bands"])

    return map_arrow(source, run, schema)


def _compared(left, right):
    """Of each row's two texts: shared weight, both weights; and what the left has beyond the right: (row, shingle, weight)."""
    n = len(left)
    d1, e1, c1, _ = shingle_sets(left)
    d2, e2, c2, _ = shingle_sets(right)
    doc, elem, count = np.concatenate([d1, d2]), np.concatenate([e1, e2]), np.concatenate([c1, c2])
    own = np.concatenate([np.ones(len(d1), bool), np.zeros(len(d2), bool)])
    order = np.lexsort((~own, elem, doc))
    d, e, c, own = doc[order], elem[order], count[order], own[order]
    same = np.flatnonzero((d[1:] == d[:-1]) & (e[1:] == e[:-1])) if len(d) else np.zeros(0, np.int64)
    shared = np.bincount(d[same], weights=np.minimum(c[same], c[same + 1]), minlength=n)
    beyond = np.where(own, c, 0)
    beyond[same] = np.maximum(0, c[same] - c[same + 1])
    more = beyond > 0
    return shared, np.bincount(d1, weights=c1, minlength=n), np.bincount(d2, weights=c2, minlength=n), d[more], e[more], beyond[more]


def _with_texts(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, lead) with both texts; texts: (node, text)."""
    return (pairs.select("node", "lead").join(texts, "node")
            .join(texts.select(F.col("node").alias("lead"), F.col("text").alias("lead_text")), "lead")
            .select("node", "lead", "text", "lead_text"))


def _settle(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Exact similarity of (node, lead) pairs, with the shared weight and both weights."""
    numbers = ["sim", "shared", "weight", "lead_weight"]
    schema = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("lead", T.BinaryType()),
                           *(T.StructField(n, T.DoubleType()) for n in numbers)])

    def run(batches):
        for part in tk.slices(batches, ("text", "lead_text")):
            shared, w, lw, *_ = _compared(part.column(2), part.column(3))
            columns = [pa.array(x) for x in (shared / np.maximum(w + lw - shared, 1), shared, w, lw)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *columns], names=schema.names)

    return map_arrow(_with_texts(pairs, texts), run, schema)


def _own_shingles(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """(node, lead, shingle, extra) for what each node has beyond its lead; extra: by how much weight."""
    schema = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("lead", T.BinaryType()),
                           T.StructField("shingle", T.LongType()), T.StructField("extra", T.DoubleType())])

    def run(batches):
        for part in tk.slices(batches, ("text", "lead_text")):
            *_, row, elem, extra = _compared(part.column(2), part.column(3))
            row = pa.array(row)
            yield pa.RecordBatch.from_arrays([part.column(0).take(row), part.column(1).take(row), pa.array(elem.view(np.int64)),
                                              pa.array(extra.astype(np.float64))], names=schema.names)

    return map_arrow(_with_texts(pairs, texts), run, schema)


def links(sketched: DataFrame, docs: DataFrame, scratch: Scratch, id_col: str = "doc_id", text_col: str = "text",
          similarity: float = SIMILARITY, few: int = 64, holders: int = 16) -> DataFrame:
    """(u, v) of different texts at or above the threshold: as many as join what is similar, not all pairs.

    In every bucket of a band all members are compared with one lead: the
    member that meets most others in all its buckets, such as the text that
    the others were copied from.  Members that it links need no more links
    among each other.  A member b that it doesn't link may still be near
    another member a; such pairs have the lead in common, and their
    similarities to it differ by at most 1 - similarity (triangle inequality).
    Texts that a chain of found links joins need no more links either.  Around
    a lead with few texts left they are compared in pairs.  Other leads that
    share members form a crowd, and each of its members emits its shingles once,
    those beyond the crowd's centre (the lead with most members).  Let K be the
    centre's shingles and those that more than ``holders`` members hold beyond
    it.  Two members either share a shingle outside K, by which they are joined
    (at most ``holders`` rows each), or what they share lies in K: then it
    weighs at most what either of them has in K.  These weights bound the
    similarity and leave few pairs to settle.  So no link is lost, and rows grow
    with the texts of a crowd, not with its leads or its pairs.
    """
    far = 1 - similarity + 1e-9
    exploded = sketched.where("node is not null").select("node", F.explode("bands").alias("b"))
    buckets = exploded.groupBy("b").agg(F.min("node").alias("low"), F.max("node").alias("high"))
    members = scratch.write(exploded.join(buckets.where("low <> high").select("b"), "b").distinct(), "members")
    met = members.join(members.groupBy("b").agg(F.count("*").alias("n")), "b").groupBy("node").agg(F.sum("n").alias("met"))
    leads = members.join(met, "node").groupBy("b").agg(F.max(F.struct("met", "node")).alias("lead"))
    pairs = scratch.write(members.join(leads.select("b", F.col("lead.node").alias("lead"), F.col("lead.met").alias("met")), "b")
                          .where("node <> lead").select("node", "lead", "met").distinct(), "pairs")
    involved = pairs.select("node").unionByName(pairs.select(F.col("lead").alias("node"))).distinct()
    chosen = sketched.join(involved, "node").groupBy("node").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("x"))
    chosen = chosen.select("node", F.col("x.doc_id").alias("chosen_id"), F.col("x.text_hash").alias("chosen_hash"))
    own = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(text_col).alias("text_hash"), F.col(text_col).alias("text"))
    texts = scratch.write(
        own.join(chosen, own.doc_id.eqNullSafe(chosen.chosen_id) & (own.text_hash == chosen.chosen_hash))
        .select("node", "text").dropDuplicates(["node"]), "texts")
    settled = scratch.write(_settle(pairs, texts).withColumn("linked", F.col("sim") >= similarity), "settled")
    found = settled.where("linked").select(F.col("node").alias("u"), F.col("lead").alias("v"))
    # texts of one component are linked already: only texts of different labels are compared from here on
    stars = scratch.write(components(found, scratch), "stars")
    scratch.drop(members, pairs)
    around = settled.join(stars.withColumnRenamed("comp", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    groups = around.groupBy("lead").agg(
        F.sum(F.when(F.col("linked"), 0).otherwise(1)).alias("apart"), (F.count("*") * F.sum(F.when(F.col("linked"), 0).otherwise(1))).alias("work"),
        F.min("label").alias("low"), F.max("label").alias("high")).where("apart > 0 and low <> high")
    around = scratch.write(around.join(groups.select("lead", "work"), "lead"), "around")
    scratch.drop(settled)
    enough = similarity - 1e-9
    different = F.col("label") != F.col("o_label")

    def meeting(rows: DataFrame, most: Column) -> DataFrame:
        """Pairs around one lead whose shared weight may be as high as ``most``."""
        other = rows.select("lead", *(F.col(c).alias(f"o_{c}") for c in ("node", "label", "linked", "sim", "weight", "within")))
        ok = different & (F.col("o_linked") | (F.col("node") > F.col("o_node"))) & (F.abs(F.col("sim") - F.col("o_sim")) <= far)
        return (rows.where("not linked").join(other, "lead").where(ok & (most >= enough * (F.col("weight") + F.col("o_weight") - most)))
                .select("node", F.col("o_node").alias("lead")))

    # what two texts share beyond the lead is at most what either has there
    plain = around.withColumn("within", F.col("shared"))
    both = F.least("within", "o_within") + F.least(F.col("weight") - F.col("within"), F.col("o_weight") - F.col("o_within"))
    small, large = plain.where(F.col("work") <= few), around.where(F.col("work") > few)
    more = meeting(small, both)
    if not large.isEmpty():
        crowd = components(large.select(F.col("node").alias("u"), F.col("lead").alias("v")), scratch)
        crowd = scratch.write(crowd.withColumnRenamed("comp", "crowd"), "crowds")
        sizes = large.groupBy("lead").count().join(crowd.withColumnRenamed("node", "lead"), "lead")
        centre = sizes.groupBy("crowd").agg(F.max(F.struct("count", "lead"))["lead"].alias("centre"))
        nodes = scratch.write(large.select("node", "label", "weight").distinct().join(crowd, "node").join(centre, "crowd"), "crowded")
        beyond = scratch.write(
            _own_shingles(nodes.where("node <> centre").select("node", F.col("centre").alias("lead")), texts)
            .join(nodes.select("node", "crowd", "label"), "node").select("crowd", "shingle", "node", "label", "extra"), "beyond")
        held = scratch.write(beyond.groupBy("crowd", "shingle").agg(
            F.count("*").alias("n"), F.min("label").alias("low"), F.max("label").alias("high")), "held")
        rare = held.where(F.col("n") <= holders)
        alone = beyond.join(rare.select("crowd", "shingle"), ["crowd", "shingle"]).groupBy("node").agg(F.sum("extra").alias("rare"))
        kept = scratch.write(nodes.join(alone, "node", "left").select(
            "node", "weight", (F.col("weight") - F.coalesce("rare", F.lit(0.0))).alias("within")), "within")
        # a text that is mostly rare shingles can't reach the threshold by the others
        common = large.join(kept.drop("weight"), "node").where(F.col("within") >= enough * F.col("weight"))
        more = more.unionByName(meeting(common, F.least("within", "o_within")))
        shared = beyond.join(rare.where("low < high").select("crowd", "shingle"), ["crowd", "shingle"])
        other = shared.select("crowd", "shingle", *(F.col(c).alias(f"o_{c}") for c in ("node", "label", "extra")))
        met = (shared.join(other, ["crowd", "shingle"]).where(different & (F.col("node") > F.col("o_node")))
               .groupBy("node", "o_node").agg(F.sum(F.least("extra", "o_extra")).alias("met")))
        met = met.join(kept, "node").join(kept.select(*(F.col(c).alias(f"o_{c}") for c in kept.columns)), "o_node")
        most = F.col("met") + F.least("within", "o_within")
        more = more.unionByName(met.where(most >= enough * (F.col("weight") + F.col("o_weight") - most)).select(
            "node", F.col("o_node").alias("lead")))
    more = scratch.write(_settle(scratch.write(more.distinct(), "more"), texts).where(F.col("sim") >= similarity), "late")
    scratch.drop(texts, around)
    return stars.select(F.col("node").alias("u"), F.col("comp").alias("v")).unionByName(more.select(F.col("node").alias("u"), F.col("lead").alias("v")))


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
            bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """One row per document: doc_id, text_hash, class_id, class_size.

    class_id is the smallest doc_id of the class, text_hash is xxhash64 of the
    text (with doc_id it finds the row again), class_size counts the rows of
    the class.
    """
    return _classes(docs, id_col, text_col, similarity, bands, rows)[0]


def _classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", similarity: float = SIMILARITY,
             bands: int = BANDS, rows: int = ROWS) -> tuple[DataFrame, list[DataFrame]]:
    """``classes``, and the written tables that it reads."""
    scratch = Scratch(docs.sparkSession, "near-dup")
    sketched = scratch.write(sketch(docs, id_col, text_col, bands, rows), "sketch")
    found = links(sketched, docs, scratch, id_col, text_col, similarity)
    rows_ = scratch.write(sketched.select("doc_id", "text_hash", "node"), "rows")
    scratch.drop(sketched)
    comp = scratch.write(components(found, scratch), "classes")
    worded = rows_.where("node is not null")
    placed = worded.join(comp, "node", "left").select("doc_id", "text_hash", F.coalesce("comp", "node").alias("comp"))
    named = scratch.write(placed.groupBy("comp").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size")), "named")
    # classes of more than a HEAVY share of the rows, fewer than 1 / HEAVY of them, are broadcast, so that no task gets one whole
    most = HEAVY * (named.agg(F.sum("class_size")).first()[0] or 0)
    heavy = F.broadcast(named.where(F.col("class_size") > most))
    out = placed.join(heavy, "comp").unionByName(
        placed.join(heavy, "comp", "left_anti").join(named.where(F.col("class_size") <= most), "comp"))
    return out.select("doc_id", "text_hash", "class_id", "class_size").unionByName(rows_.where("node is null").select(
        "doc_id", "text_hash", F.col("doc_id").alias("class_id"), F.lit(1).cast("long").alias("class_size"))), [rows_, comp, named]


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with one of each class left: the row whose id names the class.

    Of rows that repeat that id inside the class one stays (in a class of null
    ids, one row).  Rows without words all stay.
    """
    found, tables = _classes(docs, id_col, text_col, **options)
    scratch = Scratch(docs.sparkSession, "near-dup-keep")
    found = scratch.write(found.where("class_size > 1"), "grouped")
    scratch.drop(*tables)
    # (id, text) pairs that occur in many rows are settled apart, the rest by an anti-join
    key = ["doc_id", "text_hash"]
    lost = found.where(~F.col("doc_id").eqNullSafe(F.col("class_id"))).select(*key).distinct()
    heads = found.where(F.col("doc_id").eqNullSafe(F.col("class_id")))
    # a null id names no single class: its rows are told apart by their text
    tied = heads.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").select(*key)
    own = "text_hash"
    while own in docs.columns:
        own += "_"
    marked = docs.withColumn(own, F.xxhash64(text_col))
    on = lambda t: marked[id_col].eqNullSafe(t.doc_id) & (marked[own] == t.text_hash)
    kept = marked.join(lost, on(lost), "left_anti")
    if tied.isEmpty():
        return kept.drop(own)
    on_tied = kept[id_col].eqNullSafe(tied.doc_id) & (kept[own] == tied.text_hash)
    single = kept.join(tied, on_tied, "left_anti")
    many = kept.join(tied, on_tied, "left_semi").dropDuplicates([id_col, own])
    return single.unionByName(many).drop(own)
