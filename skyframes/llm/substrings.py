"""Substring deduplication by seed and extend on winnowed anchors.

A repeat is `window` or more consecutive words that also stand in a document of a smaller id.

Seeds: of each window, the least hash of its runs of `seed` words is its anchor (winnowing: any
shared window has the same anchor in both documents). Anchors are joined over all documents; those
in only one text are dropped, which is nearly all of them.
Extension: from each shared anchor a document is followed both ways, word by word, through every
window that has the anchor; a window is kept as (hash, position), and one aggregate finds the least
document of each. Windows that start in a smaller document, put together, are the maximal repeats
over the threshold: two that touch or overlap are one repeat.

An aggregate and a join by hash stand for the comparison of all pairs that share an anchor, so a
passage in a third of all documents costs as many rows as it has occurrences.

Exact copies are found by a hash of their words: all but the least are wholly repeats (if they
have a window), and only that one takes part in the rest.

Window and text hashes have 128 bits. Defined results: a null or empty text, or one of fewer words
than a window, loses nothing; rows of one id are one document, so they don't repeat each other; a
row without an id is never a repeat, nor the source of one.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import appended, stored
from .words import Piece, grams, mixed, pieces


def anchors(p: Piece, h: np.ndarray, window: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """The anchor of each window of a split piece, and the windows' first words."""
    if len(h) < window:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    # runs over the end of a text are only in windows that are left out
    least, _ = grams(h, np.zeros(len(h), np.int8), seed, 3)
    have, want = 1, window - seed + 1
    while have < want:
        by = min(have, want - have)
        least = np.minimum(least[:-by], least[by:])
        have += by
    start = np.flatnonzero(p.doc[: len(least)] == p.doc[window - 1 :])
    return least[start], start


def text_hash(h: np.ndarray) -> tuple[int, int]:
    """128 bits of a sequence of word hashes."""
    n = np.arange(1, len(h) + 1, dtype=np.uint64)
    return tuple(int((mixed(h, s) * mixed(n, s)).sum(dtype=np.uint64).view(np.int64)) for s in (13, 14))


def _lists(values: np.ndarray, doc: np.ndarray, n: int) -> pa.ListArray:
    ends = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.view(np.int64)))


def _chain(parts: list[pa.Array], kind: pa.DataType) -> pa.Array:
    return pa.concat_arrays(parts) if parts else pa.array([], kind)


_LONGS = pa.list_(pa.int64())


def _described(docs: DataFrame, window: int, seed: int) -> DataFrame:
    def judge(batch: pa.RecordBatch) -> list:
        n, hashes, digests, found = [], [], [], []
        for p in pieces(batch.column("text")):
            h = p.split().hashes()
            n += np.diff(p.first).tolist()
            for i in range(p.n):
                hashes.append(text_hash(h[p.first[i] : p.first[i + 1]]))
                digests.append(hashlib.sha256(b" ".join(p.data[p.at[i] : p.at[i + 1]].tobytes().split())).hexdigest())
            a, start = anchors(p, h, window, seed)
            doc = p.doc[start]
            new = np.ones(len(a), bool)
            new[1:] = (a[1:] != a[:-1]) | (doc[1:] != doc[:-1])
            found.append(_lists(a[new], doc[new], p.n))
        return [n, [x[0] for x in hashes], [x[1] for x in hashes], digests, _chain(found, _LONGS)]

    return appended(docs, "n_words bigint, w1 bigint, w2 bigint, digest string, anchors array<bigint>", judge, ("text",))


def _windows(texts: DataFrame, window: int, seed: int) -> DataFrame:
    """Windows that have one of the shared anchors: two hashes and positions, without the texts.

    Rows of another text of the id go.
    """

    def judge(batch: pa.RecordBatch) -> list:
        same, out, row = [], [[], [], []], 0
        wanted, marks = batch.column("w1").to_pylist(), batch.column("shared")
        for p in pieces(batch.column("text")):
            h = p.split().hashes()
            a, start = anchors(p, h, window, seed)
            doc = p.doc[start]
            keep = np.zeros(len(a), bool)
            first = np.searchsorted(doc, np.arange(p.n + 1))
            for i in range(p.n):
                same.append(text_hash(h[p.first[i] : p.first[i + 1]])[0] == wanted[row])
                mine = marks[row].values.to_numpy(zero_copy_only=False).view(np.uint64)
                keep[first[i] : first[i + 1]] = np.isin(a[first[i] : first[i + 1]], mine)
                row += 1
            at = start[keep]
            g1, where = grams(h, p.doc, window, 4)
            g2, _ = grams(h, p.doc, window, 5)
            pick = np.searchsorted(where, at)
            for into, x in zip(out, (g1[pick], g2[pick], at - p.first[p.doc[at]])):
                into.append(_lists(x, p.doc[at], p.n))
        return [*(_chain(x, _LONGS) for x in out), same]

    made = appended(texts, "g1 array<bigint>, g2 array<bigint>, at array<bigint>, same boolean", judge, ("shared", "text"))
    return made.filter("same").drop("same")


def _cut(texts: DataFrame, window: int) -> DataFrame:
    """texts (text, w1, late: positions of windows to remove) with n_removed, digest of what is kept and the repeats.

    Rows of another text of the id go.
    """

    def judge(batch: pa.RecordBatch) -> list:
        removed, digests, repeats, same = [], [], [], []
        wanted = batch.column("w1").to_pylist()
        for p in pieces(batch.column("text")):
            h = p.split().hashes()
            same += [text_hash(h[p.first[i] : p.first[i + 1]])[0] == wanted[len(same) + i] for i in range(p.n)]
        for text, late, own in zip(batch.column("text").to_pylist(), batch.column("late").to_pylist(), same):
            words = text.encode().split()
            late = late if own else []
            turn = np.zeros(len(words) + 1, np.int64)
            at = np.unique(np.array(late, np.int64))
            turn[at] += 1
            turn[at + window] -= 1
            gone = np.cumsum(turn[:-1]) > 0
            edges = np.flatnonzero(np.diff(np.concatenate([[0], gone, [0]]))).reshape(-1, 2)
            removed.append(int(gone.sum()))
            digests.append(hashlib.sha256(b" ".join(w for w, x in zip(words, gone) if not x)).hexdigest())
            repeats.append([{"start": int(a), "stop": int(b)} for a, b in edges])
        return [removed, digests, repeats, same]

    schema = "n_removed bigint, kept_sha256 string, repeats array<struct<start: bigint, stop: bigint>>, same boolean"
    return appended(texts, schema, judge, ("text", "late")).filter("same").drop("same")


def deduplicated(docs: DataFrame, window: int = 13, seed: int = 5, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, repeats) for each row; repeats: spans of words that go."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    all_ = stored(_described(rows, window, seed), "described")
    real = all_.filter(F.col("doc_id").isNotNull() & (F.col("n_words") >= window))
    least = real.groupBy("w1", "w2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("_z")).filter("least < _z").drop("_z")
    copies = stored(real.select("doc_id", "w1", "w2").join(least, ["w1", "w2"]).filter("doc_id > least").select("doc_id", "w1").distinct(), "copies")
    leaders = real.join(copies, ["doc_id", "w1"], "left_anti")
    seeds = leaders.select("doc_id", "w1", F.explode("anchors").alias("anchor"))
    # tables of their own, so that the joins with them can split a hot anchor or window
    shared = stored(seeds.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("anchor"), "anchors")
    hits = stored(seeds.join(shared, "anchor").groupBy("doc_id", "w1").agg(F.collect_set("anchor").alias("shared")), "hits")
    found = stored(_windows(rows.filter("doc_id is not null").join(hits, "doc_id"), window, seed), "windows")
    each = found.select("doc_id", "w1", F.explode(F.arrays_zip("g1", "g2", "at")).alias("x")).select("doc_id", "w1", "x.*")
    first = stored(each.groupBy("g1", "g2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").drop("hi"), "first-windows")
    late = stored(each.join(first, ["g1", "g2"]).filter("doc_id > lo").groupBy("doc_id", "w1").agg(F.collect_list("at").alias("late")), "late")
    cut = stored(_cut(rows.filter("doc_id is not null").join(late, "doc_id"), window).dropDuplicates(["doc_id", "w1"]), "cut")
    gone = copies.withColumn("_gone", F.lit(True))
    out = all_.drop("anchors").join(gone, ["doc_id", "w1"], "left").join(cut, ["doc_id", "w1"], "left")
    whole = F.array(F.struct(F.lit(0).cast("bigint").alias("start"), F.col("n_words").alias("stop")))
    return out.select(
        "doc_id", "n_words",
        F.when(F.col("_gone"), F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0).cast("bigint"))).alias("n_removed"),
        F.when(F.col("_gone"), F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "digest")).alias("kept_sha256"),
        F.when(F.col("_gone"), whole).otherwise(F.coalesce("repeats", F.array().cast("array<struct<start:bigint,stop:bigint>>"))).alias("repeats"),
    )
