"""Compression classifier: zstandard dictionaries of good and of bad text.

A text is compressed, in blocks, with a dictionary built from good labelled texts and with one
built from bad ones. The difference of the two sizes, divided by the larger, says which it resembles; logistic
regression on that difference and on the logarithm of the text's own compression ratio (text that
repeats itself compresses alike with both) turns it into a probability, fitted on labelled rows
that gave nothing to the dictionaries.

The fit uses a bounded sample: `per_class` rows of each label for the dictionaries and as many for
the calibration, those of the smallest hash of their id among the ids that have a text of 1 to `most_chars`
characters. Scoring covers all rows and whole texts.

Defined results: a null text counts as an empty one; an empty text has difference 0 and ratio 1,
so its score is the calibrated one for that; without labels of both classes the score is 0.5. An
id with several labels has the lowest. Rows are scored one by one. Columns of the same name as a
result are replaced.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import appended, stored


@dataclass
class Model:
    good: bytes
    bad: bytes
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # constant, difference, ratio
    level: int


def _dictionary(texts: list[bytes], size: int) -> bytes:
    cut = [b for x in texts for b in blocks(x)]
    try:
        return zstandard.train_dictionary(size, cut).as_bytes()
    except zstandard.ZstdError:  # too little text to train on: the text itself serves
        return b"\n".join(texts)[-size:]


def _compressors(model: Model) -> list[zstandard.ZstdCompressor]:
    out = []
    for raw in (model.good, model.bad):
        d = zstandard.ZstdCompressionDict(raw)
        d.precompute_compress(level=model.level)
        out.append(zstandard.ZstdCompressor(dict_data=d, write_checksum=False, write_dict_id=False, write_content_size=True))
    return out


def blocks(text: bytes, size: int = 2048) -> list[bytes]:
    """All of a text in blocks, so that a long text can't become its own dictionary."""
    return [text[i : i + size] for i in range(0, len(text), size)]


def features(texts: list[bytes], pair: list[zstandard.ZstdCompressor]) -> np.ndarray:
    """Normalised difference (positive: more like good text) and log ratio of each text."""
    sizes = np.array([(len(t), *(sum(len(c.compress(b)) for b in blocks(t)) for c in pair)) for t in texts], float).reshape(-1, 3)
    difference = (sizes[:, 2] - sizes[:, 1]) / np.maximum(1, np.maximum(sizes[:, 1], sizes[:, 2]))
    ratio = np.log(np.maximum(1, np.minimum(sizes[:, 1], sizes[:, 2])) / np.maximum(1, sizes[:, 0]))
    empty = sizes[:, 0] == 0
    return np.stack([np.where(empty, 0, difference), np.where(empty, 0, ratio)], 1)


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 50) -> np.ndarray:
    """Weights (constant first) by Newton's method."""
    x = np.column_stack([np.ones(len(x)), x])
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - ridge * w
        bend = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        step = np.linalg.solve(bend, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return w


def fit(
    docs: DataFrame, labels: DataFrame, per_class: int = 1200, most_chars: int = 16_384, dictionary: int = 112_640,
    level: int = 1, text: str = "text", doc_id: str = "doc_id", label: str = "label",
) -> Model | None:
    """labels: ids and a label of 1 (good) or 0 (bad); None if a class has no text."""
    known = labels.filter(F.col(label).isin(0, 1)).groupBy(F.col(doc_id).alias("_id")).agg(F.min(label).cast("int").alias("_y"))
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t")).filter(F.length("_t").between(1, most_chars))
    known = stored(known.join(texts.select("_id").distinct(), "_id", "left_semi"), "labelled")
    rank = F.xxhash64("_id")
    picked = None
    for y in (0, 1):
        one = known.filter(F.col("_y") == y).orderBy(rank, "_id").limit(2 * per_class)
        picked = one if picked is None else picked.unionByName(one)
    rows = texts.join(F.broadcast(picked), "_id").select("_id", "_y", rank.alias("_r"), "_t").collect()
    by: list[list[bytes]] = [[], []]
    for r in sorted(rows, key=lambda r: (r["_r"], r["_id"], r["_t"])):
        by[r["_y"]].append(r["_t"].encode())
    if not all(by):
        return None
    model = Model(_dictionary(by[1][::2], dictionary), _dictionary(by[0][::2], dictionary), np.zeros(2), np.ones(2), np.zeros(3), level)
    held = [x[1::2] or x for x in by]
    x = features(held[0] + held[1], _compressors(model))
    y = np.array([0.0] * len(held[0]) + [1.0] * len(held[1]))
    model.mean, model.scale = x.mean(0), x.std(0) + 1e-9
    model.weights = logistic((x - model.mean) / model.scale, y)
    # the sample has as many bad rows as good ones if there are enough: put the labels' own share back
    share = {r["_y"]: r["n"] for r in known.groupBy("_y").agg(F.count("*").alias("n")).collect()}
    model.weights[0] += np.log(share[1] / share[0]) - np.log(len(held[1]) / len(held[0]))
    return model


def scored(docs: DataFrame, model: Model | None, least: float = 0.7, text: str = "text") -> DataFrame:
    """docs with score (0 to 1, higher: good likelier) and predicted (1 if score >= least, else 0)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    pair: list = []

    def judge(batch: pa.RecordBatch) -> list:
        model = shared.value
        if model is None:
            p = np.full(len(batch), 0.5)
        else:
            pair[:] = pair or _compressors(model)
            column = batch.column(text).cast(pa.binary()).fill_null(b"")
            x = (features([v.as_py() for v in column], pair) - model.mean) / model.scale
            p = 1 / (1 + np.exp(-np.clip(model.weights[0] + x @ model.weights[1:], -30, 30)))
        return [pa.array(p, pa.float64()), pa.array(p >= least).cast(pa.int32())]

    return appended(docs, "score double, predicted int", judge)
