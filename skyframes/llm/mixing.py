"""Mixing sources to target weights, with soft membership in domains.

A multinomial logistic classifier, trained on a bounded sample of a labelled table, gives each
document a posterior over domains, from which hashed words it has and from its shape. A document's
tokens count for each domain in proportion. Rates r >= 0 are fitted so that the expected tokens of
each domain, sum of r * posterior * tokens, match the targets: accelerated projected gradient (with
restarts) on the least squares of the differences, starting from rate 1. The step of a document is
divided by its tokens, which treats long and short documents alike, and the squares are weighted by
the inverse of the domains' second moments, for which a step of 1 is safe whatever the shares of
the domains. A document's rate depends only on its posterior and on the few numbers of each step so
far, so a step is one pass over a narrow table, in which each task replays the steps and gives one
row of sums.

The result says what was reached: `reached` has the share of each domain at the rates given, and
`met` whether all are within `close` of their targets. Targets that no nonnegative rates can meet
are not met, and the rates come as near as the steps got.

Defined results: null or empty texts have no tokens and the rate 1 takes steps like any other; a
domain with a target but without a labelled document of some text can't be filled and is left out, with the other
targets scaled up; without labelled rows there is no posterior, all rates are 1 and nothing is met; targets must be
nonnegative and not all 0. Labels of one id that disagree count once each. Rows are rated one by
one. Input columns of the results' names are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import appended, slices, stored
from .words import Piece, mixed, pieces

BITS = 18
_SHAPES = 3 * 16  # buckets kept for the shape of a text
_UPPER, _LOWER, _SYMBOL = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = _LOWER[97:123] = True
_SYMBOL[[*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]] = True


@dataclass
class Model:
    domains: list[str]
    weights: np.ndarray  # (2 ** BITS, domains), float32
    bias: np.ndarray


def features(p: Piece) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) pairs, each once: the words of each text of a split piece, and its shape."""
    h = p.hashes(folded=True)
    words = (mixed(h, 3) % np.uint64((1 << BITS) - _SHAPES)).astype(np.int64) + _SHAPES
    n = np.maximum(1, np.diff(p.first))
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (p.doc[1:] != p.doc[:-1])
    upper, lower = p.sums(_UPPER[p.data]), p.sums(_LOWER[p.data])
    shape = [
        np.minimum(15, 15 * upper // np.maximum(1, upper + lower)),
        16 + np.minimum(15, 5 * p.sums(_SYMBOL[p.data]) // n),
        32 + 15 * np.bincount(p.doc[new], minlength=p.n) // n,
    ]
    key = np.unique(np.concatenate([(p.doc.astype(np.int64) << BITS) | words, *((np.arange(p.n) << BITS) | s for s in shape)]))
    return key >> BITS, key & ((1 << BITS) - 1)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(1, keepdims=True))
    return x / x.sum(1, keepdims=True)


def train(rows: np.ndarray, buckets: np.ndarray, y: np.ndarray, k: int, rounds: int = 150, rate: float = 0.05, ridge: float = 2e-3) -> tuple[np.ndarray, np.ndarray]:
    """Weights (2 ** BITS, k) and bias by Adam on all rows; buckets of fewer than 3 rows stay 0."""
    seen = np.bincount(buckets, minlength=1 << BITS)
    keep = seen[buckets] >= 3
    rows, (used, at) = rows[keep], np.unique(buckets[keep], return_inverse=True)
    w, b, hot = np.zeros((len(used), k)), np.zeros(k), np.eye(k)[y]
    first, second, size = np.zeros_like(w), np.zeros_like(w), np.sqrt(np.maximum(1, np.bincount(rows, minlength=len(y))))
    for step in range(1, rounds + 1):
        score = np.stack([np.bincount(rows, w[at, c], len(y)) for c in range(k)], 1) + b
        miss = (hot - _softmax(score)) / len(y)
        g = np.stack([np.bincount(at, miss[rows, c], len(used)) for c in range(k)], 1) - ridge / len(y) * w
        first, second = 0.9 * first + 0.1 * g, 0.99 * second + 0.01 * g * g
        w += rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-6)
        b += 0.5 * miss.sum(0)
    out = np.zeros((1 << BITS, k), np.float32)
    out[used] = w
    return out, b


def fit(docs: DataFrame, labelled: DataFrame, per_domain: int = 1500, most_domains: int = 64, text: str = "text", doc_id: str = "doc_id", domain: str = "domain") -> Model | None:
    """labelled: ids and domains. The sample: for each domain the `per_domain` ids of smallest hash among those with a text.

    Whole texts are read, and the driver gets the set of buckets of each. More than `most_domains` domains are an error.
    """
    known = labelled.filter(F.col(domain).isNotNull()).select(F.col(doc_id).alias("_id"), F.col(domain).cast("string").alias("_y")).distinct()
    texts = docs.select(F.col(doc_id).alias("_id"), F.col(text).alias("_t")).filter("_t is not null and _t != ''")
    known = stored(known.join(texts.select("_id").distinct(), "_id", "left_semi"), "labelled")
    counts = {r["_y"]: r["count"] for r in known.groupBy("_y").count().limit(most_domains + 1).collect()}
    if not counts:
        return None
    if len(counts) > most_domains:
        raise ValueError(f"more than {most_domains} domains")
    names, picked = sorted(counts), None
    for y in names:
        one = known.filter(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(per_domain)
        picked = one if picked is None else picked.unionByName(one)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices(batches):
            made = []
            for p in pieces(b.column(2)):
                row, bucket = features(p.split())
                made += np.split(bucket.astype(np.int32), np.searchsorted(row, np.arange(1, p.n)))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array([m.tobytes() for m in made], pa.binary())], names=["id", "y", "buckets"])

    got = texts.join(F.broadcast(picked), "_id").select(F.col("_id").cast("string").alias("id"), "_y", "_t").mapInArrow(rows, "id string, y string, buckets binary").collect()
    got = sorted((r["id"] or "", r["y"], bytes(r["buckets"])) for r in got)
    sets = [np.frombuffer(x[2], np.int32) for x in got]
    y = np.array([names.index(x[1]) for x in got])
    weights, bias = train(np.repeat(np.arange(len(sets)), [len(s) for s in sets]), np.concatenate(sets), y, len(names))
    # the sample has its own shares of the domains: put those of the labels back
    own = np.maximum(0.5, np.bincount(y, minlength=len(names)))
    bias = bias + np.log(np.array([counts[n] for n in names]) / own)
    return Model(names, weights, bias)


def posteriors(docs: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """docs with n_tokens and posterior (array, in the order of model.domains; null without a model)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batch: pa.RecordBatch) -> list:
        counts, out = [], []
        for p in pieces(batch.column(text)):
            p.split()
            counts.append(np.diff(p.first))
            if (m := shared.value) is not None:
                row, bucket = features(p)
                score = np.stack([np.bincount(row, m.weights[bucket, c], p.n) for c in range(len(m.domains))], 1)
                out.append(_softmax(score + m.bias))
        n = np.concatenate(counts) if counts else np.zeros(0, np.int64)
        if shared.value is None:
            return [pa.array(n, pa.int64()), [None] * len(n)]
        flat = np.concatenate(out) if out else np.zeros((0, len(shared.value.domains)))
        return [pa.array(n, pa.int64()), pa.array(list(flat), pa.list_(pa.float64()))]

    return appended(docs, "n_tokens bigint, posterior array<double>", judge)


def replayed(q: np.ndarray, steps: list[tuple[float, np.ndarray]]) -> np.ndarray:
    """Rates after the steps (momentum, multipliers) of rows with these posteriors."""
    rate = before = np.ones(len(q))
    for momentum, step in steps:
        rate, before = np.maximum(0, rate + momentum * (rate - before) - q @ step), rate
    return rate


def _posterior(column: pa.Array, k: int) -> np.ndarray:
    return np.asarray(column.flatten()).reshape(-1, k)


def _totals(rows: DataFrame, k: int, steps: list | None) -> np.ndarray:
    """Expected tokens of each domain after the steps; without any, all tokens and the second moments of the posteriors."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(k if steps is not None else 1 + k * k)
        for b in batches:
            n, q = np.asarray(b.column("n_tokens")).astype(float), _posterior(b.column("posterior"), k)
            sums += (replayed(q, steps) * n) @ q if steps is not None else np.concatenate([[n.sum()], ((q * n[:, None]).T @ q).ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums)], names=["i", "x"])

    got = rows.select("n_tokens", "posterior").mapInArrow(add, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).collect()
    out = np.zeros(k if steps is not None else 1 + k * k)
    for r in got:  # as many numbers as domains, or their squares
        out[r["i"]] = r["x"]
    return out


def rates(rows: DataFrame, targets: list[float], rounds: int = 100, close: float = 1e-5) -> tuple[Column, np.ndarray]:
    """The rate of a row, from its posterior, and the domains' expected tokens divided by all tokens.

    rows: n_tokens and posterior, read once for each step; targets: a share for each domain. It ends
    when all shares are within `close`, when steps change nothing any more, or after `rounds`.
    """
    k, wanted = len(targets), np.array(targets)
    first = _totals(rows, k, None)
    total, g = first[0], first[1:].reshape(k, k) / max(first[0], 1.0)
    # a domain without mass takes no part: its target is out of reach
    inverse = np.linalg.pinv(g, rcond=1e-12, hermitian=True)
    miss = lambda x: float((x - wanted) @ inverse @ (x - wanted))
    steps: list[tuple[float, np.ndarray]] = []
    reached = before = g.sum(1)
    speed, still = 1.0, 0
    while total and len(steps) < rounds and np.abs(reached - wanted).max() > close and still < 3:
        faster = (1 + np.sqrt(1 + 4 * speed * speed)) / 2
        momentum = (speed - 1) / faster
        ahead = reached + momentum * (reached - before)
        tried = [*steps, (momentum, inverse @ (ahead - wanted))]
        there = _totals(rows, k, tried) / total
        if momentum and miss(there) > miss(reached):
            speed = 1.0  # start again from here, without momentum
            continue
        still = still + 1 if np.abs(there - reached).max() < close / 10 else 0
        steps, before, reached, speed = tried, reached, there, faster

    @F.pandas_udf("double")
    def rate(posterior: pd.Series) -> pd.Series:
        out = np.ones(len(posterior))
        real = posterior.notna().to_numpy()
        if real.any():
            out[real] = replayed(np.stack(posterior[real].to_list()), steps)
        return pd.Series(out)

    return rate("posterior"), reached


def mixed_to(docs: DataFrame, labelled: DataFrame, targets: dict[str, float], text: str = "text", close: float = 1e-5, **fitting) -> DataFrame:
    """docs with n_tokens, posterior (array), domain (likeliest), rate, reached (array of shares, as the posterior) and met.

    targets: the share of all tokens that each domain shall have; shares are scaled to sum 1.
    """
    if min(targets.values(), default=0) < 0 or not sum(targets.values()):
        raise ValueError(f"targets must be nonnegative and not all 0: {targets}")
    model = fit(docs, labelled, text=text, **fitting)
    new = {"n_tokens", "posterior", "domain", "rate", "reached", "met"}
    docs = docs.drop(*[c for c in docs.columns if c.lower() in new and c != text])
    rated = stored(posteriors(docs, model, text), "posteriors")
    if model is None:
        nothing = {"domain": F.lit(None).cast("string"), "rate": F.lit(1.0), "reached": F.lit(None).cast("array<double>"), "met": F.lit(False)}
        return rated.withColumns(nothing)
    wanted = np.array([targets.get(d, 0.0) for d in model.domains])
    if not wanted.sum():
        raise ValueError(f"no target is a labelled domain: {targets}, {model.domains}")
    wanted = wanted / wanted.sum()
    rate, reached = rates(rated.select("n_tokens", "posterior"), list(wanted), close=close)
    top = F.array_position("posterior", F.array_max("posterior")).cast("int")
    return rated.withColumns({
        "domain": F.element_at(F.array(*map(F.lit, model.domains)), top), "rate": rate,
        "reached": F.array(*[F.lit(float(x)) for x in reached]),
        "met": F.lit(bool(np.abs(reached - wanted).max() <= close)),
    })
