"""Language mixtures by expectation-maximisation over n-gram likelihoods.

Model: for each language the frequencies of hashed letter trigrams (lower-cased, a word's edges
count as letters), counted over all training texts in one Spark aggregate and mixed with a uniform
share, so that an unseen trigram favours no language. A text is a mixture: each of its words
(a run of letters) comes from one language, with the product of its trigrams' probabilities.
Expectation-maximisation over the words gives the languages' shares. Candidate sets are the m
languages of largest shares; each is fitted again, and the set with the highest log likelihood
less `penalty` * (m - 1) * log(words) / 2 is the text's language set.

The model has 2 ** BITS numbers for each language; `fit` refuses more than `most_languages`.

Defined results: a null text, or one without a letter, is `und` with score 0 and no shares; so is
every text if nothing could be learned. Ties go to the language that sorts first. Rows are judged
one by one. Columns of the same name as a result are replaced.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import appended, slices

BITS = 16
_PIECE = 1 << 18  # characters at a time
RESULT = "lang_pred string, score double, shares map<string, double>"


@dataclass
class Model:
    languages: list[str]
    logs: np.ndarray  # (2 ** BITS, languages), float32


@cache
def _letters() -> np.ndarray:
    """For each code point its lower-cased letter's number, 0 for what is no letter."""
    out = np.zeros(sys.maxunicode + 1, np.uint32)
    for c in range(sys.maxunicode + 1):
        if unicodedata.category(x := chr(c))[0] == "L":
            low = x.lower()
            out[c] = ord(low[0])
    return out


def _trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each letter of all texts: its trigram's bucket, whether it starts a word, and its text."""
    size = np.array([len(t) + 1 for t in texts])
    raw = "\n".join([*texts, ""]).encode("utf-32-le", "surrogatepass")
    c = _letters()[np.frombuffer(raw, np.uint32)]
    before, after = np.zeros_like(c), np.zeros_like(c)
    before[1:], after[:-1] = c[:-1], c[1:]
    at = np.flatnonzero(c)
    with np.errstate(over="ignore"):
        h = before[at] * np.uint32(0x9E3779B1) + c[at] * np.uint32(0x85EBCA77) + after[at] * np.uint32(0xC2B2AE3D)
        h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    text = np.searchsorted(np.cumsum(size), at, "right") if len(texts) < 64 else np.repeat(np.arange(len(texts)), size)[at]
    return (h >> np.uint32(32 - BITS)).astype(np.int64), before[at] == 0, text


def _pieces(texts: list[str | None]) -> Iterator[tuple[int, list[str]]]:
    start, some, n = 0, [], 0
    for i, t in enumerate(texts):
        some.append(t or "")
        n += len(t or "")
        if n >= _PIECE:
            yield start, some
            start, some, n = i + 1, [], 0
    if some:
        yield start, some


def fit(docs: DataFrame, text: str = "text", lang: str = "lang", seen: float = 0.98, most_languages: int = 256) -> Model | None:
    """Count trigrams of all rows with a language; None if there is no letter in any of them."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for b in slices(batches):
            langs = b.column(1).to_pylist()
            texts = b.column(0).to_pylist()
            for name in sorted(set(langs)):
                into = total.setdefault(name, np.zeros(1 << BITS, np.int64))
                for _, some in _pieces([t for t, x in zip(texts, langs) if x == name]):
                    into += np.bincount(_trigrams(some)[0], minlength=1 << BITS)
        for name, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([name] * len(at)), pa.array(at), pa.array(n[at])], names=["lang", "gram", "n"])

    counts = (
        docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(text).alias("t"), F.col(lang).alias("l"))
        .mapInArrow(counted, "lang string, gram bigint, n bigint")
        .groupBy("lang", "gram").agg(F.sum("n").alias("n"))
        .groupBy("lang").agg(F.collect_list("gram").alias("grams"), F.collect_list("n").alias("counts"))
    )
    rows = sorted(counts.limit(most_languages + 1).collect(), key=lambda r: r["lang"])
    if len(rows) > most_languages:
        raise ValueError(f"over {most_languages} languages: give a larger most_languages")
    if not rows:
        return None
    p = np.zeros((1 << BITS, len(rows)))
    for k, r in enumerate(rows):
        p[r["grams"], k] = r["counts"]
    p = seen * p / p.sum(0) + (1 - seen) / (1 << BITS)
    return Model([r["lang"] for r in rows], np.log(p).astype(np.float32))


def _em(e: np.ndarray, text: np.ndarray, first: np.ndarray, share: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """Shares of each text and its log likelihood; e: (words, languages), first: each text's first word."""
    n = np.diff(first, append=len(e))[:, None]
    for _ in range(rounds):
        r = e * share[text]
        new = np.add.reduceat(r / r.sum(1, keepdims=True), first) / n
        moved = np.abs(new - share).max()
        share = new
        if moved < 1e-4:
            break
    return share, np.add.reduceat(np.log((e * share[text]).sum(1)), first)


def mixtures(texts: list[str], model: Model, penalty: float = 1.0, least: float = 0.02, rounds: int = 25) -> tuple[np.ndarray, np.ndarray]:
    """Shares of each text in its chosen set (no letter: all 0) and in all languages."""
    k = len(model.languages)
    chosen, whole = np.zeros((len(texts), k)), np.zeros((len(texts), k))
    gram, starts, text = _trigrams(texts)
    if not len(gram):
        return chosen, whole
    word = np.flatnonzero(starts)
    logs = np.add.reduceat(model.logs[gram], word).astype(np.float64)
    top = logs.max(1, keepdims=True)
    e = np.exp(np.maximum(logs - top, -60))
    rows, first, text = np.unique(text[word], return_index=True, return_inverse=True)
    n = np.diff(first, append=len(e))
    share, _ = _em(e, text, first, np.full((len(rows), k), 1 / k), rounds)
    rank = np.argsort(-share, axis=1, kind="stable")
    single = np.add.reduceat(np.maximum(logs - top, -60), first)
    best = np.take_along_axis(single, rank[:, :1], 1)[:, 0]
    pick = np.zeros_like(share)
    np.put_along_axis(pick, rank[:, :1], 1.0, 1)
    for m in range(2, k + 1):
        go = np.flatnonzero(np.take_along_axis(share, rank[:, m - 1 : m], 1)[:, 0] >= least)
        if not len(go):
            break
        mine = np.isin(text, go)
        inside = np.zeros((len(go), k))
        np.put_along_axis(inside, rank[go, :m], 1 / m, 1)
        new_first = np.concatenate([[0], np.cumsum(n[go])[:-1]])
        fitted, likely = _em(e[mine], np.repeat(np.arange(len(go)), n[go]), new_first, inside, rounds)
        likely = likely - penalty * (m - 1) * np.log(np.maximum(2, n[go])) / 2
        better = likely > best[go]
        best[go[better]], pick[go[better]] = likely[better], fitted[better]
    chosen[rows], whole[rows] = pick, share
    return chosen, whole


def predicted(docs: DataFrame, model: Model | None, text: str = "text", penalty: float = 1.0) -> DataFrame:
    """docs with lang_pred (largest share of the chosen set), score (its share of the whole mixture) and shares."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge(batch: pa.RecordBatch) -> list:
        model, names, scores, shares = shared.value, [], [], []
        for _, some in _pieces(batch.column(text).to_pylist()):
            if model is None:
                chosen = whole = np.zeros((len(some), 1))
            else:
                chosen, whole = mixtures(some, model, penalty)
            top = chosen.argmax(1)
            known = chosen.any(1)
            names += [model.languages[t] if ok else "und" for t, ok in zip(top, known)]
            scores += np.where(known, np.clip(np.take_along_axis(whole, top[:, None], 1)[:, 0], 0, 1), 0.0).tolist()
            for row, ok in zip(chosen, known):
                shares.append([(model.languages[i], float(row[i])) for i in np.flatnonzero(row)] if ok else [])
        return [names, scores, shares]

    return appended(docs, RESULT, judge)
