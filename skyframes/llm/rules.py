"""Quality rules as weak supervision.

Each rule looks at a document's signals and votes good (1), bad (-1) or abstains (0). The number of
different vote patterns is at most 3 ** rules, whatever the number of documents: one aggregate
counts them over all documents, and expectation-maximisation estimates each rule's accuracies and
the share of good documents from those counts. The posterior probability of a pattern is the
document's quality; there is no filter that all rules must pass.

Defined results: a null or empty text has no words and fails the base rule; an empty table gives
an empty table; rows are judged one by one, so repeated rows and ids get equal verdicts. A result
column of the same name as an input column replaces it; other columns stay.
"""

from __future__ import annotations

import numpy as np
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import appended
from .words import code_points, grams, mixed, pieces

# fixed value: the symbols that count
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_LOWER = np.zeros(256, bool)
_LOWER[97:123] = True

SIGNALS = (
    "n_words bigint, word_chars bigint, n_symbols bigint, n_dup_lines bigint, n_repeat_words bigint, "
    "n_upper bigint, n_lower bigint, n_lines bigint, n_unlike_words bigint"
)


def repeated_words(h: np.ndarray, doc: np.ndarray, n: int, width: int = 3) -> np.ndarray:
    """Words of each text in windows of `width` words that the text holds twice or more."""
    g, at = grams(h, doc, width)
    out = np.zeros(n, np.int64)
    if len(g):
        key = mixed(g + doc[at].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15), 2)
        order = np.argsort(key)
        same = np.concatenate([[False], key[order][1:] == key[order][:-1]])
        same[:-1] |= same[1:]
        first = at[order[same]]
        hit = np.zeros(len(h), bool)
        for j in range(width):
            hit[first + j] = True
        out += np.bincount(doc[hit], minlength=n)
    return out


def _signals(batch, text: str) -> list:
    column = batch.column(text)
    parts: list[list[np.ndarray]] = []
    for p in pieces(column):
        p.split()
        h, full = p.hashes(), np.zeros(len(p.data) + 1, np.int8)
        full[p.starts] += 1
        full[p.ends] -= 1
        inside = np.cumsum(full[:-1], dtype=np.int8).astype(bool)
        n_words = np.diff(p.first)
        unlike = np.ones(len(h), bool)
        unlike[1:] = (h[1:] != h[:-1]) | (p.doc[1:] != p.doc[:-1])
        breaks = p.data == 10
        dup, lines = np.zeros(p.n, np.int64), p.sums(breaks) + 1
        for i in np.flatnonzero(lines > 1):
            kept = [x for x in p.data[p.at[i] : p.at[i + 1]].tobytes().split(b"\n") if x.strip()]
            dup[i] = len(kept) - len(set(kept))
        parts.append([
            n_words, p.sums(inside & code_points(p.data)), p.sums(_SYMBOL[p.data]), dup,
            repeated_words(h, p.doc, p.n), p.sums(_UPPER[p.data]), p.sums(_LOWER[p.data]), lines,
            np.bincount(p.doc[unlike], minlength=p.n),
        ])
    return [np.concatenate(x) for x in zip(*parts)] if parts else [[]] * 9


def signals(docs: DataFrame, text: str = "text") -> DataFrame:
    """docs with the columns of SIGNALS."""
    import pyarrow as pa

    return appended(docs, SIGNALS, lambda b: [pa.array(x, pa.int64()) for x in _signals(b, text)])


def _vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def default_votes() -> list[Column]:
    """Votes of the rules on the columns of SIGNALS."""
    n, c = F.greatest("n_words", F.lit(1)), F.greatest("word_chars", F.lit(1))
    per_word, cased = F.col("word_chars") / n, F.greatest(F.col("n_upper") + F.col("n_lower"), F.lit(1))
    return [
        _vote(F.col("n_symbols") / n > 0.3, F.col("n_symbols") / n < 0.02),
        _vote(F.col("n_repeat_words") / n > 0.4, F.col("n_repeat_words") / n < 0.1),
        _vote(F.col("n_dup_lines") / F.col("n_lines") > 0.3, (F.col("n_lines") >= 4) & (F.col("n_dup_lines") == 0)),
        _vote(F.col("n_upper") / cased > 0.5, F.col("n_upper") / cased < 0.2),
        _vote((per_word > 14) | (per_word < 2), (per_word > 3) & (per_word < 9)),
        _vote(F.col("n_unlike_words") / n < 0.6, F.col("n_unlike_words") / n > 0.9),
        _vote(F.col("n_symbols") / c > 0.1, F.col("n_symbols") / c < 0.01),
    ]


def base_failed(least_words: int = 50) -> Column:
    """Too few words, or over half of them in repeated windows."""
    return (F.col("n_words") < least_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))


def fit(patterns: np.ndarray, counts: np.ndarray, rounds: int = 100, prior: float = 0.85) -> tuple[float, np.ndarray]:
    """Share of good documents and P(vote | class) as an array (class, rule, vote -1, 0, 1).

    Expectation-maximisation on counted vote patterns. It starts from rules that are right three
    times in four when they vote, which also tells the two classes apart; each table is smoothed
    by that belief, worth a hundredth of the documents, so that no rule turns round.
    """
    shown = patterns[:, :, None] == np.array([-1, 0, 1])  # pattern, rule, vote
    rate = (counts[:, None, None] * shown).sum(0) / counts.sum()
    start = np.stack([rate * [1.5, 1, 0.5], rate * [0.5, 1, 1.5]]) + 1e-3
    start /= start.sum(2, keepdims=True)
    table, share, worth = start.copy(), prior, 0.01 * counts.sum() + 1
    for _ in range(rounds):
        q = posterior(patterns, share, table)
        weight = np.stack([counts * (1 - q), counts * q])
        new = np.einsum("cp,prv->crv", weight, shown) + worth * start
        new /= new.sum(2, keepdims=True)
        share = float(np.clip(weight[1].sum() / counts.sum(), 0.01, 0.99))
        done = np.abs(new - table).max() < 1e-9
        table = new
        if done:
            break
    return share, table


def posterior(patterns: np.ndarray, share: float, table: np.ndarray) -> np.ndarray:
    """Probability that a document with each pattern is good."""
    logs = np.log(table)
    rules = np.arange(patterns.shape[1])
    bad, good = (logs[c][rules, patterns + 1].sum(1) for c in (0, 1))
    return 1 / (1 + np.exp(np.clip(bad - good + np.log((1 - share) / share), -700, 700)))


def judged(docs: DataFrame, votes: list[Column] | None = None, least: float = 0.5, text: str = "text") -> DataFrame:
    """docs with SIGNALS, votes (array), quality (0 to 1), base_failed and kept.

    Two passes over the texts: one counts patterns, one judges. Only counts of patterns reach the
    driver, at most 3 ** rules of them.
    """
    votes = votes or default_votes()
    if len(votes) > 12:
        raise ValueError("patterns of over 12 rules are too many to count: group the rules")
    seen = signals(docs, text).withColumn("votes", F.array(*[v.cast("int") for v in votes]))
    counted = signals(docs.select(F.col(f"`{text}`")), text).select(F.array(*[v.cast("int") for v in votes]).alias("votes"))
    rows = counted.groupBy("votes").count().orderBy("votes").collect()
    if not rows:
        return seen.withColumns({"quality": F.lit(0.0), "base_failed": F.lit(True), "kept": F.lit(False)})
    patterns = np.array([r["votes"] for r in rows])
    share, table = fit(patterns, np.array([r["count"] for r in rows], float))
    logs = np.log(table[1] / table[0])
    odds = F.lit(float(np.log(share / (1 - share))))
    for i in range(len(votes)):
        bad, none, good = (float(x) for x in logs[i])
        odds = odds + F.when(F.get("votes", F.lit(i)) < 0, bad).when(F.get("votes", F.lit(i)) > 0, good).otherwise(none)
    return (
        seen.withColumn("quality", 1 / (1 + F.exp(-odds)))
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))
    )
