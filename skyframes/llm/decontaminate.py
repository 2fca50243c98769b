"""Benchmark decontamination with one Aho-Corasick automaton.

Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A window is `width`
consecutive words of an item; an item of fewer words, but not none, is one window. The automaton
holds all windows as strings of words between single spaces; each text is normalised the same way
and scanned once, so a window matches whole words only. Matches are mapped back to word positions
and to code points of the text as it came.

Defined results: a null or empty text has no words and is clean; a null or empty item has no
window; equal items each count; item ids may repeat (counted once) or be null (left out of the
list of ids). Rows are judged one by one, so repeated rows and ids give equal results. Columns of
the same name as a result are replaced; all others stay.
"""

from __future__ import annotations

import re

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import appended

# fixed values: A-Z become a-z; bytes outside [0-9a-z] and the non-ASCII ones stand between words
_TO = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)
_WORD = re.compile(rb"[^ ]+")

RESULT = (
    "n_words bigint, n_hit bigint, items array<string>, contaminated boolean, "
    "spans array<struct<start: bigint, stop: bigint>>"
)


def normal(text: str | None) -> list[bytes]:
    """Words of a text."""
    return text.encode().translate(_TO).split() if text else []


def windows(text: str | None, width: int) -> set[bytes]:
    w = normal(text)
    n = min(width, len(w))
    return {b" ".join(w[i : i + n]) for i in range(len(w) - n + 1)} if n else set()


def automaton(items: list[tuple[str | None, str | None]], width: int) -> tuple[ahocorasick.Automaton, list[list[str]]]:
    """The automaton over the windows of all items, and the ids of the items that have each window.

    One byte is one character in it, so offsets are byte offsets of the normalised text.
    """
    owners: dict[bytes, set[str]] = {}
    for item, text in items:
        for w in windows(text, width):
            owners.setdefault(w, set()).update([] if item is None else [item])
    found = ahocorasick.Automaton()
    for n, w in enumerate(owners):
        found.add_word(f" {w.decode('latin-1')} ", (n, len(w)))
    if owners:
        found.make_automaton()
    return found, [sorted(x) for x in owners.values()]


def scan(text: str | None, found: ahocorasick.Automaton, owners: list[list[str]]) -> tuple:
    """(words, words hit, item ids, spans hit as code points of the text)."""
    raw = text.encode().translate(_TO) if text else b""
    words = raw.split()
    if not words or not owners:
        return len(words), 0, [], []
    flat = b" " + b" ".join(words) + b" "
    matches = list(found.iter(flat.decode("latin-1")))
    if not matches:
        return len(words), 0, [], []
    at = np.concatenate([[1], 2 + np.cumsum([len(w) for w in words]) + np.arange(len(words))])  # starts in flat
    turns = np.zeros(len(words) + 1, np.int64)
    items: set[str] = set()
    for end, (n, size) in matches:
        first = np.searchsorted(at, end - size)  # end: of the closing space
        turns[first] += 1
        turns[np.searchsorted(at, end + 1)] -= 1
        items.update(owners[n])
    hit = np.cumsum(turns[:-1]) > 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit, [0]])))
    places = [m.span() for m in _WORD.finditer(raw)]
    points = np.concatenate([[0], np.cumsum((np.frombuffer(text.encode(), np.uint8) & 0xC0) != 0x80)])
    spans = [(int(points[places[a][0]]), int(points[places[b - 1][1]])) for a, b in edges.reshape(-1, 2)]
    return len(words), int(hit.sum()), sorted(items), spans


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, width: int = 10, text: str = "text", item_id: str = "item_id",
    item_text: str = "text", most_chars: int = 1 << 28,
) -> DataFrame:
    """docs with n_words, n_hit, items (ids as strings, sorted), contaminated and spans.

    The benchmark is a set of test questions: it is brought to every task, and refused with a
    ValueError if its texts hold more than `most_chars` characters together.
    """
    size = benchmark.agg(F.coalesce(F.sum(F.length(item_text)), F.lit(0)).alias("n")).first()["n"]
    if size > most_chars:
        raise ValueError(f"the benchmark has {size} characters, over most_chars={most_chars}: scan it in parts")
    rows = benchmark.select(F.col(f"`{item_id}`").cast("string"), F.col(f"`{item_text}`").cast("string")).collect()
    items = docs.sparkSession.sparkContext.broadcast([tuple(r) for r in rows])
    made: list = []

    def judge(batch):
        if not made:
            made.append(automaton(items.value, width))
        rows = [scan(t.as_py(), *made[0]) for t in batch.column(text)]
        cols = list(zip(*rows)) if rows else [()] * 4
        spans = [[{"start": a, "stop": b} for a, b in x] for x in cols[3]]
        return [list(cols[0]), list(cols[1]), list(cols[2]), [n > 0 for n in cols[1]], spans]

    return appended(docs, RESULT, judge)
