"""Secret scan: base patterns, and a linear-chain conditional random field that adds spans.

A token is a run of letters, digits, `_ + / -` and non-ASCII characters. The field tags tokens as
begin, inside or outside of a secret, from the token's shape, its neighbours (keyword before,
`=` or `:` and quotes around it, shapes beside it) and its document (share of digits, length). It
is trained on a bounded sample of documents (`sample`, those of the smallest hash of their text),
whose base matches are the labels, by gradient ascent on the likelihood with forward-backward.
Decoding is exact Viterbi: a token whose lead for outside exceeds twice the range of the
transition scores is outside in every best path, so only the runs between such tokens are decoded.

Defined results: a null text is empty and has no spans; if the sample has no base match, or there
are no documents, only base spans are returned; equal texts get equal spans. A tagged run that
overlaps a base span is dropped, base spans always stay. Columns of the same name as a result are
replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import appended, slices
from .words import Piece, code_points, pieces

# fixed values: the base patterns and the least lengths of what they find
KINDS = ("assign", "access", "hex", "tagged")
ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE
)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
KEYWORDS = (b"password", b"passwd", b"secret", b"token", b"apikey", b"api_key")

_GAP = np.ones(256, bool)
_GAP[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256), *b"_+/-"]] = False
_DIGIT, _UPPER, _LOWER, _HEX = (np.zeros(256, np.int8) for _ in range(4))
_DIGIT[48:58] = _UPPER[65:91] = _LOWER[97:123] = _HEX[48:58] = _HEX[97:103] = 1
_SETS, _QUOTE = np.zeros(256, np.int8), np.zeros(256, np.int8)
_SETS[list(b"=:")] = 1
_QUOTE[list(b"\"'")] = 1

#: number of values of each categorical feature
SIZES = (7, 5, 5, 3, 4, 2, 2, 2, 4, 2, 4, 4, 3, 3)
OFFSETS = np.concatenate([[0], np.cumsum(SIZES)])
SPANS = "array<struct<kind: string, start: bigint, stop: bigint>>"


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """Matches of the base patterns, leftmost and non-overlapping for each kind, by start, then kind."""
    out = []
    # `=` or `:` must follow a keyword, which all hold one of these in some case
    low = text.lower()
    if any(k in low for k in ("passw", "secret", "token", "api")):
        out += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    if "AKIA" in text:
        out += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 20]
    out += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(out, key=lambda s: (s[1], KINDS.index(s[0])))


def value_spans(text: str) -> list[tuple[int, int]]:
    """The secrets themselves in the base matches: of an assignment, what is assigned."""
    return [m.span(2) for m in ASSIGN.finditer(text) if len(m[2]) >= 6] + [(a, b) for kind, a, b in base_spans(text) if kind != "assign"]


def _shift(x: np.ndarray, by: int, same: np.ndarray) -> np.ndarray:
    out = np.zeros_like(x)
    if by > 0:
        out[1:] = np.where(same[1:], x[:-1], 0)
    else:
        out[:-1] = np.where(same[1:], x[1:], 0)
    return out


def token_features(p: Piece) -> np.ndarray:
    """(tokens, features): rows of the weight table for each token of a piece."""
    n, size = len(p.starts), p.ends - p.starts
    if not n:
        return np.zeros((0, len(SIZES)), np.int64)

    def count(table: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(table[p.data], dtype=np.int32)])
        return total[b] - total[a]

    digits, upper, lower, hexes = (count(t, p.starts, p.ends) for t in (_DIGIT, _UPPER, _LOWER, _HEX))
    kind = _DIGIT[p.data] + 2 * (_UPPER[p.data] | _LOWER[p.data])
    turn = np.zeros(len(p.data) + 1, np.int32)
    turn[2:] = np.cumsum(kind[1:] != kind[:-1], dtype=np.int32) if len(kind) > 1 else 0
    turns = turn[p.ends] - turn[p.starts + 1]
    same = np.concatenate([[False], p.doc[1:] == p.doc[:-1]])
    # the gap before a token starts where the one before ends, or with the text
    gap_from = np.where(same, np.concatenate([[0], p.ends[:-1]]), p.at[p.doc])
    gap_to = np.where(np.concatenate([same[1:], [False]]), np.concatenate([p.starts[1:], [len(p.data)]]), p.at[p.doc + 1])
    sets = np.minimum(1, count(_SETS, gap_from, p.starts))
    quoted = np.minimum(1, count(_QUOTE, gap_from, p.starts)) + 2 * np.minimum(1, count(_QUOTE, p.ends, gap_to))
    key = np.zeros(n, np.int64)
    low = p.data | np.uint8(32) * ((p.data >= 65) & (p.data <= 90)).astype(np.uint8)
    for k in {len(k) for k in KEYWORDS}:
        at = np.flatnonzero(size == k)
        if len(at):
            found = low[p.starts[at][:, None] + np.arange(k)]
            for w in KEYWORDS:
                if len(w) == k:
                    key[at[(found == np.frombuffer(w, np.uint8)).all(1)]] = 1
    share = np.where(digits == 0, 0, np.where(digits == size, 4, 1 + np.minimum(2, 3 * digits // size)))
    case = np.where(upper == 0, 0, np.where(upper + digits == size, 2, 1))
    letters = (lower > 0) + 2 * (upper > 0)
    dense = np.minimum(3, turns // 2)
    doc_digits = p.sums(_DIGIT[p.data])
    size_of = np.maximum(1, np.diff(p.at))
    doc_kind = np.where(doc_digits == 0, 0, np.where(doc_digits * 50 < size_of, 1, 2))
    doc_size = np.minimum(2, np.diff(p.first) // 200)
    length = np.searchsorted([4, 8, 12, 16, 24, 40], size, "right")
    rare = (digits > 0) + 2 * (size >= 16)
    values = (
        length, share, np.where(digits > 0, 1 + dense, 0), case, letters, hexes == size, (hexes == size) & (size >= 16) & (digits > 0),
        _shift(key, 1, same), quoted, sets, _shift(rare, 1, same), _shift(rare, -1, same), doc_kind[p.doc], doc_size[p.doc],
    )
    return np.stack([np.asarray(v, np.int64) + OFFSETS[i] for i, v in enumerate(values)], 1)


@dataclass
class Field:
    """Scores of a linear chain; states: outside, begin, inside."""

    weights: np.ndarray  # (feature values, 3)
    moves: np.ndarray  # (3, 3)
    open: np.ndarray  # (3,) before the first token

    def viterbi(self, scores: np.ndarray, left: bool, right: bool) -> np.ndarray:
        """Best tags of a run; left, right: an outside token stands there, else the text ends."""
        now = scores[0] + (self.moves[0] if left else self.open)
        back = []
        for row in scores[1:]:
            ways = now[:, None] + self.moves
            back.append(ways.argmax(0))
            now = ways.max(0) + row
        if right:
            now = now + self.moves[:, 0]
        tags = [int(now.argmax())]
        for b in reversed(back):
            tags.append(int(b[tags[-1]]))
        return np.array(tags[::-1])

    def tags(self, rows: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Tags of all tokens; rows: token_features."""
        out = np.zeros(len(rows), np.int8)
        if not len(rows):
            return out
        lead = self.weights[:, 1:] - self.weights[:, :1]
        most = np.full(len(rows), -np.inf)
        for s in range(2):
            x = np.zeros(len(rows))
            for f in range(rows.shape[1]):
                x += lead[rows[:, f], s]
            most = np.maximum(most, x)
        everything = np.concatenate([self.moves.ravel(), self.open])
        open_ = most >= -2 * (everything.max() - everything.min())
        at = np.flatnonzero(open_)
        if not len(at):
            return out
        cut = np.flatnonzero((np.diff(at) > 1) | (doc[at[1:]] != doc[at[:-1]])) + 1
        for run in np.split(at, cut):
            a, b = run[0], run[-1]
            left = a > 0 and doc[a - 1] == doc[a]
            right = b + 1 < len(doc) and doc[b + 1] == doc[b]
            out[a : b + 1] = self.viterbi(self.weights[rows[a : b + 1]].sum(1), left, right)
        return out


def _labelled(text: str, around: int, plain: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Training chains of a text: tokens around its secrets, and `plain` tokens from its middle."""
    p = next(pieces(pa.array([text])))
    p.split(_GAP)
    rows = token_features(p)
    if not len(rows):
        return []
    points = np.concatenate([[0], np.cumsum(code_points(p.data))])
    tags = np.zeros(len(rows), np.int64)
    for a, b in sorted(value_spans(text)):
        inside = np.flatnonzero((points[p.starts] < b) & (points[p.ends] > a))
        tags[inside[:1]], tags[inside[1:]] = 1, 2
    chains, taken = [], np.zeros(len(rows), bool)
    for i in np.flatnonzero(tags == 1):
        if not taken[i]:
            a, b = max(0, i - around), min(len(rows), i + around + 1)
            taken[a:b] = True
            chains.append((rows[a:b], tags[a:b]))
    a = max(0, len(rows) // 2 - plain // 2)
    if not taken[a : a + plain].any():
        chains.append((rows[a : a + plain], tags[a : a + plain]))
    return chains


def varied(chains: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[np.ndarray, np.ndarray]]:
    """The chains, and those with a secret again with one kind of evidence taken from its tokens.

    Base patterns show few forms of secrets, all with all the evidence. Without a keyword, with
    letters of both cases instead of hexadecimal digits, or in other lengths a secret is still one.
    """
    case, letters, hexes, long_hex, key, sets = (OFFSETS[i] for i in (3, 4, 5, 6, 7, 9))
    out = list(chains)
    for rows, tags in chains:
        at = np.flatnonzero(tags)
        if len(at):
            mixed = {3: case + 1, 4: letters + 3, 5: hexes, 6: long_hex}
            for change in ({7: key, 9: sets}, mixed, mixed | {0: 3, 7: key}, mixed | {0: 5, 9: sets}, {0: 3, 6: long_hex}, {0: 4, 9: sets}):
                new = rows.copy()
                for f, v in change.items():
                    new[at, f] = v
                out.append((new, tags))
    return out


def train(chains: list[tuple[np.ndarray, np.ndarray]], rounds: int = 200, rate: float = 0.2, ridge: float = 1e-4) -> Field:
    """Maximise the chains' likelihood (Adam on the exact gradient)."""
    long = max(len(t) for _, t in chains)
    n, f = len(chains), chains[0][0].shape[1]
    rows, tags, real = np.zeros((n, long, f), np.int64), np.zeros((n, long), np.int64), np.zeros((n, long), bool)
    for i, (r, t) in enumerate(chains):
        rows[i, : len(t)], tags[i, : len(t)], real[i, : len(t)] = r, t, True
    hot = np.eye(3)[tags] * real[:, :, None]
    pairs = np.einsum("nta,ntb->ab", hot[:, :-1], hot[:, 1:])
    values = [np.zeros((OFFSETS[-1], 3)), np.zeros((3, 3)), np.zeros(3)]
    first, second = [np.zeros_like(v) for v in values], [np.zeros_like(v) for v in values]
    kinds, of = np.unique(rows.reshape(-1, f), axis=0, return_inverse=True)
    of = of.reshape(n, long)
    for step in range(1, rounds + 1):
        w, moves, start = values
        scores = w[kinds].sum(1)[of]
        alpha, beta = np.zeros((n, long, 3)), np.zeros((n, long, 3))
        alpha[:, 0] = scores[:, 0] + start
        for t in range(1, long):
            x = alpha[:, t - 1, :, None] + moves
            top = x.max(1)
            alpha[:, t] = np.where(real[:, t, None], top + np.log(np.exp(x - top[:, None]).sum(1)) + scores[:, t], alpha[:, t - 1])
        for t in range(long - 2, -1, -1):
            x = moves + (scores[:, t + 1] + beta[:, t + 1])[:, None, :]
            top = x.max(2)
            beta[:, t] = np.where(real[:, t + 1, None], top + np.log(np.exp(x - top[:, :, None]).sum(2)), 0)
        end = alpha[:, -1]
        total = end.max(1) + np.log(np.exp(end - end.max(1, keepdims=True)).sum(1))
        prob = np.exp(np.minimum(0, alpha + beta - total[:, None, None])) * real[:, :, None]
        both = np.exp(np.minimum(0, alpha[:, :-1, :, None] + moves + (scores + beta)[:, 1:, None, :] - total[:, None, None, None]))
        both *= real[:, 1:, None, None]
        miss = np.stack([np.bincount(of[real], (hot - prob)[real][:, s], minlength=len(kinds)) for s in range(3)], 1)
        slope = [np.zeros_like(w), pairs - both.sum((0, 1)), (hot - prob)[:, 0].sum(0)]
        for j in range(f):
            np.add.at(slope[0], kinds[:, j], miss)
        for i, v in enumerate(values):
            g = slope[i] / n - ridge * v
            first[i] = 0.9 * first[i] + 0.1 * g
            second[i] = 0.999 * second[i] + 0.001 * g * g
            values[i] = v + rate * (first[i] / (1 - 0.9**step)) / (np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8)
    return Field(*values)


def fit(docs: DataFrame, sample: int = 4000, around: int = 8, plain: int = 16, most: int = 8, text: str = "text") -> Field | None:
    """Train on a bounded sample of whole documents; None if they hold no base match.

    What reaches the driver is some 17 tokens for each secret, of at most `most` per document, and
    `plain` tokens for each document.
    """
    ranked = docs.filter(F.length(text) > 0).select(F.xxhash64(text).alias("_r"), F.lit(1).alias("_n"))
    cut = ranked.groupBy("_r").agg(F.sum("_n").alias("_n")).orderBy("_r").limit(sample).agg(F.max("_r").alias("r")).first()["r"]
    if cut is None:
        return None

    def chains(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for b in slices(batches):
            out = []
            for r, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if r not in seen:
                    seen.add(r)
                    out += [(r, rows.tobytes(), tags.tobytes()) for rows, tags in _labelled(t, around, plain)[: most + 1]]
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in out], kind) for i, kind in enumerate((pa.int64(), pa.binary(), pa.binary()))], names=["r", "rows", "tags"]
            )

    picked = docs.filter(F.length(text) > 0).select(F.xxhash64(text).alias("_r"), F.col(text)).filter(F.col("_r") <= cut)
    found = {tuple(x) for x in picked.mapInArrow(chains, "r bigint, rows binary, tags binary").collect()}
    got = [
        (np.frombuffer(rows, np.int64).reshape(-1, len(SIZES)), np.frombuffer(tags, np.int64)) for _, rows, tags in sorted((r, bytes(a), bytes(b)) for r, a, b in found)
    ]
    return train(varied(got)) if any((t == 1).any() for _, t in got) else None


def scanned(docs: DataFrame, field: Field | None, text: str = "text") -> DataFrame:
    """docs with spans: base ones and the field's (kind `tagged`), in code points, by start, then kind."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def judge(batch: pa.RecordBatch) -> list:
        column, out = batch.column(text), []
        for p in pieces(column):
            texts = [t.as_py() or "" for t in column.slice(p.start, p.n)]
            spans = [base_spans(t) for t in texts]
            if shared.value is not None:
                p.split(_GAP)
                tags = shared.value.tags(token_features(p), p.doc)
                at = np.flatnonzero(tags)
                runs = np.split(at, np.flatnonzero((np.diff(at) > 1) | (tags[at[1:]] == 1) | (p.doc[at[1:]] != p.doc[at[:-1]])) + 1) if len(at) else []
                for run in runs:
                    row = int(p.doc[run[0]])
                    points = code_points(p.data[p.at[row] : p.ends[run[-1]]])
                    a, b = int(points[: p.starts[run[0]] - p.at[row]].sum()), int(points.sum())
                    if not any(a < y and x < b for kind, x, y in spans[row] if kind != "tagged"):
                        spans[row].append(("tagged", a, b))
            out += [sorted(s, key=lambda s: (s[1], KINDS.index(s[0]))) for s in spans]
        return [pa.array([[dict(zip(("kind", "start", "stop"), s)) for s in x] for x in out],
                         pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())])))]

    return appended(docs, f"spans {SPANS}", judge)


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def redacted(text: Column, spans: Column, mark: str = "<secret>") -> Column:
    """The text with each union of overlapping spans replaced by a mark."""
    start = F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at"))
    done = F.aggregate(
        spans, start,
        lambda s, x: F.struct(
            F.when(x["start"] >= s["at"], F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), (x["start"] - s["at"]).cast("int")), F.lit(mark))).otherwise(s["out"]).alias("out"),
            F.greatest(s["at"], x["stop"]).alias("at"),
        ),
        lambda s: F.concat(s["out"], F.substring(text, (s["at"] + 1).cast("int"), F.length(text))),
    )
    return F.when(F.size(spans) > 0, done).otherwise(text)
