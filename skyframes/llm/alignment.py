"""Alignment of the tokens of two tokenizers, by coalescing their byte intervals.

A byte-level BPE (A) and a piece model with byte fallback (B) cut the same bytes, a space and the
text. The tokens of many texts become intervals of one row of bytes. All of them are sorted by
start (`lexsort`); the running maximum of their ends (`maximum.accumulate`) is what the tokens so
far reach. Where a token starts at or beyond it, a group ends: those are the offsets at which tokens of
A and of B both end. Within a group, overlaps are expanded to links: the tokens of B from the
first that ends after a token of A starts to the last that starts before it ends.

Corpus counts: a pair of ids counts once for each row that holds it linked. Texts are not read
again for that: a stage table keeps each row's distinct pairs. Counting combines in the tasks.
Scoring a row needs the counts of its pairs; the pairs in most documents, at most `sent` of them,
which make up nearly all links, go to every task, and only links of rarer pairs are shuffled.
Sums combine in the task that holds the row.

The files of the tokenizers are read by the driver and sent along (their size is fixed).

Defined results: a null or empty text, and one whose joined tokens of A or B differ from the space and the
text, has no tokens, no links and the groups ''. Each row is a document of its own, so repeated
rows count each and a null id is as good as any. Texts are never cut, so memory is bounded by the
longest one. An empty table gives no rows. Input columns other than id and text are not read.
"""

from __future__ import annotations

import os
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import slices, stored

TOKENIZERS = "/opt/tokenizers"
_PIECE = 1 << 18
_SCHEMA = (
    "row bigint, doc_id {kind}, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, "
    "a array<int>, b array<int>, times array<int>"
)


def byte_alphabet() -> dict[str, int]:
    """The characters by which byte-level vocabularies write bytes: printable ones as they are, the others from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


class Vocabulary:
    """A tokenizer with the bytes of each of its tokens."""

    def __init__(self, tokens: list[bytes], encode):
        self.tokens, self.encode = tokens, encode
        self.size = np.array([len(t) for t in tokens], np.int64)
        self.digits = np.char.encode(np.arange(len(tokens)).astype(str)).view(np.uint8).reshape(len(tokens), -1)

    def ids(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text with a space before it; None where the tokens' bytes are not those of the space and the text."""
        out = []
        for text, ids in zip(texts, self.encode(texts)):
            same = b"".join([self.tokens[i] for i in ids]) == b" " + text.encode()
            out.append(np.array(ids, np.int32) if same else None)
        return out


@lru_cache(4)
def byte_level(raw: bytes) -> Vocabulary:
    """A: a tokenizers file. It is given the space."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # the cores are Spark's
    from tokenizers import Tokenizer

    tool, alphabet = Tokenizer.from_str(raw.decode()), byte_alphabet()
    tool.encode_special_tokens = True
    known = {i: t for t, i in tool.get_vocab(with_added_tokens=True).items()}
    tokens = [bytes(alphabet[c] for c in known[i]) if i in known and all(c in alphabet for c in known[i]) else b"" for i in range(max(known) + 1)]
    return Vocabulary(tokens, lambda texts: [e.ids for e in tool.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)])


@lru_cache(4)
def piece_level(raw: bytes) -> Vocabulary:
    """B: a sentencepiece file. It adds the space itself."""
    from sentencepiece import SentencePieceProcessor

    tool = SentencePieceProcessor(model_proto=raw)
    tokens = [bytes([int(tool.id_to_piece(i)[1:-1], 16)]) if tool.is_byte(i) else tool.id_to_piece(i).replace("▁", " ").encode() for i in range(tool.get_piece_size())]
    return Vocabulary(tokens, lambda texts: tool.encode(texts, num_threads=1))


def tiles(size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of intervals of the given sizes, one after the other."""
    end = np.cumsum(size)
    return end - size, end


def coalesced(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Group numbers (from 0) of the intervals of A and of B: a group ends where an interval starts at what the ones so far reach."""
    start, end = np.concatenate([start_a, start_b]), np.concatenate([end_a, end_b])
    order = np.lexsort((end, start))
    reach = np.maximum.accumulate(end[order])
    new = np.ones(len(order), bool)
    new[1:] = start[order][1:] >= reach[:-1]
    group = np.empty(len(order), np.int64)
    group[order] = np.cumsum(new) - 1
    return group[: len(start_a)], group[len(start_a) :]


def overlaps(start_a: np.ndarray, end_a: np.ndarray, start_b: np.ndarray, end_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of intervals of A and of B that overlap; those of a side are ascending and apart."""
    low = np.searchsorted(end_b, start_a, "right")
    n = np.searchsorted(start_b, end_a, "left") - low
    a = np.repeat(np.arange(len(start_a)), n)
    return a, np.arange(len(a)) + np.repeat(low - (np.cumsum(n) - n), n)


def _written(a: np.ndarray, group_a: np.ndarray, b: np.ndarray, group_b: np.ndarray, groups: int, first: np.ndarray, va: Vocabulary, vb: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """The groups of all texts as text, and the number of characters of each token with its separator.

    first: the group with which each text starts. Order: groups, in each the ids of A, then those of B.
    """
    per_a, per_b = np.bincount(group_a, minlength=groups), np.bincount(group_b, minlength=groups)
    at_a = np.arange(len(a)) + (np.cumsum(per_b) - per_b)[group_a]
    at_b = np.arange(len(b)) + np.cumsum(per_a)[group_b]
    wide = max(va.digits.shape[1], vb.digits.shape[1])
    out = np.zeros((len(a) + len(b), 1 + wide), np.uint8)
    for at, ids, group, v, mark in ((at_a, a, group_a, va, b";"), (at_b, b, group_b, vb, b"|")):
        lead = np.ones(len(ids), bool)
        lead[1:] = group[1:] != group[:-1]
        sep = np.where(lead, mark[0], ord(","))
        if v is va:
            sep[lead & np.isin(group, first)] = 0
        out[at, 0] = sep
        # digit tables hold UCS-free bytes: unused places are 0 and vanish
        out[at, 1 : 1 + v.digits.shape[1]] = v.digits[ids]
    return out[out != 0], np.count_nonzero(out, axis=1)


def _align(texts: list[str | None], va: Vocabulary, vb: Vocabulary) -> list[list]:
    """Columns n_a, n_b, n_groups, n_links, groups, a, b, times of some texts."""
    n = len(texts)
    some = [i for i, t in enumerate(texts) if t]
    both = {i: (x, y) for i, x, y in zip(some, va.ids([texts[i] for i in some]), vb.ids([texts[i] for i in some])) if x is not None and y is not None}
    none = np.zeros(0, np.int32)
    ids = [both.get(i, (none, none)) for i in range(n)]
    sizes = [np.array([len(x[k]) for x in ids], np.int64) for k in (0, 1)]
    a, b = (np.concatenate([x[k] for x in ids] + [none]) for k in (0, 1))
    doc_a = np.repeat(np.arange(n), sizes[0])
    span_a, span_b = tiles(va.size[a]), tiles(vb.size[b])
    group_a, group_b = coalesced(*span_a, *span_b)
    i, j = overlaps(*span_a, *span_b)
    groups = int(group_a[-1]) + 1 if len(group_a) else 0
    lead = np.searchsorted(doc_a, np.flatnonzero(sizes[0]))
    written, chars = _written(a, group_a, b, group_b, groups, group_a[lead], va, vb)
    per_group_doc = np.zeros(groups, np.int64)
    per_group_doc[group_a] = doc_a
    ends = np.concatenate([[0], np.cumsum(chars)])[np.concatenate([[0], np.cumsum(sizes[0] + sizes[1])])]
    text = written.tobytes().decode()
    # distinct pairs of each text and how often they are linked
    wide = np.int64(len(vb.tokens))
    key, times = np.unique((doc_a[i] * np.int64(len(va.tokens)) + a[i]) * wide + b[j], return_counts=True)
    doc, pair = np.divmod(key, wide * len(va.tokens))
    at = np.searchsorted(doc, np.arange(n + 1)).astype(np.int32)
    lists = [pa.ListArray.from_arrays(pa.array(at), pa.array(x.astype(np.int32))) for x in (pair // wide, pair % wide, times)]
    return [
        sizes[0], sizes[1], np.bincount(per_group_doc, minlength=n), np.bincount(doc_a[i], minlength=n),
        [text[x:y] for x, y in zip(ends[:-1], ends[1:])], *lists,
    ]


def _chunks(column: list[str | None]) -> Iterator[slice]:
    """Rows of about _PIECE characters together; a text is never cut."""
    start = held = 0
    for i, text in enumerate(column):
        if held and held + len(text or "") > _PIECE:
            yield slice(start, i)
            start, held = i, 0
        held += len(text or "")
    if start < len(column):
        yield slice(start, len(column))


def aligned(docs: DataFrame, a_file: str = f"{TOKENIZERS}/byte_bpe_50k.json", b_file: str = f"{TOKENIZERS}/piece_bpe_32k.model", text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """A row per row of docs: row (a number), doc_id, n_a, n_b, n_groups, n_links, groups, and its distinct pairs.

    groups: ids by group, `a1,a2|b1;a3|b2,b3`. a, b, times: the linked pairs of ids and their links.
    """
    raw = [open(f, "rb").read() for f in (a_file, b_file)]
    shared = docs.sparkSession.sparkContext.broadcast(raw)

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        va, vb = byte_level(shared.value[0]), piece_level(shared.value[1])
        for batch in slices(batches):
            texts = batch.column("text").to_pylist()
            for some in _chunks(texts):
                made = _align(texts[some], va, vb)
                own = batch.slice(some.start, some.stop - some.start)
                arrays = [x if isinstance(x, pa.Array) else pa.array(x) for x in made]
                arrays[4] = arrays[4].cast(pa.string())
                yield pa.RecordBatch.from_arrays([own.column("row"), own.column("doc_id"), *arrays], names=[c.split()[0] for c in _SCHEMA.split(", ")])

    rows = docs.select(F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(align, _SCHEMA.format(kind=dict(docs.dtypes)[doc_id]))


def _links(rows: DataFrame) -> DataFrame:
    each = rows.select("row", F.inline(F.arrays_zip("a", "b", "times")))
    return each.select("row", F.shiftleft(F.col("a").cast("bigint"), 32).bitwiseOR(F.col("b").cast("bigint")).alias("pair"), "times")


def counted(rows: DataFrame) -> DataFrame:
    """(pair, docs, best): in how many rows each pair is linked, and whether no other pair of its id of A is in more."""
    pairs = stored(_links(rows).groupBy("pair").agg(F.count("*").alias("docs")), "pairs")
    a = F.shiftright("pair", 32)
    most = stored(pairs.groupBy(a.alias("_a")).agg(F.max("docs").alias("_most")), "best-pairs")
    return stored(pairs.join(most, a == F.col("_a")).select("pair", "docs", (F.col("docs") == F.col("_most")).alias("best")), "pair-counts")


def _common(spark: SparkSession, pairs: DataFrame, sent: int) -> int:
    """The least power of two for which at most `sent` pairs are in as many documents."""
    level = F.floor(F.log2("docs")).cast("int")
    held = 0
    by = {r["level"]: r["count"] for r in pairs.groupBy(level.alias("level")).count().collect()}  # at most 63 levels
    for at in sorted(by, reverse=True):
        held += by[at]
        if held > sent:
            return 1 << (at + 1)
    return 1


def scored(rows: DataFrame, sent: int = 1 << 18) -> DataFrame:
    """rows (a stage table of `aligned`) with n_best and count_sum instead of their pairs.

    n_best: links whose pair is in as many rows as any pair of its id of A; count_sum: the sum of the pairs' counts over all links.
    """
    pairs, links = counted(rows), _links(rows)
    least = _common(rows.sparkSession, pairs, sent)
    common = pairs.filter(F.col("docs") >= least)
    met = links.join(F.broadcast(common), "pair")
    if least > 1:
        rest = links.join(F.broadcast(common.select("pair")), "pair", "left_anti")
        met = met.unionByName(rest.join(pairs.filter(F.col("docs") < least), "pair"))
    sums = met.groupBy("row").agg(
        F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).cast("bigint").alias("n_best"), F.sum(F.col("times") * F.col("docs")).alias("count_sum")
    )
    zero = F.lit(0).cast("bigint")
    out = rows.drop("a", "b", "times").join(stored(sums, "pair-sums"), "row", "left")
    return out.withColumns({c: F.coalesce(c, zero) for c in ("n_best", "count_sum")}).drop("row")
