"""Similarity join on word n-grams by prefix filters under several global token orders.

Documents link when |A & B| / |A | B| >= percent / 100 of their distinct n-gram sets; the result is
the connected components of the links.

Let n be a set's size and m = n - ceil(n * percent / 100) the tokens that it may hold besides the
common ones. Under any global order the first l common tokens of a linked pair are among the first
m + l of either set. So:

1. Equal sets become one class; only its least document goes on.
2. Order 1 (by hash): a document needs some l of its first m + l tokens to occur in the prefix of
   another set. Text of its own keeps nearly all documents from that, and they are done.
3. Stars: those left meet under the first token of each of several orders; each is compared to the
   least document it meets there. That finds most links of large groups without all their pairs.
4. Order 2 (another hash, a longer prefix): of a document not yet linked to another one's component,
   l of the first m + l tokens must occur in another component. Few documents are left.
5. Orders 3 and 4 (rarest first among those left, ties by two hashes): pairs of different components
   that share a prefix token under both orders, at places that leave room for a link, are verified.

Pairs inside one component need no check, so no link that matters is lost and large groups are
never paired out. Tokens are 64-bit hashes; verification compares whole sets.

Defined results: a null or empty text has no n-gram and links with nothing; a text of fewer words
has its whole sequence as its only n-gram. Rows of one id are one document for reachability; each
row keeps its own n_shingles. A row without id gets a null component.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .tables import appended, likely_in, slices, stored
from .words import Piece, grams, mixed, pieces

_STARS = 8  # orders whose first tokens bring documents together
_SIGNATURE = 16
_SET = "h1 bigint, h2 bigint"


def sets(p: Piece, k: int) -> list[np.ndarray]:
    """Sorted distinct tokens of each text of a split piece; A-Z count as a-z."""
    h = p.hashes(folded=True)
    g, at = grams(h, p.doc, k)
    first = np.searchsorted(p.doc[at] if len(at) else at, np.arange(p.n + 1))
    out = []
    for i in range(p.n):
        if first[i] < first[i + 1]:
            out.append(np.unique(g[first[i] : first[i + 1]]))
        else:
            words = h[p.first[i] : p.first[i + 1]]
            out.append(grams(words, np.zeros(len(words), int), len(words), 2)[0] if len(words) else words)
    return out


def slack(n: int, percent: int) -> int:
    """How many tokens of a set of n a linked set may lack."""
    return n * (100 - percent) // 100


def prefix(n: int, percent: int, extra: int) -> tuple[int, int]:
    """Length of the prefix, and how many of its tokens any linked set's prefix shares at least; extra: percent of n."""
    least = -(-n * percent // 100)  # size of the smallest set it can link with
    return min(n, slack(n, percent) + 1 + n * extra // 100), 1 + least * extra // 100


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    ends = np.concatenate([[0], np.cumsum([len(x) for x in parts])]).astype(np.int32)
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat.view(np.int64)))


def _ordered(tokens: np.ndarray, salt: int) -> np.ndarray:
    return tokens[np.argsort(mixed(tokens, salt))]


def _hashes(x: np.ndarray) -> tuple[int, int]:
    return tuple(int(mixed(x, salt).sum(dtype=np.uint64).view(np.int64)) for salt in (10, 11))


def described(docs: DataFrame, k: int, percent: int, text: str, extra: int = 5) -> DataFrame:
    """docs without text, with n, the set's hashes, order 1's prefix and how many of it must be shared."""

    def judge(batch: pa.RecordBatch) -> list:
        n, hashes, heads, need = [], [], [], []
        for p in pieces(batch.column(text)):
            for x in sets(p.split(), k):
                length, least = prefix(len(x), percent, extra)
                n.append(len(x))
                hashes.append(_hashes(x))
                heads.append(x[: length if len(x) else 0])
                need.append(least)
        return [n, [h[0] for h in hashes], [h[1] for h in hashes], need, _lists(heads)]

    return appended(docs, f"n bigint, {_SET}, need bigint, head array<bigint>", judge, (text,))


def _detailed(docs: DataFrame, k: int, percent: int, extra: int = 30) -> DataFrame:
    """Rows (doc_id, h1, text) whose text has that set, with n, a signature and order 2's prefix."""

    def judge(batch: pa.RecordBatch) -> list:
        n, marks, heads, need, same = [], [], [], [], []
        wanted = batch.column("h1").to_pylist()
        for p in pieces(batch.column("text")):
            for x in sets(p.split(), k):
                length, least = prefix(len(x), percent, extra)
                same.append(wanted[len(n)] == _hashes(x)[0])
                n.append(len(x))
                marks.append(np.array([mixed(x, 20 + i).min() for i in range(_SIGNATURE)]))
                heads.append(_ordered(x, 12)[:length])
                need.append(least)
        return [n, _lists(marks), _lists(heads), need, same]

    made = appended(docs, "n bigint, marks array<bigint>, head array<bigint>, need bigint, same boolean", judge)
    return made.filter("same").drop("same")


def verified(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, b) that link; texts: doc_id, text."""
    side = texts.select("doc_id", "text")
    both = pairs.join(side.withColumnsRenamed({"doc_id": "a", "text": "ta"}), "a").join(side.withColumnsRenamed({"doc_id": "b", "text": "tb"}), "b")

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 256):

            def all_sets(name: str) -> list[np.ndarray]:
                column = batch.column(name).dictionary_encode()
                made = [x for p in pieces(column.dictionary) for x in sets(p.split(), k)]
                return [made[i] for i in column.indices.to_pylist()]

            link = []
            for x, y in zip(all_sets("ta"), all_sets("tb")):
                common = len(np.intersect1d(x, y, assume_unique=True))
                link.append(common > 0 and 100 * common >= percent * (len(x) + len(y) - common))
            at = pa.array(np.flatnonzero(link))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])

    kind = dict(pairs.dtypes)["a"]
    return both.select("a", "b", "ta", "tb").mapInArrow(check, f"a {kind}, b {kind}").distinct()


def _sizes_fit(x: Column, y: Column, percent: int) -> Column:
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _stars(known: DataFrame, k: int, percent: int) -> DataFrame:
    """Links to the least document that shares a first token; known: rows of _detailed."""
    met = known.select("doc_id", F.posexplode(F.slice("marks", 1, _STARS)).alias("r", "token"))
    least = met.groupBy("r", "token").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("_z")).filter("a < _z").drop("_z")
    pairs = met.join(least, ["r", "token"]).filter("doc_id != a").select("a", F.col("doc_id").alias("b")).distinct()
    marks = known.select("doc_id", "n", "marks")
    both = pairs.join(marks.withColumnsRenamed({"doc_id": "a", "n": "na", "marks": "ma"}), "a").join(
        marks.withColumnsRenamed({"doc_id": "b", "n": "nb", "marks": "mb"}), "b"
    )
    # only a choice of what to try first: links missed here are found by the later orders
    alike = F.size(F.filter(F.zip_with("ma", "mb", lambda x, y: x == y), lambda x: x))
    tried = both.filter(_sizes_fit(F.col("na"), F.col("nb"), percent) & (alike >= _SIGNATURE // 2)).select("a", "b").distinct()
    return verified(tried, known, k, percent)


def _prefix_pairs(heads: DataFrame, head: str, percent: int) -> DataFrame:
    """Pairs of different components that share a prefix token early enough in both sets.

    heads: doc_id, comp, n, spare (tokens that no other component has; they come first) and an
    order's prefix. A linked pair has at least percent / (100 + percent) of both sizes in common,
    all of them at or after the first common token.
    """
    each = heads.select("doc_id", "comp", "n", "spare", F.posexplode(head).alias("at", "token")).withColumn("rest", F.col("n") - F.col("spare") - F.col("at"))
    each = each.select("token", "doc_id", "comp", "n", "rest")
    by = each.groupBy("token", "comp").count().groupBy("token").agg(
        F.max_by("comp", F.struct("count", "comp")).alias("main"), F.count("*").alias("comps")
    ).filter("comps > 1").drop("comps")
    each = each.join(by, "token")
    # each pair of components but the largest with itself: stragglers against all
    left = each.filter("comp != main").select("token", *[F.col(c).alias(f"{c}_l") for c in ("doc_id", "comp", "n", "rest")])
    enough = (100 + percent) * F.least("rest_l", "rest") >= percent * (F.col("n_l") + F.col("n"))
    return (
        left.join(each, "token").filter((F.col("comp_l") != F.col("comp")) & enough)
        .select(F.least("doc_id_l", "doc_id").alias("a"), F.greatest("doc_id_l", "doc_id").alias("b")).distinct()
    )


def _across(known: DataFrame, found: DataFrame, k: int, percent: int) -> DataFrame:
    """All links between documents of different components of the links found so far."""
    comps = components(found)
    rows = known.join(comps, known["doc_id"] == comps["node"], "left").withColumn("comp", F.coalesce("component", "doc_id")).drop("node", "component")
    tokens = rows.select("doc_id", "h1", "comp", "need", F.explode("head").alias("token"))
    shared = stored(tokens.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("token"), "shared-across")
    open_ = tokens.join(shared, "token").groupBy("doc_id", "h1", "comp", "need").count().filter("count >= need").select("doc_id", "h1", "comp")
    open_ = stored(open_, "open-ids")
    left = stored(known.select("doc_id", "h1", "n", "text").filter(likely_in(open_, "doc_id")).join(open_, ["doc_id", "h1"]), "open")
    full = stored(appended(left, "tokens array<bigint>", lambda b: [_lists([x for p in pieces(b.column("text")) for x in sets(p.split(), k)])], ("text",)), "open-tokens")
    each = full.select("doc_id", "h1", "comp", "n", F.explode("tokens").alias("token"))
    live = each.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("df")).filter("lo < hi").select("token", "df")
    live = stored(live, "live-tokens")
    alive = each.join(live, "token").groupBy("doc_id", "h1", "comp", "n").agg(F.collect_set(F.struct("df", "token")).alias("alive"))
    slots = F.col("n") - F.ceil(F.col("n") * percent / 100) + 1 - F.col("spare")

    def first(salt: int) -> Column:
        """Order 3 or 4: rarest first, then by a hash."""
        keyed = F.transform("alive", lambda t: F.struct(t["df"].alias("df"), F.xxhash64(t["token"], F.lit(salt)).alias("by"), t["token"].alias("token")))
        return F.transform(F.slice(F.array_sort(keyed), 1, slots.cast("int")), lambda t: t["token"])

    spared = alive.withColumn("spare", F.col("n") - F.size("alive")).filter(slots > 0)
    heads = stored(spared.select("doc_id", "comp", "n", "spare", first(1).alias("three"), first(2).alias("four")), "heads")
    pairs = _prefix_pairs(heads, "three", percent).intersect(_prefix_pairs(heads, "four", percent))
    return verified(stored(pairs, "pairs"), left, k, percent)


def linked(docs: DataFrame, k: int = 5, percent: int = 80, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    all_ = stored(described(rows, k, percent, "text"), "sets")
    real = all_.filter("n > 0 and doc_id is not null")
    least = real.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.max("doc_id").alias("_z")).filter("least < _z").drop("_z")
    copies = stored(real.select("doc_id", "h1", "h2").join(least, ["h1", "h2"]).filter("doc_id != least").select("doc_id", "h1", "least").distinct(), "copies")
    equal = copies.select(F.col("least").alias("a"), F.col("doc_id").alias("b"))
    own = real.join(copies, ["doc_id", "h1"], "left_anti")
    tokens = own.select("doc_id", F.explode("head").alias("token"))
    # a table of its own, so that the join with it can split a hot token
    shared = stored(tokens.groupBy("token").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi")).filter("lo < hi").select("token"), "shared")
    # counts of an id with several texts are joint, which only lets more of them pass
    counts = stored(tokens.join(shared, "token").groupBy("doc_id").count(), "shared-tokens")
    first = own.select("doc_id", "h1", "need").join(counts, "doc_id").filter("count >= need").select("doc_id", "h1").distinct()
    passed = stored(first, "passed")
    texts = rows.filter("doc_id is not null").filter(likely_in(passed, "doc_id")).join(passed, "doc_id")
    known = stored(_detailed(texts, k, percent), "survivors")
    found = stored(_stars(known, k, percent), "stars")
    across = stored(_across(known, found, k, percent), "across")
    comps = components(reduce(DataFrame.union, [found, across, equal]))
    out = all_.join(comps, all_["doc_id"] == comps["node"], "left")
    return out.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"))
