"""Near-duplicates by an inverted join on the coordinates of MinHash signatures.

Documents link when |A & B| / |A | B| >= percent / 100 of their distinct n-gram sets; the result is
the connected components of the links.

1. A set has a signature of `coordinates` minima, each under another hash. Equal sets become one
   class, whose least document goes on.
2. Every document is posted under each of its coordinate-value pairs. A pair that only one document
   has can't collide, so only shared ones stay, with the number of documents that have them; a
   document with fewer than `matches` of them collides with no one often enough and is done.
3. Prefix: with a document's pairs in order of that number, rarest first, two documents that
   collide at least `matches` times share one before the last `matches` - 1 of either. Only those
   pairs are merged: the frequent ones, from passages that many documents have, fall out.
4. Skip merging: a merge of a list compares its members with its head only. Collisions are counted
   over the lists that two documents share; each document is checked against the head it meets most
   often. Members that turn out linked are skipped in the next merge. So groups of copies, however
   large, are never paired out.
5. What is left are documents that still collide `matches` times with other components. Their lists
   are merged in full, members of different components, smaller ones against all. As a document
   meets many others there whose similarity is less, the merge itself compares sizes and a bitmap
   that has the parity of each n-gram hash: two sets differ in at least as many n-grams as their
   bitmaps do in bits, so a pair that differs in too many is no link.
6. Pairs above the match threshold are confirmed on full sets. The text of a document that others
   are compared with goes once to each task that has some of them, not once with each.

A link of similarity s is missed only if the signatures collide fewer than `matches` times in
`coordinates`: 1e-8 for the defaults at 0.8, less above. Links inside a component need no check.

Defined results: a null or empty text has no n-gram and links with nothing; a text of fewer words
than an n-gram has its whole sequence as its only one. Rows of one id are one document for reachability; each row keeps its
own n_shingles. A row without id links with nothing, gets a null component and is kept. An empty
table gives no rows. Input columns other than id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .graph import components
from .jaccard import sets
from .tables import appended, likely_in, slices, stored
from .words import mixed, pieces

_HUB = 64  # comparisons for which a text is sent again
_WORDS = 16  # of 64 bits, of parities
_BITS = 64 * _WORDS


def _list_array(rows: np.ndarray) -> pa.ListArray:
    at = np.arange(len(rows) + 1, dtype=np.int32) * rows.shape[1]
    return pa.ListArray.from_arrays(pa.array(at), pa.array(rows.ravel().view(np.int64)))


def signature(tokens: list[np.ndarray], coordinates: int) -> np.ndarray:
    """(sets, coordinates): the minimum of each nonempty set under each hash; 0 for empty sets."""
    size = np.array([len(t) for t in tokens], np.int64)
    out = np.zeros((len(tokens), coordinates), np.uint64)
    if size.any():
        flat = np.concatenate(tokens)
        first = (np.cumsum(size) - size)[size > 0]
        for i in range(coordinates):
            out[size > 0, i] = np.minimum.reduceat(mixed(flat, i), first)
    return out


def parities(tokens: list[np.ndarray]) -> np.ndarray:
    """(sets, _WORDS): a bit for each value of a hash of the n-grams, set where an odd number of the set's have it."""
    size = np.array([len(t) for t in tokens], np.int64)
    flat = np.concatenate([*tokens, np.zeros(0, np.uint64)])
    place = np.repeat(np.arange(len(tokens)), size) * _BITS + (mixed(flat, 61) % np.uint64(_BITS)).astype(np.int64)
    odd = (np.bincount(place, minlength=len(tokens) * _BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.uint64).reshape(len(tokens), _WORDS)


def sketched(docs: DataFrame, k: int, coordinates: int, text: str = "text", whole: bool = False) -> DataFrame:
    """docs with n (size of the n-gram set), two hashes of the set, and its signature; whole: also its parities and the text."""

    def judge(batch: pa.RecordBatch) -> list:
        n, same, marks, bits = [], [[], []], [], []
        for p in pieces(batch.column(text)):
            tokens = sets(p.split(), k)
            n += [len(x) for x in tokens]
            for out, salt in zip(same, (62, 63)):
                out += [mixed(x, salt).sum(dtype=np.uint64).view(np.int64) for x in tokens]
            marks.append(signature(tokens, coordinates))
            bits.append(parities(tokens) if whole else None)
        columns = [n, *same, _list_array(np.concatenate([*marks, np.zeros((0, coordinates), np.uint64)]))]
        return [*columns, _list_array(np.concatenate([*bits, np.zeros((0, _WORDS), np.uint64)])), batch.column(text)] if whole else columns

    return appended(docs, "n bigint, h1 bigint, h2 bigint, marks array<bigint>" + (f", bits array<bigint>, {text} string" if whole else ""), judge, (text,))


def _alike(x: str, y: str, bits: Column, percent: int) -> Column:
    """Whether sets of sizes x and y whose parities differ in so many bits can link."""
    # |A ^ B| = |A| + |B| - 2 |A & B|, and a link has 100 |A & B| >= percent |A | B|
    return _fits(F.col(x), F.col(y), percent) & ((100 + percent) * bits <= (100 - percent) * (F.col(x) + F.col(y)))


def _fits(x: Column, y: Column, percent: int) -> Column:
    """Whether sets of these sizes can link."""
    return 100 * F.least(x, y) >= percent * F.greatest(x, y)


def _likely(every: DataFrame, shared: DataFrame, matches: int) -> DataFrame:
    """Ids of the documents that a Bloom filter of shared pairs gives at least `matches` of: all with so many, and few others.

    A document's rows meet in the task that made them, so one row for each is shuffled.
    """
    hit = every.filter(likely_in(shared, "token", 1 << 26))
    return hit.groupBy("doc_id", "h1").count().filter(F.col("count") >= matches).select("doc_id", "h1")


def posted(own: DataFrame, matches: int) -> DataFrame:
    """(doc_id, h1, n, token): the postings that are merged, of documents with enough shared pairs.

    own: doc_id, h1, n, marks of one document of each class.
    """
    every = own.select("doc_id", "h1", "n", F.explode("marks").alias("token"))
    shared = stored(every.groupBy("token").agg(F.count("*").alias("df")).filter("df > 1"), "shared-marks")
    some = own.join(stored(_likely(every, shared, matches), "likely"), ["doc_id", "h1"], "left_semi")
    return stored(_prefixes(some.select("doc_id", "h1", "n", F.explode("marks").alias("token")), shared, ["doc_id", "h1", "n"], matches), "postings")


def _prefixes(every: DataFrame, shared: DataFrame, keys: list[str], matches: int) -> DataFrame:
    """(keys, token): the rarest shared pairs of each document, all but `matches` - 1; documents with fewer than `matches` have none."""
    held = every.join(shared, "token").groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("df", "token"))).alias("held"))
    prefix = F.slice("held", F.lit(1), F.size("held") - matches + 1)
    return held.filter(F.size("held") >= matches).select(*keys, F.inline(prefix)).drop("df")


def _colliding(pairs: DataFrame, known: DataFrame, matches: int, percent: int) -> DataFrame:
    """The pairs (a, ha, b, hb) whose signatures collide at least `matches` times and whose parities allow a link."""
    side = known.select("doc_id", "h1", "n", "marks", "bits")
    left = side.withColumnsRenamed({"doc_id": "a", "h1": "ha", "n": "na", "marks": "ma", "bits": "ba"})
    right = side.withColumnsRenamed({"doc_id": "b", "h1": "hb", "n": "nb", "marks": "mb", "bits": "bb"})
    both = pairs.join(left, ["a", "ha"]).join(right, ["b", "hb"])
    alike = F.size(F.filter(F.zip_with("ma", "mb", lambda x, y: x == y), lambda x: x))
    apart = F.aggregate(F.zip_with("ba", "bb", lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda s, x: s + x)
    return both.filter((alike >= matches) & _alike("na", "nb", apart, percent)).select("a", "ha", "b", "hb")


def confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """The pairs (a, ha, b, hb) whose full sets link, as (a, b); texts: doc_id, h1, text.

    Pairs come together by their first document. Its text is sent once for every `_HUB` of them, and
    a task holds that one set while it streams the others past it.
    """
    pairs = stored(pairs, "to-confirm")
    side = texts.select("doc_id", "h1", "text")
    parts = stored(pairs.groupBy("a", "ha").agg(F.ceil(F.count("*") / _HUB).cast("int").alias("parts")), "hubs")
    other = side.withColumnsRenamed({"doc_id": "b", "h1": "hb"})
    spokes = pairs.join(parts, ["a", "ha"]).join(other, ["b", "hb"]).select("a", "ha", F.pmod(F.xxhash64("b", "hb"), "parts").cast("int").alias("part"), "b", "text")
    hubs = parts.select("a", "ha", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")).join(side.withColumnsRenamed({"doc_id": "a", "h1": "ha"}), ["a", "ha"])
    kind = dict(pairs.dtypes)["a"]
    rows = hubs.select("a", "ha", "part", F.lit(None).cast(kind).alias("b"), "text").unionByName(spokes)
    n = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.repartition(n, "a", "ha", "part").sortWithinPartitions("a", "ha", "part", F.col("b").asc_nulls_first())

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hub, key = np.zeros(0, np.uint64), None
        for batch in slices(batches, 256):
            link = np.zeros(len(batch), bool)
            keys = list(zip(*(batch.column(c).to_pylist() for c in ("a", "ha", "part"))))
            alone = batch.column("b").is_null().to_pylist()
            made = [x for p in pieces(batch.column("text")) for x in sets(p.split(), k)]
            for i, x in enumerate(made):
                if alone[i]:
                    hub, key = x, keys[i]
                elif keys[i] == key:
                    common = len(np.intersect1d(hub, x, assume_unique=True))
                    link[i] = common > 0 and 100 * common >= percent * (len(hub) + len(x) - common)
                else:
                    raise ValueError(f"the text of document {keys[i][0]} is missing")
            at = pa.array(np.flatnonzero(link))
            yield pa.RecordBatch.from_arrays([batch.column("a").take(at), batch.column("b").take(at)], names=["a", "b"])

    return rows.mapInArrow(check, f"a {kind}, b {kind}").distinct()


def _in_components(posts: DataFrame, comps: DataFrame | None) -> DataFrame:
    """posts with comp, the component of the document so far: itself, before any link is known."""
    if comps is None:
        return posts.withColumn("comp", F.col("doc_id"))
    return posts.join(comps, F.col("doc_id") == F.col("node"), "left").withColumn("comp", F.coalesce("component", "doc_id")).drop("node", "component")


def _mixed(posts: DataFrame, key: str = "token") -> DataFrame:
    """Lists of more than one component: key, main (the largest one), df (members)."""
    by = posts.groupBy(key, "comp").agg(F.count("*").alias("m"))
    out = by.groupBy(key).agg(F.max_by("comp", F.struct("m", "comp")).alias("main"), F.sum("m").alias("df"), F.count("*").alias("comps"))
    return out.filter("comps > 1").select(key, "main", "df")


def _heads(posts: DataFrame, salt: int, percent: int) -> DataFrame:
    """Each document with the head of another component that it meets in most lists; heads are least by a hash."""
    by = F.xxhash64("doc_id", "h1", F.lit(salt)) if salt else F.lit(0).cast("bigint")
    head = F.min(F.struct(by.alias("by"), "doc_id", "h1", "n", "comp")).alias("head")
    mixed_ones = posts.groupBy("token").agg(head, F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo < hi").select("token", "head")
    met = posts.join(stored(mixed_ones, "heads"), "token").filter((F.col("head.comp") != F.col("comp")) & _fits(F.col("head.n"), F.col("n"), percent))
    counts = met.groupBy("doc_id", "h1", F.col("head.doc_id").alias("a"), F.col("head.h1").alias("ha")).agg(F.count("*").alias("lists"))
    best = F.max(F.struct("lists", F.xxhash64("a", "ha").alias("by"), "a", "ha")).alias("best")
    return counts.groupBy("doc_id", "h1").agg(best).select("best.a", "best.ha", F.col("doc_id").alias("b"), F.col("h1").alias("hb"))


def _rest(known: DataFrame, comps: DataFrame, percent: int, matches: int) -> DataFrame:
    """Pairs of different components that meet in a list of their prefixes; known: doc_id, h1, n, marks, bits."""
    every = _in_components(known.select("doc_id", "h1", "n", F.explode("marks").alias("token")), comps)
    shared = stored(_mixed(every).select("token", "df"), "mixed-marks")
    posts = stored(_prefixes(every, shared, ["doc_id", "h1", "n", "comp"], matches), "open-postings")
    lists = stored(_mixed(posts).select("token", "main"), "open-lists")
    words = [f"w{i}" for i in range(_WORDS)]
    bits = known.select("doc_id", "h1", *[F.col("bits")[i].alias(w) for i, w in enumerate(words)])
    members = stored(posts.join(lists, "token").join(bits, ["doc_id", "h1"]), "members")
    left = members.filter("comp != main").drop("main").select("token", *[F.col(c).alias(f"{c}_l") for c in ("doc_id", "h1", "n", "comp", *words)])
    # of two members outside of the main component, one order is enough
    once = (F.col("comp") == F.col("main")) | (F.col("comp_l") < F.col("comp"))
    apart = sum((F.bit_count(F.col(w).bitwiseXOR(F.col(f"{w}_l"))) for w in words), F.lit(0))
    on = (left["token"] == members["token"]) & (F.col("comp_l") != F.col("comp")) & once & _alike("n_l", "n", apart, percent)
    return left.join(members, on).select(F.col("doc_id").alias("a"), F.col("h1").alias("ha"), F.col("doc_id_l").alias("b"), F.col("h1_l").alias("hb")).distinct()


def linked(
    docs: DataFrame, k: int = 5, percent: int = 80, coordinates: int = 32, matches: int = 11, merges: int = 1,
    text: str = "text", doc_id: str = "doc_id",
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for each row of docs; kept: the least document of its component.

    merges: how often lists are merged with their heads before the rest; it changes no result.
    """
    if not 1 < matches <= coordinates <= 60:
        raise ValueError("1 < matches <= coordinates <= 60")
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    all_ = stored(sketched(rows, k, coordinates), "signatures")
    real = all_.filter("n > 0 and doc_id is not null")
    least = stored(real.groupBy("h1", "h2").agg(F.min("doc_id").alias("least"), F.count("*").alias("m")).filter("m > 1").drop("m"), "classes")
    copies = stored(real.select("doc_id", "h1", "h2").join(least, ["h1", "h2"]).filter("doc_id != least").select("doc_id", "h1", "least").distinct(), "copies")
    # one row for each class, also where an id has it several times
    heads = real.join(least, ["h1", "h2"]).filter("doc_id = least").drop("least").dropDuplicates(["h1", "h2"])
    own = real.join(least, ["h1", "h2"], "left_anti").unionByName(heads).select("doc_id", "h1", "n", "marks")
    posts = posted(own, matches)
    ids = stored(posts.select("doc_id", "h1").distinct(), "survivors")
    texts = rows.filter("doc_id is not null").filter(likely_in(ids, "doc_id")).join(ids.select("doc_id").distinct(), "doc_id", "left_semi")
    # an id may have several texts: that of the class goes on
    known = stored(sketched(texts, k, coordinates, whole=True).join(ids, ["doc_id", "h1"], "left_semi").dropDuplicates(["doc_id", "h1"]), "survivor-texts")
    found, comps = None, None
    for salt in range(merges):
        tried = _colliding(_heads(_in_components(posts, comps), salt, percent), known, matches, percent)
        links = confirmed(tried, known, k, percent)
        found = stored(links if found is None else found.union(links), "links")
        comps = components(found)
    rest = stored(confirmed(_colliding(_rest(known, comps, percent, matches), known, matches, percent), known, k, percent), "rest-links")
    equal = copies.select(F.col("least").alias("a"), F.col("doc_id").alias("b"))
    comps = components(equal.union(rest) if found is None else equal.union(rest).union(found))
    out = all_.select("doc_id", F.col("n").alias("n_shingles")).join(comps, F.col("doc_id") == F.col("node"), "left")
    out = out.select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
