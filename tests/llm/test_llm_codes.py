"""Vector codes, token alignment and the MinHash join: against brute force, and their edge cases."""

import hashlib

import duckdb
import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from skyframes.llm import alignment, lloyd, minhash
from skyframes.llm.queries import ORACLE, QUERIES
from skyframes.llm.tables import stored


def plain_codes(rows, parts=4, entries=256, rounds=4, scale=1024):
    """(id, label, vector) rows by loops over Python integers."""
    kept = []
    for i, label, v in rows:
        if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v):
            kept.append((i, label, [int(np.floor(float(np.float32(x)) * scale)) for x in v]))
    low = min(i for i, _, _ in kept if i is not None)
    length = len(min(v for i, _, v in kept if i == low))
    kept = [k for k in kept if len(k[2]) == length]
    firsts = {}
    for i, _, v in kept:
        if i is not None:
            firsts[i] = min(firsts.get(i, v), v)
    start = [firsts[i] for i in sorted(firsts)[:entries]]
    width = len(start[0]) // parts
    cut = lambda v: [v[p * width : (p + 1) * width] for p in range(parts)]
    books = [[cut(v)[p] for v in start] for p in range(parts)]

    def near(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for _, _, v in kept:
                members.setdefault(near(cut(v)[p], books[p])[1], []).append(cut(v)[p])
            books[p] = [[sum(c) // len(members[e]) for c in zip(*members[e])] if e in members else b for e, b in enumerate(books[p])]
    out = []
    for i, label, v in kept:
        found = [near(x, books[p]) for p, x in enumerate(cut(v))]
        out.append([i, label, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found)])
    total = {}
    for _, label, _, error in out:
        total[label] = total.get(label, 0) + error
    digest = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    return [(*o, total[o[1]], digest) for o in out]


VECTORS = "vec_id long, label string, embedding array<float>, row string, position int, code string, moved string"


def coded(spark, rows, **options):
    df = spark.createDataFrame([(*r, "x", 9, "y", "z") for r in rows], VECTORS)
    key = lambda r: tuple((x is not None, x) for x in r)
    return sorted((tuple(r) for r in lloyd.encoded(df, **options).collect()), key=key), key


def test_codes_are_those_of_plain_loops(spark):
    rng = np.random.default_rng(8)
    rows = [(int(i), str(i % 3) if i % 7 else None, [float(x) for x in rng.normal(0, 1, 8)]) for i in rng.permutation(60)]
    rows += [(3, "0", rows[5][2]), (3, "0", rows[5][2]), (None, "0", rows[6][2]), (None, None, rows[6][2])]
    rows += [(70 + i, "same", [0.5] * 8) for i in range(40)]  # one entry holds them all; ties between equal entries
    rows += [(-5, "a", None), (-4, "a", [None] + [1.0] * 7), (-3, "a", [float("nan")] + [1.0] * 7), (-2, "a", [float("-inf")] + [1.0] * 7), (200, "a", []), (201, "a", [1.0] * 4)]
    for entries, rounds in ((256, 4), (7, 4), (7, 1), (5, 3)):
        got, key = coded(spark, rows, entries=entries, rounds=rounds)
        assert got == sorted(plain_codes(rows, entries=entries, rounds=rounds), key=key)


def test_codes_of_large_components_and_of_nothing(spark):
    rng = np.random.default_rng(9)
    rows = [(i, "l", [float(x) for x in rng.integers(-200_000, 200_000, 4)]) for i in range(12)]
    got, key = coded(spark, rows, entries=3, rounds=2)
    assert got == sorted(plain_codes(rows, entries=3, rounds=2), key=key)
    assert coded(spark, [])[0] == coded(spark, [(1, "a", None), (None, "a", [1.0] * 4)])[0] == []
    assert coded(spark, [(1, "a", [1.0] * 6)])[0] == []
    with pytest.raises(Exception, match="exceeds"):
        coded(spark, [(1, "a", [0.0] * 4), (2, "a", [1e9] * 4)])


def test_only_those_that_change_move(spark, tmp_path):
    """A round writes members that keep their entry apart from those that leave it."""
    rng = np.random.default_rng(10)
    rows = spark.createDataFrame([(i, i, "l", [float(x) for x in rng.normal(0, 1, 4)]) for i in range(200)], "row long, id long, label string, v array<float>")
    books = lloyd._first_books(rows, 2, 8, 1024)
    members = stored(lloyd.residents(rows, books, 1024), "members")
    after = lloyd.updated(books, *lloyd.member_sums(members, books.shape))
    lloyd._round(members, after, f"file://{tmp_path}/round")
    new = {(r.row, r.position): (r.entry, r.moved) for r in spark.read.schema(lloyd._judged(members.schema)).parquet(f"file://{tmp_path}/round").collect()}
    old = {(r.row, r.position): r.entry for r in members.collect()}
    assert {k: v[0] != old[k] for k, v in new.items()} == {k: v[1] for k, v in new.items()} and len(new) == 400
    assert any(v[1] for v in new.values()) and not all(v[1] for v in new.values())


def plain_alignment(texts):
    a_tool, b_tool = Tokenizer.from_file(f"{alignment.TOKENIZERS}/byte_bpe_50k.json"), SentencePieceProcessor(model_file=f"{alignment.TOKENIZERS}/piece_bpe_32k.model")
    a_tool.encode_special_tokens = True
    back = {c: b for c, b in alignment.byte_alphabet().items()}
    made, docs = [], {}
    for text in texts:
        links, groups, n = [], [], (0, 0)
        if text:
            a = [(i, bytes(back[c] for c in a_tool.id_to_token(i))) for i in a_tool.encode(" " + text, add_special_tokens=False).ids]
            b = [(i, bytes([int(b_tool.id_to_piece(i)[3:5], 16)]) if b_tool.is_byte(i) else b_tool.id_to_piece(i).replace("▁", " ").encode()) for i in b_tool.encode(text)]
            if b"".join(x for _, x in a) == b"".join(x for _, x in b) == (" " + text).encode():
                spans = []
                for side in (a, b):
                    at, out = 0, []
                    for i, x in side:
                        out.append((i, at, at + len(x)))
                        at += len(x)
                    spans.append(out)
                n = len(a), len(b)
                ends = sorted({e for _, _, e in spans[0]} & {e for _, _, e in spans[1]})
                start = 0
                for end in ends:
                    inside = [[t for t in s if start <= t[1] and t[2] <= end] for s in spans]
                    links += [(x[0], y[0]) for x in inside[0] for y in inside[1] if x[1] < y[2] and y[1] < x[2]]
                    groups.append("|".join(",".join(str(t[0]) for t in s) for s in inside))
                    start = end
        made.append((*n, len(groups), links, ";".join(groups)))
        for pair in set(links):
            docs[pair] = docs.get(pair, 0) + 1
    best = {}
    for (a, _), c in docs.items():
        best[a] = max(best.get(a, 0), c)
    return [(na, nb, g, len(links), text, sum(docs[p] == best[p[0]] for p in links), sum(docs[p] for p in links)) for na, nb, g, links, text in made]


ODD = [
    None, "", " ", "plain words here", "plain words here", "<|endoftext|> and <s> </s> <unk> <0x41>", "lower ▁ one eighth block", "▁", "a\x00b\r\n\tc  d   ",
    "日本語のテキスト🙂 Größe étude é", "x" * 5000, "0123456789" * 300, "don't  DON'T nbsp", "﻿bom", "́", "many words " * 4000, "!" * 700,
]


def test_alignment_is_that_of_plain_loops(spark):
    docs = spark.createDataFrame([(i % 14 or None, t, "x", 1) for i, t in enumerate(ODD)], "doc_id long, text string, row string, a int")
    rows = stored(alignment.aligned(docs), "aligned")
    order = ["n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
    key = lambda r: (r[4], r)
    want = sorted(plain_alignment(ODD), key=key)
    for sent in (1 << 18, 200, 1):  # all pairs sent, some, none
        out = alignment.scored(rows, sent)
        assert out.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "n_best", "count_sum"]
        assert sorted((tuple(r) for r in out.select(order).collect()), key=key) == want
    assert {w[0] for w in want} > {0} and sum(w[0] == 0 for w in want) >= 3
    assert alignment.scored(stored(alignment.aligned(docs.limit(0)), "aligned")).collect() == []


def test_intervals_that_do_not_tile():
    """The steps hold for intervals with gaps, too."""
    rng = np.random.default_rng(4)
    for _ in range(100):
        cuts = [np.sort(rng.choice(60, 2 * int(rng.integers(1, 9)), replace=False)).reshape(-1, 2) for _ in (0, 1)]
        (a0, a1), (b0, b1) = (c.T for c in cuts)
        i, j = alignment.overlaps(a0, a1, b0, b1)
        assert sorted(zip(i, j)) == [(x, y) for x in range(len(a0)) for y in range(len(b0)) if a0[x] < b1[y] and b0[y] < a1[x]]
        ga, gb = alignment.coalesced(a0, a1, b0, b1)
        assert (ga[i] == gb[j]).all() and len({*ga, *gb}) == max([*ga, *gb]) + 1


def test_alignment_query(spark, sf_dir):
    docs = pd.read_parquet(f"{sf_dir}/documents.parquet")
    want = {i: (*w[:4], hashlib.sha256(w[4].encode()).hexdigest() if w[0] else "", *w[5:]) for i, w in zip(docs.doc_id, plain_alignment(docs.text))}
    out = QUERIES["op12_token_alignment"](spark, sf_dir).collect()
    assert {r.doc_id: (r.n_a, r.n_b, r.n_groups, r.n_links, r.groups_sha256, r.n_best, r.count_sum) for r in out} == want and len(out) == len(docs)


def test_minhash_edges(spark):
    long = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
    same = "alpha beta gamma delta epsilon zeta eta theta"
    rows = [(1, same), (2, same.upper()), (2, same.upper()), (3, None), (4, ""), (5, " \n\t "), (6, "one two"), (7, "One TWO"), (None, same), (8, long), (9, long + " end"), (10, "größe 日本語"), (6, "other text of the same id, long enough")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for name in ("H1", "n", "marks", "token", "component_id", "kept", "a", "part", "_text"):
        docs = docs.withColumn(name, F.lit("x"))
    got = sorted(tuple(r) for r in minhash.linked(docs, 4, 80).filter("doc_id is not null").collect())
    assert got == [(1, 5, 1, True), (2, 5, 1, False), (2, 5, 1, False), (3, 0, 3, True), (4, 0, 4, True), (5, 0, 5, True), (6, 1, 6, True), (6, 5, 6, True), (7, 1, 6, False),
                   (8, got[9][1], 8, True), (9, got[9][1] + 1, 8, False), (10, 1, 10, True)]
    assert minhash.linked(docs, 4, 80).filter("doc_id is null").collect()[0][1:] == (5, None, True)
    assert minhash.linked(docs.limit(0), 4, 80).collect() == []
    with pytest.raises(ValueError):
        minhash.linked(docs, matches=1)


@pytest.mark.parametrize("merges", [0, 2])
def test_minhash_finds_every_link(spark, merges):
    """Chains and cliques of edited copies, and a passage that many texts share, against all pairs, also without merges with heads."""
    rng = np.random.default_rng(6)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = list(rng.choice(vocabulary, 60))
    texts = []
    for group in range(6):
        now = list(rng.choice(vocabulary, 120))
        for _ in range(25):
            texts.append(" ".join(now))
            now = list(now)
            for at in rng.integers(0, len(now), group // 2):
                now[at] = str(rng.choice(vocabulary))
    texts += [" ".join([*rng.choice(vocabulary, 15 * (i % 9)), *passage]) for i in range(90)]
    docs = pd.DataFrame({"doc_id": rng.permutation(len(texts)), "text": texts})
    con = duckdb.connect()
    con.register("documents", docs)
    want = con.execute(ORACLE["op13_minhash_dedup"]).df().sort_values("doc_id").reset_index(drop=True)
    got = minhash.linked(spark.createDataFrame(docs), 4, 80, merges=merges).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert (want.component_id != want.doc_id).sum() > 60
    pd.testing.assert_frame_equal(got[list(want.columns)], want, check_dtype=False)
