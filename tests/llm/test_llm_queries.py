"""The registered queries against SQL, or against plain Python where SQL can't express them."""

import hashlib
import re

import duckdb
import numpy as np
import pandas as pd
import pytest
from compare import database, difference
from corpus_pipeline import STAGES, run

from skyframes.llm import jaccard, secrets
from skyframes.llm.queries import ORACLE, QUERIES, TARGETS

WORD = re.compile("[^\x20\x09-\x0d]+")


@pytest.fixture(scope="module")
def tables(sf_dir):
    return {t: pd.read_parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels", "benchmark")}


@pytest.fixture(scope="module")
def got(spark, sf_dir):
    made = {}

    def result(name):
        if name not in made:
            made[name] = QUERIES[name](spark, sf_dir).toPandas()
        return made[name]

    return result


@pytest.mark.parametrize("name", ORACLE)
def test_matches_sql(spark, sf_dir, name):
    assert difference(QUERIES[name](spark, sf_dir), ORACLE[name], database(sf_dir)) is None


def test_thirteen_operators():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_languages_of_held_out_documents(got, tables):
    out = got("op2_language_mixture").merge(tables["documents"], on="doc_id")
    held = out[out.held_out]
    assert len(out) == len(tables["documents"]) and len(held) > 40
    assert (held.lang_pred == held.lang).mean() > 0.97
    assert out.score.between(0, 1).all()


def base(text):
    found = [("assign", *m.span()) for m in re.finditer(
        "((?:[pP][aA][sS][sS][wW][oO][rR][dD])|(?:[pP][aA][sS][sS][wW][dD])|(?:[sS][eE][cC][rR][eE][tT])|(?:[tT][oO][kK][eE][nN])|(?:[aA][pP][iI]_?[kK][eE][yY]))"
        "[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 6]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found, key=lambda s: (s[1], ["assign", "access", "hex"].index(s[0])))


def test_base_secrets(spark):
    """On larger data than the smallest, which has no base match."""
    d = "/root/testdata/sf0.01"
    out = QUERIES["op6_secret_scan"](spark, d).toPandas().set_index("doc_id")
    documents = pd.read_parquet(f"{d}/documents.parquet")
    seen = 0
    for doc_id, text in zip(documents.doc_id, documents.text):
        want = base(text)
        row = out.loc[doc_id]
        assert (row.n_assign, row.n_access, row.n_hex) == tuple(sum(k == w[0] for w in want) for k in ("assign", "access", "hex"))
        listed = [":".join(map(str, w)) for w in want]
        assert row.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(row.spans.split(",")) if listed else True
        seen += len(want)
    assert seen


def test_quality_of_held_out_documents(spark):
    """Trained on larger data than the smallest, which has too few labels."""
    d = "/root/testdata/sf0.01"
    out = QUERIES["op7_compression_quality"](spark, d).toPandas().merge(pd.read_parquet(f"{d}/labels.parquet"), on="doc_id")
    held = out[out.held_out]
    good, bad = held[held.quality == 1].score, held[held.quality == 0].score
    assert np.mean([g > b for g in good for b in bad]) > 0.9
    assert (held.predicted == (held.score >= 0.7)).all()
    assert (held[held.quality == 1].predicted == 1).mean() > 0.9


def test_quality_signals(got, tables):
    out = got("op9_quality_rules").set_index("doc_id")
    for doc_id, text in zip(tables["documents"].doc_id, tables["documents"].text):
        words = WORD.findall(text)
        at = {}
        for i in range(len(words) - 2):
            at.setdefault(tuple(words[i : i + 3]), []).append(i)
        hit = {i + j for x in at.values() if len(x) > 1 for i in x for j in range(3)}
        lines = [x for x in text.split("\n") if WORD.search(x)]
        want = (len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(hit))
        row = out.loc[doc_id]
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == want
        assert row.base_failed == (want[0] < 50 or 100 * want[4] > 50 * want[0])
        assert not (row.base_failed and row.kept)


def test_quality_rules_keep_the_good(spark):
    d = "/root/testdata/sf0.01"
    out = QUERIES["op9_quality_rules"](spark, d).toPandas().merge(pd.read_parquet(f"{d}/labels.parquet"), on="doc_id", suffixes=("_p", ""))
    out = out[~out.base_failed]
    assert out[out.quality == 1].kept.mean() > 0.98
    assert out[out.quality == 0].kept.mean() < 0.1


def test_mixing_meets_its_targets(spark):
    out = QUERIES["op10_mixing"](spark, "/root/testdata/sf0.01").toPandas()
    assert (out.rate >= 0).all() and len(out) == 1000
    share = (np.stack(out.posterior) * (out.n_tokens * out.rate).to_numpy()[:, None]).sum(0) / out.n_tokens.sum()
    assert np.allclose(share, [TARGETS[d] for d in sorted(TARGETS)], atol=1e-3)


def test_pipeline_stage_by_stage(spark, sf_dir, tables):
    """Each stage on what its predecessor kept, against plain Python."""
    docs, seen = spark.read.parquet(f"{sf_dir}/documents.parquet"), {}
    for name, stage in STAGES:
        before = docs.toPandas()
        docs = stage(spark, docs, sf_dir)
        seen[name] = (before, docs.toPandas())
        if name != STAGES[-1][0]:
            assert docs.columns == list(before.columns)
            docs = spark.createDataFrame(seen[name][1], docs.schema)
    kept = QUERIES["op9_quality_rules"](spark, sf_dir).filter("kept").toPandas().doc_id
    assert sorted(seen["quality_rules"][1].doc_id) == sorted(kept)

    before, after = seen["near_duplicates"]
    sets = {i: {tuple(w[j : j + 5]) for j in range(max(1, len(w) - 4))} for i, w in
            ((i, WORD.findall(t.translate(str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})))) for i, t in zip(before.doc_id, before.text))}
    least = {i: i for i in sets}
    for _ in range(10):
        for i in sets:
            for j in sets:
                if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                    least[i] = least[j] = min(least[i], least[j])
    assert sorted(after.doc_id) == sorted(i for i in sets if least[i] == i)

    before, after = seen["benchmark_decontamination"]
    dirty = QUERIES["op5_benchmark_decontamination"](spark, sf_dir).filter("contaminated").toPandas().doc_id
    assert sorted(after.doc_id) == sorted(set(before.doc_id) - set(dirty)) and set(dirty) & set(before.doc_id)

    before, after = seen["secret_scan"]
    both = before.merge(after, on="doc_id", suffixes=("", "_new"))
    assert len(both) == len(before) == len(after)
    for a, b, n in zip(both.text, both.text_new, both.n_chars_new):
        assert not base(b) and n == len(b)
        if not base(a) and "<secret>" not in b:
            assert a == b

    before, after = seen["mixing"]
    assert sorted(after.doc_id) == sorted(before.doc_id) and (after.rate >= 0).all()
    assert sorted(run(spark, sf_dir).toPandas().doc_id) == sorted(before.doc_id)


def test_larger_groups_of_near_copies(spark):
    """Chains and cliques of edited copies, and passages that many texts share, against all pairs."""
    rng = np.random.default_rng(5)
    vocabulary = [f"w{i}" for i in range(3000)]
    passage = list(rng.choice(vocabulary, 60))
    texts = []
    for group in range(6):
        now = list(rng.choice(vocabulary, 120))
        for copy in range(25):
            texts.append(" ".join(now))
            now = list(now)
            for at in rng.integers(0, len(now), group // 2):
                now[at] = str(rng.choice(vocabulary))
    texts += [" ".join([*rng.choice(vocabulary, 20 * (i % 9)), *passage]) for i in range(60)]
    docs = pd.DataFrame({"doc_id": rng.permutation(len(texts)), "text": texts})
    con = duckdb.connect()
    con.register("documents", docs)
    want = con.execute(ORACLE["op8_jaccard_join"]).df().sort_values("doc_id").reset_index(drop=True)
    got = jaccard.linked(spark.createDataFrame(docs), 4, 85).toPandas().sort_values("doc_id").reset_index(drop=True)
    assert (want.component_id != want.doc_id).sum() > 60
    pd.testing.assert_frame_equal(got[list(want.columns)], want, check_dtype=False)


def test_field_finds_what_the_patterns_miss(spark):
    rng = np.random.default_rng(3)
    words = ["the", "anesh", "of", "tion", "ther", "woud", "en", "hend"]
    plain = lambda n: " ".join(rng.choice(words, n))
    secret = lambda: "".join(rng.choice(list("0123456789abcdef"), 32))
    rows = [(i, f"{plain(40)} token = \"{secret()}\" {plain(40)}" if i % 4 == 0 else plain(80)) for i in range(400)]
    field = secrets.fit(spark.createDataFrame(rows, "doc_id long, text string"))
    value = "9f8A7b6C5d4E3f2A1b0C"
    test = spark.createDataFrame([(0, f"{plain(50)} secret \"{value}\" {plain(50)}"), (1, plain(100))], "doc_id long, text string")
    out = {r.doc_id: r for r in secrets.scanned(test, field).collect()}
    assert [out[0].text[s.start : s.stop] for s in out[0].spans] == [value] and out[0].spans[0].kind == "tagged"
    assert out[1].spans == []
