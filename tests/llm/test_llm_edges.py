"""Nulls, empty and very long texts, ties, repeated rows, empty tables, clashing column names."""

import corpus_pipeline
import numpy as np
import pytest
import zstandard
from pyspark.sql import functions as F

from skyframes.llm import compression, decontaminate, graph, jaccard, language, mixing, rules, secrets, substrings, tables, urls, warc

LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(60_000))
ROWS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi", "en"),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi", None),
    (2, "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi", None),
    (3, None, "en"), (4, "", "de"), (5, " \n\t ", None), (6, "one two", "en"), (7, "One TWO", None),
    (None, "alpha beta gamma delta epsilon zeta eta theta iota kappa lamda mu nu xi omicron pi", "en"),
    (8, LONG, "en"), (9, LONG, "en"), (10, "12345 --- 678", None), (11, "größe über ärger müßig €5 日本語 \U0001f600 été", "de"),
]


@pytest.fixture(scope="module")
def docs(spark):
    # columns that clash with names the operators give, in another case too
    made = spark.createDataFrame(ROWS, "doc_id long, text string, lang string")
    for name in ("N_WORDS", "n", "score", "spans", "kept", "component", "h1", "at", "_id", "rate", "a"):
        made = made.withColumn(name, F.lit("x"))
    return made


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


def by_id(df, *columns):
    return {(r["doc_id"], i): tuple(r[c] for c in columns) for i, r in enumerate(sorted(df.collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)))}


def values(df, *columns):
    return [v if len(columns) > 1 else v[0] for v in by_id(df, *columns).values()]


def test_decontamination(spark, docs, none):
    items = spark.createDataFrame(
        [(1, "Beta GAMMA delta! epsilon zeta eta theta iota kappa lamda mu"), (1, "one two"), (2, None), (3, ""), (None, "one, two")], "item_id long, text string"
    )
    out = values(decontaminate.decontaminated(docs, items), "n_words", "n_hit", "items", "contaminated")
    assert out[0] == out[1] == out[2] == (16, 11, ["1"], True)
    assert out[3] == out[4] == out[5] == (0, 0, [], False)
    assert out[6] == out[7] == (2, 2, ["1"], True)
    assert decontaminate.decontaminated(none, items).collect() == []
    assert not any(values(decontaminate.decontaminated(docs, items.limit(0)), "contaminated"))
    with pytest.raises(ValueError):
        decontaminate.decontaminated(docs, items, most_chars=10)


def test_decontamination_spans_are_of_the_original(spark):
    text = "Für Ünï — ONE,two; three four"
    row = decontaminate.decontaminated(spark.createDataFrame([(text,)], "text string"), spark.createDataFrame([("q", "one two three")], "item_id string, text string")).first()
    assert [text[s.start : s.stop] for s in row.spans] == ["ONE,two; three"]


def test_quality_rules(docs, none):
    out = rules.judged(docs)
    assert values(out, "n_words")[:8] == [16, 16, 16, 0, 0, 0, 2, 2]
    assert all(r.base_failed and not r.kept for r in out.filter("n_words < 50").collect())
    assert rules.judged(none).collect() == [] and rules.judged(none).columns == out.columns


def test_rule_accuracies_are_found():
    rng = np.random.default_rng(1)
    good = rng.random(20_000) < 0.8
    right = [0.95, 0.8, 0.7, 0.9]
    votes = np.stack([np.where(rng.random(20_000) < 0.3, 0, np.where(rng.random(20_000) < r, 1, -1) * np.where(good, 1, -1)) for r in right], 1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    share, table = rules.fit(patterns, counts.astype(float))
    assert abs(share - 0.8) < 0.03
    assert np.allclose(table[1, :, 2] / (1 - table[1, :, 1]), right, atol=0.05)


def test_language(docs, none):
    model = language.fit(docs)
    out = values(language.predicted(docs, model), "lang_pred", "score", "shares")
    assert [o[0] for o in out[3:6]] == ["und"] * 3 and out[3][1:] == (0.0, {})
    assert out[0][0] == out[1][0] == "en" and out[-2][0] in ("und", "de") and out[11][0] == "de"
    assert language.predicted(none, model).collect() == []
    assert language.fit(none) is None
    assert set(values(language.predicted(docs, None), "lang_pred")) == {"und"}
    with pytest.raises(ValueError):
        language.fit(docs, most_languages=1)


def test_language_mixture_of_two(spark):
    en = "the quick brown fox jumps over the lazy dog while the sun is shining brightly on the green hills "
    de = "der schnelle braune fuchs springt über den faulen hund während die sonne hell auf grüne hügel scheint "
    model = language.fit(spark.createDataFrame([(en, "en"), (de, "de")], "text string, lang string"))
    rows = [r.shares for r in language.predicted(spark.createDataFrame([(en,), (de,), (en * 3 + de,)], "text string"), model).collect()]
    assert set(rows[0]) == {"en"} and set(rows[1]) == {"de"} and set(rows[2]) == {"en", "de"}
    assert rows[2]["en"] > rows[2]["de"] > 0.15


def test_compression(spark, docs, none):
    labels = spark.createDataFrame([(1, 1), (6, 0), (7, 0), (None, 1), (2, None)], "doc_id long, label int")
    model = compression.fit(docs, labels)
    out = values(compression.scored(docs, model), "score", "predicted")
    assert all(0 <= s <= 1 and p == (s >= 0.7) for s, p in out) and out[3] == out[4]
    assert compression.scored(none, model).collect() == []
    assert compression.fit(docs, labels.filter("label = 1")) is None
    assert set(values(compression.scored(docs, None), "score")) == {0.5}


def test_secrets(spark, docs, none):
    assert secrets.fit(none) is None and secrets.fit(docs) is None
    texts = [None, "", "password: abc", "x PASSWORD = 'abcdef'", "AKIA" * 9, "token=" + "0" * 24, "ſecret=abcdefgh", "é🙂 api_key:Zz+/=-_. é"]
    test = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = values(secrets.scanned(test, None).withColumn("s", secrets.listed(F.col("spans"))).withColumn("r", secrets.redacted(F.col("text"), F.col("spans"))), "s", "r")
    assert [o[0] for o in out] == ["", "", "", "assign:2:20", "access:0:36", "assign:0:30,hex:6:30", "", "assign:3:19"]
    assert [o[1] for o in out] == [None, "", "password: abc", "x <secret>'", "<secret>", "<secret>", "ſecret=abcdefgh", "é🙂 <secret> é"]
    assert secrets.scanned(none, None).collect() == []


def test_pruned_decoding_is_viterbi():
    rng = np.random.default_rng(2)
    n = int(secrets.OFFSETS[-1])
    for _ in range(20):
        field = secrets.Field(rng.normal(0, 1, (n, 3)) + [1.0, 0, 0], rng.normal(0, 0.5, (3, 3)), rng.normal(0, 0.5, 3))
        rows = np.stack([rng.integers(0, s, 60) + o for s, o in zip(secrets.SIZES, secrets.OFFSETS)], 1)
        doc = np.sort(rng.integers(0, 3, 60))
        whole = np.concatenate([field.viterbi(field.weights[rows[doc == d]].sum(1), False, False) for d in np.unique(doc)])
        assert (field.tags(rows, doc) == whole).all()


def test_jaccard(docs, none):
    out = jaccard.linked(docs, 5, 80)
    got = values(out, "doc_id", "n_shingles", "component_id")
    assert got[:8] == [(1, 12, 1), (2, 12, 1), (2, 12, 1), (3, 0, 3), (4, 0, 4), (5, 0, 5), (6, 1, 6), (7, 1, 6)]
    assert got[-1] == (None, 12, None) and got[8][2] == got[9][2] == 8
    assert jaccard.linked(none, 5, 80).collect() == []


def test_prefixes_share_enough_tokens():
    rng = np.random.default_rng(7)
    for _ in range(300):
        n, percent, extra = int(rng.integers(1, 80)), int(rng.choice([80, 85, 95])), int(rng.choice([0, 5, 30]))
        x = rng.choice(1000, n, replace=False)
        y = np.concatenate([rng.permutation(x)[: n - int(rng.integers(0, jaccard.slack(n, percent) + 1))], rng.integers(2000, 3000, int(rng.integers(0, 1 + n // 6)))])
        y = np.unique(y)
        common = len(np.intersect1d(x, y))
        if 100 * common >= percent * len(np.union1d(x, y)):
            (a, need), (b, _) = jaccard.prefix(len(x), percent, extra), jaccard.prefix(len(y), percent, extra)
            assert len(np.intersect1d(np.sort(x)[:a], np.sort(y)[:b])) >= need


def test_components(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(50, 60), (60, 70), (80, 80), (None, 5), (3, None), (50, 60)], "a long, b long")
    got = {r.node: r.component for r in graph.components(links).collect()}
    assert got == {**{i: 0 for i in range(41)}, 50: 50, 60: 50, 70: 50}
    assert graph.components(links.limit(0)).collect() == []


def test_substrings(docs, none):
    out = substrings.deduplicated(docs, 13)
    got = values(out, "doc_id", "n_words", "n_removed")
    assert got[:8] == [(1, 16, 0), (2, 16, 16), (2, 16, 16), (3, 0, 0), (4, 0, 0), (5, 0, 0), (6, 2, 0), (7, 2, 0)]
    assert got[8:10] == [(8, 60_000, 0), (9, 60_000, 60_000)] and got[-1] == (None, 16, 0)
    assert substrings.deduplicated(none, 13).collect() == []


def test_maximal_repeats(spark):
    w = [f"w{i}" for i in range(200)]
    rows = [(1, " ".join(w[:60])), (2, " ".join([*w[100:110], *w[20:50], *w[110:120]])), (3, " ".join([*w[20:33], "x", *w[37:50]]))]
    out = {r.doc_id: [(s.start, s.stop) for s in r.repeats] for r in substrings.deduplicated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert out == {1: [], 2: [(10, 40)], 3: [(0, 13), (14, 27)]}


def test_urls(spark):
    rules_ = [urls.host_rule(*r) for r in (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/fr"))]
    rows = [None, "", "no scheme", "http://Example.COM/en/x?q#f", "https://www.example.com/en/", "http://notexample.com/en/", "http://a.net/french", "http://a.net/FR",
            "http://example.com", "http://x.org/casino/", "http://x.org/casinos", "http://example.com:80/en/", "a://b://c.com/en/"]
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in enumerate(rows)] + [(3, rows[3], "x", "y")], "page_id long, url string, host string, _url string")
    out = sorted((r.page_id, r.host, r.path, r.rule, r.verdict) for r in urls.judged(pages, rules_ + urls.WORD_RULES).collect())
    got = {o[0]: o[1:] for o in out}
    assert {r._url for r in urls.judged(pages, rules_).collect()} == {"y"}
    assert len(out) == len(rows) + 1 and out[3] == out[4]
    assert got[0] == got[1] == got[2] == ("", "", None, "allow")
    assert got[3] == ("example.com", "/en/x", "example.com/en/", "block") and got[4][2:] == ("www.example.com/en/", "allow")
    assert got[5][2:] == ("com/", "allow") and got[6][2:] == ("net/fr", "block") and got[7][2:] == (None, "allow") and got[8][2:] == (None, "allow")
    assert got[9][2:] == ("casino", "block") and got[10][2:] == (None, "allow") and got[11][0] == "example.com:80" and got[12][0] == "b:"
    assert urls.judged(pages.limit(0), rules_).collect() == []
    assert {r.verdict for r in urls.judged(pages, []).collect()} == {"allow"}
    with pytest.raises(ValueError):
        urls.judged(pages, [urls.Rule("all", "block", ".*")])


PAGES = [
    (1, "http://a/1", "x" * 200), (2, "http://a/2", "x" * 200), (2, "http://a/2", "x" * 200), (3, None, None), (4, "http://a/4\r\nEvil: 1", ""),
    (5, "u", "short"), (6, "u", "short"), (None, "u", "x" * 200), (7, "u", "é€\U0001f600" * 50),
    (8, "u", "WARC/1.0\r\nContent-Length: 5\r\n\r\nhello\r\n\r\n" * 40), (9, "u", "WARC/1.0\r\n" * 30), (10, "u", "y" * 300_000),
    (11, "u", "\r\n\r\nWARC/1.0\r\nWARC-Type: response\r\nContent-Length: 0\r\n\r\n\r\n\r\n"),
]


@pytest.mark.parametrize("size", [64, 1000, 1 << 20])
def test_warc(spark, tmp_path, size):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string").withColumn("_first", F.lit(1)).withColumn("value", F.lit("z"))
    warc.write(pages.coalesce(2), f"file://{tmp_path}/w")
    out = warc.read(spark, f"file://{tmp_path}/w", size)
    got = sorted((r.record_id or "", r.record_type, r.refers_to, bytes(r.payload).decode(), r.payload_length) for r in out.collect())
    twins = {(2, 1)}
    want = sorted((str(i or ""), "revisit" if (i, 1) in twins else "response", "1" if (i, 1) in twins else None, "" if (i, 1) in twins else t or "", len((t or "").encode())) for i, _, t in PAGES)
    assert got == want
    cut, reach, _ = warc.reached(spark, f"file://{tmp_path}/w", size)
    assert warc.broken(cut, reach).count() == 0


LONG_URL = "data:text/html," + "z" * 70_000


@pytest.mark.parametrize("size", [64, 1000, 1 << 20])
def test_warc_headers_of_any_length(spark, tmp_path, size):
    rows = [(i, LONG_URL if i in (3, 5) else "http://a/WARC/1.0" if i == 6 else "u", f"page {i} " + "WARC/1.0\r\n" * i) for i in range(1, 9)]
    warc.write(spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/w")
    got = {int(r.record_id): (r.target_uri, bytes(r.payload).decode()) for r in warc.read(spark, f"file://{tmp_path}/w", size).collect()}
    assert got == {i: (u, t) for i, u, t in rows}


def test_warc_empty(spark):
    assert warc.round_trip(spark.createDataFrame(PAGES, "page_id long, url string, html string").limit(0)).count() == 0


@pytest.mark.parametrize("size", [64, 1000, 1 << 20])
@pytest.mark.parametrize("fault", ["junk", "cut", "start"])
def test_warc_breaks_are_found(spark, tmp_path, size, fault):
    """Records before the break come back, the file is listed with the offset, and reading raises by default."""
    order = [p for p in PAGES if p[0] not in (None, 2)]
    warc.write(spark.createDataFrame(order, "page_id long, url string, html string").coalesce(1), f"file://{tmp_path}/w")
    warc.write(spark.createDataFrame([(99, "u", "whole")], "page_id long, url string, html string"), f"file://{tmp_path}/w/other")
    file = next(tmp_path.glob("w/part-*"))
    raw = file.read_bytes()
    at = 0 if fault == "start" else raw.rindex(warc.MAGIC, 0, raw.index(b"<urn:page:10>"))
    file.write_bytes(raw[: at + 100_000] if fault == "cut" else raw[:at] + b"JUNK" + raw[at:])
    (tmp_path / "w" / f".{file.name}.crc").unlink(missing_ok=True)
    folder = f"file://{tmp_path}/w"
    cut, reach, _ = warc.reached(spark, folder, size)
    assert [(r["file"].rpartition("/")[2], r["at"]) for r in warc.broken(cut, reach).collect()] == [(file.name, at)]
    got = [int(r.record_id) for r in warc.read(spark, folder, size, strict=False).collect()]
    before = [] if fault == "start" else [p[0] for p in order if raw.index(f"<urn:page:{p[0]}>".encode()) < at]
    assert sorted(got) == sorted([*before, 99]) and (fault == "start" or len(before) > 5)
    with pytest.raises(ValueError, match=file.name):
        warc.read(spark, folder, size)


def test_warc_is_read_in_as_many_tasks_as_its_bytes_need(spark, sf_dir):
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    assert warc.round_trip(pages, size=1 << 14).rdd.getNumPartitions() == int(spark.conf.get("spark.sql.shuffle.partitions"))


def test_mixing(spark, docs, none):
    labels = spark.createDataFrame([(1, "a"), (8, "b"), (99, "c"), (6, None), (None, "a")], "doc_id long, domain string")
    out = mixing.mixed_to(docs, labels, {"a": 0.5, "b": 0.5, "c": 3.0})
    rows = out.collect()
    assert len(rows) == len(ROWS) and all(r.rate >= 0 and len(r.posterior) == 2 for r in rows)
    assert set(values(mixing.mixed_to(docs, labels.limit(0), {"a": 1.0}), "rate")) == {1.0}
    assert mixing.mixed_to(none, labels, {"a": 1.0}).collect() == []
    for bad in ({"a": -1.0, "b": 2.0}, {}, {"a": 0.0}):
        with pytest.raises(ValueError):
            mixing.mixed_to(docs, labels, bad)


def test_mixing_keeps_domains_of_long_texts(spark):
    rows = [(i, f"short {i} plain words of this domain here") for i in range(20)]
    rows += [(100 + i, " ".join(f"other{j % 50} vocabulary{j % 7}" for j in range(3000 + i))) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, "a" if i < 100 else "b") for i, _ in rows] + [(999, "gone")], "doc_id long, domain string")
    out = mixing.mixed_to(docs, labels, {"a": 0.5, "b": 0.5, "gone": 1.0}).collect()
    assert {(r.doc_id < 100, r.domain) for r in out} == {(True, "a"), (False, "b")} and all(r.met for r in out)
    assert np.allclose(out[0].reached, [0.5, 0.5], atol=2e-5)
    assert {r.domain for r in mixing.mixed_to(docs, labels.filter("domain = 'b'"), {"b": 1.0}).collect()} == {"b"}
    with pytest.raises(ValueError):
        mixing.mixed_to(docs, labels, {"a": 1.0}, most_domains=1)


@pytest.mark.parametrize("spread", [0.3, 1.5, None])
def test_rates_meet_targets_that_can_be_met(spark, spread):
    """Many rows, one domain of few tokens: targets of some nonnegative rates are met; others are approached."""
    rng = np.random.default_rng(12)
    q = rng.dirichlet([8, 0.4, 0.05], 3000)
    n = rng.integers(0, 500, 3000)
    rows = spark.createDataFrame([(int(a), [float(x) for x in b]) for a, b in zip(n, q)], "n_tokens long, posterior array<double>")
    some = (rng.exponential(1, 3000) ** (spread or 1)) * (rng.random(3000) < 0.9)
    targets = (some * n) @ q / n.sum() if spread else np.array([0.2, 0.3, 0.5])
    rate, reached = mixing.rates(rows, list(targets))
    r = np.array([x.rate for x in rows.withColumn("rate", rate).collect()])
    assert (r >= 0).all() and np.allclose((r * n) @ q / n.sum(), reached)
    want = least_squares(q, n, np.array(targets))
    weight = np.linalg.inv((q * n[:, None]).T @ q / n.sum())
    miss = lambda x: (x - targets) @ weight @ (x - targets)
    if spread:
        assert np.abs(reached - targets).max() <= 1e-5
    else:
        start = n @ q / n.sum()
        assert miss(want) <= miss(reached) < 0.2 * miss(start)


def least_squares(q, n, targets, rounds=20_000):
    """Shares at nonnegative rates by plain projected gradient on the weighted squares."""
    weight = np.linalg.inv((q * n[:, None]).T @ q / n.sum())
    r = np.ones(len(n))
    for _ in range(rounds):
        r = np.maximum(0, r - q @ weight @ ((r * n) @ q / n.sum() - targets))
    return (r * n) @ q / n.sum()


def test_targets_out_of_reach_are_told(spark):
    docs = spark.createDataFrame([(i, "one two three four") for i in range(10)] + [(20 + i, "one two three") for i in range(10)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, "a" if i % 2 else "b") for i in range(30)], "doc_id long, domain string")
    out = mixing.mixed_to(docs, labels, {"a": 1.0, "b": 0.0}).collect()
    assert not any(r.met for r in out) and all(r.rate >= 0 and 0 < r.reached[0] < 1 for r in out)


def test_compression_draws_from_texts_that_qualify(spark):
    rows = [(i, "x" * 20_000 if i < 40 else f"good text number {i} of many words" if i % 2 else f"B@D {i} $$$") for i in range(80)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, label int")
    model = compression.fit(spark.createDataFrame(rows, "doc_id long, text string"), labels, per_class=10)
    assert model is not None and b"good text" in model.good and b"B@D" in model.bad


def test_rates_project_to_zero(spark):
    """A target of 0 drives the domain's rates to 0, the rest is scaled up."""
    rows = spark.createDataFrame([(100, [1.0, 0.0]), (50, [0.0, 1.0]), (0, [0.5, 0.5]), (50, [0.1, 0.9])], "n_tokens long, posterior array<double>")
    rate, reached = mixing.rates(rows, [1.0, 0.0], rounds=300)
    got = [r.rate for r in rows.withColumn("rate", rate).collect()]
    assert got[1] < 0.02 and got[0] > 1.7 and abs(reached[0] - 1) < 0.02


def test_a_block_removes_its_stage_tables(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "shared_dir", lambda _: f"file://{tmp_path}")
    kept = tables.stored(spark.range(2), "kept")
    with tables.stages(spark):
        assert tables.stored(spark.range(3), "three").count() == 3
        assert len(list(tmp_path.iterdir())) == 2
    assert len(list(tmp_path.iterdir())) == 1 and kept.count() == 2


def test_stage_tables_need_a_shared_folder(spark, monkeypatch):
    monkeypatch.setattr(type(spark.sparkContext), "getCheckpointDir", lambda self: None)
    monkeypatch.setattr(type(spark.sparkContext), "getConf", lambda self: {})
    monkeypatch.setattr(type(spark.conf), "get", lambda self, key, default=None: default)
    with pytest.raises(ValueError):
        tables.shared_dir(spark)


def test_language_shares_by_loops():
    rng = np.random.default_rng(14)
    e, text = rng.random((40, 3)) + 1e-3, np.repeat([0, 1, 2], [5, 25, 10])
    first = np.array([0, 5, 30])
    got, likely = language._em(e, text, first, np.full((3, 3), 1 / 3), 4)
    for i in range(3):
        words, share = e[text == i], [1 / 3] * 3
        for _ in range(4):
            total = [0.0] * 3
            for w in words:
                whole = sum(w[j] * share[j] for j in range(3))
                for j in range(3):
                    total[j] += w[j] * share[j] / whole
            share = [t / len(words) for t in total]
        assert np.allclose(got[i], share)
        assert np.isclose(likely[i], sum(np.log(sum(w[j] * share[j] for j in range(3))) for w in words))


def test_compressed_sizes_by_hand():
    rng = np.random.default_rng(15)
    words = [bytes(rng.integers(97, 123, int(rng.integers(2, 9)), dtype=np.uint8)) for _ in range(400)]
    text = lambda n: b" ".join(words[i] for i in rng.integers(0, 400, n))
    model = compression.Model(text(3000), text(3000)[::-1], np.zeros(2), np.ones(2), np.zeros(3), 1)
    texts = [b"", b"x", text(50), text(2000), b"ab" * 5000]
    got = compression.features(texts, compression._compressors(model))
    for t, (difference, ratio) in zip(texts, got):
        sizes = []
        for raw in (model.good, model.bad):
            tool = zstandard.ZstdCompressor(level=1, dict_data=zstandard.ZstdCompressionDict(raw), write_checksum=False, write_dict_id=False, write_content_size=True)
            sizes.append(sum(len(tool.compress(t[i : i + 2048])) for i in range(0, len(t), 2048)))
        if not t:
            assert (difference, ratio) == (0, 0)
            continue
        assert abs(difference - (sizes[1] - sizes[0]) / max(*sizes, 1)) < 0.02
        assert abs(ratio - np.log(min(sizes) / len(t))) < 0.05


@pytest.fixture(scope="module")
def odd_corpus(spark, tmp_path_factory):
    """Documents with nulls, an empty text, a very long one, repeated ids and rows, and a column that clashes."""
    text = " ".join(f"word{i} of a plain sentence" for i in range(30)) + "."
    rows = [(1, text, "en", "s", 1), (2, text, "en", "s", 1), (2, text, "en", "t", 1), (2, text.replace("plain", "other"), None, None, None), (3, None, "en", "s", 0),
            (4, "", None, None, 0), (None, text, "en", "s", 1), (5, LONG, "de", "s", 1), (6, "short", "en", "s", 5)]
    folder = tmp_path_factory.mktemp("odd")
    spark.createDataFrame([(9, "a question that no document holds at all in its words")], "item_id long, text string").write.parquet(f"file://{folder}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0), (5, None, None), (99, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"file://{folder}/labels.parquet")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("n_words", F.lit("mine"))
    return docs, f"file://{folder}"


def test_pipeline_stages_on_odd_rows(spark, odd_corpus):
    docs, folder = odd_corpus
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, folder)
        none = stage(spark, docs.limit(0), folder)
        assert none.columns == out.columns and none.collect() == [], name
        got = out.collect()
        if name == "mixing":
            assert len(got) == docs.count() and all(r.rate >= 0 for r in got)
            continue
        assert out.columns == docs.columns and {r.n_words for r in got} <= {"mine"}, name
        if name == "near_duplicates":
            assert sorted((r.doc_id or 0, r.source or "") for r in got) == [(0, "s"), (1, "s"), (3, "s"), (4, ""), (5, "s"), (6, "s")]
        elif name != "quality_rules":
            assert len(got) == docs.count(), name


def test_texts_of_one_id_all_stay(spark, odd_corpus):
    docs, folder = odd_corpus
    out = corpus_pipeline.near_duplicates(spark, docs.filter("doc_id = 2"), folder).collect()
    assert sorted((r.text[:40], r.source or "") for r in out) == sorted({(r.text[:40], r.source or "") for r in docs.filter("doc_id = 2 and coalesce(source, '') != 't'").collect()})
