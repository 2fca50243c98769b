"""The registered queries of the operators, with their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import alignment, compression, decontaminate, jaccard, language, lloyd, minhash, mixing, rules, secrets, substrings, urls, warc
from .tables import stored


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _part(parts: int):
    """Remainder of an id's checksum, by which rows are held out of training."""
    return F.crc32(F.col("doc_id").cast("string")) % parts


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.round_trip(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    full = F.col("record_type") == "response"
    return records.select(
        F.col("record_id").cast("bigint").alias("page_id"),
        F.when(full, F.octet_length("payload").cast("bigint")).otherwise(F.col("payload_length")).alias("payload_bytes"),
        F.when(full, F.sha2("payload", 256)).otherwise(F.substring_index("payload_digest", ":", -1)).alias("payload_digest"),
        "record_type", F.col("refers_to").cast("bigint").alias("refers_to"),
    )


def op2_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language.fit(docs.filter(F.coalesce(_part(3) != 1, F.lit(True))))
    out = language.predicted(docs.select("doc_id", "text"), model)
    return out.select("doc_id", F.coalesce(_part(3) == 1, F.lit(False)).alias("held_out"), "lang_pred", "score", "shares")


#: (action, host, path) that fit a host and its subdomains
HOST_RULES = [
    ("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"),
]


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    out = urls.judged(pages, [urls.host_rule(*r) for r in HOST_RULES] + urls.WORD_RULES)
    return out.select("page_id", "host", "path", F.when(F.col("tier") == 1, F.col("rule")).alias("rule"), "verdict")


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substrings.deduplicated(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"))
    return out.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated",
    )


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = secrets.scanned(docs, secrets.fit(docs))
    base = F.filter("spans", lambda s: s["kind"] != "tagged")

    def count(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return out.select(
        "doc_id", *map(count, secrets.KINDS[:3]), F.sha2(secrets.listed(base), 256).alias("base_sha256"), secrets.listed(F.col("spans")).alias("spans")
    )


def op7_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    model = compression.fit(docs, labels.filter(_part(4) != 2))
    out = compression.scored(docs, model)
    return out.select("doc_id", F.coalesce(_part(4) == 2, F.lit(False)).alias("held_out"), "score", "predicted")


def op8_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked(table(spark, sf_dir, "documents"), k=4, percent=85)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rules.judged(docs).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "quality"
    )


def labelled_domains(labels: DataFrame) -> DataFrame:
    """Domains of the labels table."""
    return labels.select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "junk").when(F.col("quality") == 1, "clean").alias("domain"))


#: share of all tokens that each domain shall have
TARGETS = {"clean": 0.9, "junk": 0.06, "toxic": 0.04}


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = mixing.mixed_to(docs, labelled_domains(table(spark, sf_dir, "labels")), TARGETS)
    return out.select("doc_id", "n_tokens", "domain", "posterior", "rate", "reached", "met")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = lloyd.encoded(table(spark, sf_dir, "embeddings"))
    return out.select("vec_id", "code", "error", "label_error", "codebooks_sha256")


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = alignment.aligned(table(spark, sf_dir, "documents"))
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    narrow = stored(rows.withColumn("groups_sha256", digest).drop("groups"), "aligned")
    return alignment.scored(narrow)


def op13_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.linked(table(spark, sf_dir, "documents"), k=4, percent=80)


QUERIES = {f.__name__: f for f in (
    op1_warc, op2_language_mixture, op3_url_filters, op4_substring_dedup, op5_benchmark_decontamination, op6_secret_scan,
    op7_compression_quality, op8_jaccard_join, op9_quality_rules, op10_mixing, op11_vector_codes, op12_token_alignment,
    op13_minhash_dedup,
)}


def _lloyd_sql(rounds: int = 4) -> str:
    """Rounds of assignment and update, one pair of tables each. Components are doubles that hold integers."""
    near = """
        a{r} as materialized (
            select rid, p, min({{'d': list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c), 'e': e}}) m
            from parts join c{r} using (p) group by 1, 2)"""
    move = """
        c{s} as materialized (
            select c.p, c.e, coalesce(u.c, c.c) c
            from c{r} c left join (
                select p, e, list(f order by i) c
                from (select p, m.e e, i, floor(sum(x[i]) / count(*)) f from a{r} join parts using (rid, p), unnest(range(1, len(x) + 1)) t(i) group by all)
                group by 1, 2) u using (p, e))"""
    steps = ",".join(near.format(r=r) + "," + move.format(r=r, s=r + 1) for r in range(rounds)) + "," + near.format(r=rounds)
    return f"""
        with kept as materialized (
            select row_number() over () rid, vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::double)) v
            from embeddings where embedding is not null and list_bool_and(list_transform(embedding, lambda x: coalesce(isfinite(x), false)))),
        parts as materialized (
            select rid, p, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] x from kept, unnest(range(4)) t(p)),
        firsts as (select vec_id, min(v) v from kept where vec_id is not null group by 1 order by 1 limit 256),
        c0 as materialized (
            select p, e, v[p * (len(v) // 4) + 1 : (p + 1) * (len(v) // 4)] c
            from (select row_number() over (order by vec_id) - 1 e, v from firsts), unnest(range(4)) t(p)),{steps},
        books as (select sha256(string_agg(c[i]::bigint::varchar, ',' order by p, e, i)) h from c{rounds}, unnest(range(1, len(c) + 1)) t(i)),
        coded as (
            select rid, string_agg(format('{{:02x}}', m.e), '' order by p) code, sum(m.d)::bigint error from a{rounds} group by 1),
        rows as (select vec_id, label, code, error from kept join coded using (rid))
        select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, h codebooks_sha256 from rows, books"""


#: components of the links of a similarity join on 4-word shingles
_LINKED = r"""
        with recursive d as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') w
            from documents),
        s as (
            select distinct doc_id, w[i : i + least(len(w), 4) - 1] g
            from d, unnest(range(1, len(w) - least(len(w), 4) + 2)) t(i) where len(w) > 0),
        n as (select doc_id, count(*) n from s group by 1),
        common as (
            select a.doc_id a, b.doc_id b, count(*) c from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
        links as (
            select a, b from common join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= {percent} * (x.n + y.n - c)),
        both_ways as (select a, b from links union all select b, a from links),
        reach(node, least) as (
            select doc_id, doc_id from d
            union
            select b, least from reach join both_ways on node = a where least < b)
        select doc_id, coalesce(max(n.n), 0)::bigint n_shingles, min(least) component_id{more}
        from d left join n using (doc_id) join reach on node = doc_id group by 1"""

ORACLE = {
    "op11_vector_codes": _lloyd_sql(),
    "op1_warc": """
        with d as (
            select page_id, octet_length(encode(coalesce(html, ''))) n, sha256(coalesce(html, '')) h from pages),
        f as (select *, case when n >= 100 then min(page_id) over (partition by h) end first from d)
        select page_id, n::bigint payload_bytes, h payload_digest,
            case when page_id > first then 'revisit' else 'response' end record_type,
            case when page_id > first then first end refers_to
        from f""",
    "op3_url_filters": r"""
        with u as (
            select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end rest from pages),
        p as (
            select page_id, translate(regexp_extract(rest, '^[^/?#]*', 0), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') host,
                regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) path from u),
        r(action, rhost, rpath) as (values
            ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
            ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
        w(word1, word2) as (values ('casino', 'casino'), ('poker', 'poker'), ('porn', 'porn'), ('xxx', 'xxx'), ('viagra', 'viagra'),
            ('warez', 'warez'), ('torrent', 'download'), ('exe', 'exe'), ('apk', 'apk'), ('ads', 'click')),
        best as (
            select page_id, arg_max(rhost || rpath, length(rhost || rpath)) rule, arg_max(action, length(rhost || rpath)) action
            from p join r on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by 1),
        bad as (
            select distinct page_id from p join w
            on list_contains(regexp_extract_all(lower(host || path), '[a-z0-9]+'), word1)
                and list_contains(regexp_extract_all(lower(host || path), '[a-z0-9]+'), word2))
        select page_id, host, path, rule, coalesce(action, case when bad.page_id is null then 'allow' else 'block' end) verdict
        from p left join best using (page_id) left join bad using (page_id)""",
    "op4_substring_dedup": r"""
        with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') w from documents),
        cuts as (select doc_id, i, w[i : i + 12] win from d, unnest(range(1, len(w) - 11)) t(i) where len(w) >= 13),
        firsts as (select win, min(doc_id) lo from cuts group by 1),
        gone as (
            select distinct doc_id, j from cuts join firsts using (win), unnest(range(i, i + 13)) t(j) where doc_id > lo),
        words as (select doc_id, j, w[j] word from d, unnest(range(1, len(w) + 1)) t(j)),
        kept as (
            select doc_id, string_agg(word, ' ' order by j) filter (where gone.j is null) txt, count(gone.j) n
            from words left join gone using (doc_id, j) group by 1)
        select doc_id, len(w)::bigint n_words, coalesce(n, 0)::bigint n_removed, sha256(coalesce(txt, '')) kept_sha256
        from d left join kept using (doc_id)""",
    "op8_jaccard_join": _LINKED.format(percent=85, more=""),
    "op13_minhash_dedup": _LINKED.format(percent=80, more=", doc_id = min(least) kept"),
    "op5_benchmark_decontamination": r"""
        with docs as (
            select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
            from documents),
        items as (
            select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') w
            from benchmark),
        cuts as (
            select distinct item_id, least(len(w), 10) n, w[i : i + least(len(w), 10) - 1] win
            from items, unnest(range(1, len(w) - least(len(w), 10) + 2)) t(i) where len(w) > 0),
        sizes as (select distinct n from cuts),
        places as (
            select doc_id, i, n, w[i : i + n - 1] win
            from docs, sizes, unnest(range(1, len(w) - n + 2)) t(i) where len(w) >= n),
        hits as (select doc_id, item_id, i, cuts.n from places join cuts on places.n = cuts.n and places.win = cuts.win),
        words as (select doc_id, count(distinct j) n_hit from hits, unnest(range(i, i + n)) t(j) group by 1),
        found as (
            select doc_id, count(*) n_items, string_agg(item_id, ',' order by item_id) ids
            from (select distinct doc_id, item_id::varchar item_id from hits) group by 1)
        select doc_id, len(w)::bigint n_words, coalesce(n_hit, 0)::bigint n_hit, coalesce(n_items, 0)::bigint n_items,
            sha256(coalesce(ids, '')) items_sha256, coalesce(n_hit, 0) > 0 contaminated
        from docs left join words using (doc_id) left join found using (doc_id)""",
}
