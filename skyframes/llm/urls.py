"""URL filters: pattern rules found through their rarest literal token.

Each rule names the literal tokens (runs of a-z and 0-9, any case) that a matching URL must hold.
Tokens are counted over all URLs, each rule is indexed under its rarest one, the tokens of a URL
fetch the rules indexed under them, and only those rules' regular expressions run, on host + path.
Everything is DataFrame functions: explode, join, one aggregate by URL with a map-side part.

Of the matching rules the one with the highest tier wins, then the longest, then the first by name.
The verdict is its action; if none matches, `otherwise`.

Defined results: a null URL, or one without `://`, has empty host and path and no match; repeated
rows get equal verdicts; an empty table gives an empty table; without rules all get `otherwise`.
A rule without tokens can't be indexed and is refused with a ValueError. Input columns of the
results' names are replaced.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .tables import stored

_AZ, _az = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_TOKEN = re.compile("[a-z0-9]+")

#: bytes of rules that go to every task at most
MOST_SENT = 1 << 25


@dataclass(frozen=True)
class Rule:
    name: str
    action: str
    pattern: str  # on host + path
    tokens: tuple[str, ...] = field(default=())
    tier: int = 0
    length: int = 0


def host_rule(action: str, host: str, path: str = "/") -> Rule:
    """Fits a host and its subdomains if the URL's path starts with the rule's."""
    whole = path if not path or not path[-1].isalnum() else re.sub("[A-Za-z0-9]+$", "", path)
    tokens = tuple(_TOKEN.findall(f"{host}{whole}".lower()))
    ends = "" if path else "(?:/|$)"
    return Rule(host + path, action, rf"^(?:[^/]*\.)?\Q{host}\E\Q{path}\E{ends}", tokens, 1, len(host + path))


def word_rule(action: str, *words: str) -> Rule:
    """Fits URLs that hold all the words, each as a token of its own."""
    looks = "".join(rf"(?=(?:.*[^a-z0-9])?{w}(?:[^a-z0-9]|$))" for w in words)
    return Rule(" ".join(words), action, f"(?is)^{looks}", tuple(words), 0, sum(map(len, words)))


#: what is blocked where no host rule fits
WORD_RULES = [word_rule("block", *w) for w in (
    ("casino",), ("poker",), ("porn",), ("xxx",), ("viagra",), ("warez",), ("torrent", "download"), ("exe",), ("apk",), ("ads", "click"),
)]


def host(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _AZ, _az)


def path(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.coalesce(F.locate("://", url), F.lit(0))
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")


def indexed(urls: DataFrame, rules: list[Rule]) -> DataFrame:
    """Rules with the one of their tokens that is rarest in all URLs; urls has `_tokens`."""
    spark = urls.sparkSession
    if lost := [r.name for r in rules if not r.tokens]:
        raise ValueError(f"rules without a literal token: {lost}")
    # the rules come from the driver, so their size is known; beyond the limit the joins shuffle
    sent = F.broadcast if sum(len(r.pattern) + len(r.name) + 100 for r in rules) <= MOST_SENT else (lambda df: df)
    listed = spark.createDataFrame(
        [(i, r.name, r.action, r.pattern, r.tier, r.length, sorted(set(r.tokens))) for i, r in enumerate(rules)],
        "_id int, name string, action string, pattern string, tier int, length int, tokens array<string>",
    )
    wanted = listed.select("_id", F.explode("tokens").alias("_token"))
    counts = (
        urls.select(F.explode("_tokens").alias("_token"))
        .join(sent(wanted.select("_token").distinct()), "_token", "left_semi")
        .groupBy("_token").count()
    )
    rarest = (
        wanted.join(counts, "_token", "left")
        .groupBy("_id").agg(F.min_by("_token", F.struct(F.coalesce("count", F.lit(0)), "_token")).alias("_token"))
    )
    return sent(listed.drop("tokens").join(sent(rarest), "_id"))


def judged(pages: DataFrame, rules: list[Rule], otherwise: str = "allow", url: str = "url") -> DataFrame:
    """pages with host, path, rule, tier (both null where no rule fits) and verdict."""
    kept = pages.drop("host", "path", "rule", "tier", "verdict")
    key = F.concat(host(F.col("_url")), path(F.col("_url")))
    urls = (
        kept.select(F.col(url).alias("_url")).filter(F.col("_url").isNotNull())
        .withColumn("_key", key).filter("_key != ''")
        .withColumn("_tokens", F.array_distinct(F.regexp_extract_all(F.translate("_key", _AZ, _az), F.lit("[a-z0-9]+"), F.lit(0))))
    )
    found = (
        urls.select("_url", "_key", F.explode("_tokens").alias("_token"))
        .join(indexed(urls, rules), "_token")
        .filter(F.rlike("_key", F.col("pattern")))
        .groupBy("_url")
        .agg(F.min(F.struct(-F.col("tier"), -F.col("length"), "name", "action", "tier")).alias("_best"))
    )
    # tables of their own, so that the join can split a URL that many pages have; pages that no rule fits do not meet there
    found = stored(found, "judged-urls")
    address, none = F.col(f"`{url}`"), F.lit(None)

    def result(rows: DataFrame, name: Column, tier: Column, action: Column) -> DataFrame:
        new = {"host": host(address), "path": path(address), "rule": name.cast("string"), "tier": tier.cast("int"), "verdict": F.coalesce(action.cast("string"), F.lit(otherwise))}
        return rows.select(*[F.col(f"`{c}`") for c in kept.columns], *[column.alias(c) for c, column in new.items()])

    # the other side's columns get names that no page has
    own = {c.lower() for c in kept.columns}
    key, best = (next(f"{c}{i}" for i in range(len(own) + 1) if f"{c}{i}" not in own) for c in ("_url", "_best"))
    met = kept.filter(address.isNotNull()).join(found.withColumnsRenamed({"_url": key, "_best": best}), address == F.col(key), "left")
    with_url = result(met, F.col(f"{best}.name"), F.col(f"{best}.tier"), F.col(f"{best}.action"))
    return with_url.unionByName(result(kept.filter(address.isNull()), none, none, none))
