"""URL filters: pattern rules indexed by their rarest literal token.

Every rule names the literal tokens (runs of a-z and 0-9, lower case) that each
URL it fits must hold. One pass over all URLs counts those literals; a rule is
filed under its rarest one. A URL's tokens then fetch candidate rules from that
index and only the candidates' regular expressions run. All of it is DataFrame
functions; there is no join: the index (one entry a rule, so its size is that of
the rule list) is a literal map inside the expression, and rows never move.

Nulls and odd rows: a null URL, or one without ``://``, has an empty host and
path and no host rule fits it. Repeated rows are judged each for itself; other
columns of the input take no part, and an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
_TOKEN = re.compile("[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    """``on``: ``place`` matches host + path (host rules), ``url`` the whole lower-case URL (pattern rules)."""

    name: str
    verdict: str
    regex: str
    literals: tuple[str, ...]
    on: str = "url"


def host_rule(verdict: str, host_and_path: str) -> Rule:
    """``org/en/1``: the host and its subdomains, where the URL's path starts with ``/en/1``."""
    host, _, path = host_and_path.partition("/")
    # The last piece of the path may be the start of a longer token; it is no literal unless a slash ends it.
    whole_pieces = path.split("/")[:-1]
    literals = _TOKEN.findall(host.lower()) + [t for p in whole_pieces for t in _TOKEN.findall(p.lower())]
    # (?s) is not needed: negated classes match line breaks.
    regex = r"^(?:[^/]*\.)?" + re.escape(host.lower()) + re.escape("/" + path)
    return Rule(host_and_path, verdict, regex, tuple(dict.fromkeys(literals)), "place")


#: The rules of the query (fixed values).
HOST_RULES = (
    host_rule("allow", "org/"),
    host_rule("block", "example.org/es/"),
    host_rule("block", "example.org/en/1"),
    host_rule("allow", "com/fr/"),
    host_rule("block", "com/de/"),
)

#: Pattern rules for the URLs that no host rule fits; all block.
PATTERN_RULES = (
    Rule("casino", "block", r"[./_-]casino[./_-]", ("casino",)),
    Rule("poker", "block", r"[./_-]poker[./_-]", ("poker",)),
    Rule("porn", "block", r"[./_-]porn[./_-]", ("porn",)),
    Rule("xxx", "block", r"[./]xxx[./]", ("xxx",)),
    Rule("viagra", "block", r"[./_=-]viagra([./_&-]|\z)", ("viagra",)),
    Rule("torrent-file", "block", r"\.torrent(\z|[?#])", ("torrent",)),
    Rule("ad-host", "block", r"://ads\.[^/]*/", ("ads",)),
    Rule("login-page", "block", r"/(user|account)/login(\z|[/?#])", ("login",)),
    Rule("cart-page", "block", r"/cart/(add|checkout)(\z|[/?#])", ("cart",)),
    Rule("session-id", "block", r"[?&;](jsessionid|phpsessid|sid)=[0-9a-f]{16,}", ()),
    Rule("feed-tracker", "block", r"[?&]utm_source=feed(&|#|\z)", ("utm", "source", "feed")),
    Rule("binary-file", "block", r"\.exe(\z|[?#])", ("exe",)),
)


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, LOWER)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host and path as the contract words them (both empty where the URL is null or has no ``://``)."""
    url = F.coalesce(url, F.lit(""))
    rest = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return ascii_lower(host), path


def url_tokens(lower_url: Column) -> Column:
    return F.array_distinct(F.filter(F.split(lower_url, "[^a-z0-9]+"), lambda t: t != ""))


def literal_counts(pages: DataFrame, rules: tuple[Rule, ...], url: str = "url") -> dict[str, int]:
    """In how many URLs each literal of the rules occurs, over all rows (at most one count a literal is collected)."""
    literals = sorted({t for r in rules for t in r.literals})
    if not literals:
        return {}
    lower = ascii_lower(F.coalesce(F.col(url), F.lit("")))
    tokens = pages.select(F.explode(F.array_intersect(url_tokens(lower), F.array(*map(F.lit, literals)))).alias("token"))
    found = {r["token"]: r["n"] for r in tokens.groupBy("token").agg(F.count("*").alias("n")).collect()}
    return {t: found.get(t, 0) for t in literals}


def rule_index(rules: tuple[Rule, ...], counts: dict[str, int]) -> dict[str, list[Rule]]:
    """Each rule under its rarest literal (ties: the alphabetically first); rules without literals under the empty token."""
    index: dict[str, list[Rule]] = {}
    for r in rules:
        index.setdefault(min(r.literals, key=lambda t: (counts.get(t, 0), t), default=""), []).append(r)
    return index


def _entry(r: Rule) -> Column:
    return F.struct(
        F.lit(r.name).alias("name"),
        F.lit(r.verdict).alias("verdict"),
        F.lit(r.regex).alias("regex"),
        F.lit(r.on == "place").alias("is_host_rule"),
    )


def judge_urls(
    pages: DataFrame,
    host_rules: tuple[Rule, ...] = HOST_RULES,
    pattern_rules: tuple[Rule, ...] = PATTERN_RULES,
    url: str = "url",
) -> DataFrame:
    """Add host, path, rule (the longest host rule that fits), pattern (the first pattern rule, by name) and verdict.

    The verdict is the host rule's, else ``block`` if a pattern rule fits, else
    ``allow``. Columns of the input with the same names are replaced.
    """
    rules = (*host_rules, *pattern_rules)
    index = rule_index(rules, literal_counts(pages, rules, url))
    always = F.array(*map(_entry, index.pop("", [])))
    if index:
        filed = F.create_map(*[c for t, rs in sorted(index.items()) for c in (F.lit(t), F.array(*map(_entry, rs)))])
    else:
        filed = F.create_map(F.lit(""), always)
    known = F.array(*[F.lit(t) for t in sorted(index)]) if index else F.array(F.lit(""))
    host, path = host_and_path(F.col(url))
    df = pages.withColumn("host", host).withColumn("path", path)
    lower = ascii_lower(F.coalesce(F.col(url), F.lit("")))
    fetched = F.flatten(F.transform(F.array_intersect(url_tokens(lower), known), lambda t: F.try_element_at(filed, t)))
    place = F.concat("host", "path")
    fits = F.filter(
        F.concat(always, fetched) if len(rules) else always,
        lambda r: F.when(r["is_host_rule"], F.regexp(place, r["regex"])).otherwise(F.regexp(lower, r["regex"])),
    )
    df = df.withColumn("_fits", fits)
    ranked = F.transform(
        F.filter("_fits", lambda r: r["is_host_rule"]),
        lambda r: F.struct(F.length(r["name"]).alias("length"), r["name"].alias("name"), r["verdict"].alias("verdict")),
    )
    df = df.withColumn("_best", F.array_max(ranked))
    df = df.withColumn("pattern", F.array_min(F.transform(F.filter("_fits", lambda r: ~r["is_host_rule"]), lambda r: r["name"])))
    df = df.withColumn("rule", F.col("_best.name"))
    verdict = F.coalesce(F.col("_best.verdict"), F.when(F.col("pattern").isNotNull(), "block").otherwise("allow"))
    return df.withColumn("verdict", verdict).drop("_fits", "_best")


def oracle_sql(host_rules: tuple[Rule, ...] = HOST_RULES, pattern_rules: tuple[Rule, ...] = PATTERN_RULES) -> str:
    """DuckDB SQL that runs every rule on every URL."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    longest_first = sorted(host_rules, key=lambda r: (-len(r.name), r.name))
    rule = "CASE " + " ".join(f"WHEN regexp_matches(host || path, {quote(r.regex)}) THEN {quote(r.name)}" for r in longest_first) + " END"
    of_rule = "CASE rule " + " ".join(f"WHEN {quote(r.name)} THEN {quote(r.verdict)}" for r in longest_first) + " END"
    pattern = "CASE " + " ".join(f"WHEN regexp_matches(low, {quote(r.regex)}) THEN {quote(r.name)}" for r in sorted(pattern_rules, key=lambda r: r.name)) + " END"
    return f"""
    WITH cut AS (
      SELECT page_id, translate(coalesce(url, ''), '{UPPER}', '{LOWER}') AS low,
             CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
    parts AS (
      SELECT page_id, low, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM cut),
    ruled AS (SELECT *, {rule} AS rule, {pattern} AS pattern FROM parts)
    SELECT page_id, host, path, rule, coalesce({of_rule}, CASE WHEN pattern IS NULL THEN 'allow' ELSE 'block' END) AS verdict, pattern
    FROM ruled
    """
