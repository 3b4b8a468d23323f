"""URL filter: pattern rules indexed by their rarest literal token.

A rule is a regular expression over ``host + path`` together with the literal tokens that every
match contains as whole tokens. Each rule is filed under the one of its tokens that occurs in the
fewest URLs; a URL is checked only against the rules filed under its own tokens. Only DataFrame
functions are used.

Defined results: a null URL, one without ``://`` and an empty one have empty host and path, match
no rule and get the default verdict. Repeated URLs are judged once and each row gets the verdict.
A rule without a token fails the query, since no index could find it. An empty rule table leaves
the default everywhere.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tenurelake.llm.common import free_name
from tenurelake.operators.scale import small

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
TOKEN = r"[^\p{L}\p{N}]+"
RULE_SCHEMA = "rule string, pattern string, tokens array<string>, verdict string, weight int"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a URL, both empty where there is no ``://``."""
    shape = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    part = lambda k: F.coalesce(F.regexp_extract(url, shape, k), F.lit(""))
    return F.translate(part(1), UPPER, LOWER), part(2)


def _tokens(text: str) -> list[str]:
    return [t for t in re.split(r"[\W_]+", text.lower()) if t]


def path_rule(host: str, path: str, verdict: str) -> tuple:
    """A rule for a host and its subdomains whose path starts with ``path``; the longest rule wins.

    A last token that the path could continue is no whole token and is not filed.
    """
    pattern = rf"(?s)^(?:[^/]*\.)?{re.escape(host)}(?=/|$){re.escape(path)}"
    tokens = _tokens(host) + (_tokens(path) if re.search(r"[\W_]$", path) else _tokens(path)[:-1])
    return f"{host}{path}", pattern, tokens, verdict, 1000 + len(host) + len(path)


def word_rule(word: str, verdict: str = "block") -> tuple:
    """A rule for URLs that contain ``word`` as a whole token, in any case; weaker than path rules."""
    pattern = rf"(?is)(?:^|[^\p{{L}}\p{{N}}]){re.escape(word)}(?:$|[^\p{{L}}\p{{N}}])"
    return f"word:{word}", pattern, _tokens(word), verdict, len(word)


def rule_table(spark: SparkSession, rules: list[tuple]) -> DataFrame:
    if not rules:
        return spark.sql("select 1 as one").select(
            *[F.lit(None).cast(kind).alias(name) for name, kind in (x.split(" ") for x in RULE_SCHEMA.split(", "))]
        ).filter(F.lit(False))
    quote = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = ", ".join(
        f"({quote(rule)}, {quote(pattern)}, array({', '.join(map(quote, tokens))}), {quote(verdict)}, {int(weight)})"
        for rule, pattern, tokens, verdict, weight in rules
    )
    named = spark.sql(f"select * from values {rows} as t(rule, pattern, tokens, verdict, weight)")
    return named.withColumn("tokens", F.col("tokens").cast("array<string>"))


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (null where none matched) and verdict.

    Existing columns named host, path, rule or verdict are replaced. Of several matching rules the
    heaviest wins, ties going to the larger rule text.
    """
    target = free_name(pages, "_target")
    host, path = url_parts(F.col(f"`{url}`"))
    parted = pages.withColumns({"host": host, "path": path}).withColumn(target, F.concat("host", "path"))
    urls = parted.select(F.col(target).alias("target")).filter("target <> ''").distinct()
    split = F.array_distinct(F.filter(F.split(F.lower("target"), TOKEN), lambda t: t != ""))
    found = urls.select("target", F.explode(split).alias("token"))

    filable = F.when(F.size("tokens") > 0, F.col("tokens")).otherwise(
        F.raise_error(F.concat(F.lit("a rule needs a literal token: "), "rule"))
    )
    wanted = rules.select("rule", F.explode(filable).alias("token"))
    literal = small(wanted.select("token").distinct())
    uses = found.join(literal, "token").groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    rarest = (
        wanted.join(uses, "token", "left")
        .groupBy("rule").agg(F.min(F.struct(F.coalesce("n", F.lit(0)), "token")).getField("token").alias("token"))
    )
    index = rules.select("rule", "pattern", "verdict", "weight").join(rarest, "rule")
    hits = (
        found.join(small(index), "token").filter(F.expr("target rlike pattern"))
        .groupBy(F.col("target").alias(target)).agg(F.max(F.struct("weight", "rule", "verdict")).alias("hit"))
    )
    kept = [c for c in parted.columns if c.lower() not in ("rule", "verdict", target)]
    return (
        parted.select(*[f"`{c}`" for c in [*kept, target]]).join(hits, target, "left")
        .select(
            *[f"`{c}`" for c in kept], F.col("hit.rule").alias("rule"),
            F.coalesce("hit.verdict", F.lit(default)).alias("verdict"),
        )
    )
