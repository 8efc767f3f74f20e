"""URL rules matched by hashed expressions: host suffix times path prefix.

A rule (host, path) fits a URL whose host is the rule's or a subdomain of it and whose path
starts with the rule's.  Every URL is expanded into the host suffixes and path prefixes a
rule could have; an expression and a rule meet in an equi-join on the first bytes of their
SHA-256 digests, and whole digests confirm the match.  The longest matching rule wins.

DataFrame functions only.  Expansion is bounded by the shapes (number of labels, length of
path) that occur among the rules, not by the URL: a URL of a million characters gives as many
expressions as a short one.  Expansion works on distinct (host, head of path) pairs, counted
down before the shuffle, so a host with a third of all pages is expanded once per different
head.  Nothing is broadcast by hint: the planner does so where it knows the size.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from matrixlens.llm.tables import ascii_lower, written

#: Hexadecimal digits of a digest that make the join key (four bytes).
PREFIX_DIGITS = 8


def url_host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/ ? #``, A-Z lower-cased; else empty."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1))


def url_path(url: Column) -> Column:
    """What follows the host up to ``? #``; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, "\\."))


def _digest(host: Column, path: Column) -> Column:
    """Of the expression; the path's length keeps host and path apart."""
    return F.sha2(F.concat_ws(":", F.length(path).cast("string"), F.concat(host, path)).cast("binary"), 256)


def filter_urls(pages: DataFrame, rules: DataFrame, page_id: str = "page_id", url: str = "url", default: str = "allow") -> DataFrame:
    """Judge every row of ``pages`` by ``rules`` (host, path, verdict).

    Returns page_id, host, path, rule, verdict, one row per input row.  Of the rules that fit,
    the one with the most characters wins; then the longer host; then ``block``.  No rule:
    ``rule`` is null and the verdict is ``default``.  A null URL, or one without ``://``, has an
    empty host and path and fits no rule; rules with a null host or path fit nothing.  Repeated
    pages are judged alike, repeated rules count once; other columns are not looked at.
    """
    pages = pages.select(F.col(page_id).alias("page_id"), url_host(F.col(url)).alias("host"), url_path(F.col(url)).alias("path"))
    rules = (
        rules.select(ascii_lower(F.col("host")).alias("rule_host"), F.col("path").alias("rule_path"), F.col("verdict").alias("rule_verdict"))
        .where("rule_host IS NOT NULL AND rule_host != '' AND rule_path IS NOT NULL")
        .distinct()
    )
    shapes = sorted((r[0], r[1]) for r in rules.select(_labels(F.col("rule_host")), F.length("rule_path")).distinct().collect())
    if not shapes:
        return pages.select("*", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    reach = max(n for _, n in shapes)
    pages = pages.withColumn("_head", F.left("path", F.lit(reach)))

    def expression(shape: Column) -> Column:
        host = F.call_function("substring_index", F.col("host"), F.lit("."), -shape["labels"])
        fits = (_labels(F.col("host")) >= shape["labels"]) & (F.length("_head") >= shape["chars"])
        return F.when(fits, _digest(host, F.substring(F.col("_head"), F.lit(1), shape["chars"])))

    known = F.array(*(F.struct(F.lit(k).alias("labels"), F.lit(n).alias("chars")) for k, n in shapes))
    expanded = (
        pages.where("host != ''").select("host", "_head").distinct()
        .select("host", "_head", F.explode(F.transform(known, expression)).alias("_digest"))
        .where("_digest IS NOT NULL")
        .withColumn("_prefix", F.left("_digest", F.lit(PREFIX_DIGITS)))
    )
    hashed = rules.withColumn("_rule_digest", _digest(F.col("rule_host"), F.col("rule_path")))
    hashed = hashed.withColumn("_prefix", F.left("_rule_digest", F.lit(PREFIX_DIGITS)))
    rule = F.concat("rule_host", "rule_path")
    precedence = F.struct(F.length(rule), F.length("rule_host"), F.col("rule_verdict") == "block")
    decided = (
        expanded.join(hashed, "_prefix").where("_digest = _rule_digest")
        .groupBy("host", "_head")
        .agg(F.max(F.struct(precedence.alias("rank"), rule.alias("rule"), F.col("rule_verdict").alias("verdict"))).alias("_won"))
    )
    decided = written(decided)  # both sides of the join are dealt anew then, so a hot host can be split
    return pages.join(decided, ["host", "_head"], "left").select(
        "page_id", "host", "path", F.col("_won.rule").alias("rule"), F.coalesce("_won.verdict", F.lit(default)).alias("verdict")
    )
