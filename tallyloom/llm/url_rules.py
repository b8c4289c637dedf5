"""URL filter by hashed expressions, as browsers look up unsafe sites.

Each URL is expanded into all pairs of a host suffix and a path prefix. The pairs are joined with the rules on the
first bits of their digests, and only pairs whose full digest is that of a rule count. Of the rules that fit, the one
with the longest text decides.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a digest that the join compares.
PREFIX_BITS = 32
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://`` or for null."""
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def _prefix(digest: Column) -> Column:
    return F.conv(F.substring(digest, 1, PREFIX_BITS // 4), 16, 10).cast("long")


def apply_rules(urls: DataFrame, rules: DataFrame, id_column: str = "page_id", url_column: str = "url", default: str = "allow") -> DataFrame:
    """Judge every URL by ``rules`` (rule, verdict); a rule is a host, a slash and a path, such as ``example.org/es/``.

    A rule fits its host and all subdomains if the URL's path starts with the rule's path. The longest rule wins; of
    equally long ones a block, then the least in order of text. Rules without a slash or with a null are ignored, and
    repeated ones count once. URLs that no rule fits, null and empty ones get ``default``. One row per input row
    (repeated rows stay), with id, host, path, rule and verdict; other columns of ``urls`` are not returned.
    """
    known = (
        rules.where(F.col("rule").contains("/") & F.col("verdict").isNotNull())
        .select(F.col("rule"), F.col("verdict").alias("rule_verdict"))
        .distinct()
        .select("*", F.sha2("rule", 256).alias("rule_digest"))
        .select("*", _prefix(F.col("rule_digest")).alias("short"))
    )
    # the lengths that paths of rules have: at most as many as a URL has characters
    lengths = known.agg(F.array_sort(F.collect_set(F.length("rule") - F.instr("rule", "/") + 1)).alias("lengths"))
    rows = urls.select(F.col(id_column).alias("id"), F.col(url_column).cast("string").alias("url"))
    parts = rows.select("id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))

    # equal URLs are judged once
    distinct = parts.select("host", "path").distinct().select("host", "path", lengths.scalar().alias("lengths"))
    labels = F.split("host", r"\.", -1)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(F.filter("lengths", lambda n: n <= F.length("path")), lambda n: F.col("path").substr(F.lit(1), n))
    expressions = F.flatten(F.transform(F.array_distinct(suffixes), lambda h: F.transform(prefixes, lambda p: F.concat(h, p))))
    expanded = distinct.select("host", "path", F.explode(expressions).alias("expression"))
    hashed = expanded.select("host", "path", F.sha2("expression", 256).alias("digest")).select("*", _prefix(F.col("digest")).alias("short"))
    fits = hashed.join(known, "short").where("digest = rule_digest")
    order = F.struct((-F.length("rule")).alias("long"), F.when(F.col("rule_verdict") == "block", 0).otherwise(1).alias("kind"), F.col("rule"), F.col("rule_verdict"))
    chosen = fits.groupBy("host", "path").agg(F.min(order).alias("best")).select("host", "path", "best.rule", "best.rule_verdict")
    return parts.join(chosen, ["host", "path"], "left").select(
        F.col("id").alias(id_column), "host", "path", "rule", F.coalesce("rule_verdict", F.lit(default)).alias("verdict")
    )
