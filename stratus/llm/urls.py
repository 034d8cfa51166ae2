"""URL rules by hashed host-suffix and path-prefix expressions.

A URL is expanded into every (host suffix at a label boundary) + (path prefix of
a length that some rule's path has).  Expressions meet rules in an equi-join on
the first 4 bytes of their SHA-256; the full digest is confirmed after the join,
and of the rules that fit the longest wins (then the one with the longer host,
then block before allow).  Each distinct (host, path) is expanded once, so a
URL that repeats very often costs no more than one.

Edge cases: a null URL or one without ``://`` has empty host and path and gets
the default verdict; repeated rows and null page ids are kept; a rule given
twice with both verdicts blocks; a rule without host is ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from stratus.llm.scratch import bounded_broadcast

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: Hexadecimal digits of the digest that the join compares (4 bytes).
PREFIX_DIGITS = 8
#: Rules are broadcast up to this many (about 150 bytes each).
MAX_RULES = 200_000


def host_path(url: Column) -> tuple[Column, Column]:
    """The host (after the first ``://``, A-Z lower-cased) and the path."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3, F.length(url))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _UPPER.lower()), path


def _expressions(host: Column, path: Column, lengths: list[int]) -> Column:
    labels = F.split(host, r"\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)),
                           lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fits = F.filter(F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.length(path))
    return F.flatten(F.transform(suffixes, lambda h: F.transform(
        fits, lambda n: F.concat(h, F.substr(path, F.lit(1), n)))))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow",
          id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """(page_id, host, path, rule, verdict), one row per row of ``pages``.

    ``rules``: (host, path, verdict); a rule fits its host and all subdomains if
    the URL's path starts with its path.
    """
    host = F.translate(F.col("host"), _UPPER, _UPPER.lower())
    rule = F.concat(host, F.coalesce("path", F.lit("")))
    keyed = (rules.where("host IS NOT NULL AND host <> ''")
             .select(rule.alias("rule"), F.length(host).alias("host_chars"),
                     F.coalesce(F.length("path"), F.lit(0)).alias("path_chars"), "verdict")
             .groupBy("rule", "host_chars", "path_chars")
             .agg(F.max_by("verdict", F.when(F.col("verdict") == "block", 1).otherwise(0)).alias("verdict"))
             .withColumn("digest", F.sha2("rule", 256)))
    # One number per distinct length of a rule's path, not per rule.
    lengths = sorted(r[0] for r in keyed.select("path_chars").distinct().collect())
    keyed = keyed.withColumn("key", F.substring("digest", 1, PREFIX_DIGITS))

    h, p = host_path(F.col(url_col))
    urls = pages.select(F.col(id_col).alias("page_id"), h.alias("host"), p.alias("path"))
    if not lengths:
        return urls.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
                           F.lit(default).alias("verdict"))
    asked = (urls.select("host", "path").where("host <> ''").distinct()
             .withColumn("expression", F.explode(_expressions(F.col("host"), F.col("path"), lengths)))
             .withColumn("asked", F.sha2("expression", 256))
             .withColumn("key", F.substring("asked", 1, PREFIX_DIGITS)))
    rank = F.struct(F.length("rule"), F.col("host_chars"),
                    F.when(F.col("verdict") == "block", 1).otherwise(0))
    found = (asked.join(bounded_broadcast(keyed, MAX_RULES), "key").where("asked = digest")
             .groupBy("host", "path")
             .agg(F.max_by(F.struct("rule", "verdict"), rank).alias("best")))
    return (urls.join(found, ["host", "path"], "left")
            .select("page_id", "host", "path", F.col("best.rule").alias("rule"),
                    F.coalesce(F.col("best.verdict"), F.lit(default)).alias("verdict")))
