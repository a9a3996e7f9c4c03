"""Allow and block rules on URLs, found through the rarest token of each rule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from beforeafter.llm.text import ascii_lower, unused
from beforeafter.staging import broadcast_if_small, stage

_TOKEN = "[A-Za-z0-9]+"


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def host(url: Column) -> Column:
    """What follows the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null or without ``://``."""
    return ascii_lower(F.coalesce(F.regexp_extract(_rest(url), "^([^/?#]*)", 1), F.lit("")))


def path(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end; empty where the host is."""
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def _tokens(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(f"({_TOKEN})"), F.lit(0))


def compiled(rules: DataFrame) -> DataFrame:
    """``rule``, ``verdict``, its ``pattern`` on host and path, and its whole ``tokens``.

    A rule is a host, then from its first ``/`` on the start of a path; it fits the
    host and all subdomains. ``*`` stands for any characters. Only tokens that every
    fitting URL holds as a whole count: not those beside a ``*``, nor one that ends
    a path prefix.
    """
    rule = F.col("rule")
    rule_host = ascii_lower(F.regexp_extract(rule, "^([^/]*)", 1))
    rule_path = F.regexp_extract(rule, "^[^/]*(.*)$", 1)
    literal = F.concat(rule_host, rule_path)
    quoted = F.regexp_replace(F.regexp_replace(literal, r"([\\^$.|?+()\[\]{}])", r"\\$1"), r"\*", ".*")
    pattern = F.concat(F.lit(r"(?s)^(?:[^/]*\.)?"), quoted, F.when(rule_path == "", F.lit("(?:/|$)")).otherwise(F.lit("")))
    whole = F.regexp_replace(literal, r"[A-Za-z0-9]*\*[A-Za-z0-9]*", "*")
    whole = F.when(rule_path == "", whole).otherwise(F.regexp_replace(whole, f"{_TOKEN}$", ""))
    return rules.filter(rule.isNotNull()).select(
        "rule", "verdict", pattern.alias("pattern"), F.array_distinct(_tokens(whole)).alias("tokens")
    )


def indexed(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """One row per rule with the ``token`` that fewest of the urls hold (then the
    longest, then the first), or an empty one if it has no whole token.

    ``urls`` has an array column ``tokens``; only tokens of rules are counted.
    """
    named = rules.select("rule", "verdict", "pattern", F.explode_outer("tokens").alias("token"))
    wanted = broadcast_if_small(named.select("token").distinct())
    counts = urls.select(F.explode("tokens").alias("token")).join(wanted, "token", "left_semi").groupBy("token").count()
    best = F.min_by(
        F.coalesce("token", F.lit("")),
        F.struct(F.coalesce("count", F.lit(0)), -F.length("token"), "token"),
    )
    return named.join(counts, "token", "left").groupBy("rule", "verdict", "pattern").agg(best.alias("token"))


def judge(df: DataFrame, rules: DataFrame, url_col: str = "url", default: str = "allow") -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` (null if none fits) and ``verdict``.

    ``rules`` has ``rule`` and ``verdict``. Each URL's tokens, and one empty token, fetch the rules filed under them; only
    those run their regular expression, and the longest that fits wins (ties: the
    greater string). ``default`` is the verdict without a fitting rule. Null URLs and
    those without ``://`` have an empty host and path. Every row comes back once,
    repeated rows too; columns of the new names are replaced; an empty table stays
    empty. The rule side is broadcast only while it is measured to be small.
    """
    new = ("host", "path", "rule", "verdict")
    carry = [c for c in df.columns if c.lower() not in new]
    url = F.col(f"`{url_col}`")
    uid = unused("_uid", carry)
    urls = df.select(*[F.col(f"`{c}`") for c in carry], host(url).alias("host"), path(url).alias("path"))
    tokens = F.array_distinct(F.array_append(_tokens(F.concat("host", "path")), F.lit("")))
    index = stage(indexed(compiled(rules), urls.select(tokens.alias("tokens"))), "url-rules")
    names = [f"`{c}`" for c in (*carry, "host", "path")]
    held = unused("_row", carry)
    fetched = (
        urls.withColumn(uid, F.monotonically_increasing_id())
        .select(uid, F.struct(*names).alias(held), F.explode(tokens).alias("_token"))
        .join(broadcast_if_small(index.withColumnRenamed("token", "_token")), "_token", "left")
    )
    address = F.concat(F.col(held)["host"], F.col(held)["path"])
    fits = F.when(
        F.expr("pattern IS NOT NULL") & F.call_function("rlike", address, F.col("pattern")),
        F.struct(F.length("rule").alias("n"), "rule", "verdict"),
    )
    # A row's tokens lie in one task, so they shrink to one row before the shuffle.
    best = fetched.groupBy(uid).agg(F.any_value(held).alias(held), F.max(fits).alias("_best"))
    return best.select(
        *[F.col(held)[c].alias(c) for c in (*carry, "host", "path")],
        F.col("_best")["rule"].alias("rule"),
        F.coalesce(F.when(F.col("_best").isNotNull(), F.col("_best")["verdict"]), F.lit(default)).alias("verdict"),
    )
