"""URL filters (operator 9), DataFrame expressions only.

Each distinct (host, path) is expanded into its host suffixes (at label
borders) and those path prefixes whose length some rule has; each expression
is hashed. Rules and expressions meet in an equi-join on a short prefix of the
hash; the full digest and the rule's own text confirm a match. The longest
rule wins; of equally long ones block, then the smaller text. Work is done
once per distinct (host, path); a URL that fills a third of the table is one
row until the final join back, which AQE may split.

A null url, or one without ``://``, has an empty host and path; only the
default verdict fits it. Repeated pages each give a row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pmflow.llm.common import column

#: Hex digits of the hash by which rules and expressions meet: 32 bits.
HASH_PREFIX = 8
#: Verdict of a url that no rule fits.
DEFAULT_VERDICT = "allow"


def _ascii_lower(c: Column) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    return F.coalesce(_ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    # no host holds a slash, so host and path can't run into each other
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge(pages: DataFrame, rules: DataFrame, key: str = "page_id", url: str = "url",
          default: str = DEFAULT_VERDICT) -> DataFrame:
    """One row per page: ``key``, host, path, rule (host and path of the rule,
    else null) and verdict. ``rules`` has verdict, host and path; hosts are
    compared in lower case, a null path is an empty one."""
    rules = rules.select(
        F.col("verdict").alias("r_verdict"), _ascii_lower(F.col("host")).alias("r_host"),
        F.coalesce("path", F.lit("")).alias("r_path")).where("r_host is not null and r_host != ''")
    rules = rules.withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path"))).withColumn(
        "r_short", F.substring("r_digest", 1, HASH_PREFIX))
    # the few lengths that rule paths have, as a scalar subquery
    lengths = rules.agg(F.array_sort(F.collect_set(F.char_length("r_path")))).scalar()
    given = pages.select(column(key).alias("_key"), host_of(column(url)).alias("host"),
                         path_of(column(url)).alias("path"))
    urls = given.select("host", "path").distinct().where("host != ''")
    labels = F.split("host", r"\.")
    urls = urls.select(
        "host", "path", lengths.alias("lengths"),
        F.explode(F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.concat_ws(
            ".", F.slice(labels, i, F.size(labels))))).alias("suffix"))
    urls = urls.select("host", "path", "suffix", F.explode(F.filter(
        "lengths", lambda n: n <= F.char_length("path"))).alias("n"))
    urls = urls.withColumn("prefix", F.substring(F.col("path"), F.lit(1), F.col("n")))
    urls = urls.withColumn("digest", _digest(F.col("suffix"), F.col("prefix"))).withColumn(
        "short", F.substring("digest", 1, HASH_PREFIX))
    hits = urls.join(rules, (F.col("short") == F.col("r_short"))).where(
        "digest = r_digest and suffix = r_host and prefix = r_path")
    rule = F.concat("r_host", "r_path")
    best = hits.groupBy("host", "path").agg(F.min(F.struct(
        (-F.char_length(rule)).alias("shorter"), (F.col("r_verdict") != "block").alias("allows"),
        rule.alias("rule"), F.col("r_verdict").alias("verdict"))).alias("best"))
    return given.join(best, ["host", "path"], "left").select(
        F.col("_key").alias(key), "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
