"""URL filters: host-suffix and path-prefix expressions, joined on short hash prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from waybill.llm.common import fresh, small
from waybill.sources.scratch import Scratch

#: Hex digits of a digest that rules and URLs meet on.
PREFIX = 8

RULES = "host string, path string, verdict string"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """Rules (host, path, verdict) from settings."""
    return spark.createDataFrame(rules, RULES)


def host_of(url: Column) -> Column:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; empty without one."""
    rest = _rest(url)
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """After the host up to ?, # or the end; empty without ://."""
    return F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1)


def _rest(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _digest(host: Column, path: Column) -> Column:
    """A host and a path cannot be taken for another pair: no host holds a line feed or slash."""
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def _suffixes(host: Column) -> Column:
    """The host and what follows each of its dots."""
    labels = F.split(host, r"\.")
    return F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )


def judge(
    pages: DataFrame,
    rules: DataFrame,
    space: Scratch,
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Columns host, path, rule, verdict besides those of pages (renamed there if they clash).

    A rule fits its host and all subdomains where the path starts with the rule's. The longest
    fitting rule (host and path together) decides, of equally long ones that with the longer path, then a
    block. Without a fitting rule, and for URLs that are null or have no ://, rule is null and the verdict
    the default. Repeated rules count once; rules with a null host, path or verdict never fit.
    Repeated pages are judged each; an empty table gives no rows.

    Each distinct (host, path) is expanded once, so a host or URL with most rows costs nothing
    extra before the final join. Path prefixes are built only in the lengths that rules have.
    """
    url = F.coalesce(F.col(f"`{url_col}`"), F.lit(""))
    clash = {"host", "path", "rule", "verdict"}
    kept = [
        F.col(f"`{c}`").alias(fresh(pages.columns, f"page_{c}") if c.lower() in clash else c)
        for c in pages.columns
    ]
    judged = pages.select(*kept, host_of(url).alias("host"), path_of(url).alias("path"))

    known = rules.where("host is not null and path is not null and verdict is not null").distinct()
    known = known.select(
        F.substring(_digest(F.col("host"), F.col("path")), 1, PREFIX).alias("short"),
        _digest(F.col("host"), F.col("path")).alias("rule_digest"),
        F.concat("host", "path").alias("rule"),
        F.length("path").alias("path_len"),
        "verdict",
    )
    known = space.write(known, "rules")
    # One number for each length that a path of a rule has: no more than the longest has letters.
    lengths = sorted(r.path_len for r in known.select("path_len").distinct().collect())

    urls = pages.select(host_of(url).alias("host"), path_of(url).alias("path")).distinct()
    fitting = F.filter(
        F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path")
    )
    expressions = urls.select(
        "host", "path", F.explode(_suffixes(F.col("host"))).alias("suffix")
    ).select("host", "path", "suffix", F.explode(fitting).alias("n"))
    digest = _digest(F.col("suffix"), F.substring(F.col("path"), F.lit(1), F.col("n")))
    expressions = expressions.select("host", "path", digest.alias("digest"))
    expressions = expressions.withColumn("short", F.substring("digest", 1, PREFIX))
    best = (
        expressions.join(small(known), "short")
        .where("digest = rule_digest")
        .groupBy("host", "path")
        .agg(
            F.max(
                F.struct(
                    F.length("rule").alias("len"), "path_len", (F.col("verdict") == "block").alias("block"),
                    "rule", "verdict",
                )
            ).alias("best")
        )
    )
    best = best.select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    # Stored, so that the rows of a frequent URL can be split in the last join.
    best = space.write(best, "best")
    out = judged.join(best, ["host", "path"], "left")
    return out.select(
        *[judged[f"`{c}`"] for c in judged.columns],
        "rule",
        F.coalesce("verdict", F.lit(default)).alias("verdict"),
    )
