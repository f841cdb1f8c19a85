"""URL filter lists: a blocked Bloom filter in front of an exact hash join."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: A block is eight words of 64 bits; a key sets one bit in each word.
WORDS = 8
#: Filter tables of up to so many blocks (64 MB) are sent to all executors; larger ones are joined by block.
SENT_BLOCKS = 1 << 20


def url_host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or end, A-Z lower-cased; empty where there is none."""
    host = F.regexp_extract(url, r"(?s)\A.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def url_path(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or end; empty where there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)\A.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_suffixes(host: Column) -> Column:
    """The host and all its parent domains: ``a.b.c``, ``b.c``, ``c``."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels) - i + 1), "."))


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks)).cast("int")


def _bits(key: Column) -> list[Column]:
    h = F.xxhash64(F.lit(1), key)
    return [F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int") for i in range(WORDS)]


def bloom_filter(keys: DataFrame, key: str, n_blocks: int) -> DataFrame:
    """The blocks that any key falls in: ``block, w0 .. w7``."""
    bits = [F.expr(f"shiftleft(1L, b{i})").alias(f"w{i}") for i in range(WORDS)]
    spread = keys.select(_block(F.col(key), n_blocks).alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(_bits(F.col(key)))])
    return spread.select("block", *bits).groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def filter_urls(
    pages: DataFrame,
    rules: DataFrame,
    url: str = "url",
    default: str = "allow",
    keys_per_block: int = 24,
) -> DataFrame:
    """The verdict of the longest rule that fits each url.

    ``rules`` has ``host, path, action``: a rule fits its host and all
    subdomains where the url's path starts with the rule's. A url's candidate
    keys are its parent domains with the starts of its path, in the lengths that
    rules have. Keys that pass a blocked Bloom filter of the rules (about 21
    bits a rule) are joined to the rules exactly, so no false positive is left;
    urls are judged once each, however often they occur. Adds ``host, path,
    rule`` (null if none fits) and ``verdict``; columns of those names give way.
    Null urls and urls without ``://`` have an empty host and path and get the
    default. Rules that repeat count once; of rules that share host and path,
    the smallest action wins. Without rules all urls get the default.
    """
    own = ["host", "path", "rule", "verdict"]
    packed = pages.select(
        F.struct(*[pages[f"`{c}`"] for c in pages.columns]).alias("row"),
        url_host(pages[f"`{url}`"]).alias("host"),
        url_path(pages[f"`{url}`"]).alias("path"),
    )
    kept = [F.col(f"row.`{c}`").alias(c) for c in pages.columns if c not in own]
    listed = (
        rules.where("host IS NOT NULL AND path IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.min("action").alias("action"))
        .select(F.concat("host", "path").alias("rule"), F.concat_ws("\n", "host", "path").alias("rule_key"), "action", F.length("path").alias("n"))
    )
    n_rules = listed.count()
    if not n_rules:
        return packed.select(*kept, "host", "path", F.lit(None).cast("string").alias("rule"), F.lit(default).alias("verdict"))
    lengths = [r["n"] for r in listed.select("n").distinct().collect()]
    n_blocks = max(1, -(-n_rules // keys_per_block))
    blocks = bloom_filter(listed, "rule_key", n_blocks)
    if n_blocks <= SENT_BLOCKS:
        blocks = F.broadcast(blocks)

    starts = F.array_distinct(
        F.filter(
            F.array(*[F.when(F.length("path") >= n, F.substring("path", 1, n)) for n in sorted(lengths)]),
            lambda p: p.isNotNull(),
        )
    )
    keys = F.flatten(F.transform(host_suffixes(F.col("host")), lambda h: F.transform(starts, lambda p: F.concat_ws("\n", h, p))))
    places = packed.where("host <> ''").select("host", "path").distinct()
    probes = places.select("host", "path", F.explode(keys).alias("key"))
    probes = probes.select("*", _block(F.col("key"), n_blocks).alias("block"), *[b.alias(f"b{i}") for i, b in enumerate(_bits(F.col("key")))])
    passed = probes.join(blocks, "block").where(
        " AND ".join(f"(shiftright(w{i}, b{i}) & 1L) = 1L" for i in range(WORDS))
    )
    fits = passed.join(listed, passed["key"] == listed["rule_key"])
    best = fits.groupBy("host", "path").agg(F.max(F.struct(F.length("rule").alias("n"), "rule", "action")).alias("best"))
    best = best.select(F.col("host").alias("h"), F.col("path").alias("p"), "best.rule", "best.action")
    judged = packed.join(best, (F.col("host") == F.col("h")) & (F.col("path") == F.col("p")), "left")
    return judged.select(*kept, "host", "path", "rule", F.coalesce("action", F.lit(default)).alias("verdict"))
