"""URL filters: rules by host and path, then a list of canonical URLs behind a blocked Bloom filter.

The list is hashed into blocks of eight 64-bit words; a URL sets one bit in each word of its
block. Blocks are built by one aggregation of bit-ors, their number never passes ``MAX_BLOCKS``, and
so the filter may be broadcast whatever the size of the list. URLs that miss a bit are certainly not
listed and take no further part. Possible hits, few of them wrong, go to an exact join with the
list, which removes the false positives; a fuller filter only sends more URLs there.

Everything is DataFrame functions. A null URL, or one without ``://``, has an empty host and path,
fits no rule and is never listed. Null page ids and repeated rows are judged like any others, an
empty list blocks nothing, an empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlane.shared import settle

WORDS = 8
KEYS_PER_BLOCK = 24
MAX_BLOCKS = 1 << 15
TRACKING = "^(utm_[^=]*|ref|fbclid|gclid|sessionid)(=.*)?$"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty where there is none."""
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(_rest(url), "^[^/?#]*", 0), _UPPER, _LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1)


def canonical(url: Column) -> Column:
    """Host without user, ``www.`` and usual port, path without last slash, sorted parameters.

    Scheme, fragment and tracking parameters are dropped. Null for a URL without a host.
    """
    host = F.regexp_replace(host_of(url), "^[^@]*@", "")
    host = F.regexp_replace(F.regexp_replace(host, ":(80|443)$", ""), "^www\\.", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.regexp_extract(_rest(url), "^[^?#]*\\?([^#]*)", 1)
    kept = F.filter(F.split(query, "&"), lambda one: (one != "") & ~one.rlike(TRACKING))
    query = F.array_join(F.array_sort(kept), "&")
    whole = F.concat(host, path, F.when(query != "", F.concat(F.lit("?"), query)).otherwise(""))
    return F.when(host != "", whole)


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest of (verdict, host, path) rules that fits, as a struct; null if none does."""
    fits = [
        F.when(
            ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path),
            F.struct(
                F.lit(len(rule_host + rule_path)).alias("length"),
                F.lit(rule_host + rule_path).alias("rule"),
                F.lit(verdict).alias("verdict"),
            ),
        )
        for verdict, rule_host, rule_path in rules
    ]
    return F.array_max(F.filter(F.array(*fits), lambda one: one.isNotNull()))


def _masks(key: Column) -> list[Column]:
    bits = F.xxhash64(F.lit("bits"), key)
    return [
        F.call_function(
            "shiftleft",
            F.lit(1).cast("long"),
            F.shiftrightunsigned(bits, 6 * word).bitwiseAND(F.lit(63)).cast("int"),
        )
        for word in range(WORDS)
    ]


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def bloom_blocks(listed: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, w0 .. w7): at most ``blocks`` rows."""
    marked = listed.select(
        _block(F.col(key), blocks).alias("block"),
        *[mask.alias(f"w{word}") for word, mask in enumerate(_masks(F.col(key)))],
    )
    return marked.groupBy("block").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(WORDS)])


def judge_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str, str]] = (),
    page_id: str = "page_id",
    url: str = "url",
    listed_url: str = "url",
    max_blocks: int = MAX_BLOCKS,
) -> DataFrame:
    """page_id, host, path, rule and verdict ("allow" or "block") of every row of ``pages``.

    ``listed`` names the URLs to block where no rule decides.
    """
    if max_blocks > MAX_BLOCKS:
        raise ValueError(f"a filter may have at most {MAX_BLOCKS} blocks, to be broadcast")
    names = settle(
        listed.select(canonical(F.col(listed_url).cast("string")).alias("listed")).dropna().distinct(),
        "listed-urls",
    )
    blocks = min(max_blocks, max(1, -(-names.count() // KEYS_PER_BLOCK)))
    bloom = bloom_blocks(names, "listed", blocks)

    given = F.col(url).cast("string")
    parts = pages.select(
        F.col(page_id).cast("long").alias("page_id"),
        F.coalesce(host_of(given), F.lit("")).alias("host"),
        F.coalesce(path_of(given), F.lit("")).alias("path"),
        canonical(given).alias("key"),
    ).withColumn("fit", fitting_rule(F.col("host"), F.col("path"), rules) if rules else F.lit(None))
    if rules:
        parts = parts.withColumn("rule", F.col("fit.rule")).withColumn("verdict", F.col("fit.verdict"))
    else:
        parts = parts.select(
            "*", F.lit(None).cast("string").alias("rule"), F.lit(None).cast("string").alias("verdict")
        )
    open_key = F.when(F.col("rule").isNull(), F.col("key"))
    hit = F.lit(True)
    for word, mask in enumerate(_masks(F.col("key"))):
        hit = hit & (F.col(f"w{word}").bitwiseAND(mask) == mask)
    tested = (
        parts.withColumn("key", open_key)
        .withColumn("block", _block(F.col("key"), blocks))
        .withColumn("block", F.when(F.col("key").isNotNull(), F.col("block")))
        .join(F.broadcast(bloom), "block", "left")
        .select(
            "page_id", "host", "path", "rule", "verdict", "key", F.coalesce(hit, F.lit(False)).alias("hit")
        )
    )
    tested = settle(tested, "tested-urls")
    out = ("page_id", "host", "path", "rule")
    missed = tested.where(~F.col("hit")).select(*out, F.coalesce("verdict", F.lit("allow")).alias("verdict"))
    checked = (
        tested.where("hit")
        .join(names, F.col("key") == F.col("listed"), "left")
        .select(*out, F.when(F.col("listed").isNotNull(), "block").otherwise("allow").alias("verdict"))
    )
    return missed.unionByName(checked)
