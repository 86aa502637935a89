"""URL filter: rules by host and path, then a list of canonical URLs behind a Bloom filter.

The filter is sized by the list, up to a bound (``bloom.MOST_BLOCKS``), and sent to all tasks. Only
URLs whose bits are all set go on to an exact join with the list, which removes the false
positives: a hash join while the filter is not full, so that the list is at most ``KEYS`` keys for
each block, and beyond that Spark's own choice, a merge join that spills. A longer list sends more
URLs to the join, but results stay exact. All of it is DataFrame code.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripledger.llm.bloom import KEYS, MOST_BLOCKS, PROBES, blocks_for, bloom, maybe_listed
from tripledger.staging import Staging

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PORTS = {"http": "80", "https": "443", "ftp": "21"}


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; else empty."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling for addresses of one page: scheme and host in lower case, no default port,
    no empty path, no fragment, no tracking parameters. Null where there is no ``://``."""
    scheme = F.lower(F.regexp_extract(url, r"(?s)^(.*?)://", 1))
    host = host_of(url)
    for name, port in PORTS.items():
        host = F.when((scheme == name) & host.endswith(f":{port}"),
                      F.regexp_replace(host, f":{port}$", "")).otherwise(host)
    path = F.when(path_of(url) == "", "/").otherwise(path_of(url))
    query = F.regexp_extract(url, r"(?s)^[^?#]*\?([^#]*)", 1)
    kept = F.array_join(F.array_sort(F.filter(
        F.split(query, "&"), lambda q: (q != "") & ~q.startswith("utm_"))), "&")
    return F.when(url.contains("://"), F.concat(
        scheme, F.lit("://"), host, path, F.when(kept == "", "").otherwise(F.concat(F.lit("?"), kept))))


def rule_for(host: Column, path: Column, rules: Iterable[tuple[str, str, str]]) -> Column:
    """The longest rule (host, path, verdict) that fits, as a struct ``rule``, ``verdict``.

    A rule fits its host and all subdomains if the path starts with its path. Of rules of equal
    length that fit, a block wins.
    """
    fits = [F.when(((host == h) | host.endswith(f".{h}")) & path.startswith(p), F.struct(
        F.lit(len(h + p)).alias("length"), F.lit(v).alias("verdict"), F.lit(h + p).alias("rule")))
        for h, p, v in rules]
    return F.array_max(F.filter(F.array(*fits), lambda r: r.isNotNull()))


def judge(pages: DataFrame, listed: DataFrame, rules: Iterable[tuple[str, str, str]], staging: Staging,
          blocks: int | None = None, probes: int = PROBES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule``, ``verdict``, ``canonical`` and ``maybe``.

    ``listed`` has a column ``url``. The longest fitting rule decides; without one, a listed
    canonical URL is blocked and any other allowed. A null or odd url has empty host and path, is
    never listed and so allowed. Repeated rows, on either side, change nothing for the others. An
    empty table of pages gives no rows. ``blocks`` fixes the filter's size.
    """
    keys = staging.put(listed.select(canonical(F.col("url")).alias("key")).where("key IS NOT NULL").distinct(), "listed")
    number = keys.count()
    blocks = blocks or blocks_for(number)
    seen = pages.select("page_id", host_of(F.col("url")).alias("host"),
                        path_of(F.col("url")).alias("path"), canonical(F.col("url")).alias("key"))
    ruled = seen.withColumn("fit", rule_for(F.col("host"), F.col("path"), list(rules)))
    open_ = maybe_listed(ruled, staging.put(bloom(keys, blocks, probes), "bloom"), blocks, probes)
    asks = F.col("maybe") & F.col("fit").isNull()
    own = keys.withColumn("hit", F.lit(True))
    if number <= KEYS * MOST_BLOCKS:
        own = own.hint("shuffle_hash")
    hits = open_.where(asks).join(own, "key", "left")
    rest = open_.where(~asks).withColumn("hit", F.lit(None).cast("boolean"))
    return rest.unionByName(hits).select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce(F.col("fit.verdict"), F.when(F.col("hit"), "block").otherwise("allow"))
        .alias("verdict"), F.col("key").alias("canonical"), "maybe")
