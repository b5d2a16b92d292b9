"""URL filter: prefix rules, and a list of canonical URLs behind a blocked Bloom filter.

All of it is DataFrame code. Each listed URL sets a few bits in one 64-bit block of the
filter; a page whose bits are not all set is not listed. What passes is joined with the list
itself, which removes false positives.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
KEYS_PER_BLOCK = 4  # 16 bits for a listed URL
BITS_PER_KEY = 5
BROADCAST_BLOCKS = 1 << 20  # 16 MB; a larger filter is joined by a shuffle of its blocks
BLOCK, ALLOW = "block", "allow"


def host_of(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end; A-Z lower-cased."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    host = F.translate(F.regexp_extract(rest, "^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(F.when(at > 0, host), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    at = F.instr(url, "://")
    rest = F.substring(url, at + 3, F.length(url))
    tail = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.coalesce(F.when(at > 0, tail), F.lit(""))


def canonical(url: Column) -> Column:
    """One spelling for the URLs of a page: host without ``www.`` and default port, path
    without closing slashes, query without ``utm_`` fields, no scheme and no fragment.

    NULL where there is no ``://``.
    """
    host = F.regexp_replace(F.regexp_replace(host_of(url), r"^www\.", ""), r":(80|443)$", "")
    path = F.regexp_replace(path_of(url), "/+$", "")
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    fields = F.filter(F.split(query, "&"), lambda x: (x != "") & ~x.startswith("utm_"))
    kept = F.array_join(F.array_sort(fields), "&")
    return F.when(
        F.instr(url, "://") > 0, F.concat(host, path, F.when(kept != "", F.concat(F.lit("?"), kept)).otherwise(""))
    )


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The longest of ``rules`` (``host/path``) that fits, else NULL."""
    fits = []
    for rule, _ in sorted(rules, key=lambda x: (-len(x[0]), x[0])):
        rule_host, _, rest = rule.partition("/")
        same = (host == rule_host) | host.endswith(f".{rule_host}")
        fits.append(F.when(same & path.startswith(f"/{rest}"), F.lit(rule)))
    return F.coalesce(*fits, F.lit(None).cast("string")) if fits else F.lit(None).cast("string")


def _bits(key: Column) -> Column:
    """The bits of a key in its block: five times six bits of a second hash."""
    seed = F.xxhash64(key, F.lit(1))
    one = F.lit(1).cast("long")
    bits = []
    for i in range(BITS_PER_KEY):
        place = F.shiftrightunsigned(seed, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        bits.append(F.call_function("shiftleft", one, place))
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def bloom(listed: DataFrame, blocks: int) -> DataFrame:
    """The filter: one row for each block that has a bit, ``block`` and ``word``."""
    return (
        listed.select(_block(F.col("key"), blocks).alias("block"), _bits(F.col("key")).alias("bits"))
        .groupBy("block")
        .agg(F.bit_or("bits").alias("word"))
    )


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks).cast("long"))


def judge(
    pages: DataFrame,
    listed: DataFrame,
    rules: Sequence[tuple[str, str]] = (),
    url: str = "url",
    keep: tuple[str, ...] = ("page_id",),
) -> DataFrame:
    """Columns ``keep``, ``host``, ``path``, ``rule``, ``listed`` and ``verdict``.

    ``listed`` has one column of URLs; NULLs, repeats and URLs without ``://`` in it do not
    matter. A page gets the verdict of the longest rule that fits, else block if its
    canonical URL is listed, else allow. A NULL page URL, or one without ``://``, has empty
    host and path, fits no rule, is not listed, and is allowed. Repeated rows stay.

    Only pages that pass the filter are shuffled for the exact join; pages of one very
    frequent URL are split there by adaptive execution.
    """
    source = pages.select(*keep, F.col(url).alias("__url"))
    names = listed.columns[0]
    keys = (
        listed.select(canonical(F.col(f"`{names}`")).alias("key")).where(F.col("key").isNotNull()).distinct()
    )
    blocks = max(1, keys.count() // KEYS_PER_BLOCK)
    words = bloom(keys, blocks)
    if blocks <= BROADCAST_BLOCKS:
        words = F.broadcast(words)
    probed = source.select(
        *keep,
        host_of(F.col("__url")).alias("host"),
        path_of(F.col("__url")).alias("path"),
        canonical(F.col("__url")).alias("__key"),
    )
    verdict_of = dict(rules)
    probed = probed.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    # Without a key the block is any: it spreads those pages if the blocks are shuffled.
    block = F.coalesce(_block(F.col("__key"), blocks), -F.xxhash64(*keep) - 1 if keep else F.lit(-1))
    probed = probed.withColumn("__block", block).join(
        words.select(F.col("block").alias("__block"), F.col("word").alias("__word")), "__block", "left"
    )
    bits = _bits(F.col("__key"))
    probed = probed.withColumn(
        "__maybe", F.coalesce(F.col("__word").bitwiseAND(bits) == bits, F.lit(False)) & F.col("__key").isNotNull()
    )
    columns = [*keep, "host", "path", "rule"]
    exact = keys.select(F.col("key").alias("__key"), F.lit(True).alias("__hit"))
    possible = (
        probed.where("__maybe")
        .join(exact.hint("shuffle_hash"), "__key", "left")
        .select(*columns, F.coalesce("__hit", F.lit(False)).alias("listed"))
    )
    found = possible.unionByName(
        probed.where(~F.col("__maybe")).select(*columns, F.lit(False).alias("listed"))
    )
    by_rule = F.lit(None).cast("string")
    for rule, verdict in verdict_of.items():
        by_rule = F.when(F.col("rule") == rule, F.lit(verdict)).otherwise(by_rule)
    return found.withColumn(
        "verdict", F.coalesce(by_rule, F.when(F.col("listed"), F.lit(BLOCK)).otherwise(F.lit(ALLOW)))
    )


#: Rules of the registered query. Fixed values of its contract.
RULES = (("net/", BLOCK), ("example.net/en/", ALLOW), ("example.com/de/", BLOCK), ("org/fr/", ALLOW))


def listed_urls(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The list of the registered query: URLs of pages whose id is labelled as toxic or of
    low quality.

    Pages that repeat an id or a URL, and NULL URLs, are listed as they are; pages without an id
    are not listed, and labels that are NULL name nothing. Without labels the list is empty.
    """
    bad = labels.where((F.col("toxic") == 1) | (F.col("quality") == 0)).select(
        F.col("doc_id").alias("page_id")
    )
    return pages.select("page_id", "url").join(bad.distinct(), "page_id", "left_semi").select("url")


def verdicts(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``judge`` with the fixed rules and the list of ``listed_urls``.

    One row per page, those with a NULL or repeated id too. A NULL or empty URL, or one without
    ``://``, has an empty host and path and is allowed. URLs of any length are read whole. An empty
    table gives no rows. Other columns are not read.
    """
    return judge(pages, listed_urls(pages, labels), RULES)


VERDICTS_SQL = r"""
WITH parts AS (
  SELECT page_id, url,
    CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) END AS rest
  FROM pages
), named AS (
  SELECT page_id, url, rest,
    translate(coalesce(regexp_extract(rest, '^[^/?#]*'), ''),
              'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') AS path,
    list_aggregate(list_sort(list_filter(
      string_split(regexp_extract(url, '^[^?#]*\?([^#]*)', 1), '&'),
      lambda x: x <> '' AND NOT starts_with(x, 'utm_'))), 'string_agg', '&') AS query
  FROM parts
), keyed AS (
  SELECT *, CASE WHEN rest IS NOT NULL THEN
      regexp_replace(regexp_replace(host, '^www\.', ''), ':(80|443)$', '')
      || regexp_replace(path, '/+$', '')
      || CASE WHEN coalesce(query, '') <> '' THEN '?' || query ELSE '' END END AS key
  FROM named
), listed AS (
  SELECT DISTINCT key FROM keyed
  WHERE key IS NOT NULL AND page_id IN (SELECT doc_id FROM labels WHERE toxic = 1 OR quality = 0)
), ruled AS (
  SELECT page_id, host, path, key,
    CASE WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/de/')
           THEN 'example.com/de/'
         WHEN (host = 'example.net' OR ends_with(host, '.example.net')) AND starts_with(path, '/en/')
           THEN 'example.net/en/'
         WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/fr/') THEN 'org/fr/'
         WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/') THEN 'net/'
    END AS rule
  FROM keyed
)
SELECT page_id, host, path, rule, l.key IS NOT NULL AS listed,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block'
       WHEN rule IN ('example.net/en/', 'org/fr/') THEN 'allow'
       WHEN l.key IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict
FROM ruled r LEFT JOIN listed l ON r.key = l.key
"""
