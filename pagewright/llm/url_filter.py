"""URL filters: a blocked Bloom filter of listed canonical URLs in front of an exact hash join.

Everything here is DataFrame expressions. The filter has 256-bit blocks of four 64-bit words; a URL
picks one block and sets one bit in each word. Blocks are rows, so the filter is built by ``bit_or``
with partial aggregation, and probing is a join on the block number. Only URLs whose four bits are
all set reach the exact join, a hash join at any size of the list: broadcast, or shuffled with the
list's distinct keys as the side that is built. A URL that many rows share is a hot key of the other
side alone, whose partitions adaptive execution may split.

Defined results: a null URL, or one without ``://``, has an empty host and path, has no canonical
form and is never listed. Null rows of the list are dropped, repeated rows of either side change
nothing else (each input row gives one output row). An empty list blocks nothing. Input columns
beyond ``url`` pass through under any name; the five columns that the operator adds replace input
columns of their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagewright.llm.common import BROADCAST_BYTES, ascii_lower, broadcast_if, free_name, materialize

#: Scheme, then host (group 1) and path (group 2).
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Up to this many rules are one expression; more are a table, joined by host.
INLINE_RULES = 100


@dataclass(frozen=True)
class Rule:
    """Allow or block a host with its subdomains, for paths that start with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path

    def fits(self, host: Column, path: Column) -> Column:
        return ((host == self.host) | host.endswith("." + self.host)) & path.startswith(self.path)


def host_of(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, PARTS, 1)), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def canonical(host: Column, path: Column) -> Column:
    """Host without ``www.`` and default port, path without trailing slashes; null for an empty host.

    Scheme, query and fragment are not part of it.
    """
    site = F.regexp_replace(F.regexp_replace(host, r"^www\.", ""), r":(80|443)$", "")
    return F.when(host != "", F.concat(site, F.regexp_replace(path, r"/+$", "")))


def _block(key: Column, n_blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(n_blocks))


def _mask(key: Column, word: int) -> Column:
    bit = F.shiftrightunsigned(F.xxhash64(key, F.lit("bloom")), 6 * word).bitwiseAND(F.lit(63)).cast("int")
    return F.call_function("shiftleft", F.expr("1L"), bit)


def bloom_blocks(listed: DataFrame, n_blocks: int) -> DataFrame:
    """(block, w0..w3) of the non-empty blocks, from a column ``url_key``."""
    key = F.col("url_key")
    return (
        listed.select(_block(key, n_blocks).alias("block"), *[_mask(key, j).alias(f"w{j}") for j in range(4)])
        .groupBy("block")
        .agg(*[F.bit_or(f"w{j}").alias(f"w{j}") for j in range(4)])
    )


def _by_expression(host: Column, path: Column, ordered: list[Rule]) -> tuple[Column, Column]:
    """Text and verdict of the first of the ``ordered`` rules that fits, as expressions."""
    which, what = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in reversed(ordered):
        fits = rule.fits(host, path)
        which, what = F.when(fits, F.lit(rule.text)).otherwise(which), F.when(fits, F.lit(rule.verdict)).otherwise(what)
    return which, what


def _rules_of_hosts(hosts: DataFrame, ordered: list[Rule]) -> DataFrame:
    """(host, rules): for each distinct host the rules of it and of what it is a subdomain of, in their order."""
    spark, parts = hosts.sparkSession, F.split("host", r"\.", -1)
    ends = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    table = spark.createDataFrame([(r.host, i, r.path, r.text, r.verdict) for i, r in enumerate(ordered)], "end string, place int, path string, text string, verdict string")
    table = broadcast_if(table, sum(len(r.text.encode()) * 2 + 48 for r in ordered))
    found = hosts.distinct().select("host", F.explode(ends).alias("end")).join(table, "end")
    return found.groupBy("host").agg(F.array_sort(F.collect_list(F.struct("place", "path", "text", "verdict"))).alias("rules"))


def with_rules(rows: DataFrame, ordered: list[Rule], names: dict[str, str], broadcast_bytes: int, inline: int) -> DataFrame:
    """``rows`` with the text and the verdict of the first rule that fits."""
    if len(ordered) <= inline:
        which, what = _by_expression(F.col("host"), F.col("path"), ordered)
        return rows.withColumns({"rule": which, names["what"]: what})
    of_hosts = materialize(rows.sparkSession, _rules_of_hosts(rows.select("host"), ordered), "url-rules")
    size = F.octet_length("host") + F.aggregate("rules", F.lit(0), lambda n, r: n + F.octet_length(r["path"]) + F.octet_length(r["text"]) + 48)
    n_bytes = of_hosts.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    joined = rows.join(broadcast_if(of_hosts.withColumnRenamed("rules", names["rules"]), n_bytes, broadcast_bytes), "host", "left")
    first = F.get(F.filter(names["rules"], lambda r: F.col("path").startswith(r["path"])), F.lit(0))
    return joined.withColumn(names["first"], first).withColumns({"rule": F.col(names["first"])["text"], names["what"]: F.col(names["first"])["verdict"]})


def filter_urls(
    pages: DataFrame,
    listed: DataFrame,
    rules: list[Rule] | tuple[Rule, ...] = (),
    bits_per_url: int = 16,
    broadcast_bytes: int = BROADCAST_BYTES,
    inline_rules: int = INLINE_RULES,
) -> DataFrame:
    """``pages`` with host, path, rule (text or null), listed (boolean) and verdict (allow or block).

    ``listed`` has a column ``url_key`` of canonical URLs (see :func:`canonical`). The longest rule that
    fits decides (ties: the longer host); without one, listed URLs are blocked. Filter and list are
    broadcast only when their measured sizes are within ``broadcast_bytes``; beyond it both joins
    shuffle, and only possible hits take part in the exact one: pages are then read twice, so that rows
    that the filter clears are not shuffled. The list is written once.
    """
    ordered = sorted(rules, key=lambda r: (-len(r.text), -len(r.host), r.verdict))
    keys = materialize(pages.sparkSession, listed.select("url_key").where("url_key is not null").distinct(), "url-list")
    n, n_bytes = keys.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("url_key") + 32), F.lit(0))).first()
    n_blocks = max(1, -(-n * bits_per_url // 256))

    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "listed", "verdict")]
    own = {x: free_name(f"__{x}", kept) for x in ("what", "rules", "first", "key", "block", "may", "hit", "w0", "w1", "w2", "w3")}
    rows = pages.select(*kept, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = with_rules(rows, ordered, own, broadcast_bytes, inline_rules)
    key, words = F.col(own["key"]), [own[f"w{j}"] for j in range(4)]
    rows = rows.withColumn(own["key"], canonical(F.col("host"), F.col("path")))

    blocks = bloom_blocks(keys, n_blocks).withColumnsRenamed({"block": own["block"], **{f"w{j}": own[f"w{j}"] for j in range(4)}})
    probe = lambda some: some.withColumn(own["block"], F.when(key.isNotNull(), _block(key, n_blocks))).join(broadcast_if(blocks, n_blocks * 64, broadcast_bytes), own["block"], "left")
    if n_blocks * 64 <= broadcast_bytes:
        probed = probe(rows)
    else:  # rows without a key would all meet in one task
        probed = probe(rows.where(key.isNotNull())).unionByName(rows.where(key.isNull()), allowMissingColumns=True)
    may = F.coalesce(F.col(words[0]).isNotNull(), F.lit(False))
    for j in range(4):
        may = may & F.coalesce(F.col(words[j]).bitwiseAND(_mask(key, j)) != 0, F.lit(False))
    probed = probed.withColumn(own["may"], may)
    exact = keys.select(F.col("url_key").alias(own["key"]), F.lit(True).alias(own["hit"]))
    if n_bytes <= broadcast_bytes:
        judged = probed.join(F.broadcast(exact.withColumn(own["may"], F.lit(True))), [own["key"], own["may"]], "left")
    else:
        hits = probed.where(own["may"]).join(exact.hint("shuffle_hash"), own["key"], "left")
        judged = probed.where(f"not `{own['may']}`").withColumn(own["hit"], F.lit(None).cast("boolean")).unionByName(hits)
    in_list = F.coalesce(F.col(own["hit"]), F.lit(False))
    return judged.select(
        *kept, "host", "path", "rule", in_list.alias("listed"),
        F.coalesce(own["what"], F.when(in_list, "block").otherwise("allow")).alias("verdict"),
    )
