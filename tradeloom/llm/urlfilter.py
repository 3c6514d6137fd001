"""Judge URLs by a list of canonical prefixes: a blocked Bloom filter, then an exact join.

Each listed prefix sets a few bits inside one block of the filter, so a probe looks at one row. Keys that
the filter passes go to an exact join, which removes its false positives. The filter grows with the list: up to
MAX_BLOCKS it is broadcast, beyond that it meets the keys by block.

A url is looked up by its host first. Only the host's own suffixes that are listed make keys, and only of the path
lengths listed for them. Keys are counted before they are probed, so a common host or prefix is probed once, and what is
found of it goes back to its urls by a join that spreads it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeloom.llm.frames import all_of, ascii_lower, fresh_name, keep
from tradeloom.operators.skew import join_group_stats

BLOCK_WORDS = 8  # 512 bits
BITS_PER_KEY = 16
PROBES = 6  # bits that a key sets in its block
MAX_BLOCKS = 1 << 16  # 4 MB, the bound of what is broadcast


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host in lower case and path without query or fragment; both empty for null or without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3)))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + F.lit(1)), "^[^?#]*", 0)
    return ascii_lower(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def listed(rules: DataFrame) -> DataFrame:
    """(key, rule, verdict, host_length) of a list with columns ``rule`` (host and path prefix) and ``verdict``.

    A rule given twice with two verdicts blocks; null rules and rules without a host are none.
    """
    host = ascii_lower(F.regexp_extract("rule", "^[^/]*", 0))
    return (
        rules.where(F.col("rule").isNotNull() & (host != ""))
        .groupBy("rule").agg(F.max("verdict").alias("verdict"))
        .select(F.concat(host, F.substr("rule", F.char_length(host) + F.lit(1))).alias("key"), "rule", "verdict",
                F.char_length(host).alias("host_length"))
    )


def _block(key: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(blocks))


def _bits(key: Column) -> list[Column]:
    """The bits of a key inside its block, 0 to 511."""
    mixed = F.xxhash64(key, F.lit("within the block"))
    return [F.shiftrightunsigned(mixed, 9 * i).bitwiseAND(F.lit(64 * BLOCK_WORDS - 1)).cast("int") for i in range(PROBES)]


def _mask(bit: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)))


def _word(bit: Column) -> Column:
    return F.floor(bit / 64).cast("int")


def blocked_bloom(keys: DataFrame, column: str, blocks: int) -> DataFrame:
    """The filter as rows (block, w0 to w7), at most ``blocks`` of them; blocks without a bit have no row."""
    bits = keys.select(_block(F.col(column), blocks).alias("block"), F.explode(F.array(*_bits(F.col(column)))).alias("bit"))
    return bits.groupBy("block").agg(*[
        F.bit_or(F.when(_word(F.col("bit")) == w, _mask(F.col("bit"))).otherwise(F.lit(0).cast("long"))).alias(f"w{w}")
        for w in range(BLOCK_WORDS)
    ])


def possible_hits(keys: DataFrame, column: str, bloom: DataFrame, blocks: int) -> DataFrame:
    """The rows of ``keys`` whose key may be in the filter, with columns as before."""
    words = F.array(*[F.col(f"w{w}") for w in range(BLOCK_WORDS)])
    set_there = [F.get(words, _word(bit)).bitwiseAND(_mask(bit)) != 0 for bit in _bits(F.col(column))]
    probed = keys.join(F.broadcast(bloom) if blocks <= MAX_BLOCKS else bloom, _block(F.col(column), blocks) == F.col("block"))
    return probed.where(all_of(set_there)).select(*keys.columns)


def blocks_for(keys: int) -> int:
    return keys * BITS_PER_KEY // (64 * BLOCK_WORDS) + 1


def host_tails(host: Column, labels: int) -> Column:
    """Every suffix of a host of at most ``labels`` labels; null for an empty host."""
    parts = F.split(host, r"\.")
    tails = F.transform(
        F.sequence(F.greatest(F.lit(1), F.size(parts) - F.lit(labels - 1)), F.size(parts)),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    return F.when(host != "", tails)


def looked_up(rows: DataFrame, key: str, listed: DataFrame, count: int) -> DataFrame:
    """``rows`` with the columns of ``listed``, which has one row for each of its ``count`` keys, where their key is one.

    The distinct keys of the rows, with their numbers, pass the filter and the exact join; those that are left are the
    groups of a join that spreads what is frequent.
    """
    numbers = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"))
    blocks = blocks_for(count)
    found = possible_hits(numbers, key, blocked_bloom(listed, key, blocks), blocks).join(listed, key)
    return join_group_stats(rows, found, [key], "_rows").drop("_rows")


def judge(pages: DataFrame, url: str, rules: DataFrame, otherwise: str = "allow") -> DataFrame:
    """All columns of ``pages`` with host, path, the longest rule that fits its ``url`` and the verdict.

    A rule fits its host and all its subdomains where the path starts with the rule's path. Of rules equally
    long the one with the longer host wins. A row without a fitting rule has a null rule and the verdict
    ``otherwise``; so has a url that is null, empty or without ``://``. Repeated rows stay repeated: each
    distinct url is judged once and the verdicts are joined back, so a very common url is no heavy key but in
    that last join, where adaptive execution splits it. Columns of ``pages`` named host, path, rule or verdict
    are replaced. No rules, or no pages, is no special case.
    """
    rules = keep(listed(rules))
    rule_host = F.substr("key", F.lit(1), F.col("host_length"))
    hosts = keep(rules.groupBy(rule_host.alias("tail")).agg(
        F.collect_set(F.char_length("key") - F.col("host_length")).alias("lengths"), F.count(F.lit(1)).alias("n")))
    shape = hosts.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rules"), F.count(F.lit(1)).alias("hosts"),
        F.max(F.size(F.split("tail", r"\."))).alias("labels")).first()

    wanted = fresh_name(pages, "_url")
    urls = pages.select(F.col(url).alias(wanted)).where(F.col(wanted).isNotNull()).distinct()
    host, path = host_and_path(F.col(wanted))
    tails = urls.select(wanted, path.alias("rest"), F.explode(host_tails(host, shape["labels"] or 1)).alias("tail"))
    own = looked_up(tails, "tail", hosts.drop("n"), shape["hosts"])
    heads = F.transform(F.filter("lengths", lambda n: n <= F.char_length("rest")), lambda n: F.substr("rest", F.lit(1), n))
    keys = own.select(wanted, "tail", F.explode(heads).alias("head")).select(wanted, F.concat("tail", "head").alias("key"))
    hits = looked_up(keys, "key", rules, shape["rules"])
    best = F.struct(F.char_length("key").alias("length"), "host_length", "rule", "verdict")
    verdicts = hits.groupBy(wanted).agg(F.max(best).alias("best"))

    won = fresh_name(pages, "_won")
    host, path = host_and_path(F.col(url))
    judged = pages.join(verdicts.withColumnRenamed("best", won), F.col(url) == F.col(wanted), "left")
    return judged.withColumns({
        "host": host, "path": path, "rule": F.col(f"{won}.rule"),
        "verdict": F.coalesce(F.col(f"{won}.verdict"), F.lit(otherwise)),
    }).drop(wanted, won)
