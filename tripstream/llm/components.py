"""Connected components of a table of links, by alternating large and small stars.

Every step is one group-by (partially aggregated before the shuffle, so a
node with very many links is cheap) and one join; the links between steps are
written to the shared folder. No link or component reaches the driver: a step
is compared with the one before by a count and a checksum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripstream.llm.common import few_parts, small, written


def _print(links: DataFrame) -> tuple:
    return tuple(links.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")),
                           F.sum(F.xxhash64("b", "a").bitwiseAND(F.lit(0xFFFFFFFF)))).first())


def connected(links: DataFrame) -> DataFrame:
    """``a, b``: for each node of the links (columns a, b: numbers) that is not
    the smallest of its component, that smallest node."""
    at = written(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .where("a > b").distinct(), "links")
    seen = _print(at)
    while seen[0]:
        few = small(at)
        both = at.unionByName(at.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = few_parts(both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")), 2 * seen[0])
        large = both.join(few(low), "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        # a link gives one link at most, in either step
        large = few_parts(large, seen[0])
        low = few_parts(large.groupBy("a").agg(F.min("b").alias("m")), seen[0])
        inner = large.join(few(low), "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        at = written(low.select("a", F.col("m").alias("b")).unionByName(inner).distinct(), "links", seen[0])
        now = _print(at)
        if now == seen:
            break
        seen = now
    return at
