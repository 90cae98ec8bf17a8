"""Connected components of a table of links, in rounds of large-star and small-star steps.

Each round replaces links by links to the smallest neighbour, first upwards, then downwards, until every node links
to the smallest node of its component. Minima are aggregated before the shuffle, joins split skewed keys, and each round is a written
table, so a hub with very many links and the loss of an executor do no harm.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ratelens.llm.frames import written


def _digest(links: DataFrame):
    return links.agg(F.count("*"), F.bit_xor(F.xxhash64("high", "low"))).first()


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node that has a link; ``links`` has two columns of the same type, in any order.

    The root is the smallest node. Links with a null or of a node to itself do not count. No links: an empty table.
    """
    a, b = links.columns
    found = links.filter(f"`{a}` <> `{b}`").select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low")).distinct()
    found = written(found, "links")
    state = _digest(found)
    while state[0]:
        both = found.unionByName(found.select(F.col("low").alias("high"), F.col("high").alias("low")))
        least = both.groupBy("high").agg(F.min("low").alias("least")).withColumn("least", F.least("least", "high"))
        large = both.join(least, "high").filter("low > high").select(F.col("low").alias("high"), F.col("least").alias("low"))
        large = large.filter("high <> low").distinct()
        smallest = large.groupBy("high").agg(F.min("low").alias("least"))
        down = large.join(smallest, "high").select(F.col("low").alias("high"), F.col("least").alias("low")).filter("high <> low")
        found = written(down.unionByName(smallest.withColumnRenamed("least", "low")).distinct(), "links")
        before, state = state, _digest(found)
        if state == before:
            break
    roots = found.select("low").distinct()
    return found.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
        roots.select(F.col("low").alias("node"), F.col("low").alias("root"))
    )
