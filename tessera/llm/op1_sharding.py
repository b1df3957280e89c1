"""Best-fit-decreasing bin packing of indivisible groups into shards of equal bytes.

Rows of equal text form a group, which one shard takes as a whole. Groups are
counted by size; the packing works on these counts, the largest size first, and
puts as many groups of a size as fit into the bin with the tightest remaining
capacity, found in a balanced tree of the capacities. So its cost on the driver
depends on the number of different sizes (at most the root of twice the total
bytes), not on rows. A group larger than a fair share opens a bin of its own,
and the others share the rest. The smallest capacity that needs no more than
the wanted number of shards is searched for.

Groups of one size are told apart by their rank, and rows get their slots, by
counting fixed hash buckets first: no shard, size or group passes through one
task whole.

A null text has no bytes, like an empty one, and is grouped with the empty
texts. Repeated rows share a group and get slots of their own. Further columns
pass through; those named like the outputs are replaced.
"""

from __future__ import annotations

from random import Random

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, without

#: Hash buckets in which ranks and slots are counted.
BUCKETS = 4096

OUTPUTS = ("size", "text_crc32", "law", "shard", "slot", "grown_shard")


class Capacities:
    """Bins ordered by what is left in them: a treap, a binary tree balanced by random priorities.

    A node is [(left, shard), priority, lower, higher]. Finding, taking out and
    putting in cost the logarithm of the number of bins, as expected over the
    priorities, whatever the order in which bins come.
    """

    def __init__(self):
        self.root, self.draw = None, Random(0).random

    def add(self, left: int, shard: int) -> None:
        lower, higher = _split(self.root, (left, shard))
        self.root = _joined(_joined(lower, [(left, shard), self.draw(), None, None]), higher)

    def take_tightest(self, need: int) -> tuple[int, int] | None:
        """The bin with the least room of those that have ``need``, taken out; None if there is none."""
        node, found = self.root, None
        while node:
            if node[0] >= (need, -1):
                node, found = node[2], node[0]
            else:
                node = node[3]
        if found:
            lower, rest = _split(self.root, found)
            self.root = _joined(lower, _split(rest, (found[0], found[1] + 1))[1])
        return found


def _split(node: list | None, key: tuple[int, int]) -> tuple[list | None, list | None]:
    """The nodes below ``key``, and the others."""
    if node is None:
        return None, None
    if node[0] < key:
        node[3], higher = _split(node[3], key)
        return node, higher
    lower, node[2] = _split(node[2], key)
    return lower, node


def _joined(lower: list | None, higher: list | None) -> list | None:
    """One tree of two, where every bin of ``lower`` comes before those of ``higher``."""
    if not lower or not higher:
        return lower or higher
    if lower[1] > higher[1]:
        lower[3] = _joined(lower[3], higher)
        return lower
    higher[2] = _joined(lower, higher[2])
    return higher


def best_fit(counts: list[tuple[int, int]], capacity: int, most: int | None = None) -> list[tuple[int, int, int, int]] | None:
    """(size, first rank, last rank, shard) for counts of groups by size, the largest size first.

    A group larger than the capacity fills a bin of its own. None if more than
    ``most`` bins were needed.
    """
    bins, plan, opened = Capacities(), [], 0
    for size, count in counts:
        rank = 0
        while rank < count:
            found = bins.take_tightest(size)
            if found is None:
                if opened == most:
                    return None
                found, opened = (max(capacity, size), opened), opened + 1
            left, shard = found
            n = min(count - rank, left // size)
            plan.append((size, rank, rank + n - 1, shard))
            bins.add(left - n * size, shard)
            rank += n
    return plan


def equal_shards(counts: list[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int]]:
    """Best fit with the smallest capacity found that needs at most ``shards`` bins."""
    counts = sorted(counts, reverse=True)
    rest, free = sum(s * c for s, c in counts), shards
    for size, count in counts:  # groups above a fair share of the rest stand alone
        alone = 0
        while alone < count and free > 1 and size * free > rest:
            rest, free, alone = rest - size, free - 1, alone + 1
        if alone < count:
            break
    low = max(1, -(-rest // free))
    high = low
    while (plan := best_fit(counts, high, shards)) is None:
        low, high = high + 1, high + max(1, high // 64)
    while low < high:
        middle = (low + high) // 2
        tried = best_fit(counts, middle, shards)
        if tried is None:
            low = middle + 1
        else:
            high, plan = middle, tried
    return plan


def _ranked(rows: DataFrame, group: str, spread, order: list, name: str) -> DataFrame:
    """``rows`` with a gapless number from 0 in each ``group``, by buckets of ``spread`` and then ``order``."""
    rows = rows.withColumn("_bucket", F.pmod(spread, F.lit(BUCKETS)).cast("int"))
    sizes = rows.groupBy(group, "_bucket").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(group).orderBy("_bucket")) - F.col("_n")
    starts = sizes.select(F.col(group).alias("_g"), F.col("_bucket").alias("_b"), before.alias("_before"))
    inside = F.row_number().over(Window.partitionBy(group, "_bucket").orderBy(*order)) - 1
    numbered = rows.withColumn("_inside", inside).join(starts, (F.col(group) == F.col("_g")) & (F.col("_bucket") == F.col("_b")))
    return numbered.withColumn(name, (F.col("_before") + F.col("_inside")).cast("long")).drop("_bucket", "_g", "_b", "_before", "_inside")


def shard_by_bytes(docs: DataFrame, shards: int = 16, key: str = "doc_id", text: str = "text", capacity: int | None = None) -> DataFrame:
    """``docs`` without the text, with size, checksum, shard and slot; law ``bytes``.

    With a ``capacity`` as many shards of so many bytes are opened as best fit
    needs, whatever ``shards`` says. ``grown_shard`` is null: under this law one
    more shard moves rows freely.
    """
    if shards < 1:
        raise ValueError("at least one shard")
    value = F.coalesce(F.col(text), F.lit(""))
    rows = without(docs, *OUTPUTS).withColumns(
        {
            "size": (F.octet_length(value) + 1).cast("long"),
            "text_crc32": F.crc32(value.cast("binary")),
            "_text": F.unhex(F.md5(value.cast("binary"))),
            "_row": F.monotonically_increasing_id(),
        }
    )
    rows = materialize(rows.drop(text), "shard-rows")
    groups = materialize(rows.groupBy("_text").agg(F.sum("size").alias("_total")), "shard-groups")
    counts = groups.groupBy("_total").count().collect()  # one row per different size
    counts = sorted(((r["_total"], r["count"]) for r in counts), reverse=True)
    plan = best_fit(counts, capacity) if capacity else equal_shards(counts, shards)
    spark = docs.sparkSession
    ranges = spark.createDataFrame(plan, "_size long, _from long, _to long, shard int")
    ranked = _ranked(groups, "_total", F.xxhash64("_text"), ["_text"], "_rank")
    placed = ranked.join(ranges, (F.col("_total") == F.col("_size")) & F.col("_rank").between(F.col("_from"), F.col("_to")))
    # every group has one shard; a group of very many rows is a skewed join, which Spark splits
    dealt = rows.join(placed.select(F.col("_text").alias("_t"), "shard"), F.col("_text") == F.col("_t")).drop("_t")
    # rows equal in key and text would share a bucket: their place in the written rows spreads them
    twice = rows.groupBy(F.col(key).alias("_k"), F.col("_text").alias("_t")).count().where("count > 1").drop("count")
    dealt = dealt.join(twice, F.col(key).eqNullSafe(F.col("_k")) & (F.col("_text") == F.col("_t")), "left")
    dealt = dealt.withColumn("_row", F.when(F.col("_t").isNotNull(), F.col("_row"))).drop("_k", "_t")
    slots = _ranked(dealt, "shard", F.xxhash64(key, "_text", "_row"), ["_text", key, "_row"], "slot")
    return slots.drop("_text", "_row").withColumns({"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")})
