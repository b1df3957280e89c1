"""Importance resampling towards a target: array-scored weights and a distributed radix sort.

1. *Weights.* Every run of 1 to ``runs`` consecutive words is a feature; its
   crc32 names a bucket. Both tables are counted by bucket (one array a task,
   summed by Spark). A bucket's gain is the floor of 1000 times the log of how
   much likelier it is in the target than in the documents, smoothed by one. A
   document's weight is the sum of the gains of its features: one array look-up.
2. *Scores.* The weight plus Gumbel noise from a hash of the key, so that the
   highest scores are a sample without replacement in proportion to the weights.
3. *Ranks.* Scores (descending) and keys (ascending) form one composite key. It
   is sorted by stable counting-sort passes, the least significant digit first.
   A pass counts (digit, block of positions); prefix sums over digits, and over
   the blocks of a digit, give each (block, digit) its first destination; a row
   goes to that plus its number within them. Destinations are positions of the
   next pass; after the last they are the ranks. Leading bits that all keys
   share need no pass.

The only things that meet in one place are the buckets (their number is a
parameter) and a digit's counts (one for each block).

Null and empty texts have no words and a weight of 0. A null key is hashed as
empty text and comes before all others on ties. Rows that agree in score and
key are ranked in the order of the scored table. Further columns pass through;
those named like the outputs are replaced. Keys must be integers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import chunks, materialize, without
from tessera.llm.op3_decontaminate import WORD_BYTES

#: Bits of a digit: a pass has 2 ** DIGIT counts a block at most.
DIGIT = 12
#: Rows of a block of positions at most, and blocks for each shuffle partition at least.
BLOCK_ROWS, BLOCKS_EACH = 1 << 18, 4
#: Bytes of a long text that are split into words at once.
PIECE = 4 << 20

OUTPUTS = ("n_words", "n_features", "weight", "score", "rank")


class _Numbers(dict):
    """Numbers words in the order in which they first come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _pieces(low: bytes, size: int) -> Iterator[bytes]:
    """A cleaned text in pieces of about ``size`` bytes, cut between words."""
    at = 0
    while len(low) - at > size:
        cut = low.find(b" ", at + size)
        if cut < 0:
            break
        yield low[at:cut]
        at = cut
    yield low[at:]


def features(data: np.ndarray, at: np.ndarray, runs: int, buckets: int, piece: int = PIECE) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(words by text, text of each feature, bucket of each feature) of the texts of a buffer, in parts."""
    low, n = data.tobytes().translate(WORD_BYTES), len(at) - 1

    def part(words: list[bytes], row: np.ndarray, fresh: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        # the first words, up to `fresh`, belong to the part before: only runs that reach beyond them count
        vocabulary = _Numbers()
        ids = np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words))
        crc = np.fromiter(map(zlib.crc32, vocabulary), np.int64, len(vocabulary))[ids]
        owners, found = [row[fresh:]], [crc[fresh:]]
        for k in range(2, runs + 1):
            crc = np.fromiter((zlib.crc32(b" " + w, c) for w, c in zip(words[k - 1 :], crc.tolist())), np.int64, max(0, len(words) - k + 1))
            inside = row[k - 1 :] == row[: max(0, len(row) - k + 1)]
            inside[: max(0, fresh - k + 1)] = False
            owners.append(row[k - 1 :][inside])
            found.append(crc[inside])
        return np.bincount(row[fresh:], minlength=n), np.concatenate(owners), np.concatenate(found) % buckets

    if len(low) <= piece:
        words, sizes = [], []
        for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
            mine = low[a:b].split()
            words += mine
            sizes.append(len(mine))
        yield part(words, np.repeat(np.arange(n), sizes), 0)
        return
    for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
        before: list[bytes] = []
        for raw in _pieces(low[a:b], piece):
            words = before + raw.split()
            yield part(words, np.full(len(words), i), len(before))
            before = words[len(words) - runs + 1 :] if runs > 1 else []


def bucket_counts(docs: DataFrame, text: str, runs: int, buckets: int) -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for _, data, at in chunks(batches, "text", 1 << 20):
            for _, _, bucket in features(data, at, runs, buckets):
                total += np.bincount(bucket, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen), pa.array(total[seen])], names=["bucket", "n"])

    sums = docs.select(F.col(text).alias("text")).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()  # a row a bucket
    out = np.zeros(buckets, np.int64)
    out[sums["bucket"].to_numpy(np.int64)] = sums["n"].to_numpy(np.int64)
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """By bucket, the floor of 1000 times the smoothed log ratio of target to source."""
    m = float(len(source))
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + m) / ((s + 1) * (t.sum() + m)))).astype(np.int64)


def scored(docs: DataFrame, gain: np.ndarray, key: str, text: str, runs: int, seed: int, keep_text: bool) -> DataFrame:
    """``docs`` with n_words, n_features, weight and score."""
    shared = docs.sparkSession.sparkContext.broadcast(gain)  # a number a bucket
    plain = [f for f in docs.schema if keep_text or f.name != text]
    schema = T.StructType(plain + [T.StructField(c, T.LongType()) for c in OUTPUTS[:3]])

    def weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for part, data, at in chunks(batches, text, 1 << 20):
            n = len(at) - 1
            words, size, weight = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, np.int64)
            for w, row, bucket in features(data, at, runs, len(shared.value)):
                words += w
                size += np.bincount(row, minlength=n)
                weight += np.bincount(row, shared.value[bucket], n).astype(np.int64)  # whole numbers below 2 ** 53
            values = [part.column(f.name) for f in plain] + [pa.array(x) for x in (words, size, weight)]
            yield pa.RecordBatch.from_arrays([v.cast(f.type) for v, f in zip(values, out)], schema=out)

    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))).cast("binary"), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("double")
    noise = F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0))).cast("long")
    return docs.mapInArrow(weigh, schema).withColumn("score", F.col("weight") + noise)


def _passes(parts: list[tuple[str, int]], width: int) -> list[list[tuple[str, int, int, int]]]:
    """Digits of the composite key, the least significant first: pieces (part, its first bit, bits, first bit in the digit)."""
    out: list[list[tuple[str, int, int, int]]] = [[]]
    used = 0
    for name, bits in parts:
        shift = 0
        while shift < bits:
            if used == width:
                out.append([])
                used = 0
            take = min(bits - shift, width - used)
            out[-1].append((name, shift, take, used))
            used, shift = used + take, shift + take
    return out


def _digit(pieces: list[tuple[str, int, int, int]]) -> Column:
    digit = F.lit(0).cast("long")
    for name, shift, take, at in pieces:
        bits = F.shiftrightunsigned(F.col(name), shift).bitwiseAND(F.lit((1 << take) - 1))
        digit = digit.bitwiseOR(F.shiftleft(bits, at))
    return digit


def radix_ranks(rows: DataFrame, parts: list[str], digit_bits: int = DIGIT, block_rows: int | None = None) -> DataFrame:
    """(pos, rank) of ``rows``: rank counts from 1 in the order of ``parts``, the most significant first.

    ``rows`` holds ``pos`` (long, of its own for each row, the order of equals)
    and the parts, longs read as unsigned numbers; it must give the same rows
    whenever it is read (a written table).
    """
    spark = rows.sparkSession
    edge = rows.agg(F.count("*").alias("n"), *[f(F.col(p).bitwiseXOR(F.lit(-(1 << 63)))).alias(f"{p}{s}") for p in parts for f, s in ((F.min, 0), (F.max, 1))]).first()
    # the bits above the highest in which the least and the greatest differ are the same in all
    used = [(p, ((edge[f"{p}0"] ^ edge[f"{p}1"]) & (1 << 64) - 1).bit_length()) for p in reversed(parts) if edge["n"]]
    wanted = -(-edge["n"] // (BLOCKS_EACH * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    size = block_rows or min(BLOCK_ROWS, max(64, wanted))
    state = rows.select(F.col("pos").alias("row"), "pos", *parts)
    for pieces in _passes(used, digit_bits):
        here = state.withColumns({"digit": _digit(pieces), "block": F.expr(f"pos div {size}")})
        counts = materialize(here.groupBy("digit", "block").agg(F.count("*").alias("n")), "radix-counts")
        totals = counts.groupBy("digit").agg(F.sum("n").alias("all"))  # a row a digit value
        first = F.coalesce(F.sum("all").over(Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        before = F.coalesce(F.sum("n").over(Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        starts = F.broadcast(totals.select("digit", first.alias("first")))  # 2 ** digit_bits rows at most
        offsets = counts.select("digit", "block", before.alias("before")).join(starts, "digit").select("digit", "block", (F.col("first") + F.col("before")).alias("to"))
        nth = F.row_number().over(Window.partitionBy("block", "digit").orderBy("pos"))
        moved = here.join(offsets, ["block", "digit"]).select("row", (F.col("to") + nth - 1).alias("pos"), *parts)
        state = materialize(moved, "radix-pass")
    return state.select(F.col("row").alias("pos"), (F.col("pos") + 1).alias("rank"))


def ranked(
    docs: DataFrame, target: DataFrame, key: str = "doc_id", text: str = "text", target_text: str = "text",
    runs: int = 1, buckets: int = 10000, seed: int = 2024, min_words: int = 20, percent: int = 10, keep_text: bool = False,
) -> DataFrame:
    """``docs`` (without the text unless asked for) with n_words, n_features, weight, score and rank.

    Of the rows with ``min_words`` words, ``percent`` % (rounded down) have a
    rank, the highest scores, ties to the smaller key; it is null for the rest.
    """
    if not isinstance(docs.schema[key].dataType, T.IntegralType):
        raise ValueError(f"the key {key} must be an integer")
    docs = without(docs, *OUTPUTS)
    gain = gains(bucket_counts(docs, text, runs, buckets), bucket_counts(target, target_text, runs, buckets))
    rows = scored(docs, gain, key, text, runs, seed, keep_text).withColumn("_pos", F.monotonically_increasing_id())
    rows = materialize(rows, "scored")
    able = rows.where(F.col("n_words") >= min_words)
    edge = able.agg(F.count("*").alias("n"), F.max("score").alias("top")).first()
    lowest, top = F.lit(-(1 << 63)), F.lit(edge["top"]).cast("long")
    eligible = able.select(
        F.col("_pos").alias("pos"),
        (top - F.col("score")).alias("down"),
        F.col(key).isNotNull().cast("long").alias("there"),
        F.coalesce(F.col(key).cast("long").bitwiseXOR(lowest), F.lit(0)).alias("up"),
    )
    drawn = percent * edge["n"] // 100
    ranks = radix_ranks(eligible, ["down", "there", "up"]).where(F.col("rank") <= drawn).withColumnRenamed("pos", "_at")
    return rows.join(ranks, F.col("_pos") == F.col("_at"), "left").drop("_pos", "_at")


def draw(docs: DataFrame, target: DataFrame, **options) -> DataFrame:
    """The drawn rows of ``docs``, texts included, with their scores and ranks."""
    return ranked(docs, target, **options, keep_text=True).where("rank IS NOT NULL")
