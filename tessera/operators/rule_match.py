"""The first rule, of a table of very many, whose text occurs in a value.

The rules' texts are compiled into Aho-Corasick automata and the values stream
through them as Arrow batches: one pass over a value's characters, however
many rules there are and however long the value is. A set of rules that fits
one automaton (``SHARD_CHARS`` characters of distinct rule texts, some 100 MB
once built) needs no shuffle at all. More rules are cut, in their order, into several
automata; each is met by its own pass over the distinct values, so a task
holds one automaton at a time, and the smallest rule of the passes wins. Above
``MAX_CHARS`` the rules no longer come to the driver: the substrings of each
distinct value, of each rule length, meet the rules in a join.

A null value meets no rule; rules without a text are ignored.
"""

from __future__ import annotations

from functools import reduce
from typing import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SHARD_CHARS = 1_000_000
MAX_CHARS = 16_000_000

_HIT = "rank long, find string, value string"


def _matcher(rules: list[tuple[int, str, str]]):
    """Pandas UDF: the smallest-ranked of ``rules`` (rank, find, value) in each text, a struct with null rank if none."""

    @F.pandas_udf(_HIT)
    def match(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        import ahocorasick

        automaton = ahocorasick.Automaton()
        for i, (_, find, _) in enumerate(rules):
            automaton.add_word(find, i)
        automaton.make_automaton()
        nothing = len(rules)
        for texts in batches:
            found = []
            for text in texts:
                best = nothing
                for _, i in automaton.iter(text) if text else ():
                    if i < best:
                        best = i
                        if not best:
                            break
                found.append(rules[best] if best < nothing else (None, None, None))
            out = pd.DataFrame(found, columns=["rank", "find", "value"])
            yield out.astype({"rank": "Int64"})

    return match


def _shards(rules: list[tuple[int, str, str]], chars: int) -> list[list[tuple[int, str, str]]]:
    """``rules``, in order, cut where a part would have more than ``chars`` characters."""
    parts, held = [[]], 0
    for r in rules:
        if parts[-1] and held + len(r[1]) > chars:
            parts.append([])
            held = 0
        parts[-1].append(r)
        held += len(r[1])
    return parts


def with_first_rule(df: DataFrame, text: Column, rules: DataFrame, hit: str = "__hit") -> DataFrame:
    """``df`` with the struct ``hit`` (find, value): the first of ``rules`` whose text occurs in ``text``, else null.

    ``rules`` has the columns ``__find``, ``__value`` (texts) and ``__order``
    (what the rules are ordered by; equal ones by find text, then value).
    """
    rules = rules.where(F.length("__find") > 0)
    # of rules with one text only the first can be the answer
    best = rules.groupBy("__find").agg(F.min(F.struct("__order", "__find", "__value")).alias("__rule"))
    if best.agg(F.coalesce(F.sum(F.length("__find")), F.lit(0))).first()[0] > MAX_CHARS:
        first = _by_substrings(df.select(text.alias("__v")), best)
        res = df.withColumn("__d", F.md5(text.cast("binary"))).join(first, "__d", "left").drop("__d")
        return res.withColumn(hit, F.when(F.col("__rule").isNotNull(), F.struct(
            F.col("__rule.__find").alias("find"), F.col("__rule.__value").alias("value")))).drop("__rule")
    rows = best.orderBy("__rule").select("__find", "__rule.__value").collect()
    shards = _shards([(i, r[0], r[1]) for i, r in enumerate(rows)], SHARD_CHARS)
    pair = F.when(F.col("__m.rank").isNotNull(), F.struct("__m.find", "__m.value"))
    if len(shards) == 1:
        if not shards[0]:
            return df.withColumn(hit, F.lit(None).cast("struct<find:string,value:string>"))
        return df.withColumn("__m", _matcher(shards[0])(text)).withColumn(hit, pair).drop("__m")
    # the passes read the distinct texts, and give back a digest and a rule for those that match
    values = df.select(text.alias("__v")).where("__v IS NOT NULL").distinct()
    values = values.select(F.md5(F.col("__v").cast("binary")).alias("__d"), "__v")
    from .window import materialize_if_costly

    values = materialize_if_costly(values)
    passes = [values.select("__d", _matcher(s)(F.col("__v")).alias("__m")).where("__m.rank IS NOT NULL") for s in shards]
    first = reduce(DataFrame.unionByName, passes).groupBy("__d").agg(F.min("__m").alias("__m"))
    res = df.withColumn("__d", F.md5(text.cast("binary"))).join(first, "__d", "left")
    return res.withColumn(hit, pair).drop("__d", "__m")


def _by_substrings(texts: DataFrame, rules: DataFrame) -> DataFrame:
    """(``__d``, ``__rule``): by the digest of each text ``__v``, the smallest ``__rule`` whose ``__find`` occurs in it."""
    lengths = [r[0] for r in rules.select(F.length("__find")).distinct().collect()]  # at most the longest rule
    values = texts.where("__v IS NOT NULL").distinct()
    grams = values.select(F.md5(F.col("__v").cast("binary")).alias("__d"), substrings(F.col("__v"), lengths).alias("__find")).distinct()
    return grams.join(rules, "__find").groupBy("__d").agg(F.min("__rule").alias("__rule"))


def substrings(text: Column, lengths: list[int]) -> Column:
    """Generator: every substring of ``text`` whose length is in ``lengths``.

    Used to turn "rule text occurs in value" into an equi-join on the
    substring, which is exact for any number of rules.
    """

    def grams_of(n: int) -> Column:
        # Spark reads a 2-argument lambda as (x, index): keep it 1-argument
        starts = F.sequence(F.lit(1), F.greatest(F.length(text) - F.lit(n - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.substr(text, i, F.lit(n)))

    return F.explode(F.flatten(F.array(*[grams_of(n) for n in lengths])))
