"""Benchmark decontamination with a generalised suffix automaton over item words.

The items' words become one automaton (its size is checked; larger benchmarks
are cut into shards, one pass each). Documents stream through it inside Spark's
tasks: after each word the automaton holds the longest match that ends there,
which yields every occurrence of a window of ``window`` consecutive item words
(a shorter item is one window).

Null and empty texts have no words and no hits; items without words match
nothing; repeated items or documents each keep their rows. An item's id is read
as text (null: ``null``). Further columns pass through; columns named like the
outputs are replaced.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import chunks, materialize, without

#: Item bytes of one automaton; beyond them the items are cut into shards.
SHARD_BYTES = 2 << 20

#: Lower-cases A-Z; digits, a-z and all bytes of non-ASCII characters are word bytes.
WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))

SPAN = T.StructType([T.StructField(c, T.IntegerType(), False) for c in ("first_word", "last_word", "start_byte", "end_byte")])
ADDED = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("longest_match", T.IntegerType()),
        T.StructField("hit_items", T.ArrayType(T.StringType())),
        T.StructField("hit_spans", T.ArrayType(SPAN)),
    ]
)


class ItemAutomaton:
    """Suffix automaton of word sequences with, by state, the items of its windows."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        marks: list[set[str]] = [set()]
        whole: list[tuple[int, int, str]] = []
        pairs = set()
        for name, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            pairs.update(zip(ids, ids[1:]))
            last = 0
            for c in ids:
                last = self._extend(last, c)
                while len(marks) < len(self.next):
                    marks.append(set())
                marks[last].add(name)
            if 0 < len(ids) < window:
                whole.append((last, len(ids), name))
        self.shortest = min([window, *(n for _, n, _ in whole)])
        self.pairs = np.array(sorted((a << 32) | b for a, b in pairs), np.int64)
        upwards = sorted(range(1, len(self.next)), key=self.length.__getitem__, reverse=True)
        for v in upwards:
            # windows longer than the link's strings need the marks of what extends them
            if self.link[v] > 0 and self.length[self.link[v]] >= self.shortest:
                marks[self.link[v]] |= marks[v]
        short: list[tuple[tuple[int, str], ...]] = [()] * len(self.next)
        for state, n, name in whole:
            short[state] += ((n, name),)
        self.window_items: list[frozenset[str] | None] = [None] * len(self.next)
        self.short: list[tuple[tuple[int, str], ...]] = short
        for v in reversed(upwards):
            up = self.link[v]
            if self.length[v] >= window:
                self.window_items[v] = self.window_items[up] if self.length[up] >= window else frozenset(marks[v])
            if up > 0:
                self.short[v] = self.short[up] + self.short[v]

    def _extend(self, last: int, c: int) -> int:
        known = self.next[last].get(c)
        if known is not None:
            return known if self.length[known] == self.length[last] + 1 else self._clone(last, c, known)
        new = len(self.next)
        self.next.append({})
        self.length.append(self.length[last] + 1)
        self.link.append(0)
        p = last
        while p >= 0 and c not in self.next[p]:
            self.next[p][c] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][c]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._clone(p, c, q)
        return new

    def _clone(self, p: int, c: int, q: int) -> int:
        copy = len(self.next)
        self.next.append(dict(self.next[q]))
        self.length.append(self.length[p] + 1)
        self.link.append(self.link[q])
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def runs(self, ids: np.ndarray) -> list[tuple[int, int]]:
        """Stretches outside which no match of ``shortest`` words can lie."""
        if self.shortest == 1:
            good = ids > 0
            need = 1
        else:
            code = (ids[:-1].astype(np.int64) << 32) | ids[1:]
            known = np.flatnonzero((ids[:-1] > 0) & (ids[1:] > 0))
            place = np.searchsorted(self.pairs, code[known])
            place[place == len(self.pairs)] = 0
            good = np.zeros(max(0, len(ids) - 1), bool)
            good[known] = self.pairs[place] == code[known] if len(self.pairs) else False
            need = self.shortest - 1
        edge = np.flatnonzero(np.diff(np.concatenate([[False], good, [False]]).astype(np.int8)))
        starts, stops = edge[::2], edge[1::2]
        long = stops - starts >= need
        return list(zip(starts[long].tolist(), (stops[long] + (self.shortest > 1)).tolist()))

    def stream(self, ids: list[int], window: int) -> Iterator[tuple[int, int, int, tuple[str, ...]]]:
        """(end position, words hit, longest match, items) wherever a window ends."""
        step, link, length = self.next, self.link, self.length
        state = size = 0
        for i, c in enumerate(ids):
            to = step[state].get(c)
            while to is None and state:
                state = link[state]
                size = length[state]
                to = step[state].get(c)
            if to is None:
                size = 0
                continue
            state, size = to, size + 1
            if size < self.shortest:
                continue
            # a state holds several lengths: only those up to `size` end here
            v = state
            while length[link[v]] >= size:
                v = link[v]
            reach, found = 0, ()
            if size >= window:
                reach, found = window, tuple(self.window_items[v] or ())
            if self.short[v]:
                fit = [(n, name) for n, name in self.short[v] if n <= size]
                if fit:
                    reach, found = max(reach, max(n for n, _ in fit)), found + tuple(name for _, name in fit)
            if reach:
                yield i, reach, size, found


def automata(items: DataFrame, window: int, item_id: str, item_text: str, shard_bytes: int) -> Iterator[ItemAutomaton]:
    """One automaton for each shard of the items, none larger than the bound allows."""
    rows = items.select(F.coalesce(F.col(item_id).cast("string"), F.lit("null")).alias("id"), F.coalesce(F.col(item_text), F.lit("")).alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // shard_bytes) or 1
    for k in range(n):
        mine = rows.where(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == k).toLocalIterator()
        yield ItemAutomaton([(r["id"], r["text"].encode().translate(WORD_BYTES).split()) for r in mine], window)


def mark(
    docs: DataFrame,
    items: DataFrame,
    window: int = 10,
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    keep_text: bool = True,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """``docs`` with word counts, hit words, longest match, hit items and hit spans (words and bytes)."""
    made = without(docs, *ADDED.names)
    previous = None
    for automaton in automata(items, window, item_id, item_text, shard_bytes):
        if previous is not None:
            made = materialize(made, "decontaminate")
        previous = made = _pass(made, automaton, window, text)
    return made if keep_text else made.drop(text)


def _pass(docs: DataFrame, automaton: ItemAutomaton, window: int, text: str) -> DataFrame:
    shared = docs.sparkSession.sparkContext.broadcast(automaton)
    plain = [f for f in docs.schema if f.name not in ADDED.names]
    again = len(plain) < len(docs.columns)
    schema = T.StructType(plain + ADDED.fields)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        known, out = shared.value, to_arrow_schema(schema)
        get = known.vocabulary.get
        word = re.compile(rb"[^ ]+")
        for part, data, at in chunks(batches, text, 1 << 20):
            low = data.tobytes().translate(WORD_BYTES)
            ends, ids = [0], [0]
            for lo, hi in zip(at[:-1].tolist(), at[1:].tolist()):
                ids.extend([get(w, 0) for w in low[lo:hi].split()])
                ids.append(0)  # no match crosses documents
                ends.append(len(ids) - 1)
            ends = np.array(ends, np.int64)
            n_words = np.diff(ends) - 1
            hits: dict[int, list] = {}
            for lo, hi in known.runs(np.array(ids, np.int64)):
                for i, reach, size, names in known.stream(ids[lo:hi], window):
                    row = int(np.searchsorted(ends, lo + i, "right")) - 1
                    first = int(ends[row]) + 1
                    mine = hits.setdefault(row, [0, set(), []])
                    mine[0] = max(mine[0], size)
                    mine[1].update(names)
                    mine[2].append((lo + i - reach + 1 - first, lo + i - first))
            if again:
                for row, old in enumerate(part.select(["longest_match", "hit_items", "hit_spans"]).to_pylist()):
                    if old["hit_spans"]:
                        mine = hits.setdefault(row, [0, set(), []])
                        mine[0] = max(mine[0], old["longest_match"])
                        mine[1].update(old["hit_items"])
                        mine[2] += [(s["first_word"], s["last_word"]) for s in old["hit_spans"]]
            n = part.num_rows
            n_hit, longest, found, spans = [0] * n, [0] * n, [[]] * n, [[]] * n
            for row, (size, names, pieces) in hits.items():
                merged: list[list[int]] = []
                for a, b in sorted(pieces):
                    if merged and a <= merged[-1][1] + 1:
                        merged[-1][1] = max(merged[-1][1], b)
                    else:
                        merged.append([a, b])
                where = [m.span() for m in word.finditer(low[at[row] : at[row + 1]])]
                n_hit[row] = sum(b - a + 1 for a, b in merged)
                longest[row], found[row] = size, sorted(names)
                spans[row] = [{"first_word": a, "last_word": b, "start_byte": where[a][0], "end_byte": where[b][1]} for a, b in merged]
            values = [part.column(f.name) for f in plain] + [
                pa.array(v, out.field(c).type) for c, v in zip(ADDED.names, (n_words, n_hit, longest, found, spans))
            ]
            yield pa.RecordBatch.from_arrays([v.cast(f.type) for v, f in zip(values, out)], schema=out)

    return docs.mapInArrow(match, schema)


def remove_hits(marked: DataFrame, min_words: int = 1, max_coverage: float = 0.8, text: str = "text") -> DataFrame:
    """The marked documents without spans of at least ``min_words`` words.

    A document is dropped where its hit words exceed ``max_coverage`` of all.
    """
    spans = F.filter("hit_spans", lambda s: s["last_word"] - s["first_word"] + 1 >= min_words)
    raw = F.col(text).cast("binary")
    start = F.struct(F.lit(b"").alias("kept"), F.lit(0).alias("at"))
    walked = F.aggregate(
        spans,
        start,
        lambda a, s: F.struct(F.concat(a["kept"], F.substring(raw, a["at"] + 1, s["start_byte"] - a["at"])).alias("kept"), s["end_byte"].alias("at")),
        lambda a: F.concat(a["kept"], F.substring(raw, a["at"] + 1, F.octet_length(raw))).cast("string"),
    )
    return marked.where(F.col("n_hit") <= F.col("n_words") * max_coverage).withColumn(text, F.when(F.size(spans) > 0, walked).otherwise(F.col(text)))
