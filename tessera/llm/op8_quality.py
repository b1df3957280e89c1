"""Quality rules and gradient-boosted trees over document statistics.

``statistics`` measures every whole text inside Spark's tasks. ``fit`` boosts
small trees on a bounded sample of labelled documents, with the scores held
monotone in chosen statistics. The trees are flattened into node arrays, so a
batch walks down all of them with array look-ups.

Null, empty and blank texts have no words (all counts 0) and fail the base
rules. Rows with a null or repeated key each get their own verdict; further
columns pass through, those named like the outputs are replaced. Without
labels of both kinds the model gives every document the score 1 and the base
rules decide alone.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import chunks, without

#: Labelled documents that the fit uses at most: those of the smallest key hashes.
FIT_ROWS = 20_000

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

#: The statistics that the trees see, with the direction in which the score may move (0: either).
FEATURES = {
    "log_words": 0,
    "word_length": 0,
    "symbols_per_word": -1,
    "dup_lines_share": -1,
    "repeat_share": -1,
    "upper_share": -1,
    "marks_per_word": -1,
    "digits_share": 0,
    "distinct_share": 0,
}

_SPACE = np.isin(np.arange(256), [32, 9, 10, 11, 12, 13])
_LEAD = (np.arange(256) & 0xC0) != 0x80
_KINDS = {
    "chars": _LEAD & ~_SPACE,
    "symbols": np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8)),
    "upper": (np.arange(256) >= 65) & (np.arange(256) <= 90),
    "digits": (np.arange(256) >= 48) & (np.arange(256) <= 57),
    "marks": np.isin(np.arange(256), np.frombuffer(b"!?", np.uint8)),
}


def _repeated(ids: np.ndarray, vocabulary: int) -> int:
    """Words inside 3-word windows that occur at least twice."""
    if len(ids) < 4:
        return 0
    if vocabulary < 1 << 21:
        code = (ids[:-2] << 42) | (ids[1:-1] << 21) | ids[2:]
    else:
        _, pair = np.unique(ids[:-2] * vocabulary + ids[1:-1], return_inverse=True)
        code = pair * vocabulary + ids[2:]
    order = np.argsort(code, kind="stable")
    same = code[order][1:] == code[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(code), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(ids), bool)
    covered[:-2] |= twice
    covered[1:-1] |= twice
    covered[2:] |= twice
    return int(covered.sum())


def measure(data: np.ndarray, at: np.ndarray) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """The counts of each text and its row of ``FEATURES``."""
    n = len(at) - 1
    kinds = {}
    for name, lut in _KINDS.items():
        run = np.concatenate([[0], np.cumsum(lut[data], dtype=np.int64)])
        kinds[name] = run[at[1:]] - run[at[:-1]]
    raw = data.tobytes()
    words, dup, repeat, distinct, n_lines = (np.zeros(n, np.int64) for _ in range(5))
    vocabulary: dict[bytes, int] = {}
    for i in range(n):
        text = raw[at[i] : at[i + 1]]
        found = text.split()
        if not found:
            continue
        words[i] = len(found)
        before = len(vocabulary)
        ids = np.fromiter((vocabulary.setdefault(w, len(vocabulary)) for w in found), np.int64, len(found))
        distinct[i] = len(np.unique(ids)) if before else len(vocabulary)
        repeat[i] = _repeated(ids, len(vocabulary))
        lines = [x for x in text.split(b"\n") if x.strip()]
        n_lines[i] = len(lines)
        dup[i] = len(lines) - len(set(lines))
    some, chars = np.maximum(words, 1), np.maximum(kinds["chars"], 1)
    counts = dict(zip(COUNTS, (words, kinds["chars"], kinds["symbols"], dup, repeat)))
    features = np.column_stack(
        [
            np.log1p(words),
            kinds["chars"] / some,
            kinds["symbols"] / some,
            dup / np.maximum(n_lines, 1),
            repeat / some,
            kinds["upper"] / chars,
            kinds["marks"] / some,
            kinds["digits"] / chars,
            distinct / some,
        ]
    )
    return counts, features


@dataclass
class Trees:
    """All trees in one set of node arrays; a leaf is its own child."""

    base: float = 50.0
    feature: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    threshold: np.ndarray = field(default_factory=lambda: np.zeros(0))
    child: np.ndarray = field(default_factory=lambda: np.zeros((0, 2), np.int32))
    value: np.ndarray = field(default_factory=lambda: np.zeros(0))
    roots: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int32))
    depth: int = 0

    def score(self, x: np.ndarray) -> np.ndarray:
        """Probability of good quality; rows walk down all trees together."""
        node = np.broadcast_to(self.roots, (len(x), len(self.roots)))
        row = np.arange(len(x))[:, None]
        for _ in range(self.depth):
            node = self.child[node, (x[row, self.feature[node]] > self.threshold[node]).astype(np.int8)]
        return 1 / (1 + np.exp(-np.clip(self.base + self.value[node].sum(axis=1), -50, 50)))


def boost(x: np.ndarray, y: np.ndarray, trees: int = 60, depth: int = 4, rate: float = 0.15, bins: int = 64, least: int = 10, shrink: float = 1.0) -> Trees:
    """Second-order boosting of the log loss over quantile bins.

    A split on a constrained statistic must order its sides, and the middle of
    the two then bounds everything below either side, which keeps every tree,
    and so their sum, monotone.
    """
    if len(y) == 0 or y.min() == y.max():
        return Trees()
    edges = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, bins + 1)[1:-1])) for j in range(x.shape[1])]
    binned = np.column_stack([np.searchsorted(e, x[:, j], "left") for j, e in enumerate(edges)])
    direction = list(FEATURES.values())
    mean = y.mean()
    base = float(np.log(mean / (1 - mean)))
    logit = np.full(len(y), base)
    feature, threshold, child, value, roots = [], [], [], [], []

    def node() -> int:
        feature.append(0), threshold.append(0.0), value.append(0.0), child.append([len(child)] * 2)
        return len(child) - 1

    for _ in range(trees):
        p = 1 / (1 + np.exp(-logit))
        g, h = y - p, np.maximum(p * (1 - p), 1e-6)
        roots.append(node())
        todo = [(roots[-1], np.arange(len(y)), -np.inf, np.inf, 0)]
        while todo:
            at, rows, low, high, level = todo.pop()
            total, weight = g[rows].sum(), h[rows].sum()
            best = (1e-6, None)
            if level < depth and len(rows) >= 2 * least:
                for j, e in enumerate(edges):
                    if not len(e):
                        continue
                    b = binned[rows, j]
                    gs, hs, ns = (np.cumsum(np.bincount(b, w, len(e) + 1))[:-1] for w in (g[rows], h[rows], np.ones(len(rows))))
                    left, right = np.clip(gs / (hs + shrink), low, high), np.clip((total - gs) / (weight - hs + shrink), low, high)
                    gain = gs**2 / (hs + shrink) + (total - gs) ** 2 / (weight - hs + shrink) - total**2 / (weight + shrink)
                    gain[(ns < least) | (len(rows) - ns < least) | (direction[j] * (right - left) < 0)] = 0
                    k = int(np.argmax(gain))
                    if gain[k] > best[0]:
                        best = (gain[k], (j, k, left[k], right[k]))
            if best[1] is None:
                value[at] = rate * float(np.clip(total / (weight + shrink), low, high))
                logit[rows] += value[at]
                continue
            j, k, left, right = best[1]
            feature[at], threshold[at], middle = j, float(edges[j][k]), (left + right) / 2
            child[at] = [node(), node()]
            bounds = {1: ((low, middle), (middle, high)), -1: ((middle, high), (low, middle)), 0: ((low, high),) * 2}[direction[j]]
            goes_left = binned[rows, j] <= k
            for to, mine, (a, z) in zip(child[at], (rows[goes_left], rows[~goes_left]), bounds):
                todo.append((to, mine, a, z, level + 1))
    return Trees(base, np.array(feature, np.int32), np.array(threshold), np.array(child, np.int32), np.array(value), np.array(roots, np.int32), depth)


def _per_row(docs: DataFrame, text: str, added: dict[str, T.DataType], make, keep_text: bool) -> DataFrame:
    """``docs`` with columns that ``make(data, offsets)`` gives for each batch of texts."""
    docs = without(docs, *added)
    plain = [f for f in docs.schema if keep_text or f.name != text]
    schema = T.StructType(plain + [T.StructField(c, t) for c, t in added.items()])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for part, data, at in chunks(batches, text, 1 << 20):
            made = make(data, at)
            values = [part.column(f.name) for f in plain] + [pa.array(made[c]) for c in added]
            yield pa.RecordBatch.from_arrays([v.cast(f.type) for v, f in zip(values, out)], schema=out)

    return docs.mapInArrow(run, schema)


def fit(docs: DataFrame, labels: DataFrame, key: str = "doc_id", label: str = "quality", text: str = "text", rows: int = FIT_ROWS, **options) -> Trees:
    """Trees from at most ``rows`` labelled documents; a key labelled twice counts as its larger label."""
    sample = (
        labels.where(F.col(key).isNotNull() & F.col(label).isNotNull())
        .groupBy(F.col(key).alias("fit_key"))
        .agg(F.max(label).cast("int").alias("fit_label"))
        .orderBy(F.xxhash64("fit_key"), "fit_key")
        .limit(rows)  # the documented bound of the fit; also what makes the broadcast safe
    )
    mine = docs.select(F.col(key).alias("k"), F.col(text).alias("t")).join(F.broadcast(sample), F.col("k") == F.col("fit_key")).select("t", "fit_label")
    got = _per_row(mine, "t", {"x": T.ArrayType(T.DoubleType())}, lambda data, at: {"x": list(measure(data, at)[1])}, False).limit(rows).toPandas()
    x = np.array(got["x"].tolist(), float).reshape(len(got), len(FEATURES))
    order = np.lexsort(x.T)  # the fit does not depend on the order of tasks
    return boost(x[order], got["fit_label"].to_numpy(float)[order], **options)


def judge(docs: DataFrame, trees: Trees, text: str = "text", threshold: float = 0.5, min_words: int = 50, max_repeat: int = 50, keep_text: bool = True) -> DataFrame:
    """``docs`` with counts, ``base_failed``, the trees' ``score`` and the verdict ``kept``."""
    shared = docs.sparkSession.sparkContext.broadcast(trees)  # some thousand nodes
    added = {c: T.LongType() for c in COUNTS} | {"score": T.DoubleType()}

    def make(data: np.ndarray, at: np.ndarray) -> dict:
        counts, features = measure(data, at)
        return counts | {"score": shared.value.score(features)}

    docs = without(docs, "base_failed", "kept")
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > max_repeat * F.col("n_words"))
    made = _per_row(docs, text, added, make, keep_text).withColumn("base_failed", failed)
    return made.withColumn("kept", ~F.col("base_failed") & (F.col("score") >= threshold))
