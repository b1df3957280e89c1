"""Toxicity by non-negative positive-unlabelled learning.

Confirmed toxic documents and unlabelled text train a logistic model on word
presence. The risk is class-prior corrected: what the unlabelled texts lose as
negatives, less the prior's share of what the positives would, estimates the
negatives' risk; where that estimate falls below zero, the step goes back up
instead of fitting it further.

The fit uses bounded numbers of positives and of unlabelled texts; the prior is
given, or counted over all labelled rows of the training part. Every whole text
is scored. A null or empty text has no words and gets the score that the bias
gives. Without positives all scores are the prior. Rows with null or repeated
keys are scored like others, and equal rows are learnt from once; further columns pass through, those named like
the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import chunks, without

#: Texts of the fit (those of the smallest key hashes) and words of the model.
FIT_POSITIVE, FIT_UNLABELLED, WORDS = 3000, 6000, 1024

#: Lower-cases A-Z; digits, a-z and all bytes of non-ASCII characters are word bytes.
WORD_BYTES = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))


def word_codes(data: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """The distinct words of each text, as 63-bit hashes."""
    low = data.tobytes().translate(WORD_BYTES)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
        yield np.array(sorted(xxhash.xxh3_64_intdigest(w) >> 1 for w in set(low[a:b].split())), np.int64)


@dataclass
class Model:
    """Weights of words, by hash in ascending order, and the bias."""

    words: np.ndarray
    weights: np.ndarray
    bias: float


def train(positive: np.ndarray, unlabelled: np.ndarray, prior: float, steps: int = 1500, rate: float = 0.1, decay: float = 5e-6) -> tuple[np.ndarray, float]:
    """Minimise the non-negative risk of a logistic model by Adam on the whole sample."""
    x = np.vstack([positive, unlabelled]).astype(np.float32)
    n = len(positive)
    w, b = np.zeros(x.shape[1], np.float32), float(np.log(prior / (1 - prior)))
    state = [np.zeros(x.shape[1] + 1) for _ in range(2)]
    for step in range(1, steps + 1):
        z = x @ w + b
        p = 1 / (1 + np.exp(-z))
        as_negative = np.logaddexp(0, z)
        negative_risk = as_negative[n:].mean() - prior * as_negative[:n].mean()
        pull = np.zeros(len(x), np.float32)  # derivative of the risk by each text's z
        if negative_risk >= 0:
            pull[:n] = prior * (p[:n] - 1) / n - prior * p[:n] / n
            pull[n:] = p[n:] / (len(x) - n)
        else:  # the estimate cannot be negative: undo what made it so
            pull[:n] = prior * p[:n] / n
            pull[n:] = -p[n:] / (len(x) - n)
        g = np.append(x.T @ pull + (decay * w if negative_risk >= 0 else 0), pull.sum())
        state[0] = 0.9 * state[0] + 0.1 * g
        state[1] = 0.999 * state[1] + 0.001 * g * g
        move = rate * (state[0] / (1 - 0.9**step)) / (np.sqrt(state[1] / (1 - 0.999**step)) + 1e-8)
        w, b = w - move[:-1].astype(np.float32), b - float(move[-1])
    # the bias at which the unlabelled texts are toxic as often as the prior says
    z, low, high = unlabelled @ w, -30.0, 30.0
    for _ in range(60):
        b = (low + high) / 2
        low, high = (b, high) if (1 / (1 + np.exp(-(z + b)))).mean() < prior else (low, b)
    return w, b


def _sets(rows: DataFrame) -> list[np.ndarray]:
    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in chunks(batches, "text", 1 << 20):
            yield pa.RecordBatch.from_arrays([part.column("h"), pa.array(list(word_codes(data, at)), pa.list_(pa.int64()))], names=["h", "words"])

    got = rows.mapInArrow(words, "h long, words array<long>").toPandas()
    got["n"] = got["words"].str.len()
    return got.sort_values(["h", "n"], kind="stable")["words"].to_list()  # the fit does not depend on the order of tasks


def fit(
    docs: DataFrame,
    labels: DataFrame,
    train_part: Column,
    key: str = "doc_id",
    label: str = "toxic",
    text: str = "text",
    prior: float | None = None,
    positives: int = FIT_POSITIVE,
    unlabelled: int = FIT_UNLABELLED,
) -> Model:
    """Learn from labelled toxic documents and from any documents, both where ``train_part`` (on the key) holds."""
    known = labels.where(train_part & F.col(key).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(key).alias("k")).agg(F.max(label).alias("y"))
    if prior is None:
        prior = known.agg(F.avg(F.col("y").cast("double"))).first()[0]
    prior = min(max(prior or 0.01, 1e-3), 0.9)
    # the documented bounds of the fit; also what makes the broadcasts safe
    ids = known.where("y = 1").orderBy(F.xxhash64("k"), "k").limit(positives).select("k")
    any_ids = docs.where(train_part & F.col(key).isNotNull()).select(F.col(key).alias("k")).orderBy(F.xxhash64("k"), "k").limit(unlabelled).distinct()
    texts = docs.select(F.col(key).alias("key"), F.xxhash64(key, text).alias("h"), F.col(text).alias("text"))

    def pick(which: DataFrame, n: int) -> DataFrame:
        # repeated rows count once, and of a repeated key's texts those of the smallest hashes are taken
        rows = texts.join(F.broadcast(which), F.col("key") == F.col("k")).groupBy("h").agg(F.max("text").alias("text"))
        return rows.orderBy("h").limit(n)

    p, u = _sets(pick(ids, positives)), _sets(pick(any_ids, unlabelled))
    if not p or not u:
        return Model(np.zeros(0, np.int64), np.zeros(0, np.float32), float(np.log(prior / (1 - prior))))
    words, column = np.unique(np.concatenate(p + u), return_inverse=True)
    row = np.repeat(np.arange(len(p) + len(u)), [len(s) for s in p + u])
    in_p, in_u = np.bincount(column[row < len(p)], minlength=len(words)) / len(p), np.bincount(column[row >= len(p)], minlength=len(words)) / len(u)
    mean = (in_p * len(p) + in_u * len(u)) / (len(p) + len(u))
    tells = np.abs(in_p - in_u) / np.sqrt(mean * (1 - mean) * (1 / len(p) + 1 / len(u)) + 1e-12)
    # words whose shares differ by more than the largest of so many chance differences would
    sure = np.flatnonzero((tells > np.sqrt(2 * np.log(max(2, len(words))))) & (mean * (len(p) + len(u)) >= 5))
    top = np.sort(sure[np.lexsort((words[sure], -tells[sure]))[:WORDS]])
    place = np.full(len(words), -1)
    place[top] = np.arange(len(top))
    x = np.zeros((len(p) + len(u), len(top)), np.float32)
    ok = place[column] >= 0
    x[row[ok], place[column[ok]]] = 1
    weights, bias = train(x[: len(p)], x[len(p) :], prior)
    return Model(words[top], weights, bias)


def score(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.3, keep_text: bool = True) -> DataFrame:
    """``docs`` with the ``score`` and ``predicted`` (1 from the threshold on)."""
    docs = without(docs, "score", "predicted")
    plain = [f for f in docs.schema if keep_text or f.name != text]
    schema = T.StructType(plain + [T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # WORDS words

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, known = to_arrow_schema(schema), shared.value
        weight_of = dict(zip(known.words.tolist(), known.weights.astype(float).tolist()))
        for part, data, at in chunks(batches, text, 1 << 20):
            low = data.tobytes().translate(WORD_BYTES)
            seen: dict[bytes, float] = {}
            logits = []
            for a, b in zip(at[:-1].tolist(), at[1:].tolist()):
                found = set(low[a:b].split())
                for w in found - seen.keys():
                    seen[w] = weight_of.get(xxhash.xxh3_64_intdigest(w) >> 1, 0.0)
                logits.append(known.bias + sum(sorted(v for w in found if (v := seen[w]))))
            values = [part.column(f.name) for f in plain] + [pa.array(1 / (1 + np.exp(-np.clip(logits, -50, 50))))]
            yield pa.RecordBatch.from_arrays([v.cast(f.type) for v, f in zip(values, out)], schema=out)

    return docs.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
