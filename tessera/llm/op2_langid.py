"""Language identification by string kernels.

The kernel of two texts is the blended spectrum kernel on presence: the n-grams
(of one to three bytes, letters lower-cased, all else one space) that both
contain, counted and divided by the root of the product of their own counts.
It is taken over the n-grams found in most of the training texts. Landmark
texts give the Nyström map; one ridge regression against the rest for each
language is solved in that space. Scoring is two matrix products for a batch:
texts by landmarks, landmarks by languages.

The fit uses a bounded number of training texts of each language. Every whole
text is scored. A null text or one without letters is ``und`` with the score 0;
one with letters but without a known n-gram is as likely to be any language and
gets the first. Without any training text all are ``und``. Rows with
null or repeated keys are scored like others; further columns pass through,
those named like the outputs are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import chunks, without

#: Training texts of each language (those of the smallest key hashes), landmarks of each, and n-grams of the kernel.
FIT_ROWS, LANDMARKS, GRAMS = 300, 16, 4096
UNKNOWN = "und"

#: Lower-cases A-Z; ASCII that is no letter becomes a space.
LETTERS = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_FOLD = np.frombuffer(LETTERS, np.uint8)
_ORDERS = ((1, 0), (2, 1 << 8), (3, (1 << 8) + (1 << 16)))
_ALL = (1 << 8) + (1 << 16) + (1 << 24)


def _codes(data: np.ndarray) -> list[np.ndarray]:
    """The code of the n-gram at each byte, for each order."""
    one = _FOLD[data].astype(np.int32)
    two = (one[:-1] << 8) | one[1:]
    three = (two[:-1] << 8) | one[2:]
    return [one, two + _ORDERS[1][1], three + _ORDERS[2][1]]


def gram_sets(data: np.ndarray, at: np.ndarray) -> Iterator[np.ndarray]:
    """The distinct n-grams of each text."""
    for a, b in zip(at[:-1], at[1:]):
        yield np.unique(np.concatenate(_codes(data[a:b]))) if b > a else np.zeros(0, np.int32)


@dataclass
class Kernel:
    """``grams`` of the kernel, presence of the landmarks (grams x landmarks), and their weights for each language."""

    grams: np.ndarray
    landmarks: np.ndarray
    weights: np.ndarray
    languages: list[str]

    def column(self) -> np.ndarray:
        place = np.full(_ALL, -1, np.int16)
        place[self.grams] = np.arange(len(self.grams))
        return place

    def presence(self, data: np.ndarray, at: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Texts x n-grams: 1 where the n-gram is in the text."""
        found = np.zeros((len(at) - 1, len(self.grams)), np.float32)
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))
        for (n, _), code in zip(_ORDERS, _codes(data)):
            column = place[code]
            here = np.flatnonzero(column >= 0)
            here = here[here + n <= at[1:][row[here]]]  # no n-gram crosses texts
            found[row[here], column[here]] = 1
        return found

    def scores(self, found: np.ndarray) -> np.ndarray:
        return kernel(found, self.landmarks) @ self.weights


def kernel(x: np.ndarray, landmarks: np.ndarray) -> np.ndarray:
    """Normalised kernel of texts (rows of x) and landmarks (columns)."""
    size = np.sqrt(np.maximum(x.sum(axis=1), 1))[:, None] * np.sqrt(np.maximum(landmarks.sum(axis=0), 1))[None, :]
    return (x @ landmarks) / size


def solve(x: np.ndarray, labels: np.ndarray, chosen: np.ndarray, ridge: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """(landmarks, weights): kernel ridge regression of each language against the rest in the Nyström space."""
    landmarks = x[chosen].T.copy()
    middle = kernel(x[chosen], landmarks).astype(np.float64)
    value, vector = np.linalg.eigh((middle + middle.T) / 2)
    keep = value > 1e-6 * value.max()
    root = vector[:, keep] / np.sqrt(value[keep])
    z = kernel(x, landmarks).astype(np.float64) @ root
    target = np.where(labels[:, None] == np.arange(labels.max() + 1)[None, :], 1.0, -1.0)
    share = 1 / np.bincount(labels)[labels]  # each language weighs the same
    w = np.linalg.solve(z.T @ (z * share[:, None]) + ridge * np.eye(z.shape[1]), z.T @ (target * share[:, None]))
    return landmarks, (root @ w).astype(np.float32)


def fit(docs: DataFrame, train: Column, key: str = "doc_id", text: str = "text", lang: str = "lang", rows: int = FIT_ROWS) -> Kernel | None:
    """Learn from at most ``rows`` texts of each language among the rows where ``train`` holds; None without any."""
    usable = docs.where(train & F.col(lang).isNotNull() & (F.octet_length(text) > 0) & F.col(key).isNotNull())
    order = Window.partitionBy("l").orderBy(F.xxhash64("k"), "k")
    # ids first: Spark keeps `rows` of them in each map task before the shuffle
    ids = usable.select(F.col(key).alias("k"), F.col(lang).alias("l")).withColumn("r", F.row_number().over(order)).where(F.col("r") <= rows)
    ids = ids.select("k", "l").distinct()
    texts = usable.select(F.col(key).alias("key"), F.col(lang).alias("lang"), F.col(text).alias("text"))
    sample = texts.join(F.broadcast(ids), (F.col("key") == F.col("k")) & (F.col("lang") == F.col("l"))).select("key", "lang", "text")

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, data, at in chunks(batches, "text", 1 << 20):
            sets = pa.array(list(gram_sets(data, at)), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([part.column("key").cast(pa.string()), part.column("lang"), sets], names=["key", "lang", "grams"])

    got = sample.mapInArrow(grams, "key string, lang string, grams array<int>").toPandas()
    if not len(got):
        return None
    got = got.sort_values(["lang", "key"], kind="stable").groupby("lang").head(rows).reset_index(drop=True)
    languages = sorted(got["lang"].unique())
    labels = got["lang"].map({x: i for i, x in enumerate(languages)}).to_numpy()
    # n-grams by the share of a language's texts that have them, at its best language
    seen, column = np.unique(np.concatenate(got["grams"].to_list()), return_inverse=True)
    row = np.repeat(np.arange(len(got)), got["grams"].str.len())
    often = np.zeros((len(languages), len(seen)))
    np.add.at(often, (labels[row], column), 1 / np.bincount(labels)[labels[row]])
    top = np.sort(np.lexsort((seen, -often.max(axis=0)))[:GRAMS])
    where = np.full(len(seen), -1)
    where[top] = np.arange(len(top))
    x = np.zeros((len(got), len(top)), np.float32)
    ok = where[column] >= 0
    x[row[ok], where[column[ok]]] = 1
    chosen = np.concatenate([np.flatnonzero(labels == i)[:: max(1, int((labels == i).sum()) // LANDMARKS)][:LANDMARKS] for i in range(len(languages))])
    landmarks, weights = solve(x, labels, chosen)
    return Kernel(seen[top].astype(np.int32), landmarks, weights, languages)


def _has_letter(raw: bytes) -> bool:
    return any(c.isalpha() for c in raw.decode("utf-8", "replace"))


def predict(docs: DataFrame, model: Kernel | None, text: str = "text", sharpness: float = 4.0, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the softmax of the languages' scores at the best."""
    docs = without(docs, "lang_pred", "score")
    plain = [f for f in docs.schema if keep_text or f.name != text]
    schema = T.StructType(plain + [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())])
    shared = docs.sparkSession.sparkContext.broadcast(model)  # n-grams x landmarks, both bounded

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out, known = to_arrow_schema(schema), shared.value
        column = known.column() if known else None
        for part, data, at in chunks(batches, text, 1 << 20):
            n = part.num_rows
            names, best = [UNKNOWN] * n, np.zeros(n)
            if known:
                ascii_letters = np.concatenate([[0], np.cumsum((_FOLD[data] >= 97) & (data < 128), dtype=np.int64)])
                sure = ascii_letters[at[1:]] > ascii_letters[at[:-1]]
                found = known.presence(data, at, column)
                letters = [bool(s) or _has_letter(data[a:b].tobytes()) for s, a, b in zip(sure, at[:-1], at[1:])]
                ok = np.array(letters)
                # a text that shares no n-gram with the model has a kernel of 0 to all: every language is as likely
                s = np.where(found.sum(axis=1, keepdims=True) > 0, np.nan_to_num(known.scores(found)), 0)
                odds = np.exp(sharpness * s - sharpness * s.max(axis=1, keepdims=True))
                first = odds.argmax(axis=1)
                best = np.where(ok, (1 / odds.sum(axis=1)).astype(float), 0.0)
                names = [known.languages[i] if fine else UNKNOWN for i, fine in zip(first, ok)]
            values = [part.column(f.name) for f in plain] + [pa.array(names, pa.string()), pa.array(best)]
            yield pa.RecordBatch.from_arrays([v.cast(f.type) for v, f in zip(values, out)], schema=out)

    return docs.mapInArrow(score, schema)
