"""Removal of lines that many documents have.

1. Each text is exploded into its lines. A line's key is the line without blanks
   at both ends and with A-Z in lower case; what travels is a 128-bit hash of
   it, with the places that the key has in the text and a 128-bit hash of the text.
2. Documents are counted by key, in the map tasks first.
3. Keys of enough documents meet the exploded lines again (a join whose hot keys
   Spark can split); by text, their places come together.
4. Documents meet the places of their text, and the lines left are joined again
   in the order of their places.

A document is a row; a key counts once in it, however often it is there. Null
and empty texts are one empty line, which never counts; a null text stays null.
Rows of equal texts share the places. If all lines go, the text left is empty.
Further columns pass through; those named like the outputs are replaced.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import chunks, materialize, text_id, without

OUTPUTS = {"n_lines": T.LongType(), "n_dropped": T.LongType(), "kept_text": T.StringType(), "kept_sha256": T.StringType()}
#: Lines in one batch of the exploded table, about.
BATCH_LINES = 1 << 16


def exploded(docs: DataFrame, text: str, min_chars: int) -> DataFrame:
    """(th, line, at): for each row the hashes of its distinct keys of ``min_chars`` and more, with their places."""
    kind = pa.schema([("th", pa.binary()), ("line", pa.binary()), ("at", pa.list_(pa.int32()))])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        owner: list[int] = []
        line: list[bytes] = []
        places: list[list[int]] = []

        def done(ids: pa.Array) -> pa.RecordBatch:
            made = pa.RecordBatch.from_arrays([ids.take(pa.array(owner, pa.int64())), pa.array(line, pa.binary()), pa.array(places, kind.field("at").type)], schema=kind)
            for x in (owner, line, places):
                x.clear()
            return made

        for part, data, at in chunks(batches, "text", 1 << 20):
            low, ids = data.tobytes().lower(), part.column("th").cast(pa.binary())  # of bytes: A-Z only
            for i, (a, b) in enumerate(zip(at[:-1].tolist(), at[1:].tolist())):
                mine: dict[bytes, list[int]] = {}
                for p, raw in enumerate(low[a:b].split(b"\n")):
                    key = raw.strip()
                    if len(key) >= min_chars and (min_chars == 1 or len(key.decode()) >= min_chars):
                        mine.setdefault(key, []).append(p)
                for key, found in mine.items():
                    owner.append(i)
                    line.append(xxhash.xxh3_128_digest(key))
                    places.append(found)
                if len(owner) >= BATCH_LINES:
                    yield done(ids)
            if owner:
                yield done(ids)

    rows = docs.where(F.col(text).isNotNull()).select(text_id(text).alias("th"), F.col(text).alias("text"))
    return rows.mapInArrow(scan, "th binary, line binary, at array<int>")


def dropped_places(docs: DataFrame, text: str, min_docs: int, min_chars: int) -> DataFrame:
    """(th, gone): by text, the places of the lines whose key ``min_docs`` rows have."""
    lines = materialize(exploded(docs, text, min_chars), "lines")
    common = lines.groupBy("line").agg(F.count("*").alias("docs")).where(F.col("docs") >= min_docs).select("line")
    # written first: beneath a join of two plain exchanges Spark can split a line of very many documents
    hits = lines.join(materialize(common, "common-lines"), "line")
    return hits.groupBy("th").agg(F.flatten(F.collect_set("at")).alias("gone"))  # equal texts give equal places


def drop_common_lines(docs: DataFrame, text: str = "text", min_docs: int = 10, min_chars: int = 1, want: tuple[str, ...] = ("n_lines", "n_dropped", "kept_text")) -> DataFrame:
    """``docs`` without the text, with the wanted ones of ``OUTPUTS``.

    ``n_lines`` counts before dropping. ``kept_text`` is null for a null text,
    whose ``kept_sha256`` is that of the empty text.
    """
    if min_chars < 1:
        raise ValueError("a key must have at least one character")
    docs = without(docs, *want)
    gone = materialize(dropped_places(docs, text, min_docs, min_chars), "dropped-places").withColumnsRenamed({"th": "_th", "gone": "_gone"})
    joined = docs.join(gone, text_id(text) == F.col("_th"), "left").drop("_th")
    plain = [f for f in docs.schema if f.name != text]
    schema = T.StructType(plain + [T.StructField(w, OUTPUTS[w]) for w in want])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for part, data, at in chunks(batches, text, 1 << 22):
            raw, made = data.tobytes(), {w: [] for w in OUTPUTS}
            for a, b, places in zip(at[:-1].tolist(), at[1:].tolist(), part.column("_gone").to_pylist()):
                kept = raw[a:b]
                made["n_lines"].append(kept.count(b"\n") + 1)
                made["n_dropped"].append(len(places or ()))
                if places:
                    lines = kept.split(b"\n")
                    stays = np.ones(len(lines), bool)
                    stays[places] = False
                    kept = b"\n".join([lines[i] for i in np.flatnonzero(stays)])
                if "kept_text" in want:
                    made["kept_text"].append(kept.decode())
                if "kept_sha256" in want:
                    made["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if "kept_text" in want:
                made["kept_text"] = [x if there else None for x, there in zip(made["kept_text"], part.column(text).is_valid().to_pylist())]
            values = [part.column(f.name) for f in plain] + [pa.array(made[w], out.field(w).type) for w in want]
            yield pa.RecordBatch.from_arrays([v.cast(f.type) for v, f in zip(values, out)], schema=out)

    return joined.mapInArrow(finish, schema)
