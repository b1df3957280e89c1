"""Byte-level BPE encoding and decoding over the corpus's distinct words.

Documents are cut into pre-tokens. A *block* (a few MB of whole documents)
keeps each document as positions into the block's own word list, so that the
words, not the tokens of the corpus, go through the shuffle. The words of all
blocks meet once: each distinct word is merged into ids once, and its ids go
back to the blocks that hold it, where every document is put together again by
position. For decoding, a block's ids are joined with the token-byte table (a
vocabulary of fixed size, sent to every task).

Null and empty texts have no tokens and decode to nothing. Repeated rows and
any further columns (also ones named like the outputs, which the outputs then
replace) pass through unchanged.
"""

from __future__ import annotations

import base64
import hashlib
import io
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import bucketed, chunks, without

#: Text bytes of a block: bounds a task's memory; larger blocks repeat fewer words.
BLOCK_BYTES = 24 << 20

OUTPUTS = {
    "token_ids": T.ArrayType(T.IntegerType()),
    "n_tokens": T.LongType(),
    "ids_sha256": T.StringType(),
    "decoded": T.BinaryType(),
    "decoded_sha256": T.StringType(),
}


def read_ranks(path: str) -> dict[bytes, int]:
    """The rank file's token bytes and ids; a vocabulary, so bounded."""
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def spelled(pattern: str) -> str:
    r"""The pre-token pattern with ``\s`` written as the Unicode White_Space property."""
    return pattern.replace(r"[^\s", r"[^\p{White_Space}").replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}")


def merge_word(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the adjacent pair of lowest rank is merged until none is known.

    Candidate pairs wait in a heap and pieces are linked both ways, so a word of
    n bytes costs n log n whatever its length.
    """
    whole = ranks.get(word)
    if whole is not None:
        return [whole]
    from heapq import heapify, heappop, heappush

    n = len(word)
    end = list(range(1, n + 1))
    before = list(range(-1, n - 1))
    heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(word[i : i + 2])) is not None]
    heapify(heap)
    alive = [True] * n
    while heap:
        _, i, stop = heappop(heap)
        if not alive[i] or (j := end[i]) >= n or not alive[j] or end[j] != stop:
            continue
        alive[j] = False
        end[i] = stop
        if stop < n:
            before[stop] = i
            if (r := ranks.get(word[i : end[stop]])) is not None:
                heappush(heap, (r, i, end[stop]))
        if (h := before[i]) >= 0 and (r := ranks.get(word[h:stop])) is not None:
            heappush(heap, (r, h, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[word[i : end[i]]])
        i = end[i]
    return out


def _packed(index: np.ndarray, counts: np.ndarray, rows: pa.RecordBatch) -> bytes:
    sink = io.BytesIO()
    with pa.ipc.new_stream(sink, rows.schema) as w:
        w.write_batch(rows)
    parts = [np.asarray(counts, "<i8").tobytes(), _planes(index), sink.getvalue()]
    head = np.array([len(p) for p in parts], "<i8").tobytes()
    return zstandard.ZstdCompressor(level=3).compress(head + b"".join(parts))


def _unpacked(blob: bytes) -> tuple[np.ndarray, np.ndarray, pa.Table]:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    a, b, c = np.frombuffer(raw[:24], "<i8")
    counts = np.frombuffer(raw[24 : 24 + a], "<i8")
    return _values(raw[24 + a : 24 + a + b]), counts, pa.ipc.open_stream(raw[24 + a + b : 24 + a + b + c]).read_all()


def word_blocks(docs: DataFrame, pattern: str, text: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """One row per block: ``block_id``, its distinct ``words``, and the documents as word positions."""
    schema = T.StructType([T.StructField("block_id", T.StringType()), T.StructField("words", T.ArrayType(T.StringType())), T.StructField("body", T.BinaryType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import regex

        find = regex.compile(spelled(pattern)).findall
        ids: dict[str, int] = {}
        index, counts, rows, size = [], [], [], 0

        def done() -> pa.RecordBatch:
            flat = np.concatenate(index) if index else np.zeros(0, np.uint32)
            # frequent words get small positions, which compress better
            often = np.argsort(-np.bincount(flat, minlength=len(ids)), kind="stable")
            place = np.empty(len(ids), np.uint32)
            place[often] = np.arange(len(ids), dtype=np.uint32)
            words = list(ids)
            body = _packed(place[flat], np.array(counts, np.int64), pa.Table.from_batches(rows).combine_chunks().to_batches()[0])
            return pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().hex]), pa.array([[words[i] for i in often]], pa.list_(pa.string())), pa.array([body], pa.binary())], names=schema.names
            )

        for part, data, _ in chunks(batches, text, 1 << 20):
            for value in part.column(text).to_pylist():
                found = find(value) if value else ()
                index.append(np.fromiter((ids.setdefault(w, len(ids)) for w in found), np.uint32, len(found)))
                counts.append(len(found))
            rows.append(part.drop_columns([text]))
            size += len(data)
            if size >= block_bytes:
                yield done()
                ids, index, counts, rows, size = {}, [], [], [], 0
        if rows:
            yield done()

    return docs.mapInArrow(cut, schema)


def _planes(values: np.ndarray) -> bytes:
    return values.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()


def _values(planes: bytes) -> np.ndarray:
    return np.frombuffer(planes, np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()


def word_codes(words: DataFrame, ranks: dict[bytes, int]) -> DataFrame:
    """Packed codes of each ``block``'s words, every distinct ``word`` encoded once.

    A word comes from a block at most once, so even the commonest word brings
    no more rows to its task than there are blocks; its rows follow each other.
    """
    shared = words.sparkSession.sparkContext.broadcast(ranks)  # a vocabulary file: about 50,000 entries
    schema = "block string, codes binary"

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, last, ids = shared.value, None, []
        waiting: dict[str, list[tuple[int, list[int]]]] = {}
        held = 0

        def done() -> pa.RecordBatch:
            packed = []
            for mine in waiting.values():
                at = np.array([a for a, _ in mine])
                order = np.argsort(at)
                n = np.array([len(c) for _, c in mine])[order]
                flat = np.array([i for k in order for i in mine[k][1]])
                parts = [_planes(np.diff(at[order], prepend=0)), _planes(n), _planes(flat)]
                packed.append(zstandard.compress(np.array([len(x) for x in parts], "<i8").tobytes() + b"".join(parts), 3))
            return pa.RecordBatch.from_arrays([pa.array(list(waiting)), pa.array(packed, pa.binary())], names=["block", "codes"])

        for batch in batches:
            for block, at, word in zip(*(batch.column(c).to_pylist() for c in ("block", "at", "word"))):
                if word != last:
                    last, ids = word, merge_word(word.encode(), table)
                waiting.setdefault(block, []).append((at, ids))
            held += batch.num_rows
            if held > 400_000:
                yield done()
                waiting, held = {}, 0
        if waiting:
            yield done()

    return words.repartition("word").sortWithinPartitions("word").mapInArrow(encode, schema)


def _codes(packed: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Ids of a block's words and where each word's begin."""
    at, n, flat = [], [], []
    for blob in packed:
        raw = zstandard.decompress(blob)
        a, b, c = np.frombuffer(raw[:24], "<i8")
        at.append(np.cumsum(_values(raw[24 : 24 + a]), dtype=np.int64))
        n.append(_values(raw[24 + a : 24 + a + b]).astype(np.int64))
        flat.append(_values(raw[24 + a + b : 24 + a + b + c]))
    if not at:
        return np.zeros(0, np.uint32), np.zeros(1, np.int64)
    at, n, flat = np.concatenate(at), np.concatenate(n), np.concatenate(flat)
    begin = np.cumsum(n) - n
    order = np.argsort(at)
    n, begin = n[order], begin[order]
    first = np.concatenate([[0], np.cumsum(n)])
    return flat[np.arange(first[-1]) + np.repeat(begin - first[:-1], n)], first


def encode_decode(
    docs: DataFrame,
    rank_path: str,
    pattern: str,
    want: tuple[str, ...] = ("token_ids", "n_tokens", "decoded"),
    text: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """``docs`` without the text, with the wanted ones of ``OUTPUTS``.

    ``token_ids`` are the ids, ``decoded`` the bytes that the ids stand for;
    the two digests are of the ids as little-endian unsigned 32-bit integers
    and of the decoded bytes.
    """
    ranks = read_ranks(rank_path)
    kept = without(docs, *want).columns
    docs = docs.select(*[f"`{c}`" for c in dict.fromkeys([*kept, text])])
    kept = [c for c in kept if c != text]
    blocks = bucketed(word_blocks(docs, pattern, text, block_bytes), "bpe_blocks", "block_id")
    words = blocks.select(F.col("block_id").alias("block"), F.posexplode("words").alias("at", "word"))
    codes = word_codes(words, ranks)
    token_bytes = docs.sparkSession.sparkContext.broadcast({i: b for b, i in ranks.items()})
    schema = T.StructType([docs.schema[c] for c in kept] + [T.StructField(w, OUTPUTS[w]) for w in want])
    out = pa.schema([(f.name, _arrow(f.dataType)) for f in schema])

    def assemble(body: pa.Table, coded: pa.Table) -> pa.Table:
        index, counts, rows = _unpacked(body.column("body")[0].as_py())
        ids, id_at = _codes(coded.column("codes").to_pylist())
        token = token_bytes.value
        tokens = [token[i] for i in ids.tolist()]
        spelt = [b"".join(tokens[a:b]) for a, b in zip(id_at[:-1].tolist(), id_at[1:].tolist())]
        ends = np.concatenate([[0], np.cumsum(counts)])
        made: dict[str, list] = {w: [] for w in want}
        for lo, hi in zip(ends[:-1], ends[1:]):
            mine = index[lo:hi]
            n = id_at[mine + 1] - id_at[mine]
            first = np.concatenate([[0], np.cumsum(n)])
            flat = ids[np.arange(first[-1]) + np.repeat(id_at[mine] - first[:-1], n)]
            if "token_ids" in made:
                made["token_ids"].append(flat.astype(np.int32))
            if "n_tokens" in made:
                made["n_tokens"].append(len(flat))
            if "ids_sha256" in made:
                made["ids_sha256"].append(hashlib.sha256(flat.astype("<u4").tobytes()).hexdigest())
            if "decoded" in made or "decoded_sha256" in made:
                whole = b"".join([spelt[i] for i in mine])
                if "decoded" in made:
                    made["decoded"].append(whole)
                if "decoded_sha256" in made:
                    made["decoded_sha256"].append(hashlib.sha256(whole).hexdigest())
        columns = [rows.column(c).cast(out.field(c).type) for c in kept] + [pa.array(made[w], out.field(w).type) for w in want]
        return pa.Table.from_arrays(columns, schema=out)

    def each(left: pa.Table, right: pa.Table) -> pa.Table:
        return assemble(left, right) if left.num_rows else out.empty_table()

    return blocks.select("block_id", "body").groupBy("block_id").cogroup(codes.groupBy("block")).applyInArrow(each, schema)


def _arrow(kind: T.DataType) -> pa.DataType:
    from pyspark.sql.pandas.types import to_arrow_type

    return to_arrow_type(kind)
