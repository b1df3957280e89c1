"""Removal of byte strings that start more than once, by merged Burrows-Wheeler transforms.

A string of ``length`` bytes is one *window* for each place where it starts.

1. *Anchors.* Of the k-grams in a window (k is half its length) the one of the
   smallest hash, the leftmost of equals, is its anchor. Equal windows have equal
   anchors at equal distance, so windows with an anchor seen once are unique.
   Successive windows with the same anchor form one *context*; anchors are
   counted with map-side aggregation.
2. *Blocks.* Contexts of one anchor agree on the anchor and are aligned at it.
   A block whose contexts are all the same string is closed: its windows repeat.
   All others are reduced to distinct contexts with the number of their copies.
3. *Transforms.* Shards of a block's contexts are turned into aligned
   Burrows-Wheeler transforms: column by column from the right, the symbol before
   each suffix in the order of the suffixes.
4. *Merge.* The transforms of a block's shards are merged without their texts:
   the interleave of the shards is refined by one symbol a step, reading each
   shard's next column in the order found so far. The steps also carry how far
   neighbours agree (the common prefixes), and neighbours that agree over the
   rest of a window bound the repeated intervals.

A block with very many distinct contexts is first split by the half of the
window's places, which lengthens what its members share, as often as needed.

Null and empty texts have no bytes. Repeated rows and equal texts repeat each
other; they share one result, by a 128-bit hash of the text. Matches never cross
rows. Further columns pass through; those named like the outputs are replaced.
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

from tessera.llm.common import chunks, dealt, materialize, text_id, without

#: Distinct contexts of a block beyond which it is split.
BLOCK_CONTEXTS = 4096
#: Contexts of a shard, whose transform is built by itself.
SHARD_CONTEXTS = 512
#: Bytes whose k-grams are hashed together; longer texts are taken in overlapping pieces.
PIECE = 1 << 20

_NONE = 256  # the symbol of a place that a context does not reach; equal to nothing
_BASE = 0x9E3779B97F4A7C15 | 1
_PLACE = np.uint64((1 << 24) - 1)


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values (the public splitmix64 finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, np.uint64(base & (1 << 64) - 1))]), dtype=np.uint64)


class Hasher:
    """Anchors and hashes of all windows of a buffer."""

    def __init__(self, length: int):
        self.length, self.k = length, length // 2
        self.symbol = _mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_BASE))
        self.up = np.zeros(0, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) <= n:
            self.up, self.down = _powers(_BASE, 2 * n), _powers(pow(_BASE, -1, 1 << 64), 2 * n)

    def contexts(self, data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, ...]:
        """(anchor, span, row, first window, last window, anchor's place) of every context; places in the buffer."""
        n, length, k = len(data), self.length, self.k
        if n < length:
            return (np.zeros(0, np.uint64),) * 2 + (np.zeros(0, np.int64),) * 4
        self._grow(n)
        run = np.concatenate([[np.uint64(0)], np.cumsum(self.symbol[data] * self.up[:n], dtype=np.uint64)])
        gram = _mix((run[k:] - run[:-k]) * self.down[: n - k + 1])
        least = (gram & ~_PLACE) | np.arange(len(gram), dtype=np.uint64)
        wide, size = length - k + 1, 1
        while 2 * size <= wide:
            least = np.minimum(least[:-size], least[size:])
            size *= 2
        if size < wide:
            least = np.minimum(least[: len(least) - (wide - size)], least[wide - size :])
        place = (least & _PLACE).astype(np.int64)
        row = np.repeat(np.arange(len(at) - 1), np.diff(at))[: len(place)]
        inside = np.arange(len(place)) + length <= at[1:][row]
        change = np.concatenate([[True], (place[1:] != place[:-1]) | (inside[1:] != inside[:-1]), [True]])
        edge = np.flatnonzero(change)
        first, last = edge[:-1], edge[1:] - 1
        ok = inside[first]
        first, last = first[ok], last[ok]
        span = _mix((run[last + length] - run[first]) * self.down[first] + (last - first).astype(np.uint64))
        return gram[place[first]], span, row[first], first, last, place[first]


def contexts(texts: DataFrame, length: int) -> DataFrame:
    """(anchor, span, th, a, b, p) of every context of ``texts`` (th, text)."""
    kind = "anchor long, span long, th binary, a int, b int, p int"

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(length)
        for part, data, at in chunks(batches, "text", PIECE):
            th = part.column("th").cast(pa.binary())
            for lo in range(0, max(1, len(data)), PIECE):
                # more than one piece only where a single text is longer
                piece = data[lo : lo + PIECE + length - 1] if len(data) > PIECE else data
                ends = np.clip(at - lo, 0, len(piece)) if len(data) > PIECE else at
                anchor, span, row, first, last, place = hasher.contexts(piece, ends)
                start = at[row] - lo
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor.view(np.int64)), pa.array(span.view(np.int64)), th.take(pa.array(row))]
                    + [pa.array((v - start).astype(np.int32)) for v in (first, last, place)],
                    names=["anchor", "span", "th", "a", "b", "p"],
                )
                if len(data) <= PIECE:
                    break

    return texts.mapInArrow(scan, kind)


#: A distinct context in a block: its windows start lo to hi places after the
#: anchor, all of them hold the places hi to lo + length; `left` and `right` are
#: the bytes before and after those, as far as the context goes.
MEMBER = "block binary, anchor long, span long, copies long, lo int, hi int, left binary, right binary"


def _members(found: DataFrame, length: int) -> DataFrame:
    """Distinct contexts (with ``body``, the text's, and their places in it) as members of their anchors' blocks."""
    k = length // 2

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        unpack = zstandard.ZstdDecompressor().decompress
        for batch in batches:
            out = []
            for body, spans in zip(batch.column("body").to_pylist(), batch.column("spans").to_pylist()):
                text = unpack(body)
                for s in spans:
                    a, b, p = s["a"], s["b"], s["p"]
                    core = xxhash.xxh3_128_digest(text[p : p + k])
                    out.append((core, s["anchor"], s["span"], s["copies"], k - length, 0, text[max(a, p + k - length) : p], text[p + k : b + length]))
            names = ["block", "anchor", "span", "copies", "lo", "hi", "left", "right"]
            types = [pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], t) for i, t in enumerate(types)], names=names)

    return found.mapInArrow(cut, MEMBER)


def _split(members: DataFrame) -> DataFrame:
    """Each member in two: with the windows of the first and of the second half of the places.

    The block's key goes on with the bytes that all windows of the half now share.
    """
    wide = F.col("hi") - F.col("lo")
    mid = (F.col("lo") + F.floor(wide / 2)).cast("int")
    grow_left = F.col("hi") - mid  # bytes that the first half takes from `left`, the second from `right`
    grow_right = mid + 1 - F.col("lo")
    n_left, n_right = F.octet_length("left"), F.octet_length("right")
    near = F.substring(F.col("left"), n_left - grow_left + 1, grow_left)
    first = members.where(n_left >= grow_left).select(
        F.unhex(F.md5(F.concat("block", F.lit(b"L"), near))).alias("block"), "anchor", "span", "copies", "lo", mid.alias("hi"),
        F.substring(F.col("left"), F.lit(1), n_left - grow_left).alias("left"),
        F.substring(F.col("right"), F.lit(1), mid - F.col("lo")).alias("right"),
    )
    second = members.where(n_right >= grow_right).select(
        F.unhex(F.md5(F.concat("block", F.lit(b"R"), F.substring(F.col("right"), F.lit(1), grow_right)))).alias("block"), "anchor", "span", "copies",
        (mid + 1).alias("lo"), "hi",
        F.substring(F.col("left"), F.greatest(n_left - (F.col("hi") - mid - 1), F.lit(0)) + 1, F.col("hi") - mid - 1).alias("left"),
        F.substring(F.col("right"), grow_right + 1, n_right).alias("right"),
    )
    return first.unionByName(second)


def shard_transforms(columns: np.ndarray, group: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Aligned transforms of all shards; rows are sorted by ``group``, their shard.

    By column, from the right: the symbols in the order of the suffixes that
    follow, where each suffix goes when its symbol is put before it, and the
    rows in the order so reached.
    """
    n, wide = columns.shape
    symbols, goes, rows = np.empty((wide, n), np.uint16), np.empty((wide, n), np.int32), np.empty((wide, n), np.int32)
    order, key = np.arange(n, dtype=np.int32), group.astype(np.int64) << 9
    for t in range(wide - 1, -1, -1):
        symbols[t] = columns[order, t]
        step = np.argsort(key | symbols[t], kind="stable")
        goes[t, step] = np.arange(n, dtype=np.int32)
        order = order[step]
        rows[t] = order
    return symbols, goes, rows


def merged_windows(symbols: np.ndarray, goes: np.ndarray, block: np.ndarray, size: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
    """Merge the shards of each block: by window, from the right, the suffixes that have an equal elsewhere.

    ``size`` is, by place, how many columns belong to a window of that place's
    block. A suffix is given by its place in the order of its own shard.
    """
    wide, n = symbols.shape
    key = block.astype(np.int64) << 9
    fresh = np.concatenate([[True], block[1:] != block[:-1]])  # the first place of each block
    interleave = np.arange(n)
    reach = np.where(fresh, -1, wide)  # the column at which a suffix and the one before it differ
    for t in range(wide - 1, -1, -1):
        symbol = symbols[t][interleave]
        step = np.argsort(key | symbol, kind="stable")
        sorted_symbol = symbol[step]
        same = ~fresh & (sorted_symbol != _NONE)
        same[1:] &= sorted_symbol[1:] == sorted_symbol[:-1]
        to = np.flatnonzero(same)
        left, right = step[to - 1] + 1, step[to] + 1
        new = np.where(fresh, -1, t)
        if len(to):
            padded = np.append(reach, wide)
            pair = np.empty(2 * len(to), np.int64)
            pair[::2], pair[1::2] = left, right
            new[to] = np.minimum.reduceat(padded, pair)[::2]
        reach = new
        interleave = goes[t][interleave[step]]
        equal = reach - t >= np.maximum(size, 1)
        equal[:-1] |= equal[1:]
        if equal.any():
            yield t, interleave[equal]


def repeated(members: pa.Table) -> list[list[dict]]:
    """For each member of whole blocks (sorted by block), runs of windows that start elsewhere too."""
    n = members.num_rows
    lo, hi, copies = (members.column(c).to_numpy() for c in ("lo", "hi", "copies"))
    size = (hi - lo).astype(np.int64)
    keys = members.column("block").to_pylist()
    block = np.cumsum(np.array([i > 0 and keys[i] != keys[i - 1] for i in range(n)]))
    wide = max(1, int(size.max()))
    columns = np.full((n, 2 * wide), _NONE, np.uint16)
    left, right = members.column("left").to_pylist(), members.column("right").to_pylist()
    for i in range(n):
        # the bytes before the shared ones end at column `size`, those after begin there
        x, y = np.frombuffer(left[i], np.uint8), np.frombuffer(right[i], np.uint8)
        columns[i, size[i] - len(x) : size[i]] = x
        columns[i, size[i] : size[i] + len(y)] = y
    reach = np.concatenate([np.zeros((n, 1), np.int64), np.cumsum(columns == _NONE, axis=1)], axis=1)
    found = np.zeros((n, wide + 1), bool)
    place = np.arange(wide + 1)
    fits = place[None, :] <= size[:, None]
    whole = fits & (np.take_along_axis(reach, np.minimum(place[None, :] + size[:, None], 2 * wide), 1) == reach[:, : wide + 1])
    found |= whole & (copies >= 2)[:, None]
    first = np.flatnonzero(np.concatenate([[True], block[1:] != block[:-1]]))
    shard = block * (n // SHARD_CONTEXTS + 1) + (np.arange(n) - first[block]) // SHARD_CONTEXTS
    symbols, goes, rows = shard_transforms(columns, shard)
    for t, suffixes in merged_windows(symbols, goes, block, size):
        if t <= wide:
            mine = rows[t][suffixes]
            found[mine, t] |= whole[mine, t]
    out_of_one = size == 0  # the shared bytes are the whole window
    many = np.bincount(block)[block] >= 2
    found[out_of_one & many, 0] = True
    runs = []
    for i in range(n):
        edge = np.flatnonzero(np.diff(np.concatenate([[False], found[i], [False]]).astype(np.int8)))
        runs.append([{"first": int(lo[i] + x), "last": int(lo[i] + y - 1)} for x, y in zip(edge[::2], edge[1::2])])
    return runs


RUNS = T.ArrayType(T.StructType([T.StructField("first", T.IntegerType()), T.StructField("last", T.IntegerType())]))


def _merge(members: DataFrame) -> DataFrame:
    """(anchor, span, runs) for the members of blocks that are small enough for a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_type

        kind = to_arrow_type(RUNS)

        def done(table: pa.Table) -> pa.RecordBatch:
            table = table.combine_chunks()
            return pa.RecordBatch.from_arrays(
                [table.column("anchor").combine_chunks(), table.column("span").combine_chunks(), pa.array(repeated(table), kind)], names=["anchor", "span", "runs"]
            )

        held: list[pa.RecordBatch] = []
        for batch in batches:
            keys = batch.column("block").to_pylist()
            lo = 0
            for i in range(len(keys)):
                last = keys[i - 1] if i else (held[-1].column("block")[-1].as_py() if held else keys[0])
                if keys[i] != last and sum(h.num_rows for h in held) + i - lo >= BLOCK_CONTEXTS:
                    held.append(batch.slice(lo, i - lo))
                    yield done(pa.Table.from_batches([h for h in held if h.num_rows]))
                    held, lo = [], i
            held.append(batch.slice(lo))
        held = [h for h in held if h.num_rows]
        if held:
            yield done(pa.Table.from_batches(held))

    schema = T.StructType([T.StructField("anchor", T.LongType()), T.StructField("span", T.LongType()), T.StructField("runs", RUNS)])
    return dealt(members, "block").sortWithinPartitions("block", "anchor", "span").mapInArrow(run, schema)


def _packed(texts: DataFrame) -> DataFrame:
    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard

        pack = zstandard.ZstdCompressor(level=3).compress
        for part, data, at in chunks(batches, "text", 1 << 22):
            raw = data.tobytes()
            yield pa.RecordBatch.from_arrays([part.column("th"), pa.array([pack(raw[a:b]) for a, b in zip(at[:-1], at[1:])], pa.binary())], names=["th", "body"])

    return texts.mapInArrow(squeeze, "th binary, body binary")


def repeated_spans(texts: DataFrame, length: int, block_contexts: int = BLOCK_CONTEXTS) -> DataFrame:
    """(th, spans): for each text hash of ``texts`` (th, text) the byte ranges that repeated windows cover."""
    rows = materialize(contexts(texts, length), "contexts")
    anchors = rows.groupBy("anchor").agg(F.count("*").alias("n"), F.min("span").alias("s0"), F.max("span").alias("s1")).where("n >= 2")
    # written first: beneath a join of two plain exchanges Spark can split an anchor with very many contexts
    anchors = materialize(anchors.select("anchor", (F.col("s0") != F.col("s1")).alias("mixed")), "anchors")
    hits = materialize(rows.join(anchors, "anchor"), "hits")
    closed = hits.where("NOT mixed").select("th", F.col("a").alias("start"), (F.col("b") + length).alias("end")).distinct()

    mixed = hits.where("mixed")
    distinct = mixed.groupBy("anchor", "span").agg(F.count("*").alias("copies"), F.min(F.struct("th", "a", "b", "p")).alias("at"))
    wanted = distinct.groupBy(F.col("at.th").alias("of")).agg(F.collect_list(F.struct("anchor", "span", "copies", "at.a", "at.b", "at.p")).alias("spans"))
    bodies = _packed(texts).dropDuplicates(["th"])
    open_ = materialize(_members(bodies.join(wanted, F.col("th") == F.col("of")).select("body", "spans"), length), "members")
    verdicts = []
    while True:
        sizes = open_.groupBy("block").agg(F.count("*").alias("m"))
        sized = open_.join(sizes, "block")
        one = sized.where("m = 1 AND copies >= 2")
        reach = F.struct(
            F.greatest(F.col("hi") - F.octet_length("left"), F.col("lo")).cast("int").alias("first"),
            F.least(F.col("lo") + F.octet_length("right"), F.col("hi")).cast("int").alias("last"),
        )
        verdicts.append(one.select("anchor", "span", F.array(reach).alias("runs")))
        # what members with one window left share is that window
        same = F.array(F.struct(F.col("lo").alias("first"), F.col("hi").alias("last")))
        verdicts.append(sized.where("m >= 2 AND lo = hi").select("anchor", "span", same.alias("runs")))
        verdicts.append(_merge(sized.where((F.col("m") >= 2) & (F.col("lo") < F.col("hi")) & (F.col("m") <= block_contexts)).drop("m")))
        large = sizes.where(F.col("m") > block_contexts)
        if not large.take(1):
            break
        more = open_.join(large.select("block"), "block").where("lo < hi").select(open_.columns)
        open_ = materialize(_split(more), "members")
    found = verdicts[0]
    for v in verdicts[1:]:
        found = found.unionByName(v)
    found = found.select(F.col("anchor").alias("x"), F.col("span").alias("y"), F.explode("runs").alias("run"))
    found = materialize(found, "verdicts")
    opened = mixed.join(found, (F.col("anchor") == F.col("x")) & (F.col("span") == F.col("y")))
    opened = opened.select("th", (F.col("p") + F.col("run.first")).alias("start"), (F.col("p") + F.col("run.last") + length).alias("end")).distinct()
    return closed.unionByName(opened).groupBy("th").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))


OUTPUTS = {"n_bytes": T.LongType(), "n_kept": T.LongType(), "n_removed": T.LongType(), "n_spans": T.LongType(), "kept": T.BinaryType(), "kept_sha256": T.StringType(), "kept_text": T.StringType()}


def remove_repeats(
    docs: DataFrame, length: int = 400, text: str = "text", want: tuple[str, ...] = ("n_bytes", "n_removed", "n_spans", "kept"), block_contexts: int = BLOCK_CONTEXTS
) -> DataFrame:
    """``docs`` without the text, with the wanted ones of ``OUTPUTS``.

    ``kept`` are the bytes that stay; ``kept_text`` is the same as text, without
    the halves of characters that a cut can leave (null for a null text).
    """
    docs = without(docs, *want)
    texts = docs.where(F.octet_length(text) >= length).select(text_id(text).alias("th"), F.col(text).alias("text"))
    spans = repeated_spans(texts, length, block_contexts).select(F.col("th").alias("_th"), F.col("spans").alias("_spans"))
    joined = docs.join(spans, text_id(text) == F.col("_th"), "left").drop("_th")
    plain = [f for f in docs.schema if f.name != text]
    schema = T.StructType(plain + [T.StructField(w, OUTPUTS[w]) for w in want])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for part, data, at in chunks(batches, text, 1 << 22):
            raw = data.tobytes()
            made: dict[str, list] = {w: [] for w in OUTPUTS}
            for a, b, ranges in zip(at[:-1].tolist(), at[1:].tolist(), part.column("_spans").to_pylist()):
                merged: list[list[int]] = []
                for s in ranges or ():
                    if merged and s["start"] <= merged[-1][1]:
                        merged[-1][1] = max(merged[-1][1], s["end"])
                    else:
                        merged.append([s["start"], s["end"]])
                edges = [0, *(x for m in merged for x in m), b - a]
                kept = b"".join([raw[a + x : a + y] for x, y in zip(edges[::2], edges[1::2])])
                made["n_bytes"].append(b - a)
                made["n_kept"].append(len(kept))
                made["n_removed"].append(b - a - len(kept))
                made["n_spans"].append(len(merged))
                made["kept"].append(kept)
                if "kept_text" in want:
                    made["kept_text"].append(kept.decode("utf-8", "ignore"))
                if "kept_sha256" in want:
                    made["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            if "kept_text" in want:
                made["kept_text"] = [x if there else None for x, there in zip(made["kept_text"], part.column(text).is_valid().to_pylist())]
            values = [part.column(f.name) for f in plain] + [pa.array(made[w], out.field(w).type) for w in want]
            yield pa.RecordBatch.from_arrays([v.cast(f.type) for v, f in zip(values, out)], schema=out)

    return joined.mapInArrow(finish, schema)
