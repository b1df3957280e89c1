"""Centroid clustering over subvector dictionaries.

1. *Encoding, once.* Vectors are turned into integers and stored in chunks. In a
   chunk each block of ``width`` dimensions has a dictionary of its distinct
   subvectors, and a vector is one code a block: nothing is lost, and equal
   subvectors are stored once.
2. *A round.* By chunk, the squared distances of every dictionary entry to every
   centroid's block are computed once, in whole numbers; a vector's distances
   are the sums of its codes' partial ones. A cluster's sums are counted by code
   as well: how often each entry is in it, times the entry. Only a count and a
   sum a dimension leave a task for each cluster; the driver holds ``clusters``
   centroids and nothing of the vectors.
3. The final assignment, and sums of its distances.

All arithmetic is exact, so results do not depend on how rows are spread. A
round moves no vectors; one vector's many copies make neither a hot key nor a
large group.

Kept are vectors with exactly ``dims`` components, none null, NaN or infinite;
rows of other vectors have no result. Each component x becomes floor(scale * x).
Those must lie within 2 ** 27 of zero, else the job fails with a message
(distances would leave 64 bits). Repeated vectors and keys are ordinary rows.
The first centroids are the vectors of the smallest hashes of their keys (equal
hashes: the smaller vector; null keys last); with fewer vectors than clusters
there are as many clusters as vectors. An empty cluster keeps its centroid. An
empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import materialize

#: Vectors of a chunk, which is encoded and scored at once; dimensions of a dictionary's block.
CHUNK, WIDTH = 1 << 15, 2
#: Components must be smaller than this in size: 64-bit sums of the squares of their differences then hold for 128 dimensions.
LARGEST = 1 << 27


def quantised(vectors: DataFrame, key: str, vector: str, dims: int, scale: int) -> DataFrame:
    """(id, v) of the kept rows: v is the array of whole numbers."""
    x = F.col(vector)
    finite = lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf"))
    kept = vectors.where((F.size(x) == dims) & F.forall(x, finite))
    # beyond the whole numbers that a double holds one by one, floor would leave the type
    whole = F.transform(x, lambda e: F.floor(F.greatest(F.least(F.lit(float(scale)) * e.cast("double"), F.lit(2.0**52)), F.lit(-(2.0**52)))).cast("long"))
    return kept.select(F.col(key).alias("id"), whole.alias("v"))


def encode(columns: np.ndarray, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    """The dictionary of each block of dimensions, and the codes (block, vector)."""
    n, dims = columns.shape
    books, codes = [], np.empty((-(-dims // width), n), np.int32)
    for b, lo in enumerate(range(0, dims, width)):
        part = columns[:, lo : lo + width]
        low = part.min(axis=0)
        span = [int(s) for s in part.max(axis=0) - low + 1]
        total = 1
        for s in span:
            total *= s
        if total < 1 << 62:  # one number stands for a subvector
            one = np.zeros(n, np.int64)
            for j, s in enumerate(span):
                one = one * s + (part[:, j] - low[j])
            _, first, codes[b] = np.unique(one, return_index=True, return_inverse=True)
            books.append(part[first])
        else:
            book, inverse = np.unique(part, axis=0, return_inverse=True)
            codes[b] = inverse.reshape(-1)
            books.append(book)
    return books, codes


def dictionaries(vectors: DataFrame, dims: int, width: int = WIDTH, chunk: int = CHUNK) -> DataFrame:
    """One row a chunk of ``vectors`` (id, v): ids, the entries of each block's dictionary, and the codes."""
    kind = vectors.schema["id"].dataType
    schema = T.StructType([T.StructField("ids", T.ArrayType(kind)), T.StructField("sizes", T.ArrayType(T.IntegerType())), T.StructField("books", T.BinaryType()), T.StructField("codes", T.BinaryType())])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)

        def done(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            columns = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in table.column("v").chunks]).reshape(-1, dims)
            if np.abs(columns).max() >= LARGEST:
                raise ValueError(f"a component times the scale is not within {LARGEST} of zero")
            books, codes = encode(columns, width)
            sizes = [len(b) for b in books]
            body = np.concatenate([b.reshape(-1) for b in books]).astype(np.int32).tobytes()
            ids = table.column("id").combine_chunks()
            of = pa.ListArray.from_arrays(pa.array([0, len(ids)], pa.int32()), ids.combine_chunks() if isinstance(ids, pa.ChunkedArray) else ids)
            small = np.uint16 if max(sizes) <= 1 << 16 else np.int32
            values = [of, pa.array([sizes], out.field("sizes").type), pa.array([body], pa.binary()), pa.array([codes.astype(small).tobytes()], pa.binary())]
            return pa.RecordBatch.from_arrays([v.cast(f.type) for v, f in zip(values, out)], schema=out)

        held, n = [], 0
        for batch in batches:
            for lo in range(0, batch.num_rows, chunk):
                part = batch.slice(lo, chunk)
                if n and n + part.num_rows > chunk:
                    yield done(held)
                    held, n = [], 0
                held.append(part)
                n += part.num_rows
        if n:
            yield done(held)

    return vectors.mapInArrow(pack, schema)


def _unpacked(batches: Iterator[pa.RecordBatch], dims: int, width: int) -> Iterator[tuple[pa.Array, list[np.ndarray], np.ndarray]]:
    """(ids, dictionaries, codes) of each chunk."""
    edge = list(range(0, dims, width))
    for batch in batches:
        for i in range(batch.num_rows):
            ids = batch.column("ids").slice(i, 1).flatten()
            sizes = batch.column("sizes")[i].as_py()
            body = np.frombuffer(batch.column("books")[i].as_py(), np.int32).astype(np.int64)
            raw = batch.column("codes")[i].as_py()
            codes = np.frombuffer(raw, np.uint16 if len(raw) == 2 * len(edge) * len(ids) else np.int32).reshape(len(edge), len(ids))
            books, at = [], 0
            for lo, n in zip(edge, sizes):
                wide = min(width, dims - lo)
                books.append(body[at : at + n * wide].reshape(n, wide))
                at += n * wide
            yield ids, books, codes


def nearest(books: list[np.ndarray], codes: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each coded vector (ties: the smaller number) and its squared distance."""
    total, lo = np.zeros((codes.shape[1], len(centroids)), np.int64), 0
    for book, code in zip(books, codes):
        wide = book.shape[1]
        partial = np.zeros((len(book), len(centroids)), np.int64)
        for j in range(wide):
            partial += (book[:, j, None] - centroids[None, :, lo + j]) ** 2
        total += partial[code]
        lo += wide
    cluster = total.argmin(axis=1)
    return cluster, np.take_along_axis(total, cluster[:, None], 1)[:, 0]


def _sums(chunks: DataFrame, centroids: np.ndarray, width: int) -> list:
    """For each cluster that has vectors: how many, and their sum by dimension."""
    k, dims = centroids.shape
    shared = chunks.sparkSession.sparkContext.broadcast(centroids)  # `clusters` vectors

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, sums = np.zeros(k, np.int64), np.zeros((k, dims), np.int64)
        for _, books, codes in _unpacked(batches, dims, width):
            cluster, _ = nearest(books, codes, shared.value)
            count += np.bincount(cluster, minlength=k)
            lo = 0
            for book, code in zip(books, codes):
                times = np.bincount(cluster * len(book) + code, minlength=k * len(book)).reshape(k, len(book))
                sums[:, lo : lo + book.shape[1]] += times @ book
                lo += book.shape[1]
        seen = np.flatnonzero(count)
        dim = np.tile(np.arange(dims), len(seen))
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(seen, dims)), pa.array(dim), pa.array(np.repeat(count[seen], dims)), pa.array(sums[seen].reshape(-1))], names=["cluster", "dim", "n", "total"])

    parts = chunks.select("ids", "sizes", "books", "codes").mapInArrow(add, "cluster long, dim long, n long, total long")
    return parts.groupBy("cluster", "dim").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).collect()  # clusters x dims rows


def _assigned(chunks: DataFrame, centroids: np.ndarray, width: int) -> DataFrame:
    """(id, cluster, distance) of every vector."""
    dims = centroids.shape[1]
    shared = chunks.sparkSession.sparkContext.broadcast(centroids)  # `clusters` vectors
    kind = chunks.schema["ids"].dataType.elementType
    schema = T.StructType([T.StructField("id", kind), T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        out = to_arrow_schema(schema)
        for ids, books, codes in _unpacked(batches, dims, width):
            cluster, distance = nearest(books, codes, shared.value)
            yield pa.RecordBatch.from_arrays([ids.cast(out.field("id").type), pa.array(cluster.astype(np.int32)), pa.array(distance)], schema=out)

    return chunks.mapInArrow(assign, schema)


def first_centroids(vectors: DataFrame, clusters: int, seed: int) -> np.ndarray:
    """The vectors of ``vectors`` (id, v) with the smallest hashes of their ids, in that order."""
    h = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("id").cast("string")).cast("binary"), 256)
    rows = vectors.select(h.alias("h"), "v").orderBy(F.asc_nulls_last("h"), "v").limit(clusters).collect()  # `clusters` rows
    return np.array([r["v"] for r in rows], np.int64)


def cluster(
    vectors: DataFrame, key: str = "vec_id", vector: str = "embedding", dims: int = 64, scale: int = 64, clusters: int = 16, rounds: int = 3, seed: int = 1,
    width: int = WIDTH, chunk: int = CHUNK,
) -> tuple[DataFrame, np.ndarray]:
    """(key, cluster, distance, cluster_inertia, inertia) of every kept vector, and the final centroids."""
    kept = quantised(vectors, key, vector, dims, scale)
    centroids = first_centroids(kept, clusters, seed)
    if not len(centroids):
        empty = kept.select(F.col("id").alias(key), *[F.lit(0).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"))])
        return empty.limit(0), centroids.reshape(0, dims)
    if np.abs(centroids).max() >= LARGEST:
        raise ValueError(f"a component times the scale is not within {LARGEST} of zero")
    chunks = materialize(dictionaries(kept, dims, width, chunk), "dictionaries")
    for _ in range(rounds):
        for r in _sums(chunks, centroids, width):
            centroids[r["cluster"], r["dim"]] = int(r["total"]) // r["n"]  # floors, in whole numbers
    final = materialize(_assigned(chunks, centroids, width), "assigned")
    by = final.groupBy("cluster").agg(F.sum("distance").alias("cluster_inertia"))
    inertia = by.agg(F.sum("cluster_inertia")).first()[0]  # one number
    rows = final.join(F.broadcast(by), "cluster")  # a row a cluster
    return rows.select(F.col("id").alias(key), "cluster", "distance", "cluster_inertia", F.lit(inertia).cast("long").alias("inertia")), centroids


def digests(centroids: np.ndarray) -> list[str]:
    """The lower-case hex sha256 of each centroid's components, joined by commas."""
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
