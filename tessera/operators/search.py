"""Batch document and vector search (V1-V6): a table of queries against a
table of documents.

Vector scoring never materialises the (query, document) product. Queries
and documents are hashed into blocks; each query block meets each document
block once in a cogrouped ``applyInArrow`` that multiplies the two
L2-normalised matrices with numpy, a tile at a time, and emits only the block's
top-k per query.
The final top-k per query is a ``row_number() <= k`` over at most
``doc_blocks * k`` candidates (planned with a partial group limit). Block
counts are derived from the table sizes so a task holds bounded vectors.

Keyword scoring (BM25): each text's words are sorted and counted in the task
that reads it, so that only postings of query terms leave it; document
frequencies are aggregates, and query terms meet postings in an equi-join on
the term (AQE splits hot terms). Bounds on
what a term can add keep very common terms out of that join, but for the
documents that can still be among the best.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import DoubleType, LongType, StructField, StructType

from .common import written

MAX_BLOCK_CELLS = 1_000_000_000  # query rows x document rows scored in one task, tile by tile
MAX_BLOCK_BYTES = 32_000_000  # one side's vectors of a task, as doubles
TILE_QUERIES, TILE_DOCS = 256, 4096  # scores held at once: 8 MB
FIRST_DOCS = 2048  # documents of a block's first tile, which sets the scores to beat


def l2_normalize(v) -> Column:
    """Unit-length ``array<double>``; a zero vector stays zero."""
    x = F.col(v) if isinstance(v, str) else v
    x = F.transform(x, lambda e: e.cast("double"))
    norm = F.sqrt(F.aggregate(x, F.lit(0.0), lambda acc, e: acc + e * e))
    return F.when(norm > 0, F.transform(x, lambda e: e / norm)).otherwise(x)


def dot(a, b) -> Column:
    """Dot product of two arrays, JVM-side."""
    a = F.col(a) if isinstance(a, str) else a
    b = F.col(b) if isinstance(b, str) else b
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0),
                       lambda acc, x: acc + x)


def cosine(a, b) -> Column:
    return dot(l2_normalize(a), l2_normalize(b))


def _blocks(n_q: int, n_d: int, parallelism: int, dim: int = 1) -> tuple[int, int]:
    """Query and document block counts.

    Every (query block, document block) pair is one task scoring at most
    ``MAX_BLOCK_CELLS`` pairs and holding about ``MAX_BLOCK_BYTES`` of vectors
    of either side, so at least T = Q*D/cells tasks (and at least
    ``parallelism``) are needed. Queries are copied once per document block
    and documents once per query block; Q*Bd + D*Bq is smallest when
    Q*Bd = D*Bq, i.e. Bq = sqrt(T*Q/D), Bd = sqrt(T*D/Q).
    """
    n_q, n_d = max(1, n_q), max(1, n_d)
    held = max(1, MAX_BLOCK_BYTES // (8 * max(1, dim)))
    tasks = max(parallelism, math.ceil(n_q * n_d / MAX_BLOCK_CELLS))
    bq = max(math.ceil(n_q / held), min(n_q, round(math.sqrt(tasks * n_q / n_d))), 1)
    bd = max(math.ceil(n_d / held), min(n_d, math.ceil(tasks / bq)), 1)
    # keep each task's pairs bounded after rounding
    while math.ceil(n_q / bq) * math.ceil(n_d / bd) > MAX_BLOCK_CELLS and bd < n_d:
        bd += 1
    return bq, bd


def _floats(df: DataFrame, v: str) -> Column:
    """The vector as it is stored where that is float, otherwise as doubles."""
    return F.col(v) if dict(df.dtypes)[v] == "array<float>" else F.col(v).cast("array<double>")


def _matrix(v: pa.ChunkedArray, unit: bool = True) -> np.ndarray:
    """Vectors of an Arrow column as rows of doubles, of length one (a zero vector stays zero)."""
    m = v.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype("float64").reshape(len(v), -1)
    if unit:
        norm = np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]
        np.divide(m, norm, out=m, where=norm > 0)
    return m


def _best_of_tiles(qm: np.ndarray, dm: np.ndarray, k: int, threshold: float | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query row, document row, score) of each query's ``k`` best documents, ties to the earlier row.

    Scores are compared rounded to 9 places, so that ties do not depend on BLAS
    summation order. Tiles go by document row: a later document enters only
    above the k-th score so far, never on a tie.
    """
    finite = np.isfinite(qm).all() and np.isfinite(dm).all()
    floor = -np.inf if threshold is None else threshold
    found = []
    for q0 in range(0, len(qm), TILE_QUERIES):
        q = qm[q0:q0 + TILE_QUERIES]
        best = (np.empty(0, "int64"), np.empty(0, "int64"), np.empty(0))
        kth = np.full(len(q), -np.inf)
        d0 = 0
        while d0 < len(dm):
            d1 = d0 + (TILE_DOCS if d0 else FIRST_DOCS)
            s = q @ dm[d0:d1].T
            if not finite:
                s[~np.isfinite(s)] = -np.inf
            # what rounds above the k-th score so far
            least = np.maximum(kth + 4e-10, floor)
            if not d0 and s.shape[1] > k:
                least = np.maximum(least, np.partition(s, -k, axis=1)[:, -k] - 1e-9)
            flat = np.flatnonzero(s >= least[:, None])
            vals = s.ravel()[flat]
            rows, cols = np.divmod(flat, s.shape[1])
            keep = (np.round(vals, 9) > kth[rows]) & (vals > -np.inf)
            if keep.any():
                rows, cols, vals = (np.concatenate([x, y]) for x, y in zip(best, (rows[keep], cols[keep] + d0, vals[keep])))
                # stable: the earlier document first on ties
                order = np.lexsort((cols, -np.round(vals, 9), rows))
                rows, cols, vals = rows[order], cols[order], vals[order]
                place = np.arange(len(rows)) - np.searchsorted(rows, np.arange(len(q)))[rows]
                best = tuple(x[place < k] for x in (rows, cols, vals))
                last = place == k - 1
                kth[rows[last]] = np.round(vals[last], 9)
            d0 = d1
        found.append((best[0] + q0, best[1], best[2]))
    return tuple(np.concatenate(x) for x in zip(*found))


_CAND_SCHEMA = StructType([StructField("__qid", LongType()), StructField("__did", LongType()),
                           StructField("score", DoubleType())])


def similarity_search(
    queries: DataFrame, docs: DataFrame, q_id: str, q_vec: str, d_id: str, d_vec: str, k: int = 10,
    threshold: float | None = None, doc_filter: Column | None = None, blocks: tuple[int, int] | None = None,
) -> DataFrame:
    """SIMILARITY / SIMILARITY_THRESHOLD search: the ``k`` best documents per query by cosine.

    Returns (``q_id``, ``d_id``, score, rank); rank 1 is the best, ties go to
    the smaller document id. ``doc_filter`` (V5) applies before scoring;
    ``threshold`` drops scores below it before ranking. Ids must be integers.
    """
    if doc_filter is not None:
        docs = docs.filter(doc_filter)
    qn = queries.select(F.col(q_id).cast("bigint").alias("__qid"), _floats(queries, q_vec).alias("__v"))
    dn = docs.select(F.col(d_id).cast("bigint").alias("__did"), _floats(docs, d_vec).alias("__v"))
    if blocks is None:
        par = int(queries.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        (n_q, dim), (n_d, _) = (x.agg(F.count(F.lit(1)), F.coalesce(F.max(F.size("__v")), F.lit(1))).first() for x in (qn, dn))
        blocks = _blocks(n_q, n_d, par, dim)
    bq, bd = blocks
    # both sides must carry the block keys with the same types, or the cogroup hashes them apart
    qx = qn.withColumns({"__qb": F.pmod(F.xxhash64("__qid"), F.lit(bq)).cast("int"),
                         "__db": F.explode(F.sequence(F.lit(0), F.lit(bd - 1)))})
    dx = dn.withColumns({"__db": F.pmod(F.xxhash64("__did"), F.lit(bd)).cast("int"),
                         "__qb": F.explode(F.sequence(F.lit(0), F.lit(bq - 1)))})
    types = to_arrow_schema(_CAND_SCHEMA)

    def score_block(qp: pa.Table, dp: pa.Table) -> pa.Table:
        if not qp.num_rows or not dp.num_rows:
            return types.empty_table()
        dp = dp.sort_by("__did")
        rows, cols, vals = _best_of_tiles(_matrix(qp["__v"]), _matrix(dp["__v"]), k, threshold)
        return pa.table([qp["__qid"].combine_chunks().take(pa.array(rows)), dp["__did"].combine_chunks().take(pa.array(cols)),
                         pa.array(vals)], schema=types)

    cand = qx.groupBy("__qb", "__db").cogroup(dx.groupBy("__qb", "__db")).applyInArrow(score_block, _CAND_SCHEMA)
    w = Window.partitionBy("__qid").orderBy(F.desc(F.round("score", 9)), F.asc("__did"))
    top = cand.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.select(F.col("__qid").alias(q_id), F.col("__did").alias(d_id), "score", F.col("rank").cast("bigint").alias("rank"))


def mmr_search(queries: DataFrame, docs: DataFrame, q_id: str, q_vec: str, d_id: str, d_vec: str, k: int = 10,
               pool: int = 20, diversity: float = 0.25) -> DataFrame:
    """MMR: from the ``pool`` most similar documents, pick ``k`` greedily by
    ``(1 - diversity) * sim(q, d) - diversity * max sim(d, already picked)``.

    The greedy step takes the pools of many queries at once, as the rows come
    sorted by query: a batch of rows and one pool are held.
    """
    cand = similarity_search(queries, docs, q_id, q_vec, d_id, d_vec, k=pool)
    vecs = docs.select(F.col(d_id).cast("bigint").alias(d_id), _floats(docs, d_vec).alias("__v"))
    j = cand.join(vecs, d_id).select(q_id, d_id, "score", "rank", "__v")
    schema = StructType([StructField(q_id, LongType()), StructField(d_id, LongType()),
                         StructField("score", DoubleType()), StructField("mmr_rank", LongType())])
    types = to_arrow_schema(schema)

    def starts(t: pa.Table) -> np.ndarray:
        q = t[q_id].to_numpy()
        return np.flatnonzero(np.concatenate([[True], q[1:] != q[:-1]]))

    def picks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last query's pool may go on in the next batch
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b])
            t = t if held is None else pa.concat_tables([held, t])
            cut = int(starts(t)[-1])
            held = t.slice(cut).combine_chunks()
            if cut:
                yield from pick(t.slice(0, cut))
        if held is not None:
            yield from pick(held)

    def pick(t: pa.Table) -> list[pa.RecordBatch]:
        chosen = _mmr(starts(t), t[d_id].to_numpy(), t["score"].to_numpy(), _matrix(t["__v"]), k, diversity)
        return pa.table([t[q_id].take(pa.array(chosen[0])), t[d_id].take(pa.array(chosen[0])), t["score"].take(pa.array(chosen[0])),
                         pa.array(chosen[1])], schema=types).to_batches()

    return j.repartition(q_id).sortWithinPartitions(q_id, "rank", d_id).mapInArrow(picks, schema)


def _mmr(start: np.ndarray, ids: np.ndarray, sims: np.ndarray, vs: np.ndarray, k: int, diversity: float) -> tuple[np.ndarray, np.ndarray]:
    """Rows picked and their ranks, greedily and side by side in every run of rows beginning at ``start``."""
    sizes = np.diff(np.append(start, len(ids)))
    # runs beside each other, filled up with a repeat of their first row that is never free
    at = start[:, None] + np.arange(sizes.max())
    free = np.arange(sizes.max()) < sizes[:, None]
    at = np.where(free, at, start[:, None])
    runs, red, made = np.arange(len(start)), np.zeros(at.shape), []
    for rank in range(1, min(k, sizes.max()) + 1):
        # ties independent of float noise, to the smaller id
        val = np.where(free, np.round((1.0 - diversity) * sims[at] - diversity * red, 9), -np.inf)
        top = free & (val == val.max(axis=1, keepdims=True))
        best = np.where(top, ids[at], np.iinfo("int64").max).argmin(axis=1)
        some = free.any(axis=1)
        rows = at[runs, best]
        made.append((rows[some], np.full(some.sum(), rank)))
        free[runs, best] = False
        now = np.einsum("gpd,gd->gp", vs[at], vs[rows])
        red = now if rank == 1 else np.maximum(red, now)
    return tuple(np.concatenate(x) for x in zip(*made))


# Keyword (BM25) --------------------------------------------------------------------------
NO_LETTERS = r"\P{L}+"
PROBE = 20  # postings scored first, for each of a query's k results
SCORE_MARGIN = 1e-6  # scores are compared to 9 places; bounds leave room for the order of summation


def tokens(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, term) rows: lower-cased letter runs of the whole text."""
    return df.select(F.col(id_col).alias("__id"), F.explode(F.split(F.lower(F.col(text_col)), NO_LETTERS)).alias("term")).where("term <> ''")


def document_terms(docs: DataFrame, d_id: str, d_text: str) -> DataFrame:
    """(__id, term, tf, dl): how often each document has each term, and its length.

    Every text is counted where it is read, without a shuffle: its words are
    sorted, and a term's count is the length of its run. A row with the null
    term and tf = dl stands for the document itself.
    """
    words = F.filter(F.split(F.lower(F.col(d_text)), NO_LETTERS), lambda w: w != "")
    own = docs.select(F.col(d_id).alias("__id"), F.sort_array(words).alias("__w"))
    own = own.where(F.size("__w") > 0).withColumn("dl", F.size("__w"))
    starts = F.filter(F.sequence(F.lit(0), F.col("dl") - 1), lambda i: (i == 0) | (F.get("__w", i) != F.get("__w", i - 1)))
    runs = F.transform(F.col("__at"), lambda i, j: F.struct(
        F.get("__w", i).alias("term"), (F.coalesce(F.get("__at", j + 1), F.col("dl")) - i).alias("tf")))
    whole = F.array(F.struct(F.lit(None).cast("string").alias("term"), F.col("dl").alias("tf")))
    rows = own.withColumn("__at", starts).select("__id", "dl", F.explode(F.concat(whole, runs)).alias("__r"))
    return rows.select("__id", "__r.term", F.col("__r.tf").cast("bigint").alias("tf"), F.col("dl").cast("bigint").alias("dl"))


def postings(qt: DataFrame, docs: DataFrame, d_id: str, d_text: str, k1: float, b: float) -> DataFrame:
    """(term, __id, __s, __n): the BM25 share, without its idf, of every query term in every document that has it.

    ``__n`` is the number of documents with a token. The texts are read once
    and the postings written once. Rows that repeat an id are one document;
    only where there are such rows do the counts travel, by id.
    """
    wanted = written(qt.select("term").distinct()).withColumn("__w", F.lit(True))
    counts = document_terms(docs, d_id, d_text).join(wanted, "term", "left")
    counts = counts.where("__w OR term IS NULL").select("__id", "term", "tf", "dl")
    if docs.groupBy(d_id).agg(F.count(F.lit(1)).alias("n")).where("n > 1").limit(1).count():
        counts = counts.repartition("__id").groupBy("__id", "term").agg(F.sum("tf").alias("tf"))
        counts = counts.withColumn("dl", F.max(F.when(F.col("term").isNull(), F.col("tf"))).over(Window.partitionBy("__id")))
    counts = written(counts)
    n, avgdl = counts.where("term IS NULL").agg(F.count(F.lit(1)), F.avg("tf")).first()
    share = F.col("tf") * (k1 + 1) / (F.col("tf") + k1 * (1 - b + b * F.col("dl") / F.lit(avgdl or 1.0)))
    return counts.where("term IS NOT NULL").select("term", "__id", share.alias("__s"), F.lit(n).cast("bigint").alias("__n"))


def _scores(terms: DataFrame, post: DataFrame) -> DataFrame:
    # a document with a null id counts for its terms' frequencies, but is no result
    hits = terms.select("__qid", "term", "idf").join(post.where("__id IS NOT NULL"), "term")
    return hits.groupBy("__qid", "__id").agg(F.sum(F.col("idf") * F.col("__s")).alias("__s"))


def _kth_best(scored: DataFrame, k: int) -> DataFrame:
    """(__qid, __tau): the k-th best score of each query that has k scores."""
    w = Window.partitionBy("__qid").orderBy(F.desc("__s"))
    best = scored.withColumn("__r", F.row_number().over(w)).where(F.col("__r") <= k)
    return best.groupBy("__qid").agg(F.min("__s").alias("__tau"), F.count(F.lit(1)).alias("__n")).where(
        F.col("__n") == k).drop("__n")


def term_plan(qt: DataFrame, post: DataFrame, k: int) -> DataFrame:
    """(__qid, term, df, u, idf, essential): the terms of each query by whether they can lift a document into its top ``k``.

    A query's rarest terms are scored first; the k-th best of these scores is
    a floor of the final k-th best. The terms whose greatest shares (``u``),
    the smallest first, add up to less than that floor cannot reach it alone.
    """
    heads = post.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.max("__s").alias("__most"), F.max("__n").alias("__n"))
    idf = F.log(F.lit(1.0) + (F.col("__n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    heads = heads.withColumn("idf", idf).select("term", "df", "idf", (F.col("idf") * F.col("__most")).alias("u"))
    by_df = Window.partitionBy("__qid").orderBy("df", "term").rowsBetween(Window.unboundedPreceding, -1)
    by_u = Window.partitionBy("__qid").orderBy("u", "term").rowsBetween(Window.unboundedPreceding, 0)
    terms = written(qt.join(heads, "term").withColumns(
        {"__before": F.coalesce(F.sum("df").over(by_df), F.lit(0)), "__reach": F.sum("u").over(by_u)}))
    floor = _kth_best(_scores(terms.where(F.col("__before") < PROBE * k), post), k)
    essential = F.col("__tau").isNull() | (F.col("__reach") >= F.col("__tau") - SCORE_MARGIN)
    return written(terms.join(floor, "__qid", "left").select("__qid", "term", "df", "u", "idf", essential.alias("essential")))


def bm25_search(queries: DataFrame, docs: DataFrame, q_id: str, q_text: str, d_id: str, d_text: str,
                k: int = 10, k1: float = 1.2, b: float = 0.75) -> DataFrame:
    """BM25 keyword search: the ``k`` best documents per query.

    idf = ln(1 + (N - df + 0.5) / (df + 0.5)); each distinct query term counts
    once. Only the postings of a query's essential terms (``term_plan``) are
    scored in full; its other terms, the very common ones, are looked up just
    for the documents that can still reach the top ``k``. The rows are those
    of scoring everything.
    """
    qt = written(tokens(queries, q_id, q_text).distinct().withColumnRenamed("__id", "__qid"))
    post = postings(qt, docs, d_id, d_text, k1, b)
    plan = term_plan(qt, post, k)
    part = written(_scores(plan.where("essential"), post))
    rest = plan.where("NOT essential")
    slack = rest.groupBy("__qid").agg(F.sum("u").alias("__rest"))
    bound = slack.join(_kth_best(part, k), "__qid", "left")
    near = part.join(bound, "__qid", "left").where(
        F.col("__rest").isNull() | F.col("__tau").isNull() | (F.col("__s") + F.col("__rest") >= F.col("__tau") - SCORE_MARGIN))
    near = written(near.select("__qid", "__id", "__s"))
    more = near.select("__qid", "__id").join(rest.select("__qid", "term", "idf"), "__qid").join(post, ["term", "__id"])
    scored = near.unionByName(more.select("__qid", "__id", (F.col("idf") * F.col("__s")).alias("__s"))).groupBy("__qid", "__id").agg(F.sum("__s").alias("score"))
    w = Window.partitionBy("__qid").orderBy(F.desc(F.round("score", 9)), F.asc("__id"))
    top = scored.withColumn("rank", F.row_number().over(w)).filter(F.col("rank") <= k)
    return top.select(F.col("__qid").alias(q_id), F.col("__id").alias(d_id), "score", F.col("rank").cast("bigint").alias("rank"))


def hybrid_search(queries: DataFrame, docs: DataFrame, q_id: str, q_text: str, q_vec: str, d_id: str, d_text: str,
                  d_vec: str, k: int = 10, rrf_constant: int = 60, rrf_window: int = 4,
                  query_vectors: DataFrame | None = None, doc_vectors: DataFrame | None = None) -> DataFrame:
    """HYBRID: reciprocal rank fusion of the keyword and vector rankings.

    Each list contributes ``1 / (rrf_constant + rank)`` for its top
    ``rrf_window`` documents; the ``k`` best fused documents are returned.
    Vectors kept in tables of their own come as ``query_vectors`` (``q_id``,
    ``q_vec``) and ``doc_vectors`` (``d_id``, ``d_vec``), so that no text
    travels to meet its vector.
    """
    query_vectors = queries if query_vectors is None else query_vectors
    doc_vectors = docs if doc_vectors is None else doc_vectors
    kw = bm25_search(queries, docs, q_id, q_text, d_id, d_text, k=rrf_window)
    # a document or query without a vector still takes part by its words
    vec = similarity_search(query_vectors.where(F.col(q_vec).isNotNull()), doc_vectors.where(F.col(d_vec).isNotNull()), q_id, q_vec, d_id, d_vec, k=rrf_window)
    both = kw.select(q_id, d_id, "rank").unionByName(vec.select(q_id, d_id, "rank"))
    fused = both.groupBy(q_id, d_id).agg(F.sum(F.lit(1.0) / (F.lit(rrf_constant) + F.col("rank"))).alias("rrf_score"))
    w = Window.partitionBy(q_id).orderBy(F.desc(F.round("rrf_score", 9)), F.asc(d_id))
    return fused.withColumn("rank", F.row_number().over(w).cast("bigint")).filter(F.col("rank") <= k)


# V6 --------------------------------------------------------------------------------------------
def build_index(docs: DataFrame, id_col: str, text_col: str, chunk_chars: int = 500, metadata=(),
                vectors: DataFrame | None = None, vec_id: str | None = None, vec_col: str | None = None) -> DataFrame:
    """Index table: fixed-size character chunks of each whole text, metadata, unit vector.

    Every character of every text lands in exactly one chunk.
    """
    n = F.greatest(F.ceil(F.length(text_col) / F.lit(chunk_chars)), F.lit(1))
    chunks = docs.select(F.col(id_col), *metadata, F.col(text_col),
                         F.explode(F.sequence(F.lit(0), (n - 1).cast("int"))).alias("chunk_no"))
    chunks = chunks.select(id_col, *metadata, "chunk_no",
                           F.substr(F.col(text_col), F.col("chunk_no") * chunk_chars + 1, F.lit(chunk_chars)).alias("chunk"))
    if vectors is not None:
        v = vectors.select(F.col(vec_id).alias(id_col), l2_normalize(vec_col).alias("vector"))
        chunks = chunks.join(v, id_col, "left")
    return chunks


def write_index(index: DataFrame, path: str, partition_by=()) -> None:
    index.write.mode("overwrite").partitionBy(*partition_by).parquet(path)
