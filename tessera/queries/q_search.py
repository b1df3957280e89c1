"""Document and vector search (V1-V6) on the driver tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import search as V
from ..tables import table
from . import register

_E = "WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)"


def _emb(spark, d):
    return table(spark, d, "embeddings")


@register("v01_similarity_top_k", f"""
{_E},
s AS (SELECT q.vec_id AS qid, x.vec_id AS did, list_cosine_similarity(q.v, x.v) AS score FROM e q, e x),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, did) AS rank FROM s)
SELECT qid, did, round(score, 9) AS score, rank FROM r WHERE rank <= 5""")
def v01(spark, d):
    e = _emb(spark, d)
    r = V.similarity_search(e.withColumnRenamed("vec_id", "qid"), e.withColumnRenamed("vec_id", "did"),
                            "qid", "embedding", "did", "embedding", k=5)
    return r.withColumn("score", F.round("score", 9))


@register("v02_similarity_threshold", f"""
{_E},
s AS (SELECT q.vec_id AS qid, x.vec_id AS did, list_cosine_similarity(q.v, x.v) AS score FROM e q, e x),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, did) AS rank FROM s WHERE score >= 0.3)
SELECT qid, did, round(score, 9) AS score, rank FROM r WHERE rank <= 10""")
def v02(spark, d):
    e = _emb(spark, d)
    r = V.similarity_search(e.withColumnRenamed("vec_id", "qid"), e.withColumnRenamed("vec_id", "did"),
                            "qid", "embedding", "did", "embedding", k=10, threshold=0.3)
    return r.withColumn("score", F.round("score", 9))


def _mmr_sql(k: int = 5, pool: int = 20, diversity: float = 0.25) -> str:
    """Greedy MMR unrolled into one CTE per pick (oracle for V3)."""
    lam = 1.0 - diversity
    ctes = [
        "e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings)",
        "s AS (SELECT q.vec_id AS qid, x.vec_id AS did, list_cosine_similarity(q.v, x.v) AS score FROM e q, e x)",
        f"p AS (SELECT qid, did, score FROM (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, did) "
        f"AS r FROM s) WHERE r <= {pool})",
        "pv AS (SELECT p.*, e.v FROM p JOIN e ON p.did = e.vec_id)",
        f"k1 AS (SELECT qid, did, score, 1 AS mmr_rank FROM (SELECT *, row_number() OVER (PARTITION BY qid "
        f"ORDER BY round({lam!r} * score, 9) DESC, did) AS r FROM pv) WHERE r = 1)",
    ]
    for i in range(2, k + 1):
        prev = " UNION ALL ".join(f"SELECT * FROM k{j}" for j in range(1, i))
        ctes.append(
            f"k{i} AS (SELECT qid, did, score, {i} AS mmr_rank FROM ("
            f"SELECT c.qid, c.did, c.score, row_number() OVER (PARTITION BY c.qid ORDER BY "
            f"round({lam!r} * c.score - {diversity!r} * max(list_cosine_similarity(c.v, pk.v)), 9) DESC, c.did) AS r "
            f"FROM pv c JOIN ({prev}) picked ON picked.qid = c.qid JOIN e pk ON pk.vec_id = picked.did "
            f"WHERE NOT EXISTS (SELECT 1 FROM ({prev}) z WHERE z.qid = c.qid AND z.did = c.did) "
            f"GROUP BY c.qid, c.did, c.score) WHERE r = 1)")
    union = " UNION ALL ".join(f"SELECT * FROM k{j}" for j in range(1, k + 1))
    return "WITH " + ",\n".join(ctes) + f"\nSELECT qid, did, round(score, 9) AS score, CAST(mmr_rank AS BIGINT) AS mmr_rank FROM ({union})"


@register("v03_mmr", _mmr_sql())
def v03(spark, d):
    e = _emb(spark, d)
    r = V.mmr_search(e.withColumnRenamed("vec_id", "qid"), e.withColumnRenamed("vec_id", "did"),
                     "qid", "embedding", "did", "embedding", k=5, pool=20, diversity=0.25)
    return r.withColumn("score", F.round("score", 9))


_HYB = r"""
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
d AS (SELECT doc_id AS did, text, e.v FROM documents LEFT JOIN e ON doc_id = e.vec_id),
q AS (SELECT item_id AS qid, text, e.v FROM benchmark LEFT JOIN e ON item_id = e.vec_id),
dt AS (SELECT did, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS term FROM d),
tf AS (SELECT did, term, count(*) AS tf FROM dt GROUP BY 1, 2),
dl AS (SELECT did, count(*) AS dl FROM dt GROUP BY 1),
st AS (SELECT count(*) AS n, avg(dl) AS avgdl FROM dl),
dfq AS (SELECT term, count(*) AS df FROM tf GROUP BY 1),
qt AS (SELECT DISTINCT qid, term FROM (SELECT qid, unnest(regexp_extract_all(lower(text), '\p{L}+')) AS term FROM q)),
sc AS (SELECT qid, tf.did, sum(ln(1 + (n - df + 0.5) / (df + 0.5)) * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * dl / avgdl))) AS score
       FROM qt JOIN tf ON qt.term = tf.term JOIN dl ON tf.did = dl.did JOIN dfq ON tf.term = dfq.term, st GROUP BY 1, 2),
kw AS (SELECT qid, did, score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, did) AS rank FROM sc),
vs AS (SELECT q.qid, d.did, list_cosine_similarity(q.v, d.v) AS score FROM q, d WHERE q.v IS NOT NULL AND d.v IS NOT NULL),
vr AS (SELECT qid, did, score, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, did) AS rank FROM vs)"""


@register("v04_keyword_bm25", _HYB + """
SELECT qid, did, round(score, 9) AS score, rank FROM kw WHERE rank <= 10""")
def v04k(spark, d):
    q, docs, _, _ = _hybrid_inputs(spark, d)
    r = V.bm25_search(q, docs, "qid", "text", "did", "text", k=10)
    return r.withColumn("score", F.round("score", 9))


@register("v04_hybrid_rrf", _HYB + """,
fused AS (SELECT qid, did, sum(1.0 / (60 + rank)) AS rrf_score
          FROM (SELECT qid, did, rank FROM kw WHERE rank <= 4 UNION ALL SELECT qid, did, rank FROM vr WHERE rank <= 4)
          GROUP BY 1, 2),
fr AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(rrf_score, 9) DESC, did) AS rank FROM fused)
SELECT qid, did, round(rrf_score, 9) AS rrf_score, rank FROM fr WHERE rank <= 10""")
def v04h(spark, d):
    q, docs, qv, dv = _hybrid_inputs(spark, d)
    r = V.hybrid_search(q, docs, "qid", "text", "embedding", "did", "text", "embedding", k=10, query_vectors=qv, doc_vectors=dv)
    return r.withColumn("rrf_score", F.round("rrf_score", 9))


def _hybrid_inputs(spark, d):
    """Texts of queries and documents, and the vectors of those that have one."""
    q = table(spark, d, "benchmark").select(F.col("item_id").alias("qid"), "text")
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("did"), "text")
    e = _emb(spark, d)
    vectors = [e.select(F.col("vec_id").alias(k), "embedding").join(t.select(k), k, "left_semi") for k, t in (("qid", q), ("did", docs))]
    return q, docs, *vectors


@register("v05_metadata_filter", f"""
{_E},
s AS (SELECT q.vec_id AS qid, x.vec_id AS did, list_cosine_similarity(q.v, x.v) AS score FROM e q, e x
      WHERE x.label IN (1, 2, 3)),
r AS (SELECT *, row_number() OVER (PARTITION BY qid ORDER BY round(score, 9) DESC, did) AS rank FROM s)
SELECT qid, did, round(score, 9) AS score, rank FROM r WHERE rank <= 5""")
def v05(spark, d):
    e = _emb(spark, d)
    r = V.similarity_search(e.withColumnRenamed("vec_id", "qid"), e.withColumnRenamed("vec_id", "did"),
                            "qid", "embedding", "did", "embedding", k=5, doc_filter=F.col("label").isin(1, 2, 3))
    return r.withColumn("score", F.round("score", 9))


@register("v06_build_index", """
SELECT doc_id, lang, source, CAST(i AS INTEGER) AS chunk_no, substr(text, i * 2000 + 1, 2000) AS chunk,
       e.vec_id IS NOT NULL AS has_vector
FROM documents, LATERAL (SELECT unnest(range(0, CAST(greatest(ceil(length(text) / 2000), 1) AS BIGINT))) AS i)
LEFT JOIN embeddings e ON doc_id = e.vec_id""")
def v06(spark, d):
    docs = table(spark, d, "documents")
    idx = V.build_index(docs, "doc_id", "text", 2000, ["lang", "source"], vectors=_emb(spark, d),
                        vec_id="vec_id", vec_col="embedding")
    return idx.select("doc_id", "lang", "source", "chunk_no", "chunk", F.col("vector").isNotNull().alias("has_vector"))
