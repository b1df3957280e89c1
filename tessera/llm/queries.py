"""The registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.tables import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql:
            ORACLE[name] = sql.strip()
        return fn

    return add


@query("op9_bpe")
def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of every document's ids and of the bytes that they decode to."""
    import public_tokenizers

    from tessera.llm.op9_bpe import encode_decode

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return encode_decode(docs, path, public_tokenizers.PATTERN, ("n_tokens", "ids_sha256", "decoded_sha256"))


OP3_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
i AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
iw AS (SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(ws[p:p + least(len(ws), 10) - 1], ' ') AS win
       FROM (SELECT *, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS p FROM i WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT doc_id, n, p, array_to_string(ws[p:p + n - 1], ' ') AS win
       FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM w, sizes WHERE len(ws) >= n)),
hit AS (SELECT doc_id, dw.n, p, item_id FROM dw JOIN iw ON dw.n = iw.n AND dw.win = iw.win),
words AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS k FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query("op3_decontaminate", OP3_SQL)
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of 10 words in every document."""
    from tessera.llm.op3_decontaminate import mark

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    items = table(spark, sf_dir, "benchmark").select("item_id", "text")
    return mark(docs, items, window=10, keep_text=False).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


@query("op8_quality")
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rules and the trees' verdict on every document."""
    from tessera.llm.op8_quality import COUNTS, fit, judge

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    trees = fit(docs, table(spark, sf_dir, "labels"))
    return judge(docs, trees, keep_text=False).select("doc_id", *COUNTS, "base_failed", "kept", "score")


OP10_SQL = """
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                 '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(ws[p:p + 3], ' ') AS g
      FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS p FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS MATERIALIZED (SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 85 * (x.n + y.n - k)),
reach AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) c USING (doc_id)
"""


@query("op10_ngram_join", OP10_SQL)
def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingle counts and the component of every document at a similarity of 85 %."""
    from tessera.llm.op10_ngram_join import groups

    return groups(table(spark, sf_dir, "documents"), n=4, percent=85)


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the bytes of 400-byte strings that start elsewhere too."""
    from tessera.llm.op6_suffix_dedup import remove_repeats

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return remove_repeats(docs, 400, want=("n_bytes", "n_kept", "n_removed", "n_spans", "kept_sha256"))


@query("op1_sharding")
def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in 16 shards of nearly equal bytes."""
    from tessera.llm.op1_sharding import shard_by_bytes

    return shard_by_bytes(table(spark, sf_dir, "documents").select("doc_id", "text"), 16)


OP5_SQL = """
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, CAST(octet_length(encode(html)) AS BIGINT) AS n, sha1(html) AS hex FROM p),
b AS (SELECT *, array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        1 + ((CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INT), 5) AS INT) >> CAST(15 - 5 * (i % 4) AS INT)) & 31), 1) FOR i IN range(0, 32)], '') AS digest,
      min(page_id) OVER (PARTITION BY hex) AS first FROM d)
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM b
"""


@query("op5_warc", OP5_SQL)
def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to archives and read back: responses with their payloads, revisits by their headers."""
    from tessera.llm.op5_warc import read_archives, write_archives

    folder = write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    responses = read_archives(spark, folder).where("warc_type = 'response'").withColumn("n", F.octet_length("payload").cast("long"))
    revisits = read_archives(spark, folder, payload=False).where("warc_type = 'revisit'").withColumn("n", F.col("payload_length"))
    page = lambda c: F.regexp_extract(c, "^<urn:page:(.*)>$", 1).cast("long")
    return responses.unionByName(revisits).select(
        page("record_id").alias("page_id"),
        F.col("n").alias("payload_bytes"),
        "payload_digest",
        F.col("warc_type").alias("record_type"),
        page("refers_to").alias("refers_to"),
    )


@query("op2_langid")
def op2_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every whole text; learnt where crc32(doc_id) mod 5 is not 0."""
    from tessera.llm.common import crc_mod
    from tessera.llm.op2_langid import fit, predict

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = crc_mod("doc_id", 5) == 0
    model = fit(docs, ~held_out)
    return predict(docs.select("doc_id", "text"), model, keep_text=False).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op7_toxicity")
def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every whole text; labels are learnt where crc32(doc_id) mod 4 is not 2."""
    from tessera.llm.common import crc_mod
    from tessera.llm.op7_toxicity import fit, score

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = crc_mod("doc_id", 4) == 2
    model = fit(docs, table(spark, sf_dir, "labels"), ~held_out)
    return score(docs, model, keep_text=False).select("doc_id", held_out.alias("held_out"), "score", "predicted")


OP4_SQL = """
WITH t0 AS (SELECT conv_id, turn, CAST(floor(turn / 64) AS BIGINT) AS segment, replace(coalesce(role, 'unknown'), '<|', '< |') AS role,
                  replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
t AS (SELECT *, (row_number() OVER (PARTITION BY conv_id, segment ORDER BY turn, role, text) - 1) // 64 AS part FROM t0),
s AS (SELECT DISTINCT conv_id, role AS speaker FROM t WHERE role <> 'system'),
p AS (SELECT t.conv_id, speaker, segment, part, turn, role, text, role = speaker AS own,
        CASE WHEN role = speaker THEN '<|assistant|>' WHEN role = 'system' THEN '<|system|>' ELSE '<|user name=' || role || '|>' END || chr(10) AS head,
        text || '<|end|>' || chr(10) AS body
      FROM t JOIN s ON t.conv_id IS NOT DISTINCT FROM s.conv_id),
o AS (SELECT *, sum(length(head) + length(body)) OVER (PARTITION BY conv_id, speaker, segment, part ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING) AS stop FROM p)
SELECT conv_id, speaker, segment, part, count(*) AS n_turns, CAST(sum(CAST(own AS INT)) AS BIGINT) AS n_spoken,
       md5(string_agg(head || body, '' ORDER BY turn, role, text)) AS rendered_md5,
       coalesce(string_agg(CASE WHEN own THEN CAST(stop - length(body) AS BIGINT) || '-' || CAST(stop AS BIGINT) END, ',' ORDER BY turn, role, text), '') AS masks
FROM o GROUP BY conv_id, speaker, segment, part
"""


@query("op4_chat", OP4_SQL)
def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation from every participant's side, with the masks of that side's turns."""
    from tessera.llm.op4_chat import rotate

    ranges = F.transform("masks", lambda m: F.concat_ws("-", m["start"].cast("string"), m["end"].cast("string")))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return rotate(turns).select(
        "conv_id", "speaker", "segment", "part", "n_turns", "n_spoken", F.md5(F.col("rendered").cast("binary")).alias("rendered_md5"), F.array_join(ranges, ",").alias("masks")
    )


# rank is a long with nulls, which pandas shows as float64: so does this side
OP11_SQL = """
WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
i AS (SELECT regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark),
step AS (SELECT list(c ORDER BY k) AS tab FROM (SELECT k, list_reduce([k] || range(8), lambda x, j: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c FROM range(256) t(k))),
dw AS (SELECT word, count(*) AS n FROM (SELECT unnest(ws) AS word FROM w) GROUP BY word),
iw AS (SELECT word, count(*) AS n FROM (SELECT unnest(ws) AS word FROM i) GROUP BY word),
hexed AS (SELECT word, hex(encode(word)) AS x FROM (SELECT word FROM dw UNION SELECT word FROM iw)),
coded AS (SELECT word, list_transform(range(len(x) // 2), lambda j: CAST('0x' || substr(x, 2 * j + 1, 2) AS BIGINT)) AS b FROM hexed),
crc AS (SELECT word, xor(list_reduce([4294967295] || b, lambda x, y: xor(x >> 8, tab[xor(x & 255, y) + 1])), 4294967295) % 10000 AS bucket FROM coded, step),
ds AS (SELECT bucket, sum(n) AS s FROM dw JOIN crc USING (word) GROUP BY bucket),
ts AS (SELECT bucket, sum(n) AS t FROM iw JOIN crc USING (word) GROUP BY bucket),
tot AS (SELECT coalesce((SELECT sum(s) FROM ds), 0)::DOUBLE AS big_s, coalesce((SELECT sum(t) FROM ts), 0)::DOUBLE AS big_t),
gain AS (SELECT word, CAST(floor(1000 * ln((coalesce(t, 0)::DOUBLE + 1) * (big_s + 10000) / ((s::DOUBLE + 1) * (big_t + 10000)))) AS BIGINT) AS gain
         FROM crc JOIN ds USING (bucket) LEFT JOIN ts USING (bucket), tot),
weights AS (SELECT doc_id, sum(gain) AS weight FROM (SELECT doc_id, unnest(ws) AS word FROM w) JOIN gain USING (word) GROUP BY doc_id),
scored AS (SELECT w.doc_id, len(ws) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('2024:' || w.doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE))) AS score
           FROM w LEFT JOIN weights USING (doc_id)),
ranks AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n FROM scored WHERE n_features >= 20)
SELECT doc_id, CAST(n_features AS BIGINT) AS n_features, CAST(weight AS BIGINT) AS weight, CAST(score AS BIGINT) AS score,
       CAST(CASE WHEN rank <= 10 * n // 100 THEN rank END AS DOUBLE) AS rank
FROM scored LEFT JOIN ranks USING (doc_id)
"""


@query("op11_resampling", OP11_SQL)
def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of all documents towards the benchmark's words, and the ranks of the tenth that is drawn."""
    from tessera.llm.op11_resampling import ranked

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = ranked(docs, table(spark, sf_dir, "benchmark"), runs=1, buckets=10000, seed=2024, min_words=20, percent=10)
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


OP12_SQL = """
WITH s AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS p FROM s),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
c AS (SELECT key, true AS common FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(common) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (WHERE common IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN c USING (key) GROUP BY doc_id
"""


@query("op12_line_dedup", OP12_SQL)
def op12_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that ten documents and more have."""
    from tessera.llm.op12_line_dedup import drop_common_lines

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_common_lines(docs, min_docs=10, min_chars=1, want=("n_lines", "n_dropped", "kept_sha256"))


def _op13_sql(rounds: int = 3) -> str:
    """Assignment and update, written out for each round."""
    parts = [
        """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * x::DOUBLE) AS BIGINT)) AS v FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64)""",
        "c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS c, v AS m FROM v QUALIFY c < 16)",
    ]
    for r in range(rounds + 1):
        parts.append(
            f"""a{r} AS MATERIALIZED (SELECT vec_id, any_value(v) AS v, min(struct_pack(d := d, c := c)) AS near FROM
  (SELECT vec_id, v, c, list_sum(list_transform(range(1, 65), lambda i: (v[i] - m[i]) * (v[i] - m[i]))) AS d FROM v, c{r}) GROUP BY vec_id)"""
        )
        if r < rounds:
            parts.append(
                f"""u{r} AS (SELECT c, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS m FROM
  (SELECT near.c AS c, i, sum(v[i]) AS s, count(*) AS n FROM a{r}, range(1, 65) t(i) GROUP BY 1, 2) GROUP BY c)"""
            )
            parts.append(f"c{r + 1} AS MATERIALIZED (SELECT c, coalesce(u{r}.m, c{r}.m) AS m FROM c{r} LEFT JOIN u{r} USING (c))")
    return (
        ",\n".join(parts)
        + f"""
SELECT vec_id, CAST(near.c AS INT) AS cluster, CAST(near.d AS BIGINT) AS distance, CAST(sum(near.d) OVER (PARTITION BY near.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(near.d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON c{rounds}.c = near.c"""
    )


@query("op13_centroids", _op13_sql())
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixteen clusters of all vectors after three rounds."""
    from tessera.llm.op13_centroids import cluster, digests

    rows, centroids = cluster(table(spark, sf_dir, "embeddings"), dims=64, scale=64, clusters=16, rounds=3, seed=1)
    of = F.array(*[F.lit(d) for d in digests(centroids)])  # a digest a cluster
    return rows.withColumn("centroid_sha256", of[F.col("cluster")] if len(centroids) else F.lit(""))
