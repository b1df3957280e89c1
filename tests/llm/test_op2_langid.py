import numpy as np
from pyspark.sql import functions as F

from tessera.llm.common import crc_mod
from tessera.llm.op2_langid import fit, kernel, predict, solve
from tessera.llm.queries import QUERIES
from tests.conftest import SF_MID, SF_SMALL


def test_kernel_and_presence_equal_sets(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = fit(docs, F.lit(True), rows=30)
    texts = [b"The quick brown fox", b"", "été la".encode(), b"12 !!"]
    at = np.cumsum([0, *map(len, texts)])
    got = model.presence(np.frombuffer(b"".join(texts), np.uint8), at, model.column())
    for row, raw in zip(got, texts):
        low = bytes(b if 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in raw)
        grams = {low[i : i + n] for n in (1, 2, 3) for i in range(len(low) - n + 1)}
        code = {int.from_bytes(g, "big") + (0, 0, 256, 256 + 65536)[len(g)] for g in grams}
        assert set(model.grams[row > 0].tolist()) == code & set(model.grams.tolist())
    both = got[0] @ model.landmarks
    assert np.allclose(kernel(got, model.landmarks)[0], both / np.sqrt(got[0].sum() * model.landmarks.sum(axis=0)))


def test_all_landmarks_give_exact_kernel_ridge():
    r = np.random.default_rng(1)
    x = (r.random((40, 60)) < 0.4).astype(np.float32)
    y = np.repeat([0, 1], 20)
    landmarks, weights = solve(x, y, np.arange(40), ridge=1e-3)
    k = kernel(x, landmarks).astype(float)
    exact = np.linalg.solve(k / 20 + 1e-3 * np.eye(40), np.where(y[:, None] == [0, 1], 1.0, -1.0) / 20)
    assert np.allclose(k @ weights, k @ exact, atol=1e-2)


def test_odd_rows(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    model = fit(docs, F.lit(True), rows=60)
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 34 !", "x"), (None, "the of and that with", "x"), (5, "the of and that with", "x"), (5, "der die und ich nicht", "x")]
    got = predict(spark.createDataFrame(rows, "doc_id long, text string, score string"), model).collect()
    assert len(got) == 6 and all(0 <= r["score"] <= 1 for r in got)
    assert [r["lang_pred"] for r in got if r["doc_id"] in (1, 2, 3)] == ["und"] * 3
    assert {r["lang_pred"] for r in got if r["text"] and r["text"].startswith("the")} == {"en"}
    far = spark.createDataFrame([(7, "你好"), (8, "你 1 "), (9, "1 2")], "doc_id long, text string")
    plain = fit(docs.where("text rlike '^[ -~\\n]*$'"), F.lit(True), rows=60)
    got = {r["doc_id"]: (r["lang_pred"], r["score"]) for r in predict(far, plain).collect()}
    assert got[7][0] in plain.languages and got[8][0] in plain.languages and 0 < got[7][1] <= 1 and got[9] == ("und", 0.0)
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert fit(none, F.lit(True)) is None and predict(none, model).count() == 0
    assert {r["lang_pred"] for r in predict(docs.limit(3), None).collect()} == {"und"}


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet")
    got = QUERIES["op2_langid"](spark, SF_MID).join(docs.select("doc_id", "lang"), "doc_id").toPandas()
    assert len(got) == docs.count()
    held = got[got["held_out"]]
    assert (held["lang_pred"] == held["lang"]).mean() > 0.97
    assert set(got.loc[got["held_out"], "doc_id"]) == {r[0] for r in docs.where(crc_mod("doc_id", 5) == 0).select("doc_id").collect()}
