"""Fitted models score every row of the table they are applied to."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tessera.tables import table
from tests.conftest import SF_SMALL


@pytest.mark.parametrize("name", ["m01_train_binary", "m11_save_load_score", "t07_logistic_regression"])
def test_every_document_is_scored(spark, name):
    out = entry.queries()[name](spark, SF_SMALL)
    docs = table(spark, SF_SMALL, "documents").select("doc_id")
    labels = table(spark, SF_SMALL, "labels").select("doc_id")
    assert labels.count() < docs.count()  # some documents have no label
    assert sorted(out.select("doc_id").collect()) == sorted(docs.collect())
    assert out.filter(F.col("prediction").isNull()).count() == 0
    known = {"m01_train_binary": "label", "t07_logistic_regression": "quality"}.get(name)
    if known:
        assert out.filter(F.col(known).isNotNull()).count() == labels.count()
