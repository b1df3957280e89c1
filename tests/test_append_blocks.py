from collections import Counter

import pytest

from tessera.operators import joins as J


@pytest.mark.parametrize("n_source,block_rows", [(0, 10), (1, 10), (9, 10), (500, 3), (12_000, 40)])
def test_every_pair_once(spark, n_source, block_rows):
    target = [(i % 4, None if i == 2 else f"t{i}") for i in range(5)] + [(0, "t0")]
    source = [(i // 2, "x" if i % 3 else None, "clash") for i in range(n_source)]  # with equal rows
    got = J.append_in_blocks(
        spark.createDataFrame(target, "a int, b string"),
        spark.createDataFrame(source, "`k.d` int, v string, __no string").repartition(3), block_rows)
    assert got.columns == ["a", "b", "k.d", "v", "__no"]
    assert Counter(map(tuple, got.collect())) == Counter(t + s for t in target for s in source)


def test_empty_target_and_plan(spark):
    source = spark.range(500).toDF("k")
    assert J.append_in_blocks(spark.range(0).toDF("a"), source, 10).count() == 0
    plan = J.append_in_blocks(spark.range(20).toDF("a"), source, 10)._jdf.queryExecution().executedPlan().toString()
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_refusal_names_the_bound(spark):
    with pytest.raises(ValueError, match="more than 10 rows"):
        J.append_fields(spark.range(2).toDF("a"), spark.range(11).toDF("k"), max_source_rows=10)
