"""Context vectors are summed once, and a plug-in model's scores come as buffers."""

import numpy as np

from wordloom.operators import learn
from wordloom.plans.queries import QUERIES


def test_context_vectors_are_summed_once(spark, sf):
    for name in ("context_vectors", "context_vectors_unmasked"):
        plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("_vectors") > 0 and "transform(" in plan
        assert not [line for line in plan.split("\n") if "Filter" in line and "transform(" in line]


def test_scores_of_a_plugin(spark):
    """More rows than a batch, no rows, and no conversion element by element."""

    def make():
        return lambda ids: ids[:, :2] * 0.5

    df = spark.createDataFrame([(i, [i, i + 1, 0]) for i in range(25)], "id int, context_ids array<int>").repartition(3)
    got = learn.score_plugin(df, make, 3, 4)
    assert {r["id"]: r["probabilities"] for r in got.collect()} == {i: [i / 2, (i + 1) / 2] for i in range(25)}
    assert got.schema["probabilities"].dataType.simpleString() == "array<float>"
    assert learn.score_plugin(df.limit(0), make, 3).collect() == []
    assert "pythonUDF" in got._jdf.queryExecution().executedPlan().toString() and not hasattr(learn, "predict_batch_udf")
    assert np.float32(0.5) == got.filter("id = 0").first()["probabilities"][1]
