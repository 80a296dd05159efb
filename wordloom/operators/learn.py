"""Scoring by an external next-word network."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.model_cache import ModelCache
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wordloom.functions.text import CONTEXT_TOKENS


def score_plugin(
    df: DataFrame,
    make_predict_fn: Callable[[], Callable[[np.ndarray], np.ndarray]],
    n: int = CONTEXT_TOKENS,
    batch_size: int = 1024,
    out: str = "probabilities",
) -> DataFrame:
    """Score ``context_ids`` with an external model, loaded once per worker.

    ``make_predict_fn`` returns a function from a (rows, n) array of indexes to a (rows, classes)
    array of probabilities, one class for each index from 2 on. The arrays go to Spark as Arrow buffers,
    ``batch_size`` rows at a time; no element becomes a Python object.
    """
    model = uuid.uuid4()

    def predict(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        scores = ModelCache.get(model)
        if scores is None:
            scores = make_predict_fn()
            ModelCache.add(model, scores)
        for column in columns:
            if column.null_count:
                raise ValueError("context_ids must not be NULL")
            ids = column.flatten().to_numpy().reshape(len(column), n)
            for start in range(0, len(ids), batch_size):
                part = ids[start : start + batch_size]
                told = np.ascontiguousarray(scores(part), dtype="float32")
                if told.ndim != 2 or len(told) != len(part):
                    raise ValueError(f"the model gave {told.shape} for {len(part)} rows")
                offsets = np.arange(0, told.size + 1, told.shape[1], dtype="int32")
                yield pa.ListArray.from_arrays(pa.array(offsets), pa.array(told.ravel()))

    # Spark reads the kind of function from its types, which this module holds as strings.
    predict.__annotations__ = {"columns": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return df.withColumn(out, F.arrow_udf(predict, "array<float>")(F.col("context_ids")))
