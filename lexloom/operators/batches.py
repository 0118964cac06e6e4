"""Running a caller's model over batches of rows, with or without error capture."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import types as T


def map_batches(
    df: DataFrame, make_fn: Callable[[], Callable[[pd.DataFrame], pd.DataFrame]], added: str
) -> DataFrame:
    """Add the columns of ``added`` (DDL) by a model that sees one pandas batch at a time.

    ``make_fn`` builds the model once per task. It must return one row per input row, in order;
    the input columns, keys included, are kept beside its output. Batch size follows
    ``spark.sql.execution.arrow.maxRecordsPerBatch``.
    """
    new = T.StructType.fromDDL(added)
    schema = T.StructType(df.schema.fields + new.fields)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make_fn()
        for batch in batches:
            result = model(batch)
            if len(result) != len(batch):
                raise ValueError(f"model returned {len(result)} rows for {len(batch)}")
            out = batch.copy()
            for field in new.fields:
                out[field.name] = result[field.name].to_numpy()
            yield out

    return df.mapInPandas(run, schema)


def score_with_status(df: DataFrame, column: str, make_fn: Callable[[], Callable[[str], str]]) -> DataFrame:
    """Call a model per row; a failing call leaves ``result`` null and the run goes on.

    Adds ``result string, ok boolean, error string`` (the exception's class name).
    """

    def make_batch() -> Callable[[pd.DataFrame], pd.DataFrame]:
        call = make_fn()

        def one(value: object) -> tuple[str | None, bool, str | None]:
            try:
                return call(value), True, None
            except Exception as failure:  # the row reports it
                return None, False, type(failure).__name__

        return lambda batch: pd.DataFrame(
            [one(v) for v in batch[column]], columns=["result", "ok", "error"], dtype=object
        )

    return map_batches(df, make_batch, "result string, ok boolean, error string")
