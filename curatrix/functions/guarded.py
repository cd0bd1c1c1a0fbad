"""Batch functions that may fail: the batch first, then row by row, errors kept beside the rows."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def map_with_fallback(df: DataFrame, ident: str, value: str, batch: Callable[[list], list], out_type: str = "string", rows_at_once: int = 64) -> DataFrame:
    """(ident, result, error): ``batch`` maps a list of values to as many results, in calls of ``rows_at_once``.

    If a call fails or returns another number of results, its values are tried one by one; a value that
    still fails has a null result and the error's text. ``out_type`` is string, long, int, double or boolean.
    Narrow: no shuffle.
    """
    kind = df.schema[ident].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "double": pa.float64(), "boolean": pa.bool_()}
        for b in batches:
            values, results, errors = b.column(1).to_pylist(), [], []
            for at in range(0, len(values), rows_at_once):
                part = values[at : at + rows_at_once]
                try:
                    done = list(batch(part))
                    if len(done) != len(part):
                        raise ValueError(f"{len(done)} results for {len(part)} values")
                    results += done
                    errors += [None] * len(part)
                except Exception:
                    for v in part:
                        try:
                            results.append(list(batch([v]))[0])
                            errors.append(None)
                        except Exception as e:
                            results.append(None)
                            errors.append(f"{type(e).__name__}: {e}")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(results, kinds[out_type]), pa.array(errors, pa.string())], names=["i", "result", "error"])

    source = df.select(F.col(ident).alias("i"), F.col(value).alias("v"))
    return source.mapInArrow(run, f"i {kind}, result {out_type}, error string").withColumnRenamed("i", ident)
