"""Small declared tables (options, questions, pairs) as local relations.

They come from declarations, not from data, so their size is fixed by what was declared. Handed over
as Arrow they stay local relations: no job is needed to build them and Spark knows their exact size.
"""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

_TYPES = {
    "string": pa.string(), "int": pa.int32(), "bigint": pa.int64(), "double": pa.float64(), "boolean": pa.bool_(),
    "array<string>": pa.list_(pa.string()),
    "options": pa.list_(pa.struct([("code", pa.string()), ("label", pa.string())])),
}


def small_table(spark: SparkSession, rows: Sequence[tuple], columns: str) -> DataFrame:
    """columns: 'name type, name type, ...'."""
    fields = [item.split() for item in columns.split(",")]
    arrays = [pa.array([row[i] for row in rows], type=_TYPES[kind]) for i, (_, kind) in enumerate(fields)]
    return spark.createDataFrame(pa.table(arrays, names=[name for name, _ in fields]))
