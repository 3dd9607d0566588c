import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))
sys.path.insert(0, str(Path(__file__).resolve().parents[2]))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from corpus_cases import SCHEMA, corpus  # noqa: E402


@pytest.fixture(scope="session")
def rows_():
    return corpus()


@pytest.fixture(scope="session")
def docs(spark, rows_):
    """With extra columns whose names the operators use themselves, and one row repeated."""
    rows = [(d, t, "en" if d % 2 else None, "s", None, "clash", "clash", 7, "clash") for d, t in rows_]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def items(spark, rows_):
    long = dict(rows_)[28]
    texts = [(1, " ".join(long.split()[40:75])), (2, "stone river"), (3, None), (4, ""), (5, dict(rows_)[16].upper()), (10, "never seen anywhere at all in these texts but long enough")]
    return spark.createDataFrame(texts, "item_id long, text string")
