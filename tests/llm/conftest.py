import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from civiclake.session import get_spark
    s = get_spark("local[*]", 4, app_name="civiclake-llm-tests", local_memory="4g")
    yield s


@pytest.fixture(scope="session")
def edge(spark):
    """Nulls in every column, empty and very long texts, repeated rows, and extra
    columns whose names clash with the operators' own."""
    long_text = "lorem ipsum dolor sit amet " * 20_000
    rows = [(1, "a b c d e", "en", "s", 9), (1, "a b c d e", "en", "s", 9), (2, "A  b\nc d e", "en", None, 9), (3, None, None, "s", None), (4, "", "en", "s", 0),
            (5, " \t\n", "en", "t", 3), (None, "x y z", "de", "t", 5), (None, "x y z", None, None, None), (6, long_text, "la", "t", len(long_text)), (7, long_text, "la", "t", 0)]
    df = spark.createDataFrame(rows, DOCS)
    clash = ["row", "node", "key", "digest", "locator", "size", "target", "kept", "k", "a", "b", "score", "lang_pred", "line", "unit", "piece", "ids", "component_id"]
    from pyspark.sql import functions as F
    return df.withColumns({c: F.lit(f"clash {c}") for c in clash})


@pytest.fixture(scope="session")
def none(spark):
    return spark.createDataFrame([], DOCS)
