import os
import random

import pytest
from pyspark.sql import Row

from vigiframe.llm.common import read_table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def docs(spark):
    return read_table(spark, SMALL, "documents").cache()


@pytest.fixture(scope="session")
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows, and columns whose names helper columns might use."""
    rng = random.Random(7)
    words = ["the", "and", "of", "to", "tion", "ering", "Éa", "blé", "x1", "in", "is", "on"]
    long = " ".join(rng.choice(words) for _ in range(60_000))
    texts = [None, "", " \t\n", "a", "same text of the day and it is for you", "same text of the day and it is for you", long, "no\nbreak\n\nno"]
    rows = [(i, t, "en", "s", i) for i, t in enumerate(texts)] + [(4, texts[4], "en", "s", 4), (None, "orphan", None, None, None), (None, None, None, None, None)]
    return spark.createDataFrame([Row(doc_id=i, text=t, lang=lang, source=s, n_chars=n, key="k", lead="l", kept="no", secrets="-", tokens="t", _score="s")
                                  for i, t, lang, s, n in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, lead string, kept string, "
                                 "secrets string, tokens string, _score string")


@pytest.fixture(scope="session")
def no_docs(spark, odd_docs):
    return spark.createDataFrame([], odd_docs.schema)


@pytest.fixture(scope="session", autouse=True)
def importable_workers():
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    os.environ["PYTHONPATH"] = os.pathsep.join([root, os.environ.get("PYTHONPATH", "")])
