import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, os.path.dirname(os.path.dirname(HERE)))
sys.path.insert(0, os.path.dirname(HERE))

DOC = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="session")
def spark():
    from sitegauge.session import build_session
    return build_session("local[8]")


@pytest.fixture(scope="session")
def docs(spark):
    """A maker of document tables from (doc_id, text[, lang[, source]]) with clashing columns."""
    def make(rows, extra=()):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", r[3] if len(r) > 3 else "s",
                 len(r[1] or ""), *[7] * len(extra)) for r in rows]
        schema = DOC + "".join(f", {c} long" for c in extra)
        return spark.createDataFrame(full, schema)
    return make


@pytest.fixture(scope="session")
def sample(spark):
    """All documents of the smallest tables."""
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
