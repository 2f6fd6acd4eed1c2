import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture()
def make(spark):
    """Documents from (doc_id, text) pairs or a list of texts; ``more`` adds columns."""
    def build(rows, more="", value=None, lang="en"):
        pairs = [r if isinstance(r, tuple) else (i, r) for i, r in enumerate(rows)]
        full = [(d, t, lang, "src0", len(t or "")) + ((value,) * (more.count(",") + 1) if more else ()) for d, t in pairs]
        return spark.createDataFrame(full, SCHEMA + (", " + more if more else "")).repartition(3)
    return build
