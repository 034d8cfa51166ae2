import os

import pytest

os.environ.setdefault("OMP_NUM_THREADS", "1")


@pytest.fixture()
def scratch(spark, request):
    from stratus.llm.scratch import Scratch

    return Scratch(spark, request.node.name.replace("[", "-").replace("]", ""))


@pytest.fixture()
def docs(spark):
    """A documents table from (doc_id, text) or (doc_id, text, source) rows."""
    def make(rows, extra=False):
        rows = [(*r, None) if len(r) == 2 else r for r in rows]
        df = spark.createDataFrame(rows, "doc_id long, text string, source string")
        if extra:  # columns whose names the operators use themselves
            for c in ("sig", "n", "u", "v", "size", "_size", "component", "key", "score", "shard", "row"):
                df = df.selectExpr("*", f"'x' AS {c}")
        return df
    return make
