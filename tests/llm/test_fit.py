"""The latent space of the search is fitted on all documents."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from stratus.llm import decontaminate
from stratus.llm.words import doc_words


N = 10_700


@pytest.fixture()
def fitted_on(spark, monkeypatch):
    """The passages that each fit reads."""
    seen, fit = [], decontaminate.latent_basis

    def watched(pieces, weight, **kw):
        found = pieces.mapInArrow(decontaminate._frequencies, "bucket int, n long").where("bucket = -1")
        seen.append(found.agg(F.sum("n")).first()[0])
        return fit(pieces, weight, **kw)

    monkeypatch.setattr(decontaminate, "latent_basis", watched)
    return seen


def many_docs(spark):
    """Texts of one passage each."""
    return spark.range(N).select(F.col("id").alias("doc_id"), F.format_string("x%d of y%d", "id", "id").alias("text"))


def items(spark):
    return spark.createDataFrame([(1, "x5 of y5 and no more")], "item_id long, text string")


def test_the_fit_reads_every_document(spark, scratch, fitted_on):
    decontaminate.leaks(many_docs(spark), items(spark), scratch)
    assert fitted_on == [N]


def test_the_pipelines_stage_fits_on_every_document(spark, tmp_path, fitted_on):
    items(spark).write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = corpus_pipeline.drop_benchmark_leaks(spark, many_docs(spark), str(tmp_path))
    assert fitted_on == [N] and kept.columns == ["doc_id", "text"]


def test_basis_is_the_singular_vectors_of_all_passages(spark, docs, scratch):
    rng = random.Random(4)
    texts = [" ".join(f"w{int(rng.paretovariate(0.6)) % 400}" for _ in range(rng.choice([0, 3, 32, 33, 100])))
             for _ in range(30)] + [None]
    pieces = docs([(i, t) for i, t in enumerate(texts)]).select("text").mapInArrow(
        decontaminate._bucket_rows, "buckets binary")
    weight = decontaminate.idf(pieces)
    rows, count = [], np.zeros(decontaminate.FEATURES)
    for words in doc_words(pa.array(texts)):
        for i in range(0, len(words), 32):
            b = decontaminate.buckets(words[i: i + 32])
            rows.append(np.bincount(b, weight[b], decontaminate.FEATURES) / np.linalg.norm(weight[b]))
            count += np.bincount(b, minlength=decontaminate.FEATURES)
    assert weight == pytest.approx(np.log1p((1 + len(rows)) / (1 + count)), rel=1e-5)
    a = np.array(rows)
    assert 40 < len(rows) <= decontaminate.RANK  # the range finder then spans all of them
    vectors = decontaminate.latent_basis(pieces, weight)[:, :8] / weight[:, None]
    want = np.linalg.svd(a, compute_uv=False)[:8]
    assert 1 / np.linalg.norm(vectors, axis=0) == pytest.approx(want, rel=1e-3)
    assert np.linalg.norm(a @ vectors, axis=0) == pytest.approx(np.ones(8), rel=1e-3)
