"""Every query without SQL names a test that checks it against brute force, an exact
round trip or held-out accuracy."""

import importlib
import sys

import pytest

import __spark_entry__ as E

CHECKED_BY = {
    "op1_wavelet_tokens": "test_small.test_shards_round_trip",
    "op2_toxicity": "test_scorer.test_scores_equal_the_averaged_bags",
    "op4_repeated_passages": "test_search.test_passages_match_brute_force",
    "op5_decontamination": "test_scorer.test_leaks_against_an_exhaustive_search",
    "op9_brown_lm": "test_search.test_brown_score_equals_the_class_model",
    "op11_secret_scan": "test_secrets.test_query_equals_brute_force",
    "pipeline": "test_pipeline.test_pipeline_matches_plain_python",
}


def test_every_query_without_sql_has_a_named_test():
    assert set(E.queries()) - set(E.oracle_sql()) <= set(CHECKED_BY)


@pytest.mark.parametrize("name", sorted(CHECKED_BY))
def test_the_named_test_is_there(name):
    module, test = CHECKED_BY[name].split(".")
    assert callable(getattr(importlib.import_module(f"{__package__}.{module}" if __package__ else module), test))


def test_a_missing_library_leaves_the_other_queries(monkeypatch, capsys):
    for name in [m for m in sys.modules if m.startswith("stratus.llm") or m == "corpus_pipeline"]:
        monkeypatch.delitem(sys.modules, name)
    monkeypatch.setitem(sys.modules, "zstandard", None)
    left = E.queries()
    assert "daily_weather" in left and not any(n.startswith("op") and n[2].isdigit() for n in left)
    assert "zstandard" in capsys.readouterr().err
