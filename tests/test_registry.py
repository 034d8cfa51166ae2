"""Snapshots, commits, conflicts, unfinished commits; the job's chain."""

import json
import os

import pytest
from conftest import rows

from stratus.sources import registry
from stratus.sources.files import read_registry
from stratus.sources.fs import Store
from stratus.sources.sinks import write_registry

DOC = {"version": 5, "updated_at": "2025-09-25T12:26:15Z", "updated_by": "x", "cities": [
    {"id": "paris-fr", "name": "Paris", "country": "FR", "lat": 48.8566, "lon": 2.3522, "active": True},
    {"id": "lyon-fr", "name": "Lyon", "country": "FR", "lat": 45.764, "lon": 4.8357, "active": None}]}
CHANGE_DDL = ("op string, seq bigint, id string, name string, country string, lat double, lon double, active boolean")


def _put(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write(text)


def _changes(spark, *ops):
    return spark.createDataFrame([(op, i, cid, "N", "FR", 1.0, 1.0, True) for i, (op, cid) in enumerate(ops)], CHANGE_DDL)


@pytest.fixture()
def doc(tmp):
    _put(f"{tmp}/cities.json", json.dumps(DOC, indent=2))
    return f"{tmp}/cities.json"


def test_three_runs_of_the_job_go_on_from_each_other(spark, tmp, doc):
    from stratus.jobs import registry as job

    batches = [[{"op": "create", "seq": 1, "name": "Nice", "country": "fr", "lat": 43.7, "lon": 7.2}],
               [{"op": "toggle", "seq": 1, "id": "lyon-fr"}, {"op": "delete", "seq": 2, "id": "paris-fr"}],
               [{"op": "toggle", "seq": 1, "id": "ghost"}, {"op": "toggle", "seq": 2, "id": "nice-fr"}]]
    root, base = f"{tmp}/reg", doc
    for k, batch in enumerate(batches):
        _put(f"{tmp}/ch{k}/part.json", "\n".join(map(json.dumps, batch)))
        assert job.main(["--registry", base, "--changes", f"{tmp}/ch{k}", "--out-root", root, "--log", f"{tmp}/log"]) == 0
        base = root
    snap = registry.open_registry(spark, root)
    assert (snap.version, snap.path) == (9, f"{root}/v=9")
    assert rows(snap.cities, "id", "active") == [("lyon-fr", False), ("nice-fr", False)]
    assert rows(read_registry(spark, root), "id", "version") == [("lyon-fr", 9), ("nice-fr", 9)]
    assert rows(spark.read.json(f"{tmp}/log"), "version", "id") == [
        (6, "nice-fr"), (7, "lyon-fr"), (8, "paris-fr"), (9, "nice-fr")]


def test_a_stale_base_is_refused(spark, tmp, doc):
    root = f"{tmp}/reg"
    registry.apply_batch(spark, doc, _changes(spark, ("toggle", "lyon-fr")), root)
    stale = registry.open_registry(spark, root)
    registry.apply_batch(spark, root, _changes(spark, ("toggle", "paris-fr"), ("toggle", "lyon-fr")), root)
    with pytest.raises(registry.RegistryConflict, match="not the newest"):
        registry.commit(spark, stale, stale.cities, root, 1, "late")
    with pytest.raises(registry.RegistryConflict):  # the document is not the root's newest either
        registry.apply_batch(spark, doc, _changes(spark, ("toggle", "lyon-fr")), root)
    assert registry.open_registry(spark, root).version == 8
    assert not [n for n in Store(spark).names(f"{root}/_staged")]


def test_of_two_commits_at_once_one_wins_and_the_other_may_try_again(spark, tmp, doc, monkeypatch):
    """Both have read version 6; the other's commit comes in just before ours."""
    root = f"{tmp}/reg"
    registry.apply_batch(spark, doc, _changes(spark, ("toggle", "lyon-fr")), root)
    real, raced = Store.write_new, []

    def overtaken(self, path, text):
        if not raced:
            raced.append(path)
            registry.apply_batch(spark, root, _changes(spark, ("delete", "paris-fr")), root, "other")
        return real(self, path, text)

    monkeypatch.setattr(Store, "write_new", overtaken)
    with pytest.raises(registry.RegistryConflict, match="already has a successor"):
        registry.apply_batch(spark, root, _changes(spark, ("toggle", "lyon-fr")), root)
    raced.clear()
    done = registry.apply_batch(spark, root, _changes(spark, ("toggle", "lyon-fr"), ("delete", "lyon-fr")), root, attempts=2)
    assert done.snapshot.version == 9  # 6, other's 7, refused, other's delete finds nothing, ours 8 and 9
    assert done.snapshot.cities.count() == 0


def test_a_commit_whose_writer_died_is_completed(spark, tmp, doc, monkeypatch):
    root = f"{tmp}/reg"
    real = Store.rename_new

    def dies(self, source, target):
        if "/v=" in target:
            raise RuntimeError("lost")
        return real(self, source, target)

    monkeypatch.setattr(Store, "rename_new", dies)
    with pytest.raises(RuntimeError, match="lost"):
        registry.apply_batch(spark, doc, _changes(spark, ("toggle", "paris-fr")), root)
    monkeypatch.setattr(Store, "rename_new", real)
    assert registry.open_registry(spark, root).version == 6
    assert rows(registry.open_registry(spark, root).cities, "id", "active") == [("lyon-fr", None), ("paris-fr", False)]


def test_an_emptied_registry_keeps_its_version(spark, tmp, doc):
    root = f"{tmp}/reg"
    registry.apply_batch(spark, doc, _changes(spark, ("delete", "paris-fr"), ("delete", "lyon-fr")), root)
    snap = registry.open_registry(spark, root)
    assert (snap.version, snap.cities.count()) == (7, 0)
    registry.apply_batch(spark, root, _changes(spark, ("toggle", "lyon-fr")), root)  # refused: nothing changes
    assert registry.open_registry(spark, root).version == 7


def test_what_is_no_registry_raises(spark, tmp, doc):
    assert registry.open_registry(spark, f"{tmp}/none").version == 1
    os.makedirs(f"{tmp}/empty")
    _put(f"{tmp}/lines.json", json.dumps(DOC["cities"][0]))
    _put(f"{tmp}/broken.json", "{ not json")
    os.makedirs(f"{tmp}/v=3")
    for name in ("empty", "lines.json", "broken.json", "v=3"):
        with pytest.raises(Exception, match="registry|snapshot|JSON|MALFORMED|FAILFAST"):
            registry.open_registry(spark, f"{tmp}/{name}").cities.collect()


def test_folders_of_the_plain_writer_are_versions_too(spark, tmp, doc):
    write_registry(registry.open_registry(spark, doc).cities, f"{tmp}/r", 11, "x")
    write_registry(registry.open_registry(spark, doc).cities, f"{tmp}/r", 9, "x")
    assert registry.open_registry(spark, f"{tmp}/r").version == 11
    assert registry.open_registry(spark, f"{tmp}/r/v=9").version == 9
    assert registry.apply_batch(spark, f"{tmp}/r", _changes(spark, ("toggle", "lyon-fr")), f"{tmp}/r").snapshot.version == 12
