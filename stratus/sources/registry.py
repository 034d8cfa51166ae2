"""The city registry as numbered snapshots.

A registry is either one JSON document (the original's form: version, stamp and
an array of cities) or a root folder of snapshots ``v=<version>/``, each holding
one JSON line per city, so that no task builds the whole document.

Writers are optimistic.  A commit names the version it started from; its rows are
first written to a folder of their own, then the one small file
``_commits/from=<base>`` is put in place by a rename that fails if the name is
taken.  That file is the commit: it says which folder follows ``base``.  Of two
writers with one base the second finds the name taken and gets
:class:`RegistryConflict`, whatever versions they aim at, and a writer whose base
is no longer the newest gets it at once.  The folder's final name is set last; a
writer that dies in between leaves a commit that the next reader or writer
completes.

Every accepted change raises the version by one, so a batch of changes skips
versions; the chain of commits does not depend on that.
"""

from __future__ import annotations

import json
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratus.functions.times import now_iso
from stratus.operators import cities as ops
from stratus.schemas import CITY_DDL, REGISTRY_DDL
from stratus.sources.fs import Store

_LINE_DDL = f"version int, updated_at string, updated_by string, {CITY_DDL}"
_FOLDER = re.compile(r"v=(\d+)")
FIRST_VERSION = 1


class RegistryConflict(RuntimeError):
    """The base of a commit is not the newest version."""


class RegistryUnreadable(ValueError):
    """A path that holds something, but no registry."""


@dataclass(frozen=True)
class Snapshot:
    """One version of the registry.  ``path`` is None where there is none yet."""

    version: int
    path: str | None
    table: DataFrame

    @property
    def cities(self) -> DataFrame:
        return self.table.select(*ops.CITY_COLS)


def open_registry(spark: SparkSession, path: str) -> Snapshot:
    """The registry at ``path``: a document, a snapshot folder, or the newest
    snapshot under a root.  Nothing there is an empty registry of version 1;
    anything else that cannot be read as a registry raises."""
    store, path = Store(spark), path.rstrip("/")
    if not store.exists(path):
        return Snapshot(FIRST_VERSION, None, spark.createDataFrame([], _LINE_DDL))
    if not store.is_folder(path):
        return _document(spark, path)
    named = _FOLDER.fullmatch(path.rpartition("/")[2])
    if named:
        if "_SUCCESS" not in store.names(path):
            raise RegistryUnreadable(f"{path}: an unfinished snapshot")
        return _lines(spark, path, int(named[1]))
    newest = _newest(store, path)
    if newest is None:
        raise RegistryUnreadable(f"{path}: neither a registry document nor a folder of snapshots")
    return _lines(spark, f"{path}/v={newest}", newest)


def _lines(spark: SparkSession, path: str, version: int) -> Snapshot:
    table = spark.read.schema(_LINE_DDL).option("mode", "FAILFAST").json(path)
    return Snapshot(version, path, table.withColumn("version", F.lit(version)))


def _document(spark: SparkSession, path: str) -> Snapshot:
    doc = spark.read.schema(REGISTRY_DDL).option("multiLine", True).option("mode", "FAILFAST").json(path)
    head = doc.select(F.coalesce("version", F.lit(FIRST_VERSION)), F.col("cities").isNotNull()).head(2)
    if len(head) != 1 or not head[0][1]:
        raise RegistryUnreadable(f"{path}: no registry document")
    table = doc.select(F.lit(head[0][0]).alias("version"), "updated_at", "updated_by", F.inline_outer("cities"))
    return Snapshot(head[0][0], path, table.where(F.col("id").isNotNull() | F.col("name").isNotNull()))


def _newest(store: Store, root: str) -> int | None:
    """The newest committed version under ``root``; finishes a commit whose writer
    stopped before naming its folder."""
    found = sorted((int(m[1]) for m in map(_FOLDER.fullmatch, store.names(root)) if m), reverse=True)
    newest = next((v for v in found if "_SUCCESS" in store.names(f"{root}/v={v}")), None)
    while store.exists(_commit_file(root, newest)):
        commit = json.loads(store.read_text(_commit_file(root, newest)))
        target = f"{root}/v={commit['version']}"
        if not store.exists(target):
            store.rename_new(f"{root}/{commit['folder']}", target)
        newest = commit["version"]
    return newest


def _commit_file(root: str, base: int | None) -> str:
    return f"{root}/_commits/from={'nothing' if base is None else base}"


def commit(spark: SparkSession, base: Snapshot, cities: DataFrame, root: str, accepted: int,
           updated_by: str) -> Snapshot:
    """Write ``cities`` as the successor of ``base`` under ``root``.

    ``accepted`` changes raise the version; with none, a base that already is
    the root's newest stays.  A base read from elsewhere (a document) can only
    begin an empty root.
    """
    store, root = Store(spark), root.rstrip("/")
    head = _newest(store, root)
    own = head is not None and base.path == f"{root}/v={head}"
    if not own and not (head is None and (base.path is None or not base.path.startswith(f"{root}/"))):
        raise RegistryConflict(f"{root}: version {base.version} from {base.path} is not the newest ({head})")
    if own and not accepted:
        return base
    version = base.version + accepted
    folder = f"_staged/{uuid.uuid4().hex}"
    rows = cities.select(F.lit(version).alias("version"), now_iso().alias("updated_at"),
                         F.lit(updated_by).alias("updated_by"), *ops.CITY_COLS)
    rows.write.mode("errorifexists").json(f"{root}/{folder}")
    said = json.dumps({"version": version, "folder": folder})
    if not store.write_new(_commit_file(root, head), said):
        store.delete(f"{root}/{folder}")
        raise RegistryConflict(f"{root}: version {base.version} already has a successor")
    store.rename_new(f"{root}/{folder}", f"{root}/v={version}")
    return _lines(spark, f"{root}/v={version}", version)


@dataclass(frozen=True)
class Applied:
    """What a batch of changes did: the new snapshot, (id, op, seq, version) of the
    accepted changes and (id, seq, error) of the others."""

    snapshot: Snapshot
    log: DataFrame
    rejected: DataFrame


def apply_batch(spark: SparkSession, registry: str, changes: DataFrame, root: str, updated_by: str = "backend",
                attempts: int = 1) -> Applied:
    """Apply a batch of changes to the registry at ``registry`` and commit the result
    under ``root``.  With ``registry`` under ``root``, a commit that another writer
    overtook is done again on the newer version, up to ``attempts`` times."""
    for left in reversed(range(max(1, attempts))):
        base = open_registry(spark, registry)
        after, accepted, rejected = ops.apply_changes(base.cities, changes)
        try:
            made = commit(spark, base, after, root, accepted.count(), updated_by)
        except RegistryConflict:
            if not left:
                raise
            continue
        return Applied(made, ops.change_log(base.version, accepted, seq="seq"), rejected)
    raise AssertionError("unreachable")
