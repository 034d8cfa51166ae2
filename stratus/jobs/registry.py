"""Registry maintenance: apply a batch of city changes and commit a new version.

    python -m stratus.jobs.registry --registry cities.json --changes changes.jsonl \
        --out-root registry/ --user streamlit [--log log/] [--rejected rejected/]
    python -m stratus.jobs.registry --registry registry/ --changes more.jsonl --out-root registry/

``--registry`` is the original's JSON document (to begin a root with) or the root
itself, of which the newest version is taken.  ``changes.jsonl`` holds one JSON
object per line with ``op`` in ``create | update | delete | toggle`` and the city
fields (``id`` for update/delete/toggle; create derives the id from name and
country) and a ``seq``: changes apply in that order.  Invalid cities and unknown
ids go to ``--rejected`` with the reason.  Every accepted change raises the version
by one; ``--log`` gets (id, op, seq, version), a folder per version.  A commit that
another writer overtook is done again on the newer version (``--attempts``), then
fails with exit code 3.
"""

from __future__ import annotations

import argparse

from stratus.session import get_session
from stratus.sources.registry import RegistryConflict, apply_batch

CHANGE_DDL = ("op string, seq bigint, id string, name string, country string, "
              "lat double, lon double, active boolean")


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description="apply registry changes")
    p.add_argument("--registry", required=True, help="registry document, or the root of versions")
    p.add_argument("--changes", required=True, help="JSON lines of changes")
    p.add_argument("--out-root", required=True)
    p.add_argument("--user", default="backend")
    p.add_argument("--log", default=None)
    p.add_argument("--rejected", default=None)
    p.add_argument("--attempts", type=int, default=3)
    a = p.parse_args(argv)
    spark = get_session("registry-changes", profile="cluster")
    changes = spark.read.schema(CHANGE_DDL).json(a.changes)
    try:
        done = apply_batch(spark, a.registry, changes, a.out_root, a.user, a.attempts)
    except RegistryConflict as exc:
        print(f"[registry] refused: {exc}")
        return 3
    version = done.snapshot.version
    if a.log:
        done.log.write.mode("overwrite").json(f"{a.log}/to={version}")
    if a.rejected:
        done.rejected.write.mode("overwrite").json(a.rejected)
    print(f"[registry] version {version} at {done.snapshot.path}")
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
