"""Text helpers: slugs, CSV lists, label regex."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from stratus.schemas import EVENT_SLUG_STEPS, REGISTRY_SLUG_STEPS

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_dashes(c: Column) -> Column:
    return F.regexp_replace(c, r"^-+|-+$", "")


def _steps(c: Column, steps: Iterable[tuple[str, str]]) -> Column:
    for pattern, to in steps:
        c = F.regexp_replace(c, pattern, to)
    return strip_dashes(c)


def slug_registry(c: ColumnOrName) -> Column:
    """Registry slug: lower, trimmed, white space to dashes, other characters
    dropped, dashes collapsed and stripped (may be empty)."""
    return _steps(strip_ws(F.lower(_c(c))), REGISTRY_SLUG_STEPS)


def slug_event(c: ColumnOrName) -> Column:
    """Event slug: lower, every run of other characters a dash, dashes collapsed
    and stripped; empty -> 'na'."""
    return F.coalesce(F.nullif(_steps(F.lower(_c(c)), EVENT_SLUG_STEPS), F.lit("")), F.lit("na"))


def slug_ui(c: ColumnOrName) -> Column:
    """UI fallback slug: lower, ' ', '_' and '/' -> '-', strip dashes."""
    return strip_dashes(F.translate(F.lower(_c(c)), " _/", "---"))


def norm_id(c: ColumnOrName) -> Column:
    """Trim and lower an id typed by a user."""
    return F.lower(strip_ws(_c(c)))


# Every character Python's str.strip() removes (derived by rule, not listed).
WHITESPACE = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())


def strip_ws(c: ColumnOrName) -> Column:
    """Strip leading/trailing whitespace of any kind (plain ``trim`` only drops
    spaces); a character-set trim, no regex."""
    return F.trim(_c(c), F.lit(WHITESPACE))


def csv_to_list(c: ColumnOrName) -> Column:
    """'a, b,,c' -> ['a','b','c']: split on commas, strip entries, drop blanks."""
    return F.array_remove(F.transform(F.split(_c(c), ","), strip_ws), "")


def list_to_csv(c: ColumnOrName) -> Column:
    return F.array_join(_c(c), ",")


def _quote(v: str) -> str:
    # Java regex literal quoting; an embedded \E closes and reopens the quote.
    return r"\Q" + v.replace(r"\E", r"\E\\E\Q") + r"\E"


def label_match(c: ColumnOrName, values: Iterable[str] | None) -> Column:
    """Anchored multi-value label match ``label =~ "v1|v2"``; ``None`` or an
    empty selection means "All" (no filter)."""
    vals = [v for v in (values or []) if v is not None]
    if not vals:
        return F.lit(True)
    return _c(c).rlike("^(?:" + "|".join(_quote(v) for v in vals) + ")$")


# Characters that a partition folder's name writes as % and two hex digits.
ESCAPED = "".join(map(chr, range(1, 32))) + "\"#%'*/:=?\\\x7f{[]^"


def folder_name(c: ColumnOrName) -> Column:
    """A value as it appears in a ``key=value`` folder's name."""
    out = _c(c)
    for ch in "%" + ESCAPED.replace("%", ""):
        out = F.replace(out, F.lit(ch), F.lit(f"%{ord(ch):02X}"))
    return out


def result_path(base: str, request_id: ColumnOrName, key: str | None = None) -> Column:
    """Result folder of a request: ``{base}/{request_id}``, or
    ``{base}/{key}={request_id}`` with the name as a partitioned write makes it."""
    name = folder_name(request_id) if key else _c(request_id)
    return F.concat(F.lit(base.rstrip("/") + "/" + (f"{key}=" if key else "")), name)
