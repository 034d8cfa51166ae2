"""City registry: validation, defaults, keyed changes, lookups
(C4 C10 D1-D3 E9 B9 G4-G8 H10 H11 H13-H15).

The registry is a DataFrame of (id, name, country, lat, lon, active).
Changes are DataFrames too; upsert/delete/update are anti/semi joins plus a
union, never a driver-side loop.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stratus.functions.text import norm_id, slug_event, slug_registry
from stratus.schemas import CITY_ID_PATTERN, COUNTRY_LEN, LAT_RANGE, LON_RANGE

CITY_COLS = ["id", "name", "country", "lat", "lon", "active"]


def is_active(c: str = "active") -> Column:
    """C4: a missing flag means active."""
    return F.coalesce(F.col(c), F.lit(True))


def default_id(id_col: str = "id", name: str = "name", country: str = "country") -> Column:
    """Given id, else slug of ``name-country`` (name alone without a
    country).  May be empty; validation reports that."""
    base = F.concat_ws("-", F.col(name), F.nullif(F.col(country), F.lit("")))
    return F.coalesce(F.nullif(F.col(id_col), F.lit("")), slug_registry(base))


def created_id(name: str = "name", country: str = "country") -> Column:
    """Create always derives the id from ``name-country``, ignoring a given id."""
    return slug_registry(F.concat_ws("-", F.col(name), F.nullif(F.col(country), F.lit(""))))


def validate(cities: DataFrame) -> DataFrame:
    """Field rules after the id default; ``violations`` lists broken
    rules (empty when valid)."""
    return validate_given(cities.withColumn("id", default_id()))


def validate_given(df: DataFrame) -> DataFrame:
    """C10 on the ids as they are."""
    rules = [
        ("id_empty", F.coalesce(F.col("id"), F.lit("")) == ""),
        ("id_pattern", ~F.coalesce(F.col("id"), F.lit("")).rlike(CITY_ID_PATTERN)),
        ("name_empty", F.coalesce(F.length("name"), F.lit(0)) < 1),
        ("country_length", F.coalesce(F.length("country"), F.lit(0)) != COUNTRY_LEN),
        ("lat_range", ~F.coalesce(F.col("lat").between(*LAT_RANGE), F.lit(False))),
        ("lon_range", ~F.coalesce(F.col("lon").between(*LON_RANGE), F.lit(False))),
    ]
    violations = F.filter(
        F.array(*[F.when(cond, F.lit(name)) for name, cond in rules]), lambda x: x.isNotNull()
    )
    return df.withColumn("violations", violations).withColumn(
        "valid", F.size("violations") == 0
    )


def split_valid(cities: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Good rows (input columns kept, id defaulted) and quarantined rows
    (with ``violations``)."""
    v = validate(cities)
    return v.where("valid").drop("violations", "valid"), v.where(~F.col("valid"))


def active_for_fetch(cities: DataFrame) -> DataFrame:
    """C4 + H11 + H14: the producer's view of the registry: active cities,
    id in event-slug form, name defaults to the id, country to ``na``."""
    a = cities.where(is_active()).withColumn("id", slug_event("id"))
    return a.select(
        "id",
        F.coalesce(F.nullif(F.col("name"), F.lit("")), F.col("id")).alias("name"),
        F.coalesce(F.nullif(F.col("country"), F.lit("")), F.lit("na")).alias("country"),
        "lat", "lon",
    )


def create(base: DataFrame, new: DataFrame) -> DataFrame:
    """Create cities (H13 H15 C10): country upper-cased, id always derived from
    ``name-country`` (a given id is ignored), valid rows upserted by that id
    (the others come from :func:`split_valid` of :func:`created`)."""
    good, _ = split_valid(created(new))
    return upsert(base, good)


def created(new: DataFrame) -> DataFrame:
    """Rows as a create makes them, not validated yet."""
    rows = new.withColumn("country", F.upper("country")).withColumn("id", created_id())
    return rows.withColumn("active", is_active())


def upsert(base: DataFrame, changes: DataFrame, order_col: str | None = None) -> DataFrame:
    """Replace the row with the same id, else append.  With several changes
    to one id, the one with the largest ``order_col`` wins, and of equal ones
    the largest row, so an id never comes out twice."""
    chg = _last_per_id(changes, order_col).select(*CITY_COLS)
    return base.select(*CITY_COLS).join(chg.select("id"), "id", "left_anti").unionByName(chg)


def _last_per_id(changes: DataFrame, order_col: str | None) -> DataFrame:
    row = F.struct(*[c for c in CITY_COLS if c != "id"])
    order = F.struct(order_col, row) if order_col else row
    return changes.groupBy("id").agg(F.max_by(row, order).alias("_c")).select("id", "_c.*")


def apply_changes(base: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Apply create/update/delete/toggle rows in the order of ``seq``.

    Returns (registry, accepted, rejected).  Per id, in order: a create sets the
    row, an update replaces it, a delete removes it, a toggle flips ``active``;
    all but create need the id to exist at that point (D3), creates and updates
    must be valid (C10).  One window over the changes decides what is accepted;
    then each id's state is its last accepted create/update/delete (else its
    base row) and the parity of the accepted toggles after it, joined to the
    base once.  ``accepted`` has (id, op, seq), ``rejected`` (id, seq, error).
    Changes of equal ``seq`` apply in the order of their operation's name.
    """
    ch = changes.withColumn("op", F.lower("op"))
    made = created(ch)
    is_create = F.col("op") == "create"
    rows = made.where(is_create).unionByName(ch.where(~F.coalesce(is_create, F.lit(False))))
    checked = validate_given(rows)
    needs = F.col("op").isin("create", "update")
    fault = (F.when(~F.coalesce(F.col("op").isin("create", "update", "delete", "toggle"), F.lit(False)),
                    F.lit("unknown operation"))
             .when(needs & (F.size("violations") > 0),
                   F.concat(F.lit("invalid: "), F.array_join("violations", ","))))
    known = base.select(F.col("id"), F.lit(True).alias("_known")).dropDuplicates(["id"])
    row = F.struct(*[c for c in CITY_COLS if c != "id"])
    by_id = Window.partitionBy("id").orderBy("seq", "op")
    before = by_id.rowsBetween(Window.unboundedPreceding, -1)
    alive = F.when(F.col("_fault").isNull() & F.col("op").isin("create", "delete"), F.col("op") == "create")
    judged = (
        checked.withColumn("_fault", fault)
        .join(known, "id", "left")
        .withColumn("_exists", F.coalesce(F.last(alive, ignorenulls=True).over(before),
                                          F.col("_known"), F.lit(False)))
        .withColumn("error", F.coalesce(
            "_fault", F.when((F.col("op") != "create") & ~F.col("_exists"), F.lit("city not found"))))
    )
    ok = judged.where("error IS NULL")
    sets = F.col("op") != "toggle"
    after = (
        ok.withColumn("_set", F.max(F.when(sets, F.struct("seq", "op"))).over(
            Window.partitionBy("id")))
        .groupBy("id").agg(
            F.max("_set.op").alias("_op"),
            F.max_by(row, F.when(sets, F.struct("seq", "op"))).alias("_row"),
            F.count_if(~sets & (F.col("_set").isNull() | (F.struct("seq", "op") > F.col("_set")))).alias("_flips"))
    )
    state = (
        base.select(F.col("id"), row.alias("_base")).join(after, "id", "full_outer")
        .where(F.coalesce(F.col("_op"), F.lit("")) != "delete")
        .select("id", F.when(F.col("_op").isNotNull(), F.col("_row")).otherwise(F.col("_base")).alias("_r"),
                F.coalesce("_flips", F.lit(0)).alias("_flips"))
    )
    active = F.when(F.col("_flips") % 2 == 1, ~F.coalesce("_r.active", F.lit(True))).otherwise(F.col("_r.active"))
    registry = state.select("id", "_r.name", "_r.country", "_r.lat", "_r.lon", active.alias("active"))
    return (registry, ok.select("id", "op", "seq"),
            judged.where("error IS NOT NULL").select("id", "seq", "error"))


def update_existing(base: DataFrame, changes: DataFrame, order_col: str | None = None):
    """G6 + D3: apply changes whose id exists; return (registry, rejected).
    Rejected rows carry ``error = 'city not found'``."""
    ids = base.select("id")
    accepted = changes.join(ids, "id", "left_semi")
    rejected = changes.join(ids, "id", "left_anti").withColumn("error", F.lit("city not found"))
    return upsert(base, accepted, order_col), rejected


def delete(base: DataFrame, ids: DataFrame):
    """G5 + D3: drop rows by id; return (registry, rejected ids)."""
    known = base.select("id")
    rejected = ids.join(known, "id", "left_anti").withColumn("error", F.lit("city not found"))
    return base.join(ids.select("id"), "id", "left_anti"), rejected


def toggle(base: DataFrame, ids: DataFrame):
    """Flip ``active`` (missing = true) for the chosen ids; one join.
    Returns (registry, rejected ids)."""
    chosen = ids.select("id").distinct()
    flip = chosen.withColumn("_flip", F.lit(True))
    reg = base.select(*CITY_COLS).join(flip, "id", "left").withColumn(
        "active", F.when(F.col("_flip"), ~is_active()).otherwise(F.col("active"))).drop("_flip")
    rejected = chosen.join(base.select("id"), "id", "left_anti").withColumn("error", F.lit("city not found"))
    return reg.select(*CITY_COLS), rejected


def global_row_number(df: DataFrame, order_cols: list[str], name: str = "rn",
                      buckets: int = 256) -> DataFrame:
    """1-based position of each row in the total order of ``order_cols``, without
    moving all rows to one task.

    Rows fall into buckets by the first order column, between bounds that are
    quantiles of the data and enter the plan as literals: a row's bucket depends
    on its value alone, whatever the partitioning.  The position is the number of
    rows in earlier buckets (a table of ``buckets`` rows) plus the row number in
    the bucket.  The first column must be numeric, a date or a timestamp; nulls
    come first.  Very many rows with one first value share a bucket.
    """
    first = order_cols[0]
    shares = [i / buckets for i in range(1, buckets)]
    cuts = df.select(F.approx_percentile(first, shares, 20 * buckets)).first()[0]
    kind = df.schema[first].dataType
    bounds = [F.lit(x).cast(kind) for x in sorted(set(cuts or []))]

    def bucket(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(F.col(first) >= bounds[mid], bucket(mid + 1, hi)).otherwise(bucket(lo, mid))

    tagged = df.withColumn("_bucket", bucket(0, len(bounds)))
    counts = tagged.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        "_bucket", (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_off"))
    place = F.row_number().over(Window.partitionBy("_bucket").orderBy(*order_cols))
    return (
        tagged.withColumn("_place", place).join(F.broadcast(offsets), "_bucket")
        .withColumn(name, F.col("_off") + F.col("_place"))
        .drop("_bucket", "_place", "_off")
    )


def change_log(base_version: Column | int, changes: DataFrame, seq: str = "change_seq") -> DataFrame:
    """One version per accepted change, in change order (version = base +
    position).  ``changes`` must carry ``seq``."""
    base = base_version if isinstance(base_version, Column) else F.lit(base_version)
    numbered = global_row_number(changes, [seq], "_pos")
    return numbered.withColumn("version", base + F.col("_pos")).drop("_pos")


def lookup(requests: DataFrame, cities: DataFrame, id_col: str = "city_id"):
    """Requested ids (trimmed, lowered) -> active cities; unknown ids are
    returned apart.  Returns (found, unknown)."""
    req = requests.withColumn(id_col, norm_id(id_col))
    active = active_for_fetch(cities).withColumnRenamed("id", id_col)
    found = req.join(active, id_col)
    unknown = req.join(active.select(id_col), id_col, "left_anti")
    return found, unknown


def listing(cities: DataFrame) -> DataFrame:
    """Registry table as shown to users (4-decimal coordinates, flag text)."""
    return cities.select(
        "id", "name", "country",
        F.format_string("%.4f", "lat").alias("lat"),
        F.format_string("%.4f", "lon").alias("lon"),
        F.when(is_active(), F.lit("active")).otherwise(F.lit("inactive")).alias("status"),
    )


def registry_counts(registry: DataFrame) -> DataFrame:
    """Number of cities, active cities, and the document version."""
    return registry.agg(
        F.count("id").alias("cities"),
        F.count_if(is_active()).alias("active_cities"),
        F.max("version").alias("version"),
    )
