"""C4 C10 D1 D3 E9 B9 G4-G8 H10 H11 H13-H15 A12 A13, P11 P12."""

import json

from conftest import rows

from stratus.functions.text import label_match, slug_event, slug_registry, slug_ui
from stratus.operators import cities
from stratus.sources import files, sinks

CITY = "id string, name string, country string, lat double, lon double, active boolean"

# The sample registry shipped with the pipeline (fixed values).
SHIPPED = {
    "version": 5, "updated_at": "2025-09-25T12:26:15Z", "updated_by": "streamlit",
    "cities": [
        {"id": "paris-fr", "name": "Paris", "country": "FR", "lat": 48.8566, "lon": 2.3522, "active": True},
        {"id": "lyon-fr", "name": "Lyon", "country": "FR", "lat": 45.764, "lon": 4.8357, "active": True},
        {"id": "marseille-fr", "name": "Marseille", "country": "FR", "lat": 43.2965, "lon": 5.3698, "active": True},
        {"id": "nanterre-fr", "name": "Nanterre", "country": "FR", "lat": 48.89198, "lon": 2.20675, "active": True},
    ],
}


def _reg(spark):
    return spark.createDataFrame([
        ("paris-fr", "Paris", "FR", 48.8566, 2.3522, True),
        ("lyon-fr", "Lyon", "FR", 45.764, 4.8357, None),          # missing flag = active
        ("north", "North", "FR", 91.0, 0.0, True),                 # lat out of range
        ("bad", "Bad", "FRA", 0.0, 0.0, False),                    # 3-letter country
        ("", "Saint Étienne", "FR", 45.4, 4.4, True),               # id from name-country
        ("", "!!!", "", 0.0, 0.0, True),                            # empty after slug
    ], CITY)


def test_slugs(spark):
    df = spark.createDataFrame([("Saint_Étienne",), ("  New   York ",), ("a--b",), ("!!",)], "s string")
    got = df.select(slug_registry("s").alias("r"), slug_event("s").alias("e"),
                    slug_ui("s").alias("u")).collect()
    assert [tuple(r) for r in got] == [
        ("sainttienne", "saint-tienne", "saint-étienne"),   # P11: no accent folding
        ("new-york", "new-york", "new---york"),
        ("a-b", "a-b", "a--b"),
        ("", "na", "!!"),
    ]


def test_validate(spark):
    v = {r.id: (r.valid, list(r.violations)) for r in cities.validate(_reg(spark)).collect()}
    assert v["paris-fr"] == (True, [])
    assert v["north"] == (False, ["lat_range"])
    assert v["bad"] == (False, ["country_length"])
    assert v["saint-tienne-fr"] == (True, [])                     # generated id
    assert v[""] == (False, ["id_empty", "id_pattern", "country_length"])


def test_active_for_fetch_and_lookup(spark):
    reg = _reg(spark)
    a = rows(cities.active_for_fetch(reg), "id", "name", "country")
    assert ("lyon-fr", "Lyon", "FR") in a and all(r[0] != "bad" for r in a)
    assert ("na", "!!!", "na") in a                                # empty id -> na
    req = spark.createDataFrame([(" PARIS-fr ",), ("bad",), ("nowhere",)], "city_id string")
    found, unknown = cities.lookup(req, reg)
    assert rows(found, "city_id") == [("paris-fr",)]
    assert rows(unknown, "city_id") == [("bad",), ("nowhere",)]


def test_upsert_update_delete_toggle(spark):
    base = _reg(spark).where("id <> ''")
    chg = spark.createDataFrame([("paris-fr", "Paris 2", "FR", 1.0, 1.0, True),
                                 ("new", "New", "FR", 2.0, 2.0, True)], CITY)
    up = cities.upsert(base, chg)
    assert up.count() == 5 and rows(up.where("id='paris-fr'"), "name") == [("Paris 2",)]
    assert rows(cities.upsert(up, chg)) == rows(up)                # idempotent
    reg, rej = cities.update_existing(base, chg)
    assert reg.count() == 4 and rows(rej, "id", "error") == [("new", "city not found")]
    ids = spark.createDataFrame([("bad",), ("ghost",)], "id string")
    reg, rej = cities.delete(base, ids)
    assert reg.count() == 3 and rows(rej, "id") == [("ghost",)]
    reg, _ = cities.toggle(base, spark.createDataFrame([("lyon-fr",), ("bad",)], "id string"))
    flags = dict(rows(reg, "id", "active"))
    assert flags["lyon-fr"] is False and flags["bad"] is True and flags["paris-fr"] is True


def test_last_change_per_id_wins_and_change_log(spark):
    base = _reg(spark).where("id <> ''")
    chg = spark.createDataFrame([("paris-fr", "P1", "FR", 1.0, 1.0, True, 2),
                                 ("paris-fr", "P2", "FR", 1.0, 1.0, True, 7),
                                 ("lyon-fr", "L", "FR", 1.0, 1.0, True, 5)],
                                CITY + ", change_seq bigint")
    up = cities.upsert(base, chg, order_col="change_seq")
    assert rows(up.where("id='paris-fr'"), "name") == [("P2",)]
    log = cities.change_log(5, chg.repartition(3))
    assert rows(log, "change_seq", "version") == [(2, 6), (5, 7), (7, 8)]


def test_global_row_number_many_partitions(spark):
    df = spark.range(0, 1000, 1, 7).selectExpr("(id * 7919) % 1000 AS k")
    out = cities.global_row_number(df, ["k"], "rn")
    assert [(r.k, r.rn) for r in out.orderBy("k").collect()] == [(i, i + 1) for i in range(1000)]


def test_listing_and_counts(spark):
    reg = _reg(spark).where("id <> ''")
    lst = {r.id: r for r in cities.listing(reg).collect()}
    assert lst["paris-fr"].lat == "48.8566" and lst["lyon-fr"].status == "active"
    assert lst["bad"].status == "inactive"
    c = cities.registry_counts(reg.selectExpr("*", "5 AS version")).collect()[0]
    assert (c.cities, c.active_cities, c.version) == (4, 3, 5)


def test_registry_read_write(spark, tmp):
    path = f"{tmp}/cities.json"
    with open(path, "w") as f:
        json.dump(SHIPPED, f, indent=2)
    reg = files.read_registry(spark, path)
    assert reg.count() == 4 and {r.version for r in reg.collect()} == {5}
    assert files.read_registry(spark, f"{tmp}/absent.json").count() == 0
    out = sinks.write_registry(reg.drop("version", "updated_at", "updated_by"), f"{tmp}/reg", 6, "tests")
    back = files.read_registry_version(spark, f"{tmp}/reg", 6)
    assert out.endswith("v=6") and back.count() == 4
    assert {r.updated_by for r in back.collect()} == {"tests"}


def test_label_match_is_anchored_and_quoted(spark):
    df = spark.createDataFrame([("c1",), ("c10",), ("a.b",), ("axb",)], "v string")
    assert rows(df.where(label_match("v", ["c1", "a.b"]))) == [("a.b",), ("c1",)]
    assert df.where(label_match("v", None)).count() == 4


def test_global_row_number_large_and_wide(spark, tmp):
    """300,000 rows with a wide payload, written and read back: exactly 1..n."""
    df = spark.range(0, 300_000, 1, 24).selectExpr(
        "(id * 7919 + 13) % 1000003 AS seq", "repeat(sha2(cast(id AS string), 256), 2) AS payload")
    cities.change_log(100, df, seq="seq").write.parquet(f"{tmp}/log")
    back = spark.read.parquet(f"{tmp}/log")
    from pyspark.sql import Window
    from pyspark.sql import functions as F
    want = df.withColumn("want", 100 + F.row_number().over(Window.orderBy("seq"))).drop("payload")
    both = back.join(want, "seq")
    assert back.count() == 300_000 == both.where("version = want AND length(payload) = 128").count()


def test_global_row_number_ties_nulls_and_empty(spark):
    df = spark.createDataFrame([(None, 1), (5, 1), (5, 2), (5, 3), (1, 9), (None, 0)], "k int, t int")
    out = cities.global_row_number(df.repartition(4), ["k", "t"], "rn")
    assert [(r.k, r.t) for r in out.orderBy("rn").collect()] == [(None, 0), (None, 1), (1, 9), (5, 1), (5, 2), (5, 3)]
    assert cities.global_row_number(df.limit(0), ["k"]).count() == 0


def _apply_in_order(base, changes):
    """One change after the other, as a service would."""
    reg = {r[0]: r for r in base}
    accepted, rejected = [], []
    for op, seq, i, name, country, lat, lon, active in sorted(changes, key=lambda c: (c[1], c[0])):
        if op == "create":
            i = f"{name}-{country}".lower()
            country = country.upper()
            active = True if active is None else active
        bad = op in ("create", "update") and (len(country or "") != 2 or not -90 <= lat <= 90)
        if bad or (op != "create" and i not in reg):
            rejected.append((i, seq))
            continue
        accepted.append((i, seq))
        if op in ("create", "update"):
            reg[i] = (i, name, country, lat, lon, active)
        elif op == "delete":
            del reg[i]
        else:
            r = reg[i]
            reg[i] = (*r[:5], not (True if r[5] is None else r[5]))
    return reg, accepted, rejected


def test_changes_apply_in_order(spark):
    import random
    rng = random.Random(9)
    base = [(f"city{k}-fr", f"city{k}", "FR", 1.0, 1.0, rng.choice([True, False, None])) for k in range(8)]
    seqs = rng.sample(range(1000), 300)
    ch = []
    for s in seqs:
        k = rng.randrange(12)
        op = rng.choice(["create", "update", "delete", "toggle", "toggle"])
        ch.append((op, s, f"city{k}-fr", f"city{k}", rng.choice(["fr", "fr", "f"]) if op == "create" else "FR",
                   rng.choice([2.0, 3.0, 3.0, 95.0]), 1.0, rng.choice([True, False, None])))
    reg, acc, rej = cities.apply_changes(
        spark.createDataFrame(base, CITY),
        spark.createDataFrame(ch, "op string, seq long, id string, name string, country string, lat double, lon double, active boolean"))
    want, w_acc, w_rej = _apply_in_order(base, ch)
    assert rows(reg) == rows(spark.createDataFrame(list(want.values()), CITY))
    assert sorted((r.id, r.seq) for r in acc.collect()) == sorted(w_acc)
    assert sorted((r.id, r.seq) for r in rej.collect()) == sorted(w_rej)


def test_upsert_never_repeats_an_id(spark):
    base = _reg(spark).where("id <> ''")
    chg = spark.createDataFrame([("x", "A", "FR", 1.0, 1.0, True), ("x", "B", "FR", 1.0, 1.0, True)], CITY)
    assert rows(cities.upsert(base, chg).where("id = 'x'"), "name") == [("B",)]
