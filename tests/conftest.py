import json
import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from stratus.session import get_session

    s = get_session(
        "stratus-tests", master="local[*]", shuffle_partitions=8,
        extra={"spark.checkpoint.dir": tempfile.mkdtemp(prefix="stratus-test-ckpt-"),
               "spark.driver.memory": "4g"},
    )
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)


def raw_event(city="paris-fr", name="Paris", country="FR", times=None, temps=None, hums=None,
              winds=None, current=None, ingested_at="2025-01-01T00:30:00Z", drop=(), raw=None):
    """A raw event as the producer builds it (arrays under hourly and raw.hourly)."""
    hourly = {
        "time": times if times is not None else ["2025-01-01T00:00", "2025-01-01T01:00"],
        "temperature_2m": temps if temps is not None else [1.5, 2.5],
        "relative_humidity_2m": hums if hums is not None else [80.0, 81.0],
        "wind_speed_10m": winds if winds is not None else [3.0, 4.0],
    }
    for k in drop:
        hourly.pop(k, None)
    ev = {
        "_meta": {"city_id": city, "city_name": name, "country": country,
                  "ingested_at": ingested_at},
        "source": "open-meteo",
        "current": current,
        "hourly": hourly,
        "raw": raw if raw is not None else {"hourly": hourly, "current": current},
    }
    return json.dumps(ev)


def _key(t):
    # Sort with NULLs first, whatever the column types.
    return tuple((v is not None, v) for v in t)


def rows(df, *cols):
    cols = cols or df.columns
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=_key)
