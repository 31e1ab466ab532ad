import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from eventide.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", shuffle_partitions=4, app_name="eventide-tests",
                      extra={"spark.driver.memory": "4g"})
    yield s
    s.stop()


def sensor_rows(spark, text: str, unit_ms: int = 1000):
    """Sensor lines (``id,time,temperature``) in arrival order -> DataFrame
    with ``event_id`` (= arrival index), ``t_ms``, ``ts`` and ``arr_ms``."""
    rows = []
    for i, line in enumerate(x for x in text.strip("\n").splitlines() if x.strip()):
        sid, t, temp = line.split(",")
        rows.append((i, sid, int(t) * unit_ms, float(temp)))
    from pyspark.sql import functions as F
    df = spark.createDataFrame(rows, "event_id long, id string, t_ms long, temperature double")
    return df.withColumn("ts", F.timestamp_millis("t_ms")).withColumn("arr_ms", F.col("event_id"))
