import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from claimloom.operators import retrieval
from claimloom.streaming import throttle

FIELDS = "host string, seq bigint, status int, retry_after int, arrived timestamp"
START = datetime(2026, 1, 1)


@pytest.fixture(scope="module")
def keyed(spark):
    key = "spark.sql.streaming.stateStore.providerClass"
    spark.conf.set(key, throttle.STATE_STORE)
    yield spark
    spark.conf.unset(key)


def run(spark, tmp_path, parts, **options):
    """Outcomes of parts that arrive one after another; the query ends after each and starts again from its checkpoint."""
    (tmp_path / "in").mkdir()
    for part in parts:
        spark.createDataFrame(part, FIELDS).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        stream = spark.readStream.schema(FIELDS).parquet(str(tmp_path / "in"))
        found = throttle.outcomes(stream, **options).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "state")).trigger(availableNow=True).start(str(tmp_path / "out"))
        found.awaitTermination()
    return spark.read.parquet(str(tmp_path / "out"))


@pytest.mark.parametrize("parts", [1, 3])
def test_any_split_gives_the_outcomes_of_a_batch(keyed, tmp_path, parts):
    rng = random.Random(4)
    rows = [(f"h{rng.randrange(6)}", n, rng.choice([200, 200, 403, 404, 429, 503]), rng.choice([None, 5, 60]), START + timedelta(seconds=n)) for n in range(240)]
    edges = sorted(rng.sample(range(1, 240), parts - 1))
    found = run(keyed, tmp_path, [rows[a:b] for a, b in zip([0, *edges], [*edges, 240])])
    told = {(r.host, r.seq): r.outcome for r in found.filter("seq IS NOT NULL").collect()}
    batch = retrieval.outcomes(keyed.createDataFrame(rows, FIELDS))
    assert told == {(r.host, r.seq): r.outcome for r in batch.collect()} and set(told.values()) == {"ok", "failed", "retried", "deferred", "quarantined"}
    waits = found.filter("outcome = 'deferred'").join(keyed.createDataFrame(rows, FIELDS), ["host", "seq"]).select((F.unix_timestamp("resume_at") - F.unix_timestamp("arrived")).alias("wait"))
    assert {r.wait for r in waits.collect()} == {60}


def test_hosts_resume_and_are_forgotten(keyed, tmp_path):
    at = lambda s: START + timedelta(seconds=s)
    parts = [
        [("a", 1, 429, 100, at(0)), ("b", 1, 403, None, at(0)), ("b", 2, 403, None, at(1)), ("b", 3, 403, None, at(2)), ("b", 4, 429, 500, at(3)), ("c", 1, 503, 60, at(3))],
        [("c", 2, 503, 600, at(50)), ("b", 5, 200, None, at(60))],
        [("d", 1, 200, None, at(400))],
        [("d", 2, 200, None, at(2000))],
        [("b", 6, 200, None, at(2100)), ("d", 3, 200, None, at(2100))],
    ]
    found = run(keyed, tmp_path, parts, delay="1 second", quiet_ms=900_000)
    told = {(r.host, r.seq): r.outcome for r in found.filter("seq IS NOT NULL").collect()}
    assert [told["b", n] for n in range(1, 6)] == ["failed"] * 3 + ["quarantined"] * 2
    assert told["b", 6] == "ok"  # after a quarter of an hour without a request
    resumed = {(r.host, r.resume_at) for r in found.filter("outcome = 'resumed'").collect()}
    assert resumed == {("a", at(100)), ("c", at(650))}
