"""Ordered scans equal plain loops, also where a key lies in several partitions."""

import random

import pytest
from pyspark.sql import functions as F

from trailgrain.plans import crawl


def rows(seed, n=600):
    rng = random.Random(seed)
    return [(i, rng.choice(["hot"] * 8 + ["a", "b", None]), rng.randrange(4000)) for i in range(n)]


@pytest.fixture(params=[1, 7, 40])
def frame(spark, request):
    before = spark.conf.get("spark.sql.shuffle.partitions"), spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.shuffle.partitions", request.param)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 37)
    yield lambda data: spark.createDataFrame(data, "id long, host string, at long")
    spark.conf.set("spark.sql.shuffle.partitions", before[0])
    spark.conf.set("spark.sql.adaptive.enabled", before[1])
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


@pytest.mark.parametrize("gap", [0, 3, 50])
def test_throttled(frame, gap):
    data, last, expected = rows(gap), {}, {}
    for i, host, at in sorted(data, key=lambda r: (r[2], r[0])):
        last[host] = max(at, last[host] + gap) if host in last else at
        expected[i] = last[host]
    got = crawl.throttled(frame([*data, (9999, "hot", None)]), "host", "at", "id", gap).collect()
    assert {r["id"]: r["start_ms"] for r in got} == expected | {9999: None}


@pytest.mark.parametrize("quiet", [0, 5, 30])
def test_debounced(frame, quiet):
    data, following, expected = rows(quiet), {}, set()
    for i, host, at in sorted(data, key=lambda r: (-r[2], -r[0])):
        if host not in following or following[host] - at >= quiet:
            expected.add(i)
        following[host] = at
    got = [r["id"] for r in crawl.debounced(frame([*data, (9999, "hot", None)]), "host", "at", "id", quiet).collect()]
    assert sorted(got) == sorted(expected)


def test_empty_tables(frame):
    empty = frame([(1, "a", 1)]).where(F.lit(False))
    assert crawl.throttled(empty, "host", "at", "id").count() == 0 and crawl.debounced(empty, "host", "at", "id").count() == 0
