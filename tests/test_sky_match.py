"""Nearest sources on the sky against all pairs, and the number of pairs that the search looks at."""

import math
import random

import pytest
from pyspark.sql import functions as F

from radiospark.operators import sources

SKY = "id long, ra double, dec double"


def distance(a, b):
    p, q, d = math.radians(a[1]), math.radians(b[1]), math.radians(a[0] - b[0])
    return math.degrees(math.atan2(math.hypot(math.cos(q) * math.sin(d), math.cos(p) * math.sin(q) - math.sin(p) * math.cos(q) * math.cos(d)), math.sin(p) * math.sin(q) + math.cos(p) * math.cos(q) * math.cos(d)))


def whole_sky(rng, n):
    return [(rng.uniform(0, 360), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(n)]


@pytest.mark.parametrize("crowd", [0, 120])
def test_nearest_is_exact(spark, crowd):
    rng = random.Random(crowd)
    known = whole_sky(rng, 40) + [(rng.gauss(83, 0.02), rng.gauss(22, 0.02)) for _ in range(crowd)] + [(0.0, 90.0), (180.0, -90.0)]
    asked = whole_sky(rng, 150) + [(rng.gauss(83, 0.05), rng.gauss(22, 0.05)) for _ in range(crowd)] + [(359.99, 0.0), (0.01, 89.99), (0.0, -90.0)]
    left = spark.createDataFrame([(k, *p) for k, p in enumerate(asked)], SKY)
    right = spark.createDataFrame([(k, *p) for k, p in enumerate(known)], "pid long, ra double, dec double")
    for first in (None, 4.0, 0.01):
        got = {r["id"]: r["near"]["sep"] for r in sources.nearest_on_sky(left, right, first).collect()}
        for k, p in enumerate(asked):
            assert abs(got[k] - min(distance(p, q) for q in known)) < 1e-7
    assert sources.nearest_on_sky(left, right.where("false")).count() == 0


def test_pairs_of_a_row_do_not_grow_with_the_catalogues(spark):
    """Whole-sky catalogues of 1,000, 10,000 and 100,000 sources, each matched with one as large."""
    counts = {}
    for n in (1_000, 10_000, 100_000):
        sky = lambda seed: spark.range(n).select("id", (F.rand(seed) * 360).alias("ra"), F.degrees(F.asin(F.rand(seed + 1) * 2 - 1)).alias("dec"))  # noqa: E731, B023
        right = sky(5).withColumnRenamed("id", "pid")
        counts[n] = sources.sky_candidates(sky(1), right, sources.first_height(right)).count() / n
    assert max(counts.values()) < 1.6 * min(counts.values()) and max(counts.values()) < 60, counts
