"""Single linkage over spanning forests, and the adaptive cut, against plain loops."""

import itertools
import math
import random

from pyspark.sql import functions as F

from radiospark.operators import sources
from radiospark.operators.spanning import linkage, spanning_forest


def merges_of(points):
    """Merge heights by joining the two closest clusters again and again."""
    parts, heights = [{p} for p in points], []
    while len(parts) > 1:
        (w, i, j) = min((min(math.dist(p, q) for p in a for q in b), i, j) for (i, a), (j, b) in itertools.combinations(enumerate(parts), 2))
        parts[i] |= parts.pop(j)
        heights.append(w)
    return sorted(heights)


def parts_at(points, cut):
    left, out = set(points), []
    while left:
        part, stack = set(), [left.pop()]
        while stack:
            p = stack.pop()
            part.add(p)
            near = {q for q in left if math.dist(p, q) <= cut}
            left -= near
            stack += near
        out.append(frozenset(part))
    return set(out)


def cut_of(z, apart=14.0):
    """The rule in words of the dendrogram: merges z from low to high."""
    if len(z) == 1:
        return 1.0
    cut = apart if z[-1] - z[-2] > apart else z[-1]
    above = [w for w in z if w > cut]
    below = [w for w in z if w <= cut]
    if len(z) <= 3 or z[-1] == 1 or not below:
        return cut
    step = z[-1] - z[-2] if not above else above[0] - below[-1]
    over = above[1] - above[0] if len(above) > 1 else 0
    if len(z) == len(above) + 1:
        return cut
    return 2 * apart if step < 2 * apart and over < apart else cut


def fixtures():
    rng = random.Random(8)
    for k in range(100):
        seeds = [(rng.randrange(120), rng.randrange(120)) for _ in range(1 + k % 5)]
        points = {(max(0, x + round(rng.gauss(0, 1 + k % 7))), max(0, y + round(rng.gauss(0, 1 + k % 7)))) for x, y in seeds for _ in range(rng.randrange(1, 9))}
        if k % 10 == 0:
            points |= {(x + 60, y + 20) for x in range(9) for y in range(9)}  # a filled square, whose inner points are left out
        yield k, sorted(points)


def test_adaptive_clusters_against_plain_single_linkage(spark):
    rows = [(k, x, y) for k, points in fixtures() for x, y in points]
    hits = spark.createDataFrame(rows, "image_id long, x int, y int").repartition(6)
    heights, cuts, found = {}, {}, {}
    merges = linkage(hits, ["image_id"], 250.0)
    for r in merges.select("image_id", "w").collect():
        heights.setdefault(r["image_id"], []).append(r["w"])
    for r in sources.cut_heights(merges, ["image_id"]).collect():
        cuts[r["image_id"]] = r["cut"]
    for r in sources.adaptive_clusters(hits, ["image_id"], 250.0).collect():
        found.setdefault(r["image_id"], {}).setdefault(r["cluster"], set()).add((r["x"], r["y"]))
    moved = 0
    for k, points in fixtures():
        want = merges_of(points)
        assert sorted(heights.get(k, [])) == want, k
        cut = cut_of(want) if want else 1.0
        assert cuts.get(k, 1.0) == cut, (k, want)
        moved += cut == 28.0
        assert {frozenset(p) for p in found[k].values()} == parts_at(points, cut), k
        assert all(min(p, key=lambda q: (q[1], q[0])) == (c % (1 << 20), c >> 20) for c, p in found[k].items())
    assert 10 < moved < 90 and {1.0, 14.0, 28.0} < set(cuts.values())


def test_spanning_forest(spark):
    rng = random.Random(9)
    edges = [(rng.randrange(60), rng.randrange(60), float(rng.randrange(6))) for _ in range(150)] + [(100, 101, 1.0), (101, 100, 1.0), (7, 7, 0.0)]
    forest, labels = spanning_forest(spark.createDataFrame(edges, "a long, b long, w double"))
    root = {n: n for e in edges for n in e[:2]}

    def find(n):
        while root[n] != n:
            n = root[n]
        return n

    total = 0.0
    for w, a, b in sorted((w, min(a, b), max(a, b)) for a, b, w in edges):
        if find(a) != find(b):
            root[find(a)] = find(b)
            total += w
    got = forest.collect()
    assert sum(r["w"] for r in got) == total and len(got) == len(root) - len({find(n) for n in root})
    groups = {}
    for r in labels.collect():
        groups.setdefault(r["root"], set()).add(r["node"])
    assert {frozenset(g) for g in groups.values()} == {frozenset(n for n in root if find(n) == f) for f in {find(n) for n in root} if f != 7 or find(7) != 7 or sum(find(n) == 7 for n in root) > 1}


def test_hits_of_large_image_ids_and_empty_tables(spark):
    hits = spark.createDataFrame([((1 << 40) + 1, 3, 4), ((1 << 40) + 1, 3, 5), ((1 << 40) + 2, 3, 5)], "image_id long, x int, y int")
    assert sorted((r["image_id"] - (1 << 40), r["cluster"]) for r in sources.clusters(hits, 1.5).collect()) == [(1, (4 << 20) + 3), (1, (4 << 20) + 3), (2, (5 << 20) + 3)]
    assert sources.clusters(hits.where("false"), 1.5).count() == 0 and sources.adaptive_clusters(hits.where("false"), ["image_id"], 9.0).count() == 0
    assert sources.adaptive_clusters(hits.where("image_id % 2 = 0"), ["image_id"], 9.0).select(F.count("cluster")).first()[0] == 1
