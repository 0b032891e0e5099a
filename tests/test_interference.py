"""Interference flagging of whole tables against plain loops over planes."""

import math

import numpy as np
import pytest

from radiospark.functions.numbers import amp
from radiospark.plans import registry
from radiospark.sources import fixtures as fx


class Plane:
    """One baseline and correlation: values and flags of the times and channels that occur, None where a sample is absent."""

    def __init__(self, rows):
        self.times, self.chans = (sorted({r[k] for r in rows}) for k in ("scan", "chan"))
        at = {(r["scan"], r["chan"]): r for r in rows}
        self.there = [[(t, c) in at for c in self.chans] for t in self.times]
        self.amp = [[at[t, c]["amp"] if (t, c) in at else None for c in self.chans] for t in self.times]
        self.flag = [[bool(at[t, c]["flag"]) if (t, c) in at else True for c in self.chans] for t in self.times]

    def cells(self):
        return [(i, j) for i in range(len(self.times)) for j in range(len(self.chans)) if self.there[i][j]]


def median(values):
    v = sorted(values)
    return (v[(len(v) - 1) // 2] + v[len(v) // 2]) / 2


def line_hits(values, bad, level):
    """SumThreshold along one line."""
    flags, n = list(bad), 1
    while n <= min(64, len(values)):
        hits = set()
        for a in range(len(values) - n + 1):
            good = [values[k] for k in range(a, a + n) if not flags[k]]
            if good and abs(sum(good)) > level * 1.5 ** -math.log2(n) * len(good) * (1 + 1e-12):
                hits |= set(range(a, a + n))
        flags = [f or k in hits for k, f in enumerate(flags)]
        n *= 2
    return flags


def sum_threshold(plane, value, level):
    good = [value[i][j] for i, j in plane.cells() if not plane.flag[i][j]]
    if not good:
        return
    middle = median(good)
    spread = 1.4826 * median([abs(v - middle) for v in good]) or 1.0
    bad = plane.flag
    scaled = [[0.0 if bad[i][j] else (value[i][j] - middle) / spread for j in range(len(plane.chans))] for i in range(len(plane.times))]
    rows = [line_hits(scaled[i], bad[i], level) for i in range(len(plane.times))]
    columns = [line_hits([r[j] for r in scaled], [r[j] for r in bad], level) for j in range(len(plane.chans))]
    for i, j in plane.cells():
        plane.flag[i][j] = bad[i][j] or rows[i][j] or columns[j][i]


def high_pass(plane):
    out = [[None] * len(plane.chans) for _ in plane.times]
    good = [(i, j) for i, j in plane.cells() if not plane.flag[i][j]]
    for i, j in plane.cells():
        weights = [math.exp(-((i - a) ** 2) / 12.5) * math.exp(-((j - b) ** 2) / 50.0) for a, b in good]
        total = sum(weights)
        smooth = sum(w * plane.amp[a][b] for w, (a, b) in zip(weights, good)) / total if total > 1e-12 else 0.0
        out[i][j] = plane.amp[i][j] - smooth
    return out


def rms_threshold(plane, value, axis, level):
    lines = {}
    for i, j in plane.cells():
        if not plane.flag[i][j]:
            lines.setdefault((i, j)[axis], []).append(value[i][j] ** 2)
    rms = {k: math.sqrt(sum(v) / len(v)) for k, v in lines.items()}
    if not rms:
        return
    mean = sum(rms.values()) / len(rms)
    std = math.sqrt(sum((v - mean) ** 2 for v in rms.values()) / len(rms))
    far = {k for k, v in rms.items() if abs(v - mean) > level * std}
    for i, j in plane.cells():
        plane.flag[i][j] = plane.flag[i][j] or (i, j)[axis] in far


def rank(plane, axis, level):
    lines = {}
    for i, j in plane.cells():
        lines.setdefault((i, j)[1 - axis], []).append((i, j))
    for cells in lines.values():
        flags = [plane.flag[i][j] for i, j in cells]
        n = len(cells)
        for k, (i, j) in enumerate(cells):
            plane.flag[i][j] = any(sum(level if f else level - 1 for f in flags[a:b]) >= -1e-9 for a in range(k + 1) for b in range(k + 1, n + 1))


def schedule(plane):
    value = plane.amp
    sum_threshold(plane, value, 16.0)
    rms_threshold(plane, value, 0, 3.5)
    rms_threshold(plane, value, 1, 12.0)
    value = high_pass(plane)
    sum_threshold(plane, value, 4.0)
    rank(plane, 0, 0.2)
    rank(plane, 1, 0.2)
    rms_threshold(plane, plane.amp, 0, 4.0)


@pytest.fixture(scope="module")
def samples(spark, sf_dir):
    planes = {}
    for r in fx.vis(spark, sf_dir).where("ant1 != ant2").withColumn("amp", amp()).collect():
        planes.setdefault((r["ant1"], r["ant2"], r["corr"]), []).append(r)
    return planes


def compared(spark, sf_dir, samples, name, column, work):
    got = {tuple(r[c] for c in ("ant1", "ant2", "corr", "scan", "chan")): r[column] for r in registry.queries()[name](spark, sf_dir).collect()}
    assert len(got) == sum(map(len, samples.values()))
    wrong = 0
    for key, rows in samples.items():
        plane = Plane(rows)
        want = work(plane) or plane.flag
        for i, j in plane.cells():
            there = got[(*key, plane.times[i], plane.chans[j])]
            wrong += abs(there - want[i][j]) > 1e-5 if column == "residual" else there != want[i][j]
    return wrong, got


def test_sum_threshold_on_the_whole_table(spark, sf_dir, samples):
    wrong, got = compared(spark, sf_dir, samples, "r1_sum_threshold", "flag", lambda p: sum_threshold(p, p.amp, 3.0))
    assert wrong == 0 and 0 < np.mean(list(got.values())) < 1


def test_high_pass_on_the_whole_table(spark, sf_dir, samples):
    assert compared(spark, sf_dir, samples, "r4_high_pass", "residual", high_pass)[0] == 0


def test_schedule_on_the_whole_table(spark, sf_dir, samples):
    wrong, got = compared(spark, sf_dir, samples, "r8_flag_schedule", "flag", schedule)
    assert wrong == 0 and 0 < np.mean(list(got.values())) < 1
