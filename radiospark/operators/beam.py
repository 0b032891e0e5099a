"""Beams and polarisation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


#: Correlations (XX, XY, YX, YY) that make up each Stokes parameter (I, Q, U, V), and the other way.
TO_STOKES = ((0.5, 0, 0, 0.5), (0.5, 0, 0, -0.5), (0, 0.5, 0.5, 0), (0, -0.5j, 0.5j, 0))
FROM_STOKES = ((1, 1, 0, 0), (0, 0, 1, 1j), (0, 0, 1, -1j), (1, -1, 0, 0))

Complex = tuple[Column, Column]


def mueller(jones: list[Complex]) -> dict[str, Column]:
    """the Stokes Mueller matrix ``m00`` to ``m33`` of a Jones matrix (XX, XY, YX, YY), each entry (re, im).

    Correlation pq of what is seen takes J[p, r] * conj(J[q, s]) of correlation rs of the sky. The matrix is real and not
    normalised.
    """

    def term(weight: complex, p: int, q: int) -> Column:
        (a, b), (c, d) = jones[p], jones[q]
        return F.lit(float(weight.real)) * (a * c + b * d) - F.lit(float(weight.imag)) * (b * c - a * d)

    out = {}
    for i, seen in enumerate(TO_STOKES):
        for j in range(4):
            weights = {(pq, rs): complex(seen[pq] * FROM_STOKES[rs][j]) for pq in range(4) for rs in range(4)}
            terms = [term(w, 2 * (pq // 2) + rs // 2, 2 * (pq % 2) + rs % 2) for (pq, rs), w in weights.items() if w]
            out[f"m{i}{j}"] = sum(terms[1:], terms[0])
    return out


def without_leakage(pixels: DataFrame, factors: DataFrame, by: list[str], keys: list[str]) -> DataFrame:
    """images of all Stokes parameters (``stokes`` 0 to 3 of ``by``) divided by the beam, Q, U and V less what leaks
    from I.

    ``factors`` has the Mueller matrix of each of ``keys``. What has no I image loses nothing; where the beam is 0 the value
    is null.
    """
    named = pixels.join(factors.select(*keys, *(f"m{i}{j}" for i in range(4) for j in {0, i})), keys)
    bright = F.max(F.when(F.col("stokes") == 0, F.col("val"))).over(Window.partitionBy(*by, "x", "y"))
    pick = lambda kind: F.element_at(F.array(*(F.col(f"m{i}{i if kind == 'own' else 0}") for i in range(4))), F.col("stokes").cast("int") + 1)
    leaked = F.when(F.col("stokes") == 0, 0.0).otherwise(pick("leak") * F.coalesce(bright, F.lit(0.0)))
    return named.withColumn("val", F.try_divide(F.col("val") - leaked, pick("own"))).select(*pixels.columns)


def nearest_cell(df: DataFrame, grid: DataFrame, axes: dict[str, tuple[float, float]], values: list[str]) -> DataFrame:
    """Values of the nearest cell of a regular grid; axes gives each axis' (origin, step), the grid has integer
    columns ``<axis>_i``."""
    keyed = df.withColumns({f"{a}_i": F.rint((F.col(a) - o) / step).cast("bigint") for a, (o, step) in axes.items()})
    keys = [f"{a}_i" for a in axes]
    return keyed.join(grid.select(*keys, *values), keys, "left").drop(*keys)


def trilinear(df: DataFrame, grid: DataFrame, axes: dict[str, tuple[float, float]], values: str | list[str], key: str) -> DataFrame:
    """(key, values) by linear interpolation between the corners of the cell of a regular grid; null at its edge."""
    values = [values] if isinstance(values, str) else values
    out = df.select(key, *axes)
    for a, (o, step) in axes.items():
        place = (F.col(a) - o) / step
        out = out.withColumn(f"_{a}", F.floor(place).cast("bigint")).withColumn(f"_{a}_f", place - F.floor(place))
    sides = F.array(F.lit(0), F.lit(1))
    for a in axes:
        out = out.withColumn("_s", F.explode(sides)).withColumn(f"{a}_i", F.col(f"_{a}") + F.col("_s")).withColumn(f"_{a}_w", F.when(F.col("_s") == 1, F.col(f"_{a}_f")).otherwise(1 - F.col(f"_{a}_f"))).drop("_s")
    weight: Column = F.lit(1.0)
    for a in axes:
        weight = weight * F.col(f"_{a}_w")
    both = out.join(grid.select(*(f"{a}_i" for a in axes), *(F.col(v).alias(f"_v{k}") for k, v in enumerate(values))), [f"{a}_i" for a in axes], "left")
    held = lambda k: F.count_if((weight > 0) & F.col(f"_v{k}").isNull()) == 0
    total = lambda k: F.sum(weight * F.coalesce(f"_v{k}", F.lit(0.0)))
    return both.groupBy(key).agg(*(F.when(held(k), total(k)).alias(v) for k, v in enumerate(values)))


#: Columns of a grid of electric fields: those of the X and the Y antenna along theta and phi, real and imaginary.
FIELDS = [f"{pol}_{along}_{part}" for pol in "xy" for along in ("theta", "phi") for part in ("re", "im")]


def jones(df: DataFrame, grid: DataFrame, axes: dict[str, tuple[float, float]], key: str) -> DataFrame:
    """(key, the FIELDS) at each row's ``freq``, ``theta`` and ``phi``, over the amplitude at the zenith of that frequency.

    The amplitude is interpolated in frequency between those of the grid's own; that of a frequency is the root of half the
    sum of squares of the fields in cell (0, 0).
    """
    squares = [F.col(f) * F.col(f) for f in FIELDS]
    zenith = grid.where("theta_i = 0 and phi_i = 0").select("freq_i", F.sqrt(0.5 * sum(squares[1:], squares[0])).alias("_top"))
    top = trilinear(df, zenith, {"freq": axes["freq"]}, "_top", key)
    at = trilinear(df, grid, axes, FIELDS, key).join(top, key)
    return at.select(key, *(F.try_divide(f, "_top").alias(f) for f in FIELDS))
