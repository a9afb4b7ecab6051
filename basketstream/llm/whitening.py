"""Whitening of embeddings by polarisation covariance.

An entry c counts as the whole number x = floor(1024 c) + 100000, so every sum below
is a sum of whole numbers and exact whatever the order in which tasks are added up.

*Covariance.* Values are centred first: z = x - m, m being the whole number next to
the mean of the dimension. For every dimension and for every sum of two dimensions
the squares are added up: sum z_i^2 and sum (z_i + z_j)^2. What is left of the mean,
half a unit at most, is taken out of each exactly (n sum z^2 - (sum z)^2), and a
cross-covariance is what the variance of a sum has more than both variances:
2 cov(i, j) = var(i + j) - var(i) - var(j). The matrix goes to ``eigh``.

*Sums of any size.* Tasks add up in Python or 64-bit numbers, whichever holds the
batch, and give each total in digits of 40 bits. Spark adds the digits as longs, one
key per dimension pair and digit, combined on the map side: a task sends a number of
rows that depends on the dimensions alone, and the driver receives as many.

Defined cases: vectors that are null or hold null, NaN or infinite entries are
dropped; so are those whose length is not the most frequent one (the longest of
several) and empty ones. Null and repeated ids are carried as they are. Components
without variance (up to rounding) are left out, so that a single row or equal rows
give no rows; an empty table gives an empty result. Further columns are ignored.
"""

from fractions import Fraction
from math import floor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from basketstream.llm.common import batch_of, write_once

SCALE, SHIFT = 1024, 100_000
COMPONENTS = 8
DIGIT = 40  # bits
SAFE = 1 << 20  # |z| below which a batch of up to 2^20 rows is added up in 64 bits
ROUNDING = 1e-12  # eigenvalues below this part of the largest are rounding


def whole(values: np.ndarray) -> np.ndarray:
    """x of finite values: int64 where all are small, else Python numbers."""
    scaled = np.floor(values.astype(np.float64) * SCALE) if len(values) and np.abs(values).max() < 1e9 else None
    if scaled is not None:
        return scaled.astype(np.int64) + SHIFT
    flat = [floor(SCALE * Fraction(float(v))) + SHIFT for v in values.ravel()]
    return np.array(flat, object).reshape(values.shape)


def centred(values: np.ndarray, middle: list) -> np.ndarray:
    """z = x - middle as int64 if squares of pair sums can be added up, else as Python numbers."""
    z = whole(values).astype(object) - np.array(middle, object) if max(map(abs, middle), default=0) > 1 << 40 else (
        whole(values) - np.array(middle, np.int64))
    if z.dtype == object and z.size and max(abs(v) for v in z.ravel()) < SAFE:
        return z.astype(np.int64)
    return z if z.dtype == object or not z.size or np.abs(z).max() < SAFE else z.astype(object)


def digits(value: int):
    """(index, digit) with value = sum digit * 2^(40 index); digits lie within half a place of zero."""
    at = 0
    while value:
        low = ((value + (1 << DIGIT - 1)) & ((1 << DIGIT) - 1)) - (1 << DIGIT - 1)
        if low:
            yield at, low
        value, at = (value - low) >> DIGIT, at + 1


def usable(embeddings: DataFrame, id_column="vec_id", vector_column="embedding") -> DataFrame:
    """vec_id and vector (doubles) of the rows without null or non-finite entries."""
    vector = F.col(f"`{vector_column}`").cast("array<double>")
    fine = F.forall("vector", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return embeddings.select(F.col(f"`{id_column}`").alias("vec_id"), vector.alias("vector")).where(fine & (F.size("vector") > 0))


def matrix(batch: pa.RecordBatch) -> np.ndarray:
    lists = batch.column(batch.schema.get_field_index("vector"))
    return lists.flatten().to_numpy(zero_copy_only=False).reshape(len(lists), -1)


SUM = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("digit", pa.int32()), ("value", pa.int64())])


def _totals(rows: DataFrame, add) -> dict:
    """{(i, j): total} of what ``add(values)`` gives per batch: a list of ((i, j), whole number)."""

    def sums(batches):
        total = {}
        for batch in batches:
            for key, value in add(matrix(batch)):
                total[key] = total.get(key, 0) + value
        found = [(*key, at, low) for key, value in total.items() for at, low in digits(value)]
        if found:
            yield batch_of(SUM, zip(*found))

    parts = rows.select("vector").mapInArrow(sums, "i int, j int, digit int, value long")
    out = {}
    for row in parts.groupBy("i", "j", "digit").agg(F.sum("value").alias("value")).collect():
        out[row.i, row.j] = out.get((row.i, row.j), 0) + (row.value << (DIGIT * row.digit))
    return out


def _pair_squares(values: np.ndarray, middle: list):
    """Sums of z, z^2 and of (z_i + z_j)^2 as ((i, -1), .), ((i, i), .) and ((i, j), .)."""
    z = centred(values, middle)
    for i in range(z.shape[1]):
        yield (i, -1), int(z[:, i].sum())
        yield (i, i), int((z[:, i] ** 2).sum())
        both = ((z[:, i : i + 1] + z[:, i + 1 :]) ** 2).sum(axis=0)
        for j, value in enumerate(both.tolist(), i + 1):
            yield (i, j), int(value)


class Whitening:
    """n, whole sums S, covariance V, eigenvalues and unit eigenvectors by falling eigenvalue (rows of ``axes``)."""

    def __init__(self, n: int, sums: list, middle: list, squares: dict):
        size = len(sums)
        rest = [squares.get((i, -1), 0) for i in range(size)]
        spread = [n * squares.get((i, i), 0) - rest[i] ** 2 for i in range(size)]  # n^2 var
        scale = n * n
        self.n, self.sums, self.middle, self.rest = n, sums, middle, rest
        self.covariance = np.empty((size, size))
        for i in range(size):
            self.covariance[i, i] = Fraction(spread[i], scale)
            for j in range(i + 1, size):
                of_sum = n * squares.get((i, j), 0) - (rest[i] + rest[j]) ** 2
                self.covariance[i, j] = self.covariance[j, i] = Fraction(of_sum - spread[i] - spread[j], 2 * scale)
        self.trace = float(Fraction(sum(spread), scale))
        values, vectors = np.linalg.eigh(self.covariance)
        real = values > ROUNDING * max(values[-1], 0)
        self.values, self.axes = values[real][::-1], vectors[:, real].T[::-1]

    def deviations(self, z: np.ndarray) -> list:
        """Sum over dimensions of (n x - S)^2 as whole numbers."""
        bound = self.n * (int(np.abs(z).max()) if z.size else 0) + max(map(abs, self.rest), default=0)
        exact = z if z.dtype != object and bound * bound * z.shape[1] < 1 << 63 else z.astype(object)
        return ((self.n * exact - np.array(self.rest, exact.dtype)) ** 2).sum(axis=1).tolist()

    def project(self, z: np.ndarray, components: int) -> np.ndarray:
        """(x - S/n) on the components, each over the root of its eigenvalue."""
        apart = np.asarray(z, np.float64) - np.array([Fraction(r, self.n) for r in self.rest], np.float64)
        return apart @ (self.axes[:components] / np.sqrt(self.values[:components, None])).T

    def whiten(self, rows: DataFrame, components: int) -> DataFrame:
        """vec_id, deviation (null above 38 digits), whitened (an array) of usable rows of the fitted length."""
        schema = pa.schema([("vec_id", rows.select("vec_id").limit(0).toArrow().schema.field(0).type),
                            ("deviation", pa.decimal128(38, 0)), ("whitened", pa.list_(pa.float64()))])

        def each(batches):
            from decimal import Decimal

            for batch in batches:
                z = centred(matrix(batch), self.middle)
                far = [Decimal(v) if v < 10**38 else None for v in self.deviations(z)]
                yield batch_of(schema, (batch.column("vec_id"), far, list(self.project(z, components))))

        kind = rows.schema["vec_id"].dataType.simpleString()
        return rows.mapInArrow(each, f"vec_id {kind}, deviation decimal(38,0), whitened array<double>")


def fit(embeddings: DataFrame, id_column="vec_id", vector_column="embedding"):
    """(usable rows of the fitted length, ``Whitening``); the second is None if there is no row."""
    rows = usable(embeddings, id_column, vector_column)
    size = F.size("vector")
    common = rows.groupBy(size.alias("size")).count().orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    if not common:
        return rows, None
    rows, n = rows.where(size == common[0]["size"]), common[0]["count"]
    sums = _totals(rows, lambda values: (((i, -1), int(v)) for i, v in enumerate(whole(values).sum(axis=0).tolist())))
    sums = [sums.get((i, -1), 0) for i in range(common[0]["size"])]
    middle = [round(Fraction(s, n)) for s in sums]
    return rows, Whitening(n, sums, middle, _totals(rows, lambda values: _pair_squares(values, middle)))


def identity_error(white: DataFrame, components: int, n: int) -> float:
    """Largest absolute entry of the covariance of ``whitened`` (centred already, but for rounding) minus the identity."""
    at = [F.element_at("whitened", c + 1) for c in range(components)]
    means = [F.avg(c) for c in at]
    pairs = [(i, j) for i in range(components) for j in range(i, components)]
    row = white.agg(F.array(*means).alias("mean"), F.array(*(F.sum(at[i] * at[j]) for i, j in pairs)).alias("both")).first()
    return max(abs(both / n - row["mean"][i] * row["mean"][j] - (i == j)) for (i, j), both in zip(pairs, row["both"]))


def whitened(embeddings: DataFrame, components: int = COMPONENTS, id_column="vec_id", vector_column="embedding") -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error of every usable row and component."""
    rows, model = fit(embeddings, id_column, vector_column)
    kind = rows.schema["vec_id"].dataType.simpleString()
    count = 0 if model is None else min(components, len(model.values))
    if not count:
        return embeddings.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double")
    white = write_once(model.whiten(rows, count), "whitened")
    explained = F.array(*(F.lit(float(v / model.trace)) for v in model.values[:count]))
    return white.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
        explained[F.col("at")].alias("explained"), F.lit(identity_error(white, count, model.n)).alias("identity_error"))
