"""Whitening of embeddings by an exact integer scatter.

An entry c counts as the whole number x = floor(SCALE * c) + SHIFT. What is fitted is each distinct vector once: tasks
subtract the shift, cut what is left into limbs of LIMB bits and multiply limb by limb, in doubles that hold every
partial sum exactly; these go into Python's integers, and a task hands on its sums and cross-products as digits of
DIGIT bits, which Spark adds up as longs. On the driver there are only n, the sums S and the cross-products X'X of the
dimensions, however many rows there are. n X'X - S S' is formed in integers, divided by n squared once, and only then
are there doubles, for eigh.

Components are numbered by falling eigenvalue, with their largest entry positive. Those whose eigenvalue isn't above
what rounding makes of nothing (dimensions * 2.2e-16 * the largest) have no whitened value and are left out: of n
equal vectors there are none, and no rows. `identity_error` is measured: whitened values of the fitted vectors, already
deviations from the exact mean, are multiplied and added up by Spark once more.

Rows whose vector is null or holds null or non-finite entries are dropped; beyond a long, SCALE * c counts as the
nearest long; a shorter vector, the empty one too, counts as padded with zeros. Repeated rows and ids give a result
each and count once in the fit; rows with a null id are whitened like others. An empty table gives an empty result;
other columns play no part. Sums are exact to 192 bits, so for any longs up to 2 ** 60 rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from floeframe.llm.common import Scratch

SCALE, SHIFT, COMPONENTS = 64, 1_000_000, 16
#: Limbs of LIMB bits: a product has 2 * LIMB, and EXACT rows of them stay below 2 ** 53.
LIMB, EXACT = 20, 4096
DIGIT, DIGITS = 32, 6
SUMS = "i int, j int, " + ", ".join(f"d{k} long" for k in range(DIGITS))
#: Whole numbers below this are deviated from the mean in longs, larger ones in Python's integers.
SAFE = 2**62


def shifted(vector: str) -> Column:
    """x - SHIFT of each entry, without the zeros at the end: equal for vectors that are equal once padded."""
    made = F.transform(vector, lambda c: F.floor(c.cast("double") * SCALE))
    last = F.array_max(F.transform(made, lambda v, i: F.when(v != 0, i + 1).otherwise(0)))
    return F.slice(made, 1, F.coalesce(last, F.lit(0)))


def usable(vector: str) -> Column:
    odd = lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))
    return F.col(vector).isNotNull() & ~F.exists(vector, odd)


def matrix(column: pa.Array, least: int = 0) -> np.ndarray:
    """Lists of whole numbers as the rows of a matrix, padded with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    made = np.zeros((len(column), max(least, lengths.max(initial=0))), dtype=np.int64)
    made[np.arange(made.shape[1])[None] < lengths[:, None]] = column.flatten().to_numpy()
    return made


def limbs(y: np.ndarray) -> list[np.ndarray]:
    """Doubles l_k with y = sum of l_k * 2 ** (LIMB * k), each below 2 ** LIMB."""
    made = []
    while y.size and max(int(y.max()), -int(y.min())) >= 2**LIMB:
        made.append((y & (2**LIMB - 1)).astype(np.float64))
        y = y >> LIMB
    return [*made, y.astype(np.float64)]


class Scatter:
    """n, sums and cross-products of rows of whole numbers, as Python's integers."""

    def __init__(self):
        self.n, self.sums, self.products = 0, np.zeros(0, dtype=object), np.zeros((0, 0), dtype=object)

    def add(self, rows: np.ndarray) -> None:
        w, held = rows.shape[1], len(self.sums)
        if w > held:
            sums, products = np.zeros(w, dtype=object), np.zeros((w, w), dtype=object)
            sums[:held], products[:held, :held] = self.sums, self.products
            self.sums, self.products = sums, products
        for at in range(0, len(rows), EXACT):
            parts = limbs(rows[at : at + EXACT])
            self.n += len(parts[0])
            for a, left in enumerate(parts):
                self.sums[:w] += left.sum(0).astype(np.int64).astype(object) * 2 ** (LIMB * a)
                for b, right in enumerate(parts):
                    self.products[:w, :w] += (left.T @ right).astype(np.int64).astype(object) * 2 ** (LIMB * (a + b))

    def rows(self) -> Iterator[tuple[int, ...]]:
        """(i, j, digits): the cross-product of dimensions i <= j, at j = -1 the sum of i, at i = -1 n."""
        yield (-1, -1, *digits(self.n))
        for i in range(len(self.sums)):
            yield (i, -1, *digits(self.sums[i]))
            for j in range(i, len(self.sums)):
                yield (i, j, *digits(self.products[i, j]))


def digits(whole: int) -> list[int]:
    """Of DIGIT bits, the least first; the last has the sign."""
    made = [(whole >> (DIGIT * k)) & (2**DIGIT - 1) for k in range(DIGITS - 1)]
    return [*made, whole >> (DIGIT * (DIGITS - 1))]


def summed(fitted: DataFrame) -> tuple[int, list[int], np.ndarray]:
    """n, sums and cross-products over all rows of fitted (y array<long>)."""
    schema = StructType.fromDDL(SUMS)
    arrow = to_arrow_schema(schema)

    def run(batches):
        held = Scatter()
        for batch in batches:
            held.add(matrix(batch.column(0)))
        if held.n:
            columns = [*zip(*held.rows())]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    added = fitted.mapInArrow(run, schema).groupBy("i", "j").agg(*(F.sum(f"d{k}").alias(f"d{k}") for k in range(DIGITS)))
    # as many rows as there are pairs of dimensions
    whole = {(r[0], r[1]): sum(d << (DIGIT * k) for k, d in enumerate(r[2:])) for r in added.collect()}
    n, width = whole.get((-1, -1), 0), 1 + max((i for i, _ in whole), default=-1)
    products = np.zeros((width, width), dtype=object)
    for (i, j), value in whole.items():
        if j >= 0:
            products[i, j] = products[j, i] = value
    return n, [whole[i, -1] for i in range(width)], products


class Model:
    """Mean, components and eigenvalues of a fit."""

    def __init__(self, n: int, sums: list[int], products: np.ndarray, most: int):
        self.n, self.sums = n, sums
        s = np.array(sums, dtype=object)
        exact = n * products - s[:, None] * s[None]
        # Python rounds a quotient of integers once
        cov = np.array([[a / (n * n) for a in row] for row in exact.tolist()], dtype=np.float64).reshape(exact.shape)
        values, vectors = np.linalg.eigh(cov) if len(cov) else (np.zeros(0), cov)
        values, vectors = values[::-1], vectors[:, ::-1]
        held = int((values > len(values) * np.finfo(float).eps * max(values.max(initial=0), 0)).sum())
        self.values, vectors = values[: min(held, most)], vectors[:, : min(held, most)]
        largest = np.abs(vectors).argmax(0) if vectors.size else np.zeros(0, dtype=int)
        self.vectors = vectors * np.where(vectors[largest, range(vectors.shape[1])] < 0, -1.0, 1.0)
        trace = sum(exact[i, i] for i in range(len(exact))) / (n * n) if n else 0.0
        self.explained = self.values / trace if trace else self.values
        self.most = max(map(abs, sums), default=0)

    def deviations(self, y: np.ndarray) -> np.ndarray:
        """n * y - S, exact: longs where they fit, else Python's integers. y has the fit's dimensions."""
        n, sums = self.n, np.array(self.sums, dtype=object)
        if n * max(int(y.max(initial=0)), -int(y.min(initial=0))) + self.most < SAFE:
            return n * y - sums.astype(np.int64)
        return n * y.astype(object) - sums

    def whitened(self, deviations: np.ndarray) -> np.ndarray:
        """(rows, components)"""
        return (deviations / self.n).astype(np.float64) @ self.vectors / np.sqrt(self.values)


def squares(deviations: np.ndarray) -> list[int]:
    """Of each row the sum of squares, exact."""
    if deviations.dtype == np.int64 and deviations.shape[1] * int(np.abs(deviations).max(initial=0)) ** 2 < SAFE:
        return (deviations * deviations).sum(1).tolist()
    wide = deviations.astype(object)
    return [int(x) for x in (wide * wide).sum(1)]


def identity_error(fitted: DataFrame, model: Model) -> float:
    """Largest absolute entry of the whitened values' covariance over fitted, less the identity."""
    k = len(model.values)
    schema = StructType.fromDDL("a int, b int, product double")
    arrow = to_arrow_schema(schema)
    left, right = np.triu_indices(k)

    def run(batches):
        total = np.zeros((k, k))
        for batch in batches:
            w = model.whitened(model.deviations(matrix(batch.column(0), len(model.sums))))
            total += w.T @ w
        columns = [left, right, total[left, right]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, arrow)], schema=arrow)

    added = fitted.mapInArrow(run, schema).groupBy("a", "b").agg(F.sum("product").alias("product"))
    off = F.abs(F.col("product") / model.n - F.when(F.col("a") == F.col("b"), 1.0).otherwise(0.0))
    return float(added.agg(F.max(off)).first()[0] or 0.0)


RESULT = "component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"


def whitened(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(id_col, component, n, deviation, whitened, explained, identity_error) of every usable row and component.

    n is the number of distinct vectors. deviation is exact: the sum over dimensions of (n * x - S) ** 2, null beyond
    38 digits.
    """
    spark = vectors.sparkSession
    schema = StructType.fromDDL(f"`{id_col}` long, {RESULT}")
    kept = vectors.where(usable(vector_col)).select(F.col(id_col).cast("long").alias(id_col), shifted(vector_col).alias("y"))
    aside = Scratch(spark, "whitening")
    try:
        fitted = aside(kept.select("y").distinct(), "distinct")
        model = Model(*summed(fitted), components)
        error = identity_error(fitted, model) if len(model.values) else 0.0
    finally:
        aside.drop()
    arrow, k = to_arrow_schema(schema), len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches if k else ():
            each = model.deviations(matrix(batch.column(1), len(model.sums)))
            size = len(each)
            fits = [x if x < 10**38 else None for x in squares(each)]
            columns = [
                batch.column(0).take(pa.array(np.repeat(np.arange(size), k))),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), size)),
                pa.array(np.full(size * k, model.n)),
                pa.array(fits, pa.decimal128(38, 0)).take(pa.array(np.repeat(np.arange(size), k))),
                pa.array(model.whitened(each).ravel()),
                pa.array(np.tile(model.explained, size)),
                pa.array(np.full(size * k, error)),
            ]
            yield pa.RecordBatch.from_arrays(columns, schema=arrow)

    return kept.mapInArrow(run, schema)
