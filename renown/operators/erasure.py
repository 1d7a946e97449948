"""Linear erasure of a protected concept from vectors."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Erasure:
    """The map x -> x - out * (probe . x - offset): everything along the directions ``out`` goes.

    ``out`` and ``probe`` are one vector or one row for each direction, so the size follows the number of
    classes and the width of the vectors, whatever the number of rows.
    """

    out: np.ndarray
    probe: np.ndarray
    offset: float | np.ndarray

    def apply_to(self, matrix: np.ndarray) -> np.ndarray:
        out, probe = np.atleast_2d(self.out), np.atleast_2d(self.probe)
        return matrix - (matrix @ probe.T - np.atleast_1d(self.offset)) @ out


@dataclass
class Moments:
    """Rows, means and centred second moments of labelled vectors, and rows and mean per class."""

    n: int
    mean: np.ndarray
    square: np.ndarray
    classes: dict[str, tuple[int, np.ndarray]]

    def merge(self, other: Moments) -> Moments:
        """Moments of the rows of both, without loss of digits where means are large."""
        if not self.n or not other.n:
            return self if self.n else other
        n, gap = self.n + other.n, other.mean - self.mean
        classes = dict(self.classes)
        for name, (rows, mean) in other.classes.items():
            own, at = classes.get(name, (0, mean))
            classes[name] = (own + rows, at + (mean - at) * (rows / (own + rows)))
        square = self.square + other.square + np.outer(gap, gap) * (self.n * other.n / n)
        return Moments(n, self.mean + gap * (other.n / n), square, classes)

    @classmethod
    def of(cls, labels: np.ndarray, matrix: np.ndarray) -> Moments:
        mean = matrix.mean(0)
        centred = matrix - mean
        classes = {str(c): (int((labels == c).sum()), matrix[labels == c].mean(0)) for c in np.unique(labels)}
        return cls(len(matrix), mean, centred.T @ centred, classes)

    def to_row(self) -> pa.RecordBatch:
        names = list(self.classes)
        values = [self.n, self.mean.tobytes(), self.square.tobytes(), names, [self.classes[c][0] for c in names], [self.classes[c][1].tobytes() for c in names]]
        return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _ROW.types)], _ROW.names)

    @classmethod
    def from_row(cls, row: dict) -> Moments:
        mean = np.frombuffer(row["mean"])
        classes = {c: (n, np.frombuffer(m)) for c, n, m in zip(row["names"], row["rows"], row["means"])}
        return cls(row["n"], mean, np.frombuffer(row["square"]).reshape(len(mean), len(mean)), classes)


_ROW = pa.schema(
    [("n", pa.int64()), ("mean", pa.binary()), ("square", pa.binary()), ("names", pa.list_(pa.string())), ("rows", pa.list_(pa.int64())), ("means", pa.list_(pa.binary()))]
)
_ROW_DDL = "n long, mean binary, square binary, names array<string>, rows array<long>, means array<binary>"


def moment_rows(df: DataFrame, vector: str, concept: str, fan: int = 32) -> DataFrame:
    """Moments of the labelled rows as one row, in one scan; rows without a class or vector don't count.

    Every task sums its rows to one block, and blocks are merged in ``fan`` groups and then together.
    """
    rows = df.where(F.col(concept).isNotNull() & F.col(vector).isNotNull()).select(F.col(concept).cast("string").alias("label"), F.col(vector).cast("array<double>").alias("x"))

    def blocks(batches):
        total = None
        for batch in batches:
            if batch.num_rows:
                labels = np.array(batch.column(0).to_pylist(), object)
                matrix = batch.column(1).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                found = Moments.of(labels, matrix)
                total = found if total is None else total.merge(found)
        if total is not None:
            yield total.to_row()

    def merged(table: pa.Table) -> pa.Table:
        total = None
        for row in table.select(_ROW.names).to_pylist():
            total = Moments.from_row(row) if total is None else total.merge(Moments.from_row(row))
        return pa.Table.from_batches([total.to_row()])

    partial = rows.mapInArrow(blocks, _ROW_DDL).withColumn("part", F.pmod(F.spark_partition_id(), F.lit(fan)))
    some = partial.groupBy("part").applyInArrow(merged, _ROW_DDL)
    return some.groupBy(F.lit(0).alias("all")).applyInArrow(merged, _ROW_DDL)


def moments(df: DataFrame, vector: str, concept: str) -> Moments:
    """The row of ``moment_rows``: d x d numbers and a mean for each class reach the driver."""
    found = moment_rows(df, vector, concept).collect()
    if not found:
        raise ValueError(f"no row has both {vector} and {concept}")
    return Moments.from_row(found[0].asDict())


def _two_classes(found: Moments, concept: str) -> tuple[tuple[int, np.ndarray], tuple[int, np.ndarray]]:
    if set(found.classes) not in ({"false", "true"}, {"0", "1"}):
        raise ValueError(f"both classes of {concept} need rows")
    low, high = sorted(found.classes)
    return found.classes[low], found.classes[high]


def fit_centroid(df: DataFrame, vector: str, concept: str) -> Erasure:
    """Project out the unit direction between the two class means."""
    (_, low), (_, high) = _two_classes(moments(df, vector, concept), concept)
    gap = high - low
    length = np.linalg.norm(gap)
    if length == 0:  # equal means: no direction to project out
        return Erasure(np.zeros_like(gap), np.zeros_like(gap), 0.0)
    unit = gap / length
    return Erasure(unit, unit, 0.0)


def fit_leace(df: DataFrame, vector: str, concept: str) -> Erasure:
    """The least-squares-smallest affine map after which no linear probe can tell the classes.

    For a two-class concept the whitened projection has rank one. With S the
    covariance and c the covariance with the concept it is
    x - c * (w . (x - mean)) / (w . c) with w = pinv(S) c.
    """
    found = moments(df, vector, concept)
    (n0, m0), (n1, m1) = _two_classes(found, concept)
    shared = (n0 * n1 / found.n**2) * (m1 - m0)
    probe = np.linalg.pinv(found.square / max(found.n - 1, 1), hermitian=True) @ shared
    scale = probe @ shared
    if scale <= 0:  # equal means: nothing linear to erase
        return Erasure(np.zeros_like(shared), np.zeros_like(shared), 0.0)
    probe = probe / scale
    return Erasure(shared, probe, float(probe @ found.mean))


def fit_leace_classes(df: DataFrame, vector: str, concept: str, tolerance: float = 1e-10) -> Erasure:
    """The same map for a concept of any number of classes.

    After whitening, everything in the span of the class means goes: one direction less than there are
    classes, or fewer where means coincide. With a single class nothing goes.
    """
    found = moments(df, vector, concept)
    values, axes = np.linalg.eigh(found.square / found.n)
    used = values > tolerance * max(values.max(), 0)
    whiten, colour = axes[:, used] / np.sqrt(values[used]), axes[:, used] * np.sqrt(values[used])
    shared = np.stack([(n / found.n) * (mean - found.mean) for n, mean in found.classes.values()], 1)
    span, size, _ = np.linalg.svd(whiten.T @ shared, full_matrices=False)
    span = span[:, size > 1e-9 * max(size.max(initial=0), 1e-300)] if size.max(initial=0) > 1e-12 else span[:, :0]
    probe = (whiten @ span).T
    return Erasure((colour @ span).T, probe, probe @ found.mean)


def erase(df: DataFrame, vector: str, erasure: Erasure, as_float: bool = True) -> DataFrame:
    """Apply an erasure to every row, labelled or not, in Arrow batches.

    ``as_float`` stores 32-bit values as the input tables do; the arithmetic is
    64-bit either way.
    """
    names = df.columns
    place = names.index(vector)
    element = "float" if as_float else "double"
    arrow_element = pa.float32() if as_float else pa.float64()
    width = np.shape(erasure.out)[-1]
    schema = ", ".join(
        f"`{f.name}` {'array<' + element + '>' if f.name == vector else f.dataType.simpleString()}"
        for f in df.schema.fields
    )

    def run(batches):
        for batch in batches:
            column = batch.column(place)
            offsets = column.offsets.to_numpy()
            flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
            erased = erasure.apply_to(flat.reshape(-1, width))
            values = pa.array(erased.ravel(), type=pa.float64()).cast(arrow_element)
            # null vectors stay null; offsets restart at 0 because flatten() drops them
            valid = column.is_valid().to_numpy(zero_copy_only=False)
            lengths = np.where(valid, np.diff(offsets), 0)
            starts = pa.array(np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32))
            mask = None if valid.all() else pa.array(~valid)
            lists = pa.ListArray.from_arrays(starts, values, mask=mask)
            columns = [lists if i == place else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    return df.mapInArrow(run, schema)
