"""Embedding whitening: pivoted Cholesky of the centred scatter, one-sided Jacobi on the triangular factor.

Vectors become whole numbers x = floor(scale * entry); the fit list holds every distinct x vector once. Sums are exact. Each
task multiplies x less the rounded mean, so products are those of centred values and whole numbers; what the rounding left,
less than half a unit, is taken off exactly at the end. The scatter therefore does not depend on how rows are spread.

The scatter A (at most ``dimension`` squared numbers, whatever the number of rows) is factored on the driver: pivoted
Cholesky gives A = L L' with the rows permuted, rotations from the right make the columns of L orthogonal, and then the
squared column norms are the eigenvalues of A and the normalised columns its eigenvectors. Both steps run in extended
precision; the model is sent to the tasks, which project their rows.

Defined results. Vectors that are null or hold null or non-finite entries are dropped, and so are vectors of another length
than most of the remaining rows have (of equally frequent lengths the longest counts). Components without variance, or
with less than rounding leaves of the largest variance, are not returned: equal vectors, or a single one, give no rows. ``deviation`` is null where it has more than 38 digits, in the query
where it exceeds a long. Repeated rows each get their rows; null ids stay; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trajspark.llm.common import arrow_map, document_table, stored
from trajspark.llm.registry import query

SCALE = 256
COMPONENTS = 4
#: Largest whole number below which doubles are exact.
EXACT = 1 << 53
LONG = (1 << 63) - 1
#: Sums too long for a decimal travel as multiples of this and a rest.
LIMB = 10**18


@dataclass
class Whitening:
    """n distinct vectors with sums ``sums``; per component (falling) eigenvalue, unit eigenvector, share of the variance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    explained: np.ndarray


def whole_vectors(df: DataFrame, id_col: str = "vec_id", vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id and ``x`` (array of long) of the valid rows, all of one length."""
    entry = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != F.lit(float("inf")))
    rows = df.select(F.col(id_col).alias("vec_id"), F.col(vector).cast("array<double>").alias("v")).filter(F.col("v").isNotNull() & F.forall("v", entry))
    rows = stored(rows.select("vec_id", F.transform("v", lambda v: F.floor(v * F.lit(float(scale)))).alias("x")), "whitening-x")
    most = rows.groupBy(F.size("x").alias("k")).count().orderBy(F.desc("count"), F.desc("k")).first()
    return rows if most is None else rows.filter(F.size("x") == most["k"])


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1)


def _most(x: np.ndarray) -> int:
    return max(-int(x.min(initial=0)), int(x.max(initial=0)))


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a.T @ b of whole numbers without rounding: in doubles while all sums are small enough, else in Python's numbers."""
    if not len(a):
        return np.zeros((a.shape[1], b.shape[1]), dtype=object)
    if _most(a) * _most(b) * len(a) < EXACT:
        return (a.T.astype(np.float64) @ b.astype(np.float64)).astype(np.int64).astype(object)
    return a.T.astype(object) @ b.astype(object)


def _totals(df: DataFrame, fn, names: list[str]) -> list[tuple]:
    """Sum of ``fn(x matrix)``, an array of whole numbers, as (place, total) rows; totals travel as two limbs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if batch.num_rows:
                part = fn(_matrix(batch.column(0)))
                held = part if held is None else held + part
        if held is not None:
            places = np.indices(held.shape).reshape(held.ndim, -1)
            limbs = zip(*(divmod(int(v), LIMB) for v in held.ravel()), strict=True)
            digits = [pa.array(map(str, limb), pa.string()) for limb in limbs]
            yield pa.RecordBatch.from_arrays([*(pa.array(p.astype(np.int32)) for p in places), *digits], [*names, "high", "low"])

    parts = arrow_map(df.select("x"), run, ", ".join(f"{n} int" for n in names) + ", high string, low string")
    limbs = [F.sum(F.col(limb).cast("decimal(38,0)")).alias(limb) for limb in ("high", "low")]
    return [(*(r[n] for n in names), int(r["high"]) * LIMB + int(r["low"])) for r in parts.groupBy(*names).agg(*limbs).collect()]


def _long_double(x: Fraction) -> np.longdouble:
    """``x`` in extended precision, from its leading 128 bits."""
    whole, part = divmod(x.numerator, x.denominator)
    digits = max(0, 128 - whole.bit_length())
    scaled = (whole << digits) + (part << digits) // x.denominator
    shift = max(0, scaled.bit_length() - 128)
    scaled >>= shift
    high, low = scaled >> 64, scaled & ((1 << 64) - 1)
    value = np.longdouble(high) * np.longdouble(2) ** 64 + np.longdouble(low)
    return np.ldexp(value, shift - digits)


def pivoted_cholesky(a: np.ndarray) -> np.ndarray:
    """L with a = L L', one column per pivot; rows keep the order of ``a``, so in pivot order L is lower triangular."""
    d = len(a)
    rest, done, columns = np.diag(a).copy(), np.zeros(d, dtype=bool), []
    limit = rest.max(initial=np.longdouble(0)) * d * np.finfo(a.dtype).eps
    while not done.all():
        pivot = int(np.argmax(np.where(done, -1, rest)))
        if rest[pivot] <= limit:
            break
        column = a[:, pivot].copy()
        for before in columns:
            column -= before * before[pivot]
        column /= np.sqrt(column[pivot])
        column[done] = 0
        columns.append(column)
        rest -= column * column
        done[pivot] = True
    return np.stack(columns, axis=1) if columns else np.zeros((d, 0), dtype=a.dtype)


def jacobi_columns(factor: np.ndarray, sweeps: int = 60) -> np.ndarray:
    """``factor`` times a rotation that makes its columns orthogonal; disjoint pairs of a round turn together."""
    w = factor.copy()
    k = w.shape[1]
    size = k + k % 2
    ring = np.arange(size)
    tiny = np.finfo(w.dtype).eps * 4
    for _ in range(sweeps):
        turned = False
        for _ in range(size - 1):
            p, q = ring[: size // 2], ring[size // 2 :][::-1]
            real = (p < k) & (q < k)
            a, b = w[:, p[real]], w[:, q[real]]
            aa, bb, ab = (a * a).sum(0), (b * b).sum(0), (a * b).sum(0)
            turn = np.abs(ab) > tiny * np.sqrt(aa * bb)
            if turn.any():
                turned = True
                a, b, aa, bb, ab = a[:, turn], b[:, turn], aa[turn], bb[turn], ab[turn]
                slope = (bb - aa) / (2 * ab)
                t = np.where(slope >= 0, 1, -1) / (np.abs(slope) + np.sqrt(1 + slope * slope))
                c = 1 / np.sqrt(1 + t * t)
                s = c * t
                w[:, p[real][turn]], w[:, q[real][turn]] = c * a - s * b, s * a + c * b
            ring = np.concatenate([ring[:1], np.roll(ring[1:], 1)])
        if not turned:
            break
    return w


def fit_list(rows: DataFrame) -> DataFrame:
    """The distinct vectors of ``rows`` (column x), in the shared folder."""
    return stored(rows.select("x").distinct(), "whitening-fit")


def _sums(x: np.ndarray) -> np.ndarray:
    return (x if _most(x) * len(x) < LONG else x.astype(object)).sum(axis=0).astype(object)


def fit(distinct: DataFrame) -> Whitening:
    """The model of a fit list (column x, distinct, all of one length)."""
    n = distinct.count()
    sums = [total for _, total in sorted(_totals(distinct, _sums, ["i"]))]
    d = len(sums)
    # Halves of the rounding are below one unit; round() of a Fraction is exact.
    middle = [round(Fraction(s, n)) for s in sums]
    shift = np.array([m if -LONG <= m <= LONG else 0 for m in middle], dtype=np.int64)

    def products(x: np.ndarray) -> np.ndarray:
        near = x.astype(object) - shift.astype(object) if _most(x) > LONG // 4 else x - shift
        return _exact(near, near)

    scatter = np.zeros((d, d), dtype=np.longdouble)
    trace = Fraction(0)
    rest = [Fraction(s, n) - int(m) for s, m in zip(sums, shift, strict=True)]
    for i, j, total in _totals(distinct, products, ["i", "j"]):
        value = total - n * rest[i] * rest[j]
        scatter[i, j] = _signed(value)
        trace += value if i == j else 0
    turned = jacobi_columns(pivoted_cholesky(scatter))
    norms = (turned * turned).sum(axis=0)
    order = np.argsort(-norms, kind="stable")
    norms, turned = norms[order], turned[:, order]
    vectors = (turned / np.sqrt(norms)).T
    if len(vectors):  # of the two signs the one with a positive largest entry
        vectors *= np.sign(vectors[np.arange(len(vectors)), np.abs(vectors).argmax(axis=1)])[:, None]
    part = norms / _signed(trace) if trace else norms
    return Whitening(n, sums, (norms / n).astype(np.float64), vectors.astype(np.float64), part.astype(np.float64))


def _signed(x: Fraction) -> np.longdouble:
    return _long_double(x) if x >= 0 else -_long_double(-x)


def _projected(x: np.ndarray, model: Whitening, k: int) -> np.ndarray:
    """(x - S / n) on the first k components over the roots of their eigenvalues; the mean is taken off in whole numbers."""
    middle = np.array([s // model.n for s in model.sums], dtype=object)
    part = np.array([(s - int(m) * model.n) / model.n for s, m in zip(model.sums, middle, strict=True)])
    near = (x.astype(object) - middle).astype(np.float64) if _most(x) > LONG // 4 else (x - middle.astype(np.int64)).astype(np.float64)
    return (near - part) @ model.vectors[:k].T / np.sqrt(model.values[:k])


def _deviation(x: np.ndarray, model: Whitening) -> list[int]:
    most = _most(x) * model.n + max(map(abs, model.sums), default=0)
    kind = np.int64 if most * most * x.shape[1] < LONG else object
    apart = x.astype(kind) * model.n - np.array(model.sums, dtype=kind)
    return (apart * apart).sum(axis=1).tolist()


def project(rows: DataFrame, model: Whitening, components: int = COMPONENTS) -> DataFrame:
    """Per row and component: vec_id, component, n, deviation (decimal), whitened, explained."""
    k = min(components, len(model.values))
    shared = rows.sparkSession.sparkContext.broadcast(model)
    names = ["vec_id", "component", "n", "deviation", "whitened", "explained"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            if not (batch.num_rows and k):
                continue
            x, rows_ = _matrix(batch.column(1)), batch.num_rows
            white = _projected(x, model, k)
            far = [v if v < 10**38 else None for v in _deviation(x, model)]
            ids = batch.column(0).take(pa.array(np.repeat(np.arange(rows_), k)))
            numbers = pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows_))
            deviation = pa.array([v if v is None else str(v) for v in far], pa.string()).take(pa.array(np.repeat(np.arange(rows_), k)))
            shares = pa.array(np.tile(model.explained[:k], rows_))
            yield pa.RecordBatch.from_arrays([ids, numbers, pa.array(np.full(rows_ * k, model.n)), deviation, pa.array(white.ravel()), shares], names)

    kind = rows.schema["vec_id"].dataType.simpleString()
    out = arrow_map(rows.select("vec_id", "x"), run, f"vec_id {kind}, component int, n long, deviation string, whitened double, explained double")
    return out.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def identity_error(distinct: DataFrame, model: Whitening, components: int = COMPONENTS) -> float | None:
    """Largest absolute entry of the covariance of the whitened fit list less the identity; null without components."""
    k = min(components, len(model.values))
    if not k:
        return None
    shared = distinct.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                white = _projected(_matrix(batch.column(0)), shared.value, k)
                yield pa.RecordBatch.from_arrays([pa.array(white[:, i].copy()) for i in range(k)], [f"w{i}" for i in range(k)])

    white = arrow_map(distinct.select("x"), run, ", ".join(f"w{i} double" for i in range(k)))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = white.agg(*[F.covar_pop(f"w{i}", f"w{j}") for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs, strict=True))


@query("op11_embedding_whitening")
def whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = whole_vectors(document_table(spark, sf_dir, "embeddings"))
    distinct = fit_list(rows)
    model = fit(distinct)
    out = project(rows, model).withColumn("deviation", F.expr("try_cast(deviation AS BIGINT)"))
    return out.withColumn("identity_error", F.lit(identity_error(distinct, model)).cast("double"))
