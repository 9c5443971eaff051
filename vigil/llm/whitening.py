"""Whitening of embeddings by the covariance of all rows, its eigenvectors refined to double precision.

Entries become whole numbers, so that sums and products are added up exactly, whatever the order: tasks send sums
of centred products, Spark adds them, and only the covariance itself comes to the driver. Its eigenvectors are found
in single precision and then corrected by matrix products in higher precision (Ogita and Aishima 2018); eigenvalues
too close to be told apart at a step are a cluster, whose vectors are turned within their span by the eigenvectors of
the small matrix that the shifted covariance leaves there (Ogita and Aishima 2019).
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.functions import arrow_udf

from vigil.session import materialize

#: An entry c is taken as floor(SCALE * c) + SHIFT.
SCALE, SHIFT = 1024, 100_000
#: Entries as large as this would leave the 64 bits of their whole number.
TOO_LARGE = 2.0**52
#: The covariance of so many dimensions is still small for the driver: 128 MB.
MOST_DIMENSIONS = 4096

_LIMB = 20  # products of two limbs, summed over a block of rows, are exact in a double
_BLOCK = 1 << (53 - 2 * _LIMB)
_WORD = 1 << 60
_WIDE = pa.decimal128(38, 0)


# Exact sums over all rows


def usable(rows: DataFrame) -> DataFrame:
    """Rows with a vector that is neither null nor empty and whose entries all are finite and can be stored."""
    fine = F.forall("embedding", lambda c: F.coalesce(F.abs(c.cast("double")) < TOO_LARGE, F.lit(False)))
    return rows.where(F.coalesce((F.size("embedding") > 0) & fine, F.lit(False)))


def _whole(vectors: pa.Array, size: int) -> Iterator[np.ndarray]:
    """The entries floor(SCALE * c) in blocks of rows."""
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    step = max(1, min(_BLOCK, (1 << 20) // size)) * size
    for at in range(0, len(flat), step):
        yield np.floor(float(SCALE) * flat[at : at + step].astype(np.float64)).astype(np.int64).reshape(-1, size)


def _column_sums(whole: np.ndarray) -> list[int]:
    if len(whole) * int(np.abs(whole).max(initial=0)) < 2**62:
        return whole.sum(0).tolist()
    return whole.astype(object).sum(0).tolist()


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors = batch.column(0)
        sizes = vectors.value_lengths().to_numpy(zero_copy_only=False)
        for size in np.unique(sizes).tolist():
            own = vectors.filter(pa.array(sizes == size))
            total = [0] * size
            for block in _whole(own, size):
                total = [a + b for a, b in zip(total, _column_sums(block))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([size] * size, pa.int32()), pa.array(range(size), pa.int32()),
                 pa.array([len(own)] * size, pa.int64()), pa.array(total, _WIDE)], ["size", "position", "n", "s"])


def products(whole: np.ndarray) -> np.ndarray:
    """The exact sums of products of all pairs of columns: 64-bit numbers for small entries, else whole numbers of
    any length. At most _BLOCK rows."""
    limbs, rest = [], whole
    while True:
        low = ((rest + (1 << _LIMB - 1)) & ((1 << _LIMB) - 1)) - (1 << _LIMB - 1)
        limbs.append(low.astype(np.float64))
        rest = rest - low >> _LIMB
        if not rest.any():
            break
    if len(limbs) == 1:
        return (limbs[0].T @ limbs[0]).astype(np.int64)
    return sum((a.T @ b).astype(np.int64).astype(object) << _LIMB * (i + j)
               for i, a in enumerate(limbs) for j, b in enumerate(limbs))


def _gram(size: int, centre: list[int]):
    middle = np.array(centre, np.int64)
    upper = np.triu_indices(size)

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        small, large, held = np.zeros(len(upper[0]), np.int64), 0, 0
        for batch in batches:
            for block in _whole(batch.column(0), size):
                found = products(block - middle)[upper]
                if found.dtype == object or held == 500:  # each block adds less than 53 bits
                    large, small, held = large + small.astype(object), np.zeros_like(small), 0
                if found.dtype == object:
                    large = large + found
                else:
                    small, held = small + found, held + 1
        total = [int(v) for v in (small.astype(object) + large)]
        for at in range(0, len(total), 100_000):
            part = slice(at, at + 100_000)
            yield pa.RecordBatch.from_arrays(
                [pa.array(upper[0][part], pa.int32()), pa.array(upper[1][part], pa.int32()),
                 pa.array([v // _WORD for v in total[part]], _WIDE), pa.array([v % _WORD for v in total[part]], _WIDE)],
                ["i", "j", "high", "low"])

    return gram


# Eigenvectors


def _norm(a: np.ndarray) -> np.longdouble:
    return np.sqrt((a * a).sum())


def eigenpairs(matrix: np.ndarray, steps: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues in falling order, and unit eigenvectors as columns, of a symmetric matrix.

    Starts from the eigenvectors of the matrix in single precision. All corrections are products in long double,
    so that vectors are right to double precision even where eigenvalues lie close together."""
    a = np.asarray(matrix, np.longdouble)
    scale = np.abs(a).max(initial=0)
    if scale == 0:
        return np.zeros(len(a), np.longdouble), np.eye(len(a), dtype=np.longdouble)
    a = a / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    one, length, least = np.eye(len(a), dtype=np.longdouble), _norm(a), len(a) * np.finfo(np.longdouble).eps
    best, idle = np.inf, 0
    for _ in range(steps):
        r = one - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2
        values = np.diag(s) / (1 - np.diag(r))
        order = np.argsort(-values, kind="stable")
        x, r, s, values = x[:, order], r[order][:, order], s[order][:, order], values[order]
        blur = 2 * (_norm(s - np.diag(values)) + length * _norm(r))
        gaps = values[None, :] - values[:, None]
        apart = np.abs(gaps) > blur
        # Half of the lack of orthogonality for each of two vectors, and between those that are told apart a turn.
        turn = np.where(apart, (s + (values[None, :] + values[:, None]) / 2 * r) / np.where(apart, gaps, 1), 0)
        x = x + x @ (r / 2 + turn)
        far = max(np.abs(r).max(), np.abs(turn).max(), _solve_clusters(a, x, values, blur))
        best, idle = (far, 0) if far < best / 2 else (best, idle + 1)
        if far <= 4 * least or idle == 3:  # close eigenvalues leave turns by rounding alone
            break
    x = x + x @ ((one - x.T @ x) / 2)
    values = (x * (a @ x)).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order] * scale, x[:, order]


def _solve_clusters(a: np.ndarray, x: np.ndarray, values: np.ndarray, blur) -> float:
    """Turn the vectors of each run of eigenvalues within `blur` of the next, in place; how far the most turned."""
    far, start = 0.0, 0
    for end in range(1, len(values) + 1):
        if end < len(values) and values[end - 1] - values[end] <= blur:
            continue
        if end - start > 1:
            part = x[:, start:end]
            shifted = part.T @ (a @ part) - values[start:end].mean() * (part.T @ part)
            width = np.abs(shifted).max()
            if width > len(a) * np.finfo(np.longdouble).eps:  # else the eigenvalues are one
                turn = np.linalg.eigh((shifted / width).astype(np.float64))[1][:, ::-1]
                x[:, start:end] = part @ turn.astype(np.longdouble)
                # By how far the vectors have new directions, whatever their order and sign.
                far = max(far, float(np.sqrt(1 - np.minimum(1, np.abs(turn).max(0)).min() ** 2)))
        start = end
    return far


# The operator


def _judged(size: int, n: int, total: list[int], centre: list[int], weights: np.ndarray):
    """A function of vectors: deviation and whitened values."""
    # Within 62 bits all is done in 64-bit numbers.
    middle, rest = np.array(centre, np.int64), [t - n * c for t, c in zip(total, centre)]

    def judge(vectors: pa.Array) -> pa.Array:
        deviations, whitened = [], []
        for block in _whole(vectors, size):
            centred = block - middle
            most = n * int(np.abs(centred).max(initial=0)) + max(map(abs, rest))
            kind = np.int64 if most**2 * size < 2**62 else object
            exact = centred.astype(kind) * n - np.array(rest, kind)
            deviations += [v if v < 2**63 else None for v in (exact * exact).sum(1).tolist()]
            # The quotient of whole numbers, rounded once.
            whitened.append((exact / n).astype(np.float64) @ weights)
        flat = np.concatenate(whitened).ravel() if whitened else np.empty(0)
        k = weights.shape[1]
        lists = pa.ListArray.from_arrays(pa.array(range(0, len(flat) + 1, k), pa.int32()), pa.array(flat))
        return pa.StructArray.from_arrays([pa.array(deviations, pa.int64()), lists], ["deviation", "whitened"])

    return judge


def _identity_error(table: DataFrame, k: int) -> float:
    """The largest absolute entry of the covariance of column `whitened` less the identity."""
    entry = [F.col("whitened")[i] for i in range(k)]
    mean = table.agg(*[F.avg(e) for e in entry]).first()
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    found = table.agg(*[F.avg((entry[i] - F.lit(mean[i])) * (entry[j] - F.lit(mean[j]))) for i, j in pairs]).first()
    return max(abs(v - (i == j)) for v, (i, j) in zip(found, pairs))


def covariance(rows: DataFrame) -> tuple[int, int, list[int], list[int], np.ndarray] | None:
    """(size, n, sums, whole means, covariance) of the `usable` rows: the sums are of floor(SCALE * c), and the
    covariance is exact but for one rounding to long double. None without rows.

    Where vectors differ in length, the most frequent one counts, of equally frequent ones the longest."""
    sums = materialize(rows.select("embedding").mapInArrow(_sums, "size int, position int, n long, s decimal(38,0)")
                       .groupBy("size", "position").agg(F.sum("n").alias("n"), F.sum("s").alias("s")), "vector-sums")
    most = sums.where("position = 0").orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return None
    size, n = most["size"], most["n"]
    if size > MOST_DIMENSIONS:
        raise ValueError(f"{size} dimensions are more than {MOST_DIMENSIONS}")
    total = [int(r.s) for r in sums.where(F.col("size") == size).orderBy("position").collect()]
    centre = [(2 * t + n) // (2 * n) for t in total]
    rest = [t - n * c for t, c in zip(total, centre)]
    cells = (
        rows.where(F.size("embedding") == size).select("embedding")
        .mapInArrow(_gram(size, centre), "i int, j int, high decimal(38,0), low decimal(38,0)")
        .groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low")))
    out = np.zeros((size, size), np.longdouble)
    for i, j, high, low in cells.collect():  # one number for each pair of dimensions
        exact = n * (int(high) * _WORD + int(low)) - rest[i] * rest[j]
        near = exact / n**2
        out[i, j] = out[j, i] = np.longdouble(near) + np.longdouble(float(Fraction(exact, n**2) - Fraction(near)))
    return size, n, total, centre, out


def whiten(embeddings: DataFrame, components: int = 8) -> DataFrame:
    """Rows of (vec_id, component, n, deviation, whitened, explained, identity_error), for each row of `embeddings`
    (vec_id, embedding) with a usable vector and each component from 1 up to `components`.

    Each entry c becomes x = floor(1024 * c) + 100000. `n` is the number of vectors and S their sum; `deviation` the
    sum over dimensions of (n * x - S)^2, null beyond 64 bits; `whitened` x - S / n projected on the component, over
    the square root of its eigenvalue; `explained` that eigenvalue's part of the trace; `identity_error` the largest
    absolute entry of the covariance of all whitened values less the identity, as measured over them.

    Left out are null and empty vectors, and those that hold a null, a NaN, an infinity or an entry of 2^52 or more;
    where lengths differ, vectors of all but the most frequent length. Repeated rows count and come as often as they
    stand there; null vec_ids are rows like others; other columns are not read. Components without variance (an
    eigenvalue that is zero to double precision) have no rows, so that an empty table, one row, or equal rows give
    none.
    """
    id_type = embeddings.schema["vec_id"].dataType
    rows = usable(embeddings.select("vec_id", "embedding"))
    schema = (f"vec_id {id_type.simpleString()}, component int, n bigint, deviation bigint, whitened double, "
              "explained double, identity_error double")
    known = covariance(rows)
    values, vectors = eigenpairs(known[4]) if known else (np.zeros(0), np.zeros((0, 0)))
    k = int((values[:components] > 2.0**-52 * len(values) * values[:1]).sum())
    if k == 0:
        return embeddings.sparkSession.createDataFrame([], schema)
    size, n, total, centre, matrix = known
    weights = (vectors[:, :k] / np.sqrt(values[:k])).astype(np.float64)
    judge = arrow_udf(_judged(size, n, total, centre, weights), "deviation bigint, whitened array<double>")
    judged = rows.where(F.size("embedding") == size).select("vec_id", judge("embedding").alias("v"))
    table = materialize(judged.select("vec_id", "v.deviation", "v.whitened"), "whitened")
    part = F.array(*[F.lit(float(v / np.trace(matrix))) for v in values[:k]])
    return table.select("vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).alias("component"), F.lit(n).cast("bigint").alias("n"), "deviation", "whitened",
        _at(part, F.col("at")).alias("explained"), F.lit(_identity_error(table, k)).alias("identity_error"))


def _at(values: Column, place: Column) -> Column:
    return F.element_at(values, place + 1)
