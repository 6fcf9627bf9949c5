"""Whole-number vectors: components floor(256 x), kept as doubles, and exact inner products."""

import numpy as np
import pyarrow as pa

SCALE = 256
LONG = 1 << 63


def quantise(column):
    """floor(256 x) of every vector of an Arrow list column, x as double; None for NULL, and for NULL or non-finite components."""
    values = column.values.to_numpy(zero_copy_only=False).astype(np.float64)
    whole, good = np.floor(SCALE * values), np.isfinite(values)
    at = column.offsets.to_numpy()
    out = [whole[a:b] if good[a:b].all() else None for a, b in zip(at, at[1:])]
    return [None if gone else v for gone, v in zip(column.is_null().to_pylist(), out)]


def quantised(df):
    """vec_id, label and vector (little-endian doubles) of df (vec_id, label, embedding), without rows that take no part.

    Rows without an id or a label, without a vector, or with a NULL or non-finite component take no part.
    """

    def task(batches):
        for b in batches:
            vectors = quantise(b.column("embedding").cast(pa.list_(pa.float64())))
            keep = [i for i, v in enumerate(vectors) if v is not None]
            small = b.select(["vec_id", "label"]).take(pa.array(keep, pa.int64()))
            yield pa.RecordBatch.from_arrays([*small.columns, pa.array([vectors[i].astype("<f8").tobytes() for i in keep], pa.binary())], names=["vec_id", "label", "vector"])

    rows = df.selectExpr("CAST(vec_id AS LONG) AS vec_id", "CAST(label AS LONG) AS label", "CAST(embedding AS ARRAY<DOUBLE>) AS embedding")
    return rows.filter("vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL").mapInArrow(task, "vec_id long, label long, vector binary")


def matrix(blobs, width=None):
    """Vectors as rows; shorter ones are filled up with 0."""
    width = max((len(x) // 8 for x in blobs), default=0) if width is None else width
    out = np.zeros((len(blobs), width))
    for i, x in enumerate(blobs):
        out[i, :len(x) // 8] = np.frombuffer(x, "<f8")
    return out


def widened(a, width):
    return np.pad(a, ((0, 0), (0, width - a.shape[1]))) if a.shape[1] < width else a


def products(a, b, most=LONG):
    """Inner products of all rows of a and b as longs, exact at any size; one of `most` or more is an error."""
    width = max(a.shape[1], b.shape[1])
    a, b = widened(a, width), widened(b, width)
    limit = np.sqrt(2 ** 53 / max(1, width))  # no sum of products of smaller components passes 2^53
    wide_a, wide_b = (np.flatnonzero(np.abs(m).max(axis=1, initial=0) >= limit) for m in (a, b))
    if not len(wide_a) and not len(wide_b):
        return (a @ b.T).astype(np.int64)
    if not (np.isfinite(a).all() and np.isfinite(b).all()):
        raise OverflowError("a component times 256 is beyond a double")
    slim_a, slim_b = a.copy(), b.copy()
    slim_a[wide_a], slim_b[wide_b] = 0, 0
    out = (slim_a @ slim_b.T).astype(np.int64)
    ints = lambda m: [[int(x) for x in row] for row in m]
    exact = lambda x, y: sum(p * q for p, q in zip(x, y))
    for i, x in zip(wide_a, ints(a[wide_a])):
        out[i] = [_below(exact(x, y), most) for y in ints(b)]
    for j, y in zip(wide_b, ints(b[wide_b])):
        out[:, j] = [_below(exact(x, y), most) for x in ints(a)]
    return out


def _below(score, most):
    if not -most < score < most:
        raise OverflowError(f"an inner product is beyond {most}")
    return score
