"""Least squares by mergeable triangular factors.

The rows [l | x] of a tall system l·z = x are reduced to the triangle R of their QR factorisation, which has one row and column more
than there are unknowns.  Triangles of disjoint sets of rows merge by stacking and reducing again, so a system may be cut
by any key, and everything that is asked of the whole one (coordinates, residual, singular values, rank) follows from its triangle.
"""

import numpy as np


def reduced(rows: np.ndarray) -> np.ndarray:
    """The triangle of ``rows``: as many rows as columns, zero rows where there were fewer."""
    width = rows.shape[1]
    out = np.zeros((width, width))
    if len(rows):
        triangle = np.linalg.qr(rows, mode="r")
        out[: len(triangle)] = triangle
    return out


def reduced_segments(rows: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Triangles of the consecutive segments of ``rows`` that begin at ``starts``: segments of like size are reduced together."""
    width = rows.shape[1]
    sizes = np.diff(np.append(starts, len(rows)))
    out = np.zeros((len(starts), width, width))
    padded = 1 << np.ceil(np.log2(np.maximum(sizes, 1))).astype(int)
    for size in np.unique(padded):
        some = np.flatnonzero(padded == size)
        # zero rows change no triangle
        at = np.arange(size)[None, :]
        block = np.where((at < sizes[some, None])[:, :, None], rows[np.minimum(starts[some, None] + at, len(rows) - 1)], 0.0)
        triangles = np.linalg.qr(block, mode="r")
        out[some, : triangles.shape[1]] = triangles
    return out


def merged(*triangles: np.ndarray) -> np.ndarray:
    return reduced(np.vstack(triangles))


def all_but_one(triangles: list[np.ndarray]) -> list[np.ndarray]:
    """For every triangle the merged triangle of all others, from running merges of both ends: three merges each."""
    if not triangles:
        return []
    none = np.zeros_like(triangles[0])
    before, after = [none], [none]
    for t in triangles[:-1]:
        before.append(merged(before[-1], t))
    for t in triangles[:0:-1]:
        after.append(merged(after[-1], t))
    return [merged(a, b) for a, b in zip(before, reversed(after))]


def solution(triangle: np.ndarray, rows: int, rcond: float) -> dict:
    """What the system of this triangle, made of ``rows`` rows, says; nothing is judged here.

    Singular values up to ``rcond`` times the largest count as zero in the coordinates; the rank counts those above
    the rounding error of a system of this shape.
    """
    k = len(triangle) - 1
    left, x, beyond = triangle[:k, :k], triangle[:k, k], triangle[k, k]
    u, values, turned = np.linalg.svd(left)
    values = values[: min(rows, k)]
    largest = values[0] if len(values) else 0.0
    rank = int((values > largest * max(rows, k) * np.finfo(float).eps).sum())
    live = values > rcond * largest
    z = turned[: len(values)].T[:, live] @ ((u[:, : len(values)].T @ x)[live] / values[live])
    off = left @ z - x
    return {
        "matrix_rank": rank,
        "singular_values": values.tolist(),
        "condition_number": float(largest / values[-1]) if rows and rank == k else None,
        "coordinates": z.tolist(),
        "residual_norm": float(np.sqrt(off @ off + beyond * beyond)),
    }
