"""Jaro-Winkler similarity as an Arrow-batched function, and a JVM-side upper bound for it.

Spark has no Jaro-Winkler built in. The kernel below works on whole Arrow batches with numpy, so the
cost per pair is a few array operations. ``score_ceiling`` needs no Python: joins use it to drop
pairs that cannot reach a threshold before any string leaves the JVM.
"""

from __future__ import annotations

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

_CELLS_PER_SLICE = 1 << 18

# the kernel travels with the job, so the package need not be installed on the executors
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def _code_points(values: np.ndarray, width: int) -> np.ndarray:
    fixed = values.astype(f"U{width}")
    return fixed.view(np.uint32).reshape(len(values), width)


def _similarity_slice(a, b, len_a, len_b) -> np.ndarray:
    width_a, width_b = int(len_a.max()), int(len_b.max())
    codes_a, codes_b = _code_points(a, width_a), _code_points(b, width_b)
    rows = np.arange(len(a))
    reach = np.maximum(np.maximum(len_a, len_b) // 2 - 1, 0)
    widest = int(reach.max())
    position = np.arange(width_b)
    used_a = np.zeros(codes_a.shape, dtype=bool)
    used_b = np.zeros(codes_b.shape, dtype=bool)
    in_b = position[None, :] < len_b[:, None]

    for i in range(width_a):
        low, high = max(0, i - widest), min(width_b, i + widest + 1)
        if low >= high:
            continue
        near = np.abs(position[low:high][None, :] - i) <= reach[:, None]
        hit = (
            (codes_b[:, low:high] == codes_a[:, i : i + 1])
            & near
            & in_b[:, low:high]
            & ~used_b[:, low:high]
            & (i < len_a)[:, None]
        )
        found = hit.any(axis=1)
        used_a[:, i] = found
        used_b[rows[found], low + hit.argmax(axis=1)[found]] = True

    common = used_a.sum(axis=1)
    shared = int(common.max()) if len(common) else 0
    order_a = np.argsort(~used_a, axis=1, kind="stable")[:, :shared]
    order_b = np.argsort(~used_b, axis=1, kind="stable")[:, :shared]
    swapped = np.take_along_axis(codes_a, order_a, 1) != np.take_along_axis(codes_b, order_b, 1)
    swapped &= np.arange(shared)[None, :] < common[:, None]
    half_swaps = swapped.sum(axis=1) // 2

    m = common.astype(float)
    with np.errstate(divide="ignore", invalid="ignore"):
        jaro = np.where(m > 0, (m / len_a + m / len_b + (m - half_swaps) / m) / 3.0, 0.0)

    lead = min(4, width_a, width_b)
    same = codes_a[:, :lead] == codes_b[:, :lead]
    same &= np.arange(lead)[None, :] < np.minimum(len_a, len_b)[:, None]
    prefix = np.cumprod(same, axis=1).sum(axis=1)
    return np.where(jaro > 0.7, jaro + prefix * 0.1 * (1.0 - jaro), jaro)


def jaro_winkler_batch(left: pd.Series, right: pd.Series) -> pd.Series:
    """Standard Jaro-Winkler (prefix weight 0.1, four characters, boost above 0.7)."""
    a = left.fillna("").to_numpy(dtype=object)
    b = right.fillna("").to_numpy(dtype=object)
    len_a = np.fromiter((len(s) for s in a), dtype=np.int64, count=len(a))
    len_b = np.fromiter((len(s) for s in b), dtype=np.int64, count=len(b))
    equal = a == b
    out = np.where(equal, 1.0, 0.0)
    todo = np.flatnonzero(~equal & (len_a > 0) & (len_b > 0))
    if len(todo):
        # names come again and again in other pairs: each different pair is compared once
        (code_a, _), (code_b, known) = pd.factorize(a[todo]), pd.factorize(b[todo])
        pairs, first, place = np.unique(code_a * len(known) + code_b, return_index=True, return_inverse=True)
        rows_of, todo = todo, todo[first]
        longest = np.maximum(len_a, len_b)
        todo = todo[np.argsort(longest[todo], kind="stable")]
        start = 0
        while start < len(todo):
            # rows come shortest first, so a slice stays within its cell budget
            rows = max(1, _CELLS_PER_SLICE // int(longest[todo[start]]))
            while rows > 1 and rows * int(longest[todo[min(start + rows, len(todo)) - 1]]) > 2 * _CELLS_PER_SLICE:
                rows //= 2
            part = todo[start : start + rows]
            out[part] = _similarity_slice(a[part], b[part], len_a[part], len_b[part])
            start += rows
        out[rows_of] = out[rows_of[first]][place]
    missing = left.isna().to_numpy() | right.isna().to_numpy()
    return pd.Series(np.where(missing, np.nan, out))


@F.pandas_udf(DoubleType())
def jaro_winkler(left: pd.Series, right: pd.Series) -> pd.Series:
    return jaro_winkler_batch(left, right)


@F.pandas_udf(DoubleType())
def _computed_once(left: pd.Series, right: pd.Series) -> pd.Series:
    return jaro_winkler_batch(left, right)


# the same for columns that are filtered on and kept: a filter pushed below it would compute it a second time
jaro_winkler_once = _computed_once.asNondeterministic()


def char_mask(c: Column) -> Column:
    """One bit per distinct character (code modulo 64)."""
    return F.aggregate(
        F.array_distinct(F.split(c, "")),
        F.lit(0).cast("bigint"),
        lambda mask, ch: mask.bitwiseOR(
            F.when(ch == "", F.lit(0).cast("bigint")).otherwise(
                F.call_function("shiftleft", F.lit(1).cast("bigint"), F.ascii(ch).bitwiseAND(F.lit(63)))
            )
        ),
    )


def inverse_length(c: Column) -> Column:
    return F.when(F.length(c) > 0, 1.0 / F.length(c)).otherwise(0.0)


def common_start(a: Column, b: Column) -> Column:
    """The number of leading characters, at most four, that two strings share."""
    same = lambda n: F.substring(a, 1, n) == F.substring(b, 1, n)
    return F.when(~same(1), 0).when(~same(2), 1).when(~same(3), 2).when(~same(4), 3).otherwise(4)


def score_ceiling(
    len_a: Column, len_b: Column, inv_a: Column, inv_b: Column, mask_a: Column, mask_b: Column, start: Column | None = None
) -> Column:
    """Upper bound of Jaro-Winkler from lengths, their inverses, character sets and, if known, the length of the common start.

    A character that the other string lacks cannot be matched, so the number of matches is at most
    each length less its foreign characters. The prefix boost is at most 0.4 of the distance to 1.
    """
    foreign_a = F.bit_count(mask_a.bitwiseAND(F.bitwise_not(mask_b)))
    foreign_b = F.bit_count(mask_b.bitwiseAND(F.bitwise_not(mask_a)))
    m = F.least(len_a - foreign_a, len_b - foreign_b)
    if start is None:
        return F.when(m > 0, 0.4 + 0.2 * (m * (inv_a + inv_b) + 1.0)).otherwise(0.0)
    jaro = (m * (inv_a + inv_b) + 1.0) / 3.0
    return F.when(m > 0, jaro + start * 0.1 * (1.0 - jaro)).otherwise(0.0)
