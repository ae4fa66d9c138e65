"""Array helpers: padding, sentinels, argmax, n-grams."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = ["let", "pad_array", "mask_pad", "unmask", "argmax", "ngrams", "index_range",
           "PAD_ID", "UNK_ID", "TAG_PAD", "IGNORE_INDEX"]

# Fixed sentinel values of the reference's encoded outputs.
PAD_ID = 0
UNK_ID = 1
TAG_PAD = -1
IGNORE_INDEX = -100


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once a row: as a lambda variable it
    cannot be put back into ``body``'s own lambdas by the optimizer."""
    return F.transform(F.array(value), body)[0]


def pad_array(col, n, pad=PAD_ID) -> Column:
    """Pad with ``pad`` / truncate to exactly ``n`` elements (n may be a Column)."""
    n = n if isinstance(n, Column) else F.lit(int(n))
    return F.slice(F.concat(_c(col), F.array_repeat(F.lit(pad), n)), F.lit(1), n)


def mask_pad(col, pad=PAD_ID, ignore=IGNORE_INDEX) -> Column:
    return F.transform(_c(col), lambda x: F.when(x == pad, F.lit(ignore)).otherwise(x))


def unmask(col, pad=PAD_ID, ignore=IGNORE_INDEX) -> Column:
    return F.transform(_c(col), lambda x: F.when(x == ignore, F.lit(pad)).otherwise(x))


def argmax(col) -> Column:
    """0-based index of the first maximum (``torch.max`` / ``np.argmax``)."""
    c = _c(col)
    return (F.array_position(c, F.array_max(c)) - 1).cast("int")


def index_range(n) -> Column:
    """``[0, 1, ..., n-1]``; empty for n <= 0 (``sequence(0,-1)`` would count down)."""
    n = n if isinstance(n, Column) else F.lit(int(n))
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def ngrams(col, n: int) -> Column:
    """Contiguous n-grams of a token array (pass a column), each joined by a
    unit separator.  Built by zipping n shifted copies of the array, so no
    lambda re-reads the array (linear in its length)."""
    c = _c(col)
    shifted = [F.slice(c, k + 1, F.greatest(F.size(c), F.lit(1))).alias(f"t{k}") for k in range(n)]
    z = F.arrays_zip(*shifted)
    last = f"t{n - 1}"
    return F.transform(F.filter(z, lambda x: x[last].isNotNull()),
                       lambda x: F.concat_ws("\u001f", *[x[f"t{k}"] for k in range(n)]))
