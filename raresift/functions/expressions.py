"""Column expressions shared by the operators (FN1-FN8, SMP1/SMP2 predicate).

Everything here is a built-in Spark expression, so it stays inside
whole-stage code generation.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The seed, split and threshold defaults of the training job.
SEED = 2003
TRAIN_FRACTION = 0.8
DECISION_THRESHOLD = 0.7
MAX_ITER = 10

# Fixed value: text of the live notice printed for each flagged row.
ALERT_FORMAT = "FRAUD FLAGGED: time=%.1f amount=%.2f"

_HASH_SPACE = 1 << 32


def _as_col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def hash_key(cols: Sequence[str | Column]) -> Column:
    """Text key of one or more columns, ``-`` separated.

    With several columns a null becomes the marker ``<null>`` so that
    ``(a, null, b)`` and ``(a, b, null)`` stay different keys.
    """
    parts = [_as_col(c).cast("string") for c in cols]
    if len(parts) == 1:
        return parts[0]
    return F.concat_ws("-", *[F.coalesce(p, F.lit("<null>")) for p in parts])


def hash_fraction(key: str | Column, fraction: float, seed: int = SEED) -> Column:
    """Deterministic Bernoulli draw: True for about ``fraction`` of keys.

    The first 32 bits of ``md5('<seed>:<key>')`` are compared with
    ``fraction * 2^32``.  The draw depends only on the key, never on the
    partition layout, so a job re-run on another cluster (or a recomputed
    partition after an executor loss) gives the same rows.  Any SQL engine
    with ``md5`` reproduces it, which is what the oracle uses.
    """
    if fraction >= 1.0:
        return F.lit(True)
    if fraction <= 0.0:
        return F.lit(False)
    cut = format(math.ceil(fraction * _HASH_SPACE), "08x")
    digest = F.md5(F.concat(F.lit(f"{seed}:"), _as_col(key).cast("string")))
    return F.substring(digest, 1, 8) < F.lit(cut)


def hash_cut_hex(fraction: float) -> str:
    """The 8-hex-digit cut used by :func:`hash_fraction` (for SQL text)."""
    return format(math.ceil(fraction * _HASH_SPACE), "08x")


def parse_double(c: str | Column) -> Column:
    """``float(text)`` as a null-on-failure cast (FN4).

    ``try_cast`` trims blanks and accepts ``1e+05``, ``nan`` and ``inf``;
    anything else becomes null instead of failing the micro-batch.
    """
    return _as_col(c).cast("string").try_cast("double")


def alert_text(time_col: str | Column = "Time", amount_col: str | Column = "Amount") -> Column:
    """Live notice for one flagged row (SNK6, FN7)."""
    return F.format_string(ALERT_FORMAT, _as_col(time_col), _as_col(amount_col))
