"""Repeatable random numbers from row numbers: the same in Spark, numpy and SQL text.

A number of 31 bits is mixed from the row, a stream (the round of a resampling) and a seed by integer
steps that stay below 2 ** 63, so every engine gives the same bits whatever the partitioning.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import exp

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 31
TOP = 1 << BITS
# fixed values of the mixing: (shift, multiplier) of each step, and the last shift
STEPS = ((16, 0x45D9F3B), (15, 0x2C1B3C6D))
LAST = 16
APART = 40503  # between the numbers of streams and of rows


def _poisson_limits() -> np.ndarray:
    """Numbers from which the Poisson(1) count is 1, 2, ...; counts rarer than one number cannot come up."""
    out, total, term, k = [], 0.0, exp(-1.0), 0
    while term * TOP > 1:
        total += term
        out.append(int(total * TOP))
        k += 1
        term /= k
    return np.array(out)


POISSON = _poisson_limits()


def _mix(x: np.ndarray) -> np.ndarray:
    x = x & (TOP - 1)
    for shift, factor in STEPS:
        x = ((x ^ (x >> shift)) * factor) & (TOP - 1)
    return x ^ (x >> LAST)


def numbers(rows: np.ndarray, streams: np.ndarray, seed: int) -> np.ndarray:
    """[row, stream] numbers below 2 ** 31; rows are not negative."""
    rows = rows.astype(np.int64)
    own = _mix((rows & (TOP - 1)) + _mix((rows >> BITS) + seed + 1))
    return _mix(_mix(own[:, None] + _mix(streams.astype(np.int64) + seed + APART)))


def poisson_counts(u: np.ndarray) -> np.ndarray:
    return np.searchsorted(POISSON, u, side="right")


def row_number(df: DataFrame, row_key: Sequence[str]) -> Column:
    """A number for each row: a single integer column itself, otherwise a hash of the columns."""
    kinds = dict(df.dtypes)
    if len(row_key) == 1 and kinds[row_key[0]] in ("tinyint", "smallint", "int", "bigint"):
        number = F.coalesce(F.col(row_key[0]).cast("bigint"), F.lit(0))
    else:
        number = F.xxhash64(*[F.col(c) for c in row_key])
    return number.bitwiseAND(F.lit((1 << 63) - 1))


def once(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often it is named."""
    return F.get(F.transform(F.array(value), use), 0)


def _mixed(start: Column) -> Column:
    x = start.bitwiseAND(F.lit(TOP - 1))
    for shift, factor in STEPS:
        x = once(x, lambda v: (v.bitwiseXOR(F.shiftright(v, shift)) * F.lit(factor)).bitwiseAND(F.lit(TOP - 1)))  # noqa: B023 (used at once)
    return once(x, lambda v: v.bitwiseXOR(F.shiftright(v, LAST)))


def number(row: Column, seed: int, stream: Column | None = None) -> Column:
    """The number of each row (in the stream, 0 by default)."""
    stream = F.lit(0) if stream is None else stream
    high = _mixed(F.shiftright(row, BITS) + F.lit(seed + 1))
    own = _mixed(row.bitwiseAND(F.lit(TOP - 1)) + high)
    return _mixed(_mixed(own + _mixed(stream.cast("bigint") + F.lit(seed + APART))))


def _mixed_column(x: Column) -> Column:
    """As :func:`_mixed` for a column of a table: plain arithmetic that names it eight times."""
    x = x.bitwiseAND(F.lit(TOP - 1))
    for shift, factor in STEPS:
        x = (x.bitwiseXOR(F.shiftright(x, shift)) * F.lit(factor)).bitwiseAND(F.lit(TOP - 1))
    return x.bitwiseXOR(F.shiftright(x, LAST))


def with_rounds(df: DataFrame, row: Column, seed: int, rounds: int, name: str) -> DataFrame:
    """Every row once for each round, with ``iter`` and, as ``name``, the :func:`number` of row and round.

    What depends on the row alone is mixed before the rows are spread, what depends on the round alone
    here, and each mixing is a column of its own, so that no value is worked out twice.
    """
    own = df.withColumn("_row", row).withColumn("_high", _mixed_column(F.shiftright("_row", BITS) + F.lit(seed + 1)))
    own = own.withColumn("_own", _mixed_column(F.col("_row").bitwiseAND(F.lit(TOP - 1)) + F.col("_high")))
    streams = F.lit(_mix(np.arange(rounds) + seed + APART).tolist()).cast("array<bigint>")
    spread = own.select(*df.columns, "_own", F.posexplode(streams).alias("iter", "_stream"))
    both = spread.withColumn("_both", _mixed_column(F.col("_own") + F.col("_stream")))
    return both.withColumn(name, _mixed_column(F.col("_both"))).drop("_own", "_stream", "_both")


def poisson_weight(u: Column) -> Column:
    """Poisson(1) count of a number."""
    out = F.when(u < int(POISSON[0]), F.lit(0))
    for k, limit in enumerate(POISSON[1:], 1):
        out = out.when(u < int(limit), F.lit(k))
    return out.otherwise(F.lit(len(POISSON)))


def numbers_sql(source: str, name: str, row: str, seed: int, stream: str = "0") -> str:
    """The rows of ``source`` with the column ``name``, as a subquery."""

    def mixed(inner: str, start: str, to: str) -> str:
        text = f"(SELECT *, ({start}) & {TOP - 1} AS {to} FROM {inner})"
        for shift, factor in STEPS:
            text = f"(SELECT * REPLACE ((xor({to}, {to} >> {shift}) * {factor}) & {TOP - 1} AS {to}) FROM {text})"
        return f"(SELECT * REPLACE (xor({to}, {to} >> {LAST}) AS {to}) FROM {text})"

    text = mixed(source, f"(CAST({row} AS BIGINT) >> {BITS}) + {seed + 1}", "n_high")
    text = mixed(text, f"(CAST({row} AS BIGINT) & {TOP - 1}) + n_high", "n_own")
    text = mixed(text, f"CAST({stream} AS BIGINT) + {seed + APART}", "n_round")
    text = mixed(text, "n_own + n_round", "n_both")
    return f"(SELECT * EXCLUDE (n_high, n_own, n_round, n_both) FROM {mixed(text, 'n_both', name)})"


def poisson_sql(u: str) -> str:
    return "(" + " + ".join(f"CAST({u} >= {int(x)} AS INTEGER)" for x in POISSON) + ")"
