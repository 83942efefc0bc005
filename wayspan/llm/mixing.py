"""Mixing of sources to target weights by iterative proportional fitting.

The token weights of the cells (source, language, topic) are raked: scaled to one marginal after
the other until all targets are met. A document's probability is the weight of its cell for each
of its tokens, scaled so that the largest is one, and documents are drawn by a hash of their id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wayspan.llm.textops import store, words

DIMS = ("source", "lang", "topic")
ALPHA = 0.8  # targets are the corpus shares to this power, where none are given
SWEEPS, AT_ONCE, CLOSE = 24, 4, 1e-6


def token_count(text: Column) -> Column:
    return F.size(words(F.coalesce(text, F.lit("")))).cast("long")


def register(text: Column) -> Column:
    """A topic by form: tables, short prose, long prose."""
    text = F.coalesce(text, F.lit(""))
    return F.when(F.instr(text, " | ") > 0, "table").when(token_count(text) < 150, "short").otherwise("prose")


def tempered_targets(cells: DataFrame, dim: str, alpha: float = ALPHA) -> DataFrame:
    """(dim, share) proportional to the corpus shares to the power ``alpha``."""
    sums = cells.groupBy(dim).agg(F.sum("tokens").alias("t")).filter("t > 0").select(dim, F.pow(F.col("t").cast("double"), F.lit(alpha)).alias("x"))
    total = sums.agg(F.sum("x")).first()[0]
    return sums.select(dim, (F.col("x") / F.lit(float(total or 1.0))).alias("share"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], sweeps: int = SWEEPS, close: float = CLOSE) -> DataFrame:
    """``cells`` (dimensions, tokens) with ``weight``, the token weights raked to the targets, which
    sum to one. Values without a target get no weight; null is a value of its own. Cells without
    tokens stay at zero, so targets that only they could meet are not reached."""
    work = cells.withColumn("weight", F.col("tokens").cast("double"))
    dims = list(targets)
    for d, t in targets.items():
        goal = t.select(F.col(d).alias(f"_{d}"), F.col("share").alias(f"{d}_goal"))
        work = work.join(goal, F.col(d).eqNullSafe(F.col(f"_{d}")), "left").drop(f"_{d}").fillna(0.0, [f"{d}_goal"])
    work = store(work, "cells")
    done = 0
    while done < sweeps:
        for _ in range(min(AT_ONCE, sweeps - done)):
            for d in dims:
                held = F.sum("weight").over(Window.partitionBy(d))
                work = work.withColumn("weight", F.when(held > 0, F.col("weight") * F.col(f"{d}_goal") / held).otherwise(0.0))
        done += AT_ONCE
        work = store(work, "cells")
        off = [work.groupBy(d).agg((F.abs(F.sum("weight") - F.first(f"{d}_goal"))).alias("off")) for d in dims[:-1]]
        if all((o.agg(F.max("off")).first()[0] or 0.0) < close for o in off):
            break
    return work.drop(*[f"{d}_goal" for d in dims])


def mix(docs: DataFrame, targets: dict[str, DataFrame] | None = None, dims: tuple[str, ...] = DIMS, id_col: str = "doc_id", tokens_col: str = "tokens", seed: int = 17) -> DataFrame:
    """All rows and columns with weight (of each token of the document, the corpus mean being 1),
    probability and sampled.

    The marginals of the sampled tokens meet the targets in expectation. Rows without tokens and
    rows of values without a target have probability 0. Equal ids are drawn together. An empty
    table gives an empty result.
    """
    cells = docs.groupBy(*dims).agg(F.sum(tokens_col).alias("tokens"))
    cells = store(cells, "cells")
    targets = targets or {d: tempered_targets(cells, d) for d in dims}
    raked = rake(cells, targets)
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    most, total, weighed = raked.agg(F.max(ratio), F.sum("tokens"), F.sum("weight")).first()
    scale = float(total or 1) / float(weighed or 1.0)
    rated = store(raked.select(*[F.col(d).alias(f"_{d}") for d in dims], F.round(ratio * scale, 9).alias("weight"), F.round(ratio / F.lit(float(most or 1.0)), 9).alias("probability")), "rates")
    same = [F.col(d).eqNullSafe(F.col(f"_{d}")) for d in dims]
    clear = docs.drop("weight", "probability", "sampled")
    drawn = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.lit(seed)), 11) / F.lit(float(1 << 53))
    return clear.join(rated, same).drop(*[f"_{d}" for d in dims]).withColumn(
        "sampled", (drawn < F.col("probability")) & (F.col(tokens_col) > 0)
    )
