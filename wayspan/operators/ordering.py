"""Exact positions, quantiles and sliding frames for groups of any size.

A window over ``partitionBy(route)`` puts a whole route into one task. Here every group is cut
into ordered blocks, each handled by its own task; a group that fits one block simply has one:

1. count the rows of every group, and from that its number of blocks;
2. take a hash sample of the order keys of groups with more than one block (the same rows on
   every run) and keep every n-th as a split point;
3. number the rows inside (group, block) and add the rows of earlier blocks.

Split points are looked up on two levels, so that no row meets more than about the square root
of them. NULL is a group key like any other. Nothing runs while a plan is built.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

ROWS_PER_BLOCK = 1_000_000
OVERSAMPLE = 16
FANOUT = 256
SALTS = 32


def _uniform(*cols: Column) -> Column:
    """A repeatable number in [0, 1) made from the given columns."""
    return F.xxhash64(*cols).bitwiseAND(F.lit((1 << 52) - 1)).cast("double") / F.lit(float(1 << 52))


def _blocked(df: DataFrame, keys: Sequence[str], order: Sequence[str], rows_per_block: int) -> DataFrame:
    """Add ``_block`` (ordered block inside the group) and the order key ``_ord``.

    Only groups of more than ``rows_per_block`` rows are sampled and have split points, of which there is
    about one for so many rows; these small tables are broadcast, so the rows stay where they
    are. Where no group is that large the sample's scan falls away at run time.
    """
    keys = list(keys)
    df = df.withColumn("_ord", F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]))
    sizes = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).withColumn("_blocks", F.ceil(F.col("_rows") / F.lit(rows_per_block)))
    hot = sizes.filter("_blocks > 1").select(*keys, "_rows", "_blocks")
    picked = _uniform(*[F.col(k) for k in keys], F.col("_ord")) < F.col("_blocks") * F.lit(OVERSAMPLE) / F.col("_rows")
    if keys:
        sample = attach(df.select(*keys, "_ord"), F.broadcast(hot), keys).filter(picked)
    else:
        pair = hot.select(F.struct("_rows", "_blocks").alias("p")).scalar()
        sample = (
            df.select("_ord").withColumn("_p", pair)
            .withColumn("_rows", F.col("_p._rows")).withColumn("_blocks", F.col("_p._blocks")).filter(picked)
        )
    # OVERSAMPLE rows a block: a small table, ordered group by group
    at = F.row_number().over(Window.partitionBy(*keys).orderBy("_ord"))
    splits = sample.select(*keys, "_ord").distinct().withColumn("_at", at).filter(F.col("_at") % OVERSAMPLE == 0)
    splits = splits.withColumn("_at", (F.col("_at") / OVERSAMPLE).cast("long") - 1)
    last = F.col("_at") % FANOUT == FANOUT - 1
    coarse = splits.filter(last).groupBy(*keys).agg(F.sort_array(F.collect_list("_ord")).alias("_coarse"))
    fine = splits.filter(~last).groupBy(*keys, F.floor(F.col("_at") / FANOUT).cast("int").alias("_c")).agg(F.sort_array(F.collect_list("_ord")).alias("_fine"))
    if keys:
        out = attach(df, F.broadcast(coarse), keys, "left")
    else:
        out = df.withColumn("_coarse", coarse.select("_coarse").scalar())
    passed = lambda name: F.when(F.col(name).isNull(), F.lit(0)).otherwise(F.size(F.filter(name, lambda s: s <= F.col("_ord"))))
    out = attach(out.withColumn("_c", passed("_coarse")), F.broadcast(fine), [*keys, "_c"], "left")
    return out.withColumn("_block", F.col("_c") * FANOUT + passed("_fine")).drop("_coarse", "_fine", "_c")


def with_positions(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    *,
    weight: str | None = None,
    pos: str = "pos",
    total: str = "n",
    rows_per_block: int = ROWS_PER_BLOCK,
) -> DataFrame:
    """0-based position of each row in its group and the group size.

    With ``weight``, ``pos`` is the weight of all earlier rows and ``total`` the
    weight of the group.  ``order`` must be unique inside a group for a fixed result.
    """
    keys = list(keys)
    rows = _blocked(df, keys, order, rows_per_block)
    amount = F.lit(1).cast("bigint") if weight is None else F.col(weight).cast("bigint")
    blocks = rows.groupBy(*keys, "_block").agg(F.sum(amount).alias("_in"))
    before = Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        *keys, "_block", F.coalesce(F.sum("_in").over(before), F.lit(0)).alias("_off"), F.sum("_in").over(Window.partitionBy(*keys)).alias("_total")
    )
    # The explicit exchange keeps a hot group spread: a join on the bare keys would
    # otherwise already satisfy the window below.
    spread = rows.repartition(*keys, "_block")
    inner = Window.partitionBy(*keys, "_block").orderBy("_ord")
    if weight is None:
        local = (F.row_number().over(inner) - 1).cast("bigint")
    else:
        local = F.coalesce(F.sum(amount).over(inner.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    numbered = spread.withColumn("_local", local)
    return (
        attach(numbered, offsets, [*keys, "_block"])
        .withColumn(pos, F.col("_local") + F.col("_off"))
        .withColumn(total, F.col("_total").cast("bigint"))
        .drop("_local", "_off", "_block", "_ord", "_total")
    )


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """One row per (group, value) with its count; NULL values are left out."""
    return df.filter(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("cnt"))


def running_counts(
    df: DataFrame, keys: Sequence[str], value: str, *, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Per (group, value): ``cnt``, rows below it (``below``) and group rows ``n``."""
    return with_positions(
        value_counts(df, keys, value), keys, [value], weight="cnt", pos="below", total="n",
        rows_per_block=rows_per_block,
    )


def expand_counts(df: DataFrame, first: str = "below", cnt: str = "cnt", pos: str = "pos", chunk: int = 4096) -> DataFrame:
    """One row per original row of a running count; long ties are unfolded in bounded chunks."""
    starts = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(cnt) - 1, F.lit(chunk).cast("bigint")))
    cut = df.withColumn("_s", starts)
    upto = F.least(F.col("_s") + (chunk - 1), F.col(cnt) - 1)
    return cut.withColumn("_i", F.explode(F.sequence(F.col("_s"), upto))).withColumn(pos, F.col(first) + F.col("_i")).drop("_s", "_i")


def quantiles_of(running: DataFrame, keys: Sequence[str], value: str, qs: dict[str, float]) -> DataFrame:
    """Linear-interpolated quantiles per group from :func:`running_counts`."""
    aggs = []
    for name, q in qs.items():
        rank = (F.col("n") - 1) * F.lit(float(q))
        lo = F.floor(rank)
        hi = F.least(lo + 1, F.col("n") - 1)
        for tag, at in (("lo", lo), ("hi", hi)):
            inside = (F.col("below") <= at) & (at < F.col("below") + F.col("cnt"))
            aggs.append(F.max(F.when(inside, F.col(value))).alias(f"_{name}_{tag}"))
    out = running.groupBy(*keys).agg(F.max("n").alias("_n"), *aggs)
    cols = []
    for name, q in qs.items():
        rank = (F.col("_n") - 1) * F.lit(float(q))
        lo, hi = F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        cols.append((lo + (hi - lo) * (rank - F.floor(rank))).alias(name))
    return out.select(*keys, *cols)


def group_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    qs: dict[str, float],
    *,
    rows_per_block: int = ROWS_PER_BLOCK,
    accuracy: int | None = None,
) -> DataFrame:
    """Exact quantiles per group from running counts of its values; ``accuracy`` asks for the
    approximation in one pass instead."""
    if accuracy:
        cols = [F.percentile_approx(value, F.lit(float(q)), F.lit(accuracy)).alias(n) for n, q in qs.items()]
        return df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(*cols)
    return quantiles_of(running_counts(df, keys, value, rows_per_block=rows_per_block), keys, value, qs)


def weighted_quantiles(
    counts: DataFrame, keys: Sequence[str], value: str, weights: Sequence[str], q: float = 0.5, *, rows_per_block: int = ROWS_PER_BLOCK
) -> DataFrame:
    """Linear-interpolated quantile per group for several counts of the same values: one row for each
    (group, value) with a column of counts for every population, one order for all of them.
    Columns are named after the weights; NULL where a population is empty."""
    keys, weights = list(keys), list(weights)
    rows = _blocked(counts.filter(F.col(value).isNotNull()).select(*keys, value, *weights), keys, [value], rows_per_block)
    blocks = rows.groupBy(*keys, "_block").agg(*[F.sum(w).alias(f"_in_{w}") for w in weights])
    whole, before = Window.partitionBy(*keys), Window.partitionBy(*keys).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = blocks.select(
        *keys, "_block", *[F.coalesce(F.sum(f"_in_{w}").over(before), F.lit(0)).alias(f"_off_{w}") for w in weights],
        *[F.sum(f"_in_{w}").over(whole).alias(f"_n_{w}") for w in weights],
    )
    inner = Window.partitionBy(*keys, "_block").orderBy("_ord").rowsBetween(Window.unboundedPreceding, -1)
    local = rows.repartition(*keys, "_block").withColumns({f"_below_{w}": F.coalesce(F.sum(w).over(inner), F.lit(0)) for w in weights})
    placed = attach(local, offsets, [*keys, "_block"])
    aggs = []
    for w in weights:
        rank = (F.col(f"_n_{w}") - 1) * F.lit(float(q))
        below, lo = F.col(f"_below_{w}") + F.col(f"_off_{w}"), F.floor(rank)
        for tag, at in (("lo", lo), ("hi", F.least(lo + 1, F.col(f"_n_{w}") - 1))):
            aggs.append(F.max(F.when((below <= at) & (at < below + F.col(w)), F.col(value))).alias(f"_{w}_{tag}"))
        aggs.append(F.max(rank - lo).alias(f"_{w}_part"))
    out = placed.groupBy(*keys).agg(*aggs)
    cells = [(F.col(f"_{w}_lo") + (F.col(f"_{w}_hi") - F.col(f"_{w}_lo")) * F.col(f"_{w}_part")).alias(w) for w in weights]
    return out.select(*keys, *cells)


def row_frames(
    df: DataFrame, keys: Sequence[str], order: Sequence[str], before: int, after: int, *,
    block_rows: int = 100_000, rows_per_block: int = ROWS_PER_BLOCK, figures: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[DataFrame, WindowSpec]:
    """Rows with ``pos`` and ``n``, and a window in row order that sees ``before`` rows back and ``after`` ahead.

    The numbered rows are cut into blocks of ``block_rows``, and each block also receives copies
    of its neighbours' edge rows. ``figures`` adds columns to the numbered rows that their order does not
    need. Call :func:`core_rows` afterwards to drop the copies.
    """
    keys = list(keys)
    placed = with_positions(df, keys, order, rows_per_block=rows_per_block)
    placed = figures(placed) if figures else placed
    size = max(block_rows, before, after, 1)
    blk, off = F.floor(F.col("pos") / F.lit(size)), F.col("pos") % F.lit(size)
    # only to blocks that have rows: a short group is one block and not copied
    ahead, back = (off >= size - before) & ((blk + 1) * size < F.col("n")), (off < after) & (blk > 0)
    copies = F.array_compact(F.array(blk, F.when(ahead, blk + 1), F.when(back, blk - 1)))
    framed = (
        placed.withColumn("_own", blk).withColumn("_frame", F.explode(copies))
        .withColumn("_core", F.col("_frame") == F.col("_own")).drop("_own").repartition(*keys, "_frame")
    )
    return framed, Window.partitionBy(*keys, "_frame").orderBy("pos")


def core_rows(df: DataFrame) -> DataFrame:
    return df.filter("_core").drop("_core", "_frame")


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row of each group by ``order``, combined map-side (no group is gathered)."""
    rest = F.struct(*[F.col(c) for c in df.columns])
    first = df.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.min_by(rest, F.struct(*[F.col(c) for c in order])).alias("_row")
    )
    return first.select("_row.*")


def attach(df: DataFrame, stats: DataFrame, keys: Sequence[str], how: str = "inner", salts: int = 1) -> DataFrame:
    """Join per-group figures back to the rows; NULL keys meet NULL keys.

    Spark broadcasts ``stats`` only if its measured size allows; otherwise the join
    shuffles.  ``salts`` > 1 spreads each key over that many tasks, for plans that
    aggregate on the same keys next (where adaptive skew splitting cannot help).  The salt
    of a row is its input partition: copies of one row are spread as well, and a task that
    runs again gives the same salts.
    """
    keys = list(keys)
    names = [f"_key{i}" for i in range(len(keys))]
    figures = stats.withColumnsRenamed(dict(zip(keys, names, strict=True)))
    same = F.lit(True)
    for k, name in zip(keys, names, strict=True):
        same = same & F.col(k).eqNullSafe(F.col(name))
    if salts <= 1:
        return df.join(figures, same, how).drop(*names)
    tag = F.spark_partition_id() % F.lit(salts)
    copies = figures.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return df.withColumn("_salt", tag).join(copies, same & (F.col("_salt") == F.col("_copy")), how).drop("_salt", "_copy", *names)
