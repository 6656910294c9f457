"""Exact interpolated percentiles per group, with no group gathered in one task."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytide.session import stored

# Log-linear bins: 2**bits bins per power of two, so finer bins nest in coarser ones.
# A group has at most about 100 * 2**COARSE coarse bins, a coarse bin at most
# 2**(FINE - COARSE) fine ones, and a fine bin around value v at most v / 2**FINE values.
COARSE, FINE = 5, 17


def _magnitude_bin(v: Column, bits: int) -> Column:
    top = F.floor(F.log2(F.greatest(v, F.lit(1)).cast("double"))).cast("int")
    shift = F.greatest(top - F.lit(bits), F.lit(0))
    # floor(v / 2**shift) is exact: the divisor is a power of two and v < 2**53
    return (shift.cast("long") * (1 << bits) + F.floor(v / F.pow(F.lit(2.0), shift))).cast("long")


def value_bin(v: Column, bits: int = COARSE) -> Column:
    """A bin number that never decreases as ``v`` (an integer) grows."""
    return F.when(v < 0, -_magnitude_bin(-v, bits)).otherwise(_magnitude_bin(v, bits))


def _rank(p: float, side) -> Column:
    return side(F.lit(p) * (F.col("_n") - 1)).cast("long")


def _holding(bins: DataFrame, within: list[str], at: str, probs: dict[str, float]) -> DataFrame:
    """Bins (``at``, with row counts ``_c``) that hold a wanted rank, and their first rank.

    Counting starts at ``_start``, the first rank of the surrounding bin.
    """
    ordered = Window.partitionBy(*within).orderBy(at)
    placed = bins.withColumn("_end", F.col("_start") + F.sum("_c").over(ordered)).withColumn(
        "_start", F.col("_end") - F.col("_c")
    )
    wanted = reduce(
        lambda a, b: a | b,
        [
            (F.col("_start") <= _rank(p, side)) & (_rank(p, side) < F.col("_end"))
            for p in probs.values()
            for side in (F.floor, F.ceil)
        ],
    )
    return placed.filter(wanted)


def _in_bins(rows: DataFrame, targets: DataFrame, keys: list[str], at: str) -> DataFrame:
    """Rows of the target bins, with each bin's ``_n`` and ``_start``. Keys may be null.

    The bin is matched null-safely as well, although it never is null: a plain equality
    would add a not-null filter that computes every bin a second time.
    """
    t = targets.select(
        *[F.col(k).alias(f"_t{i}") for i, k in enumerate(keys)], F.col(at).alias("_tbin"), "_n", "_start"
    )
    same = [F.col(k).eqNullSafe(F.col(f"_t{i}")) for i, k in enumerate(keys)]
    joined = rows.join(t, reduce(lambda a, b: a & b, same, F.col(at).eqNullSafe(F.col("_tbin"))))
    return joined.drop(*[f"_t{i}" for i in range(len(keys))], "_tbin")


def exact_percentiles(
    df: DataFrame, keys: list[str], value: str, probs: dict[str, float], count: str = "n"
) -> DataFrame:
    """``percentile_cont`` of the integer column ``value`` for each group of ``keys``.

    The first pass counts rows per coarse bin, combined before the shuffle, and finds the
    bins holding the wanted ranks. The second pass reads the rows of those bins only and
    counts them by distinct value; fine bins then narrow each search to a few values,
    which are walked in order. So a group with a third of all rows costs a short histogram
    and two narrow slices, and no window is longer than the bounds above.

    Both passes run when this is called and store what they found, a few rows per group.
    The second join then knows the true size of its target bins: Spark broadcasts them if
    they are small, so the table is read twice but only its wanted slices are shuffled.
    """
    cells = df.filter(F.col(value).isNotNull()).select(
        *keys, F.col(value).cast("long").alias("_v"), value_bin(F.col(value)).alias("_bin")
    )
    histogram = (
        cells.groupBy(*keys, "_bin")
        .agg(F.count("*").alias("_c"))
        .withColumn("_n", F.sum("_c").over(Window.partitionBy(*keys)))
        .withColumn("_start", F.lit(0).cast("long"))
    )
    wanted = _holding(histogram, keys, "_bin", probs)
    coarse = stored(wanted.select(*keys, "_bin", "_n", "_start"), "bins")
    values = stored(
        _in_bins(cells, coarse, keys, "_bin")
        .groupBy(*keys, "_bin", "_n", "_start", "_v")
        .agg(F.count("*").alias("_c"))
        .withColumn("_fine", value_bin(F.col("_v"), FINE)),
        "slices",
    )
    slices = values.groupBy(*keys, "_bin", "_n", "_start", "_fine").agg(F.sum("_c").alias("_c"))
    fine = _holding(slices, [*keys, "_bin"], "_fine", probs)
    near = _in_bins(values.drop("_n", "_start"), fine, keys, "_fine")
    walked = near.withColumn(
        "_hi",
        F.col("_start") + F.sum("_c").over(Window.partitionBy(*keys, "_fine").orderBy("_v")),
    ).withColumn("_lo", F.col("_hi") - F.col("_c"))

    def at_rank(p: float, side) -> Column:
        r = _rank(p, side)
        return F.max(F.when((F.col("_lo") <= r) & (r < F.col("_hi")), F.col("_v")))

    picked = walked.groupBy(*keys).agg(
        F.max("_n").alias("_n"),
        *[at_rank(p, F.floor).alias(f"_{name}_lo") for name, p in probs.items()],
        *[at_rank(p, F.ceil).alias(f"_{name}_hi") for name, p in probs.items()],
    )

    def interpolated(name: str, p: float) -> Column:
        lo, hi = F.col(f"_{name}_lo").cast("double"), F.col(f"_{name}_hi").cast("double")
        place = F.lit(p) * (F.col("_n") - 1)
        return (lo + (hi - lo) * (place - F.floor(place))).alias(name)

    return picked.select(
        *keys, F.col("_n").alias(count), *[interpolated(n, p) for n, p in probs.items()]
    )
