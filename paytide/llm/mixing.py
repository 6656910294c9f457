"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

Targets share the whole budget by weight, none above ``repeat`` times its source. The budget
is cut into seats of ``block`` words, which go to sources by the highest quotients
target/(2j+1). A source's documents, in seeded order, form one stream of words cut into
blocks; the words of its seats are full passes over that stream and, for the rest, an integer
quota of blocks for each of ``shards`` stretches of it. A source at its cap is all full passes. Within a stretch a seeded start picks the blocks. A
document's words in chosen blocks are what the mix takes from it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paytide.functions.position import with_position
from paytide.llm.common import key_number, n_words
from paytide.session import stored

WEIGHTS = (5, 2, 1)


def targets(sources: DataFrame, repeat: int) -> DataFrame:
    """Add ``target`` to sources (source, source_size, weight).

    Sources whose share passes ``repeat`` times their size stop there, and the rest is shared
    again by weight until none is above. Each turn is one sum over the table of sources.
    """
    total = sources.agg(F.sum("source_size").cast("double")).head()[0] or 0.0
    level, cap = None, F.col("source_size") * F.lit(float(repeat))
    while True:
        above = F.lit(False) if level is None else cap <= F.lit(level) * F.col("weight")
        spent, weight = sources.agg(
            F.sum(F.when(above, cap).otherwise(F.lit(0.0))),
            F.sum(F.when(above, F.lit(0.0)).otherwise(F.col("weight").cast("double"))),
        ).head()
        if not weight:
            break
        new = (total - spent) / weight
        if level is not None and new <= level:
            break
        level = new
    return sources.withColumn("target", F.least(cap, F.lit(float(level or 0.0)) * F.col("weight")))


def seats(sources: DataFrame, block: int) -> DataFrame:
    """Add ``seats``: the budget's round(total/block) seats by highest quotients target/(2j+1).

    A quotient threshold t gives a source floor((target/t + 1)/2) seats, and all sources
    within half a seat each of total/(2t). Seats above the upper such threshold are surely
    in; only those between the two, two a source on average, are ranked.
    """
    total, n = sources.agg(F.sum("target"), F.count("*")).head()
    m = int((total or 0.0) / block + 0.5)
    if not m:
        return sources.withColumn("seats", F.lit(0).cast("long"))
    high = total / (2 * (m - n / 2)) if 2 * m > n else None
    low = total / (2 * (m + n / 2))
    sure = F.lit(0) if high is None else F.greatest(F.floor((F.col("target") / high + 1) / 2) - 1, F.lit(0))
    ranged = sources.withColumn("_sure", sure.cast("long")).withColumn(
        "_most", (F.floor((F.col("target") / low + 1) / 2) + 1).cast("long")
    )
    open_seats = ranged.filter("target > 0").select(
        "source", "_rank", "target", F.explode(F.expr("sequence(_sure, _most)")).alias("_j")
    ).withColumn("_less", -F.col("target") / (2 * F.col("_j") + 1))
    left = m - ranged.agg(F.sum("_sure")).head()[0]
    ranked = with_position(open_seats, ["_less", "_rank", "_j"], "_place")
    won = ranked.filter(F.col("_place") < left).groupBy("_rank").agg(F.count("*").alias("_won"))
    return (
        ranged.join(won, "_rank", "left")
        .withColumn("seats", F.col("_sure") + F.coalesce("_won", F.lit(0)))
        .drop("_sure", "_most", "_won")
    )


def laid_out(rows: DataFrame, group: str, order: list[str], size: str, name: str) -> DataFrame:
    """Add where each row starts when a group's rows lie end to end in ``order``.

    Rows are dealt by range over (group, order), so a group may span many tasks; sums per
    task and group give each task its start.
    """
    ranged = stored(
        rows.withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(group, *order, "_tie")
        .sortWithinPartitions(group, *order, "_tie")
        .drop("_tie")
        .withColumn("_row", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_row", 33)),
        "laid",
    )
    per_part = ranged.groupBy(group, "_part").agg(F.sum(size).alias("_sum"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_part.select(
        F.col(group).alias("_g"), F.col("_part").alias("_p"), F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_start")
    )
    inside = Window.partitionBy("_part", group).orderBy("_row").rowsBetween(Window.unboundedPreceding, -1)
    return (
        ranged.withColumn(name, F.coalesce(F.sum(size).over(inside), F.lit(0)))
        .join(starts, (F.col("_part") == F.col("_p")) & F.col(group).eqNullSafe(F.col("_g")))
        .withColumn(name, F.col(name) + F.col("_start"))
        .drop("_row", "_part", "_g", "_p", "_start")
    )


def mix(
    rows: DataFrame,
    order: list[str],
    block: int = 32,
    repeat: int = 3,
    shards: int = 16,
    seed: int = 0,
) -> DataFrame:
    """Add source_size, target and taken to rows that have ``source`` and ``size``.

    Sources in code-point order, null last, weigh 5, 2, 1 and again. ``order`` lists columns
    that tell documents apart; they are hashed with the seed. A document of size 0 takes
    nothing, an empty table gives an empty result, equal rows are each laid out. No row
    takes more than ``repeat`` times its size. The only numbers on the driver are totals.
    """
    columns = rows.columns
    rows = stored(rows, "sizes")  # counting words is the costly part, and rows are read three times
    sizes = rows.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    sizes = stored(sizes.withColumn("_null", F.col("source").isNull()), "sources")
    ranked = with_position(sizes, ["_null", "source"], "_rank").drop("_null")
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (F.col("_rank") % len(WEIGHTS) + 1).cast("int"))
    shared = stored(seats(targets(stored(ranked.withColumn("weight", weight), "weights"), repeat), block), "seats")
    quotas = shared.select(
        F.col("source").alias("_source"),
        F.col("source_size"),
        F.col("target"),
        F.col("_rank"),
        # a source at its cap is taken whole that many times; another one gets the words of its seats
        F.expr(f"IF(target >= {repeat} * source_size, {repeat} * source_size, least(seats * {block}, {repeat} * source_size))").alias("_words"),
    ).filter("source_size > 0")
    quotas = quotas.withColumns({"_n": F.expr(f"source_size div {block}"), "_full": F.expr("_words div source_size"), "_left": F.expr("_words % source_size")})
    # what is left comes from whole blocks, a last short one aside, unless one more pass is nearer to it
    quotas = quotas.withColumn("_rest", F.expr(f"least(_n, (_left + {block // 2}) div {block})"))
    more = F.expr(f"_full < {repeat} AND source_size - _left < abs(_left - _rest * {block})")
    quotas = quotas.select(
        "_source",
        "source_size",
        "target",
        "_n",
        (F.col("_full") + more.cast("long")).alias("_full"),
        F.when(more, 0).otherwise(F.col("_rest")).alias("_rest"),
        F.expr(f"{key_number(seed, 'start')} + _rank * 7919").alias("_seed"),
    )
    keyed = rows.withColumn("_key", F.xxhash64(F.lit(key_number(seed, "order")), *order))
    laid = laid_out(keyed, "source", ["_key", *order], "size", "_at")
    # per shard p: blocks from p*n/shards on, and its quota of the rest in proportion
    empty = shared.filter("source_size = 0").select(F.col("source").alias("_source"), "source_size", "target", *[F.lit(0).cast("long").alias(c) for c in ("_n", "_full", "_rest", "_seed")])
    joined = laid.join(quotas.unionByName(empty), F.col("source").eqNullSafe(F.col("_source")))
    p = f"((b * {shards}) div _n)"
    first = f"((({{p}}) * _n + {shards - 1}) div {shards})".format
    c0, c1 = first(p=p), first(p=f"{p} + 1")
    quota = f"(({c1} * _rest) div _n - ({c0} * _rest) div _n)"
    start = f"((_seed + {p} * 104729) % ({c1} - {c0}))"
    chosen = f"(((b - {c0} + {start}) % ({c1} - {c0})) < {quota})"
    words = f"(least((b + 1) * {block}, _at + size) - greatest(b * {block}, _at))"
    blocks = f"sequence(_at div {block}, (_at + size - 1) div {block})"
    partly = f"aggregate({blocks}, 0L, (sum, b) -> sum + CASE WHEN b < _n AND {chosen} THEN {words} ELSE 0L END)"
    taken = f"CASE WHEN size <= 0 THEN 0L WHEN _rest = 0 THEN _full * size ELSE _full * size + {partly} END"
    return joined.select(*[f"`{c}`" for c in columns], "source_size", "target", F.expr(taken).alias("taken"))


def mix_documents(docs: DataFrame, **options) -> DataFrame:
    """What the mix takes of every document: doc_id, size, source_size, target, taken.

    Size is the number of words; a null text has none. Only these numbers and digests move,
    never the text.
    """
    narrow = docs.select(
        "doc_id", "source", n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_text")
    )
    mixed = mix(narrow, ["doc_id", "_text"], **options)
    return mixed.select("doc_id", "size", "source_size", "target", "taken")
