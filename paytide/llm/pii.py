"""Personal data by rules and by bootstrapped context patterns, in SQL functions throughout.

Rules find e-mail addresses, IP addresses, card numbers and phone numbers. These spans are the
seeds. Every word with a digit is a possible identifier (an instance), and the two words before
it are its pattern. On the graph of patterns and instances, Spark scores in turns: a pattern by
the mean score of what it precedes, an instance by the mean score of its patterns; seeds keep
score 1. Patterns with a high score and enough different seeds then name unseen identifiers:
what stands after them and no rule has found is added with kind ``id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paytide.session import stored

LOCAL = "A-Za-z0-9._%+-"
#: The contract's patterns, with quantifiers that never step back and starts only where a run
#: starts: the same matches, in linear time and without deep recursion on long runs.
PATTERNS = {
    "email": rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}",
    "card": r"[0-9](?:[\x20-]?[0-9]){15,}+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
#: What a text must hold for a pattern to be worth a search.
HINTS = {"email": "@", "phone": "+"}
#: Words with a digit.
POSSIBLE = r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+"
OTHER = "id"
OCTET = r"0*(?:[0-9]{1,2}|1[0-9]{2}|2[0-4][0-9]|25[0-5])"
CONTEXT = 96


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]+", "")


def _luhn(value: Column) -> Column:
    """Whether the check digit fits; every second digit from the right is doubled."""
    digits = F.transform(F.split(F.reverse(_digits(value)), ""), lambda d: F.when(d == "", None).otherwise(d.cast("int")))
    doubled = F.transform(
        F.filter(digits, lambda d: d.isNotNull()), lambda d, i: F.when(i % 2 == 0, d).when(d > 4, 2 * d - 9).otherwise(2 * d)
    )
    return F.aggregate(doubled, F.lit(0), lambda s, d: s + d) % 10 == 0


def _length_between(value: Column, least: int, most: int) -> Column:
    return F.length(_digits(value)).between(least, most)


VALID = {
    "email": lambda v: F.lit(True),
    "ip": lambda v: v.rlike(rf"^{OCTET}(?:\.{OCTET}){{3}}$"),
    "card": lambda v: F.when(_length_between(v, 16, 19), _luhn(v)).otherwise(F.lit(False)),
    "phone": lambda v: _length_between(v, 8, 15),
}


def _by_rule(kind: str):
    def detail(value: Column, near: Column) -> list[Column]:
        none = F.lit(None).cast("long")
        return [VALID[kind](value).alias("ok"), none.alias("pattern"), none.alias("instance")]

    return detail


def _by_context(value: Column, near: Column) -> list[Column]:
    """The instance, and its pattern: the two words before it, digits masked."""
    plain = F.translate(F.lower(F.right(near, F.lit(CONTEXT))), "0123456789", "0000000000")
    words = F.filter(F.split(plain, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    pattern = F.array_join(F.slice(words, F.greatest(F.size(words) - 1, F.lit(1)), F.lit(2)), " ")
    return [F.lit(False).alias("ok"), F.xxhash64(pattern).alias("pattern"), F.xxhash64(value).alias("instance")]


def marks(kind: str, detail) -> Column:
    """Matches as (kind, i, gap, length) and what ``detail`` says of each, from a kind's columns.

    gap is the length of what lies between a match and the one before; with it, places follow
    from running sums. Lengths are code points. ``detail`` gets the match and what precedes it.
    """
    values, between = F.col(f"values_{kind}"), F.col(f"between_{kind}")

    def mark(value: Column, i: Column) -> Column:
        near = F.concat(F.coalesce(F.get(values, i - 1), F.lit("")), F.right(F.get(between, i), F.lit(CONTEXT)))
        return F.struct(
            F.lit(kind).alias("kind"), i.alias("i"), F.length(F.get(between, i)).alias("gap"), F.length(value).alias("length"), *detail(value, near)
        )

    return F.when(between.isNotNull(), F.transform(values, mark))


def located(rows: DataFrame) -> DataFrame:
    """(row, kind, start, end, ok, pattern, instance, seed) for rows of (row, text).

    ``seed``: a valid span of a rule overlaps it. Running sums within a row give the places,
    and a running greatest end the overlaps, so a row's work grows with its matches alone.
    """
    text = F.col("text")
    searches = PATTERNS | {OTHER: POSSIBLE}
    # matches, then what lies between them, then marks: each a column of its own, since what is
    # written inside a lambda is computed anew for every element
    for kind, pattern in searches.items():
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        rows = rows.withColumn(f"values_{kind}", F.when(F.contains(text, F.lit(HINTS[kind])), values) if kind in HINTS else values)
    for kind, pattern in searches.items():
        rows = rows.withColumn(f"between_{kind}", F.when(F.size(f"values_{kind}") > 0, F.split(text, pattern, -1)))
    found = [marks(kind, _by_context if kind == OTHER else _by_rule(kind)) for kind in searches]
    lists = F.flatten(F.filter(F.array(*found), lambda m: m.isNotNull()))
    dealt = rows.select("row", F.explode(lists).alias("m")).select("row", "m.*").repartition("row")
    within = Window.partitionBy("row", "kind").orderBy("i")
    start = F.sum("gap").over(within) + F.sum("length").over(within) - F.col("length")
    placed = dealt.withColumn("start", start.cast("int")).withColumn("end", F.expr("start + length"))
    placed = placed.filter(F.col("ok") | (F.col("kind") == OTHER))
    # the rules' spans that start before this one ends, in order
    is_rule = F.col("kind") != OTHER
    key = F.when(is_rule, F.col("start")).otherwise(F.col("end") - 1)
    earlier = Window.partitionBy("row").orderBy(key, F.col("kind") == OTHER).rowsBetween(Window.unboundedPreceding, 0)
    reach = F.max(F.when(is_rule, F.col("end"))).over(earlier)
    return placed.withColumn("seed", F.coalesce(reach > F.col("start"), F.lit(False))).drop("i", "gap", "length")


def confident_patterns(edges: DataFrame, turns: int = 3, least_score: float = 0.9, least_seeds: int = 5) -> DataFrame:
    """Patterns that mostly precede identifiers, from edges (pattern, instance, seed, n).

    Every turn aggregates over the edges by pattern, then by instance; sums are formed before
    anything moves, so a pattern or an instance with a great many edges is no one task's work.
    """
    edges = stored(edges, "edges")
    instances = edges.groupBy("instance").agg(F.max(F.col("seed").cast("double")).alias("seed"))
    scores = instances.withColumn("score", F.col("seed"))
    for turn in range(turns):
        known = edges.select("pattern", "instance", "n").join(scores, "instance")
        patterns = known.groupBy("pattern").agg(
            (F.sum(F.col("n") * F.col("score")) / F.sum("n")).alias("p"), F.sum(F.col("seed")).alias("seeds")
        )
        patterns = stored(patterns, "patterns")
        if turn + 1 < turns:
            told = edges.select("pattern", "instance", "n").join(patterns, "pattern").groupBy("instance")
            told = told.agg((F.sum(F.col("n") * F.col("p")) / F.sum("n")).alias("mean"))
            scores = instances.join(told, "instance").withColumn("score", F.greatest("seed", "mean")).drop("mean")
            scores = stored(scores, "scores")
    return patterns.filter((F.col("p") >= least_score) & (F.col("seeds") >= least_seeds)).select("pattern")


def find_documents(docs: DataFrame) -> DataFrame:
    """Personal data of every row (doc_id, text).

    Returns doc_id, n_email, n_ip, n_card, n_phone (spans found by rule), base_sha256 (of those
    spans, kind:start:end, by kind and then start, comma-joined) and spans (all spans written
    likewise, discovered ones last with kind ``id``). Places are code points from 0, the end is
    exclusive. A null text is empty; equal rows are each answered; an empty table gives an
    empty result; other columns are not looked at.
    """
    rows = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    spans = stored(located(rows), "spans")
    possible = spans.filter(F.col("kind") == OTHER)
    edges = possible.groupBy("pattern", "instance").agg(F.max("seed").alias("seed"), F.count("*").alias("n"))
    unseen = possible.filter(~F.col("seed")).join(confident_patterns(edges), "pattern", "left_semi")
    kinds = F.array(*map(F.lit, PATTERNS))
    kept = spans.filter(F.col("kind") != OTHER).select("row", "kind", "start", "end")
    kept = kept.union(unseen.select("row", "kind", "start", "end"))
    place = F.when(F.col("kind") == OTHER, len(PATTERNS) + 1).otherwise(F.array_position(kinds, F.col("kind"))).cast("int")
    listed = kept.groupBy("row").agg(F.sort_array(F.collect_list(F.struct(place.alias("k"), "start", "end", "kind"))).alias("s"))
    none = F.array().cast("array<struct<k:int,start:int,end:int,kind:string>>")
    joined = rows.select("row", "doc_id").join(listed, "row", "left").withColumn("s", F.coalesce("s", none))

    def written(found: Column) -> Column:
        return F.array_join(
            F.transform(found, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))), ","
        )

    def number(kind: str) -> Column:
        return F.size(F.filter("s", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return joined.select(
        "doc_id",
        *map(number, PATTERNS),
        F.sha2(written(F.filter("s", lambda x: x["kind"] != OTHER)), 256).alias("base_sha256"),
        written(F.col("s")).alias("spans"),
    )
