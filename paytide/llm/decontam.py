"""Benchmark decontamination by templates.

Numbers, units after numbers and names become typed placeholders; all other words are lower-cased.
Windows of ``WINDOW`` template words of the benchmark are looked up among the windows of all
documents by a hash join, so a question is found again when only its numbers or names were changed.
A run of capitalised words is one name. Whether a capitalised word that begins a sentence is a name
cannot be seen, and a copy may have lost its capitals, so three templates of each text are looked
up: such words as words, such words as names, and all names as words. Matches of a document and an
item on one diagonal (place in the document less place in the item) or on neighbouring ones are then
checked slot by slot: a value of the item must stand for one and the same value everywhere in the copy.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paytide.session import stored

WINDOW = 8
#: Items of fewer template words are left out.
LEAST = 4
#: Letters, digits and marks that a template word may hold.
SEPARATOR = r"[^\p{L}\p{M}\p{N}⟨·]+"
#: Units that may follow a number.
UNITS = "mm|cm|km|m|mg|kg|g|ml|l|ms|s|sec|min|h|hours?|minutes?|seconds?|days?|weeks?|months?|years?|miles?|feet|ft|inch(?:es)?|lbs?|oz|usd|eur|dollars?|euros?|percent|mph|kmh|hz|khz|mhz|gb|mb|kb|tb"
#: Windows of the benchmark that a task may hold; a larger benchmark is joined by a shuffle.
BROADCAST_WINDOWS = 1 << 18
#: Names (16 bytes) of documents that a task may hold; more of them meet the texts by a shuffle.
BROADCAST_NAMES = 1 << 20


def marked(text: Column) -> Column:
    """The text with ⟨ and a letter before what may be a placeholder.

    n is a number, u a unit, p a name inside a sentence, r a further word of that name, c another
    capitalised word, s a name right after that.
    """
    plain = F.replace(text, F.lit("⟨"), F.lit(" "))
    joined = F.regexp_replace(plain, r"([0-9])[.,](?=[0-9])", "$1·")
    # what does not begin like a match is told by its first character, ahead of any look behind
    numbers = F.regexp_replace(joined, r"[0-9]++(?:·[0-9]++)*+", " ⟨n$0 ")
    units = F.regexp_replace(numbers, rf"⟨n(?i:([0-9·]++ {{1,3}})({UNITS})(?![\p{{L}}\p{{N}}]))", "⟨n$1⟨u$2")
    names = F.regexp_replace(units, r"(?=\p{Lu})(?<=[\p{L}\p{N},;] )(\p{Lu}\p{Ll}++)", "⟨p$1")
    first = F.regexp_replace(names, r"(?=\p{Lu})(?<![\p{L}\p{M}\p{N}·⟨])(\p{Lu}\p{Ll}++)", "⟨c$1")
    further = F.regexp_replace(first, r"⟨p(?<=⟨p[\p{L}\p{M}]{1,40} ⟨p)", "⟨r")
    return F.regexp_replace(further, r"⟨p(?<=⟨c[\p{L}\p{M}]{1,40} ⟨p)", "⟨s")


def template_words(mark: Column) -> Column:
    return F.filter(F.split(F.lower(mark), SEPARATOR), lambda w: w != "")


#: Ways to look a text up: the letters that stand for a name, and those that belong to the name before.
KINDS = {"typed": ("ps", "r"), "named": ("pc", "rs"), "folded": ("", ""), "valued": ("", "")}


def keys(words: Column, kind: str) -> Column:
    """One hash per template word: placeholders count by type alone, those of "valued" by their value."""
    names, inner = ([f"⟨{m}" for m in marks] for marks in KINDS[kind])

    def key(w: Column) -> Column:
        mark, bare = F.substring(w, 1, 2), F.when(w.startswith("⟨"), F.substring(w, 3, 1 << 30)).otherwise(w)
        if kind == "valued":
            return F.xxhash64(bare)
        return F.xxhash64(F.when(mark.isin("⟨n", "⟨u"), mark).when(mark.isin(*names), "⟨p").otherwise(bare) if names else F.when(mark.isin("⟨n", "⟨u"), mark).otherwise(bare))

    return F.transform(F.filter(words, lambda w: ~F.substring(w, 1, 2).isin(*inner)) if inner else words, key)


def _values(mark: Column, kind: str) -> Column:
    """Per place of ``kind`` the value in its slot, after its type; null where there is no slot."""
    names, inner = KINDS[kind]
    whole = F.regexp_replace(mark, f" ⟨[{inner}]", "·") if inner else mark

    def value(w: Column) -> Column:
        letter = F.substring(w, 2, 1)
        slot = F.when(letter.isin("n", "u"), letter)
        slot = slot.when(letter.isin(*names), "p") if names else slot
        return F.when(w.startswith("⟨"), F.concat(slot, F.substring(w, 3, 1 << 30)))

    return F.transform(template_words(whole), value) if kind != "valued" else F.array().cast("array<string>")


def windows(rows: DataFrame, ids: list[str], forms: list[tuple[str, int]], label=None) -> DataFrame:
    """(ids, at, window) for rows of (ids, an array of hashes per kind).

    A window is the hash of a run of ``size`` places of ``kind``, one for every pair of ``forms``
    and every place where the run fits. With ``label``, the columns it gives for (kind, size)
    come too, and windows for which it gives null are left out.
    """
    last = F.greatest(F.lit(-1), *[F.size(kind) - size for kind, size in forms])
    # outer, and no filter: what is asked of a generator's input is pushed down to where texts are read, and splits them once more
    at = rows.withColumn("_last", last).withColumn("at", F.explode_outer(F.when(F.col("_last") >= 0, F.sequence(F.lit(0), F.col("_last")))))
    runs = []
    for kind, size in forms:
        run = F.xxhash64(F.lit(kind), F.lit(size), *[F.get(kind, F.col("at") + i) for i in range(size)]).alias("window")
        holds, more = label(kind, size) if label else (F.lit(True), [])
        runs.append(F.when((F.col("at") + size <= F.size(kind)) & holds, F.struct(run, *more)))
    # no lambda here: between generators that are not compiled, every place would hold its whole text
    return at.select(*ids, "at", F.explode_outer(F.array(*runs)).alias("_run")).filter("_run IS NOT NULL").select(*ids, "at", "_run.*")


def _lettered(keys_of: Column, at: Column, size: Column) -> Column:
    """How many words of a run are no placeholder."""
    types = F.array(*[F.xxhash64(F.lit(f"⟨{t}")) for t in "nup"])
    return F.size(F.filter(F.slice(keys_of, at + 1, size), lambda k: ~F.array_contains(types, k)))


def contaminated(docs: DataFrame, benchmark: DataFrame, share: float = 0.5, size: int = WINDOW) -> DataFrame:
    """Documents that hold benchmark items: doc_id, item_id, n_windows, item_windows, reworded.

    One row per document and item. An item is held if, in one of its templates, at least ``share``
    of its windows occur on one diagonal, or on diagonals less than the item's length apart as
    many words are covered as that share covers in one run, and all its slots are filled
    consistently. The figures are those of the template that is covered best; reworded tells that
    some value differs there. A copy whose names are filled inconsistently is not held for the
    lesser part that other templates see.

    Items of four words up to ``size`` are one window of their own length. Windows with fewer than
    half their words literal do not count; an item that has no others is looked up by its values
    instead, so that only copies with the same numbers and names are found. Items of fewer than four
    words, and null texts, are left out. Repeated rows of one document or item count once; rows
    without an id are left out; texts of one repeated id are looked at one by one. Other columns
    are not looked at.
    """
    doc, match = ["doc_id", "digest"], ["doc_id", "digest", "item_id", "kind"]
    items = benchmark.filter("item_id IS NOT NULL AND text IS NOT NULL").select("item_id", marked(F.col("text")).alias("mark")).distinct()
    items = stored(items.withColumn("words", template_words(F.col("mark"))).filter(F.size("words") >= LEAST), "items")
    listed = stored(_listed(items, size), "windows")
    totals = listed.groupBy("item_id", "kind").agg(F.countDistinct("item_at").alias("item_windows"))
    n = listed.count()
    forms = sorted((r["kind"], r["size"]) for r in listed.select("kind", "size").distinct().collect()) or [("typed", size)]
    wanted = listed.select("window").distinct()
    wanted = F.broadcast(wanted) if n <= BROADCAST_WINDOWS else wanted
    texts = docs.filter("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.xxhash64("text").alias("digest"), "text")
    words = texts.select(*doc, template_words(marked(F.col("text"))).alias("words"))
    spread = windows(words.select(*doc, *[keys(F.col("words"), kind).alias(kind) for kind in sorted({kind for kind, _ in forms})]), doc, forms)
    # first which windows occur at all, then which items they belong to: few rows are left by then
    hits = stored(spread.join(wanted, "window", "left_semi").distinct(), "hits")
    matched = stored(hits.join(listed, "window").select(*match, "size", "span", "item_at", "at"), "matched")
    # no diagonal can have more windows of an item than the whole document: most chance matches end here
    enough = F.col("size") - 1 + F.lit(share) * F.col("item_windows")
    possible = matched.groupBy(*match, "size").agg(F.countDistinct("item_at").alias("_n")).join(totals, ["item_id", "kind"])
    possible = possible.filter(F.col("_n") * F.col("size") >= enough).select(*match, "size")
    matched = stored(matched.join(possible, [*match, "size"]), "possible")
    # a diagonal by itself, and in both bands of two spans that hold it
    shift = F.col("at") - F.col("item_at")
    band = F.floor(shift / F.col("span")).cast("int")
    groups = F.array(*[F.struct(w.alias("width"), b.alias("band")) for w, b in ((F.lit(0), shift), (F.col("span"), band), (F.col("span"), band - 1))])
    spots = matched.select(*match, "size", "item_at", "at", F.explode(groups).alias("_g")).select(*match, "size", "item_at", "at", "_g.*")
    group = [*match, "size", "width", "band"]
    # the places of an item that one group has, as many as the item has windows: a window covers its words up to the next one's
    held = spots.groupBy(*group).agg(F.array_sort(F.collect_set("item_at")).alias("_ats")).join(totals, ["item_id", "kind"])
    covers = F.expr("size + aggregate(sequence(1, greatest(size(_ats) - 1, 1)), 0, (sum, i) -> sum + IF(i < size(_ats), least(size, _ats[i] - _ats[i - 1]), 0))")
    held = held.select(*group, "item_windows", F.size("_ats").alias("n_windows"), covers.alias("covered"))
    held = held.filter((F.col("n_windows") * F.col("size") >= enough) & (F.col("covered") >= enough))
    held = stored(held.withColumn("share", F.col("n_windows") / F.col("item_windows")), "held")
    places = spots.join(held.select(*group), group).withColumn("i", F.explode(F.expr("sequence(0, size - 1)")))
    places = places.select(*group, (F.col("item_at") + F.col("i")).alias("ours"), (F.col("at") + F.col("i")).alias("theirs")).distinct()
    judged = _judged(texts, items, held, places, group)
    broken = judged.filter("NOT consistent AND kind = 'typed' AND width = 0").groupBy(*doc, "item_id").agg(F.max("share").alias("_broken"))
    kept = judged.filter("consistent").join(broken, [*doc, "item_id"], "left").filter("kind = 'typed' OR _broken IS NULL OR share >= _broken")
    best = F.max(F.struct("share", (~F.col("reworded")).alias("same"), "n_windows", "item_windows")).alias("_b")
    return kept.groupBy("doc_id", "item_id").agg(best).select(
        "doc_id", "item_id", "_b.n_windows", "_b.item_windows", (~F.col("_b.same")).alias("reworded")
    )


def _listed(items: DataFrame, size: int) -> DataFrame:
    """Windows of the items that count: item_id, item_at, window, kind, size, and the item's span.

    Diagonals of one copy are fewer places apart than twice the span, two copies side by side more.
    """
    found = items.select("item_id", *[keys(F.col("words"), kind).alias(kind) for kind in KINDS])

    def literal(kind: str) -> Column:
        own = F.least(F.lit(size), F.size(kind))
        return F.transform(F.sequence(F.lit(0), F.size(kind) - own), lambda at: _lettered(F.col(kind), at, own) * 2 >= own)

    found = found.withColumns({f"_{kind}": literal(kind) for kind in KINDS if kind != "valued"})
    found = found.withColumn("_valued", ~F.array_contains("_folded", True))

    def label(kind: str, n: int) -> tuple[Column, list[Column]]:
        counts = F.col("_valued") if kind == "valued" else F.get(f"_{kind}", F.col("at"))
        span = F.greatest(F.lit(1), F.floor(F.size(kind) / 2)).cast("int")
        return (F.least(F.lit(size), F.size(kind)) == n) & counts, [F.lit(kind).alias("kind"), F.lit(n).alias("size"), span.alias("span")]

    listed = windows(found, ["item_id"], [(kind, n) for kind in KINDS for n in range(LEAST, size + 1)], label)
    return listed.withColumnRenamed("at", "item_at").distinct()


def _judged(texts: DataFrame, items: DataFrame, held: DataFrame, places: DataFrame, group: list[str]) -> DataFrame:
    """The groups in ``held``, and whether each item value stands for one value, and whether one differs."""

    def slots(mark: Column, *ids: str):
        kinds = F.array(*[F.struct(F.lit(kind).alias("kind"), _values(mark, kind).alias("values")) for kind in KINDS])
        return [*ids, F.explode(kinds).alias("_k")]

    ours = items.select(*slots(F.col("mark"), "item_id")).select("item_id", "_k.kind", F.posexplode("_k.values").alias("ours", "value"))
    doc = ["doc_id", "digest"]
    named = stored(held.select(*doc).distinct(), "named")
    # few enough of them come to the texts; otherwise both move
    named = F.broadcast(named) if named.count() <= BROADCAST_NAMES else named
    copies = texts.join(named, doc).groupBy(*doc).agg(F.first("text").alias("text"))
    marks = stored(copies.select(*doc, marked(F.col("text")).alias("mark")), "marks")
    theirs = marks.select(*slots(F.col("mark"), *doc)).select(*doc, "_k.kind", F.posexplode("_k.values").alias("theirs", "copy"))
    filled = places.join(ours.filter("value IS NOT NULL"), ["item_id", "kind", "ours"])
    filled = filled.join(theirs.filter("copy IS NOT NULL"), [*doc, "kind", "theirs"])
    pairs = filled.groupBy(*group, "value").agg(F.countDistinct("copy").alias("copies"), F.max(F.col("copy") != F.col("value")).alias("differs"))
    verdict = pairs.groupBy(*group).agg((F.max("copies") == 1).alias("consistent"), F.max("differs").alias("reworded"))
    judged = held.join(verdict, group, "left")
    return judged.withColumn("consistent", F.coalesce("consistent", F.lit(True))).withColumn("reworded", F.coalesce("reworded", F.lit(False)))


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no benchmark item; rows without an id or a text stay."""
    return docs.join(contaminated(docs, benchmark).select("doc_id").distinct(), "doc_id", "left_anti").select(*[f"`{c}`" for c in docs.columns])
