"""Sharding, mixing, chat pairs, decontamination, toxicity, top-k: against plain Python."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import brute
from paytide.llm import chat, decontam, mixing, sharding, topk, toxicity
from paytide.llm.common import key_number, n_words

DOC = "doc_id LONG, text STRING"


def place(number, n, seed=0):
    """The permutation, written as a loop."""
    a, b = sharding.sides(n)
    while True:
        left, right = divmod(number, b)
        for i in range(sharding.ROUNDS):
            half = right if i % 2 == 0 else left
            value = int(hashlib.md5(f"{key_number(seed, i)}:{half}".encode()).hexdigest()[:8], 16)
            if i % 2 == 0:
                left = (left + value) % a
            else:
                right = (right + value) % b
        number = left * b + right
        if number < n:
            return number


@pytest.mark.parametrize("n", [1, 2, 3, 5, 7, 50, 333, 1000])
def test_places_are_a_permutation(spark, n):
    got = sharding.permuted(spark.range(n), "id", n, 0, "place").collect()
    assert sorted(r.place for r in got) == list(range(n))
    assert all(r.place == place(r.id, n) for r in got)


def test_shards_are_even_and_slots_have_no_gaps(spark):
    rows = [(i % 40 if i % 3 else None, None if i % 7 == 0 else f"text {i % 11}") for i in range(211)]
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "'x' AS shard", "1 AS _row")
    got = sharding.shard_documents(docs).collect()
    again = sharding.shard_documents(docs.repartition(5)).collect()
    assert sorted(map(str, got)) == sorted(map(str, again))
    shards = {s: sorted(r.slot for r in got if r.shard == s) for s in range(16)}
    assert all(v == list(range(len(v))) for v in shards.values())
    assert sum(map(len, shards.values())) == 211 and {len(v) for v in shards.values()} == {13, 14}
    assert all(r.law == "rows" and r.grown_shard is None for r in got)
    assert {r.size for r in got} <= {1, 7, 8} and all(r.text_crc32 == 0 for r in got if r.size == 1)
    assert sharding.shard_documents(spark.createDataFrame([], DOC)).count() == 0


def test_word_counts(spark):
    rows = [(None,), ("",), (" \n ",), ("a",), (" a\x0bb\x1fc  d e\n",)]
    got = spark.createDataFrame(rows, "t STRING").select(n_words(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [len(brute.words(t)) for (t,) in rows]


def test_mix_meets_its_targets(spark):
    r = random.Random(1)
    rows = []
    for s, n in [("a", 40), ("b", 300), ("c", 5), ("d", 1), (None, 60), ("e", 900)]:
        rows += [(len(rows) + i, " ".join(["w"] * r.randrange(120)), s) for i in range(n)]
    rows += [(0, None, "f"), (0, None, "f"), (1, "big " * 30000, "e")]
    docs = spark.createDataFrame(rows, DOC + ", source STRING").selectExpr("*", "1 AS taken", "2 AS _part")
    got = mixing.mix_documents(docs).collect()
    again = mixing.mix_documents(docs.repartition(3)).collect()
    key = lambda x: (x.doc_id, x.size, x.source_size)
    assert sorted(map(str, sorted(got, key=key))) == sorted(map(str, sorted(again, key=key))) and len(got) == len(rows)
    names = ["a", "b", "c", "d", "e", "f", None]
    sizes = [sum(len(brute.words(t)) for _, t, s in rows if s == name) for name in names]
    goals = brute.water_level(sizes, [(5, 2, 1)[i % 3] for i in range(len(names))])
    by_size = {}
    for x in got:
        assert 0 <= x.taken <= 3 * x["size"]
        by_size.setdefault(x.source_size, []).append(x)
    for size, goal in zip(sizes, goals, strict=True):
        if not size:
            continue
        assert {round(x.target, 6) for x in by_size[size]} == {round(goal, 6)}
        assert abs(sum(x.taken for x in by_size[size]) - goal) <= 48
    assert mixing.mix_documents(spark.createDataFrame([], DOC + ", source STRING")).count() == 0


@pytest.mark.parametrize("words", [1, 10, 33, 40, 64, 95])
def test_small_sources_at_their_cap_are_taken_whole(spark, words):
    rows = [(1, " ".join(["w"] * words), "a"), (2, "w " * 5000, "b"), (3, "w " * 300, "c")]
    got = {x.doc_id: x for x in mixing.mix_documents(spark.createDataFrame(rows, DOC + ", source STRING")).collect()}
    assert got[1].target == 3 * words == got[1].taken
    assert all(abs(got[i].taken - got[i].target) <= 32 for i in (2, 3))


def test_seats_are_those_of_the_highest_quotients(spark):
    for goals in ([530.0, 210.5, 101.0, 7.0, 0.0], [10.0] * 12, [1000.0, 1.0, 1.0, 1.0, 1.0], [3.0]):
        rows = [(f"s{i:02}", i, g) for i, g in enumerate(goals)]
        frame = spark.createDataFrame(rows, "source STRING, _rank LONG, target DOUBLE")
        got = {r._rank: r.seats for r in mixing.seats(frame, 10).collect()}
        want = brute.sainte_lague(goals, int(sum(goals) / 10 + 0.5))
        assert [got[i] for i in range(len(goals))] == want


def test_preference_pairs(spark):
    def turns(conv, *said):
        return [(conv, i, role, text) for i, (role, text) in enumerate(said)]

    rows = turns(0, ("user", "hi"), ("assistant", "yes?"), ("user", "two"), ("assistant", "good"))
    rows += turns(1, ("user", "hi"), ("assistant", "yes?"), ("user", "two"), ("assistant", "bad"), ("user", None))
    rows += turns(2, ("user", "alone")) + turns(4, (None, None), ("assistant", "x")) + turns(5, (None, None), ("assistant", "x"))
    rows += [(7, None, "assistant", "b"), (7, None, "assistant", "a"), (None, 0, "user", "lost")]
    frame = spark.createDataFrame(rows, "conv_id LONG, turn LONG, role STRING, text STRING").selectExpr("*", "0 AS i", "1 AS pair_id")
    got = {r.pair_id: r for r in chat.preferences(frame, chat.neighbouring_pairs(frame)).collect()}
    say = lambda role, text: f"<|{role}|>\n{text}<|end|>\n"
    first = got[0]
    assert first.prefix_turns == 3 and first.prompt == say("user", "hi") + say("assistant", "yes?") + say("user", "two")
    assert first.chosen_completion == say("assistant", "good")
    assert first.rejected_completion == say("assistant", "bad") + say("user", "")
    at, to = map(int, first.rejected_mask.split("-"))
    assert first.rejected_completion[at:to] == "bad<|end|>\n"
    assert (got[1].chosen, got[1].rejected, got[1].prompt, got[1].rejected_completion) == (2, None, "", None)
    assert got[1].chosen_mask == "" and got[2].prefix_turns == 2 and got[2].chosen_completion == ""
    assert got[3].chosen is None and got[3].rejected_completion == say("assistant", "a") + say("assistant", "b")
    empty = spark.createDataFrame([], frame.schema)
    assert chat.preferences(empty, chat.neighbouring_pairs(empty)).count() == 0


QUESTION = "In June, Alice Smith paid 3.5 kg of rice to Bob for 20 days and then 3.5 kg again today at home."


def test_reworded_questions_are_found(spark):
    docs = [
        (1, "Before it. " + QUESTION + " After it."),
        (2, "In June, Carol Jones paid 7 kg of rice to Dan for 31 days and then 7 kg again today at home."),
        (3, "In June, Carol Jones paid 7 kg of rice to Dan for 31 days and then 9 kg again today at home."),
        (4, "other words stand here and there is nothing of the kind in this text at all"),
        (5, QUESTION.upper()), (5, QUESTION), (6, None), (7, ""), (8, "1 2 3 4 5 6 7 8 9"), (None, QUESTION),
        (9, "word " * 30000 + QUESTION),
    ]
    items = [(1, QUESTION), (1, QUESTION), (2, None), (3, "too short"), (4, "9 8 7 6 5 4 3 2 1"), (None, QUESTION)]
    frame = spark.createDataFrame(docs, DOC).selectExpr("*", "1 AS at", "2 AS window")
    bench = spark.createDataFrame(items, "item_id LONG, text STRING").selectExpr("*", "1 AS words")
    got = sorted((r.doc_id, r.item_id, r.reworded) for r in decontam.contaminated(frame, bench).collect())
    assert got == [(1, 1, False), (2, 1, True), (5, 1, False), (9, 1, False)]
    kept = decontam.clean_documents(frame, bench)
    assert kept.columns == frame.columns and sorted(r.doc_id or 0 for r in kept.collect()) == [0, 3, 4, 6, 7, 8]
    assert decontam.contaminated(frame.limit(0), bench).count() == 0
    assert decontam.contaminated(frame, bench.limit(0)).count() == 0


def found(spark, docs, items):
    frame, bench = spark.createDataFrame(docs, DOC), spark.createDataFrame(items, "item_id LONG, text STRING")
    return sorted((r.doc_id, r.item_id, r.reworded) for r in decontam.contaminated(frame, bench).collect())


def test_short_items_and_tables_are_found_in_longer_documents(spark):
    items = [
        (4, "name our largest moon"), (5, "Add 17 to both sides"), (7, "which red planet has two small moons"),
        (9, "12 31 7 44 90 11 5 63 8 2"), (10, "3 8 5 13"), (8, "why does ice float on water in winter"),
    ]
    docs = [(i, f"some words stand before it. {text} and other words stand after it here") for i, text in items]
    docs += [(105, "first add 23 to both sides of it"), (109, "12 31 7 44 91 12 5 64 8 2 and so on it goes here"), (110, "3 8 5 14 x y z w")]
    docs += [(104, "Name our largest moon"), (100, "name our largest river and some other moon")]
    want = [(i, i, False) for i, _ in items] + [(104, 4, False), (105, 5, True)]
    assert found(spark, docs, items) == sorted(want)


def test_edited_copies_are_found(spark):
    long = "In June, Alice Smith paid for rice. Bert buys four more pens at the shop. Then he went home with all of the things that she had left for him there."
    paris = "the train from Paris to the sea takes about four hours and costs more than we had ever thought before"
    inserted = "one plain question of twenty words that asks how many old ships were seen near the big harbour that day"
    items = [(1, long), (2, paris), (3, inserted), (4, QUESTION)]
    docs = [
        (1, long.replace("Bert", "Dora").replace("Alice Smith", "Mary Ann Jones")),
        (2, paris.replace("Paris", "New York")),
        (3, inserted.replace("asks how", "asks us how")),
        (4, QUESTION.upper()), (5, QUESTION.lower()), (6, long.upper()),
        (7, inserted[:50] + " but nothing else of it comes after this place in the text"),
        (8, "In June, Carol paid 7 kg of rice to Dan for 31 days and then 9 kg again today at home."),
    ]
    assert found(spark, docs, items) == [
        (1, 1, True), (2, 2, True), (3, 3, False), (4, 4, False), (5, 4, False), (6, 1, False)
    ]
    # texts of one id are looked at one by one
    twice = [(1, QUESTION.replace("3.5", "4")), (1, QUESTION.replace("3.5", "6"))]
    assert found(spark, twice, items) == [(1, 4, True)]


def rude_rows(n=400, seed=2):
    r = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        text = " ".join(f"w{r.randrange(300)}" for _ in range(40))
        bad, junk = i % 7 == 0, i % 4 == 0
        text = text + (" you fool" if bad else "") + (" ### $$$" if junk else "")
        docs.append((i, text))
        labels.append((i, int(not junk), int(bad)))
    return docs, labels


LABELS = "doc_id LONG, quality INT, toxic INT"


def test_toxic_rows_are_told_apart(spark):
    docs, labels = rude_rows()
    frame = spark.createDataFrame(docs, DOC)
    chain = toxicity.train_documents(frame, spark.createDataFrame([x for x in labels if x[0] % 3], LABELS))
    assert [link.name for link in chain] == toxicity.CATEGORIES and [len(link.chain) for link in chain] == [0, 1]
    got = {r.doc_id: r for r in toxicity.predict(frame.selectExpr("*", "1 AS toxic", "'x' AS p_toxic"), chain).collect()}
    held = [x for x in labels if x[0] % 3 == 0]
    assert all(got[i].toxic == bool(bad) for i, _, bad in held)
    assert all((got[i].p_low_quality > 0.5) == (good == 0) for i, good, _ in held)


def test_decisions_do_not_turn_with_the_number_of_labels(spark):
    r = random.Random(5)
    docs, labels = [], []
    for i in range(1500):
        kind = i % 50
        said = " you fool" if kind < 3 else " perhaps so" if kind < 8 else ""
        docs.append((i, " ".join(f"w{r.randrange(300)}" for _ in range(20)) + said))
        labels.append((i, 1, int(kind < 5)))  # two of five that say perhaps
    frame = spark.createDataFrame(docs, DOC)
    asked = spark.createDataFrame([(1, "w1 w2 w3 perhaps so"), (2, "w1 w2 w3 you fool"), (3, "w1 w2 w3")], DOC)
    for n in (500, 1500):  # with 200 rows to draw, the larger has three times the labels for each
        marks = spark.createDataFrame(labels[:n], LABELS)
        got = toxicity.predict(asked, toxicity.train_documents(frame, marks, most_rows=200)).collect()
        assert {x.doc_id: x.toxic for x in got} == {1: False, 2: True, 3: False}


def test_draw_takes_the_lowest_hashes_of_each_kind(spark):
    marks = spark.range(3000).selectExpr("id AS doc_id", "cast(id % 3 = 0 AS int) AS low_quality", "cast(id % 10 = 0 AS int) AS toxic")
    hashed = marks.selectExpr("*", "xxhash64(doc_id) AS h", "greatest(low_quality, toxic) AS y").collect()
    for most in (2, 100, 2500, 10_000):
        want = {r.doc_id for y in (0, 1) for r in sorted((r for r in hashed if r.y == y), key=lambda r: r.h)[: most // 2]}
        got = toxicity.drawn(marks, toxicity.CATEGORIES, most).collect()
        assert {r.doc_id for r in got} == want and len(got) == len(want)
        positive = sum(r.weight for r in got if r.low_quality or r.toxic) / sum(r.weight for r in got)
        assert abs(positive - sum(r.y for r in hashed) / 3000) < 1e-3


def test_toxicity_of_odd_tables(spark):
    docs, labels = rude_rows(80)
    frame = spark.createDataFrame([*docs, (500, None), (501, ""), (502, "fool " * 40000), (3, docs[3][1])], DOC)
    marks = spark.createDataFrame([*labels, (500, None, 1), (None, 1, 1), (999, 0, 1), (501, 1, None)], LABELS)
    got = toxicity.rate_documents(frame, marks).collect()
    assert len(got) == 84 and not any(r.toxic for r in got if r.doc_id in (500, 501))
    for table in (marks.limit(0), marks.filter("toxic = 0")):
        assert not any(r.toxic for r in toxicity.rate_documents(frame, table).collect())
    assert toxicity.rate_documents(frame.limit(0), marks).count() == 0


def test_features_are_words_and_parts():
    import pyarrow as pa

    (_, a), (_, b), (_, c), (_, d) = toxicity.features(pa.array(["abcd abcde", "abcde  ABCD", None, "ab\ncd"]))
    assert a.tolist() == b.tolist() and len(a) == 4 and len(c) == 0 and len(d) == 2


def best(rows, k=10):

    use = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = set()
    for q, a in use:
        if q % 100 == 0:
            s = sorted((-sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in use if i != q and len(b) == len(a))
            out |= {(q, n + 1, i, -x) for n, (x, i) in enumerate(s[:k])}
    return out


@pytest.mark.parametrize("n, dim, rows_per_block", [(700, 8, 64), (300, 3, 4096), (5, 2, 2)])
def test_top_k_is_exact(spark, monkeypatch, n, dim, rows_per_block):
    monkeypatch.setattr(topk, "ROWS", rows_per_block)
    monkeypatch.setattr(topk, "QUERIES", 4)
    r = np.random.default_rng(n)
    rows = [(i, [float(np.float32(x)) for x in r.normal(size=dim).round(1)]) for i in range(n)]
    rows += [(9001, None), (None, [0.5] * dim), (9002, [float("nan")] * dim), (9003, [None] * dim), (9004, [float("inf")] * dim), (9100, [1.0] * (dim + 1)), (9200, [0.0] * dim)]
    rows += [rows[1], rows[1]]
    frame = spark.createDataFrame(rows, "vec_id LONG, embedding ARRAY<FLOAT>").selectExpr("*", "1 AS row", "2 AS dim")
    got = topk.top_k(frame, "vec_id % 100 = 0").collect()
    want = best(rows)
    assert len(got) == len(want) and {tuple(x) for x in got} == want
    assert topk.top_k(frame.limit(0), "vec_id % 100 = 0").count() == 0


@pytest.mark.parametrize("kind", ["FLOAT", "DOUBLE"])
def test_large_components_are_kept(spark, monkeypatch, kind):
    monkeypatch.setattr(topk, "ROWS", 16)
    monkeypatch.setattr(topk, "QUERIES", 2)
    monkeypatch.setattr(topk, "TOGETHER", 1)
    r = np.random.default_rng(5)
    cast = np.float32 if kind == "FLOAT" else np.float64
    rows = [(i, [float(cast(x * s)) for x in r.normal(size=4)]) for i, s in enumerate([1, 1e5, 1e5, 1e8, 1e12, 1e17, 1e30] * 12)]
    rows += [(100, [30000.0, 0.5, 0.0, 0.0]), (200, [1e5] * 4), (300, [float(cast(1e12)), -1.0, 2.0, 3.0]), (300, [float(cast(1e12)), -1.0, 2.0, 3.0])]
    frame = spark.createDataFrame(rows, f"vec_id LONG, embedding ARRAY<{kind}>")
    got = sorted(map(tuple, topk.top_k(frame, "vec_id % 100 = 0").collect()))
    whole = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows]
    want = []
    for q, a in {q: a for q, a in whole if q % 100 == 0}.items():
        scored = sorted(((sum(x * y for x, y in zip(a, b, strict=True)), i) for i, b in whole if i != q), key=lambda s: (-s[0], s[1]))
        want += [(q, rank + 1, i, min(max(s, -(2**63)), 2**63 - 1)) for rank, (s, i) in enumerate(scored[:10])]
    assert got == sorted(want)
