"""Spelling variants against all pairs of words."""

import collections
import random
import re
import zlib

import numpy as np

from paytide.llm import spelling

DOC = "doc_id LONG, text STRING"


def counted(rows):
    words = collections.Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 97 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            words[run] += 1
    return {w: n for w, n in words.items() if len(w) >= 5 and n >= 3}


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def expected(rows):
    n = counted(rows)
    near = {w: [v for v in n if one_edit(w, v)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= 2 * n[w] else None
    out = {}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, n[w], len(near[w]), n[form[w]] if form[w] else None)
    return out


def documents(seed, n=400):
    r = random.Random(seed)
    stems = ["".join(r.choice("abcdeéÀz") for _ in range(r.randrange(4, 9))) for _ in range(40)] + ["aaaaaa", "aaaaaaa", "×÷×÷×", "Straße"]
    rows = []
    for i in range(n):
        words = []
        for _ in range(r.randrange(40)):
            w = stems[min(r.randrange(44), r.randrange(44))]
            for _ in range(r.choice([0, 0, 0, 1, 1, 2])):
                at = r.randrange(len(w))
                w = r.choice([w[:at] + w[at + 1 :], w[:at] + r.choice("abé") + w[at:], w[:at] + r.choice("abÿ") + w[at + 1 :]]) or "b"
            words.append(r.choice([w, w.upper() if w.isascii() else w, w.capitalize()]))
        rows.append((r.choice([i, i, None]), r.choice([" ", "1", ", "]).join(words)))
    return rows + [(1, None), (2, ""), (3, " 12 ")]


def got(spark, rows):
    docs = spark.createDataFrame(rows, DOC).selectExpr("*", "'x' AS word", "1 AS n", "2 AS id")
    return {r.word: tuple(r)[1:] for r in spelling.variants(docs).collect()}


def test_forms_are_those_of_all_pairs(spark):
    rows = documents(1)
    want = expected(rows)
    assert got(spark, rows) == want
    assert sum(f is not None for f, *_ in want.values()) > 30 and any(f not in (None, r) for f, r, *_ in want.values())


def test_full_filters_only_cost_time(spark, monkeypatch):
    monkeypatch.setattr(spelling, "MOST_BLOCKS", 1)
    monkeypatch.setattr(spelling, "PROBED", 50)
    monkeypatch.setattr(spelling, "LONG", 6)
    rows = documents(2, 150)
    assert got(spark, rows) == expected(rows)


def test_long_words_and_chains(spark):
    long = "ab" * 700
    texts = [long] * 3 + [long + "c"] * 7 + ["x" + long + "c"] * 20
    chain = [("wwww" + "abcdef"[: i + 1]) for i in range(6)]
    texts += [w for i, w in enumerate(chain) for _ in range(4 * 3**i)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(None, long)] * 2
    want = expected(rows)
    assert got(spark, rows) == want and want[chain[0]][1] == chain[-1]


def test_no_words(spark):
    assert got(spark, [(1, "a bc"), (2, None)]) == {}
    assert spelling.variants(spark.createDataFrame([], DOC)).count() == 0


def test_filters_hold_what_they_were_given():
    words = [f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(600)]
    sizes = spelling.filter_sizes({6: 600})
    held = spelling.Filters(sizes, np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
    for length, _, letters in spelling._by_length(words):
        keys = spelling._keys((spelling._CODES[letters] * spelling.powers(spelling._BASE, length)).sum(axis=1, dtype=np.uint64), length)
        block, mask = spelling._blocks_and_masks(keys, sizes[6])
        np.bitwise_or.at(held.bits, block, mask)
        assert held.hold(keys, length).all() and held.hold(keys + np.uint64(1), length).mean() < 0.2
    many = spelling.filter_sizes({s: 10**9 for s in range(5, 60)})
    assert sum(many.values()) <= spelling.MOST_BLOCKS
