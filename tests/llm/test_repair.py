"""Conversation repair against a breadth of all edit sequences by dynamic programming."""

import hashlib
import random
import zlib

import pytest

from paytide.llm import repair

SCHEMA = "conv_id LONG, turn LONG, role STRING, text STRING"
BLANKS = " \t\n\x0b\x0c\r"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        show = lambda v: " " if v is None else str(v)
        kind = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        if kind == 1:
            text = ""
        if kind == 2:
            text = "".join(c for c in text if c not in ".!?")
        if kind == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
    return out


def faults(rows):
    seen, out = set(), []
    for _, _, role, text in rows:
        end = text.rstrip(BLANKS)[-1:]
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows, found):
    """(cost, audit) by all states from the end, least cost first, then least audit."""
    n = len(rows)
    step = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
    turn = {"": "u", "s": "u", "u": "a", "a": "u"}
    best = {"": (0, ""), "a": (0, ""), "u": (3, "I"), "s": (6, "II")}
    for i in range(n - 1, -1, -1):
        initial, now = rows[i][2][:1], {}
        for q in step:
            options = [(4 + best[q][0], "D" + best[q][1])]
            if found[i] not in ("blank", "duplicate"):
                extra = 3 * (found[i] == "truncated")
                if initial in step[q]:
                    c, a = best[step[q][initial]]
                    options.append((c + extra, "K" + a))
                c, a = best[turn[q]]
                options.append((c + 3 + extra, "R" + a))
            now[q] = options
        for _ in range(3):  # insertions before the row
            for q in step:
                c, a = min(now[turn[q]])
                if (c + 3, "I" + a) not in now[q]:
                    now[q].append((c + 3, "I" + a))
        best = {q: min(now[q]) for q in step}
    return best[""]


def replay(rows, audit):
    """The repaired rows that an audit stands for."""
    out, q, i = [], "", 0
    for letter in audit:
        other = "user" if q != "u" else "assistant"
        if letter == "D":
            i += 1
            continue
        role, text = (other, "") if letter == "I" else (rows[i][2] if letter == "K" else other, rows[i][3])
        i += letter != "I"
        out.append(f"{role}:{text}")
        q = role[:1]
    assert i == len(rows) and q in ("", "a")
    return out


def expected(rows):
    out = {}
    for conv in dict.fromkeys(r[0] for r in rows):
        mine = damaged([r for r in rows if r[0] == conv])
        digest = lambda r: hashlib.sha256(f"{len(r[2])}:{r[2]}:{r[3]}".encode()).digest()
        mine.sort(key=lambda r: (r[1] is not None, r[1] or 0, digest(r)))
        found = faults(mine)
        turns = {r[1] for r in mine} - {None}
        pairs = [a[2][:1] + b[2][:1] for a, b in zip(mine, mine[1:], strict=False)]
        cost, audit = cheapest(mine, found)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(turns) if turns else 0,
            *[found.count(k) for k in ("blank", "duplicate", "truncated")],
            sum(p not in ("su", "ua", "au") for p in pairs),
            cost,
            audit,
            hashlib.sha256("\n".join(replay(mine, audit)).encode()).hexdigest(),
        )
    return out


def conversations(seed, n=400):
    r = random.Random(seed)
    rows = []
    for c in [*range(n), None]:
        for t in range(r.randrange(1, 14)):
            role = r.choice(["user", "assistant", "system", "user", "assistant", "tool", "", None])
            text = r.choice([f"words {r.randrange(99)}.", "no end", " \n ", "", "same!", "same!", None, "tail? ", "ü　."])
            rows.append((c, r.choice([t, t, t, 2 * t, None]), role, text))
    return rows


@pytest.mark.parametrize("bits", [10, 1])
def test_repairs_are_those_of_all_sequences(spark, monkeypatch, bits):
    monkeypatch.setattr(repair, "PART_BITS", bits)
    rows = conversations(bits)
    # rows equal in conversation and turn are damaged alike, so any of them may be repeated
    got = repair.audit_conversations(spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS place", "2 AS conv", "3 AS digest")).collect()
    want = expected(rows)
    assert len(got) == len(want)
    for row in got:
        assert tuple(row)[1:] == want[row.conv_id], row.conv_id


def test_searches_of_parts_are_those_of_the_whole(monkeypatch):
    r = random.Random(5)
    for _ in range(300):
        codes = "".join(r.choice("abcdefghijkl") for _ in range(r.randrange(1, 18)))
        whole, _ = repair.search(codes, 0, None)
        cuts = sorted(r.sample(range(1, len(codes)), min(len(codes) - 1, 3)))
        parts = [codes[a:b] for a, b in zip([0, *cuts], [*cuts, len(codes)], strict=True)]
        goals, goal = [], None
        for part in reversed(parts):
            goals.append(goal)
            costs, ahead = repair.matrix(part), goal or repair.AT_END
            goal = [min(costs[4 * q + to] + ahead[to] for to in range(4)) for q in range(4)]
        q, audit = 0, ""
        for part, goal in zip(parts, reversed(goals), strict=True):
            letters, q = repair.search(part, q, goal)
            audit += letters
        assert audit == whole
        monkeypatch.setattr(repair, "RUN", r.choice([1, 3, 7]))
        assert repair.solved(codes, 0, None)[0] == whole


def test_one_long_conversation_is_cut(spark):
    r = random.Random(6)
    rows = [(7, t, r.choice(["user", "assistant", "user", "tool"]), r.choice(["a.", "b", "c?", ""]) + str(t) * (t % 3) + r.choice([".", ""])) for t in range(3000)]
    rows += [(8, 1, "user", "hi.")] * 900
    [a, b] = sorted(repair.audit_conversations(spark.createDataFrame(rows, SCHEMA)).collect())
    want = expected(rows)
    assert tuple(a)[1:] == want[7] and tuple(b)[1:] == want[8]


def test_conversations_without_rows(spark):
    dropped = next(c for c in range(1000) if zlib.crc32(f"{c}:1".encode()) % 20 == 0)
    frame = spark.createDataFrame([(dropped, 1, "user", "hi."), (dropped, 1, "user", "hi.")], SCHEMA)
    [row] = repair.audit_conversations(frame).collect()
    assert tuple(row) == (dropped, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())
    assert repair.audit_conversations(frame.limit(0)).count() == 0
    long = spark.createDataFrame([(1, 2, "user", "word " * 300000 + "."), (1, 3, "assistant", "\n" * 100000)], SCHEMA)
    edits = sorted((e.place, e.step, e.edit, e.fault) for e in repair.repair(long).collect())
    assert [e[2:] for e in edits] == [("K", ""), ("D", "blank"), ("I", None)]
