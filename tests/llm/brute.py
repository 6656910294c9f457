"""Plain Python versions of the operators, for small inputs."""

from __future__ import annotations

import collections
import hashlib
import math
import re
import zlib


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else {tuple(w)} - {()}


def groups(rows, percent=80):
    """rows of (id, text) -> id: (set size, smallest id reached)."""
    sets = [(i, shingles(t)) for i, t in rows]
    least = list(range(len(sets)))

    def find(x):
        while least[x] != x:
            x = least[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            s, t = sets[a][1], sets[b][1]
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                least[find(a)] = find(b)
    ids = collections.defaultdict(list)
    for a, (i, _) in enumerate(sets):
        ids[find(a)].append(i)
    return sorted((i, len(s), min(ids[find(a)])) for a, (i, s) in enumerate(sets))


class SuffixTree:
    """The model of the language-model scorer, grown with dictionaries of word tuples."""

    def __init__(self, texts, depth=3, c0=0.02, discount=0.5):
        self.c = collections.Counter()
        runs = [None] + [collections.Counter() for _ in range(depth + 1)]
        for t in texts:
            w = words(t)
            self.c.update([*w, "END"])
            s = ["START", *w, "END"]
            for k in range(1, depth + 2):
                runs[k].update(tuple(s[j : j + k]) for j in range(len(s) - k + 1))
        self.n, self.v = sum(self.c.values()), len(self.c)
        self.support = max(2, math.ceil(c0 * math.sqrt(self.n)))
        self.depth, self.states = depth, {}
        for k in range(1, depth + 1):
            entries = collections.defaultdict(dict)
            for g, c in runs[k + 1].items():
                if c >= self.support:
                    entries[g[:-1]][g[-1]] = c
            new = {}
            for s, e in entries.items():
                held = runs[k][s]
                own = {w: (c - discount) / held for w, c in e.items()}
                parent = {w: 10 ** self.logp(s[1:], w) for w in e}
                used, lost = 1 - sum(own.values()), 1 - sum(parent.values())
                if used <= 0 or lost <= 0:
                    continue
                rest = used / lost
                gain = sum(c * math.log(own[w] / parent[w]) for w, c in e.items())
                gain += (held - sum(e.values())) * math.log(rest)
                if gain > 0.5 * math.log(max(self.n, 2)) * len(e):
                    new[s] = (own, rest)
            self.states.update(new)

    def base(self, w):
        return math.log10((self.c[w] + 1) / (self.n + self.v + 1))

    def logp(self, context, w):
        while context and context not in self.states:
            context = context[1:]
        if not context:
            return self.base(w)
        own, rest = self.states[context]
        return math.log10(own[w]) if w in own else math.log10(rest) + self.logp(context[1:], w)

    def score(self, text):
        s = ["START", *words(text), "END"]
        d = self.depth
        return sum(map(self.base, s[1:])), sum(self.logp(tuple(s[max(0, j - d) : j]), s[j]) for j in range(1, len(s)))


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def _luhn(digits):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 if int(c) > 4 else 2 * int(c)) for i, c in enumerate(reversed(digits))) % 10 == 0


def _digits(value):
    return re.sub("[^0-9]", "", value)


RULES = [
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda v: True),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda v: all(int(x) <= 255 for x in v.split("."))),
    ("card", r"[0-9]([\x20-]?[0-9])+", lambda v: 16 <= len(_digits(v)) <= 19 and _luhn(_digits(v))),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda v: 8 <= len(_digits(v)) <= 15),
]


def personal(text):
    """Counts by kind, digest and spans of what the rules find."""
    found = [[f"{k}:{m.start()}:{m.end()}" for m in re.finditer(p, text or "") if ok(m[0])] for k, p, ok in RULES]
    spans = ",".join(x for f in found for x in f)
    return [len(f) for f in found], hashlib.sha256(spans.encode()).hexdigest(), spans


def water_level(sizes, weights, repeat=3):
    """Targets: shares by weight, none above repeat times its size, the excess shared again."""
    total, capped = sum(sizes), set()
    while True:
        rest = total - sum(repeat * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        goal = [repeat * s if i in capped else rest * weights[i] / weight for i, s in enumerate(sizes)]
        new = {i for i, s in enumerate(sizes) if i not in capped and goal[i] > repeat * s}
        if not new:
            return goal
        capped |= new


def sainte_lague(goals, seats):
    won = [0] * len(goals)
    for _ in range(seats):
        best = max(range(len(goals)), key=lambda i: (goals[i] / (2 * won[i] + 1), -i))
        won[best] += 1
    return won
