"""Periodic runs against a search of every period at every place."""

import hashlib
import random
import re
import zlib
from fractions import Fraction

import numpy as np
import pytest

from arkspark.llm import periodic_runs as pr
from arkspark.llm import queries as llm
from arkspark.llm.recompression import Grammar


def smallest_period(words):
    border = [0] * len(words)
    for i in range(1, len(words)):
        b = border[i - 1]
        while b and words[i] != words[b]:
            b = border[b - 1]
        border[i] = b + (words[i] == words[b])
    return len(words) - border[-1]


def brute_force(words):
    words, found = list(words), set()
    for q in range(1, len(words) // 3 + 1):
        at = 0
        while at + q < len(words):
            end = at
            while end + q < len(words) and words[end] == words[end + q]:
                end += 1
            if end + q - at >= max(24, 3 * q) and smallest_period(words[at : end + q]) == q:
                found.add((at, end + q - at, q))
            at = end + 1
    return sorted(found, key=lambda r: (r[0], r[2]))


def sequences(seed, many=60):
    draw = random.Random(seed)
    out = [[], [0], [0] * 23, [0] * 24, [0] * 500, [0, 1] * 200, [0, 0, 1] * 50 + [0, 0, 2] * 50, list(range(9)) * 3, list(range(8)) * 3, list(range(7)) * 3, [0, 1] * 40 + [2] + [0, 1] * 40, [*range(100)] * 3 + [7], ([0, 1] * 20 + [2]) * 9]
    fib = [[0], [0, 1]]
    while len(fib[-1]) < 600:
        fib.append(fib[-1] + fib[-2])
    out += [fib[-1], [x for i in range(300) for x in (0, 1 + i % 97)]]
    for _ in range(many):
        alphabet = draw.choice((1, 2, 3, 50))
        words = []
        for _ in range(draw.randrange(1, 7)):
            unit = [draw.randrange(alphabet) for _ in range(draw.randrange(1, 40))]
            words += (unit * draw.randrange(1, 12))[: draw.randrange(1, 250)]
            if draw.random() < 0.5:
                words += [draw.randrange(alphabet) for _ in range(draw.randrange(30))]
        out.append(words)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_all_runs_of_many_sequences_at_once(seed):
    given = sequences(seed)
    random.Random(seed).shuffle(given)
    got = pr.find_runs([np.array(x, np.int64) for x in given])
    assert got == [brute_force(x) for x in given]


def test_extensions_of_a_grammar():
    draw = random.Random(5)
    words = [x for s in sequences(9, 10) for x in s][:3000]
    symbols = np.array([10**6, *words, 10**6 + 1], np.int64)
    barriers = np.zeros(len(symbols), bool)
    barriers[[0, -1]] = True
    grammar = Grammar(symbols, barriers)
    assert len(grammar.name) > 2 * len(symbols)
    pairs = [sorted(draw.sample(range(1, len(words) + 1), 2)) for _ in range(3000)]
    i, j = (np.array(x) for x in zip(*pairs, strict=True))
    right, left = grammar.extend(i, j, True), grammar.extend(i, j, False)
    for a, b, r, x in zip(i.tolist(), j.tolist(), right.tolist(), left.tolist(), strict=True):
        assert (symbols[a : a + r] == symbols[b : b + r]).all() and symbols[a + r] != symbols[b + r]
        assert (symbols[a - x + 1 : a + 1] == symbols[b - x + 1 : b + 1]).all() and symbols[a - x] != symbols[b - x]


def test_met_hashes_are_noticed(monkeypatch):
    """A grammar whose names are worthless is built again with others."""
    real, built = pr.Grammar, []

    class Worthless(real):
        def __init__(self, symbols, barriers, salt=0):
            super().__init__(symbols, barriers, salt)
            built.append(salt)

        def extend(self, i, j, forward):
            return super().extend(i, j, forward) + (built[-1] == 0) * 9

    monkeypatch.setattr(pr, "Grammar", Worthless)
    words = np.array([5, 6, *[1, 2, 3] * 20, 9, 8], np.int64)
    assert pr.find_runs([words]) == [[(2, 60, 3)]] and built == [0, 1]


def test_operator_on_texts(spark, monkeypatch):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a\x0bb " * 30), (4, "a\x0bb " * 30), (None, "x " * 24), (5, "é é " * 23), (6, "lead " + "p q r " * 10 + "tail"), (7, "w " * 300_000)]
    docs = spark.createDataFrame([(i, t, 1, "c") for i, t in rows], "doc_id long, text string, runs int, collapsed string")
    got = [(r.doc_id, r.n_words, [tuple(x) for x in r.runs], r.collapsed) for r in pr.periodic_runs(docs).collect()]
    want = [(i, len((t or "").encode().split()), None, None) for i, t in rows]
    assert sorted(map(str, [g[:2] for g in got])) == sorted(map(str, [w[:2] for w in want]))
    by = {g[0]: g for g in got}
    assert by[1][2:] == ([], "") and by[2][2:] == ([], "") and by[3][2:] == ([], "")
    assert by[4][2:] == ([(0, 60, 2)], "a b") and by[None][2:] == ([(0, 24, 1)], "x") and by[5][2:] == ([], "é é " * 22 + "é é")
    assert by[6][2:] == ([(1, 30, 3)], "lead p q r tail") and by[7][2:] == ([(0, 300_000, 1)], "w")
    assert pr.periodic_runs(docs.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    """Every document of the smallest table, planted runs and all."""
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: r for r in llm.queries()["op11_periodic_runs"](spark, sf).collect()}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert set(got) == set(texts)
    planted = 0
    for i, text in texts.items():
        words = re.findall("[^\\x20\\x09-\\x0D]+", text or "")
        h, n = zlib.crc32(str(i).encode()), len(words)
        if h % 10 == 0 and n:
            g, planted = h // 10, planted + 1
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if k < a else words[a + (k - a) % p] for k, w in enumerate(words)]
        if n > 3000 and h % 10:
            continue  # too slow for the search of every place
        runs = brute_force(words)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None, None, None))
        gone = {k for s, e, q in runs for k in range(s + q, s + e)}
        left = " ".join(w for k, w in enumerate(words) if k not in gone)
        lines = "".join(f"{s},{e},{q}\n" for s, e, q in runs)
        want = (i, len(runs), *best, 1000 * best[1] // best[2] if runs else None, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(left.encode()).hexdigest())
        assert tuple(got[i]) == want
    assert planted > 10
