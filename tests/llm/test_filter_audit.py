"""The filter audit against a run of every order over the documents themselves."""

import random
import re
from itertools import permutations
from math import factorial

from arkspark.llm.filter_audit import filter_audit, lattice_edges

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, part string, fails int, n long, quality int"


def failed(rows):
    """The filters that each (doc_id, text, source) fails."""
    out = []
    for i, text, _ in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = {"A"} if len(words) < 200 else set()
        fails |= {"B"} if 100 * len(set(words)) < 50 * len(words) else set()
        fails |= {"C"} if 100 * len(re.findall("[A-Z]", text)) > 2 * len(text) else set()
        fails |= {"D"} if re.search(r"[#$%&*|]", text) else set()
        same = [j for j, t, _ in rows if (t or "") == text]
        fails |= {"E"} if any(j is not None and (i is None or j < i) for j in same) else set()
        out.append(fails)
    return out


def brute_force(rows, labels):
    fails, out = failed(rows), {}
    for part in {s or "" for _, _, s in rows}:
        mine = [(i, f) for (i, _, s), f in zip(rows, fails, strict=True) if (s or "") == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for at, f in enumerate(order):
                gone = [x for x in left if f in x[1]]
                left = [x for x in left if f not in x[1]]
                shapley[f] += len(gone)
                lost = [[(labels.get(i) or (0, 0))[k] == 1 for i, _ in gone].count(True) for k in (0, 1)]
                out[part, "".join(order), at + 1] = [len(left), len(gone), sum(f in x[1] for x in mine) - len(gone), sum(x[1] == {f} for x in mine), *lost]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def fixture(seed=3):
    draw = random.Random(seed)
    rows = []
    for i in range(60):
        words = [f"w{draw.randrange(draw.choice((20, 5000)))}" for _ in range(draw.choice((0, 30, 199, 200, 260)))]
        text = " ".join(words)
        text = text.replace("w", "W", draw.choice((0, 3, 40))) + draw.choice(("", " #", " é\t|", "\x0b"))
        rows.append((i, text, draw.choice(("a", "b", None, ""))))
    rows += [(100 + i, rows[draw.randrange(60)][1], draw.choice(("a", "b", "c"))) for i in range(30)]
    rows += [(7, rows[7][1], "a"), (7, rows[7][1], "c"), (200, None, "a"), (201, "", "d"), (None, rows[3][1], "a"), (None, "alone", "a"), (None, "alone", "a"), (300, "x " * 50_000, "b")]
    labels = {i: (draw.choice((0, 1, None)), draw.choice((0, 1, None))) for i in range(0, 120, 2)}
    return rows, labels


def told(df):
    names = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    rows = df.collect()
    assert len({(r.part, r.filter_order, r.step) for r in rows}) == len(rows)
    return {(r.part, r.filter_order, r.step): [r[c] for c in names] for r in rows}


def test_every_order_equals_brute_force(spark):
    rows, labels = fixture()
    docs = spark.createDataFrame([(i, t, s, "p", 9, 1, 1) for i, t, s in rows], DOCS)
    marks = spark.createDataFrame([*((i, *m, "x") for i, m in labels.items()), (None, 1, 1, "x"), (2, 0, 0, "x")], "doc_id long, quality int, toxic int, part string")
    assert told(filter_audit(docs, marks)) == brute_force(rows, labels)


def test_empty_tables(spark):
    docs = spark.createDataFrame([], DOCS)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit(docs, labels).count() == 0
    one = told(filter_audit(spark.createDataFrame([(1, None, None, "", 0, 0, 0)], DOCS), labels))
    assert len(one) == 600 and one["", "ABCDE", 1] == [0, 1, 0, 1, 0, 0, 120] and one["", "BCDEA", 4] == [1, 0, 0, 0, 0, 0, 0]


def test_paths_are_all_orders():
    for n in range(1, 7):
        for state, f, orders in lattice_edges(n):
            held = state.bit_count()
            assert not state >> f & 1 and orders == factorial(held) * factorial(n - held - 1)
