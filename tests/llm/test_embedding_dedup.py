"""Near duplicates among embeddings against all cosines."""

import numpy as np
import pytest

from arkspark.llm import projection_forest as forest
from arkspark.llm.embedding_dedup import embedding_near_duplicates

SCHEMA = "vec_id long, embedding array<double>, label int, component_id string, leaf long, key long"


def table_of(spark, rows):
    return spark.createDataFrame([(i, v, 1, "c", 2, 3) for i, v in rows], SCHEMA)


def brute_force(rows, threshold=0.9):
    """(vec_id, n_links, component_id, kept) of each row."""
    good = [k for k, (i, v) in enumerate(rows) if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    links = {k: set() for k in good}
    for dim in {len(rows[k][1]) for k in good}:
        own = [k for k in good if len(rows[k][1]) == dim]
        x = np.array([rows[k][1] for k in own], float)
        x = x / np.abs(x).max(axis=1, keepdims=True)
        x = x / np.linalg.norm(x, axis=1)[:, None]
        for a, b in zip(*np.nonzero(x @ x.T >= threshold - 1e-12), strict=True):
            if a != b:
                links[own[a]].add(own[b])
    near = {k: set(v) for k, v in links.items()}
    by_id = {}
    for k in good:
        by_id.setdefault(rows[k][0], []).append(k)
    for same in by_id.values():
        for k in same:
            near[k] |= set(same) - {k}
    comp, out = {}, []
    for k in good:
        if k not in comp:
            seen, waiting = {k}, [k]
            while waiting:
                new = near[waiting.pop()] - seen
                seen |= new
                waiting += new
            for s in seen:
                comp[s] = min(rows[x][0] for x in seen)
    for k, (i, _) in enumerate(rows):
        c = comp.get(k, i)
        out.append((i, len(links.get(k, ())), c, i is None or i == c))
    return sorted(out, key=str)


def copies(rng, centre, n, cosine):
    """Vectors of about this cosine with each other."""
    noise = rng.standard_normal((n, len(centre)))
    noise -= (noise @ centre)[:, None] * centre
    noise /= np.linalg.norm(noise, axis=1)[:, None]
    return np.sqrt(cosine) * centre + np.sqrt(1 - cosine) * noise


def fixture(seed, many=1200, dim=32):
    rng = np.random.default_rng(seed)
    x = [forest.unit(rng.standard_normal((many, dim)))]
    for n, cosine in ((2, 0.97), (2, 0.91), (3, 0.99), (40, 0.97), (300, 0.975), (250, 0.93), (30, 0.9)):
        for _ in range(12 if n < 10 else 1):
            x.append(copies(rng, forest.unit(rng.standard_normal((1, dim)))[0], n, cosine))
    x = np.vstack(x) * rng.uniform(0.1, 9, (sum(map(len, x)), 1))
    ids = rng.permutation(len(x)) * 3
    rows = [(int(i), v.tolist()) for i, v in zip(ids, x, strict=True)]
    v = rows[5][1]
    rows += [(100_000 + k, rows[1600][1]) for k in range(700)]  # equal ones
    rows += [(-5, None), (-6, []), (-7, [0.0] * dim), (-8, [None] + [1.0] * (dim - 1)), (-9, [float("nan")] * dim), (-10, [float("inf")] + [0.0] * (dim - 1)), (None, v), (None, v), (-11, [1.0, 2.0]), (-12, [2.0, 4.0]), (-13, [1e300, 2e300]), (-14, [1e-300, 2e-300])]
    return rows


def compared(got, want, ids_differ=0):
    assert len(got) == len(want)
    exact = sum(g == w for g, w in zip(got, want, strict=True))
    assert exact >= len(want) - ids_differ, [(g, w) for g, w in zip(got, want, strict=True) if g != w][:5]


def told(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect()), key=str)


@pytest.mark.parametrize("sizes", [{}, {"leaf_rows": 48, "block": 64, "fit_vectors": 300, "fit_node": 100, "trees": 12}])
def test_links_equal_all_cosines(spark, sizes):
    """With the sizes of production, and with so small ones that leaves are cut in rounds and dealt by blocks."""
    rows = fixture(2)
    rows += [(rows[7][0], rows[1500][1]), (rows[7][0], rows[7][1])]  # one id with two vectors, and a repeated row
    got, want = told(embedding_near_duplicates(table_of(spark, rows), **sizes)), brute_force(rows)
    links = sum(w[1] for w in want)
    assert links > 100_000 and all(g[1] <= w[1] for g, w in zip(got, want, strict=True))
    assert sum(g[1] for g in got) >= 0.99 * links
    compared([g[2:] for g in got], [w[2:] for w in want])


def test_recall_at_the_threshold(spark):
    """Pairs of a cosine just above and just below it."""
    rng = np.random.default_rng(3)
    x = forest.unit(rng.standard_normal((1500, 64)))
    noise = rng.standard_normal(x.shape)
    noise -= np.einsum("ij,ij->i", noise, x)[:, None] * x
    noise = forest.unit(noise)
    cosine = np.where(np.arange(1500) % 2, 0.9 + 1e-7, 0.9 - 1e-7)[:, None]
    y = cosine * x + np.sqrt(1 - cosine**2) * noise
    rows = [(i, v.tolist()) for i, v in enumerate(np.vstack([x, y]))]
    got, want = told(embedding_near_duplicates(table_of(spark, rows))), brute_force(rows)
    assert sum(w[1] for w in want) == 1500
    assert all(g[1] <= w[1] for g, w in zip(got, want, strict=True)) and sum(g[1] for g in got) >= 0.97 * 1500


def test_empty_tables(spark):
    assert embedding_near_duplicates(table_of(spark, [])).count() == 0
    assert told(embedding_near_duplicates(table_of(spark, [(3, None), (4, [])]))) == [(3, 0, 3, True), (4, 0, 4, True)]
    assert told(embedding_near_duplicates(table_of(spark, [(3, [1.0])] * 2))) == [(3, 1, 3, True)] * 2


def test_quantised_bounds():
    rng = np.random.default_rng(4)
    x = forest.unit(rng.standard_normal((200, 100)) * rng.uniform(0, 1, (200, 100)) ** 9)
    q, step, off = forest.quantised(x)
    y = q * step[:, None]
    error = np.abs(x @ x.T - y @ y.T)
    assert (error <= off[:, None] + off[None, :] + off[:, None] * off[None, :] + 1e-12).all() and error.max() < 1e-3
