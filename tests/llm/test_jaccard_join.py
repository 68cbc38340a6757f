import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from texts import lowered

from orderlens.llm import components, jaccard_join as op


def brute_force(rows):
    sets, root = {}, {}
    for i, text in rows:
        own = lowered(text)
        sets[i] = frozenset(tuple(own[k : k + 4]) for k in range(len(own) - 3)) if len(own) > 3 else frozenset([tuple(own)] if own else [])
        root[i] = i

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for i, s in sets.items():
        for j, both in Counter(j for x in s for j in holders[x] if j < i).items():
            if 100 * both >= 85 * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: (len(sets[i]), find(i)) for i in sets}


def near_copies(seed, count):
    rng, pool = random.Random(seed), [f"w{k}" for k in range(300)]
    made, rows = [], []
    for i in range(count):
        if made and rng.random() < 0.6:
            own = list(rng.choice(made[-50:]))
            for _ in range(rng.randrange(4)):
                place = rng.randrange(len(own) + 1)
                own[place : place + rng.randrange(2)] = [rng.choice(pool)] * rng.randrange(2)
        else:
            own = [rng.choice(pool) for _ in range(rng.choice([0, 1, 2, 3, 4, 5, 8, 10, 12, 15, 20, 30, 60, 200, 900]))]
        made.append(own)
        text = " ".join(own)
        rows.append((3 * i + 1, text.upper() if rng.random() < 0.1 else text))
    return rows


@pytest.mark.parametrize("most_small", [None, 0, 13])
def test_equals_brute_force(docs, monkeypatch, most_small):
    if most_small is not None:
        monkeypatch.setattr(op, "boundary", lambda sizes, percent: most_small)
    monkeypatch.setattr(op, "CHUNK", 7)
    rows = [*near_copies(3, 350), (2, None), (3, "")]
    found = op.join_groups(docs(rows)).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in found} == brute_force(rows)
    assert len(found) == len(rows)


def test_edge_cases(docs):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(4, text), (2, text + " x"), (2, text + " x"), (None, text), (9, "a b"), (8, "A\tB"), (7, "a"), (6, None), (5, " ")]
    found = {(r["doc_id"], r["component_id"]) for r in op.join_groups(docs(rows)).collect()}
    assert found == {(4, 2), (2, 2), (None, None), (9, 8), (8, 8), (7, 7), (6, 6), (5, 5)}
    kept = op.one_of_each(docs(rows))
    assert kept.columns == docs([]).columns
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(["2", "None", "8", "7", "6", "5"])
    assert op.join_groups(docs([])).collect() == [] and op.one_of_each(docs([])).collect() == []


def test_sketches_never_exceed_the_difference():
    rng = np.random.default_rng(2)
    for size in (1, 40, 600, 5000):
        a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
        b = np.unique(np.append(a[size // 10 :], rng.integers(0, 2**63, size // 9).astype(np.uint64)))
        x, y = op.sketch_of(a), op.sketch_of(b)
        words = min(len(x), len(y))
        apart = int(np.bitwise_count(op._folded(x, words) ^ op._folded(y, words)).sum())
        assert apart <= len(np.setxor1d(a, b))


def test_the_boundary_weighs_subsets_against_entries():
    assert op.boundary({3: 100}, 85) >= 3 and op.boundary({15: 10_000}, 85) < 15
    assert op.boundary({}, 85) == 0


def test_components_of_paths_stars_and_rings(session):
    links = [(k, k + 1) for k in range(0, 40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 202), (202, 200), (300, 300)]
    frame = session.createDataFrame(links, "a long, b long")
    found = dict(map(tuple, components.components(frame).collect()))
    assert found == {**{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, **{k: 200 for k in (200, 201, 202)}}
    assert components.components(frame.limit(0)).collect() == []
