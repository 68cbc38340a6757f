import random
from collections import Counter, defaultdict

import corpus_pipeline as pipeline
from texts import lowered


def brute_force(rows):
    """Least id of each text's component of texts that share four fifths of their five-word shingles."""
    sets, root = {}, {i: i for i, _ in rows}
    for i, text in rows:
        own = lowered(text)
        sets[i] = frozenset(tuple(own[k : k + 5]) for k in range(len(own) - 4)) if len(own) > 4 else frozenset([tuple(own)] if own else [])

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
            if 5 * both >= 4 * (len(s) + len(sets[j]) - both):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def test_the_stage_equals_five_word_brute_force(session, docs):
    from test_jaccard_join import brute_force as four_words, near_copies

    rows, rng = near_copies(5, 250), random.Random(6)
    for k in range(40):
        # a run of changed words, so that similarities lie on both sides of 0.8
        size = rng.choice([30, 60, 200])
        own = [f"v{k}x{j}" for j in range(size)]
        run = round(size * rng.uniform(0.05, 0.15))
        place = rng.randrange(5, size - run - 5)
        rows += [(2000 + 2 * k, " ".join(own)), (2001 + 2 * k, " ".join([*own[:place], *(f"y{j}" for j in range(run)), *own[place + run :]]))]
    rows += [(5000, None), (5001, "")]
    kept = {r["doc_id"] for r in dict(pipeline.STAGES)["jaccard_join"](session, docs(rows).select(*pipeline.COLUMNS), "").collect()}
    expected = set(brute_force(rows).values())
    assert kept == expected
    assert expected != {c for _, c in four_words(rows).values()}


def test_copies_just_above_four_fifths_go(session, docs):
    # 98 and 98 five-word shingles, 87 in common: 0.798; with one changed word less, 88 and 0.815
    own = [f"w{k}" for k in range(102)]
    changed = lambda n: " ".join([*own[:40], *(f"x{j}" for j in range(n)), *own[40 + n :]])
    stage = dict(pipeline.STAGES)["jaccard_join"]
    for n, ids in ((7, {1, 2}), (6, {1})):
        frame = docs([(1, " ".join(own)), (2, changed(n))]).select(*pipeline.COLUMNS)
        assert {r["doc_id"] for r in stage(session, frame, "").collect()} == ids
