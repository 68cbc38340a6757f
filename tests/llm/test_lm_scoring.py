import math
import zlib
from collections import Counter

import numpy as np
import pytest
from texts import lowered, shared_passages

from orderlens.llm import lm_scoring as op


def held_out(doc_id):
    return doc_id is not None and zlib.crc32(str(doc_id).encode()) % 7 == 2


def brute_force(rows, mu):
    tokens = [[*lowered(t), "</s>"] for _, t in rows]
    single, pairs, before = Counter(), Counter(), Counter()
    for (i, _), own in zip(rows, tokens, strict=True):
        if not held_out(i):
            single.update(own)
            pairs.update(zip(["<s>", *own], own, strict=False))
            before["<s>"] += 1
    before.update(single)
    total, kinds, out = sum(single.values()), len(single), []
    for (i, _), own in zip(rows, tokens, strict=True):
        p = [(single[w] + 1) / (total + kinds + 1) for w in own]
        q = [(pairs[h, w] + mu * x) / (before[h] + mu) for h, w, x in zip(["<s>", *own], own, p, strict=False)]
        known = sum(single[w] > 0 for w in own)
        out.append((str(i), held_out(i), len(own), known, total, sum(map(math.log10, p)), sum(map(math.log10, q))))
    return sorted(out)


@pytest.mark.parametrize("block_bytes", [300, 1 << 20])
def test_equals_brute_force(docs, block_bytes):
    rows = shared_passages(2, 90, ["x", "Y", "é"], ["ab", "CD", "ef", "gh"], (3, 30), [" ", "\n"])
    rows += [(500, "unseen words here"), (501, ""), (None, "ab x"), (7, rows[7][1]), (502, "w " * 30_000)]
    found = op.score(docs(rows), block_bytes=block_bytes).collect()
    got = sorted((str(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) for r in found)
    for a, b in zip(got, brute_force(rows, op.MU), strict=True):
        assert a[:5] == b[:5] and a[5:] == pytest.approx(b[5:], rel=1e-9)


def test_weights_of_every_state_sum_to_one():
    counts = np.array([5, 3, 0, 2])
    pairs = np.array([[1, 2, 0, 2], [0, 0, 0, 3], [0, 0, 0, 0], [1, 1, 0, 0], [4, 1, 0, 0]])
    own = op.Automaton(counts, pairs.reshape(-1), 5, 10, 3, 2.0)
    for state in range(5):
        seen = pairs[state]
        weights = [(c / (own.state[state] + 2.0) if c else 0.0) + own.failure[state] * r for c, r in zip(seen, own.root, strict=True)]
        # tokens beyond the four share one more place at the root
        assert sum(weights) <= 1 + 1e-9


def test_held_out_accuracy_beats_single_tokens(docs):
    rows = [(k, " ".join(["the cat sat on the mat and looked at me"] * 3 + [f"w{k}"])) for k in range(60)]
    found = [r for r in op.score(docs(rows)).collect() if r["held_out"]]
    assert found and sum(r["score"] for r in found) > sum(r["base_score"] for r in found)
    assert op.score(docs([])).collect() == []
