"""Words as the operators' contracts define them, and texts that share passages."""

from __future__ import annotations

import random
import re


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def lowered(text):
    return [w.translate({c: c + 32 for c in range(0x41, 0x5B)}) for w in words(text)]


def shared_passages(seed, count, unit, pool, lengths, blanks=" "):
    """Texts that are made of pieces of a few passages and of noise; every 11th is null, some are empty."""
    rng = random.Random(seed)
    passages = [[rng.choice(pool) for _ in range(lengths[1])] for _ in range(5)]
    passages.append([pool[0]] * lengths[1])
    rows = []
    for i in range(count):
        parts = []
        for _ in range(rng.randrange(4)):
            if rng.random() < 0.7:
                base = rng.choice(passages)
                start = rng.randrange(lengths[1] // 2)
                parts += base[start : start + rng.randint(*lengths)]
            parts += [rng.choice(unit) for _ in range(rng.randrange(12))]
        rows.append((i, None if i % 11 == 10 else rng.choice(blanks).join(parts)))
    return rows
