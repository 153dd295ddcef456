"""The FM index against a plain search."""

import random

import numpy as np
import pytest

from hexapla.llm.fmindex import FMIndex, _smaller_beside


def brute(texts, owners, pattern, depth):
    out = []
    for i in range(len(pattern)):
        best, owner = 0, -1
        for t, o in zip(texts, owners, strict=True):
            for k in range(len(t)):
                n = 0
                while n < depth and i + n < len(pattern) and k + n < len(t) and pattern[i + n] == t[k + n]:
                    n += 1
                if n == depth:
                    owner = o if owner < 0 else min(owner, o)
                best = max(best, n)
        out.append((best, owner))
    return out


@pytest.mark.parametrize(("seed", "alphabet", "depth"), [(0, 2, 5), (1, 3, 4), (2, 1, 6), (3, 40, 3), (4, 5, 1), (5, 2, 12)])
def test_matching_statistics(seed, alphabet, depth):
    r = random.Random(seed)
    texts = [[r.randint(1, alphabet) for _ in range(r.randint(1, 25))] for _ in range(30)]
    texts += [texts[3], texts[4][:5] + texts[5]]
    owners = [r.randint(0, 9) for _ in texts]
    index = FMIndex(np.array(sum(texts, [])), np.array([len(t) for t in texts]), np.array(owners), alphabet + 2, depth)
    patterns = [*texts[:6], [alphabet + 1, 1, 1, alphabet + 1], [0, 1, 0], *[[r.randint(0, alphabet) for _ in range(r.randint(1, 30))] for _ in range(12)]]
    length, owner = index.matching_statistics(np.array(sum(patterns, [])), np.array([len(p) for p in patterns]))
    plain = [x for p in patterns for x in brute(texts, owners, [x or -5 for x in p], depth)]
    assert list(zip(length.tolist(), owner.tolist(), strict=True)) == plain


def test_smaller_beside():
    r = random.Random(0)
    v = [r.randint(-1, 6) for _ in range(200)]
    before, after = _smaller_beside(np.array(v))
    for i, x in enumerate(v):
        assert before[i] == next((k for k in range(i - 1, -1, -1) if v[k] < x), i)
        assert after[i] == next((k for k in range(i + 1, len(v)) if v[k] < x), i)
