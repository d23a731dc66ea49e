import random

import numpy as np
import pytest

from quern.llm.pieces import Lattice


def every_way(lattice, text):
    if not text:
        return [(0, ())]
    out = []
    for start, ids, cost in lattice.edges(text, len(text)):
        out += [(c + cost, path + ids) for c, path in every_way(lattice, text[:start])]
    return out


def small(seed):
    rng = random.Random(seed)
    texts = {"".join(rng.choice("abc") for _ in range(rng.randint(1, 3))) for _ in range(9)} | {" ", " a", " ab", ",", ",,", ",a", "1b"}
    pieces = {t: (i, rng.randint(1, 50)) for i, t in enumerate(sorted(texts))}
    return Lattice(pieces, list(range(1000, 1256)), 40)


@pytest.mark.parametrize("seed", range(30))
def test_n_best_against_every_segmentation(seed):
    lattice, rng = small(seed), random.Random(seed + 99)
    for _ in range(20):
        text = "".join(rng.choice("abcü  ,1\n") for _ in range(rng.randint(0, 8)))
        ways = sorted(every_way(lattice, " " + text))
        for n in (1, 2, 4):
            best, found = lattice.encode(text, n)
            assert [ways[0][0] + more for more, _ in found] == [w[0] for w in ways[:n]]
            assert len({tuple(ids.tolist()) for _, ids in found}) == len(found)
            assert all((ways[0][0] + more, tuple(ids.tolist())) in ways for more, ids in found)
            assert lattice.decode(best) == text.encode()
            assert all(lattice.decode(ids) == text.encode() for _, ids in found)
            assert np.array_equal(best, found[0][1])
        assert [c for c, _ in lattice.n_best(" " + text, 5)] == [w[0] for w in ways[:5]]
