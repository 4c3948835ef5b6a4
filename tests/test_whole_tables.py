"""Tables filled place by pair give what the band that doesn't move gives."""

import numpy as np
import pytest

from editlake.operators import align

SCORES = [*align.PROFILES.values(), align.Scores(8, -6, 8, 1), align.Scores(2, -3, 1, 1), align.Scores(1.5, -0.5, 2.25, 0.5)]


@pytest.mark.parametrize("mode", ["global", "global-local", "local"])
def test_whole_tables(mode):
    rng = np.random.default_rng(6)
    for k in range(70):
        letters, b = list("ACGTNRY" if k % 3 == 0 else "ACGT"), int(rng.integers(1, 9))
        x = ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(b)]
        y = [t[:3] + t[5:] for t in x] if k % 4 == 0 else ["".join(rng.choice(letters, rng.integers(0, 40))) for _ in range(b)]
        m, n = (np.array([len(t) for t in z]) for z in (x, y))
        rows, cols = int(m.max()), int(n.max())
        want = align._fill(align._codes(x, rows), align._codes(y, cols), m, n, np.zeros(b, int), cols + 1, False, mode, SCORES[k % len(SCORES)])
        assert align._fill_whole(align._codes(x, rows), align._codes(y, cols), m, n, mode, SCORES[k % len(SCORES)]) == want
        assert align.align_batch(x, y, mode, SCORES[k % len(SCORES)]) == want
