import math

import numpy as np
import pytest
from test_operators import rows

from tarmac.llm import neighbours
from tarmac.llm.common import ship_code


@pytest.fixture
def vectors(spark):
    ship_code(spark)

    def build(*rows):
        return spark.createDataFrame([(i, None if v is None else list(v), 1.0, 2) for i, v in rows],
                                     "vec_id long, embedding array<float>, score double, rank int")
    return build


def brute_force(table, k):
    usable = [(i, np.array(v, np.float32).astype(np.float64)) for i, v in table if v is not None and len(v) and all(
        x is not None and math.isfinite(x) for x in v) and any(v)]
    out = []
    for n, (i, q) in enumerate(usable):
        if i is not None and i % 20 == 0:
            near = sorted((-(x * q).sum(), j is None, j) for m, (j, x) in enumerate(usable) if m != n and len(x) == len(q))
            out += [(i, rank, j, -s) for rank, (s, _, j) in enumerate(near[:k], 1)]
    return sorted(out, key=repr)


def drawn(n, length=16, seed=1, spread=0.5):
    draw = np.random.default_rng(seed)
    return np.float32(draw.standard_normal((n, length)) * np.exp(spread * draw.standard_normal((n, 1))))


@pytest.mark.parametrize("block, chunk", [(8192, 4096), (60, 7)])
def test_most_neighbours_are_found_whatever_the_lengths(vectors, block, chunk):
    table = list(enumerate(drawn(600).tolist()))
    want = brute_force(table, 20)
    got = rows(neighbours.nearest(vectors(*table), block=block, chunk=chunk))
    assert len(got) == len(want)
    found = {(r[0], r[2]): r[3] for r in got}
    missed = [w for w in want if (w[0], w[2]) not in found]
    assert len(missed) <= 0.05 * len(want)
    assert all(abs(found[w[0], w[2]] - w[3]) < 1e-12 for w in want if w not in missed)


def test_odd_rows(vectors):
    near = drawn(30, 4, 2).tolist()
    table = [(i, v) for i, v in enumerate(near)] + [
        (40, None), (60, []), (80, [0.0] * 4), (100, [1.0, None, 0.0, 0.0]), (120, [math.nan, 1.0, 0.0, 0.0]),
        (140, [math.inf, 0.0, 0.0, 0.0]), (160, [1.0, 2.0]), (161, [3.0, 1.0]), (None, near[0]), (0, near[0]), (7, near[3])]
    assert rows(neighbours.nearest(vectors(*table))) == brute_force(table, 20)
    assert rows(neighbours.nearest(vectors(*table), k=3)) == brute_force(table, 3)


def test_a_vector_in_most_rows(vectors):
    common = drawn(1, 16, 3)[0].tolist()
    table = [(i, common if i % 3 else v) for i, v in enumerate(drawn(400, 16, 4).tolist())]
    got = rows(neighbours.nearest(vectors(*table), block=50))
    want = brute_force(table, 20)
    # Copies tie: the smallest ids of all blocks are named.
    for q in (20, 40, 80):
        assert [g for g in got if g[0] == q] == [w for w in want if w[0] == q]


def test_few_and_no_vectors(vectors):
    assert neighbours.nearest(vectors()).count() == 0
    assert neighbours.nearest(vectors((20, [1.0, 0.0]))).count() == 0
    assert rows(neighbours.nearest(vectors((20, [1.0, 0.0]), (21, [2.0, 5.0])))) == [(20, 1, 21, 2.0)]
    assert neighbours.nearest(vectors((21, [2.0, 5.0]), (22, [2.0, 5.0]))).count() == 0


def test_threshold_is_reached_with_the_stated_chance():
    draw = np.random.default_rng(5)
    least = neighbours.threshold()
    collisions = (np.abs(draw.standard_normal((4000, neighbours.PROJECTIONS))) <= neighbours.REACH).sum(axis=1)
    assert 0.96 < (collisions >= least).mean() < 0.995
