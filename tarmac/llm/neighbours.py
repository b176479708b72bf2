"""Nearest vectors by inner product, found by counting collisions in sorted projections.

* Every vector is projected on `PROJECTIONS` random directions; for each direction the projections are kept as one sorted
  array. Around a query's own projection a window is opened in every array. A vector that lies in enough of the windows is
  verified: its inner product is computed. Windows widen with the radius searched (virtual rehashing) and nothing is
  hashed again.
* Inner products become distances by one more component, sqrt(M^2 - |x|^2), M being the largest norm around.
* A window reaches `REACH` radii to both sides, so a vector at the radius or nearer falls into each with probability 0.9 at
  least. The threshold is the number of collisions that such a vector reaches with probability 1 - `MISSED`. A search ends when the
  k-th best inner product found is that of the radius; then every nearer vector has had that chance.
* Rows are dealt into blocks of about `BLOCK`, queries into chunks; a block meets a chunk in one task. In the first block
  the k-th best of `TRIED` vectors bounds the radius, and windows widen up to it. What is found there is the bound (the
  k-th best product so far) for the next blocks, whose windows open at that radius at once; waves of blocks
  grow sixteenfold. Blocks whose norms cannot reach the bound are skipped. Nothing limits the number of candidates.

Vectors that are null, empty, zero or hold null or non-finite components take no part. Products are taken between vectors of
equal length only. Rows count one by one: repeated rows are candidates of each other, and each is a query of its own. A row
without vec_id may be found (its vec_id is null, last among ties). Ties go to the smaller vec_id. Fewer than k
candidates are all returned; an empty table gives no rows. Extra columns are ignored.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.llm.common import column, stored

K = 20
PROJECTIONS = 96
REACH = 1.645
MISSED = 0.02
WIDEN = 1.1
TRIED = 512
BLOCK = 8192
CHUNK = 4096
SEED = 17
_NONE = 2 ** 63 - 1


def threshold(projections=PROJECTIONS, reach=REACH, missed=MISSED):
    """The most collisions that a vector at the radius reaches with probability 1 - missed."""
    p = math.erf(reach / math.sqrt(2))
    below = 0.0
    for least in range(projections + 1):
        below += math.comb(projections, least) * p ** least * (1 - p) ** (projections - least)
        if below > missed:
            return least
    return projections


class Arrays:
    """Sorted projections of some vectors (rows of `x`)."""

    def __init__(self, x, projections=PROJECTIONS, seed=SEED):
        self.x = x
        self.scale = np.abs(x).max()
        scaled = x / self.scale
        squares = (scaled * scaled).sum(axis=1)
        self.largest = math.sqrt(squares.max())
        more = np.sqrt(np.maximum(self.largest ** 2 - squares, 0))
        draw = np.random.default_rng([seed, x.shape[1]])
        self.directions = draw.standard_normal((x.shape[1] + 1, projections))
        placed = (scaled @ self.directions[:-1] + np.outer(more, self.directions[-1])).T
        self.order = np.argsort(placed, axis=1)
        self.values = np.take_along_axis(placed, self.order, axis=1)

    def projected(self, queries):
        """Projections and norms of queries, brought to the length of the longest vector here."""
        queries = queries / np.abs(queries).max(axis=1, keepdims=True)
        norms = np.sqrt((queries * queries).sum(axis=1, keepdims=True))
        return (queries / norms * self.largest) @ self.directions[:-1]

    def radius(self, cosine):
        """The distance at which the inner product, by |q| and the scale, is `cosine`."""
        return math.sqrt(max(0.0, 2 * self.largest * (self.largest - cosine)))

    def windows(self, at, radii, reach=REACH):
        """Ends of the windows, by direction and query."""
        half = radii * reach
        low = [np.searchsorted(v, p - half, "left") for v, p in zip(self.values, at.T)]
        high = [np.searchsorted(v, p + half, "right") for v, p in zip(self.values, at.T)]
        return np.array(low), np.array(high)

    def collisions(self, low, high):
        """In how many windows each vector lies; what lies outside is counted where that is less."""
        n, m = len(self.x), len(self.order)
        if 2 * int((high - low).sum()) <= n * m:
            inside = np.concatenate([o[a:b] for o, a, b in zip(self.order, low, high)])
            return np.bincount(inside, minlength=n)
        outside = [o[:a] for o, a in zip(self.order, low)] + [o[b:] for o, b in zip(self.order, high)]
        return m - np.bincount(np.concatenate(outside), minlength=n)


def best(scores, names, k):
    """Places of the k largest scores, ties to the smaller name."""
    return np.lexsort((names, -scores))[:k]


def searched(x, names, own, queries, bounds, k=K, projections=PROJECTIONS, seed=SEED, reach=REACH, missed=MISSED):
    """For each query the places and scores of the k best vectors found that reach its bound.

    `own` is the place of the query itself among the vectors, or -1; `bounds` may be -inf: then some vectors are
    tried first, and the search starts below the radius of the k-th best of them.
    """
    arrays = Arrays(x, projections, seed)
    enough = threshold(projections, reach, missed)
    at, bounds = arrays.projected(queries), np.array(bounds, np.float64)
    sizes = np.abs(queries).max(axis=1)
    sizes = sizes * np.sqrt(((queries / sizes[:, None]) ** 2).sum(axis=1)) * arrays.scale
    seen = np.zeros((len(queries), len(x)), bool)
    seen[np.flatnonzero(own >= 0), own[own >= 0]] = True
    found = [(np.zeros(0, np.int64), np.zeros(0)) for _ in queries]
    hopeless = bounds > sizes * arrays.largest * (1 + 1e-9)
    steps = np.zeros(len(queries), np.int64)
    for q in np.flatnonzero(bounds == -math.inf).tolist():
        tried = np.flatnonzero(~seen[q, :TRIED])
        if len(tried) >= k:
            bounds[q] = np.sort((x[tried] * queries[q]).sum(axis=1))[-k]
            steps[q] = 2
    ends = np.array([arrays.radius(b / s) if b > -math.inf else math.inf for b, s in zip(bounds, sizes)])
    ends *= 1 + 1e-9
    radii = ends / WIDEN ** steps
    active = np.flatnonzero(~hopeless)
    while len(active):
        low, high = arrays.windows(at[active], radii[active], reach)
        going = []
        for i, q in enumerate(active.tolist()):
            count = arrays.collisions(low[:, i], high[:, i])
            new = np.flatnonzero((count >= enough) & ~seen[q])
            places, scores = found[q]
            if len(new):
                seen[q, new] = True
                # Products as fast as they come, then those near the bound in an order of sums that copies share.
                new = new[x[new] @ queries[q] >= bounds[q] - 1e-9 * sizes[q] * arrays.largest]
                products = (x[new] * queries[q]).sum(axis=1)
                reaching = products >= bounds[q]
                places = np.concatenate([places, new[reaching]])
                scores = np.concatenate([scores, products[reaching]])
                top = best(scores, names[places], k)
                places, scores = found[q] = places[top], scores[top]
            done = len(scores) >= k and arrays.radius(np.sort(scores)[-k] / sizes[q]) <= radii[q]
            if not done and radii[q] < ends[q]:
                going.append(q)
        active = np.array(going, np.int64)
        radii[active] = np.minimum(radii[active] * WIDEN, ends[active])
    return found


def usable(vector):
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def _matrix(values, length):
    values = values.combine_chunks() if isinstance(values, pa.ChunkedArray) else values
    return values.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, length)


_FOUND = "query_row long, query_id long, vec_id long, score double"


def _met(k, options):
    names = [c.split()[0] for c in _FOUND.split(", ")]
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.float64()]

    def meet(vectors, queries):
        out = [[], [], [], []]
        if vectors.num_rows and queries.num_rows:
            length = vectors.column("length")[0].as_py()
            rows = vectors.column("row").to_numpy()
            ids = vectors.column("id").to_numpy()
            order = np.argsort(rows)
            asked = queries.column("row").to_numpy()
            place = np.searchsorted(rows[order], asked)
            near = order[np.minimum(place, len(rows) - 1)]
            own = np.where(rows[near] == asked, near, -1)
            results = searched(_matrix(vectors.column("vector"), length), ids, own, _matrix(queries.column("vector"), length),
                               queries.column("bound").to_numpy(), k, **options)
            for row, name, (places, scores) in zip(asked.tolist(), queries.column("id").to_pylist(), results):
                out[0] += [row] * len(places)
                out[1] += [name] * len(places)
                out[2] += ids[places].tolist()
                out[3] += scores.tolist()
        return pa.table([pa.array(v, t) for v, t in zip(out, kinds)], names=names)
    return meet


def nearest(table, queries=None, k=K, vector="embedding", name="vec_id", block=BLOCK, chunk=CHUNK, **options):
    """(query_id, rank, vec_id, score): the k nearest rows found for each query.

    `queries` is a condition on the table's rows; without it, ids divisible by 20 are queries.
    """
    asked = (column(name) % 20 == 0) if queries is None else queries
    at = column(vector)
    rows = table.where(usable(at)).select(
        F.coalesce(column(name).cast("long"), F.lit(_NONE)).alias("id"), at.alias("vector"), F.size(at).alias("length"),
        F.coalesce(asked, F.lit(False)).alias("asked"), F.monotonically_increasing_id().alias("row"))
    rows = stored(rows, "vectors")
    size = rows.agg(F.count("*").alias("all"), F.count_if("asked").alias("asked")).first()
    blocks, chunks = max(1, -(-size["all"] // block)), max(1, -(-size["asked"] // chunk))
    rows = rows.withColumns({"block": F.pmod(F.xxhash64("row"), F.lit(blocks)),
                             "chunk": F.pmod(F.xxhash64("row", F.lit(1)), F.lit(chunks))})
    ask = rows.where("asked").select(*[F.col(c).alias(c) for c in ("length", "chunk", "row", "id", "vector")])
    bounds = ask.select(F.col("row").alias("of"), F.lit(-math.inf).alias("bound"))
    found, first, ranked = None, 0, Window.partitionBy("query_row").orderBy(F.desc("score"), F.asc("vec_id"))
    while first < blocks:
        last = min(blocks, max(1, 16 * first))
        here = rows.where(F.col("block").between(first, last - 1)).select(
            "length", "block", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)).cast("array<long>")).alias("chunk"),
            "row", "id", "vector")
        there = ask.join(bounds, F.col("row") == F.col("of"), "left").select(
            "length", F.explode(F.sequence(F.lit(first), F.lit(last - 1)).cast("array<long>")).alias("block"), "chunk",
            "row", "id", "vector", F.coalesce("bound", F.lit(-math.inf)).alias("bound"))
        keys = ["length", "block", "chunk"]
        wave = stored(here.groupBy(*keys).cogroup(there.groupBy(*keys)).applyInArrow(_met(k, options), _FOUND), "found")
        found = wave if found is None else found.unionByName(wave)
        found = stored(found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= k), "nearest")
        bounds = found.where(F.col("rank") == k).select(F.col("query_row").alias("of"), F.col("score").alias("bound"))
        found, first = found.drop("rank"), last
    return found.withColumn("rank", F.row_number().over(ranked)).select(
        "query_id", "rank", F.nullif("vec_id", F.lit(_NONE)).alias("vec_id"), "score")


def recall(table, found, queries=None, k=K, vector="embedding", name="vec_id"):
    """Share of the k nearest, by scores of all rows on the driver, that were found: for tables of test size."""
    rows = table.where(usable(column(vector))).select(column(name).alias("id"), column(vector).alias("v"), (
        (column(name) % 20 == 0) if queries is None else queries).alias("asked")).collect()
    x, ids = np.array([r["v"] for r in rows], np.float64), np.array([r["id"] for r in rows])
    got = {}
    for r in found.collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    hits = total = 0
    for i, r in enumerate(rows):
        if r["asked"]:
            scores = (x * x[i]).sum(axis=1)
            scores[i] = -math.inf
            want = ids[best(scores, ids, min(k, len(ids) - 1))]
            hits += len(got.get(r["id"], set()).intersection(want.tolist()))
            total += len(want)
    return hits / max(total, 1)
