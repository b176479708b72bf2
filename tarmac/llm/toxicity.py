"""Toxicity by maximum-scoring segments.

* Tokens (runs of letters and digits, hashed into a table of fixed width) get log-odds of toxic against clean training
  texts (how many have it, n near copies as 1 + ln n) under a Dirichlet prior: pseudo-texts in proportion to the token's count
  over all documents and `LEAST` more for each token, dealt to the labels by their size, so a rare token is drawn to 0.
  Log-odds below `TELLING` count as 0, and every token costs `DRIFT`.
* One scan over the tokens with a positive score finds all maximal segments (linear time); the tokens
  between them only add their cost.
* Segment scores become expected numbers of segments as good by chance, E = K n exp(-lambda S): lambda from the
  token scores of clean texts, K from their best segments. The evidence -ln E of a text's significant segments adds up
  and a logistic curve, fitted on the training texts, near copies once, turns it into a score from 0 to 1. K and the
  curve see each training text by the counts of the others, else words that only it has would look like proof.

Labels are learned from at most `SAMPLE` labelled ids and as many of their texts, drawn by hash, of those not held out: a
bounded table that every task may hold; what reaches the driver is one row per class of near copies. Background counts and
scores cover all documents. Labels of one doc_id that differ count as toxic; null labels are left out. Null and empty texts
have no segments and get the score of no evidence. Without training rows every score is 0; an empty table gives
no rows. Equal texts get equal scores. Extra columns of documents are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tarmac.llm import tokens
from tarmac.llm.common import column, pieces, stored, summed_counters, utf8

BITS = 20
WIDTH = 1 << BITS
_SHIFT = np.uint64(64 - BITS)
SAMPLE = 20_000
#: Pseudo-counts of the prior, as a share of the training counts.
PRIOR = 0.005
#: Pseudo-texts that every token has besides, and the least log-odds that count: the best of twelve pairs on three folds
#: of the training rows (held-out rows took no part).
LEAST = 3.0
TELLING = 2.0
DRIFT = 0.3
THRESHOLD = 0.3


def held_out(doc_id="doc_id"):
    return F.pmod(F.crc32(F.coalesce(column(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def training_labels(labels, sample=SAMPLE):
    """(id, toxic) of at most `sample` labelled documents."""
    return (labels.where(column("toxic").isNotNull() & column("doc_id").isNotNull() & ~held_out())
            .groupBy(column("doc_id").alias("id")).agg((F.max("toxic") > 0).alias("toxic"))
            .orderBy(F.xxhash64("id"), "id").limit(sample))


def _buckets(part, k):
    data, offsets = utf8(part.column(k))
    starts, ends, h, first = tokens.words(data, offsets, tokens.ALNUM)
    return (h >> _SHIFT).astype(np.int64), starts, ends, first, offsets


def _background(batch, counters):
    for part in pieces(batch):
        counters += np.bincount(_buckets(part, 0)[0], minlength=WIDTH)


def _classes(h, first):
    """A name for each text that near copies mostly share: the least two hashes of its three-word contexts."""
    around = np.zeros(len(h) + 2, np.uint64)
    around[1:-1] = h
    inner = tokens.ngrams(around, 3)
    out = np.zeros(len(first) - 1, np.uint64)
    full = np.flatnonzero(np.diff(first) > 0)
    for k in (1, 2):
        salted = tokens.mixed(inner ^ np.uint64(0x9E3779B97F4A7C15 * k % 2 ** 64))
        if len(full):
            out[full] = tokens.mixed(out[full] + np.minimum.reduceat(salted, first[full]))
    return out.view(np.int64)


def _evidence(batches):
    """(bucket, class, toxic): each token of a text once, with the class of the text."""
    for batch in batches:
        for part in pieces(batch):
            data, offsets = utf8(part.column(0))
            _, _, h, first = tokens.words(data, offsets, tokens.ALNUM)
            bucket = (h >> _SHIFT).astype(np.int64)
            row = np.repeat(np.arange(part.num_rows), np.diff(first))
            pairs = np.unique(row.astype(np.int64) * WIDTH + bucket)
            row, bucket = pairs // WIDTH, pairs % WIDTH
            toxic = part.column(1).to_numpy(zero_copy_only=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket), pa.array(_classes(h, first)[row]), pa.array(toxic[row].astype(bool))],
                names=["bucket", "class", "toxic"])


def label_counts(rows):
    """Clean and toxic texts with each token bucket. A class of n rows counts 1 + ln n: copies do not
    dominate and are not hidden, and a phrase counts for all the different texts that have it."""
    seen = rows.mapInArrow(_evidence, "bucket long, class long, toxic boolean").groupBy(
        "bucket", "class", "toxic").agg(F.count("*").alias("n"))
    # Whole numbers, so that sums do not depend on the order.
    weight = F.sum(F.round((1 + F.log("n")) * 10 ** 6).cast("long")).alias("weight")
    out = np.zeros((2, WIDTH))
    for r in seen.groupBy("bucket", "toxic").agg(weight).toLocalIterator():
        out[int(r["toxic"]), r["bucket"]] = r["weight"] / 10 ** 6
    return out


def _prior(background, counted, prior=PRIOR):
    return max(prior * counted, 1.0) * (background + 0.01) / (background + 0.01).sum()


def log_odds(background, clean, toxic, prior=PRIOR):
    """Token scores before the drift, and the same as a clean and as a toxic training text sees them: without itself."""
    n, t, c = clean.sum() + toxic.sum(), toxic.sum(), clean.sum()
    alpha = _prior(background, n, prior) + LEAST

    def odds(clean, toxic):
        x = np.log((toxic + alpha * t / n) / t) - np.log((clean + alpha * c / n) / c)
        return np.where(x >= TELLING, x, 0.0)

    return odds(clean, toxic), [odds(np.maximum(clean - 1, 0), toxic), odds(clean, np.maximum(toxic - 1, 0))]


def decay(scores, weights):
    """lambda with sum(weights * exp(lambda * scores)) = 1 for scores of negative mean."""
    p = weights / max(weights.sum(), 1)
    if (p * scores).sum() >= 0 or not (p[scores > 0] > 0).any():
        return 1.0
    low, high = 0.0, 1.0
    while (p * np.exp(np.minimum(high * scores, 600))).sum() < 1 and high < 100:
        high *= 2
    for _ in range(60):
        middle = (low + high) / 2
        if (p * np.exp(np.minimum(middle * scores, 600))).sum() < 1:
            low = middle
        else:
            high = middle
    return low


def segments(places, gains, drift=DRIFT):
    """All maximal scoring segments (first, last, score) of tokens at `places` with scores `gains`;
    every token between them scores -drift. Linear: each candidate is merged once."""
    found = []  # (first, last, sum before it, sum at its end)
    total, at = 0.0, -1
    for place, gain in zip(places, gains):
        total -= drift * (place - at - 1)
        left, right, first = total, total + gain, place
        total, at = right, place
        while True:
            k = len(found) - 1
            while k >= 0 and found[k][2] >= left:
                k = found[k][4]
            if k < 0 or found[k][3] >= right:
                found.append((first, place, left, right, k))
                break
            first, left = found[k][0], found[k][2]
            del found[k:]
    return [(a, b, r - l) for a, b, l, r, _ in found]


class Model:
    def __init__(self, scores, rate, k, curve):
        self.scores, self.rate, self.k, self.curve = scores, rate, k, curve

    def evidence(self, found, n):
        """Sum of -ln E over the significant segments of a text of n tokens."""
        return sum(max(0.0, self.rate * s - np.log(self.k * n)) for _, _, s in found)

    def score(self, evidence):
        a, b = self.curve
        return 1 / (1 + np.exp(-(a + b * np.minimum(evidence, 100.0))))


def _found(part, k, scores):
    """For each row: number of tokens and segments, with the byte places of all tokens."""
    buckets, starts, ends, first, offsets = _buckets(part, k)
    gains = scores[buckets]
    hits = np.flatnonzero(gains > 0)
    cuts = np.searchsorted(hits, first)
    for i in range(part.num_rows):
        mine = hits[cuts[i]:cuts[i + 1]]
        found = segments((mine - first[i]).tolist(), gains[mine].tolist()) if len(mine) else []
        yield int(first[i + 1] - first[i]), [
            (a, b, s, int(starts[first[i] + a] - offsets[i]), int(ends[first[i] + b] - offsets[i]))
            for a, b, s in found]


def _best(shared):
    def scan(batches):
        for batch in batches:
            for part in pieces(batch):
                data, offsets = utf8(part.column(0))
                _, _, h, first = tokens.words(data, offsets, tokens.ALNUM)
                toxic = part.column(1).to_pylist()
                each = [list(_found(part, 0, scores)) for scores in shared.value]
                rows = [each[int(label)][i] for i, label in enumerate(toxic)]
                yield pa.RecordBatch.from_arrays([
                    pa.array(_classes(h, first)), pa.array([n for n, _ in rows], pa.int64()),
                    pa.array([max([s for _, _, s, _, _ in f], default=0.0) for _, f in rows], pa.float64()),
                    pa.array(toxic, pa.bool_()),
                    pa.array([[s for _, _, s, _, _ in f] for _, f in rows], pa.list_(pa.float64()))],
                    names=["class", "n", "best", "toxic", "found"])
    return scan


def _logistic(x, y, steps=50):
    """Intercept and slope by Newton steps with a slight ridge."""
    beta = np.zeros(2)
    a = np.column_stack([np.ones(len(x)), x])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(a @ beta, -30, 30)))
        gradient = a.T @ (y - p) - 0.01 * beta
        hessian = (a * (p * (1 - p))[:, None]).T @ a + 0.01 * np.eye(2)
        move = np.linalg.solve(hessian, gradient)
        beta += np.clip(move, -2, 2)
        if np.abs(move).max() < 1e-8:
            break
    return float(beta[0]), max(0.0, float(beta[1]))


def fit(documents, labels, sample=SAMPLE):
    spark = documents.sparkSession
    texts = documents.select(column("text").alias("text"))
    background = summed_counters(texts, WIDTH, _background)
    chosen = training_labels(labels, sample)
    rows = stored(documents.select(column("doc_id").alias("doc_id"), column("text").alias("text"))
                  .join(F.broadcast(chosen), F.col("doc_id") == F.col("id"))
                  .select("text", "toxic", F.xxhash64("doc_id", "text").alias("drawn")), "training")
    last = rows.select("drawn").distinct().orderBy("drawn").limit(sample).agg(F.max("drawn")).first()[0]
    rows = rows.where(F.col("drawn") <= F.lit(last)).select("text", "toxic")
    clean, toxic = label_counts(rows)
    if not clean.any() or not toxic.any():
        return Model(np.zeros(WIDTH), 1.0, 1.0, (-100.0, 0.0))
    scores, without = log_odds(background, clean, toxic)
    rate = decay(scores - DRIFT, clean + _prior(background, clean.sum() + toxic.sum()))
    shared = spark.sparkContext.broadcast(without)
    seen = rows.mapInArrow(_best(shared), "class long, n long, best double, toxic boolean, found array<double>")
    # One text of a class, the same whatever the order of the rows.
    seen = seen.groupBy("class", "toxic").agg(F.min(F.struct("n", "found", "best")).alias("one")).select(
        "class", "toxic", "one.*").toPandas().sort_values(["class", "toxic"])
    calm = seen[~seen["toxic"] & (seen["n"] > 0)]
    k = float(np.exp(np.mean(rate * calm["best"] - np.log(calm["n"])) - np.euler_gamma)) if len(calm) else 1.0
    model = Model(scores, rate, max(k, 1e-12), (0.0, 1.0))
    evidence = np.array([min(100.0, model.evidence([(0, 0, s) for s in f], max(n, 1)))
                         for n, f in zip(seen["n"], seen["found"])])
    model.curve = _logistic(evidence, seen["toxic"].to_numpy().astype(float))
    return model


def score(documents, model):
    """(doc_id, held_out, score, passages) of every document; passages with places in bytes and evidence."""
    shared = documents.sparkSession.sparkContext.broadcast(model)
    passage = pa.struct([("start", pa.int64()), ("stop", pa.int64()), ("evidence", pa.float64())])

    def scan(batches):
        for batch in batches:
            m = shared.value
            for part in pieces(batch):
                out, passages = [], []
                for n, found in _found(part, part.schema.get_field_index("text"), m.scores):
                    each = [(start, stop, m.evidence([(0, 0, s)], max(n, 1))) for _, _, s, start, stop in found]
                    out.append(float(m.score(sum(e for _, _, e in each))))
                    passages.append([{"start": a, "stop": b, "evidence": float(e)} for a, b, e in each if e > 0])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(out, pa.float64()),
                     pa.array(passages, pa.list_(passage))], names=["doc_id", "held_out", "score", "passages"])

    rows = documents.select(column("doc_id"), held_out().alias("held_out"), column("text").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {kind}, held_out boolean, score double, "
                                 "passages array<struct<start:long,stop:long,evidence:double>>")


def digest(scored, threshold=THRESHOLD):
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= threshold).cast("int").alias("predicted"),
                         F.size("passages").alias("n_passages"))
