"""N-gram Jaccard join: link documents whose sets of word n-grams overlap enough.

* Documents with the same set are one node (named by a 64-bit hash of the set, checked for clashes).
* N-grams are ordered rare first. How often each occurs is counted over all documents in a counter table of
  fixed width; n-grams that share a counter are ordered by hash. Any total order gives the same links, this
  one keeps frequent passages out of the prefixes.
* Two sets that overlap enough share one of the first n - ceil(t n) + 1 n-grams (prefix filter). Only these
  are shuffled, once, by n-gram. Length and positional filters apply as nodes meet; a suffix filter (counts
  of the n-grams by hash range bound the overlap) before sets are compared. Each pair is compared once.
* N-grams that no other prefix has are not shared by what precedes a common n-gram: a sharper positional filter.
* Large groups never make all pairs. First each n-gram links its nodes to one of them only (of similar
  size, and with the fewest n-grams of its own); the links found make components. Then an n-gram whose nodes all belong to one component has nothing
  left to compare; elsewhere, nodes outside the n-gram's main component meet the nodes of other
  components. Every pair that shares a prefix n-gram is thus compared or already connected.

Texts with fewer words than n are one n-gram; without words the set is empty and linked with
nothing. Null texts are empty. Rows of equal text are in one component; null doc_ids count in
sizes but name no component, so a component of only such rows has a null id. An empty table gives no rows.
Extra columns are kept by `keep_one`; the digest has its own columns only. Intermediate tables and shuffle files go as soon
as they have been read for the last time; what a lazy result reads stays.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.llm import tokens
from tarmac.llm.common import column, drop, packed, pieces, stored, summed_counters, unpacked, utf8
from tarmac.llm.components import connected
from tarmac.session import shuffles_removed

N = 5
PERCENT = 80
WIDTH = 1 << 20
SHIFT = np.uint64(44)
RANGES = 64


def _sets(part, n, text="text"):
    """Rows and hashes of the distinct n-grams, by row and hash; and the size of each row's set."""
    data, offsets = utf8(part.column(part.schema.get_field_index(text)))
    _, _, h, first = tokens.words(data, offsets, tokens.SPACED)
    counts = np.diff(first)
    rows = np.repeat(np.arange(part.num_rows), counts)
    grams = tokens.ngrams(h, n)
    whole = rows[:len(grams)] == rows[len(h) - len(grams):] if len(grams) else np.zeros(0, bool)
    sizes = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    ends = np.cumsum(sizes)
    row, gram = np.repeat(np.arange(part.num_rows), sizes), np.empty(int(sizes.sum()), np.uint64)
    gram[np.repeat(counts >= n, sizes)] = grams[whole]
    for k in range(1, n):
        short = np.flatnonzero(counts == k)
        if len(short):
            gram[ends[short] - 1] = tokens.ngrams(h, k)[first[short]]
    for i in np.flatnonzero(sizes > 1).tolist():
        gram[ends[i] - sizes[i]:ends[i]].sort()
    new = np.ones(len(row), bool)
    new[1:] = (row[1:] != row[:-1]) | (gram[1:] != gram[:-1])
    row, gram = row[new], gram[new]
    return row, gram, np.bincount(row, minlength=part.num_rows)


def _nodes(row, gram, sizes, seed):
    """Two independent 64-bit hashes of each set; sums do not depend on the order."""
    out = []
    for k in (2 * seed + 1, 2 * seed + 2):
        salted = tokens.mixed(gram ^ np.uint64(0x9E3779B97F4A7C15 * k % 2 ** 64))
        ends = np.cumsum(sizes)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(salted)])
        out.append(tokens.mixed(sums[ends] - sums[ends - sizes] + sizes.astype(np.uint64)).view(np.int64))
    return out


def _described(n, seed):
    def scan(batches):
        for batch in batches:
            for part in pieces(batch):
                row, gram, sizes = _sets(part, n)
                node, check = _nodes(row, gram, sizes, seed)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(sizes, pa.int64()), pa.array(node), pa.array(check)],
                    names=[*part.schema.names[:-1], "size", "node", "check"])
    return scan


def _count(n):
    def add(batch, counters):
        for part in pieces(batch):
            _, gram, _ = _sets(part, n)
            counters += np.bincount((gram >> SHIFT).astype(np.int64), minlength=WIDTH)
    return add


def _prefixes(n, percent, seed, frequency):
    """(gram, node, size, place) of every prefix n-gram, each node once a task."""
    def scan(batches):
        seen = set()
        for batch in batches:
            for part in pieces(batch):
                row, gram, sizes = _sets(part, n)
                node, _ = _nodes(row, gram, sizes, seed)
                fresh = np.zeros(len(node), bool)
                for i, x in enumerate(node.tolist()):
                    if sizes[i] and x not in seen:
                        seen.add(x)
                        fresh[i] = True
                often = frequency.value[(gram >> SHIFT).astype(np.int64)]
                heads = np.cumsum(sizes) - sizes
                lengths = np.where(fresh, sizes - -(-percent * sizes // 100) + 1, 0)
                # Sets are sorted by hash: sorting by frequency must keep that order among equals.
                order = [heads[i] + np.argsort(often[heads[i]:heads[i] + sizes[i]], kind="stable")[:lengths[i]]
                         for i in np.flatnonzero(fresh).tolist()]
                gram = gram[np.concatenate(order)] if order else gram[:0]
                row = np.repeat(np.arange(part.num_rows), lengths)
                place = np.arange(len(row)) - (np.cumsum(lengths) - lengths)[row]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), pa.array(node[row]),
                     pa.array(sizes[row].astype(np.int32)), pa.array(place.astype(np.int32))],
                    names=["gram", "node", "size", "place"])
    return scan


def _wanted_sets(n, seed, wanted):
    """(node, grams, ranges) of nodes that pairs may need, each once a task."""
    def scan(batches):
        seen = set()
        for batch in batches:
            for part in pieces(batch):
                row, gram, sizes = _sets(part, n)
                node, _ = _nodes(row, gram, sizes, seed)
                hit = wanted.value[node.view(np.uint64) >> SHIFT] & (sizes > 0)
                ends = np.cumsum(sizes)
                names, sets, ranges = [], [], []
                for i in np.flatnonzero(hit).tolist():
                    if int(node[i]) not in seen:
                        seen.add(int(node[i]))
                        grams = gram[ends[i] - sizes[i]:ends[i]]
                        names.append(int(node[i]))
                        sets.append(grams.tobytes())
                        ranges.append(np.bincount((grams >> np.uint64(58)).astype(np.int64),
                                                  minlength=RANGES).astype(np.int32).tobytes())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.int64()), pa.array(sets, pa.binary()),
                     pa.array(ranges, pa.binary())], names=["node", "grams", "ranges"])
    return scan


def _suffix_filter(percent):
    """Pairs whose counts by hash range leave room for enough overlap."""
    def scan(batches):
        for batch in batches:
            a = np.frombuffer(b"".join(batch.column("ranges_a").to_pylist()), np.int32)
            b = np.frombuffer(b"".join(batch.column("ranges_b").to_pylist()), np.int32)
            a, b = a.reshape(-1, RANGES).astype(np.int64), b.reshape(-1, RANGES).astype(np.int64)
            most = np.minimum(a, b).sum(axis=1)
            both = a.sum(axis=1) + b.sum(axis=1)
            keep = 100 * most >= percent * (both - most)
            yield batch.select(["a", "b"]).filter(pa.array(keep))
    return scan


def _verify(percent):
    def scan(batches):
        for batch in batches:
            keep = []
            for a, b in zip(batch.column("grams_a").to_pylist(), batch.column("grams_b").to_pylist()):
                a, b = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
                common = len(np.intersect1d(a, b, assume_unique=True))
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return scan


def _possible(percent):
    """Length and positional filter for two nodes that share an n-gram at these places.

    What comes before it in a set can only be shared where it is in the other one's prefix as well, so
    the n-grams before it that no other prefix has (`before` counts the rest) bound the overlap.
    """
    a, b, i, j, before, before2 = (F.col(x).cast("long") for x in (
        "size", "size2", "place", "place2", "before", "before2"))
    most = F.least(before, before2) + F.least(a - i, b - j)
    return ((100 * F.least(a, b) >= percent * F.greatest(a, b))
            & ((100 + percent) * most >= percent * (a + b)))


class Join:
    """The steps of one join over a table of documents."""

    def __init__(self, documents, n=N, percent=PERCENT, keys=()):
        """`keys` are columns added to doc_id in what `rooted` gives."""
        self.documents, self.n, self.percent, self.seed = documents, n, percent, 0
        self.named = ["doc_id", *[f"key{i}" for i in range(len(keys))]]
        self.texts = documents.select(column("doc_id").alias("doc_id"), *[
            key.alias(name) for key, name in zip(keys, self.named[1:])], column("text").alias("text"))

    def described(self):
        """(doc_id, keys, size, node, check) of every document; another seed where two sets share a node."""
        kinds = ", ".join(f"{c} {self.texts.schema[c].dataType.simpleString()}" for c in self.named)
        while True:
            df = stored(self.texts.mapInArrow(_described(self.n, self.seed),
                                              f"{kinds}, size long, node long, check long"), "sets")
            clash = df.groupBy("node").agg(F.min("check").alias("x"), F.max("check").alias("y"))
            if clash.where("x <> y").isEmpty():
                return df
            drop(df)
            self.seed += 1

    def prefixes(self):
        spark = self.documents.sparkSession
        texts = self.texts.select("text")
        frequency = summed_counters(texts, WIDTH, _count(self.n))
        shared = spark.sparkContext.broadcast(frequency)
        # Read twice below: stored, so that texts are cut and sorted once.
        rows = stored(texts.mapInArrow(_prefixes(self.n, self.percent, self.seed, shared),
                                       "gram long, node long, size int, place int"), "first")
        often = (rows.groupBy("gram").agg(F.count("*").alias("k")).where("k > 1")
                 .select(F.col("gram").alias("often")))
        # Equal texts of different tasks leave equal rows; distinct() makes them one.
        shared_ = stored(rows.join(often, F.col("gram") == F.col("often"), "left_semi").distinct(),
                         "shared")
        drop(rows)
        own = Window.partitionBy("node")
        out = stored(shared_.withColumns({
            "before": F.row_number().over(own.orderBy("place")) - 1,
            "share": F.count("*").over(own) / F.col("size")}), "prefixes")
        drop(shared_)
        return out

    def links(self, pairs):
        """The pairs (a < b) that overlap enough."""
        pairs = stored(pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
                       .distinct(), "pairs")
        ends = pairs.select(F.col("a").alias("node")).unionByName(pairs.select(F.col("b").alias("node")))

        def mark(batch, counters):
            nodes = batch.column(0).to_numpy().view(np.uint64)
            counters[np.unique(nodes >> SHIFT).astype(np.int64)] += 1

        wanted = summed_counters(ends, WIDTH, mark) > 0
        shared = self.documents.sparkSession.sparkContext.broadcast(wanted)
        sets = stored(self.texts.select("text").mapInArrow(
            _wanted_sets(self.n, self.seed, shared), "node long, grams binary, ranges binary"), "wanted")
        once = sets.dropDuplicates(["node"])

        def both(df, name):
            for end in ("a", "b"):
                side = once.select(F.col("node").alias("key"), F.col(name).alias(f"{name}_{end}"))
                df = df.join(side, F.col(end) == F.col("key")).drop("key")
            return df

        close = both(pairs, "ranges").mapInArrow(_suffix_filter(self.percent), "a long, b long")
        close = stored(close, "close")
        out = stored(both(close, "grams").mapInArrow(_verify(self.percent), "a long, b long"), "links")
        drop(pairs, sets, close)
        return out

    def roots(self):
        """(node, root) of the nodes that are linked to others."""
        rows = self.prefixes()
        level = F.floor(F.log("size") / F.log(F.lit(1.1))).cast("int")
        sized = rows.withColumn("level", level)
        pivots = sized.groupBy("gram", "level").agg(
            F.max(F.struct("share", "node", "size", "place", "before")).alias("p")).select(
            F.col("gram").alias("g"), F.col("level").alias("l"), F.col("p.node").alias("a"),
            F.col("p.size").alias("size2"), F.col("p.place").alias("place2"),
            F.col("p.before").alias("before2"))
        stars = (sized.join(pivots, (F.col("gram") == F.col("g")) & (F.col("level") == F.col("l")))
                 .where(F.col("node") != F.col("a")).where(_possible(self.percent))
                 .select("a", F.col("node").alias("b")))
        first = self.links(stars)
        roots = connected(first)
        named = rows.join(roots.withColumnRenamed("node", "k"), F.col("node") == F.col("k"), "left"
                          ).select("gram", "node", "size", "place", "before",
                                   F.coalesce("root", "node").alias("root"))
        named = stored(named, "named")
        drop(rows)
        mixed = (named.groupBy("gram", "root").agg(F.count("*").alias("n"))
                 .groupBy("gram").agg(F.max(F.struct("n", "root")).alias("main"), F.count("*").alias("k"))
                 .where("k > 1").select(F.col("gram").alias("g"), F.col("main.root").alias("main")))
        open_ = named.join(mixed, F.col("gram") == F.col("g")).drop("g")
        left = open_.where("root <> main").select("gram", "node", "size", "place", "before", "root")
        right = open_.select(
            F.col("gram").alias("gram2"), F.col("node").alias("node2"), F.col("size").alias("size2"),
            F.col("place").alias("place2"), F.col("before").alias("before2"),
            F.col("root").alias("root2"), F.col("main").alias("main2"))
        meet = left.join(right, (F.col("gram") == F.col("gram2")) & (F.col("root") != F.col("root2"))
                         & ((F.col("root2") == F.col("main2")) | (F.col("node") < F.col("node2")))
                         & _possible(self.percent))
        second = self.links(meet.select(F.col("node").alias("a"), F.col("node2").alias("b")))
        drop(named)
        if not second.isEmpty():
            drop(roots)
            roots = connected(first.unionByName(second))
        drop(first, second)
        return roots

    def rooted(self):
        """(doc_id, keys, n_shingles, root) of every document; null roots are those of empty sets."""
        with shuffles_removed(self.documents.sparkSession):
            docs = self.described()
            roots = self.roots()
            named = docs.join(roots.withColumnRenamed("node", "k"), F.col("node") == F.col("k"), "left").select(
                *self.named, F.col("size").alias("n_shingles"),
                F.when(F.col("size") > 0, F.coalesce("root", "node")).alias("root"))
            out = stored(named, "rooted")
        drop(docs, roots)
        return out

    def result(self):
        """(doc_id, n_shingles, component_id) of every document."""
        named = self.rooted()
        least = named.where(F.col("root").isNotNull()).groupBy(F.col("root").alias("k")).agg(
            F.min("doc_id").alias("least"))
        return named.join(least, F.col("root") == F.col("k"), "left").select(
            "doc_id", "n_shingles", F.when(F.col("root").isNull(), F.col("doc_id"))
            .otherwise(F.col("least")).alias("component_id"))


def join(documents, n=N, percent=PERCENT):
    """(doc_id, n_shingles, component_id) of every document."""
    return Join(documents, n, percent).result()


def row_key():
    """A digest of doc_id and text, null and empty ids apart."""
    doc = column("doc_id").cast("string")
    return F.unhex(F.md5(F.concat(F.when(doc.isNull(), F.lit("-")).otherwise(F.concat(F.length(doc), F.lit(" "), doc)),
                                  F.lit("\n"), F.coalesce(column("text"), F.lit(""))).cast("binary")))


def keep_one(documents, n=N, percent=PERCENT):
    """One row of each component, and all rows without words.

    The least doc_id stays, nulls last; of rows that share it the least digest of the text, and of equal
    texts the least row. Rows of one doc_id with unlike texts are in components of their own.
    """
    found = Join(documents, n, percent, [row_key()]).rooted()
    chosen = found.where(F.col("root").isNotNull()).groupBy("root").agg(F.min(F.struct(
        F.col("doc_id").isNull().alias("none"), "doc_id", "key0")).alias("first")).select(
        F.col("first.key0").alias("chosen"))
    chosen = stored(chosen, "chosen")
    drop(found)
    rows = documents.select(packed(documents), row_key().alias("key"),
                            F.regexp_like(F.coalesce(column("text"), F.lit("")),
                                          F.lit(r"[^\x20\x09-\x0D]")).alias("has_words"))
    kept = rows.where("has_words").join(chosen, F.col("key") == F.col("chosen"), "left_semi")
    once = kept.groupBy("key").agg(F.min("row").alias("row")).select("row")
    rest = rows.where(~F.col("has_words")).select("row")
    return unpacked(once.unionByName(rest), documents.columns)


def brute_force(texts, n=N, percent=PERCENT):
    """In plain Python, for rows (doc_id, text): (doc_id, set size, component)."""
    import re
    fold = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    sets = []
    for _, text in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(fold))
        sets.append({tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1))} if w else set())
    root = list(range(len(texts)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                root[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(texts):
        if doc is not None:
            least[top(i)] = min(doc, least.get(top(i), doc))
    return [(doc, len(sets[i]), least.get(top(i)) if sets[i] else doc)
            for i, (doc, _) in enumerate(texts)]
