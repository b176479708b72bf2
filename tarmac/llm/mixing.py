"""Mix sources to target weights, with exact quotas per output shard.

Sizes are word counts. Sources by code point (null last) weigh 1, 2, 3, 1, 2, 3 ...; together they share
all words, but no source more than `REPEAT` times its own; what is above goes to the others by weight.

* Rows of a source fall into `BLOCKS` blocks by a hash of their doc_id (hash order is the random
  permutation). A source of any size thus has at most that many blocks, and one block is a small share of it.
* A source taken f times its size gives every block floor(f) times, and in a last pass so many blocks that their
  words come nearest to the rest: blocks are taken in permuted order, leaving out those that don't fit.
* The numbers of blocks taken from each source (its quota) are split among the shards by a tree: at every
  node a multivariate hypergeometric draw says how many blocks of each source go to the left half of
  the shards. Each leaf knows its exact quotas; the permuted blocks of a source are dealt to
  the leaves in runs of these lengths, so blocks are disjoint. Rows are shuffled inside their shard.

* The tree is built for `RANGE` sources at a time (their blocks are spread evenly by a tree of their own), so there may be any
  number of sources and nothing about them passes through the driver but the level at which targets are shared.

Block and quota tables have at most (sources x BLOCKS) and (sources x shards) rows whatever the number of
documents. Hot sources are pre-aggregated by block before anything is shuffled. Texts meet the plan of the blocks by
broadcast where it has `PLAN_ROWS` rows at most (its size is checked), else by a shuffle of both.

Null or empty texts have size 0 and follow their block. Rows with equal or null doc_id share a block and a fate.
An empty table gives an empty mix. Equal input and seed give the same mix, whatever the partitioning. Extra columns
are kept; columns named like an added one are replaced.
"""

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm import tokens
from tarmac.llm.common import column, packed, pieces, stored, unpacked, utf8
from tarmac.llm.places import placed, runs, sorted_rows

WEIGHTS = (1, 2, 3)
REPEAT = 3
BLOCKS = 4096
SHARDS = 64
SEED = 42
#: Sources that share one splitting tree: with all their copies they stay below what one draw can take.
RANGE = 4096
#: The plan of the blocks is broadcast up to this number of rows, about 100 bytes each.
PLAN_ROWS = 1 << 18
#: Permutations tried to come within a thousandth of a target that few blocks must make up.
TRIES = 16


def _block(seed, blocks):
    return F.pmod(F.xxhash64(F.lit(seed), column("doc_id")), F.lit(blocks)).cast("int")


def sizes(documents, seed=SEED, blocks=BLOCKS):
    """(doc_id, source, block, size) of every document."""
    def count(batches):
        for batch in batches:
            for part in pieces(batch):
                data, offsets = utf8(part.column(part.schema.get_field_index("text")))
                counts = tokens.count_words(data, offsets, tokens.SPACED)
                yield pa.RecordBatch.from_arrays(
                    [part.column(part.schema.get_field_index(c)) for c in ("doc_id", "source", "block")]
                    + [pa.array(counts, pa.int64())], names=["doc_id", "source", "block", "size"])

    slim = documents.select(column("doc_id"), column("source"), column("text"),
                            _block(seed, blocks).alias("block"))
    shape = T.StructType([*slim.select("doc_id", "source", "block").schema.fields,
                          T.StructField("size", T.LongType())])
    return slim.mapInArrow(count, shape)


def targets(totals, weights=WEIGHTS, repeat=REPEAT):
    """Words to take of each source, in plain Python. `totals`: words per source, in the order of the weights."""
    totals = np.asarray(totals, np.float64)
    shares = np.resize(np.asarray(weights, np.float64), len(totals))
    out = np.zeros(len(totals))
    free = totals > 0
    rest = totals.sum()
    while free.any():
        level = rest / shares[free].sum()
        full = free & (level * shares > repeat * totals)
        if not full.any():
            out[free] = level * shares[free]
            break
        out[full] = repeat * totals[full]
        rest -= out[full].sum()
        free &= ~full
    return out


def catalogue(per_block, weights=WEIGHTS, repeat=REPEAT):
    """(source, number, source_size, target) of every source; numbers follow the code points, null is last."""
    per_source = per_block.groupBy("source").agg(F.sum("words").cast("long").alias("source_size")).withColumns(
        {"none": F.col("source").isNull(), "all": F.lit(0)})
    rows = sorted_rows(per_source, "all", ["none", "source"])
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("idx") % len(weights) + 1).cast("int"))
    sources = stored(placed(rows, runs(rows, "all"), "all").select(
        "source", F.col("idx").alias("number"), "source_size", weight.alias("weight")), "sources")
    most = repeat * F.col("source_size")
    level, capped = 0.0, -1
    while True:
        full = F.lit(level) * F.col("weight") > most
        seen = sources.where("source_size > 0").agg(
            F.count_if(full).alias("capped"), F.sum("source_size").alias("all"), F.sum(F.when(full, most)).alias("taken"),
            F.sum(F.when(~full, F.col("weight"))).alias("free")).first()
        if seen["capped"] == capped or not seen["free"]:
            break
        level, capped = (seen["all"] - (seen["taken"] or 0)) / seen["free"], seen["capped"]
    target = F.least(F.lit(level) * F.col("weight"), most.cast("double"))
    return sources.select("source", "number", "source_size", target.alias("target"))


def splitting_tree(quotas, shards, seed=SEED, part=0):
    """Blocks of each source (columns) for each shard (rows); column sums are the quotas.

    A node with k shards sends half of its blocks, in proportion to its halves of shards, to the left.
    """
    quotas = np.asarray(quotas, np.int64)
    out = np.zeros((shards, len(quotas)), np.int64)
    nodes = [(0, shards, quotas)]
    while nodes:
        low, high, have = nodes.pop()
        if high - low == 1 or not have.any():
            out[low] = have
            continue
        middle = (low + high) // 2
        total = int(have.sum())
        draw = np.random.default_rng([seed, low, high, part] if part else [seed, low, high])
        share = total * (middle - low)
        left_total = share // (high - low) + int(draw.integers(high - low) < share % (high - low))
        left = draw.multivariate_hypergeometric(have, left_total, method="marginals")
        nodes += [(low, middle, left), (middle, high, have - left)]
    return out


def _choose(words, order, goal):
    """Blocks (as booleans) whose words come near `goal`, taken in the given order."""
    taken = np.zeros(len(words), bool)
    rest = goal
    for i in order:
        if 0 < words[i] <= rest:
            taken[i] = True
            rest -= words[i]
    left = np.flatnonzero(~taken & (words > 0))
    if len(left):
        i = left[np.argmin(words[left])]
        if abs(rest - words[i]) < rest:
            taken[i] = True
    return taken


def plan(per_block, weights=WEIGHTS, repeat=REPEAT, shards=SHARDS, seed=SEED):
    """From (source, block, words): (source, block, source_size, target, shards: where copies go)."""
    numbered = stored(catalogue(per_block, weights, repeat), "catalogue")
    joined = (per_block.withColumnRenamed("source", "key")
              .join(numbered, F.col("key").eqNullSafe(F.col("source"))).drop("key"))

    def passes(rows):
        rows = rows.sort_values("block").reset_index(drop=True)
        words = rows["words"].to_numpy()
        size, goal = int(rows["source_size"][0]), float(rows["target"][0])
        whole = min(int(goal // size), repeat) if size else 0
        rest = goal - whole * size
        draw = np.random.default_rng([seed, int(rows["number"][0])])
        for _ in range(TRIES):
            order = draw.permutation(len(words))
            last = _choose(words, order, rest)
            if abs(words[last].sum() - rest) <= goal / 1000:
                break
        if whole >= repeat:
            last[:] = False
        rows["times"] = whole + last.astype(np.int64)
        rows["rank"] = np.argsort(order)
        return rows[["number", "block", "source_size", "target", "times", "rank"]]

    chosen = stored(joined.groupBy("number").applyInPandas(
        passes, "number long, block int, source_size long, target double, times long, rank long"),
        "blocks")
    def split(key, rows):
        """Where the copies of each source end, shard by shard."""
        rows = rows.sort_values("number")
        ends = np.cumsum(splitting_tree(rows["times"].to_numpy(), shards, seed, int(key[0])), axis=0)
        return pd.DataFrame({"number": rows["number"].to_numpy(), "ends": list(ends.T)})

    quota = chosen.groupBy("number").agg(F.sum("times").cast("long").alias("times"))
    edges = quota.groupBy(F.floor(F.col("number") / RANGE).alias("part")).applyInPandas(
        split, "number long, ends array<long>")

    def deal(rows, ends):
        """Copies of a source's blocks in permuted order, in runs as long as the leaves' quotas."""
        rows = rows.sort_values("rank").reset_index(drop=True)
        copies = np.repeat(np.arange(len(rows)), rows["times"])
        number = int(rows["number"][0])
        turn = np.random.default_rng([seed, number, 1]).permutation(len(copies))
        shard = np.searchsorted(np.asarray(ends["ends"][0]), turn, side="right")
        held = [[] for _ in range(len(rows))]
        for i, s in zip(copies.tolist(), shard.tolist()):
            held[i].append(s)
        rows["shards"] = held
        return rows[["number", "block", "source_size", "target", "shards"]]

    dealt = chosen.groupBy("number").cogroup(edges.groupBy("number")).applyInPandas(
        deal, "number long, block int, source_size long, target double, shards array<int>")
    # Stored, so that its size is known before texts are joined with it.
    return stored(dealt.join(numbered.select("source", "number"), "number").drop("number"), "plan")


def _planned(slim, weights, repeat, shards, seed):
    per_block = slim.groupBy("source", "block").agg(F.sum("size").cast("long").alias("words"))
    plans = plan(per_block, weights, repeat, shards, seed)
    small = plans.count() <= PLAN_ROWS
    plans = plans.select(F.col("source").alias("plan_source"), F.col("block").alias("plan_block"),
                         "source_size", "target", "shards")
    return F.broadcast(plans) if small else plans


def assign(documents, weights=WEIGHTS, repeat=REPEAT, shards=SHARDS, seed=SEED, blocks=BLOCKS):
    """(doc_id, source, size, source_size, target, shards) of every document: a shard per copy taken."""
    slim = stored(sizes(documents, seed, blocks), "sizes")
    plans = _planned(slim, weights, repeat, shards, seed)
    return slim.join(plans, F.col("source").eqNullSafe(F.col("plan_source"))
                     & (F.col("block") == F.col("plan_block"))).select(
        "doc_id", "source", "size", "source_size", "target", "shards")


def mix(documents, weights=WEIGHTS, repeat=REPEAT, shards=SHARDS, seed=SEED, blocks=BLOCKS):
    """The mixed corpus: documents with `shard` and `place` in it, a row per copy taken.

    Rows of a shard are in one partition, in the order of `place`. Documents without words are in it, too.
    """
    slim = stored(sizes(documents, seed, blocks), "sizes")
    plans = _planned(slim, weights, repeat, shards, seed)
    rows = documents.select(packed(documents), column("source").alias("of"),
                            _block(seed, blocks).alias("block"))
    copies = rows.join(plans, F.col("of").eqNullSafe(F.col("plan_source"))
                       & (F.col("block") == F.col("plan_block"))).select(
        "row", "block", F.posexplode("shards").alias("copy", "shard"))
    place = F.xxhash64(F.lit(seed), "shard", "copy", F.col("row").getField("doc_id"))
    out = (copies.withColumn("place", place).repartition(shards, "shard")
           .sortWithinPartitions("shard", "place", "copy"))
    return unpacked(out, documents.columns, added=["shard", "place"])


def digest(assigned):
    return assigned.select("doc_id", "size", "source_size", "target",
                           (F.col("size") * F.size("shards")).cast("long").alias("taken"))
