"""Merkle manifest of a table of documents: a tree of digests for each source, one tree over the sources.

* A leaf is the digest of a document's fields. Leaves of a source ascend by doc_id (nulls first); rows of one doc_id
  by their leaf, so equal rows are interchangeable. Places come from a range sort and offsets of the ranges,
  so a source may hold any share of the rows.
* A superblock is a run of 3^8 consecutive nodes of a tree. Each is reduced by eight levels in a task
  (fewer where the tree ends); its result is a node of the next round, until every tree is one node. The subroots
  of the sources are the leaves of one more tree, reduced the same way.
* Then the proofs go down again: the nodes of a superblock and the path from its own root to the top (a few
  siblings a level) are cogrouped, and one pass over the superblock finishes local reduction, joins the proofs
  and folds them with the leaf that is to be checked.

A group never has more than 3^8 nodes and a path. Null fields are `-`; a null doc_id is never tampered with; equal rows have
equal leaves, each in its own place, and proofs that may differ. An empty table gives no rows; a single document is subroot
and root at once, with the digest of nothing as proof. Extra columns are ignored.
"""

import hashlib

import pandas as pd
from pyspark.sql import functions as F

from tarmac.llm.common import column, stored
from tarmac.llm.places import placed, runs, sorted_rows

ARITY = 3
LEVELS = 8
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(fields):
    """Digest of some columns: `-` for null, else the length in bytes, a colon and the value."""
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-"))
                             for f in (c.cast("string") for c in fields)]), 256)


def without_line_ends(documents):
    """The tampered text: rows whose checksum of the doc_id is even lose their line ends."""
    text = column("text")
    even = F.crc32(column("doc_id").cast("string")) % 2 == 0
    return F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def leaves(documents, tampered=None):
    """(doc_id, source, leaf, checked, row): `checked` is the leaf of the text to be verified."""
    fields = [column(c) for c in FIELDS]
    tampered = without_line_ends(documents) if tampered is None else tampered
    df = documents.select(column("doc_id").alias("doc_id"), column("source").alias("source"),
                          leaf_of(fields).alias("leaf"),
                          F.when(~tampered.eqNullSafe(column("text")), leaf_of([*fields[:-1], tampered])).alias("other"))
    return stored(df.select("doc_id", "source", "leaf", F.coalesce("other", "leaf").alias("checked"),
                            F.monotonically_increasing_id().alias("row")), "leaves")


def depth(n):
    """Levels above n leaves."""
    levels = 0
    while n > 1:
        n, levels = -(-n // ARITY), levels + 1
    return levels


def climbed(nodes, levels):
    """The nodes and each of the `levels` above them."""
    out = [nodes]
    for _ in range(levels):
        below = out[-1]
        out.append([digest("".join(below[i:i + ARITY])) for i in range(0, len(below), ARITY)])
    return out


def steps(level, i):
    """What stands left and right of a node in its run."""
    first = i - i % ARITY
    return "".join(level[first:i]), "".join(level[i + 1:first + ARITY])


def paths(levels, top):
    """For each node of the lowest level its steps to the root, `top` being those of the highest one."""
    found = [top]
    for level in reversed(levels[:-1]):
        found = [(steps(level, i), *found[i // ARITY]) for i in range(len(level))]
    return found


def folded(node, path):
    for left, right in path:
        node = digest(left + node + right)
    return node


def _written(path):
    return ";".join(f"{left},{right}" for left, right in path)


def _read(text):
    return tuple(tuple(step.split(",")) for step in text.split(";")) if text else ()


def _block(levels):
    return F.floor(F.col("idx") / F.lit(ARITY ** levels)).cast("long").alias("block")


def _ordered(rows, levels):
    rows = rows.sort_values("idx").reset_index(drop=True)
    return rows, climbed(rows["node"].tolist(), min(levels, depth(int(rows["total"][0]))))


def reduced(nodes, levels=LEVELS):
    """(tree, idx, total, node) of the superblocks' roots."""
    def reduce(key, rows):
        rows, tree = _ordered(rows, levels)
        return pd.DataFrame({"tree": [key[0]], "idx": [key[1]],
                             "total": [-(-int(rows["total"][0]) // ARITY ** levels)], "node": tree[-1]})

    blocks = nodes.select("tree", "idx", "total", "node").groupBy("tree", _block(levels))
    return stored(blocks.applyInPandas(reduce, "tree long, idx long, total long, node string"), "superblocks")


def rounds(nodes, levels=LEVELS):
    """The nodes, their superblocks' roots, those of the next round and so on until each tree is one node."""
    out = [nodes]
    while (out[-1].agg(F.max("total").alias("n")).first()["n"] or 1) > 1:
        out.append(reduced(out[-1], levels))
    return out


def exchanged(nodes, outer, finish, shape, levels=LEVELS):
    """Superblocks cogrouped with the path above their root; `finish(rows, paths, outer row)` makes the result."""
    def join(rows, above):
        if not len(rows):
            return finish(rows, [], None)
        rows, tree = _ordered(rows, levels)
        above = above.iloc[0]
        return finish(rows, paths(tree, _read(above["path"])), above)

    inner = nodes.withColumn("block", _block(levels)).groupBy("tree", "block")
    return inner.cogroup(outer.groupBy("tree", "idx")).applyInPandas(join, shape)


def _outer(rows, found, above):
    out = rows[["tree", "idx"]].assign(path=[_written(p) for p in found])
    for name in ("subroot", "root"):
        out[name] = above[name] if len(rows) else ""
    return out


def downward(levels_of_nodes, outer, levels=LEVELS):
    """Paths of the nodes of the second round, given those of the last one."""
    for nodes in reversed(levels_of_nodes[1:-1]):
        outer = stored(exchanged(nodes, outer, _outer, "tree long, idx long, path string, subroot string, root string",
                                 levels), "paths")
    return outer


def _finished(rows, found, above):
    out = pd.DataFrame({"doc": rows["doc"], "leaf": rows["node"]})
    out["subroot"] = above["subroot"] if len(rows) else ""
    out["root"] = above["root"] if len(rows) else ""
    out["proof_sha256"] = [digest("".join(left + right for left, right in p)) for p in found]
    out["folded_root"] = [folded(node, p) for node, p in zip(rows["checked"], found)]
    out["verified"] = out["folded_root"] == out["root"]
    return out


def manifest(documents, tampered=None, levels=LEVELS):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every document."""
    rows = sorted_rows(leaves(documents, tampered), "source", ["doc_id", "leaf", "row"])
    of_sources = runs(rows, "source")
    sources = sorted_rows(of_sources.groupBy("source").agg(F.lit(0).cast("long").alias("all")), "all", ["source"])
    sources = placed(sources, runs(sources, "all"), "all")
    trees = of_sources.join(sources.select(F.col("source").alias("named"), F.col("idx").alias("tree")),
                            F.col("source").eqNullSafe(F.col("named"))).drop("named")
    nodes = stored(placed(rows, trees, "source", ["tree"]).select(
        "tree", "idx", "total", F.col("leaf").alias("node"), "checked", F.col("doc_id").cast("string").alias("doc")), "nodes")
    up = rounds(nodes, levels)
    subroots = up[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), "node")
    subroots = stored(subroots.withColumn("total", F.lit(up[-1].count()).cast("long")), "subroots")
    top = rounds(subroots, levels)
    outer = top[-1].select("tree", "idx", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("node").alias("root"))
    outer = downward(top, outer, levels)
    outer = stored(exchanged(subroots, outer, _outer,
                             "tree long, idx long, path string, subroot string, root string", levels), "sources")
    outer = outer.select(F.col("idx").alias("tree"), F.lit(0).cast("long").alias("idx"), "path", "root").join(
        up[-1].select("tree", F.col("node").alias("subroot")), "tree").select("tree", "idx", "path", "subroot", "root")
    outer = downward(up, outer, levels)
    found = exchanged(nodes, outer, _finished, "doc string, leaf string, subroot string, root string, "
                      "proof_sha256 string, folded_root string, verified boolean", levels)
    return found.select(F.col("doc").cast(documents.schema["doc_id"].dataType).alias("doc_id"), *found.columns[1:])


def brute_force(rows):
    """In plain Python, for rows (doc_id, source, lang, n_chars, text): the rows of the manifest."""
    import zlib

    def leaf(*fields):
        return digest("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append(climbed(levels[-1], 1)[1])
        return levels

    def way(levels, i):
        out = []
        for level in levels[:-1]:
            out.append(steps(level, i))
            i //= ARITY
        return tuple(out)

    by = {}
    for row in rows:
        by.setdefault(row[1], []).append((row[0] is not None, row[0] or 0, leaf(*row), row))
    order = sorted(by, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: tree([x[2] for x in sorted(by[s], key=lambda x: x[:3])]) for s in order}
    whole = tree([trees[s][-1][0] for s in order])
    out = []
    for k, s in enumerate(order):
        for i, (_, _, own, row) in enumerate(sorted(by[s], key=lambda x: x[:3])):
            path = way(trees[s], i) + way(whole, k)
            text = row[4]
            if row[0] is not None and text is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                text = text.replace("\n", "")
            back = folded(leaf(*row[:4], text), path)
            out.append((row[0], own, trees[s][-1][0], whole[-1][0], digest("".join(a + b for a, b in path)),
                        back, back == whole[-1][0]))
    return out
