"""Remove every byte that lies in a string of `W` bytes found at two places or more.

A sorted suffix array would put equal strings side by side; only their equality is needed here, so suffixes are
compared by hash and the shuffle takes the place of the merge sort:

* Anchors: in every window of W bytes the K-byte string with the smallest hash. Equal windows have the same anchor
  at the same offset. The windows of one anchor are consecutive: a run. There are about 2 / (W - K) anchors a byte.
* A run whose anchor occurs once holds nothing repeated. A run whose whole stretch is found twice is repeated throughout:
  polynomial prefix hashes give the stretch's hash, and a digest of its bytes verifies it, since powers modulo 2^64 make
  some unlike strings collide whatever their base (Thue-Morse words do). What is left are the ends of repeated passages.
* There the common extension is searched in two fixed steps: windows in blocks of `BLOCK` offsets share a core and lie in
  a hull. A hull found twice: all repeated. A core found once: none. Windows of the other blocks are compared one by
  one. These comparisons use 128-bit digests of the bytes themselves; whole runs count as equal when the 64-bit hashes of
  anchor and stretch agree, so there a clash of both would remove bytes that occur once.

Strings are judged on the input: counting is by rows, so equal texts in two rows repeat each other, and matches never
cross rows. Rows meet by hash only, in counts and joins; no group is gathered. Null texts are empty; texts below W
bytes lose nothing, and an empty table gives an empty result. Removing may cut characters in half: kept bytes are returned as they are, and texts decode
them without broken characters. Extra columns are kept; columns named like an added one are replaced.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tarmac.llm import tokens
from tarmac.llm.common import column, packed, pieces, stored, unpacked, utf8

W = 400
K = 32
BLOCK = 16
CHUNK = 1 << 20
_MASK = np.uint64((1 << 21) - 1)
_VALUES = np.random.default_rng(11).integers(1, 2 ** 63, 256, dtype=np.uint64)
_ID = ["id1", "id2"]


def _identified(documents, keep=()):
    """Texts with two 64-bit hashes of them; rows of equal text are alike in everything that follows."""
    text = F.coalesce(column("text"), F.lit(""))
    return documents.select(*keep, F.xxhash64(text).alias("id1"),
                            F.xxhash64(F.lit(1), text).alias("id2"), text.alias("text"))


def _least(values, m):
    """Smallest of every m consecutive values."""
    n = len(values)
    blocks = np.full(-(-n // m) * m, np.iinfo(np.uint64).max, np.uint64)
    blocks[:n] = values
    blocks = blocks.reshape(-1, m)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n - m + 1], ahead[m - 1:n])


def _runs(data, offsets, w=W, k=K, chunk=CHUNK):
    """Row, anchor, first and last window start (within the row), hashes of anchor and stretch, digest of the stretch."""
    rows = np.repeat(np.arange(len(offsets) - 1, dtype=np.int32), np.diff(offsets))
    out = []
    for c in range(0, max(len(data) - w + 1, 0), chunk):
        d = data[c:c + chunk + w - 1]
        n = len(d)
        up, down = tokens._power(n + 1)
        sums = np.zeros(n + 1, np.uint64)
        np.cumsum(_VALUES[d] * up[:n], out=sums[1:])
        gram = tokens.mixed((sums[k:] - sums[:-k]) * down[:n - k + 1])
        marked = (gram & ~_MASK) | np.arange(len(gram), dtype=np.uint64)
        anchor = (_least(marked, w - k + 1) & _MASK).astype(np.int64)
        row = rows[c:c + len(anchor)]
        whole = rows[c + w - 1:c + w - 1 + len(anchor)] == row
        new = np.ones(len(anchor), bool)
        new[1:] = (anchor[1:] != anchor[:-1]) | (row[1:] != row[:-1]) | (whole[1:] != whole[:-1])
        first = np.flatnonzero(new)
        last = np.append(first[1:], len(anchor)) - 1
        first, last = first[whole[first]], last[whole[first]]
        at = anchor[first]
        stretch = tokens.mixed((sums[last + w] - sums[first]) * down[first])
        stretch = tokens.mixed(stretch + (at - first).astype(np.uint64) * np.uint64(2 ** 40 + 15))
        raw = d.tobytes()
        proof = np.frombuffer(b"".join(_proof(raw[a:b + w]) for a, b in zip(first.tolist(), last.tolist())), np.int64)
        base = offsets[row[first]] - c
        out.append((row[first], at - base, first - base, last - base, gram[at], stretch, proof))
    if not out:
        return [np.zeros(0, np.int64)] * 4 + [np.zeros(0, np.uint64)] * 2 + [np.zeros(0, np.int64)]
    return [np.concatenate(x) for x in zip(*out)]


def _proof(raw):
    return hashlib.blake2b(raw, digest_size=8).digest()


def _scan(w, k, chunk):
    def scan(batches):
        for batch in batches:
            for part in pieces(batch):
                data, offsets = utf8(part.column(2))
                row, at, first, last, gram, stretch, proof = _runs(data, offsets, w, k, chunk)
                ids = [part.column(i).to_numpy()[row] for i in (0, 1)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[0]), pa.array(ids[1]), pa.array(gram.view(np.int64)),
                     pa.array(stretch.view(np.int64)), pa.array(proof)]
                    + [pa.array(x.astype(np.int32)) for x in (at, first, last)],
                    names=["id1", "id2", "gram", "stretch", "proof", "at", "first", "last"])
    return scan


def _surroundings(w):
    """The bytes around the anchors of open runs: all that their windows and hulls hold."""
    def scan(batches):
        for batch in batches:
            rows = {"id1": [], "id2": [], "at": [], "first": [], "last": [], "start": [], "bytes": []}
            for i in range(batch.num_rows):
                raw = batch.column(2)[i].as_py().encode()
                merged = {}  # a run cut by a chunk's end is one again, else its place would count twice
                for run in batch.column(3)[i].as_py():
                    old = merged.setdefault(run["at"], run)
                    old["first"] = min(old["first"], run["first"])
                    old["last"] = max(old["last"], run["last"])
                for run in merged.values():
                    low = max(0, run["first"] - BLOCK)
                    rows["id1"].append(batch.column(0)[i].as_py())
                    rows["id2"].append(batch.column(1)[i].as_py())
                    for name in ("at", "first", "last"):
                        rows[name].append(run[name])
                    rows["start"].append(low)
                    rows["bytes"].append(raw[low:run["last"] + BLOCK + w])
                    if len(rows["at"]) == 4096:
                        yield pa.RecordBatch.from_pydict(rows, schema=_AROUND)
                        rows = {name: [] for name in rows}
            yield pa.RecordBatch.from_pydict(rows, schema=_AROUND)
    return scan


_AROUND = pa.schema([("id1", pa.int64()), ("id2", pa.int64()), ("at", pa.int32()), ("first", pa.int32()),
                     ("last", pa.int32()), ("start", pa.int32()), ("bytes", pa.binary())])


def _digest(kind, offset, raw):
    return hashlib.blake2b(raw, digest_size=16, person=b"%d:%d" % (kind, offset)).digest()


_ROWS = pa.schema([("run", pa.int64()), ("block", pa.int32()), ("core", pa.binary()), ("hull", pa.binary())])
_KINDS = "run long, block int, core binary, hull binary"


def _emit(batches, each):
    for batch in batches:
        rows = []
        for row in batch.to_pylist():
            rows += each(row)
            if len(rows) > 20_000:
                yield pa.RecordBatch.from_pylist(rows, schema=_ROWS)
                rows = []
        yield pa.RecordBatch.from_pylist(rows, schema=_ROWS)


def _blocks(w):
    """Digests of core and hull of every block of offsets of a run; a hull beyond the text is null."""
    def each(row):
        raw, start, at = row["bytes"], row["start"], row["at"]
        for block in range((at - row["last"]) // BLOCK, (at - row["first"]) // BLOCK + 1):
            high = at - block * BLOCK - start          # the last window's start
            low = high - BLOCK + 1                     # the first one's
            inside = low >= 0 and high + w <= len(raw)
            yield {"run": row["run"], "block": block,
                   "core": _digest(0, block, raw[max(high, 0):low + w]),
                   "hull": _digest(1, block, raw[low:high + w]) if inside else None}

    return lambda batches: _emit(batches, each)


def _windows(w):
    """Digests of the windows of open blocks; `block` is the offset."""
    def each(row):
        raw, start, at = row["bytes"], row["start"], row["at"]
        for block in row["open"]:
            for offset in range(max(block * BLOCK, at - row["last"]),
                                min(block * BLOCK + BLOCK - 1, at - row["first"]) + 1):
                low = at - offset - start
                yield {"run": row["run"], "block": offset,
                       "core": _digest(2, offset, raw[low:low + w]), "hull": None}

    return lambda batches: _emit(batches, each)


def _often(rows, key):
    """The rows whose key is there twice or more. The keys are stored first: a join whose sides both
    come straight from a shuffle is one that Spark can split where a key is frequent."""
    twice = stored(rows.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")
                   .select(F.col(key).alias("often")), "often")
    return rows.join(twice, F.col(key) == F.col("often"), "left_semi")


def _settled(rows, key, part, one):
    """Of rows with a repeated `key`: those whose `part` (some columns) is repeated too, and what stays open.

    Where some part of a key is there once, one row of each of its other parts stays open as well, as
    the others' possible partner. Rows return with the columns of the struct `one`.
    """
    names = [key, *part]
    groups = stored(rows.groupBy(*names).agg(F.count("*").alias("n"), F.min(one).alias("one")), "groups")
    whole = rows.join(groups.where("n > 1").select(*[F.col(c).alias(f"same_{c}") for c in names]),
                      [F.col(c) == F.col(f"same_{c}") for c in names], "left_semi")
    partly = stored(groups.where("n = 1").select(F.col(key).alias("k")).distinct(), "partly")
    return whole, groups.join(partly, F.col(key) == F.col("k"), "left_semi").select("one.*")


def ranges(documents, w=W, k=K, chunk=CHUNK):
    """(id1, id2, covered): for each text the first and last starts of repeated windows. A task scans `chunk` bytes at
    a time, a million at most."""
    texts = _identified(documents)
    runs = stored(texts.mapInArrow(_scan(w, k, min(chunk, CHUNK)), "id1 long, id2 long, gram long, stretch long, proof long, "
                                                                   "at int, first int, last int"), "runs")
    again = stored(_often(runs, "gram"), "again")
    whole, open_ = _settled(again, "gram", ["stretch", "proof"], F.struct(*_ID, "at", "first", "last"))
    open_ = open_.groupBy(F.col("id1").alias("i1"), F.col("id2").alias("i2")).agg(
        F.collect_set(F.struct("at", "first", "last")).alias("open"))
    near = texts.join(open_, (F.col("id1") == F.col("i1")) & (F.col("id2") == F.col("i2"))).select(
        *_ID, "text", "open")
    around = stored(near.mapInArrow(_surroundings(w), "id1 long, id2 long, at int, first int, last int, "
                                                      "start int, bytes binary")
                    .withColumn("run", F.monotonically_increasing_id()), "around")
    blocks = stored(_often(around.mapInArrow(_blocks(w), _KINDS), "core"), "blocks").withColumn(
        "hull", F.coalesce("hull", F.concat_ws(":", F.col("run").cast("string"), F.col("block").cast("string")).cast("binary")))
    sure, open_blocks = _settled(blocks, "core", ["hull"], F.struct("run", "block"))
    open_blocks = open_blocks.groupBy(F.col("run").alias("r")).agg(F.collect_set("block").alias("open"))
    fine = around.join(open_blocks, F.col("run") == F.col("r")).drop("r")
    single = _often(fine.mapInArrow(_windows(w), _KINDS), "core")
    parts = sure.select(F.col("run").alias("r"), "block", F.lit(False).alias("single")).unionByName(
        single.select(F.col("run").alias("r"), "block", F.lit(True).alias("single")))
    high = F.col("at") - F.col("block") * BLOCK
    places = around.select("run", *_ID, "at", "first", "last").join(
        parts, F.col("run") == F.col("r")).select(
        *_ID, F.when(F.col("single"), F.col("at") - F.col("block"))
        .otherwise(F.greatest(F.col("first"), high - (BLOCK - 1))).alias("first"),
        F.when(F.col("single"), F.col("at") - F.col("block"))
        .otherwise(F.least(F.col("last"), high)).alias("last"))
    every = whole.select(*_ID, "first", "last").unionByName(places)
    return stored(every.groupBy(*_ID).agg(F.collect_set(F.struct("first", "last")).alias("covered")),
                  "covered")


def _cut(w, with_text):
    def scan(batches):
        for batch in batches:
            rows = {"row": [], "n_bytes": [], "n_removed": [], "n_spans": [], "kept_sha256": [], "text": []}
            texts, covered = batch.column("text").to_pylist(), batch.column("covered").to_pylist()
            for value, starts in zip(texts, covered):
                raw = (value or "").encode()
                kept, at, removed, spans, end = [], 0, 0, 0, -1
                for low, high in sorted((x["first"], x["last"] + w) for x in starts or ()):
                    if low > end:
                        spans += 1
                        kept.append(raw[at:low])
                        removed += high - low
                    elif high > end:
                        removed += high - end
                    end = max(end, high)
                    at = end
                out = b"".join(kept) + raw[at:]
                rows["n_bytes"].append(len(raw))
                rows["n_removed"].append(removed)
                rows["n_spans"].append(spans)
                rows["kept_sha256"].append(hashlib.sha256(out).hexdigest())
                rows["text"].append(out.decode("utf-8", "ignore") if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(rows["n_bytes"], pa.int64()),
                 pa.array(rows["n_removed"], pa.int64()), pa.array(rows["n_spans"], pa.int64()),
                 pa.array(rows["kept_sha256"], pa.string()), pa.array(rows["text"], pa.string())],
                names=["row", "n_bytes", "n_removed", "n_spans", "kept_sha256", "text"])
    return scan


def _removed(documents, carry, with_text, w, k, chunk):
    found = ranges(documents, w, k, chunk).withColumnsRenamed({"id1": "i1", "id2": "i2"})
    rows = _identified(documents, [packed(documents.select(*[column(c) for c in carry]))])
    joined = rows.join(found, (F.col("id1") == F.col("i1")) & (F.col("id2") == F.col("i2")), "left"
                       ).select("row", "text", "covered")
    kind = joined.schema["row"].dataType.simpleString()
    return joined.mapInArrow(_cut(w, with_text), f"row {kind}, n_bytes long, n_removed long, "
                                                 "n_spans long, kept_sha256 string, text string")


ADDED = ["n_bytes", "n_removed", "n_spans", "kept_sha256"]


def measure(documents, carry=("doc_id",), w=W, k=K, chunk=CHUNK):
    """For every document what is removed, and the digest of what is kept."""
    return unpacked(_removed(documents, list(carry), False, w, k, chunk), list(carry), added=ADDED)


def remove(documents, w=W, k=K, chunk=CHUNK):
    """Documents without their repeated stretches, with the counts beside them."""
    rest = [c for c in documents.columns if c != "text"]
    return unpacked(_removed(documents, rest, True, w, k, chunk), rest, added=["text", *ADDED])


def brute_force(texts, w=W):
    """In plain Python, for each text: (bytes, removed bytes, spans, digest of the rest)."""
    from collections import Counter
    raws = [(t or "").encode() for t in texts]
    seen = Counter(r[i:i + w] for r in raws for i in range(len(r) - w + 1))
    out = []
    for raw in raws:
        gone = bytearray(len(raw))
        for i in range(len(raw) - w + 1):
            if seen[raw[i:i + w]] > 1:
                gone[i:i + w] = b"\1" * w
        spans = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(raw, gone) if not g)
        out.append((len(raw), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out
