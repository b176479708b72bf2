"""Benchmark decontamination: find passages of test items in training texts, remove them.

Windows of `n` item words (an item of fewer words is one window) are hashed. A bounded slice of the
windows goes to every task as a hash set; each task hashes all windows of its texts, looks them up and
compares the words of every hit with those of the item. Texts never move. More windows than one
slice holds are handled by further passes over a stored table, each with the next slice.

Null texts have no words and are never hit. An item without words has no window. Items of equal text
are all found; a null item_id marks words as hit but is not listed. Empty tables give empty results or
nothing hit. Extra columns are passed through; those named like an added one are replaced.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarmac.llm import tokens
from tarmac.llm.common import column, packed, pieces, stored, unpacked, utf8

WINDOW = 10
#: Windows held by a task at a time; at some 150 bytes each, 30 MB.
SLICE_WINDOWS = 200_000

_RUN = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("start", pa.int64()),
                  ("stop", pa.int64())])
_FOUND = (T.StructType().add("n_words", "long").add("items", T.ArrayType(T.StringType()))
          .add("runs", T.ArrayType(T.StructType().add("first", "long").add("last", "long")
                                   .add("start", "long").add("stop", "long"))))


def windows(benchmark, n=WINDOW, item="item_id", text="text"):
    """Distinct (hash, length, words) of the items' windows with the ids of the items."""
    def cut(batches):
        for batch in batches:
            rows = {"k": [], "hash": [], "words": [], "item": []}
            for part in pieces(batch, "text"):
                data, offsets = utf8(part.column("text"))
                starts, ends, h, first = tokens.words(data, offsets, tokens.ALNUM)
                ids = part.column("item").to_pylist()
                for i, name in enumerate(ids):
                    a, b = int(first[i]), int(first[i + 1])
                    k = min(n, b - a)
                    if k:
                        grams = tokens.ngrams(h[a:b], k).view(np.int64)
                        for j in range(b - a - k + 1):
                            rows["k"].append(k)
                            rows["hash"].append(int(grams[j]))
                            rows["words"].append(_words(data, starts, ends, a + j, k))
                            rows["item"].append(name)
            yield pa.RecordBatch.from_pydict(rows, schema=pa.schema([
                ("k", pa.int64()), ("hash", pa.int64()), ("words", pa.binary()),
                ("item", pa.string())]))

    few = benchmark.select(column(item).cast("string").alias("item"), column(text).alias("text"))
    return (few.mapInArrow(cut, "k long, hash long, words binary, item string")
            .groupBy("k", "hash", "words").agg(F.collect_set("item").alias("items")))


def _words(data, starts, ends, at, k):
    return b" ".join(data[starts[j]:ends[j]].tobytes() for j in range(at, at + k)).lower()


def _scan(batches, known, again):
    """Words hit by the windows in `known`: {(length, hash): [(words, items)]}."""
    by_length = {}
    for k, h in known:
        by_length.setdefault(k, []).append(h)
    sets = {}
    for k, hs in by_length.items():
        hs = np.sort(np.array(hs, np.int64).view(np.uint64))
        bits = np.zeros(1 << 22, bool)
        bits[hs >> np.uint64(42)] = True
        sets[k] = (hs, bits)
    for batch in batches:
        texts = batch.schema.get_field_index("text")
        for part in pieces(batch):
            data, offsets = utf8(part.column(texts))
            starts, ends, h, first = tokens.words(data, offsets, tokens.ALNUM)
            row_of = np.repeat(np.arange(part.num_rows), np.diff(first))
            cover = np.zeros(len(h) + 1, np.int64)
            items = {}
            for k, (hs, bits) in sets.items():
                grams = tokens.ngrams(h, k)
                at = np.flatnonzero(bits[grams >> np.uint64(42)])
                if not len(at):
                    continue
                at = at[row_of[at] == row_of[at + k - 1]]
                place = np.minimum(np.searchsorted(hs, grams[at]), len(hs) - 1)
                for j in at[hs[place] == grams[at]].tolist():
                    text = _words(data, starts, ends, j, k)
                    for words_, ids in known[k, int(grams[j].view(np.int64))]:
                        if words_ == text:
                            cover[j] += 1
                            cover[j + k] -= 1
                            items.setdefault(int(row_of[j]), set()).update(ids)
            hit = np.cumsum(cover[:-1]) > 0
            if again:
                _mark(hit, items, first, part)
            yield _with_found(part, hit, items, first, row_of, starts, ends, offsets)


def _mark(hit, items, first, part):
    """Add what earlier passes have found."""
    for i, (runs, names) in enumerate(zip(part.column(part.schema.get_field_index("runs")).to_pylist(),
                                          part.column(part.schema.get_field_index("items")).to_pylist())):
        if runs:
            for run in runs:
                hit[first[i] + run["first"]:first[i] + run["last"]] = True
            items.setdefault(i, set()).update(names)


def _with_found(part, hit, items, first, row_of, starts, ends, offsets):
    """Runs of hit words: numbers of words and of bytes within the text, ends exclusive."""
    runs = [[] for _ in range(part.num_rows)]
    at = np.flatnonzero(hit)
    if len(at):
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(at) > 1) | (row_of[at[1:]] != row_of[at[:-1]])
        heads = at[new]
        tails = at[np.append(np.flatnonzero(new)[1:] - 1, len(at) - 1)]
        for a, b in zip(heads.tolist(), tails.tolist()):
            i = int(row_of[a])
            runs[i].append({"first": a - int(first[i]), "last": b + 1 - int(first[i]),
                            "start": int(starts[a] - offsets[i]), "stop": int(ends[b] - offsets[i])})
    added = {"n_words": pa.array(np.diff(first), pa.int64()),
             "items": pa.array([sorted(x for x in items.get(i, ()) if x is not None)
                                for i in range(part.num_rows)], pa.list_(pa.string())),
             "runs": pa.array(runs, pa.list_(_RUN))}
    for name, values in added.items():
        k = part.schema.get_field_index(name)
        part = (part.append_column(name, values) if k < 0
                else part.set_column(k, name, values))
    return part


def find(documents, benchmark, n=WINDOW, carry=None, slice_windows=SLICE_WINDOWS, text="text"):
    """Documents with `n_words`, `items` (ids found, sorted as strings) and `runs` of hit words.

    `carry` names the columns to keep beside them (all by default; naming few saves moving texts
    back out of the tasks).
    """
    columns = documents.columns
    carry = columns if carry is None else carry
    spark = documents.sparkSession
    table = stored(windows(benchmark, n), "windows")
    count = table.count()
    slices = max(1, -(-count // slice_windows))
    df = documents.select(packed(documents.select(*[column(c) for c in carry])),
                          column(text).alias("text"))
    for k in range(slices):
        known = {}
        for row in table.where(F.pmod("hash", F.lit(slices)) == k).toLocalIterator():
            known.setdefault((row["k"], row["hash"]), []).append((bytes(row["words"]), row["items"]))
        shared = spark.sparkContext.broadcast(known)
        again, last = k > 0, k == slices - 1
        fields = [df.schema["row"]] + ([] if last else [df.schema["text"]]) + _FOUND.fields

        def scan(batches, shared=shared, again=again, names=tuple(f.name for f in fields)):
            for part in _scan(batches, shared.value, again):
                yield part.select(list(names))

        df = df.mapInArrow(scan, T.StructType(fields))
        if not last:
            df = stored(df, "scanned")
    return unpacked(df, carry, added=_FOUND.names)


def _without(batches):
    """Texts without the bytes of their runs."""
    for batch in batches:
        texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
        runs = batch.column(batch.schema.get_field_index("runs")).to_pylist()
        out = []
        for value, spans in zip(texts, runs):
            if spans:
                raw, at, kept = value.encode(), 0, []
                for span in spans:
                    kept.append(raw[at:span["start"]])
                    at = span["stop"]
                value = b"".join(kept + [raw[at:]]).decode()
            out.append(value)
        k = batch.schema.get_field_index("text")
        yield batch.set_column(k, "text", pa.array(out, batch.schema.field(k).type))


def decontaminate(documents, benchmark, n=WINDOW, remove="documents"):
    """Documents without contaminated ones, or (`remove="spans"`) without the hit passages."""
    found = find(documents, benchmark, n)
    if remove == "documents":
        clean = found.where(F.size("runs") == 0)
    else:
        clean = found.mapInArrow(_without, found.schema)
    return clean.select(*[column(c) for c in documents.columns])


def digest(found):
    """One row per document with counts and a digest of the items found."""
    hit = F.aggregate("runs", F.lit(0).cast("long"), lambda n, r: n + r["last"] - r["first"])
    return found.select(
        "doc_id", "n_words", hit.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"))


ORACLE_SQL = r"""
WITH item_words AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE text IS NOT NULL),
item_windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS k,
         array_to_string(w[j:j + least(len(w), 10) - 1], ' ') AS words
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS j FROM item_words
        WHERE len(w) > 0)),
doc_words AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents),
lengths AS (SELECT DISTINCT k FROM item_windows),
doc_windows AS (
  SELECT r, k, j, array_to_string(w[j:j + k - 1], ' ') AS words
  FROM (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS j FROM doc_words, lengths
        WHERE len(w) >= k)),
hits AS (
  SELECT r, j, d.k, item FROM doc_windows d JOIN item_windows i ON d.k = i.k AND d.words = i.words),
hit_words AS (
  SELECT r, count(DISTINCT p) AS n_hit
  FROM (SELECT r, unnest(range(j, j + k)) AS p FROM hits) GROUP BY r),
hit_items AS (
  SELECT r, count(DISTINCT item) AS n_items,
         string_agg(DISTINCT item, ',' ORDER BY item) AS items FROM hits GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc_words LEFT JOIN hit_words USING (r) LEFT JOIN hit_items USING (r)
"""


def brute_force(texts, items, n=WINDOW):
    """The same in plain Python: for each text (words, hit words, items found)."""
    import re
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    fold = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    split = [(i, pattern.findall((t or "").translate(fold))) for i, t in items]
    out = []
    for text in texts:
        w, hit, found = pattern.findall((text or "").translate(fold)), set(), set()
        for item, q in split:
            k = min(n, len(q))
            grams = {tuple(q[j:j + k]) for j in range(len(q) - k + 1)} if k else set()
            for j in range(len(w) - k + 1):
                if tuple(w[j:j + k]) in grams:
                    hit.update(range(j, j + k))
                    found.add(str(item))
        out.append((len(w), len(hit), len(found),
                    hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()))
    return out
