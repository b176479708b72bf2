"""Helpers shared by the operators: stored tables, safe columns, Arrow text, summed counters."""

import os
import tempfile
import weakref
import zipfile

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F

import tarmac
from tarmac.session import forget, work_folder

PIECE_BYTES = 4 << 20


_shipped = weakref.WeakSet()
_places = weakref.WeakKeyDictionary()


def ship_code(spark):
    """Give this package to the tasks, for sessions that were not submitted with it."""
    context = spark.sparkContext
    if context not in _shipped:
        top = os.path.dirname(tarmac.__file__)
        path = os.path.join(tempfile.mkdtemp(prefix="tarmac-code-"), "tarmac.zip")
        with zipfile.ZipFile(path, "w") as archive:
            for folder, _, names in os.walk(top):
                for name in names:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        archive.write(full, os.path.relpath(full, os.path.dirname(top)))
        context.addPyFile(path)
        _shipped.add(context)
    return spark


def column(name):
    """A column by its exact name, whatever characters the name has."""
    return F.col("`" + name.replace("`", "``") + "`")


def packed(df, name="row"):
    """All columns as one struct, so that columns added beside it cannot clash with them."""
    return F.struct(*[column(c) for c in df.columns]).alias(name)


def unpacked(df, columns, name="row", added=()):
    """Columns of the struct again; added columns win over old ones of the same name."""
    taken = {a.lower() for a in added}
    kept = [F.col(name).getField(c).alias(c) for c in columns if c.lower() not in taken]
    return df.select(*kept, *[F.col(a) for a in added])


def stored(df, purpose):
    """Write a table below the cluster's shared folder and read it back: later steps neither
    repeat the work nor depend on executors that may be lost."""
    spark = df.sparkSession
    path = work_folder(spark, purpose)
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    _places[out] = path
    return out


def drop(*tables):
    """Delete tables that `stored` gave, once nothing reads them any more."""
    for table in tables:
        forget(table.sparkSession, _places.pop(table))


def pieces(batch, text="text", limit=PIECE_BYTES):
    """Slices of a record batch with about `limit` bytes of text each, one row at least."""
    _, offsets = utf8(batch.column(text))
    first = 0
    while first < batch.num_rows:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(max(last, first + 1), batch.num_rows)
        yield batch.slice(first, last - first)
        first = last


def utf8(column_):
    """Bytes and row offsets of a string column; null counts as empty."""
    if column_.null_count:
        column_ = pc.fill_null(column_, "")
    if isinstance(column_, pa.ChunkedArray):
        column_ = column_.combine_chunks()
    wide = pa.types.is_large_string(column_.type) or pa.types.is_large_binary(column_.type)
    _, places, data = column_.buffers()
    offsets = np.frombuffer(places, dtype=np.int64 if wide else np.int32)
    offsets = offsets[column_.offset:column_.offset + len(column_) + 1].astype(np.int64)
    if data is None or len(offsets) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column_) + 1, np.int64)
    start = offsets[0]
    return np.frombuffer(data, dtype=np.uint8)[start:offsets[-1]], offsets - start


CHUNK = 4096
SALTS = 64


def summed_counters(df, width, add):
    """Element-wise sum, over all rows of `df`, of a counter table of fixed width.

    `add(batch, counters)` adds a record batch to a task's own table of `width` int64 counters.
    Each task sends its table once, in chunks without the empty ones; chunks are summed in two steps,
    so no task reads more than a share of what the tasks of the first step have sent. The sum
    returned has `width` numbers whatever the size of the corpus, hence it may be broadcast.
    """
    def count(batches):
        counters = np.zeros(width, np.int64)
        seen = 0
        for batch in batches:
            add(batch, counters)
            seen += batch.num_rows
        if seen:
            salt = int(counters.sum() % SALTS)
            used = [i for i in range(0, width, CHUNK) if counters[i:i + CHUNK].any()]
            for at in range(0, len(used), 64):
                some = used[at:at + 64]
                yield pa.RecordBatch.from_arrays([
                    pa.array(some, pa.int64()), pa.array([salt] * len(some), pa.int64()),
                    pa.array([_narrow(counters[i:i + CHUNK]) for i in some], pa.binary()),
                ], names=["chunk", "salt", "counts"])

    def total(table):
        sums = np.zeros(CHUNK, np.int64)
        for value in table.column("counts"):
            part = _wide(value.as_py())
            sums[:len(part)] += part
        return pa.table({"chunk": [table.column("chunk")[0].as_py()],
                         "salt": [table.column("salt")[0].as_py()], "counts": [_narrow(sums)]},
                        schema=pa.schema([("chunk", pa.int64()), ("salt", pa.int64()),
                                          ("counts", pa.binary())]))

    shape = "chunk long, salt long, counts binary"
    parts = df.mapInArrow(count, shape).groupBy("chunk", "salt").applyInArrow(total, shape)
    whole = parts.groupBy("chunk").applyInArrow(total, shape)
    sums = np.zeros(width, np.int64)
    for row in whole.collect():
        part = _wide(row["counts"])[:width - row["chunk"]]
        sums[row["chunk"]:row["chunk"] + len(part)] = part
    return sums


def _narrow(counts):
    wide = counts.max(initial=0) >= 2 ** 31 or counts.min(initial=0) < -2 ** 31
    return (b"8" + counts.tobytes()) if wide else (b"4" + counts.astype(np.int32).tobytes())


def _wide(raw):
    return np.frombuffer(raw[1:], np.int64 if raw[:1] == b"8" else np.int32).astype(np.int64)
