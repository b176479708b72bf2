"""Collocations: phrases of two to four words, scored by how much oftener they occur than their parts.

* Every word starts one window: the word and those that follow it in its piece, at most four, padded with nulls. Only
  these longest windows are counted. Each occurrence of a shorter phrase is the head of exactly one window, so
  Spark's ROLLUP over the window's columns gives the counts of all shorter phrases, of the words, and of
  all words of a language.
* Most windows occur once or twice. A first pass adds up how often the two-, three- and four-word phrases of each
  language occur, in one counter table that phrases share by hash, so a counter is never below
  the count of any of its phrases. Where it is below the least count asked for, a window is padded from there on: no
  phrase that occurs often enough loses an occurrence. The table grows with the text up to a largest width. On a corpus
  so large that every counter is full, windows stay whole and the result is the same.
* Within a task, equal windows of a slice are counted by codes of the words themselves, not by hashes.
* Cuts join a phrase to its two parts. A phrase is dropped if a longer one keeps most of its occurrences:
  longer phrases name the shorter ones they hold, and the largest count for each is joined back.

Null texts are empty; a null lang is `und`. Rows count one by one, copies too. Texts without words and empty tables
give no rows. Ties of score and count are in the order of the phrase's bytes. Extra columns are ignored.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.llm import tokens
from tarmac.llm.common import column, pieces, stored, utf8
from tarmac.session import shuffles_removed

LONGEST = 4
LEAST = 30
TOP = 2000
HELD = 80
WIDTH, WIDEST = 1 << 24, 1 << 27
TEXT_BYTES = 64  # of the corpus, for each counter
CLIPPED = 1 << 15
SHARE = 1 << 18
SALTS = 64
CHUNK = 1 << 20
NO_LANG = "und"
_BREAKS = np.zeros(256, bool)
_BREAKS[[ord(c) for c in ".,;:!?\n\x0b\x0c\r"]] = True
WORDS = tokens.Alphabet([0x20, 0x09, *np.flatnonzero(_BREAKS).tolist()])
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32
COLUMNS = [f"w{k}" for k in range(1, LONGEST + 1)]


def _slices(batch):
    """For at most CHUNK words at a time: how many of them start a window, hashes, pieces, rows, and bytes of the words.

    A slice ends with the words that complete its last windows.
    """
    for part in pieces(batch):
        data, offsets = utf8(part.column(part.schema.get_field_index("text")))
        starts, ends, h, first = tokens.words(data, offsets, WORDS)
        row_of = np.repeat(np.arange(part.num_rows), np.diff(first))
        breaks = np.flatnonzero(_BREAKS[data])
        langs = part.column(part.schema.get_field_index("lang")).dictionary_encode()
        names = langs.dictionary.to_pylist()
        salts = np.array([tokens.mixed(np.array([hash_text(n)], np.uint64))[0] for n in names] or [0], np.uint64)
        code = langs.indices.to_numpy()
        for c in range(0, len(starts), CHUNK):
            some = slice(c, min(c + CHUNK + LONGEST - 1, len(starts)))
            row = row_of[some]
            piece = np.searchsorted(breaks, starts[some])
            yield (min(CHUNK, len(starts) - c), tokens.mixed(h[some] ^ salts[code[row]]), piece, row, code[row], names,
                   data, starts[some], ends[some])


def hash_text(text):
    """A 64-bit number of a short text that is the same in every process."""
    total = 0xCBF29CE484222325
    for byte in text.encode():
        total = (total ^ byte) * 0x100000001B3 % 2 ** 64
    return total


def _heads(n, h, piece, row, longest):
    """For k = 2, 3, ...: whether the k words from each of n places are in one piece, and their counter."""
    for k in range(2, longest + 1):
        whole = np.zeros(n, bool)
        at = np.zeros(n, np.int64)
        m = min(n, max(0, len(h) - k + 1))
        whole[:m] = (piece[:m] == piece[k - 1:k - 1 + m]) & (row[:m] == row[k - 1:k - 1 + m])
        at[:m] = (tokens.ngrams(h, k)[:m] >> np.uint64(20)).astype(np.int64)
        yield whole, at


def often(texts, least, width):
    """For each counter whether it reaches `least`: counts of all phrases, added up over all rows.

    A task sends counts cut at `least`, a byte each; sums of cut counts reach it whenever the counts do. Whatever
    the corpus, the result has `width` flags.
    """
    assert 0 < least < 128

    def count(batches):
        counters = np.zeros(width, np.uint16)
        seen = 0
        for batch in batches:
            for n, h, piece, row, *_ in _slices(batch):
                for whole, at in _heads(n, h, piece, row, LONGEST):
                    places = at[whole] % width
                    for i in range(0, len(places), CLIPPED):  # cut in time, so that none overflows
                        some = places[i:i + CLIPPED]
                        np.add.at(counters, some, 1)
                        counters[some] = np.minimum(counters[some], least)
                seen += n
        counters = counters.astype(np.uint8)
        if seen:
            for i in range(0, width, SHARE):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i], pa.int64()), pa.array([seen % SALTS], pa.int64()),
                     pa.array([counters[i:i + SHARE].tobytes()], pa.binary())], names=["share", "salt", "counts"])

    def total(table):
        sums = np.zeros(SHARE, np.uint8)
        for value in table.column("counts"):
            part = np.frombuffer(value.as_buffer(), np.uint8)
            sums[:len(part)] = np.minimum(sums[:len(part)] + part, least)
        return pa.table({"share": table.column("share")[:1], "salt": table.column("salt")[:1],
                         "counts": pa.array([sums.tobytes()], pa.binary())})

    shape = "share long, salt long, counts binary"
    sums = texts.mapInArrow(count, shape).groupBy("share", "salt").applyInArrow(total, shape)
    flags = np.zeros(width, bool)
    with shuffles_removed(texts.sparkSession):  # else what the tasks sent lies beside the windows
        rows = sums.groupBy("share").applyInArrow(total, shape).collect()  # `width` bytes, whatever the corpus
    for row in rows:
        part = np.frombuffer(row["counts"], np.uint8)[:width - row["share"]]
        flags[row["share"]:row["share"] + len(part)] = part >= least
    return np.packbits(flags)


def _spelled(data, starts, ends):
    """Words as an Arrow column, A-Z in lower case."""
    lengths = ends - starts
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=offsets[1:])
    if not len(starts):
        return pa.array([], pa.large_string())
    at = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], lengths)
    return pa.LargeStringArray.from_buffers(
        len(starts), pa.py_buffer(offsets), pa.py_buffer(_FOLD[data[at]]))


def _windows(flags, width):
    """(lang, w1, ..., w4, n): windows of a slice, padded, each with its number of places."""
    def scan(batches):
        packed = flags.value  # eight flags a byte, as it came: tasks hold no copy of their own

        def frequent(at):
            return (packed[at >> 3] >> (7 - (at & 7)).astype(np.uint8) & 1).astype(bool)

        for batch in batches:
            for n, h, piece, row, lang, names, data, starts, ends in _slices(batch):
                spelled = _spelled(data, starts, ends).dictionary_encode()
                word = spelled.indices.to_numpy().astype(np.int64)
                size = len(spelled.dictionary) + 1
                alive = np.ones(n, bool)
                key = lang[:n].astype(np.int64) * size + word[:n] + 1
                _, key = np.unique(key, return_inverse=True)
                codes = [word[:n] + 1]
                for k, (whole, at) in enumerate(_heads(n, h, piece, row, LONGEST), 2):
                    shorter = alive
                    alive = shorter & whole & frequent(at % width)
                    if k > 2:  # a frequent phrase holds a frequent one from its second word on
                        alive[:-1] &= shorter[1:]
                    following = np.zeros(n, np.int64)
                    m = min(n, len(word) - k + 1)
                    following[:m] = word[k - 1:k - 1 + m] + 1
                    following[~alive] = 0
                    codes.append(following)
                    _, key = np.unique(key * size + following, return_inverse=True)
                _, first, count = np.unique(key, return_index=True, return_counts=True)
                spelled = pa.concat_arrays([pa.array([None], pa.large_string()), spelled.dictionary])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()).take(pa.array(lang[first])),
                     *[spelled.take(pa.array(c[first])).cast(pa.string()) for c in codes],
                     pa.array(count, pa.int64())], names=["lang", *COLUMNS, "n"])
    return scan


def fitting(texts):
    """A width for the counters of all phrases, by the bytes of the texts."""
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    width = WIDTH
    while width < min(WIDEST, size / TEXT_BYTES):
        width *= 2
    return width


def counts(documents, least=LEAST, width=None):
    """(lang, size, phrase, w1, ..., w4, f): the words and phrases that occur often enough; size 0 is the language."""
    texts = documents.select(F.coalesce(column("lang").cast("string"), F.lit(NO_LANG)).alias("lang"),
                             F.coalesce(column("text"), F.lit("")).alias("text"))
    width = width or fitting(texts)
    flags = documents.sparkSession.sparkContext.broadcast(often(texts, least, width))
    shape = "lang string, " + ", ".join(f"{c} string" for c in COLUMNS) + ", n long"
    windows = texts.mapInArrow(_windows(flags, width), shape).groupBy("lang", *COLUMNS).agg(F.sum("n").alias("n"))
    rolled = windows.rollup("lang", *COLUMNS).agg(F.sum("n").alias("f"), F.grouping_id().alias("rolled"))
    size = F.lit(LONGEST) - F.bit_count("rolled")
    padded = F.lit(False)
    for k in range(1, LONGEST + 1):
        padded = padded | ((F.col("size") >= k) & F.col(f"w{k}").isNull())
    kept = (rolled.where(F.col("rolled") < 2 ** (LONGEST + 1) - 1).withColumn("size", size)
            .where(~padded & ((F.col("size") == 0) | (F.col("f") >= least))))
    with shuffles_removed(documents.sparkSession):
        return stored(kept.select("lang", "size", F.concat_ws(" ", *COLUMNS).alias("phrase"), *COLUMNS, "f"), "phrases")


def _exact(c):
    return c.cast("decimal(20,0)")


def scored(frequent):
    """(lang, size, phrase, words, a, l, r, score) of every candidate, by its lowest-scoring cut."""
    words = F.array_compact(F.array(*COLUMNS))
    many = frequent.where("size >= 2").select("lang", "size", "phrase", words.alias("words"), F.col("f").alias("a"))
    cuts = many.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1))).select(
        "*", F.array_join(F.slice("words", F.lit(1), F.col("k")), " ").alias("head"),
        F.array_join(F.slice("words", F.col("k") + 1, F.col("size") - F.col("k")), " ").alias("tail"))
    parts = frequent.where("size >= 1")
    for name, part in (("l", "head"), ("r", "tail")):
        cuts = cuts.join(parts.select(F.col("lang").alias("of"), F.col("phrase").alias(part), F.col("f").alias(name)),
                         [part]).where(F.col("lang") == F.col("of")).drop("of")
    cuts = cuts.withColumn("score", F.expr(
        "(cast(a as decimal(20,0)) * cast(2000000 as decimal(7,0))) div (cast(l as decimal(20,0)) + cast(r as decimal(20,0)))"))
    lowest = cuts.groupBy("lang", "size", "phrase", "words", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    with shuffles_removed(frequent.sparkSession):
        return stored(lowest.select("lang", "size", "phrase", "words", "a", "cut.l", "cut.r", "cut.score"), "scored")


def standing(candidates, held=HELD):
    """Candidates that no longer one holds for the given share of their occurrences."""
    inner = candidates.where("size >= 3").select(
        "lang", "a", "words", "size", F.explode(F.sequence(F.lit(2), F.col("size") - 1)).alias("short"))
    inner = inner.select("*", F.explode(F.sequence(F.lit(1), F.col("size") - F.col("short") + 1)).alias("start")).select(
        F.col("lang").alias("of"), F.array_join(F.slice("words", F.col("start"), F.col("short")), " ").alias("inside"), "a")
    longest = inner.groupBy("of", "inside").agg(F.max("a").alias("most"))
    joined = candidates.join(longest, (F.col("lang") == F.col("of")) & (F.col("phrase") == F.col("inside")), "left")
    return joined.where(F.col("most").isNull() | (100 * _exact(F.col("most")) < held * _exact(F.col("a")))).drop(
        "of", "inside", "most")


def mine(documents, least=LEAST, top=TOP, held=HELD, width=None):
    """(lang, rank, phrase, a, l, r, n, score): the first `top` phrases of each language."""
    frequent = counts(documents, least, width)
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    ranked = standing(scored(frequent), held).withColumn(
        "rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    totals = frequent.where("size = 0").select(F.col("lang").alias("of"), F.col("f").alias("n"))
    return ranked.join(totals, F.col("lang") == F.col("of")).select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


#: DuckDB SQL for the digest.
ORACLE_SQL = r"""
WITH pieces AS (
  SELECT row_number() OVER () AS row_id, coalesce(lang, 'und') AS lang,
         unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
worded AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
heads AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM worded),
lengths AS (SELECT lang, w, i, unnest(range(1, least(4, len(w) - i + 1) + 1)) AS k FROM heads),
f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM lengths GROUP BY ALL),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
candidates AS (SELECT lang, k AS size, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k >= 2 AND f >= 30),
cuts AS (
  SELECT c.lang, c.phrase, c.a, c.size, c.w, t.k, x.f AS l, y.f AS r,
         ((2000000::HUGEINT * c.a) // (x.f::HUGEINT + y.f))::BIGINT AS score
  FROM candidates c, LATERAL (SELECT unnest(range(1, c.size)) AS k) t
       JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:t.k], ' ')
       JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[t.k + 1:], ' ')),
lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
standing AS (
  SELECT s.* FROM lowest s WHERE NOT EXISTS (
    SELECT 1 FROM candidates b WHERE b.lang = s.lang AND b.size > s.size AND 100 * b.a >= 80 * s.a
      AND contains(' ' || b.phrase || ' ', ' ' || s.phrase || ' '))),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM standing)
SELECT r.lang, r.rank::BIGINT AS rank, r.phrase, r.a::BIGINT AS a, r.l::BIGINT AS l, r.r::BIGINT AS r, n.n, r.score
FROM ranked r JOIN n ON n.lang = r.lang WHERE r.rank <= 2000
"""


def brute_force(rows, least=LEAST, top=TOP, held=HELD):
    """In plain Python, for rows (text, lang): the digest's rows."""
    import re
    from collections import Counter
    fold = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = NO_LANG if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(fold)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i:i + k]) for k in range(1, LONGEST + 1) for i in range(len(words) - k + 1))
    out = []
    often = {p: a for p, a in f.items() if len(p) > 2 and a >= least}
    for p, a in often.items():
        lang, words = p[0], p[1:]
        cuts = [(2000000 * a // (f[(lang, *words[:k])] + f[(lang, *words[k:])]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        inside = any(b[0] == lang and len(b) > len(p) and 100 * c >= held * a and any(
            b[i:i + len(words)] == words for i in range(1, len(b))) for b, c in often.items())
        if not inside:
            out.append((lang, -score, -a, " ".join(words).encode(), f[(lang, *words[:k])], f[(lang, *words[k:])]))
    done = []
    for lang in n:
        for rank, (_, score, a, phrase, left, right) in enumerate(sorted(o for o in out if o[0] == lang)[:top], 1):
            done.append((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return done
