"""Quality rules: fixed limits, and divergence from what the language looks like.

A document's histograms of character classes and of common words are compared to references of the
languages by Jensen-Shannon distance (0 to 1). A language's reference starts as the median of each bin over
its distinct texts that pass the fixed limits and becomes the mean of those near it, again and again until it
is still: neither copies (a text counts once, in however many rows) nor junk texts, while they are the
minority, bend it. Every value of `lang` has its own reference; documents without language, or of one with too few
distinct texts to tell, have distances of 0 and are judged by the fixed limits alone. The counted words are
those of four languages; elsewhere the word histogram tells little and the characters decide.
Short documents have noisy histograms, so each distance counts from a minimum of words on.

All of it is column expressions: words are split once, five-word windows are hashed in arrays, character
classes are counted on what remains when lower-case letters are taken out. Histograms of distinct texts
are shuffled once, then a row of sums per language and task. Null texts have no words and fail; an empty table has no
references and no rows. Equal rows get equal verdicts. Extra columns are kept; columns named like an
added one are replaced.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from tarmac.llm.common import column, packed, stored, unpacked

WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
GRAM = 5

#: Character histograms are judged from so many words on, word histograms from so many.
CHARS_FROM = 40
WORDS_FROM = 60
#: A document is rejected where its characters are as far as FAR, or both histograms beyond these.
FAR_CHARS = 0.26
MAX_CHARS = 0.17
MAX_WORDS = 0.23
#: Documents up to these distances from the reference so far make the next one.
TRIM_CHARS = 0.2
TRIM_WORDS = 0.25
#: A language has a reference from so many distinct texts on.
USABLE = 10
#: Medians are taken to so many parts, means from whole numbers of so many parts (their sums are exact);
#: a reference is still when no bin moves by more.
CELLS = 1000
PARTS = 10 ** 9
STILL = 1e-4

# Frequent function words of each language.
COMMON = {
    "en": ["the", "of", "and", "to", "in", "is", "that", "it", "for", "was", "on", "with"],
    "fr": ["de", "la", "le", "et", "les", "des", "en", "un", "du", "que", "qui", "pour"],
    "de": ["der", "die", "und", "in", "den", "von", "zu", "das", "mit", "nicht", "ist", "ein"],
    "es": ["de", "la", "que", "el", "en", "los", "del", "se", "las", "por", "un", "para"],
}
WORDS = sorted({w for words in COMMON.values() for w in words})
SIZES = {"chars": 7, "common_words": len(WORDS) + 1}
ADDED = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
         "chars_distance", "words_distance", "kept"]


def _less(text, pattern):
    return F.regexp_replace(text, pattern, "")


def measured(documents):
    """Each row as struct `row` with the counts of the fixed limits and both histograms."""
    text = F.coalesce(column("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike(WORD))
    df = documents.select(
        packed(documents), F.unhex(F.md5(text.cast("binary"))).alias("key"),
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)).alias("words"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("long").alias("n_dup_lines"),
        F.length(text).cast("long").alias("n_chars_all"))
    either = [w for word in WORDS for w in (word, word.capitalize(), word.upper())]
    df = df.select(
        "row", "key", "n_dup_lines", "n_chars_all", F.size("words").cast("long").alias("n_words"),
        F.array_join("words", "").alias("solid"),
        F.lower(F.concat(F.lit(" "), F.array_join(
            F.filter("words", lambda w: w.isin(either)), "  "), F.lit(" "))).alias("common"),
        F.when(F.size("words") >= GRAM, F.transform(
            F.sequence(F.lit(0), F.size("words") - GRAM),
            lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(GRAM)])))
        .otherwise(F.array().cast("array<bigint>")).alias("grams"))
    df = df.select(
        "*", F.length("solid").cast("long").alias("word_chars"), _less("solid", "[a-z]+").alias("rest"),
        # Places of the windows are sorted only where some window occurs twice.
        F.when(F.size(F.array_distinct("grams")) < F.size("grams"), F.sort_array(
            F.transform("grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).alias("places"))
    df = df.select(
        "*", F.length("rest").alias("n_rest"), _less("rest", "[#*$%&|<>]+").alias("rest2"),
        F.sort_array(F.transform(F.filter("places", lambda x, i: (
            x["h"] == F.get("places", i - 1)["h"]) | (x["h"] == F.get("places", i + 1)["h"])),
            lambda x: x["i"])).alias("again"))
    df = df.select(
        "*", F.length("rest2").alias("n_rest2"), _less("rest2", "[A-Z]+").alias("rest3"))
    df = df.select(
        "*", F.length("rest3").alias("n_rest3"), F.length(_less("rest3", "[0-9]+")).alias("n_rest4"),
        F.length(_less("rest3", r"[0-9\x00-\x7F]+")).alias("n_wide"))
    repeat = F.when(F.col("places").isNull(), F.lit(0)).otherwise(F.aggregate(
        F.transform("again", lambda at, i: F.least(
            F.lit(GRAM), F.coalesce(F.get("again", i + 1) - at, F.lit(GRAM)))),
        F.lit(0), lambda total, n: total + n)).cast("long")
    classes = [
        F.col("word_chars") - F.col("n_rest"), F.col("n_rest") - F.col("n_rest2"),
        F.col("n_rest2") - F.col("n_rest3"), F.col("n_rest3") - F.col("n_rest4"),
        F.col("n_rest4") - F.col("n_wide"), F.col("n_wide"),
        F.col("n_chars_all") - F.col("word_chars")]
    counts = [(F.octet_length("common") - F.octet_length(F.replace(F.col("common"), F.lit(f" {w} "))))
              / (len(w.encode()) + 2) for w in WORDS]
    n = F.col("n_words")
    df = df.select(
        "row", "key", "n_words", "word_chars",
        (F.col("n_rest") - F.col("n_rest2")).cast("long").alias("n_symbols"), "n_dup_lines",
        repeat.alias("n_repeat_words"),
        F.array(*[c.cast("double") for c in classes]).alias("chars"),
        F.array(*counts).alias("common_words"))
    return df.select(
        "row", "key", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((n < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * n))
        .alias("base_failed"),
        shares("chars").alias("chars"),
        shares(F.concat("common_words", F.array(n - total("common_words")))).alias("common_words"))


def total(values):
    return F.aggregate(values, F.lit(0.0), lambda s, x: s + x)


def shares(values):
    values = F.col(values) if isinstance(values, str) else values
    return F.transform(values, lambda x: F.when(total(values) > 0, x / total(values)).otherwise(0.0))


def medians(texts):
    """(lang, chars, common_words): the median of each bin, scaled to a sum of 1."""
    cells = texts.select("lang", F.posexplode(F.concat(*SIZES)).alias("bin", "x")).groupBy(
        "lang", "bin", F.floor(F.col("x") * CELLS).alias("cell")).count()
    own = Window.partitionBy("lang", "bin")
    half = cells.withColumns({"upto": F.sum("count").over(own.orderBy("cell")),
                              "n": F.sum("count").over(own)}).where("2 * upto >= n")
    rows = half.groupBy("lang", "bin").agg((F.min("cell") / CELLS).alias("x")).groupBy("lang").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("bin", "x"))), lambda b: b["x"]).alias("all"))
    first = SIZES["chars"]
    return rows.select("lang", shares(F.slice("all", 1, first)).alias("chars"),
                       shares(F.slice("all", first + 1, SIZES["common_words"])).alias("common_words"))


def references(texts):
    """(lang, chars, common_words) of each language with enough sound texts, one row each."""
    texts = stored(texts, "texts")
    usable = texts.groupBy("lang").count().where(F.col("count") >= USABLE).select("lang")
    known = stored(medians(texts).join(usable, "lang", "left_semi"), "references")
    sums = [F.sum(F.round(F.get(name, F.lit(k)) * PARTS).cast("long")).alias(f"{name}{k}")
            for name, size in SIZES.items() for k in range(size)]
    seen = set()
    while True:
        old = known.select("lang", *[F.col(name).alias(f"old_{name}") for name in SIZES])
        near = texts.join(old, "lang").where((distance("chars", "old_chars") <= TRIM_CHARS)
                                             & (distance("common_words", "old_common_words") <= TRIM_WORDS))
        means = near.groupBy("lang").agg(F.count("*").alias("n"), *sums, F.sum(
            F.xxhash64("key").cast("decimal(38,0)")).alias("members"))
        # A language with no text near its reference keeps it.
        known = stored(old.join(means, "lang", "left").select("lang", "n", "members", *[
            F.when(F.col("n") > 0, F.array(*[F.col(f"{name}{k}") / (F.col("n") * F.lit(float(PARTS)))
                                             for k in range(size)])).otherwise(F.col(f"old_{name}")).alias(name)
            for name, size in SIZES.items()], *[f"old_{name}" for name in SIZES]), "references")
        moved = F.greatest(*[F.array_max(F.zip_with(name, f"old_{name}", lambda x, y: F.abs(x - y)))
                             for name in SIZES])
        move, *state = known.agg(F.max(moved), F.sum(F.xxhash64("lang", "n", "members").cast("decimal(38,0)"))).first()
        if move is None or move <= STILL or tuple(state) in seen:
            return known.select("lang", *SIZES)
        seen.add(tuple(state))


def distance(shares_, reference):
    """Jensen-Shannon distance, with logarithms to base 2."""
    def part(a, b):
        return F.when(a > 0, a * F.log2(2 * a / (a + b))).otherwise(0.0)

    both = F.zip_with(shares_, reference, lambda a, b: (part(a, b) + part(b, a)) / 2)
    return F.sqrt(F.greatest(total(both), F.lit(0.0)))


def _distances(df, known):
    held = known.select(F.col("lang").alias("known"), *[F.col(name).alias(f"of_{name}") for name in SIZES])
    df = df.join(held, F.col("row.lang") == F.col("known"), "left")
    for name, added, at_least in (("chars", "chars_distance", CHARS_FROM),
                                  ("common_words", "words_distance", WORDS_FROM)):
        df = df.withColumn(added, F.when(F.col("known").isNotNull() & (F.col("n_words") >= at_least),
                                         distance(name, f"of_{name}")).otherwise(0.0))
    return df


def judge(documents, far=FAR_CHARS, chars=MAX_CHARS, words=MAX_WORDS, carry=None):
    """Documents with their counts, distances and verdict `kept`."""
    carry = documents.columns if carry is None else carry
    slim = documents.select(*[column(c) for c in dict.fromkeys([*carry, "lang", "text"])])
    df = measured(slim)
    keep = F.struct(*[F.col("row").getField(c).alias(c) for c in dict.fromkeys([*carry, "lang"])])
    df = stored(df.withColumn("row", keep), "quality")
    sound = df.where(~F.col("base_failed") & (F.col("n_words") >= WORDS_FROM) & F.col("row.lang").isNotNull())
    texts = sound.select(F.col("row.lang").alias("lang"), "key", *SIZES).dropDuplicates(["lang", "key"])
    df = _distances(df, references(texts))
    odd = (F.col("chars_distance") > far) | ((F.col("chars_distance") > chars)
                                             & (F.col("words_distance") > words))
    df = df.withColumn("kept", ~F.col("base_failed") & ~odd)
    return unpacked(df, carry, added=ADDED)


def keep_good(documents):
    """The documents that pass, with their own columns."""
    df = judge(documents)
    return df.where("kept").select(*[column(c) for c in documents.columns])


def digest(judged):
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
                         "n_repeat_words", "base_failed", "kept")


def _shares_sql(values):
    return f"list_transform({values}, lambda x: CASE WHEN list_sum({values}) > 0 THEN x / list_sum({values}) ELSE 0 END)"


def _distance_sql(a, b):
    part = "CASE WHEN p[{0}] > 0 THEN p[{0}] * log2(2 * p[{0}] / (p[1] + p[2])) ELSE 0 END"
    return (f"sqrt(greatest(0, list_sum(list_transform(list_zip({a}, {b}), "
            f"lambda p: ({part.format(1)} + {part.format(2)}) / 2))))")


def _means_sql(name):
    bins = ", ".join(f"sum(CAST(round(t_{name}[{k + 1}] * {PARTS}) AS BIGINT)) FILTER (WHERE near)"
                     f" / (count(*) FILTER (WHERE near) * {float(PARTS)})" for k in range(SIZES[name]))
    return f"CASE WHEN count(*) FILTER (WHERE near) > 0 THEN [{bins}] ELSE {name} END AS new_{name}"


#: The recursion ends with a still reference, as `references` does; that one also ends where references of earlier steps come
#: again, for which the SQL has a number of steps.
ORACLE_SQL = """
WITH RECURSIVE docs AS (
  SELECT row_number() OVER () AS r, doc_id, lang, coalesce(text, '') AS t FROM documents),
split AS (
  SELECT r, doc_id, lang, t, regexp_extract_all(t, '[^\\x20\\x09-\\x0D]+') AS w,
         list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) AS lines
  FROM docs),
grams AS (
  SELECT r, j, array_to_string(w[j:j + 4], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS j FROM split WHERE len(w) >= 5)),
again AS (SELECT r, j, count(*) OVER (PARTITION BY r, g) AS n FROM grams),
repeated AS (
  SELECT r, count(DISTINCT p) AS n_repeat_words
  FROM (SELECT r, unnest(range(j, j + 5)) AS p FROM again WHERE n > 1) GROUP BY r),
counted AS (
  SELECT r, doc_id, lang, t, w, array_to_string(w, '') AS solid, len(t) AS n_all,
         CAST(len(w) AS BIGINT) AS n_words,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
         CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words
  FROM split LEFT JOIN repeated USING (r)),
classes AS (
  SELECT *, CAST(len(solid) AS BIGINT) AS word_chars,
         len(regexp_replace(solid, '[a-z]+', '', 'g')) AS a1,
         len(regexp_replace(solid, '[a-z#*$%&|<>]+', '', 'g')) AS a2,
         len(regexp_replace(solid, '[a-zA-Z#*$%&|<>]+', '', 'g')) AS a3,
         len(regexp_replace(solid, '[a-zA-Z0-9#*$%&|<>]+', '', 'g')) AS a4,
         len(regexp_replace(solid, '[\\x00-\\x7F]+', '', 'g')) AS a5,
         n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed
  FROM counted),
counts AS (
  SELECT *, list_transform([word_chars - a1, a1 - a2, a2 - a3, a3 - a4, a4 - a5, a5, n_all - word_chars],
                           lambda x: CAST(x AS DOUBLE)) AS char_counts,
         list_transform([@words], lambda v: CAST(len(list_filter(w, lambda x:
           x = v OR x = upper(v[1]) || v[2:] OR x = upper(v))) AS DOUBLE)) AS found
  FROM classes),
shares AS MATERIALIZED (
  SELECT r, doc_id, lang, t, n_words, word_chars, CAST(a1 - a2 AS BIGINT) AS n_symbols, n_dup_lines, n_repeat_words,
         base_failed, @char_shares AS chars, @word_shares AS common_words
  FROM (SELECT *, list_append(found, n_words - list_sum(found)) AS word_counts FROM counts)),
texts AS MATERIALIZED (
  SELECT lang, t, any_value(chars) AS t_chars, any_value(common_words) AS t_common_words,
         count(*) OVER (PARTITION BY lang) AS texts_of_lang
  FROM shares WHERE NOT base_failed AND n_words >= @words_from AND lang IS NOT NULL GROUP BY lang, t
  QUALIFY texts_of_lang >= @usable),
middles AS (
  SELECT lang, k, quantile_disc(floor(x * @cells), 0.5) / @cells AS x
  FROM (SELECT lang, unnest(t_chars || t_common_words) AS x,
               unnest(range(1, 1 + len(t_chars || t_common_words))) AS k FROM texts)
  GROUP BY lang, k),
medians AS (
  SELECT lang, list(x ORDER BY k) FILTER (WHERE k <= @n_chars) AS m_chars,
         list(x ORDER BY k) FILTER (WHERE k > @n_chars) AS m_common_words
  FROM middles GROUP BY lang),
known AS (
  SELECT 0 AS step, lang, @median_chars AS chars, @median_words AS common_words,
         CAST(1 AS DOUBLE) AS move
  FROM medians
  UNION ALL
  SELECT step + 1, lang, new_chars, new_common_words, max(greatest(
           list_max(list_transform(list_zip(chars, new_chars), lambda p: abs(p[1] - p[2]))),
           list_max(list_transform(list_zip(common_words, new_common_words), lambda p: abs(p[1] - p[2]))))) OVER ()
  FROM (
    SELECT step, lang, chars, common_words, @mean_chars, @mean_words
    FROM (
      SELECT step, lang, chars, common_words, t_chars, t_common_words,
             @near_chars <= @trim_chars AND @near_words <= @trim_words AS near
      FROM known JOIN texts USING (lang) WHERE move > @still AND step < 1000)
    GROUP BY step, lang, chars, common_words)),
final AS (
  SELECT lang, chars AS of_chars, common_words AS of_words FROM known
  WHERE step = (SELECT max(step) FROM known)),
distances AS (
  SELECT s.*, CASE WHEN f.lang IS NOT NULL AND n_words >= @chars_from THEN @far_chars ELSE 0 END AS d_chars,
         CASE WHEN f.lang IS NOT NULL AND n_words >= @words_from THEN @far_words ELSE 0 END AS d_words
  FROM shares s LEFT JOIN final f ON s.lang = f.lang)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND NOT (d_chars > @far OR (d_chars > @max_chars AND d_words > @max_words)) AS kept
FROM distances
"""
# Longer names first: some begin with others.
for _name, _value in sorted({
        "@words_from": WORDS_FROM, "@chars_from": CHARS_FROM, "@trim_words": TRIM_WORDS, "@trim_chars": TRIM_CHARS,
        "@far": FAR_CHARS, "@max_chars": MAX_CHARS, "@max_words": MAX_WORDS, "@usable": USABLE, "@cells": float(CELLS),
        "@still": STILL, "@n_chars": SIZES["chars"], "@words": ", ".join(f"'{w}'" for w in WORDS),
        "@char_shares": _shares_sql("char_counts"), "@word_shares": _shares_sql("word_counts"),
        "@median_chars": _shares_sql("m_chars"), "@median_words": _shares_sql("m_common_words"),
        "@mean_chars": _means_sql("chars"), "@mean_words": _means_sql("common_words"),
        "@near_chars": _distance_sql("t_chars", "chars"), "@near_words": _distance_sql("t_common_words", "common_words"),
        "@far_chars": _distance_sql("s.chars", "of_chars"), "@far_words": _distance_sql("s.common_words", "of_words"),
        }.items(), reverse=True):
    ORACLE_SQL = ORACLE_SQL.replace(_name, str(_value))
