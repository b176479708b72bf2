"""Secret scans by a trigram index.

From each rule's pattern follows a Boolean query over trigrams that every match contains. The index holds
postings (trigram, text) for the trigrams the rules ask for; texts are named by a hash of their content, so
equal texts share postings. Postings are intersected per alternative by counting, and only the texts
found are searched with the rule's pattern. Rules without a mandatory trigram search every text.

A hash shared by different texts only adds candidates; the pattern decides. Null texts are
empty: no spans. Places are code points from 0, ends exclusive. Rows of equal text get equal spans, whatever
their doc_id. Extra columns are kept; columns named like an added one are replaced.
"""

from typing import NamedTuple

from pyspark.sql import functions as F

from tarmac.llm import trigrams
from tarmac.llm.common import column, packed, unpacked


class Rule(NamedTuple):
    kind: str
    pattern: str
    value: int = 0  # the group whose length counts
    least: int = 1


def _either_case(words):
    return "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w)
                    for w in words.split("|"))


# The base kinds in their order.
BASE = [
    Rule("assign", "(" + _either_case("password|passwd|secret|token|api_?key")
         + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]{24,}", 0, 24),  # runs are whole: shorter ones would be dropped anyway
]
MORE = [
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]*"),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
]
RULES = BASE + MORE
MARK = "<secret>"


def _key(text):
    return F.xxhash64(text)


def build_index(documents, grams, text="text"):
    """Postings (gram, key): the texts that contain each trigram, every text once."""
    low = F.lower(column(text))
    held = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(g)), F.lit(g)) for g in grams]))
    return (documents.where(column(text).isNotNull())
            .select(_key(column(text)).alias("key"), F.explode(held).alias("gram")).distinct())


def candidates(index, queries):
    """Per text found by any query: `key` and the numbers of the queries that hold, `wanted`."""
    tests = []
    for number, alternatives in queries.items():
        held = [F.count_if(F.col("gram").isin(sorted(a))) == len(a) for a in alternatives]
        tests.append(F.when(_any(held), F.lit(number)))
    grams = sorted({g for alternatives in queries.values() for a in alternatives for g in a})
    found = (index.where(F.col("gram").isin(grams)).groupBy("key")
             .agg(F.array_compact(F.array(*tests)).alias("wanted")))
    return found.where(F.size("wanted") > 0)


def _any(tests):
    out = tests[0]
    for t in tests[1:]:
        out = out | t
    return out


def _spans(rule, rank, text, wanted):
    """Spans of a rule: what lies between matches and the matches themselves give their places."""
    found = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    empty = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")

    def located(matches, value):
        gaps = F.split(text, rule.pattern, -1)
        lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches,
                             lambda gap, m: F.struct(F.length(gap).alias("gap"), F.length(m).alias("own")))
        placed = F.aggregate(
            lengths, F.struct(F.lit(0).alias("at"),
                              F.array().cast("array<struct<start:int,end:int>>").alias("all")),
            lambda s, x: F.struct(
                (s["at"] + x["gap"] + x["own"]).alias("at"),
                F.concat(s["all"], F.array(F.struct(
                    (s["at"] + x["gap"]).alias("start"),
                    (s["at"] + x["gap"] + x["own"]).alias("end")))).alias("all")),
            lambda s: s["all"])
        kept = F.filter(F.arrays_zip(placed.alias("place"), value.alias("value")),
                        lambda x: F.length(x["value"]) >= rule.least)
        return F.transform(kept, lambda x: F.struct(
            x["place"]["start"].alias("start"), F.lit(rank).alias("rank"),
            x["place"]["end"].alias("end"), F.lit(rule.kind).alias("kind")))

    value = (F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.value))
             if rule.value else found)
    hit = F.regexp_like(text, F.lit(rule.pattern))
    return F.when(wanted & hit, located(found, value)).otherwise(empty)


def find(documents, rules=RULES, carry=None, text="text"):
    """Documents with `spans`: array of (start, rank, end, kind), by start, then order of the rules."""
    carry = documents.columns if carry is None else carry
    queries = {n: q for n, r in enumerate(rules) if (q := trigrams.query(r.pattern)) is not None}
    content = F.coalesce(column(text), F.lit(""))
    df = documents.select(packed(documents.select(*[column(c) for c in carry])),
                          content.alias("text"), _key(content).alias("key"))
    if queries:
        grams = sorted({g for q in queries.values() for a in q for g in a})
        found = candidates(build_index(documents, grams, text), queries)
        df = df.join(found, "key", "left")
    else:
        df = df.withColumn("wanted", F.array().cast("array<int>"))
    each = []
    for n, rule in enumerate(rules):
        wanted = (F.coalesce(F.array_contains("wanted", n), F.lit(False)) if n in queries
                  else F.lit(True))
        each.append(_spans(rule, n, F.col("text"), wanted))
    df = df.withColumn("spans", F.array_sort(F.concat(*each)))
    return unpacked(df, carry, added=["spans"])


def redacted(text, spans, mark=MARK):
    """The text with a mark in place of every stretch that spans cover."""
    end = F.aggregate(
        spans, F.struct(F.lit(0).alias("at"), F.lit("").alias("done")),
        lambda s, x: F.struct(
            F.greatest(s["at"], x["end"]).alias("at"),
            F.when(x["start"] >= s["at"], F.concat(
                s["done"], F.substring(text, s["at"] + 1, x["start"] - s["at"]), F.lit(mark)))
            .otherwise(s["done"]).alias("done")),
        lambda s: F.concat(s["done"], F.substring(text, s["at"] + 1, F.length(text) - s["at"])))
    return F.when(F.size(spans) > 0, end).otherwise(text)


def redact(documents, rules=RULES):
    """Documents with their own columns, secrets replaced by a mark; `n_chars` follows the text."""
    found = find(documents, rules)
    text = redacted(column("text"), F.col("spans"))
    out = found.select(packed(documents_only(found, documents)), text.alias("text"),
                       F.size("spans").alias("found"))
    counted = [c for c in documents.columns if c == "n_chars"]
    added = ["text"] + counted
    if counted:
        out = out.withColumn("n_chars", F.when(F.col("found") > 0, F.length("text").cast(
            documents.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars")))
    return unpacked(out, documents.columns, added=added).select(
        *[column(c) for c in documents.columns])


def documents_only(found, documents):
    return found.select(*[column(c) for c in documents.columns])


def _joined(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(found, base=BASE):
    def of(rank):
        return F.filter("spans", lambda s: s["rank"] == rank)

    counts = [F.size(of(n)).cast("long").alias(f"n_{r.kind}") for n, r in enumerate(base)]
    own = F.filter("spans", lambda s: s["rank"] < len(base))
    return found.select("doc_id", *counts, F.sha2(_joined(own), 256).alias("base_sha256"),
                        _joined("spans").alias("spans"))


def _kind_sql(rank, rule):
    p = rule.pattern.replace("'", "''")
    return f"""
  SELECT r, {rank} AS rank, '{rule.kind}' AS kind, unnest(range(1, len(m) + 1)) AS i,
         list_transform(m, lambda x: len(x)) AS own, list_transform(g, lambda x: len(x)) AS gap,
         list_transform(v, lambda x: len(x)) AS size, {rule.least} AS least
  FROM (SELECT r, regexp_extract_all(t, '{p}') AS m, regexp_extract_all(t, '{p}', {rule.value}) AS v,
               string_split_regex(t, '{p}') AS g FROM docs WHERE regexp_matches(t, '{p}'))"""


ORACLE_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
matches AS ({" UNION ALL ".join(_kind_sql(n, rule) for n, rule in enumerate(RULES))}),
spans AS (
  SELECT r, rank, kind, list_sum(gap[1:i]) + coalesce(list_sum(own[1:i - 1]), 0) AS s,
         list_sum(gap[1:i]) + list_sum(own[1:i]) AS e
  FROM matches WHERE size[i] >= least),
listed AS (
  SELECT r, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
         count(*) FILTER (kind = 'hex') AS n_hex,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, rank)
           FILTER (rank < {len(BASE)}) AS base,
         string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT), ',' ORDER BY s, rank) AS spans
  FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access,
       coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM docs LEFT JOIN listed USING (r)
"""
