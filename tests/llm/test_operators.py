import hashlib
import os
import random
import re
import zlib

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from texts import prose
from pyspark.sql import functions as F

from tarmac.llm import (
    decontaminate, hosts, jaccard, mixing, quality, quotations, repeats, secret_scan, token_counts, tokens,
    toxicity, trigrams,
)
from tarmac.llm.common import ship_code, utf8
from tarmac.session import SHUFFLES_END, work_folder
from verification.compare import difference

ODD = [(1, None), (2, ""), (3, " \n\t"), (4, "ä" * 30), (None, "eins zwei"), (4, "ä" * 30), (5, "a b c d e f g h i j k")]


def compare(df, sql, **tables):
    db = duckdb.connect()
    for name, table in tables.items():
        db.register(name, table.toArrow())
    assert difference(df, db, sql) is None


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- words ------------------------------------------------------------------------------------

def test_words_of_slices_equal_words_of_the_whole(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(tokens, "SLICE", 16)
    texts = ["Aé b\x00c\x0bd", "", "x" * 100 + " yz", " lead", "tail ", None]
    data, offsets = utf8(pa.array(texts))
    starts, ends, h, first = tokens.words(data, offsets, tokens.SPACED)
    got = [data[a:b].tobytes().decode() for a, b in zip(starts, ends)]
    want = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    assert got == sum(want, []) and np.diff(first).tolist() == [len(w) for w in want]
    assert len(set(h.tolist())) == len(set(w.lower() for w in got))


# --- toxicity ---------------------------------------------------------------------------------

def test_toxic_words_are_learned_and_held_out_rows_are_not_used(spark, documents):
    docs, labels = [], []
    for i in range(400):
        bad = i % 4 == 0
        words = prose(i, 60).split()
        if bad:
            words[10:13] = ["vile", "scum", "vile"]
        docs.append((i, " ".join(words)))
        labels.append((i, 1, int(bad)))
    docs = documents(*docs, *[(9000 + (r[0] or 0), r[1]) for r in ODD])
    labels = spark.createDataFrame(labels + [(1, None, None)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r["doc_id"]: r for r in toxicity.digest(toxicity.score(docs, model)).collect()}
    for i in range(400):
        assert got[i]["predicted"] == int(i % 4 == 0), i
        assert got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 4 == 2)
    assert got[9001]["score"] == got[9002]["score"] < 0.3
    flipped = labels.withColumn("toxic", F.when(toxicity.held_out(), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    assert (toxicity.fit(docs, flipped).scores == model.scores).all()


def test_copies_and_stock_phrases_are_learned(spark, documents):
    docs = [(i, prose(i, 60)) for i in range(400)]
    stock, copied = " ".join(f"stock{k}" for k in range(8)), " ".join(f"copied{k}" for k in range(40))
    docs += [(1000 + i, prose(1000 + i, 30) + f" {stock} " + prose(2000 + i, 20)) for i in range(60)]
    docs += [(3000 + i, copied) for i in range(200)]
    clean = " ".join(f"plain{k}" for k in range(40))
    docs += [(5000 + i, clean) for i in range(200)]
    labels = spark.createDataFrame([(i, 1, int(1000 <= i < 5000)) for i, _ in docs], "doc_id long, quality int, toxic int")
    docs = documents(*docs)
    got = toxicity.digest(toxicity.score(docs, toxicity.fit(docs, labels))).collect()
    assert {r["doc_id"] for r in got if r["predicted"]} == {r["doc_id"] for r in got if 1000 <= r["doc_id"] < 5000}


def test_no_labels_and_no_documents(spark, documents):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r["score"] for r in toxicity.score(documents(*ODD), toxicity.fit(documents(*ODD), none)).collect()} < {0.0, 1e-43} | {
        r["score"] for r in toxicity.score(documents((1, "a")), toxicity.fit(documents((1, "a")), none)).collect()} | {0.0}
    assert toxicity.score(documents(), toxicity.fit(documents(), none)).count() == 0


def test_segments_are_those_of_a_quadratic_search():
    draw = random.Random(3)
    for _ in range(50):
        scores = [draw.choice([-0.3, -0.3, 1.0, 2.0, 0.5]) for _ in range(30)]
        places = [i for i, s in enumerate(scores) if s > 0]
        found = toxicity.segments(places, [scores[i] for i in places])
        best = max((sum(scores[a:b + 1]) for a in range(30) for b in range(a, 30)), default=0)
        assert abs(max((s for _, _, s in found), default=0) - max(best, 0)) < 1e-9
        for a, b, s in found:
            assert abs(sum(scores[a:b + 1]) - s) < 1e-9


def maximal(scores):
    """All maximal segments by definition: the best one, then those left and right of it."""
    best = max(((sum(scores[a:b + 1]), -(b - a), a, b) for a in range(len(scores)) for b in range(a, len(scores))), default=None)
    if best is None or best[0] <= 0:
        return []
    _, _, a, b = best
    return maximal(scores[:a]) + [(a, b)] + [(b + 1 + x, b + 1 + y) for x, y in maximal(scores[b + 1:])]


def test_all_maximal_segments_are_found():
    draw = random.Random(9)
    for _ in range(60):
        scores = [-toxicity.DRIFT if draw.random() < 0.7 else draw.uniform(0.05, 1.0) for _ in range(24)]
        places = [i for i, s in enumerate(scores) if s > 0]
        found = toxicity.segments(places, [scores[i] for i in places])
        assert sorted((a, b) for a, b, _ in found) == maximal(scores)


def test_a_labelled_id_with_many_texts_and_a_long_text(spark, documents):
    docs = [(i, prose(i, 30) + (" vile scum" if i % 3 == 0 else "")) for i in range(90)]
    docs += [(3, prose(500 + i, 30)) for i in range(200)] + [(1, prose(1, 30))] * 50 + [(5000, "ok " * 300000 + "vile scum")]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(90)], "doc_id long, quality int, toxic int")
    model = toxicity.fit(documents(*docs), labels, sample=60)
    assert toxicity.score(documents(*docs), model).count() == len(docs)


# --- mixing -----------------------------------------------------------------------------------

def test_targets_are_capped_and_shared_again():
    assert mixing.targets([100, 100, 100]).tolist() == [50, 100, 150]
    got = mixing.targets([10, 1000, 10])
    assert got[0] == 30 and got[2] == 30 and abs(got.sum() - 1020) < 1e-9
    assert mixing.targets([]).tolist() == [] and mixing.targets([0, 5]).tolist() == [0, 5]


def test_tree_keeps_every_quota():
    leaves = mixing.splitting_tree([100, 0, 7, 40], 6)
    assert leaves.sum(axis=0).tolist() == [100, 0, 7, 40]
    assert max(leaves.sum(axis=1)) - min(leaves.sum(axis=1)) <= 1


def test_targets_by_aggregation(spark):
    draw = random.Random(8)
    for totals in ([100, 100, 100], [10, 1000, 10], [0, 5], [0], [draw.randint(0, 9) ** 5 for _ in range(60)]):
        names = [f"s{i:03}" for i in range(len(totals) - 1)] + [None]
        table = spark.createDataFrame([(n, b, t - t // 2 if b else t // 2) for n, t in zip(names, totals) for b in (0, 1)],
                                      "source string, block int, words long")
        got = {r["source"]: (r["number"], r["source_size"], r["target"]) for r in mixing.catalogue(table).collect()}
        want = mixing.targets(totals).tolist()
        assert [got[n][:2] for n in names] == list(enumerate(totals))
        assert all(abs(got[n][2] - w) < 1e-6 for n, w in zip(names, want))


def test_more_sources_than_one_draw_takes(documents, monkeypatch):
    monkeypatch.setattr(mixing, "RANGE", 8)
    docs = documents(*[(i, prose(i, 10 + i % 7), "en", f"s{i % 50:02}") for i in range(500)], (900, "x" * 50000, "en", "s01"))
    by_broadcast = rows(mixing.digest(mixing.assign(docs)))
    by = {}
    for _, size, source_size, target, taken in by_broadcast:
        assert taken <= 3 * size
        by.setdefault((source_size, target), []).append(taken)
    assert len(by_broadcast) == 501 and sum(map(sum, by.values())) > 0
    monkeypatch.setattr(mixing, "PLAN_ROWS", 0)
    assert rows(mixing.digest(mixing.assign(docs))) == by_broadcast
    shards = mixing.mix(docs, shards=4).groupBy("shard").count().collect()
    assert len(shards) == 4 and mixing.digest(mixing.assign(documents())).count() == 0


def test_mix_meets_targets_and_repeats_itself(documents):
    docs = documents(*[(i, prose(i, 20 + i % 30), "en", ["a", "b", None][i % 3]) for i in range(600)],
                     (None, "x y", "en", "z"), (7, None, "en", "z"), (7, "", "en", "z"))
    got = mixing.digest(mixing.assign(docs))
    first = rows(got)
    assert first == rows(mixing.digest(mixing.assign(docs.repartition(5))))
    by = {}
    for _, size, source_size, target, taken in first:
        assert taken <= 3 * size
        by.setdefault((source_size, target), []).append(taken)
    for (_, target), taken in by.items():
        assert abs(sum(taken) - target) <= max(4, target / 100)
    mixed = mixing.mix(docs, shards=4)
    assert sum(len((r["text"] or "").split()) for r in mixed.collect()) == sum(r[4] for r in first)
    assert {"shard", "place"} <= set(mixed.columns) and mixing.mix(documents()).count() == 0


# --- secrets ----------------------------------------------------------------------------------

def test_trigram_queries():
    assert trigrams.query("AKIA[A-Z]+") == [frozenset({"aki", "kia"})]
    assert trigrams.query("[0-9a-f]{24,}") is None and trigrams.query("ab?c") is None
    assert set(trigrams.query("(foo|ba[rz])x")) == {frozenset({"foo", "oox"}), frozenset({"bar", "arx"}), frozenset({"baz", "azx"})}


SECRETS = ['token = "abcdef12"', "TOKEN=token:abcdefgh", "xAKIA" + "A1" * 9, "é" + "0af" * 9 + " api_key: 'qwe.rt-y'",
           "password=ab secret:    longer/one", "ghp_" + "a" * 36 + "\neyJ" + "a" * 10 + ".eyJ" + "b" * 12 + ".c", "AKIA12"]


def test_spans_equal_sql_and_python(documents):
    docs = documents(*ODD, *[(100 + i, "so " + s + " and " + s + " end") for i, s in enumerate(SECRETS)])
    got = secret_scan.find(docs)
    compare(secret_scan.digest(got), secret_scan.ORACLE_SQL, documents=docs)
    for r in got.collect():
        want = []
        for rank, rule in enumerate(secret_scan.RULES):
            want += [(m.start(), rank, m.end(), rule.kind) for m in re.finditer(rule.pattern, r["text"] or "")
                     if len(m.group(rule.value)) >= rule.least]
        assert [tuple(s) for s in r["spans"]] == sorted(want)


def test_redacted_texts_hold_no_secret(documents):
    docs = documents(*ODD, *[(100 + i, "so " + s + " end") for i, s in enumerate(SECRETS)])
    out = secret_scan.redact(docs)
    assert out.columns == docs.columns and out.count() == docs.count()
    for r in out.collect():
        assert r["text"] is None or r["n_chars"] == len(r["text"])
        if r["doc_id"] in (100, 102, 103):
            assert secret_scan.MARK in r["text"] and "0af0af" not in r["text"]


def test_a_text_of_many_secrets_and_no_texts(documents):
    text = "é " + " ".join(f"token=abc{i:05} AKIA{'B3' * 9}" for i in range(3000))
    docs = documents((1, text), (2, text), (3, "x" * 200000))
    got = {r["doc_id"]: r for r in secret_scan.digest(secret_scan.find(docs)).collect()}
    want = sorted((m.start(), rank, m.end(), rule.kind) for rank, rule in enumerate(secret_scan.RULES)
                  for m in re.finditer(rule.pattern, text) if len(m.group(rule.value)) >= rule.least)
    listed = ",".join(f"{kind}:{start}:{end}" for start, _, end, kind in want)
    assert got[1]["spans"] == got[2]["spans"] == listed and got[3]["spans"] == ""
    assert got[1]["n_assign"] == got[1]["n_access"] == 3000
    assert got[1]["base_sha256"] == hashlib.sha256(listed.encode()).hexdigest()
    assert secret_scan.redact(docs).where("doc_id = 1").first()["text"] == "é" + f" {secret_scan.MARK}" * 6000
    assert secret_scan.find(documents()).count() == 0 and secret_scan.redact(documents()).count() == 0


# --- n-gram join ------------------------------------------------------------------------------

def test_join_finds_the_components_of_brute_force(documents):
    draw = random.Random(5)
    texts = list(ODD) + [(10, "eins zwei"), (11, "EINS  zwei"), (12, "a b c"), (13, "a b c d")]
    for g in range(12):
        base = prose(g, 120).split()
        for k in range(8):
            copy = list(base)
            for _ in range(draw.randint(0, 4)):
                copy[draw.randrange(len(copy))] = draw.choice("xyz") * draw.randint(1, 3)
            texts.append((100 * g + 20 + k, " ".join(copy)))
    got = rows(jaccard.join(documents(*texts)))
    assert got == sorted(jaccard.brute_force(texts), key=repr)
    kept = jaccard.keep_one(documents(*texts))
    assert kept.columns == documents().columns
    ids = [r["doc_id"] for r in kept.collect()]
    named = {c for d, n, c in got if n and c is not None}
    assert sorted(x for x in ids if x is not None and x > 3) == sorted(x for x in named if x > 3)
    assert {1, 2, 3} <= set(ids)


def test_one_row_of_each_component_stays(documents):
    a, b, c, d = (prose(900 + i, 60) for i in range(4))
    texts = [(1, a), (7, a + " more"), (7, b), (7, b + " more"), (8, b), (None, a), (None, c), (None, c + " x"),
             (9, d), (9, d), (None, ""), (None, "")]
    kept = rows(jaccard.keep_one(documents(*texts)).select("doc_id", "text"))
    assert [r for r in kept if r[1] == ""] == [(None, "")] * 2
    left = {(doc, next(x for x in (a, b, c, d) if text.startswith(x))) for doc, text in kept if text}
    assert len(kept) == 6 and left == {(1, a), (7, b), (None, c), (9, d)}


def test_join_of_nothing(documents):
    assert jaccard.join(documents()).count() == 0 and jaccard.keep_one(documents()).count() == 0


# --- token counts -----------------------------------------------------------------------------

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"


def test_jaccard_cuts_texts_once_for_its_prefixes(spark, documents, monkeypatch):
    """The rows of the prefix n-grams are stored once, though counted and joined; sets come sorted, each n-gram once."""
    from tarmac.llm import common
    batch = pa.RecordBatch.from_pydict({"text": [None, "b a", "a b c d e a b c d e f", "", "x " * 9, "a b c d e"]})
    row, gram, sizes = jaccard._sets(batch, 5)
    assert sizes.tolist() == [0, 1, 7 - 1, 0, 1, 1] and row.tolist() == [1] + [2] * 6 + [4, 5]
    assert all(a < b for i, a, j, b in zip(row[:-1], gram[:-1], row[1:], gram[1:]) if i == j)
    assert gram[-1] in gram[1:7]
    kept = []
    monkeypatch.setattr(jaccard, "stored", lambda df, purpose: kept.append((purpose, df)) or common.stored(df, purpose))
    jaccard.Join(documents((1, "a b c d e f g"), (2, "a b c d e f h"))).prefixes()
    scans = [purpose for purpose, df in kept if "mapInArrow" in df._jdf.queryExecution().logical().toString()
             or "MapInArrow" in df._jdf.queryExecution().logical().toString()]
    assert scans == ["first"]


@pytest.mark.parametrize("find, stays", [(jaccard.join, {"rooted"}), (jaccard.keep_one, {"chosen"})])
def test_jaccard_leaves_only_what_its_result_reads(spark, documents, find, stays):
    work_folder(spark, "x")  # a session's first call chooses the folder
    root = work_folder(spark, "x").rsplit("/", 1)[0].removeprefix("file:")
    before, setting = set(os.listdir(root)), spark.conf.get(SHUFFLES_END, "false")
    long = [prose(i, 40) for i in range(4)]
    texts = [(10 * i + j, t + f" end{j}" * (j > 0)) for i, t in enumerate(long) for j in range(3)] + [(90, ""), (91, None)]
    got = find(documents(*texts))
    left = set(os.listdir(root)) - before
    assert {p.rsplit("-", 1)[0] for p in left} == stays and len(left) == len(stays)
    assert spark.conf.get(SHUFFLES_END, "false") == setting
    ids = {0, 10, 20, 30, 90, 91}
    assert {r["component_id" if find is jaccard.join else "doc_id"] for r in got.collect()} == ids


def test_counts_after_edits_equal_counts_from_scratch():
    count = token_counts.encoder(VOCABULARY)
    draw = random.Random(1)
    for _ in range(60):
        text = "".join(draw.choice(["ab", " ", "\n", "  ", "x1", "é!", "'s", " the"]) for _ in range(200))
        tree = token_counts.Tree(text, count)
        assert tree.tokens[1] == count(text)
        for _ in range(8):
            a, b = draw.randrange(len(text) + 3), draw.randrange(len(text) + 3)
            new = draw.choice(["", " ", "zz top", "\n\n", "a" * 150 + " b" * 60])
            tree.edit(a, b, new)
            a, b = min(a, len(text)), max(min(a, len(text)), min(b, len(text)))
            text = text[:a] + new + text[b:]
            assert (tree.text(), tree.tokens[1], tree.chars[1]) == (text, count(text), len(text))


def test_a_small_edit_encodes_little(documents):
    docs = documents(*ODD, (50, prose(1, 5000)))
    got = {r["doc_id"]: r for r in token_counts.count(docs, token_counts.heading_edits(), VOCABULARY).collect()}
    assert got[50]["n_encoded"] > 0 and got[1]["n_tokens"] == 0
    text = prose(1, 5000)
    edit = F.array(F.struct(F.lit(9000).alias("start"), F.lit(9001).alias("end"), F.lit("Q").alias("replacement")))
    row = token_counts.count(documents((1, text)), edit, VOCABULARY).first()
    assert row["n_encoded"] < 300
    assert row["n_tokens_after"] == token_counts.encoder(VOCABULARY)(text[:9000] + "Q" + text[9001:])


def changes(*some):
    return F.array(*[F.struct(F.lit(a).alias("start"), F.lit(b).alias("end"), F.lit(new).alias("replacement"))
                     for a, b, new in some])


def test_stored_trees_are_edited_again(documents):
    """Two runs over the stored trees give what one run with all edits gives, and counts from scratch."""
    texts = {1: prose(1, 3000), 2: "", 3: "x" * 5000, 4: None}
    one, two = [(7, 9, " new words"), (2000, 2500, None)], [(100, 100, "\n\n  inserted, and more" * 80), (0, 5, "")]
    docs = documents(*texts.items(), (1, texts[1]))
    trees = token_counts.plant(docs, VOCABULARY)
    assert sorted(trees.columns) == ["doc_id", "sizes", "text", "tokens"]
    first = token_counts.stored(token_counts.edited(trees.withColumn("edits", changes(*one)), VOCABULARY), "edited")
    second = token_counts.edited(first.withColumn("edits", changes(*two)), VOCABULARY).collect()
    count = token_counts.encoder(VOCABULARY)
    assert len(second) == 5
    for row in second:
        text = texts[row["doc_id"]] or ""
        for a, b, new in one + two:
            a = min(a, len(text))
            text = text[:a] + (new or "") + text[max(a, min(b, len(text))):]
        assert (row["text"], row["n_tokens_after"], row["n_chars_after"]) == (text, count(text), len(text))
        assert (sum(row["sizes"]), sum(row["tokens"])) == (len(text), count(text)) and 0 not in row["sizes"]
    whole = token_counts.count(docs, changes(*one, *two), VOCABULARY).collect()
    assert sorted((r["doc_id"], r["n_tokens_after"], r["n_edits"]) for r in whole) == sorted(
        (r["doc_id"], r["n_tokens_after"], 4) for r in second)
    untouched = token_counts.edited(first.withColumn("edits", F.array().cast("array<struct<start:int,end:int,replacement:string>>")),
                                    VOCABULARY).collect()
    assert all(r["n_encoded"] == 0 and r["n_tokens"] == r["n_tokens_after"] for r in untouched)
    assert token_counts.count(documents(), changes(*one), VOCABULARY).count() == 0


def test_many_insertions_at_one_place_lay_out_the_sums_rarely(monkeypatch):
    count = token_counts.encoder(VOCABULARY)
    text = prose(5, 2000)
    tree = token_counts.Tree(text, count)
    built = []
    build = token_counts.Tree.build
    monkeypatch.setattr(token_counts.Tree, "build", lambda self, leaves: built.append(len(leaves)) or build(self, leaves))
    for i in range(300):
        tree.edit(4000, 4000, f" word{i}")
        text = text[:4000] + f" word{i}" + text[4000:]
    assert (tree.text(), tree.tokens[1]) == (text, count(text))
    assert len(built) <= 3 and tree.encoded < 300 * 2 * token_counts.WIDEST


# --- quality ----------------------------------------------------------------------------------

def test_quality_equals_sql(documents):
    good = [(100 + i, "The " + " of the and to ".join(prose(50 + i, 80).split()) + ".") for i in range(20)]
    bad = [(200, "### " * 60 + "%% $$ ||" * 30), (201, "ABC DEF GHI " + prose(3, 90).upper()),
           (202, "one two three four five six\n" * 9), (203, "a b c d e f g h i j\n \na b c d e f g h i j")]
    docs = documents(*ODD, *good, *bad, (300, prose(9, 70), "xx"), (301, prose(9, 70), None))
    judged = quality.judge(docs)
    compare(quality.digest(judged), quality.ORACLE_SQL, documents=docs)
    kept = {r["doc_id"]: r["kept"] for r in judged.collect()}
    assert all(kept[i] for i, _ in good) and not any(kept[i] for i in (200, 201, 202))
    assert quality.keep_good(docs).columns == docs.columns and quality.judge(documents()).count() == 0


@pytest.mark.parametrize("near", [False, True])
def test_a_junk_text_in_a_third_of_the_rows_does_not_become_the_reference(documents, near):
    good = [(i, "The " + " of the and to ".join(prose(50 + i, 80).split()) + ".") for i in range(40)]
    junk = "#$ %& |<> " + " ".join(f"#{w.upper()}$%" for w in prose(9, 90).split())
    docs = documents(*good, *[(100 + i, junk + (f" <{i}>" if near else "")) for i in range(20)])
    assert {r["doc_id"] for r in quality.keep_good(docs).collect()} == {i for i, _ in good}
    mostly = documents(*good[:20], *[(100 + i, junk) for i in range(200)])
    assert {r["doc_id"] for r in quality.keep_good(mostly).collect()} == {i for i, _ in good[:20]}
    for rows in (docs, mostly):
        compare(quality.digest(quality.judge(rows)), quality.ORACLE_SQL, documents=rows)


def test_languages_are_not_held_against_others(documents):
    good = [(i, "The " + " of the and to ".join(prose(50 + i, 80).split()) + ".") for i in range(20)]
    greek = str.maketrans("abcdefghij", "αβγδεζηθικ")
    other = [(100 + i, prose(i, 80).translate(greek), "el") for i in range(20)]
    few = [(200, prose(1, 80).translate(greek), "xx"), (201, prose(2, 80).translate(greek), None)]
    junk = [(300, " ".join(f"#{w.upper()}$%" for w in prose(9, 90).split()), "el")]
    for docs in (documents(*good, *other, *few, *junk), documents(*other, *few, *junk)):
        assert {r["doc_id"] for r in quality.keep_good(docs).where("doc_id >= 100").collect()} == {
            r[0] for r in other + few}
        compare(quality.digest(quality.judge(docs)), quality.ORACLE_SQL, documents=docs)


# --- quotations -------------------------------------------------------------------------------

MESSAGES = "thread long, turn long, role string, text string, place string, row long"
MAIL = [
    (1, 0, "u", "Hello there\nfriend\n\nSecond  paragraph\nof two lines"), (1, 1, "a", "Hi"), (1, 2, "u", "a > b\nyes"),
    (1, 3, "a", "> second paragraph of\n> two lines\nonly one paragraph"), (1, 4, "u", "> Hi\n> a > b\ntwo messages"),
    (1, 5, "a", "> > Hello there\n> > friend\n> Hi\n> yes\nnested"), (1, 6, "a", "> not a quote of anyone\nkept"),
    (1, 7, "u", "> > friend\nonly deep"), (1, 8, "u", "> nested\n>\n> not a quote of anyone\n>\n> only deep\nmixed"),
    (1, 9, "u", "> hi\n"), (1, 9, "u", "> hi\n"), (1, 9, "u", "twin"), (1, 10, "a", "> twin\n> mixed"), (1, None, "a", "> Hi"),
    (2, 0, "u", None), (2, 1, "a", "x"), (2, 1, "a", "> x"), (2, 2, "u", ""), (2, 3, "u", "> \n>"), (None, 0, "u", "x"),
    (None, 1, "u", "> x\nnone"), (3, 5, "u", "ok"), (3, 3, "u", "ok"), (3, 4, "u", "> ok"), (3, 9, "u", "> ok"), (3, 1, "u", "> ok")]


def conversations_of(spark, messages):
    ship_code(spark)
    table = spark.createDataFrame([(*m, "p", 5) for m in messages], MESSAGES)
    return rows(quotations.digest(quotations.conversations(table)))


def as_digest(found):
    return sorted([(*f[:9], ",".join(f"{a}:{b}" for a, b in f[9])) for f in found], key=repr)


def test_conversations_equal_brute_force(spark):
    want = quotations.brute_force(MAIL)
    assert conversations_of(spark, MAIL) == as_digest(want)
    by = {(w[0], w[1]): w for w in want}
    assert by[1, 3][3:5] == ("only one paragraph", 0) and by[1, 4][3:5] == ("two messages", 2)
    assert by[1, 4][9] == [(1, 1), (1, 2)] and by[1, 5][9] == [(1, 1), (1, 2), (2, 0)]
    assert by[1, 6][3] == "> not a quote of anyone\nkept" and by[1, 6][4] is None
    assert by[1, 7][3:5] == ("only deep", 0) and by[1, 8][3] == "> not a quote of anyone\nmixed"
    assert by[3, 9][4] == 5 and by[3, 4][4] == 3 and by[3, 1][4] is None and by[1, 10][4] == 9


def test_long_threads_and_texts(spark):
    draw = random.Random(6)
    mail = []
    for turn in range(120):
        quoted = mail[draw.randrange(turn)][3] if turn else ""
        quoted = "\n".join("> " + line for line in quoted.split("\n")) + "\n" if quoted else ""
        mail.append((7, turn, "u", quoted + draw.choice(["ok", prose(turn, 30), prose(turn, 4) + "\n" + prose(turn + 1, 5)])))
    mail.append((7, 200, "u", "\n".join("> ok" for _ in range(3000)) + "\n" + "word " * 50000))
    assert conversations_of(spark, mail) == as_digest(quotations.brute_force(mail))


def test_quotes_are_parsed_as_the_sql_does(spark):
    table = spark.createDataFrame(
        [(1, i, "u", t) for i, t in enumerate(["Hello there\nfriend", "Hi", "a > b", "Hi", "", "x\n\ny", "ok", None, "ok"])]
        + [(2, 0, "u", None), (2, 1, "a", "x"), (2, 2, "a", "> x\nfound"), (2, 3, "a", "> nowhere\nz")],
        "conv_id long, turn long, role string, text string")
    ship_code(spark)
    compare(quotations.digest(quotations.conversations(quotations.quoting(table))), quotations.ORACLE_SQL, conversations=table)


def test_no_messages(spark):
    assert conversations_of(spark, []) == []


# --- decontamination --------------------------------------------------------------------------

@pytest.mark.parametrize("slice_windows", [200_000, 3])
def test_hits_equal_brute_force_and_sql(spark, documents, slice_windows):
    items = [(1, prose(1, 14)), (2, "Short item"), (3, None), (4, " ,. "), (10, prose(1, 14).upper()), (5, prose(2, 10))]
    texts = list(ODD) + [(20, prose(8, 9) + " " + prose(1, 14) + ". " + prose(9, 5)), (21, "a short, ITEM"),
                         (22, prose(2, 9)), (23, prose(2, 10) + " " + prose(2, 10)), (24, prose(30, 50))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    docs = documents(*texts)
    found = decontaminate.find(docs, benchmark, slice_windows=slice_windows)
    want = decontaminate.brute_force([t for _, t in texts], items)
    assert rows(decontaminate.digest(found)) == sorted(
        [(i, *w, w[1] > 0) for (i, _), w in zip(texts, want)], key=repr)
    compare(decontaminate.digest(found), decontaminate.ORACLE_SQL, documents=docs, benchmark=benchmark)
    left = {r["doc_id"] for r in decontaminate.decontaminate(docs, benchmark).collect()}
    assert left.isdisjoint({20, 21, 23}) and {22, 24} <= left
    spans = decontaminate.decontaminate(docs, benchmark, remove="spans")
    assert decontaminate.find(spans, benchmark).where("size(runs) > 0").count() == 0 and spans.count() == len(texts)


def test_no_documents_no_benchmark_and_a_long_text(spark, documents):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, prose(1, 12))], "item_id long, text string")
    assert decontaminate.find(documents(), some).count() == 0
    assert not any(r["contaminated"] for r in decontaminate.digest(decontaminate.find(documents(*ODD), none)).collect())
    text = "word " * 200000 + prose(1, 12) + " end" * 1000
    row = decontaminate.digest(decontaminate.find(documents((1, text)), some)).first()
    assert (row["n_words"], row["n_hit"], row["n_items"]) == (201012, 12, 1)


# --- hosts ------------------------------------------------------------------------------------

def test_domains_below_public_suffixes(spark):
    names = spark.createDataFrame([(h,) for h in ("a.b.co.uk", "b.co.uk", "co.uk", "x.github.io:80", "a.b.com", "com", "", "10.0.0.1")], "host string")
    got = {r["host"]: (r["suffix"], r["domain"]) for r in hosts.levels(names).collect()}
    assert got == {"a.b.co.uk": ("co.uk", "b.co.uk"), "b.co.uk": ("co.uk", "b.co.uk"), "co.uk": ("co.uk", "co.uk"),
                   "x.github.io:80": ("github.io", "x.github.io"), "a.b.com": ("com", "b.com"), "com": ("com", "com"),
                   "": ("", ""), "10.0.0.1": ("", "10.0.0.1")}


def test_urls_equal_sql(spark):
    urls = [None, "", "nourl", "http://A.example.ORG/es/1?q", "https://x.example.org/en/12#a", "http://b.com/de/1",
            "http://b.com/de/2", "http://b.com/x", "ftp://b.com", "http://c.net/fr/", "http://a.co.uk/z", "http://b.co.uk:8/z", "x://10.0.0.1:80/a", "http://q.com/fr/a://b"]
    pages = spark.createDataFrame([(i % 9, u, "h", "r") for i, u in enumerate(urls * 3)], "page_id long, url string, host string, rule string")
    judged = hosts.judge(pages)
    compare(hosts.digest(judged), hosts.ORACLE_SQL, pages=pages)
    assert {r["verdict"] for r in judged.where("path = '/x'").collect()} == {"block"}
    assert hosts.judge(pages.limit(0)).count() == 0 and hosts.allowed(pages).columns == pages.columns


# --- repeated strings -------------------------------------------------------------------------

def test_removed_bytes_equal_brute_force(documents, monkeypatch):
    draw = random.Random(2)
    passages = [prose(100 + i, 90) for i in range(4)]
    texts = list(ODD) + [(50, "x" * 900), (51, "ab" * 500), (52, prose(7, 400)), (53, prose(7, 400))]
    for i in range(40):
        parts = [prose(200 + i, draw.randint(5, 60)) for _ in range(2)]
        passage = draw.choice(passages)
        a, b = sorted((draw.randrange(len(passage)), draw.randrange(len(passage))))
        texts.append((60 + i, parts[0] + (passage if i % 3 else passage[a:b] + "ü" + passage[b:]) + parts[1]))
    got = rows(repeats.measure(documents(*texts)))
    want = sorted([(i, *w) for (i, _), w in zip(texts, repeats.brute_force([t for _, t in texts]))], key=repr)
    assert got == want
    assert hashlib.sha256(b"").hexdigest() in {g[4] for g in got}
    assert repeats.measure(documents()).count() == 0
    cut = repeats.remove(documents(*texts))
    assert {r["doc_id"]: len(r["text"]) for r in cut.collect()}[51] == 0


@pytest.mark.parametrize("chunk", [1000, 403])
def test_texts_scanned_in_small_chunks_lose_the_same(documents, chunk):
    shared, long = prose(1, 200), prose(2, 1500)
    texts = list(ODD) + [(50, long + shared + long[:3000]), (51, prose(3, 700) + shared), (52, shared), (53, shared),
                         (54, "ab" * 1500), (55, long[2000:2500] + "ü" + prose(4, 300))]
    got = rows(repeats.measure(documents(*texts), chunk=chunk))
    assert got == sorted([(i, *x) for (i, _), x in zip(texts, repeats.brute_force([t for _, t in texts]))], key=repr)


def test_unlike_stretches_whose_hashes_collide_are_kept(documents):
    """A Thue-Morse word of 1024 letters and its complement have one polynomial hash modulo 2^64, whatever the base."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(1024))
    other = word.translate(str.maketrans("ab", "ba"))

    def runs(text):
        raw = np.frombuffer(text.encode(), np.uint8)
        return repeats._runs(raw, np.array([0, len(raw)]), w=1100)

    for seed in range(500):  # until the anchor lies in what both have in common
        head, tail = prose(seed, 20)[:38], prose(1000 + seed, 20)[:38]
        one, two = runs(head + word + tail), runs(head + other + tail)
        if one[1][0] == two[1][0] <= 6:
            break
    assert one[4][0] == two[4][0] and one[5][0] == two[5][0] and one[6][0] != two[6][0]
    texts = [(1, head + word + tail), (2, head + other + tail), (3, prose(7, 300)), (4, prose(7, 300))]
    got = rows(repeats.measure(documents(*texts), w=1100))
    assert got == sorted([(i, *x) for (i, _), x in zip(texts, repeats.brute_force([t for _, t in texts], w=1100))])
    assert [r[2] for r in got[:2]] == [0, 0] and got[2][2] > 0
