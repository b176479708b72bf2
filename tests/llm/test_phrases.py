import random
import re
from collections import Counter
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
from texts import prose
from test_operators import ODD, compare, rows

from tarmac.llm import phrases


def some_texts():
    draw = random.Random(4)
    stock = ["new york city", "New York", "a b c d", "zu der", "x" * 300 + " y", "é ü", "of the of the of"]
    texts = list(ODD)
    for i in range(120):
        words = []
        for _ in range(draw.randint(1, 30)):
            words.append(draw.choice([draw.choice(stock), draw.choice("abcd"), draw.choice([".", ";", "\n", "\t", ", a"])]))
        texts.append((100 + i, draw.choice([" ", "  "]).join(words), draw.choice(["en", "de", None])))
    return texts


def windows_of(texts, width, flags):
    batch = pa.RecordBatch.from_pydict({"lang": pa.array([(t[2] or "und") if len(t) > 2 else "en" for t in texts], pa.string()),
                                        "text": pa.array([t[1] for t in texts], pa.string())})
    out = Counter()
    for part in phrases._windows(SimpleNamespace(value=np.packbits(flags)), width)([batch]):
        for row in part.to_pylist():
            out[tuple(row[c] for c in ["lang", *phrases.COLUMNS])] += row["n"]
    return out


def test_slices_cut_through_windows(monkeypatch):
    texts = [t for t in some_texts() if t[1] is not None]
    whole = windows_of(texts, 1 << 12, np.ones(1 << 12, bool))
    assert sum(whole.values()) == sum(len(re.findall(r"[^ \t.,;:!?\n\v\f\r]+", t[1])) for t in texts)
    monkeypatch.setattr(phrases, "CHUNK", 7)
    assert windows_of(texts, 1 << 12, np.ones(1 << 12, bool)) == whole
    assert all(k[2] is None for k in windows_of(texts, 1 << 12, np.zeros(1 << 12, bool)))


@pytest.mark.parametrize("width", [1 << 24, 1 << 12, 8])
def test_phrases_equal_brute_force(documents, width):
    # A counter table of 8 is full at once, so nothing is padded early.
    texts = some_texts()
    docs = documents(*texts)
    want = phrases.brute_force([(t[1], t[2] if len(t) > 2 else "en") for t in texts], least=5, top=12)
    assert rows(phrases.mine(docs, least=5, top=12, width=width)) == sorted(want, key=repr)
    assert any(r[0] == phrases.NO_LANG for r in want) and any(len(r[2].split()) == 4 for r in want)


def test_phrases_equal_sql(documents):
    docs = documents(*some_texts() * 3, (900, "one two. " * 30000), (901, None, None), (901, "", ""))
    compare(phrases.mine(docs), phrases.ORACLE_SQL, documents=docs)


def test_ties_and_scores_beyond_64_bits(spark):
    frequent = spark.createDataFrame(
        [("en", 1, "a", "a", None, None, None, 4 * 10 ** 17), ("en", 1, "b", "b", None, None, None, 4 * 10 ** 17),
         ("en", 2, "a b", "a", "b", None, None, 3 * 10 ** 17), ("en", 2, "b a", "b", "a", None, None, 3 * 10 ** 17),
         ("en", 3, "a b a", "a", "b", "a", None, 24 * 10 ** 16)],
        "lang string, size int, phrase string, w1 string, w2 string, w3 string, w4 string, f long")
    scored = phrases.scored(frequent)
    assert rows(scored.select("phrase", "score", "l")) == [
        ("a b a", 685714, 4 * 10 ** 17), ("a b", 750000, 4 * 10 ** 17), ("b a", 750000, 4 * 10 ** 17)]
    assert rows(phrases.standing(scored).select("phrase")) == [("a b a",)]


def test_no_documents(documents):
    assert phrases.mine(documents()).count() == 0
    assert phrases.mine(documents((1, None), (2, " ,;\n"), (3, prose(1, 50)))).count() == 0


def test_counters_grow_with_the_text(spark, monkeypatch):
    """A table of one width is full on a large corpus, and then no window is padded."""
    texts = spark.range(40).selectExpr("repeat('a', 100) as text")
    assert phrases.fitting(texts) == phrases.WIDTH
    monkeypatch.setattr(phrases, "WIDTH", 8)
    assert phrases.fitting(texts) == 64  # 4,000 bytes
    monkeypatch.setattr(phrases, "WIDEST", 32)
    assert phrases.fitting(texts) == 32
    assert phrases.fitting(texts.limit(0)) == 8


def test_counters_do_not_overflow(spark):
    """One phrase more often than a counter of two bytes can hold, in one slice."""
    docs = spark.createDataFrame([("x " * 140_000 + "y z", "en")], "text string, lang string")
    flags = np.unpackbits(phrases.often(docs, 30, 1 << 12)).astype(bool)
    assert 1 <= flags.sum() <= 3  # x x, x x x, x x x x; the others occur once


def test_shuffles_go_before_the_next_step(spark, monkeypatch):
    from tarmac.session import SHUFFLES_END
    seen, keep = [], phrases.stored
    monkeypatch.setattr(phrases, "stored", lambda df, name: seen.append((name, spark.conf.get(SHUFFLES_END, "false"))) or keep(df, name))
    docs = spark.createDataFrame([("a b c", "en")] * 40, "text string, lang string")
    assert phrases.mine(docs).count() > 0
    assert seen == [("phrases", "true"), ("scored", "true")]
