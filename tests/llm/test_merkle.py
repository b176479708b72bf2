import pytest
from texts import prose
from test_operators import ODD, rows

from tarmac.llm import merkle


def check(docs, levels=merkle.LEVELS):
    want = merkle.brute_force([tuple(r) for r in docs.select("doc_id", "source", "lang", "n_chars", "text").collect()])
    assert rows(merkle.manifest(docs, levels=levels)) == sorted(want, key=repr)
    return want


@pytest.mark.parametrize("levels", [8, 2, 1])
def test_manifest_equals_brute_force(documents, levels):
    # One source holds most rows; small superblocks need several rounds.
    texts = [(i, prose(i, 5) + ("\n" * (i % 3)) + "é", "en", "hot") for i in range(100)]
    texts += [(i % 7, None if i % 5 == 0 else f"a{i % 3}\n", None, ["b", None, "", "ä", "z"][i % 5]) for i in range(33)]
    texts += [(1000 + i, "one\n", "en", f"s{i:03}") for i in range(30)]
    want = check(documents(*ODD, *texts, (None, "null\n", None, "hot"), (50, "x" * 300000 + "\n", "en", "hot")), levels)
    # Only rows with an even checksum and a line end fail.
    assert 0 < sum(not w[-1] for w in want) < len(want) / 2


def test_single_documents_and_none(documents):
    (only,) = check(documents((7, "a\n")))
    assert only[1] == only[2] == only[3] and only[4] == merkle.digest("")
    check(documents((7, "a\n"), (7, "a\n")))
    assert merkle.manifest(documents()).count() == 0


def test_another_change_is_found(documents):
    from pyspark.sql import functions as F
    docs = documents(*[(i, prose(i, 5)) for i in range(20)])
    out = merkle.manifest(docs, tampered=F.when(F.col("doc_id") == 4, F.lit("forged")).otherwise(F.col("text")))
    assert [r["doc_id"] for r in out.where("not verified").collect()] == [4]
