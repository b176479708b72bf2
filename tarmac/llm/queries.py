"""Registered queries of the operators, and DuckDB SQL where SQL can express a result."""

import os

import corpus_pipeline
from tarmac.llm import (
    decontaminate, hosts, jaccard, merkle, mixing, neighbours, phrases, quality, quotations, repeats, token_counts, toxicity,
)
from tarmac.llm import secret_scan as secrets
from tarmac.llm.common import ship_code

#: A rank file of a public byte-level vocabulary, at the same path on every machine.
VOCABULARY = os.environ.get("TARMAC_VOCABULARY", "/opt/tokenizers/byte_bpe_50k.tiktoken")

QUERIES = {}
EXPECTED = {}


def query(name, sql=None):
    def register(build):
        assert name not in QUERIES, name
        QUERIES[name] = lambda spark, folder: build(ship_code(spark), folder)
        if sql:
            EXPECTED[name] = sql
        return build
    return register


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query("op1_toxicity")
def op1(spark, folder):
    documents = table(spark, folder, "documents")
    return toxicity.digest(toxicity.score(documents, toxicity.fit(documents, table(spark, folder, "labels"))))


@query("op2_mixing")
def op2(spark, folder):
    return mixing.digest(mixing.assign(table(spark, folder, "documents")))


@query("op3_secrets", secrets.ORACLE_SQL)
def op3(spark, folder):
    return secrets.digest(secrets.find(table(spark, folder, "documents"), carry=["doc_id"]))


@query("op4_jaccard_join")
def op4(spark, folder):
    return jaccard.join(table(spark, folder, "documents"))


@query("op5_token_counts")
def op5(spark, folder):
    return token_counts.count(table(spark, folder, "documents"), token_counts.heading_edits(), VOCABULARY)


@query("op7_quotations", quotations.ORACLE_SQL)
def op7(spark, folder):
    return quotations.digest(quotations.conversations(quotations.quoting(table(spark, folder, "conversations"))))


@query("op6_quality", quality.ORACLE_SQL)
def op6(spark, folder):
    return quality.digest(quality.judge(table(spark, folder, "documents"), carry=["doc_id"]))


@query("op8_decontamination", decontaminate.ORACLE_SQL)
def op8(spark, folder):
    found = decontaminate.find(table(spark, folder, "documents"),
                               table(spark, folder, "benchmark"), carry=["doc_id"])
    return decontaminate.digest(found)


@query("op9_url_filters", hosts.ORACLE_SQL)
def op9(spark, folder):
    return hosts.digest(hosts.judge(table(spark, folder, "pages")))


@query("op10_repeats")
def op10(spark, folder):
    return repeats.measure(table(spark, folder, "documents"))


@query("op11_neighbours")
def op11(spark, folder):
    return neighbours.nearest(table(spark, folder, "embeddings"))


@query("op12_phrases", phrases.ORACLE_SQL)
def op12(spark, folder):
    return phrases.mine(table(spark, folder, "documents"))


@query("op13_merkle")
def op13(spark, folder):
    return merkle.manifest(table(spark, folder, "documents"))


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def pipeline(spark, folder):
    return corpus_pipeline.run(spark, folder)
