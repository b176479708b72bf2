"""From raw documents to a training mix, in stages; each works on what the one before has kept."""

from tarmac.llm import decontaminate, jaccard, mixing, quality, secret_scan
from tarmac.llm.common import ship_code
from tarmac.session import work_folder


def quality_rules(spark, docs, sf_dir):
    """Documents that the quality rules keep; the rejected ones go. Null and empty texts are rejected, an empty table stays empty."""
    ship_code(spark)
    return quality.keep_good(docs)


def near_duplicates(spark, docs, sf_dir):
    """One row of each group of near duplicates, and every row without words."""
    ship_code(spark)
    return jaccard.keep_one(docs)


def benchmark_decontamination(spark, docs, sf_dir):
    """Documents without a passage of the benchmark; null texts have none."""
    ship_code(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_redaction(spark, docs, sf_dir):
    """All documents, secrets replaced by a mark and `n_chars` counted anew; null texts stay null."""
    ship_code(spark)
    return secret_scan.redact(docs)


def source_mixing(spark, docs, sf_dir):
    """Documents as often as the mix takes them, with `shard` and `place`; nothing comes of an empty table."""
    ship_code(spark)
    return mixing.mix(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_scans", secret_redaction),
    ("source_mixing", source_mixing),
]

#: The mix draws by Spark's xxhash64 and numpy's generators, which SQL has not.
ORACLE_SQL = None


def run(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = work_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
