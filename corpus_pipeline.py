"""The corpus pipeline: quality, near duplicates, benchmark passages, source mix, shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
and reread as the next stage's docs. All but the last return the columns of
documents. The shuffled order of the mix is a hash that SQL does not have, so there is no
SQL for the whole; the tests follow it with plain Python.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from quernel.llm import decontaminate, mixing, near_dup, quality, sharding
from quernel.llm.common import documents, text_hash, without
from quernel.session import materialize
from quernel.sources import load_table


#: Link bound of the near-duplicate stage, in per cent of the union of two documents' shingles.
NEAR = 80


def quality_rules(spark, docs, sf_dir):
    """Documents that the base rule or a proved threshold rejects go."""
    named = docs.withColumn("text_hash", text_hash())
    labels = load_table(spark, "labels", folder=sf_dir)
    judged = quality.judge(named, labels, ("doc_id", "lang", "text_hash"))
    rejected = judged.filter(~F.col("kept")).select("doc_id", "text_hash")
    return without(docs, materialize(rejected, "quality-rejected"))


def near_duplicates(spark, docs, sf_dir):
    """One document of each group stays."""
    return near_dup.one_of_each(docs, NEAR)


def benchmark_passages(spark, docs, sf_dir):
    """Documents with a window of a benchmark item go."""
    found = decontaminate.contamination(docs, load_table(spark, "benchmark", folder=sf_dir))
    return without(docs, materialize(found.filter("contaminated").select("doc_id", "text_hash"), "benchmark-hits"))


def source_mix(spark, docs, sf_dir):
    """Documents as often as the mix takes them."""
    return mixing.mixed_rows(docs)


def shards(spark, docs, sf_dir):
    return sharding.shard(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("source mix", source_mix),
    ("sharding", shards),
]
ORACLE_SQL = None


def run(spark, sf_dir):
    """The stages one after the other, each on all that the one before kept."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
