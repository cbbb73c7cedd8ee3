"""The corpus pipeline: quality, near duplicates, benchmark passages, source mix, token files.

``STAGES`` are (name, function) in order; each function takes (spark, docs, sf_dir), works on all that its predecessor kept, and returns a
DataFrame. ``run`` writes each result as Parquet to the shared folder and reads it back for the next.
"""

from __future__ import annotations

from demandscope.llm import decontaminate, mixing, quality_classifier, simhash_dedup, token_ids
from demandscope.llm.common import finished, made, release, table

#: Stages with a learned model and a hash join over bits have no SQL form; tests hold each against a brute-force version.
ORACLE_SQL = None


def quality(spark, docs, sf_dir):
    """Documents that the classifier keeps; null, empty and blank texts go; an empty table stays empty, as in all stages; columns stay."""
    return quality_classifier.keep_good(docs)


def near_duplicates(spark, docs, sf_dir):
    """One row of each component of near duplicates, that with the smallest doc_id (null last); repeated rows are one."""
    return simhash_dedup.keep_one(docs)


def benchmark_passages(spark, docs, sf_dir):
    """Documents without a passage of a benchmark item; null texts stay."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark, docs, sf_dir):
    """Each document as often as the mix takes it: 0, 1 or 2 rows; a null source is a source of its own."""
    return mixing.take(docs)


def tokens(spark, docs, sf_dir):
    """Ids of each row's text, written and read back; null texts have only the end id, very long ones stay whole."""
    return token_ids.encode_and_read(docs)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_duplicates),
    ("benchmark decontamination", benchmark_passages),
    ("source mix", source_mix),
    ("token files", tokens),
]


def run(spark, sf_dir):
    """The last stage's rows. Tables that a stage made on its way, and its input, are deleted once its result is written."""
    docs = table(spark, sf_dir, "documents")
    kept = None
    for name, stage in STAGES[:-1]:
        begun = made()
        docs = finished(stage(spark, docs, sf_dir), name.replace(" ", "-"), begun)
        if kept is not None:
            release(kept)
        kept = docs
    return STAGES[-1][1](spark, docs, sf_dir)
