"""Every operator on the awkward table, on an empty one, and on whole rows."""

from collections import Counter

import corpus_pipeline
import pytest
from corpora import BENCH, PAGES, benchmark, documents, empty, rows
from demandscope.llm import common, decontaminate, html_extract, licenses, mixing, pii, quality_classifier, quality_rules, simhash_dedup, token_counts, token_ids

ROWWISE = {
    "rules": quality_rules.quality_rules, "pii": pii.find_pii, "ids": token_ids.encode_and_read, "counts": token_counts.token_counts, "licences": licenses.scan_licenses,
    "simhash": simhash_dedup.near_duplicates, "mix": mixing.mix, "classifier": quality_classifier.classify,
}


@pytest.mark.parametrize("name", ROWWISE)
def test_one_row_for_each_row(spark, name):
    got = ROWWISE[name](documents(spark)).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())


@pytest.mark.parametrize("name", ROWWISE)
def test_empty_table(spark, name):
    assert ROWWISE[name](empty(spark)).collect() == []


def test_decontamination_edges(spark):
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(documents(spark), benchmark(spark)).collect()}
    assert found == {(11, 1), (10, 3)}
    assert decontaminate.contaminated(empty(spark), benchmark(spark)).count() == 0
    assert decontaminate.contaminated(documents(spark), spark.createDataFrame([], BENCH)).count() == 0
    kept = decontaminate.keep_clean(documents(spark), spark.createDataFrame([], BENCH))
    assert kept.count() == len(rows()) and kept.columns == documents(spark).columns


def test_pages_edges(spark):
    page = "<body><nav><a href='x'>menu item</a></nav><article><h1>T &amp; t</h1><p>one  two<br>three</p></article><footer>f</footer>"
    df = spark.createDataFrame([(1, "u", page, "t", 1, "x"), (2, None, None, None, None, None), (None, "u", "", "t", 1, "x"), (1, "u", page, "t", 1, "x")], PAGES)
    got = sorted(((r.page_id or 0, r.text, r.n_chars) for r in html_extract.extract_text(df).collect()), key=str)
    text = "T & t\n\none two three"
    assert got == [(0, "", 0), (1, text, len(text)), (1, text, len(text)), (2, "", 0)]
    assert html_extract.extract_text(df.limit(0)).collect() == []


def test_pipeline_stages_on_awkward_and_empty_tables(spark, tmp_path):
    sf = str(tmp_path)
    benchmark(spark).write.parquet(f"{sf}/benchmark.parquet")
    for docs in (documents(spark), empty(spark)):
        columns = docs.columns
        for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
            docs = common.materialize(stage(spark, docs, sf), f"test-{k}")
            docs.collect()
            if k + 1 < len(corpus_pipeline.STAGES):
                assert docs.columns == columns, name
        assert docs.columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_the_pipeline_leaves_only_what_its_rows_are_read_from(spark, tmp_path):
    sf = str(tmp_path)
    benchmark(spark).write.parquet(f"{sf}/benchmark.parquet")
    documents(spark).write.parquet(f"{sf}/documents.parquet")
    before = common.made()
    assert corpus_pipeline.run(spark, sf).count() > 0
    left = [p.rsplit("/", 1)[-1].rsplit("-", 1)[0] for p in common._MADE[before:]]
    assert left == ["source-mix", "ids"]


def test_filtering_stages_keep_clean_documents(spark):
    kept = {r.doc_id for r in quality_classifier.keep_good(documents(spark)).select("doc_id").collect()}
    assert {1, 2, 3, 7, 8, 9, 11, 15, 16, 17, 20} <= kept
    one = Counter((r.doc_id, r.text) for r in simhash_dedup.keep_one(documents(spark)).select("doc_id", "text").collect())
    assert max(one.values()) == 1 and 7 not in {i for i, _ in one} and {1, 2, 3, 9, 11, 20} <= {i for i, _ in one}
    assert sum(t is None or not t.strip() for _, t in one) == 1


def test_take_repeats_no_row_more_than_twice(spark):
    docs = documents(spark)
    there = Counter((r.doc_id, r.text, r.source) for r in docs.collect())
    taken = Counter((r.doc_id, r.text, r.source) for r in mixing.take(docs).collect())
    assert all(n <= 2 * there[k] for k, n in taken.items()) and sum(taken.values()) > 0
