import corpus_pipeline
from probelake.llm import language_id, quality, tokens
from probelake.llm.common import tokenizer_file
from probelake.session import staged

from .conftest import listed
from .test_lines_and_shards import brute_lines
from .test_near_dups import brute
from .test_quality import brute as base_counts
from .test_tokens_and_packing import check_packed, pieces_of


def test_run_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    named = {r["doc_id"]: r for r in listed(language_id.identify(docs))}
    rows = [(i, r["text"]) for i, r in named.items() if r["lang_pred"] != "und" and r["score"] >= 0.5]
    spoken = staged(docs.where(docs["doc_id"].isin([i for i, _ in rows])), "test-spoken")
    judged = {r["_id"]: r for r in listed(quality.verdicts(spoken))}
    for i, text in rows:
        want = base_counts(text)
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert not (failed and judged[i]["kept"])
    rows = [(i, text) for i, text in rows if judged[i]["kept"]]
    rows = [(i, text) for i, _, _, text in brute_lines(rows, 10, 1)]
    groups = brute(rows, 5, 80)
    library = tokens.load(tokenizer_file())
    want = [p for i, text in rows if groups[i][1] == i for p in pieces_of(library, i, text, 4096)]
    check_packed(listed(corpus_pipeline.run(spark, sf_dir)), want, 4096)


def test_stages_keep_the_columns_and_bear_anything(spark, sf_dir, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES[:-1]:
        for docs in (odd_docs, no_docs):
            kept = stage(spark, docs, sf_dir)
            assert kept.columns == docs.columns, name
            assert kept.count() <= docs.count()
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "quality", "line_dedup", "near_dups", "packing"]
