import public_tokenizers

import __spark_entry__ as entry
import corpus_pipeline
from lakekit.llm import bpe
from lakekit.session import stored
from tests.llm.test_decontaminate import expected as contamination
from tests.llm.test_line_dedup import deduplicated
from tests.llm.test_simhash import fingerprint, groups


def test_stages_one_by_one_against_plain_versions(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    given, results = [docs], []
    for name, stage in corpus_pipeline.STAGES:
        results.append(stored(stage(spark, given[-1], folder), "stage"))
        given.append(results[-1])
    texts = [{r.doc_id: r.text for r in g.select("doc_id", "text").collect()} for g in given[:5]]
    assert all(r.columns == columns for r in results[:4])
    # language ID keeps the clean: all labelled documents have words of one language
    assert len(texts[1]) >= 0.99 * len(texts[0]) and all(texts[1][d] == texts[0][d] for d in texts[1])
    lines = deduplicated(sorted(texts[1].items()))
    gone = {d for d, (n, t) in lines.items() if n and not any(c.isalnum() for c in t)}
    assert texts[2] == {d: t for d, (_, t) in lines.items() if d not in gone}
    order = sorted(texts[2])
    prints = [fingerprint(texts[2][d]) for d in order]
    assert set(texts[3]) == {order[g] for g in groups(prints)}
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{folder}/benchmark.parquet").collect()]
    assert set(texts[4]) == {d for d, t in texts[3].items() if not contamination(t, items)[-1]}
    last = results[4].collect()
    assert {r.doc_id for r in last} == set(texts[4]) and all(r.round_trip and len(r.ids) == r.n_tokens for r in last)
    ranks = bpe.load_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    by_id = {v: k for k, v in ranks.items()}
    assert all(b"".join(by_id[i] for i in r.ids).decode() == texts[4][r.doc_id] for r in last)
    counted = results[1].selectExpr("count_if(n_chars <> char_length(text)) AS n").first().n
    assert counted == 0


def test_registered(spark, folder):
    names = [n for n in entry.queries() if n.startswith("op") or n == "pipeline"]
    assert len(names) == 14
    found = entry.queries()["pipeline"](spark, folder)
    assert "text" not in found.columns and found.count() > 0


def test_all_stages_take_awkward_rows(spark, folder, awkward):
    docs = awkward.selectExpr("*", "char_length(text) AS n_chars", "'s' AS source")
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stored(stage(spark, docs, folder), "stage")
        assert out.count() <= docs.count()
        if i < 4:
            assert out.columns == docs.columns
            docs = out
    assert out.count() > 0
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.where("false"), folder).count() == 0


def test_pipeline_over_empty_tables(spark, folder, tmp_path):
    for empty, full in (("documents", "benchmark"), ("benchmark", "documents")):
        spark.read.parquet(f"{folder}/{empty}.parquet").where("false").write.parquet(f"{tmp_path}/no-{empty}/{empty}.parquet")
        spark.read.parquet(f"{folder}/{full}.parquet").write.parquet(f"{tmp_path}/no-{empty}/{full}.parquet")
    assert corpus_pipeline.run(spark, f"{tmp_path}/no-documents").count() == 0
    assert corpus_pipeline.run(spark, f"{tmp_path}/no-benchmark").count() > 0
