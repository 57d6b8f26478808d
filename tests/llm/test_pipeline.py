import hashlib

import pytest
import tiktoken
import public_tokenizers

import __spark_entry__
import corpus_pipeline
from basketry.llm import bpe, mixing, queries
from tests.llm import test_lines, test_near_copies, test_quality


def test_stages_match_brute_force(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    columns, rows = docs.columns, {r["doc_id"]: r["text"] for r in docs.collect()}
    kept = {d: t for d, t in rows.items() if test_quality.brute(t)[-1]}
    stage = dict(corpus_pipeline.STAGES)
    passed = corpus_pipeline.written(stage["quality_rules"](spark, docs, small), "t")
    assert passed.columns == columns and {r["doc_id"]: r["text"] for r in passed.collect()} == kept
    shorter = {d: text for (d, _), (text, _) in test_lines.brute(list(kept.items()), 50).items() if text.encode().split()}
    deduped = corpus_pipeline.written(stage["line_dedup"](spark, passed, small), "t")
    assert deduped.columns == columns and {r["doc_id"]: (r["text"], r["n_chars"]) for r in deduped.collect()} == {d: (t, len(t)) for d, t in shorter.items()}
    ids = sorted(shorter)
    groups = {}
    for d, g in zip(ids, test_near_copies.brute([shorter[d] for d in ids])):
        groups.setdefault(g, d)
    groups = set(groups.values())
    single = corpus_pipeline.written(stage["near_dedup"](spark, deduped, small), "t")
    assert single.columns == columns and sorted(r["doc_id"] for r in single.collect()) == sorted(groups)
    taken = {r["doc_id"]: r["copies"] for r in mixing.mix(single).collect()}
    mixed = corpus_pipeline.written(stage["source_mix"](spark, single, small), "t")
    assert mixed.columns == columns and {r["doc_id"]: r["count"] for r in mixed.groupBy("doc_id").count().collect()} == {d: n for d, n in taken.items() if n}
    other = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.read_ranks(queries.RANKS), special_tokens={})
    want = sorted((d, len(ids := other.encode_ordinary(shorter[d])), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                   hashlib.sha256(shorter[d].encode()).hexdigest()) for d, n in taken.items() for _ in range(n))
    assert sorted(map(tuple, corpus_pipeline.run(spark, small).collect())) == want


def test_all_queries_are_registered():
    names = set(__spark_entry__.queries())
    assert "pipeline" in names and {n.split("_")[0] for n in names if n.startswith("op")} == {f"op{i}" for i in range(1, 14)}


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_queries_match_their_sql(spark, small, name):
    import check
    assert check.compare(queries.QUERIES[name](spark, small).toPandas(), check.connect(small).execute(queries.ORACLES[name]).df()).startswith("ok")
