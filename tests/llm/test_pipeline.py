"""The pipeline against brute force, its odd cases, and registered queries
against their SQL."""

import os
import sys

import pytest
from brute import components, contamination, pii, sha, simhash
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm.language_id import has_letter
from tidemark.llm.queries import QUERIES, tokenizer

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_its_stages_by_brute_force(spark):
    from tidemark.llm import pii as P
    from tidemark.tables import load
    got = {r.doc_id: (r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SF).collect()}
    docs = [(r.doc_id, r.text) for r in load(spark, SF, "documents").orderBy("doc_id").collect() if has_letter(r.text)]
    first = components([simhash(t) for _, t in docs])
    docs = [d for i, d in enumerate(docs) if first[i] == i]
    items = [tuple(r) for r in load(spark, SF, "benchmark").select("item_id", "text").collect()]
    docs = [d for d, c in zip(docs, contamination(docs, items)) if not c[-1]]
    tok = Tokenizer.from_file(tokenizer("byte_bpe_50k.json"))
    added = 0
    assert set(got) == {d for d, _ in docs}
    for d, t in docs:
        spans = sorted([int(a), k, int(b)] for k, a, b in (x.split(":") for x in pii(t).split(",") if x))
        merged = []
        for a, k, b in spans:
            if merged and merged[-1][2] > a:
                merged[-1][2] = max(merged[-1][2], b)
            else:
                merged.append([a, k, b])
        for a, k, b in reversed(merged):
            t = t[:a] + f"[{k.upper()}]" + t[b:]
        ids = tok.encode(t, add_special_tokens=False).ids
        added += got[d] != (len(ids), sha(",".join(map(str, ids))), sha(t))
    assert added == 0 and P.KINDS


def test_stages_take_odd_rows_and_keep_columns(spark, edge_docs):
    docs = edge_docs
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        out = stage(spark, docs, SF)
        empty = stage(spark, docs.limit(0), SF)
        assert empty.count() == 0 and out.columns == empty.columns
        if k < len(corpus_pipeline.STAGES) - 1:
            assert out.columns == docs.columns
            rows = out.collect()
            docs = spark.createDataFrame(rows, docs.schema)
        else:
            assert out.count() == docs.count() > 0


@pytest.mark.parametrize("name", ["op1_quality_rules", "op3_decontaminate", "op11_spelling", "op12_merkle"])
def test_queries_equal_their_sql(spark, name):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
    from tidemark.llm.oracle import ORACLE
    from tools.compare import digest, duck
    df = QUERIES[name](spark, SF)
    cur = duck(SF).execute(ORACLE[name])
    want = digest([d[0] for d in cur.description], cur.fetchall())
    assert digest(df.columns, [tuple(r) for r in df.collect()]) == want


def test_every_operator_has_one_query():
    import __spark_entry__ as E
    names = E.queries()
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13
    assert "pipeline" in names and set(E.oracle_sql()) <= set(names)
