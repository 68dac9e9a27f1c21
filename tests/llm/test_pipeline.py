"""The corpus pipeline against brute-force stages over its own classifier's verdicts."""

import sys
from collections import Counter

import numpy as np

import corpus_pipeline as P
import text_cases as T
from skytally.llm.bpe_codec import Codec
from skytally.llm.quality_classifier import train, scored
from skytally.llm.queries import ORACLE, QUERIES, tokenizer

SF = "/root/testdata/sf0.001"


def test_pipeline_equals_brute_force(spark):
    docs, labels, bench = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels", "benchmark"))
    good = {r.doc_id for r in scored(docs, train(docs, labels)).where("predicted = 1").collect()}
    rows = [(r.doc_id, r.text) for r in docs.collect() if r.doc_id in good]
    rows = [d for d, (i, _, c) in zip(rows, T.components(rows, 5, 80)) if c == i]
    rows = [(i, bytes(np.frombuffer(b, np.uint8)[~gone]).decode("utf-8", "ignore")) for i, b, gone in T.kept_bytes(rows)]
    items = [(r.item_id, r.text) for r in bench.collect()]
    rows = [d for d, hit in zip(rows, T.benchmark_hits(rows, items)) if not hit[5]]
    lib = Codec(tokenizer("byte_bpe_50k.json")).library
    want = []
    for i, t in rows:
        ids = lib.encode(t, add_special_tokens=False).ids
        want.append((i, len(ids), T.sha(",".join(map(str, ids))), T.sha(lib.decode(ids, skip_special_tokens=False)), tuple(ids)))
    got = [(*tuple(r)[:4], tuple(r.ids)) for r in P.run(spark, SF).collect()]
    assert Counter(got) == Counter(want) and len(got) < docs.count()


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality", "near_duplicates", "repeats", "benchmark", "tokens"]
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs.limit(0), SF).dtypes == docs.dtypes


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert set(ORACLE) <= set(QUERIES)
    import __spark_entry__ as E

    assert set(QUERIES) | {"pipeline"} <= set(E.queries()) and "skytally.llm" in sys.modules
