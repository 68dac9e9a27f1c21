"""Jaccard join, suffix dedup and decontamination against brute force."""

import random

import numpy as np
import pytest

import text_cases as T
from skytally.llm import jaccard_join as J
from skytally.llm import suffix_dedup as S
from skytally.llm.components import components
from skytally.llm.decontamination import clean, decontamination


@pytest.mark.parametrize("block", [4096, 12])
def test_jaccard_components(spark, monkeypatch, block):
    monkeypatch.setattr(J, "BLOCK", block)
    docs = T.random_docs(300, seed=5) + [d for d in T.edge_docs() if len(d[1] or "") < 10_000]
    T.same(J.jaccard_join(T.frame(spark, docs)).collect(), T.components(docs))


def test_jaccard_bits_do_not_change_links(spark, monkeypatch):
    docs = T.random_docs(200, seed=8)
    monkeypatch.setattr(J, "MOST_BITS", 8)
    monkeypatch.setattr(J, "LEAST_BITS", 8)
    monkeypatch.setattr(J, "FREQUENT", 3)
    T.same(J.jaccard_join(T.frame(spark, docs), width=5, percent=80).collect(), T.components(docs, 5, 80))


def _described(spark, docs):
    docs = spark.createDataFrame(docs, "ord long, text string").selectExpr("ord", "xxhash64(text) key", "text").repartition(5)
    maps = J.bitmaps(J.shingle_counts(docs, 4, 64), 64, 16)
    return docs, J.described(docs, 4, 85, spark.sparkContext.broadcast(maps)).localCheckpoint()


def test_common_phrases_make_no_blocks(spark):
    """Texts that share one phrase each with the next are no candidates: their sets are not sent to one another."""
    r = random.Random(4)
    phrases = [" ".join(f"p{r.randrange(10 ** 6)}" for _ in range(4)) for _ in range(40)]
    docs = [(k, " ".join(r.choice(phrases) for _ in range(6))) for k in range(300)]
    copies = [(1000 + k, " ".join(f"c{j}" for j in range(60)) + f" end{k}") for k in range(10)]
    docs, sets = _described(spark, docs + copies)
    blocks = {r.block: r.members for r in J.blocks_of(sets, 85).groupBy("block").agg({"node": "count"}).withColumnRenamed("count(node)", "members").collect()}
    assert max(blocks.values()) == 10 and sum(blocks.values()) < 60


@pytest.mark.parametrize("apart", [0, 30])
def test_sets_of_a_large_block_go_to_few_tasks(spark, monkeypatch, apart):
    """A block of 200 sets in parts of 10: each was sent to 20 tasks."""
    monkeypatch.setattr(J, "BLOCK", 10)
    r = random.Random(6)
    base = [f"b{k}" for k in range(90)]
    docs = [(k, " ".join([*base, f"end{k}"])) for k in range(200)]
    for k in range(apart):  # of the block, but linked with hardly any: every eleventh word is another one
        words = list(base)
        words[k % 11::11] = [f"x{r.randrange(10 ** 6)}" for _ in words[k % 11::11]]
        docs.append((500 + k, " ".join(words)))
    df, sets = _described(spark, docs)
    blocks = J.blocks_of(sets, 85).localCheckpoint()
    first = J.first_tasks(blocks, 8)
    assert 200 <= first.count() <= 3 * (200 + apart)
    found = components(J.linked_sets(J.sets_of(df, 4, blocks).join(first, ["ord", "key"]), 85))
    assert J.second_tasks(blocks, found).count() <= 8 * (200 + apart)
    T.same(J.jaccard_join(spark.createDataFrame(docs, "doc_id long, text string")).collect(), T.components(docs))


def test_one_document_of_each_group_stays(spark):
    docs = [d for d in T.edge_docs() if len(d[1] or "") < 10_000]
    df = T.frame(spark, docs)
    kept = J.one_of_each(df, 5, 80)
    assert kept.columns == df.columns
    T.same([(r.doc_id, r.text) for r in kept.collect()], [(i, t) for (i, t), (_, _, c) in zip(docs, T.components(docs, 5, 80)) if c == i])
    assert J.one_of_each(df.limit(0)).count() == 0 and J.jaccard_join(df.limit(0)).count() == 0


def test_signature_tree_finds_all_links():
    r = np.random.default_rng(1)
    base = [np.unique(r.integers(0, 1 << 60, r.integers(5, 200)).astype(np.uint64)) for _ in range(12)]
    sets = []
    for k in range(400):
        s = base[k % 12].copy()
        s[r.integers(0, len(s), r.integers(0, max(2, len(s) // 6)))] = r.integers(0, 1 << 60, 1).astype(np.uint64)
        sets.append(np.unique(s))
    nodes = np.arange(len(sets))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            n = len(np.intersect1d(sets[a], sets[b]))
            if 100 * n >= 85 * (len(sets[a]) + len(sets[b]) - n):
                parent[find(a)] = find(b)
    own = list(range(len(sets)))

    def root(x):
        while own[x] != x:
            x = own[x]
        return x

    side = np.arange(len(sets)) % 2
    for one in ((side == 0, np.zeros(200, int)), (side == 1, np.zeros(200, int)), (side >= 0, side)):
        some = np.flatnonzero(one[0])
        for u, v in J.block_links(nodes[some], one[1], [sets[i] for i in some], 85):
            own[root(u)] = root(v)
    assert [min(i for i in nodes if find(i) == find(k)) for k in nodes] == [min(i for i in nodes if root(i) == root(k)) for k in nodes]


def test_components_of_chains_and_stars(spark):
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 130)] + [(7, 7), (500, 400)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {k: 0 for k in range(41)} | {k: 100 for k in range(100, 130)} | {400: 400, 500: 400}


def _dedup_docs():
    r = random.Random(4)
    base = ["".join(r.choice("abé") for _ in range(r.randint(20, 160))) for _ in range(12)]
    docs = [(k if k % 11 else None, "".join(r.choice(base)[r.randint(0, 9):r.randint(40, 160)] for _ in range(r.choice([0, 1, 2, 4, 9])))) for k in range(120)]
    return docs + [d for d in T.edge_docs() if len(d[1] or "") < 10_000] + [(3, base[0] * 3)]


@pytest.mark.parametrize("hot", [(1000, 100_000), (2, 4)])
def test_suffix_dedup(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "HOT_TEXT", hot[0])
    monkeypatch.setattr(S, "HOT_ANCHOR", hot[1])
    docs = _dedup_docs()
    df = T.frame(spark, docs)
    want, texts = [], []
    for i, b, gone in T.kept_bytes(docs):
        left = bytes(np.frombuffer(b, np.uint8)[~gone])
        want.append((i, len(b), int(gone.sum()), int((gone & ~np.append(False, gone)[:-1]).sum()), T.sha(left)))
        texts.append(left.decode("utf-8", "ignore"))
    T.same(S.suffix_dedup(df).collect(), want)
    cut = S.deduplicated(df)
    assert cut.columns == df.columns
    T.same([(r.doc_id, r.text) for r in cut.collect()], [(i, None if t is None else x) for (i, t), x in zip(docs, texts)])
    assert S.suffix_dedup(df.limit(0)).count() == 0


def test_very_long_texts(spark):
    long = " ".join(str(k * k) for k in range(200_000))
    docs = [(1, "z" * 60 + long), (2, "q" + long + "y" * 10), (3, long[5000:9000])]
    got = {r.doc_id: r for r in S.suffix_dedup(T.frame(spark, docs)).collect()}
    assert got[1].n_removed == 0
    assert (got[2].n_removed, got[2].kept_sha256) == (len(long), T.sha("q" + "y" * 10))
    assert (got[3].n_removed, got[3].n_spans) == (4000, 1)


def test_long_runs_of_few_characters(spark):
    """Texts of megabytes with one anchor: it is hot in two documents, and a run is a few numbers, not 50 bytes a place."""
    docs = [(1, "x" * 3_000_000), (2, "head" + "x" * 4_000_000 + "tail"), (3, "ab " * 700_000), (4, "no" + "ab " * 500_000 + "ab"), (5, "-" * 2_000_000)]
    df = S.tagged(T.frame(spark, docs).select("doc_id", "text"))
    shards, bits = 64, 20
    packed, hot = S.shared_anchors(S.anchor_counts(df, shards), shards, bits, S.HOT_ANCHOR)
    shared = spark.sparkContext.broadcast((packed, hot))
    assert len(hot) >= 2
    assert sum(len(r.text) for r in S.contexts(df, shards, bits, shared).collect()) < 1_000_000
    rows = S.hot_strings(df, shared).collect()
    assert len(rows) < 500 and sum(len(r.places) for r in rows) < 50_000
    got = {r.doc_id: r for r in S.suffix_dedup(T.frame(spark, docs)).collect()}
    assert [got[k].n_removed for k in (1, 3, 5)] == [0, 0, 0]
    assert (got[2].n_removed, got[2].n_spans, got[2].kept_sha256) == (4_000_000, 1, T.sha("headtail"))
    assert (got[4].n_removed, got[4].n_spans, got[4].kept_sha256) == (1_500_002, 1, T.sha("no"))


def test_places_of_strings():
    r = np.random.default_rng(8)
    at = np.unique(np.concatenate([np.arange(40, 400), np.arange(1000, 3000, 3), np.arange(5000, 9000, 77), r.integers(10_000, 90_000, 500)]))
    doc, s = r.integers(0, 2, len(at)), np.where(at < 1000, 7, at % 3 + 10).astype(np.uint64)
    doc[at < 9000] = 1
    d, t, places = S.placed(doc, s, at)
    assert len(set(zip(d.tolist(), t.tolist()))) == len(d) == len(places)
    assert len(places[[*zip(d, t)].index((1, 7))].as_py()) == 12
    row, a, b = S.covered(places)
    for k in range(len(d)):
        own, got = np.zeros(100_000, bool), np.zeros(100_000, bool)
        for x in at[(doc == d[k]) & (s == t[k])]:
            own[x:x + S.LENGTH] = True
        for x, y in zip(a[row == k], b[row == k]):
            got[x:y] = True
        assert (own == got).all()


@pytest.mark.parametrize("places", [2, 40])
def test_periodic_anchors_give_the_same_result(spark, monkeypatch, places):
    monkeypatch.setattr(S, "HOT_PLACES", places)
    monkeypatch.setattr(S, "HOT_ANCHOR", 10 * places)
    docs = _dedup_docs() + [(800, "ab" * 300 + "c" + "x" * 200), (801, "q" + "ab" * 200 + "x" * 90 + "y" + "x" * 120)]
    want = []
    for i, b, gone in T.kept_bytes(docs):
        left = bytes(np.frombuffer(b, np.uint8)[~gone])
        want.append((i, len(b), int(gone.sum()), int((gone & ~np.append(False, gone)[:-1]).sum()), T.sha(left)))
    T.same(S.suffix_dedup(T.frame(spark, docs)).collect(), want)


def test_deep_shallow_sorts_suffixes():
    r = np.random.default_rng(3)
    buf = r.integers(97, 99, 3000).astype(np.uint8)
    buf[1000:1400] = buf[:400]
    buf[2000:2300] = 97
    start = np.arange(len(buf) - 50)
    order, group = S.deep_shallow(buf, start)
    strings = [buf[k:k + 50].tobytes() for k in start]
    assert [strings[k] for k in order] == sorted(strings)
    pairs = {}
    assert all(pairs.setdefault(g, strings[k]) == strings[k] for k, g in zip(order, group)) and len(pairs) == len(set(strings))


def test_decontamination(spark):
    r = random.Random(2)
    v = ["a", "b", "c", "É", "x1", "日"]
    items = [(str(k) if k % 7 else None, " ".join(r.choice(v) for _ in range(r.choice([0, 2, 3, 5, 10, 11, 14])))) for k in range(25)] + [("z", None), ("z", "a b")]
    docs = [(k if k % 11 else None, r.choice([", ", "  ", " "]).join(r.choice([*v, "Q", "B"]) for _ in range(r.choice([0, 1, 3, 8, 30, 200])))) for k in range(120)]
    docs += [(3, items[5][1]), *T.edge_docs()]
    df, bench = T.frame(spark, docs), spark.createDataFrame(items, "item_id string, text string")
    want = list(T.benchmark_hits(docs, items))
    T.same(decontamination(df, bench).drop("key").collect(), want)
    left = clean(df, bench)
    assert left.columns == df.columns
    T.same([(x.doc_id, x.text) for x in left.collect()], [d for d, w in zip(docs, want) if not w[5]])
    T.same(decontamination(df, bench.limit(0)).drop("key").collect(), T.benchmark_hits(docs, []))
    assert decontamination(df.limit(0), bench).count() == 0
