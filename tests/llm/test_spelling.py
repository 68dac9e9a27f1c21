"""Spelling variants against a comparison of all pairs of words."""

import random
import re
import zlib
from collections import Counter

import pytest
import text_cases as T

from skytally.llm import spelling as S

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def words(docs, least=7, least_n=2):
    found = Counter()
    for i, t in docs:
        for run in RUN.findall(t or ""):
            run = run.translate(T.UP)
            k = zlib.crc32(f"{'null' if i is None else i}:{run}".encode())
            if k % 31 == 0:
                run = run[:k % len(run)] + run[k % len(run) + 1:]
            if len(run) >= least:
                found[run] += 1
    return {w: n for w, n in found.items() if n >= least_n}


def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def brute(docs):
    n = words(docs)
    pairs = {w: [v for v in n if v != w and abs(len(v) - len(w)) < 2 and near(v, w)] for w in n}
    best = {w: min(vs, key=lambda v: (-n[v], v)) if vs else None for w, vs in pairs.items()}
    form = {w: v if v and n[v] >= 10 * n[w] else None for w, v in best.items()}
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        yield w, form[w], root, n[w], len(pairs[w]), n[form[w]] if form[w] else None


def word_docs(seed=3, n=150):
    r = random.Random(seed)
    base = ["".join(r.choice("eanotißéüÿxÀ") for _ in range(r.randint(6, 12))) for _ in range(60)] + ["zzzzzzzz", "zzzzzzzzz", "abcdefgh", "hgfedcba"]
    out = []
    for k in range(n):
        text = []
        for _ in range(r.randint(0, 60)):
            w = r.choice(base[:6] if r.random() < 0.6 else base)
            if r.random() < 0.25:
                at = r.randrange(len(w))
                w = r.choice([w[:at] + w[at + 1:], w[:at] + r.choice("eéz") + w[at:], w[:at] + r.choice("aéz") + w[at + 1:]])
            text.append(w.capitalize() if r.random() < 0.2 else w)
        out.append((k, r.choice([" ", "-", "3", "\n"]).join(text)))
    long = "".join(r.choice("abc") for _ in range(300))
    out += [(None, out[1][1]), (None, None), (7, None), (8, ""), (9, long + " " + long[:-1]), (10, long + " " + long[:-1])]
    return out + out[:20]


@pytest.mark.parametrize("limit,depths", [(200_000, S.DEPTHS), (40, S.DEPTHS), (25, (0, 2, S.GROUPS)), (30, (S.GROUPS,))])
def test_variants(spark, limit, depths):
    """Small limits send prefixes deeper, and at the last depth split words and searches into parts."""
    docs = word_docs()
    vocab = S.vocabulary(T.frame(spark, docs))
    got = [(r.word, r.other) for r in S.links(vocab, limit, depths).collect()]
    n = words(docs)
    assert sorted(got) == sorted((a, b) for a in n for b in n if a != b and near(a, b))


def test_forms_and_roots(spark):
    docs = word_docs(5)
    for k in range(40):  # a chain of three forms
        docs += [(1000 + k, " ".join(["correctly"] * 60 + ["corectly"] * (k < 30) + ["corectlyy"] * (k == 0)))]
    T.same(S.spelling_variants(T.frame(spark, docs)).select("word", "form", "root", "n", "n_near", "form_n").collect(), brute(docs))


def test_edge_texts_and_none(spark):
    docs = T.edge_docs()
    df = T.frame(spark, docs)
    T.same(S.spelling_variants(df).select("word", "form", "root", "n", "n_near", "form_n").collect(), brute(docs))
    assert S.spelling_variants(df.limit(0)).count() == 0


def test_chunks_bound_the_frontier(monkeypatch):
    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(S, "CHUNK", 4)
    r = random.Random(4)
    text = sorted({"".join(r.choice("ene") + r.choice("ab") for _ in range(4)) for _ in range(80)})
    w = S.Words(pa.array(text))
    none = np.zeros(len(text), np.int64)
    got = [(text[a], text[b]) for q, m in S.links_below(w, w, none, none, 0) for a, b in zip(q, m)]
    assert sorted(tuple(sorted(p)) for p in got) == sorted((a, b) for a in text for b in text if a < b and near(a, b))
