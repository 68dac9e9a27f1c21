"""The Merkle manifest against a plain tree, and its closed-form positions against a log written node by node."""

import hashlib
import zlib

import pytest
import text_cases as T
from pyspark.sql import functions as F

from skytally.llm import merkle as M


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, text):
    out = b""
    for v in (row.doc_id, row.source, row.lang, row.n_chars, text):
        b = None if v is None else str(v).encode()
        out += b"-" if b is None else b"%d:" % len(b) + b
    return hashlib.sha256(out).hexdigest()


def levels(leaves):
    got = [list(leaves)]
    while len(got[-1]) > 1:
        got.append([h(got[-1][k:k + 8]) for k in range(0, len(got[-1]), 8)])
    return got


def path(tree, i):
    out = []
    for row in tree[:-1]:
        run, own = row[i // 8 * 8:i // 8 * 8 + 8], i % 8
        out.append((run[:own], run[own + 1:]))
        i //= 8
    return out


def brute(rows):
    trees = {}
    for r in rows:
        shown = r.text
        if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 3 == 0 and shown is not None:
            shown = shown.translate(T.UP)
        trees.setdefault(r.lang, []).append((r.doc_id is not None, r.doc_id or 0, leaf(r, r.text), leaf(r, shown), r.doc_id))
    names = sorted(trees, key=lambda x: (x is not None, (x or "").encode()))
    built = {}
    for name in names:
        trees[name].sort()
        built[name] = levels([x[2] for x in trees[name]])
    top = levels([built[n][-1][0] for n in names])
    for t, name in enumerate(names):
        for i, (_, _, own, other, doc_id) in enumerate(trees[name]):
            steps = path(built[name], i) + path(top, t)
            folded = other
            for before, after in steps:
                folded = h([*before, folded, *after])
            root = top[-1][0]
            yield doc_id, own, built[name][-1][0], root, h(x for b, a in steps for x in (*b, *a)), folded, folded == root


@pytest.mark.parametrize("depth", [4, 1])
def test_manifest(spark, monkeypatch, depth):
    """Builders of one level make as many rounds as the tree has levels."""
    monkeypatch.setattr(M, "LEVELS", depth)
    df = T.frame(spark, T.edge_docs())
    got = M.merkle_manifest(df, presented={"text": M.lower_cased_text()})
    T.same(got.collect(), brute(df.collect()))


def test_many_languages_and_one_row_trees(spark):
    rows = [(k, f"T {k}", f"l{k % 90}" if k % 90 else None, "s", 3) for k in range(140)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    T.same(M.merkle_manifest(df, presented={"text": M.lower_cased_text()}).collect(), brute(df.collect()))


def test_one_row_and_none(spark):
    df = T.frame(spark, [(4, "Text")])
    (row,) = M.merkle_manifest(df, with_proofs=True).collect()
    assert row.leaf == row.root == row.folded_root and row.verified and row.proof_sha256 == h([]) and row.before == row.after == []
    assert M.merkle_manifest(df.limit(0)).count() == 0


def test_proofs_hold_and_break(spark):
    df = T.frame(spark, T.random_docs(100))
    ok = M.merkle_manifest(df, with_proofs=True).collect()
    for r in ok:
        folded = r.leaf
        for b, a in zip(r.before, r.after):
            folded = h([b, folded, a])
        assert r.verified and folded == r.root
    bad = M.merkle_manifest(df, presented={"source": F.lit("x")}).collect()
    assert not any(r.verified for r in bad) and {r.root for r in bad} == {r.root for r in ok}


@pytest.mark.parametrize("n", [1, 2, 7, 8, 9, 63, 64, 65, 512, 513, 1000])
def test_positions(n):
    log, open_ = [], [[] for _ in range(8)]
    for i in range(n):  # append each node as soon as its last child is there
        log.append((0, i))
        open_[0].append(i)
        for level in range(M.height(n)):
            if len(open_[level]) % 8 and i < n - 1 or not open_[level]:
                break
            log.append((level + 1, open_[level][-1] // 8))
            open_[level + 1].append(open_[level][-1] // 8)
            open_[level] = []
    assert len(log) == sum(M.width(k, n) for k in range(M.height(n) + 1))
    assert [M.position(level, i, n) for level, i in log] == list(range(len(log)))
