"""Small documents with every awkward case, and brute-force versions of the operators."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import numpy as np

LAST = (1 << 63) - 1
WORD = re.compile("[^\x20\x09-\x0D]+")
BENCH_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, key long, ord string, score double, spans string, held_out int"


def random_docs(n=120, seed=2):
    r = random.Random(seed)
    vocab = [f"w{k}" for k in range(60)] + ["É", "日本", "don't", "A.B", "x|y", "!!"]
    base = [[r.choice(vocab) for _ in range(r.choice([1, 2, 3, 4, 8, 40, 120]))] for _ in range(20)]
    out = []
    for k in range(n):
        words = list(r.choice(base))
        for _ in range(r.choice([0, 0, 1, 2, 6])):
            words[r.randrange(len(words))] = r.choice([*vocab, "W1"])
        if r.random() < 0.2:
            words += r.choice(base)
        out.append((k, r.choice([" ", "\n", "  ", "\t "]).join(words)))
    return out


def edge_docs(seed=2):
    """(doc_id, text): null and repeated ids, null, empty and blank texts, repeated rows, ties, a very long text."""
    docs = random_docs(seed=seed)
    docs += [(None, docs[3][1]), (None, docs[7][1]), (None, None), (900, None), (900, None), (901, ""), (902, " \n\t"), (903, "\n"), (5, "another text of id five")]
    docs += [(910, "a" * 500), (911, "a" * 300), (912, "ab" * 400), (913, " ".join(["same words"] * 300)), (914, "x " * 60 + "\n" + "x " * 60)]
    docs += [(920, ("long text " + " ".join(f"t{k % 977}" for k in range(300_000)))[:1_300_000])]
    return docs + docs[:9]


def frame(spark, docs):
    rows = [(i, t, None if k % 5 == 0 else ("en", "fr")[k % 2], None, None, 7, "o", None, "s", k) for k, (i, t) in enumerate(docs)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def same(got, expected):
    a, b = Counter(map(tuple, got)), Counter(map(tuple, expected))
    assert not a - b and not b - a, (sorted((a - b), key=str)[:3], sorted((b - a), key=str)[:3])


def sha(b):
    return hashlib.sha256(b if isinstance(b, bytes) else b.encode()).hexdigest()


def components(docs, width=4, percent=85):
    """(doc_id, set size, smallest id of the component) by comparing all pairs that share a shingle."""
    sets = []
    for _, t in docs:
        w = WORD.findall((t or "").translate(UP))
        sets.append(frozenset(tuple(w[k:k + width]) for k in range(max(1, len(w) - width + 1))) if w else frozenset())
    parent = list(range(len(docs)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    holders, first = defaultdict(list), {}
    for k, x in enumerate(sets):
        if not x:
            continue
        if x in first:
            parent[find(k)] = find(first[x])
            continue
        first[x] = k
        common = Counter(o for g in x for o in holders[g])
        for g in x:
            holders[g].append(k)
        for o, n in common.items():
            if 100 * n >= percent * (len(x) + len(sets[o]) - n):
                parent[find(k)] = find(o)
    low = {}
    for k, (i, _) in enumerate(docs):
        low[find(k)] = min(low.get(find(k), LAST), LAST if i is None else i)
    return [(i, len(sets[k]), None if low[find(k)] == LAST else low[find(k)]) for k, (i, _) in enumerate(docs)]


def kept_bytes(docs, length=50):
    """Per document: its bytes and which of them a smaller document repeats."""
    low = {}
    for i, t in docs:
        o, b = LAST if i is None else i, (t or "").encode()
        for s in {b[k:k + length] for k in range(len(b) - length + 1)}:
            low[s] = min(low.get(s, LAST), o)
    for i, t in docs:
        o, b = LAST if i is None else i, (t or "").encode()
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if low[b[k:k + length]] < o:
                gone[k:k + length] = True
        yield i, b, gone


def benchmark_hits(docs, items, length=10):
    windows = {}
    for item, t in items:
        w = BENCH_WORD.findall((t or "").translate(UP))
        n = min(length, len(w))
        for k in range(len(w) - n + 1 if n else 0):
            windows.setdefault(tuple(w[k:k + n]), set()).add("" if item is None else str(item))
    sizes = {len(x) for x in windows}
    for i, t in docs:
        w = BENCH_WORD.findall((t or "").translate(UP))
        hit, found = set(), set()
        for n in sizes:
            for k in range(len(w) - n + 1):
                if tuple(w[k:k + n]) in windows:
                    hit |= set(range(k, k + n))
                    found |= windows[tuple(w[k:k + n])]
        yield i, len(w), len(hit), len(found), sha(",".join(sorted(found))), bool(hit)
