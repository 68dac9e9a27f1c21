"""Packing: ids as the library gives them, every piece once, no gap, few sequences."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import text_cases as T
from tokenizers import Tokenizer

from skytally.llm import packing as P
from skytally.llm.queries import tokenizer

PATH = tokenizer("word_bpe_49k.json")


def awkward_texts():
    r = random.Random(1)
    marks = ["<|endoftext|>", "<|startoftext|>", "<|endoftext", "'S", "'ll", "́", "é", "é", "İ", "Σ", "ς", "ΑΣ", "\u0085", "\x1c", "　", "\xa0", "日本", "🙂",
             "՘", "ab࢏cd", "12", "½", "ﬁ", "ǅ", "\x00", "a" * 70, "\n\n", "  "]
    return ["".join(r.choice(marks + ["word", " ", "Don't", "x"]) for _ in range(r.randint(0, 40))) for _ in range(600)]


def test_ids_are_the_librarys():
    library, own = Tokenizer.from_file(PATH), P.Encoder(PATH)
    texts = awkward_texts() + [t or "" for _, t in T.edge_docs()]
    want = [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):  # from the library, then from the store
        assert [x.tolist() for x in own.ids(texts)] == want
    assert [own.ids([t])[0].tolist() for t in texts[:100]] == want[:100] and own.ids([]) == []


def test_windows_and_a_full_store_change_nothing(monkeypatch):
    monkeypatch.setattr(P, "WINDOW", 7)
    monkeypatch.setattr(P, "STORED", 3)
    library, own = Tokenizer.from_file(PATH), P.Encoder(PATH)
    texts = awkward_texts()[:200]
    assert [x.tolist() for x in own.ids(texts)] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_store_compares_bytes():
    """Segments with one hash are told apart."""
    s = P.Store()
    buf = np.frombuffer(b"abcdxy", np.uint8)
    key = np.array([5, 9], np.uint64)
    s.add(key, [b"ab", b"cd"], [[1], [2, 3]])
    assert s.find(key, buf, np.array([0, 2]), np.array([2, 2])).tolist() == [0, 1]
    assert s.find(key, buf, np.array([4, 2]), np.array([2, 1])).tolist() == [-1, -1]


def check(rows, docs, limit):
    library = Tokenizer.from_file(PATH)
    expected = Counter()
    for i, t in docs:
        ids = library.encode(t or "", add_special_tokens=False).ids + [1]
        for k, at in enumerate(range(0, len(ids), limit)):
            part = ids[at:at + limit]
            expected[i, k, at, len(part), zlib.crc32(np.array(part, "<u4").tobytes())] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
    places = defaultdict(list)
    for r in rows:
        places[r.sequence_id].append((r.offset, r.length))
    for x in places.values():
        x.sort()
        assert [o for o, _ in x] == [sum(n for _, n in x[:k]) for k in range(len(x))] and sum(n for _, n in x) <= limit
    return len(places), -(-sum(r.length for r in rows) // limit)


@pytest.mark.parametrize("limit", [256, 20, 3])
def test_packed(spark, limit):
    docs = T.edge_docs()
    got = P.packed(T.frame(spark, docs), PATH, limit).collect()
    n, least = check(got, docs, limit)
    assert n <= least * 1.05 + 2


def test_ids_column_and_empty_table(spark):
    docs = T.random_docs(60)
    df = T.frame(spark, docs)
    for r in P.packed(df, PATH, 64, with_ids=True).collect():
        assert zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    assert P.packed(df.limit(0), PATH).count() == 0


@pytest.mark.parametrize("seed", range(12))
def test_plan(seed):
    r = random.Random(seed)
    limit = r.choice([30, 100, 1000])
    kinds = r.choice([3, 10, limit])
    counts = {r.randint(1, limit) if r.random() < 0.5 else r.randint(1, 1 + limit // 3): r.choice([1, 2, 50, 3000]) for _ in range(kinds)}
    plan = P.plan_of(counts, limit)
    used, placed = defaultdict(list), Counter()
    for size, first, n, sequence, each, offset in plan.rows:
        assert first == placed[size]
        placed[size] += n
        for k in range(n):
            used[sequence + k // each].append((offset + k % each * size, size))
    assert placed == Counter(counts) and len(used) == plan.sequences
    for x in used.values():
        x.sort()
        assert all(o == sum(s for _, s in x[:k]) for k, (o, _) in enumerate(x)) and sum(s for _, s in x) <= limit
    # first-fit decreasing, piece by piece
    rooms = []
    for size in sorted((s for s, n in counts.items() for _ in range(min(n, 40))), reverse=True):
        fit = [k for k, x in enumerate(rooms) if x >= size]
        if fit:
            rooms[min(fit, key=lambda k: rooms[k])] -= size
        else:
            rooms.append(limit - size)
    small = P.plan_of({s: min(n, 40) for s, n in counts.items()}, limit)
    assert small.sequences <= len(rooms) * 1.03 + 2


def test_configurations_are_optimal():
    """Three sizes whose best packing is known."""
    got = P.configurations([50, 34, 33], [100, 90, 90], 100)
    assert abs(sum(x for _, x in got) - (50 + 45 + 22.5)) < 1e-6  # 50 50, 34 33 33, 34 34
    for config, x in got:
        assert config @ np.array([50, 34, 33]) <= 100 and x > -1e-6
