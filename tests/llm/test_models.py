"""Quality rules, language model and the two classifiers."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

import text_cases as T
from skytally.llm import lm_scores, quality_classifier, quality_rules, queries, toxicity
from skytally.llm.kneser_ney import discounts
from skytally.llm.learning import sigmoid

SF = "/root/testdata/sf0.01"


def test_base_rules(spark):
    docs = T.edge_docs()
    got = quality_rules.quality_rules(T.frame(spark, docs)).collect()
    want = []
    for i, t in docs:
        t = t or ""
        w = T.WORD.findall(t)
        lines = [x for x in t.split("\n") if T.WORD.search(x)]
        c = Counter(zip(w, w[1:], w[2:]))
        twice = {k + j for k in range(len(w) - 2) if c[tuple(w[k:k + 3])] > 1 for j in range(3)}
        want.append((i, len(w), sum(map(len, w)), sum(map(t.count, "#*$%&|<>")), len(lines) - len(set(lines)), len(twice), len(w) < 50 or 100 * len(twice) > 50 * len(w)))
    T.same([tuple(r)[:7] for r in got], want)
    assert not any(r.kept for r in got if r.base_failed)
    assert quality_rules.quality_rules(T.frame(spark, docs).limit(0)).count() == 0


def test_perplexity_bands_reject_per_language(spark):
    r = random.Random(1)
    word = lambda letters: "".join(r.choice(letters) for _ in range(6))
    rows = [(k, " ".join(word("abcdef" if k % 2 else "tuvwxy") for _ in range(80)), "en" if k % 2 else "fr") for k in range(200)]
    rows += [(500, " ".join(word("abcdef") for _ in range(80)), "en"), (501, " ".join(word("0123456789;-:kq[]") for _ in range(80)), "en"), (502, " ".join("tu" * 3 + str(k) for k in range(80)), None)]
    got = {x.doc_id: x for x in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[k].kept for k in range(200)) and got[500].kept
    assert not got[501].kept and not got[501].base_failed and got[502].kept  # alone in its language


def test_copies_do_not_set_the_bands(spark):
    """A third of all rows are copies of one plain text: verdicts and perplexities are those without the copies."""
    r = random.Random(9)
    text = lambda letters, n: " ".join("".join(r.choice(letters) for _ in range(6)) for _ in range(n))
    rows = [(k, text("abcdefgh" + "ijkl"[:k % 5], 90), "en" if k % 4 else "fr") for k in range(400)]
    rows += [(1000 + k, text("abcdefghxyz0123", 90), "en") for k in range(6)]
    copy = text("abc", 90)
    schema = "doc_id long, text string, lang string"
    run = lambda x: {d.doc_id: (d.kept, round(d.perplexity, 6)) for d in quality_rules.quality_rules(spark.createDataFrame(x, schema).repartition(5)).collect()}
    once, many = run([*rows, (2000, copy, "en")]), run([*rows, *((2000 + k, copy, "en") for k in range(203))])
    assert {k: many[k] for k in once} == once
    assert len({many[2000 + k] for k in range(203)}) == 1
    assert not any(many[1000 + k][0] for k in range(6)) and sum(many[k][0] for k in range(400)) > 380


def test_bytes_of_other_scripts_stay_apart(spark):
    """Greek letters with the last bytes of the Cyrillic ones are no Cyrillic text: every byte is a symbol of its own."""
    r = random.Random(2)
    text = lambda letters: " ".join("".join(r.choice(letters) for _ in range(6)) for _ in range(80))
    cyrillic = "абвгде"
    greek = "".join(chr(ord(c) - 0x80) for c in cyrillic)
    assert [c.encode()[1:] for c in greek] == [c.encode()[1:] for c in cyrillic]
    rows = [(k, text(cyrillic), "ru") for k in range(200)] + [(500, text(greek), "ru")]
    got = {x.doc_id: x for x in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(got[k].kept for k in range(200))
    assert not got[500].kept and not got[500].base_failed
    every = np.arange(256, dtype=np.uint8)
    assert len({int(quality_rules.trigram_codes(np.array([b], np.uint8), np.array([0, 1]))[0]) for b in every}) == 256


def test_perplexity_of_character_trigrams(spark):
    """Three characters of any script make a trigram, and a text's end is one too: as plain dictionaries have it."""
    r = random.Random(3)
    texts = ["".join(r.choice(letters) for _ in range(n)) for letters in ("abc d", "абвгд ", "日本語中文 ", "𝛼𝛽𝛾 \n") for n in (1, 2, 40, 300)]
    grams = lambda t: [*zip(["", "", *t], ["", *t, "end"], [*t, "end"])]
    fold = lambda t: hashlib.sha256(t.encode()).digest()[0] % 2
    cut = lambda n, d: max(0, n - d[min(n, 3)])

    def model(texts):
        tri = Counter(g for t in texts for g in grams(t))
        counts = [tri]
        for _ in range(2):
            counts.append(Counter(g[1:] for g in counts[-1]))
        d = [discounts(*(Counter(x.values())[k] for k in (1, 2, 3, 4))) for x in counts]
        total, left = Counter(), defaultdict(float)
        for x, own in zip(counts, d):
            for g, n in x.items():
                total[g[:-1], len(g)] += n
                left[g[:-1], len(g)] += n - cut(n, own)

        def p(g):
            if not g:
                return 1 / (len(counts[2]) + 1)
            k, c = 3 - len(g), (g[:-1], len(g))
            return (cut(counts[k][g], d[k]) + left[c] * p(g[1:])) / total[c] if total[c] else p(g[1:])

        return p

    p = [model({t for t in texts if fold(t) != f}) for f in (0, 1)]
    assert {fold(t) for t in texts} == {0, 1}
    rows = [(k, t, "en") for k, t in enumerate([*texts, texts[3], "", None])]
    got = {x.doc_id: x.perplexity for x in quality_rules.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)).collect()}
    for k, t, _ in rows:
        if t:
            assert math.isclose(got[k], math.exp(-sum(math.log(p[fold(t)](g)) for g in grams(t)) / (len(t) + 1)), rel_tol=1e-5), t
        else:
            assert got[k] is None


def test_texts_that_are_no_utf8_keep_their_bounds():
    raw = [b"\xce", b"\xb1x", "αβ".encode(), b"", b"\xff"]
    offs = np.append(0, np.cumsum([len(x) for x in raw]))
    sym, at = quality_rules.symbols(np.frombuffer(b"".join(raw), np.uint8), offs)
    assert np.diff(at).tolist() == [2, 3, 3, 0, 2] and sym[at[2]:at[3]].tolist() == [ord("α") + 2, ord("β") + 2, quality_rules.END]


def test_character_model_sums_to_one_and_backs_off():
    r = np.random.default_rng(0)
    codes, counts = np.unique(r.integers(0, 8, 4000) << 14 | r.integers(0, 8, 4000) << 7 | r.integers(0, 6, 4000), return_counts=True)
    m = quality_rules.Model(codes, counts)
    for context in (codes[0] >> 7, codes[-1] >> 7, 99 << 7 | 3, 99 << 7 | 98):
        p = np.exp(m.look_up((context << 7) + np.arange(quality_rules.CLASSES)))
        assert abs(p.sum() - 1) < 1e-4 and (p > 0).all()


def test_discounts():
    assert np.allclose(discounts(100, 40, 20, 10), [0, 1 - 2 * (100 / 180) * 0.4, 2 - 3 * (100 / 180) * 0.5, 3 - 4 * (100 / 180) * 0.5])
    assert list(discounts(0, 0, 0, 0)) == [0, 0.5, 1, 1.5]


def _tokens(t):
    return [x.encode() for x in T.WORD.findall((t or "").translate(T.UP))] + [b"</s> "]


def _kneser_ney(train, min_count):
    """log10 probability of a token list, from plain dictionaries."""
    uni, pair = Counter(), Counter()
    for t in train:
        uni.update(t)
        pair.update(zip([b"<s> ", *t], t))
    coc = Counter(pair.values())
    d = discounts(*(coc[k] for k in (1, 2, 3, 4)))
    cut = lambda n, d: d[min(n, 3)]
    contexts = Counter(w for _, w in pair)
    cc = Counter(contexts.values())
    d1 = discounts(*(cc[k] for k in (1, 2, 3, 4)))
    total = sum(contexts.values())
    rest = sum(cut(n, d1) for n in contexts.values()) / total
    low = lambda w: (contexts[w] - cut(contexts[w], d1)) / total + rest / (len(uni) + 1)
    seen, mass = defaultdict(int, uni), defaultdict(float)
    seen[b"<s> "] = len(train)
    for (h, _), n in pair.items():
        if n >= min_count:
            mass[h] += n - cut(n, d)

    def score(t):
        out = 0.0
        for h, w in zip([b"<s> ", *t], t):
            top = pair[h, w] - cut(pair[h, w], d) if pair[h, w] >= min_count else 0
            back = 1 - mass[h] / seen[h] if seen[h] else 1
            out += math.log10(top / max(seen[h], 1) + back * low(w))
        return out

    return score, uni


@pytest.mark.parametrize("min_count", [1, 2])
def test_language_model_equals_brute_force(spark, min_count):
    docs = [d for d in T.edge_docs() if len(d[1] or "") < 10_000]
    held = lambda i: zlib.crc32(("null" if i is None else str(i)).encode()) % 7 == 2
    score, uni = _kneser_ney([_tokens(t) for i, t in docs if not held(i)], min_count)
    n, v = sum(uni.values()), len(uni)
    got = sorted(map(tuple, lm_scores.lm_scores(T.frame(spark, docs), min_count).collect()), key=str)
    want = sorted(((i, held(i), len(_tokens(t)), sum(uni[w] > 0 for w in _tokens(t)), n, sum(math.log10((uni[w] + 1) / (n + v + 1)) for w in _tokens(t)), score(_tokens(t))) for i, t in docs), key=str)
    assert len(got) == len(want)
    key = lambda r: (str(r[0]), r[2], r[3], round(r[5], 3))
    for a, b in zip(sorted(got, key=key), sorted(want, key=key)):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-6 * abs(b[5]) and abs(a[6] - b[6]) < 1e-3 + 1e-4 * abs(b[6]), (a, b)


def test_registered_language_model_keeps_bigrams_seen_once(spark, tmp_path):
    """The query as registered: scores of held-out rows from all bigrams, most of them seen once."""
    r = random.Random(6)
    docs = [(k, " ".join(f"w{int(300 * r.random() ** 2)}" for _ in range(60))) for k in range(150)]
    held = lambda i: zlib.crc32(str(i).encode()) % 7 == 2
    train = [_tokens(t) for i, t in docs if not held(i)]
    pairs = Counter(p for t in train for p in zip([b"<s> ", *t], t))
    assert sum(n == 1 for n in pairs.values()) > len(pairs) / 2
    score, _ = _kneser_ney(train, 1)
    spark.createDataFrame(docs, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {x.doc_id: x.score for x in queries.op9_lm_scores(spark, str(tmp_path)).collect()}
    assert all(abs(got[i] - score(_tokens(t))) < 1e-3 + 1e-4 * abs(got[i]) for i, t in docs)


def test_language_model_without_rows(spark):
    assert lm_scores.lm_scores(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_packed_arrays():
    for a in ([], [0], [1, 255], [256, 3], [1 << 40, 7], [(1 << 64) - 1, 0]):
        a = np.array(a, np.uint64)
        assert (lm_scores.unpack(lm_scores.pack(a)) == a).all() and len(lm_scores.unpack(lm_scores.pack(a))) == len(a)
    f = np.array([0.5, -1e300, 3.0])
    assert (lm_scores.unpack(lm_scores.pack(f), "f") == f).all()


def test_passages_learned_from_are_bounded(spark, monkeypatch):
    """A long labelled text sends a few passages to the driver, and is scored by all of them."""
    docs = spark.createDataFrame([(k, "word " * (64 * k)) for k in range(1, 13)], "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(1, 13)], "doc_id long, quality int")
    seen = []
    monkeypatch.setattr(quality_classifier.Classifier, "fit", lambda self, bags, y: seen.extend(len(b) for b in bags) or self)
    quality_classifier.train(docs, labels, learned_passages=3)
    assert seen and max(seen) == 3


def _held_out(out, labels, column):
    l = {r.doc_id: r[column] for r in labels.collect()}
    rows = [(r.held_out, r.score, r.predicted, l[r.doc_id]) for r in out.collect() if r.doc_id in l]
    test = [x for x in rows if x[0]]
    pos, neg = [x[1] for x in test if x[3] == 1], [x[1] for x in test if x[3] == 0]
    auc = np.mean([(a > b) + 0.5 * (a == b) for a in pos for b in neg])
    return auc, np.mean([x[2] == x[3] for x in test])


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    out = quality_classifier.quality_classifier(docs, labels)
    assert out.count() == docs.count()
    auc, right = _held_out(out, labels, "quality")
    assert auc > 0.98 and right > 0.95


def test_toxicity_on_planted_words(spark):
    """Known words, unseen forms of a known stem, and clean texts, outside the learned fold too."""
    r = random.Random(3)
    syllables = ["ka", "lo", "mi", "ne", "ru", "sa", "ti", "vo"]
    word = lambda: "".join(r.choice(syllables) for _ in range(r.randint(1, 4)))
    docs, labels = [], []
    for k in range(900):
        words = [word() for _ in range(r.choice([5, 40, 150, 400]))]
        toxic = k % 3 == 0
        for _ in range(2 if toxic else 0):
            words.insert(r.randrange(len(words) + 1), r.choice(["blargh", "Zorgon"]) if k % 2 else "quaxx" + r.choice(syllables) + r.choice(syllables))
        docs.append((k, " ".join(words)))
        labels.append((k, int(toxic)))
    out = toxicity.toxicity(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    auc, right = _held_out(out, spark.createDataFrame(labels, "doc_id long, toxic int"), "toxic")
    assert auc > 0.99 and right > 0.97


def test_scores_of_edge_cases(spark):
    docs = [d for d in T.edge_docs() if len(d[1] or "") < 100_000]
    df = T.frame(spark, docs)
    rows = [(k, k % 2, (k // 2) % 2) for k in range(60)] + [(3, None, None), (None, 1, 1), (4, 1, 1)]
    labels = spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
    for run in (quality_classifier.quality_classifier, toxicity.toxicity):
        got = run(df, labels).collect()
        assert len(got) == len(docs) and all(0 <= r.score <= 1 for r in got)
        T.same([r.held_out for r in got] and [(r.doc_id, r.held_out) for r in got], [(i, zlib.crc32(("null" if i is None else str(i)).encode()) % 3 == 1) for i, _ in docs])
        assert len({r.score for r in got if r.doc_id in (900, 901, 902, 903)}) == 1  # texts without words
        assert run(df.limit(0), labels).count() == 0
        assert {r.score for r in run(df, labels.limit(0)).collect()} == {0.5}


def test_attention_gradients():
    r = np.random.default_rng(0)
    c = quality_classifier.Classifier()
    x, at, y = r.normal(size=(9, quality_classifier.FEATURES)), np.array([0, 2, 3]), np.array([1.0, 0, 1])
    loss = lambda: float(np.sum(np.logaddexp(0, z := c.forward(x, at)[0]) - y * z))
    logit, saved = c.forward(x, at)
    for k, g in c.gradients(at, saved, sigmoid(logit) - y).items():
        i = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        c.p[k][i] += 1e-5
        up = loss()
        c.p[k][i] -= 2e-5
        down = loss()
        c.p[k][i] += 1e-5
        assert abs((up - down) / 2e-5 - g[i]) < 1e-4 * max(1, abs(g[i])), k


def test_gru_gradients():
    r = np.random.default_rng(0)
    net = toxicity.Network()
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, y, w = r.normal(size=(3, 7, toxicity.INPUTS)), np.array([1.0, 0, 1]), np.ones(3)
    live = np.arange(7) < np.array([7, 4, 1])[:, None]
    x = x * live[:, :, None]

    def loss():
        z = net.logits(*(x @ net.p[f"W{s}"] + net.p[f"b{s}"] for s in "fb"), live)
        return float(np.sum(np.logaddexp(0, z) - y * z)) / 3

    for k, g in net.loss_step(x, live, y, w).items():
        i = np.unravel_index(np.argmax(np.abs(g)), g.shape)
        old = net.p[k][i]
        net.p[k][i] = old + 1e-3
        up = loss()
        net.p[k][i] = old - 1e-3
        down = loss()
        net.p[k][i] = old
        assert abs((up - down) / 2e-3 - g[i]) < 2e-3 * max(1, abs(g[i])), k


def test_windows_cover_every_word_and_overlap():
    doc = np.repeat([0, 2, 3], [100, 5, 33])
    first, length, owner = toxicity.windows_of(doc, 4)
    begin = {0: 0, 1: 100, 2: 100, 3: 105}
    for d, n in enumerate([100, 0, 5, 33]):
        own = [(f - begin[d], k) for f, k, o in zip(first, length, owner) if o == d]
        assert {x for f, k in own for x in range(f, f + k)} == set(range(n)) and len(own) >= 1
        assert all(b[0] - a[0] == toxicity.STRIDE for a, b in zip(own, own[1:]))


def test_words_of_pattern():
    import pyarrow as pa

    w = toxicity.Words(pa.array(["Idiot, you're Ünï".encode()], pa.large_binary()))
    assert len(w.word) == len(re.findall("[0-9a-z\x80-\U0010ffff]+", "idiot, you're Ünï"))
