"""Token counts and the BPE codec against the tokenizer libraries."""

import random

import pyarrow as pa
import pytest

import text_cases as T
from skytally.llm import bpe_codec, token_counts
from skytally.llm.queries import tokenizer


def test_token_counts_equal_the_library(spark):
    import sentencepiece

    docs = T.edge_docs() + [(1000, "▁mark  and   spaces "), (1001, "<s> </s> <unk> \r\n\x00 tab\t"), (1002, "日本語 " * 50)]
    sp = sentencepiece.SentencePieceProcessor(model_file=tokenizer("piece_bpe_32k.model"))
    n = [len(x) for x in sp.encode([t or "" for _, t in docs])]
    got = token_counts.token_counts(T.frame(spark, docs), tokenizer("piece_bpe_32k.model")).collect()
    T.same(got, [(i, len((t or "").encode()), k, k > 4096) for (i, t), k in zip(docs, n)])
    assert token_counts.token_counts(T.frame(spark, docs).limit(0), tokenizer("piece_bpe_32k.model")).count() == 0


def test_caches_are_bounded_and_do_not_change_counts():
    model, splits = token_counts.load(tokenizer("piece_bpe_32k.model"))
    assert splits
    lengths = token_counts.Lengths(model, {"▁the": 1})
    old, token_counts.CACHE_SIZE = token_counts.CACHE_SIZE, 50
    try:
        for k in range(200):
            assert lengths[f"▁word{k}"] == len(model.encode(f"▁word{k}")) and len(lengths) <= 51
        assert lengths["▁the"] == 1
    finally:
        token_counts.CACHE_SIZE = old


def test_summary_keeps_the_frequent_items():
    s = token_counts.Summary(4)
    for k in range(2000):
        s.add([f"rare{k}", "often", "often"])
    assert s.top()[0][0] == "often" and len(s.counts) <= 64 * 4 + 2


@pytest.mark.parametrize("sizes", [(1024, 256, 8192), (16, 1, 64), (64, 8, 200)])
def test_codec_equals_the_library_for_any_chunk_size(monkeypatch, sizes):
    for name, v in zip(("MEAN_CHUNK", "LEAST_CHUNK", "MOST_CHUNK"), sizes):
        monkeypatch.setattr(bpe_codec, name, v)
    codec = bpe_codec.Codec(tokenizer("byte_bpe_50k.json"))
    texts = [(t or "")[:20_000] for _, t in T.edge_docs()]
    texts += ["<|endoftext|>", "a<|endoftext|>b <|endoftext|>", "<|endof", "don't I'll we've 's 're", " \n\n  x 　 y z", "日本語" * 900, "🎉é" * 400, "123 456", "x'r" * 90]
    want = [e.ids for e in codec.library.encode_batch(texts, add_special_tokens=False)]
    got = bpe_codec.encode_texts(codec, pa.array([t.encode() for t in texts], pa.large_binary()))
    assert [x.tolist() for x in got] == want
    assert [codec.decode(x) for x in want] == [codec.library.decode(x, skip_special_tokens=False) for x in want]


def _fuzz_texts(n, seed):
    r = random.Random(seed)
    alphabet = ["a", "b", "é", "日", "本", "。", "ж", "я", " ", "  ", "\n", "\t", "'s", "'", "'ll", "1", "23", "½", "!", "…", "\x1c", "\u0085", "\u3000",
                "🎉", "\u0301", "\u0378", "<|endoftext|>", "<|endof", "\x00", "ǅ", "٣", "a'", "!'"]
    for _ in range(n):
        some = r.sample(alphabet, r.randint(2, 12))
        yield "".join(r.choice(some) for _ in range(r.randint(0, 600)))


@pytest.mark.parametrize("sizes", [(16, 1, 64), (64, 8, 200), (8, 1, 16)])
def test_codec_equals_the_library_for_awkward_texts(monkeypatch, sizes):
    for name, v in zip(("MEAN_CHUNK", "LEAST_CHUNK", "MOST_CHUNK"), sizes):
        monkeypatch.setattr(bpe_codec, name, v)
    codec = bpe_codec.Codec(tokenizer("byte_bpe_50k.json"))
    texts = [*_fuzz_texts(800, sizes[0])]
    want = [e.ids for e in codec.library.encode_batch(texts, add_special_tokens=False)]
    assert [x.tolist() for x in bpe_codec.encode_texts(codec, pa.array([t.encode() for t in texts], pa.large_binary()))] == want


def _script(name, n, r=random.Random(7)):
    letters = lambda low, high, k: "".join(chr(r.randint(low, high)) for _ in range(k))
    return {
        "latin": lambda: " ".join(letters(97, 122, r.randint(2, 9)) for _ in range(n // 6)),
        "cjk": lambda: "。".join(letters(0x4E00, 0x9000, r.randint(3, 30)) for _ in range(n // 17)),
        "cjk_alone": lambda: letters(0x4E00, 0x9000, n),
        "cyrillic": lambda: " ".join(letters(0x430, 0x44F, r.randint(2, 9)) for _ in range(n // 6)),
        "numbers": lambda: " ".join(str(r.randint(0, 10 ** 6)) for _ in range(n // 6)),
        "no_space": lambda: "".join(r.choice("abcdef0123") for _ in range(n)),
        "one_run": lambda: letters(97, 104, n),
    }[name]()


@pytest.mark.parametrize("name", ["latin", "cjk", "cjk_alone", "cyrillic", "numbers", "no_space", "one_run"])
def test_long_texts_of_every_script_are_encoded_in_linear_time(name):
    codec = bpe_codec.Codec(tokenizer("byte_bpe_50k.json"))
    text = _script(name, 1_000_000)
    got = bpe_codec.encode_texts(codec, pa.array([text.encode()], pa.large_binary()))[0]
    assert codec.encoded < 3 * len(text)
    assert got.tolist() == codec.library.encode(text, add_special_tokens=False).ids


def test_chunks_are_shared_around_special_strings():
    codec = bpe_codec.Codec(tokenizer("byte_bpe_50k.json"))
    text = " ".join(f"word{k} and more" for k in range(3000))
    once = lambda t: bpe_codec.encode_texts(codec, pa.array([t.encode()], pa.large_binary()))[0].tolist()
    once(text)
    first = codec.encoded
    for more in (text + "<|endoftext|>", "<|endoftext|>" + text, text[:20_000] + "<|endoftext|>" + text[20_000:]):
        before = codec.encoded
        assert once(more) == codec.library.encode(more, add_special_tokens=False).ids
        assert codec.encoded - before < 0.05 * first


def test_equal_chunks_are_encoded_once():
    codec = bpe_codec.Codec(tokenizer("byte_bpe_50k.json"))
    text = " ".join(f"word{k} and more" for k in range(3000))
    raw = pa.array([text.encode()], pa.large_binary())
    bpe_codec.encode_texts(codec, raw)
    first = codec.encoded
    bpe_codec.encode_texts(codec, raw)
    assert codec.encoded - first < 0.1 * first  # only the stretches at the joins


def test_round_trip_and_digests(spark):
    docs = T.edge_docs()
    path, df = tokenizer("byte_bpe_50k.json"), T.frame(spark, docs)
    lib = bpe_codec.Codec(path).library
    ids = [e.ids for e in lib.encode_batch([t or "" for _, t in docs], add_special_tokens=False)]
    T.same(bpe_codec.bpe_digests(df, path).collect(),
           [(i, len(x), T.sha(",".join(map(str, x))), T.sha(lib.decode(x, skip_special_tokens=False))) for (i, _), x in zip(docs, ids)])
    T.same(bpe_codec.bpe_decode(bpe_codec.bpe_encode(df, path), path).collect(), [(i, t or "") for i, t in docs])
    assert bpe_codec.bpe_digests(df.limit(0), path).count() == 0
