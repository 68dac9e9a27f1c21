"""Byte-level BPE encoding and decoding with content-defined chunk reuse.

A text is cut where a rolling hash of the last ``WINDOW`` bytes meets a
pattern, so equal passages of different documents give equal chunks.  Each
worker encodes a chunk once and keeps its ids (the store is emptied when it
holds ``STORE_BYTES``).

Encoding chunks alone is wrong near a cut.  The joins are repaired by
re-encoding the text from a *sync point* before the cut to one after it.  A
sync point is a place that no match of the pre-tokenizer's pattern can span, whatever
stands around it: behind a character that is no white space, where white space begins or
the kind of character changes (letter, number, other).  Every script has them.  After
re-encoding, both neighbours must have a token border at the chosen points; where one hasn't, or
a chunk has no sync point, the stretch grows by the next chunk.  It is encoded when its
end is found, so every character is encoded twice at most, once in its chunk and once
in a stretch, also in a text without any sync point.

Strings of added tokens part a text; what lies between them is joined from chunks like a whole text.

Decoding concatenates the bytes of the tokens and replaces invalid UTF-8, as
the library's byte-level decoder does.  Strings of added tokens in a text
become their id, as the library does by default.

Edge cases: null is the empty text: no ids, and the hashes of empty strings.
One row out per row in, also for repeated rows and null ids; an empty table
gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
import unicodedata

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from .shared import buffer_of, hash_spans, prefix_sums, ship, slices

WINDOW = 32
MEAN_CHUNK = 1024
LEAST_CHUNK = 256
MOST_CHUNK = 8192
STORE_BYTES = 96 << 20
#: The public byte-level pre-tokenizer pattern.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: White space of all Unicode versions; the separators U+001C to U+001F count as such for some libraries only, so no sync point is taken beside them.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
OTHER = rf"[^\p{{L}}\p{{N}}{SPACE}\x1c-\x1f]"
#: An apostrophe may take the letters behind it along.
SYNC = regex.compile(rf"(?<=[^{SPACE}\x1c-\x1f])(?=[{SPACE}])|(?<=\p{{L}})(?=\p{{N}}|{OTHER})|(?<=\p{{N}})(?=\p{{L}}|{OTHER})|(?<=(?!'){OTHER})(?=[\p{{L}}\p{{N}}])")
_CODECS: dict = {}  # per worker, by path


def byte_alphabet() -> dict[str, int]:
    """The characters that stand for bytes in the vocabulary file: printable
    Latin-1 characters stand for themselves, the others are counted up from 256."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class Codec:
    """Encoder and decoder of one tokenizer file, with the store of chunks."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        plain = (spec["pre_tokenizer"]["type"] == "ByteLevel" and not spec["pre_tokenizer"]["add_prefix_space"]
                 and spec["normalizer"] is None and all(not (t["lstrip"] or t["rstrip"] or t["single_word"]) for t in spec["added_tokens"]))
        letters = byte_alphabet()
        size = max(spec["model"]["vocab"].values()) + 1
        size = max([size, *(i + 1 for i in self.special.values())])
        self.bytes_of: list[bytes] = [b""] * size
        for token, i in spec["model"]["vocab"].items():
            self.bytes_of[i] = bytes(letters[c] for c in token) if i not in self.special.values() else token.encode()
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.length = np.array([len(b) for b in self.bytes_of], np.int64)
        self.decimal = [str(i) for i in range(size)]
        # The same vocabulary as ranks: several times faster per chunk, same ids.
        merged = spec["model"]["vocab"]
        ranks = {self.bytes_of[i]: i for t, i in merged.items() if t not in self.special}
        self.fast = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if plain else None
        self.marks = [t.encode() for t in self.special]
        self.cut_bytes = re.compile(b"|".join(map(re.escape, sorted(self.marks, key=len, reverse=True)))) if self.marks else None
        self.store: dict[bytes, np.ndarray] = {}
        self.held = 0
        self.encoded = 0

    def plain(self, text: str) -> np.ndarray:
        """Ids of a text without special strings, by one call to the encoder."""
        self.encoded += len(text)
        if self.fast is None:
            return np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
        return self.fast.encode_to_numpy(text, disallowed_special=()).astype(np.uint32)

    def chunk(self, raw: bytes) -> np.ndarray:
        ids = self.store.get(raw)
        if ids is None:
            ids = self.plain(raw.decode("utf-8", "replace"))
            self.held += len(raw) + 4 * len(ids) + 200
            if self.held > STORE_BYTES:
                self.store.clear()
                self.held = len(raw) + 4 * len(ids)
            self.store[raw] = ids
        return ids

    def border(self, ids: np.ndarray, at: int) -> int:
        """Index of the token that starts at byte ``at``; -1 if none does."""
        ends = np.cumsum(self.length[ids])
        if at == 0:
            return 0
        i = int(np.searchsorted(ends, at))
        return i + 1 if i < len(ends) and ends[i] == at else -1

    def joined(self, raw: bytes, cuts: list[int]) -> np.ndarray:
        """Ids of a text from its chunks, the joins repaired."""
        if not cuts:
            return self.chunk(raw)
        edges = [*cuts, len(raw)]
        out: list[np.ndarray] = []
        ids, begin, done = self.chunk(raw[:cuts[0]]), 0, 0  # a chunk and its start; its tokens before ``done`` are not used
        left = -1  # where the open stretch starts
        for cut, end in zip(edges, edges[1:]):
            if left < 0:
                settled = begin + int(self.length[ids[:done]].sum())
                left = last_sync(raw, settled, cut)
                i = self.border(ids, left - begin) if left >= 0 else -1
                if i < done:
                    left, i = settled, done
                out.append(ids[done:i])
            right = cut if left == cut else first_sync(raw, cut, end)
            if right < 0:
                continue  # the stretch goes on
            nxt = self.chunk(raw[cut:end])
            j = self.border(nxt, right - cut)
            if j < 0:
                continue
            if right > left:
                out.append(self.plain(raw[left:right].decode("utf-8", "replace")))
            ids, begin, done, left = nxt, cut, j, -1
        out.append(ids[done:] if left < 0 else self.plain(raw[left:].decode("utf-8", "replace")))
        return np.concatenate(out)

    def encode(self, raw: bytes, cuts: list[int]) -> np.ndarray:
        """Ids of a text as the library gives them; ``cuts`` are its chunk borders."""
        if not raw:
            return np.zeros(0, np.uint32)
        if self.fast is None:
            return self.plain(raw.decode("utf-8", "replace"))
        if not any(m in raw for m in self.marks):
            return self.joined(raw, cuts)
        out, at = [], 0
        for m in [*self.cut_bytes.finditer(raw), None]:
            end = m.start() if m else len(raw)
            if end > at:
                out.append(self.joined(raw[at:end], [c - at for c in cuts if at < c < end]))
            if m:
                out.append(np.array([self.special[m[0].decode()]], np.uint32))
                at = m.end()
        return np.concatenate(out)

    def decode(self, ids: list[int]) -> str:
        return b"".join(map(self.bytes_of.__getitem__, ids)).decode("utf-8", "replace")


def _syncs(raw: bytes, lo: int, hi: int):
    """Byte positions of the sync points p with lo < p <= hi (the character behind ``hi`` is looked at too)."""
    while lo < hi and raw[lo] & 0xC0 == 0x80:
        lo += 1
    to = min(len(raw), hi + 4)
    text = raw[lo:to].decode("utf-8", "ignore")
    at, chars = lo, 0
    for m in SYNC.finditer(text):
        k = m.start()
        at, chars = at + len(text[chars:k].encode()), k
        if at > hi:
            return
        # code points that this version does not know may be of another kind to the encoder
        if unicodedata.category(text[k - 1]) != "Cn" and unicodedata.category(text[k]) != "Cn":
            yield at


def last_sync(raw: bytes, lo: int, hi: int) -> int:
    step = 64
    while True:
        at = max(lo, hi - step)
        found = [*_syncs(raw, at, hi)]
        if found:
            return found[-1]
        if at == lo:
            return -1
        step *= 4


def first_sync(raw: bytes, lo: int, hi: int) -> int:
    step = 64
    while True:
        at = min(hi, lo + step)
        p = next(_syncs(raw, lo, at), -1)
        if 0 <= p < hi or at == hi:
            return p if p < hi else -1
        step *= 4


def chunk_cuts(buf: np.ndarray, offs: np.ndarray) -> list[list[int]]:
    """For every text of a buffer its chunk borders, relative to its start."""
    if len(buf) <= WINDOW:
        return [[] for _ in offs[1:]]
    sums = prefix_sums(buf)
    s = np.arange(len(buf) - WINDOW)
    hit = np.flatnonzero(hash_spans(sums, s, s + WINDOW) % np.uint64(MEAN_CHUNK) == 0) + WINDOW  # a cut before these bytes
    lead = (buf & 0xC0) != 0x80
    out = []
    for a, b in zip(offs[:-1].tolist(), offs[1:].tolist()):
        own, cuts, at = hit[np.searchsorted(hit, a + WINDOW):np.searchsorted(hit, b)].tolist(), [], a
        for h in [*own, b]:
            while h - at > MOST_CHUNK:
                cuts.append(at + MOST_CHUNK)
                at = cuts[-1]
            if h < b and h - at >= LEAST_CHUNK:
                cuts.append(h)
                at = h
        snapped = []
        for c in cuts:
            while c < b and not lead[c]:
                c += 1
            if c < b and (not snapped or c > snapped[-1]):
                snapped.append(c)
        out.append([c - a for c in snapped])
    return out


def codec(path: str) -> Codec:
    if path not in _CODECS:
        _CODECS[path] = Codec(path)
    return _CODECS[path]


def encode_texts(c: Codec, raw: pa.Array) -> list[np.ndarray]:
    buf, offs = buffer_of(raw)
    return [c.encode(x, cuts) for x, cuts in zip(raw.to_pylist(), chunk_cuts(buf, offs))]


def bpe_encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and the ids (array<int>) of every text."""
    ship(docs.sparkSession)

    def run(batches):
        c = codec(path)
        for batch in batches:
            for piece, raw in slices(batch):
                ids = encode_texts(c, raw)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), pa.array([x.tolist() for x in ids], pa.list_(pa.int32()))], ["doc_id", "ids"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {kind}, ids array<int>")


def bpe_decode(encoded: DataFrame, path: str) -> DataFrame:
    """doc_id and the text of the ids (null ids: empty)."""
    ship(encoded.sparkSession)

    def run(batches):
        c = codec(path)
        for batch in batches:
            texts = [c.decode(x or []) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    kind = encoded.schema["doc_id"].dataType.simpleString()
    return encoded.select("doc_id", "ids").mapInArrow(run, f"doc_id {kind}, text string")


def bpe_digests(docs: DataFrame, path: str, with_ids: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode and decode in one pass; the ids too if wanted."""
    ship(docs.sparkSession)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256", *["ids"] * with_ids]

    def run(batches):
        c = codec(path)
        sha = lambda b: hashlib.sha256(b).hexdigest()
        for batch in batches:
            for piece, raw in slices(batch):
                n, a, b, arrays = [], [], [], encode_texts(c, raw)
                for ids in map(np.ndarray.tolist, arrays):
                    n.append(len(ids))
                    a.append(sha(",".join(map(c.decimal.__getitem__, ids)).encode()))
                    b.append(sha(c.decode(ids).encode()))
                out = [piece.column("doc_id"), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())]
                if with_ids:
                    flat = np.concatenate(arrays).astype(np.int32)
                    out.append(pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(n)), pa.int32()), pa.array(flat)))
                yield pa.RecordBatch.from_arrays(out, names)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids)
