"""Spelling variants: words one edit apart, found in a frequency-vector trie.

A word's vector counts its letters by group, in a fixed order of groups.  One
inserted letter adds one to a count; one replaced letter adds one and takes one
away, or changes nothing within a group.  Words are arranged in a trie by
successive counts; a search goes down the trie depth first and may spend one
surplus and one deficit; the words of the leaves it reaches are compared.

* Each pair is found once, from the word whose vector comes first: the first
  count that differs must be a surplus of the other word (equal vectors: the other
  word is the later one).
* The trie's upper part spreads the work: words are filed under their first
  counts, and a word's search is sent to the few prefixes that its budget
  reaches.  A prefix with more than ``limit`` words and searches is cut at
  the next depth of ``DEPTHS``, for as long as there are counts; where all
  counts are equal, words and searches are split by hash and meet part by part.
* In a task the part of the trie below the prefix is a sorted array of vectors; searches go
  down it in chunks, deepest first, and stop at ranges of ``LEAF`` words.

Edge cases: null or empty text has no words; a null id joins the hash as the text
``null``; repeated rows count each; words of any length work (those over ``WIDE``
letters are compared one by one); an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship, slices, written

#: The order of the letters in a vector, most telling ones first.
LETTERS = "entiorsahldcumgpvbfwkzjxyq"
#: The 64 letters from U+00C0 on are dealt to so many groups by their code point.
BEYOND = 6
GROUPS = len(LETTERS) + BEYOND
DEPTHS = (3, 6, 10, 16, 24, GROUPS)

LEAST_LENGTH = 7
HELD = 1 << 18
LEAF = 6
WIDE = 40
CHUNK = 1 << 15

GROUP_OF = np.full(256, -1, np.int64)
for _i, _c in enumerate(LETTERS):
    GROUP_OF[ord(_c)] = _i
for _c in range(0xC0, 0x100):
    GROUP_OF[_c] = len(LETTERS) + _c % BEYOND

ROW = "search boolean, word string, n long, plus int, minus int, key binary"
LINK = "word string, other string, other_n long"


# -- words ------------------------------------------------------------------------

def _runs(least: int) -> re.Pattern:
    return re.compile("[a-zÀ-ÿ]{%d,}" % least)


def words_of(text: str, doc_id: str, least: int, modulus: int, found: Counter) -> None:
    """Add the words of one text: runs in small ASCII letters, some of them with a letter deleted."""
    runs = Counter(m.group() for m in _runs(least).finditer(text))
    start = zlib.crc32(f"{doc_id}:".encode())
    for run, n in runs.items():
        h = zlib.crc32(run.encode(), start)
        if h % modulus == 0:
            at = h % len(run)
            run = run[:at] + run[at + 1:]
            if len(run) < least:
                continue
        found[run] += n


def vocabulary(docs: DataFrame, least: int = LEAST_LENGTH, least_n: int = 2, modulus: int = 31) -> DataFrame:
    """word, n: words of at least ``least`` code points that occur ``least_n`` times or more."""
    def count(batches):
        found: Counter = Counter()

        def out():
            yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], ["word", "n"])
            found.clear()

        for batch in batches:
            for piece, texts in slices(batch):
                for doc_id, raw in zip(piece.column("id").to_pylist(), texts):
                    words_of(raw.as_py().lower().decode("utf-8", "replace"), doc_id, least, modulus, found)  # bytes.lower: A-Z alone
                    if len(found) > HELD:
                        yield from out()
        yield from out()

    ship(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("null")).alias("id"), "text")
    return (texts.mapInArrow(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_n))


# -- vectors ------------------------------------------------------------------------

def letters_of(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All words' code points in a row, and each word's length."""
    return (np.frombuffer("".join(words.to_pylist()).encode("latin-1"), np.uint8),
            pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64))


def vectors(buf: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    owner = np.repeat(np.arange(len(lengths)), lengths)
    flat = np.bincount(owner * GROUPS + GROUP_OF[buf], minlength=len(lengths) * GROUPS)
    return flat.reshape(len(lengths), GROUPS).astype(np.int32)


def _steps(plus: int, minus: int, low: int, high: int) -> list[tuple[int | None, int | None]]:
    """What a search may spend on the counts ``low`` to ``high``: (surplus at, deficit at), the surplus first."""
    if minus:
        return [(None, None)]
    if plus:
        return [(None, None), *((None, j) for j in range(low, high))]
    return [(None, None), *((i, None) for i in range(low, high)), *((i, j) for i in range(low, high) for j in range(i + 1, high))]


def _binary(keys: np.ndarray) -> pa.Array:
    kind = pa.binary(keys.shape[1])
    return pa.FixedSizeBinaryArray.from_buffers(kind, len(keys), [None, pa.py_buffer(keys.tobytes())]).cast(pa.binary())


def _extend(low: int, high: int):
    """Rows filed under their first ``low`` counts go under their first ``high``; a search to each prefix that it reaches."""
    def extend(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            vec = vectors(*letters_of(batch.column("word")))
            search = batch.column("search").to_numpy(zero_copy_only=False)
            plus, minus = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("plus", "minus"))
            old = np.frombuffer(b"".join(batch.column("key").to_pylist()), np.uint8).reshape(batch.num_rows, 4 * low)
            for s, p, m in ((False, 0, 0), (True, 0, 0), (True, 1, 0), (True, 1, 1)):
                rows = np.flatnonzero((search == s) & (plus == p) & (minus == m))
                for i, j in _steps(p, m, low, high) if s else [(None, None)]:
                    at = rows if j is None else rows[vec[rows, j] > 0]
                    if not len(at):
                        continue
                    own = vec[at, low:high].copy()
                    if i is not None:
                        own[:, i - low] += 1
                    if j is not None:
                        own[:, j - low] -= 1
                    key = np.concatenate([old[at], np.ascontiguousarray(own.astype(">u4")).view(np.uint8).reshape(len(at), -1)], axis=1)
                    part = batch.take(pa.array(at))
                    yield pa.RecordBatch.from_arrays([
                        part.column("search"), part.column("word"), part.column("n"),
                        pa.array(plus[at] + (i is not None), pa.int32()), pa.array(minus[at] + (j is not None), pa.int32()),
                        _binary(key)], ["search", "word", "n", "plus", "minus", "key"])
    return extend


# -- the trie below a prefix --------------------------------------------------------

class Words:
    """Words of a group: code points, lengths, vectors, and for comparing two padded matrices, from the front and from the back."""

    def __init__(self, words: pa.Array):
        self.text = words.to_pylist()
        buf, self.lengths = letters_of(words)
        self.vec = vectors(buf, self.lengths)
        ends = np.cumsum(self.lengths)
        short = np.flatnonzero(self.lengths <= WIDE)
        self.front = np.zeros((len(words), WIDE), np.uint8)
        self.back = np.zeros((len(words), WIDE), np.uint8)
        col = np.arange(WIDE)
        for block in np.array_split(short, max(1, len(short) >> 14)):
            inside = col < self.lengths[block, None]
            size = max(1, len(buf))
            self.front[block] = np.where(inside, buf[np.minimum((ends - self.lengths)[block, None] + col, size - 1)], 0)
            self.back[block] = np.where(inside, buf[np.maximum(ends[block, None] - 1 - col, 0)], 0)


def _leading(equal: np.ndarray) -> np.ndarray:
    """Number of true values at the front of each row."""
    return np.where(equal.all(axis=1), equal.shape[1], equal.argmin(axis=1))


def one_edit(a: str, b: str) -> bool:
    """Whether b is a with one code point replaced, inserted or deleted."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    i = next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[i + (len(a) == len(b)):] == b[i + 1:]


def _confirmed(q: Words, w: Words, qi: np.ndarray, wi: np.ndarray) -> np.ndarray:
    """Which pairs are one edit apart, the word's vector being the later one (equal vectors: the later word)."""
    la, lb = q.lengths[qi], w.lengths[wi]
    ok = (lb - la == 0) | (lb - la == 1)
    wide = np.flatnonzero(ok & (np.maximum(la, lb) > WIDE))
    ok &= np.maximum(la, lb) <= WIDE
    at = np.flatnonzero(ok)
    a, b, n, more = qi[at], wi[at], la[at], lb[at] - la[at]
    front = q.front[a] == w.front[b]
    pre = _leading(front)
    suf = _leading(q.back[a] == w.back[b])
    good = np.where(more == 1, pre + suf >= n, (pre < n) & (np.minimum(pre, n) + np.minimum(suf, n) >= n - 1))
    keep = at[good]
    if len(wide):
        keep = np.concatenate([keep, [k for k in wide if one_edit(q.text[qi[k]], w.text[wi[k]])]]).astype(np.int64)
    if not len(keep):
        return keep
    diff = w.vec[wi[keep]] - q.vec[qi[keep]]
    differs = diff != 0
    first = differs.argmax(axis=1)
    same = ~differs.any(axis=1)
    later = np.fromiter((w.text[wi[k]] > q.text[qi[k]] if s else False for k, s in zip(keep, same)), bool, len(keep))
    return keep[np.where(same, later, diff[np.arange(len(keep)), first] > 0)]


def _pairs(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and members of the ranges [lo, hi)."""
    n = hi - lo
    row = np.repeat(np.arange(len(lo)), n)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n) + lo[row]


def links_below(words: Words, searches: Words, plus: np.ndarray, minus: np.ndarray, depth: int):
    """Pairs (search, word) one edit apart, in chunks; all words have the prefix of ``depth`` counts that the searches were sent to."""
    vec = words.vec[:, depth:]
    order = np.lexsort(vec.T[::-1]) if vec.shape[1] else np.arange(len(vec))
    vec = vec[order]
    base = int(max(words.vec.max(initial=0), searches.vec.max(initial=0))) + 3
    node, keys = np.zeros(len(vec), np.int64), []  # per level: node number and count, ascending
    for level in range(vec.shape[1]):
        key = node * base + vec[:, level] + 1
        keys.append(key)
        node = np.concatenate([[0], np.cumsum(key[1:] != key[:-1])]) if len(key) else key
    levels = len(keys)
    for start in range(0, len(searches.text), CHUNK):
        q = np.arange(start, min(start + CHUNK, len(searches.text)))
        stack = [(0, q, np.zeros(len(q), np.int64), np.full(len(q), len(vec)), plus[q] > 0, minus[q] > 0)]
        while stack:
            level, q, lo, hi, spent, owed = stack.pop()
            if len(q) > 2 * CHUNK:  # bounded memory: the rest waits
                half = len(q) // 2
                stack += [(level, q[s], lo[s], hi[s], spent[s], owed[s]) for s in (slice(half, None), slice(half))]
                continue
            leaf = (hi - lo <= LEAF) | (level == levels)
            if leaf.any():
                row = np.flatnonzero(leaf)
                size = np.cumsum(hi[row] - lo[row])
                for cut in np.split(row, np.searchsorted(size, np.arange(4 * CHUNK, size[-1], 4 * CHUNK))):
                    r, member = _pairs(lo[cut], hi[cut])
                    for s in range(0, len(r), 4 * CHUNK):  # a leaf of equal vectors may be large
                        qi, wi = q[cut[r[s:s + 4 * CHUNK]]], order[member[s:s + 4 * CHUNK]]
                        good = _confirmed(searches, words, qi, wi)
                        yield qi[good], wi[good]
                rest = ~leaf
                q, lo, hi, spent, owed = q[rest], lo[rest], hi[rest], spent[rest], owed[rest]
            if not len(q):
                continue
            key = keys[level]
            node = key[lo] // base * base
            count = searches.vec[q, depth + level] + 1 + node
            found = []
            for change, may in ((0, slice(None)), (1, ~spent), (-1, spent & ~owed)):
                want = count[may] + change
                to_lo = np.maximum(np.searchsorted(key, want, "left"), lo[may])
                to_hi = np.minimum(np.searchsorted(key, want, "right"), hi[may])
                live = to_lo < to_hi
                found.append((q[may][live], to_lo[live], to_hi[live], spent[may][live] | (change > 0), owed[may][live] | (change < 0)))
            stack.append((level + 1, *(np.concatenate(c) for c in zip(*found))))


def _search(depth: int):
    def search(group: pa.Table) -> pa.Table:
        kind = group.column("search").combine_chunks()
        own, asked = group.filter(pc.invert(kind)).combine_chunks(), group.filter(kind).combine_chunks()
        words, searches = (Words(t.column("word").combine_chunks() if t.num_rows else pa.array([], pa.string())) for t in (own, asked))
        n, m = (t.column("n").to_numpy() for t in (own, asked))
        out = [pa.table([[], [], []], schema=LINKS)]
        if len(words.text) and len(searches.text):
            for qi, wi in links_below(words, searches, asked.column("plus").to_numpy(), asked.column("minus").to_numpy(), depth):
                if len(qi):
                    a, b = asked.column("word").take(pa.array(qi)), own.column("word").take(pa.array(wi))
                    out.append(pa.table([pa.chunked_array([*a.chunks, *b.chunks]), pa.chunked_array([*b.chunks, *a.chunks]),
                                         pa.array(np.concatenate([n[wi], m[qi]]), pa.int64())], schema=LINKS))
        return pa.concat_tables(out)
    return search


LINKS = pa.schema([("word", pa.string()), ("other", pa.string()), ("other_n", pa.int64())])


def links(vocab: DataFrame, limit: int = 200_000, depths: tuple[int, ...] = DEPTHS) -> DataFrame:
    """word, other, other_n: every ordered pair of words (word, n) that are one edit apart, once."""
    ship(vocab.sparkSession)
    both = vocab.select(F.explode(F.array(F.lit(False), F.lit(True))).alias("search"), "word", "n", F.lit(0).alias("plus"),
                        F.lit(0).alias("minus"), F.lit(b"").alias("key"))
    out, low = [], 0
    for depth in depths:
        rows = both.mapInArrow(_extend(low, depth), ROW)
        loads = written(
            rows.groupBy("key").agg(F.count_if(~F.col("search")).alias("words"), F.count_if(F.col("search")).alias("searches"))
            .filter("words > 0 and searches > 0").withColumn("hot", F.col("words") + F.col("searches") > limit), "spelling-loads")
        last = depth == depths[-1]
        here = loads if last else loads.filter(~F.col("hot"))
        # parts of a prefix whose words all have one vector; one part each for all others
        here = here.select("key", F.ceil(F.col("words") / limit).cast("int").alias("w"), F.ceil(F.col("searches") / limit).cast("int").alias("s"))
        own = F.pmod(F.xxhash64("word"), F.when(F.col("search"), F.col("s")).otherwise(F.col("w"))).cast("int")
        met = rows.join(here, "key").withColumn("own", own)
        met = met.withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("search"), F.col("w")).otherwise(F.col("s")) - 1)))
        met = met.select("search", "word", "n", "plus", "minus", "key", F.when(F.col("search"), F.col("other")).otherwise(F.col("own")).alias("w"),
                         F.when(F.col("search"), F.col("own")).otherwise(F.col("other")).alias("s"))
        out.append(met.groupBy("key", "w", "s").applyInArrow(_search(depth), LINK))
        if last or not loads.agg(F.max("hot")).first()[0]:
            break
        both, low = rows.join(loads.filter("hot").select("key"), "key", "left_semi").select(*both.columns), depth
    return reduce(DataFrame.unionByName, out)


# -- forms ----------------------------------------------------------------------------

def spelling_variants(docs: DataFrame, times: int = 10, limit: int = 200_000) -> DataFrame:
    """word, n, n_near, form, form_n, root for each word of ``docs`` (doc_id, text).

    A word's form is its most frequent near word (ties: the smallest) if that one is
    ``times`` as frequent; the root is the last form of the chain.
    """
    vocab = written(vocabulary(docs), "spelling-words")
    near = (links(vocab, limit).groupBy("word")
            .agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("other_n")).alias("less"), "other")).alias("best")))
    # n and form_n of a form are at least `times` apart, so a chain has at most log(n) steps
    known = written(
        vocab.join(near, "word", "left")
        .withColumn("fits", -F.col("best.less") >= times * F.col("n"))
        .select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("fits"), F.col("best.other")).alias("form"),
                F.when(F.col("fits"), -F.col("best.less")).alias("form_n")), "spelling-forms")
    most, steps = known.agg(F.max("n")).first()[0] or 1, 0
    while most >= times:
        most, steps = most // times, steps + 1
    hop = known.filter("form is not null").select("word", F.col("form").alias("root"))
    reach = 1
    while reach < steps:  # after k rounds a hop spans 2**k forms
        ahead = hop.select(F.col("word").alias("root"), F.col("root").alias("next"))
        hop = written(hop.join(ahead, "root", "left").select("word", F.coalesce("next", "root").alias("root")), "spelling-roots")
        reach *= 2
    return (known.join(hop, "word", "left")
            .select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"))
