"""N-gram Jaccard join with signature trees: near duplicates and their components.

A document's set holds its distinct shingles.  Two documents link when
``100 * common >= percent * union``.

1. Documents with equal sets form one class (a hash of the set); only one
   set per class is compared.
2. Spark counts the shingles (32 bits of each, packed per hash shard, added
   up per task first) and sets a bit for each that two documents have, and in
   a smaller bitmap for frequent ones.  This gives one order for all: shingles of one
   document, then shared ones, then frequent ones, each by hash.
3. Two sets that link share a shingle within their prefixes in that order
   (``n - ceil(percent * n / 100) + 1`` of n).  Prefix shingles of one document only meet
   nobody, so most documents drop out here.  Sets that share a prefix shingle are
   candidates if their sizes and *sketches* (how many shingles fall on each of ``PARTS`` parts of
   the hashes) allow enough common ones; sets that are candidates, directly or through others, form a block.
   A common phrase alone so joins nobody, and blocks stay about as large as the groups of near copies.
4. Within a block, a *signature tree* over the sets sorted by size: leaves are
   sets, inner nodes hold the OR of their token bitmaps and the range of their sizes.
   A dual traversal drops pairs of nodes that cannot overlap enough:
   a common token needs a common bit, so two sets overlap at most by the common bits of
   their nodes plus the tokens that fell on taken bits.  What is left is compared exactly;
   pairs already connected are skipped, so large groups of copies cost few comparisons.
5. Sets are not kept: those of blocks, one per class, are made again from the texts and sent to the
   tasks of their blocks.  Blocks of more than ``BLOCK`` sets are split.  Each part is compared with itself and the first one,
   which connects near copies; then the sets outside the largest component found so far
   are compared with all, part by part.  So a set goes to two tasks, and to more only beside many sets that are left out.

The bitmaps are bounded (``2**MOST_BITS`` bits) and affect the order only: any
order gives the same links.

Edge cases: null or empty text, or text without words, has an empty set and
links with nothing; a text of fewer words than a shingle is one shingle; null
ids come last, and a document without id that links has the smallest id it
reaches; equal rows are one class; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import IS_SPACE, LOWER, buffer_of, combine, hash_spans, mix, parts, prefix_sums, release, ship, slices, trim, word_spans, written

SHARD_BYTES = 64 << 20
LEAST_SHARDS = 64
LEAST_BITS, MOST_BITS = 16, 30
FREQUENT = 32
FLUSH = 1 << 20
BLOCK = 4096
PARTS = 128
FEW = 64             # sets of a shingle of which all pairs are looked at, at once
PAIRS = 1 << 17
TOKENS = 1 << 16     # prefix shingles in a task
FAN = 8
CHUNK = 1 << 14
LAST_ID = (1 << 63) - 1


# -- sets ---------------------------------------------------------------------------

def shingle_sets(raw: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of all texts and the text of each, sorted by text and hash."""
    buf, offs = buffer_of(raw)
    buf = LOWER[buf]
    n = len(offs) - 1
    start, end, doc = word_spans(buf, offs, ~IS_SPACE)
    h = hash_spans(prefix_sums(buf), start, end)
    count = np.bincount(doc, minlength=n)
    out, own = [], []
    for k in range(1, width + 1):
        if len(h) < k:
            break
        s = combine(h[:len(h) - k + 1], np.uint64(k))
        for j in range(1, k):
            s = combine(s, h[j:len(h) - k + 1 + j])
        same = doc[:len(s)] == doc[k - 1:]
        use = same if k == width else same & (count[doc[:len(s)]] == k)
        out.append(s[use])
        own.append(doc[:len(s)][use])
    if not out:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    s, d = np.concatenate(out), np.concatenate(own)
    order = np.lexsort((s, d))
    s, d = s[order], d[order]
    new = np.append(True, (s[1:] != s[:-1]) | (d[1:] != d[:-1])) if len(s) else np.zeros(0, bool)
    return s[new], d[new]


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return (h >> np.uint64(65 - shards.bit_length())).astype(np.int64)


def cuts(key: np.ndarray):
    at = np.flatnonzero(np.append(True, key[1:] != key[:-1])) if len(key) else np.zeros(0, np.int64)
    return zip(key[at].tolist(), at.tolist(), [*at[1:].tolist(), len(key)])


def added_up(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h)
    h, n = h[order], n[order]
    at = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    return h[at], np.add.reduceat(n, at) if len(at) else n


def shingle_counts(docs: DataFrame, width: int, shards: int) -> DataFrame:
    """Packed rows: shard, the next 32 bits of the shingles' hashes, and their documents."""
    skip = np.uint64(shards.bit_length() - 1)

    def run(batches):
        held, size = [], 0

        def emit():
            h, n = added_up(np.concatenate(held), np.ones(size, np.int64))
            low = ((h << skip) >> np.uint64(32)).astype("<u4")
            rows = [*cuts(shard_of(h, shards))]
            return pa.RecordBatch.from_arrays([pa.array([s for s, _, _ in rows], pa.int64()), pa.array([low[a:b].tobytes() for _, a, b in rows], pa.binary()),
                                               pa.array([n[a:b].astype("<u4").tobytes() for _, a, b in rows], pa.binary())], ["shard", "low", "n"])

        for batch in batches:
            for _, raw in slices(batch):
                s, _ = shingle_sets(raw, width)
                held.append(s)
                size += len(s)
                if size > FLUSH:
                    yield emit()
                    held, size = [], 0
        if size:
            yield emit()
        del held
        trim()

    return docs.select("text").mapInArrow(run, "shard long, low binary, n binary")


def bitmaps(counts: DataFrame, shards: int, bits: int) -> list[tuple[np.ndarray, int]]:
    """Bits of the shingles with two documents or more, and with ``FREQUENT`` or more (16 times fewer bits)."""
    top = shards.bit_length() - 1
    sizes = [bits - top, max(3, bits - top - 4)]

    def merge(t: pa.Table) -> pa.Table:
        cat = lambda c: np.frombuffer(b"".join(t.column(c).to_pylist()), "<u4")
        low, n = added_up(cat("low"), cat("n").astype(np.int64))
        out = []
        for step, least in zip(sizes, (2, FREQUENT)):
            flags = np.zeros(1 << step, bool)
            flags[low[n >= least] >> np.uint32(32 - step)] = True
            out.append(pa.array([np.packbits(flags).tobytes()], pa.binary()))
        return pa.table([t.column("shard").slice(0, 1), *out], names=["shard", "shared", "frequent"])

    packed = [np.zeros((1 << step + top) // 8, np.uint8) for step in sizes]
    rows = written(counts.groupBy("shard").applyInArrow(merge, "shard long, shared binary, frequent binary"), "jaccard-shingles")
    for r in rows.toLocalIterator():
        for p, own in zip(packed, (r.shared, r.frequent)):
            p[r.shard * len(own):(r.shard + 1) * len(own)] = np.frombuffer(own, np.uint8)
    return [(p, step + top) for p, step in zip(packed, sizes)]


def marked(packed: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    slot = (h >> np.uint64(64 - bits)).astype(np.int64)
    return (packed[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


SETS = "ord long, key long, n long, node long, prefix array<long>, sketch binary"


def sketches(s: np.ndarray, d: np.ndarray, k: int) -> np.ndarray:
    """How many shingles of each of ``k`` sets fall on each part of the hashes, 255 at most."""
    part = (s >> np.uint64(20)).astype(np.int64) % PARTS
    return np.minimum(np.bincount(d * PARTS + part, minlength=k * PARTS), 255).astype(np.uint8).reshape(k, PARTS)


def described(docs: DataFrame, width: int, percent: int, shared) -> DataFrame:
    """Per row of ``docs`` (ord, key, text): size of the set, class and, where the prefix has shared shingles, these and the sketch of the set.

    A task gives prefix and sketch of a class once.
    """
    def run(batches):
        maps = shared.value
        given: set[int] = set()
        for batch in batches:
            for piece, raw in slices(batch):
                s, d = shingle_sets(raw, width)
                k = len(raw)
                n = np.bincount(d, minlength=k)
                begin = np.cumsum(n) - n
                rank = marked(*maps[0], s).astype(np.uint64)
                rank += (rank > 0) & marked(*maps[1], s)
                order = np.lexsort((s >> np.uint64(2) | rank << np.uint64(62), d))
                place = np.arange(len(s)) - begin[d]
                limit = n - -(-percent * n // 100) + 1
                pick = order[(place < limit[d]) & (rank[order] > 0)]
                some = np.bincount(d[pick], minlength=k)
                total = np.zeros(len(s) + 1, np.uint64)
                np.cumsum(mix(s + np.uint64(0x51ED270B)), out=total[1:])
                node = mix(total[begin + n] - total[begin] + n.astype(np.uint64)).view(np.int64)
                edge = np.append(0, np.cumsum(some)).tolist()
                chosen = s[pick].view(np.int64)
                sketch = sketches(s, d, k)
                prefix, short = [], []
                for i, (x, m) in enumerate(zip(node.tolist(), some.tolist())):
                    new = m > 0 and x not in given
                    given.update([x] * new)
                    prefix.append(chosen[edge[i]:edge[i + 1]] if new else None)
                    short.append(sketch[i].tobytes() if new else None)
                prefix = pa.array(prefix, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays([piece.column("ord"), piece.column("key"), pa.array(n, pa.int64()), pa.array(node, pa.int64(), mask=n == 0), prefix, pa.array(short, pa.binary())],
                                                 ["ord", "key", "n", "node", "prefix", "sketch"])

    return docs.select("ord", "key", "text").mapInArrow(run, SETS)


# -- candidates ---------------------------------------------------------------------------

class Sketches:
    """Sizes and sketches of sets, sorted by size; ``extra`` counts the shingles beyond 255 in a part."""

    def __init__(self, n: np.ndarray, counts: np.ndarray):
        self.n, self.counts = n, counts
        self.extra = n - counts.sum(1, dtype=np.int64)

    def can_link(self, i, j: np.ndarray, percent: int) -> np.ndarray:
        """Which pairs may overlap enough: two sets have at most the smaller count of each part in common."""
        both = self.n[i] + self.n[j]
        ok = np.flatnonzero(100 * np.minimum(self.n[i], self.n[j]) >= percent * np.maximum(self.n[i], self.n[j]))
        i, j, both = i[ok] if np.ndim(i) else i, j[ok], both[ok]
        common = np.minimum(self.counts[i], self.counts[j]).sum(1, dtype=np.int64) + np.minimum(self.extra[i], self.extra[j])
        return ok[common * (100 + percent) >= percent * both]


def spanning(x: Sketches, a: int, b: int, percent: int) -> list[tuple[int, int]]:
    """Pairs that connect the candidates among the sets [a, b), which lie by size; sets once reached are not compared again."""
    found = []
    rest = np.arange(a, b)
    while len(rest):
        reached, rest = [int(rest[0])], rest[1:]
        while reached and len(rest):
            i = reached.pop()
            size = x.n[rest]
            lo, hi = np.searchsorted(size, -(-percent * x.n[i] // 100)), np.searchsorted(size, 100 * x.n[i] // percent, "right")
            hit = lo + x.can_link(i, rest[lo:hi], percent)
            if len(hit):
                found += [(i, j) for j in rest[hit].tolist()]
                reached += rest[hit].tolist()
                rest = np.delete(rest, hit)
    return found


def candidates(token: np.ndarray, node: np.ndarray, n: np.ndarray, counts: np.ndarray, percent: int) -> np.ndarray:
    """(node, node) rows that connect the sets of each shingle that may link."""
    order = np.lexsort((node, n, token))
    token, node = token[order], node[order]
    new = np.append(True, (token[1:] != token[:-1]) | (node[1:] != node[:-1]))  # tasks that met the same class told of it once each
    order, token, node = order[new], token[new], node[new]
    x = Sketches(n[order], counts[order])
    at = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    end = np.append(at[1:], len(token))
    out = [np.array([(node[i], node[j]) for a, b in zip(at.tolist(), end.tolist()) if b - a > FEW for i, j in spanning(x, a, b, percent)], np.int64).reshape(-1, 2)]
    stop = np.repeat(np.where(end - at > FEW, 0, end), end - at)
    later = np.maximum(stop - np.arange(len(token)) - 1, 0)  # sets of the same shingle after each
    total = np.append(0, np.cumsum(later))
    lo = 0
    while lo < len(token):
        hi = max(lo + 1, int(np.searchsorted(total, total[lo] + PAIRS, "right")) - 1)
        i = np.repeat(np.arange(lo, hi), later[lo:hi])
        j = i + 1 + np.arange(len(i)) - (total[i] - total[lo])
        hit = x.can_link(i, j, percent)
        out.append(np.stack([node[i[hit]], node[j[hit]]], 1))
        lo = hi
    return np.unique(np.sort(np.concatenate(out), axis=1), axis=0)


# -- signature trees -------------------------------------------------------------------

class SignatureTree:
    """Levels from the sets up: OR of bitmaps, size range, most tokens on taken bits."""

    def __init__(self, sets: list[np.ndarray], bits: int):
        size = np.array([len(s) for s in sets])
        first = np.array([s[0] for s in sets], np.uint64)
        self.order = np.lexsort((first, size))
        sets = [sets[i] for i in self.order]
        self.sets, size = sets, size[self.order]
        own = np.repeat(np.arange(len(sets)), size)
        slot = (mix(np.concatenate(sets)) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)
        flags = np.zeros((len(sets), bits), bool)
        flags[own, slot] = True
        maps = np.packbits(flags, axis=1).view(np.uint64)
        extra = size - np.bitwise_count(maps).sum(1, dtype=np.int64)
        self.levels = [(maps, size, size, extra)]
        while len(maps) > FAN:
            at = np.arange(0, len(maps), FAN)
            _, low, high, extra = self.levels[-1]
            maps = np.bitwise_or.reduceat(maps, at)
            self.levels.append((maps, np.minimum.reduceat(low, at), np.maximum.reduceat(high, at), np.maximum.reduceat(extra, at)))


def possible(x, y, i: np.ndarray, j: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Which pairs of nodes can hold a linked pair, and the most their sets can overlap."""
    (xm, xl, xh, xe), (ym, yl, yh, ye) = x, y
    ok = (100 * xh[i] >= percent * yl[j]) & (100 * yh[j] >= percent * xl[i])
    i, j = i[ok], j[ok]
    common = np.bitwise_count(xm[i] & ym[j]).sum(1, dtype=np.int64)
    most = np.minimum(common + np.minimum(xe[i], ye[j]), np.minimum(xh[i], yh[j]))
    fits = most * (100 + percent) >= percent * (xl[i] + yl[j])
    keep = np.flatnonzero(ok)[fits]
    return keep, most[fits]


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if len(a) > len(b):
        a, b = b, a
    at = np.minimum(np.searchsorted(b, a), len(b) - 1)
    common = int((b[at] == a).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


class Union:
    def __init__(self, n: int):
        self.root = np.arange(n)

    def find(self, i: int) -> int:
        r = self.root
        while r[i] != i:
            r[i] = r[r[i]]
            i = r[i]
        return int(i)

    def flat(self) -> np.ndarray:
        while True:
            nxt = self.root[self.root]
            if (nxt == self.root).all():
                return nxt
            self.root = nxt


def dual_traversal(x: SignatureTree, y: SignatureTree, union: Union, x_at: np.ndarray, y_at: np.ndarray, percent: int) -> None:
    """Unite the linked sets of two trees (or of one, given twice); ``x_at`` numbers the sets in ``union``."""
    same = x is y
    top = min(len(x.levels), len(y.levels)) - 1
    i, j = (v.ravel() for v in np.meshgrid(np.arange(len(x.levels[top][1])), np.arange(len(y.levels[top][1])), indexing="ij"))
    stack = [(top, i, j)]
    while stack:
        level, i, j = stack.pop()
        if same:
            half = i <= j if level else i < j
            i, j = i[half], j[half]
        if len(i) > CHUNK:
            stack += [(level, i[k:k + CHUNK], j[k:k + CHUNK]) for k in range(0, len(i), CHUNK)]
            continue
        if not level:
            flat = union.flat()
            apart = flat[x_at[i]] != flat[y_at[j]]
            i, j = i[apart], j[apart]
        keep, most = possible(x.levels[level], y.levels[level], i, j, percent)
        i, j = i[keep], j[keep]
        if level:
            lo, hi = i * FAN, j * FAN
            a = (lo[:, None] + np.repeat(np.arange(FAN), FAN)).ravel()
            b = (hi[:, None] + np.tile(np.arange(FAN), FAN)).ravel()
            ok = (a < len(x.levels[level - 1][1])) & (b < len(y.levels[level - 1][1]))
            if len(a):
                stack.append((level - 1, a[ok], b[ok]))
            continue
        size = x.levels[0][1][i] + y.levels[0][1][j]
        for k in np.argsort(-most / size, kind="stable").tolist():  # the likeliest first: later ones may be connected by then
            a, b = union.find(x_at[i[k]]), union.find(y_at[j[k]])
            if a != b and linked(x.sets[i[k]], y.sets[j[k]], percent):
                union.root[max(a, b)] = min(a, b)


def bits_for(sets: list[np.ndarray]) -> int:
    return min(1 << 15, max(256, 1 << (4 * int(np.median([len(s) for s in sets]))).bit_length()))


def block_links(nodes: np.ndarray, side: np.ndarray, sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """(node, node) pairs that connect the linked sets of one block, or of two of its parts (``side`` 0 and 1)."""
    union, bits = Union(len(sets)), bits_for(sets)
    trees = []
    for s in (0, 1):
        own = np.flatnonzero(side == s)
        if len(own):
            t = SignatureTree([sets[i] for i in own], bits)
            trees.append((t, own[t.order]))
    if len(trees) == 1:
        dual_traversal(trees[0][0], trees[0][0], union, trees[0][1], trees[0][1], percent)
    elif trees:
        dual_traversal(trees[0][0], trees[1][0], union, trees[0][1], trees[1][1], percent)
    flat = union.flat()
    return [(int(nodes[i]), int(nodes[r])) for i, r in enumerate(flat.tolist()) if i != r]


# -- the join ---------------------------------------------------------------------------

def blocks_of(sets: DataFrame, percent: int) -> DataFrame:
    """node, block, ord, key: the classes that may link with another one, the smallest of their block, and one of their documents."""
    active = sets.where("prefix IS NOT NULL")
    tokens = active.select("node", F.explode("prefix").alias("token"))
    buckets = max(parts(sets.sparkSession), (active.agg(F.sum(F.size("prefix"))).first()[0] or 0) // TOKENS)
    shared = tokens.groupBy("token").agg(F.min("node").alias("v"), F.max("node").alias("w")).where("v < w").select("token")
    # Sketches follow only the shingles that two classes have.
    one_each = active.groupBy("node").agg(F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    rows = tokens.join(shared, "token").join(one_each, "node").select(F.pmod(F.xxhash64("token"), F.lit(buckets)).alias("task"), "token", "node", "n", "sketch")

    def pairs(t: pa.Table) -> pa.Table:
        counts = np.frombuffer(b"".join(t.column("sketch").to_pylist()), np.uint8).reshape(-1, PARTS)
        found = candidates(t.column("token").to_numpy(), t.column("node").to_numpy(), t.column("n").to_numpy(), counts, percent)
        trim()
        return pa.table({"u": pa.array(found[:, 0]), "v": pa.array(found[:, 1])})

    blocks = components(rows.groupBy("task").applyInArrow(pairs, "u long, v long")).withColumnRenamed("root", "block")
    document = active.groupBy("node").agg(F.min(F.struct("ord", "key")).alias("least")).select("node", "least.ord", "least.key")
    return blocks.join(document, "node")


def sets_of(docs: DataFrame, width: int, wanted: DataFrame) -> DataFrame:
    """ord, key, tokens: the sets of the documents ``wanted`` (ord, key), and of a few others that share a bit of a bitmap with one."""
    spark = docs.sparkSession
    h = wanted.select(F.xxhash64("ord", "key").alias("h")).toArrow().column("h").to_numpy().view(np.uint64)
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * len(h)).bit_length()))
    packed = np.zeros((1 << bits) // 8, np.uint8)
    slot = (h >> np.uint64(64 - bits)).astype(np.int64)
    np.bitwise_or.at(packed, slot >> 3, np.uint8(128) >> (slot & 7).astype(np.uint8))
    shared = spark.sparkContext.broadcast(packed)

    def run(batches):
        for batch in batches:
            own = np.flatnonzero(marked(shared.value, bits, batch.column("h").to_numpy().view(np.uint64)))
            for piece, raw in slices(batch.take(pa.array(own))):
                s, d = shingle_sets(raw, width)
                end = np.cumsum(np.bincount(d, minlength=len(raw))).tolist()
                tokens = pa.array([s[a:b].tobytes() for a, b in zip([0, *end], end)], pa.binary())
                yield pa.RecordBatch.from_arrays([piece.column("ord"), piece.column("key"), tokens], ["ord", "key", "tokens"])

    return docs.select("ord", "key", F.xxhash64("ord", "key").alias("h"), "text").mapInArrow(run, "ord long, key long, tokens binary")


def linked_sets(rows: DataFrame, percent: int) -> DataFrame:
    """u, v: links among the sets of each task (``task``, ``i``, ``j``), block by block."""
    def link(t: pa.Table) -> pa.Table:
        block = t.column("block").to_numpy()
        order = np.argsort(block, kind="stable")
        node, side, raw = t.column("node").to_numpy()[order], t.column("side").to_numpy()[order], t.column("tokens")
        found: list[tuple[int, int]] = []
        for _, a, b in cuts(block[order]):
            _, once = np.unique(node[a:b], return_index=True)  # rows that repeat one another came with one id
            sets = [np.frombuffer(raw[int(k)].as_py(), "<u8") for k in order[a:b][once]]
            found += block_links(node[a:b][once], side[a:b][once], sets, percent)
        trim()
        return pa.table({"u": pa.array([u for u, _ in found], pa.int64()), "v": pa.array([v for _, v in found], pa.int64())})

    return rows.groupBy("task", "i", "j").applyInArrow(link, "u long, v long")


def met(plan: DataFrame, others) -> DataFrame:
    """A row per task of each class of ``plan`` (node, block, ord, key, own: its part): with each part of the array ``others``."""
    out = plan.withColumn("other", F.explode(others))
    return out.select(F.col("block").alias("task"), F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "block", (F.col("own") > F.col("other")).cast("int").alias("side"), "node", "ord", "key")


def pieces_of(count: str):
    return F.ceil(F.col(count) / BLOCK).cast("int")


def up_to(n):
    """The numbers below ``n``, none for 0."""
    return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))


def first_tasks(blocks: DataFrame, buckets: int) -> DataFrame:
    """Where the classes go first: small blocks to a task, each part of a large one to its own task and to one with the first part."""
    counts = blocks.groupBy("block").agg(F.count("*").alias("members")).withColumn("pieces", pieces_of("members"))
    plan = blocks.join(counts, "block").withColumn("own", F.pmod(F.xxhash64("node"), F.col("pieces")).cast("int"))
    one = plan.where("pieces = 1").select(F.pmod(F.xxhash64("block"), F.lit(buckets)).alias("task"), F.lit(-1).alias("i"), F.lit(-1).alias("j"), "block", F.lit(0).alias("side"), "node", "ord", "key")
    return one.unionByName(met(plan.where("pieces > 1"), F.when(F.col("own") == 0, up_to(F.col("pieces"))).otherwise(F.array(F.lit(0), "own"))))


def second_tasks(blocks: DataFrame, roots: DataFrame) -> DataFrame:
    """Where the classes of large blocks go then: those outside the largest component (``roots``) of their block meet all of it."""
    large = blocks.groupBy("block").agg(F.count("*").alias("members")).where(F.col("members") > BLOCK).select("block")
    found = blocks.join(large, "block").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    most = found.groupBy("block", "root").agg(F.count("*").alias("n")).groupBy("block").agg(
        F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("members")).select(
        "block", F.col("most.root").alias("main"), F.col("most.n").alias("inside"), (F.col("members") - F.col("most.n")).alias("outside"))
    most = most.where("outside > 0").withColumn("rest", pieces_of("outside")).withColumn("pieces", pieces_of("inside"))
    h = F.xxhash64("node")
    plan = found.join(most, "block").withColumn("own", F.when(F.col("root") == F.col("main"), F.col("rest") + F.pmod(h, F.col("pieces"))).otherwise(F.pmod(h, F.col("rest"))).cast("int"))
    return met(plan, up_to(F.when(F.col("own") < F.col("rest"), F.col("rest") + F.col("pieces")).otherwise(F.col("rest"))))


def links(docs: DataFrame, sets: DataFrame, width: int, percent: int) -> DataFrame:
    """u, v: enough links between classes to connect each component."""
    blocks = written(blocks_of(sets, percent), "jaccard-blocks", free=True)
    # What to send where is settled before the sets themselves are moved: one row per class.
    moved = lambda tasks, own: linked_sets(sets_of(docs, width, own).join(tasks, ["ord", "key"]), percent)
    found = moved(first_tasks(blocks, max(parts(docs.sparkSession), blocks.count() // BLOCK)), blocks)
    if blocks.groupBy("block").count().where(F.col("count") > BLOCK).isEmpty():
        return found
    found = written(found, "jaccard-links", free=True)
    tasks = written(second_tasks(blocks, components(found)), "jaccard-tasks", free=True)
    return found if tasks.isEmpty() else found.unionByName(moved(tasks, tasks.select("ord", "key").distinct()))


def jaccard_components(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """ord, key, n_shingles and component (smallest ord) of every row of ``docs`` (ord, key, text); ``ord`` not null."""
    spark = docs.sparkSession
    ship(spark)
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 << (max(LEAST_SHARDS, size // SHARD_BYTES) - 1).bit_length()
    bits = max(min(MOST_BITS, max(LEAST_BITS, (size // 4).bit_length())), shards.bit_length() + 7)
    shared = spark.sparkContext.broadcast(bitmaps(shingle_counts(docs, width, shards), shards, bits))
    release(spark)
    sets = written(described(docs, width, percent, shared), "jaccard-sets")
    roots = components(links(docs, sets, width, percent))
    classes = sets.where("node IS NOT NULL").groupBy("node").agg(F.min("ord").alias("least"))
    classes = classes.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    best = classes.groupBy("root").agg(F.min("least").alias("component"))
    found = classes.select("node", "root").join(best, "root").select("node", "component")
    return sets.select("ord", "key", "n", "node").join(found, "node", "left").select(
        "ord", "key", F.col("n").alias("n_shingles"), F.coalesce("component", "ord").alias("component"))


def ord_of(docs: DataFrame):
    return F.coalesce(docs["doc_id"].cast("long"), F.lit(LAST_ID))


def key_of(docs: DataFrame):
    """Tells rows with equal ids apart: a hash of the text."""
    return F.xxhash64(F.coalesce(docs["text"], F.lit("")))


def jaccard_join(docs: DataFrame, width: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id of every row of ``docs`` (doc_id, text)."""
    out = jaccard_components(docs.select(ord_of(docs).alias("ord"), key_of(docs).alias("key"), "text"), width, percent)
    as_id = lambda c: F.when(F.col(c) != LAST_ID, F.col(c))
    return out.select(as_id("ord").alias("doc_id"), "n_shingles", as_id("component").alias("component_id"))


def one_of_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of their component.

    Repeated rows with that id are all kept, as are rows without id that link with none that has one.
    """
    out = jaccard_components(docs.select(ord_of(docs).alias("ord"), key_of(docs).alias("key"), "text"), width, percent)
    drop = written(out.where("component < ord").select(F.col("ord").alias("drop_ord"), F.col("key").alias("drop_key")).distinct(), "jaccard-dropped")
    return docs.join(drop, (ord_of(docs) == drop["drop_ord"]) & (key_of(docs) == drop["drop_key"]), "left_anti")
