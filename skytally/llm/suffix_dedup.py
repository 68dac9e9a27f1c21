"""Removal of repeated byte strings by a sampled suffix array with deep-shallow sorting.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts in a
document with a smaller id.  Instead of all suffixes, every position is filed under
its *anchor*: the smallest-hashed ``GRAM``-byte string that begins in its
``LENGTH`` bytes (the leftmost of equals).  Equal strings have equal anchors, so
all occurrences of a string meet at one anchor.

1. Spark counts the anchors over all documents (packed arrays per hash shard,
   added up per task first) and sets one bit per anchor that two documents
   share.  The bitmap grows with the input up to ``2**MOST_BITS`` bits; it is a
   filter only, so a crowded one lets more through and changes no result.
2. Tasks read the documents again and file each shared anchor's *context* (its
   positions' bytes) under the anchor's shard.
3. Each shard sorts the suffixes of its contexts.  Equal contexts are
   taken together first.  Where an anchor has several, their suffixes are
   sorted by multikey quicksort over eight-byte characters to ``SHALLOW`` bytes;
   groups that still tie are ordered by blind tries to ``LENGTH`` bytes.  Suffixes with
   a common prefix of ``LENGTH`` bytes form a class; its smallest document id decides.
4. The found spans return to their documents, where they are united.

Hot keys.  Texts with more than ``HOT_TEXT`` exact copies are known by a bounded
list (at most 2**20 of them) and go as a whole, apart from the first.  Anchors at
more than ``HOT_ANCHOR`` places (or 2**-22 of all anchors, a bounded list), and those at more than
``HOT_PLACES`` that come ``PERIODIC`` times or more in each document that has them, as in runs of one
byte, are not gathered at all: Spark finds the smallest document of each of their strings by its
hash.  A document gives each string once with its places, as (first, step, number), so a run of any
length is a few numbers.

Edge cases: null or empty text has nothing to remove; null ids come after all
others and are not smaller than one another; rows with equal ids do not affect
each other; repeated rows come out as often as they occur, with equal results;
an empty table gives no rows; other columns are ignored.  A removal can split
a UTF-8 sequence: lengths and hashes are of bytes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import buffer_of, hash_spans, prefix_sums, ship, slices, to_bytes, trim, written

LENGTH = 50
GRAM = 20
SHALLOW = 24
SHARD_BYTES = 2 << 20
LEAST_SHARDS = 64
LEAST_BITS, MOST_BITS = 16, 30
HOT_TEXT, HOT_ANCHOR = 1000, 100_000
HOT_PLACES, PERIODIC = 10_000, 4
FLUSH = 1 << 20
SLICE = 1 << 19
PIECE_BYTES = 1 << 20
EMIT_BYTES = 4 << 20
EMIT_PLACES = 1 << 18
LAST_ID = (1 << 63) - 1


# -- anchors --------------------------------------------------------------------------

def sliding_min(v: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` consecutive values."""
    n = len(v) - width + 1
    pad = -len(v) % width
    block = np.concatenate([v, np.full(pad, v.dtype.type(-1) if v.dtype.kind == "i" else np.iinfo(v.dtype).max)]).reshape(-1, width)
    ahead = np.minimum.accumulate(block, axis=1).ravel()
    back = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], ahead[width - 1:width - 1 + n])


def anchors(raw: pa.Array, length: int = LENGTH, gram: int = GRAM):
    """Bytes, offsets and, per run of positions with one anchor: first, last, anchor, its hash and text."""
    buf, offs = buffer_of(raw)
    z = np.zeros(0, np.int64)
    if len(buf) < length:
        return buf, offs, z, z, z, z.astype(np.uint64), z
    sums = prefix_sums(buf)
    s = np.arange(len(buf) - gram + 1)
    h = hash_spans(sums, s, s + gram)
    v = (h & np.uint64(0xFFFFFFFF00000000)) | s.astype(np.uint64)
    at = (sliding_min(v, length - gram + 1) & np.uint64(0xFFFFFFFF)).astype(np.int64)  # anchor of each position
    doc = np.repeat(np.arange(len(offs) - 1), np.diff(offs))[:len(at)]
    own = np.flatnonzero(np.arange(len(at)) + length <= offs[doc + 1])  # strings that end inside their text
    if not len(own):
        return buf, offs, z, z, z, z.astype(np.uint64), z
    a, d = at[own], doc[own]
    new = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (d[1:] != d[:-1])))
    first, last = own[new], own[np.append(new[1:], len(own)) - 1]
    return buf, offs, first, last, a[new], h[a[new]], d[new]


def shard_of(h: np.ndarray, shards: int) -> np.ndarray:
    return (h >> np.uint64(65 - shards.bit_length())).astype(np.int64)


def cuts(shard: np.ndarray):
    at = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else np.zeros(0, np.int64)
    return zip(shard[at].tolist(), at.tolist(), [*at[1:].tolist(), len(shard)])


def added_up(h: np.ndarray, *counts: np.ndarray) -> tuple[np.ndarray, ...]:
    """Distinct hashes in order, and the sums of each of ``counts`` for them."""
    order = np.argsort(h)
    h = h[order]
    at = np.flatnonzero(np.append(True, h[1:] != h[:-1])) if len(h) else np.zeros(0, np.int64)
    return h[at], *(np.add.reduceat(n[order], at) if len(at) else n for n in counts)


def bounded(weight: np.ndarray, limit: int):
    """(start, end) of consecutive pieces with a weight of about ``limit`` at most."""
    after = np.cumsum(weight)
    at = 0
    while at < len(weight):
        to = max(at + 1, int(np.searchsorted(after, (after[at - 1] if at else 0) + limit, "right")))
        yield at, to
        at = to


def anchor_counts(docs: DataFrame, shards: int) -> DataFrame:
    """Packed rows: shard, hashes, the number of documents of each and of places beyond one a document, as far as a task knows."""
    def run(batches):
        held, size = [], 0

        def emit():
            h, n, more = added_up(*(np.concatenate(c) for c in zip(*held)))
            rows = [*cuts(shard_of(h, shards))]
            return pa.RecordBatch.from_arrays([pa.array([s for s, _, _ in rows], pa.int64()), pa.array([h[a:b].tobytes() for _, a, b in rows], pa.binary()),
                                               *(pa.array([x[a:b].astype("<u4").tobytes() for _, a, b in rows], pa.binary()) for x in (n, more))], ["shard", "h", "n", "more"])

        for batch in batches:
            for _, raw in slices(batch, limit=SLICE):
                _, _, _, _, _, h, d = anchors(raw)
                order = np.lexsort((d, h))
                h, d = h[order], d[order]
                once = np.append(True, (h[1:] != h[:-1]) | (d[1:] != d[:-1])) if len(h) else np.zeros(0, bool)
                h, n, more = added_up(h, once.astype(np.int64), (~once).astype(np.int64))
                held.append((h, n, more))
                size += len(h)
                if size > FLUSH:
                    yield emit()
                    held, size = [], 0
        if held:
            yield emit()
        del held
        trim()

    return docs.select("text").mapInArrow(run, "shard long, h binary, n binary, more binary")


def shared_anchors(counts: DataFrame, shards: int, bits: int, hot: int):
    """(bitmap of the anchors in two documents or more, hot anchors: those of them at too many places)."""
    step = bits - shards.bit_length() + 1  # a shard's part of the slots is 2**step

    def merge(t: pa.Table) -> pa.Table:
        cat = lambda c, kind: np.frombuffer(buffer_of(to_bytes(t.column(c)))[0], kind)
        h, n, more = added_up(cat("h", "<u8"), cat("n", "<u4").astype(np.int64), cat("more", "<u4").astype(np.int64))
        places = n + more
        many = (n > 1) & ((places > hot) | (places > max(HOT_PLACES, hot // 10)) & (places >= PERIODIC * n))
        flags = np.zeros(1 << step, bool)
        flags[((h[n > 1] >> np.uint64(64 - bits)) & np.uint64((1 << step) - 1)).astype(np.int64)] = True
        return pa.table({"shard": t.column("shard").slice(0, 1), "bits": pa.array([np.packbits(flags).tobytes()], pa.binary()),
                         "hot": pa.array([h[many].view(np.int64).tolist()], pa.list_(pa.int64()))})

    rows = written(counts.groupBy("shard").applyInArrow(merge, "shard long, bits binary, hot array<long>"), "suffix-anchors", free=True)
    packed = np.zeros((1 << bits) // 8, np.uint8)
    part = (1 << step) // 8
    for r in rows.select("shard", "bits").toLocalIterator():
        packed[r.shard * part:(r.shard + 1) * part] = np.frombuffer(r.bits, np.uint8)
    hot_ones = [r.x for r in rows.select(F.explode("hot").alias("x")).collect()]
    return packed, np.sort(np.array(hot_ones, np.int64).view(np.uint64))


def marked(packed: np.ndarray, bits: int, h: np.ndarray) -> np.ndarray:
    slot = (h >> np.uint64(64 - bits)).astype(np.int64)
    return (packed[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


# -- contexts and their suffixes ---------------------------------------------------------

CONTEXTS = "shard long, h binary, size binary, text binary, doc binary, pos binary, ids binary, keys binary"


def gathered(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of all spans, one after another."""
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    return buf[np.arange(total) + np.repeat(start - (ends - size), size)]


def packed_contexts(buf, offs, ids, keys, h, first, size, d, shards: int) -> pa.RecordBatch:
    """A row per shard: contexts in the order of their anchors' hashes."""
    out: dict[str, list] = {k: [] for k in ("shard", "h", "size", "text", "doc", "pos", "ids", "keys")}
    for s, a, b in cuts(shard_of(h, shards)):
        some, number = np.unique(d[a:b], return_inverse=True)
        for name, x in (("shard", s), ("h", h[a:b].tobytes()), ("size", size[a:b].astype(np.uint8).tobytes()), ("text", gathered(buf, first[a:b], size[a:b]).tobytes()),
                        ("doc", number.astype("<u4").tobytes()), ("pos", (first[a:b] - offs[d[a:b]]).astype("<u4").tobytes()), ("ids", ids[some].tobytes()), ("keys", keys[some].tobytes())):
            out[name].append(x)
    return pa.RecordBatch.from_arrays([pa.array(v, pa.int64() if k == "shard" else pa.binary()) for k, v in out.items()], list(out))


def contexts(docs: DataFrame, shards: int, bits: int, shared) -> DataFrame:
    """Packed rows per shard: the contexts of the shared anchors, with document and position."""
    def run(batches):
        packed, hot = shared.value
        for batch in batches:
            for piece, raw in slices(batch, limit=SLICE):
                buf, offs, first, last, _, h, d = anchors(raw)
                use = np.flatnonzero(marked(packed, bits, h) & ~np.isin(h, hot))
                if not len(use):
                    continue
                use = use[np.argsort(h[use], kind="stable")]
                ids, keys = piece.column("ord").to_numpy(), piece.column("key").to_numpy()
                h, first, d = h[use], first[use], d[use]
                size = last[use] - first + LENGTH
                for at, to in bounded(size, EMIT_BYTES):
                    yield packed_contexts(buf, offs, ids, keys, h[at:to], first[at:to], size[at:to], d[at:to], shards)

    return docs.select("ord", "key", "text").mapInArrow(run, CONTEXTS)


class BlindTrie:
    """Compacted trie that stores only branching depths; strings are compared once, at the leaf reached blindly."""

    def __init__(self):
        self.root = None

    def insert(self, s: bytes, member: int) -> None:
        if self.root is None:
            self.root = (s, [member])
            return
        node = self.root
        while isinstance(node, dict):  # an inner node: branching byte -> child, and its depth under -1
            node = node.get(s[node[-1]]) or next(v for k, v in node.items() if k >= 0)
        other, members = node
        if other == s:
            members.append(member)
            return
        differ = int.from_bytes(s, "big") ^ int.from_bytes(other, "big")
        depth = len(s) - (differ.bit_length() + 7) // 8
        parent, node = None, self.root
        while isinstance(node, dict) and node[-1] < depth:
            parent, node = node, node[s[node[-1]]]
        if isinstance(node, dict) and node[-1] == depth:
            node[s[depth]] = (s, [member])
            return
        inner = {-1: depth, s[depth]: (s, [member]), other[depth]: node}
        if parent is None:
            self.root = inner
        else:
            parent[s[parent[-1]]] = inner

    def leaves(self):
        """Groups of equal strings, in order."""
        stack = [self.root] if self.root is not None else []
        while stack:
            node = stack.pop()
            if isinstance(node, dict):
                stack += [node[k] for k in sorted((k for k in node if k >= 0), reverse=True)]
            else:
                yield node[1]


def characters(buf: np.ndarray, start: np.ndarray, depth: int) -> np.ndarray:
    """The eight bytes at ``depth`` of each suffix, as one ordered number."""
    return buf[start[:, None] + np.arange(depth, depth + 8)].view(">u8").ravel().astype(np.uint64)


def deep_shallow(buf: np.ndarray, start: np.ndarray, length: int = LENGTH, shallow: int = SHALLOW) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes sorted by their first ``length`` bytes: (order, class of each place in the order).

    Suffixes of one class are equal over ``length`` bytes.  All of ``buf[start:start + length]`` must exist.
    """
    n = len(start)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    buf = np.concatenate([buf, np.zeros(8, np.uint8)])
    order = np.arange(n)
    border = np.zeros(n, bool)  # places where a group begins
    border[0] = True
    for depth in range(0, shallow, 8):
        group = np.cumsum(border)
        tied = np.flatnonzero(~(border & np.append(border[1:], True)))
        if not len(tied):
            break
        c = characters(buf, start[order[tied]], depth)
        by = np.lexsort((c, group[tied])) if depth else np.argsort(c, kind="quicksort")
        order[tied] = order[tied][by]
        c, g = c[by], group[tied]
        border[tied[1:]] |= (c[1:] != c[:-1]) & (g[1:] == g[:-1])
    first = np.flatnonzero(border)
    size = np.diff(np.append(first, n))
    many = np.flatnonzero(size > 1)
    if len(many) and length > shallow:
        at = np.repeat(first[many], size[many])
        inside = np.arange(len(at)) - np.repeat(np.cumsum(size[many]) - size[many], size[many]) + at
        same = np.ones(len(at), bool)
        for depth in [*range(shallow, length - 8, 8), length - 8]:
            same &= characters(buf, start[order[inside]], depth) == characters(buf, start[order[at]], depth)
        begin = np.cumsum(size[many]) - size[many]
        mixed = many[~np.logical_and.reduceat(same, begin)]
        for a, k in zip(first[mixed].tolist(), size[mixed].tolist()):
            trie = BlindTrie()
            for i in order[a:a + k].tolist():
                trie.insert(buf[start[i] + shallow:start[i] + length].tobytes(), i)
            put = a
            for members in trie.leaves():
                order[put:put + len(members)] = members
                border[put] = True
                put += len(members)
    return order, np.cumsum(border) - 1


SPANS = "doc_id long, key long, spans binary"


def spans_of(t: pa.Table) -> pa.Table:
    """One shard: the spans of each document whose strings also start in a smaller one.

    Anchors do not affect each other, so they are worked off in pieces of about ``PIECE_BYTES`` of contexts.
    """
    cat = lambda c, kind: np.frombuffer(buffer_of(to_bytes(t.column(c)))[0], kind)
    counts = lambda c, width: np.diff(buffer_of(to_bytes(t.column(c)))[1]) // width
    h, size, buf, pos = cat("h", "<u8"), cat("size", np.uint8).astype(np.int64), cat("text", np.uint8), cat("pos", "<u4").astype(np.int64)
    ids, keys = cat("ids", "<i8"), cat("keys", "<i8")
    per, known = counts("doc", 4), counts("ids", 8)
    doc = cat("doc", "<u4").astype(np.int64) + np.repeat(np.cumsum(known) - known, per)
    begin = np.cumsum(size) - size
    order = np.argsort(h, kind="stable")
    h = h[order]
    after = np.cumsum(size[order])
    groups = np.append(np.flatnonzero(np.append(True, h[1:] != h[:-1])), len(h)) if len(h) else np.zeros(1, np.int64)
    found, at = [], 0
    while at < len(h):
        reach = int(np.searchsorted(after, (after[at - 1] if at else 0) + PIECE_BYTES, "right"))
        to = int(groups[max(np.searchsorted(groups, reach, "right") - 1, np.searchsorted(groups, at, "right"))])
        some = order[at:to]
        d, a, b = piece_spans(h[at:to], size[some], gathered(buf, begin[some], size[some]), ids[doc[some]], pos[some])
        found.append((doc[some[d]], a, b))
        at = to
    d, a, b = (np.concatenate(c) for c in zip(*found)) if found else (doc, pos, pos)
    out = packed_spans(ids[d], keys[d], a, b)
    del found, order, after, h, size, buf, pos
    trim()
    return out


def piece_spans(h: np.ndarray, size: np.ndarray, buf: np.ndarray, own: np.ndarray, pos: np.ndarray):
    """Contexts of some anchors (hash, length, bytes, document id, position): (context, start, end) of the strings that a smaller document holds."""
    begin = np.cumsum(size) - size
    # equal contexts, and the smallest id of each
    _, first, ctx = np.unique(hash_spans(prefix_sums(buf), begin, begin + size), return_index=True, return_inverse=True)
    least = np.full(len(first), LAST_ID)
    np.minimum.at(least, ctx, own)
    # anchors with several contexts: sort the suffixes of those
    _, which, several = np.unique(h[first], return_inverse=True, return_counts=True)
    multi = np.flatnonzero(several[which] > 1)
    length = size[first] - LENGTH + 1
    owner = np.repeat(multi, length[multi])
    base = np.zeros(len(first), np.int64)
    base[multi] = np.cumsum(length[multi]) - length[multi]
    start = begin[first][owner] + np.arange(len(owner)) - base[owner]
    order, group = deep_shallow(buf, start)
    low = np.full(int(group[-1]) + 1 if len(group) else 0, LAST_ID)
    np.minimum.at(low, group, least[owner[order]])
    least_at = np.empty(len(owner), np.int64)
    least_at[order] = low[group]
    small, large = least.copy(), least.copy()
    if len(multi):
        small[multi] = np.minimum.reduceat(least_at, base[multi])
        large[multi] = np.maximum.reduceat(least_at, base[multi])
    whole = np.flatnonzero(large[ctx] < own)
    part = np.flatnonzero((large[ctx] >= own) & (small[ctx] < own))
    d, a, b = whole, pos[whole], pos[whole] + size[whole]
    if len(part):
        n = length[ctx[part]]
        o = np.repeat(part, n)
        k = np.arange(len(o)) - np.repeat(np.cumsum(n) - n, n)
        gone = least_at[base[ctx[o]] + k] < own[o]
        o, k = o[gone], k[gone]
        new = np.flatnonzero(np.append(True, (o[1:] != o[:-1]) | (k[1:] != k[:-1] + 1))) if len(o) else np.zeros(0, np.int64)
        end = np.append(new[1:], len(o)) - 1 if len(o) else new
        d, a, b = np.concatenate([d, o[new]]), np.concatenate([a, pos[o[new]] + k[new]]), np.concatenate([b, pos[o[end]] + k[end] + LENGTH])
    return d, a, b


def packed_spans(ids: np.ndarray, keys: np.ndarray, a: np.ndarray, b: np.ndarray) -> pa.Table:
    order = np.lexsort((a, keys, ids))
    ids, keys, pair = ids[order], keys[order], np.stack([a, b], 1)[order].astype("<u4")
    new = np.flatnonzero(np.append(True, (ids[1:] != ids[:-1]) | (keys[1:] != keys[:-1]))) if len(ids) else np.zeros(0, np.int64)
    end = np.append(new[1:], len(ids)) if len(ids) else new
    return pa.table({"doc_id": pa.array(ids[new], pa.int64()), "key": pa.array(keys[new], pa.int64()),
                     "spans": pa.array([pair[x:y].tobytes() for x, y in zip(new, end)], pa.binary())})


def placed(doc: np.ndarray, s: np.ndarray, at: np.ndarray):
    """(document, string, places) of each string of each document; places are packed (first, step, number) of evenly spaced ones."""
    order = np.lexsort((at, s, doc))
    doc, s, at = doc[order], s[order], at[order]
    new = np.append(True, (doc[1:] != doc[:-1]) | (s[1:] != s[:-1]))
    gap = np.append(0, at[1:] - at[:-1])
    turn = new.copy()
    turn[2:] |= ~new[1:-1] & (gap[2:] != gap[1:-1])
    first = np.flatnonzero(turn)
    number = np.diff(np.append(first, len(at)))
    step = np.where(number > 1, gap[np.minimum(first + 1, len(at) - 1)], 1)
    head = np.flatnonzero(new)
    ends = np.append(np.searchsorted(first, head), len(first)).astype("<i4") * 12
    data = np.stack([at[first], step, number], 1).astype("<u4")
    return doc[head], s[head], pa.Array.from_buffers(pa.binary(), len(head), [None, pa.py_buffer(ends.astype("<i4").tobytes()), pa.py_buffer(data.tobytes())])


def covered(places: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, start, end) of the bytes that the strings at packed places cover; close ones are one span."""
    buf, ends = buffer_of(to_bytes(places))
    first, step, number = buf.view("<u4").reshape(-1, 3).astype(np.int64).T
    row = np.repeat(np.arange(len(places)), np.diff(ends) // 12)
    times = np.where(step <= LENGTH, 1, number)
    o = np.repeat(np.arange(len(row)), times)
    start = first[o] + step[o] * (np.arange(len(o)) - np.repeat(np.cumsum(times) - times, times))
    return row[o], start, start + LENGTH + np.where(times == 1, step * (number - 1), 0)[o]


def hot_strings(docs: DataFrame, shared) -> DataFrame:
    """The strings of the hot anchors by their hash, once for each document and piece of it, with their places."""
    def run(batches):
        _, hot = shared.value
        for batch in batches:
            for piece, raw in slices(batch, limit=SLICE):
                buf, offs, first, last, _, h, d = anchors(raw)
                use = np.flatnonzero(np.isin(h, hot))
                if not len(use):
                    continue
                first, d, n = first[use], d[use], last[use] - first[use] + 1
                sums = prefix_sums(buf)
                ids, keys = piece.column("ord").to_numpy(), piece.column("key").to_numpy()
                for a, b in bounded(n, EMIT_PLACES):
                    o = np.repeat(np.arange(a, b), n[a:b])
                    at = first[o] + np.arange(len(o)) - np.repeat(np.cumsum(n[a:b]) - n[a:b], n[a:b])
                    doc, s, places = placed(d[o], hash_spans(sums, at, at + LENGTH), at - offs[d[o]])
                    yield pa.RecordBatch.from_arrays([pa.array(ids[doc]), pa.array(keys[doc]), pa.array(s.view(np.int64)), places], ["doc_id", "key", "s", "places"])

    return docs.select("ord", "key", "text").mapInArrow(run, "doc_id long, key long, s long, places binary")


def hot_spans(docs: DataFrame, shared) -> DataFrame:
    """The same for the hot anchors: Spark finds the smallest id of every string, by its hash."""
    def pack(batches):
        for batch in batches:
            row, a, b = covered(batch.column("places"))
            t = packed_spans(batch.column("doc_id").to_numpy()[row], batch.column("key").to_numpy()[row], a, b)
            yield from t.to_batches()

    rows = written(hot_strings(docs, shared), "suffix-hot-strings", free=True)
    least = rows.groupBy("s").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "s").where("least < doc_id").select("doc_id", "key", "places").mapInArrow(pack, SPANS)


# -- the whole -----------------------------------------------------------------------------

def tagged(docs: DataFrame) -> DataFrame:
    """``docs`` with ord (the id, null last), key (hash of the text) and gone (a hot text's copy of a smaller id)."""
    order = F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST_ID))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    rows = docs.select("*", order.alias("ord"), F.xxhash64(text).alias("key"))
    total = docs.count()
    digest = F.sha2(text, 256)
    hot = (docs.select(order.alias("ord"), digest.alias("digest")).groupBy("digest").agg(F.count("*").alias("n"), F.min("ord").alias("first_id"))
           .where(F.col("n") > max(HOT_TEXT, total >> 20)).select("digest", "first_id"))
    gone = (F.col("ord") > F.col("first_id")) & (F.octet_length("text") >= LENGTH)
    return rows.withColumn("digest", digest).join(F.broadcast(written(hot, "suffix-hot-texts", free=True)), "digest", "left").withColumn("gone", F.coalesce(gone, F.lit(False))).drop("digest", "first_id")


def repeated_spans(docs: DataFrame) -> DataFrame:
    """doc_id (ord), key and the packed (start, end) spans to remove, for tagged documents that are not gone."""
    spark = docs.sparkSession
    live = docs.where(~F.col("gone"))
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 << (max(LEAST_SHARDS, size // SHARD_BYTES) - 1).bit_length()
    bits = min(MOST_BITS, max(LEAST_BITS, (size // 4).bit_length()))
    bits = max(bits, shards.bit_length() + 2)
    packed, hot = shared_anchors(anchor_counts(live, shards), shards, bits, max(HOT_ANCHOR, size >> 26))
    shared = spark.sparkContext.broadcast((packed, hot))
    found = contexts(live, shards, bits, shared).groupBy("shard").applyInArrow(spans_of, SPANS)
    if len(hot):
        found = found.unionByName(hot_spans(live, shared))
    return written(found, "suffix-spans", free=True)


def kept_parts(raw: bytes, spans: list[bytes], gone: bool) -> tuple[list[bytes], int, int]:
    """The remaining pieces of a text, the bytes removed and the number of maximal removed runs."""
    if gone:
        return [], len(raw), 1
    if not spans:
        return [raw], 0, 0
    pair = np.frombuffer(b"".join(spans), "<u4").reshape(-1, 2).astype(np.int64)
    pair = pair[np.argsort(pair[:, 0], kind="stable")]
    reach = np.maximum.accumulate(pair[:, 1])
    new = np.flatnonzero(np.append(True, pair[1:, 0] > reach[:-1]))
    start, end = pair[new, 0], reach[np.append(new[1:], len(pair)) - 1]
    edges = [0, *np.stack([start, end], 1).ravel().tolist(), len(raw)]
    return [raw[a:b] for a, b in zip(edges[0::2], edges[1::2])], int((end - start).sum()), len(start)


def with_spans(docs: DataFrame) -> DataFrame:
    """All columns of ``docs`` with gone and the list of packed spans of each row."""
    t = tagged(docs)
    spans = repeated_spans(t).groupBy("doc_id", "key").agg(F.collect_list("spans").alias("spans"))
    spans = spans.select(F.col("doc_id").alias("ord"), "key", "spans")
    return t.join(spans, ["ord", "key"], "left").drop("ord", "key")


def suffix_dedup(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            out = [[], [], [], []]
            for raw, spans, gone in zip(to_bytes(batch.column("text")).to_pylist(), batch.column("spans").to_pylist(), batch.column("gone").to_pylist()):
                parts, removed, runs = kept_parts(raw, spans or [], gone)
                for o, x in zip(out, (len(raw), removed, runs, hashlib.sha256(b"".join(parts)).hexdigest())):
                    o.append(x)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(o, pa.int64()) for o in out[:3]), pa.array(out[3], pa.string())],
                                             ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return with_spans(docs.select("doc_id", "text")).select("doc_id", "text", "gone", "spans").mapInArrow(
        run, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def deduplicated(docs: DataFrame) -> DataFrame:
    """All columns of ``docs``, the text without its repeated strings (split UTF-8 sequences at the cuts are dropped)."""
    ship(docs.sparkSession)
    names = docs.columns
    inner = [c if c in ("doc_id", "text") else f"c{i}" for i, c in enumerate(names)]  # theirs may clash with ours

    def run(batches):
        for batch in batches:
            old = batch.column("text")
            texts = []
            for raw, valid, spans, gone in zip(to_bytes(old).to_pylist(), old.is_valid().to_pylist(), batch.column("spans").to_pylist(), batch.column("gone").to_pylist()):
                texts.append(b"".join(kept_parts(raw, spans or [], gone)[0]).decode("utf-8", "ignore") if valid else None)
            new = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays([new if c == "text" else batch.column(c) for c in inner], names)

    own = with_spans(docs.select([F.col(f"`{c}`").alias(i) for c, i in zip(names, inner)]))
    return own.select(*inner, "gone", "spans").mapInArrow(run, docs.schema)
