"""Benchmark decontamination by a prefix-filtered set join.

An item's *windows* are its runs of ``length`` words (a shorter item is one
window).  A window is the set of its shingles of three words (of fewer words for a
shorter window).  A text can only contain a window if it holds all of its
shingles, so one *necessary prefix token* is enough to find every candidate: the
window's rarest shingle, by its count over all documents.

1. Count the benchmark's shingles over all documents.  Tasks look only at
   shingles whose slot is set in a bitmap of the benchmark's shingles
   (``MOST_BITS`` bits at most, a fixed bound, whatever the benchmark's size).
2. Order each window's shingles by count; join the documents' occurrences of the
   rarest ones (again behind a bitmap) with the windows on that shingle.
3. Keep candidates within the bounds of position and length (the window must
   begin at or after the text's first word and end at or before its last), and compare the words
   themselves.

Edge cases: null or empty text has no words and no hits; null item ids count
as the empty string; items without words have no windows; equal items and
windows are joined once and count for every item; repeated rows come out as
often as they occur; with an empty benchmark nothing is hit; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import LOWER, buffer_of, combine, hash_spans, prefix_sums, ship, slices, word_spans, written

WINDOW = 10
SHINGLE = 3
LEAST_BITS, MOST_BITS = 16, 27
PIECE_BITS = 16  # bits of a bitmap that are handed over in one row
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


def words_of(raw: pa.Array):
    """Lower-cased bytes, offsets, and start, end, text and hash of each word."""
    buf, offs = buffer_of(raw)
    buf = LOWER[buf]
    start, end, doc = word_spans(buf, offs, IN_WORD)
    return buf, offs, start, end, doc, hash_spans(prefix_sums(buf), start, end)


def shingles(h: np.ndarray, width: int) -> np.ndarray:
    """Hash of the ``width`` words from each word on (the last ones are missing)."""
    out = combine(h[:len(h) - width + 1], np.uint64(width)) if len(h) >= width else h[:0]
    for k in range(1, width):
        out = combine(out, h[k:len(h) - width + 1 + k])
    return out


def windows(benchmark: DataFrame, length: int, width: int) -> DataFrame:
    """item, win (its words, space-joined), n (their number), tokens (shingle hashes in order)."""
    def run(batches):
        for batch in batches:
            for piece, raw in slices(batch):
                buf, offs, start, end, doc, h = words_of(raw)
                items, wins, ns, tokens = [], [], [], []
                bounds = np.searchsorted(doc, np.arange(len(offs)))
                for item, a, b in zip(piece.column("item").to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                    n = min(length, b - a)
                    for k in range(a, b - n + 1 if n else a):
                        items.append(item)
                        wins.append(b" ".join(buf[start[i]:end[i]].tobytes() for i in range(k, k + n)).decode("utf-8", "replace"))
                        ns.append(n)
                        tokens.append(shingles(h[k:k + n], min(width, n)).view(np.int64).tolist())
                yield pa.RecordBatch.from_arrays([pa.array(items, pa.string()), pa.array(wins, pa.string()), pa.array(ns, pa.int32()), pa.array(tokens, pa.list_(pa.int64()))],
                                                 ["item", "win", "n", "tokens"])

    return benchmark.select(F.coalesce(F.col("item_id").cast("string"), F.lit("")).alias("item"), "text").mapInArrow(run, "item string, win string, n int, tokens array<long>")


def bitmap(tokens: DataFrame) -> tuple[np.ndarray, int]:
    """Bits of the top hash bits of a column of hashes, and how many hash bits they are.

    Pieces are combined by Spark; at most ``2**MOST_BITS`` bits reach the driver.
    """
    bits = min(MOST_BITS, max(LEAST_BITS, (64 * max(1, tokens.count())).bit_length()))

    def fill(batches):
        have: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = batch.column(0).to_numpy().view(np.uint64) >> np.uint64(64 - bits)
            piece = (slot >> np.uint64(PIECE_BITS)).astype(np.int64)
            for p in np.unique(piece).tolist():
                flags = have.setdefault(p, np.zeros(1 << PIECE_BITS, bool))
                flags[(slot[piece == p] & np.uint64((1 << PIECE_BITS) - 1)).astype(np.int64)] = True
        yield pa.RecordBatch.from_arrays([pa.array(list(have), pa.int64()), pa.array([np.packbits(v).tobytes() for v in have.values()], pa.binary())], ["piece", "bits"])

    def either(t: pa.Table) -> pa.Table:
        out = np.zeros((1 << PIECE_BITS) // 8, np.uint8)
        for b in t.column("bits").to_pylist():
            out |= np.frombuffer(b, np.uint8)
        return pa.table({"piece": t.column("piece").slice(0, 1), "bits": pa.array([out.tobytes()], pa.binary())})

    flags = np.zeros(1 << bits, bool)
    for r in tokens.mapInArrow(fill, "piece long, bits binary").groupBy("piece").applyInArrow(either, "piece long, bits binary").collect():
        flags[r.piece << PIECE_BITS:(r.piece + 1) << PIECE_BITS] = np.unpackbits(np.frombuffer(r.bits, np.uint8)).astype(bool)[:len(flags)]
    return np.packbits(flags), bits


def marked(shared, h: np.ndarray) -> np.ndarray:
    packed, bits = shared
    slot = (h >> np.uint64(64 - bits)).astype(np.int64)
    return (packed[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1


def hits_of(h: np.ndarray, doc: np.ndarray, widths: list[int], shared):
    """Hash, first word and width of the shingles of one text whose bit is set."""
    for width in widths:
        s = shingles(h, width)
        at = np.flatnonzero(marked(shared, s) & (doc[:len(s)] == doc[width - 1:])) if len(s) else []
        if len(at):
            yield s[at], at, width


def counted(docs: DataFrame, widths: list[int], bits) -> DataFrame:
    """token, seen: how often the marked shingles occur in all documents."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        held = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for _, raw in slices(batch):
                _, _, _, _, doc, h = words_of(raw)
                found = [s for s, _, _ in hits_of(h, doc, widths, shared.value)]
                if found:
                    t, n = np.unique(np.concatenate(found), return_counts=True)
                    t, inv = np.unique(np.concatenate([held[0], t]), return_inverse=True)
                    held = t, np.bincount(inv, np.concatenate([held[1], n])).astype(np.int64)
                    if len(t) > 1 << 20:
                        yield pa.RecordBatch.from_arrays([pa.array(t.view(np.int64)), pa.array(held[1])], ["token", "n"])
                        held = t[:0], n[:0]
        yield pa.RecordBatch.from_arrays([pa.array(held[0].view(np.int64)), pa.array(held[1])], ["token", "n"])

    return docs.select("text").mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("seen"))


HITS = "array<struct<token: bigint, at: int, before: int, words: array<string>>>"
HIT_TYPE = pa.list_(pa.struct([("token", pa.int64()), ("at", pa.int32()), ("before", pa.int32()), ("words", pa.list_(pa.string()))]))


def occurrences(docs: DataFrame, widths: list[int], bits, length: int) -> DataFrame:
    """doc_id, key (hash of the text), n_words and the marked shingles of every row, each with the words around it."""
    shared = docs.sparkSession.sparkContext.broadcast(bits)

    def run(batches):
        for batch in batches:
            for piece, raw in slices(batch):
                buf, offs, start, end, doc, h = words_of(raw)
                n = len(offs) - 1
                first = np.searchsorted(doc, np.arange(n + 1))
                found: list[list[dict]] = [[] for _ in range(n)]
                for s, at, width in hits_of(h, doc, widths, shared.value):
                    for token, i in zip(s.view(np.int64).tolist(), at.tolist()):
                        d = int(doc[i])
                        a, b = max(int(first[d]), i - (length - width)), min(int(first[d + 1]), i + length)
                        found[d].append({"token": token, "at": i - int(first[d]), "before": i - a,
                                         "words": [buf[start[k]:end[k]].tobytes().decode("utf-8", "replace") for k in range(a, b)]})
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("key"), pa.array(np.bincount(doc, minlength=n), pa.int64()), pa.array(found, HIT_TYPE)],
                                                 ["doc_id", "key", "n_words", "hits"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("key"), "text").mapInArrow(run, f"doc_id {kind}, key long, n_words long, hits {HITS}")


def contamination(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW, width: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(rows, matches): doc_id, key, n_words of every document; and doc_id, key, first, end (words) and item of every occurrence of a window."""
    spark = docs.sparkSession
    ship(spark)
    wins = written(windows(benchmark, length, width), "decontamination-windows")
    tokens = wins.select(F.explode("tokens").alias("token"))
    widths = [r.w for r in wins.select(F.least("n", F.lit(width)).alias("w")).distinct().orderBy("w").collect()]
    seen = counted(docs, widths, bitmap(tokens))
    distinct = wins.groupBy("win").agg(F.first("n").alias("n"), F.first("tokens").alias("tokens"))
    placed = distinct.select("win", "n", F.posexplode("tokens").alias("offset", "token"))
    rank = F.struct("seen", "token", "offset")
    prefix = placed.join(seen, "token").groupBy("win").agg(F.min(rank).alias("r"), F.first("n").alias("n"), F.countDistinct("offset").alias("held"))
    # a window one of whose shingles occurs nowhere can't occur either
    prefix = written(prefix.where(F.col("held") == F.col("n") - F.least("n", F.lit(width)) + 1)
                     .select("win", "n", F.col("r.token").alias("token"), F.col("r.offset").alias("offset")), "decontamination-prefix")
    rows = written(occurrences(docs, widths, bitmap(prefix.select("token")), length), "decontamination-hits")
    hits = rows.where(F.size("hits") > 0).select("doc_id", "key", "n_words", F.explode("hits").alias("h")).select("doc_id", "key", "n_words", "h.*")
    at = F.col("before") - F.col("offset")
    first = F.col("at") - F.col("offset")
    found = (hits.join(prefix, "token")
             .where((first >= 0) & (first + F.col("n") <= F.col("n_words")) & (at >= 0))
             .where(F.array_join(F.slice("words", at + 1, F.col("n")), " ") == F.col("win"))
             .select("doc_id", "key", first.alias("first"), (first + F.col("n")).alias("end"), "win"))
    return rows.select("doc_id", "key", "n_words"), found.join(wins.select("win", "item").distinct(), "win").select("doc_id", "key", "first", "end", "item")


def decontamination(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW, width: int = SHINGLE) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated of every row (and ``key``, the text's hash)."""
    rows, matches = contamination(docs, benchmark, length, width)
    spans = F.array_sort(F.collect_set(F.struct("first", "end")))
    per = matches.groupBy("doc_id", "key").agg(spans.alias("spans"), F.array_sort(F.collect_set("item")).alias("items"))
    covered = F.expr("aggregate(spans, named_struct('n', 0L, 'reach', 0), (a, x) -> named_struct('n', "
                     "a.n + greatest(0, x.end - greatest(x.first, a.reach)), 'reach', greatest(a.reach, x.end)), a -> a.n)")
    per = per.select(F.col("doc_id").alias("id"), F.col("key").alias("text_key"), covered.alias("hit"), "items")
    out = rows.join(per, F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("key") == F.col("text_key")), "left")
    items = F.coalesce("items", F.array().cast("array<string>"))
    n_hit = F.coalesce("hit", F.lit(0)).cast("long")
    return out.select("doc_id", "key", "n_words", n_hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                      F.sha2(F.array_join(items, ",").cast("binary"), 256).alias("items_sha256"), (n_hit > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, length: int = WINDOW, width: int = SHINGLE) -> DataFrame:
    """The rows of ``docs``, with all their columns, that hold no window of the benchmark."""
    _, matches = contamination(docs, benchmark, length, width)
    hit = written(matches.select(F.col("doc_id").alias("hit_id"), F.col("key").alias("hit_key")).distinct(), "decontamination-hit")
    key = F.xxhash64(F.coalesce(docs["text"], F.lit("")))
    return docs.join(hit, docs["doc_id"].eqNullSafe(hit["hit_id"]) & (key == hit["hit_key"]), "left_anti")
