"""Interpolated modified Kneser-Ney bigram model: counted in Spark, kept as sorted hash arrays.

Tokens are lower-cased words and one end mark per text, known by 64-bit hashes.

1. Unigrams: every task counts its tokens and hands them out as packed arrays
   per shard (by hash), already added up; one group per shard adds the tasks up.
2. Bigrams: the same by the hash of the context.  Contexts that hold more than
   ``HEAVY`` of all tokens (so a bounded number of them) are spread over the shards
   by the whole bigram, so that no shard holds a frequent word's successors alone.
   A shard of the model is two sorted hash arrays: its bigrams with their counts, its
   contexts with their totals.  It is written once, to the shared folder.
3. Discounts come from the counts of counts over all bigrams; lower orders use
   the number of distinct contexts of a word (from all bigrams).  All bigrams
   are stored; with a ``min_count`` above one, rarer ones are not, and their mass
   goes to the back-off weight, so the probabilities still add up to one.
4. The words (hash, count, number of contexts) are written by tasks as raw files of sorted
   arrays, handed to every machine with ``addFile`` and memory-mapped there by the
   workers: pages are shared and loaded as needed.  They grow with the vocabulary.
5. The bigrams, most of the model, are not copied to the machines.  A scoring task looks its words up and
   sends each shard the distinct bigrams of a piece of documents with the
   documents that have them; the task of the shard reads the arrays in
   place, as Arrow brings them, and adds up each document's part of the score.
   The parts meet by piece.  Documents are scored in ``ROUNDS`` parts (by the hash of their id), so that the
   questions of one part at a time are on disk; tables that only counting needs are deleted after it.

Shards grow with the bytes of the training texts (``SHARD_BYTES`` each), so a
group stays of bounded size at every scale.  Packed arrays are split into byte planes
and compressed, as the first bytes of sorted hashes repeat.

Edge cases: null or empty text is the end mark alone.  With no training rows
every token gets probability one of one, 0 in logarithms.  Repeated rows count and come out as often as they
occur; a null id hashes as the text ``null``; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from ..session import scratch_dir
from .kneser_ney import counts_of_counts, discount_of, discounts
from .shared import IS_SPACE, LOWER, bucket, buffer_of, combine, dropped, hash_spans, local_path, parts, prefix_sums, ship, slices, word_spans, written, written_by

SHARD_BYTES = 64 << 20
LEAST_SHARDS = 64
WORD_SHARD = 1 << 22  # words in a file, about
HEAVY = 1 << 16       # contexts over one in so many tokens are heavy: as many of them at most
END, BOS = np.uint64(1), np.uint64(2)
FLUSH = 1 << 20
HEADER = 4  # 64-bit words before the arrays of a file: shard, entries, large counts, large numbers of contexts
LARGE = 255  # numbers from here on are kept apart
ROUNDS = 2  # parts of the documents that are scored one after another, so that the questions of one part at a time lie on disk


# -- packed arrays ----------------------------------------------------------------

def pack(a: np.ndarray) -> bytes:
    """Unsigned numbers (or floats) as compressed byte planes; numbers take as many bytes as the largest needs."""
    if a.dtype.kind != "f":
        most = int(a.max(initial=0))
        a = a.astype(next(f"<u{w}" for w in (1, 2, 4, 8) if most < 1 << 8 * w))
    planes = np.ascontiguousarray(a.view(np.uint8).reshape(len(a), a.dtype.itemsize).T)
    return bytes([a.dtype.itemsize]) + zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def unpack(b: bytes, kind: str = "u") -> np.ndarray:
    width = b[0]
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(b[1:]), np.uint8).reshape(width, -1)
    a = np.ascontiguousarray(planes.T).reshape(-1).view(f"<{kind}{width}")
    return a if kind == "f" else a.astype(np.uint64)


def joined(t: pa.Table, name: str) -> np.ndarray:
    """A packed column of all rows, one after another."""
    got = [unpack(x) for x in t.column(name).to_pylist()]
    return np.concatenate(got) if got else np.zeros(0, np.uint64)


def summed(ids: np.ndarray, *counts: np.ndarray):
    """Distinct ids in order, and the sums of each of ``counts``."""
    order = np.argsort(ids, kind="stable")
    ids = ids[order]
    at = np.flatnonzero(np.append(True, ids[1:] != ids[:-1])) if len(ids) else np.zeros(0, np.int64)
    return ids[at], *(np.add.reduceat(n[order].astype(np.int64), at) if len(at) else n.astype(np.int64) for n in counts)


def nearly_sorted(a: np.ndarray) -> np.ndarray:
    """A stable order by the first bits of hashes (all but as many as their number has): several times faster than a full one.

    Equal hashes stand together, but for another one between them with the same first bits, which is rare.
    """
    low = np.uint64((1 << max(1, len(a).bit_length())) - 1)
    return (np.sort(a & ~low | np.arange(len(a), dtype=np.uint64)) & low).astype(np.int64)


def counted_pairs(h: np.ndarray, w: np.ndarray, n: np.ndarray | None = None):
    """Distinct pairs ordered by their first parts, and the sums of ``n``.

    Without ``n``: how often each occurs; a pair may then be there twice (see ``nearly_sorted``).
    """
    if n is None:
        order = nearly_sorted(w)
        order = order[nearly_sorted(h[order])]
    else:
        order = np.lexsort((w, h))
    h, w = h[order], w[order]
    at = np.flatnonzero(np.append(True, (h[1:] != h[:-1]) | (w[1:] != w[:-1])))
    total = np.diff(np.append(at, len(h))) if n is None else np.add.reduceat(n[order], at)
    return h[at], w[at], total


def runs(shard: np.ndarray):
    """(value, start, end) of the runs of a sorted array."""
    at = np.flatnonzero(np.append(True, shard[1:] != shard[:-1])) if len(shard) else []
    for a, b in zip(at, [*at[1:], len(shard)]):
        yield int(shard[a]), int(a), int(b)


def by_shard(shard: np.ndarray, **columns: np.ndarray) -> pa.RecordBatch:
    """A row per run of ``shard`` with its part of each column, packed."""
    rows = [*runs(shard)]
    return pa.RecordBatch.from_arrays([pa.array([s for s, _, _ in rows], pa.int64()), *(pa.array([pack(c[a:b]) for _, a, b in rows], pa.binary()) for c in columns.values())],
                                      ["shard", *columns])


def by_number(shard: np.ndarray, shards: int) -> np.ndarray:
    """A stable order by shard."""
    return np.argsort(shard.astype(np.uint16 if shards <= 1 << 16 else np.int64), kind="stable")


def shard_of(ids: np.ndarray, shards: int) -> np.ndarray:
    return (ids >> np.uint64(65 - shards.bit_length())).astype(np.int64)


# -- tokens -----------------------------------------------------------------------

def token_ids(raw: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids of all tokens, of the token before each (BOS at a start), and each token's text."""
    buf, offs = buffer_of(raw)
    buf = LOWER[buf]
    n = len(offs) - 1
    start, end, doc = word_spans(buf, offs, ~IS_SPACE)
    h = np.maximum(hash_spans(prefix_sums(buf), start, end), np.uint64(16))
    ids = np.full(len(h) + n, END)
    text = np.repeat(np.arange(n), np.bincount(doc, minlength=n) + 1) if n else np.zeros(0, np.int64)
    ids[np.arange(len(h)) + doc] = h
    before = np.empty_like(ids)
    before[1:] = ids[:-1]
    before[:1] = BOS
    before[1:][ids[:-1] == END] = BOS
    return ids, before, text


class Counts:
    """Running sums of a task, handed out whenever they are large."""

    def __init__(self, make):
        self.make, self.held, self.size = make, [], 0

    def add(self, *columns):
        self.held.append(columns)
        self.size += len(columns[0])
        if self.size > FLUSH:
            yield from self.flush()

    def flush(self):
        if self.held:
            yield self.make(*(np.concatenate(c) for c in zip(*self.held)))
        self.held, self.size = [], 0


def unigrams(docs: DataFrame, shards: int) -> DataFrame:
    """One row per shard: ids and counts of its tokens."""
    def make(ids, n):
        ids, n = summed(ids, n)
        return by_shard(shard_of(ids, shards), a=ids, n=n)

    def count(batches):
        c = Counts(make)
        for batch in batches:
            for _, raw in slices(batch):
                ids, n = np.unique(token_ids(raw)[0], return_counts=True)
                yield from c.add(ids, n)
        yield from c.flush()

    def add_up(t: pa.Table) -> pa.Table:
        ids, n = summed(joined(t, "a"), joined(t, "n"))
        return pa.table({"shard": t.column("shard").slice(0, 1), "a": pa.array([pack(ids)], pa.binary()), "n": pa.array([pack(n)], pa.binary()),
                         "tokens": [int(n.sum())], "kinds": [len(n)], "largest": [int(n.max(initial=0))]})

    return docs.select("text").mapInArrow(count, "shard long, a binary, n binary").groupBy("shard").applyInArrow(
        add_up, "shard long, a binary, n binary, tokens long, kinds long, largest long")


def heavy_ids(uni: DataFrame, tokens: int) -> np.ndarray:
    """Tokens that hold more than one in ``HEAVY`` of all, and the start mark: at most ``HEAVY`` + 1."""
    least = tokens // HEAVY

    def pick(batches):
        for batch in batches:
            for a, n in zip(batch.column("a").to_pylist(), batch.column("n").to_pylist()):
                yield pa.RecordBatch.from_arrays([pa.array(unpack(a)[unpack(n) > least].view(np.int64))], ["id"])

    rows = uni.where(F.col("largest") > least).select("a", "n").mapInArrow(pick, "id long").collect()
    return np.sort(np.append(np.array([r.id for r in rows], np.int64).view(np.uint64), BOS))


def home(h: np.ndarray, key: np.ndarray, heavy: np.ndarray, shards: int) -> np.ndarray:
    """The shard of each bigram: that of its context, or its own where the context is heavy."""
    at = np.minimum(np.searchsorted(heavy, h), len(heavy) - 1)
    return np.where(heavy[at] == h, shard_of(key, shards), shard_of(h, shards))


# -- the model ----------------------------------------------------------------------

#: kind 0: a shard's bigrams (a, b: hash and count) and contexts (c: hash; d: total, kept count, number of kept bigrams seen once, twice, more often; one after another).
#: kind 1: words (a) and in how many contexts each was seen (b).  kind 2: the sums of heavy contexts (c and d) as far as a shard knows.
MODEL = "shard long, kind int, a binary, b binary, c binary, d binary"


def _model_rows(kind: int, shards: list[int], **columns) -> pa.Table:
    n = len(shards)
    return pa.table({"shard": pa.array(shards, pa.int64()), "kind": pa.array([kind] * n, pa.int32()),
                     **{c: pa.array(columns.get(c, [b""] * n), pa.binary()) for c in "abcd"}})


def bigrams(docs: DataFrame, shards: int, word_shards: int, heavy, min_count: int) -> DataFrame:
    """The shards of the model, with the counts of counts; the words' contexts; the heavy contexts' sums."""
    def make(h, w):
        h, w, n = counted_pairs(h, w)
        key = combine(h, w)
        shard = home(h, key, heavy.value, shards)
        order = by_number(shard, shards)  # by context within a shard
        return by_shard(shard[order], a=h[order], b=w[order], n=n[order])

    def count(batches):
        c = Counts(make)
        for batch in batches:
            for _, raw in slices(batch):
                ids, before, _ = token_ids(raw)
                yield from c.add(before, ids)
        yield from c.flush()

    def add_up(t: pa.Table) -> pa.Table:
        own = t.column("shard")[0].as_py()
        h, w, n = counted_pairs(joined(t, "a"), joined(t, "b"), joined(t, "n").astype(np.int64))
        keep = n >= min_count
        first = np.flatnonzero(np.append(True, h[1:] != h[:-1]))
        contexts = h[first]
        sums = np.stack([np.add.reduceat(x.astype(np.int64), first) for x in (n, np.where(keep, n, 0), keep & (n == 1), keep & (n == 2), keep & (n > 2))])
        key = combine(h, w)
        order = np.argsort(key)
        key, kept_n = key[order], n[order]
        kept_n, key = kept_n[keep[order]], key[keep[order]]
        at = np.minimum(np.searchsorted(heavy.value, contexts), len(heavy.value) - 1)
        hot = heavy.value[at] == contexts
        flat = lambda x: pack(np.ascontiguousarray(x).ravel())
        model = _model_rows(0, [own], a=[pack(key)], b=[pack(kept_n)], c=[pack(contexts[~hot])], d=[flat(sums[:, ~hot])])
        words, seen = np.unique(w, return_counts=True)
        cut = [*runs(shard_of(words, word_shards))]
        told = _model_rows(1, [s for s, _, _ in cut], a=[pack(words[a:b]) for _, a, b in cut], b=[pack(seen[a:b]) for _, a, b in cut])
        rows = [model, told, _model_rows(2, [own], c=[pack(contexts[hot])], d=[flat(sums[:, hot])])]
        coc = [[counts_of_counts(n)], [[]] * len(cut), [[]]]
        return pa.concat_tables([x.append_column("sums", pa.array(c, pa.list_(pa.int64()))) for x, c in zip(rows, coc)])

    return docs.select("text").mapInArrow(count, "shard long, a binary, b binary, n binary").groupBy("shard").applyInArrow(add_up, f"{MODEL}, sums array<long>")


def heavy_sums(model: DataFrame, heavy: np.ndarray) -> np.ndarray:
    """The five sums of each heavy context over all shards."""
    def spread(batches):
        for batch in batches:
            for c, d in zip(batch.column("c").to_pylist(), batch.column("d").to_pylist()):
                h = unpack(c)
                yield pa.RecordBatch.from_arrays([pa.array(h.view(np.int64)), *(pa.array(x.astype(np.int64)) for x in unpack(d).reshape(5, len(h)))], ["h", *"vwxyz"])

    rows = (model.where("kind = 2").select("c", "d").mapInArrow(spread, "h long, v long, w long, x long, y long, z long")
            .groupBy("h").agg(*(F.sum(c).alias(c) for c in "vwxyz")).collect())
    out = np.zeros((5, len(heavy)), np.int64)
    if rows:
        at = np.searchsorted(heavy, np.array([r.h for r in rows], np.int64).view(np.uint64))
        out[:, at] = np.array([r[1:] for r in rows], np.int64).T
    return out


def word_files(uni: DataFrame, contexts: DataFrame, word_shards: int, folder: str) -> None:
    """A raw file per word shard: header, hashes in order, large counts and numbers of contexts (places and values), all of them in a byte each."""
    def make(t: pa.Table) -> pa.Table:
        kind = t.column("kind").to_numpy()
        (ids, n), (seen_ids, seen) = (summed(joined(x, "a"), joined(x, "b")) for x in (t.filter(pa.array(kind == k)) for k in (0, 1)))
        contexts = np.zeros(len(ids), np.int64)
        contexts[np.searchsorted(ids, seen_ids)] = seen
        large = [np.flatnonzero(x >= LARGE) for x in (n, contexts)]
        head = np.array([t.column("shard")[0].as_py(), len(ids), *map(len, large)], "<i8")
        arrays = [head, ids.astype("<u8"), *(y for x, at in zip((n, contexts), large) for y in (at.astype("<i8"), x[at].astype("<i8"))),
                  *(np.minimum(x, LARGE).astype(np.uint8) for x in (n, contexts))]
        return pa.table({"file": pa.array([b"".join(x.tobytes() for x in arrays)], pa.binary())})

    rows = uni.select("shard", F.lit(0).alias("kind"), "a", F.col("n").alias("b")).unionByName(contexts.select("shard", "kind", "a", "b"))
    files = rows.groupBy("shard").applyInArrow(make, "file binary")
    # The text writer puts the bytes of a string out as they are; a file per row, named by the task.
    files.select(F.col("file").cast("string").alias("file")).write.option("maxRecordsPerFile", 1).text(folder)


def train(docs: DataFrame, min_count: int) -> tuple[DataFrame, str, dict]:
    """Count, smooth and write the model: (its shards, the folder of the word files, its scalars)."""
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    power = lambda n: 1 << (int(n) - 1).bit_length()
    shards = power(max(LEAST_SHARDS, size // SHARD_BYTES))
    uni, at_uni = written_by(unigrams(docs, shards), "lm-unigrams")
    tokens, kinds = (x or 0 for x in uni.agg(F.sum("tokens"), F.sum("kinds")).first())
    word_shards = min(shards, power(max(LEAST_SHARDS, kinds // WORD_SHARD)))
    heavy = heavy_ids(uni, tokens)
    model, at = written_by(bigrams(docs, shards, word_shards, spark.sparkContext.broadcast(heavy), min_count), "lm-model", "kind")
    coc = [x or 0 for x in model.where("kind = 0").agg(*(F.sum(F.col("sums")[k]) for k in range(4))).first()]

    def merge(t: pa.Table) -> pa.Table:
        ids, n = summed(joined(t, "a"), joined(t, "b"))
        return pa.table({"shard": t.column("shard").slice(0, 1), "kind": pa.array([1], pa.int32()), "a": pa.array([pack(ids)], pa.binary()), "b": pa.array([pack(n)], pa.binary()),
                         "sums": pa.array([[*counts_of_counts(n), len(n), int(n.sum())]], pa.list_(pa.int64()))})

    contexts, at_contexts = written_by(model.where("kind = 1").select("shard", "a", "b").groupBy("shard").applyInArrow(
        merge, "shard long, kind int, a binary, b binary, sums array<long>"), "lm-contexts")
    dropped(spark, f"{at}/kind=1")
    s = [x or 0 for x in contexts.agg(*(F.sum(F.col("sums")[k]) for k in range(6))).first()]
    d1 = discounts(*s[:4])
    all_contexts = max(1, s[5])
    rest = (d1[1] * s[0] + d1[2] * s[1] + d1[3] * (s[4] - s[0] - s[1])) / all_contexts
    folder = scratch_dir(spark, "lm-words")
    together = F.expr(f"shard div {shards // word_shards}")  # files of words are fewer than shards of bigrams
    word_files(uni.withColumn("shard", together), contexts, word_shards, folder)
    sums = heavy_sums(model, heavy)
    for path in (at_uni, at_contexts, f"{at}/kind=2"):
        dropped(spark, path)
    return model.where("kind = 0"), folder, {
        "tokens": tokens, "kinds": kinds, "shards": shards, "word_shards": word_shards, "d1": d1, "d2": discounts(*coc), "all_contexts": all_contexts,
        "uniform": (rest if s[5] else 1.0) / (kinds + 1), "heavy": heavy, "heavy_sums": sums}


def hand_out(spark, folder: str) -> list[str]:
    """Give every word file to all machines; their names there."""
    names = []
    for r in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).select("path").collect():
        spark.sparkContext.addFile(r.path)
        names.append(r.path.rsplit("/", 1)[1])
    return names


class Words:
    """Memory-mapped words; look-ups take sorted distinct ids."""

    def __init__(self, names: list[str], shards: int):
        self.shards, self.files = shards, {}
        for n in names:
            path = local_path(n)
            head = np.fromfile(path, "<i8", HEADER).tolist()
            if len(head) < HEADER:  # the writer's empty file, where there are no words
                continue
            shard, size, *large = head
            at, arrays = 8 * HEADER, []
            for kind, k in (("<u8", size), *(("<i8", k) for k in large for _ in "pv"), ("u1", size), ("u1", size)):
                arrays.append(np.memmap(path, kind, "r", at, (k,)) if k else np.zeros(0, kind))
                at += k * np.dtype(kind).itemsize
            self.files[shard] = arrays

    @staticmethod
    def _numbers(small, places, values, i: np.ndarray) -> np.ndarray:
        out = small[i].astype(np.int64)
        big = np.flatnonzero(out == LARGE)
        if len(big):
            out[big] = values[np.searchsorted(places, i[big])]
        return out

    def find(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count and number of contexts of each id, 0 for unknown ones."""
        n, seen = np.zeros(len(ids), np.int64), np.zeros(len(ids), np.int64)
        for shard, a, b in runs(shard_of(ids, self.shards)):
            if shard in self.files and len(self.files[shard][0]):
                keys, n_at, n_large, seen_at, seen_large, n_small, seen_small = self.files[shard]
                i = np.minimum(np.searchsorted(keys, ids[a:b]), len(keys) - 1)
                hit = np.flatnonzero(keys[i] == ids[a:b])
                n[a:b][hit] = self._numbers(n_small, n_at, n_large, i[hit])
                seen[a:b][hit] = self._numbers(seen_small, seen_at, seen_large, i[hit])
        return n, seen


# -- scores -------------------------------------------------------------------------

#: kind 1: distinct bigrams of a piece in a shard: hash, number of its context among the contexts, contexts, its word's number of contexts, how many tokens, their documents.
#: kind 2: the piece's documents, as an Arrow stream.
ASK = "shard long, kind int, piece long, a binary, b binary, c binary, d binary, e binary, f binary"
_WORDS: dict[str, Words] = {}


def questions(docs: DataFrame, folder: str, names: list[str], model, part: int) -> DataFrame:
    """What the pieces of documents ask the shards, and the pieces' documents with all that needs no bigram."""
    fields = ["shard", "kind", "piece", *"abcdef"]

    def piece_rows(piece: int, held: list, tables: list):
        m = model.value
        ids, before, seen, doc = (np.concatenate(c) for c in zip(*held))
        key = combine(before, ids)
        shard = home(before, key, m["heavy"], m["shards"])
        order = nearly_sorted(key)  # documents come in order; a bigram that is there twice is asked for twice
        order = order[by_number(shard[order], m["shards"])]
        key, shard, before, seen, doc = key[order], shard[order], before[order], seen[order], doc[order]
        new = np.append(True, key[1:] != key[:-1])
        out: list[list] = [[] for _ in fields]
        for s, a, b in runs(shard):
            at = a + np.flatnonzero(new[a:b])
            contexts, number = np.unique(before[at], return_inverse=True)
            for col, x in zip(out, (s, 1, piece, pack(key[at]), pack(number), pack(contexts), pack(seen[at]), pack(np.diff(np.append(at, b))), pack(doc[a:b]))):
                col.append(x)
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, tables[0].schema) as w:
            for t in tables:
                w.write_batch(t)
        for col, x in zip(out, (piece % m["shards"], 2, piece, sink.getvalue().to_pybytes(), *(b"",) * 5)):
            col.append(x)
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), pa.int64(), *(pa.binary(),) * 6))], fields)

    def ask(batches):
        m = model.value
        if folder not in _WORDS:
            _WORDS.clear()
            _WORDS[folder] = Words(names, m["word_shards"])
        piece, held, tables, size, before_docs = (part << 56) + (TaskContext.get().partitionId() << 32), [], [], 0, 0
        for batch in batches:
            for some, raw in slices(batch):
                ids, before, text = token_ids(raw)
                k = len(raw)
                words, inv = np.unique(ids, return_inverse=True)
                n, seen = _WORDS[folder].find(words)
                base = np.log10((n + 1) / (m["tokens"] + m["kinds"] + 1))
                held.append((ids, before, seen[inv], text + before_docs))
                tables.append(pa.RecordBatch.from_arrays(
                    [some.column("doc_id"), some.column("held_out"), pa.array(np.bincount(text, minlength=k), pa.int64()),
                     pa.array(np.bincount(text, n[inv] > 0, k).astype(np.int64)), pa.array(np.bincount(text, base[inv], k))],
                    ["doc_id", "held_out", "n_tokens", "n_known", "base_score"]))
                size, before_docs = size + len(ids), before_docs + k
                if size > FLUSH:
                    yield piece_rows(piece, held, tables)
                    piece, held, tables, size, before_docs = piece + 1, [], [], 0, 0
        if held:
            yield piece_rows(piece, held, tables)

    return docs.mapInArrow(ask, ASK)


def log_probabilities(m: dict, shard: dict, key, context, seen) -> np.ndarray:
    """log10 probability of bigrams (hash, context, number of contexts of the word)."""
    low = m["uniform"] + (seen - discount_of(seen, m["d1"])) / m["all_contexts"]
    top = np.zeros(len(key))
    if len(shard["key"]):
        at = np.minimum(np.searchsorted(shard["key"], key), len(shard["key"]) - 1)
        n = shard["n"][at]
        top = np.where(shard["key"][at] == key, n - discount_of(n, m["d2"]), 0.0)
    sums = np.zeros((5, len(context)), np.int64)
    for keys, values in ((shard["contexts"], shard["sums"]), (m["heavy"], m["heavy_sums"])):
        if len(keys):
            at = np.minimum(np.searchsorted(keys, context), len(keys) - 1)
            hit = np.flatnonzero(keys[at] == context)
            sums[:, hit] = values[:, at[hit]]
    total, kept, once, twice, more = sums
    d = m["d2"]
    mass = kept - d[1] * once - d[2] * twice - d[3] * more
    return np.log10(np.where(total > 0, top / np.maximum(total, 1) + (1 - mass / np.maximum(total, 1)) * low, low))


def answers(rows: DataFrame, model) -> DataFrame:
    """Partial scores: rows lie by shard, each shard's part of the model first."""
    def look_up(batches):
        m, at, shard = model.value, None, None
        none = np.zeros(0, np.uint64)
        for batch in batches:
            cols = batch.to_pydict()
            out = {"piece": [], "shard": [], "docs": [], "sums": []}
            for k, s in enumerate(cols["shard"]):
                if s != at:
                    at, shard = s, {"key": none, "n": none.astype(np.int64), "contexts": none, "sums": np.zeros((5, 0), np.int64)}
                a, b, c, d, e, f = (cols[x][k] for x in "abcdef")
                if cols["kind"][k] == 0:
                    contexts = unpack(c)
                    shard = {"key": unpack(a), "n": unpack(b).astype(np.int64), "contexts": contexts, "sums": unpack(d).astype(np.int64).reshape(5, len(contexts))}
                    continue
                if cols["kind"][k] == 2:
                    docs, sums = b"", a
                else:
                    p = log_probabilities(m, shard, unpack(a), unpack(c)[unpack(b).astype(np.int64)], unpack(d).astype(np.int64))
                    doc, total = np.unique(unpack(f), return_inverse=True)
                    docs, sums = pack(doc), pack(np.bincount(total, np.repeat(p, unpack(e).astype(np.int64)), len(doc)))
                for name, x in zip(out, (cols["piece"][k], s, docs, sums)):
                    out[name].append(x)
            yield pa.RecordBatch.from_arrays([pa.array(out["piece"], pa.int64()), pa.array(out["shard"], pa.int64()), pa.array(out["docs"], pa.binary()), pa.array(out["sums"], pa.binary())], list(out))

    return rows.mapInArrow(look_up, "piece long, shard long, docs binary, sums binary")


def lm_scores(docs: DataFrame, min_count: int = 1, folds: int = 7, held_out: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Learns from the rows whose fold (crc32 of the id as text, modulo ``folds``) is not ``held_out``.
    """
    spark = docs.sparkSession
    ship(spark)
    fold = F.pmod(bucket(), F.lit(folds)) == held_out
    shards, folder, scalars = train(docs.where(~fold), min_count)
    names = hand_out(spark, folder)
    model = spark.sparkContext.broadcast(scalars)
    shards = shards.select("shard", "kind", F.lit(0).cast("long").alias("piece"), "a", "b", "c", "d")
    found = []
    for part in range(ROUNDS):
        own = docs.where(F.pmod(bucket(), F.lit(ROUNDS * folds)) >= part * folds).where(F.pmod(bucket(), F.lit(ROUNDS * folds)) < (part + 1) * folds)
        rows = questions(own.select("doc_id", fold.alias("held_out"), "text"), folder, names, model, part).unionByName(shards, allowMissingColumns=True)
        rows = rows.repartition(parts(spark), "shard").sortWithinPartitions("shard", "kind")
        found.append(written(answers(rows, model), "lm-parts", free=True))
    found = reduce(DataFrame.unionByName, found)
    kind = docs.schema["doc_id"].dataType
    arrow, tokens = to_arrow_type(kind), scalars["tokens"]

    def add_up(t: pa.Table) -> pa.Table:
        t = t.sort_by("shard")  # one order of adding, whatever came first
        docs = t.column("docs").to_pylist()
        first = next(k for k, x in enumerate(docs) if not x)
        own = pa.ipc.open_stream(t.column("sums")[first].as_py()).read_all()
        score = np.zeros(len(own))
        for k, x in enumerate(docs):
            if x:
                score[unpack(x).astype(np.int64)] += unpack(t.column("sums")[k].as_py(), "f")
        out = own.append_column("score", pa.array(score)).append_column("train_tokens", pa.array(np.full(len(own), tokens), pa.int64()))
        out = out.set_column(0, "doc_id", out.column("doc_id").cast(arrow))
        return out.select(["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return found.groupBy("piece").applyInArrow(
        add_up, f"doc_id {kind.simpleString()}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")
