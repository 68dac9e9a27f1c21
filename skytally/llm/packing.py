"""Packing of tokenised documents into sequences of at most ``limit`` tokens.

1. **Pieces.**  Tasks tokenise whole texts, end each document with one id and cut what
   is longer than ``limit``.  A piece is known by its length, its task and its number
   among the task's pieces of that length.
2. **Plan.**  Pieces of one length are interchangeable, so the plan needs only the
   number of pieces of each length: at most ``limit`` counts, whatever the
   table holds.  By the *linear grouping* scheme, large lengths are split into groups of equal
   cardinality and rounded up to the largest of their group; a linear program
   over configurations of these few sizes (column generation, a knapsack per
   step) says how many sequences have which configuration; the actual lengths
   take the places of the rounded ones; what the rounding down of the program
   leaves over and the small pieces go, longest first, into the sequence with the least room that holds
   them.  Sequences with equal contents are handled as one block, so the
   plan too is bounded by lengths and configurations, not by pieces.
3. **Places.**  A piece's number among all pieces of its length (counts per task, added up)
   leads to its row of the plan, and that to sequence and offset.

Edge cases: null or empty text is one piece with the end id; null ids and repeated rows are
kept, each row packed for itself; texts are read in windows, so a long one needs memory
for its own text only; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import json
import unicodedata
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from tokenizers import Tokenizer

from .shared import IS_SPACE, hash_spans, prefix_sums, ship, slices, written

LIMIT = 4096
END = 1
LARGE = 8          # lengths over limit / LARGE are large
GROUPINGS = (6, 12, 24, 48)  # numbers of groups that are tried; the plan with the fewest sequences counts
WINDOW = 1 << 20   # bytes or code points that are tokenised at a time
STORED = 1 << 21   # segments that a worker keeps
#: Fixed value: the pre-tokenizer pattern that ``segments`` is made for.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"



# -- tokens -------------------------------------------------------------------------

#: Kinds of bytes: 0 white space, 1 letter, 2 digit, 3 other ASCII, 4 part of a longer character.
KIND = np.full(256, 3, np.uint8)
KIND[IS_SPACE] = 0
KIND[97:123], KIND[48:58], KIND[128:] = 1, 2, 4
APOSTROPHE = 39


def segments(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text of the parts of (lower-case) texts that no match of the pattern goes beyond.

    White space parts them, and a change between ASCII letters, digits and others; not behind an
    apostrophe, which may take letters along, and not beside longer characters, whose kind is unknown here.
    """
    kind = KIND[buf]
    edge = np.ones(len(buf) + 1, bool)
    a, b = kind[:-1], kind[1:]
    space = (a == 0) | (b == 0)
    edge[1:-1] = (a != b) & (space | ((a != 4) & (b != 4) & ~((buf[:-1] == APOSTROPHE) & (b == 1))))
    edge[offs[:-1][np.diff(offs) > 0]] = True
    at = np.flatnonzero(edge)
    start, end = at[:-1], at[1:]
    keep = kind[start] != 0 if len(start) else np.zeros(0, bool)
    start, end = start[keep], end[keep]
    return start, end, np.searchsorted(offs, start, "right") - 1


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, one range after another."""
    ends = np.cumsum(size)
    return np.arange(int(ends[-1]) if len(ends) else 0) + np.repeat(start - (ends - size), size)


class Store:
    """Segments and their ids in flat arrays, found by hash and compared byte by byte; emptied when it holds ``STORED``."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.keys = [np.zeros(0, np.uint64)] * 2  # sorted hashes: all but the newest, the newest
        self.rows = [np.zeros(0, np.int64)] * 2   # and the row of each
        self.n = 0
        self.text, self.ids = np.zeros(1 << 16, np.uint8), np.zeros(1 << 16, np.uint32)
        self.ends = np.zeros((2, 1 << 12), np.int64)  # per row: where its text and its ids end
        self.starts = np.zeros((2, 1 << 12), np.int64)

    @staticmethod
    def _room(a: np.ndarray, n: int) -> np.ndarray:
        return a if a.shape[-1] >= n else np.concatenate([a, np.zeros((*a.shape[:-1], max(n, a.shape[-1]) - a.shape[-1] + n), a.dtype)], axis=-1)

    def find(self, keys: np.ndarray, buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Row of each of the segments (sorted hashes, and where their bytes lie); -1 where there is none."""
        row = np.full(len(keys), -1, np.int64)
        for own, rows in zip(self.keys, self.rows):
            if len(own):
                i = np.minimum(np.searchsorted(own, keys), len(own) - 1)
                hit = np.flatnonzero(own[i] == keys)
                row[hit] = rows[i[hit]]
        hit = np.flatnonzero(row >= 0)
        begin, held = self.starts[0, row[hit]], self.ends[0, row[hit]] - self.starts[0, row[hit]]
        same = held == size[hit]
        some = hit[same]
        if len(some):
            differs = buf[ranges(start[some], size[some])] != self.text[ranges(begin[same], size[some])]
            wrong = np.add.reduceat(differs, np.cumsum(size[some]) - size[some]) > 0
            row[some[wrong]] = -1
        row[hit[~same]] = -1
        return row

    def add(self, keys: np.ndarray, texts: list[bytes], ids: list[list[int]]) -> np.ndarray:
        """Rows of new segments, whose hashes are sorted."""
        n, more = self.n, len(keys)
        self.starts, self.ends = self._room(self.starts, n + more), self._room(self.ends, n + more)
        rows = np.arange(n, n + more)
        for k, (name, flat, sizes) in enumerate((("text", np.frombuffer(b"".join(texts), np.uint8), list(map(len, texts))),
                                                 ("ids", np.array([x for i in ids for x in i], np.uint32), list(map(len, ids))))):
            at = int(self.ends[k, n - 1]) if n else 0
            held = self._room(getattr(self, name), at + len(flat))
            held[at:at + len(flat)] = flat
            setattr(self, name, held)
            self.ends[k, rows] = at + np.cumsum(sizes)
            self.starts[k, rows] = self.ends[k, rows] - sizes
        self.n += more
        level = 1 if len(self.keys[1]) + more < max(1 << 14, len(self.keys[0]) // 8) else 0
        merged = [np.concatenate([*x[level:], new]) for x, new in ((self.keys, keys), (self.rows, rows))]
        order = np.argsort(merged[0], kind="stable")
        self.keys[level], self.rows[level] = (x[order] for x in merged)
        if not level:
            self.keys[1], self.rows[1] = self.keys[1][:0], self.rows[1][:0]
        return rows


class Encoder:
    """Ids of texts as the tokenizers library gives them; each segment is encoded once per worker.

    Works for files whose normalizer is NFC, white space to a space and lower case, and whose
    pre-tokenizer drops white space; others are encoded by the library text by text.
    """

    _kept: dict[str, "Encoder"] = {}

    def __init__(self, path: str):
        self.library = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        steps = [s["type"] for s in (spec.get("normalizer") or {}).get("normalizers", [])]
        pre = (spec.get("pre_tokenizer") or {}).get("pretokenizers", [])
        added = spec.get("added_tokens") or []
        self.parts = (steps == ["NFC", "Replace", "Lowercase"] and [p["type"] for p in pre] == ["Split", "ByteLevel"]
                      and pre[0]["behavior"] == "Removed" and pre[0]["invert"] and not pre[1]["add_prefix_space"] and not pre[1]["use_regex"]
                      and pre[0]["pattern"].get("Regex") == PATTERN
                      and not any(a["normalized"] or a["single_word"] or a["lstrip"] or a["rstrip"] for a in added))
        self.store = Store()
        self.pattern = regex.compile(PATTERN)
        self.special = {a["content"]: a["id"] for a in added}
        self.cut = regex.compile("(%s)" % "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True))) if added else None
        self.simple = regex.compile(r"[^\x00-\u02ff]")
        self.visible = _byte_letters()

    @classmethod
    def of(cls, path: str) -> "Encoder":
        if path not in cls._kept:
            cls._kept[path] = cls(path)
        return cls._kept[path]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        """The ids of each text."""
        out: list[list[np.ndarray]] = [[] for _ in texts]
        held, size = [], 0  # (place in out, part of a text)

        def settle():
            for (parts, k), got in zip([(out[i], k) for i, k, _ in held], self._encoded([w for _, _, w in held])):
                parts[k] = got
            held.clear()

        for i, text in enumerate(texts):
            for part in self._windows(text):
                out[i].append(part)
                if isinstance(part, bytes):
                    held.append((i, len(out[i]) - 1, part))
                    size += len(part)
                    if size > WINDOW:
                        settle()
                        size = 0
        settle()
        return [np.concatenate(x) if x else np.zeros(0, np.uint32) for x in out]

    def _windows(self, text: str) -> Iterator[bytes | np.ndarray]:
        """A text's parts in order: normalized bytes that are still to be encoded, or ids."""
        if not self.parts:
            yield np.array(self.library.encode(text, add_special_tokens=False).ids, np.uint32)
            return
        for k, part in enumerate(self.cut.split(text) if self.cut else [text]):
            if k % 2:
                yield np.array([self.special[part]], np.uint32)
                continue
            at = 0
            while at < len(part):  # a space is dropped, so texts may be cut there
                to = part.find(" ", at + WINDOW)
                to = len(part) if to < 0 else to
                piece, at = part[at:to], to + 1
                if self.simple.search(piece):
                    # code points that this Python does not know may be letters to the library
                    unknown = any(unicodedata.category(c) == "Cn" for c in set(piece))
                    piece = self.library.normalizer.normalize_str(piece)
                    if unknown:
                        yield np.array([i for word, _ in self.library.pre_tokenizer.pre_tokenize_str(piece) for i in self._model(word)], np.uint32)
                        continue
                else:  # NFC leaves these alone
                    piece = piece.lower()
                yield piece.encode()

    def _encoded(self, texts: list[bytes]) -> list[np.ndarray]:
        """Ids of normalized texts: their distinct segments looked up, the others encoded and kept."""
        buf = np.frombuffer(b"".join(texts), np.uint8)
        offs = np.append(0, np.cumsum([len(t) for t in texts], dtype=np.int64)).astype(np.int64)
        start, end, owner = segments(buf, offs)
        if not len(start):
            return [np.zeros(0, np.uint32) for _ in texts]
        if self.store.n > STORED:
            self.store.clear()
        keys, at, which = np.unique(hash_spans(prefix_sums(buf), start, end), return_index=True, return_inverse=True)
        first, size = start[at], end[at] - start[at]
        row = self.store.find(keys, buf, first, size)
        new = np.flatnonzero(row < 0)
        if len(new):
            raw = [buf[a:a + n].tobytes() for a, n in zip(first[new].tolist(), size[new].tolist())]
            row[new] = self.store.add(keys[new], raw, [self._segment(x.decode()) for x in raw])
        row = row[which]
        begin = self.store.starts[1, row]
        number = self.store.ends[1, row] - begin
        ids = self.store.ids[ranges(begin, number)]
        return np.split(ids, np.cumsum(np.bincount(owner, number, len(texts)).astype(np.int64))[:-1])

    def _segment(self, text: str) -> list[int]:
        if text.isalpha():  # one match of the pattern
            return self._word(text)
        return [i for word in self.pattern.findall(text) for i in self._word(word)]

    def _word(self, word: str) -> list[int]:
        return self._model(word.encode().decode("latin-1").translate(self.visible))

    def _model(self, letters: str) -> list[int]:
        return [t.id for t in self.library.model.tokenize(letters)]


def _byte_letters() -> dict[int, str]:
    """The byte-level alphabet: printable bytes stand for themselves, the others for U+0100 on, in order."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}


PIECE = "piece int, start long, length long, ids_crc32 long, part int, local long"


def pieces(docs: DataFrame, path: str, limit: int, end: int, with_ids: bool) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, and the piece's task (part) and number (local) among that task's pieces of its length."""
    kind = docs.schema["doc_id"].dataType
    arrow = to_arrow_type(kind)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "part", "local", *(["ids"] if with_ids else [])]

    def run(batches):
        encoder, task, seen = Encoder.of(path), TaskContext.get().partitionId(), Counter()
        for batch in batches:
            for rows, raw in slices(batch):
                cols: list[list] = [[] for _ in names]
                for k, ids in enumerate(encoder.ids([t.as_py().decode("utf-8", "replace") for t in raw])):
                    ids = np.append(ids, np.uint32(end)).astype("<u4")
                    for j, start in enumerate(range(0, len(ids), limit)):
                        part = ids[start:start + limit]
                        n = len(part)
                        row = (k, j, start, n, zlib.crc32(part.tobytes()), task, seen[n], part.view("<i4"))
                        for col, v in zip(cols, row):
                            col.append(v)
                        seen[n] += 1
                kinds = (None, pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.list_(pa.int32()))
                ids_of = rows.column("doc_id").take(pa.array(cols[0], pa.int64())).cast(arrow)
                yield pa.RecordBatch.from_arrays([ids_of, *(pa.array(c, t) for c, t in zip(cols[1:], kinds[1:]))], names)

    schema = f"doc_id {kind.simpleString()}, {PIECE}" + (", ids array<int>" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(run, schema)


# -- the plan ---------------------------------------------------------------------------

def _best_configuration(sizes: list[int], most: list[int], value: np.ndarray, limit: int) -> tuple[float, np.ndarray]:
    """The knapsack of greatest value: number of each size, at most ``most`` of it, within ``limit``."""
    best = np.zeros(limit + 1)
    taken = []  # per bundle: size number, count, where it was taken
    for k, s in enumerate(sizes):
        left, bundle = min(most[k], limit // s), 1
        while left > 0 and value[k] > 0:
            n = min(bundle, left)
            left, bundle = left - n, bundle * 2
            room = n * s
            with_it = best[:limit + 1 - room] + n * value[k]
            better = np.zeros(limit + 1, bool)
            better[room:] = with_it > best[room:] + 1e-12
            best = best.copy()
            best[room:][better[room:]] = with_it[better[room:]]
            taken.append((k, n, better))
    used, at = np.zeros(len(sizes), np.int64), int(best.argmax())
    top = float(best[at])
    for k, n, better in reversed(taken):
        if better[at]:
            used[k] += n
            at -= n * sizes[k]
    return top, used


def configurations(sizes: list[int], demand: list[int], limit: int, steps: int = 600) -> list[tuple[np.ndarray, float]]:
    """Configurations and how often each is used in an optimal fractional packing of ``demand`` pieces of ``sizes``."""
    k = len(sizes)
    d = np.array(demand, float)
    base = np.diag([float(min(limit // s, n)) for s, n in zip(sizes, demand)])  # columns are configurations
    x = d / np.diag(base)
    inverse = np.linalg.inv(base)
    for step in range(steps):
        if step % 64 == 63:  # rounding errors do not add up
            inverse = np.linalg.inv(base)
            x = inverse @ d
        price = inverse.sum(axis=0)
        worth, column = _best_configuration(sizes, demand, price, limit)
        if worth <= 1 + 1e-7:
            break
        along = inverse @ column
        ratio = np.full(k, np.inf)
        np.divide(np.maximum(x, 0), along, out=ratio, where=along > 1e-9)
        out = int(ratio.argmin())
        if not np.isfinite(ratio[out]):
            break
        grow = ratio[out]
        x = x - grow * along
        x[out] = grow
        base[:, out] = column
        pivot = inverse[out] / along[out]
        inverse = inverse - np.outer(along, pivot)
        inverse[out] = pivot
    return [(base[:, j].astype(np.int64), float(x[j])) for j in range(k)]


class Plan:
    """Rows (length, first number, how many, first sequence, per sequence, offset) and the number of sequences."""

    def __init__(self, counts: dict[int, int], limit: int, groups: int, large: int = LARGE):
        self.limit, self.rows, self.sequences = limit, [], 0
        self.next = Counter()  # pieces of each length that have a place
        self.left = Counter({s: n for s, n in counts.items() if n})
        self.room: dict[int, list[tuple[int, int]]] = defaultdict(list)  # room -> blocks (first sequence, how many)
        self.rooms: list[int] = []
        if full := self.left.pop(limit, 0):
            self._place(limit, full, self._open(full), 1, 0)
        self._configured(sorted((s for s in self.left if s > limit // large), reverse=True), groups)
        for s in sorted(self.left, reverse=True):
            self._best_fit(s, self.left[s])

    def _open(self, n: int) -> int:
        self.sequences += n
        return self.sequences - n

    def _place(self, size: int, n: int, first: int, each: int, offset: int) -> None:
        self.rows.append((size, self.next[size], n, first, each, offset))
        self.next[size] += n

    def _add_room(self, room: int, first: int, n: int) -> None:
        if n and room:
            if not self.room[room]:
                heapq.heappush(self.rooms, room)
            self.room[room].append((first, n))

    def _configured(self, large: list[int], groups: int) -> None:
        """Linear grouping, the configurations of the few sizes, and actual lengths in their places."""
        total = sum(self.left[s] for s in large)
        if not total:
            return
        share = -(-total // groups)
        members: list[list[list[int]]] = []  # per group: [length, pieces], longest first
        room_left = 0
        for s in large:
            n = self.left[s]
            while n:
                if not room_left:
                    if members and members[-1][0][0] == s:  # the next group would have the same size
                        room_left = share
                    else:
                        members.append([])
                        room_left = share
                took = min(n, room_left)
                members[-1].append([s, took])
                n, room_left = n - took, room_left - took
        sizes = [m[0][0] for m in members]
        demand = [sum(n for _, n in m) for m in members]
        have = list(demand)
        for config, times in configurations(sizes, demand, self.limit):
            times = int(times + 1e-9)
            for k in np.flatnonzero(config):
                times = min(times, have[k] // int(config[k]))
            if times:
                for k in np.flatnonzero(config):
                    have[k] -= times * int(config[k])
                self._substitute(members, config, times)

    def _substitute(self, members: list[list[list[int]]], config: np.ndarray, times: int) -> None:
        """``times`` sequences of a configuration, filled with the groups' next actual lengths."""
        first = self._open(times)
        blocks = [(first, times, 0)]  # (first sequence, how many, tokens so far)
        for k in np.flatnonzero(config):
            for _ in range(int(config[k])):
                split = []
                for at, n, used in blocks:
                    while n:
                        size, held = members[k][0]
                        took = min(n, held)
                        self._place(size, took, at, 1, used)
                        self.left[size] -= took
                        split.append((at, took, used + size))
                        at, n = at + took, n - took
                        if held == took:
                            members[k].pop(0)
                        else:
                            members[k][0][1] = held - took
                blocks = split
        for at, n, used in blocks:
            self._add_room(self.limit - used, at, n)

    def _best_fit(self, size: int, n: int) -> None:
        """``n`` pieces of one length, each into the sequence with the least room for it."""
        small = []  # rooms too small for this length, put back at the end
        while n:
            while self.rooms and self.rooms[0] < size:
                small.append(heapq.heappop(self.rooms))
            if not self.rooms:
                each = self.limit // size
                if n >= each:
                    first = self._open(n // each)
                    self._place(size, n // each * each, first, each, 0)
                    self._add_room(self.limit - each * size, first, n // each)
                if rest := n % each:
                    first = self._open(1)
                    self._place(size, rest, first, rest, 0)
                    self._add_room(self.limit - rest * size, first, 1)
                break
            room = self.rooms[0]
            each = room // size
            at, held = self.room[room].pop()
            if not self.room[room]:
                heapq.heappop(self.rooms)
            if n >= each:
                took = min(held, n // each)
                self._place(size, took * each, at, each, self.limit - room)
                self._add_room(room - each * size, at, took)
                n -= took * each
            else:
                took = 1
                self._place(size, n, at, n, self.limit - room)
                self._add_room(room - n * size, at, 1)
                n = 0
            self._add_room(room, at + took, held - took)
        for room in small:
            if self.room[room]:
                heapq.heappush(self.rooms, room)

    def arrays(self) -> list[np.ndarray]:
        """length, first number, first sequence, per sequence, offset, sorted by length and first number."""
        got = np.array(sorted(self.rows), np.int64).reshape(-1, 6)
        return [np.ascontiguousarray(got[:, c]) for c in (0, 1, 3, 4, 5)]


def plan_of(counts: dict[int, int], limit: int, groupings: tuple[int, ...] = GROUPINGS) -> Plan:
    """The plan with the fewest sequences among those of the given numbers of groups."""
    return min((Plan(counts, limit, g) for g in groupings), key=lambda p: p.sequences)


# -- the operator ---------------------------------------------------------------------

def _placed(rows: DataFrame, plan, columns: list[str]) -> DataFrame:
    def place(batches):
        size, first, sequence, each, offset = plan.value
        start = np.searchsorted(size, np.arange(int(size[-1]) + 2)) if len(size) else np.zeros(1, np.int64)
        for batch in batches:
            n = batch.column("length").to_numpy()
            number = batch.column("number").to_numpy()
            out_s, out_o = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64)
            for s in np.unique(n):
                at = np.flatnonzero(n == s)
                lo, hi = start[s], start[s + 1]
                row = lo + np.searchsorted(first[lo:hi], number[at], "right") - 1
                k = number[at] - first[row]
                out_s[at] = sequence[row] + k // each[row]
                out_o[at] = offset[row] + k % each[row] * s
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in columns), pa.array(out_s), pa.array(out_o)], [*columns, "sequence_id", "offset"])

    schema = ", ".join(f"{c} {rows.schema[c].dataType.simpleString()}" for c in columns)
    return rows.mapInArrow(place, f"{schema}, sequence_id long, offset long")


def packed(docs: DataFrame, path: str, limit: int = LIMIT, end: int = END, with_ids: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset for each piece of ``docs`` (doc_id, text); ``with_ids`` adds the ids."""
    spark = docs.sparkSession
    ship(spark)
    rows = written(pieces(docs, path, limit, end, with_ids), "packing-pieces")
    here = rows.groupBy("part", "length").agg(F.count("*").alias("here"))
    before = here.withColumn("before", F.sum("here").over(Window.partitionBy("length").orderBy("part")) - F.col("here"))
    counts = {r.length: r.n for r in here.groupBy("length").agg(F.sum("here").alias("n")).collect()}  # at most `limit` rows
    plan = spark.sparkContext.broadcast(plan_of(counts, limit).arrays())
    rows = rows.join(before.drop("here"), ["part", "length"]).withColumn("number", F.col("before") + F.col("local"))
    columns = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    return _placed(rows.select(*columns, "number"), plan, columns)
