"""Token counts by a map-side two-tier lookup (no shuffle of pre-tokens).

A sentencepiece BPE model whose pieces hold the space mark only at their front
and never hold a newline cannot merge across such places, so a text's token
count is the sum over its *pre-tokens* (a run of space marks with the
following run of other characters; newlines stand alone).

* Tier 1: the most frequent pre-tokens with their lengths, broadcast as one
  packed string and one byte array (``TABLE_SIZE`` entries of at most
  ``LONGEST`` characters, a fixed bound).  They are found over all documents:
  every task keeps a bounded frequency summary (entries under the running
  error bound are dropped, the rest are kept as in Misra and Gries) and hands
  out ``SUMMARY_SIZE`` rows, which Spark adds up.  The table only saves work;
  a pre-token that is missing from it is counted all the same.
* Tier 2: misses are encoded by the library and kept in a cache per worker,
  which is emptied when it holds ``CACHE_SIZE`` entries.

Edge cases: null or empty text has 0 tokens and 0 bytes; repeated rows and
null ids are kept, one row out per row in; an empty table gives no rows; other
columns are ignored.  A model without the property above (a piece with an
inner space mark or a newline) has its texts encoded whole.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import ship, slices

MARK = "▁"
LONGEST = 64
TABLE_SIZE = 1 << 16
SUMMARY_SIZE = 4096
CACHE_SIZE = 1 << 19
PRE_TOKEN = re.compile(f"{MARK}*[^{MARK}\n]+|{MARK}+|\n")
_MODELS: dict[str, tuple] = {}


def load(path: str):
    """(library model that adds no leading mark, whether texts may be split)."""
    if path not in _MODELS:
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2 as pb

        proto = pb.ModelProto()
        with open(path, "rb") as f:
            proto.ParseFromString(f.read())
        spec = proto.normalizer_spec
        lone = re.compile(f"[^{MARK}]{MARK}|\n")
        splits = (spec.name == "identity" and spec.add_dummy_prefix and spec.escape_whitespaces
                  and not spec.remove_extra_whitespaces and not proto.trainer_spec.treat_whitespace_as_suffix
                  and not any(lone.search(p.piece) for p in proto.pieces))
        if splits:
            spec.add_dummy_prefix = False
        _MODELS[path] = sentencepiece.SentencePieceProcessor(model_proto=proto.SerializeToString()), splits
    return _MODELS[path]


def pre_tokens(text: str) -> list[str]:
    return PRE_TOKEN.findall(MARK + text.replace(" ", MARK)) if text else []


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[pa.RecordBatch, list[str], list[int]]]:
    for piece, raw in slices(batch):
        got = raw.to_pylist()
        yield piece, [x.decode("utf-8", "replace") for x in got], [len(x) for x in got]


class Summary:
    """The frequent items of a stream, in bounded memory; counts are lower bounds."""

    def __init__(self, size: int):
        self.size, self.counts = size, Counter()

    def add(self, items) -> None:
        self.counts.update(items)
        if len(self.counts) > 64 * self.size:
            cut = sorted(self.counts.values(), reverse=True)[8 * self.size]
            self.counts = Counter({k: v - cut for k, v in self.counts.items() if v > cut})

    def top(self) -> list[tuple[str, int]]:
        return self.counts.most_common(self.size)


def frequent_pre_tokens(docs: DataFrame, size: int = TABLE_SIZE) -> list[str]:
    """At most ``size`` pre-tokens with the largest summed counts, most frequent first."""
    def count(batches):
        s = Summary(SUMMARY_SIZE)
        for batch in batches:
            for _, texts, _ in _texts(batch):
                for t in texts:
                    s.add(x for x in pre_tokens(t) if len(x) <= LONGEST)
        got = s.top()
        yield pa.RecordBatch.from_arrays([pa.array([k for k, _ in got], pa.string()),
                                          pa.array([n for _, n in got], pa.int64())], ["item", "n"])

    rows = (docs.select("text").mapInArrow(count, "item string, n long")
            .groupBy("item").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "item").limit(size))
    return [r.item for r in rows.collect()]


class Lengths(dict):
    """Pre-token -> number of tokens; encodes and keeps what it doesn't know."""

    def __init__(self, model, frequent: dict[str, int]):
        super().__init__(frequent)
        self.model, self.frequent = model, frequent

    def __missing__(self, item: str) -> int:
        n = len(self.model.encode(item))
        if len(item) <= LONGEST:
            if len(self) >= CACHE_SIZE:
                self.clear()
                self.update(self.frequent)
            self[item] = n
        return n


def pack(items: list[str], model) -> tuple[str, bytes]:
    """The table to broadcast: items joined by NUL (which none holds), and their lengths."""
    items = [x for x in items if "\0" not in x]
    return "\0".join(items), np.array([len(model.encode(x)) for x in items], np.uint16).tobytes()


_TABLES: dict[tuple, Lengths] = {}


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of ``docs`` (doc_id, text)."""
    spark = docs.sparkSession
    ship(spark)
    model, splits = load(model_path)
    shared = spark.sparkContext.broadcast(pack(frequent_pre_tokens(docs) if splits else [], model))

    def count(batches):
        model, splits = load(model_path)
        key = (model_path, hash(shared.value))
        if key not in _TABLES:
            joined, lens = shared.value
            _TABLES.clear()
            _TABLES[key] = Lengths(model, dict(zip(joined.split("\0") if joined else [], np.frombuffer(lens, np.uint16).tolist())))
        known = _TABLES[key].__getitem__
        for batch in batches:
            for piece, texts, sizes in _texts(batch):
                n = [sum(map(known, pre_tokens(t))) if splits else len(model.encode(t)) for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(n, pa.int64()),
                     pa.array([x > limit for x in n], pa.bool_())], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {kind}, n_bytes long, n_tokens long, over_limit boolean")
