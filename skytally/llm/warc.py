"""WARC archives: writing with revisit records, and reading by boundary-chain verification.

Writing.  Equal payloads of at least ``REVISIT_BYTES`` bytes are stored once:
the row with the smallest ``page_id`` is the response, the others become
revisit records that carry its id, the payload's digest and its length.
Archives are uncompressed, one file per task, written with the text writer
(a row is a record; the line separator is its last byte), so they reach any
file system that Spark does.

Reading.  Files are split anywhere; the text source cuts them at the magic
string.  Each such place is only a *candidate*: the magic can stand inside a
payload.  Tasks emit a candidate's offset and that of its successor (from
Content-Length).  Records are the candidates that the chain from the file's
start reaches:

1. in each split, pointer jumping gives every candidate its *exit*, the first
   successor beyond the split;
2. between splits, pointer jumping over the few candidates that are exits marks those
   reached from the file's start; a round doubles the length of the jumps;
3. in each split, the chain from its reached entry marks the records.

Payloads are hashed where they are read and never shuffled, but for those that
hold the magic themselves: their pieces are gathered per record.

Edge cases: null html is an empty payload, a null url is left out; null ids
are written as ``null`` and read back as null; rows that tie on the smallest id
and payload are all responses; control characters in a url are
percent-encoded; an empty table gives no archive and no rows; other columns
are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from .shared import dropped, freed_shuffles, ship, written, written_by

MAGIC = b"WARC/1.0\r\n"
END = b"\r\n\r\n"
REVISIT_BYTES = 100
FEW = 100_000  # repeated digests: some 5 MB as written
SLICES = 4


# -- writing ------------------------------------------------------------------------

def repeated(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """digest and first_id of the payloads that occur again, written: Spark knows their size before it joins them."""
    # The first id is found per task before the shuffle.
    firsts = (pages.select("page_id", F.coalesce("html", F.lit("")).alias("html")).where(F.octet_length("html") >= least)
              .select("page_id", F.sha2(F.col("html").cast("binary"), 256).alias("digest"))
              .groupBy("digest").agg(F.min("page_id").alias("first_id"), F.max(F.col("page_id").isNull()).alias("has_null"), F.max("page_id").alias("last_id"))
              .where((F.col("first_id") < F.col("last_id")) | F.col("has_null")).select("digest", "first_id"))
    return written(firsts, "warc-firsts", free=True)


def with_types(pages: DataFrame, firsts: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """page_id, url, html with payload_digest, payload_bytes, record_type and refers_to; ``firsts`` as ``repeated`` gives them."""
    p = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"))
    p = p.withColumn("payload_digest", F.sha2(F.col("html").cast("binary"), 256)).withColumn("payload_bytes", F.octet_length("html").cast("long"))
    again = F.col("first_id").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") > F.col("first_id"))) & (F.col("payload_bytes") >= least)
    return p.join(firsts, F.col("payload_digest") == F.col("digest"), "left").select(
        "page_id", "url", "html", "payload_digest", "payload_bytes", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_id")).alias("refers_to"))


def records(typed: DataFrame) -> DataFrame:
    """One column: the record but for its last byte."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("null"))
    field = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    again = F.col("record_type") == "revisit"
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A"), "[\\x00-\\x1f]", "%00")
    return typed.select(F.concat(
        F.lit(MAGIC.decode()),
        field("WARC-Type", F.col("record_type")),
        field("WARC-Record-ID", F.concat(F.lit("<urn:page:"), text("page_id"), F.lit(">"))),
        F.when(again, F.concat(field("WARC-Refers-To", F.concat(F.lit("<urn:page:"), text("refers_to"), F.lit(">"))),
                               F.lit("WARC-Profile: http://netpreserve.org/warc/1.0/revisit/identical-payload-digest\r\n"))).otherwise(""),
        F.coalesce(field("WARC-Target-URI", clean), F.lit("")),
        F.lit("WARC-Date: 1970-01-01T00:00:00Z\r\n"),
        field("WARC-Payload-Digest", F.concat(F.lit("sha256:"), "payload_digest")),
        field("WARC-Payload-Length", F.col("payload_bytes").cast("string")),
        F.lit("Content-Type: text/html\r\n"),
        field("Content-Length", F.when(again, F.lit("0")).otherwise(F.col("payload_bytes").cast("string"))),
        F.lit("\r\n"), F.when(again, "").otherwise(F.col("html")), F.lit("\r\n\r")).alias("value"))


def write_warc(pages: DataFrame, path: str, least: int = REVISIT_BYTES) -> None:
    """Write all pages as archives.

    While the repeated digests are few, Spark broadcasts them and payloads stay where they
    are.  Many are joined by a shuffle of the payloads, a slice of the digests after
    the other, so that only a slice of them lies beside the archives.
    """
    firsts = repeated(pages, least)
    slices = 1 if firsts.count() <= FEW else SLICES
    typed = with_types(pages, firsts, least)
    with freed_shuffles(pages.sparkSession):
        for k in range(slices):
            here = typed if slices == 1 else typed.where(F.crc32(F.col("payload_digest").cast("binary")) % slices == k)
            records(here).write.mode("append" if k else "errorifexists").option("lineSep", "\n").text(path)


# -- reading --------------------------------------------------------------------------

def parse(head: bytes) -> dict[str, str]:
    """Fields of a record header (lower-case names); empty if a line is not a field."""
    out = {}
    for line in head.split(b"\r\n"):
        name, colon, value = line.partition(b":")
        if not colon:
            return {}
        out[name.decode("utf-8", "replace").strip().lower()] = value.decode("utf-8", "replace").strip()
    return out


def chunks(spark: SparkSession, path: str) -> DataFrame:
    """file, block and the bytes between two magic strings, in file order within a split."""
    raw = spark.read.option("lineSep", MAGIC.decode()).text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.col("value").cast("binary").alias("value"))


CANDIDATE = ("file string, block long, rel long, size long, candidate boolean, succ long, way_out long, inside boolean, "
             "type string, id string, refers string, digest string, bytes long, sha string, content long")


def exits(rel: np.ndarray, succ: np.ndarray, end: int) -> np.ndarray:
    """By pointer jumping: the first successor at or beyond ``end``; -1 where the chain breaks."""
    n = len(rel)
    i = np.searchsorted(rel, succ)
    known = (i < n) & (succ >= 0)
    known[known] = rel[i[known]] == succ[known]
    to = np.where(known, i, np.arange(n))
    while True:
        further = to[to]
        if (further == to).all():
            break
        to = further
    last = succ[to]
    return np.where(last >= end, last, -1)


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """A row per chunk of a split: where it begins in the split, its successor, its exit and header."""
    def run(batches):
        key, rows, at = None, [], 0

        def emit():
            rel = np.array([r["rel"] for r in rows], np.int64)
            succ = np.array([-1 if r["succ"] is None else r["succ"] for r in rows], np.int64)
            for r, e in zip(rows, exits(rel, succ, at - len(MAGIC)).tolist()):
                r["way_out"] = None if e < 0 else e
            return pa.RecordBatch.from_pylist([{"file": key[0], "block": key[1], **r} for r in rows], schema=SCHEMA)

        for batch in batches:
            for file, block, value in zip(*(batch.column(k).to_pylist() for k in range(3))):
                if (file, block) != key:
                    if rows:
                        yield emit()
                    key, rows, at = (file, block), [], 0
                # Offsets are of the magic before the chunk; the chunk of a file's start has none.
                row = {"rel": at - len(MAGIC), "size": len(value), "candidate": not (block == 0 and at == 0), "succ": None, "way_out": None, "inside": False}
                head, gap, _ = value.partition(END) if row["candidate"] else (b"", b"", b"")
                fields = parse(head) if gap else {}
                length = fields.get("content-length", "")
                if length.isascii() and length.isdigit():
                    body = len(head) + len(END)
                    row["succ"] = at + body + int(length) + len(END)
                    row["inside"] = row["succ"] <= at + len(value)
                    row["content"] = int(length)
                    if row["inside"]:
                        row["sha"] = hashlib.sha256(value[body:body + int(length)]).hexdigest()
                    number = fields.get("warc-payload-length", "")
                    row |= {"type": fields.get("warc-type"), "id": fields.get("warc-record-id"), "refers": fields.get("warc-refers-to"),
                            "digest": fields.get("warc-payload-digest"), "bytes": int(number) if number.isdigit() else None}
                rows.append(row)
                at += len(value) + len(MAGIC)
        if rows:
            yield emit()

    return chunks(spark, path).mapInArrow(run, CANDIDATE)


SCHEMA = pa.schema([("file", pa.string()), ("block", pa.int64()), ("rel", pa.int64()), ("size", pa.int64()), ("candidate", pa.bool_()), ("succ", pa.int64()),
                    ("way_out", pa.int64()), ("inside", pa.bool_()), ("type", pa.string()), ("id", pa.string()), ("refers", pa.string()),
                    ("digest", pa.string()), ("bytes", pa.int64()), ("sha", pa.string()), ("content", pa.int64())])


def bases(sizes: DataFrame) -> DataFrame:
    """file, block, base: where the first chunk of a split begins in its file."""
    total = sizes.groupBy("file", "block").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    return total.select("file", "block", F.coalesce(F.sum("bytes").over(before), F.lit(0)).alias("base"))


def reached_entries(heads: DataFrame) -> DataFrame:
    """file, at: candidates that are exits of others and reached from their file's start.

    ``heads``: file, at, to - the candidates that a chain can enter a split by
    (the file's start among them) and their exits.  Rounds of pointer
    jumping; a round doubles the jumps, so their number is the logarithm of the
    splits of the largest file.
    """
    jump = heads.select("file", "at", "to").where(F.col("to").isNotNull())
    jump = jump.join(heads.select("file", F.col("at").alias("to")), ["file", "to"], "left_semi")
    reached = heads.where("at = 0").select("file", "at")
    size = -1
    while True:
        jump, reached = written(jump.select("file", "at", "to"), "warc-jumps", free=True), written(reached, "warc-reached", free=True)
        now = reached.count()
        if now == size or jump.isEmpty():
            return reached
        size = now
        ahead = reached.join(jump, ["file", "at"]).select("file", F.col("to").alias("at"))
        reached = reached.unionByName(ahead).distinct()
        jump = jump.alias("a").join(jump.alias("b"), (F.col("a.file") == F.col("b.file")) & (F.col("a.to") == F.col("b.at"))).select("a.file", "a.at", "b.to")


def mark_chain(t: pa.Table) -> pa.Table:
    """Of the chunks of one split: which are records (reached from the entry), and the end of the record that each belongs to."""
    t = t.sort_by("start")
    start, entry = t.column("start").to_numpy(), t.column("entry")[0].as_py()
    succ = t.column("stop").fill_null(-1).to_numpy()
    ok = t.column("candidate").to_numpy(zero_copy_only=False)
    hit = np.zeros(len(start), bool)
    at = entry
    while at is not None:
        i = int(np.searchsorted(start, at))
        if i >= len(start) or start[i] != at or not ok[i] or succ[i] <= at:
            break
        hit[i] = True
        at = int(succ[i])
    later = t.column("next_entry")[0].as_py()
    own = np.maximum.accumulate(np.where(hit, np.arange(len(start)), -1))
    before = entry if entry is not None else later
    end = [(before if k < 0 else int(succ[k])) for k in own.tolist()]
    return t.append_column("record", pa.array(hit)).append_column("record_end", pa.array(end, pa.int64()))


def verified(spark: SparkSession, path: str) -> DataFrame:
    """All chunks with absolute offsets, marked ``record`` where the chain from the file's start reaches them."""
    c, read = written_by(candidates(spark, path), "warc-candidates")
    c = c.join(bases(c), ["file", "block"])
    a = c.select(*[k for k in c.columns if k not in ("rel", "succ", "way_out", "base")], (F.col("rel") + F.col("base")).alias("start"),
                 (F.col("succ") + F.col("base")).alias("stop"), (F.col("way_out") + F.col("base")).alias("to"))
    a, placed_at = written_by(a, "warc-offsets")
    dropped(spark, read)
    targets = a.where("to IS NOT NULL").select("file", F.col("to").alias("start")).distinct()
    valid = a.where("candidate AND stop IS NOT NULL").select("file", "block", "start", "to")
    heads = valid.join(targets, ["file", "start"], "left_semi").unionByName(valid.where("start = 0")).distinct()
    heads = written(heads.withColumnRenamed("start", "at"), "warc-heads", free=True)
    entries = heads.join(reached_entries(heads), ["file", "at"], "left_semi").groupBy("file", "block").agg(F.min("at").alias("entry"))
    after = Window.partitionBy("file").orderBy("block").rowsBetween(1, Window.unboundedFollowing)
    splits = a.select("file", "block").distinct().join(entries, ["file", "block"], "left").select("file", "block", "entry", F.min("entry").over(after).alias("next_entry"))
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in a.schema)
    marked = written(a.join(splits, ["file", "block"]).groupBy("file", "block").applyInArrow(
        mark_chain, f"{fields}, entry long, next_entry long, record boolean, record_end long"), "warc-records", free=True)
    dropped(spark, placed_at)
    return marked


def assembled(t: pa.Table) -> pa.Table:
    """Digest of a payload whose pieces hold the magic string."""
    t = t.sort_by("start")
    raw = MAGIC.join(t.column("value").to_pylist())
    body = raw.index(END) + len(END)
    n = t.column("content")[0].as_py()
    return pa.table({"file": t.column("file").slice(0, 1), "start": t.column("start").slice(0, 1), "whole": [hashlib.sha256(raw[body:body + n]).hexdigest()]})


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """page_id, payload_bytes, payload_digest, record_type and refers_to of every record of the archives."""
    ship(spark)
    v = verified(spark, path)
    rows = v.where("record")
    spanning = rows.where("NOT inside").select("file", "record_end", "content")
    if not spanning.isEmpty():
        pieces = v.select("file", "start", "record_end").join(spanning, ["file", "record_end"])
        again = chunks(spark, path).mapInArrow(placed, "file string, block long, rel long, size long, value binary")
        base = bases(chunks(spark, path).select("file", "block", F.length("value").alias("size")))
        values = again.join(base, ["file", "block"]).select("file", (F.col("rel") + F.col("base")).alias("start"), "value")
        whole = values.join(pieces, ["file", "start"]).groupBy("file", "record_end").applyInArrow(assembled, "file string, start long, whole string")
        rows = rows.join(whole, ["file", "start"], "left")
    else:
        rows = rows.withColumn("whole", F.lit(None).cast("string"))
    number = lambda c: F.regexp_extract(F.col(c), "^<urn:page:(-?\\d+)>$", 1)
    as_id = lambda c: F.when(number(c) != "", number(c).cast("long"))
    again = F.col("type") == "revisit"
    return rows.select(as_id("id").alias("page_id"), F.when(again, F.col("bytes")).otherwise(F.col("content")).alias("payload_bytes"),
                       F.when(again, F.regexp_replace("digest", "^sha256:", "")).otherwise(F.coalesce("sha", "whole")).alias("payload_digest"),
                       F.col("type").alias("record_type"), F.when(again, as_id("refers")).alias("refers_to"))


def placed(batches):
    """Chunks with their place in the split."""
    key, at = None, 0
    for batch in batches:
        rel = []
        size = [len(v) for v in batch.column(2).to_pylist()]
        for file, block, n in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), size):
            if (file, block) != key:
                key, at = (file, block), 0
            rel.append(at - len(MAGIC))
            at += n + len(MAGIC)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(rel, pa.int64()), pa.array(size, pa.int64()), batch.column(2)],
                                         ["file", "block", "rel", "size", "value"])


def warc_round_trip(pages: DataFrame) -> DataFrame:
    """Write the pages as archives in the shared folder and read them back."""
    spark = pages.sparkSession
    path = scratch_dir(spark, "warc")
    write_warc(pages, path)
    return read_warc(spark, path)
