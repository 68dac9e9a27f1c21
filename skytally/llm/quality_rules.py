"""Quality rules with perplexity bands of a character n-gram model.

The model is an interpolated modified Kneser-Ney model of order 3 over characters: the
code points of Unicode, and a mark that ends each text.  So a trigram spans three characters
of any script (three bytes hold one Chinese character, or one and a half Cyrillic ones), and the
model grows with the corpus.  A trigram is three symbols of 21 bits in one number, so none are mixed up.

1. Spark counts the trigrams of all distinct texts (copies meet by their SHA-256
   and count once; each task adds up sorted arrays of bounded size, and the sums meet by trigram).
2. Spark smooths the counts: contexts, lower orders and probabilities are tables joined by code, nothing but the counts
   of counts reaches the driver.  The log-probabilities are kept as sorted arrays in raw files, handed to
   every machine with ``addFile`` and memory-mapped there by the workers.  There are two models, of the texts whose
   digest is even and odd; a text is scored by the one that has not counted it, as rare
   characters would else be known from the very text, with back-off where a trigram is unknown.
3. Each document gets its perplexity per character (the end mark counts); documents outside the lower or
   upper band of their language are rejected.  Bands come from the quartiles
   of log-perplexity of the distinct texts of the language that pass the base rules, so
   that copies do not move them: ``[q1 - LOWER * iqr, q3 + UPPER * iqr]``, with ``iqr`` at
   least ``LEAST_IQR``.  Junk lies above (1.5 is Tukey's fence); the thin lower tail is mostly sound text, hence the wider bound.

Edge cases: null or empty text has no words and fails the base rules; null
language is a language of its own; repeated rows and copies of a text count once
(once per language for the bands) and come out as often as they occur; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir
from .kneser_ney import counts_of_counts, discount_of, discounts
from .lm_scores import hand_out, summed
from .shared import IS_SPACE, buffer_of, combine, hash_spans, local_path, mix, parts, prefix_sums, ship, slices, word_spans, written

SYMBOL_BITS = 21
SYMBOL = (1 << SYMBOL_BITS) - 1
PAIR = (1 << 2 * SYMBOL_BITS) - 1
END = 1           # 0 marks the start; a character's symbol is its code point plus 2
FOLDS = 2
FLUSH = 1 << 20
FILE_CODES = 1 << 21  # trigrams in a file, about
BITS = 7          # of the symbols of a model in memory
CLASSES = 1 << BITS
LOWER, UPPER = 2.5, 1.5
LEAST_IQR = 0.02
SEEN = 1 << 16
PART_BYTES = 64 << 20
SYMBOLS = b"#*$%&|<>"


def symbols(buf: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols of all texts, one after another with an end mark after each that is not empty, and where those of each begin."""
    data, lead = buf.tobytes(), (buf & 0xC0) != 0x80
    try:
        if not lead[offs[:-1][offs[1:] > offs[:-1]]].all():
            raise UnicodeError
        chars = np.frombuffer(data.decode().encode("utf-32-le"), "<u4")
        at = np.append(0, np.cumsum(lead))[offs]
    except UnicodeError:  # bytes that are no UTF-8 stand for themselves
        each = [data[a:b].decode(errors="surrogateescape") for a, b in zip(offs[:-1].tolist(), offs[1:].tolist())]
        chars = np.frombuffer("".join(each).encode("utf-32-le", "surrogatepass"), "<u4")
        at = np.append(0, np.cumsum([len(x) for x in each], dtype=np.int64))
    n = np.diff(at)
    ends = np.append(0, np.cumsum(n > 0))  # end marks before each text
    out = np.full(len(chars) + ends[-1], END, np.int64)
    out[np.arange(len(chars)) + np.repeat(ends[:-1], n)] = chars.astype(np.int64) + 2
    return out, at + ends


def trigrams(sym: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Code of the trigram that ends at each symbol; two start marks precede a text."""
    code = sym.copy()
    code[1:] |= sym[:-1] << SYMBOL_BITS
    code[2:] |= sym[:-2] << 2 * SYMBOL_BITS
    first = at[:-1][at[1:] > at[:-1]]
    code[first] = sym[first]
    code[first + 1] = sym[first + 1] | sym[first] << SYMBOL_BITS  # a text has two symbols at least
    return code


def trigram_codes(buf: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """The trigrams of all texts, those with the end marks too."""
    return trigrams(*symbols(buf, offs))


class Model:
    """The same smoothing in memory, over ``2**bits`` symbols, with back-off weights for trigrams that were not counted."""

    def __init__(self, codes: np.ndarray, counts: np.ndarray, bits: int = BITS):
        self.bits, self.symbols = bits, 1 << bits
        codes = codes.astype(np.int64)
        ctx, low = codes >> bits, codes & (self.symbols ** 2 - 1)
        uni, log_bi, back_bi, bi_codes = self.lower(codes, low)
        d = discounts(*counts_of_counts(counts))
        total = np.bincount(ctx, counts, self.symbols ** 2)
        taken = np.bincount(ctx, discount_of(counts, d), self.symbols ** 2)
        seen = np.flatnonzero(total)
        p_low = np.exp(log_bi[np.searchsorted(bi_codes, low)]) if len(codes) else np.zeros(0)
        p = (counts - discount_of(counts, d)) / total[ctx] + taken[ctx] / total[ctx] * p_low if len(codes) else np.zeros(0)
        self.tables = {"tri": self.table(codes, np.log(p)), "back2": self.table(seen, np.log(taken[seen] / total[seen])),
                       "bi": self.table(bi_codes, log_bi), "back1": self.table(*back_bi)}
        self.uni = uni
        self.memo = None

    def lower(self, codes, low):
        bi_codes, a = np.unique(low, return_counts=True)  # in how many contexts the bigram was seen
        uni_codes, u = np.unique(bi_codes & (self.symbols - 1), return_counts=True)
        du = discounts(*counts_of_counts(u))
        p_uni = np.full(self.symbols, 1 / self.symbols)
        if len(u):
            p_uni *= discount_of(u, du).sum() / u.sum()
            p_uni[uni_codes] += (u - discount_of(u, du)) / u.sum()
        d = discounts(*counts_of_counts(a))
        ctx = bi_codes >> self.bits
        total, taken = np.bincount(ctx, a, self.symbols), np.bincount(ctx, discount_of(a, d), self.symbols)
        seen = np.flatnonzero(total)
        p = (a - discount_of(a, d)) / total[ctx] + taken[ctx] / total[ctx] * p_uni[bi_codes & (self.symbols - 1)] if len(a) else np.zeros(0)
        return np.log(p_uni), np.log(p), (seen, np.log(taken[seen] / total[seen])), bi_codes

    @staticmethod
    def table(codes, values) -> tuple[np.ndarray, np.ndarray]:
        h = mix(np.asarray(codes).astype(np.uint64))
        order = np.argsort(h)
        return h[order], np.asarray(values, np.float64).astype(np.float32)[order]

    def find(self, name: str, codes: np.ndarray, missing: float) -> np.ndarray:
        keys, values = self.tables[name]
        if not len(keys):
            return np.full(len(codes), missing)
        h = mix(codes.astype(np.uint64))
        i = np.minimum(np.searchsorted(keys, h), len(keys) - 1)
        return np.where(keys[i] == h, values[i].astype(np.float64), missing)

    def look_up(self, codes: np.ndarray) -> np.ndarray:
        """Log-probability of each trigram code, backing off where it is unknown."""
        bi = codes & (self.symbols ** 2 - 1)
        p2 = self.find("bi", bi, np.nan)
        p2 = np.where(np.isnan(p2), self.find("back1", bi >> self.bits, 0.0) + self.uni[bi & (self.symbols - 1)], p2)
        p3 = self.find("tri", codes, np.nan)
        return np.where(np.isnan(p3), self.find("back2", codes >> self.bits, 0.0) + p2, p3)

    def log_probs(self, codes: np.ndarray) -> np.ndarray:
        if self.memo is None:
            self.memo = np.zeros(1 << 3 * self.bits, np.float32)  # 0: not looked up yet; pages are taken as they are written
        got = self.memo[codes]
        unknown = got == 0
        if unknown.any():
            new = np.unique(codes[unknown])
            self.memo[new] = self.look_up(new.astype(np.int64))
            got = self.memo[codes]
        return got


def first_of_each(batch: pa.RecordBatch, seen: set) -> pa.RecordBatch:
    """The rows whose digest is not in ``seen``, which takes them up."""
    new = []
    for k, d in enumerate(batch.column("digest").to_pylist()):
        if d not in seen:
            seen.add(d)
            new.append(k)
    return batch if len(new) == len(batch) else batch.take(pa.array(new, pa.int64()))


def distinct_texts(docs: DataFrame) -> DataFrame:
    """digest and text of ``docs``: copies lie in one partition, where a hot text has only a few rows of each task."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0

    def once(batches):
        seen = set()
        for batch in batches:
            if len(seen) > SEEN:
                seen.clear()
            yield first_of_each(batch, seen)

    return docs.where("octet_length(text) > 0").select("digest", "text").mapInArrow(once, "digest binary, text string").repartition(
        max(parts(docs.sparkSession), size // PART_BYTES), "digest")


def folds_of(piece: pa.RecordBatch) -> np.ndarray:
    """Of each text, from its digest; 0 where there is none."""
    return np.array([d[0] % FOLDS if d else 0 for d in piece.column("digest").to_pylist()], np.int64)


def counted(docs: DataFrame) -> DataFrame:
    """fold, code, n: how often the distinct texts of each fold have each trigram."""
    def count(batches):
        held, size, seen = [[] for _ in range(FOLDS)], 0, set()

        def emit():
            for fold, some in enumerate(held):
                if some:
                    codes, n = summed(*(np.concatenate(x) for x in zip(*some)))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), fold)), pa.array(codes), pa.array(n)], ["fold", "code", "n"])

        for batch in batches:
            if len(seen) > SEEN:
                seen.clear()
            for piece, raw in slices(first_of_each(batch, seen)):
                own = folds_of(piece)
                for fold in range(FOLDS):
                    buf, offs = buffer_of(raw.filter(pa.array(own == fold)))
                    if len(buf):
                        held[fold].append(np.unique(trigram_codes(buf, offs), return_counts=True))
                        size += len(held[fold][-1][0])
                if size > FLUSH:
                    yield from emit()
                    held, size = [[] for _ in range(FOLDS)], 0
        yield from emit()

    return distinct_texts(docs).mapInArrow(count, "fold long, code long, n long").groupBy("fold", "code").agg(F.sum("n").alias("n"))


def few(n: str) -> list:
    """Numbers of rows with a count of one, two, and three or more."""
    return [F.count_if(F.col(n) == 1).alias("one"), F.count_if(F.col(n) == 2).alias("two"), F.count_if(F.col(n) > 2).alias("more")]


def discounts_of(df: DataFrame, n: str) -> np.ndarray:
    return discounts(*df.agg(*(F.count_if(F.col(n) == k) for k in (1, 2, 3, 4))).first())


def cut(n: str, d: np.ndarray):
    """A count less its discount."""
    return F.col(n) - F.when(F.col(n) == 1, float(d[1])).when(F.col(n) == 2, float(d[2])).otherwise(float(d[3]))


def mass(d: np.ndarray):
    """What the discounts of a context took."""
    return F.col("one") * float(d[1]) + F.col("two") * float(d[2]) + F.col("more") * float(d[3])


#: Kinds of entries: a trigram's log-probability, the back-off weight of two symbols, a bigram's log-probability, the weight of a symbol, its log-probability.
TRIGRAM, BACK_2, BIGRAM, BACK_1, SINGLE = range(5)


def smoothed(tri: DataFrame) -> tuple[DataFrame, float]:
    """kind, key, value: the interpolated Kneser-Ney model of the counted trigrams (code, n); and the log-probability of an unknown symbol."""
    symbol, low = F.col("pair").bitwiseAND(F.lit(SYMBOL)), F.col("code").bitwiseAND(F.lit(PAIR))
    pairs = written(tri.groupBy(low.alias("pair")).agg(F.count("*").alias("a")), "quality-pairs", free=True)  # in how many contexts the bigram was seen
    single = written(pairs.groupBy(symbol.alias("symbol")).agg(F.count("*").alias("u")), "quality-symbols", free=True)
    d3, d2, d1 = discounts_of(tri, "n"), discounts_of(pairs, "a"), discounts_of(single, "u")
    total, kinds, *seen = single.agg(F.sum("u"), F.count("*"), *few("u")).first()
    rest = (float(np.dot(d1[1:], seen)) / total if total else 1.0) / (kinds + 1)
    p1 = single.select("symbol", (cut("u", d1) / F.lit(float(total or 1)) + rest).alias("p1"))
    first = F.shiftright("pair", SYMBOL_BITS)
    c1 = pairs.groupBy(first.alias("context")).agg(F.sum("a").alias("sum"), *few("a")).select("context", "sum", (mass(d2) / F.col("sum")).alias("back"))
    p2 = (pairs.select("pair", "a", first.alias("context"), symbol.alias("symbol")).join(c1, "context").join(p1, "symbol")
          .select("pair", (cut("a", d2) / F.col("sum") + F.col("back") * F.col("p1")).alias("p2")))
    two = F.shiftright("code", SYMBOL_BITS)
    c2 = tri.groupBy(two.alias("context")).agg(F.sum("n").alias("sum"), *few("n")).select("context", "sum", (mass(d3) / F.col("sum")).alias("back"))
    p3 = (tri.select("code", "n", two.alias("context"), low.alias("pair")).join(c2, "context").join(p2, "pair")
          .select("code", (cut("n", d3) / F.col("sum") + F.col("back") * F.col("p2")).alias("p3")))
    out = None
    for kind, df, key, value in ((TRIGRAM, p3, "code", "p3"), (BACK_2, c2, "context", "back"), (BIGRAM, p2, "pair", "p2"), (BACK_1, c1, "context", "back"), (SINGLE, p1, "symbol", "p1")):
        rows = df.select(F.lit(kind).alias("kind"), F.col(key).alias("key"), F.log(value).cast("float").alias("value"))
        out = rows if out is None else out.unionByName(rows)
    return out, float(np.log(rest))


def train(docs: DataFrame) -> list[tuple[list[str], int, float]]:
    """Count, smooth and hand out the models; of the one that scores each fold: the names of its files, how many a kind has, the unknown symbol."""
    spark = docs.sparkSession
    tri = written(counted(docs), "quality-trigrams", free=True)

    def make(t: pa.Table) -> pa.Table:
        t = t.sort_by("key")
        head = np.array([t.column("file")[0].as_py(), len(t)], "<i8")
        return pa.table({"raw": pa.array([head.tobytes() + t.column("key").to_numpy().astype("<i8").tobytes() + t.column("value").to_numpy().astype("<f4").tobytes()], pa.binary())})

    models = []
    for fold in range(FOLDS):
        others = tri.where(F.col("fold") != fold).select("code", "n")
        files = max(1, others.count() // FILE_CODES) | 1
        folder = scratch_dir(spark, "quality-model")
        rows, unknown = smoothed(others)
        # The text writer puts the bytes of a string out as they are; a file per row, named by the task.
        rows.withColumn("file", F.col("kind") * F.lit(files).cast("long") + F.pmod("key", F.lit(files).cast("long"))).groupBy("file").applyInArrow(
            make, "raw binary").select(F.col("raw").cast("string")).write.option("maxRecordsPerFile", 1).text(folder)
        models.append((hand_out(spark, folder), files, unknown))
    return models


class LogProbabilities:
    """A memory-mapped model."""

    def __init__(self, names: list[str], files: int, unknown: float):
        self.files, self.unknown, self.arrays = files, unknown, {}
        for n in names:
            path = local_path(n)
            head = np.fromfile(path, "<i8", 2).tolist()
            if len(head) == 2:  # the writer makes an empty file where there are no rows
                self.arrays[head[0]] = np.memmap(path, "<i8", "r", 16, (head[1],)), np.memmap(path, "<f4", "r", 16 + 8 * head[1], (head[1],))

    def find(self, kind: int, keys: np.ndarray, missing: float = np.nan) -> np.ndarray:
        out, home = np.full(len(keys), missing), keys % self.files
        for f in np.unique(home).tolist():
            if kind * self.files + f in self.arrays:
                own = np.flatnonzero(home == f)
                known, values = self.arrays[kind * self.files + f]
                at = np.minimum(np.searchsorted(known, keys[own]), len(known) - 1)
                hit = known[at] == keys[own]
                out[own[hit]] = values[at[hit]]
        return out

    def look_up(self, codes: np.ndarray) -> np.ndarray:
        """Log-probability of each trigram, backing off where it was not counted."""
        distinct, inverse = np.unique(codes, return_inverse=True)
        p3 = self.find(TRIGRAM, distinct)
        new = np.flatnonzero(np.isnan(p3))
        pair = distinct[new] & PAIR
        p2 = self.find(BIGRAM, pair)
        rare = np.flatnonzero(np.isnan(p2))
        p2[rare] = self.find(BACK_1, pair[rare] >> SYMBOL_BITS, 0.0) + self.find(SINGLE, pair[rare] & SYMBOL, self.unknown)
        p3[new] = self.find(BACK_2, distinct[new] >> SYMBOL_BITS, 0.0) + p2
        return p3[inverse]


_MODELS: dict[str, list[LogProbabilities]] = {}


def mapped(models: list[tuple[list[str], int, float]]) -> list[LogProbabilities]:
    """The worker's maps of the models; those of another query go."""
    key = "/".join(names[0] for names, _, _ in models)
    if key not in _MODELS:
        _MODELS.clear()
        _MODELS[key] = [LogProbabilities(*m) for m in models]
    return _MODELS[key]


def per_text(flags: np.ndarray, offs: np.ndarray) -> np.ndarray:
    """Sum of a flag per byte over each text."""
    sums = np.zeros(len(flags) + 1, np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[offs[1:]] - sums[offs[:-1]]


def base_measures(buf: np.ndarray, offs: np.ndarray) -> dict[str, np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of each text."""
    n = len(offs) - 1
    in_word = ~IS_SPACE
    start, end, doc = word_spans(buf, offs, in_word)
    out = {"n_words": np.bincount(doc, minlength=n) if len(doc) else np.zeros(n, np.int64)}
    word_byte = in_word[buf]
    out["word_chars"] = per_text(word_byte & ((buf & 0xC0) != 0x80), offs)
    symbol = np.zeros(256, bool)
    symbol[list(SYMBOLS)] = True
    out["n_symbols"] = per_text(symbol[buf], offs)
    sums = prefix_sums(buf)
    # lines: from the start of a text or a newline to the next
    breaks = np.flatnonzero(buf == 10)
    ls = np.sort(np.concatenate([offs[:-1], breaks + 1]))
    ldoc = np.searchsorted(offs, ls, "right") - 1
    stray = np.isin(ls, breaks + 1) & np.isin(ls, offs[1:])  # after a newline that ends a text: an empty line
    le = np.minimum(np.append(ls[1:], len(buf)), offs[np.minimum(ldoc + 1, n)]) if n else ls
    words_before = np.zeros(len(buf) + 1, np.int64)
    np.cumsum(word_byte, out=words_before[1:])
    le = np.where((le > ls) & (buf[np.maximum(le - 1, 0)] == 10), le - 1, le) if len(buf) else le
    has = (le > ls) & ~(stray & (le <= ls))
    has &= words_before[le] > words_before[ls]
    ls, le, ldoc = ls[has], le[has], ldoc[has]
    key = combine(hash_spans(sums, ls, le), ldoc.astype(np.uint64))
    _, first = np.unique(key, return_index=True)
    out["n_dup_lines"] = np.bincount(ldoc, minlength=n) - np.bincount(ldoc[first], minlength=n)
    # three-word windows found twice or more in their text
    repeat = np.zeros(n, np.int64)
    if len(start) >= 3:
        h = hash_spans(sums, start, end)
        inside = doc[2:] == doc[:-2]
        at = np.flatnonzero(inside)
        key = combine(combine(combine(h[at], h[at + 1]), h[at + 2]), doc[at].astype(np.uint64))
        _, inv, cnt = np.unique(key, return_inverse=True, return_counts=True)
        twice = at[cnt[inv] > 1]
        mark = np.zeros(len(start), bool)
        for k in range(3):
            mark[twice + k] = True
        repeat = np.bincount(doc[mark], minlength=n)
    out["n_repeat_words"] = repeat
    return out


MEASURES = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measured(docs: DataFrame, models: list[tuple[list[str], int, float]]) -> DataFrame:
    """doc_id, lang, digest, the base measures, base_failed and log_perplexity (null for empty texts)."""
    def run(batches) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece, raw in slices(batch):
                buf, offs = buffer_of(raw)
                m = base_measures(buf, offs)
                sym, at = symbols(buf, offs)
                sums = np.zeros(len(sym) + 1)
                if len(sym):
                    codes, fold = trigrams(sym, at), np.repeat(folds_of(piece), np.diff(at))
                    p = np.zeros(len(codes))
                    for f, model in enumerate(mapped(models)):
                        p[fold == f] = model.look_up(codes[fold == f])
                    np.cumsum(p, out=sums[1:])
                size = at[1:] - at[:-1]
                lp = -(sums[at[1:]] - sums[at[:-1]]) / np.maximum(size, 1)
                failed = (m["n_words"] < 50) | (100 * m["n_repeat_words"] > 50 * m["n_words"])
                yield pa.RecordBatch.from_arrays(
                    [piece.column("doc_id"), piece.column("lang"), piece.column("digest"), *(pa.array(m[k], pa.int64()) for k in MEASURES),
                     pa.array(failed), pa.array(lp, pa.float64(), mask=size == 0)],
                    ["doc_id", "lang", "digest", *MEASURES, "base_failed", "log_perplexity"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "lang", "digest", "text").mapInArrow(
        run, f"doc_id {kind}, lang string, digest binary, {', '.join(f'{k} long' for k in MEASURES)}, base_failed boolean, log_perplexity double")


def bands(scored: DataFrame, lower: float = LOWER, upper: float = UPPER) -> DataFrame:
    """lang, low, high: the bounds of log-perplexity per language, from its distinct texts."""
    texts = scored.where("NOT base_failed").groupBy("lang", "digest").agg(F.max("log_perplexity").alias("log_perplexity"))
    q = texts.groupBy("lang").agg(F.percentile_approx("log_perplexity", [0.25, 0.75], 10000).alias("q"))
    iqr = F.greatest(F.col("q")[1] - F.col("q")[0], F.lit(LEAST_IQR))
    return q.select("lang", (F.col("q")[0] - lower * iqr).alias("low"), (F.col("q")[1] + upper * iqr).alias("high"))


def quality_rules(docs: DataFrame, lower: float = LOWER, upper: float = UPPER) -> DataFrame:
    """Measures, perplexity, base_failed and kept for every row of ``docs`` (doc_id, text, lang)."""
    ship(docs.sparkSession)
    digest = F.unhex(F.sha2(F.col("text").cast("binary"), 256))
    docs = docs.select("doc_id", "text", F.col("lang").cast("string").alias("lang"), digest.alias("digest"))
    scored = written(measured(docs, train(docs)), "quality-rules")
    b = bands(scored, lower, upper).withColumnRenamed("lang", "band_lang")
    inside = F.col("log_perplexity").between(F.col("low"), F.col("high"))
    return scored.join(b, F.col("lang").eqNullSafe(F.col("band_lang")), "left").select(
        "doc_id", *MEASURES, "base_failed", (~F.col("base_failed") & F.coalesce(inside, F.lit(False))).alias("kept"),
        F.exp("log_perplexity").alias("perplexity"))
