"""Quality classifier by attention-based multiple-instance learning (Ilse et al., 2018).

A document is a bag of passages: consecutive runs of ``PASSAGE`` words that
cover the whole text.  Every passage is described by shares of byte classes
and by word statistics (lengths, repeats), encoded to a vector, and weighted
by gated attention ``softmax(w . (tanh(V h) * sigmoid(U h)))``.  The weighted sum is
classified.  All weights are learned from document labels alone, in numpy, on
a bounded sample (``per_class`` documents of each class; their passages are
collected, which bounds the driver).  Scoring runs in Spark tasks over all rows.

Edge cases: a text without words is one passage of zeros; null text counts as
empty.  With no labelled rows, or one class only, all scores are that class's
share (0.5 with none).  Repeated rows get equal scores; an empty table gives no
rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .learning import Adam, held_out, labelled_sample, sigmoid
from .shared import IS_SPACE, LOWER, buffer_of, hash_spans, combine, prefix_sums, ship, slices, word_spans

PASSAGE = 64
HIDDEN = 16
ATTENTION = 8
PER_CLASS = 4096
EPOCHS = 30
LEARNED_PASSAGES = 128
#: Shares of bytes: (name, bytes).
CLASSES = [b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz", b"0123456789", b".", b",", b"!", b"?", b"#", b"*", b"$", b"%", b"&",
           b"|", b"<>", b"{}[]()", b"@_/\\^~`=+", b"\"'", b":;-", b"\n", bytes(range(128, 256))]
FEATURES = len(CLASSES) + 8


def class_of() -> np.ndarray:
    out = np.full(256, len(CLASSES))
    for i, c in enumerate(CLASSES):
        out[list(c)] = i
    return out


CLASS = class_of()


def passages(raw: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Features of all passages and the text each belongs to (each text has one at least)."""
    buf, offs = buffer_of(raw)
    n = len(offs) - 1
    start, end, doc = word_spans(buf, offs, ~IS_SPACE)
    if not len(start):
        return np.zeros((n, FEATURES), np.float32), np.arange(n)
    per_doc = np.bincount(doc, minlength=n)
    rank = np.arange(len(doc)) - np.repeat(np.cumsum(per_doc) - per_doc, per_doc)
    head = rank % PASSAGE == 0
    number = np.cumsum(head) - 1  # passage of each word
    first = np.flatnonzero(head)
    owner = doc[first]
    size = np.bincount(number)
    # bytes of a passage: from its first word to the next passage or the end of the text
    a = start[first]
    b = np.minimum(np.append(a[1:], len(buf)), offs[owner + 1])
    out = np.zeros((len(first), FEATURES), np.float32)
    span = np.maximum(b - a, 1)
    mark = np.repeat(np.arange(len(first)), b - a)
    inside = np.arange(len(mark)) - np.repeat(np.cumsum(b - a) - (b - a), b - a) + np.repeat(a, b - a)
    hist = np.bincount(mark * (len(CLASSES) + 1) + CLASS[buf[inside]], minlength=len(first) * (len(CLASSES) + 1)).reshape(len(first), -1)
    out[:, :len(CLASSES)] = np.sqrt(hist[:, :-1] / span[:, None])
    length = end - start
    h = hash_spans(prefix_sums(LOWER[buf]), start, end)
    mean = np.bincount(number, length) / size
    same = np.append(False, (h[1:] == h[:-1]) & ~head[1:])
    # distinct words of a passage: count distinct (passage, word)
    _, at = np.unique(combine(number.astype(np.uint64), h), return_index=True)
    distinct = np.bincount(number[at], minlength=len(first))
    lead = buf[start]
    tail = buf[end - 1]
    alpha = ((LOWER[tail] >= 97) & (LOWER[tail] <= 122)) | (tail >= 128)
    upper = (lead >= 65) & (lead <= 90) & (tail >= 65) & (tail <= 90)
    more = [np.log(mean) / 3, np.bincount(number, length > 14) / size, np.bincount(number, length < 2) / size, np.bincount(number, same) / size,
            distinct / size, np.log(size) / 4, np.bincount(number, ~alpha) / size, np.bincount(number, upper) / size]
    for i, x in enumerate(more):
        out[:, len(CLASSES) + i] = x
    empty = np.flatnonzero(per_doc == 0)
    if len(empty):
        out = np.vstack([out, np.zeros((len(empty), FEATURES), np.float32)])
        owner = np.concatenate([owner, empty])
        order = np.argsort(owner, kind="stable")
        out, owner = out[order], owner[order]
    return out, owner


def starts_of(owner: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))


class Classifier:
    """Encoder, gated attention and output layer."""

    def __init__(self, seed: int = 7):
        r = np.random.default_rng(seed)
        init = lambda a, b: r.normal(0, 1 / np.sqrt(a), (a, b))
        self.p = {"W": init(FEATURES, HIDDEN), "b": np.zeros(HIDDEN), "V": init(HIDDEN, ATTENTION), "U": init(HIDDEN, ATTENTION),
                  "w": r.normal(0, 0.1, ATTENTION), "c": r.normal(0, 0.1, HIDDEN), "d": np.zeros(1)}
        self.mean, self.scale = np.zeros(FEATURES), np.ones(FEATURES)
        self.constant = None

    def forward(self, x: np.ndarray, at: np.ndarray):
        """Logits of the bags whose passages begin at rows ``at`` of ``x``; and what backward needs."""
        p, size = self.p, np.diff(np.append(at, len(x)))
        x = (x - self.mean) / self.scale
        h = np.tanh(x @ p["W"] + p["b"])
        t, g = np.tanh(h @ p["V"]), sigmoid(h @ p["U"])
        s = (t * g) @ p["w"]
        e = np.exp(s - np.repeat(np.maximum.reduceat(s, at), size))
        a = e / np.repeat(np.add.reduceat(e, at), size)
        z = np.add.reduceat(a[:, None] * h, at)
        return z @ p["c"] + p["d"][0], (x, h, t, g, a, z, size)

    def gradients(self, at: np.ndarray, saved, dlogit: np.ndarray) -> dict[str, np.ndarray]:
        p, (x, h, t, g, a, z, size) = self.p, saved
        dz = np.repeat(dlogit[:, None] * p["c"], size, 0)
        da = (dz * h).sum(1)
        ds = a * (da - np.repeat(np.add.reduceat(a * da, at), size))
        dt, dg = ds[:, None] * p["w"] * g * (1 - t * t), ds[:, None] * p["w"] * t * g * (1 - g)
        dh = a[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T
        dx = dh * (1 - h * h)
        return {"W": x.T @ dx, "b": dx.sum(0), "V": h.T @ dt, "U": h.T @ dg, "w": (t * g).T @ ds, "c": z.T @ dlogit, "d": np.array([dlogit.sum()])}

    def fit(self, bags: list[np.ndarray], y: np.ndarray, epochs: int = EPOCHS, batch: int = 64, seed: int = 7) -> Classifier:
        if not len(y) or y.min() == y.max():
            self.constant = float(y[0]) if len(y) else 0.5
            return self
        every = np.concatenate(bags)
        self.mean, self.scale = every.mean(0), every.std(0) + 1e-3
        weight = np.where(y == 1, 1.0, np.sqrt((y == 1).sum() / (y == 0).sum()))
        r, opt = np.random.default_rng(seed), Adam(self.p)
        steps = max(1, 1500 // max(1, len(y) // batch))
        for _ in range(max(epochs, min(steps, 200))):
            order = r.permutation(len(y))
            for k in range(0, len(y), batch):
                own = order[k:k + batch]
                at = np.concatenate([[0], np.cumsum([len(bags[i]) for i in own])[:-1]])
                logit, saved = self.forward(np.concatenate([bags[i] for i in own]), at)
                opt.step(self.gradients(at, saved, weight[own] * (sigmoid(logit) - y[own]) / len(own)))
        return self

    def scores(self, x: np.ndarray, owner: np.ndarray) -> np.ndarray:
        at = starts_of(owner)
        if self.constant is not None:
            return np.full(len(at), self.constant)
        return sigmoid(self.forward(x, at)[0])


def train(docs: DataFrame, labels: DataFrame, column: str = "quality", per_class: int = PER_CLASS, learned_passages: int = LEARNED_PASSAGES) -> Classifier:
    """Collect the passages of a bounded labelled sample and fit the classifier.

    At most ``per_class`` documents of each class and ``learned_passages`` evenly spaced passages of each are
    learned from, so what reaches the driver is bounded; scoring uses all passages.
    """
    def bags(batches):
        for batch in batches:
            for piece, raw in slices(batch):
                x, owner = passages(raw)
                rows = np.split(x, starts_of(owner)[1:]) if len(owner) else []
                rows = [v[np.unique(np.linspace(0, len(v) - 1, learned_passages).astype(np.int64))] if len(v) > learned_passages else v for v in rows]
                yield pa.RecordBatch.from_arrays([piece.column("doc_id").cast(pa.string()), piece.column("y"), pa.array([v.astype("<f4").tobytes() for v in rows], pa.binary())], ["doc_id", "y", "x"])

    rows = labelled_sample(docs, labels, column, per_class).mapInArrow(bags, "doc_id string, y int, x binary").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))  # the same order on every run
    return Classifier().fit([np.frombuffer(r["x"], "<f4").reshape(-1, FEATURES).astype(np.float64) for r in rows], np.array([r["y"] for r in rows], np.float64))


def scored(docs: DataFrame, model: Classifier, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted of every row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            for piece, raw in slices(batch):
                s = shared.value.scores(*passages(raw))
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                                 ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")


def accepted(docs: DataFrame, labels: DataFrame, threshold: float = 0.5, per_class: int = PER_CLASS) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the classifier accepts."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class=per_class))

    def run(batches):
        for batch in batches:
            for piece, raw in slices(batch):
                yield piece.filter(pa.array(shared.value.scores(*passages(raw)) >= threshold))

    return docs.mapInArrow(run, docs.schema)


def quality_classifier(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)
    return scored(docs, train(docs, labels, per_class=per_class))
