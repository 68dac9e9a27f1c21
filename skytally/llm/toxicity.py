"""Toxicity by a bidirectional gated recurrent network with attention pooling.

A text is read in overlapping windows of ``WINDOW`` words (a new one every
``STRIDE`` words, to the end of the text); every window is scored and the text's
score is the largest.  Inputs per word:

* word: the log-odds of the whole word between toxic and other documents;
* characters: log-odds of its character n-grams (4 and 5 bytes, word ends
  marked) - largest, second largest, mean and smallest - and whether it has digits
  or capitals, and its length.  Inflected or unseen forms of a toxic
  stem are known by these.

The log-odds are document counts per hash bucket, counted by Spark tasks over a
bounded labelled sample (``per_class`` documents of each class).  In training
each document's own count is left out, so rare words teach nothing by
themselves.  The network (forward and backward GRU, attention pooling, logistic output) is
trained in numpy by back-propagation through time on at most ``TRAIN_WINDOWS``
windows of each sampled document: the most telling ones and an even choice of others;
only the most telling one of a toxic document counts as toxic.

Edge cases: text without words (null included) is one empty window, scored by
the output bias.  Without labelled rows of both classes every score is the share
of the class (0.5 with none).  Repeated rows get equal scores; an empty
table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .learning import Adam, held_out, labelled_sample, sigmoid
from .shared import LOWER, buffer_of, combine, hash_spans, prefix_sums, ship, slices, word_spans, written

WINDOW, STRIDE = 32, 16
BITS = 18
BUCKETS = 1 << BITS
HIDDEN = 8
INPUTS = 8
PER_CLASS = 3000
TRAIN_WINDOWS = 3
EPOCHS = 8
BATCH = 256
IN_WORD = np.zeros(256, bool)
IN_WORD[48:58] = IN_WORD[97:123] = IN_WORD[128:] = True


class Words:
    """The distinct words of a piece and the hash buckets of their character n-grams."""

    def __init__(self, raw: pa.Array):
        own, offs = buffer_of(raw)
        low = LOWER[own]
        self.n = len(offs) - 1
        start, end, self.doc = word_spans(low, offs, IN_WORD)
        marked = np.concatenate([[0, 0], np.where(IN_WORD[low], low, 0), [0, 0]]).astype(np.uint8)
        sums = prefix_sums(marked)
        h = hash_spans(sums, start + 2, end + 2)
        self.keys, first, self.word = np.unique(h, return_index=True, return_inverse=True)
        s, e = start[first], end[first]
        self.bucket = (self.keys >> np.uint64(64 - BITS)).astype(np.int64)
        which, grams = [], []
        for size in (4, 5):
            k = np.maximum(e - s + 2 - size + 1, 0)  # spans inside the word with a mark on either side
            w = np.repeat(np.arange(len(s)), k)
            at = s[w] + 1 + np.arange(len(w)) - np.repeat(np.cumsum(k) - k, k)
            which.append(w)
            grams.append(combine(hash_spans(sums, at, at + size), np.uint64(size)))
        self.which = np.concatenate(which)
        order = np.argsort(self.which, kind="stable")
        self.which = self.which[order]
        self.gram = (np.concatenate(grams)[order] >> np.uint64(64 - BITS)).astype(np.int64) + BUCKETS
        digit = np.append(0, np.cumsum((low >= 48) & (low <= 57)))
        self.plain = np.stack([np.minimum(e - s, 16) / 16, digit[e] > digit[s]], 1) if len(s) else np.zeros((0, 2))
        capital = np.append(0, np.cumsum((own >= 65) & (own <= 90)))
        self.capitals = (capital[end] - capital[start]) / np.maximum(end - start, 1)


def log_odds(pos, neg, n_pos: float, n_neg: float) -> np.ndarray:
    return np.log((pos + 0.5) / (n_pos + 1)) - np.log((neg + 0.5) / (n_neg + 1))


def inputs(w: Words, odds_word: np.ndarray, odds_gram: np.ndarray) -> np.ndarray:
    """Inputs of the distinct words, but for capitals, which belong to the occurrence."""
    out = np.zeros((len(w.keys), INPUTS), np.float32)
    out[:, 0] = odds_word / 4
    count = np.bincount(w.which, minlength=len(w.keys))
    has = np.flatnonzero(count)
    if len(has):
        at = (np.cumsum(count) - count)[has]
        out[has, 1] = np.maximum.reduceat(odds_gram, at) / 4
        out[has, 2] = np.minimum.reduceat(odds_gram, at) / 4
        out[has, 3] = np.add.reduceat(odds_gram, at) / count[has] / 4
        top = odds_gram >= out[w.which, 1] * 4 - 1e-4
        left = np.where(top, -9.0, odds_gram)
        second = np.maximum.reduceat(left, at)
        several = np.add.reduceat(top.astype(np.int64), at) > 1
        out[has, 4] = np.where(several, out[has, 1], np.maximum(second, -4) / 4)
    out[:, 5:7] = w.plain
    return out


def windows_of(doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, length and text of all windows; a text of few or no words has one."""
    count = np.bincount(doc, minlength=n)
    k = np.maximum(1, -(-(count - (WINDOW - STRIDE)) // STRIDE))
    owner = np.repeat(np.arange(n), k)
    rank = np.arange(len(owner)) - np.repeat(np.cumsum(k) - k, k)
    first = (np.cumsum(count) - count)[owner] + rank * STRIDE
    return first, np.minimum(WINDOW, count[owner] - rank * STRIDE), owner


class Network:
    """Two GRUs, attention pooling over their states, logistic output."""

    def __init__(self, seed: int = 3):
        r = np.random.default_rng(seed)
        self.p = {}
        for side in "fb":
            self.p |= {f"W{side}": r.normal(0, 0.5, (INPUTS, 3 * HIDDEN)), f"R{side}": r.normal(0, 0.3, (HIDDEN, 3 * HIDDEN)), f"b{side}": np.zeros(3 * HIDDEN)}
        self.p |= {"A": r.normal(0, 0.3, (2 * HIDDEN, HIDDEN)), "a": r.normal(0, 0.3, HIDDEN), "o": r.normal(0, 0.3, 2 * HIDDEN), "d": np.zeros(1)}
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}
        self.pos = self.neg = None
        self.n_pos = self.n_neg = 0
        self.constant = None

    def gru(self, side: str, gates: np.ndarray, live: np.ndarray, keep: bool):
        """States of one direction; ``gates`` are the inputs times W (windows, steps, 3 * HIDDEN)."""
        n, steps, _ = gates.shape
        order = range(steps) if side == "f" else range(steps - 1, -1, -1)
        r_all = self.p[f"R{side}"]
        h = np.zeros((n, HIDDEN), np.float32)
        states = np.zeros((n, steps, HIDDEN), np.float32)
        saved = {}
        for t in order:
            q = h @ r_all
            zr = sigmoid(gates[:, t, :2 * HIDDEN] + q[:, :2 * HIDDEN])
            z, r = zr[:, :HIDDEN], zr[:, HIDDEN:]
            c = np.tanh(gates[:, t, 2 * HIDDEN:] + r * q[:, 2 * HIDDEN:])
            new = np.where(live[:, t, None], z * h + (1 - z) * c, h)
            if keep:
                saved[t] = (h, z, r, c, q[:, 2 * HIDDEN:])
            h = states[:, t] = new
        return states, saved

    def pool(self, states: np.ndarray, live: np.ndarray):
        u = np.tanh(states @ self.p["A"])
        s = np.where(live, u @ self.p["a"], -30.0)
        e = np.exp(s - s.max(1, keepdims=True)) * live
        a = e / np.maximum(e.sum(1, keepdims=True), 1e-9)
        z = (a[:, :, None] * states).sum(1)
        return z @ self.p["o"] + self.p["d"][0], u, a, z

    def logits(self, gates_f: np.ndarray, gates_b: np.ndarray, live: np.ndarray) -> np.ndarray:
        f, _ = self.gru("f", gates_f, live, False)
        b, _ = self.gru("b", gates_b, live, False)
        return self.pool(np.concatenate([f, b], 2), live)[0]

    def loss_step(self, x: np.ndarray, live: np.ndarray, y: np.ndarray, weight: np.ndarray) -> dict[str, np.ndarray]:
        """Gradients of the weighted cross-entropy over one batch."""
        p, g = self.p, {}
        sides, saved = {}, {}
        for side in "fb":
            sides[side], saved[side] = self.gru(side, x @ p[f"W{side}"] + p[f"b{side}"], live, True)
        states = np.concatenate([sides["f"], sides["b"]], 2)
        logit, u, a, z = self.pool(states, live)
        dl = (weight * (sigmoid(logit) - y) / len(y)).astype(np.float32)
        g["o"], g["d"] = z.T @ dl, np.array([dl.sum()], np.float32)
        dz = dl[:, None] * p["o"]
        da = (states * dz[:, None]).sum(2)
        ds = a * (da - (a * da).sum(1, keepdims=True))
        g["a"] = (u * ds[:, :, None]).sum((0, 1))
        du = ds[:, :, None] * p["a"] * (1 - u * u)
        g["A"] = np.einsum("nti,ntj->ij", states, du, optimize=True)
        dstates = a[:, :, None] * dz[:, None] + du @ p["A"].T
        for side, part in (("f", slice(0, HIDDEN)), ("b", slice(HIDDEN, None))):
            steps = x.shape[1]
            order = range(steps - 1, -1, -1) if side == "f" else range(steps)
            dgates = np.zeros((*x.shape[:2], 3 * HIDDEN), np.float32)
            dr_all = np.zeros_like(p[f"R{side}"])
            dh = np.zeros((len(x), HIDDEN), np.float32)
            for t in order:
                h, z_t, r, c, qc = saved[side][t]
                on = live[:, t, None]
                dh = dh + dstates[:, t, part]
                own = np.where(on, dh, 0)
                dc = own * (1 - z_t) * (1 - c * c)
                dzt = own * (h - c) * z_t * (1 - z_t)
                drt = dc * qc * r * (1 - r)
                dgates[:, t] = np.concatenate([dzt, drt, dc], 1)
                dq = np.concatenate([dzt, drt, dc * r], 1)
                dr_all += h.T @ dq
                dh = np.where(on, own * z_t + dq @ p[f"R{side}"].T, dh)
            g[f"R{side}"] = dr_all
            g[f"W{side}"] = np.einsum("nti,ntj->ij", x, dgates, optimize=True)
            g[f"b{side}"] = dgates.sum((0, 1))
        return g

    def fit(self, x: np.ndarray, length: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, seed: int = 3) -> None:
        live = np.arange(WINDOW) < length[:, None]
        r, opt = np.random.default_rng(seed), Adam(self.p, 0.01)
        weight = np.where(y == 1, max(1.0, np.sqrt((y == 0).sum() / max(1, (y == 1).sum()))), 1.0)
        rounds = max(epochs, min(150, 300 * BATCH // max(1, len(y))))
        for k in range(rounds):
            order = r.permutation(len(y))
            opt.rate = 0.01 if k < rounds * 0.7 else 0.003
            for b in range(0, len(y), BATCH):
                own = order[b:b + BATCH]
                opt.step(self.loss_step(x[own], live[own], y[own], weight[own]))
        self.p = {k: v.astype(np.float32) for k, v in self.p.items()}

    def scores(self, raw: pa.Array) -> np.ndarray:
        """The largest score over all windows of each text."""
        if self.constant is not None:
            return np.full(len(raw), self.constant)
        w = Words(raw)
        first, length, owner = windows_of(w.doc, w.n)
        logit = np.full(len(first), float(self.p["d"][0]))
        if len(w.keys):
            odds = self.odds
            x = inputs(w, odds[w.bucket], odds[w.gram])
            gates = {s: x @ self.p[f"W{s}"] + self.p[f"b{s}"] for s in "fb"}
            row = {s: self.p[f"W{s}"][INPUTS - 1] for s in "fb"}  # capitals differ between occurrences
            for k in range(0, len(first), 2048):
                f, n = first[k:k + 2048], length[k:k + 2048]
                live = np.arange(WINDOW) < n[:, None]
                at = np.minimum(f[:, None] + np.arange(WINDOW), len(w.word) - 1)
                caps = w.capitals[at][:, :, None].astype(np.float32)
                got = self.logits(*(gates[s][w.word[at]] + caps * row[s] for s in "fb"), live)
                logit[k:k + 2048] = np.where(n > 0, got, logit[k:k + 2048])
        out = np.full(w.n, -np.inf)
        np.maximum.at(out, owner, logit)
        return sigmoid(out)


def train(docs: DataFrame, labels: DataFrame, column: str = "toxic", per_class: int = PER_CLASS) -> Network:
    sample = written(labelled_sample(docs, labels, column, per_class), "toxicity-sample")
    net = Network()
    sizes = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    net.n_pos, net.n_neg = sizes.get(1, 0), sizes.get(0, 0)
    if not net.n_pos or not net.n_neg:
        net.constant = 0.5 if not sizes else float(bool(net.n_pos))
        return net

    def count(batches):
        total = np.zeros((2, 2 * BUCKETS), np.int64)
        for batch in batches:
            for piece, raw in slices(batch):
                w, y = Words(raw), piece.column("y").to_numpy()
                if not len(w.keys):
                    continue
                pair = np.unique(w.doc * len(w.keys) + w.word)
                doc, word = pair // len(w.keys), pair % len(w.keys)
                grams = np.bincount(w.which, minlength=len(w.keys))
                begin = np.cumsum(grams) - grams
                k = grams[word]
                at = np.repeat(begin[word], k) + np.arange(k.sum()) - np.repeat(np.cumsum(k) - k, k)
                own = np.concatenate([doc * 2 * BUCKETS + w.bucket[word], np.repeat(doc, k) * 2 * BUCKETS + w.gram[at]])
                own = np.unique(own)  # a document counts once per bucket
                d, b = own // (2 * BUCKETS), own % (2 * BUCKETS)
                for v in (0, 1):
                    total[v] += np.bincount(b[y[d] == v], minlength=2 * BUCKETS)
        at = np.flatnonzero(total.any(0))
        yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(total[1][at]), pa.array(total[0][at])], ["bucket", "pos", "neg"])

    got = sample.mapInArrow(count, "bucket long, pos long, neg long").groupBy("bucket").agg(F.sum("pos").alias("pos"), F.sum("neg").alias("neg")).toArrow()
    net.pos, net.neg = np.zeros(2 * BUCKETS, np.float32), np.zeros(2 * BUCKETS, np.float32)
    b = got.column("bucket").to_numpy()
    net.pos[b], net.neg[b] = got.column("pos").to_numpy(), got.column("neg").to_numpy()
    net.odds = log_odds(net.pos, net.neg, net.n_pos, net.n_neg).astype(np.float32)
    shared = docs.sparkSession.sparkContext.broadcast((net.pos, net.neg, net.n_pos, net.n_neg))

    def pick(batches):
        """The windows to learn from: inputs (own document left out) and labels."""
        pos, neg, n_pos, n_neg = shared.value
        for batch in batches:
            for i in range(len(batch)):
                row = batch.slice(i, 1)
                y = row.column("y")[0].as_py()
                for _, raw in slices(row):
                    w = Words(raw)
                    if not len(w.keys):
                        continue
                    odds = lambda b: log_odds(np.maximum(pos[b] - y, 0), np.maximum(neg[b] - 1 + y, 0), n_pos - y, n_neg - 1 + y)
                    x = inputs(w, odds(w.bucket), odds(w.gram))
                    first, length, _ = windows_of(w.doc, 1)
                    telling = x[w.word, 0] + x[w.word, 1]
                    best = np.array([telling[a:a + n].max() for a, n in zip(first, length)])
                    order = np.argsort(-best, kind="stable")
                    chosen = order[:1] if y else np.unique(np.concatenate([order[:TRAIN_WINDOWS - 1], [len(order) // 2]]))
                    for k in chosen:
                        at = first[k] + np.arange(length[k])
                        v = np.zeros((WINDOW, INPUTS), "<f4")
                        v[:length[k]] = x[w.word[at]]
                        v[:length[k], INPUTS - 1] = w.capitals[at]
                        yield pa.RecordBatch.from_arrays([row.column("doc_id").cast(pa.string()), pa.array([y], pa.int32()), pa.array([int(length[k])], pa.int32()), pa.array([v.tobytes()], pa.binary())],
                                                         ["doc_id", "y", "length", "x"])

    rows = sample.mapInArrow(pick, "doc_id string, y int, length int, x binary").toArrow().to_pylist()
    rows.sort(key=lambda r: (r["doc_id"], r["x"]))
    if rows:
        net.fit(np.stack([np.frombuffer(r["x"], "<f4").reshape(WINDOW, INPUTS) for r in rows]), np.array([r["length"] for r in rows]), np.array([r["y"] for r in rows], np.float32))
    net.pos = net.neg = None
    return net


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, per_class: int = PER_CLASS) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs`` (doc_id, text)."""
    ship(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(train(docs, labels, per_class=per_class))

    def run(batches):
        for batch in batches:
            for piece, raw in slices(batch, limit=2 << 20):
                s = shared.value.scores(raw).astype(np.float64)
                yield pa.RecordBatch.from_arrays([piece.column("doc_id"), piece.column("held_out"), pa.array(s), pa.array((s >= threshold).astype(np.int32))],
                                                 ["doc_id", "held_out", "score", "predicted"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(run, f"doc_id {kind}, held_out boolean, score double, predicted int")
