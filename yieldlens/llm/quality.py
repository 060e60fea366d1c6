"""Document quality: a linear-chain conditional random field over lines."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from yieldlens.llm.common import Words, stored, hash_ranges, held_out, in_arrow, pieces, text_buffer
from yieldlens.llm.sampling import label_sample, with_text

#: Documents the field learns from, at most: this many of each label.
SAMPLE = 500

# kinds of bytes: lower case, upper case, digit, blank, stop and comma, ! ?, bar, money and marks, other ASCII, beyond ASCII
_KINDS = 10
_KIND = np.full(256, 8, dtype=np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 0, 1, 2
_KIND[[9, 11, 12, 13, 32]] = 3
_KIND[[ord(c) for c in ".,;:'\"-()"]] = 4
_KIND[[ord(c) for c in "!?"]] = 5
_KIND[ord("|")] = 6
_KIND[[ord(c) for c in "$%&*#@^~"]] = 7
_KIND[128:] = 9
OWN = _KINDS + 8
#: Own, previous and next line's features.
WIDTH = 3 * OWN


class Lines:
    """Lines of a run of texts (cut at newlines; an empty text is one empty line) with their features."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        newline = data == 10
        # lines end at newlines and at the ends of texts
        breaks = np.flatnonzero(newline)
        docs = len(at) - 1
        per_doc = 1 + np.diff(np.concatenate([[0], np.cumsum(newline)])[at])
        self.bounds = np.concatenate([[0], np.cumsum(per_doc)])
        self.doc = np.repeat(np.arange(docs), per_doc)
        starts, ends = np.empty(len(self.doc), np.int64), np.empty(len(self.doc), np.int64)
        firsts, lasts = self.bounds[:-1], self.bounds[1:] - 1
        inner_start, inner_end = np.ones(len(starts), bool), np.ones(len(starts), bool)
        inner_start[firsts], inner_end[lasts] = False, False
        starts[firsts], ends[lasts] = at[:-1], at[1:]
        starts[inner_start], ends[inner_end] = breaks + 1, breaks
        self.length = ends - starts
        n = len(starts)
        line = np.repeat(np.arange(n), np.append(starts[1:], len(data)) - starts) if len(data) else np.zeros(0, np.int64)
        kind = _KIND[data]
        text = ~newline
        counts = np.bincount(line[text] * _KINDS + kind[text], minlength=n * _KINDS).reshape(n, _KINDS).astype(np.float64)
        size = np.maximum(self.length, 1)
        x = np.zeros((n, OWN))
        x[:, :_KINDS] = counts / size[:, None]
        letters = np.maximum(counts[:, 0] + counts[:, 1] + counts[:, 9], 1)
        x[:, _KINDS] = counts[:, 1] / letters
        words = counts[:, 3] + 1
        x[:, _KINDS + 1] = np.minimum(size / words / 20, 2)
        x[:, _KINDS + 2] = np.log1p(self.length) / 10
        x[:, _KINDS + 3] = np.minimum((counts[:, 5] + counts[:, 6] + counts[:, 7]) / words, 3)
        x[:, _KINDS + 4] = counts[:, 3] == 0
        last = np.where(self.length > 0, data[np.maximum(ends - 1, 0)] if len(data) else 0, 0)
        x[:, _KINDS + 5] = np.isin(last, [ord(c) for c in ".!?:;\""])
        x[:, _KINDS + 6] = self._repeats(data, starts, ends)
        x[:, _KINDS + 7] = self._echoes(data, at, starts)
        self.x = x

    def _echoes(self, data: np.ndarray, at: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The share of a line's words that equal the word before them in the line."""
        words = Words(data, at)
        line = np.searchsorted(starts, words.starts, side="right") - 1
        hashes = words.hashes()
        same = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
        echoes = np.bincount(line[1:][same], minlength=len(starts))
        return echoes / np.maximum(np.bincount(line, minlength=len(starts)), 1)

    def _repeats(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Whether the same text has an equal line before."""
        hashes = hash_ranges(data, starts, ends)
        order = np.lexsort((starts, hashes, self.doc))
        again = np.zeros(len(starts), bool)
        a, b = order[:-1], order[1:]
        again[b] = (hashes[a] == hashes[b]) & (self.doc[a] == self.doc[b]) & (self.length[b] > 0)
        return again

    def features(self) -> np.ndarray:
        return neighbours(self.x, self.bounds)


def neighbours(x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A line's features beside those of the line before and after it in the same text (zeros at the ends)."""
    wide = np.zeros((len(x), WIDTH))
    wide[:, :OWN] = x
    wide[1:, OWN : 2 * OWN] = x[:-1]
    wide[:-1, 2 * OWN :] = x[1:]
    wide[bounds[:-1], OWN : 2 * OWN] = 0
    wide[bounds[1:] - 1, 2 * OWN :] = 0
    return wide


class Chains:
    """Forward and backward sums of two-state chains of different lengths, step by step over all chains at once."""

    def __init__(self, bounds: np.ndarray):
        lengths = np.diff(bounds)
        self.order = np.argsort(-lengths, kind="stable")
        self.first, self.lengths = bounds[:-1][self.order], lengths[self.order]
        self.steps = int(lengths.max()) if len(lengths) else 0
        # chains still running at each step: the longest come first
        self.running = np.searchsorted(-self.lengths, -np.arange(self.steps), side="left")

    def marginals(self, emit: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Per line the probability of each state, summed pair probabilities, and the log of the normaliser.

        ``emit`` and ``move`` are potentials (exponentials of scores), ``emit`` at most 1 in each row.
        """
        n = len(emit)
        alpha, scale = np.empty((n, 2)), np.ones(n)
        for t in range(self.steps):
            at = self.first[: self.running[t]] + t
            a = emit[at] if t == 0 else (alpha[at - 1] @ move) * emit[at]
            scale[at] = a.sum(axis=1)
            alpha[at] = a / scale[at][:, None]
        beta = np.ones((n, 2))
        pairs = np.zeros((2, 2))
        for t in range(self.steps - 1, 0, -1):
            at = self.first[: self.running[t]] + t
            onward = emit[at] * beta[at] / scale[at][:, None]
            beta[at - 1] = onward @ move.T
            pairs += move * (alpha[at - 1].T @ onward)
        return alpha * beta, pairs, float(np.log(scale).sum())


class LineField:
    """The field: state 1 is a good line, 0 a bad one. Weights of a good line's features and of the four transitions."""

    def __init__(self, weights: np.ndarray, moves: np.ndarray):
        self.weights, self.moves = weights, moves

    def _potentials(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        score = np.stack([np.zeros(len(x)), np.clip(x @ self.weights[:-1] + self.weights[-1], -60, 60)], axis=1)
        top = score.max(axis=1)
        return np.exp(score - top[:, None]), top

    def good(self, x: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """Probability of each line to be good."""
        emit, _ = self._potentials(x)
        return Chains(bounds).marginals(emit, np.exp(self.moves))[0][:, 1]

    @classmethod
    def fit(cls, x: np.ndarray, bounds: np.ndarray, labels: np.ndarray, weight: float = 2e-3, steps: int = 120) -> "LineField":
        """Maximum likelihood with a quadratic penalty; every line has its document's label; labels weigh the same.

        Labels are constant along a document, so transitions learn how strongly lines go together.
        """
        groups = [np.flatnonzero(labels == y) for y in (0, 1)]
        parts = []
        for y, docs in enumerate(groups):
            rows = np.concatenate([np.arange(bounds[d], bounds[d + 1]) for d in docs]) if len(docs) else np.zeros(0, int)
            ends = np.concatenate([[0], np.cumsum(np.diff(bounds)[docs])])
            parts.append((y, x[rows], ends, Chains(ends), 0.5 / max(1, len(docs))))
        width = x.shape[1] + 1

        def loss(p: np.ndarray) -> tuple[float, np.ndarray]:
            field = cls(p[:width], p[width:].reshape(2, 2))
            value, grad = 0.5 * weight * float(p @ p), weight * p
            for y, own, ends, chains, share in parts:
                if not len(own):
                    continue
                emit, top = field._potentials(own)
                prob, pairs, norm = chains.marginals(emit, np.exp(field.moves))
                inner = len(own) - (len(ends) - 1)
                right = (own @ p[: width - 1]).sum() + p[width - 1] * len(own) if y else 0.0
                value += share * (norm + top.sum() - right - inner * field.moves[y, y])
                off = prob[:, 1] - y
                pairs = pairs.copy()
                pairs[y, y] -= inner
                grad = grad + share * np.concatenate([own.T @ off, [off.sum()], pairs.ravel()])
            return value, grad

        p = _minimise(loss, np.zeros(width + 4), steps)
        return cls(p[:width], p[width:].reshape(2, 2))


def _minimise(loss, p: np.ndarray, steps: int, memory: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent with a halving line search."""
    value, grad = loss(p)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(steps):
        step, used = grad.copy(), []
        for s, y in reversed(past):
            a = (s @ step) / (s @ y)
            step -= a * y
            used.append(a)
        if past:
            s, y = past[-1]
            step *= (s @ y) / (y @ y)
        else:
            step /= max(1.0, float(np.linalg.norm(grad)))
        for (s, y), a in zip(past, reversed(used)):
            step += s * (a - (y @ step) / (s @ y))
        rate, slope = 1.0, float(grad @ step)
        while rate > 1e-8:
            new_value, new_grad = loss(p - rate * step)
            if new_value <= value - 1e-4 * rate * slope:
                break
            rate /= 2
        else:
            break
        s, y = -rate * step, new_grad - grad
        if s @ y > 1e-12:
            past = [*past[1 - memory :], (s, y)]
        done = value - new_value < 1e-7 * max(1.0, abs(value))
        p, value, grad = p + s, new_value, new_grad
        if done:
            break
    return p


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = SAMPLE,
) -> LineField | None:
    """Learn from at most ``sample`` whole documents of label 0 and of label 1, none of them held out; None without any."""
    learn = labels.where(~held_out(F.col(f"`{id_column}`")) & F.col(f"`{label}`").isin(0, 1))
    chosen = stored(label_sample(learn, id_column, label, sample))

    def run(batch: pa.RecordBatch):
        data, at = text_buffer(batch.column(2))
        for first, last in pieces(at, 1 << 19):
            lines = Lines(data[at[first] : at[last]], at[first : last + 1] - at[first])
            rows = [lines.x[a:b].astype(np.float32).tobytes() for a, b in zip(lines.bounds, lines.bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, last - first), batch.column(1).slice(first, last - first), pa.array(rows, pa.binary())],
                names=["id", "label", "x"],
            )

    texts = with_text(chosen, docs, id_column, text).select("id", F.col("label").cast("int").alias("label"), "text")
    rows = sorted(in_arrow(texts, run, "id long, label int, x binary").collect(), key=lambda r: r["id"])
    if not rows:
        return None
    own = [np.frombuffer(r["x"], dtype=np.float32).reshape(-1, OWN) for r in rows]
    bounds = np.concatenate([[0], np.cumsum([len(a) for a in own])])
    x = neighbours(np.concatenate(own).astype(np.float64), bounds)
    return LineField.fit(x, bounds, np.array([r["label"] for r in rows]))


def score(docs: DataFrame, field: LineField | None, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``id, score``: the share of good text, each line's probability to be good weighted by its length.

    From 0 to 1, 0.5 if nothing was learned. Whole texts count; a null or empty text is one
    empty line. Repeated rows each get a row; other columns are not read; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batch: pa.RecordBatch):
        data, at = text_buffer(batch.column(1))
        found = np.full(batch.num_rows, 0.5)
        for first, last in pieces(at, 1 << 19) if shared.value is not None else ():
            lines = Lines(data[at[first] : at[last]], at[first : last + 1] - at[first])
            good, weight = shared.value.good(lines.features(), lines.bounds), lines.length + 1.0
            begin = lines.bounds[:-1]
            found[first:last] = np.add.reduceat(good * weight, begin) / np.add.reduceat(weight, begin)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.clip(found, 0.0, 1.0))], names=["id", "score"])

    read = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return in_arrow(read, run, "id long, score double").withColumnRenamed("id", id_column)
