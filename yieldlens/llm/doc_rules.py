"""Quality rules: statistics of whole documents, judged by fixed base rules and by boosted trees."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from yieldlens.llm.common import SPACES, Words, held_out, in_arrow, mix64, pieces, stored, text_buffer
from yieldlens.llm.sampling import label_sample, with_text

#: Documents the trees learn from, at most: this many of each label.
SAMPLE = 2000
#: Fixed by the query's contract.
SYMBOLS = b"#*$%&|<>"
WINDOW = 3
LEAST_WORDS = 50
MOST_REPEATED = 50
#: A document stays if its score is at least this.
LEAST_SCORE = 0.5
#: Bytes whose words are found and hashed at once.
RUN = 1 << 20

#: What the trees see, and how a higher value may move the score: down, up or both ways (0).
FEATURES = {
    "log_words": 0, "chars_per_word": 0, "symbols_per_word": -1, "dup_line_share": -1, "repeat_share": -1,
    "distinct_share": 0, "top_word_share": -1, "upper_share": 0, "digit_share": 0, "other_share": 0, "beyond_ascii_share": 0,
    "stops_per_word": 0, "words_per_line": 0, "marked_word_share": -1,
}
MONOTONE = np.array(list(FEATURES.values()))

_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True
# kinds of bytes that are counted: symbols, upper case, lower case, digits, stops, starts of characters, those beyond ASCII, spaces
_KINDS = 8
_KIND = np.zeros((256, _KINDS), bool)
_KIND[:, 0] = _SYMBOL
_KIND[65:91, 1] = _KIND[97:123, 2] = _KIND[48:58, 3] = True
_KIND[[ord(c) for c in ".,;:!?"], 4] = True
_KIND[:128, 5] = _KIND[192:, 5] = _KIND[192:, 6] = True
_KIND[:, 5] &= ~_SPACE
_KIND[:, 7] = _SPACE
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _cuts(data: np.ndarray, at: np.ndarray, run: int) -> list[int]:
    """Places where ``data`` can be cut in slices of about ``run`` bytes: ends of texts, or after a blank."""
    cuts = [0]
    while cuts[-1] < len(data):
        want = cuts[-1] + run
        if want >= len(data):
            cuts.append(len(data))
            break
        end = int(at[np.searchsorted(at, want, side="right") - 1])
        if end <= cuts[-1]:
            back = np.flatnonzero(_SPACE[data[cuts[-1] : want]])
            if len(back):
                end = cuts[-1] + int(back[-1]) + 1
            else:  # one very long word
                end = want
                while end < len(data) and not _SPACE[data[end]]:
                    ahead = np.flatnonzero(_SPACE[data[end : end + run]])
                    end = end + int(ahead[0]) if len(ahead) else min(len(data), end + run)
                end = min(end, int(at[np.searchsorted(at, cuts[-1], side="right")]))
        cuts.append(end)
    return cuts


class Profile:
    """Statistics of the texts of a buffer. ``at`` has the n + 1 places where texts begin and end."""

    def __init__(self, data: np.ndarray, at: np.ndarray, run: int = RUN):
        n = len(at) - 1
        doc, hashes, marked = [], [], np.zeros(n, np.int64)
        self.kinds = np.zeros((n, _KINDS), np.int64)
        cuts = _cuts(data, at, run)
        for a, b in zip(cuts, cuts[1:]):
            first, last = int(np.searchsorted(at, a, side="right")) - 1, int(np.searchsorted(at, b, side="left"))
            inner = np.clip(at[first : last + 1], a, b) - a
            part = data[a:b]
            words = Words(part, inner)
            doc.append((words.doc + first).astype(np.int32))
            hashes.append(words.hashes())
            for k in range(_KINDS):
                total = np.concatenate([[0], np.cumsum(_KIND[part, k], dtype=np.int32)])
                self.kinds[first:last, k] += total[inner[1:]] - total[inner[:-1]]
            total = np.concatenate([[0], np.cumsum(_SYMBOL[part], dtype=np.int32)])
            marked += np.bincount(words.doc[total[words.ends] > total[words.starts]] + first, minlength=n)
        self.doc = np.concatenate(doc) if doc else np.zeros(0, np.int32)
        self.hash = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        self.n_words = np.bincount(self.doc, minlength=n)
        self.word_chars, self.n_symbols = self.kinds[:, 5], self.kinds[:, 0]
        self.marked = marked
        self._lines(data, at)
        self.n_repeat_words = self._repeats()
        self._distinct()

    def _lines(self, data: np.ndarray, at: np.ndarray) -> None:
        n = len(at) - 1
        self.n_dup_lines, self.n_lines = np.zeros(n, np.int64), np.zeros(n, np.int64)
        for i in range(n):
            lines = Counter(data[at[i] : at[i + 1]].tobytes().split(b"\n"))
            for line, times in lines.items():
                if line.strip(SPACES):
                    self.n_lines[i] += times
                    self.n_dup_lines[i] += times - 1

    def _repeats(self) -> np.ndarray:
        """Words in windows of WINDOW words that their text holds twice or more."""
        n, size = len(self.n_words), len(self.hash)
        if size < WINDOW:
            return np.zeros(n, np.int64)
        starts = size - WINDOW + 1
        with np.errstate(over="ignore"):
            key = self.doc[:starts].astype(np.uint64)
            for w in range(WINDOW):
                key = mix64(key + self.hash[w : w + starts])
        inside = np.flatnonzero(self.doc[:starts] == self.doc[WINDOW - 1 :])
        key = key[inside]
        order = np.argsort(key, kind="stable")
        same = key[order][1:] == key[order][:-1]
        again = np.zeros(len(key), bool)
        again[order[1:][same]] = again[order[:-1][same]] = True
        edge = np.zeros(size + 1, np.int32)
        np.add.at(edge, inside[again], 1)
        np.add.at(edge, inside[again] + WINDOW, -1)
        return np.bincount(self.doc[np.cumsum(edge[:-1]) > 0], minlength=n)

    def _distinct(self) -> None:
        """Different words of each text, and how often its commonest one stands in it."""
        n = len(self.n_words)
        order = np.lexsort((self.hash, self.doc))
        doc, word = self.doc[order], self.hash[order]
        edge = np.flatnonzero(np.concatenate([[True], (doc[1:] != doc[:-1]) | (word[1:] != word[:-1])])) if len(doc) else np.zeros(0, int)
        times = np.diff(np.append(edge, len(doc)))
        self.distinct = np.bincount(doc[edge], minlength=n)
        self.top_word = np.zeros(n, np.int64)
        np.maximum.at(self.top_word, doc[edge], times)

    def features(self) -> np.ndarray:
        """A row for each text, in the order of FEATURES; shares of nothing are 0."""
        words, chars, lines = (np.maximum(x, 1).astype(float) for x in (self.n_words, self.word_chars, self.n_lines))
        upper, lower, digits, stops, beyond = (self.kinds[:, k] for k in (1, 2, 3, 4, 6))
        other = self.word_chars - upper - lower - digits - stops - beyond
        columns = [
            np.log1p(self.n_words), self.word_chars / words, self.n_symbols / words, self.n_dup_lines / lines,
            self.n_repeat_words / words, self.distinct / words, self.top_word / words, upper / np.maximum(upper + lower, 1),
            digits / chars, other / chars, beyond / chars, stops / words, self.n_words / lines, self.marked / words,
        ]
        return np.stack(columns, axis=1)

    def base_failed(self) -> np.ndarray:
        return (self.n_words < LEAST_WORDS) | (100 * self.n_repeat_words > MOST_REPEATED * self.n_words)


class Trees:
    """Boosted trees as flat arrays of nodes. A leaf's children are itself, so all rows walk the same number of steps."""

    def __init__(self, roots, feature, threshold, left, right, value, depth: int, base: float):
        self.roots, self.feature, self.threshold = np.array(roots, np.int64), np.array(feature, np.int64), np.array(threshold, float)
        self.left, self.right, self.value = np.array(left, np.int64), np.array(right, np.int64), np.array(value, float)
        self.depth, self.base = depth, base

    def margin(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        rows = np.arange(len(x))
        for root in self.roots:
            node = np.full(len(x), root)
            for _ in range(self.depth):
                node = np.where(x[rows, self.feature[node]] <= self.threshold[node], self.left[node], self.right[node])
            total += self.value[node]
        return total

    def score(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margin(x), -60, 60)))

    @classmethod
    def fit(
        cls, x: np.ndarray, y: np.ndarray, monotone: np.ndarray = MONOTONE, trees: int = 60, depth: int = 3,
        rate: float = 0.2, bins: int = 64, penalty: float = 1.0, least_weight: float = 1.0,
    ) -> "Trees":
        """Second-order boosting of the logistic loss on histograms; both labels weigh the same.

        A split on a feature with a sign is taken only if its children's values stand in that order, and all
        values below it stay on their side of the middle between them, so the score is monotone in that feature.
        """
        edges = [np.unique(np.quantile(column, np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for column in x.T]
        code = np.stack([np.searchsorted(e, column, side="left") for e, column in zip(edges, x.T)], axis=1)
        share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum())) * len(y)
        margin = np.zeros(len(y))
        table: dict[str, list] = {k: [] for k in ("roots", "feature", "threshold", "left", "right", "value")}

        def node(value: float) -> int:
            at = len(table["value"])
            for k, v in (("feature", 0), ("threshold", 0.0), ("left", at), ("right", at), ("value", value)):
                table[k].append(v)
            return at

        def best_split(rows: np.ndarray, g: np.ndarray, h: np.ndarray, low: float, high: float):
            found = (1e-9, None)
            total_g, total_h = g[rows].sum(), h[rows].sum()
            parent = total_g**2 / (total_h + penalty)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                left_g = np.cumsum(np.bincount(code[rows, f], g[rows], len(e) + 1))[:-1]
                left_h = np.cumsum(np.bincount(code[rows, f], h[rows], len(e) + 1))[:-1]
                right_g, right_h = total_g - left_g, total_h - left_h
                a = np.clip(-left_g / (left_h + penalty), low, high)
                b = np.clip(-right_g / (right_h + penalty), low, high)
                gain = -(2 * left_g * a + (left_h + penalty) * a * a) - (2 * right_g * b + (right_h + penalty) * b * b) - parent
                bad = (left_h < least_weight) | (right_h < least_weight) | (monotone[f] * (b - a) < 0)
                gain = np.where(bad, -np.inf, gain)
                k = int(gain.argmax())
                if gain[k] > found[0]:
                    found = (gain[k], (f, k, a[k], b[k]))
            return found[1]

        for _ in range(trees):
            p = 1 / (1 + np.exp(-margin))
            g, h = share * (p - y), share * p * (1 - p)
            step = np.zeros(len(y))
            root = node(0.0)
            table["roots"].append(root)
            open_ = [(root, np.arange(len(y)), -np.inf, np.inf, 0)]
            while open_:
                at, rows, low, high, level = open_.pop()
                split = best_split(rows, g, h, low, high) if level < depth else None
                if split is None:
                    value = np.clip(-g[rows].sum() / (h[rows].sum() + penalty), low, high)
                    table["value"][at] = step[rows] = rate * float(value)
                    continue
                f, k, a, b = split
                table["feature"][at], table["threshold"][at] = f, float(edges[f][k])
                middle = (a + b) / 2
                bounds = [(low, high), (low, high)]
                if monotone[f] > 0:
                    bounds = [(low, middle), (middle, high)]
                elif monotone[f] < 0:
                    bounds = [(middle, high), (low, middle)]
                goes_left = code[rows, f] <= k
                for side, own, bound in (("left", rows[goes_left], bounds[0]), ("right", rows[~goes_left], bounds[1])):
                    child = node(0.0)
                    table[side][at] = child
                    open_.append((child, own, *bound, level + 1))
            margin += step
        return cls(**table, depth=depth, base=0.0)


def train(
    docs: DataFrame, labels: DataFrame, id_column: str = "doc_id", text: str = "text", label: str = "quality",
    sample: int = SAMPLE,
) -> Trees | None:
    """Learn from at most ``sample`` whole documents of label 0 and of label 1, none of them held out; None without both labels."""
    learn = labels.where(~held_out(F.col(f"`{id_column}`")) & F.col(f"`{label}`").isin(0, 1))
    chosen = stored(label_sample(learn, id_column, label, sample))

    def run(batch: pa.RecordBatch):
        data, at = text_buffer(batch.column(2))
        for first, last in pieces(at):
            rows = Profile(data[at[first] : at[last]], at[first : last + 1] - at[first]).features()
            part = [batch.column(j).slice(first, last - first) for j in (0, 1)]
            yield pa.RecordBatch.from_arrays([*part, pa.array(list(rows), pa.list_(pa.float64()))], names=["id", "label", "x"])

    texts = with_text(chosen, docs, id_column, text).select("id", F.col("label").cast("int").alias("label"), "text")
    # as many rows as the sample, of one number a feature
    rows = sorted(in_arrow(texts, run, "id long, label int, x array<double>").collect(), key=lambda r: r["id"])
    y = np.array([r["label"] for r in rows])
    return Trees.fit(np.array([r["x"] for r in rows]), y) if len(set(y.tolist())) == 2 else None


def judge(docs: DataFrame, trees: Trees | None, id_column: str = "doc_id", text: str = "text", least: float = LEAST_SCORE) -> DataFrame:
    """``id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, score, kept`` of every document.

    Words are runs of bytes other than blanks. ``base_failed``: fewer than 50 words, or over half of the words in
    3-word windows that the text holds twice or more. ``score`` (0 to 1, 0.5 if nothing was learned) is the trees'
    probability of a good document; ``kept`` are documents that pass the base rules and score at least ``least``. Null and empty texts have no
    words. Repeated rows each get a row; other columns are not read; an empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(trees)

    def run(batch: pa.RecordBatch):
        data, at = text_buffer(batch.column(1))
        for first, last in pieces(at):
            profile = Profile(data[at[first] : at[last]], at[first : last + 1] - at[first])
            score = np.full(last - first, 0.5) if shared.value is None else shared.value.score(profile.features())
            failed = profile.base_failed()
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).slice(first, last - first),
                    *(pa.array(getattr(profile, c).astype(np.int64)) for c in STATISTICS),
                    pa.array(failed), pa.array(score), pa.array(~failed & (score >= least)),
                ],
                names=["id", *STATISTICS, "base_failed", "score", "kept"],
            )

    read = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    schema = "id long, " + ", ".join(f"{c} long" for c in STATISTICS) + ", base_failed boolean, score double, kept boolean"
    return in_arrow(read, run, schema).withColumnRenamed("id", id_column)
