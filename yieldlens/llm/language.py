"""Language identification: the family first, then one-versus-one linear support vector machines within it."""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from yieldlens.llm.common import stored, held_out, in_arrow, pieces, text_buffer
from yieldlens.llm.sampling import label_sample, with_text

#: Rows the machines learn from, at most, shared evenly by the languages (20 of each at least).
SAMPLE = 1_600
BUCKETS = 4_096
UNDETERMINED = "und"

# Families of languages. A language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fy is lb nb nl nn no sv yi",
    "romance": "ca es fr gl it oc pt ro",
    "slavic": "be bg bs cs hr mk pl ru sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd",
    "uralic": "et fi hu",
    "turkic": "az kk ky tr tt uz",
    "indo-aryan": "bn gu hi mr ne pa ur",
    "semitic": "am ar he mt",
}
_FAMILY_OF = {language: family for family, languages in FAMILIES.items() for language in languages.split()}


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language.lower().split("-")[0].split("_")[0], f"only {language}")


# letters of ASCII in lower case and all bytes of other characters count, the rest are blanks
_LETTER = np.full(256, 0x20, dtype=np.uint8)
_LETTER[97:123] = np.arange(97, 123)
_LETTER[128:] = np.arange(128, 256)


def features(column: pa.Array, most: int = 1 << 19):
    """Unit vectors of hashed byte-trigram frequencies: yields (first, last + 1, matrix) for runs of texts.

    Texts are lower-cased whole; runs of characters other than letters count as one blank.
    """
    data, at = text_buffer(pc.utf8_lower(column))
    for first, last in pieces(at, most, 256):  # a text has a row of BUCKETS numbers, however short it is
        own, places = data[at[first] : at[last]], at[first : last + 1] - at[first]
        x = _LETTER[own]
        doc = np.repeat(np.arange(last - first, dtype=np.int64), np.diff(places))
        keep = np.ones(len(x), dtype=bool)
        keep[1:] = (x[1:] != 0x20) | (x[:-1] != 0x20) | (doc[1:] != doc[:-1])
        x, doc = x[keep].astype(np.uint32), doc[keep]
        counts = np.zeros((last - first, BUCKETS), dtype=np.float32)
        if len(x) > 2:
            code = (x[:-2] << np.uint32(16)) | (x[1:-1] << np.uint32(8)) | x[2:]
            bucket = (code * np.uint32(2654435761)) >> np.uint32(20)
            same = doc[:-2] == doc[2:]
            cells = doc[:-2][same] * BUCKETS + bucket[same]
            counts = np.bincount(cells, minlength=counts.size).reshape(counts.shape).astype(np.float32)
        counts = np.sqrt(counts)
        norm = np.sqrt(np.square(counts).sum(axis=1, keepdims=True))
        yield first, last, counts / np.maximum(norm, 1e-9)


def linear_machine(x: np.ndarray, positive: np.ndarray, weight: float = 1e-3, steps: int = 150) -> np.ndarray:
    """A linear support vector machine with squared hinge loss, both sides weighing the same: weights, bias last."""
    x = np.hstack([x, np.ones((len(x), 1), dtype=x.dtype)])
    y = np.where(positive, 1.0, -1.0).astype(x.dtype)
    share = np.where(positive, 0.5 / max(1, positive.sum()), 0.5 / max(1, (~positive).sum())).astype(x.dtype)
    v = np.ones(x.shape[1], dtype=x.dtype)
    for _ in range(20):  # the largest curvature, by power iteration
        v = x.T @ (share * (x @ v))
        size = float(np.linalg.norm(v))
        v /= size
    rate = 1.0 / (2 * 1.05 * size + weight)
    w = u = np.zeros(x.shape[1], dtype=x.dtype)
    t = 1.0
    for _ in range(steps):  # accelerated gradient descent
        slack = np.maximum(0, 1 - y * (x @ u))
        new = u - rate * (weight * u - 2 * x.T @ (share * y * slack))
        t_new = (1 + (1 + 4 * t * t) ** 0.5) / 2
        u = new + (t - 1) / t_new * (new - w)
        w, t = new, t_new
    return w


class LanguageModel:
    """Machines between families and, within each family, between languages."""

    def __init__(self, x: np.ndarray, labels: list[str]):
        languages = sorted(set(labels))
        own = np.array(labels, dtype=object)
        self.families: dict[str, list[str]] = {}
        for language in languages:
            self.families.setdefault(family_of(language), []).append(language)
        in_family = np.array([family_of(a) for a in labels], dtype=object)
        self.names = sorted(self.families)
        self.between = self._pairs(x, in_family, self.names)
        self.within = {f: self._pairs(x, own, members) for f, members in self.families.items()}

    @staticmethod
    def _pairs(x: np.ndarray, labels: np.ndarray, names: list[str]) -> list[tuple[int, int, np.ndarray]]:
        out = []
        for (i, a), (j, b) in combinations(enumerate(names), 2):
            own = (labels == a) | (labels == b)
            out.append((i, j, linear_machine(x[own], labels[own] == a)))
        return out

    @staticmethod
    def _vote(x: np.ndarray, names: list[str], machines: list) -> tuple[np.ndarray, np.ndarray]:
        """The name with most wins, ties to the larger sum of margins, and how sure its closest win is."""
        wins = np.zeros((len(x), len(names)))
        least = np.full((len(x), len(names)), 9.0)
        for i, j, w in machines:
            margin = x @ w[:-1] + w[-1]
            wins[:, i] += (margin > 0) + 1e-3 * np.tanh(margin)
            wins[:, j] += (margin <= 0) - 1e-3 * np.tanh(margin)
            least[:, i] = np.minimum(least[:, i], margin)
            least[:, j] = np.minimum(least[:, j], -margin)
        best = wins.argmax(axis=1)
        return best, 1 / (1 + np.exp(-4 * least[np.arange(len(x)), best]))

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        family, sure = self._vote(x, self.names, self.between)
        language = np.empty(len(x), dtype=object)
        for i, name in enumerate(self.names):
            rows = np.flatnonzero(family == i)
            if len(rows):
                members = self.families[name]
                best, also = self._vote(x[rows], members, self.within[name])
                language[rows] = np.array(members, dtype=object)[best]
                sure[rows] = sure[rows] * also
        return language, np.clip(sure, 0.0, 1.0)


def train(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", lang: str = "lang", sample: int = SAMPLE
) -> LanguageModel | None:
    """Learn from at most ``sample`` whole texts with a non-null language, none of them held out; None without any."""
    learn = docs.where(~held_out(F.col(f"`{id_column}`")) & F.col(f"`{lang}`").isNotNull() & F.col(f"`{text}`").isNotNull())
    languages = learn.select(F.col(f"`{lang}`").alias("lang")).distinct().count()
    if not languages:
        return None
    chosen = stored(label_sample(learn, id_column, lang, max(20, sample // languages)))

    def run(batch: pa.RecordBatch):
        for first, last, x in features(batch.column(1)):
            rows = pa.array([r.tobytes() for r in x.astype(np.float32)], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), rows], names=["label", "x"])

    texts = with_text(chosen, docs, id_column, text).select(F.col("label").cast("string").alias("label"), "text")
    rows = in_arrow(texts.where(F.col("text").rlike(r"\p{L}")), run, "label string, x binary").collect()
    if not rows:
        return None
    rows = sorted(rows, key=lambda r: (r["label"], bytes(r["x"])))
    return LanguageModel(np.stack([np.frombuffer(r["x"], dtype=np.float32) for r in rows]), [r["label"] for r in rows])


def identify(
    docs: DataFrame, model: LanguageModel | None, id_column: str = "doc_id", text: str = "text", keep: bool = False
) -> DataFrame:
    """``id, lang_pred, score``, or with ``keep`` all columns of ``docs`` and ``lang_pred_``, ``score_``.

    ``lang_pred`` is one of the languages learned, and ``score``, from 0 to 1, how sure it is:
    the family's certainty times the language's. A text that is null or has no letter, and every
    text if nothing was learned, is ``und`` with score 0. Whole texts count. Repeated rows each get a row; columns
    other than the two named are not read (with ``keep``, handed on; any named ``lang_pred_`` or ``score_`` are replaced); an empty table gives no rows.
    """
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(model)

    def judge(column: pa.Array) -> tuple[pa.Array, pa.Array]:
        n = len(column)
        language, score = np.full(n, UNDETERMINED, dtype=object), np.zeros(n)
        if shared.value is not None and n:
            letters = pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            for first, last, x in features(column):
                language[first:last], score[first:last] = shared.value.predict(x)
            language[~letters], score[~letters] = UNDETERMINED, 0.0
        return pa.array(language, pa.string()), pa.array(score, pa.float64())

    if keep:
        def run(batch: pa.RecordBatch):
            found = judge(batch.column(batch.num_columns - 1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], *found], names=[*batch.schema.names[:-1], "lang_pred_", "score_"]
            )

        columns = [c for c in docs.columns if c not in ("lang_pred_", "score_")]
        renamed = docs.select(
            *[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(columns)], F.col(f"`{text}`").cast("string").alias("text")
        )
        kinds = ", ".join(f"{c} {t}" for c, t in renamed.dtypes[:-1])
        judged = in_arrow(renamed, run, f"{kinds}, lang_pred_ string, score_ double")
        return judged.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], "lang_pred_", "score_")

    def run(batch: pa.RecordBatch):
        yield pa.RecordBatch.from_arrays([batch.column(0), *judge(batch.column(1))], names=["id", "lang_pred", "score"])

    read = docs.select(F.col(f"`{id_column}`").cast("long").alias("id"), F.col(f"`{text}`").cast("string").alias("text"))
    return in_arrow(read, run, "id long, lang_pred string, score double").withColumnRenamed("id", id_column)
