"""Language identification by hierarchical discrimination.

The family of a text's language is predicted first; within the family, linear
support vector machines that each separate two languages decide. Families are
told apart by machines of the same kind. Features are hashed letter n-grams of
the whole text; the machines' margins are turned into probabilities on samples
they were not trained on.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import ngrams
from .sampling import id_remainder, sample_per_class
from .workers import send_code

PER_LANGUAGE = 400
SAMPLE = 4000
MAX_LANGUAGES = 256
BITS = 12
UNDETERMINED = "und"
MIN_SCORE = 0.25
_BATCH = 256

#: Families of closely related languages; any other language is its own.
FAMILIES = {
    "germanic": ("en", "de", "nl", "sv", "da", "no", "nb", "nn", "is", "af"),
    "romance": ("fr", "es", "it", "pt", "ro", "ca", "gl", "oc"),
    "slavic": ("ru", "uk", "be", "pl", "cs", "sk", "bg", "mk", "sr", "hr", "bs", "sl"),
    "uralic": ("fi", "et", "hu"),
    "turkic": ("tr", "az", "kk", "uz"),
    "indic": ("hi", "mr", "ne", "bn", "pa", "gu"),
}
_FAMILY_OF = {lang: family for family, langs in FAMILIES.items() for lang in langs}


def family_of(lang: str) -> str:
    return _FAMILY_OF.get(lang.lower().split("-")[0].split("_")[0], lang)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text)) if text else False


def describe(text: str) -> np.ndarray:
    """Unit vector of square roots of n-gram counts, with a constant."""
    counts = np.zeros(1 << BITS)
    for part in ngrams.chunks(text):
        a = ngrams.letters(part)
        for n in (1, 2, 3):
            counts += np.bincount(ngrams.ngrams(a, n, BITS), minlength=1 << BITS)
    v = np.sqrt(counts)
    v /= np.linalg.norm(v) or 1.0
    return np.concatenate([v, [0.3]]).astype(np.float32)


def train_svm(x: np.ndarray, y: np.ndarray, *, c: float = 10.0, rounds: int = 30, seed: int = 0) -> np.ndarray:
    """Weights of a linear support vector machine for labels -1 and 1, by dual
    coordinate ascent; both classes weigh the same in all."""
    rng = np.random.default_rng(seed)
    x = x.astype(np.float64)
    w, a, q = np.zeros(x.shape[1]), np.zeros(len(x)), (x * x).sum(axis=1)
    cap = np.where(y > 0, c * len(y) / (2 * max(1, (y > 0).sum())), c * len(y) / (2 * max(1, (y < 0).sum())))
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            new = min(max(a[i] + (1 - y[i] * (x[i] @ w)) / q[i], 0.0), cap[i])
            if new != a[i]:
                w += (new - a[i]) * y[i] * x[i]
                a[i] = new
    return w


def fit_slope(margins: np.ndarray, y: np.ndarray, rounds: int = 50) -> float:
    """Slope of the logistic curve through held-out margins (at least 1)."""
    t, s = np.where(y > 0, 1 - 1 / (2 + (y > 0).sum()), 1 / (2 + (y < 0).sum())), 4.0
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(s * margins, -40, 40)))
        g, h = ((p - t) * margins).sum(), (p * (1 - p) * margins ** 2).sum() + 1e-6
        s = float(np.clip(s - g / h, 1.0, 50.0))
    return s


@dataclass
class LanguageModel:
    """Machines between families, then between the languages of each. A group
    is (its members, its pairs of members); ``weights`` has a row per pair."""
    families: list[str]
    languages: dict[str, list[str]]
    pairs: list[tuple[str, str, str]]
    weights: np.ndarray
    slopes: np.ndarray

    def _decide(self, group: str, members: list[str], p: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Winner (most votes, then largest probability sum, then first) and
        its probability against its strongest rival."""
        n = p.shape[0]
        votes, worst = np.zeros((n, len(members))), np.ones((n, len(members)))
        for k, (g, a, b) in enumerate(self.pairs):
            if g == group:
                i, j = members.index(a), members.index(b)
                votes[:, i] += (p[:, k] >= 0.5) + p[:, k] / (len(members) + 1)
                votes[:, j] += (p[:, k] < 0.5) + (1 - p[:, k]) / (len(members) + 1)
                worst[:, i] = np.minimum(worst[:, i], p[:, k])
                worst[:, j] = np.minimum(worst[:, j], 1 - p[:, k])
        best = votes.argmax(axis=1)
        return best, worst[np.arange(n), best]

    def predict(self, x: np.ndarray) -> tuple[list[str], np.ndarray]:
        p = 1 / (1 + np.exp(-np.clip(self.slopes * (x @ self.weights.T), -40, 40)))
        family, score = self._decide("", self.families, p)
        names = np.empty(len(x), dtype=object)
        for f, name in enumerate(self.families):
            rows = np.flatnonzero(family == f)
            if len(rows):
                best, inner = self._decide(name, self.languages[name], p[rows])
                names[rows] = np.array(self.languages[name], dtype=object)[best]
                score[rows] *= inner
        return names.tolist(), score


def _machine(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float]:
    """Trains on three samples of four, sets the slope on the others."""
    held = np.arange(len(y)) % 4 == 3
    if len(set(y[held])) < 2 or len(set(y[~held])) < 2:
        return train_svm(x, y), 4.0
    w = train_svm(x[~held], y[~held])
    return w, fit_slope(x[held] @ w, y[held])


def train_model(samples: list[tuple[str, np.ndarray]]) -> LanguageModel | None:
    """A model from (language, vector) samples, None without any."""
    if not samples:
        return None
    langs = np.array([lang for lang, _ in samples], dtype=object)
    x = np.stack([v for _, v in samples])
    fams = np.array([family_of(lang) for lang in langs], dtype=object)
    families = sorted(set(fams))
    languages = {f: sorted(set(langs[fams == f])) for f in families}
    pairs, weights, slopes = [], [], []
    for group, of, members in [("", fams, families)] + [(f, langs, languages[f]) for f in families]:
        for a, b in combinations(members, 2):
            rows = np.flatnonzero((of == a) | (of == b))
            w, s = _machine(x[rows], np.where(of[rows] == a, 1.0, -1.0))
            pairs.append((group, a, b))
            weights.append(w)
            slopes.append(s)
    width = x.shape[1]
    return LanguageModel(families, languages, pairs, np.array(weights, dtype=np.float32).reshape(-1, width), np.array(slopes))


def fit_languages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                  per_language: int = PER_LANGUAGE, sample: int = SAMPLE,
                  max_languages: int = MAX_LANGUAGES) -> LanguageModel | None:
    """Learns from documents with a language whose id is not held out
    (crc32 of the id as text, modulo 4, is not 2): about ``per_language`` of
    each language, at most about ``sample`` in all. Languages are the
    ``max_languages`` with most documents (of equally many the first by name).
    Documents are picked by id and text, and rows equal in both are one
    example, so a repeated id does not enlarge the sample."""
    send_code(docs.sparkSession)
    known = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(
        F.col("lang").isNotNull() & (id_remainder("doc_id", 4) != 2) & F.col("text").rlike(r"\p{L}"))
    most = known.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(max_languages).collect()
    counts = {r.lang: r["count"] for r in sorted(most, key=lambda r: r.lang)}
    if not counts:
        return None
    picked = sample_per_class(known, "lang", ["doc_id", "text"], counts, min(per_language, max(1, sample // len(counts))), "language")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            v = [describe(t.as_py()).tobytes() for t in b.column(2)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(v, pa.binary())], names=["doc_id", "lang", "v"])

    rows = picked.select("doc_id", "lang", "text").mapInArrow(run, "doc_id long, lang string, v binary").collect()
    rows.sort(key=lambda r: (r.doc_id, r.lang, bytes(r.v)))
    return train_model([(r.lang, np.frombuffer(bytes(r.v), dtype=np.float32)) for r in rows])


def predictor(docs: DataFrame, model: LanguageModel | None):
    """Arrow function over (text, anything ...) batches: appends ``lang_pred``
    and ``score`` to the columns after the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            n = b.num_rows
            names, scores = [UNDETERMINED] * n, np.zeros(n)
            rows, vectors = [], []

            def flush():
                if rows:
                    got, s = m.predict(np.stack(vectors))
                    for i, name, score in zip(rows, got, s):
                        names[i], scores[i] = name, score
                    rows.clear()
                    vectors.clear()

            for i, t in enumerate(b.column(0)):
                text = t.as_py()
                if m is not None and has_letter(text):
                    rows.append(i)
                    vectors.append(describe(text))
                    if len(rows) >= _BATCH:
                        flush()
            flush()
            yield pa.RecordBatch.from_arrays([*b.columns[1:], pa.array(names, pa.string()), pa.array(scores)],
                                             names=[*b.schema.names[1:], "lang_pred", "score"])
    return run


def identify_languages(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                       per_language: int = PER_LANGUAGE, sample: int = SAMPLE) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` of every row.

    A null text, or one without a letter, is ``und`` with score 0; so is every
    text if no document has a language to learn from. With one known language
    every text with letters has it, with score 1. A null id is never held out
    nor learned from. Every row is judged by its own text, which is read whole;
    rows that repeat are all returned, an empty table gives no rows, and other
    columns, whatever their names, are not looked at.
    """
    model = fit_languages(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, per_language=per_language, sample=sample)
    d = docs.select(F.col(text_col).alias("text"), F.col(id_col).cast("long").alias("doc_id"),
                    F.coalesce(id_remainder(id_col, 4) == 2, F.lit(False)).alias("held_out"))
    return d.mapInArrow(predictor(docs, model), "doc_id long, held_out boolean, lang_pred string, score double")


def keep_identified(docs: DataFrame, *, min_score: float = MIN_SCORE, id_col: str = "doc_id", text_col: str = "text",
                    lang_col: str = "lang", per_language: int = PER_LANGUAGE, sample: int = SAMPLE) -> DataFrame:
    """The rows of ``docs`` whose language is determined with at least
    ``min_score``, all columns as they are. Where no document has a language
    to learn from nothing can be judged, and only texts without letters go."""
    model = fit_languages(docs, id_col=id_col, text_col=text_col, lang_col=lang_col, per_language=per_language, sample=sample)
    if model is None:
        return docs.where(F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False)))
    schema = T.StructType([T.StructField("row", docs.schema), T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    rows = docs.select(F.col(text_col).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    rows = rows.mapInArrow(predictor(docs, model), schema)
    return rows.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= min_score)).select("row.*")
