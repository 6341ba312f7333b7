"""Operator 10: hierarchical language identification with linear support vector machines.

First the language family is predicted, then one-versus-one linear SVMs
separate the languages within it. Features are frequencies of letter pairs and
triples of the whole text (lower case; runs of anything but letters are one
space), hashed into a fixed number of columns, square-rooted and normalised.

Fitting uses at most ``per_language`` labelled documents of each language
(a documented bound): those with the smallest hash of their id, found by a
top-k per language; only their hashed features, 8 KB each, reach the driver.
The hash bound keeps the sample independent of how the rows are dealt. Prediction is a
single mapping over all rows without a shuffle.

Defined results: a null text or one without letters is ``und`` with score 0;
if nothing can be learned from, every row is; with one learned language every
other row gets it. Null labels and null ids are not learned from; a null id is
not held out. Rows with the same id are predicted each. The score is the
logistic of the smallest margin on the way.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from reviewforge.plans.joins import join_per_key

from .common import forget, python_ready

#: Families of the languages by ISO 639-1 code; a language that is not listed is a family of its own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af lb fy",
    "romance": "fr es it pt ro ca gl oc",
    "slavic": "ru uk pl cs sk bg sr hr sl mk be bs",
}
FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}

COLUMNS = 4096
#: Labelled documents of a language that the classifier is fitted on, at most.
PER_LANGUAGE = 1000
#: Tasks of a language that thin out its hashes.
SPREAD = 64
UND = "und"

_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")


def features(text: str | None) -> np.ndarray | None:
    """The feature vector of a whole text, or None if it has no letter."""
    if not text:
        return None
    plain = _NOT_LETTERS.sub(" ", text.lower()).strip()
    if not any(map(str.isalpha, plain[:64])) and not any(map(str.isalpha, plain)):
        return None
    codes = np.frombuffer(f" {plain} ".encode("utf-32-le"), "<u4").astype(np.uint64)
    pairs = codes[:-1] * np.uint64(0x9E3779B97F4A7C15) + codes[1:] * np.uint64(0xC2B2AE3D27D4EB4F)
    triples = pairs[:-1] * np.uint64(0xFF51AFD7ED558CCD) + codes[2:] * np.uint64(0x165667B19E3779F9)
    counts = np.bincount((pairs >> np.uint64(52)).astype(np.int64), minlength=COLUMNS) + np.bincount((triples >> np.uint64(52)).astype(np.int64), minlength=COLUMNS)
    root = np.sqrt(counts.astype(np.float32))
    return root / np.linalg.norm(root)


def linear_svm(x: np.ndarray, positive: np.ndarray, penalty: float = 10.0, steps: int = 100) -> tuple[np.ndarray, float]:
    """Weights and bias of an L2-regularised squared-hinge SVM, by accelerated gradient descent.

    Deterministic. Classes are weighted to equal totals. All in single
    precision: mixed products would copy the whole matrix in every step.
    """
    x = np.ascontiguousarray(x, np.float32)
    y = np.where(positive, 1.0, -1.0).astype(np.float32)
    share = (np.where(positive, 0.5 / max(positive.sum(), 1), 0.5 / max((~positive).sum(), 1)) * penalty).astype(np.float32)
    w, b = np.zeros(x.shape[1], np.float32), 0.0
    v, c = w.copy(), b
    rate = 1 / (1 + 4 * penalty)  # rows have norm 1 and the bias column is 1: the loss has curvature at most 4 * penalty
    for t in range(1, steps + 1):
        miss = np.maximum(0, 1 - y * (x @ v + np.float32(c))) * share * y
        w_new = v - np.float32(rate) * (v - 2 * (miss @ x))
        b_new = c + rate * 2 * float(miss.sum())
        fast = (t - 1) / (t + 2)
        v, c = w_new + np.float32(fast) * (w_new - w), b_new + fast * (b_new - b)
        w, b = w_new, b_new
    return w.astype(np.float32), float(b)


class Model:
    """One-versus-one SVMs between families, and between the languages of each family."""

    def __init__(self, x: np.ndarray, langs: np.ndarray):
        self.langs = sorted(set(langs.tolist()))
        kin = np.array([FAMILY.get(lang, lang) for lang in langs.tolist()])
        self.families = {f: sorted({lang for lang in self.langs if FAMILY.get(lang, lang) == f}) for f in sorted(set(kin.tolist()))}
        self.between = self._pairs(x, kin, list(self.families))
        self.within = {f: self._pairs(x, langs, members) for f, members in self.families.items()}

    @staticmethod
    def _pairs(x, names, classes):
        found = {}
        for i, a in enumerate(classes):
            for b in classes[i + 1 :]:
                rows = (names == a) | (names == b)
                found[a, b] = linear_svm(x[rows], names[rows] == a)  # copied and widened for one pair at a time
        return found

    @staticmethod
    def _vote(v: np.ndarray, classes: list[str], pairs: dict) -> tuple[str, float]:
        """The class that wins most pairs (ties: larger margins, then name) and its smallest margin."""
        if len(classes) == 1:
            return classes[0], np.inf
        margins: dict[str, list[float]] = {c: [] for c in classes}
        for (a, b), (w, bias) in pairs.items():
            m = float(v @ w + bias)
            margins[a].append(m)
            margins[b].append(-m)
        best = max(classes, key=lambda c: (sum(m > 0 for m in margins[c]), sum(margins[c])))
        return best, min(margins[best])

    def predict(self, text: str | None) -> tuple[str, float]:
        v = features(text)
        if v is None or not self.langs:
            return UND, 0.0
        family, first = self._vote(v, list(self.families), self.between)
        lang, second = self._vote(v, self.families[family], self.within[family])
        return lang, float(1 / (1 + np.exp(-4 * np.clip(min(first, second), -10, 10))))


def sample(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(lang, v) of the rows that a model is fitted on, in an order that does not depend on how they are dealt.

    Two jobs, whatever the number of languages. The k-th smallest hash of a
    language is found on (language, hash) alone, the top k of each task at most
    being shuffled; only texts up to it are read again, without a shuffle of the others. Rows with the same id
    share a hash, so what passes is ranked once more. ``v``: half precision.
    """
    learn = docs.select(docs["doc_id"], docs["text"], docs["lang"]).where((F.crc32(F.col("doc_id").cast("string")) % 5 != 0) & F.col("lang").isNotNull())
    learn = learn.withColumn("h", F.xxhash64("doc_id"))
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(*r, v) for *r, text in zip(*(batch.column(c).to_pylist() for c in ("lang", "h", "t", "text"))) if (v := features(text)) is not None]
            cols = list(zip(*rows)) or [()] * 4
            packed = [v.astype("<f2").tobytes() for v in cols[3]]
            yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.int64()), pa.array(packed, pa.binary())], names=["lang", "h", "t", "v"])

    def least(rows: DataFrame, *by: str) -> DataFrame:
        """The k smallest hashes of each group."""
        nth = F.row_number().over(Window.partitionBy(*by).orderBy("h"))
        return rows.withColumn("nth", nth).where(F.col("nth") <= per_language).drop("nth")

    # Every task sends up to k hashes of a language; they meet in ``SPREAD`` tasks before they meet in one.
    narrow = learn.select("lang", "h", (F.spark_partition_id() % SPREAD).alias("part"))
    bounds = least(least(narrow, "lang", "part"), "lang").groupBy("lang").agg(F.max("h").alias("bound"))
    near = join_per_key(learn, bounds, "lang").where("h <= bound").withColumn("t", F.xxhash64("text"))
    ranked = near.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("h", "t"))).where(F.col("nth") <= per_language)
    return ranked.select("lang", "h", "t", "text").mapInArrow(run, "lang string, h long, t long, v binary").orderBy("lang", "h", "t").select("lang", "v")


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """A model of the labelled rows whose crc32(doc_id as text) mod 5 is not 0."""
    x, names = bytearray(), []
    for row in sample(docs, per_language).toLocalIterator():  # 8 KB a row, a partition at a time
        x += row["v"]
        names.append(row["lang"])
    return Model(np.frombuffer(x, "<f2").reshape(len(names), COLUMNS), np.array(names, dtype=object))


def identify(docs: DataFrame, per_language: int = PER_LANGUAGE, model: Model | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row of ``docs``, after the columns ``keep`` of ``docs`` as a struct ``own``.

    Fitted on the labelled rows unless a model is given.
    """
    model = model or fit(docs, per_language)
    python_ready(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            found = [model.predict(t) for t in batch.column("text").to_pylist()]
            kept = batch.select([c for c in batch.schema.names if c != "text"])
            yield kept.append_column("lang_pred", pa.array([p[0] for p in found], pa.string())).append_column("score", pa.array([p[1] for p in found], pa.float64()))

    held = F.coalesce(F.crc32(docs["doc_id"].cast("string")) % 5 == 0, F.lit(False))
    own = [F.struct(*[docs[c] for c in keep]).alias("own")] if keep else []
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), held.alias("held_out"), docs["text"].alias("text"), *own)
    schema = StructType([f for f in rows.schema if f.name != "text"] + [StructField("lang_pred", StringType()), StructField("score", DoubleType())])
    return rows.mapInArrow(run, schema)
