"""Language identification by string kernels.

The kernel of two texts is the number of byte n-grams (of one to three bytes, A-Z lower-cased) that both have, over the
geometric mean of how many each has: a blended-spectrum presence kernel.
Landmarks are a bounded sample of labelled texts; the Nyström method maps a text to its kernels with the landmarks, times
the inverse square root of the landmarks' own kernel matrix. One-versus-rest ridge regression on a bounded sample of
labelled rows gives a weight for each landmark and language; the two maps are one matrix, so that a batch of texts is
scored by two matrix products.

Defined cases: a text that is null or without letters is ``und`` with score 0, and so is every text if no row has a label.
Ties between languages go to the more frequent one, then to the first by name. Repeated rows are each scored. Other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Bounds of the sample that is learned from: rows, and landmarks among them, for each language; and landmarks in all, of
#: which each language then has its part, one at least.
ROWS, LANDMARKS, MOST_LANDMARKS = 400, 32, 256
RIDGE = 1e-2
#: Texts scored at a time.
BATCH = 128
UNKNOWN = "und"

_FOLD = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Codes of n-grams: one byte, two bytes, three bytes.
_BASE2, _BASE3, _CODES = 1 << 8, (1 << 8) + (1 << 16), (1 << 8) + (1 << 16) + (1 << 24)


def gram_codes(text: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The codes of a text's n-grams, one array for each length."""
    one = np.frombuffer(text.translate(_FOLD), np.uint8).astype(np.int32)
    two = (one[:-1] << 8) | one[1:]
    three = (two[:-1] << 8) | one[2:]
    return one, two + _BASE2, three + _BASE3


class Spectrum:
    """Presence kernels with landmarks."""

    def __init__(self, landmarks: list[np.ndarray]):
        self.grams = np.unique(np.concatenate(landmarks)) if landmarks else np.zeros(0, np.int32)
        self.have = np.zeros((len(landmarks), len(self.grams)), bool)
        for row, codes in zip(self.have, landmarks, strict=True):
            row[np.searchsorted(self.grams, codes)] = True

    def ready(self) -> Spectrum:
        """Build, in this worker, the table from a code to its column and the landmarks' matrix."""
        self.column = np.full(_CODES, len(self.grams), np.int32)
        self.column[self.grams] = np.arange(len(self.grams), dtype=np.int32)
        self.weight = np.ascontiguousarray(self.have.T, np.float32)
        self.norm = np.sqrt(self.have.sum(1, dtype=np.float32))
        return self

    def kernels(self, texts: list[bytes]) -> np.ndarray:
        """One row for each text, one column for each landmark."""
        present, others = np.zeros((len(texts), len(self.grams) + 1), np.float32), np.zeros(len(texts), np.float32)
        for k, text in enumerate(texts):
            for codes in gram_codes(text):
                at = self.column[codes]
                present[k, at] = 1
                others[k] += len(np.unique(codes[at == len(self.grams)]))
        present = present[:, :-1]
        norm = np.sqrt(present.sum(1) + others)
        return (present @ self.weight) / np.maximum(norm[:, None] * self.norm[None, :], 1)


def fit_weights(spectrum: Spectrum, kernels: np.ndarray, labels: np.ndarray, n_labels: int, ridge: float = RIDGE) -> np.ndarray:
    """(landmarks, languages): weights on kernels, by ridge regression in the Nyström space."""
    have = spectrum.have.astype(np.float64)
    norm = np.sqrt(np.maximum(have.sum(1), 1))
    values, vectors = np.linalg.eigh(have @ have.T / norm[:, None] / norm[None, :])
    kept = values > 1e-8 * values.max()
    root = vectors[:, kept] / np.sqrt(values[kept])
    phi = kernels.astype(np.float64) @ root
    target = np.where(labels[:, None] == np.arange(n_labels)[None, :], 1.0, -1.0)
    balance = 1 / np.bincount(labels, minlength=n_labels)[labels]
    gram = (phi * balance[:, None]).T @ phi
    return root @ np.linalg.solve(gram + ridge * np.trace(gram) / len(gram) * np.eye(len(gram)), (phi * balance[:, None]).T @ target)


def _batches(batches: Iterator[pa.RecordBatch], column: int) -> Iterator[tuple[list[list], list[bytes]]]:
    """Rows and their texts in UTF-8, few at a time."""
    for batch in batches:
        for at in range(0, batch.num_rows, BATCH):
            part = batch.slice(at, BATCH)
            texts = [t or b"" for t in part.column(column).cast(pa.binary()).to_pylist()]
            yield [c.to_pylist() for k, c in enumerate(part.columns) if k != column], texts


def held_out(doc_id: Column) -> Column:
    """Rows that are not learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


class Model:
    """Languages, landmarks and weights."""

    def __init__(self, languages: list[str], spectrum: Spectrum, weights: np.ndarray):
        self.languages, self.spectrum, self.weights = languages, spectrum, weights.astype(np.float32)


def fit(docs: DataFrame, rows: int = ROWS, landmarks: int = LANDMARKS) -> Model:
    """Learn from a bounded sample of labelled rows that are not held out: for each language the ``rows`` of least hash.

    How many rows a language has is counted over all of them; a cut on the hash leaves about twice what is needed, so that
    no language, however frequent, is sorted in one task.
    """
    spark = docs.sparkSession
    labelled = docs.select(F.col("doc_id").cast("long"), "lang", "text").filter(F.col("lang").isNotNull() & ~held_out(F.col("doc_id")))
    counts = {r["lang"]: r["count"] for r in labelled.groupBy("lang").count().collect()}
    languages = sorted(counts, key=lambda x: (-counts[x], x))
    if not languages:
        return Model([], Spectrum([]), np.zeros((0, 0)))
    parts = 1 << 30
    cuts = spark.createDataFrame([(x, k, min(parts, parts * 3 * rows // counts[x] + 1)) for k, x in enumerate(languages)], "c_lang string, label int, cut long")
    mixed = F.xxhash64(F.lit("language sample"), "doc_id")
    few = labelled.withColumn("h", mixed).join(F.broadcast(cuts), (F.col("lang") == F.col("c_lang")) & (F.pmod("h", F.lit(parts)) < F.col("cut")))
    few = few.filter(F.col("text").rlike(r"\p{L}"))
    ranked = few.withColumn("rank", F.row_number().over(Window.partitionBy("label").orderBy("h", "doc_id"))).filter(F.col("rank") <= rows).select("label", "rank", "text")

    def codes(batches):
        for (labels, _), texts in _batches(batches, 2):
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array([np.unique(np.concatenate(gram_codes(t))).astype("<i4").tobytes() for t in texts])], ["label", "codes"])

    landmarks = min(landmarks, max(1, MOST_LANDMARKS // len(languages)))
    marks = ranked.filter(F.col("rank") <= landmarks).mapInArrow(codes, "label int, codes binary").collect()
    spectrum = Spectrum([np.frombuffer(r["codes"], "<i4") for r in sorted(marks, key=lambda r: (r["label"], bytes(r["codes"])))])
    shared = spark.sparkContext.broadcast(spectrum)

    def kernels(batches):
        ready = shared.value.ready()
        for (labels, _), texts in _batches(batches, 2):
            yield pa.RecordBatch.from_arrays([pa.array(labels, pa.int32()), pa.array([k.astype("<f4").tobytes() for k in ready.kernels(texts)])], ["label", "kernels"])

    found = sorted(((r["label"], bytes(r["kernels"])) for r in ranked.mapInArrow(kernels, "label int, kernels binary").collect()))
    if not found:
        return Model([], Spectrum([]), np.zeros((0, 0)))
    matrix, labels = np.stack([np.frombuffer(k, "<f4") for _, k in found]), np.array([x for x, _ in found])
    seen = np.unique(labels)
    weights = fit_weights(spectrum, matrix, np.searchsorted(seen, labels), len(seen))
    return Model([languages[k] for k in seen], spectrum, weights)


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of each row; the score is the best language's part of all languages' margins."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = docs.select(F.col("doc_id").cast("long"), held_out(F.col("doc_id")).alias("held_out"), F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)).alias("letters"), "text")

    def score(batches):
        m = shared.value
        ready = m.spectrum.ready() if m.languages else None
        for (ids, held, letters), texts in _batches(batches, 3):
            known = [k for k, x in enumerate(letters) if x and ready]
            pred, sure = [UNKNOWN] * len(ids), [0.0] * len(ids)
            if known:
                margin = np.clip((ready.kernels([texts[k] for k in known]) @ m.weights + 1) / 2, 0, 1) + 1e-6
                best = margin.argmax(1)
                for k, b, p in zip(known, best, margin.max(1) / margin.sum(1), strict=True):
                    pred[k], sure[k] = m.languages[b], float(min(p, 1.0))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(held, pa.bool_()), pa.array(pred), pa.array(sure, pa.float64())], ["doc_id", "held_out", "lang_pred", "score"])

    return rows.mapInArrow(score, "doc_id long, held_out boolean, lang_pred string, score double")


def identified(docs: DataFrame, rows: int = ROWS, landmarks: int = LANDMARKS) -> DataFrame:
    """Fit on the labelled rows of ``docs`` and predict all of its rows."""
    return predict(docs, fit(docs, rows, landmarks))
