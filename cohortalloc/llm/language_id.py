"""Language ID: nearest of several centroids per language, with rejection by distance.

Method.  A text becomes a vector of hashed letter-trigram counts (lower
case, all but letters folded to single blanks), damped (log), weighted by
inverse document frequency and normalised.  Each language's labelled sample
is clustered by spherical k-means into ``CENTROIDS`` centroids; a text gets
the language of the centroid with the largest cosine.  It is rejected when
that cosine is below ``MARGIN`` times the cosine that all but one hundredth
of the sample texts reach when they are cut to the least number of trigrams
of its length class (a random part of a text's trigrams).  So every length
has a floor, however few sample texts are that short or that long: past the
``LONGEST`` longest ones the floor stays level.  The cosines are those of
texts the centroids did not see: each half of the sample is scored by the
other half's (by its own only if no language has two sample texts).

Fit.  On a bounded sample of labelled rows: about ``SAMPLE`` documents in
all, the same share for each language, chosen by a hash of the key (at
least one class of rows per language however rare).  Prediction reads every
text as a whole.

Edge cases.  ``und`` (score 0, rejected) for a NULL text, a text without a
letter, or if no row is labelled.  Ties go to the language that sorts first.
Rows without a label or key are not learned from; repeated rows stay.
Columns other than the ones named are ignored by ``predict`` and kept by
``keep_known``.

Scale.  Fit and prediction are narrow passes; only the counts per language
and the sample (``SAMPLE`` vectors of ``DIM`` small numbers) reach the
driver; the model that goes to the workers has a fixed size per language.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortalloc.llm.common import runs_of_texts, ship_package, table

DIM = 4096
SAMPLE = 2400
CENTROIDS = 4
ROUNDS = 8
MARGIN = 0.35
#: Length classes: powers of two of the number of trigrams.
CLASSES = 24
#: Sample texts that a length class is fitted on at least (or all there are).
LONGEST = 20

_FOLD = bytes(b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))
_LETTER = re.compile(r"[A-Za-z]")


def has_letter(text: str) -> bool:
    return bool(_LETTER.search(text)) or (not text.isascii() and any(map(str.isalpha, text)))


def trigram_counts(text: str) -> np.ndarray:
    """Counts of the hashed byte trigrams of the folded text (``DIM`` numbers)."""
    words = text.lower().encode().translate(_FOLD).split()
    b = np.frombuffer(b" " + b" ".join(words) + b" ", np.uint8).astype(np.uint32)
    if len(b) < 3:
        return np.zeros(DIM, np.int64)
    code = b[:-2] | b[1:-1] << 8 | b[2:] << 16
    return np.bincount((code * np.uint32(0x9E3779B1)) >> np.uint32(20), minlength=DIM)


def unit(rows: np.ndarray) -> np.ndarray:
    size = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(size > 0, size, 1)


def length_class(total: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(np.maximum(total, 1)).astype(int), CLASSES - 1)


@dataclass
class Model:
    """``languages[i]`` has the centroids ``owner == i``; ``floors``: least cosine by length class."""

    languages: list[str]
    idf: np.ndarray
    centroids: np.ndarray
    owner: np.ndarray
    floors: np.ndarray

    def score(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Language index, cosine and rejection of each row of trigram counts."""
        likeness = unit(np.log1p(counts).astype(np.float32) * self.idf) @ self.centroids.T
        best = likeness.argmax(axis=1)
        cosine = np.clip(likeness[np.arange(len(best)), best], 0, 1)
        return self.owner[best], cosine, cosine < self.floors[length_class(counts.sum(axis=1))]


def spherical_kmeans(rows: np.ndarray, k: int) -> np.ndarray:
    """At most ``k`` unit centroids; starts from rows far from each other."""
    chosen = [int((rows @ rows.mean(axis=0)).argmax())]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int((rows @ rows[chosen].T).max(axis=1).argmin()))
    centroids = rows[chosen]
    for _ in range(ROUNDS):
        nearest = (rows @ centroids.T).argmax(axis=1)
        centroids = unit(np.stack([
            rows[nearest == i].sum(axis=0) if (nearest == i).any() else centroids[i] for i in range(len(centroids))
        ]))
    return centroids


def centroids_of(languages: list[str], label: np.ndarray, counts: np.ndarray) -> Model:
    """Model of sample rows that rejects nothing yet."""
    idf = (np.log((1 + len(counts)) / (1 + (counts > 0).sum(axis=0))) + 1).astype(np.float32)
    rows = unit(np.log1p(counts).astype(np.float32) * idf)
    groups = [spherical_kmeans(rows[label == i], CENTROIDS) if (label == i).any() else rows[:0] for i in range(len(languages))]
    owner = np.repeat(np.arange(len(groups)), [len(g) for g in groups])
    return Model(languages, idf, np.concatenate(groups), owner, np.zeros(CLASSES, np.float32))


def cut_cosines(model: Model, counts: np.ndarray, rng: np.random.Generator) -> np.ndarray:
    """Cosine of each row cut to ``2**c`` trigrams (whole if it has no more), a column for each length class c."""
    dims, out = np.arange(DIM, dtype=np.uint16), np.zeros((len(counts), CLASSES))
    for a in range(0, len(counts), 64):
        mixed = [rng.permutation(np.repeat(dims, row)) for row in counts[a : a + 64]]
        for c in range(CLASSES):
            if c and 2 ** (c - 1) >= max(map(len, mixed)):
                out[a : a + 64, c] = out[a : a + 64, c - 1]
                continue
            out[a : a + 64, c] = model.score(np.stack([np.bincount(x[: 2**c], minlength=DIM) for x in mixed]))[1]
    return out


def fit_sample(languages: list[str], label: np.ndarray, counts: np.ndarray) -> Model:
    """Model of sample rows; ``label[i]`` is the language index of ``counts[i]``."""
    model = centroids_of(languages, label, counts)
    half, many = np.zeros(len(label), int), np.zeros(len(label), bool)
    for i in range(len(languages)):
        at = np.flatnonzero(label == i)
        half[at], many[at] = np.arange(len(at)) % 2, len(at) > 1
    rng, total, cosine = np.random.default_rng(10), [], []
    if many.any():
        for h in (0, 1):
            tested, seen = many & (half == h), half != h
            total.append(counts[tested].sum(axis=1))
            cosine.append(cut_cosines(centroids_of(languages, label[seen], counts[seen]), counts[tested], rng))
    else:
        total, cosine = [counts.sum(axis=1)], [cut_cosines(model, counts, rng)]
    size, cosine = np.concatenate(total), np.concatenate(cosine)
    longest = np.sort(size)[-min(LONGEST, len(size))]
    for c in range(CLASSES):
        model.floors[c] = MARGIN * np.quantile(cosine[size >= min(2**c, longest), c], 0.01)
    return model


def held_out(key: Column) -> Column:
    """Rows never learned from: crc32 of the key as text leaves 2 modulo 4."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def fit(docs: DataFrame, key: str = "doc_id", label: str = "lang") -> Model | None:
    """Model of the labelled rows that are not held out; None without any."""
    ship_package(docs.sparkSession)
    has_text = F.length("text") > 0
    learn = docs.where(F.col(key).isNotNull() & F.col(label).isNotNull() & has_text & ~held_out(F.col(key)))
    totals = {r[0]: r[1] for r in learn.groupBy(label).count().collect()}  # a row per language
    if not totals:
        return None
    languages = sorted(totals)
    each = max(1, SAMPLE // len(languages))
    place = F.pmod(F.xxhash64(F.col(key), F.lit(7)), F.lit(1 << 30)) / (1 << 30)
    keep = F.lit(False)
    for name in languages:
        keep |= (F.col(label) == name) & (place < min(1.0, max(each, 20) / totals[name]))

    def run(batches):
        for batch in batches:
            rows = [trigram_counts(t) for t in batch.column("text").to_pylist()]
            raw = [np.minimum(x, 65535).astype(np.uint16).tobytes() for x in rows]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), pa.array(raw, pa.binary())], names=["label", "counts"]
            )

    picked = learn.where(keep).select(F.col(label).alias("label"), "text")
    sample = sorted((r[0], bytes(r[1])) for r in picked.mapInArrow(run, "label string, counts binary").collect())
    used = sorted({name for name, _ in sample})
    if not used:
        return None
    at = np.array([used.index(name) for name, _ in sample])
    return fit_sample(used, at, np.stack([np.frombuffer(x, np.uint16) for _, x in sample]))


def _judge(model: Model | None, texts: list[str]) -> tuple[list[str], list[float], list[bool]]:
    names, scores, rejected = ["und"] * len(texts), [0.0] * len(texts), [True] * len(texts)
    known = [i for i, t in enumerate(texts) if model and has_letter(t)]
    for a in range(0, len(known), 256):
        part = known[a : a + 256]
        best, cosine, out = model.score(np.stack([trigram_counts(texts[i]) for i in part]))
        for i, b, c, r in zip(part, best.tolist(), cosine.tolist(), out.tolist()):
            names[i], scores[i], rejected[i] = model.languages[b], c, r
    return names, scores, rejected


def predict(docs: DataFrame, model: Model | None, key: str = "doc_id") -> DataFrame:
    """(key, lang_pred, score, rejected) of every row."""
    shared = ship_package(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            at = 0
            for texts in runs_of_texts(batch.column("text")):
                columns = _judge(shared.value, texts)
                keys = batch.column(key).slice(at, len(texts))
                at += len(texts)
                yield pa.RecordBatch.from_arrays([keys, *map(pa.array, columns)], names=names)

    names = [key, "lang_pred", "score", "rejected"]
    kind = docs.schema[key].dataType.simpleString()
    return docs.select(key, "text").mapInArrow(
        run, f"`{key}` {kind}, lang_pred string, score double, rejected boolean"
    )


def keep_known(docs: DataFrame, model: Model | None) -> DataFrame:
    """The rows of ``docs`` that are not rejected, with all their columns."""
    shared = ship_package(docs.sparkSession).sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            rejected = []
            for texts in runs_of_texts(batch.column("text")):
                rejected += _judge(shared.value, texts)[2]
            yield batch.filter(pa.array([not r for r in rejected], pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the rows that are not held out; see the module."""
    docs = table(spark, sf_dir, "documents")
    found = predict(docs, fit(docs))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
