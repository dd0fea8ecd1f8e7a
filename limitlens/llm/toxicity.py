"""Toxicity: boosted trees over dense features of the text, calibrated by isotonic regression.

The lexicon is a short public list plus terms learned from labelled documents: words, and stems at
the start of words, that toxic documents hold far more often than others. A document becomes
a few rates: lexicon densities, how often a hit stands near a second-person word, capitals,
punctuation, digits, obfuscated spellings. Trees are fitted on three folds of the labelled rows
and calibrated on the fourth; a fifth is never seen.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from limitlens.llm.tables import held_out, keep, whole_text

# Bounds of the fit: labelled rows that are used, and learned terms that are kept.
MAX_TRAINING_ROWS, MAX_TERMS = 40_000, 1000
# A learned term is in so many toxic documents at least, and so much likelier there (log of odds).
LEAST_SUPPORT, LEAST_LOG_ODDS = 6, 3.0
STEMS = (4, 5, 6)
NEAR_CHARS = 40

INSULTS = (
    "idiot moron stupid loser trash scum pathetic worthless disgusting clown dumb fool jerk creep "
    "freak coward liar imbecile bastard bitch asshole retard filth vermin"
).split()
SECOND_PERSON = (
    "you your yours yourself du dich dir dein deine ihr euch tu te toi ton ta tes vous votre "
    "usted ustedes ti tus tuyo"
).split()
_LOOKALIKES = str.maketrans("013457@$!", "oieastasi")
_MIXED = re.compile(r"[a-z][013457@$!*]+[a-z]")
_SPACED = re.compile(r"\b(?:[a-z][.\-_*]){2,}[a-z]\b")

FEATURES = [
    "log_words", "public_rate", "learned_rate", "log_public", "log_learned", "share_distinct",
    "person_rate", "near_person", "capitals", "shouted", "punctuation", "exclaims", "digits", "obfuscated",
    "hidden_rate",
]
_CLASS = np.zeros(256, np.uint8)
for _b in range(256):
    _c = chr(_b)
    _CLASS[_b] = (
        1 if "a" <= _c <= "z" else 2 if "A" <= _c <= "Z" else 3 if _c.isdigit() and _b < 128
        else 4 if _b < 128 and _c in "!?" else 5 if 32 < _b < 127 else 6 if _b <= 32 else 7
    )
_WORDS = re.compile(r"[^\W\d_]+")


class Featurizer:
    """Dense features of a text, by one pass of a multi-pattern automaton and byte counts."""

    def __init__(self, learned: list[tuple[str, bool]]):
        self.automaton = ahocorasick.Automaton()
        # term -> (class, whole word); later entries do not replace earlier ones.
        entries: dict[str, tuple[int, bool, int]] = {}
        for word in SECOND_PERSON:
            entries[word] = (0, True, len(word))
        for word in INSULTS:
            entries[word] = (1, False, len(word))
        for term, whole in learned:
            entries.setdefault(term, (2, whole, len(term)))
        for term, value in entries.items():
            self.automaton.add_word(term, (term, *value))
        self.automaton.make_automaton()

    def _hits(self, text: str) -> tuple[dict[int, tuple[int, str]], list[int]]:
        """Starts of words that hold a term (class and term), and places of second-person words."""
        hits: dict[int, tuple[int, str]] = {}
        persons = []
        for end, (term, kind, whole, length) in self.automaton.iter(text):
            start = end + 1 - length
            if start and text[start - 1].isalpha():
                continue
            if whole and end + 1 < len(text) and text[end + 1].isalpha():
                continue
            if kind == 0:
                persons.append(start)
            elif start not in hits or kind < hits[start][0]:
                hits[start] = (kind, term)
        return hits, persons

    def __call__(self, text: str) -> list[float]:
        if not text:
            return [0.0] * len(FEATURES)
        low = text.lower()
        counts = np.bincount(_CLASS[np.frombuffer(text.encode("utf-8", "replace"), np.uint8)], minlength=8)
        chars = len(text)
        letters = max(1, counts[1] + counts[2] + counts[7] // 2)
        words = max(1, int(counts[6]) + 1)
        hits, persons = self._hits(low)
        public = sum(1 for kind, _ in hits.values() if kind == 1)
        learned = len(hits) - public
        places = np.asarray(persons)
        near = sum(1 for s in hits if len(places) and np.abs(places - s).min() <= NEAR_CHARS)
        hidden = mixed = 0
        if counts[3] or counts[5] or counts[4]:
            mixed = len(_MIXED.findall(low))
            spaced = _SPACED.findall(low)
            if mixed or spaced:
                plain = _SPACED.sub(lambda m: re.sub(r"[.\-_*]", "", m[0]), low.translate(_LOOKALIKES))
                hidden = max(0, len(self._hits(plain)[0]) - len(hits))
            mixed += len(spaced)
        shouted = len(re.findall(r"\b[A-Z]{3,}\b", text)) if counts[2] * 4 > letters else 0
        return [
            math.log1p(words), 1000 * public / words, 1000 * learned / words, math.log1p(public),
            math.log1p(learned), len({t for _, t in hits.values()}) / max(1, len(hits)),
            1000 * len(persons) / words, near / max(1, len(hits)), float(counts[2] / letters),
            shouted / words, float((counts[4] + counts[5]) / chars), float(1000 * counts[4] / chars),
            float(counts[3] / chars), 1000 * mixed / words, 1000 * hidden / words,
        ]


def _terms(text: str) -> set[tuple[str, bool]]:
    words = set(_WORDS.findall(text.lower()))
    found = {(w, True) for w in words if 3 <= len(w) <= 40}
    for n in STEMS:
        found |= {(w[:n], False) for w in words if len(w) > n}
    return found


def _count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        step = 500  # bounds the counts that are held at once
        texts, labels = batch.column("text"), batch.column("label")
        for at in range(0, batch.num_rows, step):
            counts: tuple[Counter, Counter] = (Counter(), Counter())
            for i in range(at, min(at + step, batch.num_rows)):
                counts[labels[i].as_py()].update(_terms(texts[i].as_py()))
            terms = list(counts[0] | counts[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array([t for t, _ in terms], pa.string()), pa.array([w for _, w in terms], pa.bool_()),
                 pa.array([counts[1][t] for t in terms], pa.int64()),
                 pa.array([counts[0][t] for t in terms], pa.int64())],
                ["term", "whole", "toxic", "clean"],
            )


def learn_terms(sample: DataFrame) -> list[tuple[str, bool]]:
    """Terms that mark toxic documents in ``sample`` (text, label): at most ``MAX_TERMS``."""
    totals = sample.groupBy("label").count().collect()
    sizes = {r["label"]: r["count"] for r in totals}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return []
    counted = (
        sample.select("text", "label")
        .mapInArrow(_count_terms, "term string, whole boolean, toxic long, clean long")
        .groupBy("term", "whole")
        .agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        .where(F.col("toxic") >= LEAST_SUPPORT)
    )
    odds = F.log((F.col("toxic") + 0.5) / (toxic + 1.0)) - F.log((F.col("clean") + 0.5) / (clean + 1.0))
    best = (
        counted.withColumn("odds", odds)
        .where(F.col("odds") >= LEAST_LOG_ODDS)
        .orderBy(F.desc(F.col("toxic") * F.col("odds")), "term", "whole")
        .limit(MAX_TERMS)
        .collect()
    )
    return [(r["term"], r["whole"]) for r in best]


def _add_features(learned: list[tuple[str, bool]], columns: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        featurize = Featurizer(learned)
        for batch in batches:
            rows = [featurize(t.as_py()) for t in batch.column("_text")]
            made = np.asarray(rows, np.float64).reshape(len(rows), len(FEATURES))
            kept = [batch.column(c) for c in columns]
            yield pa.RecordBatch.from_arrays(
                [*kept, *[pa.array(made[:, i]) for i in range(len(FEATURES))]],
                [*columns, *[f"_f_{f}" for f in FEATURES]],
            )

    return run


class ToxicityModel:
    """Terms, trees and calibration, or a constant where the labels hold one class only."""

    def __init__(self, terms=(), trees=None, calibration=None, constant: float = 0.0):
        self.terms, self.trees, self.calibration, self.constant = list(terms), trees, calibration, constant

    def features(self, docs: DataFrame) -> DataFrame:
        """``docs`` with its columns and the feature columns; needs ``_text``, which goes."""
        columns = [f for f in docs.schema.fields if f.name != "_text"]
        names = [f"_f_{f}" for f in FEATURES]
        schema = StructType([*columns, *[StructField(n, DoubleType()) for n in names]])
        made = docs.mapInArrow(_add_features(self.terms, [f.name for f in columns]), schema)
        return VectorAssembler(inputCols=names, outputCol="_features").transform(made)

    def score(self, docs: DataFrame) -> DataFrame:
        """``docs`` without ``_text`` and with ``_score``."""
        names = [c for c in docs.columns if c != "_text"]
        if self.trees is None:
            return docs.select(*names, F.lit(self.constant).alias("_score"))
        scored = self.trees.transform(self.features(docs))
        raw = vector_to_array("_probability")[1]
        if self.calibration is None:
            return scored.select(*names, raw.alias("_score"))
        scored = self.calibration.transform(scored.withColumn("_raw", raw))
        raw = F.col("_raw")
        # Inside a calibrated step the raw probability still orders documents, by a hair.
        score = F.least(F.lit(1.0), F.greatest(F.lit(0.0), 0.999 * F.col("_calibrated") + 0.001 * raw))
        return scored.select(*names, score.alias("_score"))


def training_sample(docs: DataFrame, labels: DataFrame, label: str, most: int) -> DataFrame:
    """At most about ``most`` labelled rows outside the held-out fold: doc_id, text, label, fold.

    Rows are drawn by a hash of the id, so the draw does not depend on the order. Labels other than
    0 and 1 and rows without id are left out; of several labels of one id the majority counts, a tie is 0.
    """
    usable = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id").agg((F.avg("label") > 0.5).cast("int").alias("label"))
    )
    total = usable.count()
    if total > most:
        draw = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(1 << 30))
        usable = usable.where(draw < int(most / total * (1 << 30)))
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)).cast("int")
    chosen = usable.withColumn("fold", fold)  # at most about `most` rows of three numbers
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return keep(texts.join(F.broadcast(chosen), "doc_id"), f"{label}-sample")


def fit(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS) -> ToxicityModel:
    sample = training_sample(docs, labels, "toxic", most)
    counts = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(counts) < 2:
        return ToxicityModel(constant=1.0 if counts.get(1) else 0.0)
    model = ToxicityModel(learn_terms(sample))
    made = model.features(
        sample.select(F.col("label").cast("double").alias("label"), "fold", F.col("text").alias("_text"))
    ).select("label", "fold", "_features")
    made = keep(made, "toxicity-features")
    folds = {(r["label"], r["fold"] == 4): r["count"] for r in
             made.groupBy("label", F.when(F.col("fold") == 4, 4).otherwise(1).alias("fold")).count().collect()}
    held = (0.0, True) in folds and (1.0, True) in folds
    learn = made.where("fold <> 4") if held and (0.0, False) in folds and (1.0, False) in folds else made
    trees = GBTClassifier(
        featuresCol="_features", labelCol="label", predictionCol="_class", maxIter=20, maxDepth=3, stepSize=0.3,
        maxBins=64, seed=7,
    )
    trees.setProbabilityCol("_probability").setRawPredictionCol("_margin")
    model.trees = trees.fit(learn.coalesce(4))
    raw = vector_to_array("_probability")[1].alias("_raw")
    seen = model.trees.transform(made.where("fold = 4") if held else made).select("label", raw)
    model.calibration = IsotonicRegression(
        featuresCol="_raw", labelCol="label", predictionCol="_calibrated", isotonic=True
    ).fit(seen)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, most: int = MAX_TRAINING_ROWS) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Null text counts as empty, which has features of zero and the score the trees give them.
    Rows are scored alone, so repeated rows get equal scores; a row without doc_id counts as held
    out. Labels of one class only, or none, make the score a constant (1 if all are toxic, else
    0). No documents give no rows.
    """
    model = fit(docs, labels, most)
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held_out"), whole_text().alias("_text")
    )
    return model.score(rows).select(
        "doc_id", "held_out", F.col("_score").alias("score"), (F.col("_score") >= 0.5).cast("int").alias("predicted")
    )
