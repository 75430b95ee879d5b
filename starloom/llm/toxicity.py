"""Toxicity scores: gradient-boosted trees over dense features, with isotonic calibration.

Features of a text are densities, not words: hits of a lexicon and of its prefixes, hits near a
second-person pronoun, capitals, punctuation, and words written to hide (digits or
symbols inside). The lexicon is a fixed list of English insults plus what a bounded sample of
labelled texts shows to be typical of toxic ones, in any language.

The sample is cut in three by doc_id: one part finds the lexicon, one grows the trees, one
calibrates their output, so none is judged on what it was fitted to.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from starloom.llm.common import sparing, staged
from starloom.llm.encoding import byte_slices, forget

#: Insults that count in any corpus, before anything is learned.
INSULTS = frozenset(
    "clown coward disgusting dumb fool garbage idiot imbecile jerk loser moron pathetic scum stupid trash ugly useless vermin worthless".split()
)
#: Second-person pronouns of English, German, French and Spanish.
SECOND_PERSON = frozenset("you your yours yourself u du dich dir dein deine ihr euch tu te toi ton ta tes vous vos votre usted ti tus ustedes".split())
#: Digits and symbols read as letters.
LOOKALIKES = str.maketrans("013457@$!|", "oieastasil")
PREFIXES = range(4, 9)
NEAR = 5
FEATURES = (
    "words", "hits", "hit_density", "weight_density", "largest_weight", "distinct_hits", "prefix_hits", "prefix_density",
    "near_second_person", "second_person", "capitals", "capital_words", "marks", "symbols", "hidden_words", "hidden_hits",
)
#: Columns of the model's own, which no caller's column is likely to be called.
FEATURE_COLUMN, VECTOR, LABEL, RAW = "__features", "__vector", "__label", "__raw"
INNER = re.compile(r"[^\w]|_")
MEMO = 200_000
#: Bytes of text handled together, and terms that are counted before the counts are passed on.
GROUP_BYTES, COUNTED = 1 << 20, 200_000


def core(word: str) -> str:
    """``word`` without punctuation at its ends."""
    i, j = 0, len(word)
    while i < j and not (word[i].isalnum() or word[i] in "_@$"):
        i += 1
    while j > i and not (word[j - 1].isalnum() or word[j - 1] in "_@$"):
        j -= 1
    return word[i:j]


@dataclass(frozen=True)
class Lexicon:
    """Words and prefixes with their log-odds of standing in a toxic text."""

    words: dict[str, float]
    prefixes: dict[str, float]


class Features:
    """Dense features of texts; remembers what it found about a word."""

    def __init__(self, lexicon: Lexicon) -> None:
        self.lexicon = lexicon
        self._forget()

    def _forget(self) -> None:
        self.memo: dict[str, int] = {}
        self.kinds: dict[tuple, int] = {}
        self.rows: list[tuple] = []
        self.table = np.zeros((0, 6))

    def _kind(self, word: str) -> int:
        """Number of what is known of a lower-case word: weight, prefix weight, pronoun, hidden, hidden hit, name."""
        bare = core(word)
        plain = INNER.sub("", bare.translate(LOOKALIKES))
        hidden = plain != bare and any(c.isalpha() for c in bare) and len(plain) > 2 and not any(c in bare for c in "'-.")
        own = self.lexicon.words.get(bare, 0.0)
        weight = own or self.lexicon.words.get(plain, 0.0)
        prefix = max((self.lexicon.prefixes.get(plain[:n], 0.0) for n in PREFIXES if len(plain) >= n), default=0.0)
        row = (weight, prefix, bare in SECOND_PERSON, hidden, bool(weight and not own), plain if weight or prefix else "")
        if row not in self.kinds:
            self.kinds[row] = len(self.rows)
            self.rows.append(row)
        return self.kinds[row]

    def of(self, text: str) -> list[float]:
        if len(self.memo) > MEMO:
            self._forget()
        words = text.lower().split()
        memo = self.memo
        for w in set(words):
            if w not in memo:
                memo[w] = self._kind(w)
        ids = np.fromiter((memo[w] for w in words), np.int64, len(words))
        if len(self.table) < len(self.rows):
            self.table = np.array([(*r[:5], i) for i, r in enumerate(self.rows)], dtype=float)
        n = max(1, len(words))
        weight, prefix, second, hidden, hidden_hit = (self.table[ids, k] for k in range(5)) if len(words) else [np.zeros(0)] * 5
        hit = (weight > 0) | (prefix > 0)
        at, you = np.flatnonzero(hit), np.flatnonzero(second)
        near = 0
        if len(at) and len(you):
            to = np.searchsorted(you, at)
            gap = np.minimum(np.abs(you[np.minimum(to, len(you) - 1)] - at), np.abs(you[np.maximum(to - 1, 0)] - at))
            near = int((gap <= NEAR).sum())
        byte = np.bincount(np.frombuffer(text.encode(), np.uint8), minlength=256)
        upper, letters = byte[65:91].sum(), max(1, byte[65:91].sum() + byte[97:123].sum())
        size = max(1, byte.sum())
        shouted = sum(w.isupper() and len(w) > 2 for w in text.split()) if upper > n else 0
        both = np.maximum(weight, prefix)
        return [
            math.log1p(len(words)), float((weight > 0).sum()), (weight > 0).sum() / n, both.sum() / n, both.max(initial=0.0),
            float(len(np.unique(ids[at]))), float((prefix > 0).sum()), (prefix > 0).sum() / n, near / n, second.sum() / n,
            upper / letters, shouted / n, (byte[33] + byte[63]) / size, (byte[33:48].sum() + byte[58:65].sum() + byte[91:97].sum()) / size,
            hidden.sum() / n, hidden_hit.sum() / n,
        ]


def with_features(texts: DataFrame, lexicon: Lexicon, keep_text: bool = False) -> DataFrame:
    """``texts`` (text, any further columns) with ``FEATURE_COLUMN``, and without the text unless it is kept."""
    kept = [f for f in texts.schema if keep_text or f.name != "text"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        features = Features(lexicon)
        for batch in batches:
            for i, j in byte_slices(batch.column("text"), GROUP_BYTES):
                found = [features.of(t or "") for t in batch.column("text")[i:j].to_pylist()]
                columns = [*(batch.column(f.name)[i:j] for f in kept), pa.array(found, pa.list_(pa.float64()))]
                yield pa.RecordBatch.from_arrays(columns, [*(f.name for f in kept), FEATURE_COLUMN])

    schema = texts.select(*(f.name for f in kept), F.array(F.lit(0.0)).alias(FEATURE_COLUMN)).schema
    return texts.mapInArrow(sparing(run), schema)


def held_out(doc_id: Column) -> Column:
    """Documents whose labels are never learned from."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def learned_lexicon(sample: DataFrame, most: int = 1000, times_likelier: float = 8.0) -> Lexicon:
    """Words and prefixes of ``sample`` (text, toxic) that are ``times_likelier`` in toxic texts; at most ``most`` of each."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        counts: dict[int, Counter] = {0: Counter(), 1: Counter()}

        def counted() -> Iterator[pa.RecordBatch]:
            for toxic, found in counts.items():
                terms, times = list(found), list(found.values())
                found.clear()
                for i in range(0, len(terms), 50_000):
                    part = terms[i : i + 50_000], [toxic] * len(terms[i : i + 50_000]), times[i : i + 50_000]
                    yield pa.RecordBatch.from_arrays([pa.array(part[0]), pa.array(part[1], pa.int32()), pa.array(part[2], pa.int64())], ["term", "toxic", "times"])

        for part in (b.slice(i, j - i) for b in batches for i, j in byte_slices(b.column("text"), GROUP_BYTES)):
            for text, toxic in zip(part.column("text").to_pylist(), part.column("toxic").to_pylist(), strict=True):
                words = {INNER.sub("", core(w).translate(LOOKALIKES)) for w in (text or "").lower().split()}
                counts[toxic].update({w + "$" for w in words} | {w[:n] for w in words for n in PREFIXES if len(w) >= n})
                counts[toxic][""] += 1  # the text itself
            if sum(map(len, counts.values())) >= COUNTED:
                yield from counted()
        yield from counted()

    parts = sample.select("text", F.col("toxic").cast("int")).mapInArrow(sparing(run), "term string, toxic int, times long")
    sums = staged(
        parts.groupBy("term").agg(
            F.sum(F.when(F.col("toxic") == 1, F.col("times")).otherwise(0)).alias("bad"), F.sum(F.when(F.col("toxic") == 0, F.col("times")).otherwise(0)).alias("good")
        ),
        "terms",
    )
    total = sums.where("term = ''").first()
    bad, good = (max(1, total["bad"]), max(1, total["good"])) if total else (1, 1)
    odds = F.log(((F.col("bad") + 0.5) / bad) / ((F.col("good") + 0.5) / good))
    typical = sums.where(f"term != '' AND bad >= {max(3, bad * 0.004)}").withColumn("odds", odds).where(F.col("odds") >= math.log(times_likelier))

    def best(rows: DataFrame) -> dict[str, float]:
        return {r["term"].removesuffix("$"): r["odds"] for r in rows.orderBy(F.desc("odds"), "term").limit(most).collect()}

    words = best(typical.where("term LIKE '%$'"))
    return Lexicon({**{w: 4.0 for w in INSULTS}, **{w: o for w, o in words.items() if len(w) > 2}}, best(typical.where("term NOT LIKE '%$'")))


def toxicity_scorer(docs: DataFrame, labels: DataFrame, most_labelled: int = 30_000) -> Callable[..., DataFrame]:
    """Learn from ``labels`` (doc_id, toxic) on ``docs``; gives a function that adds ``score`` to (text, ...).

    That function drops the text unless called with ``keep_text=True``; other columns pass, whatever
    their names, but one called score, which raises.

    Learned from are labelled, not held-out documents, about ``most_labelled`` of them if there
    are more, chosen by a hash of doc_id; equal texts count once. Repeated labels: toxic if one
    says so. Null labels and labels without a document are left out. With no labels, or one
    class only, the score is that class (0 without labels).
    """
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    known = known.groupBy(F.col("doc_id").cast("long").alias("id")).agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    total = known.count()
    if total > most_labelled:
        known = known.where(F.pmod(F.xxhash64("id"), F.lit(1_000_000)) < int(1_000_000 * most_labelled / total))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = texts.join(known, texts["doc_id"] == known["id"]).drop("id")
    # Equal texts once, told apart by their hashes; the row of the smallest id stays.
    first = rows.groupBy(F.xxhash64("text").alias("h"), F.length("text").alias("n")).agg(F.min(F.struct("doc_id", "text", "toxic")).alias("one")).select("one.*")
    sample = staged(first.withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(20))), "sample")
    classes = [r[0] for r in sample.select("toxic").distinct().collect()]
    if len(classes) < 2:
        only = float(classes[0]) if classes else 0.0
        return lambda d, keep_text=False: (d if keep_text else d.drop("text")).withColumn("score", F.lit(only))
    lexicon = learned_lexicon(sample.where("part < 10"))
    rated = staged(with_features(sample.where("part >= 6"), lexicon).withColumn(VECTOR, array_to_vector(FEATURE_COLUMN)).withColumn(LABEL, F.col("toxic").cast("double")), "features")
    # The sample is bounded, and growing trees is many short jobs: few partitions keep them short.
    grown, rest = rated.where("part < 16").coalesce(2), rated.where("part >= 14").coalesce(2)
    if grown.select(LABEL).distinct().count() < 2:
        grown = rated
    trees = GBTClassifier(featuresCol=VECTOR, labelCol=LABEL, predictionCol="__prediction", maxIter=12, maxDepth=4, stepSize=0.3, maxBins=32, minInstancesPerNode=4, seed=5).fit(grown)
    trees = trees.setProbabilityCol("__probability").setRawPredictionCol("__raw_prediction")
    raw = lambda d: trees.transform(d).withColumn(RAW, vector_to_array("__probability")[1])
    calibration = IsotonicRegression(featuresCol=RAW, labelCol=LABEL, predictionCol="score").fit(raw(rest).select(RAW, LABEL))

    def score(d: DataFrame, keep_text: bool = False) -> DataFrame:
        if "score" in d.columns:
            raise ValueError("the texts have a column score already")
        vectors = with_features(d, lexicon, keep_text).withColumn(VECTOR, array_to_vector(FEATURE_COLUMN))
        scored = calibration.transform(raw(vectors)).withColumn("score", F.greatest(F.lit(0.0), F.least(F.lit(1.0), "score")))
        return scored.drop(FEATURE_COLUMN, VECTOR, RAW, "__prediction", "__probability", "__raw_prediction")

    return score


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, most_labelled: int = 30_000) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of ``docs`` (doc_id, text).

    Whole texts are scored; the score depends on the text alone. Null text is empty. Null and
    repeated doc_ids: one row each. A text of any length is one list of words, in some 35 times
    its own memory. Empty docs: no rows.
    """
    score = toxicity_scorer(docs, labels, most_labelled)
    return score(docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted")
    )
