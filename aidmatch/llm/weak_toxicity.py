"""Toxicity by weak supervision.

Voters are words of a fixed lexicon, words and word beginnings that the labelled
rows show to go with toxic texts, and patterns of writing; a voter that finds
nothing abstains. A generative label model estimates how often each voter speaks
for either class (expectation-maximisation from the labels) and how voters
correlate given the class, so that voters who repeat each other count less. A
linear classifier is then trained on its posterior labels and scores every text.

Fitting uses at most ``TRAIN_ROWS`` labelled rows, those with the smallest hash
of their id, and never a held-out row (crc32 of the id as text divisible by 5).
Scoring reads whole texts of all rows and nothing but the text.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from aidmatch.llm.common import whole_text

TRAIN_ROWS = 8_000
#: Most mined voters.
VOTERS = 256
BEGINNINGS = (3, 4, 5, 6)
#: A mined voter speaks in so many toxic training rows at least, and in this share of them.
LEAST_ROWS, LEAST_SHARE = 3, 0.01
#: ... and so many times as often in toxic rows as in others.
LEAST_RATIO = 5.0
ROUNDS = 10
STEPS = 30
#: Log odds of a label being right.
LABEL_WEIGHT = 4.0
PENALTY = 0.1

#: Fixed list of insults.
LEXICON = (
    "idiot stupid moron loser pathetic worthless disgusting scum trash clown imbecile dumb fool jerk "
    "idiota estúpido imbécil idiote crétin débile dumm dummkopf trottel arschloch"
).split()
_WORD = re.compile(r"[^\W\d_]+")
_PATTERNS = {
    "shouting": re.compile(r"[A-Z]{3,}(?:\W+[A-Z]{3,}){4}"), "marks": re.compile(r"[!?]{3}"),
    "address": re.compile(r"(?i:\b(?:you|tu|du|usted|vous|ihr)\b)"), "masked": re.compile(r"[A-Za-z][*#@$%]{2,}[A-Za-z]"),
}


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.encode(F.col(doc_id).cast("string"), "UTF-8")) % 5 == 0, F.lit(False))


def _names(text: str) -> set[str]:
    """Words of a text and their beginnings, in lower case."""
    words = set(_WORD.findall(text.lower()))
    names = {f"{w} " for w in words}
    for n in BEGINNINGS:
        names.update(w[:n] for w in words if len(w) >= n)
    return names


class Model:
    """Voters by name and the weights of the classifier: bias, patterns, lexicon, mined voters."""

    def __init__(self, mined: list[str], weights: np.ndarray):
        self.mined, self.weights = mined, weights
        self.place = {name: i for i, name in enumerate(mined)}
        self.words = {n: i for n, i in self.place.items() if n.endswith(" ")}
        self.starts = {k: {n: i for n, i in self.place.items() if len(n) == k and not n.endswith(" ")} for k in BEGINNINGS}

    @property
    def size(self) -> int:
        return 1 + len(_PATTERNS) + 1 + len(self.mined)

    def voices(self, text: str) -> list[int]:
        """Which features speak in a text."""
        found = {0}
        found.update(i for i, p in enumerate(_PATTERNS.values(), 1) if p.search(text))
        first = len(_PATTERNS) + 2
        for word in set(_WORD.findall(text.lower())):
            if word in _LEXICON:
                found.add(first - 1)
            i = self.words.get(word + " ")
            if i is not None:
                found.add(first + i)
            for k, names in self.starts.items():
                i = names.get(word[:k])
                if i is not None:
                    found.add(first + i)
        return sorted(found)

    def score(self, text: str) -> float:
        return float(1 / (1 + np.exp(-np.clip(self.weights[self.voices(text)].sum(), -50, 50))))


_LEXICON = frozenset(LEXICON)


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: tuple[Counter, Counter] = (Counter(), Counter())
    for batch in batches:
        for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            counts[toxic].update(_names(text))
    # a voter needs toxic rows to speak in, so names without any need not travel
    names = list(counts[1])
    yield pa.RecordBatch.from_arrays(
        [pa.array(names, pa.string()), *(pa.array([counts[y][n] for n in names], pa.int64()) for y in (1, 0))],
        names=["name", "toxic", "clean"],
    )


def _mine(rows: DataFrame, toxic: int, clean: int) -> list[str]:
    """Names that go with toxic rows, by their surplus over what chance would give.

    All training rows are counted in one place a task each; names that a task
    met in clean rows only are counted again once the candidates are known.
    """
    least = max(LEAST_ROWS, int(np.ceil(LEAST_SHARE * toxic)))
    counted = rows.mapInArrow(_count, "name string, toxic bigint, clean bigint").groupBy("name").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")
    )
    ratio = (F.col("toxic") + 0.5) / (toxic + 1) / ((F.col("clean") + 0.5) / (clean + 1))
    many = counted.filter((F.col("toxic") >= least) & (ratio >= LEAST_RATIO)).withColumn("gain", F.col("toxic") * F.log(ratio))
    top = many.orderBy(F.desc("gain"), "name").limit(4 * VOTERS).collect()  # a bounded list of candidates
    names = [r["name"] for r in top]
    wanted = frozenset(names)

    def clean_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter()
        for batch in batches:
            for text, is_toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not is_toxic:
                    counts.update(_names(text) & wanted)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["name", "n"]
        )

    seen = dict(rows.mapInArrow(clean_rows, "name string, n bigint").groupBy("name").agg(F.sum("n")).collect())
    kept = []
    for r in top:
        share = (r["toxic"] + 0.5) / (toxic + 1) / ((seen.get(r["name"], 0) + 0.5) / (clean + 1))
        if share >= LEAST_RATIO:
            kept.append((-r["toxic"] * np.log(share), r["name"]))
    return [name for _, name in sorted(kept)[:VOTERS]]


def label_model(votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Posterior of class 1 for rows of votes (speaks or abstains), from voters' accuracies and correlations.

    Starts from the labels, then alternates: rates of every voter in both
    classes, correlations of voters within the classes, posteriors.
    """
    posterior = np.where(labels == 1, 0.95, 0.05)
    for _ in range(ROUNDS):
        balance = np.clip(posterior.mean(), 1e-3, 1 - 1e-3)
        rates, spread = [], 0.0
        for weight in (1 - posterior, posterior):
            rate = (weight @ votes + 0.5) / (weight.sum() + 1)
            rest = (votes - rate) * np.sqrt(weight)[:, None]
            spread = spread + rest.T @ rest
            rates.append(rate)
        scale = np.sqrt(np.diag(spread)) + 1e-9
        related = np.abs(spread / scale / scale[:, None])
        # small correlations are chance; its own is 1
        independent = 1 / np.where(related > 0.2, related, 0).sum(axis=0).clip(1)
        for_one = np.log(rates[1] / rates[0]) * independent
        against = np.log((1 - rates[1]) / (1 - rates[0])) * independent
        logit = np.log(balance / (1 - balance)) + votes @ for_one + (1 - votes) @ against
        # a label is one more voter
        logit += np.where(labels == 1, LABEL_WEIGHT, -LABEL_WEIGHT)
        posterior = 1 / (1 + np.exp(-np.clip(logit, -30, 30)))
    return posterior


def fit_linear(x: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Weights of a logistic classifier for soft targets, by Newton steps; there are a few hundred weights."""
    ridge = np.full(x.shape[1], PENALTY)
    ridge[0] = 1e-6
    weights = np.zeros(x.shape[1])
    for _ in range(STEPS):
        chance = 1 / (1 + np.exp(-np.clip(x @ weights, -50, 50)))
        up = x.T @ (target - chance) - ridge * weights
        bend = (x * (chance * (1 - chance) + 1e-6)[:, None]).T @ x + np.diag(ridge)
        step = np.linalg.solve(bend, up)
        weights = weights + step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
    return weights


def fit(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """The model from the labelled rows that are not held out. Without toxic or clean rows every text scores low or high."""
    chosen = labels.filter("toxic IN (0, 1)").filter(~held_out()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows)
    # at most train_rows pairs of numbers
    rows = docs.select("doc_id", whole_text().alias("text")).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")
    one = rows.dropDuplicates(["doc_id"]).select("text", F.col("toxic").cast("int").alias("toxic")).repartition(
        max(2, docs.sparkSession.sparkContext.defaultParallelism)
    ).persist()
    try:
        sizes = {r["toxic"]: r["n"] for r in one.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
        toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
        empty = Model([], np.zeros(len(_PATTERNS) + 2))
        empty.weights[0] = np.log((toxic + 0.5) / (clean + 9.5))
        if not toxic or not clean:
            return empty
        shape = Model(_mine(one, toxic, clean), empty.weights)

        def hear(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([shape.voices(t) for t in batch.column(0).to_pylist()], pa.list_(pa.int32())), batch.column(1)],
                    names=["voices", "toxic"],
                )

        heard = one.mapInArrow(hear, "voices array<int>, toxic int").collect()  # train_rows rows of a few numbers
    finally:
        one.unpersist()
    heard = sorted((tuple(r["voices"]), r["toxic"]) for r in heard)
    x = np.zeros((len(heard), shape.size))
    for i, (voices, _) in enumerate(heard):
        x[i, list(voices)] = 1
    posterior = label_model(x[:, 1:], np.array([y for _, y in heard]))
    return Model(shape.mined, fit_linear(x, posterior))


def with_score(docs: DataFrame, model: Model, name: str = "score") -> DataFrame:
    """Add the score of every text, 0 to 1; null texts count as empty."""
    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) for t in texts], dtype="float64")

    return docs.withColumn(name, score(whole_text()))


def score_toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Every row as ``doc_id, held_out, score, predicted``. Rows of one id stay apart; an empty table gives an empty result."""
    scored = with_score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without the rows that score 0.5 or more, all columns as they were."""
    name = "_toxicity_score"
    return with_score(docs, fit(docs, labels), name).filter(F.col(name) < 0.5).drop(name)
