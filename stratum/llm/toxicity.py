"""Toxicity by a weighted lexicon.

Texts are folded first: lower case, accents and compatibility forms removed,
look-alike letters of other scripts, digits and signs mapped to the Latin letter
they stand for, invisible characters dropped, everything else a blank.  Terms are
word beginnings; one Aho-Corasick pass over the folded text finds them, and a
match inside an exception phrase does not count.  The sum of the weights found,
its ratio to the length, and the number of different terms go into a logistic
score.

Terms and weights are learned from labelled rows: word beginnings that are far
more frequent in toxic documents than in others, weighted by the log-odds, next to
a few given seeds.  At most ``sample_rows`` labelled rows are used (those with
the smallest hash of their doc_id), each with one text, the least; part of them learn the lexicon and the rest
the score, which is fitted on the driver from five numbers a row.

Defined results: a null or empty text folds to nothing and gets the score of a
document without a match; repeated rows score alike; without labels, or without
labels of both kinds, the seeds and a default score are used; label rows with
nulls are left out, and a doc_id labelled twice is toxic if one label says so.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import map_rows, read_table, spool

SAME_SHAPE = {
    "o": "0оοσ०ѳ", "i": "1lіӏιı|ⅼ", "e": "3еєε", "a": "4@аαɑ", "s": "5$ѕꜱ", "t": "7тτ", "b": "8вβьъ", "g": "9ɡց",
    "c": "сϲ¢", "p": "рρ", "x": "хχ×", "y": "уγү", "k": "кκ", "m": "м", "h": "нһ", "n": "пη", "u": "υս", "w": "ԝω", "d": "ԁ", "j": "ј", "r": "гᴦ", "v": "ν",
}
SEEDS = ("idiot", "moron", "stupid", "pathetic", "worthless", "disgusting", "scum", "loser", "imbecile", "bastard", "retard")
EXCEPTIONS = ("clown fish", "clownfish", "circus clown", "trash can", "trash bag", "trash bin", "pathetic fallacy", "sore loser clause")


class Folding(dict):
    """A translation table that works out characters as they come."""

    def __init__(self):
        super().__init__({ord(c): to for to, same in SAME_SHAPE.items() for c in same})

    def __missing__(self, code: int):
        c = chr(code)
        to = unicodedata.normalize("NFKD", c)[:1].lower()
        kind = unicodedata.category(c)
        if kind in ("Mn", "Me", "Cf"):
            value = None
        elif to != c and ord(to) in self:
            value = self[ord(to)]
        else:
            value = to if to.isalpha() else " "
        self[code] = value
        return value


FOLDING = Folding()


def fold(text: str | None) -> str:
    return f" {text.lower().translate(FOLDING)} " if text else " "


@dataclass(frozen=True)
class ToxicityParams:
    sample_rows: int = 12_000
    shortest: int = 4
    longest: int = 16
    least_ratio: float = 2.5  # log-odds
    least_z: float = 4.0
    max_terms: int = 2_000
    seeds: tuple[str, ...] = SEEDS
    exceptions: tuple[str, ...] = EXCEPTIONS


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    exceptions: tuple[str, ...]
    coefficients: tuple[float, ...]  # intercept first

    def automaton(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for term, w in self.weights.items():
            found.add_word(" " + term, (len(term) + 1, term, w))
        for phrase in self.exceptions:
            folded = fold(phrase).rstrip()
            if folded not in found:
                found.add_word(folded, (len(folded), None, 0.0))
        found.make_automaton()
        return found


def features(text: str | None, automaton: ahocorasick.Automaton) -> tuple[float, ...]:
    """log sum of weights, that sum per word and per root of the words, number of
    different terms; all 0 without a match."""
    folded = fold(text)
    hits, spared = [], []
    for last, (size, term, w) in automaton.iter(folded):
        (spared if term is None else hits).append((last + 1 - size, last + 1, term, w))
    if spared:
        hits = [h for h in hits if not any(a <= h[0] and h[1] <= b for a, b, _, _ in spared)]
    if not hits:
        return 0.0, 0.0, 0.0, 0.0
    best: dict[int, tuple] = {}  # the longest term at a place
    for h in hits:
        if h[0] not in best or h[1] > best[h[0]][1]:
            best[h[0]] = h
    total = sum(h[3] for h in best.values())
    n = max(1, len(folded.split()))
    return math.log1p(total), total / n, total / math.sqrt(n), float(len({h[2] for h in best.values()}))


def term_counts(sample: DataFrame) -> DataFrame:
    """(word, toxic, clean): in how many documents of either label a folded word stands."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = (Counter(), Counter())
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                seen[toxic].update(set(fold(text).split()))
        words = list(seen[0] | seen[1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(words, pa.string()), pa.array([seen[1][w] for w in words], pa.int64()), pa.array([seen[0][w] for w in words], pa.int64())],
            names=["word", "toxic", "clean"],
        )

    rows = sample.select("text", "toxic").mapInArrow(count, "word string, toxic bigint, clean bigint")
    return rows.groupBy("word").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def learn_lexicon(sample: DataFrame, params: ToxicityParams) -> dict[str, float]:
    n = {r["toxic"]: r["n"] for r in sample.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    weights: dict[str, float] = {}
    if n.get(1) and n.get(0):
        words = term_counts(sample).where(F.length("word") >= params.shortest)
        length = F.explode(F.sequence(F.lit(params.shortest), F.least(F.length("word"), F.lit(params.longest))))
        starts = words.select("word", "toxic", "clean", length.alias("k")).groupBy(F.substring("word", F.lit(1), F.col("k")).alias("term"))
        starts = starts.agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
        a, b = (F.col("toxic") + 0.5) / (n[1] + 1), (F.col("clean") + 0.5) / (n[0] + 1)
        odds = F.log(a / b)
        z = odds / F.sqrt(1 / (F.col("toxic") + 0.5) + 1 / (F.col("clean") + 0.5))
        rows = (
            starts.where(F.col("toxic") >= max(3, n[1] // 100)).select("term", "toxic", odds.alias("odds"), z.alias("z"))
            .where((F.col("odds") >= params.least_ratio) & (F.col("z") >= params.least_z))
            .orderBy(F.desc("z"), "term").limit(params.max_terms).collect()
        )
        found = {r["term"]: r for r in rows}

        def said_longer(term: str) -> bool:
            """Whether a longer beginning is in nearly as many toxic documents."""
            return any(x != term and x.startswith(term) and found[x]["toxic"] >= 0.9 * found[term]["toxic"] for x in found)

        kept = [t for t in found if not said_longer(t)]
        weights = {t: min(8.0, found[t]["odds"]) for t in kept if not any(t != k and t.startswith(k) for k in kept)}
    usual = sorted(weights.values())[len(weights) // 2] if weights else 4.0
    for seed in params.seeds:
        folded = fold(seed).strip()
        if not any(folded.startswith(t) for t in weights):
            weights[folded] = usual
    return weights


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 0.01) -> np.ndarray:
    """Coefficients, intercept first, by Newton steps on standardised columns."""
    mean, scale = x.mean(0), x.std(0) + 1e-9
    z = np.hstack([np.ones((len(x), 1)), (x - mean) / scale])
    w = np.zeros(z.shape[1])
    ridge = penalty * np.eye(len(w))
    ridge[0, 0] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) / len(y) + ridge @ w
        hess = (z * (p * (1 - p))[:, None]).T @ z / len(y) + ridge
        step = np.linalg.solve(hess, grad)
        w -= step
        if np.abs(step).max() < 1e-8:
            break
    w[1:] /= scale
    w[0] -= (w[1:] * mean).sum()
    return w


def learn(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams()) -> Model:
    """A model from the labelled rows whose crc32(doc_id) mod 5 is not 0: rests 1
    to 3 learn the lexicon, rest 4 the score."""
    rest = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    chosen = (
        labels.where("doc_id is not null and toxic is not null").where(rest != 0)
        .groupBy("doc_id").agg(F.max((F.col("toxic") > 0).cast("int")).alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.sample_rows)
    )
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    sample = spool(found.groupBy("doc_id", "toxic").agg(F.min("text").alias("text")).withColumn("rest", rest))
    weights = learn_lexicon(sample.where("rest < 4"), params)
    model = Model(weights, params.exceptions, ())
    rows = map_rows(sample, lambda: _scorer(model), ["text"], "x array<double>", ["toxic", "rest"]).drop("rest").collect()  # at most sample_rows
    y = np.array([r["toxic"] for r in rows], float)
    if len(y) and 0 < y.sum() < len(y):
        w = fit_logistic(np.array([r["x"] for r in rows]), y)
    else:
        w = np.array([-4.0, 2.5, 0.0, 0.0, 0.5])
    return Model(weights, params.exceptions, tuple(float(v) for v in w))


def _scorer(model: Model):
    automaton = model.automaton()
    return lambda rows: [(list(features(x, automaton)),) for (x,) in rows]


def score(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """``keep`` columns and ``score`` from 0 to 1; one pass, no shuffle."""

    def make():
        automaton, w = model.automaton(), model.coefficients

        def one(text):
            z = w[0] + sum(a * b for a, b in zip(w[1:], features(text, automaton)))
            return (1 / (1 + math.exp(-max(-30.0, min(30.0, z)))),)

        return lambda rows: [one(x) for (x,) in rows]

    return map_rows(docs, make, ["text"], "score double", keep)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row without a doc_id is not held out (it has no label to learn from either)."""
    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs, read_table(spark, sf_dir, "labels"))
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))
    return score(docs, model, ["doc_id"]).select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
