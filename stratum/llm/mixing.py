"""Mixing to target weights with soft membership.

Domains are cells of the ``labels`` table: ``toxic`` (toxic = 1), ``junk`` (not toxic,
quality = 0) and ``good`` (the rest).  A Gaussian naive Bayes classifier, fitted on
at most ``sample_rows`` labelled documents from aggregates, predicts each document's
domain posterior; posteriors are rounded to multiples of 1/``grid`` that sum to 1.  One of
its features is how many words in a hundred begin with a cue, a word beginning that
tells toxic documents from others.  Cues are chosen on one half of the labelled
documents (at least 1 % of the toxic ones, log-odds and their z above floors), and
kept if their log-odds are above the floor in the other half too.

Document rates r >= 0 (at most ``max_rate``) are fitted so that the expected domain
token totals ``sum(r * tokens * posterior)`` match ``weight * budget``: projected
gradient steps on the squared residuals, each divided by the larger of the target
and the domain's own tokens, with momentum.  In the metric that weighs rates by
tokens the gradient of a document depends on its posterior only, so documents
are pre-aggregated into posterior cells, of which there are at most
``(grid + 1)(grid + 2) / 2`` for three domains, whatever the corpus.  A step is one
distributed sum over the cells; the driver holds the residuals of past steps
only, and every rate is a fold over them.

A document's copies are its rate rounded down, plus one with the probability of the
fraction, decided by a hash of the document.

All of it is DataFrame functions.  Defined results: null texts have no tokens;
repeated rows get the same rate; without labelled documents every posterior is
``good``; label rows with nulls are left out, and contradicting rows of a doc_id count
as toxic before junk before good; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import fresh_name, read_table, small_side, spool

DOMAINS = ("good", "junk", "toxic")
STEM = r"(?<!\p{L})\p{L}{4,6}"


@dataclass(frozen=True)
class MixingParams:
    weights: dict[str, float] = field(default_factory=lambda: {"good": 0.92, "junk": 0.06, "toxic": 0.02})
    budget_ratio: float = 1.0  # tokens wanted, as a share of the corpus
    max_rate: float = 4.0
    sample_rows: int = 12_000
    cues: int = 64
    least_ratio: float = 4.5  # log-odds of a cue
    least_z: float = 4.0
    grid: int = 200
    max_steps: int = 80
    tolerance: float = 1e-4  # of a domain's tokens


def stems(text: str) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(F.col(text), F.lit(""))), F.lit(STEM), F.lit(0))


def count_of(text: str, pattern: str) -> Column:
    return F.regexp_count(F.coalesce(F.col(text), F.lit("")), F.lit(pattern)).cast("double")


def describe(docs: DataFrame, text: str, cues: list[str], names: dict[str, str]) -> DataFrame:
    """``docs`` without the text, with the number of words and the features."""
    chars = F.length(F.coalesce(F.col(text), F.lit(""))).cast("double")
    with_words = docs.withColumn(names["n"], count_of(text, r"\S+"))
    n = F.greatest(F.col(names["n"]), F.lit(1.0))
    hits = F.size(F.filter(stems(text), lambda s: s.isin(*cues))) if cues else F.lit(0)
    x = F.array(
        F.log1p(100 * count_of(text, r"[#*$%&|<>]") / n),
        F.log1p(100 * count_of(text, r"[A-Z]") / n),
        chars / n,
        F.log1p(n),
        F.log1p(100 * hits.cast("double") / n),
    )
    return with_words.withColumn(names["x"], x).drop(text)


FEATURES = 5


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """(doc_id, text, domain number) of labelled documents, the smallest hashes first."""
    domain = F.when(F.col("toxic") > 0, 2).when(F.col("quality") == 0, 1).otherwise(0)
    chosen = (
        labels.where("doc_id is not null and toxic is not null and quality is not null")
        .groupBy("doc_id").agg(F.max(domain).alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    )
    return spool(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id"))


def learn_cues(sample: DataFrame, params: MixingParams) -> list[str]:
    """Word beginnings that tell toxic documents from others, chosen on one half of
    the documents and judged on the other."""
    toxic, second = F.col("domain") == 2, F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(2)) == 1
    parts = {"t1": toxic & ~second, "c1": ~toxic & ~second, "t2": toxic & second, "c2": ~toxic & second}
    counts = [F.count_if(part).alias(name) for name, part in parts.items()]
    count = sample.groupBy().agg(*counts).first()
    if not all(count):
        return []
    seen = sample.select("doc_id", "domain", F.explode(F.array_distinct(stems("text"))).alias("stem")).groupBy("stem").agg(*counts)
    odds = {k: F.log((F.col(f"t{k}") + 0.5) / (count[f"t{k}"] + 1) / (F.col(f"c{k}") + 0.5) * (count[f"c{k}"] + 1)) for k in (1, 2)}
    z = odds[1] / F.sqrt(1 / (F.col("t1") + 0.5) + 1 / (F.col("c1") + 0.5))
    strong = (F.col("t1") >= max(3, count["t1"] // 100)) & (z >= params.least_z)
    chosen = seen.where(strong & (odds[1] > params.least_ratio) & (odds[2] > params.least_ratio))
    return [r["stem"] for r in chosen.orderBy(F.desc(z), "stem").limit(params.cues).collect()]


@dataclass(frozen=True)
class DomainModel:
    cues: tuple[str, ...]
    prior: tuple[float, ...]
    mean: tuple[tuple[float, ...], ...]
    variance: tuple[tuple[float, ...], ...]


def learn_domains(docs: DataFrame, labels: DataFrame, params: MixingParams) -> DomainModel | None:
    sample = labelled_sample(docs, labels, params.sample_rows)
    cues = learn_cues(sample, params)
    names = {"n": "n", "x": "x"}
    described = describe(sample, "text", cues, names)
    stats = [F.count(F.lit(1)).alias("rows")]
    for k in range(FEATURES):
        stats += [F.avg(F.col("x")[k]).alias(f"m{k}"), F.var_pop(F.col("x")[k]).alias(f"v{k}")]
    by = {r["domain"]: r for r in described.groupBy("domain").agg(*stats).collect()}
    if not by:
        return None
    total = sum(r["rows"] for r in by.values())
    pooled = [sum(r["rows"] * r[f"v{k}"] for r in by.values()) / total for k in range(FEATURES)]
    prior, mean, variance = [], [], []
    for d in range(len(DOMAINS)):
        r = by.get(d)
        prior.append((r["rows"] if r else 0) / total)
        mean.append(tuple(r[f"m{k}"] for k in range(FEATURES)) if r else (0.0,) * FEATURES)
        variance.append(tuple(max(r[f"v{k}"], 0.05 * pooled[k], 1e-3) for k in range(FEATURES)) if r else (1.0,) * FEATURES)
    return DomainModel(tuple(cues), tuple(prior), tuple(mean), tuple(variance))


def posterior_cell(model: DomainModel | None, x: str, grid: int) -> Column:
    """The posterior in multiples of 1/``grid``, as integers that sum to ``grid``."""
    if model is None:
        return F.array(F.lit(grid), *[F.lit(0)] * (len(DOMAINS) - 1))
    logs = []
    for p, mean, variance in zip(model.prior, model.mean, model.variance):
        if not p:
            logs.append(F.lit(-1e9))
            continue
        score = F.lit(math.log(p))
        for k, (m, v) in enumerate(zip(mean, variance)):
            score = score - (F.col(x)[k] - m) * (F.col(x)[k] - m) / (2 * v) - 0.5 * math.log(v)
        logs.append(score)
    peak = F.greatest(*logs)
    weights = [F.exp(s - peak) for s in logs]
    total = sum(weights[1:], weights[0])
    cells = [F.floor(grid * w / total).cast("int") for w in weights]
    rest = grid - sum(cells[1:], cells[0])
    best = F.least(*[F.when(s == peak, k).otherwise(len(logs)) for k, s in enumerate(logs)])
    return F.array(*[c + F.when(best == k, rest).otherwise(0) for k, c in enumerate(cells)])


def rate_of(cell: str, steps: list[tuple[list[float], float]], grid: int, max_rate: float) -> Column:
    """Rate and look-ahead rate of a posterior cell after the given steps (gradient
    by domain, momentum), from rate 1."""
    history = F.array(*[F.struct(F.array(*map(F.lit, g)).alias("g"), F.lit(float(b)).alias("b")) for g, b in steps])
    start = F.struct(F.lit(1.0).alias("r"), F.lit(1.0).alias("y"))
    if not steps:
        return start

    def step(state, s):
        slope = sum((F.col(cell)[k] * s["g"][k] for k in range(1, len(DOMAINS))), F.col(cell)[0] * s["g"][0]) / float(grid)
        new = F.least(F.lit(float(max_rate)), F.greatest(F.lit(0.0), state["y"] - slope))
        return F.struct(new.alias("r"), (new + s["b"] * (new - state["r"])).alias("y"))

    return F.aggregate(history, start, step)


def fit_rates(cells: DataFrame, params: MixingParams) -> tuple[list[tuple[list[float], float]], dict]:
    """The steps of the descent over ``cells`` (cell, tokens), and its report."""

    def totals(steps: list, part: str) -> list[float]:
        rated = cells.select("cell", "tokens", rate_of("cell", steps, params.grid, params.max_rate)[part].alias("r"))
        sums = [F.sum(F.col("r") * F.col("tokens") * F.col("cell")[k] / float(params.grid)) for k in range(len(DOMAINS))]
        return [v or 0.0 for v in rated.agg(*sums).first()]

    own = totals([], "r")
    budget = params.budget_ratio * sum(own)
    share = sum(params.weights.values())
    target = [budget * params.weights.get(d, 0.0) / share for d in DOMAINS]
    scale = [max(a, b, 1.0) for a, b in zip(own, target)]
    steps: list[tuple[list[float], float]] = []
    t, reached, gradient = 1.0, own, None
    for _ in range(params.max_steps if budget else 0):
        seen = totals(steps, "y")
        before, gradient = gradient, [(s - w) / c for s, w, c in zip(seen, target, scale)]
        if max(abs(g) for g in gradient) < params.tolerance:
            break
        if before and max(abs(a - b) for a, b in zip(before, gradient)) < params.tolerance / 20:
            break  # the bounds on rates hold it
        after = (1 + math.sqrt(1 + 4 * t * t)) / 2
        steps.append((gradient, (t - 1) / after))
        t = after
    reached = totals(steps, "r")
    return steps, {"own": own, "target": target, "reached": reached, "steps": len(steps)}


def mixing_rates(docs: DataFrame, labels: DataFrame, keep: list[str], params: MixingParams, names: dict[str, str]) -> DataFrame:
    """``keep`` columns, tokens, posterior cell, rate and copies, one row a document."""
    model = learn_domains(docs, labels, params)
    hashed = docs.withColumn(names["u"], F.pmod(F.xxhash64("doc_id", "text", F.lit(7)), F.lit(1 << 20)) / float(1 << 20))
    slim = hashed.select(*dict.fromkeys([*keep, "text"]), names["u"])
    features = describe(slim, "text", list(model.cues) if model else [], names)
    features = features.withColumn(names["cell"], posterior_cell(model, names["x"], params.grid)).drop(names["x"])
    features = spool(features)
    cells = features.groupBy(F.col(names["cell"]).alias("cell")).agg(F.sum(F.col(names["n"])).alias("tokens"))
    cells = spool(cells.coalesce(8))  # a bounded number of cells
    steps, _ = fit_rates(cells, params)
    rated = spool(cells.select(
        F.col("cell").alias(names["cell"]), rate_of("cell", steps, params.grid, params.max_rate)["r"].alias(names["rate"]),
    ))
    rated = features.join(small_side(rated), names["cell"])
    rate = F.col(names["rate"])
    return rated.withColumn(names["copies"], (F.floor(rate) + (F.col(names["u"]) < rate - F.floor(rate)).cast("int")).cast("int"))


NAMES = ("n", "x", "u", "cell", "rate", "copies")


def mix(docs: DataFrame, labels: DataFrame, params: MixingParams = MixingParams()) -> DataFrame:
    """``docs`` with each row as often as its copies say, with the input's columns.
    Only the keys of rows that are not wanted once are joined with the texts."""
    names = {k: fresh_name(k, docs.columns) for k in NAMES}
    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    rated = mixing_rates(keyed, labels, ["doc_id", "h"], params, names)
    odd = spool(rated.where(F.col(names["copies"]) != 1).select(F.col("doc_id").alias("d"), F.col("h"), F.col(names["copies"]).alias("c")).distinct())
    hashed, d, c = (fresh_name(x, docs.columns) for x in ("hash", "odd_id", "odd_copies"))
    odd = small_side(odd.select(F.col("d").alias(d), F.col("h").alias(f"{hashed}_odd"), F.col("c").alias(c)), limit=200_000)
    joined = docs.withColumn(hashed, F.coalesce(F.xxhash64("text"), F.lit(0))).join(
        odd, F.col("doc_id").eqNullSafe(F.col(d)) & (F.col(hashed) == F.col(f"{hashed}_odd")), "left",
    )
    copies = F.coalesce(F.col(c), F.lit(1))
    once = joined.where(copies > 0).withColumn(c, F.explode(F.sequence(F.lit(1), copies)))
    return once.select(*[F.col(f"`{x}`") for x in docs.columns])


def op7_mixing_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = MixingParams()
    names = {k: k for k in NAMES}
    rated = mixing_rates(
        read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels"), ["doc_id"], params, names,
    )
    shares = [(F.col("cell")[k] / float(params.grid)).alias(f"p_{d}") for k, d in enumerate(DOMAINS)]
    return rated.select("doc_id", F.col("n").cast("bigint").alias("n_tokens"), *shares, "rate", "copies")
