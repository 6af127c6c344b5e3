"""Quality rules with adaptive thresholds.

Each document gets counts (words, symbols, repeated lines and phrases).  Ratios
of these counts are gathered, per language and source, into log-bucketed
quantile sketches (DDSketch: a table of bucket counts, so sketches of partitions,
of sources or of days merge by adding counts, in any order and with the same
result).  Documents that fail the base rule are left out of them.

A fence is found by climbing the sketch's quantiles, from the median outwards (``RUNGS``).
The bulk of a group reaches as far as each quantile lies within ``reach`` times the
distance of the two before it; the fence is where the next one would have to lie.  Where
a few documents in a hundred are of another kind, there is a step in the quantiles, the
climb ends below it and the fence falls into the gap; where the tail is long but
steady, as of repeated phrases, the fence follows it.  No distance is taken for
smaller than the noise of a count: ``reach`` standard deviations of a Poisson count, in
units of the least change a count can make, at the group's median document size; or
the sketch's own accuracy.  There are no fixed cutoffs, and fences follow the data
without a change of parameters.  Groups with fewer than ``min_group`` documents use the
merged sketch of their language, then of all documents.

Defined results: a null text has no words; a document without words has ratio 0
everywhere; null languages or sources are groups of their own; repeated rows are
judged alike; an empty table gives an empty result.  Input columns that clash
with result columns are left out of the measured table, and the filter returns
the input columns unchanged.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import fresh_name, map_rows, read_table, small_side, spool

COUNTS = "n_words bigint, word_chars bigint, n_symbols bigint, n_lines bigint, n_dup_lines bigint, n_repeat_words bigint"
SYMBOLS = "#*$%&|<>"
ASCII_SPACE = "\t\n\x0b\x0c\r "


@dataclass(frozen=True)
class Metric:
    """A ratio, the column whose size it is a share of, the least change of the count
    above it (None: not a count), and whether small values are odd too."""

    name: str
    of: str = "n_words"
    unit: float | None = None
    two_sided: bool = False


#: Quantiles climbed from the median; their complements on the way down.
RUNGS = (0.5, 0.75, 0.9, 0.95, 0.98, 0.99, 0.995)


@dataclass(frozen=True)
class QualityParams:
    metrics: tuple[Metric, ...] = (
        Metric("symbol_ratio", unit=1),
        Metric("dup_line_ratio", "n_lines", unit=1),
        Metric("repeat_ratio", unit=6),  # two windows of three words
        Metric("mean_word_len", unit=1, two_sided=True),  # characters, counted
    )
    reach: float = 4.0
    gamma: float = 1.02
    min_group: int = 50
    min_words: int = 50
    max_repeat_percent: int = 50


def count_text(text: str | None) -> tuple[int, int, int, int, int, int]:
    """The six counts of one text.  Words are runs of characters other than
    ASCII white space; a word is repeated if a window of three words around it
    occurs at least twice."""
    if not text:
        return 0, 0, 0, 0, 0, 0
    words = text.encode().split()
    chars = len(text) - sum(map(text.count, ASCII_SPACE))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(ASCII_SPACE)]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        seen, until = Counter(windows), 0
        for i, w in enumerate(windows):
            if seen[w] > 1:
                repeated += i + 3 - max(i, until)
                until = i + 3
    return len(words), chars, symbols, len(lines), len(lines) - len(set(lines)), repeated


def measure(docs: DataFrame, keep: list[str], prefix: str = "") -> DataFrame:
    """``keep`` columns and the counts of ``text``, in one pass without a shuffle;
    ``prefix`` goes before the names of the counts."""
    schema = ", ".join(prefix + x.strip() for x in COUNTS.split(","))
    return map_rows(docs, lambda: lambda rows: [count_text(x) for (x,) in rows], ["text"], schema, keep)


def ratios(prefix: str = "") -> dict[str, F.Column]:
    n = lambda c: F.col(prefix + c).cast("double")
    part = lambda a, b: F.when(n(b) > 0, n(a) / n(b)).otherwise(F.lit(0.0))
    return {
        "symbol_ratio": part("n_symbols", "n_words"),
        "dup_line_ratio": part("n_dup_lines", "n_lines"),
        "repeat_ratio": part("n_repeat_words", "n_words"),
        "mean_word_len": part("word_chars", "n_words"),
        "n_words": n("n_words"),
        "n_lines": n("n_lines"),
    }


def base_failed(params: QualityParams, prefix: str = "") -> F.Column:
    n, repeat = F.col(f"{prefix}n_words"), F.col(f"{prefix}n_repeat_words")
    return (n < params.min_words) | (100 * repeat > params.max_repeat_percent * n)


def sketched_names(params: QualityParams) -> list[str]:
    """The metrics, and the sizes that their counts are shares of."""
    return list(dict.fromkeys([m.name for m in params.metrics] + [m.of for m in params.metrics]))


def sketch(measured: DataFrame, params: QualityParams, prefix: str = "", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, metric, bucket, n): the sketch of every group, over the documents that
    pass the base rule.  Bucket b holds ratios in (gamma^(b-1), gamma^b], the null bucket
    holds zero."""
    value = ratios(prefix)
    pairs = F.array(*[
        F.struct(F.lit(name).alias("metric"), F.ceil(F.log(F.nullif(value[name], F.lit(0.0))) / math.log(params.gamma)).cast("int").alias("bucket"))
        for name in sketched_names(params)
    ])
    return (
        measured.where(~base_failed(params, prefix))
        .select(F.col(lang).alias("lang"), F.col(source).alias("source"), F.explode(pairs).alias("p"))
        .groupBy("lang", "source", "p.metric", "p.bucket").agg(F.count(F.lit(1)).alias("n"))
    )


def climb(q: list[F.Column], size: F.Column, metric: Metric, params: QualityParams, sign: int) -> F.Column:
    """The fence above (``sign`` 1) or below (-1) quantiles that run outwards from the median."""

    def step(here: F.Column, before: F.Column) -> F.Column:
        if metric.unit is None:
            noise = here * (params.gamma - 1)
        else:
            counted = F.greatest(here * size / metric.unit, F.lit(1.0))
            noise = F.lit(params.reach * metric.unit) * F.sqrt(counted) / F.greatest(size, F.lit(1.0))
        return here + sign * F.greatest(params.reach * F.abs(here - before), noise)

    pairs = F.array(*[F.struct(a.alias("here"), b.alias("before")) for a, b in zip(q[2:], q[1:])])
    start = F.struct(step(q[1], q[0]).alias("fence"), F.lit(True).alias("open"))

    def further(so_far: F.Column, pair: F.Column) -> F.Column:
        within = so_far["open"] & (sign * (so_far["fence"] - pair["here"]) >= 0)
        return F.struct(
            F.when(within, step(pair["here"], pair["before"])).otherwise(so_far["fence"]).alias("fence"), within.alias("open"))

    return F.aggregate(pairs, start, further, lambda x: x["fence"])


def thresholds(sketched: DataFrame, params: QualityParams) -> DataFrame:
    """(lang, source, fences): lower and upper fence by metric for each group in
    the sketch; the sketches of languages and of everything are merged from it."""
    from pyspark.sql import Window

    probabilities = sorted({*RUNGS, *(round(1 - p, 6) for p in RUNGS)})
    levels = [["lang", "source"], ["lang"], []]
    found = []
    for k, keys in enumerate(levels):
        by = [*keys, "metric"]
        merged = sketched.groupBy(*by, "bucket").agg(F.sum("n").alias("n"))
        order = Window.partitionBy(*by).orderBy(F.asc_nulls_first("bucket"))
        ranked = merged.select(
            *by, "bucket",
            F.sum("n").over(order).alias("upto"),
            F.sum("n").over(Window.partitionBy(*by)).alias("total"),
        )
        at = lambda q: F.min(F.when(F.col("upto") >= F.ceil(F.col("total") * q), F.coalesce(F.col("bucket"), F.lit(-(1 << 30)))))
        quantiles = ranked.groupBy(*by).agg(F.max("total").alias("total"), F.array(*[at(p) for p in probabilities]).alias("b"))
        value = F.transform("b", lambda c: F.when(c == -(1 << 30), 0.0).otherwise(2 * F.pow(F.lit(params.gamma), c) / (params.gamma + 1)))
        quantiles = quantiles.select(*by, "total", value.alias("q"))
        found.append(quantiles.groupBy(*keys).agg(
            F.max("total").alias(f"total{k}"), F.map_from_entries(F.collect_list(F.struct("metric", "q"))).alias(f"quantiles{k}"),
        ))
    group, lang, every = found
    joined = group.join(lang.withColumnRenamed("lang", "l"), F.col("lang").eqNullSafe(F.col("l")))
    total = every.first()["quantiles2"] or {}  # one row
    rest = F.create_map(*[x for name, q in sorted(total.items()) for x in (F.lit(name), F.array(*map(F.lit, q)))])
    chosen = (
        F.when(F.col("total0") >= params.min_group, F.col("quantiles0"))
        .when(F.col("total1") >= params.min_group, F.col("quantiles1")).otherwise(rest if total else F.col("quantiles1"))
    )
    fences = []
    for m in params.metrics:
        q = {p: F.col("chosen")[m.name][k] for k, p in enumerate(probabilities)}
        size = F.col("chosen")[m.of][probabilities.index(0.5)]
        low = climb([q[round(1 - p, 6)] for p in RUNGS], size, m, params, -1) if m.two_sided else F.lit(float("-inf"))
        fences += [low.alias(f"{m.name}_low"), climb([q[p] for p in RUNGS], size, m, params, 1).alias(f"{m.name}_high")]
    return joined.withColumn("chosen", chosen).select("lang", "source", F.struct(*fences).alias("fences"))


def verdict(measured: DataFrame, fences: DataFrame, params: QualityParams, prefix: str = "", lang: str = "lang", source: str = "source") -> DataFrame:
    """``measured`` with ``<prefix>base_failed`` and ``<prefix>kept``.  The fences
    are one row a group: broadcast if their count is small, else a join that AQE
    splits where one group holds most rows.  A group without a fence has no document
    that passes the base rule."""
    limits = small_side(fences.select(F.col("lang").alias(f"{prefix}g1"), F.col("source").alias(f"{prefix}g2"), F.col("fences").alias(f"{prefix}fences")))
    joined = measured.join(
        limits, F.col(f"`{lang}`").eqNullSafe(F.col(f"{prefix}g1")) & F.col(f"`{source}`").eqNullSafe(F.col(f"{prefix}g2")), "left",
    )
    failed = base_failed(params, prefix)
    inside = F.lit(True)
    value = ratios(prefix)
    for m in params.metrics:
        f = F.col(f"{prefix}fences")
        inside = inside & (value[m.name] <= f[f"{m.name}_high"]) & (value[m.name] >= f[f"{m.name}_low"])
    return joined.withColumns({f"{prefix}base_failed": failed, f"{prefix}kept": ~failed & F.coalesce(inside, F.lit(True))})


def quality_report(docs: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """doc_id, lang, source, the counts, base_failed and kept, one row a document."""
    measured = spool(measure(docs.select("doc_id", "lang", "source", "text"), ["doc_id", "lang", "source"]))
    fences = spool(thresholds(sketch(measured, params), params))
    return verdict(measured, fences, params).drop("g1", "g2", "fences")


def quality_filter(docs: DataFrame, params: QualityParams = QualityParams()) -> DataFrame:
    """The kept documents, with the input's columns.  Two passes over the texts:
    one for the sketches, one for the verdicts; texts are never shuffled."""
    prefix = fresh_name("q", docs.columns)
    measured = measure(docs, ["lang", "source"], prefix)
    fences = spool(thresholds(sketch(measured, params, prefix), params))
    judged = verdict(measure(docs, docs.columns, prefix), fences, params, prefix)
    return judged.where(f"`{prefix}kept`").select(*[F.col(f"`{c}`") for c in docs.columns])


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )
