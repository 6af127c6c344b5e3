"""Token counts from pre-token frequencies.

A text's token count is the sum over its distinct pre-tokens of frequency times
number of pieces, so pieces need to be found once for each distinct pre-token of
the corpus, and ids are never kept.

Each document is reduced to its pre-token frequencies.  The pieces of the most
frequent pre-tokens (at most ``common_limit``, chosen from a hash sample of
about ``sample_rows`` documents; the choice moves work, not results) are counted
first and joined from a broadcast dictionary, which takes the frequent keys out of
the shuffle.  All other (document, pre-token, frequency) rows are joined by a
sort-merge: partitioned and sorted by pre-token, each run of equal pre-tokens is
encoded once and multiplied out, and the products are summed by document.

Texts with one blank between words are cut at blanks, which the pre-tokenizer's
pattern never spans, and each distinct piece of a batch is split once.  Texts with
characters on whose class libraries may differ go through the tokenizer's own
pre-tokenizer.  Special strings inside a text count as one token, the library's
default.

Defined results: null and empty texts have 0 bytes and 0 tokens; repeated rows are
counted each; null doc_ids are kept; an empty table gives an empty result.
"""

from __future__ import annotations

import os
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stratum.llm.common import fresh_name, map_rows, read_table, share, spool

VOCABULARY = "byte_bpe_50k.json"
#: Separators and everything beyond Latin letters: left to the library's own pattern.
UNUSUAL = re.compile("[\x1c-\x1f\x85\xa0ɐ-\U0010ffff]")
NEAR_BLANK = re.compile(r" (?=[\s])|(?<=\s) |^ | $")
#: Chunks whose parse a task remembers; longer ones are never remembered.
CACHE_ENTRIES = 150_000
CACHED_LENGTH = 64


def load_tokenizer(vocabulary: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path(vocabulary))


def special_strings(tokenizer) -> list[str]:
    return sorted((t.content for t in tokenizer.get_added_tokens_decoder().values()), key=len, reverse=True)


def count_pieces(tokenizer, texts: list[str], step: int = 10_000) -> list[int]:
    """Numbers of pieces; the library's encodings of ``step`` texts live at once."""
    return [
        len(e.ids) for at in range(0, len(texts), step)
        for e in tokenizer.encode_batch_fast(texts[at : at + step], add_special_tokens=False)
    ]


class PreTokenizer:
    """Splits texts into pre-token frequencies."""

    def __init__(self, vocabulary: str):
        self.tokenizer = load_tokenizer(vocabulary)
        self.findall = regex.compile(public_tokenizers.PATTERN).findall
        special = special_strings(self.tokenizer)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None

    def chunks(self, text: str) -> Counter:
        """Frequencies of strings that the pattern splits independently of what is around them."""
        if UNUSUAL.search(text):
            return Counter({text: 1})
        if NEAR_BLANK.search(text):
            return Counter({text: 1})
        parts = text.split(" ")
        counts = Counter(parts[1:])
        counts = Counter({" " + k: v for k, v in counts.items()})
        counts[parts[0]] += 1
        return counts

    def split(self, text: str) -> tuple[int, Counter]:
        """The number of special strings, and the frequencies of chunks."""
        if self.special is None or not self.special.search(text):
            return 0, self.chunks(text)
        parts = self.special.split(text)
        total: Counter = Counter()
        for part in filter(None, parts):
            total.update(self.chunks(part))
        return len(parts) - 1, total

    def pretokens(self, chunk: str) -> list[str]:
        if UNUSUAL.search(chunk):
            return [chunk[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(chunk)]
        return self.findall(chunk)


class PieceCounter:
    """Token counts of texts, from remembered counts of the chunks they consist of."""

    def __init__(self, vocabulary: str):
        self.splitter = PreTokenizer(vocabulary)
        self.known: dict[str, int] = {}

    def counts(self, texts: list[str]) -> list[int]:
        parsed = [self.splitter.split(t) for t in texts]
        new = list({c for _, chunks in parsed for c in chunks if c not in self.known})
        found = dict(zip(new, count_pieces(self.splitter.tokenizer, new)))
        totals = []
        for special, chunks in parsed:
            totals.append(special + sum(n * (self.known[c] if c in self.known else found[c]) for c, n in chunks.items()))
        if len(self.known) + len(found) > CACHE_ENTRIES:
            self.known.clear()
        else:
            self.known.update((c, n) for c, n in found.items() if len(c) <= CACHED_LENGTH)
        return totals


def common_pieces(docs: DataFrame, n_docs: int, vocabulary: str, sample_rows: int, common_limit: int) -> dict[str, int]:
    """Pieces of the pre-tokens that are in the most documents of a hash sample."""
    one_in = max(1, n_docs // sample_rows)
    sample = docs.where(F.pmod(F.xxhash64("doc_id", F.lit(4)), F.lit(one_in)) == 0).select("text")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        splitter, seen = PreTokenizer(vocabulary), Counter()
        for batch in batches:
            for text in batch.column(0).to_pylist():
                own = set()
                for chunk in splitter.split(text or "")[1]:
                    own.update(splitter.pretokens(chunk))
                seen.update(own)
        keys = list(seen)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.string()), pa.array([seen[k] for k in keys], pa.int64())], names=["token", "n"])

    rows = sample.mapInArrow(count, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    tokens = [r["token"] for r in rows.where("n > 1").orderBy(F.desc("n"), "token").limit(common_limit).select("token").collect()]
    return dict(zip(tokens, count_pieces(load_tokenizer(vocabulary), tokens)))


def frequencies(docs: DataFrame, keep: list[str], names: dict[str, str], common, vocabulary: str) -> DataFrame:
    """``keep`` columns, a row number, the tokens of special strings and common
    pre-tokens, and the frequencies of the others."""

    def make():
        from pyspark import TaskContext

        splitter, known = PreTokenizer(vocabulary), common()
        row = [TaskContext.get().partitionId() << 40]
        parsed: dict[str, tuple[int, list[str]]] = {}

        def one(text):
            row[0] += 1
            total, chunks = splitter.split(text or "")
            rare: Counter = Counter()
            for chunk, n in chunks.items():
                found = parsed.get(chunk)
                if found is None:
                    tokens = splitter.pretokens(chunk)
                    found = sum(known.get(t, 0) for t in tokens), [t for t in tokens if t not in known]
                    if len(chunk) <= CACHED_LENGTH:
                        if len(parsed) >= CACHE_ENTRIES:
                            parsed.clear()
                        parsed[chunk] = found
                total += n * found[0]
                for t in found[1]:
                    rare[t] += n
            return row[0], total, list(rare), list(rare.values())

        return lambda rows: [one(x) for (x,) in rows]

    schema = f"{names['row']} bigint, {names['sure']} bigint, {names['rare']} array<string>, {names['times']} array<bigint>"
    return map_rows(docs, make, ["text"], schema, keep)


def multiply_out(rows: DataFrame, vocabulary: str) -> DataFrame:
    """(row, n) from (row, token, times) sorted by token within partitions: each
    run of equal tokens is encoded once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = load_tokenizer(vocabulary)
        last, last_n = None, 0
        for batch in batches:
            coded = batch.column(1).dictionary_encode()
            tokens = coded.dictionary.to_pylist()
            if tokens and tokens[0] == last:
                pieces = [last_n, *count_pieces(tokenizer, tokens[1:])]
            else:
                pieces = count_pieces(tokenizer, tokens)
            if tokens:
                last, last_n = tokens[-1], pieces[-1]
            n = np.array(pieces, np.int64)[coded.indices.to_numpy()] * batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64())], names=["row", "n"])

    return rows.select("row", "token", "times").mapInArrow(run, "row bigint, n bigint")


def count_tokens(
    docs: DataFrame, keep: list[str], vocabulary: str = VOCABULARY, limit: int = 512,
    sample_rows: int = 8_000, common_limit: int = 100_000,
) -> DataFrame:
    """``keep`` columns, n_bytes, n_tokens and over_limit, one row a document."""
    spark = docs.sparkSession
    names = {k: fresh_name(k, docs.columns) for k in ("row", "sure", "rare", "times", "bytes")}
    n_docs = docs.count()
    common = share(spark, common_pieces(docs, n_docs, vocabulary, sample_rows, common_limit))
    docs = docs.withColumn(names["bytes"], F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint"))
    parsed = spool(frequencies(docs, [*keep, names["bytes"]], names, common, vocabulary))
    rare = (
        parsed.select(F.col(names["row"]).alias("row"), F.explode(F.arrays_zip(F.col(names["rare"]).alias("token"), F.col(names["times"]).alias("times"))).alias("x"))
        .select("row", "x.token", "x.times").repartition("token").sortWithinPartitions("token")
    )
    more = multiply_out(rare, vocabulary).groupBy(F.col("row").alias(names["row"])).agg(F.sum("n").alias(names["rare"]))
    n_tokens = F.col(names["sure"]) + F.coalesce(F.col(names["rare"]), F.lit(0))
    return parsed.drop(names["rare"], names["times"]).join(more, names["row"], "left").select(
        *[F.col(f"`{c}`") for c in keep], F.col(names["bytes"]).alias("n_bytes"), n_tokens.alias("n_tokens"), (n_tokens > limit).alias("over_limit"),
    )


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(read_table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
