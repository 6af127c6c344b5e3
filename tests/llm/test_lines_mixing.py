import random

import reference as plain
from reference import prose, same_rows

from stratum.llm import lines, mixing


def dropped(df):
    return {(r.doc_id, at) for r in df.collect() for at in r.dropped}


def test_lines_of_documents(spark, small):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    rows = lines.op8_fuzzy_lines(spark, small)
    assert dropped(rows) == plain.fuzzy_lines(docs)
    assert {r.doc_id: r.n_lines for r in rows.collect()} == {d: len(t.split("\n")) for d, t in docs}


def test_line_families(spark):
    """Lines with edits of a base line, over several documents, and stretches longer than one step."""
    rng, docs = random.Random(2), []
    bases = [prose(25, 50), prose(60, 51), prose(400, 52)]
    for d in range(40):
        own = []
        for base in bases:
            text = list(base)
            for at in rng.sample(range(len(text)), rng.randint(0, len(text) // 60)):
                text[at] = rng.choice("klmnop")
            own.append("".join(text))
        docs.append((d, "\n".join([*own, "short", "", prose(12, 1000 + d)])))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    want = plain.fuzzy_lines(docs)
    got = dropped(lines.dropped_lines(df))
    assert not got - want and len(want - got) <= 0.01 * len(want)
    kept = {r.doc_id: r.text for r in lines.dedup_lines(df).collect()}
    gone = got
    for d, text in docs:
        assert kept[d] == "\n".join(x for at, x in enumerate(text.split("\n")) if (d, at) not in gone)


def test_odd_lines(spark, odd, odd_rows, none):
    kept = lines.dedup_lines(odd)
    assert kept.columns == odd.columns and kept.count() == len(odd_rows)
    text = {r.doc_id: r.text for r in kept.collect() if r.doc_id is not None}
    assert text[1] == "" and text[2] is None and text[14] == "" and text[11] == "a\n" and text[9] == ""
    assert len(text[7]) > 100  # the first place of the twin line
    assert lines.dedup_lines(none).count() == 0 and lines.dropped_lines(none).count() == 0


def rates(spark, docs, labels, params):
    names = {k: k for k in mixing.NAMES}
    return mixing.mixing_rates(docs, labels, ["doc_id"], params, names)


def test_expected_totals_match_targets(spark, small):
    rows = mixing.op7_mixing_rates(spark, small).collect()
    params = mixing.MixingParams()
    assert len(rows) == 200 and all(0 <= r.rate <= params.max_rate and r.copies in (int(r.rate), int(r.rate) + 1) for r in rows)
    total = sum(r.n_tokens for r in rows)
    for d in mixing.DOMAINS:
        assert abs(sum(r.n_tokens * r.rate * r[f"p_{d}"] for r in rows) / total - params.weights[d]) < 0.01
    assert all(abs(r.p_good + r.p_junk + r.p_toxic - 1) < 1e-9 for r in rows)


def test_descent_reaches_the_least_squares_solution(spark):
    """Against a dense projected gradient of one process, where bounds are active."""
    import numpy as np

    rng = np.random.default_rng(4)
    p = rng.multinomial(200, [0.7, 0.2, 0.1], size=40)
    p[:20] = rng.multinomial(200, [0.05, 0.05, 0.9], size=20)
    tokens = rng.integers(10, 1000, 40).astype(float)
    cells = spark.createDataFrame([(x.tolist(), float(n)) for x, n in zip(p, tokens)], "cell array<int>, tokens double")
    params = mixing.MixingParams(weights={"good": 0.95, "junk": 0.04, "toxic": 0.01}, max_rate=1.5, max_steps=60, tolerance=1e-5)
    steps, report = mixing.fit_rates(cells, params)
    own, target = np.array(report["own"]), np.array(report["target"])
    scale = np.maximum(own, target)
    r, share = np.ones(40), p / 200
    for _ in range(20_000):
        r = np.clip(r - share @ (((r * tokens) @ share - target) / scale), 0, 1.5)
    best = ((((r * tokens) @ share - target) ** 2) / scale).sum()
    mine = (((np.array(report["reached"]) - target) ** 2) / scale).sum()
    assert mine <= best * 1.02 + 1e-3 * scale.sum() * 1e-3


def test_odd_documents(spark, odd, odd_rows, none, labels):
    for table in (labels, labels.limit(0)):
        rows = rates(spark, odd, table, mixing.MixingParams()).collect()
        assert len(rows) == len(odd_rows) and all(r.rate >= 0 for r in rows)
        mixed = mixing.mix(odd, table, mixing.MixingParams(max_rate=2.0, budget_ratio=2.0))
        assert mixed.columns == odd.columns
    same_rows(mixing.mix(odd, labels.limit(0), mixing.MixingParams(weights={"good": 1.0}, max_rate=1.0)), odd_rows)
    assert rates(spark, none, labels, mixing.MixingParams()).count() == 0 and mixing.mix(none, labels).count() == 0


def test_labelled_good_documents_keep_rate_1(spark):
    """Long clean documents hold chance stems; those are not toxic."""
    import corpus_pipeline as pipeline
    from pyspark.sql import functions as F

    from stratum.llm import quality

    sf = "/root/testdata/sf0.1"
    docs = quality.quality_filter(spark.read.parquet(f"{sf}/documents.parquet")).dropDuplicates(["text"])
    table = spark.read.parquet(f"{sf}/labels.parquet")
    labelled = rates(spark, docs.select("doc_id", "text"), table, pipeline.MIX).join(table, "doc_id")
    by = {(r.quality > 0, r.toxic > 0): r for r in labelled.groupBy("quality", "toxic").agg(F.count("rate").alias("n"), F.min("rate").alias("least"), F.avg("rate").alias("mean")).collect()}
    assert by[True, False].n > 2000 and by[True, False].least > 0.999
    assert by[True, True].mean < 0.6  # toxic ones with insults are thinned


def test_default_stop_is_close_to_the_converged_rates(spark):
    import numpy as np

    rng = np.random.default_rng(4)
    p = rng.multinomial(200, [0.7, 0.2, 0.1], size=40)
    p[:20] = rng.multinomial(200, [0.05, 0.05, 0.9], size=20)
    tokens = rng.integers(10, 1000, 40).astype(float)
    cells = spark.createDataFrame([(x.tolist(), float(n)) for x, n in zip(p, tokens)], "cell array<int>, tokens double")
    params = mixing.MixingParams(weights={"good": 0.95, "junk": 0.04, "toxic": 0.01}, max_rate=1.5)
    steps, report = mixing.fit_rates(cells, params)
    target, share = np.array(report["target"]), p / 200
    scale, r = np.maximum(np.array(report["own"]), target), np.ones(40)
    for _ in range(20_000):
        r = np.clip(r - share @ (((r * tokens) @ share - target) / scale), 0, 1.5)
    assert (np.abs(np.array(report["reached"]) - (r * tokens) @ share) < 1e-3 * scale).all()
    rated = cells.select("cell", mixing.rate_of("cell", steps, params.grid, params.max_rate)["r"].alias("r")).collect()
    best = {tuple(x): v for x, v in zip(p.tolist(), r)}
    assert all(abs(x.r - best[tuple(x.cell)]) < 0.01 for x in rated)


def test_repeated_short_lines_are_dropped(spark, small):
    """Lines under nine units are dropped if they are equal to an earlier one; blank lines stay."""
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{small}/documents.parquet").collect()]
    docs += [(10_000 + d, "Menu\n\n\u4e3b\u9875\nMenu\n \nMenus\n" + prose(20, d)) for d in range(20)]
    seen, short = set(), set()
    for d, text in sorted(docs):
        for at, line in enumerate(text.split("\n")):
            if len(line) < 9 and plain.plain_words(line):
                if line in seen:
                    short.add((d, at))
                seen.add(line)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert dropped(lines.dropped_lines(df)) == plain.fuzzy_lines(docs) | short and len(short) > 80


def test_lists_compare_all_their_components(spark, monkeypatch):
    """Similar lines that share one band only, in a list whose smallest member is like neither."""
    from pyspark.sql import functions as F

    def one_band(df, size, coordinates):
        values = [F.lit(k) if k in lines.BAND else F.hash("line", F.lit(k)) for k in range(coordinates)]
        return df.select(*lines.line_key("line"), "line").distinct().coalesce(1).sort("line").select("k1", "k2", F.array(*values).alias("signature"))

    monkeypatch.setattr(lines, "signatures", one_band)
    base = prose(30, 60)
    df = spark.createDataFrame([(1, " " + prose(30, 61)), (2, base), (3, base + "!")], "doc_id bigint, text string")
    assert dropped(lines.dropped_lines(df)) == {(3, 0)}


def test_unlike_pairs_of_a_list_are_ruled_out_before_sets_are_compared(spark, monkeypatch):
    """A list of lines that have their start in common: pairs that are far below the threshold
    are not verified, all links are found, and the bound holds for each pair."""
    from pyspark.sql import functions as F

    rng, seen, verify = random.Random(3), [], lines.verify
    docs = [(d, prose(12, 70) + " " + prose(40, 700 + d)) for d in range(40)]
    for d in range(10):
        text = list(docs[d][1])
        for at in rng.sample(range(len(text)), 2):
            text[at] = "#"
        docs.append((40 + d, "".join(text)))

    def one_list(df, size, coordinates):
        keyed = df.select(*lines.line_key("line")).distinct()
        return keyed.select("k1", "k2", F.array(*[F.lit(k) for k in range(coordinates)]).alias("signature"))

    def counted(pairs, *rest):
        seen.append(pairs.count())
        return verify(pairs, *rest)

    monkeypatch.setattr(lines, "signatures", one_list)
    monkeypatch.setattr(lines, "verify", counted)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert dropped(lines.dropped_lines(df)) == plain.fuzzy_lines(docs) == {(40 + d, 0) for d in range(10)}
    assert sum(seen) < 100  # of 1,225 pairs


def test_bitmaps_never_rule_out_a_similar_pair(spark):
    from pyspark.sql import functions as F

    rng, texts = random.Random(5), []
    for size in (12, 80, 900, 6000):
        base = prose(size, size)[:size] * (2 if size == 900 else 1)
        for k in range(12):
            text = list(base)
            for at in rng.sample(range(len(text)), min(len(text) // 2, k * len(text) // 90)):
                text[at] = rng.choice("xyz主")
            texts.append("".join(text))
    coded = spark.createDataFrame(list(enumerate(texts)), "id bigint, line string").select("id", lines.units("line").alias("units"))
    maps = lines.bitmaps(coded, 9)
    a, b = (maps.select(*[F.col(c).alias(f"{x}_{c}") for c in maps.columns]) for x in "ab")
    got = {(r.a_id, r.b_id) for r in a.join(b, F.col("a_id") < F.col("b_id")).where(lines.may_be_similar("a_", "b_", 80)).collect()}
    sets = [{t[k : k + 9] for k in range(len(t) - 8)} for t in texts]
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])}
    assert want and want <= got and len(got) < len(texts) * (len(texts) - 1) // 2


def test_shingle_sets_are_not_written_out(spark, monkeypatch):
    """Tables between the steps have no value for each shingle, and the links are all found."""
    from pyspark.sql import functions as F

    rng, written, spool = random.Random(9), [], lines.spool
    base = "".join(rng.choice("abcdefghijklmnopqrstuvwxyz ") for _ in range(3000))
    docs = []
    for d in range(60):
        text = list(base if d % 2 else base[::-1])
        for at in rng.sample(range(len(text)), 8):
            text[at] = "#"
        docs.append((d, "".join(text)))

    def counted(df):
        found = spool(df)
        written.extend(found.agg(F.sum(F.size(c))).first()[0] or 0 for c, kind in found.dtypes if kind.startswith("array"))
        return found

    monkeypatch.setattr(lines, "spool", counted)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    assert dropped(lines.dropped_lines(df)) == {(d, 0) for d in range(2, 60)}
    assert 0 < max(written) < 5000  # of 180,000 shingles


def test_wider_bitmaps_rule_out_more_pairs_and_no_similar_one(spark):
    from pyspark.sql import functions as F

    rng, texts = random.Random(6), []
    for size in (9, 300, 1500):
        base = prose(size, size)[:size]
        for k in range(14):
            text = list(base)
            for at in rng.sample(range(len(text)), k * len(text) // 300):
                text[at] = rng.choice("xyz\u4e3b")
            texts.append("".join(text))
    coded = spark.createDataFrame(list(enumerate(texts)), "id bigint, line string").select("id", lines.units("line").alias("units"))
    every = coded.select(F.col("id").alias("a")).crossJoin(coded.select(F.col("id").alias("b"))).where("a < b")
    got = [{(r.a, r.b) for r in lines.likely_pairs(every, lines.bitmaps(coded, 9, n), 80, n).collect()} for n in (1, lines.FINER)]
    sets = [{t[k : k + 9] for k in range(len(t) - 8)} for t in texts]
    want = {(i, j) for i in range(len(texts)) for j in range(i + 1, len(texts)) if 10 * len(sets[i] & sets[j]) >= 8 * len(sets[i] | sets[j])}
    exact = {(r.a, r.b) for r in lines.verify(every, coded, 9, 80).collect()}
    assert want == exact and want <= got[1] < got[0]
