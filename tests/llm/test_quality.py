import reference as plain
from reference import same_rows

from stratum.llm import quality


def test_counts_of_documents(spark, small):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    rows = quality.op10_quality_rules(spark, small).collect()
    assert len(rows) == len(text)
    for r in rows:
        counts = plain.quality_counts(text[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == counts
        assert r.base_failed == (counts[0] < 50 or 100 * counts[4] > 50 * counts[0])
        assert not (r.kept and r.base_failed)


def test_odd_rows(spark, odd, odd_rows, none):
    rows = quality.quality_report(odd).collect()
    want = sorted(plain.quality_counts(r[1]) for r in odd_rows)
    assert sorted((r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows) == want
    kept = quality.quality_filter(odd)
    assert kept.columns == odd.columns
    good = [r for r in odd_rows if r[1] and len(r[1].split()) >= 50 and r[0] not in (11, 14)]
    same_rows(kept.where("doc_id is null or doc_id not in (11, 14, 15)"), [r for r in good if r[0] != 15])
    assert quality.quality_report(none).count() == 0 and quality.quality_filter(none).count() == 0


def test_thresholds_adapt_and_merge(spark):
    rows = [("en", "a", 100, 500, 0, 5, 0, 0)] * 60 + [("en", "a", 100, 500, 40, 5, 0, 0)] * 5 + [("de", "b", 100, 700, 30, 5, 0, 0)] * 60
    rows += [("en", "c", 100, 500, 40, 5, 0, 0)] * 3  # a small source uses its language's sketch
    m = spark.createDataFrame(rows, "lang string, source string, " + quality.COUNTS)
    params = quality.QualityParams()
    whole = quality.sketch(m, params)
    parts = quality.sketch(m.where("source = 'a'"), params).union(quality.sketch(m.where("source <> 'a'"), params))
    assert sorted(map(tuple, whole.collect()), key=str) == sorted(map(tuple, parts.collect()), key=str)
    fences = quality.thresholds(whole, params)
    judged = quality.verdict(m, fences, params).groupBy("lang", "source", "n_symbols").agg({"kept": "min"}).collect()
    kept = {(r[0], r[1], r[2]): r[3] for r in judged}
    assert kept == {("en", "a", 0): True, ("en", "a", 40): False, ("de", "b", 30): True, ("en", "c", 40): False}


def test_quartiles_are_close_to_exact(spark):
    values = [(7 * k % 101 + 1) * 3 for k in range(1010)]
    m = spark.createDataFrame([("x", "y", 100, v * 100, 0, 1, 0, 0) for v in values], "lang string, source string, " + quality.COUNTS)
    params = quality.QualityParams(metrics=(quality.Metric("mean_word_len", two_sided=True),), reach=0.0)
    f = quality.thresholds(quality.sketch(m, params), params).first().fences
    exact = sorted(values)  # without reach the fences are the quartiles, less and more the sketch's accuracy
    assert abs(f.mean_word_len_low / (exact[252] * 0.98) - 1) < 0.02 and abs(f.mean_word_len_high / (exact[757] * 1.02) - 1) < 0.02


def test_fences_follow_the_data(spark):
    """Another level of symbols, or another spread, moves the fences of its group alone."""
    def fences(level, spread):
        rows = [("en", "a", 200, 1000, level + (k * k) % spread, 10, 0, 0) for k in range(200)]
        rows += [("en", "b", 200, 1000, (k * k) % 7, 10, 0, 0) for k in range(200)]
        m = spark.createDataFrame(rows, "lang string, source string, " + quality.COUNTS)
        params = quality.QualityParams()
        found = quality.thresholds(quality.sketch(m, params), params)
        assert quality.verdict(m, found, params).where("not kept").count() == 0
        return {r.source: r.fences.symbol_ratio_high for r in found.collect()}

    plain, shifted, wide = fences(0, 7), fences(60, 7), fences(0, 31)
    assert plain["a"] == plain["b"] == shifted["b"] == wide["b"]
    assert 0.3 < shifted["a"] < 0.6 and plain["a"] < wide["a"]


def test_sketches_set_the_fences(spark):
    """On the test tables: fences differ between groups, and most lie beyond what the noise
    of a single count at rate zero would give."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    params = quality.QualityParams()
    rows = [r.fences for r in quality.thresholds(quality.sketch(quality.measure(docs, ["lang", "source"]), params), params).collect()]
    for name in ("mean_word_len_high", "mean_word_len_low", "repeat_ratio_high"):
        assert len({round(r[name], 6) for r in rows}) > len(rows) // 3, name


def test_each_metric_rejects_an_outlier(spark):
    """All documents pass the base rule; the planted ratios are below 0.5, or 2 characters a word."""
    usual = [("en", "a", 100, 500 + k % 5, 0, 20, 0, 0) for k in range(60)]
    wide = [("en", "w", 100, 300 + 10 * (k % 60), 0, 20, 0, 0) for k in range(60)]  # words of 3 to 8.9
    planted = [
        ("en", "a", 100, 500, 8, 20, 0, 0), ("en", "a", 100, 500, 0, 20, 9, 0), ("en", "a", 100, 500, 0, 20, 0, 48),
        ("en", "a", 100, 700, 0, 20, 0, 0), ("en", "a", 100, 300, 0, 20, 0, 0),
    ]
    m = spark.createDataFrame(usual + wide + planted, "lang string, source string, " + quality.COUNTS)
    params = quality.QualityParams()
    rows = quality.verdict(m, quality.thresholds(quality.sketch(m, params), params), params).collect()
    assert not any(r.base_failed for r in rows)
    odd = {(r.source, *(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"))) for r in rows if not r.kept}
    assert odd == {p[1:] for p in planted}


def test_labelled_good_documents_stay(spark):
    sf = "/root/testdata/sf0.1"
    good = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").collect() if r.quality and not r.toxic}
    rows = [r for r in quality.op10_quality_rules(spark, sf).collect() if r.doc_id in good and not r.base_failed]
    assert len(rows) > 2000 and sum(not r.kept for r in rows) <= len(rows) // 1000
    junk = {r.doc_id for r in spark.read.parquet(f"{sf}/labels.parquet").where("quality = 0").collect()}
    rows = [r for r in quality.op10_quality_rules(spark, sf).collect() if r.doc_id in junk]
    assert sum(not r.kept for r in rows) >= 0.99 * len(rows)
