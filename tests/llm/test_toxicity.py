import zlib

from stratum.llm import toxicity as tox


def test_folding():
    assert tox.fold("ІDIОT 1d10t Ｉdiot i​díot").split() == ["idiot"] * 4  # Cyrillic, digits, full width, hidden, accent
    assert tox.fold(None) == " " and tox.fold("").split() == []


def test_exceptions_and_length():
    model = tox.Model({tox.fold("trash").strip(): 4.0}, tox.EXCEPTIONS, ())
    found = model.automaton()
    assert tox.features("put it into the trash can", found)[0] == 0
    assert tox.features("you are tr4sh", found)[0] > 0
    assert tox.features("untrashed", found)[0] == 0
    short, long = tox.features("trash a", found), tox.features("trash " + "a " * 500, found)
    assert short[0] == long[0] and short[1] > 50 * long[1]


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    toxic = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    rows = tox.op3_toxicity(spark, sf).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    judged = [(toxic[r.doc_id], r.predicted) for r in rows if r.held_out and r.doc_id in toxic]
    wrong = [sum(t == a and p != a for t, p in judged) / max(1, sum(t == a for t, _ in judged)) for a in (0, 1)]
    # the toxic ones that are missed are scrambled copies that hold none of the terms
    assert wrong[0] < 0.01 and wrong[1] < 0.1, wrong


def test_labels_of_the_held_out_fold_are_not_read(spark):
    rows = [(k, "idiot scum" if k % 2 else "a fine day") for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    held = lambda k: zlib.crc32(str(k).encode()) % 5 == 0
    honest = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id bigint, toxic int")
    lying = spark.createDataFrame([(k, 1 - k % 2 if held(k) else k % 2) for k, _ in rows], "doc_id bigint, toxic int")
    assert tox.learn(docs, honest) == tox.learn(docs, lying)


def test_odd_rows(spark, odd, odd_rows, none, labels):
    for model in (tox.learn(odd, labels), tox.learn(odd, labels.limit(0)), tox.learn(none, labels)):
        rows = tox.score(odd, model, ["doc_id", "x"]).collect()
        assert len(rows) == len(odd_rows) and all(0 <= r.score <= 1 for r in rows)
    assert tox.score(none, model, ["doc_id"]).count() == 0


def test_a_repeated_doc_id_is_sampled_once(spark):
    rows = [(k, "idiot scum" if k % 2 else "a fine day") for k in range(60)]
    schema = "doc_id bigint, text string"
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id bigint, toxic int")
    hot = next(k for k, _ in rows if k % 2 == 0 and zlib.crc32(str(k).encode()) % 5 == 4)
    many = rows + [(hot, f"a fine day {k} idiot") for k in range(3000)]
    once, often = (tox.learn(spark.createDataFrame(x, schema), labels) for x in (rows, many))
    assert once.weights == often.weights and once.coefficients == often.coefficients
