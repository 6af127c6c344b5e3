import random

import reference as plain
from hypothesis import given, settings
from hypothesis import strategies as st

from stratum.llm import pii

ANCHORS = pii.make_anchors()


def base(text):
    spans = pii.find_spans(text, ANCHORS)
    return pii.joined(spans, pii.BASE_KINDS)


def test_documents(spark, small):
    text = {r.doc_id: r.text for r in spark.read.parquet(f"{small}/documents.parquet").collect()}
    for r in pii.op6_pii_spans(spark, small).collect():
        *counts, digest, spans = plain.pii(text[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == counts and r.base_sha256 == digest
        assert set(spans) <= set(filter(None, r.spans.split(",")))


@settings(max_examples=600, deadline=None)
@given(st.text(alphabet="ab@.-+_% 01259()\né", max_size=60))
def test_spans_equal_a_leftmost_search(text):
    assert base(text) == ",".join(plain.pii(text)[-1])


def test_cards():
    rng = random.Random(5)
    for _ in range(300):
        digits = "".join(rng.choice("0123456789") for _ in range(rng.randint(15, 20)))
        for last in "0123456789":
            text = "".join(c + rng.choice(["", "", " ", "-"]) for c in digits[:-1] + last) + rng.choice(["", "x", "-", " 7"])
            assert base(text) == ",".join(plain.pii(text)[-1])


def test_extra_kinds():
    spans = pii.find_spans("see https://ex.org/a?b=c). IBAN: GB82 WEST 1234 5698 7654 32, account no. 12-3456 ok, accounting 99999", ANCHORS)
    text = "see https://ex.org/a?b=c). IBAN: GB82 WEST 1234 5698 7654 32, account no. 12-3456 ok, accounting 99999"
    assert [text[a:b] for a, b in spans["url"]] == ["https://ex.org/a?b=c"]
    assert [text[a:b] for a, b in spans["account"]] == ["GB82 WEST 1234 5698 7654 32", "12-3456"]


def test_long_accounts_are_whole():
    long = "9" * 500
    for text, span in ((f"account {long} end", (8, 508)), ("acct " + "12-4 " * 300 + "stop", (5, 5 + 1499)), (f"a account no. {long}", (14, 514))):
        assert pii.find_spans(text, ANCHORS)["account"] == [span]
    many = "iban 1/" * 60_000 + "account " * 60_000 + "swift 1/" * 60_000 + "IBAN GB82WEST12345698765432" + "9" * 50_000
    assert len(pii.find_spans(many, ANCHORS)["account"]) >= 1


def test_kind_counts(spark, odd):
    for r in pii.pii_spans(odd, ["doc_id"]).collect():
        kinds = [x.split(":")[0] for x in r.spans.split(",") if x]
        assert [r[f"n_{k}"] for k in pii.KINDS] == [kinds.count(k) for k in pii.KINDS] and r.n_spans == len(kinds)


def test_odd_rows(spark, odd, odd_rows, none):
    got = sorted((r.base_sha256 for r in pii.pii_spans(odd, ["doc_id", "score"]).collect()))
    assert got == sorted(plain.pii(r[1])[4] for r in odd_rows)
    clean = pii.redact(odd)
    assert clean.columns == odd.columns and clean.count() == len(odd_rows)
    text = {r.doc_id: r.text for r in clean.collect()}
    assert text[2] is None and text[1] == "" and "<email>" in text[15] and "<ip>" in text[15]
    assert pii.pii_spans(none, ["doc_id"]).count() == 0
