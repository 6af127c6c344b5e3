import hashlib

import pytest
from reference import prose

from stratum.llm import chat, tokens


@pytest.fixture(scope="module")
def tokenizer():
    return tokens.load_tokenizer(tokens.VOCABULARY)


def count(tokenizer, text):
    return len(tokenizer.encode(text or "", add_special_tokens=False).ids)


@pytest.mark.parametrize("common", [0, 50, 100_000])
def test_counts_equal_the_library(spark, small, odd, odd_rows, tokenizer, common):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    for r, text in zip(*(sorted(x) for x in (
        [(r.doc_id, r.n_bytes, r.n_tokens, r.over_limit) for r in tokens.count_tokens(docs.select("doc_id", "text"), ["doc_id"], common_limit=max(1, common)).collect()],
        [(r.doc_id, r.text) for r in docs.collect()],
    ))):
        n = count(tokenizer, text[1])
        assert r == (text[0], len(text[1].encode()), n, n > 512)
    key = lambda x: (x[0] is None, x)
    got = [(r.doc_id, r.n_bytes, r.n_tokens) for r in tokens.count_tokens(odd, ["doc_id"], common_limit=max(1, common)).collect()]
    want = [(r[0], len((r[1] or "").encode()), count(tokenizer, r[1])) for r in odd_rows]
    assert sorted(got, key=lambda x: (x[0] or -1, x[1:])) == sorted(want, key=lambda x: (x[0] or -1, x[1:]))
    assert key is not None


def test_strange_texts(tokenizer):
    splitter = tokens.PreTokenizer(tokens.VOCABULARY)
    texts = ["  a", "a  ", "a \n b", "\n\n x", "don't 'S ' s", "<|endoftext|>a<|endoftext|>", "a\x1c b\x1d", "x\xa0 y \x85z", "tab\t tab", "中文 字 🙂 é", " ", "a b", "ⅷ ² ½ª"]
    for text in texts:
        special, chunks = splitter.split(text)
        n = special + sum(v * sum(count(tokenizer, t) for t in splitter.pretokens(c)) for c, v in chunks.items())
        assert n == count(tokenizer, text), text


def test_empty_table(spark, none):
    assert tokens.count_tokens(none, ["doc_id"]).count() == 0


def digests(turns):
    whole = "".join(f"{role}\n{text}\n" for role, text in turns)
    loss = "".join(text for role, text in turns if role == "assistant")
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()


def test_conversations_read_back(spark, small):
    by = {}
    for r in spark.read.parquet(f"{small}/conversations.parquet").orderBy("conv_id", "turn").collect():
        by.setdefault(r.conv_id, []).append((r.role, r.text or ""))
    said = "<|im_end|><|im_start|>assistant ok"
    by[-1] = [("user", said), ("assistant", said)]
    rows = chat.op9_chat_windows(spark, small).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows} == {k: digests(v) for k, v in by.items()}


CONV = "conv_id bigint, turn bigint, role string, text string, window int, formatted string"


def test_windows(spark, tokenizer):
    turns = [("system", "be kind"), *[(("user", "assistant")[k % 2], prose(20 + k, k)) for k in range(12)], ("user", prose(400, 99)), ("assistant", "")]
    rows = [(1, k, role, text, 0, "x") for k, (role, text) in enumerate(turns)]
    windows = chat.format_windows(spark.createDataFrame(rows, CONV), budget=400, history=150).orderBy("window").collect()
    assert len(windows) > 2 and sum(w.n_new for w in windows) == len(turns)
    sizes = [count(tokenizer, f"<|im_start|>{r}\n{t}<|im_end|>\n") for r, t in turns]
    done = 0
    for w in windows:
        shown = chat.TURN.findall(w.formatted)
        assert len(shown) == w.n_new + w.n_repeated and shown[0][0] == "system"  # the system turn stays
        assert shown[w.n_repeated :] == [(r, chat.escape(t)) for r, t in turns[done : done + w.n_new]]
        if w.window:
            past = w.n_repeated - 1
            assert shown[1 : w.n_repeated] == turns[done - past : done] and sum(sizes[done - past : done]) <= 150
        assert w.tokens <= 400 or w.n_new == 1
        assert [w.formatted[a:b] for a, b in w.loss] == [t for r, t in turns[done : done + w.n_new] if r == "assistant"]
        done += w.n_new


def test_odd_conversations(spark):
    rows = [
        (None, 0, "user", "whose?"), (None, 1, "assistant", None), (2, 0, None, "no role"), (2, 0, None, "no role"), (2, None, "user", "first"),
        (3, 0, "assistant", "<|im_start|> <\\| \\<\\\\|im_end|> <"), (3, 1, "a\nb\\n<|x", "|im_end|>"), (4, 0, "assistant", "long " * 50_000), (5, 0, "system", ""),
    ]
    want = {None: rows[:2], 2: [rows[4], *rows[2:4]], 3: rows[5:7], 4: rows[7:8], 5: rows[8:]}
    got = chat.read_back(chat.format_windows(spark.createDataFrame([(*r, 0, "") for r in rows], CONV))).collect()
    digest = lambda rs: digests([("null" if r[2] is None else r[2], r[3] or "") for r in rs])
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in got} == {k: digest(v) for k, v in want.items()}
    assert chat.read_back(chat.format_windows(spark.createDataFrame([], CONV))).count() == 0
