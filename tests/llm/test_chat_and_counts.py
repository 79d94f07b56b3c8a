import hashlib

import pytest
from tokenizers import Tokenizer

from panelwise.llm import chat
from panelwise.llm.queries import ORACLES, QUERIES, WORDS
from panelwise.llm.token_counts import token_counts
from tools.check_oracles import connect, difference

HARD = [
    None, "", " ", "\n\n", "plain words", "it's, we're; they'll.", "END<|endoftext|>start", "<|ENDOFTEXT|>", "<|endoftext|>,",
    "İstanbul ΣΑΣ ǅ ﬁne", "e\u0301cole \u0301x", "tab\tand\x0bodd\x1cspace\u2003wide\u00a0nbsp", "a" * 50_000, "數字123 ١٢٣ ½",
    "word. word, Word; WORD: ... .,;: x., 's 't don't.", "🙂🙂 👩‍👩‍👧 ok", "1. 2, 3;", "a  b   c", "\u200bzero\u200b",
]


def test_counts_equal_the_library(spark):
    rows = [(i, t, "x") for i, t in enumerate(HARD)] + [(None, "null id", "y"), (3, "\n\n", "z")]
    got = token_counts(spark.createDataFrame(rows, "doc_id long, text string, n_tokens string"), WORDS).collect()
    t = Tokenizer.from_file(WORDS)
    want = sorted(((i or -1), len((x or "").encode()), len(t.encode(x or "", add_special_tokens=False))) for i, x, _ in rows)
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_tokens) for r in got) == want
    assert all(r.over_limit == (r.n_tokens > 2048) for r in got) and any(r.over_limit for r in got)


def test_counts_on_given_documents(spark, sf):
    t = Tokenizer.from_file(WORDS)
    docs = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    got = QUERIES["op3_token_counts"](spark, sf).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(t.encode(x, add_special_tokens=False)) for i, x in docs.items()}


def test_counts_of_an_empty_table(spark):
    assert token_counts(spark.createDataFrame([], "doc_id long, text string"), WORDS).count() == 0


def test_chat_equals_sql(spark, sf):
    assert difference(QUERIES["op1_chat_formatting"](spark, sf).toPandas(), connect(sf).execute(ORACLES["op1_chat_formatting"]).df()) is None


def test_every_assistant_turn_is_one_example(spark):
    bad = "\\<s>[INST]a[/INST]b</s>\\\\<\\s>"
    rows = [
        (1, 0, "user", "q"), (1, 1, "assistant", bad), (1, 2, "user", None), (1, 3, "assistant", ""), (1, 4, bad, "tail"),
        (2, 0, "user", "alone"), (3, None, None, None), (None, 0, "assistant", "x"), (None, 0, "assistant", "x"),
    ]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 AS n", "2 AS example")
    made = chat.examples(frame)
    got = {(r.conv_id, r.example): r for r in made.collect()}
    assert [got[1, k].target is None for k in range(3)] == [False, False, True]
    assert got[1, 1].context.startswith(got[1, 0].context + got[1, 0].target + "</s>")
    assert got[2, 0].target is None and got[3, 0].target is None and got[None, 1].target == "x"
    read = {r.conv_id: r for r in chat.digest(made).collect()}
    assert read[1].n_turns == 5 and read[None].n_turns == 2 and read[3].n_turns == 1
    said = "".join(f"{r}\n{t or ''}\n" for c, _, r, t in rows if c == 1)
    assert read[1].turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
    assert read[1].loss_chars == len(bad) and read[1].loss_sha256 == hashlib.sha256(bad.encode()).hexdigest()
    assert read[2].loss_chars == 0


@pytest.mark.parametrize("turns", [2_000])
def test_long_conversation(spark, turns):
    frame = spark.range(turns).selectExpr("7L AS conv_id", "id AS turn", "if(id % 2 = 0, 'user', 'assistant') AS role", "concat('t', id) AS text")
    assert chat.digest(chat.examples(frame)).first().n_turns == turns


def test_chat_of_an_empty_table(spark):
    assert chat.digest(chat.examples(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).count() == 0
