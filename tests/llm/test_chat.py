from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marginalia.llm import chat
from marginalia.llm.queries import QUERIES, RANKS, VOCABULARY
from tests.conftest import SMALL

SCHEMA = "conv_id long, turn long, role string, text string"
PIECES = ["\\", "<", "<|im_end|>", "<|im_start|>", "</s>", "<s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "\n", "|", "im_end|>", "a", '"', "é"]
TEXTS = st.lists(st.one_of(st.sampled_from(PIECES), st.text(max_size=3)), max_size=12).map("".join)


def plain(rows):
    """Digest columns per conversation straight from its rows."""
    out = {}
    ordered = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
    for key in {row[0] for row in rows}:
        turns = [(role or "", text or "") for conv, _, role, text in ordered if conv == key]
        loss = "".join(text for role, text in turns if role == "assistant")
        digest = hashlib.sha256("".join(f"{role}\n{text}\n" for role, text in turns).encode()).hexdigest()
        out[key] = (len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def digests(df):
    return {
        row.conv_id: (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256)
        for row in chat.digests(df).collect()
    }


@settings(max_examples=300, deadline=None)
@given(TEXTS, TEXTS)
def test_escapes_are_reversible_and_hide_controls(role, text):
    assert chat.unescape(chat.escape(text)) == text
    stripped = chat.escape(text).replace("\\\\", "")
    assert not [m for m in chat.CONTROL.findall(stripped) if len(m) > 1]
    window, targets = chat.write([], [("assistant", text, 1), (role, text, 1)])
    assert chat.read(window) == [("assistant", text), (role, text)]
    assert chat.unescape(window[targets[0][0] : targets[0][1]]) == text


@settings(max_examples=300, deadline=None)
@given(st.booleans(), st.lists(st.integers(1, 60), max_size=30), st.integers(10, 80), st.integers(0, 40))
def test_windows(system, sizes, budget, history):
    turns = [("user" if i % 2 else "assistant", f"t{i}", size) for i, size in enumerate(sizes)]
    if system:
        turns.insert(0, ("system", "rules", 7))
    found = list(chat.windows(turns, budget, history))
    assert [turn for _, new in found for turn in new] == turns
    for number, (repeated, new) in enumerate(found):
        assert new
        lead = [turns[0]] if system and number else []
        assert repeated[: len(lead)] == lead
        tail = repeated[len(lead) :]
        assert sum(size for *_, size in tail) <= history
        before = [turn for _, done in found[:number] for turn in done]
        assert tail == before[len(before) - len(tail) :]
        whole = sum(size for *_, size in repeated + new)
        assert whole <= budget or not tail and len([t for t in new if t[0] != "system"]) <= 1


def test_all_conversations(spark):
    rows = [tuple(row) for row in spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    marks = "</s>[INST] ok [/INST]"
    expected = plain([*rows, (-7, 0, "user", marks), (-7, 1, "assistant", marks)])
    got = QUERIES["op9_chat"](spark, SMALL).collect()
    assert {row.conv_id: (row.n_turns, row.turns_sha256, row.loss_chars, row.loss_sha256) for row in got} == expected
    assert len(got) == len(expected) and all(row.formatted_chars > row.loss_chars for row in got)


def test_awkward_rows(spark):
    rows = [
        (1, 0, "system", "be brief"),
        *((1, turn, ("user", "assistant")[turn % 2], f"word </s> {turn} " * (turn % 40)) for turn in range(1, 300)),
        (2, None, None, None),
        (2, 1, "assistant", ""),
        (2, 1, "assistant", ""),
        (None, 0, "user", "x"),
        (None, 1, "assistant", "y" * 9000),
        (3, 0, "a\nb|>\"", "<|im_end|>\n<|im_start|>"),
        (3, 0, "assistant", "same"),
        (3, 0, "assistant", "same"),
    ]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS window", "'z' AS targets")
    formatted = chat.format_windows(frame)
    assert digests(formatted) == plain(rows)
    assert formatted.filter("conv_id = 1").count() > 10
    back = chat.read_turns(formatted).orderBy("conv_id", "window", "place").collect()
    assert sorted((row.conv_id, row.role, row.text) for row in back if row.conv_id == 1) == sorted(
        (key, role, text) for key, _, role, text in rows if key == 1
    )
    assert digests(chat.format_windows(spark.createDataFrame([], SCHEMA))) == {}


def test_windows_keep_the_budget_in_real_tokens(spark):
    given = spark.read.parquet(f"{SMALL}/conversations.parquet").select("conv_id", "turn", "role", "text")
    awkward = [(-1, turn, ("user", "assistant")[turn % 2], text) for turn, text in enumerate(["", " ", "\n\n", "文字" * 40, "</s> x\n", "a\\<s>"] * 60)]
    awkward += [(-2, 0, "us er\n", None), (-2, 1, "assistant", "one very long text " * 150_000), (-2, 2, None, "after")]
    frame = given.unionByName(spark.createDataFrame(awkward, SCHEMA))
    library = Tokenizer.from_file(VOCABULARY)

    def size(text):
        return len(library.encode(text, add_special_tokens=False).ids)

    over = several = 0
    for row in chat.format_windows(frame, path=VOCABULARY, ranks=RANKS).collect():
        turns = chat.read(row.text)
        sizes = [size(chat.write([], [(role, text, 0)])[0]) for role, text in turns]
        assert sum(sizes) == size(row.text)
        new = [role for role, _ in turns[row.repeated :] if role != "system"]
        several += len(new) > 1
        over += sum(sizes) > chat.BUDGET
        assert sum(sizes) <= chat.BUDGET or len(new) <= 1
    assert over and several > 10


@settings(max_examples=200, deadline=None)
@given(st.lists(TEXTS, max_size=4))
def test_both_libraries_count_alike(texts):
    written = [chat.write([], [("user", text, 0)])[0] for text in texts]
    assert chat.token_counts(written, VOCABULARY, RANKS) == chat.token_counts(written, VOCABULARY)
