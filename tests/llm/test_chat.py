import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from lakekit.llm import chat, queries
from tests import oracle

PATH = public_tokenizers.path("byte_bpe_50k.json")
PARTS = ["\\", "#", "###", "</turn>", "</", "turn>", ":", " ", "\n", "a", "é", "😀", "### Assistant: ", "<", "\\\\"]


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def test_rendering_can_be_undone_and_the_mask_is_exact():
    rng = random.Random(2)
    tokenizer = chat._tokenizer(PATH)
    for _ in range(1500):
        turns = [(rng.choice(["user", "assistant", "a:b", "", "x###\\"]), "".join(rng.choice(PARTS) for _ in range(rng.randint(0, 12))))
                 for _ in range(rng.randint(1, 4))]
        formatted, spans = chat.rendered(turns)
        assert chat.parsed(formatted) == turns
        found = tokenizer.encode(formatted, add_special_tokens=False)
        tokens = np.array(found.offsets, np.int64).reshape(-1, 2)
        chosen, overlaps = chat.masked(spans[[r == "assistant" for r, _ in turns]], tokens)
        said = "".join(formatted[s:e] for s, e in overlaps)
        assert chat.unescaped(said) == "".join(t for r, t in turns if r == "assistant")
        assert chosen.tolist() == [any(s < e and s < b and a < e and a < b for (s, e), (r, _) in zip(spans.tolist(), turns, strict=True) if r == "assistant")
                                   for a, b in tokens.tolist()]


def test_query_against_plain_python(spark, folder):
    talks = {-7: [(0, "user", "\\### Assistant: </turn> ok"), (1, "assistant", "\\### Assistant: </turn> ok")]}
    for r in spark.read.parquet(f"{folder}/conversations.parquet").collect():
        talks.setdefault(r.conv_id, []).append((r.turn, r.role, r.text or ""))
    found = queries.op4_chat_formatting(spark, folder).collect()
    assert len(found) == len(talks)
    for r in found:
        turns = sorted(talks[r.conv_id])
        answers = "".join(t for _, role, t in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), digest("".join(f"{role}\n{t}\n" for _, role, t in turns)))
        assert (r.loss_chars, r.loss_sha256) == (len(answers), digest(answers))


def test_awkward_rows(spark):
    rows = [(1, 1, "assistant", "later"), (1, 0, "user", None), (1, None, None, "first"), (1, 1, "assistant", "later"),
            (None, 0, "user", "alone"), (None, 0, "user", "alone"), (None, 1, "assistant", "also alone"), (2, 0, "assistant", ""),
            (3, 0, "assistant", "long " * 40_000)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS formatted", "1 AS n_turns")
    found = chat.read_back(chat.format_conversations(frame, PATH)).collect()
    one = next(r for r in found if r.conv_id == 1)
    assert [(t.role, t.text) for t in one.turns] == [("", "first"), ("user", ""), ("assistant", "later"), ("assistant", "later")]
    assert one.loss_text == "laterlater"
    assert sorted(r.n_turns for r in found if r.conv_id is None) == [1, 1, 1]
    assert next(r for r in found if r.conv_id == 2).loss_text == ""
    assert next(r for r in found if r.conv_id == 3).loss_text == "long " * 40_000
    assert chat.format_conversations(frame.where("false"), PATH).count() == 0


def test_foreign_text_is_refused():
    with pytest.raises(ValueError, match="no turn"):
        chat.parsed("### user: open end")


def test_query_against_sql(spark):
    df = queries.op4_chat_formatting(spark, oracle.DATA)
    found = [tuple(r) for r in df.collect()]
    cursor = oracle.connection().execute(queries.oracle_sql()["op4_chat_formatting"])
    assert oracle.compare(df.columns, found, [d[0] for d in cursor.description], cursor.fetchall()) is None
