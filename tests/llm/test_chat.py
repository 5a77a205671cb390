import hashlib
import random

import pytest
from tokenizers import Tokenizer

from strandweave.llm import chat
from strandweave.llm.common import tokenizer_path

from .data import clashing, words

TALK = "conv_id long, turn long, role string, text string"


def conversations(spark):
    r, rows = random.Random(2), []
    marks = ["### user: ", " </turn>\n", "\\", "\\h", "<", "#", ":", "\\### Assistant: </turn> ok"]
    for c in range(12):
        if c % 2:
            rows.append((c, 0, "system", f"be {c}"))
        for t in range(1, r.randrange(2, 30)):
            rows.append((c, t, "user" if t % 2 else "assistant", r.choice(marks) + words(r.randrange(0, 90), t) + r.choice(marks)))
    rows += [(50, None, None, None), (50, 1, "assistant", None), (50, 1, "assistant", "x"), (50, 1, "assistant", "x"),
             (None, 1, "assistant", "lost"), (None, 0, "us:er\n###", "lost"), (60, 0, "assistant", words(3000, 1)), (60, 1, "user", "")]
    return spark.createDataFrame(rows, TALK).repartition(5)


def expected(rows):
    by = {}
    for r in rows:
        role, text = r["role"] or "", r["text"] or ""
        by.setdefault(r["conv_id"], []).append((r["turn"] is not None, r["turn"] or 0, role, role, chat.format_turn(role, text)[0], text))
    out = {}
    for c, turns in by.items():
        all_, loss = hashlib.sha256(), ""
        for t in sorted(turns):
            all_.update(f"{t[3]}\n{t[5]}\n".encode())
            loss += t[5] if t[3] == "assistant" else ""
        out[c] = (len(turns), all_.hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


@pytest.mark.parametrize("budget,history", [(1024, 256), (120, 40), (60, 0), (1, 1)])
def test_reads_back_exactly(spark, budget, history):
    talks = clashing(conversations(spark), ["window", "n_tokens"])
    got = {r["conv_id"]: r for r in chat.window_digests(chat.chat_windows(talks, budget, history)).collect()}
    want = expected(talks.collect())
    assert got.keys() == want.keys()
    for c, w in want.items():
        assert tuple(got[c][1:5]) == w


def test_windows_keep_to_the_budget(spark):
    library = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    windows = chat.chat_windows(conversations(spark), 150, 50).collect()
    size = lambda turns: sum(len(library.encode(chat.format_turn(*t)[0], add_special_tokens=False).ids) for t in turns)
    first = {w["conv_id"]: chat.read_turns(w["text"])[0] for w in windows if w["window"] == 0}
    for w in windows:
        turns = chat.read_turns(w["text"])
        new = turns[w["repeated"]:]
        assert size(turns) == w["n_tokens"] and (w["n_tokens"] <= 150 or len(new) == 1)
        if first[w["conv_id"]][0] == "system":
            assert turns[0] == first[w["conv_id"]]
        history = turns[:w["repeated"]][first[w["conv_id"]][0] == "system" and w["window"] > 0:]
        assert size(history) <= 50
        masked = [chat.unescape(w["text"][s["start"]:s["end"]]) for s in w["loss"]]
        assert masked == [t for r, t in new if r == "assistant" and t]


def test_query_has_the_added_conversation(spark, tmp_path):
    conversations(spark).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r["conv_id"]: r for r in chat.op4_budgeted_windows(spark, str(tmp_path)).collect()}
    text = "\\### Assistant: </turn> ok"
    assert got[-7]["loss_sha256"] == hashlib.sha256(text.encode()).hexdigest() and got[-7]["n_turns"] == 2
    assert got[-7]["turns_sha256"] == hashlib.sha256(f"user\n{text}\nassistant\n{text}\n".encode()).hexdigest()
    assert chat.window_digests(chat.chat_windows(spark.createDataFrame([], TALK))).count() == 0
