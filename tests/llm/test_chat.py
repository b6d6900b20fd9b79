"""Windows of conversations: what they hold, what they repeat and what is under the mask."""

import hashlib
import os
from collections import defaultdict

import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from passagemill.llm import chat, encoders, queries

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def count():
    model = Tokenizer.from_file(encoders.default_path("byte_bpe_50k.json"))
    model.encode_special_tokens = True
    return lambda text: len(model.encode(text, add_special_tokens=False).ids)


TRICKY = ["\\### Assistant: </turn> ok", "###", "####", "<", "</", "/turn>\n", "\\", "\\\\</turn>\n### user: x", "a: b", "<\\/turn>", "", "#", "end<", "\n### system: ", "<|endoftext|>"]


@given(st.lists(st.tuples(st.text("#</>turn :\\\nab", max_size=20), st.text("#</>turn :\\\nab", max_size=40)), max_size=5))
def test_any_turns_come_back(turns):
    window = "".join(chat.render(role, text)[0] for role, text in turns)
    assert chat.read_turns(window) == turns
    for role, text in turns:
        made, start, end = chat.render(role, text)
        assert chat.unescape(made[start:end]) == text
        assert "</turn>" not in made[: -len("</turn>\n")] and "##" not in chat.escape(text)


@given(st.lists(st.integers(0, 50), max_size=40), st.integers(1, 80), st.integers(0, 5), st.integers(0, 40))
def test_spans(tokens, budget, history, history_tokens):
    """Each turn is new once, and windows keep to the budget unless one turn is over it."""
    at = 0
    for h, s, e in chat.spans_of_turns(tokens, 0, 0, budget, history, history_tokens):
        assert s == at and e > s and h <= s and s - h <= history and sum(tokens[h:s]) <= history_tokens
        assert sum(tokens[h:e]) <= budget or (h, e) == (s, s + 1) and tokens[s] > budget or sum(tokens[s:e]) == tokens[s] and sum(tokens[h:s]) == 0
        if e < len(tokens):
            assert sum(tokens[h : e + 1]) > budget
        at = e
    assert at == len(tokens)


def naive(turns, count, budget, history, share, part=10**9, system="system"):
    """Windows of one ordered conversation as ``(turn numbers, new ones)``, counted turn by turn."""
    cost = [count(chat.render(r or "", t or "")[0]) for r, t in turns]
    lead = [0] if turns and turns[0][0] == system else []
    s, out = len(lead), []
    while s < len(turns):
        room = budget - sum(cost[i] for i in lead)
        past = []
        for i in range(s - 1, max(len(lead) - 1, s - 1 - history), -1):
            if sum(cost[j] for j in past) + cost[i] + cost[s] > room or sum(cost[j] for j in past) + cost[i] > share:
                break
            past.insert(0, i)
        new = [s]
        while new[-1] + 1 < len(turns) and (new[-1] + 1) // part == s // part and sum(cost[j] for j in past + new) + cost[new[-1] + 1] <= room:
            new.append(new[-1] + 1)
        out.append((lead + past + new, new if out else lead + new))
        s = new[-1] + 1
    return out or [(lead, lead)]


CONVERSATIONS = [
    *[(1, i, "system" if i == 0 else ("user", "assistant")[i % 2], f"text {i} " * (i % 7)) for i in range(30)],
    (2, 0, "user", TRICKY[0]), (2, 1, "assistant", TRICKY[0]),
    (3, 5, "assistant", None), (3, 5, "assistant", None), (3, None, None, "no role"), (3, 1, "user", "x " * 500),
    (4, 0, "system", "alone"), (None, 0, "user", "null id"), (None, 1, "assistant", "answer"),
    *[(5, i, ("user", "assistant", "system")[i % 3], t) for i, t in enumerate(TRICKY)],
    *[(6, 0, "assistant", f"tie {i % 4}") for i in range(25)],
    *[(None if i % 2 else 7, i, "user" if i % 4 < 2 else "assistant", "filler " * (i % 5)) for i in range(2, 60)],
]


def ordered(rows):
    """Conversations with their turns in order: null turns first, then role and text."""
    made = defaultdict(list)
    for c, n, r, t in rows:
        made[c].append(((n is not None, n or 0), (r or "").encode(), (t or "").encode()))
    return {c: [(r.decode(), t.decode()) for _, r, t in sorted(v)] for c, v in made.items()}


def table(spark, rows):
    shaped = [(c, n, r, t, 1, "x") for c, n, r, t in rows]
    return spark.createDataFrame(shaped, "conv_id long, turn long, role string, text string, part int, spans string").repartition(3)


@pytest.mark.parametrize("part,history", [(1024, 4), (10, 4), (10, 0), (7, 2)])
def test_windows(spark, count, monkeypatch, part, history):
    """Nulls, ties, repeated rows, clashing columns; long conversations in parts."""
    monkeypatch.setattr(chat, "PART", part)
    budget, share = 90, 22
    windows = chat.chat_windows(table(spark, CONVERSATIONS), budget, history)
    found = defaultdict(list)
    for w in sorted(windows.collect(), key=lambda w: (w["part"], w["window"])):
        found[w.conv_id].append(w)
    want = ordered(CONVERSATIONS)
    assert set(found) == set(want)
    for c, turns in want.items():
        seen, trained = [], []
        naive_windows = naive(turns, count, budget, history, share, part if len(turns) > part else 10**9)
        assert len(naive_windows) == len(found[c]), c
        for w, (all_turns, new) in zip(found[c], naive_windows):
            assert chat.read_turns(w.text) == [turns[i] for i in all_turns]
            assert (w.n_turns, w.n_repeated, w.n_tokens) == (len(all_turns), len(all_turns) - len(new), count(w.text))
            assert w.n_tokens <= budget or len(new) == 1
            masked = [chat.unescape(w.text[x["start"] : x["end"]]) for x in w.spans]
            assert masked == [turns[i][1] for i in new if turns[i][0] == "assistant"]
            seen += [turns[i] for i in new]
            trained += masked
        assert seen == turns and trained == [t for r, t in turns if r == "assistant"]


@pytest.mark.parametrize("part", [1024, 10])
def test_read_back(spark, monkeypatch, part):
    """Digests of conversations in one and in several parts."""
    monkeypatch.setattr(chat, "PART", part)
    windows = chat.chat_windows(table(spark, CONVERSATIONS), 90, 4)
    size = defaultdict(int)
    for w in windows.collect():
        size[w.conv_id] += len(w.text)
    assert any(w.n_parts > 1 for w in windows.collect()) == (part == 10)
    found = {r.conv_id: r for r in chat.read_back(windows).collect()}
    want = ordered(CONVERSATIONS)
    assert set(found) == set(want)
    for c, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert tuple(found[c]) == (c, len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), size[c])


def test_empty_table(spark):
    windows = chat.chat_windows(table(spark, CONVERSATIONS).limit(0))
    assert windows.collect() == [] and chat.read_back(windows).collect() == []


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")
def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", TRICKY[0]), (-7, 1, "assistant", TRICKY[0])]
    want = ordered(rows)
    found = {r.conv_id: r for r in queries.QUERIES["op11_chat_windows"](spark, SF).collect()}
    assert set(found) == set(want)
    for c, turns in want.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        assert found[c].turns_sha256 == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        assert (found[c].n_turns, found[c].loss_chars, found[c].loss_sha256) == (len(turns), len(loss), hashlib.sha256(loss.encode()).hexdigest())
        assert found[c].formatted_chars >= sum(len(chat.render(r, t)[0]) for r, t in turns)
