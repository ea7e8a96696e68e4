import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tesserae.llm import chat

TEXTS = st.lists(st.sampled_from([*chat.CONTROL, "\\", "a", "\n", "<", "|", "é"]), max_size=8).map("".join)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(TEXTS, TEXTS), max_size=6))
def test_escape_is_reversible(turns):
    state = chat.Incremental()
    whole = chat.render([])
    for i, (role, text) in enumerate(turns):
        start, piece, rewrote = state.add(role, text)
        assert not rewrote and start == len(whole)
        whole += piece
        assert whole == chat.render(turns[: i + 1])
        r, t, a, b = chat.read_turn(piece)
        assert (r, t) == (role, text) and chat.unescape(piece[a:b]) == text


def test_long_conversations_keep_their_spans():
    turns = [("user" if i % 2 else "assistant", f"turn {i}") for i in range(200)]
    state = chat.Incremental(window=4)
    got = "".join([chat.render([]), *(state.add(*t)[1] for t in turns)])
    assert got == chat.render(turns) and len(state.held) <= 4


def test_history_rewriting_is_seen():
    def forgetful(messages):
        return "".join(f"[{t if i == len(messages) - 1 else 'gone'}]" for i, (_, t) in enumerate(messages))

    state = chat.Incremental(forgetful)
    assert [state.add("user", t) for t in ("one", "two")] == [(0, "[one]", False), (1, "gone][two]", True)]
    assert state.rewrites


def late_numbers(messages):
    return "".join(f"{i if i >= 20 else ''}:{t};" for i, (_, t) in enumerate(messages))


def late_stripping(messages):
    return "".join(f"{'' if r == 'assistant' and i < 5 and len(messages) > 40 else t};" for i, (r, t) in enumerate(messages))


def falsely_local(template):
    def own(messages):
        return template(messages)

    own.local = True
    return own


@pytest.mark.parametrize("template", [late_numbers, late_stripping, falsely_local(late_numbers), falsely_local(late_stripping)])
def test_templates_that_change_late(spark, template):
    """Sixty turns: numbers from the twentieth on, or early answers stripped after the fortieth; declared local or not."""
    turns = [("assistant" if i % 2 else "user", f"turn {i}") for i in range(60)]
    want, rewrites = [], False
    for k in range(60):
        before, now = template(turns[:k]), template(turns[: k + 1])
        same = next((i for i, (a, b) in enumerate(zip(before, now)) if a != b), min(len(before), len(now)))
        want.append((same, now[same:], same < len(before)))
    assert chat.verified(turns, template)[1] == want
    df = spark.createDataFrame([(1, i, *t) for i, t in enumerate(turns)], "conv_id long, turn long, role string, text string")
    got = [(r["start"], r["piece"], r["rewrote"]) for r in chat.format_turns(df, template).orderBy("n").collect()]
    assert got == want and any(r for *_, r in got) == any(r for *_, r in want)


def test_conversations_beyond_what_is_held(spark, monkeypatch):
    monkeypatch.setattr(chat, "VERIFIED", 50)
    turns = [("assistant" if i % 2 else "user", f"turn {i}" * 3) for i in range(60)]
    state, out = chat.verified(turns[:5])
    out += [state.add(*t) for t in turns[5:]]
    assert chat.render([]) + "".join(p for _, p, _ in out) == chat.render(turns) and len(state.held) <= chat.WINDOW


def test_templates_that_count_get_all_turns():
    def counting(messages):
        return "".join(f"{i}:{t};" for i, (_, t) in enumerate(messages))

    turns = [("user", str(i)) for i in range(40)]
    state = chat.Incremental(counting, window=3)
    assert "".join(state.add(*t)[1] for t in turns) == counting(turns)


def truncating(messages):
    return "".join(f"[{t}]" for _, t in messages[-20:])


def with_system(messages):
    system = "".join(t for r, t in messages if r == "system")
    return "".join(f"{r}:{system if r == 'user' else ''}{t};" for r, t in messages)


def user_first(messages):
    if [r for r, _ in messages if r != "system"][:1] not in ([], ["user"]):
        raise ValueError("a user turn comes first")
    return "".join(f"{r}:{t};" for r, t in messages)


def test_black_box_templates_in_long_conversations():
    turns = [("system", "be kind")] + [("assistant" if i % 2 else "user", f"turn {i}") for i in range(60)]
    for template in (truncating, with_system, user_first):
        state = chat.Incremental(template)
        rewrites = False
        for k, turn in enumerate(turns):
            before, now = template(turns[:k]), template(turns[: k + 1])
            same = next((i for i, (a, b) in enumerate(zip(before, now)) if a != b), min(len(before), len(now)))
            rewrites |= same < len(before)
            assert state.add(*turn) == (same, now[same:], same < len(before)), (template.__name__, k)
        assert state.rewrites == rewrites == (template is truncating)


def test_rows_of_a_black_box_template(spark):
    turns = [("system", "be kind")] + [("assistant" if i % 2 else "user", f"turn {i}") for i in range(40)]
    df = spark.createDataFrame([(1, i, *t) for i, t in enumerate(turns)], "conv_id long, turn long, role string, text string")
    got = chat.format_turns(df, with_system).orderBy("n").collect()
    assert "".join(r["piece"] for r in got) == with_system(turns) and not any(r["rewrote"] for r in got)


def digest(turns):
    loss = "".join(t for r, t in turns if r == "assistant")
    whole = "".join(f"{r}\n{t}\n" for r, t in turns)
    return len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest(), len(chat.render(turns))


def test_rows(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "user", None), (2, 1, None, "x"), (2, 1, None, "x"), (None, 0, "assistant", ""), (None, None, "user", "n"), (2**60 + 1, 5, "system", "[INST]" * 9)]
    rows += [(3, i, "assistant" if i % 2 else "user", f"</s> {i}" * (i % 5)) for i in range(500)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, n int").repartition(3)
    got = {r["conv_id"]: tuple(r)[1:6] for r in chat.digests(chat.format_turns(df)).collect()}
    want = {}
    for c, _, role, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, -1 if r[1] is None else r[1], r[2] or "", r[3] or "")):
        want.setdefault(c, []).append((role or "", text or ""))
    assert got == {c: digest(t) for c, t in want.items()}
    assert chat.digests(chat.format_turns(df.where("false"))).count() == 0
