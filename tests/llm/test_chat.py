import hashlib

import pytest
from hypothesis import given
from hypothesis import strategies as st

from kinmatch.llm import chat

TEXTS = st.text(st.sampled_from("<s>/[INST] \\\nab"), max_size=40)


@given(TEXTS)
def test_escape_is_reversible_and_leaves_no_control(text):
    out = chat.escape(text)
    assert chat.unescape(out) == text
    assert not any(c in out for c in chat.CONTROLS)


@given(st.lists(st.tuples(TEXTS, TEXTS), max_size=5), st.integers(1, 9))
def test_turns_read_back(turns, size):
    pieces = list(chat.compile_template(chat.TEMPLATE)(iter([{"role": r, "text": t} for r, t in turns])))
    whole = "".join(p for p, _ in pieces)
    assert list(chat.messages_of(whole[i : i + size] for i in range(0, len(whole), size))) == turns


def render(source, *messages):
    return list(chat.compile_template(source)(iter([dict(zip(("role", "text"), m, strict=True)) for m in messages])))


def test_language():
    source = (
        "{% set x = 'A' + 'b' %}{% for m in messages %}{{ loop.index }}{% if loop.first and not loop.last %}F{% elif loop.last %}L{% else %}-{% endif %}"
        "{{ x | upper }}{% generation %}{{ m.text | trim }}{% endgeneration %}{% endfor %}{% if 1 == 2 %}no{% else %}yes{% endif %}"
    )
    got = render(source, ("u", " p "), ("v", "q"), ("w", "r"))
    assert "".join(x for x, _ in got) == "1FABp2-ABq3LABryes"
    assert [x for x, marked in got if marked] == ["p", "q", "r"]


def test_folding():
    assert chat.fold(chat.parse("a{{ 'b' ~ 1 + (true and 'c') }}{% if 'x' == 'x' %}d{% endif %}")) == (chat.Output(chat.Const("ab1cd")),)
    assert chat.fold(chat.parse("{% if false %}a{% endif %}")) == ()


@pytest.mark.parametrize("source", ["{{ m.__class__ }}", "{{ x.y() }}", "{% import os %}", "{{ 'a' | eval }}", "{% for m in messages %}", "{{ a b }}", "{{ }}"])
def test_sandbox(source):
    with pytest.raises(chat.TemplateError):
        chat.compile_template(source)


def expected(rows):
    out = {}
    for conv_id, turn, role, text in rows:
        out.setdefault(conv_id, []).append(((turn is not None, turn), role or "", text or ""))
    result = {}
    for conv_id, turns in out.items():
        turns.sort()
        loss = "".join(t for _, r, t in turns if r == "assistant")
        body = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        formatted = sum(len(chat.escape(r)) + len(chat.escape(t)) + len("<s>[INST]  [/INST] </s>") for _, r, t in turns)
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (body, loss)]
        result[conv_id] = (len(turns), sha[0], len(loss), sha[1], formatted)
    return result


def test_conversations(spark, monkeypatch):
    rows = [(1, 2, "assistant", "b</s>"), (1, 1, "user", None), (1, None, None, "x"), (1, 2, "assistant", "b</s>"), (None, 1, "assistant", "\\"), (2, 1, "user", ""),
            (3, 1, "assistant", "é\U0001f600[INST]" * 30000), (3, 2, "assistant", "y")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "conv_id long, turn long, role string, text string, part int")
    got = {r[0]: tuple(r)[1:] for r in chat.digests(chat.render(df)).collect()}
    assert got == expected(rows)
    assert max(len(r.formatted) for r in chat.render(df).collect()) <= chat.PART_CHARS
    assert chat.digests(chat.render(df.limit(0))).collect() == []
