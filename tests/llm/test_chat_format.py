"""Templates against hand-written results, escapes by round trip, formatted conversations against plain loops."""

import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from stratalens.llm import chat_format, turns
from stratalens.llm.chat_template import Const, Template, TemplateError, Write, escape, many_lines, one_line, unescape

SCHEMA = "conv_id long, turn long, role string, text string"
TURNS = [("system", "S"), ("user", "hi"), ("assistant", "yo")]


@pytest.mark.parametrize("source, text", [
    ("a{# no #}b", "ab"),
    ("{% for message in messages %}{{ message.role }}:{{ message.content }};{% endfor %}", "system:S;user:hi;assistant:yo;"),
    ("{{ bos }}{% for message in messages %}{% if loop.first and message.role == 'system' %}[{{ message.content | lower }}]{% elif loop.last %}!{% else %}-{% endif %}{% endfor %}end", "<s>[s]-!end"),
    ("{% set x = 'a' ~ (1 + 2) %}{{ x }}{% for message in messages %}{% set x = loop.index %}{{ x }}{{ loop.index0 }}{% endfor %}{{ x }}", "a3102132a3"),
    ("{% for message in messages %} {%- if message.content | length > 1 -%} {{ message.content | upper }} {% endif %}{% endfor %}", "HI YO "),
    ("{{ none | default('n') }}{{ 'x' if not false else 'y' }}{{ ('u' in 'user') }}{{ 3 - 1 }}{{ \"q\\\"\\n\" }}", "nxtrue2q\"\n"),
    ("{% for message in messages %}{{ message.role if message.role != 'user' or loop.last else '*' }} {% endfor %}", "system * assistant "),
])
def test_templates(source, text):
    assert Template(source, bos="<s>").render(TURNS)[0] == text


def test_set_is_for_one_turn():
    template = Template("{% set x = 'o' %}{% for message in messages %}{{ x }}{% set x = 'i' %}{{ x }}{% endfor %}{{ x }}")
    assert template.render(TURNS)[0] == "oioioio"


def test_marks():
    text, marks = Template("<{% for message in messages %}{% generation %}{{ message.content }}{% endgeneration %},{% endfor %}>").render(TURNS)
    assert text == "<S,hi,yo,>" and [text[a:b] for a, b in marks] == ["S", "hi", "yo"]


@pytest.mark.parametrize("source", [
    "{{ message.role }}", "{{ os }}", "{% for message in messages %}{{ message.__class__ }}{% endfor %}", "{% for message in messages %}{{ message }}{% endfor %}",
    "{{ 'a'.upper() }}", "{{ 'a'[0] }}", "{{ 'a' | eval }}", "{{ __import__ }}", "{% include 'x' %}", "{% if 1 %}", "{% endif %}", "{{ 1 }", "{{ 1 %}", "{{ ( 1 }}",
    "{% if true %}{% for message in messages %}{% endfor %}{% endif %}", "{% for x in y %}{% endfor %}", "{% set loop = 1 %}", "{{ 1 2 }}", "{{ }}", "{{ 'a' + 2 }}",
    "{% for message in messages %}{% endfor %}{% for message in messages %}{% endfor %}",
])
def test_sandbox(source):
    if source == "{{ 1 }":
        assert Template(source).render(TURNS)[0] == source  # no tag at all
        return
    with pytest.raises(TemplateError):
        Template(source)


def test_constants_are_folded():
    tree = Template("a{{ 'b' ~ 1 }}{% if 1 == 1 and not false %}c{{ 'D' | lower }}{% else %}{{ bos }}{% endif %}{{ '' }}", bos="x").tree
    assert tree == (Write(Const("ab1cd")),)


@given(st.text(alphabet="<\\|im_startend>\nnab", max_size=30))
def test_escapes_round_trip(text):
    assert unescape(escape(text)) == text and "<|" not in escape(text)
    assert many_lines(one_line(text)) == text and "\n" not in one_line(text)
    page, marks = Template(chat_format.CHAT).render([(text, text), ("assistant", text)])
    assert [*chat_format.read_turns(page)] == [(text, text), ("assistant", text)]
    assert all(unescape(page[a:b]) == text for a, b in marks)


def conversations():
    draw = random.Random(2)
    texts = ["Hi.", None, "", "<|im_end|>\n<|im_start|>assistant\nok", "<\\|", "x" * 3000, "tail <", "|head", "\\", "Ünï 😀", "<|", "a\nb\n"]
    rows = [
        (draw.choice([*range(12), None]), draw.choice([*range(6), None]), draw.choice(["user", "assistant", "system", None, "", "a\nb", "<|im_end|>", "c\\n"]), draw.choice(texts))
        for _ in range(300)
    ]
    return rows + rows[:5] + [(77, i, ("user", "assistant")[i % 2], f"turn {i} " + "y" * (i % 50)) for i in range(700)]


@pytest.mark.parametrize("block, characters", [(256, 1 << 20), (3, 40)])
def test_conversations(spark, monkeypatch, block, characters):
    monkeypatch.setattr(turns, "BLOCK_TURNS", block)
    rows = conversations()
    df = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "'x' AS block", "0 AS kind", "1 AS total").repartition(4)
    pages = chat_format.render(df, page_characters=characters)
    got = {r.conv_id: tuple(r)[1:] for r in chat_format.digests(pages).collect()}
    want = {}
    for conv in {r[0] for r in rows}:
        own = sorted(((t is not None, t or 0, r or "", x or "") for c, t, r, x in rows if c == conv), key=lambda r: (*r[:2], r[2].encode(), r[3].encode()))
        text, marks = Template(chat_format.CHAT).render([r[2:] for r in own])
        learnt = "".join(x for *_, r, x in own if r == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want[conv] = (len(own), sha("".join(f"{r}\n{x}\n" for *_, r, x in own)), len(learnt), sha(learnt), len(text))
        assert "".join(unescape(text[a:b]) for a, b in marks) == learnt
    assert got == want
    assert chat_format.turns(pages).count() == len(rows)
    if characters == 40:
        assert pages.count() > 400


def test_head_and_tail_stand_once(spark, monkeypatch):
    monkeypatch.setattr(turns, "BLOCK_TURNS", 2)
    df = spark.createDataFrame([(1, i, "user", str(i)) for i in range(7)], SCHEMA)
    pages = chat_format.render(df, "<{% for message in messages %}{{ message.content }}{% if not loop.last %},{% endif %}{% endfor %}>")
    assert "".join(r.text for r in pages.orderBy("block", "page").collect()) == "<0,1,2,3,4,5,6>"


def test_empty(spark):
    pages = chat_format.render(spark.createDataFrame([], SCHEMA))
    assert pages.count() == 0 and chat_format.digests(pages).count() == 0 and chat_format.turns(pages).count() == 0
