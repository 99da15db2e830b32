from __future__ import annotations

import hashlib
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from galegrid.llm import chat as C
from galegrid.llm import template as T

SCHEMA = "conv_id bigint, turn bigint, role string, text string, piece string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    """What the contract says, worked out from the rows themselves."""
    out = {}
    for conv in {r[0] for r in rows}:
        order = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or ""))
        turns = [(r[2] or "", r[3] or "") for r in order]
        learned = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(learned), sha(learned),
                     sum(len(p) for p, _ in C.pieces(turns)))
    return out


def read(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    return {r[0]: tuple(r)[1:] for r in C.read_back(C.formatted(df)).collect()}


def test_round_trip(spark):
    rng = random.Random(3)
    bits = [*C.CONTROL, "\\", "a", "é", "\n", "<", "|", "\\n", "</s>[INST] ok [/INST]", "𝄞"]
    rows = [
        (c, t, rng.choice(["user", "assistant", "system", None, "a\nb", "\\", C.END]), "".join(rng.choices(bits, k=rng.randint(0, 9))))
        for c in range(40)
        for t in range(rng.randint(1, 7))
    ]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    rows += [(50, None, "user", None), (50, 1, "assistant", None), (50, 1, "assistant", "tie"), (None, 0, "user", "no key")]
    assert read(spark, rows) == brute(rows)


def test_long_conversation_streams(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"text {t} ") for t in range(5000)]
    rows.append((2, 0, "assistant", "x" * 300_000))
    assert read(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert read(spark, []) == {}


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([*C.CONTROL, "\\", "<", "[", "s>", "|im_end|>", "INST]", "/", "x"]), max_size=12).map("".join))
def test_escape_is_reversible_and_hides_control_strings(text):
    assert C.unescape(C.escape(text)) == text
    assert not any(c in C.escape(text) for c in C.CONTROL)
    assert C.unescape_name(C.escape_name(text + "\n")) == text + "\n"


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.text(max_size=8), st.text(max_size=20)), max_size=6), st.integers(1, 7))
def test_turns_from_pieces_cut_anywhere(turns, size):
    whole = "".join(p for p, _ in C.pieces(turns))
    assert list(C.turns_of(whole[i : i + size] for i in range(0, len(whole), size))) == turns


def show(source, **values):
    return "".join(p for p, _ in T.compile_template(source)(**values))


@pytest.mark.parametrize(
    "source, values, text",
    [
        ("a{{ 1 + 2 }}b", {}, "a3b"),
        ("{{ x }}|{{ x.y }}|{{ x['y'] }}|{{ l[1] }}|{{ l[9] }}", {"x": {"y": "z"}, "l": [1, 2]}, "{'y': 'z'}|z|z|2|"),
        ("{% for m in ms %}{{ loop.index }}{{ m }}{% if not loop.last %},{% endif %}{% endfor %}", {"ms": ["a", None, "b"]}, "1a,2,3b"),
        ("{% if a and b or c %}yes{% elif d %}maybe{% else %}no{% endif %}", {"a": 1, "b": 0, "d": 1}, "maybe"),
        ("{{ 'x' if n % 2 == 0 else 'y' }}", {"n": 3}, "y"),
        ("{% set t = n ~ '!' %}{{ t | upper }}{{ none_here | default('-') }}", {"n": "hi"}, "HI!-"),
        ("  {%- if 'a' in s and 'b' not in s -%}  in  {%- endif -%}  ", {"s": "cat"}, "in"),
        ("{# note #}{{ (s | trim | length) + 1 }}{{ s is none }}{{ s is not defined }}", {"s": " ab "}, "3FalseFalse"),
        ("{{ 'it\\'s' }}{{ \"q\\n\" }}", {}, "it'sq\n"),
    ],
)
def test_language(source, values, text):
    assert show(source, **values) == text


@pytest.mark.parametrize(
    "source",
    ["{{ x.__class__ }}", "{{ _x }}", "{{ x() }}", "{{ x | nothing }}", "{% while %}", "{% if a %}", "{% for a b %}{% endfor %}",
     "{{ 1 + }}", "{{ 'a' | upper ) }}", "{% endif %}", "{{ 1 + 'a' }}", "{{ x is odd }}", "{{ ? }}", "{% generation %}"],
)
def test_refused(source):
    with pytest.raises(T.TemplateError):
        T.compile_template(source)


def test_keys_with_underscores_are_refused_when_rendered():
    with pytest.raises(T.TemplateError):
        show("{{ x[k] }}", x={}, k="__class__")
    assert show("{{ x.real }}{{ x.upper }}", x="text") == ""


def test_constants_fold():
    tree = T.fold(T.parse("a{{ 'b' ~ 1 + 1 }}{% if 1 == 1 %}c{{ 'd' | upper }}{% else %}{{ x }}{% endif %}{{ 2 > 3 and x }}"))
    assert tree == ("body", (("text", "ab11cDFalse"),))
    assert T.fold(T.parse("{{ x if true else y }}")) == ("body", (("out", ("name", "x")),))


def test_generation_marks():
    parts = list(C.pieces([("user", "q"), ("assistant", "a"), ("assistant", "b")]))
    assert [p for p, learned in parts if learned] == ["a", "b"]
