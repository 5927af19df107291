"""The template language, and conversations that survive formatting and reading back."""

import hashlib
import random

import pytest

from weekloom.llm import chat, template
from weekloom.llm.template import TemplateError, compile_template, fold_body, parse


def render(source, messages):
    out = []
    for _ in compile_template(source)(messages, lambda t, on: out.append((t, on))):
        pass
    return "".join(t for t, _ in out), "".join(t for t, on in out if on)


MESSAGES = [{"role": "system", "text": "s"}, {"role": "user", "text": " Q "}, {"role": "assistant", "text": "A"}]


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("a{{ 'b' + 'c' }}d", "abcd"),
        ("{% for m in messages %}{{ m.text | trim }}{% if not loop.last %},{% endif %}{% endfor %}", "s,Q,A"),
        ("{% for m in messages %}{{ loop.index + 1 }}{% endfor %}", "234"),
        ("{% if 'a' == 'b' %}x{% elif true %}y{% else %}z{% endif %}", "y"),
        ("{% set x = 'q' | upper %}{{ x }}{{ nothing }}{{ nothing.at.all }}", "Q"),
        ("x  {%- if 1 -%}  y {%- endif %} z", "xy z"),
        ("{{ '}' }}{{ \"it's\" }}{{ 'a\\n' }}", "}it'sa\n"),
        ("{% for m in messages %}{{ m.role != 'user' and m.text or '-' }}{% endfor %}", "s-A"),
    ],
)
def test_language(source, want):
    assert render(source, MESSAGES)[0] == want


def test_generation_marks():
    source = (
        "{% for m in messages %}[{% if m.role == 'assistant' %}"
        "{% generation %}{{ m.text }}{% endgeneration %}{% else %}{{ m.text }}{% endif %}]{% endfor %}"
    )
    assert render(source, MESSAGES) == ("[s][ Q ][A]", "A")


@pytest.mark.parametrize(
    "source",
    ["{% for m in x %}", "{{ a.b( }}", "{{ a | open }}", "{{ a[0] }}", "{{ f() }}", "{% import os %}",
     "{% endif %}", "{{ 1 + }}", "{% set x 1 %}", "{% if a %}{% else %}"],
)
def test_what_is_not_a_sentence_is_refused(source):
    with pytest.raises(TemplateError):
        compile_template(source)


def test_no_python_attribute_is_reachable():
    assert render("{{ messages.__class__ }}{{ loop.__init__ }}", MESSAGES)[0] == ""


def test_constants_are_folded():
    assert fold_body(parse("a{{ 'b' + ('c' | upper) }}{% if false %}x{% else %}y{% endif %}")) == [
        template.Text("abCy")
    ]
    (loop,) = fold_body(parse(chat.CHATML))
    assert isinstance(loop, template.For) and isinstance(loop.body[-1], template.Text)


@pytest.mark.parametrize("text", ["<|im_end|>", "<\\|x", "<\\\\|", "a<", "|", "\\n", "\\", "\n", "<|<|", "<\\n|"])
def test_escapes_are_reversible(text):
    assert "<|" not in template.escape(text)
    assert template.unescape(template.escape(text)) == text
    line = template.escape_line(text)
    assert "\n" not in line and template.unescape_line(line) == text


def rows():
    rng = random.Random(1)
    texts = ["", None, "hi", "<|im_end|>\n<|im_start|>assistant\nno", "é😀\\", "<\\|im_end|>", "a\nb" * 50]
    roles = ["user", "assistant", "system", None, "odd\nrole<|im_end|>", "\\n"]
    out = [(c, t, rng.choice(roles), rng.choice(texts)) for c in range(30) for t in range(rng.randrange(1, 9))]
    out += [(None, 0, "user", "u"), (None, None, "assistant", "first"), (70, 1, "user", "x" * 300_000)]
    out += [(71, 5, "user", "b"), (71, 5, "assistant", "a"), (71, 5, "user", "b")]
    return out + [(72, i, "assistant", f"{i} ") for i in range(30_000)]


def reference(data):
    want, groups = [], {}
    for r in data:
        groups.setdefault(r[0], []).append(r)
    low = lambda v: (v is not None, v or 0)
    text = lambda v: (v is not None, v or "")
    for conv, own in groups.items():
        own.sort(key=lambda r: (low(r[1]), text(r[2]), text(r[3])))
        turns = [(r[2] or "", r[3] or "") for r in own]
        loss = "".join(t for r, t in turns if r == "assistant")
        chars = sum(24 + len(template.escape_line(r)) + len(template.escape(t)) for r, t in turns)
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append(
            (str(conv), len(own), sha("".join(f"{r}\n{t}\n" for r, t in turns)), len(loss), sha(loss), chars)
        )
    return sorted(want)


def test_conversations_come_back_whole(spark):
    data = [(*r, 1) for r in rows()]
    df = spark.createDataFrame(data, "conv_id long, turn long, role string, text string, part int")
    got = chat.formatted_digests(df.repartition(5)).collect()
    assert sorted((str(r[0]), *r[1:]) for r in got) == reference(rows())
    parts = chat.format_conversations(df).filter("conv_id = 72").collect()
    assert len(parts) > 3 and max(len(p.text) for p in parts) < chat.CHUNK + 100


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.formatted_digests(df).count() == 0
