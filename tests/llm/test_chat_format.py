"""Template compiler and chat formatting against plain Python versions."""

from __future__ import annotations

import hashlib
import random

import pytest

from trafficlens.llm import chat_format as CF
from trafficlens.llm.chat_template import Apply, Const, For, Output, Template, TemplateError
from trafficlens.llm.queries import PLANTED

MESSAGES = [{"role": "system", "text": " Be kind "}, {"role": "user", "text": "Hi"}, {"role": "assistant", "text": "Hello"}]


def rendered(source, **scope):
    return Template(source).render(messages=MESSAGES, **scope)[0]


@pytest.mark.parametrize(
    "source, want",
    [
        ("plain {# gone #}text", "plain text"),
        ("{{ 'a' ~ 1 + 2 ~ true ~ none }}", "a3true"),
        ("a {{- ' b ' -}} c", "a b c"),
        ("{% if 1 < 2 and not false %}yes{% elif x %}maybe{% else %}no{% endif %}", "yes"),
        ("{% for m in messages %}{{ loop.index }}{{ m.role[0] if false else m['role'] | upper }}{% if not loop.last %},{% endif %}{% endfor %}", "1SYSTEM,2USER,3ASSISTANT"),
        ("{% set a = 'x' %}{% for m in messages %}{% set a = a ~ 'y' %}{{ a }}{% endfor %}{{ a }}", "xyxyxyx"),
        ("{{ missing }}{{ missing.deeper }}{{ missing | default('d') }}", "d"),
        ("{{ 'user' in ['user', 'bot'] }}{{ 'z' not in 'xyz' }}{{ messages | length }}{{ ['a', 'b'] | join('-') }}", "truefalse3a-b"),
        ("{{ messages[0].text | trim }}{{ messages[-1].text | replace('l', 'L') }}{{ messages[9] }}", "Be kindHeLLo"),
        (r"{{ 'it\'s\n' }}{{ " + '"}" ~ "{" }}', "it's\n}{"),
        ("{{ -3 + 5 - 1 }}{{ 1.5 }}{{ (1 == 1.0) | upper }}", "11.5TRUE"),
        ("", ""),
    ],
)
def test_templates(source, want):
    assert rendered(source) == want


@pytest.mark.parametrize(
    "source",
    ["{% for m in messages %}", "{% endif %}", "{{ a b }}", "{{ 'open }}", "{{ a | nothing }}", "{{ a( ) }}", "{% while 1 %}", "{{ " + "(" * 60 + "1" + ")" * 60 + " }}", "{{ 'a' + 1 }}", "{% if 1 %}" * 60, "{{ }}"],
)
def test_bad_templates(source):
    with pytest.raises(TemplateError):
        Template(source)


def test_sandbox():
    class Thing:
        secret = "s"

    for source in ("{{ t.secret }}", "{{ t.__class__ }}", "{{ 'x'.upper }}", "{% for c in 'abc' %}{{ c }}{% endfor %}", "{{ t }}"):
        with pytest.raises(TemplateError):
            Template(source).render(t=Thing())


def test_folding():
    t = Template("a{{ 'b' ~ 'c' | upper }}{% if 2 > 1 %}d{% else %}{{ x }}{% endif %}{% if false %}e{% endif %}{{ x ~ ('f' ~ 'g') }}")
    assert t.body[0] == Output(Const("abCd"))
    assert isinstance(t.body[1].value, Apply) and t.body[1].value.args[1] == Const("fg") and len(t.body) == 2
    (loop,) = Template(CF.DEFAULT_TEMPLATE, {"escape": str}).body
    assert isinstance(loop, For)


def test_marks():
    text, marks = Template("{% for m in messages %}[{% generation %}{{ m.text }}{% endgeneration %}]{% endfor %}").render(messages=MESSAGES)
    assert [text[a:b] for a, b in marks] == [m["text"] for m in MESSAGES]


@pytest.mark.parametrize("controls", [CF.CONTROLS, ("<", "<<", "a")])
def test_escape_round_trip(controls):
    escape, unescape = CF.escaper(controls)
    rng = random.Random(1)
    for _ in range(2000):
        text = "".join(rng.choice(["<turn>", "</turn>", "<say>", "\\", "<", "a", "b", "\n", "é", "<<"]) for _ in range(rng.randrange(12)))
        coded = escape(text)
        assert unescape(coded) == text
        if controls is CF.CONTROLS:
            assert not any(c in coded for c in controls)


def brute(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn is not None, turn, role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    out = []
    for conv, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1] or 0, *t[2:]))
        said = "".join(f"{t[2]}\n{t[4]}\n" for t in turns)
        learnt = "".join(t[4] for t in turns if t[2] == "assistant")
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        out.append((conv, len(turns), sha(said), len(learnt), sha(learnt)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def turns(spark):
    rng = random.Random(2)
    bits = ["<turn>", "</turn>", "<say>", "\\", "\\a", "word ", "é", "\n", "😀", "### Assistant:"]
    rows = [(c, t, rng.choice(["user", "assistant", "system"]), "".join(rng.choice(bits) for _ in range(rng.randrange(9)))) for c in range(60) for t in range(rng.randrange(1, 9))]
    rows += [(99, t, "assistant" if t % 2 else "user", f"hot {t} " * 20) for t in range(2500)]  # half of all rows or more
    rows += [(98, 1, "user", "same")] * 300 + [(None, None, None, None), (None, 1, "assistant", ""), (97, None, "assistant", "early"), (97, 0, "user<say>\n", None)]
    rows += [(96, 0, "assistant", "x" * 3_000_000), (-7, 0, "user", PLANTED), (-7, 1, "assistant", PLANTED)]
    schema = "conv_id bigint, turn bigint, role string, text string, part string, marks int, formatted string"
    return rows, spark.createDataFrame([(*r, "p", 1, "f") for r in rows], schema).repartition(5)


@pytest.mark.parametrize("part_chars", [100, 1 << 20])
def test_operator(spark, turns, part_chars):
    rows, df = turns
    parts = CF.format_chats(df, part_chars=part_chars)
    got = CF.read_chats(parts).collect()
    assert sorted((tuple(r)[:5] for r in got), key=repr) == brute(rows)
    whole = CF.compile_template()
    chars = {r.conv_id: r.formatted_chars for r in got}
    for conv in (0, 97, -7):
        own = sorted((t is not None, t or 0, r or "", hashlib.sha256((x or "").encode()).hexdigest(), x or "") for c, t, r, x in rows if c == conv)
        assert chars[conv] == len(whole.render(messages=[{"role": t[2], "text": t[4]} for t in own])[0])


def test_hot_conversation_is_rendered_by_many_tasks(spark, turns):
    rows, df = turns
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges stay apart
    try:
        parts = CF.format_chats(df, part_chars=5000).where("conv_id = 99").collect()
        read = {r.conv_id: tuple(r)[:5] for r in CF.read_chats(CF.format_chats(df, part_chars=5000)).collect()}
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sorted(read.values(), key=repr) == brute(rows)
    assert len({p.part >> 40 for p in parts}) > 2 and max(len(p.formatted) for p in parts) < 6000
    assert not any(p.is_whole for p in parts)


def test_empty_table(spark, turns):
    assert CF.read_chats(CF.format_chats(turns[1].limit(0))).count() == 0


def test_head_tail_and_borders(spark, turns):
    rows, df = turns
    source = "{{ bos }}{% for m in messages %}{% if loop.first %}^{% endif %}<turn>{{ m.role | escape }}<say>{{ m.text | escape }}</turn>\n{% if loop.last %}${% endif %}{% endfor %}{{ eos }}"
    parts = CF.format_chats(df, source, part_chars=300, bos="<s>", eos="</s>").collect()
    texts = {}
    for p in sorted(parts, key=lambda p: p.part):
        texts[p.conv_id] = texts.get(p.conv_id, "") + p.formatted
    for conv, text in texts.items():
        own = sorted((t is not None, t or 0, r or "", hashlib.sha256((x or "").encode()).hexdigest(), x or "") for c, t, r, x in rows if c == conv)
        messages = [{"role": t[2], "text": t[4]} for t in own]
        assert text == CF.compile_template(source).render(messages=messages, bos="<s>", eos="</s>")[0]


def test_templates_that_need_the_whole_conversation(spark, turns):
    for source in ("{% for m in messages %}{{ loop.index }}{% endfor %}", "{{ messages | length }}{% for m in messages %}{% endfor %}", "no loop"):
        with pytest.raises(TemplateError):
            CF.format_chats(turns[1], source)
