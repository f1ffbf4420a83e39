import hashlib
import random
from collections import defaultdict

import pytest

from lectern.llm import chat
from lectern.llm.queries import QUERIES
from lectern.llm.template import Choice, Text, TemplateError, compile_template, fold, parse

FOLDER = "/root/testdata/sf0.01"


def rendered(source, **values):
    return "".join(t for t, _ in compile_template(source, {"escape": chat.escape})(values))


@pytest.mark.parametrize("source, want", [
    ("a{{ 1 + 2 }}b", "a3b"), ("{{ 'x' ~ 1 ~ none }}", "x1"), ("{# no #}{{ m['k'] }}{{ m.none }}", "v"),
    ("{% if n > 2 and not false %}big{% elif n == 2 %}two{% else %}small{% endif %}", "two"),
    ("{% for x in xs %}{{ loop.index }}{{ x | upper }}{% if not loop.last %}, {% endif %}{% endfor %}", "1A, 2B"),
    ("x  {%- if true -%}  y  {%- endif -%}  z", "xyz"), ("{{ 'a\\n\\'b' }}", "a\n'b"), ("{% set y = n + 1 %}{{ y }}", "3"),
    ("{{ 'b' in 'abc' }}{{ 'b' not in 'abc' }}", "TrueFalse"), ("{{ (n or 5) | trim }}", "2"), ("", ""),
])
def test_language(source, want):
    assert rendered(source, n=2, m={"k": "v"}, xs=["a", "b"]) == want


@pytest.mark.parametrize("source", [
    "{{ x.__class__ }}", "{{ x() }}", "{{ open }}", "{{ x | eval }}", "{% for a in 'abc' %}{% endfor %}", "{% if x %}",
    "{% endif %}", "{% else %}", "{{ 1 + }}", "{{ 'a' + 1 }}", "{% import x %}", "{{ x ** 9 }}", "{% for a in x %}{% endif %}",
])
def test_sandbox(source):
    with pytest.raises(TemplateError):
        rendered(source, x="text")


def test_folding():
    from lectern.llm.template import FILTERS

    nodes = fold(parse("a{{ 'b' ~ 1 }}{% if 1 == 2 %}never{% elif true %}c{% else %}{{ x }}{% endif %}d"), FILTERS)
    assert nodes == [Text("ab1cd")]
    assert isinstance(fold(parse("{% if x %}a{% endif %}"), FILTERS)[0], Choice)


def test_generation_fragments():
    f = compile_template("a{% generation %}b{{ x }}{% endgeneration %}c")
    assert list(f({"x": "!"})) == [("a", False), ("b", True), ("!", True), ("c", False)]


def test_escape_is_reversible():
    rng = random.Random(1)
    parts = ["[", "\\", "/", "INST]", "s>", "<", "<SYS>>", "</SYS>>", "[INST]", "</s>", "<<TURN>>", "a", "<</ROLE>>", "<s>"]
    for _ in range(5000):
        text = "".join(rng.choices(parts, k=rng.randint(0, 12)))
        out = chat.escape(text)
        assert chat.unescape(out) == text and not any(
            c in out for c in ("[INST]", "[/INST]", "<s>", "</s>", "<<SYS>>", "<</SYS>>", "<<TURN>>", "<</TURN>>", "<</ROLE>>"))


def expected(rows):
    groups = defaultdict(list)
    for conv, turn, role, text in rows:
        groups[conv].append((turn is not None, turn or 0, role is not None, role or "", text is not None, text or ""))
    out = {}
    for conv, turns in groups.items():
        turns = [(t[3], t[5]) for t in sorted(turns)]
        loss = "".join(t for r, t in turns if r == "assistant")
        out[conv] = (len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(loss),
                     hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_query(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{FOLDER}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    text = "</s>[INST] ok [/INST]"
    want = expected(rows + [(-1, 0, "user", text), (-1, 1, "assistant", text)])
    got = {r.conv_id: r for r in QUERIES["op1_chat"](spark, FOLDER).collect()}
    assert {k: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for k, r in got.items()} == want
    assert got[-1].formatted_chars == len("[INST][/INST]<s></s>") + 2 * (len(text) + 3)


def test_odd_and_long_conversations(spark, monkeypatch):
    rows = [(1, 0, None, None), (1, 1, "tool", "<<TURN>>\\"), (1, 1, "tool", "<<TURN>>\\"), (None, None, "user", "x"), (None, 2, "assistant", ""),
            (2, 5, "assistant", "é😀" * 50_000), (2, 4, "system", "<\\<SYS>>"), (3, 0, "<</ROLE>>", "</s>")]
    rows += [(4, i, ["user", "assistant"][i % 2], "[INST] " * (i % 400)) for i in range(3000)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    pieces = chat.format_conversations(df, "conv_id", "turn", "role", "text")
    assert pieces.filter("conversation = 4").count() > 10
    got = {r.conversation: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digests(pieces).collect()}
    assert got == expected(rows)
    assert chat.digests(chat.format_conversations(df.limit(0), "conv_id", "turn", "role", "text")).count() == 0
