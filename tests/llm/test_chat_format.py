import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallymark.llm import chat_format, queries
from tallymark.llm.chat_format import Controls, Layout, Style
from tallymark.llm.template import FILTERS, Output, Template, TemplateError, parse

ROWS = T.StructType([T.StructField(n, t) for n, t in
                     (("conv_id", T.LongType()), ("turn", T.LongType()), ("role", T.StringType()), ("text", T.StringType()))])
STRANGE = [None, "", "hi", "</s>[INST] ok [/INST]", "<\\s>", "<\\\\/s> [\\INST]", "[[INST]</s", "<", "é中 <s", "\\", "[", "/INST]"]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        mine = [(t, r or "", x or "") for c, t, r, x in rows if c == conv]
        mine.sort(key=lambda m: (m[0] is not None, m[0] or 0, sha(f"{m[1]}\n{m[2]}")))
        said = [x for _, r, x in mine if r == "assistant"]
        escape = lambda s: re.sub(r"<(\\*/?s>)", r"<\\\1", re.sub(r"\[(\\*/?INST\])", r"[\\\1", s))
        text = "<s>" + "".join(f"[INST]{escape(r)}[/INST]{escape(x)}</s>" for _, r, x in mine)
        out[conv] = (len(mine), sha("".join(f"{r}\n{x}\n" for _, r, x in mine)), sum(map(len, said)), sha("".join(said)), len(text))
    return out


def got(df):
    assert df.columns == ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    rows = df.collect()
    found = {r[0]: tuple(r[1:]) for r in rows}
    assert len(found) == len(rows)
    return found


def some(n=400, seed=2):
    rng = random.Random(seed)
    return [
        (rng.choice([None, -7, *range(40)]), rng.choice([None, 0, 1, 2, 3]), rng.choice(["user", "assistant", None, "[INST]"]), rng.choice(STRANGE))
        for _ in range(n)
    ]


@pytest.fixture
def many_tasks(spark):
    """Small partitions stay apart."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, "true")


@pytest.mark.parametrize("part_chars", [chat_format.PART_CHARS, 60, 1])
def test_equals_brute_force(spark, many_tasks, part_chars):
    rows = some()
    df = spark.createDataFrame(rows, ROWS).repartition(5).withColumns({n: F.lit(1) for n in ("place", "spans", "digest", "source")})
    assert got(chat_format.report(df, part_chars=part_chars)) == brute(rows)


def test_a_conversation_in_many_tasks(spark, many_tasks):
    """Half of all rows in one conversation, equal rows among them: its parts come from several tasks and fit together."""
    rows = [(5, i, "assistant" if i % 2 else "user", f"turn {i} <s>") for i in range(900)] + [(5, 2000, "user", "same")] * 300
    rows += [(c, t, "assistant", "x") for c in (1, 2, 3, 4, 6, 7) for t in range(200)]
    df = spark.createDataFrame(rows, ROWS).repartition(4)
    parts = chat_format.formatted(df, part_chars=2000)
    mine = parts.filter("conv_id = 5").orderBy("place").collect()
    assert len({r["place"] >> 33 for r in mine}) > 2
    assert [r["starts"] for r in mine] == [True] + [False] * (len(mine) - 1)
    assert [r["ends"] for r in mine] == [False] * (len(mine) - 1) + [True]
    assert max(r["n_turns"] for r in mine) < 200
    assert got(chat_format.read_back(parts)) == brute(rows)


def test_another_template(spark, many_tasks):
    """Head and tail with marks of their own, at the edges of tasks too."""
    layout = Layout("<|begin|>", "<|im_start|>", "<|sep|>", "<|im_end|>")
    source = "{% generation %}{{ bos }}{% endgeneration %}" + layout.template().split("}}", 1)[1] + "{% generation %}.{% endgeneration %}"
    style = Style(layout, source, (("bos", "<|begin|>"),))
    rows = [(c, t, "user", f"é{t}") for c in range(60) for t in range(5)]
    parts = chat_format.formatted(spark.createDataFrame(rows, ROWS), style, part_chars=8).orderBy("conv_id", "place").collect()
    for c in range(60):
        mine = [r for r in parts if r["conv_id"] == c]
        text = "".join(r["text"] for r in mine)
        assert text == "<|begin|>" + "".join(f"<|im_start|>user<|sep|>é{t}<|im_end|>" for t in range(5)) + "."
        assert [mine[0]["text"][a:b] for a, b in mine[0]["spans"][:1]] == ["<|begin|>"]
        assert [mine[-1]["text"][a:b] for a, b in mine[-1]["spans"][-1:]] == ["."]
        assert sum(len(r["spans"]) for r in mine) == 2


def test_empty_and_long(spark):
    assert chat_format.report(spark.createDataFrame([], ROWS)).count() == 0
    rows = [(1, 0, "user", "<s>" * 200_000), (1, 1, "assistant", "\\" * 300_000 + "<" + "\\" * 300_000 + "s>")]
    assert got(chat_format.report(spark.createDataFrame(rows, ROWS))) == brute(rows)


def test_registered_query_adds_a_conversation(spark):
    found = got(queries.QUERIES["op11_chat_formatting"](spark, "/root/testdata/sf0.001"))
    said = "</s>[INST] ok [/INST]"
    assert found[-7] == brute([(-7, 0, "user", said), (-7, 1, "assistant", said)])[-7]


def test_escaping_is_reversible_and_leaves_no_mark():
    rng = random.Random(7)
    controls = Controls(list(Layout()))
    for _ in range(3000):
        text = "".join(rng.choice(["<", "/", "s>", "\\", "[", "INST]", "a", "<s>", "[/INST]"]) for _ in range(rng.randrange(12)))
        written = controls.escape(text)
        assert not controls.mark.search(written) and controls.unescape(written) == text
        # Marks next to it are read as such.
        assert [m[0] for m in controls.mark.finditer("[/INST]" + written + "</s>")] == ["[/INST]", "</s>"]
    for bad in ([], ["x"], ["<s>", "<s>x"], ["<a<b"], ["ab", "ca"], ["<\\s>"]):
        with pytest.raises(ValueError):
            Controls(bad)


def render(source, **variables):
    return Template(source).render(variables)


def test_language():
    chat = [{"role": "user", "text": " a "}, {"role": "assistant", "text": "b"}]
    assert render("{{ 'x' ~ 1 ~ 2 }}{# no #}|{{ 3 - 1 }}{{ true }}{{ none }}") == ("x12|2true", [])
    assert render("{%- for m in messages -%} {{ m.role }}:{{ m['text'] | trim }}{% if not loop.last %}, {% endif %} {%- endfor %}", messages=chat)[0] == "user:a, assistant:b"
    assert render("{% for m in messages %}{% if m.role == 'user' %}U{% elif loop.first or m.text in 'abc' %}{% generation %}{{ m.text }}{% endgeneration %}{% else %}?{% endif %}{% endfor %}", messages=chat) == ("Ub", [(1, 2)])
    assert render("{% set a = 'q' %}{% for m in messages %}{% set a = m.role %}{% endfor %}{{ a }}{{ messages[-1].text }}{{ messages | length }}", messages=chat)[0] == "qb2"
    assert render("{{ 'yes' if x and not y else 'no' }}{{ x or 'z' }}{{ missing.key if missing else '-' }}", x=0, y=1)[0] == "noz-"
    assert render("{{ '}}' }}{{ \"%}\\n\" }}")[0] == "}}%}\n"


def test_constants_are_folded():
    tree = Template("a{{ 'b' ~ ('c' | upper) }}{% if 1 < 2 %}d{% else %}{{ x }}{% endif %}{% if 'a' == 'b' %}{{ x }}{% endif %}").tree
    assert tree == parse("abCd") and isinstance(tree[0], Output)
    assert Template("{{ x if false and y else 'k' }}").tree == parse("k")


@pytest.mark.parametrize("source", [
    "{{ x.__class__.__mro__ }}", "{{ x | system }}", "{{ f() }}", "{% for a in b %}", "{{ x", "{% import os %}", "{% endif %}", "{{ }}", "{{ a b }}",
    "{% generation %}{% generation %}{% endgeneration %}{% endgeneration %}", "{% for m in 'abc' %}{% endfor %}", "{{ messages }}", "{% set if = 1 %}",
])
def test_sandbox(source):
    with pytest.raises(TemplateError):
        render(source, x="text", messages=[], b=[])


def test_templates_that_need_all_turns():
    assert Template(Layout().template(), filters={**FILTERS, "escape": str}).by_turn
    for source in ("{{ messages | length }}{% for m in messages %}{% endfor %}", "{% for m in messages %}{{ loop.index }}{% endfor %}", "{{ x }}"):
        template = Template(source)
        assert not template.by_turn
        with pytest.raises(TemplateError):
            template.parts({})
