import hashlib
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from tallymark.llm import pii


def brute(text):
    """The base findings by the plain patterns."""
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 16 <= len(digits) <= 19 and pii.luhn(digits):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_base_equals_plain_patterns():
    rng = random.Random(1)
    pool = ["@", "a", "b.c", "-", "+", " ", "1", "25", "255", "256", ".", "(", ")", "4111111111111111", "\n", "é", "@a.b", "0", "%"]
    for _ in range(20_000):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(0, 30)))
        assert [tuple(s) for s in pii.find(text)[0]] == brute(text), text
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112")


@pytest.mark.parametrize(
    ("text", "kind", "part"),
    [
        ("write to jane.doe (at) mail (dot) example (dot) com today", "email", "jane.doe (at) mail (dot) example (dot) com"),
        ("write to jane at example dot com, please", "email", "jane at example dot com"),
        ("jane[at]example.org!", "email", "jane[at]example.org"),
        ("x jаne＠exаmple．com y", "email", "jаne＠exаmple．com"),
        ("j​ane@exam​ple.com", "email", "j​ane@exam​ple.com"),
        ("call plus one four one five five five five two six seven one now", "phone", "plus one four one five five five five two six seven one"),
        ("call +４１５ 555 26711", "phone", "+４１５ 555 26711"),
        ("card four one one one 1111 1111 1111 ok", "card", "four one one one 1111 1111 1111"),
        ("host one nine two dot one six eight dot zero dot one.", "ip", "one nine two dot one six eight dot zero dot one"),
        ("mail jane.35 at mail4.example.com soon", "email", "jane.35 at mail4.example.com"),
        ("mail 𝐣𝐚𝐧𝐞@example．com soon", "email", "𝐣𝐚𝐧𝐞@example．com"),
        ("JANE AT EXAMPLE DOT COM", "email", "JANE AT EXAMPLE DOT COM"),
        ("ring +1 four one five 555 2671 now", "phone", "+1 four one five 555 2671"),
        ("①⑨②.168.0.1 is up", "ip", "①⑨②.168.0.1"),
        ("card 4111 1111 1111 1l11 ok", "card", "4111 1111 1111 1l11"),
        ("vier eins eins eins 1111 1111 1111", "card", "vier eins eins eins 1111 1111 1111"),
    ],
)
def test_disguises(text, kind, part):
    plain, added = pii.find(text)
    start = text.index(part)
    assert pii.Span(kind, start, start + len(part)) in added
    assert all(s in plain for s in pii.detect(text))


def test_prose_is_left_alone():
    for text in (
        "Look at example.com for one or two dots. We met at noon, plus one friend.",
        "We looked at example.com and stayed at home. In 2020 at example.org they met; see p.5 at the end.",
        "one two three four five six seven eight nine zero",
        "the dot at the end dot",
        "Привет, как дела? 12 мая 2020 года. 1.2.3 и 10-20",
    ):
        assert pii.find(text) == ([], [])


def test_long_texts_are_linear():
    for text in ("9" * 400_000, "a" * 400_000 + "@", "+1" + " " * 300_000, "1." * 200_000, "one " * 60_000, "(" * 200_000, "a@" * 100_000):
        pii.find(text)


def test_report_and_redact(spark, documents):
    df = documents((1, "é a@b.cd jane at example dot com"), (2, None), (3, ""), (None, "10.0.0.1 +1 415 555 2671"), (3, ""))
    rows = {r["doc_id"]: r for r in pii.report(df).collect()}
    assert rows[1]["spans"] == "email:2:8,email:9:32" and rows[1]["n_email"] == 1 and rows[1]["n_added"] == 1
    assert rows[1]["base_sha256"] == hashlib.sha256(b"email:2:8").hexdigest()
    assert rows[None]["spans"] == "ip:0:8,phone:9:24"
    assert rows[2]["spans"] == "" and rows[2]["base_sha256"] == hashlib.sha256(b"").hexdigest()
    clean = pii.redact(df.withColumn("spans", F.lit("kept")))
    assert clean.columns[-1] == "spans" and clean.count() == 5
    assert {r["text"] for r in clean.collect()} == {"é [EMAIL] [EMAIL]", None, "", "[IP] [PHONE]"}
    assert pii.report(documents()).count() == 0 and pii.redact(documents()).count() == 0


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("+1 4 one 5 5 five 5 0 one 2 3", "phone"),
        ("+1 8OO 555 O199", "phone"),
        ("+1 8OO 555 019O", "phone"),
        ("4111 1111 1111 1ll1", "card"),
        ("4OO0 0000 0000 OOO2", "card"),
        ("one.two.three.four", "ip"),
        ("+4    one    5 555 2671", "phone"),
    ],
)
def test_single_spelled_digits_and_runs_of_look_alikes(text, kind):
    """Nothing else in the text hints at a disguise."""
    assert pii.find(text) == ([], [pii.Span(kind, 0, len(text))])
    for long in ("9l" * 200_000 + "x", "O" * 400_000, "one" + " " * 400_000, "1" + "(" * 400_000, "+" * 400_000):
        pii.find(long)


def test_a_run_of_digit_words_before_a_longer_word():
    number = "+1 four one five five five five one two three seven"
    for end in (" now", " onerous", " sevenths", " one-off onex"):
        found = pii.find(f"call {number}{end}")[1]
        assert [(s.kind, s.start) for s in found] == [("phone", 5)] and found[0].end >= 5 + len(number), end


def test_a_megabyte_takes_seconds():
    """Runs that end in a longer word, and many findings of both kinds, in time that grows with the text alone."""
    texts = ["one " * 250_000 + "onex", "a.b@cd.ef " * 100_000 + "x (at) example (dot) com", "five one-" * 110_000 + "oneself", "1 one " * 160_000 + "onex"]
    texts += ["x at y9 dot com " * 60_000, "8OO " * 250_000 + "l", "jane9 at example.com " * 50_000]
    for text in texts:
        start = time.process_time()
        pii.find(text)
        assert time.process_time() - start < 20, text[:20]


def test_added_findings_next_to_plain_ones():
    text = "a@b.cd, e@f.gh and x (at) y.zz, i@j.kl"
    plain, added = pii.find(text)
    assert len(plain) == 3 and [text[s.start : s.end] for s in added] == ["x (at) y.zz"]


def test_hints_equal_one_pattern():
    """The quick look at words finds what a search for all disguises at once finds."""
    d, gap, at, dot = pii._DIGIT, pii._GAP, pii.AT_WORDS, pii.DOT_WORDS
    whole = re.compile(
        rf"[\[({{<]{gap}(?:{at}|{dot}|@|\.){gap}[\])}}>]|[ \t](?:{dot})[ \t]|[ \t](?:{at})[ \t]{{1,3}}{pii._LABEL}\.[A-Za-z0-9]"
        rf"|\b{d}[ -]{d}\b|[0-9][OoIl]|[OoIl][0-9]|\bplus[ \t-]{{1,2}}(?:{d}\b|[0-9])"
        rf"|[0-9+][ ().-]*+\b{d}\b|\b{d}\b[ ().-]*+(?:[0-9+]|{d}\b)",
        re.I,
    )
    rng = random.Random(11)
    pool = ["one", "Two", "six", "onex", "vier", "oh", "un", " ", " ", "  ", "-", "+", "(", ")", "[", "]", ".", "1", "9", "O", "l", "I", "L", "at",
            "AT", "dot", "Punto", "plus", "@", "a.b", "x", "é", "\t", "_", "İ", ",", "\n"]
    for _ in range(60_000):
        text = "".join(rng.choice(pool) for _ in range(rng.randrange(0, 9)))
        assert pii.hinted(text) == bool(whole.search(text)), text
