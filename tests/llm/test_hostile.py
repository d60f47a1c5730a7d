"""Long and hostile texts end in good time, and odd rows have their stated results."""

import time

import pytest

from strata.llm import html, pii

MEGABYTE = 1_000_000
PAGES = ["<a ", "<a '\">", '<a ">"', "<div>", "<script></script>", "x<b>y</b> ", "<p><table><td><div>", "<", "<!", "<p>",
         "</p>", "<ul><li>", "a<", "<table><tr><td>x", "<dl><dd>", "<td>", "<a b='", "<select><option>x"]
TEXTS = ["secret=", "mailto:", "a://", "a@", "+1", "1", "1 ", "1.", "GB29 NWBK ", "a(at)", "account number: ", " (", "a@b,",
         "password: \"", "api key=token: ", "://u:p@"]


@pytest.mark.parametrize("piece", PAGES)
def test_pages_take_linear_time(piece):
    began = time.thread_time()
    html.render(html.build(piece * (MEGABYTE // len(piece)) + "<?"))
    assert time.thread_time() - began < 15


@pytest.mark.parametrize("piece", TEXTS)
def test_texts_take_linear_time(piece):
    began = time.thread_time()
    pii.spans("mailto:+1 " + piece * (MEGABYTE // len(piece)), pii.automaton())
    assert time.thread_time() - began < 15


def test_visible_text():
    show = lambda page: html.render(html.build(page))
    assert show('<p aria-hidden="true">icon</p>') == "icon"
    assert show('<div style="visibility:hidden">no<b style="visibility: visible">yes</b>no</div>') == "yes"
    assert show('<div style="display:none">no<b style="visibility: visible">no</b></div>x') == "x"
    wide = show("<table><tr><td colspan=150>a<td>b<tr>" + "<td>c" * 151).split("\n")
    assert wide[0].index("b") == 450 == wide[1].rindex("c")
    assert show('<a title="x>y</a> z') == "y z"
    assert show("1 < 2 <b>and</b> 3 > 2") == "1 < 2 and 3 > 2"


@pytest.mark.parametrize(("text", "kind"), [
    ("Account Number: 123456789", "account"), ("API key: abc12345678", "secret"), ("API_Key = abc123456789", "secret"),
    ("pAsSwOrD=abc12345", "secret"), ("me (AT) host.org", "contact"), ('secret=token="abc12345"', "secret")])
def test_cues_in_any_case(text, kind):
    assert pii.spans(text, pii.automaton())[kind]


def test_added_kinds_against_a_plain_search():
    import random
    import re
    rng = random.Random(3)
    cues = pii.automaton()
    words = ["secret", "=", ":", " ", "abc12345", "x" * 9, "token", '"', "\n", "7" * 8, ", "]
    for _ in range(3000):
        text = "".join(rng.choice(words) for _ in range(rng.randint(1, 14)))
        expected, past = [], 0
        for m in re.finditer("(?=(secret|token))", text):
            found = re.compile("[ \"']*[=:][ \"']*([A-Za-z0-9_+/.=~!@#$%^&*-]{8,})").match(text, m.start() + len(m[1]))
            if found and re.search("[0-9]", found[1]) and found.start(1) >= past:
                expected.append(found.span(1))
                past = found.end(1)
        assert pii.spans(text, cues)["secret"] == expected, text
