"""Spans of url logins, mailto addresses and IBANs."""

import pytest

from strata.llm import pii

CUES = pii.automaton()


def cut(text, kind):
    return [text[s:e] for s, e in pii.spans(text, CUES)[kind]]


@pytest.mark.parametrize(("text", "user", "secret"), [
    ("see postgres://bob:s3cr@t@db/x@y now", ["bob"], ["s3cr@t"]), ("ftp://anna@host.org/", ["anna"], []),
    ("redis://:pw@h", [], ["pw"]), ("http://host/a:b@c", [], []), ("http://a@ b", [], []), ("://", [], [])])
def test_logins_in_urls(text, user, secret):
    assert (cut(text, "account"), cut(text, "secret")) == (user, secret)


def test_mailto():
    assert cut("<mailto:me%40host.org?x> mailto:root@local, mailto:a@b.org,k%40l.de", "contact") == [
        "me%40host.org", "root@local", "k%40l.de"]


@pytest.mark.parametrize("code", ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB29 NWBK 6016 1331 9268 19",
                                  "MT84 MALT 0110 0001 2345 MTLC AST0 01S", "LC55 HEMM 0001 0001 0012 0012 0002 3015"])
def test_ibans(code):
    for text in (f"x {code} to pay", f"IBAN: {code}", f"iban {code} and 12", f"{code}, {code}"):
        assert set(cut(text, "account")) == {code}
    assert cut(f"X{code} " + code[:-1] + "x", "account") == []
    assert cut("iban " + code.lower(), "account") == [code.lower()]


def test_long_iban_of_unlisted_country():
    body = "7" * 30
    check = 98 - int("".join(str(int(c, 36)) for c in body + "ZZ00")) % 97
    code = f"ZZ{check:02d}{body}"
    grouped = " ".join(code[k:k + 4] for k in range(0, 34, 4))
    assert len(grouped) == 42 and cut(f"iban {grouped}.", "account") == [grouped]
