"""Disguises of personal data on texts that repeat their words, where a rule that looks back too far would be square."""

import time

import pytest

from skyledger.llm import pii

REPEATED = [
    "a dot ", "a at ", " at ", "a@", "one ", "a at b dot ", " dot at dot", "at at dot ", "1 dot ", "plus ", "+1(", "[at] ", "1.1.1.", "é at а dot ", " point dot at one two", "one-", "one" + " " * 999, "x_", "a-@"
]


@pytest.mark.parametrize("piece", REPEATED)
def test_disguise_rules_are_linear(piece):
    text = piece * (1_000_000 // len(piece)) + " john at example dot com"
    began = time.process_time()
    pii.spans_of(text)
    assert time.process_time() - began < 15


def test_many_base_and_hidden_spans():
    text = "x@y.com " * 60_000 + "john [at] example.com"
    began = time.process_time()
    base, found = pii.spans_of(text)
    assert time.process_time() - began < 15
    assert len(base) == 60_000 and len(found) == 60_001 and found[-1] == ("email", 480_000, len(text))


@pytest.mark.parametrize(
    ("text", "span"),
    [
        ("mail john at example dot com now", "john at example dot com"),
        ("mail john dot smith at mail dot example.com", "john dot smith at mail dot example.com"),
        ("mail John At Example Dot Com.", "John At Example Dot Com"),
        ("write to anna at example.org please", "anna at example.org"),
        ("јоһn@example.com", "јоһn@example.com"),
        ("mail ρeter@ехample.com", "ρeter@ехample.com"),
        ("so a dot b@c.de", "a dot b@c.de"),
    ],
)
def test_said_addresses(text, span):
    at = text.index(span)
    assert ("email", at, at + len(span)) in pii.spans_of(text)[1]


@pytest.mark.parametrize("text", ["look at example.com", "we met at noon. dot", "x_y dot @a dot com", "at dot at dot", "he is at home dot", "is it at 5 dot 3"])
def test_ordinary_words_hide_nothing(text):
    assert [s for s in pii.spans_of(text)[1] if s[0] == "email" and "@" not in text] == []
