"""The field on sentences it was not trained on: values of each kind at each place, and clean texts."""

import random

import pytest

from filmgrain.llm import pii

WORDS = ("the report that came back from our office was late again and nobody could say why so please call or write to him "
         "before noon if you need more help with this order we paid last week for two small boxes of green tea").split()
ENDINGS = ["", ",", ";", ":", ".", "!", "?", ")", '"', '".']


@pytest.fixture(scope="module")
def field(spark):
    return pii.fit(pii.labelled_table(spark))


def digits(rng, n):
    return "".join(rng.choice("0123456789") for _ in range(n))


def value(rng, kind):
    name = lambda: "".join(rng.choice("abcdefghiklmnoprstuw") for _ in range(rng.randint(3, 9)))
    if kind == "masked e-mail":
        at, dot = rng.choice([("[at]", "[dot]"), ("(at)", "(dot)")])
        return f"{name()}{at}{name()}{dot}{rng.choice(['com', 'org', 'net'])}"
    if kind == "masked IP":
        return rng.choice(["[.]", "(.)"]).join(str(rng.randint(0, 255)) for _ in range(4))
    if kind == "dotted card":
        body = "4" + digits(rng, 14)
        body += next(d for d in "0123456789" if pii.luhn(body + d))
        return ".".join(body[i:i + 4] for i in range(0, 16, 4))
    a, b, c = digits(rng, 3), digits(rng, 3), digits(rng, 4)
    return rng.choice([f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}"])


def sentence(rng, value_, ending):
    some = lambda n: " ".join(rng.choice(WORDS) for _ in range(n))
    opening = {")": "(", '"': '"', '".': '"'}.get(ending, "")
    closed = ending in (".", "!", "?", '".') or rng.random() < 0.3
    tail = ("" if ending[-1:] in (".", "!", "?") else ".") + " " + some(4) if closed else " " + some(4)
    before = some(rng.randint(2, 8)) + " "
    text = before + opening + value_ + ending + tail
    return text, len(before) + len(opening)


@pytest.mark.parametrize("kind", ["local phone", "masked e-mail", "masked IP", "dotted card"])
def test_recall_by_kind_and_ending(field, kind):
    rng = random.Random(kind)
    for ending in ENDINGS:
        found = 0
        for _ in range(200):
            v = value(rng, kind)
            text, at = sentence(rng, v, ending)
            spans = pii.find_all([text], field)[0]
            found += any(a <= at and at + len(v) <= b for _, a, b, _ in spans)
        assert found >= 0.95 * 200, (kind, ending, found)


def test_clean_texts_are_left_alone(field):
    rng = random.Random(9)
    odd = ["12", "3.5", "2024-05-17", "17.05.2024", "$1,200.50", "#48213", "12:30", "4821", "10/12", "45%", "(7)", "1999-2004", "v1.2.3", "3-4", "call:"]
    touched = 0
    for _ in range(2000):
        words = [rng.choice(odd) + rng.choice(["", ",", "."]) if rng.random() < 0.1 else rng.choice(WORDS) for _ in range(rng.randint(5, 60))]
        touched += bool(pii.find_all([" ".join(words) + "."], field)[0])
    assert touched <= 0.01 * 2000, touched
