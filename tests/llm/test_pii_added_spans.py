"""Spans that the field adds: precision and recall on lines that it has not seen, and what may stand."""

import random

import pytest

from paylake.llm import pii_crf

CARD, PHONE, IP, EMAIL = 2, 3, 1, 0


def number(rng, n):
    return "".join(rng.choice("0123456789") for _ in range(n))


def card(rng):
    head = "4" + number(rng, 14)
    return head + next(c for c in "0123456789" if pii_crf.luhn(head + c))


def groups(digits, sign):
    return sign.join(digits[i:i + 4] for i in range(0, 16, 4))


def variants(rng):
    """(line, kind or None for a decoy) from wordings of this test alone."""
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(rng.randint(3, 8)))
    part = lambda: str(rng.randrange(256))
    return [
        (f"please answer {word()} (at) {word()} (dot) com today", EMAIL),
        (f"write me: {word()} [at] {word()}.org", EMAIL),
        (f"server {part()} . {part()} . {part()} . {part()} was slow", IP),
        (f"we saw {part()}[.]{part()}[.]{part()}[.]{part()} there", IP),
        (f"charge {groups(card(rng), '.')} now", CARD),
        (f"my card {groups(card(rng), '/')} expired", CARD),
        (f"phone 0{number(rng, 2)}-{number(rng, 7)} for help", PHONE),
        (f"call (0{number(rng, 2)}) {number(rng, 3)} {number(rng, 4)} please", PHONE),
        (f"tel 0{number(rng, 3)} {number(rng, 3)} {number(rng, 2)} {number(rng, 2)}", PHONE),
        (f"invoice {number(rng, 7)} of 2023-0{rng.randint(1, 9)}-1{rng.randint(0, 9)}", None),
        (f"release {rng.randint(1, 9)}.{rng.randint(0, 9)}.{rng.randint(0, 9)} came with {rng.randint(10, 99)} fixes", None),
        (f"in {rng.randint(1900, 2024)} and {rng.randint(1900, 2024)} there were {rng.randint(100, 999)} of them", None),
        (f"{word()} looked at {word()} and at the dot", None),
        (f"price {rng.randint(1, 99)}.{rng.randint(10, 99)} for {rng.randint(2, 9)} at {rng.randint(1, 12)}:30", None),
        (f"{word()} {word()} {word()} page {rng.randint(1, 400)}", None),
    ]


def test_recall_and_precision_of_added_spans(spark):
    rng = random.Random(77)
    lines = [v for _ in range(40) for v in variants(rng)]
    plain = [(10_000 + i, "The year 2021 had 365 days, and 12 months.") for i in range(50)]
    docs = spark.createDataFrame([(i, line) for i, (line, _) in enumerate(lines)] + plain, "doc_id bigint, text string")
    crf = pii_crf.fit(docs.where("doc_id >= 10000"))
    texts = [line for line, _ in lines]
    found = pii_crf.crf_spans(crf, pii_crf.Words(texts), len(texts))
    hit = added = 0
    for (text, kind), more in zip(lines, found):
        spans = pii_crf._merge(text, pii_crf.base_spans(text), more)
        base = set(pii_crf.base_spans(text))
        own = [s for s in spans if s not in base]
        added += len(own)
        hit += kind is not None and any(k == kind for _, k, _ in spans)
        for s, k, e in own:
            assert pii_crf.reads_as(k, text[s:e])
    wanted = sum(kind is not None for _, kind in lines)
    right = sum(any(k == kind for _, k, _ in pii_crf._merge(t, [], more)) for (t, kind), more in zip(lines, found) if kind is not None)
    print(f"recall {hit / wanted:.3f}, precision {right / max(1, added):.3f} of {added}")
    assert hit >= 0.8 * wanted and right >= 0.9 * added


@pytest.mark.parametrize("kind,text,good", [
    (CARD, "4111.1111.1111.1111", True), (CARD, "2531585014589253", False), (CARD, "4111 1111", False),
    (PHONE, "030-1234567", True), (PHONE, "2024-01-05", False), (PHONE, "(030) 123 4567", True), (PHONE, "12345", False),
    (PHONE, "030 12a34567", False), (IP, "10 . 0 . 0 . 1", True), (IP, "10 . 0 . 0 . 300", False), (IP, "10 . 0 . 0", False),
    (EMAIL, "a.b (at) c (dot) de", True), (EMAIL, "at home dot", False), (EMAIL, "x [at] y.com", True)])
def test_what_may_stand(kind, text, good):
    assert pii_crf.reads_as(kind, text) is good


def test_neighbouring_cards_are_cut_apart():
    rng = random.Random(1)
    a, b = groups(card(rng), "."), groups(card(rng), ".")
    text = f"{a} {b} 1234"
    assert pii_crf._merge(text, [], [(0, CARD, len(text))]) == [(0, CARD, len(a)), (len(a) + 1, CARD, len(a) + 1 + len(b))]
    assert pii_crf._merge("2531585014589253", [], [(0, CARD, 16)]) == []


def test_table_spans_read_as_their_kind():
    lines, spans = pii_crf.table_lines()
    for line, found in zip(lines, spans):
        for s, k, e in found:
            assert pii_crf.reads_as(k, line[s:e]), line
    assert sum(not f for f in spans) > len(spans) / 3
