import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tamiz.llm import pii

PLAIN = (
    (re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"), lambda t: True),
    (re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"), lambda t: all(int(p) <= 255 for p in t.split("."))),
    (re.compile(r"[0-9]([\x20-]?[0-9])+"), pii.is_card),
    (re.compile(r"\+[0-9][\x20().0-9-]+[0-9]"), pii.is_phone),
)


def plain_spans(text):
    found = [(m.start(), m.end(), k) for k, (pattern, good) in enumerate(PLAIN) for m in pattern.finditer(text) if good(m[0])]
    return sorted(found, key=lambda s: (s[0], s[2]))


def test_patterns_as_written():
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice("a1.@+- ()7%é") for _ in range(rng.randrange(30)))
        assert pii.base_spans(text) == plain_spans(text), text
    text = "call +1 (345) 555-0199, 4111 1111 1111 1111 or x.y@z.com; 1.2.3.4.5.6.7.8 999.1.1.1"
    assert [pii.KINDS[k] for *_, k in pii.base_spans(text)] == ["phone", "card", "email", "ip", "ip"]


def test_linear_on_long_runs():
    for text in ("1" * 200_000, "a" * 200_000 + "@", "1." * 100_000, "+1" + " " * 200_000, "@" * 100_000, "a@b" * 60_000):
        pii.base_spans(text)


def test_luhn():
    assert pii.luhn("4111111111111111") and not pii.luhn("4111111111111112") and pii.luhn("79927398713")


def number(rng, digits):
    return "".join(rng.choice("0123456789") for _ in range(digits))


def card(rng):
    body = "4" + number(rng, 14)
    return next(body + c for c in "0123456789" if pii.luhn(body + c))


def made(seed, n):
    """Texts with personal data, some of it end to end, and where it is."""
    rng = random.Random(seed)
    kinds = (
        lambda: f"{rng.choice(['ann', 'bo.li', 'kim'])}.{number(rng, 2)}@mail{rng.randrange(9)}.example.com",
        lambda: ".".join(str(rng.randrange(1, 255)) for _ in range(4)),
        lambda: card(rng),
        lambda: f"+1 ({number(rng, 3)}) 555-{number(rng, 4)}",
    )
    words = lambda: " ".join(rng.choice(["river", "the", "Stone.", "and,", "token=9f8e7d6a5b"]) for _ in range(rng.randrange(3, 25)))
    rows = []
    for i in range(n):
        text, spans = words() + " ", []
        for k in rng.sample(range(4), rng.randrange(1, 4)) if i % 3 else [3, 2]:
            item = kinds[k]()
            spans.append((len(text), len(text) + len(item), k))
            text += item + " " + (words() + " " if rng.random() < 0.5 and i % 3 else "")
        rows.append((text + words(), spans))
    return rows


@pytest.fixture(scope="module")
def model(spark):
    docs = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(made(1, 900))], "doc_id long, text string")
    return pii.fit_tagger(docs, windows=1500, steps=200)


def test_tagger_adds_what_patterns_merge(model):
    rows = made(2, 300)
    found = pii.all_spans(model, [t for t, _ in rows])
    want = {(i, s) for i, (_, spans) in enumerate(rows) for s in spans}
    base = {(i, s) for i, (b, _) in enumerate(found) for s in b}
    every = base | {(i, s) for i, (_, a) in enumerate(found) for s in a}
    missed = want - base
    assert len(missed) > 50
    assert len(missed & every) >= 0.9 * len(missed)
    assert len(every - base - want) <= 0.02 * len(want)


def test_gradient():
    rng = np.random.default_rng(0)
    model = pii.Tagger(width=5)
    x, y = rng.integers(0, pii.SYMBOLS, (3, 11)), rng.integers(0, pii.LABELS, (3, 11))
    _, g = model._gradient(x, y)
    for name, w in model.w.items():
        for at in rng.integers(0, w.size, 6).tolist() + [int(np.abs(g[name]).argmax())]:
            at = np.unravel_index(at, w.shape)
            old, losses = w[at], []
            for step in (1e-5, -1e-5):
                w[at] = old + step
                losses.append(model._gradient(x, y)[0])
            w[at] = old
            assert abs((losses[0] - losses[1]) / 2e-5 - g[name][at]) < 1e-5


def test_decoding_against_all_sequences():
    rng = np.random.default_rng(1)
    model = pii.Tagger(width=3)
    model.w["move"] = rng.normal(size=model.w["move"].shape)
    scores = rng.normal(size=(2, 4, pii.LABELS))
    lengths = np.array([4, 3])
    got = model.decode(scores, lengths)
    for row, n, found in zip(scores, lengths, got):
        best = max(np.ndindex(*(pii.LABELS,) * int(n)), key=lambda s: model.w["begin"][s[0]] + sum(row[i, t] for i, t in enumerate(s)) + sum(model.w["move"][a, b] for a, b in zip(s, s[1:])))
        assert tuple(found[:n].tolist()) == best


def test_windows_overlap_and_stitch(model):
    text = "river stone " * 40 + "call +1 (345) 555-0199 4111111111111111 now " + "the mill " * 40
    assert all(b - a >= pii.WINDOW for a, b in pii.stretches(text))
    for shift in range(0, 100, 7):
        (base, added), = pii.all_spans(model, ["x" * shift + " " + text])
        assert [k for *_, k in sorted(base + added)] == [3, 2], shift


def test_tables(documents, empty, model):
    docs = documents.withColumn("n_ip", F.lit("mine")).withColumn("spans", F.lit(1))
    rows = pii.find_personal_data(docs, model).collect()
    assert len(rows) == documents.count()
    for r in rows:
        base = plain_spans(r["text"] or "")
        assert [r[f"n_{k}"] for k in pii.KINDS] == [sum(s[2] == i for s in base) for i in range(4)]
        assert set(pii.joined(base).split(",")) <= set(r["spans"].split(",")) or not base
    assert pii.find_personal_data(empty, model).count() == 0
    assert pii.Tagger().fit(np.zeros((0, 96), int), np.zeros((0, 96), int)).w["bias"].dtype == np.float32


def test_masking(spark, model):
    docs = spark.createDataFrame([(1, "mail a.b@c.de now", 17), (2, None, None), (3, "+1 (345) 555-0199 4111111111111111", 34)], "doc_id long, text string, n_chars long")
    done = {r["doc_id"]: (r["text"], r["n_chars"]) for r in pii.mask_personal_data(docs, model).collect()}
    assert done == {1: ("mail [email] now", 16), 2: (None, None), 3: ("[phone] [card]", 14)}
    assert pii.masked("0123456789", "card:1:4,phone:3:6") == "0[card][phone]6789"


def luhn_number(rng, size=16):
    digits = [rng.randrange(1, 10), *(rng.randrange(10) for _ in range(size - 2))]
    return next(t for c in range(10) if pii.luhn(t := "".join(map(str, [*digits, c]))))


def grouped(digits, mark):
    return mark.join(digits[i : i + 4] for i in range(0, len(digits), 4))


def test_other_shapes_held_out(model):
    """Cards with other separators, phones without a plus and IPv6, in words the tagger has not seen; and numbers of nobody."""
    rng = random.Random(21)
    number = lambda n: "".join(str(rng.randrange(10)) for _ in range(n))
    words = lambda n: " ".join(rng.choice(["lorem", "ipsum", "dolor", "amet", "elit", "sed"]) for _ in range(n))
    shapes = {
        "dotted card": lambda: grouped(luhn_number(rng), "."),
        "card with slashes": lambda: grouped(luhn_number(rng), "/"),
        "phone in brackets": lambda: f"({rng.randrange(200, 999)}) {rng.randrange(200, 999)}-{number(4)}",
        "phone with dashes": lambda: f"{rng.randrange(200, 999)}-{rng.randrange(200, 999)}-{number(4)}",
        "international phone": lambda: f"00{rng.randrange(10, 99)} {number(2)} {number(7)}",
        "ipv6": lambda: ":".join(f"{rng.randrange(1, 1 << 16):x}" for _ in range(8)),
    }
    found = wanted = 0
    for make in shapes.values():
        items = [make() for _ in range(30)]
        texts = [f"{words(rng.randrange(1, 9))} {x} {words(rng.randrange(1, 9))}" for x in items]
        hits = sum(x in [t[a:b] for a, b, _ in more] for x, t, (_, more) in zip(items, texts, pii.all_spans(model, texts)))
        found, wanted = found + hits, wanted + len(items)
        assert hits >= 15
    print(f"recall {found / wanted:.2f}")
    assert found >= 0.8 * wanted
    plain = [f"{words(4)} {x} {words(4)}" for _ in range(40) for x in (
        f"{rng.randrange(1950, 2030)}-0{rng.randrange(1, 9)}-1{rng.randrange(9)}", f"{number(6)}.{number(2)}", f"1,{number(3)},{number(3)}",
        f"{rng.randrange(1, 24)}:{rng.randrange(10, 59)}", f"1{number(11)}", f"v2.{rng.randrange(20)}.{rng.randrange(9)}", f"1{number(3)} 2{number(3)}",
    )]
    wrong = sum(bool(more) for _, more in pii.all_spans(model, plain))
    print(f"wrong {wrong} of {len(plain)}")
    assert wrong <= 0.02 * len(plain)


def test_loose_checks():
    assert pii.may_be_phone("0049 30 1234567") and pii.may_be_phone("(030) 123 45678") and pii.may_be_phone("555-123-4567")
    assert not any(map(pii.may_be_phone, ("123456789", "2024-01-02 12345", "192.168.100.200", "1234 5678", "12-34", "555-123-4567-89012-345")))
    assert pii.may_be_ip("2001:db8::1") and pii.may_be_ip("10.0.0.1") and not any(map(pii.may_be_ip, ("12:30", "1:2:3", "300.1.1.1", "g::1")))
    card = pii._POSSIBLE[2]
    assert card("4111.1111.1111.1111") and card("4111/1111/1111/1111") and not card("4111.1111.1111.1112") and not card("4111...1111...1111...1111")


def test_training_sample_is_the_same_whatever_the_partitions(documents):
    once = [pii.fit_tagger(documents.repartition(n), windows=60, steps=3) for n in (1, 5)]
    assert all((once[0].w[k] == once[1].w[k]).all() for k in once[0].w)
