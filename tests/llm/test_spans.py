"""Personal data and secrets against the patterns run by Python's own regular expressions."""

import hashlib
import math
import random
import re
import string
import time
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from casegrid.llm import crf, pii, secrets

from .helpers import documents, odd_table

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")


def luhn(x):
    d = [int(c) for c in x][::-1]
    return (sum(d[::2]) + sum(sum(divmod(2 * c, 10)) for c in d[1::2])) % 10 == 0


def brute_pii(t):
    out = [(m.start(), 0, "email", m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, "ip", m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, "card", m.end()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 14 <= len(re.sub("[^0-9]", "", m[0])) <= 19 and luhn(re.sub("[^0-9]", "", m[0]))]
    out += [(m.start(), 3, "phone", m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def brute_secrets(t):
    out = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(t) if len(m[2]) >= 6]
    out += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def line(spans):
    return ",".join(f"{k}:{a}:{b}" for a, _, k, b in spans)


@given(st.text(alphabet="ab1@.-_ +é", max_size=40))
@settings(max_examples=400, deadline=None)
def test_addresses_by_their_at_signs(t):
    assert pii.emails(t) == [m.span() for m in EMAIL.finditer(t)]


@given(st.text(alphabet="019. -+()x", max_size=60))
@settings(max_examples=600, deadline=None)
def test_patterns_without_going_back(t):
    assert pii.written([(a, b, k) for k, v in pii.base_spans(t).items() for a, b in v]) == line(brute_pii(t))


@pytest.mark.parametrize("text", ["7" * 1_000_000, "1." * 500_000, "12 " * 30_000, "+1 " * 300_000, "a" * 500_000 + "@", "1a" * 100_000, "@" * 300_000])
def test_hostile_texts_take_time_in_proportion(text):
    field = pii.Field()
    begun = time.monotonic()
    pii.base_spans(text)
    assert time.monotonic() - begun < 2
    pii.all_spans([text], field)
    assert time.monotonic() - begun < 40


def test_long_runs_are_decoded_whole():
    """A run of 700 tokens keeps its one best path, and so do runs that share a batch with it."""
    field = pii.Field()
    text = " ".join(["4111 1111 1111 1111", "+1 (415) 555-0132", "1999", "10.0.0.1"] * 70)
    (tokens, word), = pii.runs(text)
    assert len(tokens) > 500
    rows = pii.run_features(text, tokens, word)
    E = crf.emissions(field.weights, np.array(rows))[:, None]
    want = crf.viterbi(E, np.array([len(rows)]), field.trans, field.start)[:, 0]
    begins = [pii.trimmed(text, *tokens[i])[0] for i in np.flatnonzero(want) if pii.LABELS[want[i]].startswith("B")]
    alone = field.find([text])[0]
    assert alone and {s for s, _, _ in alone} <= set(begins)
    assert field.find(["call 415-555-0123", text, "in 1999"])[1] == alone
    old, pii.TOKENS = pii.TOKENS, 64
    try:
        assert field.find([text, "12 34", text])[2] == alone
    finally:
        pii.TOKENS = old


def mixed_texts(seed, n=150):
    r = random.Random(seed)
    bits = [
        lambda: f"{r.randint(0, 300)}.{r.randint(0, 300)}.{r.randint(0, 300)}.{r.randint(0, 300)}" + r.choice(["", ".7", "."]),
        lambda: f"u{r.randint(0, 9)}.x@mail{r.randint(0, 9)}.example.com",
        lambda: f"+{r.randint(1, 99)} ({r.randint(100, 999)}) 555-{r.randint(1000, 9999)}",
        lambda: "".join(r.choice("0123456789") for _ in range(r.randint(13, 20))),
        lambda: "4111 1111 1111 1111",
        lambda: r.choice(["Token = ", "api_key:", 'password"="', "secret= token=", "token=key: "]) + "".join(r.choice("abcXYZ019+/_.=-") for _ in range(r.randint(3, 12))),
        lambda: "AKIA" + "".join(r.choice(string.ascii_uppercase + string.digits) for _ in range(r.randint(10, 22))),
        lambda: "".join(r.choice("0123456789abcdef") for _ in range(r.randint(20, 45))),
        lambda: "the wörds 😀 of",
        lambda: r.choice([" ", "-", ",", "\n", "@", "+1"]),
    ]
    return ["".join(r.choice(bits)() + r.choice(["", " ", " "]) for _ in range(r.randint(0, 12))) for _ in range(n)]


def test_personal_data_base_spans():
    for t in mixed_texts(1, 400):
        base = pii.base_spans(t)
        assert pii.written([(a, b, k) for k, v in base.items() for a, b in v]) == line(brute_pii(t))


def test_personal_data_query(spark):
    texts = mixed_texts(2)
    got = {r["doc_id"]: r for r in pii.found(documents(spark, list(enumerate(texts))), ["doc_id"]).collect()}
    for i, t in enumerate(texts):
        want = brute_pii(t)
        r = got[i]
        assert [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]] == [sum(x[1] == k for x in want) for k in range(4)]
        assert r["base_sha256"] == hashlib.sha256(line(want).encode()).hexdigest()
        assert {x for x in line(want).split(",") if x} <= set(r["spans"].split(","))


def test_the_field_adds_what_patterns_miss_and_no_more():
    field = pii.Field()
    found = lambda t: pii.written(pii.all_spans([t], field)[0][1])
    assert found("pay with 7536784127813050 4845168114407329 now") == "card:9:25,card:26:42"
    assert found("ssn 123-45-6789 given") == "id:4:15"
    assert "phone" in found("call 415-555-0123 today")
    for t in ("in 1999 and 2021 it was", "version 1.2.3 of 2020-01-02 at 12:45", "hash 9f86d081884c7d659a2feaa0c55ad015", "", "no digits at all"):
        assert found(t) == ""


def test_masked_texts_hold_none_of_it(spark):
    texts = mixed_texts(3)
    docs = documents(spark, [*enumerate(texts), (999, None)])
    clean = pii.without(docs)
    assert clean.columns == docs.columns
    for r in clean.collect():
        if r["doc_id"] == 999:
            assert r["text"] is None
        else:
            spans = brute_pii(texts[r["doc_id"]])
            assert r["n_chars"] == len(r["text"])
            assert all(texts[r["doc_id"]][a:b] not in r["text"] for a, _, k, b in spans if k == "email")
    assert pii.masked("a b c d", [(2, 3, "ip"), (2, 5, "card"), (4, 5, "phone")]) == "a [ip] d" or pii.masked("abc", []) == "abc"


def test_secrets_query(spark):
    texts = mixed_texts(4)
    got = {r["doc_id"]: r for r in secrets.scanned(documents(spark, list(enumerate(texts))), ["doc_id"]).collect()}
    for i, t in enumerate(texts):
        want = brute_secrets(t)
        r = got[i]
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(x[1] == k for x in want) for k in range(3)], t
        assert r["base_sha256"] == hashlib.sha256(line(want).encode()).hexdigest()
        assert {x for x in line(want).split(",") if x} <= set(r["spans"].split(","))


@pytest.mark.parametrize("kind", ["random", "words"])
def test_battery(spark, kind):
    r = random.Random(6)
    symbols = string.ascii_letters + string.digits
    make = {
        "random": lambda: "".join(r.choice(symbols) for _ in range(r.choice([40, 48, 64]))),
        "words": lambda: r.choice(["/usr/local/lib/python3/site-packages/numpy", "SOME_LONG_CONSTANT_NAME_42", "getUserAccountByIdentifier2", "Ab1" * 12, "HelloWorldExample99Application", "thisisjustaverylongword2024andmore"]),
    }[kind]
    tokens = [make() for _ in range(120)]
    docs = documents(spark, [(i, f"é the {x} of.") for i, x in enumerate(tokens)])
    got = {x["doc_id"]: x["spans"] for x in secrets.scanned(docs, ["doc_id"]).collect()}
    hits = [i for i in got if "random:" in got[i]]
    if kind == "words":
        assert not hits
    else:
        assert len(hits) > 100
        assert all(got[i] == f"random:6:{6 + len(tokens[i])}" for i in hits)


VOWELS, CONSONANTS = "aeiou", "bcdfghjklmnpqrstvwxyz"


def brute_encoding(x):
    """(alphabet's two parts, ordinary chance of a change, ordinary serial correlation, sign) of a token; None: not tested."""
    body = x.rstrip("=")
    core = body.replace("-", "").replace("_", "")
    low, up, dig = (any(c in a for c in core) for a in (string.ascii_lowercase, string.ascii_uppercase, string.digits))
    if low and up and (dig or "+" in core or "/" in core):
        return string.ascii_lowercase, string.ascii_uppercase + string.digits + "+/", 0.3, 0.3, 1
    if "+" in core or "/" in core or not (low or up):
        return None
    if low and up:
        return string.ascii_lowercase, string.ascii_uppercase, 0.3, 0.3, 1
    case = str.upper if up else str
    if not dig:
        return case(VOWELS), case(CONSONANTS), 0.6, -0.25, -1
    letters = {c for c in core.lower() if c.isalpha()}
    if letters <= set("abcdef") and body == x:
        return string.digits, case("abcdef"), 0.15, 0.3, 1
    return "234567" if not set(core) & set("0189") else string.digits, case(string.ascii_lowercase), 0.15, 0.3, 1


def tail(z):
    return 0.5 * math.exp(-0.717 * z - 0.416 * z * z) if z >= 0 else 1 - 0.5 * math.exp(0.717 * z - 0.416 * z * z)


def brute_battery(x):
    """(class of length, bin of the p-value) of a token that could be random; None for others."""
    if (enc := brute_encoding(x)) is None:
        return None
    first, second, change, correlation, sign = enc
    alphabet = first + second
    body = x.rstrip("=")
    body = body.replace("-", "+").replace("_", "/") if len(alphabet) == 64 else body.replace("-", "").replace("_", "")
    n, k = len(body), len(alphabet)
    if n < 20:
        return None
    squares = sum(c * c for c in Counter(body).values())
    v = [alphabet.index(c) + 1 for c in body]
    m = sum(v) / n
    serial = sum((a - m) * (b - m) for a, b in zip(v, v[1:])) / max(sum((a - m) ** 2 for a in v), 1e-9)  # noqa: B905
    part = [c in first for c in body]
    runs, h = 1 + sum(a != b for a, b in zip(part, part[1:])), sum(part)  # noqa: B905
    chi = k * squares / n - n
    chi_z = ((max(chi, 0) / (k - 1)) ** (1 / 3) - (1 - 2 / (9 * (k - 1)))) / math.sqrt(2 / (9 * (k - 1)))
    expect = 1 + 2 * h * (n - h) / n
    runs_z = abs(runs - expect) / math.sqrt(max((expect - 1) * (expect - 2) / (n - 1), 1e-9))
    if tail(chi_z) < 0.001 or 2 * tail(runs_z) < 0.001 or 2 * tail(abs(serial) * math.sqrt(n)) < 0.001:
        return None
    pairs = n * (n - 1) / 2 * 0.065
    chi_text = (pairs - (squares - n) / 2) / math.sqrt(pairs * 0.935 + n * (n - 1) * (n - 2) * (0.0052 - 0.065**2))
    runs_text = sign * (runs - 1 - change * (n - 1)) / math.sqrt(change * (1 - change) * (n - 1))
    z = (chi_text + runs_text + sign * (correlation - serial) * math.sqrt(n)) / math.sqrt(3)
    size = (0.6931 + 0.717 * z + 0.416 * z * z) / 2.302585 if z >= 0 else 0
    return min(int(math.log2(n)), 16), min(int(size * 20), 600)


def brute_found(tokens):
    """Numbers of the tokens that Benjamini-Hochberg reports, by class of length."""
    tested = {i: t for i, x in enumerate(tokens) if (t := brute_battery(x))}
    out = set()
    for size in {c for c, _ in tested.values()}:
        own = sorted(((b, i) for i, (c, b) in tested.items() if c == size), reverse=True)
        ranks = [sum(b >= x for b, _ in own) for x, _ in own]
        good = [k for k, ((b, _), r) in enumerate(zip(own, ranks, strict=True)) if b / 20 >= -math.log10(0.001 * r / len(own))]
        out |= {i for b, i in own if good and b >= own[max(good)][0]}
    return out


ENCODED = {
    "hex": string.digits + "abcdef",
    "hex upper": string.digits + "ABCDEF",
    "base32": string.ascii_uppercase + "234567",
    "base32 lower": string.ascii_lowercase + "234567",
    "base36": string.ascii_lowercase + string.digits,
    "base36 upper": string.ascii_uppercase + string.digits,
    "letters": string.ascii_letters,
    "lower": string.ascii_lowercase,
    "base64": string.ascii_letters + string.digits + "+/",
}
ORDINARY = ["thisisjustaverylongwordwithoutend", "state-of-the-art-technologies", "internationalApplicationHandlerFactory", "donaudampfschifffahrtsgesellschaft", "SOME_LONG_CONSTANT_NAME", "some_snake_case_function_name_here", "release-2024-version-with-notes", "/usr/local/share/applications/default", "HTTPServerConnectionPoolManager", "anticonstitutionnellement", "20240115123456789012345", "--------------------------", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "a1a1a1a1a1a1a1a1a1a1a1a1"]


def test_battery_against_python(spark):
    """Random tokens of each encoding and ordinary ones: the same are reported as by the formulas above, one by one."""
    r = random.Random(8)
    tokens = [(kind, "".join(r.choice(a) for _ in range(r.choice([22, 40, 64])))) for kind, a in ENCODED.items() for _ in range(45)]
    tokens += [("ordinary", x) for x in ORDINARY for _ in range(7)] + [("base36", "qz8xk2vw9m3bt7n5rj4hs6gd"), ("base64", "A" + "b" * 30), ("base64", "aB3-_" * 9), ("hex", "550e8400-e29b-41d4-a716-446655440000")]
    got = {x["doc_id"]: x["spans"] for x in secrets.scanned(documents(spark, [(i, f"é {x} .") for i, (_, x) in enumerate(tokens)]), ["doc_id"]).collect()}
    base = {i for i, s in got.items() if "hex:" in s or "access:" in s}
    free = [i for i in range(len(tokens)) if i not in base]
    want = {free[k] for k in brute_found([tokens[i][1] for i in free])}
    assert {i for i, s in got.items() if "random:" in s} == want and len(tokens) > 500
    assert all(got[i] == f"random:2:{2 + len(tokens[i][1])}" for i in want)
    assert not any(tokens[i][0] == "ordinary" for i in want)
    assert next(i for i, (_, x) in enumerate(tokens) if x.startswith("qz8xk2")) in want
    for kind in ENCODED:
        own = [i for i in free if tokens[i][0] == kind and len(tokens[i][1]) == 64]
        assert not own or sum(i in want for i in own) > 0.8 * len(own), kind


def test_odd_inputs(spark):
    empty = hashlib.sha256(b"").hexdigest()
    for scan in (pii.found, secrets.scanned):
        got = scan(odd_table(spark), ["doc_id", "spans", "t"]).collect()
        assert len(got) == 13 and got[0].asDict().keys() >= {"doc_id", "t", "base_sha256", "spans"}
        assert all(r["base_sha256"] == empty and r["spans"] == "" for r in got if r["doc_id"] in (1, 2, 3))
        assert scan(documents(spark, []), ["doc_id"]).count() == 0
    assert pii.without(odd_table(spark)).columns == odd_table(spark).columns
