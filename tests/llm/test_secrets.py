import random
import re
import string

import numpy as np

from featureloom.llm import secrets_scan as sc

from .conftest import edge_rows, frame, prose

RULES = {  # the base rules in their plain form
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), 2, 6),
    "access": (re.compile("AKIA[A-Z0-9]+"), 0, 20), "hex": (re.compile("[0-9a-f]+"), 0, 24)}


def plain(text):
    out = [(m.start(), i, k, m.end()) for i, (k, (p, g, least)) in enumerate(RULES.items())
           for m in p.finditer(text or "") if len(m[g]) >= least]
    return [(s, k, e) for s, _, k, e in sorted(out)]


TRICKY = ['secret: token: abcdefg', 'token=abc token=token=abcdefg', 'API_KEY = "ABCDEF"', "paſſword=abcdefgh", "apikey='a.b-c_d='",
          "AKIA" + "A" * 15, "AKIA" + "A" * 16, "xAKIAAKIA" + "B" * 16, "f" * 23, "é" + "0af" * 8 + "G", 'Password":"hunter2222"',
          "secret = abc", "token\n=abcdefg", "passwd  :  x" + "y" * 40, ""]


def test_base_spans_equal_plain_rules():
    for t in TRICKY + [" ".join(TRICKY), prose(1)]:
        assert sc.base_spans(t) == plain(t), t


def planted():
    rng = random.Random(7)
    b64 = "".join(rng.choices(string.ascii_letters + string.digits + "+/", k=44))
    upper_hex = "".join(rng.choices("0123456789ABCDEF", k=40))
    return b64, upper_hex


def test_battery_finds_random_strings_and_leaves_prose(spark):
    b64, upper_hex = planted()
    rows = [(i, prose(i) + " " + "".join(prose(i + 500, 12).split())) for i in range(200)]
    rows += [(1000, f"{prose(5)} {b64} {prose(6)}"), (1001, f"{prose(7)} {upper_hex} {prose(8)}")]
    got = {r.doc_id: r for r in sc.find_secrets(frame(spark, rows)).collect()}
    for d, s in ((1000, b64), (1001, upper_hex)):
        text = dict(rows)[d]
        assert [text[x.s:x.e] for x in got[d]["__spans"]] == [s]
    assert sum(len(r["__spans"]) for d, r in got.items() if d < 1000) == 0


def test_edge_cases(edge_docs, no_docs, spark):
    rows = sorted(sc.find_secrets(edge_docs).collect(), key=lambda r: repr((r.doc_id, r.text)))
    for r, (d, t) in zip(rows, sorted(edge_rows(), key=repr), strict=True):
        assert r.doc_id == d and [(x.s, x.k, x.e) for x in r["__base"]] == plain(t)
    assert sc.find_secrets(no_docs).collect() == []
    docs = frame(spark, [(1, 'x token = "abcdefgh" y'), (2, None), (3, "plain")])
    assert {r.doc_id: r.text for r in sc.redact_secrets(docs).collect()} == {1: 'x [REDACTED]" y', 2: None, 3: "plain"}


def test_battery_p_values_are_uniform_for_random_strings():
    rng = random.Random(1)
    counts = np.bincount(np.frombuffer(prose(1, 5000).encode(), np.uint8), minlength=256)
    tokens = ["".join(rng.choices(sc.ENCODINGS["base64"], k=64)) for _ in range(2000)]
    kind, p_random, p_text = sc.battery(tokens, counts)
    assert (p_random < 0.05).mean() < 0.12 and (p_text < 1e-6).mean() > 0.99
    words = ["".join(prose(i, 40).split())[:64] for i in range(500)]
    words = [w for w in words if re.fullmatch("[a-z]{64}", w)]
    assert len(words) >= 3 and (sc.battery(words, counts)[1] < 0.05).mean() > 0.8


def test_thresholds_are_benjamini_hochberg():
    rng = np.random.default_rng(0)
    p = np.concatenate([rng.uniform(size=5000), 10.0 ** -rng.uniform(5, 9, 50)])
    bins = sc.p_bin(p)
    got = sc.thresholds([(0, 0, int(b), 1) for b in bins], 0.01)[(0, 0)]
    rounded = np.sort(10.0 ** (-bins / sc.PER_DECADE))
    k = np.flatnonzero(rounded <= 0.01 * np.arange(1, len(p) + 1) / len(p)).max() + 1
    assert (bins >= got).sum() == k
