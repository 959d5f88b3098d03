import collections
import math
import random

import numpy as np
import pytest

from featureloom.llm import langid, licenses

from .conftest import edge_rows, frame, prose

NOTICES = {"Apache-2.0": "Licensed under the Apache License, Version 2.0.", "MIT": "Released under the MIT License.",
           "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
           "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0."}


def test_notices_are_found_in_place_and_near_misses_are_not(spark):
    rows = [(i, f"{prose(i)}\n{n} {prose(i + 9)}") for i, n in enumerate(NOTICES.values())]
    rows += [(10, "a driver's license and a public domain plot, all rights reserved"),
             (11, "licensed under the GNU General Public License, version 7"), (12, "LICENSED under the  apache license -- version 2.0"),
             (13, prose(3) + " " + " ".join(NOTICES.values())), (14, "İ" * 40 + NOTICES["MIT"]), (15, NOTICES["MIT"] * 2)]
    got = {r.doc_id: r for r in licenses.license_digest(licenses.find_licenses(frame(spark, rows), ["doc_id"])).collect()}
    for i, (name, notice) in enumerate(NOTICES.items()):
        assert got[i].licenses == name
        _, s, e = got[i].spans.split(":")
        words = licenses.WORD.findall(rows[i][1][int(s):int(e)])
        assert set(words) <= set(licenses.WORD.findall(notice)) and len(words) >= 4
    assert [got[i].licenses for i in (10, 11, 12)] == ["", "", "Apache-2.0"]
    assert got[13].licenses == ",".join(sorted(NOTICES)) and got[14].licenses == "MIT" and got[15].n_matches == 2


def test_differences_are_reported():
    n, found = licenses.Scanner(licenses.TEMPLATES, 0.85).scan(
        "Permission is hereby granted, free of cost, to any person obtaining a copy of this software and associated "
        "documentation files (the \"Software\"), to deal in the Software without restriction")
    assert [f["license"] for f in found] == ["MIT"] and found[0]["differences"] == "-charge +cost"


@pytest.mark.parametrize("size", [8_000, 40_000, 400_000])
def test_notices_in_long_blocks(size):
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.85)
    words = prose(7, size // 4).split()
    for k in range(20, len(words), 40):  # cue words that merge the windows
        words[k] = "copyright"
    half = len(" ".join(words)[:size]) // 2
    text = " ".join(words)[:size]
    for name, notice in NOTICES.items():
        n, found = scanner.scan(f"{text[:half]}\n{notice} {text[half:]}")
        assert n == 1 and [f["license"] for f in found] == [name]
        again = f"{prose(8, 90)}\n" + f"{notice}\n" * (size // len(notice))
        n, found = scanner.scan(again)
        assert n == 1 and [f["license"] for f in found] == [name] * (size // len(notice))


def test_words_added_before_the_anchor():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.85)
    notice = "Licensed under the terms of the Apache License, Version 2.0."
    for text in (notice, f"{notice} {prose(4, 20)} {notice}", f"{notice} {notice} {notice}", f"A licensed shop. {notice}",
                 f"A licensed shop. {notice} {notice}"):
        found = scanner.scan(text)[1]
        assert [(f["license"], f["differences"]) for f in found] == [("Apache-2.0", "+the +terms +of")] * text.count(notice)
        assert all(text[f["s"]:f["e"]] == notice[:-1] for f in found)


def plain_scan(scanner, text):
    """Every template compared with every word window of every block, without compression."""
    out = set()
    for start, end in licenses.blocks(text):
        tokens = [(m[0].lower(), start + m.start(), start + m.end()) for m in licenses.WORD.finditer(text[start:end])]
        words, where = [t[0] for t in tokens], collections.defaultdict(list)
        for n, w in enumerate(words):
            where[w].append(n)
        for name, template, *_ in scanner.templates:
            out |= {(name, tokens[s][1], tokens[e - 1][2]) for _, s, e, _ in licenses.confirm(template, words, where, scanner.coverage)}
    return out


def test_every_template_finds_itself():
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.85)
    for k, (name, form) in enumerate((n, f) for n, forms in licenses.TEMPLATES.items() for f in forms):
        for text in (form, f"{prose(k, 400)}\n{form}\n{prose(k + 99, 400)}"):
            assert name in {f["license"] for f in scanner.scan(text)[1]}, form


def test_the_compression_finds_the_candidates():
    text = f"{prose(1)} {NOTICES['MIT']} {prose(2)} {NOTICES['Apache-2.0']}"
    scanner = licenses.Scanner(licenses.TEMPLATES, 0.85)
    assert [f["license"] for f in scanner.scan(text)[1]] == ["MIT", "Apache-2.0"]
    for name, words, given, least in (t for t in scanner.templates if t[0] == "MIT"):
        scanner.templates[[t[2] for t in scanner.templates].index(given)] = (name, words, scanner.plain, least)  # saves nothing
    assert [f["license"] for f in scanner.scan(text)[1]] == ["Apache-2.0"]


def test_matches_equal_a_scan_without_compression():
    rng, scanner = random.Random(5), licenses.Scanner(licenses.TEMPLATES, 0.85)
    forms = [(n, f) for n, forms in licenses.TEMPLATES.items() for f in forms]
    plain, found, planted, missed = 0, 0, 0, 0
    for k in range(600):
        name, form = rng.choice(forms)
        words = form.split()
        if len(words) > 5 and rng.random() < 0.6:  # a changed or added word that tells no licenses apart
            at = rng.randrange(len(words))
            low = words[at].lower().strip(".,;")
            if low in ("the", "of", "to", "a", "and", "in", "under", "this"):
                words[at] = "some"
            else:
                words.insert(at, "indeed")
        text = f"{prose(k, rng.randrange(5, 300))} {' '.join(words)} {prose(k + 1000, rng.randrange(5, 300))}"
        want = plain_scan(scanner, text)
        got = [(f["license"], f["s"], f["e"]) for f in scanner.scan(text)[1]]
        assert set(got) <= want
        reached = [w for w in want if any(w[1] < g[2] and g[1] < w[2] for g in got)]
        plain, found = plain + len(want), found + len(reached)
        planted, missed = planted + 1, missed + (name not in {g[0] for g in got} and name in {w[0] for w in want})
    assert plain > 500 and found == plain and missed == 0, (plain, found, missed)


def test_license_edge_cases(edge_docs, no_docs):
    got = licenses.license_digest(licenses.find_licenses(edge_docs, ["doc_id"])).collect()
    assert len(got) == len(edge_rows()) and all(r.licenses == "" and r.n_blocks == 0 for r in got)
    assert licenses.find_licenses(no_docs, ["doc_id"]).collect() == []


def test_blocks_equal_plain_windows():
    text = prose(1) + " License " + prose(2, 10) + " copyright " + prose(3)
    hit = set()
    for m in licenses.CUE.finditer(text):
        hit.update(range(max(0, m.start() - licenses.REACH), min(len(text), m.end() + licenses.REACH)))
    assert {k for s, e in licenses.blocks(text) for k in range(s, e)} == hit


def languages():
    rng = random.Random(1)
    syl = {"aa": ["ka", "to", "mi"], "bb": ["str", "eng", "olf"], "cc": ["zu", "xi", "qua"]}
    text = lambda lang, n: " ".join("".join(rng.choices(syl[lang], k=3)) for _ in range(n))
    docs = [(i, text(lang, 60), lang) for i, lang in enumerate(list(syl) * 30)] + [(900, None, "aa"), (901, "", "bb"), (902, "x y", None)]
    pages = []
    for i in range(120):
        lang = list(syl)[i % 3]
        body = f"<html lang='{lang}'><script>var str='eng'</script><p>{text(lang, 30)}</p></html>"
        pages.append((i, f"http://www.{lang}site.example.{lang}/x/{i}", body))
    pages += [(200, "http://www.bbsite.example.bb/empty", "<html lang=bb></html>"), (201, None, None), (202, "nonsense", ""),
              (203, "http://www.ccsite.example.cc/", None), (None, "https://u:p@h.example.aa:80/q?x", f"<p>{text('aa', 20)}</p>"),
              (5, pages[5][1], pages[5][2])]
    return docs, pages


def brute(model, pages):
    """The fused posterior in plain Python."""
    rows = []
    for i, url, page in pages:
        host = langid.host_of(url)
        ll, p = model.posterior(langid.visible(page))
        rows.append((i, host, ".".join(host.split(".")[-2:]), host.rsplit(".", 1)[-1], langid.declared(page), ll, p))
    sums = [collections.defaultdict(lambda: np.zeros(len(model.langs))) for _ in range(4)]
    for r in rows:
        for k in range(4):
            sums[k][r[1 + k]] += r[6]
    total = sum(r[6] for r in rows) + 1.0
    out = []
    for i, host, domain, suffix, said, ll, p in rows:
        h, d, x, m = (np.maximum(s[v] - p, 0) for s, v in zip(sums, (host, domain, suffix, said)))
        dp = (d + 8 * total / total.sum()) / (d.sum() + 8)
        prior = (h + 4 * dp) / (h.sum() + 4)
        like = [(v + 10 * v.sum() / total.sum() + 1e-9) / (total + 10) for v in (x, m)]
        score = ll + np.log(prior) + np.log(like[0]) + np.log(like[1])
        out.append((i, model.langs[int(score.argmax())], 1 / np.exp(score - score.max()).sum()))
    return out


def test_fusion_equals_brute_force(spark):
    docs, pages = languages()
    model = langid.train_text(spark.createDataFrame(docs, "doc_id long, text string, lang string"), temper=0.05)
    table = spark.createDataFrame(pages, "page_id long, url string, html string").selectExpr("*", "'x' as host", "1 as p", "2 as id")
    got = sorted(((r.page_id, r.lang, r.confidence) for r in langid.identify(table, model).collect()), key=repr)
    for g, w in zip(got, sorted(brute(model, pages), key=repr), strict=True):
        assert g[:2] == w[:2] and math.isclose(g[2], w[2], rel_tol=1e-6)
    lang = {r[0]: r[1] for r in got}
    assert all(lang[i] == model.langs[i % 3] for i in range(120)) and lang[200] == "bb" and lang[203] == "cc"


def test_language_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert langid.train_text(none) is None
    docs, _ = languages()
    model = langid.train_text(spark.createDataFrame(docs, "doc_id long, text string, lang string"))
    assert langid.identify(spark.createDataFrame([], "page_id long, url string, html string"), model).collect() == []


@pytest.mark.parametrize("page,lang", [('<html xml:lang="de-AT">', "de"), ("<HTML LANG=fr>", "fr"), (None, ""),
                                       ('<meta http-equiv="Content-Language" content="es">', "es"), ("<p lang='it'>", "")])
def test_declared(page, lang):
    assert langid.declared(page) == lang
