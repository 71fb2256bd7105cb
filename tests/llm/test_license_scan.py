from __future__ import annotations

import random

from helpers import documents, some_texts, with_odd_columns
from pyspark.sql import functions as F

from stridelog.llm.license_scan import Templates, parts_of, scan, words_of
from stridelog.llm.license_templates import CC_LONG, HEADERS, NOTICES, TEMPLATES, TEXTS
from stridelog.llm.license_texts import FULL_TEXTS


def plain(text, threshold=0.8):
    """Every part against every wording, without bounds."""
    out = {}
    for part in parts_of(text or ""):
        a = {(x, y) for x, y in zip(part, part[1:])}
        for name, wording in TEMPLATES:
            w = words_of(wording)
            b = {(x, y) for x, y in zip(w, w[1:])}
            if a and 2 * len(a & b) / (len(a) + len(b)) >= threshold:
                out.setdefault(name, []).append(2 * len(a & b) / (len(a) + len(b)))
    return {name: (max(s), len(s)) for name, s in out.items()}


def texts():
    base = some_texts(2, 20)
    out = [None, "", "x", "\n\n", *base, *(t for _, t in TEMPLATES)]
    out += [t + "\n" + n for t, n in zip(base, NOTICES.values())]
    out += [base[1] + "\n\n" + TEXTS["MIT"].replace("Software", "Program", 3)]
    out += ["Released under the MIT license", "released, under: the mit LICENSE!", "x " * 50000]
    return out


def test_equals_plain_version(spark):
    rows = scan(documents(spark, texts())).collect()
    got = {}
    for r in rows:
        got.setdefault(r["doc_id"], {})[r["license"]] = (r["score"], r["n_parts"])
    want = {i: f for i, f in enumerate(map(plain, texts())) if f}
    assert got == want
    assert len(want) >= len(TEMPLATES) + 6


def test_nulls_repeats_odd_columns_own_templates_and_empty_tables(spark):
    docs = with_odd_columns(documents(spark, [NOTICES["MIT"], None]))
    nulls = docs.withColumn("doc_id", F.lit(None).cast("long"))
    assert [(r["doc_id"], r["license"]) for r in scan(nulls.union(nulls)).collect()] == [
        (None, "MIT")] * 2
    assert scan(docs, templates=[]).count() == 0
    assert scan(docs, templates=[("one", "word"), ("own", "under the MIT")]).count() == 0
    assert scan(docs.where("false")).count() == 0


def best_spans(text, templates, threshold):
    """Each licence's best score over all runs of words, each compared by itself."""
    words, out = words_of(text), {}
    for name, wording in templates:
        w = words_of(wording)
        b = set(zip(w, w[1:]))
        for i in range(len(words)):
            for j in range(i + 2, len(words) + 1):
                a = set(zip(words[i:j], words[i + 1:j]))
                score = 2 * len(a & b) / (len(a) + len(b))
                if score >= threshold:
                    out[name] = max(out.get(name, 0), score)
    return out


def test_all_runs_of_words():
    draw, n_inner = random.Random(7), 0
    for _ in range(300):
        templates = [(f"L{i % 4}", " ".join(draw.sample("abcdefghijklm", k=draw.randint(4, 12))))
                     for i in range(6)]
        words = draw.choices("abcdefghij", k=draw.randint(0, 15))
        for _, wording in draw.choices(templates, k=draw.randint(0, 2)):
            words += [*wording.split()[draw.randint(0, 1):], *draw.choices("abcxyz", k=5)]
        text = "".join(w + draw.choice([" ", " ", " ", "\n", "\n\n"]) for w in words)
        threshold = draw.choice([0.6, 0.8, 1.0])
        want = best_spans(text, templates, threshold)
        known = Templates(templates, threshold)
        found = {name: score for span in known.spans(words_of(text), set())
                 for name, score in sorted(known.match(span), key=lambda m: m[1])}
        assert set(found) == set(want)
        assert {m[0] for _, ms in known.read(text) for m in ms} == set(want)
        best = {}
        for span in known.spans(words_of(text), set()):
            for name, score in known.match(span):
                best[name] = max(best.get(name, 0), score)
        assert best == want
        n_inner += bool(want)
    assert n_inner > 100


def test_licences_inside_longer_texts(spark):
    around = " ".join(f"word{i}" for i in range(300))
    inner = ["This dataset is released under the MIT License by its authors in Berlin.",
             f"{around}\n\n{TEXTS['MIT']}\n\n{around}",
             " ".join(f"{around} {TEXTS['ISC']} {around}".split())]
    rows = scan(documents(spark, inner)).collect()
    assert [(r["doc_id"], r["license"], r["score"], r["n_parts"]) for r in rows] == [
        (0, "MIT", 1.0, 1), (1, "MIT", 1.0, 1), (2, "ISC", 1.0, 1)]


def test_full_texts_and_headers_of_common_licences(spark):
    around = " ".join(f"word{i}" for i in range(300))
    names = ("Apache-2.0 GPL-2.0 GPL-3.0 LGPL-2.1 LGPL-3.0 MPL-2.0 CC0-1.0 CC-BY-3.0 CC-BY-SA-3.0 "
             "CC-BY-SA-4.0 BSD-3-Clause Unlicense GFDL-1.3 Artistic-1.0").split()
    headers = "GPL-2.0 LGPL-2.1 LGPL-3.0 AGPL-3.0 MPL-2.0 CC-BY-4.0 CC-BY-NC-SA-4.0".split()
    wanted = [(n, FULL_TEXTS[n]) for n in names] + [(n, {**CC_LONG, **HEADERS}[n]) for n in headers]
    texts = [t for _, t in wanted] + [f"{around} {t} {around}" for _, t in wanted]
    rows = scan(documents(spark, texts)).collect()
    best = {}
    for r in rows:
        best.setdefault(r["doc_id"], set()).add((r["score"], r["license"]))
    for i in range(len(texts)):
        score = max(best[i])[0]
        assert score == 1.0 or i >= len(wanted)
        assert (score, wanted[i % len(wanted)][0]) in best[i]
