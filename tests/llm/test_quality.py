from __future__ import annotations

import collections
import re

from helpers import documents, some_texts, with_odd_columns, words

from stridelog.llm.quality import RepetitionRules, drop_repetitive, repetition_report

RULES = RepetitionRules(min_words=5)


def plain(text, rules=RULES):
    w, text = words(text), text or ""
    lines, seen, dup, dup_chars, filled = text.split("\n"), set(), 0, 0, 0
    for line in lines:
        if words(line):
            filled += 1
            if line in seen:
                dup += 1
                dup_chars += sum(map(len, words(line)))
            seen.add(line)
    grams = [tuple(w[i:i + 3]) for i in range(len(w) - 2)]
    counts = collections.Counter(grams)
    covered = {i + k for i, g in enumerate(grams) if counts[g] > 1 for k in range(3)}
    chars = sum(map(len, w))
    out = {"n_words": len(w), "word_chars": chars,
           "n_symbols": len(re.findall(r"[#*$%&|<>]", text)), "n_dup_lines": dup,
           "n_repeat_words": len(covered)}
    kept = dup_chars <= rules.line_chars * chars and dup <= rules.lines * filled
    for n, most in rules.ngram_chars.items():
        seen, inside = set(), set()
        for i in range(len(w) - n + 1):
            gram = tuple(w[i:i + n])
            if gram in seen:
                inside |= set(range(i, i + n))
            seen.add(gram)
        out[f"ngram_chars_{n}"] = sum(len(w[i]) for i in inside)
        kept = kept and out[f"ngram_chars_{n}"] <= most * chars
    failed = len(w) < rules.min_words or 100 * len(covered) > rules.max_repeat_percent * len(w)
    return out | {"base_failed": failed, "kept": kept and not failed}


def odd_texts():
    base = some_texts(1, 60, 30) + some_texts(2, 60)
    again = ["\n".join([t] * 3) for t in base[:20]] + [t + " # <b> a|b\n" + t[:80] for t in base[60:]]
    return [None, "", " \n\t\n ", "x", "é " * 3000, "a b c " * 2000, "\n" * 50,
            " ".join(some_texts(3, 300)), *base, *again]


def test_report_equals_plain_counts(spark):
    texts = odd_texts()
    got = {r["doc_id"]: r for r in repetition_report(documents(spark, texts), rules=RULES).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        for name, value in plain(text).items():
            assert got[i][name] == value, (i, name)


def test_dropping_keeps_rows_and_columns(spark):
    texts = odd_texts()
    docs = with_odd_columns(documents(spark, texts))
    out = drop_repetitive(docs, rules=RULES)
    assert out.columns == docs.columns
    want = [i for i, t in enumerate(texts) if plain(t)["kept"]]
    assert sorted(r["doc_id"] for r in out.collect()) == want
    twice = docs.union(docs)
    assert drop_repetitive(twice, rules=RULES).count() == 2 * len(want)


def test_one_repeated_line_of_a_few_does_not_condemn(spark):
    line = " ".join(f"again{i}" for i in range(15))
    own = [" ".join(f"own{i}" for i in range(a, a + 40)) for a in (0, 40)]
    row = repetition_report(documents(spark, ["\n".join([line, *own, line])])).first()
    assert row["kept"] and row["n_dup_lines"] == 1
    row = repetition_report(documents(spark, ["\n".join([line, own[0], line, line, line])])).first()
    assert not row["kept"]


def test_empty_table_and_null_ids(spark):
    docs = documents(spark, ["a b", None])
    assert repetition_report(docs.where("false")).count() == 0
    nulls = docs.selectExpr("CAST(NULL AS LONG) AS doc_id", "text")
    assert [r["doc_id"] for r in repetition_report(nulls).collect()] == [None, None]
