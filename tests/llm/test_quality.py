"""Metrics by a plain version, the verdict as the conjunction of rules, and the order of the cascade."""

import re

from voltaria.llm import quality

TEXTS = [
    None, "", "one", "a b c d e f g h i j", "x y z w v " * 6, "line of seven words is right here\n" * 4, "symbols### all&&& over%%% the$$$ place*** and### then&&& some%%% more$$$ of*** them###",
    "SHOUTING IS NOT A NICE WAY OF WRITING THINGS DOWN TODAY AT ALL", "Ein ganz gewöhnlicher Satz mit genügend Wörtern, der nichts Böses im Schilde führt.", "1 2 3 4 5 6 7 8 9 10 11 12", " nbsp kept together a b c d e f g h i j k", "a " * 30000,
]


def plain(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    where = {}
    for k in range(len(w) - 4):
        where.setdefault(tuple(w[k : k + 5]), []).append(k)
    marked = {k + j for ks in where.values() if len(ks) > 1 for k in ks for j in range(5)}
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), sum(x in lines[:k] for k, x in enumerate(lines)), len(marked)


def test_metrics_and_verdict(spark):
    docs = spark.createDataFrame([(k, t, 1) for k, t in enumerate(TEXTS)], "doc_id long, text string, kept int")
    got = {r.doc_id: r for r in quality.judge(docs).collect()}
    for k, t in enumerate(TEXTS):
        r = got[k]
        base = plain(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == base, k
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        x = quality.Text(t or "")
        x.base()
        assert r.kept == (not r.base_failed and not any(rule.rejects(x) for rule in quality.RULES))
    assert [k for k in got if got[k].kept] == [8, 10]
    assert quality.judge(docs.limit(0)).count() == 0


def test_filter_keeps_the_columns(spark):
    docs = spark.createDataFrame([(8, TEXTS[8], "x"), (1, "", "y"), (8, TEXTS[8], "z")], "doc_id long, text string, kept string")
    out = quality.filter_documents(docs)
    assert out.columns == docs.columns and sorted(r.kept for r in out.collect()) == ["x", "z"]


def test_order_is_by_rejection_per_cost():
    a, b, c = (quality.Rule(n, bool) for n in "abc")
    assert quality.ordered((a, b, c), {"a": (1.0, 0.1), "b": (0.1, 0.1), "c": (0.1, 0.0)}) == (b, a, c)
    assert quality.ordered((a, b), {}) == (a, b)


def test_good_documents_of_the_labels_are_kept(spark):
    d = "/root/testdata/sf0.01"
    got = quality.op1_quality_rules(spark, d).join(spark.read.parquet(f"{d}/labels.parquet"), "doc_id").filter("NOT base_failed").groupBy("quality", "kept").count().collect()
    n = {(r.quality, r.kept): r["count"] for r in got}
    assert n.get((1, False), 0) == 0 and n.get((0, True), 0) == 0


def test_each_rule_rejects_its_kind_and_no_prose(spark):
    prose = " ".join(f"word{chr(97 + k % 26)}{chr(97 + k // 26)}" for k in range(120)) + "."
    odd = {
        "few_letters": " ".join("½²" for _ in range(10)) + " 12 34 -- __ one two", "symbols": prose[:200] + " # $ % & * | < > # $ % & *", "word_length": " ".join("abcdefghijklmnopqrst" + str(k) for k in range(20)),
        "duplicate_lines": "\n".join(["same line here"] * 6 + [f"line {chr(97 + k)} differs" for k in range(6)]), "shouting": prose.upper(), "bullets": "\n".join(f"- item {chr(97 + k)} of the list" for k in range(12)),
        "open_ended_lines": "\n".join(f"read more of {chr(97 + k)}..." for k in range(12)), "digits": " ".join(f"a{10**5 + k}" for k in range(30)), "one_word": " ".join(f"spam w{chr(97 + k)}" for k in range(26)),
        "one_phrase": " ".join(f"buy it now {chr(97 + k)}{chr(97 + k)} {chr(98 + k)}" for k in range(20)), "broken_characters": prose[:300] + "�" * 30, "placeholder": prose + " Lorem IPSUM dolor",
    }
    rules = {r.name: r for r in quality.RULES}
    assert set(odd) == set(rules)
    for name, text in odd.items():
        t = quality.Text(text)
        t.base()
        assert rules[name].rejects(t), name
    t = quality.Text(prose)
    t.base()
    assert not any(r.rejects(t) for r in quality.RULES)
    docs = spark.createDataFrame([(1, odd["few_letters"]), (None, prose), (3, prose)], "doc_id long, text string")
    assert {(r.doc_id, r.kept) for r in quality.judge(docs).collect()} == {(1, False), (None, True), (3, True)}
