"""The filter audit against applying the filters document by document, in every order."""

import re
from itertools import permutations

import pytest

from voltaria.llm import audit

LONG = " ".join(f"word{k}" for k in range(120))
ROWS = [
    (1, LONG, "en", "x"), (2, LONG, "en", "x"), (2, LONG, "de", "x"), (3, LONG + " $", "en", "x"), (4, "SHOUT " * 130, "de", "x"), (5, None, None, "x"), (6, "", "", "x"),
    (7, "a b a b", "en", "x"), (8, "a b a b", "en", None), (8, "a b a b", "en", None), (None, LONG, "en", "x"), (None, None, None, None), (9, "Ünïcode x # Ä", "fr", "x"), (1, LONG, "en", "x"),
    (10, " ".join(f"w{k} w{k}" for k in range(200)), "fr", "x"), (11, "\t \n", "fr", "x"),
]
LABELS = [(1, 1, 0), (2, 1, 1), (2, 0, 0), (3, None, 1), (4, 0, None), (7, 1, 0), (99, 1, 1), (None, 1, 1), (6, 2, 1)]


def brute(rows, labels):
    docs = [(i, t or "", p or "") for i, t, p, _ in rows]
    first = {}
    for i, t, _ in docs:
        if i is not None:
            first[t] = min(i, first.get(t, i))
    good, toxic = ({i for i, *v in labels if v[k] == 1} for k in (0, 1))

    def fails(i, t):
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        bad = {"A": len(w) < 100, "B": 100 * len(set(w)) < 80 * len(w), "C": 100 * len(re.findall("[A-Z]", t)) > 10 * len(t), "D": bool(re.search("[#$%&*|]", t)), "E": i is not None and i > first[t]}
        return {k for k, v in bad.items() if v}

    out = {}
    for part in {p for *_, p in docs}:
        own = [(i, fails(i, t)) for i, t, p in docs if p == part]
        total = dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            alive = list(range(len(own)))
            for step, f in enumerate(order, 1):
                here = [k for k in alive if f in own[k][1]]
                alive = [k for k in alive if f not in own[k][1]]
                gone = sum(f in x for _, x in own) - len(here)
                total[f] += len(here)
                out[part, order, step] = [len(alive), len(here), gone, sum(x == {f} for _, x in own), sum(own[k][0] in good - {None} for k in here), sum(own[k][0] in toxic - {None} for k in here), f]
        for (p, *_), v in out.items():
            if p == part:
                v[-1] = total[v[-1]] if isinstance(v[-1], str) else v[-1]
    return {k: tuple(v) for k, v in out.items()}


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame(LABELS, "doc_id long, quality int, toxic int").selectExpr("*", "'x' AS part", "1 AS n")


def test_equals_filters_applied_in_every_order(spark, labels):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, mask string")
    got = audit.interactions(docs, labels).collect()
    assert [f.dataType.simpleString() for f in audit.interactions(docs, labels).schema] == ["string", "string", "int"] + ["bigint"] * 7
    assert {(r.part, r.filter_order, r.step): tuple(r[3:]) for r in got} == brute(ROWS, LABELS)
    assert len(got) == 600 * len({p or "" for *_, p, _ in ROWS})


def test_outcomes_share_all_documents(spark, labels):
    m = audit.outcomes("ABCDE")
    assert m.kept.shape == m.removed.shape == m.redundant.shape == m.unique.shape == (32, 600)
    of_step = (m.kept + m.removed).reshape(32, 120, 5)
    before = m.kept.reshape(32, 120, 5)
    assert (of_step[:, :, 1:] == before[:, :, :-1]).all() and (of_step[:, :, 0] == 1).all()


def test_empty_tables_and_own_filters(spark, labels):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, lang string, words string")
    assert audit.interactions(docs.limit(0), labels).count() == 0
    bare = audit.interactions(docs, labels.limit(0)).selectExpr("sum(good_lost)", "sum(toxic_lost)").first()
    assert tuple(bare) == (0, 0)
    own = audit.interactions(docs, labels, "words", {"L": lambda t, w: t.rlike("word7")}, "Z").collect()
    assert {r.filter_order for r in own} == {"LZ", "ZL"} and {r.part for r in own} == {"", "x"}
    for r in own:
        assert r.shapley == sum(o.removed for o in own if o.part == r.part and o.filter_order[o.step - 1] == r.filter_order[r.step - 1])


def test_parts_beyond_a_block(spark, labels):
    docs = spark.range(150).selectExpr("id AS doc_id", "'a b' AS text", "cast(id AS string) AS lang")
    got = audit.interactions(docs, labels).groupBy("part").count().collect()
    assert len(got) == 150 and {r["count"] for r in got} == {600}
