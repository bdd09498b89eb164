import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from conftest import plan
from llm.cases import frame, odd_rows
from shopgrain.llm import quality as Q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    w = WORD.findall(text)
    seen = Counter(tuple(w[i:i + 3]) for i in range(len(w) - 2))
    covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i:i + 3])] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return (len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"),
            len(lines) - len(set(lines)), len(covered))


@pytest.fixture(scope="module")
def rows():
    return odd_rows() + [
        (20, "a b c a b c a b", "en", "s", 0), (21, "l one\nl one\n\n \nl one\nother", "en", "s", 0),
        (22, "a a a a", "en", "s", 0), (23, "a b c", "en", "s", 0), (24, "a\x0bb\x0cc\rd e", "en", "s", 0),
        (25, "x y z w " * 40, "en", "s", 0)]


def test_measures_match_brute_force(spark, rows):
    got = Q.apply_rules(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        n = brute(r["text"])
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == n
        assert r["base_failed"] == (n[0] < 50 or 100 * n[4] > 50 * n[0])
        assert r["kept"] == (not r["base_failed"] and r["rejected_by"] is None)


def test_order_does_not_change_the_verdict(spark, folder):
    docs = Q.measure(spark.read.parquet(f"{folder}/documents.parquet"))
    rules = Q.default_rules()
    one = docs.select("doc_id", Q.cascade(rules).isNull().alias("kept"))
    two = docs.select("doc_id", Q.cascade(rules[::-1]).isNull().alias("kept"))
    assert one.exceptAll(two).count() == 0 and one.where("NOT kept").count() > 0


def test_rules_go_by_rejections_per_cost(spark, folder):
    docs = Q.measure(spark.read.parquet(f"{folder}/documents.parquet"))
    ordered = Q.order_rules(docs, Q.default_rules())
    assert sorted(r.name for r in ordered) == sorted(r.name for r in Q.default_rules())
    never = [Q.Rule("never", F.lit(False)), Q.Rule("always", F.lit(True))]
    assert [r.name for r in Q.order_rules(docs, never)] == ["always", "never"]


def test_no_python_and_no_shuffle(spark, folder):
    text = plan(Q.apply_rules(spark.read.parquet(f"{folder}/documents.parquet")))
    assert "Python" not in text and "Arrow" not in text and "Exchange" not in text


def test_empty_table(spark):
    assert Q.apply_rules(frame(spark, [])).count() == 0
