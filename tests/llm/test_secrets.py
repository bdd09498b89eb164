import random
import re

from llm.cases import frame, odd_rows
from shopgrain.llm import secret_scan as S

ASSIGN = re.compile(r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                    r"([A-Za-z0-9+/_.=-]+)", re.ASCII)


def brute(text):
    found = []
    for order, (rule, group) in enumerate(((ASSIGN, 2), (re.compile("AKIA[A-Z0-9]+"), 0),
                                           (re.compile("[0-9a-f]+"), 0))):
        least = (8, 16, 32)[order]
        found += [(m.start(), order, m.end()) for m in rule.finditer(text or "")
                  if len(m.group(group)) >= least]
    return sorted(found)


def spans(row):
    return [(s["start"], s["ord"], s["end"]) for s in row["secret_spans"] if s["ord"] < 3]


def test_queries_from_expressions():
    assert S.trigram_query("[0-9a-f]+") is None
    assert S.trigram_query("AKIA[A-Z0-9]+") == frozenset({frozenset({"aki", "kia"})})
    assert S.trigram_query("abc(de|fg)?x*") == frozenset(
        {frozenset({"abc"}), frozenset({"abc", "bcd", "cde"}), frozenset({"abc", "bcf", "cfg"})})
    assert S.trigram_query("(abc|x)+") is None
    assert all("pas" in q or "tok" in q or "sec" in q or "api" in q
               for q in S.trigram_query(S.BASE[0].regex))


def test_random_texts_match_brute_force(spark):
    rng = random.Random(2)
    bits = ["password", "PassWD", "secret", "Token", "api_key", "APIKEY", ":", "=", " ", '"', "'",
            "AKIA", "AKIA" + "Q7" * 7, "deadbeef" * 4, "0123456789abcdef" * 2, "é", "😀", "\n", "x",
            "abcdefgh", "12345678", "tok", "-", "."]
    rows = [(i, "".join(rng.choices(bits, k=rng.randint(0, 40))), "en", "s", 0) for i in range(400)]
    got = S.find_secrets(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    assert sum(len(spans(r)) for r in got) > 300
    for r in got:
        assert spans(r) == brute(r["text"])


def test_odd_rows(spark):
    got = S.find_secrets(frame(spark)).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        assert spans(r) == brute(r["text"])
    assert S.find_secrets(frame(spark, [])).count() == 0


def test_further_kinds(spark):
    text = "x gh" + "p_" + "a1" * 18 + " and -----BEGIN RSA PRIVATE KEY----- and AI" + "za" + "b" * 35
    row = S.find_secrets(frame(spark, [(1, text, None, None, 0)])).first()
    assert {s["kind"] for s in row["secret_spans"]} >= {"github", "pem", "google"}
