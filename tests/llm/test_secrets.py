"""Secret scans against Python's regular expressions, and the trigram index."""

import re

from hypothesis import given
from hypothesis import strategies as st

from assay.llm.secrets import RULES, Rule, candidates, scan_secrets, trigram_query

KEYWORDS = "(password|passwd|secret|token|api_?key)"
BASE = [(r"(?i:" + KEYWORDS + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
        (r"AKIA[A-Z0-9]+", 0, 20), (r"[0-9a-f]+", 0, 24)]

TEXTS = [
    None, "", "nothing", "password = hunter2long", "PASSWORD:'abc'", "token=token: abcdefgh",
    'api_key="ABCDEF123456" apikey: zzzzzz', "AKIA" + "B" * 16, "AKIA" + "B" * 15,
    "xAKIAAKIA" + "C" * 20, "0123456789abcdef01234567", "g0123456789abcdef0123456",
    "secret: " + "a1" * 20 + " and token=" + "f" * 30, "\U0001f642 é secret=12345678 \U0001f642"
    " passwd = qwertyui", "Password=a secret=b token=c", "to" + "ken=abcdefgh\nSECRET:abcdefg",
    ("filler words " * 3_000 + "token=abcdef123 ") * 20, "ſecret=abcdefgh toKen=abcdefgh",
]


def plain(text):
    return sorted((m.start(), kind, m.end()) for kind, (pattern, group, least) in enumerate(BASE)
                  for m in re.finditer(pattern, text or "", re.ASCII)
                  if len(m.group(group)) >= least)


def test_spans(spark):
    rows = [(i, t, "x") for i, t in enumerate(TEXTS)] + [(3, TEXTS[4], "x"), (None, TEXTS[3], "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string, grams string")
    got = scan_secrets(df)
    assert got.columns == [*df.columns, "__spans"]
    assert sorted((str(r.doc_id), str(r.text), [tuple(s) for s in r[3]]) for r in got.collect()) \
        == sorted((str(i), str(t), plain(t)) for i, t, _ in rows)
    assert scan_secrets(df.limit(0)).count() == 0


def test_queries():
    assert trigram_query(RULES[1].pattern) == [{"aki", "kia"}]
    assert trigram_query(RULES[2].pattern) is None
    assert {"tok", "oke", "ken"} in trigram_query(RULES[0].pattern)
    assert {"api", "pik", "ike", "key"} in trigram_query(RULES[0].pattern)
    assert len(trigram_query(RULES[0].pattern)) == 6
    assert trigram_query("ab[0-9]c") is None and trigram_query("(abcd|x)") is None
    assert trigram_query("ab?cde") == [{"acd", "cde"}, {"abc", "bcd", "cde"}]


def test_queries_from_any_place_of_a_pattern():
    tok = {"tok", "oke", "ken"}
    assert trigram_query("[0-9]+token") == trigram_query("token[0-9]*") == [tok]
    assert trigram_query("[a-z](x+)token.+secret") == [tok | {"xto"} | {"sec", "ecr", "cre", "ret"}]
    assert trigram_query("[0-9](?:abc|xyz)[0-9]") == [{"abc"}, {"xyz"}]
    assert trigram_query("(?:[0-9]abc|x)[0-9]") is None
    assert trigram_query("(?:ab){2,}c") == [{"aba", "bab", "abc"}]
    assert trigram_query("(abc)*") is None and trigram_query(".*") is None
    assert trigram_query(r"^\bgh[pousr]_[A-Za-z0-9]{36}$") == [
        {f"gh{c}", f"h{c}_"} for c in "oprsu"]


PIECES = ["a", "b", "[ab]", "[a-c]", "abc", "(?:ab|c)", "(?:ca|bb.)", ".", "c?", "(?:ab)?", "b+",
          "(?:abc)+", "(?:ab){2}", "a{2,4}", "c*", "(?:a|bc*|ab+c)", "^", r"\b", "(?=a)"]


@given(st.lists(st.sampled_from(PIECES), min_size=1, max_size=6).map("".join),
       st.integers(1, 64), st.text("abcd", max_size=40))
def test_every_match_holds_its_query(pattern, limit, text):
    query = trigram_query(pattern, limit)
    for m in re.finditer(pattern, text, re.DOTALL):
        assert query is None or any(all(t in m.group() for t in s) for s in query)


def test_candidates_hold_all_trigrams(spark):
    df = spark.createDataFrame([(1, "ken tok oke"), (2, "tok ken"), (3, "aki kia"), (4, None)],
                               "doc_id long, text string")
    got = {r[0]: r.asDict() for r in candidates(df, RULES).collect()}
    assert set(got) == {1, 3}
    assert got[1]["__may_assign"] and not got[1]["__may_access"] and got[3]["__may_access"]


def test_own_rule(spark):
    rule = Rule("key", "-----BEGIN [A-Z ]+-----")
    df = spark.createDataFrame([(1, "x -----BEGIN RSA KEY----- y")], "doc_id long, text string")
    assert [tuple(s) for s in scan_secrets(df, [rule]).first()["__spans"]] == [(2, 0, 25)]


def test_rules_without_trigrams_scan_every_text(spark):
    docs = spark.createDataFrame([(1, "ab 12345 c"), (2, None), (3, "none")], "doc_id long, text string")
    only = [r for r in RULES if r.kind == "hex"]
    assert only and {r.doc_id: len(r["__spans"]) for r in scan_secrets(docs, only).collect()} == {
        1: 0, 2: 0, 3: 0}
    digits = [Rule("digits", "[0-9]+", 0, 3)]
    assert {r.doc_id: [tuple(x) for x in r["__spans"]] for r in
            scan_secrets(docs, digits).collect()} == {1: [(3, 0, 8)], 2: [], 3: []}
