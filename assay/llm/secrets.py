"""Secret scans through a trigram inverted index.

Each rule's regular expression gives a Boolean query over the trigrams that any match must
contain: an OR of ANDs. It is put together from the pattern's parts: what a part can match as a
whole, begin with and end with, and what it must contain. In a sequence all parts' queries hold, and
the trigrams across each seam; of alternatives one query holds. The index holds postings (trigram, document) of the trigrams that some
query mentions. Intersected postings name the documents in which a rule can match, and only
their texts are searched with the rule's expression. A rule without mandatory trigrams searches
every text.

Null text is empty. Repeated rows and rows with a null ``doc_id`` are scanned like any other;
postings of rows that share an id are merged, which can only add candidates.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """A kind of secret: what to search, and which matches to keep by the length of a group."""

    kind: str
    pattern: str
    group: int = 0
    min_length: int = 1


def any_case(word: str) -> str:
    """A pattern for ``word`` with its ASCII letters in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


# The three kinds in the order in which ties are listed.
KEYWORDS = ["password", "passwd", "secret", "token", "api_?key"]
RULES = [
    Rule("assign", "(" + "|".join(any_case(k) for k in KEYWORDS) + ")"
         r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]{24,}", 0, 24),
]
# "hex" asks for its length at once: a run of hex digits is one match either way, and text is
# full of short runs.
MAX_REPEATS = 8  # of a part that are written out

Query = list[frozenset[str]]  # an OR of ANDs; an empty AND always holds
ALWAYS: Query = [frozenset()]


@dataclass(frozen=True)
class Part:
    """What is known of all matches of a part of a pattern: ``whole``, all of them if they are few,
    else None; strings of which one begins, and one ends, each match; and what it contains."""

    whole: frozenset[str] | None
    begins: frozenset[str]
    ends: frozenset[str]
    holds: tuple[frozenset[str], ...] = tuple(ALWAYS)


NOTHING = frozenset([""])
EMPTY = Part(NOTHING, NOTHING, NOTHING)
UNKNOWN = Part(None, NOTHING, NOTHING)


def _least(sets: Iterable[frozenset[str]]) -> Query:
    """The sets that hold no other one whole: another one adds nothing to an OR."""
    sets = list(dict.fromkeys(sets))
    return [s for s in sets if not any(o < s for o in sets)]


def _of_strings(strings: Iterable[str]) -> Query:
    return _least(frozenset(s[i:i + 3] for i in range(len(s) - 2))
                  for s in sorted(strings, key=lambda s: (len(s), s)))


def _both(a: Query, b: Query, limit: int) -> Query:
    """Both queries; if that takes too many sets, the one of fewer, which asks for more than none."""
    if len(a) * len(b) <= limit:
        return _least(x | y for x, y in itertools.product(a, b))
    return min((q for q in (a, b) if q != ALWAYS), key=len)


def _asked(part: Part, limit: int) -> Query:
    query = list(part.holds)
    for strings in (part.whole, part.begins, part.ends):
        if strings is not None:
            query = _both(query, _of_strings(strings), limit)
    return query


def _joined(a: frozenset[str], b: frozenset[str]) -> frozenset[str]:
    return frozenset(x + y for x, y in itertools.product(a, b))


def _then(a: Part, b: Part, limit: int) -> Part:
    if a.whole is not None and b.whole is not None and len(a.whole) * len(b.whole) <= limit:
        whole = _joined(a.whole, b.whole)
        return Part(whole, whole, whole)
    begins, ends = a.begins, b.ends
    if a.whole is not None and len(a.whole) * len(b.begins) <= limit:
        begins = _joined(a.whole, b.begins)
    if b.whole is not None and len(a.ends) * len(b.whole) <= limit:
        ends = _joined(a.ends, b.whole)
    holds = _both(_asked(a, limit), _asked(b, limit), limit)
    if len(a.ends) * len(b.begins) <= limit:
        holds = _both(holds, _of_strings(_joined(a.ends, b.begins)), limit)
    return Part(None, begins, ends, tuple(holds))


def _either(parts: list[Part], limit: int) -> Part:
    def union(sets: list[frozenset[str]]) -> frozenset[str]:
        every = frozenset().union(*sets)
        return every if len(every) <= limit else NOTHING

    if all(p.whole is not None for p in parts) \
            and len(whole := frozenset().union(*(p.whole for p in parts))) <= limit:
        return Part(whole, whole, whole)
    holds = _least(s for p in parts for s in _asked(p, limit))
    return Part(None, union([p.begins for p in parts]), union([p.ends for p in parts]),
                tuple(holds if len(holds) <= limit else ALWAYS))


def _part(nodes: Iterable, limit: int) -> Part:
    out = EMPTY
    for op, arg in nodes:
        name, part = str(op), UNKNOWN
        if name == "LITERAL":
            whole = frozenset([chr(arg).lower()])
            part = Part(whole, whole, whole)
        elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg):
            whole = frozenset(chr(a).lower() for _, a in arg)
            part = Part(whole, whole, whole)
        elif name == "SUBPATTERN":
            part = _part(arg[3], limit)
        elif name == "BRANCH":
            part = _either([_part(b, limit) for b in arg[1]], limit)
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and (arg[0] or arg[1] == 1):
            once = _part(arg[2], limit)
            if arg[0] == 0:
                part = _either([EMPTY, once], limit)
            else:  # the first and the last of the repeats, at least one
                part = reduce(lambda a, b: _then(a, b, limit), [once] * min(arg[0], MAX_REPEATS))
                if arg[1] != arg[0] or arg[0] > MAX_REPEATS:
                    part = Part(None, part.begins, part.ends, tuple(_asked(part, limit)))
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):  # these match no characters
            part = EMPTY
        out = _then(out, part, limit)
    return out


def trigram_query(pattern: str, limit: int = 64) -> Query | None:
    """Sets of lower-case trigrams, of which every match of ``pattern`` contains at least one in
    full; None if the pattern has no such sets. Parts with more than ``limit`` strings, and queries
    of more sets, are taken for unknown, which can only add candidates."""
    least = _asked(_part(re._parser.parse(pattern), limit), limit)
    return None if not all(least) else least


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index for ``trigrams``: a row for each trigram of each text, case folded."""
    low = F.lower("text")
    found = F.array_compact(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t))
                                      for t in trigrams]))
    return docs.select("doc_id", F.explode(found).alias("trigram"))


def candidates(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Documents in which some rule with trigrams can match: ``doc`` and a flag ``may_<kind>``."""
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    needed = sorted({t for q in queries.values() for s in q for t in s})
    grams = postings(docs, needed).groupBy(F.col("doc_id").alias("__doc")).agg(
        F.collect_set("trigram").alias("grams"))

    def holds(query: list[frozenset[str]]) -> Column:
        return reduce(lambda a, b: a | b, [
            F.size(F.array_except(F.array(*map(F.lit, sorted(s))), "grams")) == 0 for s in query])

    flagged = grams.select("__doc", *[holds(q).alias(f"__may_{k}") for k, q in queries.items()])
    return flagged.where(reduce(lambda a, b: a | b, [F.col(f"__may_{k}") for k in queries]))


def match_spans(text: Column, rule: Rule, order: int) -> Column:
    """The rule's matches in ``text`` as an array of (start, order, end) in code points.

    Spark gives matches and the pieces between them; their lengths add up to the positions.
    """
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    judged = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group))
    lengths = F.arrays_zip(
        F.transform(F.split(text, rule.pattern), F.length).alias("gap"),
        F.transform(matches, F.length).alias("match"),
        F.transform(judged, F.length).alias("judged"))
    empty = F.array().cast("array<struct<start:int,kind:int,end:int>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["gap"]
        end = start + F.coalesce(x["match"], F.lit(0))
        span = F.struct(start.alias("start"), F.lit(order).alias("kind"), end.alias("end"))
        return F.struct(end.alias("at"), F.when(
            x["judged"] >= rule.min_length, F.concat(acc["spans"], F.array(span))
        ).otherwise(acc["spans"]).alias("spans"))

    walk = F.aggregate(lengths, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step,
                       lambda acc: acc["spans"])
    return F.when(F.regexp_like(text, F.lit(rule.pattern)), walk).otherwise(empty)


def scan_secrets(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Every row of ``docs`` with ``__spans``: an array of (start, kind, end) in order of start
    and kind, where kind is the rule's place in ``rules``."""
    indexed = {r.kind for r in rules if trigram_query(r.pattern)}
    text = F.coalesce("text", F.lit(""))
    none = F.array().cast("array<struct<start:int,kind:int,end:int>>")
    both = docs
    if indexed:
        cand = candidates(docs, rules)
        both = docs.join(cand, F.col("doc_id").eqNullSafe(F.col("__doc")), "left")
    found = [F.when(F.col(f"__may_{r.kind}"), match_spans(text, r, i)).otherwise(none)
             if r.kind in indexed else match_spans(text, r, i) for i, r in enumerate(rules)]
    return both.select(*[F.col(f"`{c}`") for c in docs.columns],
                       F.array_sort(F.concat(*found)).alias("__spans"))


def spans_text(spans: Column, rules: list[Rule] = RULES) -> Column:
    """kind:start:end, comma-joined."""
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(kinds, s["kind"]), s["start"], s["end"])), ",")
