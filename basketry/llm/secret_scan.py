"""Secret scans with a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean query is derived: a disjunction of
sets of trigrams, one of which every matching text contains whole. The index has
a posting (trigram, document) for every trigram that some query names; postings
are intersected per set, and only the documents left are verified with the regex.
A rule that matches without any mandatory trigram is run over all documents.

Trigrams are of the lower-cased text, so one index serves rules of either case.
Matches are leftmost and do not overlap within a rule; those failing the rule's
length are dropped after matching. Places are code points, the end exclusive.

Nulls: a null text is empty; a null doc_id is an id like any other. An empty table
gives no rows. Texts of any length are scanned whole. Spans that begin at the same
place stand in the order of their rules. Rows that repeat doc_id and text get the
same result each. Extra columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as op, _parser as regex_parser

from pyspark.sql import Column, DataFrame, Window, functions as F

from basketry.llm.common import DOC, doc_key, written


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its pattern, and the least length of the given group (0: the whole match)."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The base kinds in the order in which they are listed, then published formats of credentials.
BASE = (
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),
)
MORE = (
    Rule("private_key", r"-----BEGIN (RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----"),
    Rule("hosting_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud_key", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("signed_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE
MOST_TRIGRAMS = 62  # of one set that are looked up; fewer only leave more to verify
SMALL_CLASS = 6  # a character class of at most so many characters counts as alternatives, a larger one ends a literal


# --- from a regex to trigrams --------------------------------------------------

CUT = "\0"


def _literals(parsed) -> list[str]:
    """The alternatives of a parsed regex as lower-case literals, with ``CUT`` where anything may stand."""
    found = [""]
    for kind, value in parsed:
        found = [a + b for a in found for b in _choices(kind, value)]
    return found


def _choices(kind, value) -> list[str]:
    if kind == op.LITERAL:
        return [chr(value).lower()]
    if kind == op.SUBPATTERN:
        return _literals(value[-1])
    if kind == op.BRANCH:
        return [x for branch in value[1] for x in _literals(branch)]
    if kind == op.IN and len(value) <= SMALL_CLASS and all(k == op.LITERAL for k, _ in value):
        return sorted({chr(c).lower() for _, c in value})
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, inner = value
        if (least, most) == (0, 1):
            return ["", *_literals(inner)]
        if least:
            return [x + CUT + x for x in _literals(inner)] if len(inner) > 1 else [x + CUT for x in _literals(inner)]
    return [CUT]


def trigram_query(pattern: str) -> list[set[str]]:
    """Sets of trigrams of which every match contains one whole; empty if some match needs none."""
    sets = [{run[i:i + 3] for run in text.split(CUT) for i in range(len(run) - 2)} for text in _literals(regex_parser.parse(pattern))]
    if not all(sets):
        return []
    return [s for i, s in enumerate(sets) if not any(t < s or (t == s and j < i) for j, t in enumerate(sets))]


# --- index and intersection ------------------------------------------------------


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """``trigram, DOC``: one row for each of ``trigrams`` that a document's lower-cased text contains."""
    low = docs.select(*doc_key(docs), F.lower("text").alias("low"))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select(F.explode(found).alias("trigram"), *DOC)


def candidates(index: DataFrame, queries: dict[int, list[set[str]]]) -> DataFrame:
    """``DOC, rules``: the rules (as bits) of which a document holds some whole set of trigrams."""
    parts = [(rule, s, sorted(trigrams)[:MOST_TRIGRAMS]) for rule, sets in queries.items() for s, trigrams in enumerate(sets)]
    rows = [F.struct(F.lit(t).alias("trigram"), F.lit(rule).alias("rule"), F.lit(s).alias("part"), F.lit(1 << i).cast("long").alias("bit"),
                     F.lit((1 << len(trigrams)) - 1).cast("long").alias("full")) for rule, s, trigrams in parts for i, t in enumerate(trigrams)]
    # As many rows as the rules have trigrams, whatever the documents.
    terms = index.sparkSession.range(1).select(F.inline(F.array(*rows)))
    held = index.join(F.broadcast(terms), "trigram").groupBy(*DOC, "rule", "part", "full").agg(F.bit_or("bit").alias("held"))
    whole = held.filter("held = full").select(*DOC, F.call_function("shiftleft", F.lit(1).cast("long"), F.col("rule")).alias("bit"))
    return whole.groupBy(*DOC).agg(F.bit_or("bit").alias("rules"))


# --- verification ------------------------------------------------------------------


def no_matches() -> Column:
    return F.expr("cast(array() as array<struct<rule:int,n:int,gap:int,length:int,good:boolean>>)")


def matches(text: Column, number: int, rule: Rule) -> Column:
    """Array of matches in order: the code points before each since the last, its length, and whether it is long enough."""
    pattern = F.lit(rule.pattern)
    between, whole, group = F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0)), F.regexp_extract_all(text, pattern, F.lit(rule.group))
    zipped = F.transform(F.arrays_zip(F.slice(between, 1, F.size(whole)).alias("b"), whole.alias("w"), group.alias("g")), lambda z, i: F.struct(
        F.lit(number).alias("rule"), i.alias("n"), F.length(z["b"]).alias("gap"), F.length(z["w"]).alias("length"), (F.length(z["g"]) >= rule.least).alias("good")))
    return F.when(F.rlike(text, pattern), zipped).otherwise(no_matches())


def spans(found: DataFrame) -> DataFrame:
    """``DOC, spans``: sorted (start, rule, end) of the matches long enough, from rows of single matches."""
    order = Window.partitionBy(*DOC, "rule").orderBy("n").rowsBetween(Window.unboundedPreceding, 0)
    ends = found.dropDuplicates([*DOC, "rule", "n"]).withColumn("end", F.sum(F.col("gap") + F.col("length")).over(order)).filter("good")
    return ends.groupBy(*DOC).agg(F.sort_array(F.collect_list(F.struct((F.col("end") - F.col("length")).alias("start"), "rule", "end"))).alias("spans"))


def _count(spans: str, rule: int) -> Column:
    return F.size(F.filter(spans, lambda s: s["rule"] == rule)).cast("long")


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> DataFrame:
    """``doc_id``, ``n_<kind>`` of the first ``base`` rules, ``base_sha256`` and ``spans`` per document."""
    queries = {i: trigram_query(r.pattern) for i, r in enumerate(rules)}
    indexed = {i: q for i, q in queries.items() if q}
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    key = doc_key(texts)

    everywhere = [matches(F.col("text"), i, rules[i]) for i in queries if i not in indexed]
    chosen = [F.when(F.col("rules").bitwiseAND(F.lit(1 << i)) != 0, matches(F.col("text"), i, rules[i])).otherwise(no_matches()) for i in indexed]
    full = written(texts.select(*key, F.col("doc_id").cast("long").alias("doc_id"), F.flatten(F.array(no_matches(), *everywhere)).alias("found")), "full-scans")
    index = written(postings(texts, sorted({t for q in indexed.values() for s in q for t in s})), "postings")
    # A table of known size: while the candidates are few they go to the texts, and no text moves.
    left = written(candidates(index, indexed), "candidates")
    checked = texts.select(*key, "text").join(left, DOC).select(*DOC, F.flatten(F.array(no_matches(), *chosen)).alias("found"))
    single = full.select(*DOC, F.explode("found").alias("m")).unionByName(checked.select(*DOC, F.explode("found").alias("m"))).select(*DOC, "m.*")
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    text = lambda s: F.concat_ws(":", F.element_at(kinds, s["rule"] + 1), s["start"].cast("string"), s["end"].cast("string"))
    listed = F.coalesce("spans", F.array().cast("array<struct<start:bigint,rule:int,end:bigint>>"))
    rows = full.select(*DOC, "doc_id").join(spans(single), DOC, "left").select("doc_id", listed.alias("spans"))
    first = F.filter("spans", lambda s: s["rule"] < base)
    return rows.select(
        "doc_id", *[_count("spans", i).alias(f"n_{rules[i].kind}") for i in range(base)],
        F.sha2(F.array_join(F.transform(first, text), ",").cast("binary"), 256).alias("base_sha256"), F.array_join(F.transform("spans", text), ",").alias("spans"))
