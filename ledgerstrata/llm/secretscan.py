"""Secret scans: a trigram inverted index names candidate texts for each rule, and the rules verify them.

Everything is a Spark expression. Texts are known by the MD5 of their content, so copies are one entry of the index.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored
from .trigrams import ANY, of_regex

#: Distinct texts of one block of the index, about: the longest posting list a task intersects.
BLOCK = 4096
#: Candidates are broadcast up to this many (about 20 MB); beyond it they are joined by a shuffle.
BROADCAST_CANDIDATES = 150_000
#: Matches whose places are summed in one go; more are done in chunks, so that very many stay linear.
CHUNK = 256


@dataclass(frozen=True)
class Rule:
    """Matches of `pattern`, leftmost and apart, whose `group` has at least `least` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base rules, in the order of their kinds. Lengths inside a pattern spare matches that fail anyway.
BASE = [
    Rule("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", 0, 20),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
]
#: Further public token forms: they only add spans.
MORE = [
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("url", r"://[A-Za-z0-9._~%-]{1,64}:[A-Za-z0-9._~%!$&*+-]{4,64}@"),
]
RULES = BASE + MORE

SPAN = "struct<start: bigint, place: int, kind: string, end: bigint>"


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """`use(value)` with the value computed once."""
    return F.transform(F.array(value), use)[0]


def _total(items: Column) -> Column:
    return F.aggregate(items, F.lit(0).cast("bigint"), lambda acc, m: acc + m["gap"] + m["size"])


def _walk(items: Column, base: Column, place: int, kind: str) -> Column:
    """Spans of a chunk of matches that begins at `base`."""
    start = F.struct(base.alias("at"), F.array().cast(f"array<{SPAN}>").alias("made"))

    def step(acc: Column, m: Column) -> Column:
        begin, end = acc["at"] + m["gap"], acc["at"] + m["gap"] + m["size"]
        span = F.struct(begin.alias("start"), F.lit(place).alias("place"), F.lit(kind).alias("kind"), end.alias("end"))
        made = F.when(m["good"], F.array_append(acc["made"], span)).otherwise(acc["made"])
        return F.struct(end.alias("at"), made.alias("made"))

    return F.aggregate(items, start, step, lambda acc: acc["made"])


def spans_of(text: Column, rule: Rule, place: int) -> Column:
    """All spans of one rule in a text, in code points: lengths of matches and of the text between them, summed up."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)

    def items(matches: Column) -> Column:
        gaps = F.slice(between, F.lit(1), F.size(matches))
        sized = F.zip_with(matches, judged, lambda m, g: F.struct(
            F.length(m).cast("bigint").alias("size"), (F.length(g) >= rule.least).alias("good")))
        return F.zip_with(gaps, sized, lambda p, m: F.struct(
            F.length(p).cast("bigint").alias("gap"), m["size"].alias("size"), m["good"].alias("good")))

    def chunked(all_items: Column) -> Column:
        count = F.ceil(F.size(all_items) / F.lit(CHUNK)).cast("int")
        chunks = F.transform(F.sequence(F.lit(0), count - 1), lambda c: F.slice(all_items, c * CHUNK + 1, F.lit(CHUNK)))
        return _let(chunks, lambda cs: _let(F.transform(cs, _total), lambda totals: F.flatten(F.transform(
            cs, lambda c, i: _walk(c, _sum_before(totals, i), place, rule.kind)))))

    none = F.array().cast(f"array<{SPAN}>")
    made = _let(_let(found, items), lambda m: F.when(F.size(m) > 0, chunked(m)).otherwise(none))
    return F.when(F.rlike(text, pattern), made).otherwise(none)


def _sum_before(totals: Column, i: Column) -> Column:
    return F.aggregate(F.slice(totals, F.lit(1), i), F.lit(0).cast("bigint"), lambda acc, t: acc + t)


def vocabulary(rules: list[Rule]) -> list[str]:
    """All trigrams that the rules' queries ask for."""
    return sorted({g for r in rules for alternative in of_regex(r.pattern) for g in alternative})


def index(texts: DataFrame, grams: list[str]) -> DataFrame:
    """The inverted index: rows (block, postings), postings being a map from trigram number to text keys.

    Only trigrams that some query asks for are indexed; the others of a text would be of no use. A text belongs to one
    block by its key, so that queries are answered block by block and no posting list is longer than a block.
    """
    held = F.array_compact(F.array(*(F.when(F.contains("folded", F.lit(g)), F.lit(i)) for i, g in enumerate(grams))))
    folded = texts.select("k", F.lower("text").alias("folded"))
    forward = stored(folded.select("k", held.alias("grams")).where(F.size("grams") > 0).distinct())
    blocks = max(1, -(-forward.count() // BLOCK))
    pairs = forward.select(F.pmod(F.xxhash64("k"), F.lit(blocks)).alias("block"), "k", F.explode("grams").alias("gram"))
    postings = pairs.repartition("block").groupBy("block", "gram").agg(F.collect_list("k").alias("keys"))
    entries = F.collect_list(F.struct("gram", "keys"))
    return postings.groupBy("block").agg(F.map_from_entries(entries).alias("postings"))


def _intersected(postings: Column, wanted: list[int]) -> Column:
    """Keys in all wanted posting lists, the shortest list first."""
    none = F.array().cast("array<string>")
    lists = F.array(*(F.coalesce(F.try_element_at(postings, F.lit(g)), none) for g in wanted))
    ordered = F.array_sort(lists, lambda a, b: F.size(a) - F.size(b))
    return _let(ordered, lambda ls: F.aggregate(F.slice(ls, F.lit(2), F.size(ls)), ls[0], F.array_intersect))


def candidates(inverted: DataFrame, rules: list[Rule], grams: list[str]) -> DataFrame:
    """Rows (k, mask): texts that meet the trigram query of one rule or more, with a bit for each such rule."""
    number = {g: i for i, g in enumerate(grams)}
    asked = []
    for bit, rule in enumerate(rules):
        query = of_regex(rule.pattern)
        if query != ANY:
            met = [_intersected(F.col("postings"), sorted(number[g] for g in alternative)) for alternative in query]
            asked.append(F.struct(F.lit(1 << bit).cast("bigint").alias("bit"), F.array_distinct(F.concat(*met)).alias("keys")))
    hits = inverted.select(F.explode(F.array(*asked)).alias("a")).select("a.bit", F.explode("a.keys").alias("k"))
    return hits.groupBy("k").agg(F.bit_or("bit").alias("mask"))


def scan(docs: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """Find the spans of all rules in every whole text.

    Returns doc_id and spans, an array of (start, place, kind, end) in code points, end exclusive, ordered by start and
    then by the order of the rules (`place`). A null or empty text has no spans. Repeated rows, null ids and copies are
    answered row by row; ties cannot occur, as spans of one kind do not overlap. Texts of any length are searched whole.
    Other columns are not read, whatever their names. An empty table gives no rows.

    Each pattern is turned into a Boolean trigram query; postings are intersected, and only texts that meet the query
    are searched. Rules without a mandatory trigram search every text. Patterns keep to what Java and Python regular
    expressions share.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    keyed = texts.select("*", F.md5("text").alias("k"))
    grams = vocabulary(rules)
    full = sum(1 << bit for bit, rule in enumerate(rules) if of_regex(rule.pattern) == ANY)
    if grams:
        named = stored(candidates(index(keyed, grams), rules, grams))
        side = F.broadcast(named) if named.count() <= BROADCAST_CANDIDATES else named
        keyed = keyed.join(side, "k", "left").withColumn("mask", F.coalesce("mask", F.lit(0)))
    else:
        keyed = keyed.withColumn("mask", F.lit(0))
    none = F.array().cast(f"array<{SPAN}>")
    per_rule = [
        spans_of(F.col("text"), rule, place) if full >> place & 1
        else F.when(F.col("mask").bitwiseAND(1 << place) != 0, spans_of(F.col("text"), rule, place)).otherwise(none)
        for place, rule in enumerate(rules)
    ]
    return keyed.select("doc_id", F.array_sort(reduce(F.concat, per_rule)).alias("spans"))


def listed(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def digest(found: DataFrame) -> DataFrame:
    """Counts and digests of the base kinds, and all spans as text."""

    def number(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    counts = [number(rule.kind) for rule in BASE]
    fixed = F.sha2(listed(F.filter("spans", lambda s: s["place"] < len(BASE))), 256)
    return found.select("doc_id", *counts, fixed.alias("base_sha256"), listed(F.col("spans")).alias("spans"))
