"""Secret scans over a trigram inverted index, in DataFrame functions only.

From each rule's regular expression a Boolean trigram query is derived: an OR of sets of trigrams,
one of which must be in a matching text. The index posts every document under the query trigrams
that it holds; postings are intersected per set, and only documents that satisfy a query are
verified with that rule's expression. Rules without mandatory trigrams scan every text.

Candidates are a few documents, but their ids have no size bound. A fixed-size Bloom filter of them
is what is broadcast; texts it rules out never move, the others are joined with the candidates.

Defined results: NULL and empty texts have no spans; whole texts of any length are scanned; rows
with equal ids are scanned one by one (their postings are merged, which only adds candidates); a
NULL id is an id of its own; an empty table gives an empty table; other columns are not read.
"""
from __future__ import annotations

import itertools
from re import _constants as node
from re import _parser as parser
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lagwise.llm import bitmap
from lagwise.llm.common import column, packed, pick
from lagwise.sources.layers import staged


class Rule(NamedTuple):
    """Leftmost non-overlapping matches, of which those with a short ``group`` are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The three base rules, then published formats of access tokens and keys.
BASE = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
                   r"([A-Za-z0-9+/_.=-]+)", group=2, least=6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
RULES = BASE + (
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

#: Strings and clauses up to which a query is worked out; beyond, a weaker query is used.
_MOST_STRINGS, _MOST_CLAUSES, _MOST_LETTERS = 64, 64, 6
Query = frozenset  # of clauses, each a frozenset of trigrams; the empty clause is always true
ALWAYS: Query = frozenset({frozenset()})


def _grams(text: str) -> frozenset:
    return frozenset(text[i:i + 3] for i in range(len(text) - 2))


def _absorbed(clauses) -> Query:
    """Without clauses that another clause already implies."""
    return frozenset(c for c in clauses if not any(d < c for d in clauses))


def _both(a: Query, b: Query) -> Query:
    if len(a) * len(b) > _MOST_CLAUSES:
        return min(a, b, key=lambda q: (q == ALWAYS, len(q)))
    return _absorbed({x | y for x, y in itertools.product(a, b)})


def _of_strings(strings: set[str]) -> Query:
    return _absorbed({_grams(s) for s in strings})


def _letters(items) -> set[str] | None:
    """The characters of a class in lower case, None if it is negated or large."""
    found: set[str] = set()
    for op, value in items:
        if op is node.LITERAL:
            found.add(chr(value).lower())
        elif op is node.RANGE and value[1] - value[0] < 2 * _MOST_LETTERS:
            found |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return found if len(found) <= _MOST_LETTERS else None


def _exact(op, value) -> set[str] | None:
    """All strings (lower case) that a part of a pattern matches, None if they are too many."""
    if op is node.LITERAL:
        return {chr(value).lower()}
    if op is node.IN:
        return _letters(value)
    if op is node.SUBPATTERN:
        return _exact_all(value[3])
    if op is node.BRANCH:
        parts = [_exact_all(branch) for branch in value[1]]
        return None if None in parts else set().union(*parts)
    if op in (node.MAX_REPEAT, node.MIN_REPEAT):
        least, most, inner = value
        once = _exact_all(inner)
        if once is None or most is node.MAXREPEAT or most > 3 or len(once) ** most > _MOST_STRINGS:
            return None
        return {"".join(p) for n in range(least, most + 1) for p in itertools.product(once, repeat=n)}
    return {""} if op is node.AT else None


def _exact_all(parts) -> set[str] | None:
    strings = {""}
    for op, value in parts:
        more = _exact(op, value)
        if more is None or len(strings) * len(more) > _MOST_STRINGS:
            return None
        strings = {a + b for a in strings for b in more}
    return strings


def _query(parts) -> Query:
    """What any text that matches the sequence must hold."""
    query, strings = ALWAYS, {""}
    for op, value in parts:
        more = _exact(op, value)
        if more is not None and len(strings) * len(more) <= _MOST_STRINGS:
            strings = {a + b for a in strings for b in more}
            continue
        query, strings = _both(query, _of_strings(strings)), {""}
        if op is node.SUBPATTERN:
            query = _both(query, _query(value[3]))
        elif op is node.BRANCH:
            query = _both(query, _absorbed(set().union(*(_query(b) for b in value[1]))))
        elif op in (node.MAX_REPEAT, node.MIN_REPEAT) and value[0] > 0:
            query = _both(query, _query(value[2]))
    return _both(query, _of_strings(strings))


def trigram_query(pattern: str) -> Query:
    """Clauses of which one lies wholly in every text that matches, letters in lower case."""
    return _query(parser.parse(pattern))


def scans_fully(rule: Rule) -> bool:
    return frozenset() in trigram_query(rule.pattern)


def spans_of(text: Column, rule: Rule, rank: int, asked: Column | None = None) -> Column:
    """array<struct<start, rank, end, kind>> of the rule's matches, in code points; none where
    ``asked`` is false.

    Matches and the text between them alternate, so a running length gives each place.
    """
    pattern = F.lit(rule.pattern)
    matches = F.regexp_extract_all(text, pattern, F.lit(0))
    groups = F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    steps = F.zip_with(F.zip_with(between, matches, lambda b, m: F.struct(
        F.length(b).alias("skip"), F.length(m).alias("size"))), groups, lambda s, g: F.struct(
            s["skip"].alias("skip"), s["size"].alias("size"), F.length(g).alias("part")))
    none = F.array().cast("array<struct<start:int,rank:int,end:int,kind:string>>")

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + x["skip"]
        span = F.struct(start.alias("start"), F.lit(rank).alias("rank"),
                        (start + x["size"]).alias("end"), F.lit(rule.kind).alias("kind"))
        good = x["size"].isNotNull() & (x["part"] >= rule.least)
        return F.struct((start + F.coalesce(x["size"], F.lit(0))).alias("at"),
                        F.when(good, F.concat(acc["found"], F.array(span))).otherwise(
                            acc["found"]).alias("found"))

    found = F.aggregate(steps, F.struct(F.lit(0).alias("at"), none.alias("found")), step,
                        lambda acc: acc["found"])
    matching = text.rlike(rule.pattern)
    return F.when(matching if asked is None else asked & matching, found).otherwise(none)


def postings(docs: DataFrame, grams: list[str]) -> DataFrame:
    """(doc_id, gram): the inverted index, restricted to the trigrams that queries ask for."""
    low = docs.select("doc_id", F.lower("text").alias("low"))
    held = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in grams)))
    return low.select("doc_id", F.explode(held).alias("gram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame | None:
    """(doc_id, rules): a bit for each rule whose trigram query the document satisfies.

    A document's share of a posting list is one bit of its clause; OR-ing the bits intersects the
    lists, and does so within each task before anything is shuffled.
    """
    clauses = [(bit, sorted(clause)) for bit, rule in enumerate(rules) if not scans_fully(rule)
               for clause in sorted(trigram_query(rule.pattern), key=sorted)]
    if not clauses:
        return None
    wanted: dict[str, list[tuple[int, int]]] = {}
    for number, (_, clause) in enumerate(clauses):
        for place, gram in enumerate(clause):
            wanted.setdefault(gram, []).append((number, 1 << place))
    uses = F.create_map(*itertools.chain.from_iterable(
        (F.lit(gram), F.array(*(F.struct(F.lit(n).alias("clause"), F.lit(b).cast("long").alias("bit"))
                                for n, b in pairs))) for gram, pairs in wanted.items()))
    listed = postings(docs, sorted(wanted)).select("doc_id", F.inline(uses[F.col("gram")]))
    merged = listed.groupBy("doc_id", "clause").agg(F.bit_or("bit").alias("bits"))
    complete = F.array(*(F.lit((1 << len(c)) - 1).cast("long") for _, c in clauses))
    rule_bit = F.array(*(F.lit(1 << bit).cast("long") for bit, _ in clauses))
    return merged.filter(F.col("bits") == complete[F.col("clause")]).groupBy("doc_id").agg(
        F.bit_or(rule_bit[F.col("clause")]).alias("rules"))


def _found(rows: DataFrame, rules: tuple[Rule, ...], mask: Column) -> DataFrame:
    parts = [spans_of(F.col("text"), rule, i, None if scans_fully(rule) else
                      mask.bitwiseAND(1 << i) != 0) for i, rule in enumerate(rules)]
    return rows.withColumn("spans", F.sort_array(F.concat(*parts)))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id",
         text_col: str = "text", keep_rows: bool = False) -> DataFrame:
    """doc_id, text, spans array<struct<start, rank, end, kind>> sorted by start, then by rule.

    ``keep_rows`` adds the whole input row as a struct ``row``.
    """
    rows = pick(docs, id_col, text_col)
    found = candidates(rows, rules)
    if keep_rows:
        rows = docs.select(column(id_col).alias("doc_id"),
                           F.coalesce(column(text_col), F.lit("")).alias("text"),
                           packed(docs).alias("row"))
    none = F.lit(0).cast("long")
    if found is None:
        return _found(rows, rules, none)
    found = staged(found, "secret-candidates")
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit(""))
    marked = bitmap.probe(rows, key, bitmap.build(found, key), "maybe")
    checked = marked.filter("maybe").drop("maybe").join(
        found.select(F.col("doc_id").alias("found_id"), "rules"),
        F.col("doc_id").eqNullSafe(F.col("found_id")), "left")
    checked = _found(checked, rules, F.coalesce("rules", none)).drop("found_id", "rules")
    rest = _found(marked.filter(~F.col("maybe")).drop("maybe"), rules, none)
    return rest.unionByName(checked)


def spelled(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def _number(rank: int) -> Column:
    return F.size(F.filter("spans", lambda s: s["rank"] == rank)).cast("long")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans."""
    found = scan(docs, RULES, id_col, text_col).select("doc_id", "spans")
    base = F.filter("spans", lambda s: s["rank"] < len(BASE))
    counts = [_number(i).alias(f"n_{rule.kind}") for i, rule in enumerate(BASE)]
    return found.select("doc_id", *counts, F.sha2(spelled(base), 256).alias("base_sha256"),
                        spelled(F.col("spans")).alias("spans"))


def redacted(docs: DataFrame, mark: str = "[SECRET]", id_col: str = "doc_id",
             text_col: str = "text", length_col: str | None = None) -> DataFrame:
    """``docs`` with every span of the text replaced by ``mark``; overlapping spans count as one.

    ``length_col`` names a column that holds the length of the text and follows it.
    """
    found = scan(docs, RULES, id_col, text_col, keep_rows=True)

    def step(acc: Column, s: Column) -> Column:
        gap = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] >= acc["at"], F.concat(acc["out"], gap, F.lit(mark))).otherwise(
                acc["out"]).alias("out"))

    clean = F.aggregate("spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")), step,
                        lambda acc: F.concat(acc["out"], F.substring(
                            F.col("text"), acc["at"] + 1, F.length("text"))))
    found = found.withColumn("clean", F.when(F.size("spans") > 0, clean))

    def value(c: str) -> Column:
        own = F.col("row").getField(c)
        if c == text_col:
            return F.coalesce("clean", own)
        if c == length_col:
            return F.coalesce(F.length("clean").cast(docs.schema[c].dataType), own)
        return own

    return found.select(*(value(c).alias(c) for c in docs.columns))
