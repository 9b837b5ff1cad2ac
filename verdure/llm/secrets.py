"""Secret scan through a trigram inverted index, in DataFrame functions only.

Each rule's regular expression is turned into a Boolean trigram query, an AND of clauses, each an OR of trigram sets: text that
matches holds, in lower case, all trigrams of one set of every clause. The index has postings (trigram, doc_id) of the trigrams that
some query names. Postings are intersected by counting, per document and set, the trigrams found; a document that satisfies
all clauses of a rule is a candidate and the expression runs over its whole text. A rule without mandatory trigrams runs over every text.

Places are code points; a span is (kind, start, end), end exclusive, of the whole match; matches are leftmost and do not overlap
within a kind; where a rule asks for a shortest length, of the match or of a group, shorter ones go after matching.

Cases: a null text is empty; rows of one doc_id share their candidates and are each verified on their own; a null doc_id is a key like others;
an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from re import _constants as C
from re import _parser as P

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import only


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    base: bool = False
    group: int = 0  # whose length counts
    least: int = 0


RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", True, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}", True),
    Rule("hex", r"[0-9a-f]{24,}", True),
    Rule("private_key", r"-----BEGIN [A-Z ]{0,24}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)

#: More strings than this are not spelled out.
MOST = 64
Clause = frozenset[frozenset[str]]


def _exact(node) -> set[str] | None:
    """All strings, in lower case, that a parsed node matches, if they are few."""
    op, arg = node
    if op is C.LITERAL:
        return {chr(arg).lower()}
    if op is C.IN:
        out = set()
        for o, a in arg:
            if o is C.LITERAL:
                out.add(chr(a).lower())
            elif o is C.RANGE and a[1] - a[0] < 8:
                out |= {chr(c).lower() for c in range(a[0], a[1] + 1)}
            else:
                return None
        return out if len(out) <= 8 else None
    if op is C.SUBPATTERN:
        return _exact_all(arg[3])
    if op is C.BRANCH:
        parts = [_exact_all(x) for x in arg[1]]
        return None if None in parts else set().union(*parts)
    if op in (C.MAX_REPEAT, C.MIN_REPEAT):
        low, high, body = arg
        if (one := _exact_all(body)) is None or high > 8:
            return None
        out, run = set(), {""}
        for n in range(high + 1):
            if n >= low:
                out |= run
            run = {a + b for a in run for b in one}
            if len(out) > MOST or len(run) > MOST:
                return None
        return out
    if op is C.AT:
        return {""}
    return None


def _exact_all(nodes) -> set[str] | None:
    run = {""}
    for x in nodes:
        if (one := _exact(x)) is None or len(run) * len(one) > MOST:
            return None
        run = {a + b for a in run for b in one}
    return run


def _clause(strings: set[str]) -> set[Clause]:
    sets = {frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings}
    sets = {x for x in sets if not any(y < x for y in sets)}  # a set that holds another adds nothing
    return set() if frozenset() in sets or not sets else {frozenset(sets)}


def _clauses(nodes) -> set[Clause]:
    out, run = set(), {""}
    for x in nodes:
        one = _exact(x)
        if one is not None and len(run) * len(one) <= MOST:
            run = {a + b for a in run for b in one}
            continue
        out |= _clause(run)
        run = {""} if one is None else one
        op, arg = x
        if one is None and op is C.SUBPATTERN:
            out |= _clauses(arg[3])
        elif one is None and op in (C.MAX_REPEAT, C.MIN_REPEAT) and arg[0] >= 1:
            out |= _clauses(arg[2])
        elif one is None and op is C.BRANCH:
            parts = [_clauses(p) for p in arg[1]]
            if all(parts):  # one clause of each side, joined by OR
                out.add(frozenset().union(*(min(p, key=len) for p in parts)))
    return out | _clause(run)


def trigram_query(pattern: str) -> list[Clause]:
    """The clauses that hold for every text a pattern matches; none if it has no mandatory trigram."""
    return sorted(_clauses(P.parse(pattern)), key=lambda c: sorted(map(sorted, c)))


def postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """The inverted index: (trigram, doc_id) of the trigrams in the lower-case texts."""
    low = docs.select("doc_id", F.lower("text").alias("low"))
    found = F.array_compact(F.array(*(F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams)))
    return low.select(F.explode(found).alias("trigram"), "doc_id")


def candidates(docs: DataFrame, rules=RULES) -> tuple[DataFrame | None, set[str]]:
    """(doc_id, kinds) of the documents whose postings satisfy a rule's query, and the kinds that have to scan every text."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    full = {k for k, q in queries.items() if not q}
    rows = [(k, c, a, len(alt), len(q), t) for k, q in queries.items() for c, clause in enumerate(q) for a, alt in enumerate(sorted(map(sorted, clause))) for t in alt]
    if not rows:
        return None, full
    fields = ("kind", "clause", "alt", "need", "clauses", "t")
    wanted = docs.sparkSession.range(1).select(F.inline(F.array(*(F.struct(*(F.lit(v).alias(n) for n, v in zip(fields, r))) for r in rows))))
    index = postings(docs, sorted({r[-1] for r in rows}))
    sets = (
        index.join(F.broadcast(wanted), index["trigram"] == wanted["t"])  # the rules' own trigrams: a fixed size
        .groupBy("doc_id", "kind", "clause", "alt")
        .agg(F.countDistinct("trigram").alias("n"), F.first("need").alias("need"), F.first("clauses").alias("clauses"))
        .filter("n = need")
    )
    kinds = sets.groupBy("doc_id", "kind").agg(F.countDistinct("clause").alias("n"), F.first("clauses").alias("clauses")).filter("n = clauses")
    return kinds.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds")), full


def _spans(rule: Rule, order: int) -> Column:
    """Spans of a rule in ``text``, in order: array of (start, place in the list of rules, kind, end)."""
    pattern = F.lit(rule.pattern)
    found = F.regexp_extract_all("text", pattern, F.lit(0))
    counted = F.regexp_extract_all("text", pattern, F.lit(rule.group))
    gaps = F.split("text", rule.pattern, -1)
    each = F.zip_with(F.zip_with(gaps, found, lambda g, m: F.struct(F.length(g).alias("gap"), F.length(m).alias("n"))), counted, lambda x, c: F.struct(x["gap"].alias("gap"), x["n"].alias("n"), F.length(c).alias("c")))
    span = lambda start, n: F.struct(start.alias("start"), F.lit(order).alias("place"), F.lit(rule.kind).alias("kind"), (start + n).alias("end"))
    none = F.array().cast("array<struct<start:int,place:int,kind:string,end:int>>")
    step = lambda acc, x: F.struct(
        (acc["at"] + x["gap"] + F.coalesce(x["n"], F.lit(0))).alias("at"),
        F.when(F.coalesce(x["c"], F.lit(-1)) >= rule.least, F.concat(acc["spans"], F.array(span(acc["at"] + x["gap"], x["n"])))).otherwise(acc["spans"]).alias("spans"),
    )
    return F.aggregate(each, F.struct(F.lit(0).alias("at"), none.alias("spans")), step, lambda acc: acc["spans"])


def scan(docs: DataFrame, rules=RULES) -> DataFrame:
    """(doc_id, spans) of every document, spans ordered by start, then by the rules' order."""
    docs = only(docs, "doc_id", "text").select(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found, full = candidates(docs, rules)
    if found is None:
        rows = docs.withColumn("kinds", F.lit(None).cast("array<string>"))
    else:
        found = found.withColumnRenamed("doc_id", "candidate")
        rows = docs.join(found, docs["doc_id"].eqNullSafe(found["candidate"]), "left").select("doc_id", "text", "kinds")
    none = F.array().cast("array<struct<start:int,place:int,kind:string,end:int>>")
    parts = []
    for n, r in enumerate(rules):
        test = F.rlike("text", F.lit(r.pattern))
        if r.kind not in full:
            test = F.coalesce(F.array_contains("kinds", F.lit(r.kind)), F.lit(False)) & test
        parts.append(F.when(test, _spans(r, n)).otherwise(none))
    return rows.select("doc_id", F.array_sort(F.concat(*parts)).alias("spans"))


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def digest(scanned: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, a count for each base kind, the sha256 of the base spans as text, and all spans as text."""
    base = [r.kind for r in rules if r.base]
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    return scanned.select("doc_id", *map(count, base), F.sha2(_written(F.filter("spans", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"), _written(F.col("spans")).alias("spans"))


def digest_sql(rules=RULES) -> str:
    """The same by DuckDB, without an index."""
    q = lambda s: s.replace("'", "''")
    cols, lists = [], []
    for n, r in enumerate(rules):
        p = q(r.pattern)
        cols.append(f"regexp_extract_all(t, '{p}', 0) AS m{n}, regexp_extract_all(t, '{p}', {r.group}) AS c{n}, string_split_regex(t, '{p}') AS g{n}")
        start = f"list_sum(list_transform(g{n}[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m{n}[1:i-1], lambda x: length(x))), 0)"
        lists.append(f"[{{'start': CAST({start} AS BIGINT), 'place': {n}, 'kind': '{r.kind}', 'end': CAST({start} + length(m{n}[i]) AS BIGINT)}} for i in range(1, len(m{n}) + 1) if length(c{n}[i]) >= {r.least}]")
    base = [r.kind for r in rules if r.base]
    kinds = ", ".join(f"'{k}'" for k in base)
    text = lambda where: f"array_to_string(list_transform({where}, lambda s: s.kind || ':' || s.start || ':' || s.end), ',')"
    return f"""
        WITH f AS (SELECT doc_id, {', '.join(cols)} FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
        s AS (SELECT doc_id, list_sort({' || '.join(lists)}) AS spans FROM f)
        SELECT doc_id, {', '.join(f"CAST(len(list_filter(spans, lambda s: s.kind = '{k}')) AS BIGINT) AS n_{k}" for k in base)},
            sha256({text(f"list_filter(spans, lambda s: s.kind IN ({kinds}))")}) AS base_sha256, {text("spans")} AS spans FROM s"""


def brute(text: str | None, rules=RULES) -> list[tuple[int, int, str, int]]:
    """Spans of one text by Python's expressions, for tests."""
    out = []
    for n, r in enumerate(rules):
        out += [(m.start(), n, r.kind, m.end()) for m in re.finditer(r.pattern, text or "") if len(m[r.group]) >= r.least]
    return sorted(out)
