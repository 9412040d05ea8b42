"""Secret scans with a trigram inverted index, in DataFrame operations only.

Each rule's regex gives a Boolean query over the trigrams that a match must hold; the index lists, for each trigram of any query, the keys of the texts that hold it (A-Z lower-cased); a rule's candidates are what its query leaves of these lists, and only they are searched with the regex itself. A rule whose regex has no mandatory trigram searches every text. Lists of trigrams that no query names would never be read, and are not made.

A text's key is a hash of the text, so copies share their entries, rows need no identity of their own, and two texts with one key can only make a candidate too many.

Defined results: a null text counts as empty; null and repeated ids are kept as they are; repeated rows get equal results; texts are searched whole; other columns are ignored.
"""

from __future__ import annotations

import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Scratch, lower_ascii

Query = tuple  # ("all",) | ("gram", text) | ("and", queries) | ("or", queries)
ALL: Query = ("all",)
#: Strings that a part of a regex may stand for before its trigrams are taken.
MOST_STRINGS = 96


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


@dataclass(frozen=True)
class Rule:
    kind: str
    regex: str
    group: int = 0  # the group whose length counts
    least: int = 0  # its least length
    base: bool = True


# The base kinds, and more kinds of public token formats.
RULES = (
    Rule("assign", "(" + "|".join(map(either_case, ("password", "passwd", "secret", "token"))) + "|" + either_case("api") + "_?" + either_case("key") + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", "AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", "[0-9a-f]+", 0, 32),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", base=False),
    Rule("forge", "gh[pousr]_[A-Za-z0-9]+", 0, 40, False),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]+", 0, 15, False),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 40, False),
)


def _both(*queries: Query) -> Query:
    parts = list(dict.fromkeys(q for q in queries if q != ALL))
    return ALL if not parts else parts[0] if len(parts) == 1 else ("and", tuple(parts))


def _any(queries) -> Query:
    parts = list(dict.fromkeys(queries))
    plain = lambda q: q[0] == "gram" or q[0] == "and" and all(x[0] == "gram" for x in q[1])
    weaker = lambda p, q: p != q and plain(p) and plain(q) and grams_of(p) < grams_of(q)
    parts = [q for q in parts if not any(weaker(p, q) for p in parts)]  # what asks for more than another adds nothing
    return ALL if not parts or ALL in parts else parts[0] if len(parts) == 1 else ("or", tuple(parts))


def _grams(strings) -> Query:
    return _any(_both(*(("gram", s[i : i + 3]) for i in range(len(s) - 2))) for s in sorted(strings))


def trigram_query(regex: str) -> Query:
    """What the lower-cased text of a match must hold."""

    def walk(items) -> tuple[set | None, Query]:
        """The strings that the items stand for (None: too many or unknown), and a query for what comes before them."""
        now, query = {""}, ALL
        for op, arg in items:
            strings, own = node(str(op), arg)
            query = _both(query, own)
            if strings is None or len(now) * len(strings) > MOST_STRINGS:
                query, now = _both(query, _grams(now)), {""}
                if strings is None:
                    continue
            now = {a + b for a, b in product(now, strings)}
        return now, query

    def closed(items) -> tuple[set | None, Query]:
        """As walk(), but None if anything in the items is unknown."""
        items = list(items)
        for op, arg in items:
            if node(str(op), arg)[0] is None:
                now, query = walk(items)
                return None, _both(query, _grams(now))
        now, query = walk(items)
        return (now, query) if query == ALL else (None, _both(query, _grams(now)))

    def node(op: str, arg) -> tuple[set | None, Query]:
        if op == "LITERAL":
            return {chr(arg).lower()}, ALL
        if op == "IN":
            chars = set()
            for kind, x in arg:
                if str(kind) == "LITERAL":
                    chars.add(chr(x).lower())
                elif str(kind) == "RANGE" and x[1] - x[0] < 8:
                    chars |= {chr(c).lower() for c in range(x[0], x[1] + 1)}
                else:
                    return None, ALL
            return (chars, ALL) if len(chars) <= 8 else (None, ALL)
        if op == "SUBPATTERN":
            return closed(arg[3])
        if op == "BRANCH":
            parts = [closed(x) for x in arg[1]]
            if all(s is not None for s, _ in parts):
                return set().union(*(s for s, _ in parts)), ALL
            return None, _any(_both(q, _grams(s)) if s is not None else q for s, q in parts)
        if op in ("MAX_REPEAT", "MIN_REPEAT"):
            least, most, items = arg
            strings, query = closed(items)
            if (least, most) == (0, 1) and strings is not None:
                return strings | {""}, ALL
            if not least:
                return None, ALL
            return (strings, query) if (least, most) == (1, 1) else (None, _both(query, _grams(strings)) if strings is not None else query)
        return None, ALL

    now, query = walk(parser.parse(regex))
    return _both(query, _grams(now))


def grams_of(query: Query) -> set[str]:
    return {query[1]} if query[0] == "gram" else set() if query == ALL else set().union(*map(grams_of, query[1]))


#: Trigrams in one column of bits.
BITS = 60


def _holds(query: Query, at: dict[str, int]) -> Column:
    if query[0] == "gram":
        i = at[query[1]]
        return F.col(f"bits{i // BITS}").bitwiseAND(F.lit(1 << (i % BITS))) != 0
    parts = [_holds(q, at) for q in query[1]]
    found = parts[0]
    for p in parts[1:]:
        found = found & p if query[0] == "and" else found | p
    return found


def candidates(docs: DataFrame, scratch: Scratch, rules=RULES, text: str = "text") -> DataFrame | None:
    """(key, rules): for each text that a rule's query leaves, the bits of those rules. None: every rule scans all texts."""
    asked = {r.kind: q for r in rules if (q := trigram_query(r.regex)) != ALL}
    grams = sorted(set().union(*map(grams_of, asked.values()))) if asked else []
    if not grams:
        return None
    at = {g: i for i, g in enumerate(grams)}
    low = docs.select(F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("key"), lower_ascii(F.coalesce(F.col(text), F.lit(""))).alias("low"))
    held = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(i)) for g, i in at.items()]))
    postings = scratch.table(low.select("key", F.explode(held).alias("gram")).select("gram", "key"), "postings")
    bits = [F.bit_or(F.when(F.floor(F.col("gram") / BITS) == b, F.expr(f"shiftleft(1L, gram % {BITS})")).otherwise(F.lit(0).cast("long"))).alias(f"bits{b}") for b in range(-(-len(grams) // BITS))]
    left = F.lit(0)
    for i, r in enumerate(rules):
        if r.kind in asked:
            left = left.bitwiseOR(F.when(_holds(asked[r.kind], at), F.lit(1 << i)).otherwise(F.lit(0)))
    return scratch.table(postings.groupBy("key").agg(*bits).select("key", left.alias("rules")).where("rules <> 0"), "candidates")


def _spans(rule: Rule, number: int, found: Column, values: Column, pieces: Column) -> Column:
    """Structs (start, number, end) of a rule's matches, in code points, from the matches and what lies between them."""
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,number:int,end:int>>").alias("spans"))

    def step(s: Column, i: Column) -> Column:
        begin = s["at"] + F.length(F.element_at(pieces, i))
        end = begin + F.length(F.element_at(found, i))
        span = F.array(F.struct(begin.alias("start"), F.lit(number).alias("number"), end.alias("end")))
        return F.struct(end.alias("at"), F.when(F.length(F.element_at(values, i)) >= rule.least, F.concat(s["spans"], span)).otherwise(s["spans"]).alias("spans"))

    return F.when(F.size(found) > 0, F.aggregate(F.sequence(F.lit(1), F.size(found)), start, step)["spans"]).otherwise(start["spans"])


def scan(docs: DataFrame, rules=RULES, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and spans, an array of (start, number, end) in order: the matches of all rules; number: the rule's place in rules."""
    scratch = Scratch(docs.sparkSession, "secrets")
    found = candidates(docs, scratch, rules, text)
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    if found is None:
        rows = rows.withColumn("rules", F.lit(0))
    else:
        rows = rows.withColumn("at", F.xxhash64("text")).join(found, F.col("at") == found["key"], "left").select("doc_id", "text", F.coalesce("rules", F.lit(0)).alias("rules"))
    none = F.array().cast("array<string>")
    for i, r in enumerate(rules):
        full = trigram_query(r.regex) == ALL
        # where all texts are searched, a quick look for a long enough match comes first
        may = F.col("text").rlike(r.regex[:-1] + f"{{{r.least},}}" if full and r.group == 0 and r.least and r.regex.endswith("]+") else r.regex) if full else F.col("rules").bitwiseAND(1 << i) != 0
        rows = rows.withColumn(f"m{i}", F.when(may, F.regexp_extract_all("text", F.lit(r.regex), F.lit(0))).otherwise(none))
    for i, r in enumerate(rules):
        rows = rows.withColumn(f"v{i}", F.when(F.size(f"m{i}") > 0, F.regexp_extract_all("text", F.lit(r.regex), F.lit(r.group))).otherwise(none) if r.group else F.col(f"m{i}"))
        rows = rows.withColumn(f"p{i}", F.when(F.size(f"m{i}") > 0, F.split("text", r.regex, -1)).otherwise(none))
    spans = F.array_sort(F.concat(*[_spans(r, i, F.col(f"m{i}"), F.col(f"v{i}"), F.col(f"p{i}")) for i, r in enumerate(rules)]))
    return rows.select("doc_id", spans.alias("spans"))


def span_text(spans: Column, rules=RULES) -> Column:
    """kind:start:end, comma-joined."""
    kind = lambda x: F.element_at(F.array(*[F.lit(r.kind) for r in rules]), x["number"] + 1)
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", kind(x), x["start"].cast("string"), x["end"].cast("string"))), ",")


def digest(scanned: DataFrame, rules=RULES) -> DataFrame:
    """doc_id, a count for each base kind, a hash of the base spans, and all spans as text."""
    base = [i for i, r in enumerate(rules) if r.base]
    count = lambda i: F.size(F.filter("spans", lambda x: x["number"] == i)).cast("long").alias(f"n_{rules[i].kind}")
    return scanned.select("doc_id", *map(count, base), F.sha2(span_text(F.filter("spans", lambda x: x["number"].isin(base)), rules), 256).alias("base_sha256"), span_text(F.col("spans"), rules).alias("spans"))


def oracle_sql(rules=RULES) -> str:
    """The digest in DuckDB's SQL, by searching every text."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    parts = []
    for i, r in enumerate(rules):
        e = quote(r.regex)
        parts.append(f"SELECT doc_id, n, {i} AS number, {quote(r.kind)} AS kind, i, {str(r.base).lower()} AS base, list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s, length(m[i]) AS l FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM (SELECT doc_id, n, regexp_extract_all(t, {e}) AS m, regexp_extract_all(t, {e}, {r.group}) AS v, string_split_regex(t, {e}) AS p FROM t)) WHERE length(v[i]) >= {r.least}")
    counts = ", ".join(f"CAST(count(*) FILTER (WHERE kind = '{r.kind}') AS BIGINT) AS n_{r.kind}" for r in rules if r.base)
    span = "kind || ':' || CAST(CAST(s AS BIGINT) AS VARCHAR) || ':' || CAST(CAST(s + l AS BIGINT) AS VARCHAR)"
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS n FROM documents),
found AS ({" UNION ALL ".join(parts)})
SELECT t.doc_id, {counts}, sha256(coalesce(string_agg({span}, ',' ORDER BY s, number) FILTER (WHERE base), '')) AS base_sha256,
       coalesce(string_agg({span}, ',' ORDER BY s, number), '') AS spans
FROM t LEFT JOIN found f ON t.n = f.n GROUP BY t.n, t.doc_id"""
