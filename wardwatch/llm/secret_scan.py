"""Secret scans over a trigram inverted index, with DataFrame functions only.

From each rule's pattern a Boolean trigram query is derived: any match holds
all trigrams of at least one of its alternatives. The index maps a trigram to
the documents that contain it (letters folded); it holds the trigrams that
some rule asks for. A rule's candidates are the documents in the intersection
of its postings, and only they are verified with the pattern. A rule without a
mandatory trigram is verified on every document, in the scan of the documents
itself.

Spans come from ``split`` (the text between matches) and ``regexp_extract_all``
(the matches): their lengths in code points add up to the starts and ends.

Scale: postings are (trigram, document key) pairs, the key a 128-bit digest of
id and text, so repeated rows share one key. The intersection is an
aggregation by key. One shuffle join tells each text which rules name it as a
candidate; that is the only shuffle of texts. No Python runs on the executors.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAX_STRINGS = 64        # alternatives that a query may have before it is weakened
SPAN = "array<struct<start:int,ord:int,stop:int,kind:string>>"


@dataclass(frozen=True)
class Rule:
    """A kind of secret: leftmost non-overlapping matches of ``pattern``
    (syntax common to Python and Java) whose ``group`` has ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# fixed values: the three base rules, then rules with a distinctive prefix that the scan adds
RULES = [
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", r"[0-9a-f]+", 0, 24),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
]
BASE = ("assign", "access", "hex")


# --- trigram queries ----------------------------------------------------------------------

def trigram_query(pattern: str) -> list[list[str]]:
    """Alternatives of trigrams (lower case): every match contains all of one alternative.

    Empty if the pattern has no mandatory trigram.
    """
    strings, need = _walk(re._parser.parse(pattern))
    need = _both(need, _grams(strings))
    return [] if frozenset() in need else sorted(sorted(x) for x in _least(need))


def _grams(strings: set[str]) -> set[frozenset]:
    return {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}


def _least(need: set[frozenset]) -> set[frozenset]:
    """Without alternatives that another one implies."""
    return {x for x in need if not any(y < x for y in need)}


def _both(a: set[frozenset], b: set[frozenset]) -> set[frozenset]:
    """Both queries hold; the weaker statement where that has too many alternatives."""
    both = _least({x | y for x, y in product(a, b)})
    return both if len(both) <= MAX_STRINGS else min(a, b, key=len)


def _walk(items) -> tuple[set[str], set[frozenset]]:
    """(strings, need): a match ends in one of the strings, and what came before them implies ``need``."""
    strings, need = {""}, {frozenset()}
    for op, arg in items:
        name = str(op)
        more = None
        if name == "LITERAL":
            more = {chr(arg).lower()}
        elif name == "IN":
            more = _class(arg)
        elif name == "SUBPATTERN":
            inner, before = _walk(arg[-1])
            more, need = (inner, need) if before == {frozenset()} else (None, _both(need, _both(before, _grams(inner))))
        elif name == "BRANCH":
            parts = [_walk(x) for x in arg[1]]
            if all(before == {frozenset()} for _, before in parts):
                more = set().union(*(s for s, _ in parts))
            else:
                need = _both(need, set().union(*(_both(before, _grams(s)) for s, before in parts)))
        elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
            least, most, body = arg
            inner, before = _walk(body)
            if most == 1 and before == {frozenset()}:
                more = inner | ({""} if least == 0 else set())
            elif least:
                need = _both(need, _both(before, _grams(inner)))
        elif name in ("AT", "ASSERT", "ASSERT_NOT"):
            continue
        if more and len(more) * len(strings) <= MAX_STRINGS:
            strings = {a + b for a, b in product(strings, more)}
        else:       # what follows cannot be told: the run of known characters ends
            need, strings = _both(need, _grams(strings)), more if more and len(more) <= MAX_STRINGS else {""}
    return strings, need


def _class(members) -> set[str] | None:
    """The characters of a small class, else None."""
    found: set[str] = set()
    for op, arg in members:
        if str(op) == "LITERAL":
            found.add(chr(arg).lower())
        elif str(op) == "RANGE" and arg[1] - arg[0] < 4:
            found.update(chr(c).lower() for c in range(arg[0], arg[1] + 1))
        else:
            return None
    return found if len(found) <= 4 else None


# --- the scan -------------------------------------------------------------------------------

def _none() -> Column:
    return F.array().cast(SPAN)


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """row (all columns of ``docs``), text ('' for null), key (128-bit digest of id and text)."""
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    one = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("")), text)
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), text.alias("text"),
                       F.md5(one.cast("binary")).alias("key"))


def trigram_index(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(gram, key): the postings of every trigram that a rule asks for, over all ``docs``."""
    grams = sorted({g for r in rules for alternative in trigram_query(r.pattern) for g in alternative})
    known = F.array(*map(F.lit, grams)).cast("array<string>")
    # the lower-cased text is bound once, then looked through for each trigram
    found = F.transform(F.array(F.lower("text")), lambda t: F.filter(known, lambda g: F.contains(t, g)))[0]
    return _keyed(docs, id_col, text_col).select("key", F.explode(found).alias("gram")).select("gram", "key")


def candidates(index: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """(key, kinds): the documents in the intersected postings of each rule that has trigrams."""
    def asks(rule: Rule) -> Column:
        ways = [F.size(F.array_except(F.array(*map(F.lit, way)), "grams")) == 0 for way in trigram_query(rule.pattern)]
        return F.when(_any(ways), F.lit(rule.kind))

    having = [r for r in rules if trigram_query(r.pattern)]
    by_key = index.groupBy("key").agg(F.collect_set("gram").alias("grams"))
    kinds = F.array_compact(F.array(*map(asks, having)).cast("array<string>"))
    return by_key.select("key", kinds.alias("kinds")).where(F.size("kinds") > 0)


def _any(tests: list[Column]) -> Column:
    out = F.lit(False)
    for t in tests:
        out = out | t
    return out


def _spans(text: Column, rule: Rule, order: int) -> Column:
    """The rule's spans in ``text``: leftmost non-overlapping matches, then those too short dropped."""
    pattern = _java(rule)

    def build() -> Column:
        parts = F.struct(F.split(text, pattern, -1).alias("between"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
                         F.regexp_extract_all(text, F.lit(pattern), F.lit(rule.group)).alias("part"))
        start = F.struct(F.lit(0).alias("at"), _none().alias("out"))

        def step(p):
            def add(acc, i):
                begin = acc["at"] + F.length(p["between"][i])
                stop = begin + F.length(p["match"][i])
                span = F.struct(begin.alias("start"), F.lit(order).alias("ord"), stop.alias("stop"), F.lit(rule.kind).alias("kind"))
                more = F.when(F.length(p["part"][i]) >= rule.least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
                return F.struct(stop.alias("at"), more.alias("out"))
            return add

        # the matches are bound once as a lambda variable
        return F.transform(F.array(parts), lambda p: F.aggregate(
            F.sequence(F.lit(0), F.size(p["match"]) - 1), start, step(p), lambda acc: acc["out"]))[0]

    return F.when(F.rlike(text, F.lit(pattern)), build()).otherwise(_none())


def _java(rule: Rule) -> str:
    """The rule's pattern; a lone run of a class asks for its least length at once, with the same spans."""
    run = re.fullmatch(r"(\[[^\]]+\])\+", rule.pattern)
    return f"{run[1]}{{{rule.least},}}" if run and rule.group == 0 else rule.pattern


def _scan(docs: DataFrame, rules: list[Rule], id_col: str, text_col: str) -> DataFrame:
    """row, text, spans: the scan, with all columns of ``docs`` in ``row``."""
    scanned = [(i, r) for i, r in enumerate(rules) if not trigram_query(r.pattern)]
    indexed = [(i, r) for i, r in enumerate(rules) if trigram_query(r.pattern)]
    keyed, text = _keyed(docs, id_col, text_col), F.col("text")
    found = [_spans(text, r, i) for i, r in scanned]
    if indexed:
        named = candidates(trigram_index(docs, rules, id_col, text_col), rules)
        keyed = keyed.join(named, "key", "left")
        found += [F.when(F.array_contains("kinds", r.kind), _spans(text, r, i)).otherwise(_none()) for i, r in indexed]
    return keyed.select("row", "text", F.array_sort(F.concat(_none(), *found)).alias("spans"))


def scan_secrets(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, spans): ``spans`` an array of (start, ord, stop, kind) in code points, stop
    exclusive, sorted by start, then by the order of ``rules``; one row per row of ``docs``.

    A null text counts as empty and comes back empty. Null and repeated ids and
    repeated rows keep their rows. No row or no secret: no row or no span.
    Other columns are not read.
    """
    only = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    return _scan(only, rules, "doc_id", "text").select("row.doc_id", "text", "spans")


def digest(spans: Column) -> Column:
    """kind:start:end of the spans in their order, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["stop"])), ",")


def secret_report(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, counts and SHA-256 of the base spans, and all spans as text; see :func:`scan_secrets`."""
    found = scan_secrets(docs, rules, id_col, text_col)
    of = lambda kind: F.filter("spans", lambda s: s["kind"] == kind)
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE))
    return found.select("doc_id", *[F.size(of(k)).cast("long").alias(f"n_{k}") for k in BASE],
                        F.sha2(digest(base).cast("binary"), 256).alias("base_sha256"), digest(F.col("spans")).alias("spans"))


def redact_secrets(docs: DataFrame, rules: list[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text",
                   mask: str = "[SECRET]") -> DataFrame:
    """``docs`` with the spans of secrets replaced by ``mask``; all rows and columns kept.

    Overlapping spans are masked as one. A text without a secret, or null, is
    unchanged; a column ``n_chars`` is set to the new length where the text changed.
    """
    def step(acc, s):
        piece = F.substring(F.col("text"), acc["at"] + 1, s["start"] - acc["at"])
        return (F.when(s["start"] >= acc["at"], F.struct(s["stop"].alias("at"), F.concat(acc["out"], F.array(piece, F.lit(mask))).alias("out")))
                .otherwise(F.struct(F.greatest(acc["at"], s["stop"]).alias("at"), acc["out"].alias("out"))))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))
    rest = lambda acc: F.concat(acc["out"], F.array(F.substring(F.col("text"), acc["at"] + 1, F.length("text"))))
    masked = F.array_join(F.aggregate("spans", start, step, rest), "")
    found = _scan(docs, rules, id_col, text_col).withColumn("masked", F.when(F.size("spans") > 0, masked))
    own = {text_col: F.coalesce("masked", F.col("row")[text_col])}
    if "n_chars" in docs.columns:
        own["n_chars"] = F.when(F.col("masked").isNull(), F.col("row")["n_chars"]).otherwise(
            F.length("masked").cast(docs.schema["n_chars"].dataType))
    return found.select(*[own.get(c, F.col("row")[c]).alias(c) for c in docs.columns])
