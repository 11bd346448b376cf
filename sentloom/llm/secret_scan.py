"""Secret scans with a trigram inverted index, in DataFrame functions only.

Each rule's regular expression is turned into a Boolean query over lower-cased trigrams: alternatives of sets that
every match must contain (``trigram_query``). The index posts, for every trigram that some query names, the documents
that hold it; postings are intersected set by set, and only the surviving documents are matched against the rule.
Rules without a mandatory trigram scan every document.

A span is found by splitting the text at its matches: the lengths of the pieces and of the matches, summed in
order, give its place in code points.

Defined results: a null text is an empty one and has no span; null and repeated ``doc_id`` values keep one row each;
an empty table gives no row; other columns are ignored. A row is known by its ``doc_id`` and the hash of its text.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

parser = re._parser


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern`` whose ``group`` has ``least`` characters or more."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The base rules. The runs of access and hex end at the same place with or without the bound in the
# pattern, so it leaves out exactly the runs that are too short.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
# Public formats of further credentials.
ADDED = (
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY( BLOCK)?-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35,}"),
    Rule("stripe", r"[sr]k_live_[A-Za-z0-9]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + ADDED

#: Trigrams asked of a document for one alternative; any part of a set that all matches hold is such a set.
MOST_TERMS = 4
#: Alternatives kept while a query is derived; beyond it, literals stop being combined.
MOST_ALTERNATIVES = 64


def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Sets of lower-cased trigrams such that each match of ``pattern`` holds all of one set; None if there are none."""

    def extend(state: set, items) -> set:
        """``state``: pairs of the trigrams so far and the literal run that the next item goes on with."""
        for op, arg in items:
            name = str(op)
            if name == "LITERAL":
                state = {grow(*s, chr(arg).lower()) for s in state}
            elif name == "IN" and all(str(o) == "LITERAL" for o, _ in arg) and len(arg) <= 8:
                state = {grow(*s, chr(c).lower()) for s in state for _, c in arg}
            elif name == "SUBPATTERN":
                state = extend(state, arg[-1])
            elif name == "BRANCH":
                state = set().union(*(extend(state, branch) for branch in arg[1]))
            elif name in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT"):
                low, high, inner = arg
                once = extend(state, inner)
                if (low, high) == (0, 1) and str(inner[0][0]) != "IN":
                    state = state | once
                elif low == 0:
                    state = {(done, "") for done, _ in state}
                else:
                    state = once if high == 1 else {(done, "") for done, _ in once}
            elif name not in ("AT", "ASSERT", "ASSERT_NOT"):
                state = {(done, "") for done, _ in state}
            if len(state) > MOST_ALTERNATIVES:
                state = {(done, "") for done, _ in state}
            if len(state) > MOST_ALTERNATIVES:
                state = {(frozenset.intersection(*(done for done, _ in state)), "")}
        return state

    def grow(done: frozenset, run: str, char: str) -> tuple[frozenset, str]:
        run = (run + char)[-3:]
        return (done | {run} if len(run) == 3 else done), run

    sets = {done for done, _ in extend({(frozenset(), "")}, parser.parse(pattern))}
    if frozenset() in sets:
        return None
    # Those with the fewest common letters are the most selective.
    sets = {frozenset(sorted(s, key=lambda t: (sum(c in "etaoinsrh -" for c in t), t))[:MOST_TERMS]) for s in sets}
    return sorted((s for s in sets if not any(t < s for t in sets)), key=sorted)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("key", F.xxhash64("text"))


def _beside(df: DataFrame) -> tuple[DataFrame, Column]:
    """``df`` with its row names out of the way, and the condition that joins it by them."""
    renamed = df.withColumnsRenamed({"doc_id": "_doc", "key": "_key"})
    return renamed, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("key") == F.col("_key"))


def postings(keyed: DataFrame, trigrams: list[str]) -> DataFrame:
    """``trigram, doc_id, key`` for the given trigrams, whatever the case of their letters in the text."""
    lowered = keyed.select("doc_id", "key", F.lower("text").alias("lowered"))
    held = F.array_compact(F.array(*(F.when(F.contains("lowered", F.lit(t)), F.lit(t)) for t in trigrams)))
    return lowered.select(F.explode(held).alias("trigram"), "doc_id", "key")


def candidates(keyed: DataFrame, queries: dict[int, list[frozenset[str]]]) -> DataFrame:
    """``doc_id, key, rules``: the bits of the rules whose trigram query a document satisfies."""
    spark = keyed.sparkSession
    wanted, whole = [], []
    for number, (rule, terms) in enumerate((r, s) for r, sets in queries.items() for s in sets):
        wanted += [(t, number, 1 << k) for k, t in enumerate(sorted(terms))]
        whole.append((number, (1 << len(terms)) - 1, 1 << rule))
    # Both tables are as large as the rules.
    terms = spark.createDataFrame(wanted, "trigram string, number int, bit long")
    complete = spark.createDataFrame(whole, "number int, bits long, rule long")
    met = (
        postings(keyed, sorted({t for t, _, _ in wanted}))
        .join(F.broadcast(terms), "trigram")
        .groupBy("doc_id", "key", "number")
        .agg(F.bit_or("bit").alias("bits"))
    )
    return met.join(F.broadcast(complete), ["number", "bits"]).groupBy("doc_id", "key").agg(F.bit_or("rule").alias("rules"))


def _pieces(rule: Rule, number: int) -> Column:
    """Lengths around and in the matches of a rule."""
    pattern = F.lit(rule.pattern)

    def lengths(strings: Column) -> Column:
        return F.transform(strings, F.length)

    return F.struct(
        F.lit(number).alias("kind"),
        lengths(F.split("text", rule.pattern, -1)).alias("gaps"),
        lengths(F.regexp_extract_all("text", pattern, F.lit(0))).alias("matches"),
        lengths(F.regexp_extract_all("text", pattern, F.lit(rule.group))).alias("values"),
    )


def secret_spans(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, key, kind, start, end``: every span, kinds as their places in ``rules``; copies of a row count once."""
    keyed = _keyed(docs)
    queries = {k: q for k, r in enumerate(rules) if (q := trigram_query(r.pattern))}
    found = []
    full = [k for k in range(len(rules)) if k not in queries]
    if full:
        parts = F.array_compact(F.array(*(F.when(F.col("text").rlike(rules[k].pattern), _pieces(rules[k], k)) for k in full)))
        found.append(keyed.select("doc_id", "key", F.explode(parts).alias("part")))
    if queries:
        texts = keyed.join(*_beside(candidates(keyed, queries)))
        parts = F.array_compact(
            F.array(
                *(
                    F.when((F.col("rules").bitwiseAND(1 << k) != 0) & F.col("text").rlike(rules[k].pattern), _pieces(rules[k], k))
                    for k in queries
                )
            )
        )
        found.append(texts.select("doc_id", "key", F.explode(parts).alias("part")))
    pieces = found[0] if len(found) == 1 else found[0].unionByName(found[1])
    pieces = pieces.select("doc_id", "key", "part.*").dropDuplicates(["doc_id", "key", "kind"])
    matches = pieces.select("doc_id", "key", "kind", F.posexplode(F.arrays_zip("gaps", "matches", "values"))).filter("col.matches IS NOT NULL")
    so_far = Window.partitionBy("doc_id", "key", "kind").orderBy("pos")
    end = F.sum(F.col("col.gaps") + F.col("col.matches")).over(so_far)
    least = F.element_at(F.array(*(F.lit(r.least) for r in rules)), F.col("kind") + 1)
    return (
        matches.withColumn("end", end)
        .filter(F.col("col.values") >= least)
        .select("doc_id", "key", "kind", (F.col("end") - F.col("col.matches")).alias("start"), "end")
    )


def scan_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES, base: int = len(BASE)) -> DataFrame:
    """One row for each row of ``docs``: spans per base kind, the digest of the base spans, and all spans."""
    spans = secret_spans(docs, rules)
    name = F.element_at(F.array(*(F.lit(r.kind) for r in rules)), F.col("kind") + 1)
    entry = F.struct("start", "kind", F.concat_ws(":", name, "start", "end").alias("said"))

    def joined(which: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(which, entry))), lambda x: x["said"]), ",")

    each = spans.groupBy("doc_id", "key").agg(
        *(F.count_if(F.col("kind") == k).alias(f"n_{rules[k].kind}") for k in range(base)),
        joined(F.col("kind") < base).alias("base_spans"),
        joined(F.lit(True)).alias("spans"),
    )
    return _keyed(docs).select("doc_id", "key").join(*_beside(each), "left").select(
        "doc_id",
        *(F.coalesce(f"n_{rules[k].kind}", F.lit(0).cast("long")).alias(f"n_{rules[k].kind}") for k in range(base)),
        F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )


def without_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """The rows of ``docs`` without a span, all columns kept."""
    spans = _beside(secret_spans(docs, rules).select("doc_id", "key").distinct())[0]
    key = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    return docs.join(spans, F.col("doc_id").cast("long").eqNullSafe(F.col("_doc")) & (key == F.col("_key")), "left_anti")
