"""Personal data by bootstrapped contextual extraction, in DataFrame functions only.

Seeds are the base entities: e-mail and IP addresses, card and phone numbers that pass their checks. A pattern is the two
tokens in front of an entity (``phone :``, ``mail to``); what stands behind a pattern anywhere in the corpus are its
fillers: entities, numbers and plain words, each different one a node of the pattern-instance graph. A pattern's score is
the share of its different fillers that are positive: seeds, or identifiers that accepted patterns have discovered.
Patterns of ``SUPPORT`` positive fillers or more and a score of ``SHARE`` % are accepted; the identifier-shaped fillers
(five digits or more) of accepted patterns become positive, which can lift further patterns. Rounds go on until none is
lifted. The occurrences of those identifiers behind accepted patterns, apart from base spans, are the added spans; their kind
is ``near_`` and the kind that most of the pattern's seeds have, the first listed of equals.

A span is found by splitting the text at the matches of its pattern: the lengths of the pieces and of the matches, summed in
order, give its place in code points. The patterns are possessive and do not start inside a run that
has failed already, so matching takes linear time and no deep recursion on any text.

Defined results: a null text is an empty one and has no span; null and repeated ``doc_id`` values keep one row each, copies
count once in the graph; an empty table gives no row; other columns are ignored. A row is known by its ``doc_id`` and the hash of its text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sentloom.session import stage

# Kinds in the order of the results, and their patterns in Java syntax. A run that is followed by the
# wrong character fails from each of its characters, so only its first one, or the end of the last match, begins a match.
# A run of fewer than 16 digits is no card from any of its digits.
BASE = ("email", "ip", "card", "phone")
PATTERNS = (
    r"(?:(?<![A-Za-z0-9._%+-])|\G)[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    r"[0-9](?:[\x20-]?[0-9]){15,}+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)
#: What every match holds, cheaper to look for.
HINTS = ("@", r"[0-9]\.[0-9]", PATTERNS[2], "+")
IP_PARTS = r"\A0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})){3}\z"

#: Numbers, codes and the like: up to eight letters, a digit, and what is joined to it. Those with fewer digits than an
#: identifier fill a slot as plain words do.
CANDIDATE = r"(?<![A-Za-z0-9])[A-Za-z]{0,8}+[0-9](?:[\x20(]?[0-9]|[._%+@:/#()-]{0,2}[A-Za-z0-9])*+"
IDENTIFIER_DIGITS = 5
#: Tokens of a context, and the characters in front of an entity in which its context is sought.
TOKEN = r"[\p{L}\p{N}]++|[:=#]"
REACH = 100
SUPPORT = 3
SHARE = 80
#: Contexts sent to all tasks; more are joined by a shuffle.
SENT_CONTEXTS = 200_000
SENT_BYTES = 16 << 20
#: Parts of the corpus, as its 64th, in which words behind contexts are counted before the whole. The words that a part
#: shows are a lower bound: it settles the contexts that have too many, most of them, and the whole is counted for the rest.
PARTS = (64, 8)

_DOC = ["doc_id", "key"]
_CANDIDATE = len(BASE)


def _keyed(docs: DataFrame) -> DataFrame:
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text")).withColumn("key", F.xxhash64("text"))


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _pieces(kind: int, pattern: str) -> Column:
    """The matches of a pattern with the text in front of each."""
    gaps = F.split("text", pattern, -1)
    matches = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    # The match before stands in front, too, where the gap is short.
    before = F.concat(F.array(F.lit("")), matches)
    return F.struct(
        F.lit(kind).alias("kind"),
        F.transform(
            F.arrays_zip(before.alias("before"), gaps.alias("gap"), matches.alias("value")),
            lambda p: F.struct(
                F.length(p["gap"]).alias("gap"), p["value"].alias("value"), F.right(F.concat(F.right(p["before"], F.lit(REACH)), F.right(p["gap"], F.lit(REACH))), F.lit(REACH)).alias("front")
            ),
        ).alias("parts"),
    )


def context(front: Column) -> Column:
    """The last two tokens of a text in lower case, or null."""
    tokens = F.regexp_extract_all(F.lower(front), F.lit(TOKEN), F.lit(0))
    return F.when(F.size(tokens) >= 2, F.array_join(F.slice(tokens, -2, 2), " "))


def occurrences(docs: DataFrame) -> DataFrame:
    """``doc_id, key, kind, start, end, value, context`` of all valid base matches and of all candidates."""
    text = F.col("text")
    found = [F.contains(text, F.lit(HINTS[0])), text.rlike(HINTS[1]), text.rlike(HINTS[2]), F.contains(text, F.lit(HINTS[3]))]
    parts = [F.when(there, _pieces(k, PATTERNS[k])) for k, there in enumerate(found)]
    parts.append(F.when(text.rlike("[0-9]"), _pieces(_CANDIDATE, CANDIDATE)))
    pieces = _keyed(docs).select(*_DOC, F.explode(F.array_compact(F.array(*parts))).alias("piece")).select(*_DOC, "piece.*")
    each = (
        # The last part is the text behind the last match.
        pieces.filter(F.size("parts") > 1)
        .dropDuplicates([*_DOC, "kind"])
        .select(*_DOC, "kind", F.posexplode("parts").alias("pos", "part"))
        .filter("part.value IS NOT NULL")
    )
    so_far = Window.partitionBy(*_DOC, "kind").orderBy("pos")
    value = F.col("part.value")
    digits = _digits(value)
    valid = (
        F.when(F.col("kind") == 1, value.rlike(IP_PARTS))
        .when(F.col("kind") == 2, F.length(digits).between(16, 19) & F.call_function("luhn_check", digits))
        .when(F.col("kind") == 3, F.length(digits).between(8, 15))
        .otherwise(True)
    )
    return (
        each.withColumn("end", F.sum(F.col("part.gap") + F.length(value)).over(so_far))
        .filter(valid)
        .select(*_DOC, "kind", (F.col("end") - F.length(value)).alias("start"), "end", F.lower(value).alias("value"), context(F.col("part.front")).alias("context"))
    )


def apart(found: DataFrame) -> DataFrame:
    """The base matches, and the candidates that overlap none of them."""
    end = F.when(F.col("kind") < _CANDIDATE, F.col("end"))
    start = F.when(F.col("kind") < _CANDIDATE, F.col("start"))
    order = Window.partitionBy(*_DOC).orderBy("start", "kind")
    behind = F.max(end).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    # In the other order the rows so far are those that begin later, or here.
    ahead = F.min(start).over(Window.partitionBy(*_DOC).orderBy(F.desc("start"), F.desc("kind")).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    free = (F.coalesce(behind, F.lit(0)) <= F.col("start")) & (F.coalesce(ahead, F.col("end")) >= F.col("end"))
    # Base matches at the start of a candidate sort before it.
    return found.withColumns({"free": free}).filter((F.col("kind") < _CANDIDATE) | F.col("free")).drop("free")


def plain_fillers(keyed: DataFrame, contexts: DataFrame) -> DataFrame:
    """``context, words``: how many different words without digits follow each of ``contexts(context)``."""
    # An address is a number here, so that no part of it counts as a word.
    text = F.when(F.contains("text", F.lit("@")), F.regexp_replace("text", PATTERNS[0], " 0 ")).otherwise(F.col("text"))
    tokens = keyed.select(F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0)).alias("t")).filter(F.size("t") > 2)
    ends = F.slice("t", F.lit(3), F.size("t") - 2)
    slots = F.transform(
        ends, lambda word, i: F.struct(F.concat_ws(" ", F.get("t", i), F.get("t", i + 1)).alias("context"), word.alias("word"))
    )
    size = contexts.agg(F.count("*").alias("n"), F.sum(F.octet_length("context")).alias("bytes")).first()
    every = tokens.select(F.explode(slots).alias("slot")).select("slot.*").filter(~F.col("word").rlike("[0-9]") & F.col("word").rlike(r"\p{L}"))
    if size["n"] <= SENT_CONTEXTS and (size["bytes"] or 0) <= SENT_BYTES:
        kept = every.join(F.broadcast(contexts), "context", "left_semi").groupBy("context", "word").agg(F.lit(1).alias("one"))
    else:
        kept = every.groupBy("context", "word").agg(F.lit(1).alias("one")).join(contexts, "context", "left_semi")
    return kept.groupBy("context").agg(F.count("*").alias("words"))


def filled_contexts(docs: DataFrame, hopeful: DataFrame) -> DataFrame:
    """``context, fillers`` of those of ``hopeful(context, values, possible)`` that can still be accepted, with all their fillers."""
    keyed = _keyed(docs)
    for part in (*PARTS, 1):
        some = keyed if part == 1 else keyed.filter(F.pmod("key", F.lit(part)) == 0)
        filled = hopeful.join(plain_fillers(some, hopeful.select("context")), "context", "left").withColumn(
            "fillers", F.col("values") + F.coalesce("words", F.lit(0))
        )
        hopeful = stage(filled.filter(F.col("possible") * 100 >= SHARE * F.col("fillers")).drop("words"), "pii-filled")
        if part == 1 or hopeful.isEmpty():
            return hopeful.select("context", "fillers")
        hopeful = hopeful.drop("fillers")


def accepted_patterns(docs: DataFrame, found: DataFrame) -> DataFrame:
    """``context, kind``: the accepted patterns and the base kind that most of their seeds have."""
    several = F.length(_digits(F.col("value"))) >= IDENTIFIER_DIGITS
    instances = stage(
        found.filter("context IS NOT NULL")
        .groupBy("context", "value")
        .agg(F.min(F.when(F.col("kind") < _CANDIDATE, F.col("kind"))).alias("seed"), F.first(several).alias("shaped")),
        "pii-instances",
    )
    possible = F.col("seed").isNotNull() | F.col("shaped")
    # Whatever is discovered, no other pattern can be accepted.
    hopeful = stage(
        instances.groupBy("context")
        .agg(F.count("*").alias("values"), F.count_if(possible).alias("possible"))
        .filter((F.col("possible") >= SUPPORT) & (F.col("possible") * 100 >= SHARE * F.col("values")))
        .select("context", "values", "possible"),
        "pii-contexts",
    )
    if hopeful.isEmpty():
        return hopeful.select("context", F.lit(0).alias("kind"))
    fillers = filled_contexts(docs, hopeful)
    graph = stage(instances.join(fillers, "context").select("context", "value", "seed", "shaped", "fillers"), "pii-graph")
    positive = graph.filter("seed IS NOT NULL").select("value").distinct()
    # An identifier that is a seed anywhere counts as one everywhere.
    known, patterns = -1, None
    while True:
        scored = (
            graph.join(positive.withColumn("positive", F.lit(1)), "value", "left")
            .groupBy("context", "fillers")
            .agg(F.count("positive").alias("positives"))
        )
        patterns = stage(
            scored.filter((F.col("positives") >= SUPPORT) & (F.col("positives") * 100 >= SHARE * F.col("fillers"))).select("context"),
            "pii-patterns",
        )
        discovered = graph.filter("shaped").join(patterns, "context", "left_semi").select("value")
        positive = stage(positive.unionByName(discovered).distinct(), "pii-positive")
        now = positive.count()
        if now == known:
            break
        known = now
    votes = graph.join(patterns, "context", "left_semi").groupBy("context", "seed").agg(F.count("*").alias("n"))
    most = F.max_by("seed", F.struct(F.col("n"), -F.col("seed"))).alias("kind")
    seeded = votes.filter("seed IS NOT NULL").groupBy("context").agg(most)
    return patterns.join(seeded, "context", "left").select("context", F.coalesce("kind", F.lit(0)).alias("kind"))


def pii_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, key, kind, start, end``: base kinds by their places in ``BASE``, then the same kinds as added ones."""
    found = stage(apart(occurrences(docs)), "pii-occurrences")
    patterns = accepted_patterns(docs, found).withColumnRenamed("kind", "near")
    shaped = F.length(_digits(F.col("value"))) >= IDENTIFIER_DIGITS
    added = found.filter((F.col("kind") == _CANDIDATE) & shaped).join(patterns, "context").withColumn("kind", F.col("near") + len(BASE))
    columns = [*_DOC, "kind", "start", "end"]
    return found.filter(F.col("kind") < _CANDIDATE).select(columns).unionByName(added.select(columns))


def scan_pii(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: spans per base kind, the digest of the base spans, and all spans."""
    names = F.array(*(F.lit(k) for k in BASE), *(F.lit(f"near_{k}") for k in BASE))
    entry = F.struct("kind", "start", F.concat_ws(":", F.element_at(names, F.col("kind") + 1), "start", "end").alias("said"))

    def joined(which: Column) -> Column:
        return F.array_join(F.transform(F.array_sort(F.collect_list(F.when(which, entry))), lambda x: x["said"]), ",")

    each = pii_spans(docs).groupBy(*_DOC).agg(
        *(F.count_if(F.col("kind") == k).alias(f"n_{name}") for k, name in enumerate(BASE)),
        joined(F.col("kind") < len(BASE)).alias("base_spans"),
        joined(F.lit(True)).alias("spans"),
    ).withColumnsRenamed({"doc_id": "_doc", "key": "_key"})
    rows = _keyed(docs).select(*_DOC).join(each, F.col("doc_id").eqNullSafe(F.col("_doc")) & (F.col("key") == F.col("_key")), "left")
    return rows.select(
        "doc_id",
        *(F.coalesce(f"n_{name}", F.lit(0).cast("long")).alias(f"n_{name}") for name in BASE),
        F.sha2(F.coalesce("base_spans", F.lit("")), 256).alias("base_sha256"),
        F.coalesce("spans", F.lit("")).alias("spans"),
    )
