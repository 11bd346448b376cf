"""Toxicity by a weighted lexicon.

Texts are folded first: lower case, accents and look-alike letters of other scripts to plain letters, digits and
signs inside words to the letters they stand for, everything else to blanks. An Aho-Corasick automaton finds the
entries of the lexicon (whole words, and word beginnings for inflected forms) and the exception phrases, which undo the
entries inside them. The score is a logistic function of the matched weight, plain and per word.

``fit`` learns the lexicon, the phrases and the function from labelled texts: at most ``max_rows`` of them, taken
by the hash of the text, equal texts once. The model is at most ``max_entries`` entries. Scoring reads whole texts.

Defined results: a null or empty text gets the score of a text without matches; null and repeated ``doc_id`` values
keep one row each; without labelled toxic texts the lexicon is empty and every score is the base rate; an empty table
gives no row; other columns are ignored (``score``) or kept (``without_toxic``).
"""

from __future__ import annotations

import math
import re
import types
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from sentloom.llm.worker import kept, lean

# Letters that look like Latin ones.
LOOKALIKES = dict(
    zip(
        "авекмнорстухіјѕһԁԛԝӏɩαβεηικνορτυχγωɑɡıłøđßæœ",
        ["a", "b", "e", "k", "m", "h", "o", "p", "c", "t", "y", "x", "i", "j", "s", "h", "d", "q", "w", "l", "i"]
        + ["a", "b", "e", "n", "i", "k", "v", "o", "p", "t", "u", "x", "y", "w", "a", "g", "i", "l", "o", "d", "ss", "ae", "oe"],
        strict=True,
    )
)
# Digits and signs that stand for letters inside a word.
SUBSTITUTES = str.maketrans("013457@$!", "oieastasi")

_SUBSTITUTED = re.compile(r"(?<=[^\W\d_])[013457]+|[013457@$!]+(?=[^\W\d_])")
_HINT = re.compile(r"[013457@$!]")


class _Fold(dict):
    """Code point -> folded letters, or a blank."""

    def __missing__(self, code: int) -> str:
        out = "".join(
            LOOKALIKES.get(c, c) for c in unicodedata.normalize("NFKD", chr(code).lower()) if not unicodedata.combining(c)
        )
        out = "".join(c for c in unicodedata.normalize("NFKD", out) if not unicodedata.combining(c))
        if not out.isalpha():
            out = "" if unicodedata.category(chr(code)) in ("Mn", "Cf") else " "
        self[code] = out
        return out


def _kept() -> types.ModuleType:
    state = kept("toxicity")
    if not hasattr(state, "fold"):
        state.fold = _Fold()
    return state


def fold(text: str, table: dict) -> str:
    """Folded words, each with a blank on both sides."""
    if _HINT.search(text):
        text = _SUBSTITUTED.sub(lambda m: m[0].translate(SUBSTITUTES), text)
    return f" {' '.join(text.translate(table).split())} "


@dataclass
class Model:
    """``entries``: `` word `` or `` beginning`` and their weights; ``phrases``: exceptions, blanks around."""

    entries: dict[str, float] = field(default_factory=dict)
    phrases: list[str] = field(default_factory=list)
    #: Of 1, log(1 + weight) and weight per word.
    coefficients: tuple[float, float, float] = (0.0, 0.0, 0.0)

    def automaton(self) -> ahocorasick.Automaton:
        out = ahocorasick.Automaton()
        for word, weight in self.entries.items():
            out.add_word(word, (len(word), weight))
        for phrase in self.phrases:
            out.add_word(phrase, (len(phrase), None))
        out.make_automaton()
        return out


def features(folded: str, automaton) -> tuple[float, float]:
    """Matched weight and words of a folded text."""
    found: dict[int, float] = {}
    excused: list[tuple[int, int]] = []
    if len(automaton):
        for end, (length, weight) in automaton.iter(folded):
            start = end - length + 1
            if weight is None:
                excused.append((start, end))
            else:
                found[start] = max(found.get(start, 0.0), weight)
    for a, b in excused:
        for start in [s for s in found if a <= s < b]:
            del found[start]
    return sum(found.values()), max(folded.count(" ") - 1, 0)


def score_of(weight: float, words: float, coefficients: tuple[float, float, float]) -> float:
    a, b, c = coefficients
    x = a + b * math.log1p(weight) + c * weight / max(words, 1.0)
    return 1 / (1 + math.exp(-min(max(x, -30.0), 30.0)))


def _terms(folded: str) -> set[str]:
    """Whole words and beginnings of longer ones."""
    words = {w for w in folded.split() if len(w) >= 3}
    return {f" {w} " for w in words} | {f" {w[:k]}" for w in words for k in (4, 5, 6) if len(w) > k}


def fit(
    labelled: DataFrame,
    *,
    max_rows: int = 20_000,
    max_entries: int = 20_000,
    least_texts: int = 5,
    least_share: float = 0.015,
    least_ratio: float = 8.0,
) -> Model:
    """Learn from ``labelled(text, toxic)``.

    An entry occurs in ``least_texts`` toxic texts and in ``least_share`` of them or more, and ``least_ratio`` times as often in a toxic text as in
    another; its weight is the logarithm of that ratio. A phrase of an entry and the word beside it is an exception if
    clean texts hold it and toxic ones don't.
    """
    rows = labelled.filter("text IS NOT NULL AND toxic IN (0, 1)").select("text", "toxic", F.xxhash64("text").alias("key"))
    total = rows.count()
    if not total:
        return Model()
    share = min(1.0, max_rows / total)
    rows = rows.filter(F.pmod("key", F.lit(1_000_000)) < int(share * 1_000_000)).dropDuplicates(["key"])

    def count_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(_terms(fold(text.as_py(), _kept().fold)))
            if len(counts) > 500_000:
                yield pa.record_batch({"term": list(counts), "n": list(counts.values())})
                counts = Counter()
        yield pa.record_batch({"term": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    least = max(least_texts, math.ceil(least_share * n_toxic))
    toxic = {
        r["term"]: r["n"]
        for r in rows.filter("toxic = 1")
        .mapInArrow(count_terms, "term string, n long")
        .groupBy("term")
        .agg(F.sum("n").alias("n"))
        .filter(F.col("n") >= least)
        .orderBy(F.desc("n"), "term")
        .limit(10 * max_entries)
        .collect()
    }

    def count_clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                counts.update(_terms(fold(text.as_py(), _kept().fold)) & toxic.keys())
        yield pa.record_batch({"term": pa.array(list(counts), pa.string()), "n": pa.array(list(counts.values()), pa.int64())})

    clean = {
        r["term"]: r["n"]
        for r in rows.filter("toxic = 0").mapInArrow(count_clean, "term string, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    }
    weights = {
        term: math.log(((n + 0.5) / (n_toxic + 1)) / ((clean.get(term, 0) + 0.5) / (n_clean + 1))) for term, n in toxic.items()
    }
    chosen = sorted((t for t, w in weights.items() if w >= math.log(least_ratio)), key=lambda t: (-weights[t], -toxic[t], t))
    model = Model({t: weights[t] for t in chosen[:max_entries]})

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Phrases around matches, and the features of each text without them."""
        automaton, phrases, points = model.automaton(), Counter(), []
        for batch in batches:
            for text, label in zip(batch["text"], batch["toxic"].to_pylist(), strict=True):
                folded = fold(text.as_py(), _kept().fold)
                held = set()
                for end, (length, _) in automaton.iter(folded):
                    start = end - length + 1
                    stop = folded.find(" ", start + 1)
                    after = folded.find(" ", stop + 1)
                    if stop > 0 and after > 0:
                        held.add(folded[start : after + 1])
                    before = folded.rfind(" ", 0, start) if start else -1
                    if before >= 0 and stop > 0:
                        held.add(folded[before : stop + 1])
                phrases.update((p, label) for p in held)
        yield pa.record_batch(
            {
                "phrase": pa.array([p for p, _ in phrases], pa.string()),
                "toxic": pa.array([t for _, t in phrases], pa.int32()),
                "n": pa.array(list(phrases.values()), pa.int64()),
            }
        )

    if model.entries:
        around = (
            rows.mapInArrow(neighbours, "phrase string, toxic int, n long")
            .groupBy("phrase")
            .agg(F.sum(F.when(F.col("toxic") == 0, F.col("n")).otherwise(0)).alias("clean"), F.sum(F.when(F.col("toxic") == 1, F.col("n")).otherwise(0)).alias("bad"))
            .filter(f"bad = 0 AND clean >= {least_texts}")
            .orderBy(F.desc("clean"), "phrase")
            .limit(max_entries)
        )
        model.phrases = [r["phrase"] for r in around.collect()]
    points = with_features(rows, model).select("toxic", "weight", "words").collect()
    model.coefficients = _logistic(
        np.array([[1.0, math.log1p(p["weight"]), p["weight"] / max(p["words"], 1.0)] for p in points]),
        np.array([float(p["toxic"]) for p in points]),
    )
    return model


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3) -> tuple[float, float, float]:
    """Newton steps with a small penalty, so that separable samples have a finite fit too."""
    w = np.zeros(3)
    for _ in range(40):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        h = (x * (p * (1 - p))[:, None]).T @ x + ridge * len(y) * np.eye(3)
        step = np.linalg.solve(h, x.T @ (y - p) - ridge * len(y) * w)
        w += step
        if abs(step).max() < 1e-8:
            break
    # More matched weight never lowers a score.
    return float(w[0]), max(float(w[1]), 0.0), max(float(w[2]), 0.0)


def with_features(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``weight`` and ``words`` in place of ``text``."""
    others = [f for f in docs.schema.fields if f.name not in ("text", "weight", "words")]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, table = model.automaton(), _kept().fold
        for batch in batches:
            found = [features(fold(t.as_py() or "", table), automaton) for t in batch["text"]]
            yield pa.record_batch(
                [batch[f.name] for f in others]
                + [pa.array([w for w, _ in found], pa.float64()), pa.array([float(n) for _, n in found], pa.float64())],
                names=[f.name for f in others] + ["weight", "words"],
            )

    out = StructType([*others, StructField("weight", DoubleType()), StructField("words", DoubleType())])
    return docs.select(*(f.name for f in others), "text").mapInArrow(measure, out)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, score, predicted, weight, words`` of every row of ``docs(doc_id, text)``."""
    a, b, c = model.coefficients
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    x = F.lit(a) + F.lit(b) * F.log1p("weight") + F.lit(c) * F.col("weight") / F.greatest("words", F.lit(1.0))
    scored = with_features(texts, model).withColumn("score", 1 / (1 + F.exp(-F.greatest(F.least(x, F.lit(30.0)), F.lit(-30.0)))))
    return scored.select("doc_id", "score", F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"), "weight", "words")


def held_out(doc_id: str = "doc_id"):
    """One row in five, by the checksum of its id, is kept from learning."""
    return F.crc32(F.col(doc_id).cast("string")) % 5 == 0


def labelled_texts(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Texts and labels to learn from. Several labels of a document are taken as toxic if one is."""
    known = labels.filter(~held_out() & F.col("toxic").isNotNull()).groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
    return docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text")).join(known, "doc_id").select("text", "toxic")


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not rejected, all columns kept. Scoring happens beside the rows, in one pass."""
    fields = docs.schema

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, table = model.automaton(), _kept().fold
        for batch in batches:
            good = [
                score_of(*features(fold(t.as_py() or "", table), automaton), model.coefficients) < 0.5 for t in batch["text"]
            ]
            yield batch.filter(pa.array(good, pa.bool_()))

    return docs.mapInArrow(lean(keep), fields)
