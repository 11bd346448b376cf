"""Ranked lexical search with the Best Position Algorithm over impact lists.

A first pass counts each document's terms, keeps the postings of the terms that the items ask for, and stages them;
the totals and document frequencies over all documents follow from it. A second pass cuts the staged documents into
segments of about ``SEGMENT`` postings. In a segment every term has a list of its documents by falling impact. An item
reads its lists in parallel; each new document is looked up in all of them (direct access), which marks its positions as
seen. A list's best position is the last one of the seen run at its head, so what follows bounds every unseen document:
reading stops when the sum of the bounds lies strictly below the k-th best score. A task carries its best documents from segment to segment, so the
floor rises; the best of all tasks are ranked by one window. Texts are never shuffled.

Items are searched in blocks of about ``ITEM_TERMS`` different terms, each a pass over the documents: what is sent to the
tasks is bounded whatever the number of items. Terms are known by hashes of 64 bits.

Defined results: a null text has no term; a document without terms counts nowhere; repeated rows of a ``doc_id`` are
documents of their own, ranked one after another; a null ``doc_id`` ranks behind equal scores; rows that repeat an
``item_id`` are one item with the terms of all (a null id is an id); an item without terms, or without a document that
scores above 0, has no row; an empty table on either side gives no row; other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentloom.session import stage

#: Postings of a segment.
SEGMENT = 1_000_000
#: Pairs of an item and a term that are searched in one pass. One item alone may have more.
ITEM_TERMS = 500_000
#: Text bytes hashed at once.
BLOCK = 1_000_000
#: Positions of each list read in an item's first round; each further round reads twice as many.
FIRST_READ = 64

# Bytes of terms are digits, letters and all beyond ASCII; scores are scaled as follows.
_TERM = np.zeros(256, bool)
_TERM[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
SCALE, TF_SCALE, LENGTH_SCALE, LENGTH_SHARE = 1_000_000_000, 1000, 8, 90

_STEP = 0x9E3779B97F4A7C15


def _spread(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


def term_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks ``(first text, term hashes text by text, first term of each text and the end)``."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        end = max(int(np.searchsorted(bounds, bounds[at] + BLOCK, "right")) - 1, at + 1)
        part, cuts = data[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at]
        inside = _TERM[part]
        # A text's end cuts a term, too.
        edge = np.zeros(len(part) + 1, bool)
        edge[cuts] = True
        first = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
        last = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]])))
        powers = np.full(len(part) + 1, _STEP, np.uint64)
        powers[0] = 1
        powers = np.cumprod(powers)
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((_LOWER[part] + np.uint64(1)) * powers[:-1])])
        # Dividing by the power of the first byte makes the sum the same wherever the term stands.
        back = np.full(len(part) + 1, pow(_STEP, -1, 1 << 64), np.uint64)
        back[0] = 1
        hashes = _spread((sums[last + 1] - sums[first]) * np.cumprod(back)[first] + (last - first).astype(np.uint64))
        yield at, hashes.view(np.int64), np.searchsorted(first, cuts)
        at = end


def item_terms(items: DataFrame) -> DataFrame:
    """``item_id, term``, each pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, hashes, firsts in term_hashes(batch["text"]):
                owner = np.repeat(np.arange(at, at + len(firsts) - 1), np.diff(firsts))
                yield pa.record_batch({"item_id": batch["item_id"].take(pa.array(owner)), "term": pa.array(hashes)})

    texts = items.select(F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "item_id long, term long").distinct()


def postings(docs: DataFrame, terms: np.ndarray) -> DataFrame:
    """``doc_id, n, terms, tfs`` of the documents with terms; ``terms`` are places in the sorted array that is given."""
    sent = docs.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = sent.value
        for batch in batches:
            for at, hashes, firsts in term_hashes(batch["text"]):
                counts = np.diff(firsts)
                owner = np.repeat(np.arange(len(counts)), counts)
                place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                asked = known[place] == hashes
                pairs, tf = np.unique(owner[asked] * len(known) + place[asked], return_counts=True)
                cuts = pa.array(np.searchsorted(pairs, np.arange(len(counts) + 1) * len(known)), pa.int32())
                rows = pa.record_batch(
                    {
                        "doc_id": batch["doc_id"].slice(at, len(counts)),
                        "n": pa.array(counts, pa.int64()),
                        "terms": pa.ListArray.from_arrays(cuts, pa.array(pairs % len(known), pa.int32())),
                        "tfs": pa.ListArray.from_arrays(cuts, pa.array(tf, pa.int32())),
                    }
                )
                yield rows.filter(pa.array(counts > 0))

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, n long, terms array<int>, tfs array<int>")


def frequencies(indexed: DataFrame, size: int) -> np.ndarray:
    """The number of documents that hold each term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size, np.int64)
        for batch in batches:
            held += np.bincount(batch["terms"].flatten().to_numpy(), minlength=size)
        there = np.flatnonzero(held)
        yield pa.record_batch({"term": pa.array(there, pa.int32()), "df": pa.array(held[there])})

    out = np.zeros(size, np.int64)
    for r in indexed.select("terms").mapInArrow(run, "term int, df long").groupBy("term").agg(F.sum("df").alias("df")).collect():
        out[r["term"]] = r["df"]
    return out


class Segment:
    """Impact lists of some documents, and their postings by term and document for direct access."""

    def __init__(self, term: np.ndarray, doc: np.ndarray, impact: np.ndarray, docs: int, terms: int):
        self.docs = docs
        by_impact = np.lexsort((doc, -impact, term))
        self.list_doc, self.list_impact = doc[by_impact], impact[by_impact]
        self.starts = np.searchsorted(term[by_impact], np.arange(terms + 1))
        position = np.arange(len(term)) - self.starts[term[by_impact]]
        key = term[by_impact].astype(np.int64) * docs + self.list_doc
        order = np.argsort(key)
        self.key, self.position, self.impact = key[order], position[order], self.list_impact[order]

    def direct(self, terms: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Whether each term's list has each document, at which position and with which impact."""
        wanted = terms[:, None].astype(np.int64) * self.docs + docs
        at = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
        there = self.key[at] == wanted
        return there, self.position[at], np.where(there, self.impact[at], 0)

    def best(self, terms: np.ndarray, weights: np.ndarray, k: int, floor: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Documents and scores among which are the ``k`` best that reach ``floor``, and how many positions were read."""
        lengths = self.starts[terms + 1] - self.starts[terms]
        some = (lengths > 0) & (weights > 0)
        terms, weights, lengths = terms[some], weights[some], lengths[some]
        found, scores = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        if not len(terms):
            return found[0], scores[0], 0
        starts = self.starts[terms]
        base = np.concatenate([[0], np.cumsum(lengths)])
        seen = np.zeros(base[-1], bool)
        met = np.zeros(self.docs, bool)
        best = np.zeros(len(terms), np.int64)  # the first position not seen yet
        low, step, kept = 0, FIRST_READ, np.zeros(0, np.int64)
        while True:
            spans = np.clip(lengths - low, 0, step)
            at = np.repeat(starts + low, spans) + np.arange(spans.sum()) - np.repeat(np.cumsum(spans) - spans, spans)
            docs = np.unique(self.list_doc[at])
            docs = docs[~met[docs]]
            met[docs] = True
            there, position, impact = self.direct(terms, docs)
            seen[(base[:-1, None] + position)[there]] = True
            score = (impact * weights[:, None]).sum(axis=0)
            found.append(docs)
            scores.append(score)
            kept = np.concatenate([kept, score])
            if len(kept) > k:
                kept = np.partition(kept, -k)[-k:]
            if len(kept) == k:
                floor = max(floor, int(kept.min()))
            low, step = low + step, step * 2
            bound = 0
            for i, (a, b) in enumerate(zip(base[:-1].tolist(), base[1:].tolist(), strict=True)):
                unseen = seen[a + best[i] : b]
                run = int(unseen.argmin()) if len(unseen) else 0
                best[i] += len(unseen) if len(unseen) and unseen[run] else run
                if best[i] < b - a:
                    bound += int(weights[i]) * int(self.list_impact[starts[i] + best[i]])
            if bound < floor:
                return np.concatenate(found), np.concatenate(scores), int(np.minimum(lengths, low).sum())


def best_documents(indexed: DataFrame, items: list[tuple[int | None, np.ndarray]], weights: np.ndarray, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``item_id, doc_id, score``: the best documents of each task."""
    sent = indexed.sparkSession.sparkContext.broadcast((items, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, weights = sent.value
        # Of each item the scores and documents so far, best first, a null document last.
        best: dict[int, list[tuple[int, bool, int]]] = {}
        held: list[pa.RecordBatch] = []

        def search() -> None:
            rows = pa.Table.from_batches(held).combine_chunks()
            ids = rows["doc_id"].to_pylist()
            sizes = pc.list_value_length(rows["terms"]).to_numpy()
            n = rows["n"].to_numpy()
            m = (100 - LENGTH_SHARE) + LENGTH_SHARE * n * n_docs // n_terms
            doc = np.repeat(np.arange(len(ids)), sizes)
            term = rows["terms"].combine_chunks().flatten().to_numpy()
            tf = rows["tfs"].combine_chunks().flatten().to_numpy().astype(np.int64)
            if not len(term):
                return
            impact = SCALE * tf // (TF_SCALE * tf + LENGTH_SCALE * m[doc])
            # Lists of the terms that occur; the others are empty.
            present, place = np.unique(term, return_inverse=True)
            segment = Segment(place, doc, impact, len(ids), len(present))
            for i, (_, terms) in enumerate(items):
                at = np.minimum(np.searchsorted(present, terms), len(present) - 1)
                at = at[present[at] == terms]
                had = best.get(i, [])
                floor = -had[-1][0] if len(had) == k else 1
                docs, scores, _ = segment.best(at, weights[present[at]], k, floor)
                good = scores >= floor
                if good.any():
                    new = [(-s, ids[d] is None, ids[d] or 0) for s, d in zip(scores[good].tolist(), docs[good].tolist(), strict=True)]
                    best[i] = sorted(had + new)[:k]

        waiting = 0
        for batch in batches:
            # Cut so that a segment has about as many postings as it should.
            reached = np.cumsum(pc.list_value_length(batch["terms"]).to_numpy())
            at = 0
            while at < batch.num_rows:
                before = int(reached[at - 1]) if at else 0
                end = min(max(int(np.searchsorted(reached, before + SEGMENT - waiting, "right")), at + 1), batch.num_rows)
                held.append(batch.slice(at, end - at))
                waiting += int(reached[end - 1]) - before
                at = end
                if waiting >= SEGMENT or at < batch.num_rows:
                    search()
                    held, waiting = [], 0
        if held:
            search()
        rows = [(items[i][0], None if null else d, -s) for i, found in best.items() for s, null, d in found]
        columns = list(zip(*rows, strict=True)) or [[], [], []]
        yield pa.record_batch([pa.array(c, pa.int64()) for c in columns], names=["item_id", "doc_id", "score"])

    return indexed.mapInArrow(run, "item_id long, doc_id long, score long")


def search(docs: DataFrame, items: DataFrame, *, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` best documents of each item with a score above 0."""
    asked = stage(item_terms(items), "item-terms")
    blocks = max(1, -(-asked.count() // ITEM_TERMS))
    parts = []
    for block in range(blocks):
        pairs = asked.filter(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == block).toArrow()
        if not pairs.num_rows:
            continue
        terms = np.unique(pairs["term"].to_numpy())
        by_item: dict[int | None, list[int]] = {}
        for item, place in zip(pairs["item_id"].to_pylist(), np.searchsorted(terms, pairs["term"].to_numpy()).tolist(), strict=True):
            by_item.setdefault(item, []).append(place)
        indexed = stage(postings(docs, terms), "postings")
        total = indexed.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
        if not total["docs"]:
            continue
        df = frequencies(indexed, len(terms))
        weights = np.array([math.floor(1000 * math.log((2 * total["docs"] + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        wanted = [(item, np.sort(np.array(places))) for item, places in by_item.items()]
        parts.append(best_documents(indexed, wanted, weights, total["docs"], total["terms"], k))
    if not parts:
        return asked.select("item_id", F.lit(0).alias("rank"), F.lit(0).cast("long").alias("doc_id"), F.lit(0).cast("long").alias("score")).filter("false")
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (
        found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
    )
