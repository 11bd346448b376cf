"""Exact Jaccard join of word-shingle sets by universe partitions.

Every shingle is hashed into one of ``m`` segments. Two sets that reach the threshold differ in at most ``H``
shingles, so with weights ``v + 1`` that sum to ``H + 1`` or more, some segment differs in at most ``v`` shingles:
``v = 0`` needs equal segments, ``v = 1`` is found through segments with one shingle deleted. Sizes are cut into
bands; a set is indexed in its own band and, where a smaller partner could lie there, in the one below. A cost
model on the size histogram of all sets picks for each band how many segments are matched with ``v = 1`` and how many
extra segments pay for leaving empty ones out of the index (``allocate``). Candidates are verified on the shingles.

Equal sets are one node, whatever the number of their documents. Within a list of the index the members are compared
with the one that shares most lists; only members that this leaves in different components are compared with each other, so groups of
near copies never expand into all pairs: chunk by chunk, their bucket prints rule out those that differ too much, and a
pair that several lists hold comes from the first of them alone. Nodes are 64-bit hashes of shingle hashes of 64 bits.

Defined results: a null text, an empty one and one without words have an empty set, no link and their own ``doc_id``
as component; repeated rows are copies; a null ``doc_id`` is kept, and takes part as the largest one; an empty table
gives no row; other columns are ignored.
"""

from __future__ import annotations

import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentloom.llm.worker import kept, lean, small_batches
from sentloom.session import stage

BAND_RATIO = 1.5
#: Members of a list compared at once.
CHUNK = 1024
#: Buckets of a set's print for each difference that a pair may have, and the least number of buckets.
PRINT, LEAST_PRINT = 4, 16
#: Ids of documents whose sets are compared that are sent to the tasks; more are joined by a shuffle of the texts.
SENT_IDS = 1_000_000
#: Cost of verifying a pair, in index rows.
PAIR_COST = 20
#: Text bytes hashed at once.
BLOCK = 1_000_000

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += 32
_BASE = 0x9E3779B97F4A7C15


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out)


def hash_words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of texts ``data[bounds[i]:bounds[i + 1]]`` and the first word of each text."""
    word = ~_SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.concatenate([[False], word[:-1]])
    after = np.concatenate([word[1:], [False]])
    first = np.flatnonzero(word & (~before | edge[:-1]))
    last = np.flatnonzero(word & (~after | edge[1:]))
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum((_LOWER[data] + np.uint64(1)) * _powers(_BASE, len(data)))])
    hashes = (sums[last + 1] - sums[first]) * _powers(pow(_BASE, -1, 1 << 64), len(data))[first]
    return _mix(hashes + (last - first).astype(np.uint64)), np.searchsorted(first, bounds)


def shingle_sets(texts: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Blocks ``(first text, distinct shingle hashes text by text, first shingle of each text and the end)``."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    at = 0
    while at < len(texts):
        end = int(np.searchsorted(bounds, bounds[at] + BLOCK, "right")) - 1
        end = min(max(end, at + 1), at + 60_000, len(texts))
        words, firsts = hash_words(data[bounds[at] : bounds[end]], bounds[at : end + 1] - bounds[at])
        counts = np.diff(firsts)
        of = np.repeat(np.arange(end - at), counts)
        shingles, owner = [], []
        for length in range(1, n + 1):
            # All runs of n words; of shorter texts the whole sequence.
            starts = np.flatnonzero(counts[of] >= n) if length == n else firsts[:-1][counts == length]
            if length == n:
                starts = starts[starts + n <= firsts[1:][of[starts]]]
            h = np.full(len(starts), length, np.uint64)
            for k in range(length):
                h = _mix(h * np.uint64(_BASE) + words[starts + k])
            shingles.append(h)
            owner.append(of[starts])
        h, owner = np.concatenate(shingles), np.concatenate(owner).astype(np.uint16)
        order = np.argsort(h)
        order = order[np.argsort(owner[order], kind="stable")]
        h, owner = h[order], owner[order]
        if len(h):
            new = np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])
            h, owner = h[new], owner[new]
        yield at, h, np.searchsorted(owner, np.arange(end - at + 1))
        at = end


def _sum_by(values: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)])
    return sums[firsts[1:]] - sums[firsts[:-1]]


def set_nodes(h: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    return _mix(_sum_by(_mix(h + np.uint64(_BASE)), firsts) + np.diff(firsts).astype(np.uint64)).view(np.int64)


def bands(largest: int) -> list[tuple[int, int]]:
    out, low = [], 1
    while low <= largest:
        out.append((low, max(low, int(low * BAND_RATIO))))
        low = out[-1][1] + 1
    return out


def allocate(low: int, high: int, sets: int, num: int, den: int) -> tuple[int, int, int]:
    """Segments, how many of them allow one difference, and how many empty ones a set may leave out.

    The cheapest choice by index rows and expected pairs of unrelated sets that agree in empty segments.
    """
    differ = (high + high * den // num) * (den - num) // (den + num)
    size, best = (low + high) / 2, None
    for ones in range(min(differ + 1, 4) + 1):
        for spare in range(9):
            m = max(differ + 1 + spare - ones, ones, 1)
            empty = math.exp(-size / m)
            left = m - ones
            over = 1 - sum(math.comb(left, k) * empty**k * (1 - empty) ** (left - k) for k in range(min(spare, left) + 1))
            rows = left + ones * (1 + size / m)
            one = empty * size / m
            pairs = sets * (left * empty * empty * max(over, 0.0) + ones * (empty * empty + 2 * empty * one + one * one))
            cost = rows + PAIR_COST * pairs
            if best is None or cost < best[0]:
                best = (cost, m, ones, spare)
    return best[1:]


def _signatures(h: np.ndarray, firsts: np.ndarray, use: np.ndarray, band: int, plan: tuple[int, int, int], differ: np.ndarray):
    """Index entries of the sets ``use`` in one band: signature, set.

    ``differ``: in how many shingles each set may differ from a larger partner. Its first segments, as many as that
    asks for, are enough, as the partner has entries for all of those.
    """
    m, ones, spare = plan
    needed = np.minimum(m, np.maximum(differ + 1 + spare - ones, max(ones, 1)))
    sizes = np.diff(firsts)[use]
    at = np.repeat(firsts[:-1][use] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    tokens = h[at]
    row = np.repeat(np.arange(len(use)), sizes)
    segment = ((_mix(tokens + np.uint64(7)) >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
    cell = row * m + segment
    values = _mix(tokens + np.uint64(11))
    sums, filled = np.zeros(len(use) * m, np.uint64), np.bincount(cell, minlength=len(use) * m)
    np.add.at(sums, cell, values)
    keep = np.arange(m) < needed[:, None]
    empty = (filled.reshape(-1, m)[:, ones:] == 0) & keep[:, ones:]
    keep[:, ones:] &= ~empty | (empty.sum(axis=1) > spare)[:, None]
    place = np.tile(np.arange(m, dtype=np.uint64) + np.uint64(m * 4096 + 1), len(use))
    salt = _mix(place * np.uint64(_BASE) + np.uint64(band))
    stays = np.flatnonzero(keep.ravel())
    sig, owner = [_mix(sums[stays] + salt[stays])], [use[stays // m]]
    if ones:
        some = np.flatnonzero(segment < ones)
        sig.append(_mix(sums[cell[some]] - values[some] + salt[cell[some]]))
        owner.append(use[row[some]])
    return np.concatenate(sig).view(np.int64), np.concatenate(owner)


def set_prints(shingles: np.ndarray, firsts: np.ndarray, buckets: np.ndarray) -> pa.Array:
    """Four bits for each bucket of a set's shingles. Sets differ in as many shingles as their prints in buckets, or more.

    ``buckets``: an even number for each set.
    """
    ends = np.cumsum(buckets)
    owner = np.repeat(np.arange(len(buckets)), np.diff(firsts))
    at = ((_mix(shingles + np.uint64(13)) >> np.uint64(32)) * buckets[owner].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
    sums = np.zeros(ends[-1] if len(ends) else 0, np.uint64)
    np.add.at(sums, at + (ends - buckets)[owner], _mix(shingles + np.uint64(17)))
    offsets = np.concatenate([[0], ends // 2]).astype(np.int32)
    bits = (sums >> np.uint64(60)).astype(np.uint8)
    data = bits[0::2] << 4 | bits[1::2]
    return pa.Array.from_buffers(pa.binary(), len(buckets), [None, pa.py_buffer(offsets.tobytes()), pa.py_buffer(data.tobytes())])


def close_pairs(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """Pairs of different components within the sorted groups ``sig, i, j`` whose prints leave the threshold open.

    A group has at most two chunks of a list: its first one alone, or each member of side 0 with each of side 1. Of the
    lists that two members share, the first one gives the pair: ``lower`` holds the lists of a member before this one.
    """

    def pairs(rows: pa.Table) -> pa.RecordBatch:
        node, size, component, side = (rows[c].to_numpy() for c in ("node", "size", "component", "side"))
        shown = np.frombuffer(b"".join(rows["print"].to_pylist()), np.uint8).reshape(len(node), -1)
        left = np.flatnonzero(side == 0)
        right = np.flatnonzero(side == 1) if side.any() else left
        lower = pc.list_flatten(rows["lower"]).to_numpy()
        lists, code = np.unique(lower, return_inverse=True)
        starts = np.concatenate([[0], np.cumsum(pc.list_value_length(rows["lower"]).to_numpy())])
        mine = np.zeros(len(lists), bool)
        out_a, out_b = [], []
        for x in left.tolist():
            # Within one chunk each pair once.
            y = right if right is not left else right[right > x]
            total = size[x] + size[y]
            least = -(-num * total // (num + den))
            fits = (component[y] != component[x]) & (den * np.minimum(size[y], size[x]) >= num * np.maximum(size[y], size[x]))
            y, allowed = y[fits], (total - 2 * least)[fits]
            if len(y):
                other = shown[y] ^ shown[x]
                y = y[np.count_nonzero(other & 0xF0, axis=1) + np.count_nonzero(other & 0x0F, axis=1) <= allowed]
            if len(y):
                own = code[starts[x] : starts[x + 1]]
                mine[own] = True
                met = np.concatenate([[0], np.cumsum(mine[code])])
                mine[own] = False
                y = y[met[starts[y + 1]] == met[starts[y]]]
                out_a.append(np.full(len(y), node[x]))
                out_b.append(node[y])
        a = np.concatenate([np.zeros(0, np.int64), *out_a])
        b = np.concatenate([np.zeros(0, np.int64), *out_b])
        return pa.record_batch({"a": pa.array(np.minimum(a, b)), "b": pa.array(np.maximum(a, b))})

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        table = pa.Table.from_batches(held)
        key = [table[c].to_numpy() for c in ("sig", "i", "j")]
        cuts = [0, *(np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1).tolist()]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield pairs(table.slice(a, b - a))
        held = table.slice(cuts[-1]).to_batches()
    if held:
        yield pairs(pa.Table.from_batches(held))


def not_far_apart(batches: Iterator[pa.RecordBatch], num: int, den: int) -> Iterator[pa.RecordBatch]:
    """The pairs ``a, b`` of rows with sizes and prints of one length whose prints leave the threshold open."""
    for batch in batches:
        total = batch["a_size"].to_numpy() + batch["b_size"].to_numpy()
        allowed = total - 2 * -(-num * total // (num + den))
        ends = [batch[c].cast(pa.large_binary()) for c in ("a_print", "b_print")]
        bounds = np.frombuffer(ends[0].buffers()[1], np.int64)[ends[0].offset : ends[0].offset + len(total) + 1]
        x, y = (np.frombuffer(e.buffers()[2] or b"", np.uint8) for e in ends)
        start = np.frombuffer(ends[1].buffers()[1], np.int64)[ends[1].offset]
        other = x[bounds[0] : bounds[-1]] ^ y[start : start + bounds[-1] - bounds[0]]
        sums = np.concatenate([[0], np.cumsum(((other & 0xF0) > 0).astype(np.int64) + ((other & 0x0F) > 0))])
        near = sums[bounds[1:] - bounds[0]] - sums[bounds[:-1] - bounds[0]] <= allowed
        yield pa.record_batch([batch[c] for c in ("a", "b")], names=["a", "b"]).filter(pa.array(near))


def let_go(spark: SparkSession) -> None:
    """Ask the driver to drop what is no longer referred to: shuffle files of finished steps are deleted only then."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def links_of(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs ``(a, b)`` whose sets reach the threshold."""
    left = sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa"))
    right = sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb"))
    shared = F.size(F.array_intersect("sa", "sb"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .filter(shared * (num + den) >= num * (F.size("sa") + F.size("sb")))
        .select("a", "b")
        .distinct()
    )


def connect(links: DataFrame) -> DataFrame:
    """``node, component`` for the nodes of ``links(a, b)``: the smallest node that each can reach.

    Every round takes the smallest label among the neighbours and then the label of that label, so the number of
    rounds grows with the logarithm of the longest path.
    """
    edges = stage(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stage(edges.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("node"), F.least("a", "m").alias("component")), "labels")
    while True:
        near = (
            edges.join(labels.select(F.col("node").alias("b"), "component"), "b")
            .groupBy(F.col("a").alias("node"))
            .agg(F.min("component").alias("near"))
        )
        lower = labels.join(near, "node").select("node", F.col("component").alias("was"), F.least("component", "near").alias("now"))
        jump = labels.select(F.col("node").alias("now"), F.col("component").alias("then"))
        new = stage(lower.join(jump, "now").select("node", "was", F.least("now", "then").alias("component")), "labels")
        labels = new.select("node", "component")
        if new.filter("component <> was").isEmpty():
            return labels


def jaccard_components(docs: DataFrame, *, n: int = 5, num: int = 80, den: int = 100, keyed: bool = False) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row of ``docs(doc_id, text)``, and with ``keyed`` its :func:`text_key`.

    Documents link when ``den * |A & B| >= num * |A | B|`` for their sets of ``n``-word shingles.
    """
    with small_batches(docs.sparkSession):
        found = _components(docs, n, num, den)
    return found if keyed else found.drop("key")


def text_key() -> Column:
    """What tells rows of one ``doc_id`` with different texts apart."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _components(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_key().alias("key"))

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("jaccard")
        for batch in batches:
            for at, h, firsts in shingle_sets(batch["text"], n):
                yield pa.record_batch(
                    {
                        "doc_id": batch["doc_id"].slice(at, len(firsts) - 1),
                        "key": batch["key"].slice(at, len(firsts) - 1),
                        "n_shingles": pa.array(np.diff(firsts)),
                        "node": pa.array(set_nodes(h, firsts)),
                    }
                )

    measured = stage(docs.mapInArrow(lean(measure), "doc_id long, key long, n_shingles long, node long"), "shingle-counts")
    largest = measured.agg(F.max("n_shingles")).first()[0] or 0
    ranges = bands(largest)
    lows = [low for low, _ in ranges]
    # A print has PRINT buckets for each difference that two sets of the band's least size may have.
    buckets = np.array([2 * max(LEAST_PRINT // 2, PRINT * low * (den - num) // (den + num)) for low in lows], np.int64)

    def band_of(size: str) -> Column:
        """The place of a size among the bands, from 1."""
        return F.size(F.filter(F.array(*(F.lit(low).cast("long") for low in lows)), lambda low: low <= F.col(size)))

    # One row per band: its number of sets.
    histogram = (
        measured.filter("n_shingles > 0")
        .groupBy(band_of("n_shingles").alias("band"))
        .count()
        .collect()
        if ranges
        else []
    )
    filled = {r["band"] - 1: r["count"] for r in histogram}
    plans = [allocate(low, high, filled.get(k, 0) + filled.get(k + 1, 0), num, den) for k, (low, high) in enumerate(ranges)]

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept("jaccard")
        seen: set[int] = set()
        for batch in batches:
            for _, h, firsts in shingle_sets(batch["text"], n):
                sizes, nodes = np.diff(firsts), set_nodes(h, firsts)
                # Copies within the task need no entries of their own.
                new = np.sort(np.unique(nodes, return_index=True)[1])
                new = new[[x not in seen for x in nodes[new].tolist()]].astype(np.int64)
                new = new[sizes[new] > 0]
                if len(seen) < 1_000_000:
                    seen.update(nodes[new].tolist())
                band = np.searchsorted(lows, sizes[new], "right") - 1
                for k in np.unique(np.concatenate([band, band[band > 0] - 1])).tolist():
                    below = (band == k + 1) & (-(-num * sizes[new] // den) <= ranges[k][1])
                    use = new[(band == k) | below]
                    # Few sets at a time, as their segments are held in full.
                    step = max(1, 500_000 // plans[k][0])
                    for part in range(0, len(use), step):
                        own, low = use[part : part + step], ranges[k][1]
                        # Of a set of the band above, the partners here have at most the sizes of this band.
                        small = np.minimum(sizes[own], low)
                        differ = np.where(sizes[own] > low, plans[k][0] + plans[k][1], (small + small * den // num) * (den - num) // (den + num))
                        sig, owner = _signatures(h, firsts, own, k, plans[k], differ)
                        for cut in range(0, len(sig), 200_000):
                            own = owner[cut : cut + 200_000]
                            yield pa.record_batch(
                                {"sig": pa.array(sig[cut : cut + 200_000]), "node": pa.array(nodes[own]), "size": pa.array(sizes[own])}
                            )

    def lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The rows of the signatures that several sets have, each set once."""
        head = None  # signature, node and size of the first member of the list that is being read
        node, shown = None, False  # the last node, and whether the first member has been handed on
        for batch in batches:
            if not batch.num_rows:
                continue
            s, v, c = (batch[k].to_numpy() for k in ("sig", "node", "size"))
            if head is not None:
                s, v, c = (np.concatenate([[x], y]) for x, y in zip(head, (s, v, c), strict=True))
            starts = np.concatenate([[True], s[1:] != s[:-1]])
            first = np.maximum.accumulate(np.where(starts, np.arange(len(s)), 0))
            again = np.concatenate([[True], (s[1:] == s[:-1]) & (v[1:] == v[:-1])])
            if head is not None and len(s) > 1 and s[1] == s[0] and v[1] == node:
                again[1] = True
            member = np.flatnonzero(~starts & ~again & (v != v[first]))
            heads = np.unique(first[member])
            rows = np.concatenate([heads[1:] if shown and len(heads) and heads[0] == 0 else heads, member])
            shown = bool(len(heads) and heads[-1] == first[-1]) or shown and first[-1] == 0
            head, node = (s[first[-1]], v[first[-1]], c[first[-1]]), v[-1]
            yield pa.record_batch([pa.array(x[rows]) for x in (s, v, c)], names=["sig", "node", "size"])

    shared = stage(
        docs.mapInArrow(lean(index), "sig long, node long, size long")
        .repartition("sig")
        .sortWithinPartitions("sig", "node")
        .mapInArrow(lean(lists), "sig long, node long, size long"),
        "shared-lists",
    )
    let_go(spark)
    # Near copies share many signatures: of the lists with the same members, one is enough.
    every = shared.groupBy("sig").agg(F.count("*").alias("n"), F.min("size").alias("least"), F.bit_xor(F.xxhash64("node")).alias("whole"))
    single = every.groupBy("n", "whole", "least").agg(F.min("sig").alias("sig")).select("sig", "n", "least")
    members = stage(shared.join(single, "sig"), "list-members")
    let_go(spark)
    origins = measured.join(members.select("node").distinct(), "node").groupBy("node").agg(F.min("doc_id").alias("doc_id"))

    def list_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sets of the chosen documents with their prints, for lists of their own band and of the one below.

        Rows that repeat an id can give a set twice, which changes no link.
        """
        seen: set[int] = set()
        for batch in batches:
            for _, h, firsts in shingle_sets(batch["text"], n):
                nodes = set_nodes(h, firsts)
                new = np.array([i for i, x in enumerate(nodes.tolist()) if not (x in seen or seen.add(x))], np.int64)
                lists = pa.LargeListArray.from_arrays(pa.array(firsts), pa.array(h.view(np.int64))).cast(pa.list_(pa.int64()))
                band = np.searchsorted(lows, np.diff(firsts), "right") - 1
                own, below = (set_prints(h, firsts, np.where(band < 0, 2, buckets[np.maximum(band - k, 0)])) for k in (0, 1))
                columns = {"shingles": lists, "own": own, "below": below}
                yield pa.record_batch({"node": pa.array(nodes[new]), **{c: x.take(pa.array(new)) for c, x in columns.items()}})

    origins = stage(origins.select(F.col("doc_id").alias("origin")), "origins")
    if origins.count() <= SENT_IDS:
        origins = F.broadcast(origins)
    taken = docs.join(origins, F.col("doc_id").eqNullSafe(F.col("origin")), "left_semi")
    sets = stage(taken.mapInArrow(lean(list_sets), "node long, shingles array<long>, own binary, below binary"), "shingle-sets")

    # The member that shares most lists with others stands in the middle of its near copies.
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    heads = (
        members.join(weights, "node")
        .groupBy("sig")
        .agg(F.max_by(F.struct("node", "size"), F.struct("weight", "node")).alias("head"))
        .select("sig", F.col("head.node").alias("a"), F.col("head.size").alias("a_size"))
    )
    fitting = den * F.least("a_size", "size") >= num * F.greatest("a_size", "size")
    # Each member meets the heaviest of the heads of its lists.
    first = (
        members.join(heads.join(weights.withColumnRenamed("node", "a"), "a"), "sig")
        .filter(fitting & (F.col("a") != F.col("node")))
        .groupBy(F.col("node").alias("b"))
        .agg(F.first("size").alias("b_size"), F.max_by(F.struct("a", "a_size"), F.struct("weight", "a")).alias("head"))
        .select("head.*", "b", "b_size")
        .withColumn("band", F.least(band_of("a_size"), band_of("b_size")))
    )
    for side in ("a", "b"):
        print_of = F.when(band_of(f"{side}_size") == F.col("band"), F.col("own")).otherwise(F.col("below"))
        shown = sets.select(F.col("node").alias(side), "own", "below")
        first = first.join(shown, side).withColumn(f"{side}_print", print_of).drop("own", "below")
    # The prints leave few pairs, which are sent to the sets instead of the sets being shuffled.
    near = stage(first.mapInArrow(lean(lambda batches: not_far_apart(batches, num, den)), "a long, b long"), "pairs")
    links = stage(links_of(near, sets, num, den), "links")
    let_go(spark)
    joined = connect(links)
    let_go(spark)

    # Lists whose members are still apart.
    placed = members.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    apart = (
        placed.groupBy("sig")
        .agg(F.min("component").alias("low"), F.max("component").alias("high"))
        .filter("low <> high")
        .select("sig")
    )

    chunks = F.ceil(F.col("n") / CHUNK).cast("int")
    still = stage(placed.join(apart, "sig", "left_semi"), "open-lists")
    # A member has at most as many lists as its set has entries in the index.
    lists_of = still.groupBy("node").agg(F.array_sort(F.collect_list("sig")).alias("lists"))
    shown = stage(sets.select("node", "own", "below").join(lists_of, "node"), "list-prints")
    compared = (
        still.withColumn("mine", F.pmod(F.hash("node"), chunks))
        # The members of a list lie in its band, that of its least member, or in the one above.
        .withColumn("print_of", F.when(band_of("size") == band_of("least"), 0).otherwise(1))
        .select("sig", "node", "size", "component", "print_of", "mine", F.explode(F.sequence(F.lit(0), chunks - 1)).alias("other"))
        .join(shown, "node")
        .select(
            "sig", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
            F.when(F.col("mine") > F.col("other"), 1).otherwise(0).alias("side"), "node", "size", "component",
            F.when(F.col("print_of") == 0, F.col("own")).otherwise(F.col("below")).alias("print"),
            F.slice("lists", F.lit(1), F.array_position("lists", F.col("sig")).cast("int") - 1).alias("lower"),
        )
        .repartition("sig", "i", "j")
        .sortWithinPartitions("sig", "i", "j", "side")
        .mapInArrow(lean(lambda batches: close_pairs(batches, num, den)), "a long, b long")
    )
    more = stage(links_of(stage(compared, "pairs"), sets, num, den), "links")
    if not more.isEmpty():
        joined = connect(links.union(more))

    of_document = measured.join(joined, "node", "left").withColumn("component", F.coalesce("component", "node"))
    # Only the linked nodes and the copies meet here; empty sets stay alone.
    least = of_document.filter("n_shingles > 0").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return of_document.join(least, "component", "left").select(
        "doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"), "key"
    )
