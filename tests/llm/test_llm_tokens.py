"""Token code files, packing and sampled segmentations against the tokenizers themselves."""

import collections
import functools
import math
import re
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from sentloom.llm.encoding import Encoder, encoder
from sentloom.llm.piece_sampling import Vocabulary, _blocks, decode_ids, decode_pieces, sample_segmentations, sample_texts
from sentloom.llm.queries import BYTE_BPE, PIECE_BPE, WORD_BPE
from sentloom.llm.token_codes import CodeFile, encode_levels, read_token_codes, token_codes, write_token_codes
from sentloom.llm.window_packing import pack, sequences
from sentloom.llm.worker import lean


def ids_of(path, text):
    return Tokenizer.from_file(path).encode(text or "", add_special_tokens=False).ids


@functools.cache
def known(path):
    return Tokenizer.from_file(path)


def ids_of_known(path, text):
    return known(path).encode(text, add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_memoised_encoding_is_the_tokenizers(path):
    texts = ["", " ", "\n\n a", "don't  it's 'll", "a\tb c", "<|endoftext|> x", "x <|endoftext|> y<|startoftext|>", "<|ENDOFTEXT|> <|endoftext |>", "é é Å", "x y​z", "ab,***  12a3\r\n", "İS ΣΑΣ ß"]
    for text in texts:
        assert np.frombuffer(encoder(path).encode_bytes(text), "<u4").tolist() == ids_of(path, text), text


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
def test_blocks_of_texts_are_encoded_as_the_tokenizer_does(path, monkeypatch):
    """Texts of every mix of blanks, breaks, words and signs; a word is looked up once, whatever signs follow it."""
    parts = [" ", "\n", "a", "é", "b.", "漢", "x", "y,", "9", "'s", "A", "\t", "<|endoftext|>"]
    rng = np.random.default_rng(2)
    texts = ["".join(parts[i] for i in rng.integers(0, len(parts) if n % 9 == 0 else 11, rng.integers(0, 12))) for n in range(3000)]
    for block in (20, 100_000):
        monkeypatch.setattr("sentloom.llm.encoding.BLOCK", block)
        for text, ids in zip(texts, Encoder(path).encode_all(texts), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == ids_of_known(path, text), text
    fresh = Encoder(path)
    assert list(fresh.encode_all([])) == []
    assert len(list(fresh.encode_all(["word, word. word! word"] * 100))) == 100
    assert set(fresh.ids) <= {"", "word", " word", ",", ".", "!"}


def test_random_access_needs_no_decode():
    rng = np.random.default_rng(1)
    ids = np.concatenate([rng.integers(0, 300, 3000), rng.integers(0, 2**32, 500), [0, 2**32 - 1]])
    rng.shuffle(ids)
    file = CodeFile(CodeFile.pack(0, 0, [7, None], [0, 10, len(ids)], ids.astype(np.uint32)))
    assert len(encode_levels(ids.astype(np.uint32))) == 4
    assert [file[i] for i in range(len(ids))] == ids.tolist() == file.decode().tolist()
    assert file.known.tolist() == [1, 0]
    with pytest.raises(IndexError):
        file[len(ids)]


def test_token_codes_of_odd_rows(spark, odd_documents, folder):
    write_token_codes(odd_documents, f"{folder}/codes", WORD_BPE, segment_tokens=5)
    got = read_token_codes(spark, f"{folder}/codes").orderBy("start").collect()
    rows = sorted(((r["doc_id"], r["text"]) for r in odd_documents.collect()), key=lambda r: (r[0] is not None, r[0] or 0))
    start = 0
    for row, (doc, text) in zip(got, rows, strict=True):
        ids = [*ids_of(WORD_BPE, text), 1]
        assert (row["doc_id"], row["start"], row["n_tokens"]) == (doc, start, len(ids))
        assert row["ids_crc32"] == zlib.crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)


def test_empty_tables(spark, no_documents):
    assert token_codes(no_documents, WORD_BPE).count() == 0
    assert pack(no_documents, BYTE_BPE).count() == 0
    assert sample_segmentations(no_documents, PIECE_BPE).count() == 0


@pytest.mark.parametrize("size", [64, 2048])
def test_packing_places_each_id_once(spark, odd_documents, size):
    docs = odd_documents.repartition(3)
    pieces = pack(docs, BYTE_BPE, size=size, open_windows=2, keep_ids=True)
    rows = pieces.collect()
    by_document, by_sequence = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by_document[r["doc_id"], r["doc_tokens"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
        assert zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"]
    want = collections.Counter((r["doc_id"], tuple(ids_of(BYTE_BPE, r["text"])) + (1,)) for r in docs.collect())
    for (doc, ids), copies in want.items():
        mine = by_document[doc, len(ids)]
        for start in {p["start"] for p in mine}:
            assert all(list(np.frombuffer(p["ids"], "<u4")) == list(ids[start : start + p["length"]]) for p in mine if p["start"] == start)
        assert sum(p["length"] for p in mine) == copies * len(ids)
    for parts in by_sequence.values():
        at = 0
        for p in sorted(parts, key=lambda p: p["offset"]):
            assert p["offset"] == at
            at += p["length"]
        assert at <= size
    filled = sum(r["length"] for r in rows) / (size * len(by_sequence))
    assert filled > (0.95 if size == 64 else 0.5)
    built = {r["sequence_id"]: r for r in sequences(pieces, size=size).collect()}
    assert {s: sum(x > 0 for x in r["piece"]) for s, r in built.items()} == {s: sum(p["length"] for p in v) for s, v in by_sequence.items()}


def segmentations(text, words, model):
    ids = {model.IdToPiece(i): i for i in range(model.GetPieceSize()) if not (model.IsByte(i) or model.IsControl(i) or model.IsUnknown(i))}
    text = "▁" + text.replace(" ", "▁")
    out = {}

    def go(at, path, log):
        if at == len(text):
            out[tuple(path)] = log
        elif text[at] not in ids:
            part = text[at].encode()
            go(at + 1, path + [int(words.bytes[b]) for b in part], log + words.byte_log * len(part))
        for end in range(at + 1, len(text) + 1 if at < len(text) else 0):
            if text[at:end] in ids:
                go(end, [*path, ids[text[at:end]]], log + words.log[ids[text[at:end]]])

    go(0, [], 0.0)
    whole = np.logaddexp.reduce(list(out.values()))
    return {p: math.exp(x - whole) for p, x in out.items()}


@pytest.mark.parametrize("text", ["the", "a b", "é日☃", "  q"])
def test_samples_follow_the_lattice(text):
    from sentencepiece import SentencePieceProcessor

    words = Vocabulary(PIECE_BPE, 0.3)
    chance = segmentations(text, words, SentencePieceProcessor(model_file=PIECE_BPE))
    n, first, found = 4000, collections.Counter(), collections.defaultdict(list)
    for at, rank, ids, log, value, kept in sample_texts([text] * n, list(range(n)), words, 3, 1):
        path = tuple(ids.tolist())
        assert decode_ids(ids, words) == text
        assert math.isclose(math.exp(log), chance[path], rel_tol=1e-9)
        assert kept <= 1e-12 and (not found[at] or found[at][-1][1] >= value)
        found[at].append((path, value))
        first[path] += rank == 1
    assert all(len({p for p, _ in f}) == len(f) == min(3, len(chance)) for f in found.values())
    for path, p in chance.items():
        assert abs(first[path] / n - p) < 5 * math.sqrt(p * (1 - p) / n) + 1e-3


@pytest.mark.parametrize(("text", "k"), [("the", 13), ("house", 29), ("the the", 70), ("☃ the ☃", 20), ("☃", 3), ("international", 405), ("the " * 130 + "a", 600)])
def test_no_segmentation_is_left_out(text, k):
    """At the default weights, where most segmentations of a common word have hardly any chance."""
    from sentencepiece import SentencePieceProcessor

    words = Vocabulary(PIECE_BPE, 1.0)
    got = [(tuple(ids.tolist()), math.exp(log)) for _, _, ids, log, *_ in sample_texts([text], [7], words, k, 1)]
    assert len({p for p, _ in got}) == len(got)
    if len(text) > 50:
        assert len(got) == k
        return
    chance = segmentations(text, words, SentencePieceProcessor(model_file=PIECE_BPE))
    assert len(got) == min(k, len(chance))
    assert all(math.isclose(p, chance[path], rel_tol=1e-9) for path, p in got)


def test_segmentations_round_trip_and_repeat(spark, odd_documents):
    docs = odd_documents.repartition(3)
    got = sample_segmentations(docs, PIECE_BPE, k=2)
    again = sample_segmentations(docs.repartition(2), PIECE_BPE, k=2)
    key = lambda df: sorted((str(r["doc_id"]), r["rank"], r["ids_crc32"], r["log_prob"], r["log_inclusion"]) for r in df.collect())
    assert key(got) == key(again)
    texts = collections.Counter((r["doc_id"], r["text"] or "") for r in docs.collect())
    decoded = collections.Counter((r["doc_id"], r["text"]) for r in decode_pieces(got.filter("rank = 1"), PIECE_BPE).collect())
    assert decoded == texts


def test_texts_of_a_batch_are_taken_in_blocks():
    """Of a batch, few texts are there as strings and arrays at once; none is left out, and the samples are the same."""
    words = Vocabulary(PIECE_BPE, 1.0)
    texts = [None if i % 50 == 0 else "some words of a text " * 200 + str(i) for i in range(1, 601)] + ["long " * 300_000, "", "é"]
    batch = pa.record_batch({"doc_id": pa.array(range(603), pa.int64()), "text": pa.array(texts)})
    parts = list(_blocks(batch))
    assert pa.Table.from_batches(parts).equals(pa.Table.from_batches([batch]))
    assert all(sum(len((t or "").encode()) for t in p["text"].to_pylist()) <= 1_000_000 or p.num_rows == 1 for p in parts)
    assert list(_blocks(batch.slice(0, 0))) == []
    few = [t or "" for t in texts[:20]]
    whole = [(at, rank, ids.tolist(), log) for at, rank, ids, log, *_ in sample_texts(few, list(range(20)), words, 2, 1)]
    apart = [(i, rank, ids.tolist(), log) for i, t in enumerate(few) for _, rank, ids, log, *_ in sample_texts([t], [i], words, 2, 1)]
    assert whole == apart


def test_a_task_leaves_no_free_memory_behind():
    """What the allocators of a worker hold free is given back between batches and at the end, and all rows pass."""
    own = "/proc/self/smaps_rollup"

    def held():
        return int(re.search(r"\nPss_Anon:\s+(\d+)", Path(own).read_text())[1]) // 1024

    def task(batches):
        for batch in batches:
            # Far more than a batch, in many pieces.
            parts = [pa.array(np.arange(20_000)).cast(pa.string()) for _ in range(300)]
            blocks = [bytes(50_000) for _ in range(1000)]
            yield batch.append_column("n", pa.array([len(parts) + len(blocks)] * batch.num_rows))

    batches = [pa.record_batch({"x": pa.array([i])}) for i in range(5)]
    before = held()
    got = [b.to_pydict() for b in lean(task)(iter(batches))]
    assert got == [{"x": [i], "n": [1300]} for i in range(5)]
    assert held() - before < 60


def test_tokenizer_files_exist():
    assert all(public_tokenizers.path(x) for x in ("word_bpe_49k.json", "byte_bpe_50k.json", "piece_bpe_32k.model"))
