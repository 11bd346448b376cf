"""Whole-text encoding with a tokenizers file, memoised by white-space delimited pieces.

Both vocabularies used here split at white space before they merge, so the ids of a text are the ids of its
pieces one after another. A worker keeps the ids of the pieces it has met; texts with white space other than
blanks and line feeds, or with the string of an added token, are encoded in one call instead. ``encode_bytes`` therefore
returns exactly what ``Tokenizer.encode(text, add_special_tokens=False)`` returns; as there, the string of an added token
in a text is that token.

``encode_all`` gives the same for many texts: it cuts a block of them into pieces as arrays and looks each different
piece of the block up once.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer, pre_tokenizers

from sentloom.llm.worker import kept

#: Pieces kept by a worker in each of two generations. It bounds memory and never changes a result.
MEMORY = 200_000
#: Characters of the texts that are cut at once.
BLOCK = 1_000_000

#: White space and separators other than the blank and the line feed.
_RARE = re.compile(r"[\t\v\f\r\x1c-\x1f\x85\xa0 ᠎ -‏    ⁠　﻿]")
_BLANK_JOINED = re.compile(r" ?[^ \n]+|[ \n]+(?![^ \n])|[ \n]")

#: A word of letters whose lower case and composition are plain, and the signs behind it.
_PLAIN = re.compile(r"( ?)([A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)([!-&(-/:-@\[-`{-~]*)")

#: The same in the syntax of Arrow: the word, with the blank before it, and the signs.
_PARTS = r"^(?P<word> ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\xff]+)(?P<signs>[!-&(-/:-@\[-`{-~]*)$"


class _Ids(dict):
    """Piece -> its ids as little-endian unsigned 32-bit integers; the pieces not met for long are forgotten."""

    def __init__(self, tokenizer, blank_joins: bool):
        self.tokenizer, self.blank_joins = tokenizer, blank_joins
        self.old: dict[str, bytes] = {}
        # Byte-level models name each byte by a letter; what the pre-tokenizer makes of the byte is its name.
        level = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
        names = {b: level.pre_tokenize_str(chr(b))[0][0] for b in range(128)}
        for high in range(0xC0, 0x100):
            lead, tail = level.pre_tokenize_str(chr(high))[0][0]
            names[0xC3], names[high - 0x40] = lead, tail
        self.names = names

    def encode(self, piece: str) -> bytes:
        ids = self.tokenizer.encode(piece, add_special_tokens=False).ids
        return np.asarray(ids, dtype="<u4").tobytes()

    def encode_word(self, word: str) -> bytes:
        """Ids of a plain word, by the merges alone: nothing else in the tokenizer changes or cuts it."""
        named = (word if self.blank_joins else word.lower()).encode().decode("latin-1").translate(self.names)
        return np.array([t.id for t in self.tokenizer.model.tokenize(named)], "<u4").tobytes()

    def __missing__(self, piece: str) -> bytes:
        out = self.old.get(piece)
        if out is None:
            plain = _PLAIN.fullmatch(piece)
            if plain is None or plain[1] and not self.blank_joins:
                out = self.encode(piece)
            elif plain[3]:
                out = self[plain[1] + plain[2]] + self[plain[3]]
            else:
                out = self.encode_word(piece)
        if len(piece) <= 64:
            if len(self) >= MEMORY:
                self.old = dict(self)
                self.clear()
            self[piece] = out
        return out


class Encoder:
    """``blank_joins``: whether a blank belongs to the piece behind it (byte-level) or is dropped."""

    def __init__(self, path: str):
        self.tokenizer = Tokenizer.from_file(path)
        # Fixed strings in both vocabularies: none is matched after normalising.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.blank_joins = self.tokenizer.encode(" a", add_special_tokens=False).ids != (
            self.tokenizer.encode("a", add_special_tokens=False).ids
        )
        self.ids = _Ids(self.tokenizer, self.blank_joins)

    def whole(self, text: str) -> bool:
        """Whether a text has to be encoded in one call."""
        return _RARE.search(text) is not None or any(a in text for a in self.added)

    def encode_bytes(self, text: str) -> bytes:
        if not text:
            return b""
        if self.whole(text):
            return self.ids.encode(text)
        if self.blank_joins:
            pieces = _BLANK_JOINED.findall(text)
        else:
            pieces = text.replace("\n", " ").split(" ")
        return b"".join(map(self.ids.__getitem__, pieces))

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """``encode_bytes`` of each text."""
        block, size = [], 0
        for text in texts:
            block.append(text)
            size += len(text)
            if size >= BLOCK:
                yield from self._encode_block(block)
                block, size = [], 0
        yield from self._encode_block(block)

    def _encode_block(self, texts: list[str]) -> Iterator[bytes]:
        apart = {i for i, text in enumerate(texts) if self.whole(text)}
        raw = [b"" if i in apart else text.encode() for i, text in enumerate(texts)]
        bounds = np.cumsum([0, *map(len, raw)])
        codes = np.frombuffer(b"".join(raw), np.uint8)
        pieces, first = self._pieces(codes, bounds)
        encoded = pieces.dictionary_encode()
        parts = pc.extract_regex(encoded.dictionary, _PARTS)
        word = pc.if_else(parts.is_valid(), parts.field("word"), encoded.dictionary)
        signs = pc.if_else(parts.is_valid(), parts.field("signs"), pa.scalar("", pa.large_string()))
        ids = pc.binary_join_element_wise(self._look_up(word), self._look_up(signs), pa.scalar(b"", pa.large_binary()))
        ids = ids.take(encoded.indices)
        _, offsets, data = ids.buffers()
        ends = np.frombuffer(offsets, np.int64, len(ids) + 1)[first].tolist() if len(ids) else [0] * (len(texts) + 1)
        data = memoryview(data or b"")
        for i, text in enumerate(texts):
            yield self.ids.encode(text) if i in apart else bytes(data[ends[i] : ends[i + 1]])

    def _look_up(self, pieces: pa.Array) -> pa.Array:
        """The ids of each piece; different pieces are looked up once."""
        encoded = pieces.dictionary_encode()
        different = encoded.dictionary.to_numpy(zero_copy_only=False).tolist()
        return pa.array([self.ids[p] for p in different], pa.large_binary()).take(encoded.indices)

    def _pieces(self, codes: np.ndarray, bounds: np.ndarray) -> tuple[pa.Array, np.ndarray]:
        """The pieces of texts that lie one after another in UTF-8, and the number of pieces before each text."""
        space = (codes == 0x20) | (codes == 0x0A)
        edge = np.zeros(len(codes) + 1, bool)
        edge[bounds] = True
        # Whether the neighbours in the same text are white space.
        before, after = np.zeros(len(codes), bool), np.ones(len(codes), bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        before[edge[:-1]] = False
        after[edge[1:]] = True
        if self.blank_joins:
            # White space at its first place and, with a word behind it, at its last; words, but behind a blank.
            begins = space & (~before | ~after)
            joined = np.zeros(len(codes), bool)
            joined[1:] = codes[:-1] == 0x20
            begins |= ~space & before & ~joined
        else:
            begins = ~space & before
        begins |= edge[:-1] if self.blank_joins else edge[:-1] & ~space
        starts = np.flatnonzero(begins)
        first = np.searchsorted(starts, bounds)
        if not self.blank_joins:
            starts = starts - np.searchsorted(np.flatnonzero(space), starts)
            codes = codes[~space]
        offsets = np.concatenate([starts, [len(codes)]]).astype(np.int64)
        return pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(codes)), first


def encoder(path: str) -> Encoder:
    """One encoder per worker and file."""
    state = kept("encoding")
    if getattr(state, "path", None) != path:
        state.path, state.encoder = path, Encoder(path)
    return state.encoder
