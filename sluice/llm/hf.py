"""Encoders over files of the tokenizers library, one per worker process."""

from __future__ import annotations

import functools
import os
import struct

from sluice.llm.chunks import LIMIT, MARKS, ChunkEncoder, TextEncoder, plain
from sluice.llm.common import Memo


def _load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _bytes(ids: list[int]) -> bytes:
    return struct.pack(f"<{len(ids)}I", *ids)


def _byte_letters() -> dict[int, str]:
    """The letter that byte-level files write for each byte."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    return dict(zip([*own, *(b for b in range(256) if b not in own)], map(chr, [*own, *range(256, 512 - len(own))])))


def _one_piece(tokenizer):
    """Ids of a text that is one pre-token and no added token: the model alone, on the text's byte letters."""
    tokenize, letters = tokenizer.model.tokenize, _byte_letters()

    def ids(text: str) -> bytes:
        if not (text.isascii() and text.isalpha()):
            text = text.encode().decode("latin-1").translate(letters)
        return _bytes([t.id for t in tokenize(text)])

    return ids


@functools.cache
def byte_level(path: str, limit: int = LIMIT):
    """``encode(text) -> bytes`` of little-endian uint32 ids for a byte-level BPE file; ``encode.texts`` takes a batch.

    ``limit`` bounds the bytes of its memo.
    """
    tokenizer = _load(path)
    return ChunkEncoder(lambda text: _bytes(tokenizer.encode(text, add_special_tokens=False).ids), _one_piece(tokenizer), limit)


@functools.cache
def lower_words(path: str):
    """The same for a BPE file that lower-cases, drops white space and ends words by a suffix.

    White space separates pre-tokens there, so every chunk between spaces or newlines stands alone.
    """
    tokenizer = _load(path)
    word_ids = _one_piece(tokenizer)
    marks = Memo(word_ids, LIMIT // 8)

    def make(chunk: str) -> bytes:
        if plain(chunk):
            return word_ids(chunk.lower())
        base = chunk.rstrip(MARKS)
        if base != chunk and plain(base):
            return encode.chunks[base] + marks[chunk[len(base) :]]
        return _bytes(tokenizer.encode(chunk, add_special_tokens=False).ids)

    encode = TextEncoder(make)
    return encode


@functools.cache
def vocabulary_size(path: str) -> int:
    return _load(path).get_vocab_size(with_added_tokens=True)
