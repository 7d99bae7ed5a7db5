"""Encoding whole texts through memoised white-space-separated chunks.

A byte-level pre-token never holds a non-space followed by a space, so a text without adjacent white space falls
apart at its single spaces and newlines into chunks whose token ids do not depend on their neighbours. Texts repeat
most of their chunks: each is looked up once a batch, and a bounded memo replaces most calls of the encoder. A chunk that it lacks and that is a plain word
goes to a shorter path of the encoder, which need not look for pre-tokens. Texts with adjacent white space take the
encoder's whole-text path instead; all paths give the same ids.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from sluice.llm.common import Memo

#: Trailing marks that form one pre-token of their own behind a word.
MARKS = ".,;:!?*$#%&|)]}"
#: Bytes of the memo of chunks; a worker holds one for each encoder that it uses, and an eighth of it for marks.
LIMIT = 256 << 20


def plain(word: str) -> bool:
    """Whether the word is Latin letters below U+0250 only, on which all versions of Unicode agree, but for one whose lower case is no letter."""
    return word.isalpha() and (word.isascii() or (max(word) < "\u0250" and "\u0130" not in word))


class TextEncoder:
    """Encodes texts by ``make(chunk) -> bytes`` of their chunks between spaces and newlines."""

    def __init__(self, make, limit: int = LIMIT):
        self.chunks = Memo(make, limit)

    def _split(self, texts: pa.Array) -> pa.ListArray:
        return pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")

    def _joined(self, texts: pa.Array) -> tuple[memoryview, np.ndarray, np.ndarray]:
        """The ids of all texts after each other, where each text begins, and the texts with a chunk that has none."""
        split = self._split(texts)
        bounds = split.offsets.to_numpy()
        words = split.values.slice(bounds[0], bounds[-1] - bounds[0]).dictionary_encode()
        of = pa.array(list(map(self.chunks.__getitem__, words.dictionary.to_numpy(zero_copy_only=False).tolist())), pa.large_binary())
        ids, bounds = of.take(words.indices), bounds - bounds[0]
        starts = np.frombuffer(ids.buffers()[1], np.int64, len(ids) + 1, 8 * ids.offset)[bounds]
        without = np.flatnonzero(ids.is_null().to_numpy(zero_copy_only=False)) if ids.null_count else np.zeros(0, np.int64)
        return memoryview(ids.buffers()[2] or b""), starts, np.unique(np.searchsorted(bounds, without, "right") - 1)

    def texts(self, texts: pa.Array) -> list[bytes]:
        """The ids of each text of a batch; nulls are empty texts."""
        raw, starts, _ = self._joined(texts.fill_null(""))
        return [bytes(raw[a:b]) for a, b in zip(starts.tolist(), starts[1:].tolist())]

    def __call__(self, text: str) -> bytes:
        return self.texts(pa.array([text], pa.string()))[0]


class ChunkEncoder(TextEncoder):
    """``piece_ids(text) -> bytes`` (little-endian uint32 ids) must be right for any text; newline must be one id.

    ``word_ids`` gives the same for a plain word with at most one space before it.
    """

    def __init__(self, piece_ids, word_ids, limit: int = LIMIT):
        self.piece_ids, self.word_ids = piece_ids, word_ids
        self.newline = piece_ids("\n")
        assert len(self.newline) == 4, "a newline must be one token"
        self.marks = Memo(piece_ids, limit // 8)
        super().__init__(self._chunk, limit)

    def _chunk(self, chunk: str):
        """A chunk's ids; None if its edge is white space, which needs its neighbours."""
        word = chunk[1:] if chunk[:1] == "\n" else chunk
        head, lead = (self.newline, "") if chunk[:1] == "\n" else (b"", " ")
        if plain(word):
            return head + self.word_ids(lead + word)
        if not word or word[0].isspace() or word[-1].isspace():
            return None
        base = word.rstrip(MARKS)
        if base != word and base.isalpha():
            return self.chunks[chunk[: len(base) - len(word)]] + self.marks[word[len(base) :]]
        return head + (self.piece_ids if base else self.marks.__getitem__)(lead + word)

    def _split(self, texts: pa.Array) -> pa.ListArray:
        # a newline before the text tells its first chunk, which has no space before it
        return pc.split_pattern(pc.binary_join_element_wise("\n", pc.replace_substring(texts, "\n", " \n"), ""), " ")

    def texts(self, texts: pa.Array) -> list[bytes]:
        texts = texts.fill_null("")
        raw, starts, whole = self._joined(texts)
        out = [bytes(raw[a + 4 : b]) for a, b in zip(starts.tolist(), starts[1:].tolist())]
        for i in whole.tolist():
            out[i] = self.piece_ids(texts[i].as_py())
        return out
