"""Token ids of a tokenizer file inside tasks: every distinct run of letters goes to the tokenizer once per task.

The tokenizer drops white space and splits at it, so the ids of a text are those of its pieces in order. Arrow cuts the texts at spaces and finds the distinct pieces of a
slice; a piece that is letters followed by other ASCII signs is cut further, as the tokenizer cuts it, and letters below U+0250 go to its model directly,
lower-cased and in the model's spelling of bytes. Python sees each distinct run of letters of a slice once, and all else is done on arrays.
"""

from __future__ import annotations

import os
import unicodedata
from array import array
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lexforge.llm.batches import no_collection
from lexforge.llm.bpe import gather

#: ASCII signs that the tokenizer splits from letters before them; the apostrophe is not one of them
_SIGNS = "".join(c for c in map(chr, range(0x21, 0x7F)) if not c.isalnum() and c != "'")
KEPT_PIECES = 700_000


def byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: itself if it is visible, else one from U+0100 on."""
    visible = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in visible else chr(next(others)) for b in range(256)]


_AS_LETTER = {b: letter for b, letter in enumerate(byte_letters()) if chr(b) != letter}


def _spelled(letters: str) -> str | None:
    """Letters as the model knows them, or None if their lower case or normal form needs the tokenizer's own rules."""
    if not letters.isalpha():
        return None
    if letters.isascii():
        return letters.lower()
    if max(letters) >= "\u0250" or "İ" in letters or not unicodedata.is_normalized("NFC", letters):
        return None
    return letters.lower().encode().decode("latin-1").translate(_AS_LETTER)


@lru_cache(maxsize=4)
def load_tokenizer(path: str, special: bool = True):
    """The tokenizer of a file; strings of its special tokens in a text are these tokens as the file says, or ordinary text if ``special`` is off."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    found = Tokenizer.from_file(path)
    found.encode_special_tokens = not special
    return found


class _Known(dict):
    """{string: its place}; a string that is looked up for the first time is encoded then. ``plain`` says that it is letters which the model takes directly."""

    def __init__(self, tokenizer):
        super().__init__()
        self.tokenizer, self.tokenize = tokenizer, tokenizer.model.tokenize
        self.ids, self.ends, self.plain = array("i"), array("q", [0]), bytearray()

    def __missing__(self, piece: str) -> int:
        spelled = piece if piece.isascii() and piece.isalpha() and piece.islower() else _spelled(piece)
        if spelled is None:
            self.ids.extend(self.tokenizer.encode(piece, add_special_tokens=False).ids)
        else:
            self.ids.extend([t.id for t in self.tokenize(spelled)])
        self[piece] = place = len(self.plain)
        self.ends.append(len(self.ids))
        self.plain.append(spelled is not None)
        return place

    def places(self, strings: pa.Array) -> np.ndarray:
        """The place of each string; a string that occurs again is looked up once."""
        found = strings.dictionary_encode()
        words = found.dictionary.to_pylist()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))[found.indices.to_numpy()]


class PieceEncoder:
    """Encodes texts of one task by the tokenizer of a file that lower-cases and drops white space."""

    def __init__(self, path: str, special: bool = True):
        self.tokenizer = load_tokenizer(path, special)
        self.reset()

    def reset(self) -> None:
        self.known = _Known(self.tokenizer)

    def _cut(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Of each piece the place of its letters and that of the signs behind them, or that of the whole piece and no signs."""
        letters = pc.utf8_rtrim(pieces, characters=_SIGNS)
        # capitals make no difference to letters, so they needn't be strings of their own
        first = self.known.places(pc.if_else(pc.ascii_is_alpha(letters), pc.ascii_lower(letters), letters))
        second = np.full(len(pieces), self.known[""])
        ends = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset + 1:pieces.offset + 1 + len(pieces)]
        sizes = (pc.binary_length(pieces).to_numpy() - pc.binary_length(letters).to_numpy()).astype(np.int64)
        plain = np.frombuffer(self.known.plain, bool)[first]
        # a few signs are a number that tells them; longer rows of signs go with their letters
        cut = np.flatnonzero(plain & (sizes > 0) & (sizes <= 7))
        if len(cut):
            raw = np.frombuffer(pieces.buffers()[2], np.uint8)
            back = np.arange(7)
            codes = np.where(back < sizes[cut, None], raw[np.maximum(ends[cut, None] - 1 - back, 0)], 0).astype(np.int64)
            kinds, which = np.unique((codes << (8 * back)).sum(axis=1), return_inverse=True)
            second[cut] = np.array([self.known[k.to_bytes(7, "big").lstrip(b"\0").decode()] for k in kinds.tolist()])[which]
        whole = np.flatnonzero((sizes > 0) & ~(plain & (sizes <= 7)))
        if len(whole):
            first[whole] = self.known.places(pieces.take(pa.array(whole)))
        return first, second

    @no_collection()
    def encode(self, texts: pa.Array | list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """(ids, offsets): offsets[i]:offsets[i+1] are the ids of text i."""
        if len(self.known) > KEPT_PIECES:
            self.reset()
        given = (texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())).cast(pa.large_string()).fill_null("")
        lists = pc.split_pattern(pc.replace_substring(given, "\n", " "), " ")
        counts = np.diff(lists.offsets.to_numpy())
        words = lists.flatten().dictionary_encode()
        first, second = self._cut(words.dictionary)
        at = words.indices.to_numpy()
        places = np.stack([first[at], second[at]], axis=1).ravel()
        return gather(np.array(self.known.ids, np.int32), np.array(self.known.ends, np.int64), places, 2 * counts)
