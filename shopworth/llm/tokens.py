"""Subword ids of whole texts, remembered per word so that repeats cost a look-up.

Both tokenizers here treat the stretches between certain spaces independently of
one another: no match of their splitting pattern crosses such a space, and their
normalisation does not either. A text is therefore cut there, each stretch is
encoded once per worker and kept, and the ids of a text are the joined ids of its
stretches. Ids travel as little-endian unsigned 32-bit integers.
"""

from __future__ import annotations

import base64
import re
from array import array
from functools import lru_cache

#: Stretches remembered in each of two generations, and twice as many words; the
#: older generation is dropped when the newer is full. About 300 bytes each.
REMEMBERED = 1 << 16
#: Characters of a text that are cut up at a time.
SLICE = 1 << 20

_SPACE_AFTER_SPACE = re.compile(r"\s ")
_CUT = re.compile(r"(?<=\S) ")
#: Marks after a word that are one match of the splitting pattern, however many.
_CLOSING = ",.;:!?)#$%&*"


def byte_characters() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies.

    Visible Latin-1 characters stand for themselves; the other bytes take the code
    points from 256 on, in order.
    """
    visible = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b if b in visible else next(spare)) for b in range(256)]


_AS_CHARACTERS = dict(enumerate(byte_characters()))


def characters(data: bytes) -> str:
    """One character per byte."""
    return data.decode("latin-1").translate(_AS_CHARACTERS)


def read_ranks(path: str) -> dict[bytes, int]:
    """A rank file: one base64 token and its rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


def merges_of(ranks: dict[bytes, int]) -> list[tuple[str, str]]:
    """The pair that makes each token of more than one byte, in order of rank.

    Merging a token's own bytes by lower ranks alone ends in exactly that pair.
    """
    merges = []
    for token, rank in sorted(ranks.items(), key=lambda item: item[1]):
        if len(token) < 2:
            continue
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            pairs = [ranks.get(a + b, rank) for a, b in zip(parts, parts[1:], strict=False)]
            best = min(pairs)
            if best >= rank:
                raise ValueError(f"rank {rank} can't be reached by merges of lower ranks")
            at = pairs.index(best)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        merges.append((characters(parts[0]), characters(parts[1])))
    return merges


def byte_bpe_json(ranks: dict[bytes, int]) -> str:
    """A byte-level tokenizer with these ranks, as the tokenizers library writes it."""
    from tokenizers import Tokenizer, models, pre_tokenizers

    vocabulary = {characters(token): rank for token, rank in ranks.items()}
    tokenizer = Tokenizer(models.BPE(vocab=vocabulary, merges=merges_of(ranks)))
    tokenizer.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=True)
    return tokenizer.to_str()


class _Remembered(dict):
    """Ids of stretches; what is missing is encoded on first use."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most, self.older = encode, most, {}

    def __missing__(self, stretch):
        ids = self.older.get(stretch)
        if ids is None:
            ids = self.encode(stretch)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[stretch] = ids
        return ids


class _Encoder:
    """Encodes stretches by the tokenizers library.

    Stretches of plain Latin letters, perhaps with marks after them, are one match
    of the splitting pattern or two, so the merges are asked for directly. All
    others go through the whole tokenizer.
    """

    def __init__(self, definition: str, remembered: int = REMEMBERED):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.tokenizer.encode_special_tokens = True
        self.merge = self.tokenizer.model.tokenize
        self.known = _Remembered(self.stretch, remembered)
        self.pieces = _Remembered(self.piece, 2 * remembered)

    def piece(self, text: str) -> bytes:
        """Ids of one match of the splitting pattern."""
        return array("I", [token.id for token in self.merge(characters(text.encode()))]).tobytes()

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()


class ByteEncoder(_Encoder):
    """Byte-level merges: a stretch is a word with the space before it."""

    def __init__(self, definition: str):
        super().__init__(definition)
        self.first = _Remembered(lambda data: self.ids(data.decode()), 1 << 12)

    def stretch(self, data: bytes) -> bytes:
        return self.ids(" " + data.decode())

    def ids(self, text: str) -> bytes:
        word = text.rstrip(_CLOSING)
        if word and max(word) < "ɐ" and word.removeprefix(" ").isalpha():
            ids, marks = self.pieces[word], text[len(word) :]
            return ids + self.pieces[marks] if marks else ids
        return self.whole(text)

    def encode(self, text: str) -> bytes:
        if len(text) <= SLICE:
            return self._slice(text)
        parts, start = [], 0
        while len(text) - start > SLICE and (cut := _CUT.search(text, start + SLICE)):
            parts.append(self._slice(text[start : cut.start()]))
            start = cut.start()
        return b"".join([*parts, self._slice(text[start:])])

    def _slice(self, text: str) -> bytes:
        if not text:
            return b""
        if _SPACE_AFTER_SPACE.search(text) is None:
            first, *rest = text.encode().split(b" ")
            return (self.first[first] if first else b"") + b"".join(map(self.known.__getitem__, rest))
        starts = [0, *(m.start() for m in _CUT.finditer(text))]
        found = []
        for start, end in zip(starts, [*starts[1:], len(text)], strict=True):
            found.append(self.first[text[start:end].encode()] if end > start else b"")
        return b"".join(found)


class WordEncoder(_Encoder):
    """Merges within lower-case words: a stretch lies between ASCII white space."""

    def stretch(self, data: bytes) -> bytes:
        text = data.decode()
        word = text.rstrip(_CLOSING)
        lower = word.lower()
        if word and max(word) < "ɐ" and word.isalpha() and lower.isalpha():
            ids, marks = self.pieces[lower], text[len(word) :]
            return ids + self.pieces[marks] if marks else ids
        return self.whole(text)

    def encode(self, text: str) -> bytes:
        # In ASCII, lower-casing first changes nothing and makes more stretches equal.
        words = (text.lower() if text.isascii() else text).encode().split()
        return b"".join(map(self.known.__getitem__, words))


@lru_cache(maxsize=2)
def byte_encoder(definition: str) -> ByteEncoder:
    """One per worker, kept between tasks."""
    return ByteEncoder(definition)


@lru_cache(maxsize=2)
def word_encoder(definition: str) -> WordEncoder:
    return WordEncoder(definition, 2 * REMEMBERED)
