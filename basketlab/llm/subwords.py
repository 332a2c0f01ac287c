"""Token ids of whole texts from a tokenizer file, with each distinct piece encoded once.

Both kinds of tokenizer used here split a text into pieces before any merge: at white space
(which the word vocabulary drops and the byte vocabulary keeps as a piece's first blank),
and then between letters, digits and signs. Ids of a text are therefore the ids of its
pieces. A batch of texts is cut at single blanks, its distinct pieces are encoded by the
tokenizer's own model, and the ids are gathered. Texts whose cut could change the result
(white space next to a blank, characters whose treatment libraries may see differently, or an
added token of the file) are encoded whole.
"""

from __future__ import annotations

import unicodedata
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from tokenizers import Tokenizer

#: The patterns by which the two public tokenizers split, as their files state them.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Blocks of Latin letters; beyond them a piece goes to the tokenizer whole.
PLAIN = regex.compile(r"[\x00-\x7F¡-ɏ]*")
CACHE_PARTS = 600_000


def _byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: printable ones for themselves."""
    printable = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(printable)]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(others)}}


_LETTERS = _byte_letters()


class Encoder:
    """Encodes Arrow texts; kept per worker process, with the ids of parts seen before."""

    _open: dict[tuple[str, bool], "Encoder"] = {}

    def __init__(self, path: str, literal: bool):
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        if literal:
            self.tokenizer.encode_special_tokens = True
        added = [] if literal else self.tokenizer.get_added_tokens_decoder().values()
        self.added = "|".join(regex.escape(t.content) for t in added)
        self.word_level = self.tokenizer.normalizer is not None
        self.pattern = regex.compile(WORD_PATTERN if self.word_level else BYTE_PATTERN)
        self.width = np.dtype("<u2") if self.tokenizer.get_vocab_size() <= 1 << 16 else np.dtype("<u4")
        self.code = self.width.char
        self.known: dict[str, bytes] = {}

    @classmethod
    def open(cls, path: str, literal: bool = True) -> "Encoder":
        """``literal``: added tokens of the file that a text spells out are plain text, not the tokens themselves."""
        if (path, literal) not in cls._open:
            cls._open[path, literal] = cls(path, literal)
        return cls._open[path, literal]

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _part(self, part: str) -> list[int]:
        """Ids of one part that no rule splits further."""
        blank = part[:1] == " "
        if part.isascii() and part[blank:].isalnum():
            spelled = _LETTERS[32] + part[1:] if blank else part
        else:
            spelled = "".join(map(_LETTERS.__getitem__, part.encode()))
        return [t.id for t in self.model.tokenize(spelled)]

    def part(self, part: str) -> bytes:
        found = self.known.get(part)
        if found is None:
            found = array(self.code, self._part(part)).tobytes()
            if len(self.known) < CACHE_PARTS:
                self.known[part] = found
        return found

    def piece(self, piece: str) -> bytes:
        """Ids of a piece: a word, a word and one sign, or whatever the pattern finds in it."""
        body = piece[1:] if piece[:1] == " " else piece
        if not body.isascii() and not PLAIN.fullmatch(body):
            return np.array(self._whole(piece), self.width).tobytes()
        if self.word_level:
            piece = body = (body if body.isascii() else unicodedata.normalize("NFC", body)).lower()
        if body.isalpha():
            return self.part(piece)
        if body[:-1].isalpha() and body[-1] in ",.!?;:":
            return self.part(piece[:-1]) + self.part(piece[-1])
        return b"".join(map(self.part, self.pattern.findall(piece)))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(offsets, ids): text i has ``ids[offsets[i]:offsets[i + 1]]``; null is empty."""
        column = pc.fill_null(texts.cast(pa.large_string()), "")
        if self.word_level:
            column = pc.replace_substring(column, "\n", " ")
            odd = pc.match_substring_regex(column, r"[\t\v\f\r\x1c-\x1f]|[^\x00-\x{24F}]|[\x{80}-\x{A0}]")
        else:
            odd = pc.match_substring_regex(column, r" [\s\x1c-\x1f]|[\s\x1c-\x1f] |^ | $|[^\x00-\x{24F}]|[\x{80}-\x{A0}]")
        if self.added:
            odd = pc.or_(odd, pc.match_substring_regex(column, self.added))
        odd = odd.to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), pa.scalar("", pa.large_string()), column)
        lists = pc.split_pattern(plain, " ")
        pieces = lists.values
        heads = lists.offsets.to_numpy().astype(np.int64)
        if not self.word_level:
            # All but a text's first piece begin with the blank that was cut.
            marks = np.ones(len(pieces), bool)
            marks[heads[:-1][np.diff(heads) > 0]] = False
            coded = pieces.dictionary_encode()
            codes = coded.indices.to_numpy().astype(np.int64) * 2 + marks
            words = coded.dictionary.to_pylist()
            seen = np.zeros(2 * len(words), bool)
            seen[codes] = True
            used, codes = np.flatnonzero(seen), (np.cumsum(seen) - 1)[codes]
            vocabulary = [(" " if u & 1 else "") + words[u >> 1] for u in used.tolist()]
        else:
            coded = pieces.dictionary_encode()
            codes = coded.indices.to_numpy().astype(np.int64)
            vocabulary = coded.dictionary.to_pylist()
        # A part seen before is a piece of its own, too: no rule splits it.
        known, piece = self.known.get, self.piece
        found = [known(p) or piece(p) for p in vocabulary]
        return self._gathered(found, codes, heads, column, odd)

    def _gathered(self, found, codes, heads, column, odd) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.width.itemsize
        flat = np.frombuffer(b"".join(found), self.width)
        begins = np.cumsum(sizes) - sizes
        lengths = sizes[codes]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        where = np.arange(ends[-1]) + np.repeat(begins[codes] - ends[:-1], lengths)
        ids, offsets = flat[where], ends[heads]
        if not odd.any():
            return offsets, ids
        parts = [ids[a:b] for a, b in zip(offsets[:-1], offsets[1:])]
        for i in np.flatnonzero(odd).tolist():
            parts[i] = np.array(self._whole(column[i].as_py()), self.width)
        return np.concatenate([[0], np.cumsum([len(p) for p in parts])]), np.concatenate(parts)
