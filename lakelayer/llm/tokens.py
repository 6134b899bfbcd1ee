"""Tokenizer ids for columns of whole texts.

Both vocabularies split a text into small pieces before merging, and no piece
spans a place where white space follows other characters. Texts of plain Latin
characters are therefore split at white space by Arrow, the distinct chunks of
a batch are given to the tokenizer's model (with a bounded memo of pieces), and
the ids are gathered with numpy. Any other text is given to the tokenizer
whole. Both ways return the tokenizer's own ids.
"""

from __future__ import annotations

import os
import re
import sys
import unicodedata
from array import array
from collections.abc import Iterator
from types import ModuleType

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from lakelayer.llm.words import slices

# Plain: printable characters up to Latin Extended-B; white space is blank and newline only.
# (U+0130 is left out: its lower case is not one of them.)
PLAIN_CHARS = ["\n", *map(chr, range(0x20, 0x7F)), *map(chr, range(0xA1, 0x130)), *map(chr, range(0x131, 0x250))]
NOT_PLAIN = "[^\n\x20-\x7e\u00a1-\u012f\u0131-\u024f]"
SPACE_RUN = "[ \n][ \n]"
PIECES_KEPT = 150_000  # twice: those met lately, and those met before
SLICE_BYTES = 12_000_000
GATHER_TOKENS = 2_000_000

# How the two public vocabularies split a text into pieces (their
# own patterns; L and N stand for the classes of letters and numbers).
WORD_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d|[L]+|[N]|[^\sLN]+"
BYTE_PIECES = r"'s|'t|'re|'ve|'m|'ll|'d| ?[L]+| ?[N]+| ?[^\sLN]+|\s+(?!\S)|\s+"


def public_path(name: str) -> str:
    """Place of a public vocabulary file; a caller may pass any other path instead."""
    import public_tokenizers

    return public_tokenizers.path(name)


def piece_pattern(pattern: str) -> re.Pattern:
    """``pattern`` with its classes spelled out for plain characters."""
    of = {k: "".join(c for c in PLAIN_CHARS if unicodedata.category(c)[0] == k) for k in "LN"}
    return re.compile(pattern.translate({ord(k): v for k, v in of.items()}))


class ColumnEncoder:
    """``encode(texts)`` gives each text's ids as little-endian uint32 bytes.

    ``keeps_space``: whether white space is part of the ids (byte-level
    vocabularies) or dropped (word vocabularies, which also lower-case). A text
    that holds the string of a special token gets that token's id there, as the
    tokenizer gives it; with ``special_as_text`` the string is ordinary text.
    """

    def __init__(self, path: str, keeps_space: bool, pieces_kept: int = PIECES_KEPT, special_as_text: bool = False):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = [] if special_as_text else [token.content for token in added]
        self.keeps_space = keeps_space
        self.odd = f"{NOT_PLAIN}|{SPACE_RUN}" if keeps_space else NOT_PLAIN
        self.split = piece_pattern(BYTE_PIECES if keeps_space else WORD_PIECES).findall
        spell = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.spelled = {ord(c): spell(c)[0][0] for c in PLAIN_CHARS}
        self.pieces: dict[str, bytes] = {}
        self.earlier: dict[str, bytes] = {}
        self.kept = pieces_kept

    def _piece(self, piece: str) -> bytes:
        """Ids of a piece that is not among ``pieces``; they are kept there, the oldest half goes when that is full."""
        ids = self.earlier.get(piece)
        if ids is None:
            ids = array("I", [t.id for t in self.tokenizer.model.tokenize(piece.translate(self.spelled))]).tobytes()
        if len(self.pieces) >= self.kept:
            self.earlier, self.pieces = self.pieces, {}
        self.pieces[piece] = ids
        return ids

    def _chunk(self, chunk: str, blank: str) -> bytes:
        """Ids of a chunk; ``blank`` stands before it in the text, if that is part of the ids."""
        text = blank + chunk if self.keeps_space else chunk.lower()
        known = self.pieces.get(text)
        if known is not None:
            return known
        if chunk.isascii() and chunk.isalpha():  # ASCII letters alone are one piece
            return self._piece(text)
        return b"".join([self.pieces.get(piece) or self._piece(piece) for piece in self.split(text)])

    def _gathered(self, texts: pa.Array) -> Iterator[bytes]:
        """Ids of plain texts."""
        lists = pc.split_pattern(texts, " ") if self.keeps_space else pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        chunks = coded.dictionary.to_pylist()
        found = [self._chunk(chunk, " ") for chunk in chunks]
        ends = np.cumsum(np.fromiter(map(len, [b"", *found]), dtype=np.int64) // 4)
        ids = np.frombuffer(b"".join(found), dtype="<u4")
        at = coded.indices.to_numpy(zero_copy_only=False)
        starts, lengths = ends[:-1][at], np.diff(ends)[at]
        offsets = lists.offsets.to_numpy() - lists.offsets[0].as_py()
        first = [b""] * len(texts)
        if self.keeps_space:  # the first chunk of a text has no blank before it
            full = np.flatnonzero(np.diff(offsets))
            lengths[offsets[full]] = 0
            for row in full.tolist():
                head = chunks[at[offsets[row]]]
                first[row] = self._chunk(head, "")
        before = np.concatenate((np.zeros(1, np.int64), np.cumsum(lengths)))[offsets]
        row = 0
        while row < len(texts):
            stop = max(row + 1, int(np.searchsorted(before, before[row] + GATHER_TOKENS, side="right")) - 1)
            own = slice(offsets[row], offsets[stop])
            size = lengths[own]
            shift = np.repeat(starts[own] - (np.cumsum(size) - size), size)
            flat = ids[shift + np.arange(len(shift))]
            cuts = (before[row:stop + 1] - before[row]).tolist()
            for i, (a, b) in enumerate(zip(cuts, cuts[1:])):
                yield first[row + i] + flat[a:b].tobytes()
            row = stop

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """Yield the ids of each text, in order; null counts as empty."""
        for part in slices(texts, SLICE_BYTES):
            yield from self._encode(part.fill_null(""))

    def _encode(self, texts: pa.Array) -> Iterator[bytes]:
        odd = pc.match_substring_regex(texts, self.odd)
        for string in self.special:
            odd = pc.or_(odd, pc.match_substring(texts, string))
        plain = self._gathered(texts.filter(pc.invert(odd)))
        for strange, text in zip(odd, texts):
            if strange.as_py():
                yield array("I", self.tokenizer.encode(text.as_py(), add_special_tokens=False).ids).tobytes()
            else:
                yield next(plain)


def worker_encoder(path: str, keeps_space: bool) -> ColumnEncoder:
    """This Python worker's encoder; Spark reuses workers, so its memo serves later tasks too.

    Kept outside this module because functions reach executors by value.
    """
    held = sys.modules.setdefault("_lakelayer_llm_worker", ModuleType("_lakelayer_llm_worker"))
    known = held.__dict__.setdefault("encoders", {})
    if (path, keeps_space) not in known:
        known[path, keeps_space] = ColumnEncoder(path, keeps_space)
    return known[path, keeps_space]
