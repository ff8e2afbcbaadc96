"""Whole texts through a ``tokenizers`` model, each distinct word encoded once per Python worker.

A blank between two characters that are no white space ends a pre-token in both vocabularies used here, so a
text's ids are the ids of its blank-separated chunks in a row. Chunks of plain letters and marks are taken
apart as the pre-tokenizer would and go to the library's BPE model; a chunk with any other character goes
through the library's whole encoder, and so does a text with adjoining white space.
"""

from __future__ import annotations

import os
import re
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from siftlake.llm.common import Chunks, Known

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: Letters that stand alone under NFC and lower-case one to one, common marks, and line ends.
_PIECES = re.compile(r"[A-Za-zÀ-ÖØ-öø-ÿ]+|[.,!?;:|#*$%&]+|\n")
#: Entries of the caches of a worker; some 200 bytes each.
CHUNKS, PIECES = 500_000, 700_000


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}


_LETTERS = byte_letters()
#: Marks between a letter and a blank or the text's end.
_MARKS = r"([A-Za-zÀ-ÖØ-öø-ÿ])([.,!?;:|#*$%&]+)( |$)"


def parted(texts: pa.Array) -> pa.Array:
    """Texts with the same ids where white space and case are dropped: A-Z lower-cased, line ends as blanks, and a blank between
    a word and the marks that end it. Far fewer chunks are distinct then."""
    return pc.replace_substring_regex(pc.ascii_lower(pc.replace_substring(texts, "\n", " ")), _MARKS, r"\1 \2\3")


#: By number of ids, what packs them as little-endian unsigned 32-bit integers.
_PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]


class CachedEncoder:
    """``blank``: the vocabulary keeps a blank with the word after it; else white space and case are dropped.

    ``plain``: the strings of added tokens are ordinary text; else they get their ids, as the library does.
    """

    def __init__(self, path: str, blank: bool, plain: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = plain
        self.model, self.blank = self.tokenizer.model, blank
        self.added = () if plain else tuple(x.content.lower() for x in self.tokenizer.get_added_tokens_decoder().values())
        self.added_start = os.path.commonprefix(self.added)
        self.chunks: dict[str, bytes | None] = Known(CHUNKS)
        self.pieces: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        """Ids of a text by the library alone, as little-endian unsigned 32-bit integers."""
        return np.asarray(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _letters(self, letters: str) -> bytes:
        tokens = self.model.tokenize(letters)
        return _PACK[len(tokens)](*[t.id for t in tokens]) if len(tokens) < len(_PACK) else np.array([t.id for t in tokens], "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = self._letters(piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(_LETTERS))
            if len(self.pieces) >= PIECES:
                self.pieces.clear()
            self.pieces[piece] = ids
        return ids

    def chunk(self, chunk: str, before: str) -> bytes | None:
        """Ids of a chunk, None where the cut before or after it is not safe or the chunk holds an added token."""
        if self.blank and (not chunk or chunk[0].isspace() or chunk[-1].isspace()):
            return None
        if chunk.isascii() and chunk.isalpha():
            return self._piece(before + chunk) if self.blank else self._letters(chunk.lower())
        if self.added and self.added_start in chunk.lower() and any(x in chunk.lower() for x in self.added):
            return None
        found = _PIECES.findall(chunk)
        if sum(map(len, found)) != len(chunk) or "\n\n" in chunk:
            return self.whole(before + chunk)
        if self.blank:
            if found:
                found[0] = before + found[0]
            return b"".join(map(self._piece, found))
        return b"".join([self._piece(x.lower()) for x in found if x != "\n"])

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text (null: empty) as little-endian unsigned 32-bit integers."""
        chunks = Chunks(texts if self.blank else parted(texts))
        known, blank = self.chunks, " " if self.blank else ""
        for chunk in known.missing(chunks.distinct):
            known[chunk] = self.chunk(chunk, blank)
        ids = [*map(known.__getitem__, chunks.distinct)]
        ids += [self.chunk(chunk, "") for chunk in chunks.leading] if self.blank else map(known.__getitem__, chunks.leading)
        if None not in ids:
            return chunks.join(ids)
        out = chunks.join([x or b"" for x in ids])
        for row in chunks.rows_with([x is None for x in ids]):
            out[row] = self.whole(texts[row].as_py() or "")
        return out


_ENCODERS: dict[tuple[str, bool, bool], CachedEncoder] = {}


def encoder(path: str, blank: bool, plain: bool = False) -> CachedEncoder:
    """The worker's encoder for a vocabulary file; it outlives the task where Spark reuses the worker."""
    if (path, blank, plain) not in _ENCODERS:
        _ENCODERS[path, blank, plain] = CachedEncoder(path, blank, plain)
    return _ENCODERS[path, blank, plain]


def plain_encoder(path: str) -> CachedEncoder:
    """For a byte-level vocabulary, with added tokens' strings as ordinary text."""
    return encoder(path, True, True)
