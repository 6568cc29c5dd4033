"""Encoding with the tokenizers library, word by word.

Both vocabularies in use split a text into pieces that are merged one by one, and a single space between two other characters always starts a new
piece. So a text is cut at its spaces, and the ids of each chunk are kept: what the library has encoded once is not
encoded again. A chunk that is not known goes through the normaliser, the pre-tokenizer and the model of the library itself; for a run of
Latin letters with at most a full stop or comma after it the two first are a table, made by the library letter by letter. A
text in which white space stands on both sides of a space, or before one at its end, is given to the library whole, and so is one that holds
an added token such as ``<|endoftext|>`` literally: its id is what the library's plain call gives. With ``literal`` such strings are ordinary text.

Memory is bounded by ``LIMIT`` chunks and ``PIECES`` of their pieces; after that nothing more is kept (what is frequent comes early).
"""

from __future__ import annotations

import os
import re

import numpy as np

from ._common import resident

LIMIT = 500_000
#: A piece is asked for only by chunks that are not known yet; the frequent ones are enough.
PIECES = 50_000
#: Letters below this are in tables; all of them are one letter in lower case as well.
LATIN = "\u0130"
CONTROLS = re.compile("[\x1c-\x1f]")
UNSAFE = re.compile(r"[\s\u180e\u200b\ufeff] [\s\u180e\u200b\ufeff]|[\s\u180e\u200b\ufeff] $")


class Subwords:
    """The ids of texts as little-endian unsigned integers of ``width`` bytes (2 if the vocabulary allows it, else 4)."""

    def __init__(self, file: str, keeps_space: bool, literal: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(file)
        self.tok.encode_special_tokens = literal
        self.added = () if literal else tuple(t.content for t in self.tok.get_added_tokens_decoder().values())
        self.model, self.norm, self.pre = self.tok.model, self.tok.normalizer, self.tok.pre_tokenizer
        self.space = " " if keeps_space else ""
        self.dtype = np.dtype("<u2" if self.tok.get_vocab_size() <= 1 << 16 else "<u4")
        self.width = self.dtype.itemsize
        self.chunks: dict[str, bytes] = {}
        self.pieces: dict[str, bytes] = {}
        shown = lambda x: "".join(p for p, _ in self.pre.pre_tokenize_str(self.norm.normalize_str(x) if self.norm else x))
        self.letters = {ord(c): shown(c) for c in map(chr, range(ord(LATIN))) if c.isalpha()}
        self.mark = shown(" a")[:-1] if keeps_space else ""
        self.ends = {c: self._piece(shown(c)) for c in ".,"}
        self.newline = b"".join(self._piece(p) for p, _ in self.pre.pre_tokenize_str("\n")) if keeps_space else b""

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            ids = np.array([t.id for t in self.model.tokenize(piece)], self.dtype).tobytes()
            if len(self.pieces) < PIECES:
                self.pieces[piece] = ids
        return ids

    def _raw(self, space: str, chunk: str) -> bytes:
        """The ids of a chunk (after a space, if that belongs to the vocabulary's pieces), by the parts of the library."""
        core, end = (chunk[:-1], chunk[-1]) if chunk[-1:] in self.ends else (chunk, "")
        if core.isalpha() and (core.isascii() or max(core) < LATIN):
            ids = self._piece((self.mark if space else "") + core.translate(self.letters))
            return ids + self.ends[end] if end else ids
        left, newline, right = chunk.partition("\n")
        if newline and left and right and not left[-1].isspace() and not right[0].isspace():
            return self._raw(space, left) + self.newline + self._raw("", right)
        text = space + chunk
        if self.norm is not None:
            text = self.norm.normalize_str(text)
        return b"".join([self._piece(p) for p, _ in self.pre.pre_tokenize_str(text)])

    def whole(self, text: str) -> bytes:
        """The ids of a text by one call of the library."""
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def encode(self, text: str) -> bytes:
        if self.space and UNSAFE.search(text) or any(t in text for t in self.added):
            return self.whole(text)
        if self.space:
            first, *rest = text.split(" ")
        else:  # white space is dropped, whatever it is; Python counts four more characters as such
            first, rest = "", text.split() if not CONTROLS.search(text) else text.split(" ")
        chunks = self.chunks
        head = self._raw("", first) if first else b""
        try:
            return head + b"".join(map(chunks.__getitem__, rest))
        except KeyError:
            out = [head]
            for c in rest:
                ids = chunks.get(c)
                if ids is None:
                    ids = self._raw(self.space, c)
                    if len(chunks) < LIMIT:
                        chunks[c] = ids
                out.append(ids)
            return b"".join(out)


def subwords(file: str, keeps_space: bool, literal: bool = False) -> Subwords:
    return resident(("subwords", file, keeps_space, literal), lambda: Subwords(file, keeps_space, literal))
