"""Byte-level BPE ids of whole texts with the ``tokenizers`` library.

The vocabulary file is a path (``byte_bpe_50k.json`` by default); it is loaded
once per Python worker.  Text is cut at single line feeds and spaces: where no
piece has white space at its edges, a line feed is a pre-token and a space
starts one, so the ids of a text are the ids of its pieces, and pieces seen
before come from a bounded cache.  Any other text, and one that holds the string
of an added token, is encoded whole.  Both give the library's own ids, added
tokens inside texts as it takes them by default.

The path must name the file on every executor (the default is that of an
installed package, which all nodes of a cluster need).
"""

from __future__ import annotations

import os
import re
from array import array
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

END_ID = 2
#: Pieces remembered per worker while a task runs (about 40 MB), and by one that waits (Spark keeps several waiting).
CACHE_PIECES = 200_000
KEPT_PIECES = 50_000

#: White space other than a space or a line feed (fixed values): beyond ASCII, and in it.
_ODD = re.compile("[\t\r\x0b\x0c\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
_ODD_ASCII = "\t\r\x0b\x0c\x1c\x1d\x1e\x1f"
#: Signs that form one pre-token when they follow a word (no apostrophe: 's and the like are pre-tokens).
_SIGNS = "!#$%&()*+,-./:;<=>?@[]^_{|}~"
_LATIN_WORD = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")


def _byte_alphabet() -> dict[int, str]:
    """The printable character that byte-level BPE writes for each byte."""
    shown = {b: chr(b) for b in (*range(33, 127), *range(161, 173), *range(174, 256))}
    hidden = [b for b in range(256) if b not in shown]
    return shown | {b: chr(256 + i) for i, b in enumerate(hidden)}


_BYTES = _byte_alphabet()
_LATIN = {c: "".join(_BYTES[b] for b in chr(c).encode()) for c in range(0xc0, 0x250)}
_loaded: dict[str, "Encoder"] = {}


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _one_token(word: str) -> bool:
    """Is it known that ``word``, whatever signs follow, is a pre-token?"""
    return word.isalpha() and (word.isascii() or _LATIN_WORD.fullmatch(word) is not None)


class _Pieces(dict):
    """Ids (little-endian uint32 bytes) of a piece that follows ``before``: a space or nothing."""

    def __init__(self, tokenizer, before: str, room: int):
        super().__init__()
        self.encode, self.tokenize = tokenizer.encode, tokenizer.model.tokenize
        self.before, self.prefix, self.room = before, "".join(_BYTES[ord(c)] for c in before), room
        self.stops: dict[str, bytes] = {}

    @staticmethod
    def _ids(tokens) -> bytes:
        return array("I", [t.id for t in tokens]).tobytes()

    def __missing__(self, piece: str) -> bytes:
        word = piece.rstrip(_SIGNS)
        if not _one_token(word):
            out = array("I", self.encode(self.before + piece, add_special_tokens=False).ids).tobytes()
        elif len(word) < len(piece):  # a word, then signs: two pre-tokens
            new = word not in self
            out = self[word] + self.signs(piece[len(word):])
            if new:  # kept when the word comes again
                return out
        else:  # one pre-token, in the byte-level alphabet
            out = self._ids(self.tokenize(self.prefix + (word if word.isascii() else word.translate(_LATIN))))
        if len(self) < self.room:
            self[piece] = out
        return out

    def trim(self, room: int) -> None:
        """Only the first ``room`` pieces stay: frequent ones come early."""
        if len(self) > room:
            first = dict(islice(self.items(), room))
            self.clear()
            self.update(first)

    def signs(self, signs: str) -> bytes:
        out = self.stops.get(signs)
        if out is None:
            out = self._ids(self.tokenize(signs))
            if len(self.stops) < 10_000 and len(signs) < 16:
                self.stops[signs] = out
        return out


class Encoder:
    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.added = tuple(t.content for t in self.tokenizer.get_added_tokens_decoder().values())
        self.pieces = _Pieces(self.tokenizer, " ", CACHE_PIECES)
        self.firsts = _Pieces(self.tokenizer, "", CACHE_PIECES // 20)
        self.feed = self.whole("\n")
        self.texts: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def ids(self, text: str | None) -> bytes:
        """The ids of ``text`` as little-endian unsigned 32-bit integers."""
        if not text:
            return b""
        if text in self.texts:  # copies often sit close together
            return self.texts[text]
        out = self.feed.join(map(self._line, text.split("\n"))) if self._plain(text) else self.whole(text)
        if len(self.texts) >= 256:
            self.texts.clear()
        self.texts[text] = out
        return out

    def ids_many(self, texts: list[str | None]) -> list[bytes]:
        """``ids`` of each text; a word that they share is looked up once for all, and tokenised once even where no more are remembered."""
        plain = [bool(t) and self._plain(t) for t in texts]
        # a line feed stays with the piece after it; a carriage return, which plain texts lack, marks a text's first piece
        cut = pc.split_pattern(pa.array(["\r" + t.replace("\n", " \n") for t, p in zip(texts, plain) if p], pa.large_string()), " ")
        coded, ends = cut.flatten().dictionary_encode(), cut.offsets.to_numpy()
        known, codes = self._known(coded.dictionary), coded.indices.to_numpy()
        joined = (b"".join(map(known.__getitem__, codes[a:e].tolist())) for a, e in zip(ends, ends[1:]))
        return [next(joined) if p else self.ids(t) for t, p in zip(texts, plain)]

    def _known(self, pieces: pa.Array) -> list[bytes]:
        """The ids of marked pieces, looked up by the words that are left without their signs."""
        words = pc.utf8_rtrim(pieces, _SIGNS).dictionary_encode()
        strings, codes = words.dictionary.to_numpy(zero_copy_only=False).tolist(), words.indices.to_numpy()
        ids = [self.pieces[w] if _one_token(w) else None for w in strings]
        out = list(map(ids.__getitem__, codes.tolist()))
        signed = pc.not_equal(pc.utf8_length(pieces), pc.utf8_length(words.dictionary).take(words.indices)).to_numpy(zero_copy_only=False)
        others = np.flatnonzero(signed | np.array([i is None for i in ids], bool)[codes])
        for i, p, c in zip(others.tolist(), pieces.take(pa.array(others)).to_numpy(zero_copy_only=False), codes[others].tolist()):
            if p[0] in "\r\n":
                out[i] = self.firsts[p[1:]] if p[0] == "\r" else self.feed + self.firsts[p[1:]]
            else:
                out[i] = self.pieces[p] if ids[c] is None else ids[c] + self.pieces.signs(p[len(strings[c]):])
        return out

    def _plain(self, text: str) -> bool:
        """Are the ids of ``text`` those of its pieces?"""
        return not (any(a in text for a in self.added) or "  " in text or "\n\n" in text or " \n" in text or "\n " in text or text[0].isspace() or text[-1].isspace()
                    or (any(c in text for c in _ODD_ASCII) if text.isascii() else _ODD.search(text)))

    def rest(self, kept: int = KEPT_PIECES) -> None:
        """At the end of a task: a waiting worker holds little."""
        self.pieces.trim(kept)
        self.firsts.trim(kept // 20)
        self.texts.clear()

    def _line(self, line: str) -> bytes:
        first, *rest = line.split(" ")
        return self.firsts[first] + b"".join(map(self.pieces.__getitem__, rest))


def encoder(path: str, room: int = CACHE_PIECES) -> Encoder:
    """The worker's encoder, which may remember ``room`` pieces from now on."""
    if path not in _loaded:
        _loaded[path] = Encoder(path)
    out = _loaded[path]
    out.pieces.room, out.firsts.room = room, room // 20
    return out
