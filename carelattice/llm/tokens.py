"""Token ids of whole texts by the tokenizers library, with remembered words.

Both supported vocabularies split a text before merging, and no merge crosses a split; at certain white
space the split is sure. So a text is cut there, each distinct piece is encoded once per worker, and the ids
of a text are the joined ids of its pieces. Pieces outside Latin-1, and texts with unusual white space or with an
added token such as <|endoftext|> (one id, as the library does by default), go through the tokenizer's whole pipeline.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import regex

from .common import held

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

#: The split patterns of the two vocabularies, as their files state them (fixed values).
BYTE_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
WORD_PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"""

#: White space that libraries disagree on.
ODD_SPACE = re.compile("[\x1c-\x1f]")
#: White space other than space, tab and line ends.
RARE_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")
#: A space beside other white space: such texts are cut by PIECES.
BROAD_SPACE = [a + b for c in " \n\t\r\v\f" for a, b in ((" ", c), (c, " "))]
#: Marks the first piece of a text, which has no space before it.
GLUE = "\x01"
PIECES = re.compile(r"\s+(?!\S)| ?\S+|\s")
#: Distinct pieces remembered by one Python worker; beyond it the memory starts anew.
REMEMBERED = 800_000


def default_path(name: str) -> str:
    """Place of an installed public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_alphabet() -> dict[int, str]:
    """Byte -> character of byte-level vocabularies: printable bytes stand for themselves, the others follow U+0100."""
    plain = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = iter(range(256, 512))
    return {b: chr(b) if b in plain else chr(next(others)) for b in range(256)}


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        #: The library finds these in a text before it normalises and splits it.
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.model = self.tokenizer.model
        self.words = self.tokenizer.normalizer is not None
        self.pattern = regex.compile(WORD_PATTERN if self.words else BYTE_PATTERN)
        self.alphabet = _byte_alphabet()
        self.bytes_of = [i.to_bytes(4, "little") for i in range(self.tokenizer.get_vocab_size())]
        self.pieces: dict[str, bytes] = {}
        self.spaced: dict[str, bytes] = {}
        self.atoms: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return b"".join(i.to_bytes(4, "little") for i in self.tokenizer.encode(text, add_special_tokens=False).ids)

    def _ids(self, atom: str) -> bytes:
        mapped = atom.encode().decode("latin-1").translate(self.alphabet)
        return b"".join([self.bytes_of[t.id] for t in self.model.tokenize(mapped)])

    def _atom(self, atom: str) -> bytes:
        found = self.atoms.get(atom)
        if found is None:
            found = self.atoms[atom] = self._ids(atom)
        return found

    def _piece(self, piece: str) -> bytes:
        if piece and max(piece) >= "Ā":
            return self._whole(piece)
        if self.words:
            piece = piece.lower()
        # Letters alone, with or without the space before them, are one match of either pattern, remembered as a piece.
        if piece[1:].isalpha() and (piece[0] == " " or piece[0].isalpha()):
            return self._ids(piece)
        return b"".join(map(self._atom, self.pattern.findall(piece)))

    def _spaced(self, piece: str) -> bytes:
        """A piece that was cut at the space before it, unless it is glued."""
        return self._piece(piece[1:] if piece[:1] == GLUE else " " + piece)

    def _joined(self, pieces: list[str], known: dict[str, bytes], make: Callable[[str], bytes]) -> bytes:
        try:
            return b"".join(map(known.__getitem__, pieces))
        except KeyError:
            for memory in (known, self.atoms):
                if len(memory) > REMEMBERED:
                    memory.clear()
            for p in pieces:
                if p not in known:
                    known[p] = make(p)
            return b"".join(map(known.__getitem__, pieces))

    def encode(self, text: str) -> bytes:
        if not text:
            return b""
        if any(map(text.__contains__, self.added)):
            return self._whole(text)
        rare = RARE_SPACE.search(text) is not None
        if rare and ODD_SPACE.search(text):
            return self._whole(text)
        if self.words:
            return self._joined((text.lower() if text.isascii() else text).split(), self.pieces, self._piece)
        if rare or GLUE in text or any(map(text.__contains__, BROAD_SPACE)):
            return self._joined(PIECES.findall(text), self.pieces, self._piece)
        pieces = text.split(" ")
        pieces[0] = GLUE + pieces[0]
        return self._joined(pieces, self.spaced, self._spaced)


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file."""
    return held(("encoder", path), lambda: Encoder(path))
