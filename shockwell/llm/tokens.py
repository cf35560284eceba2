"""Byte-level BPE ids by the tokenizers library, with a memory of words.

The library splits a text by a fixed pattern and merges within each piece, so a
piece has the same ids in every text.  A worker remembers the ids of pieces and
asks the library's model only for new ones, in the model's own alphabet of one
character per byte.  Texts with characters past U+00FF go to the library whole,
because the split below states its character classes for the characters up to
there; so do all texts if the file is of another kind.  Added tokens are found
by the library alone, so texts that hold one go to it whole as well.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np

# The letters, numbers and blanks of Unicode up to U+00FF.
LETTERS = "A-Za-zªµºÀ-ÖØ-öø-ÿ"
NUMBERS = "0-9²³¹¼-¾"
BLANKS = "\\t-\\r \\x85\\xa0"
PIECES = re.compile(
    f" ?+[{LETTERS}]++|'s|'t|'re|'ve|'m|'ll|'d| ?[{NUMBERS}]++| ?[^{BLANKS}{LETTERS}{NUMBERS}]++"
    f"|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]++")

#: Pieces that each of a worker's two generations of memory holds.
MEMO_PIECES = 400_000


def default_path() -> str:
    """The public byte-level BPE file; any tokenizers file of that kind will do."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def spelling() -> list[str]:
    """The character of each byte: itself where it is visible, else the next free one past U+00FF."""
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    free = iter(range(0x100, 0x200))
    return [chr(b if b in visible else next(free)) for b in range(256)]


SPELT = spelling()
ALPHABET = "".join(SPELT)
#: Stands between pieces that are spelt together.  Its first byte is in no character up to U+00FF.
BETWEEN = "\u0100"
SPELT_BETWEEN = "".join(map(SPELT.__getitem__, BETWEEN.encode()))


class ByteBpe:
    """Encodes texts to little-endian unsigned 32-bit ids."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark deals out the work
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.memo: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.raw = [i.to_bytes(4, "little") for i in range(max(self.library.get_vocab().values()) + 1)]
        kind = json.loads(self.library.to_str())
        split = kind["pre_tokenizer"] or {}
        self.by_pieces = (
            kind["normalizer"] is None and kind["model"]["type"] == "BPE" and split.get("type") == "ByteLevel"
            and split.get("use_regex", True) and not split.get("add_prefix_space"))
        added = self.library.get_added_tokens_decoder().values()
        #: Contents of the added tokens that the library looks for, by ``special_as_text``.
        self.searched = {flag: [a.content for a in added if not (flag and a.special)] for flag in (False, True)}

    def new_pieces(self, pieces: list[str]) -> Iterator[bytes]:
        """Ids of pieces, one at least, by the library's model."""
        tokenize, raw = self.library.model.tokenize, self.raw
        spelt, _ = codecs.charmap_decode(BETWEEN.join(pieces).encode(), "strict", ALPHABET)
        for piece in spelt.split(SPELT_BETWEEN):
            yield b"".join([raw[t.id] for t in tokenize(piece)])

    def encode(self, texts: list[str], special_as_text: bool = True) -> list[bytes]:
        """Ids of each text; with ``special_as_text`` a special token's content is
        ordinary text, without it is that token's id, as the library has it by default."""
        plain = [self.by_pieces and (t.isascii() or all_latin(t)) for t in texts]
        for content in self.searched[special_as_text]:
            plain = [ok and content not in t for t, ok in zip(texts, plain)]
        pieces = [PIECES.findall(t) if ok else [] for t, ok in zip(texts, plain)]
        flat = list(chain.from_iterable(pieces))
        found = list(map(self.memo.get, flat))
        unknown = [k for k, ids in enumerate(found) if ids is None]
        if unknown:
            names = list(dict.fromkeys([flat[k] for k in unknown]))
            new = dict(zip(names, map(self.older.get, names)))
            unseen = [p for p, ids in new.items() if ids is None]
            if unseen:
                new.update(zip(unseen, self.new_pieces(unseen)))
            for k in unknown:
                found[k] = new[flat[k]]
            if len(self.memo) + len(new) > MEMO_PIECES:
                self.older, self.memo = self.memo, {}
            self.memo.update(new)
        out, at = [], 0
        for p in pieces:
            out.append(b"".join(found[at:at + len(p)]))
            at += len(p)
        rest = [k for k, ok in enumerate(plain) if not ok]
        if rest:
            self.library.encode_special_tokens = special_as_text
            whole = self.library.encode_batch_fast([texts[k] for k in rest], add_special_tokens=False)
            for k, e in zip(rest, whole):
                out[k] = np.array(e.ids, dtype="<u4").tobytes()
        return out


def all_latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


@lru_cache(maxsize=2)
def encoder(path: str) -> ByteBpe:
    """The worker's encoder for a file."""
    return ByteBpe(path)


def encode_slices(path: str, texts: list[str], special_as_text: bool, step: int = 32):
    """Ids of each text, encoded in slices so that memory follows the slice."""
    encode = encoder(path).encode
    for start in range(0, len(texts), step):
        yield from encode(texts[start:start + step], special_as_text)
