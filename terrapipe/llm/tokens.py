"""Token ids of whole texts by a lower-casing vocabulary that drops white space.

``Encoder`` gives exactly the ids of
``Tokenizer.encode(text, add_special_tokens=False)``. No token of such a
vocabulary crosses white space or joins a word to its closing marks, so
texts are cut there, byte by byte with numpy, and equal pieces are encoded
once: Arrow finds the distinct pieces of a batch, their ids sit in a bounded
cache per Python worker (what the last batches did not use leaves it), and a
gather lays them out in the order of the texts.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

#: A word's closing marks: between a letter or digit and a blank nothing else can join them.
MARKS = b".,!?;:&%$#*|"
#: Byte to byte: ASCII in lower case, lines joined by blanks.
FOLDED = np.arange(256, dtype=np.uint8)
FOLDED[65:91] += 32
FOLDED[10] = 32
IS_MARK = np.isin(np.arange(256), list(MARKS))
#: Bytes that end an ASCII letter or digit; and that, behind 0xC3, end one of À-Ö, Ø-ö, ø-ÿ.
IS_PLAIN = np.isin(np.arange(256), list(b"abcdefghijklmnopqrstuvwxyz0123456789"))
IS_LATIN = (np.arange(256) >= 0x80) & (np.arange(256) < 0xC0) & ~np.isin(np.arange(256), [0x97, 0xB7])
#: Letters with a one-to-one lower case and no combining marks, or marks: the
#: vocabulary's model can be asked for such a piece directly.
PLAIN = re.compile(r"[a-zÀ-ÖØ-öø-ÿ]+|[.,!?;:&%$#*|]+")
#: A text with this may hold a special token, which marks do not cut.
SPECIAL = "<|"
CACHED = 300_000


def cut(text: bytes) -> tuple[pa.Array, np.ndarray]:
    """The pieces of a text, folded, and where each begins: at blanks, and before a word's closing marks."""
    folded = FOLDED[np.frombuffer(text, np.uint8)]
    inside = folded != 32
    bounds = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = bounds[::2], bounds[1::2]
    # the closing marks of a piece begin behind the last byte that is no mark
    at = np.arange(len(folded), dtype=np.int32)
    at[IS_MARK[folded]] = -1
    closing = np.maximum.accumulate(at)[ends - 1] + 1
    closing = closing[(closing > starts) & (closing < ends)]
    last, before = folded[closing - 1], folded[np.maximum(closing - 2, 0)]
    closing = closing[IS_PLAIN[last] | (IS_LATIN[last] & (before == 0xC3))]
    edge = np.zeros(len(folded) + 1, bool)
    edge[starts] = edge[closing] = True
    starts = np.flatnonzero(edge)
    edge[:] = False
    edge[ends] = edge[closing] = True
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(np.flatnonzero(edge) - starts, out=offsets[1:])
    return pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(folded[inside])]), starts


class Encoder:
    def __init__(self, path: str, cached: int = CACHED):
        self.tokenizer = Tokenizer.from_file(path)
        self.cached = cached
        self.known: dict[str, bytes] = {}
        self.before: dict[str, bytes] = {}
        alphabet = ByteLevel(add_prefix_space=False, use_regex=False)
        self.spelled = {c: alphabet.pre_tokenize_str(chr(c))[0][0] for c in range(0xDF, 0x100) if c != 0xF7}  # the letters of PLAIN, as the model spells them

    def _whole(self, text: str) -> bytes:
        return array("I", self.tokenizer.encode(text, add_special_tokens=False).ids).tobytes()

    def _piece(self, piece: str) -> bytes:
        if not PLAIN.fullmatch(piece):
            return self._whole(piece)
        if not piece.isascii():
            piece = piece.lower().translate(self.spelled)
        return array("I", [t.id for t in self.tokenizer.model.tokenize(piece)]).tobytes()

    def _pieces(self, pieces: list[str]) -> list[bytes]:
        if len(self.known) > self.cached // 2:
            self.known, self.before = {}, self.known
        known, before, out = self.known, self.before, []
        for piece in pieces:
            ids = known.get(piece)
            if ids is None:
                ids = before.get(piece)
                ids = known[piece] = self._piece(piece) if ids is None else ids
            out.append(ids)
        return out

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """For each text (null: empty) its ids as little-endian unsigned 32-bit integers."""
        texts = pc.fill_null(texts, "")
        special = pc.match_substring(texts, SPECIAL)
        plain = pc.if_else(special, "", texts).cast(pa.binary()).to_pylist()
        pieces, starts = cut(b" ".join(plain))
        coded = pieces.dictionary_encode()
        ids = pa.array(self._pieces(coded.dictionary.to_pylist()), pa.binary()).take(coded.indices)
        offsets = np.frombuffer(ids.buffers()[1], "<i4", len(ids) + 1, ids.offset * 4) if len(ids) else np.zeros(1, np.int32)
        begins = np.cumsum([0, *(len(t) + 1 for t in plain)])
        ends, data = offsets[np.searchsorted(starts, begins)], ids.buffers()[2]
        data = data.to_pybytes() if data is not None else b""
        for i, apart in enumerate(special.to_pylist()):
            yield self._whole(texts[i].as_py()) if apart else data[ends[i]:ends[i + 1]]


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The worker's encoder of a vocabulary file: loaded once per Python worker."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]
