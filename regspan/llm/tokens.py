"""Token ids of whole texts by the tokenizers library, every distinct piece encoded once.

Byte-pair encoding never merges across the end of a word, so a text may be cut before white
space, its pieces encoded one by one, and the ids joined. A worker keeps the ids of pieces
it has met. Texts for which the cut is not proven safe go to the library whole.
"""

from __future__ import annotations

import os
import re
import unicodedata
from array import array

# White space beyond ASCII, on which libraries differ. Texts that hold any are encoded whole.
_UNUSUAL_SPACE = re.compile(
    "[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028\u2029\u202f\u205f\u2060\u3000\ufeff]"
)
_SPACE, _MARK = r"\x20\t-\r", r"!-&(-/:-@\[-`{-~"  # ASCII; an apostrophe is no mark
# A plain word before white space or a mark; the marks behind it; any other run.
_PIECE = {
    # white space belongs to the ids: it leads the piece that follows it
    "keep": re.compile(
        rf"[{_SPACE}]*[A-Za-z]+(?=[{_SPACE}{_MARK}])|(?<=[A-Za-z])[{_MARK}]+(?=[{_SPACE}])"
        rf"|[{_SPACE}]*[^{_SPACE}]+|[{_SPACE}]+"
    ),
    # white space is dropped by the tokenizer
    "drop": re.compile(
        rf"[A-Za-z]+(?=[{_SPACE}{_MARK}])|(?<=[A-Za-z])[{_MARK}]+(?=[{_SPACE}])|[^{_SPACE}]+"
    ),
}
# Punctuation behind a letter always starts a new unit, an apostrophe apart.
_TAIL = re.compile(r"(.*[A-Za-z])([!-&(-/:-@\[-`{-~]+)", re.S)
# Of white space before other characters the last one stands apart; a blank goes with what follows.
_LEAD = re.compile(rf"([{_SPACE}]*)([{_SPACE}])([^{_SPACE}].*)", re.S)
# Bytes of text, and distinct pieces, that are worked on at once.
_CHUNK, _SLICE = 1 << 24, 100_000
# Two generations of pieces are kept; the older goes when the younger is full.
_GENERATION = 600_000

_encoders: dict[tuple[str, str], Encoder] = {}


def _visible_bytes() -> dict[int, str]:
    """The character by which byte-level vocabularies write each byte, by their rule.

    Visible Latin-1 characters stand for themselves, others follow from 256 on.
    """
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return {b: chr(256 + i) for i, b in enumerate(hidden)}


class Encoder(dict):
    """Ids of a text as bytes: unsigned 32-bit little-endian numbers.

    The dictionary holds the younger generation of pieces; what is missing is made on demand.
    """

    def __init__(self, path: str, space: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self._library = Tokenizer.from_file(path)
        self._units = self._library.model.tokenize
        self._drops = space == "drop"
        self._find = _PIECE[space].findall
        self._visible = _visible_bytes()
        self._blank = self._visible[ord(" ")]
        self._old: dict[str, bytes] = {}

    def _whole(self, text: str) -> bytes:
        return array("I", self._library.encode(text, add_special_tokens=False).ids).tobytes()

    def _word(self, piece: str) -> bytes | None:
        """A piece of letters, with one space before it where spaces count: one unit.

        The library's model is asked at once, without the steps that find units.
        """
        if not piece.isalpha() and (self._drops or piece[0] != " " or not piece[1:].isalpha()):
            return None
        if piece.isascii():
            data = piece.lower() if self._drops else piece.replace(" ", self._blank)
            return array("I", [t.id for t in self._units(data)]).tobytes()
        if self._drops:
            lower = "".join(map(str.lower, piece))
            # Lower case may add marks that are no letters.
            if not (unicodedata.is_normalized("NFC", piece) and lower.isalpha()):
                return None
            piece = lower
        data = piece.encode().decode("latin-1").translate(self._visible)
        return array("I", [t.id for t in self._units(data)]).tobytes()

    def _parts(self, piece: str) -> list[str]:
        """Shorter pieces with the same ids, if the piece may be cut further."""
        if len(parts := self._find(piece)) > 1:
            return parts
        if "<|" in piece:
            return []
        lead = None if self._drops else _LEAD.fullmatch(piece)
        if lead and piece != " " + lead[3]:
            last = [" " + lead[3]] if lead[2] == " " else [lead[2], lead[3]]
            return [lead[1], *last] if lead[1] else last
        tail = _TAIL.fullmatch(piece)
        return [tail[1], tail[2]] if tail else []

    def __missing__(self, piece: str) -> bytes:
        ids = self._old.get(piece)
        if ids is None:
            ids = self._word(piece)
        if ids is None:
            parts = self._parts(piece)
            ids = b"".join(map(self.__getitem__, parts)) if parts else self._whole(piece)
        self[piece] = ids
        return ids

    def _age(self) -> None:
        if len(self) > _GENERATION:
            self._old = dict(self)
            self.clear()

    def __call__(self, text: str | None) -> bytes:
        if not text:
            return b""
        if _UNUSUAL_SPACE.search(text):
            return self._whole(text)
        self._age()
        if self._drops and "<|" not in text:  # such marks are special in lower case only
            text = text.encode().lower().decode()  # A to Z
        return b"".join(map(self.__getitem__, self._find(text)))

    def many(self, texts) -> list[bytes]:
        """The ids of every text of an Arrow array, a NULL being empty.

        A distinct piece is looked up once for some megabytes of texts.
        """
        import pyarrow as pa
        import pyarrow.compute as pc

        if self._drops:
            return [self(text) for text in texts.to_pylist()]
        texts = texts.cast(pa.large_string()).fill_null("")
        done = pc.fill_null(pc.cumulative_sum(pc.binary_length(texts)), 0).to_numpy()
        out, start = [], 0
        while start < len(texts):
            before = done[start - 1] if start else 0
            end = max(start + 1, int(done.searchsorted(before + _CHUNK, "right")))
            out += self._chunk(texts.slice(start, end - start))
            start = end
        return out

    def _chunk(self, texts) -> list[bytes]:
        """The same, texts being cut before every run of ASCII white space."""
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: len(texts) + 1]
        if bounds[0] == bounds[-1]:
            return [b""] * len(texts)
        data = np.frombuffer(texts.buffers()[2], np.uint8)[bounds[0] : bounds[-1]]
        bounds = bounds - bounds[0]
        space = (data == 32) | ((data >= 9) & (data <= 13))
        first = space.copy()
        first[1:] &= ~space[:-1]
        first[bounds[:-1][bounds[:-1] < len(data)]] = True  # a run ends with its text
        cuts = np.append(np.flatnonzero(first), len(data))
        pieces = pa.Array.from_buffers(
            pa.large_string(), len(cuts) - 1, [None, pa.py_buffer(cuts), pa.py_buffer(data)]
        ).dictionary_encode()
        distinct, ids = pieces.dictionary.to_pylist(), []
        for i in range(0, len(distinct), _SLICE):
            self._age()
            ids += map(self.__getitem__, distinct[i : i + _SLICE])
        joined = pa.array(ids, pa.large_binary()).take(pieces.indices)
        at = np.frombuffer(joined.buffers()[1], np.int64)[joined.offset :]
        at = at[np.searchsorted(cuts, bounds)]
        found = memoryview(joined.buffers()[2] or b"")
        out = [bytes(found[a:b]) for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
        unusual = pc.match_substring_regex(texts, _UNUSUAL_SPACE.pattern)
        for row in np.flatnonzero(unusual.to_numpy(zero_copy_only=False)).tolist():
            out[row] = self._whole(texts[row].as_py())
        return out


def encoder(path: str, space: str) -> Encoder:
    """The encoder of this Python worker for a vocabulary file."""
    key = (path, space)
    if key not in _encoders:
        _encoders[key] = Encoder(path, space)
    return _encoders[key]
