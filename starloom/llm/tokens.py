"""Token ids of whole texts, by a public tokenizer file.

The tokenizer of ``word_bpe_49k.json`` lower-cases, never lets a token cross
white space, and ends a word before a stop or comma that follows it. So a
text's ids are the ids of its pieces (lower-cased, split at white space and
before such stops) in order. Pieces repeat: their ids are remembered, for a
bounded number of pieces, by the Python worker over all its tasks. A new piece
of plain letters, digits and signs, which the tokenizer would neither change nor
cut in another way than into their runs, goes to its model run by run; all other
pieces are encoded together.
"""

from __future__ import annotations

import re
from codecs import charmap_decode
from collections.abc import Iterable
from itertools import pairwise

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

TOKENIZER = "word_bpe_49k.json"
REMEMBERED = 900_000
BATCH = 1024
#: Stands alone between pieces that are encoded together; it has an id of its own.
MARK = b"\x01"
#: Texts with this start of a special token are not lower-cased beforehand.
SPECIAL = b"<|"
STOP = re.compile(rb"([.,])(?<=[a-z0-9][.,])(?=[ \n])")
#: Lower-case letters of ASCII and Latin-1, digits, signs without the apostrophe: pieces, and their runs.
SIMPLE = re.compile(rb"(?:[a-z0-9!-&(-/:-@[-`{-~]|\xc3[\x9f-\xb6\xb8-\xbf])+")
RUNS = re.compile(rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+|[0-9]|[!-&(-/:-@[-`{-~]+")
PROBE = b"words#.7\xc3\x9f\xc3\xa9"
#: The characters that stand for bytes in byte-level models: Latin-1's own, or free ones.
_FREE = [*range(33), *range(127, 161), 173]
BYTES = "".join(chr(256 + _FREE.index(b)) if b in _FREE else chr(b) for b in range(256))


class _Known(dict):
    """Piece to ids; notes the pieces that it does not know."""

    def __init__(self):
        self.fresh: list[bytes] = []

    def __missing__(self, piece: bytes) -> None:
        self.fresh.append(piece)


class TextIds:
    """``of(texts)``: for each text the little-endian ids as bytes."""

    def __init__(self, tokenizer: str = TOKENIZER, dtype: str = "<u4", remembered: int = REMEMBERED):
        self.tokenizer = Tokenizer.from_file(public_tokenizers.path(tokenizer))
        self.dtype, self.remembered = np.dtype(dtype), remembered
        self.known, self.stage = _Known(), None
        (self.mark,) = self._ids(MARK)
        self.cut = self.tokenizer.model.tokenize
        self.by_runs = self._of_runs(PROBE) == self._ids(PROBE)

    @classmethod
    def shared(cls, tokenizer: str = TOKENIZER, dtype: str = "<u4", stage: int | None = None) -> TextIds:
        """The worker's own, with what earlier tasks have learned; with a ``stage``,
        those of that stage only, so that no worker holds an earlier job's pieces."""
        if (tokenizer, dtype) not in _SHARED:
            _SHARED[tokenizer, dtype] = cls(tokenizer, dtype)
        ids = _SHARED[tokenizer, dtype]
        if stage is not None and stage != ids.stage:
            ids.known.clear()
            ids.stage = stage
        return ids

    def _ids(self, text: bytes) -> list[int]:
        (found,) = self.tokenizer.encode_batch_fast([text.decode("utf-8", "surrogatepass")], add_special_tokens=False)
        return found.ids

    def _of_runs(self, piece: bytes) -> list[int]:
        """Ids of a simple piece."""
        cut = self.cut
        if piece.isalpha():
            return [t.id for t in cut(piece.decode())]
        return [t.id for run in RUNS.findall(piece) for t in cut(charmap_decode(run, "strict", BYTES)[0])]

    def _keep(self, pieces: list[bytes], ids: list[int], bounds: Iterable[tuple[int, int]]) -> None:
        packed, size = np.array(ids, self.dtype).tobytes(), self.dtype.itemsize
        for piece, (start, end) in zip(pieces, bounds, strict=True):
            self.known[piece] = packed[start * size : end * size]

    def _learn(self, pieces: list[bytes]) -> None:
        simple, ids, ends, others = [], [], [0], []
        for piece in pieces:
            lower = piece.isalpha() and piece.islower()
            if self.by_runs and (lower or (SIMPLE.fullmatch(piece) and SPECIAL not in piece)):
                simple.append(piece)
                ids += self._of_runs(piece)
                ends.append(len(ids))
            else:
                others.append(piece)
        self._keep(simple, ids, pairwise(ends))
        plain = [p for p in others if MARK not in p and SPECIAL not in p]
        for at in range(0, len(plain), BATCH):
            some = plain[at : at + BATCH]
            ids = self._ids((b" " + MARK + b" ").join(some))
            marks = [-1, *(i for i, x in enumerate(ids) if x == self.mark), len(ids)]
            self._keep(some, ids, ((start + 1, end) for start, end in pairwise(marks)))
        for piece in others:
            if piece not in self.known:
                self._keep([piece], ids := self._ids(piece), [(0, len(ids))])

    def of(self, texts: Iterable[str | None]) -> list[bytes]:
        out = []
        for text in texts:
            raw = (text or "").encode("utf-8", "surrogatepass")
            pieces = (raw if SPECIAL in raw else STOP.sub(rb" \1", raw.lower())).split()
            found = list(map(self.known.__getitem__, pieces))
            if self.known.fresh:
                new, self.known.fresh = list(set(self.known.fresh)), []
                if len(self.known) + len(new) > self.remembered:
                    self.known.clear()
                    new = list(set(pieces))
                self._learn(new)
                found = list(map(self.known.__getitem__, pieces))
            out.append(b"".join(found))
        return out


_SHARED: dict[tuple[str, str], TextIds] = {}
