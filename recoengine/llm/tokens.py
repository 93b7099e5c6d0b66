"""Token ids of whole texts, as little-endian unsigned 32-bit bytes.

The byte-level vocabulary splits a text into pieces that never reach across
the border between a visible character and a following space, so a text
without a space after other white space is the concatenation of its space-led
units. Units repeat far more often than texts: each worker encodes a unit once
with the tokenizers library and keeps its ids, up to ``KEPT_UNITS`` units. A
text with a space after white space of any kind is encoded whole: such a run
is one piece, and some vocabulary pieces hold several of its spaces.
"""

from __future__ import annotations

import os
import re
from functools import partial
from itertools import compress
from operator import is_

import numpy as np

END_ID = 0
#: Units kept in a worker between batches (about 0.2 kB each).
KEPT_UNITS = 900_000
_encoders: dict[str, Encoder] = {}

#: A space after white space: written with the space first, which the search
#: for it is quick with. All that the library counts as white space is in ``\s``.
WHITE_RUN = re.compile(r" (?<=\s )")

#: Units of these characters only are split into the vocabulary's pieces here
#: (letters, digits, marks, line feeds; others go to the library as they are).
_LETTERS = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f"
PLAIN = re.compile("[\\n!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u024f]+")
#: Units stand between zero bytes, each a piece of its own.
PIECES = re.compile(f"\\0|'s|'t|'re|'ve|'m|'ll|'d| ?[{_LETTERS}]+| ?[0-9]+| ?[^\\s{_LETTERS}0-9\\0]+|\\s+(?![^\\s\\0])|\\s+")


def _byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary has for each byte: printable
    Latin-1 characters stand for themselves, the rest follow from U+0100."""
    own = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    rest = [b for b in range(256) if b not in own]
    return {b: chr(b) for b in own} | {b: chr(0x100 + i) for i, b in enumerate(rest)}


def default_tokenizer() -> str:
    """Place of the vocabulary file; it has to be readable on every executor."""
    import public_tokenizers
    return public_tokenizers.path("byte_bpe_50k.json")


def encoder(path: str) -> Encoder:
    """The worker's encoder, kept between tasks."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def forget() -> None:
    """Drop what the worker's encoders keep."""
    _encoders.clear()


class Encoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        self.whole = Tokenizer.from_file(path)
        self.whole.encode_special_tokens = True  # their strings in a text are ordinary text
        self.pieces = Tokenizer(self.whole.model)
        self.letters = _byte_letters()
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        self.sizes = np.zeros(max(vocabulary.values()) + 1, dtype=np.int64)  # letters of each token
        self.sizes[list(vocabulary.values())] = [len(x) for x in vocabulary]
        self.kept: dict[str, bytes] = {}  # unit without its leading space -> ids with it

    def _encode_whole(self, units: list[str]) -> list[bytes]:
        return [np.array(x.ids, dtype="<u4").tobytes()
                for x in self.whole.encode_batch_fast(units, add_special_tokens=False)]

    def _encode_plain(self, units: list[str]) -> list[bytes]:
        """Ids of plain units. Their pieces go to the library as one pretokenised
        sequence, each piece once, since pieces repeat more often than units. A token
        has as many letters as it stands for bytes, so a piece's size tells its end."""
        pieces = PIECES.findall("\0".join(units) + "\0")  # a zero byte is in no plain unit
        fresh = dict.fromkeys(pieces)
        del fresh["\0"]
        border = self.letters[0]
        spelled = "\0".join(fresh).encode().decode("latin-1").translate(self.letters).split(border)
        out = self.pieces.encode_batch_fast([spelled], is_pretokenized=True, add_special_tokens=False)[0]
        flat = np.array(out.ids, dtype="<u4")
        ends, reached = np.cumsum([len(x) for x in spelled]), np.cumsum(self.sizes[flat])
        cuts = np.searchsorted(reached, ends)
        if reached[-1] != ends[-1] or (reached[cuts] != ends).any():  # a vocabulary without some bytes
            return self._encode_whole(units)
        raw, at = flat.tobytes(), (4 * (cuts + 1)).tolist()
        ids = {p: raw[a:b] for p, a, b in zip(fresh, [0, *at], at)}
        ids["\0"] = b""
        found = list(map(ids.__getitem__, pieces))
        sizes = np.fromiter(map(len, found), np.int64, len(found))
        at = np.cumsum(sizes)[sizes == 0].tolist()
        raw = b"".join(found)
        return [raw[a:b] for a, b in zip([0, *at], at)]

    def _learn(self, words: list[str]) -> None:
        plain = [w for w in words if PLAIN.fullmatch(w)]
        for i in range(0, len(plain), 20_000):
            some = plain[i:i + 20_000]
            self.kept.update(zip(some, self._encode_plain([" " + w for w in some])))
        other = [w for w in words if w not in self.kept]
        self.kept.update(zip(other, self._encode_whole([" " + w for w in other])))

    def __call__(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text and the end id; null counts as empty."""
        kept, end, missing = self.kept, END_ID.to_bytes(4, "little"), partial(is_, None)
        # a unit is a space and what follows it up to the next; a run of white
        # space is a piece of its own, so a text with a space in one is encoded as it is
        split = [[t] if WHITE_RUN.search(t) else t.split(" ") for t in (t or "" for t in texts)]
        first = self._encode_whole([words[0] for words in split])
        found: list[list] = []
        fresh: set[str] = set()
        for h, words in zip(first, split):
            ids = list(map(kept.get, words))
            ids[0] = h
            if None in ids:
                fresh.update(compress(words, map(missing, ids)))
            found.append(ids)
        new = list(fresh)
        self._learn(new)
        out = []
        for words, ids in zip(split, found):
            if None in ids:
                for i in list(compress(range(len(ids)), map(missing, ids))):
                    ids[i] = kept[words[i]]
            out.append(b"".join(ids) + end)
        for w in new[:max(0, len(kept) - KEPT_UNITS)]:
            del kept[w]
        return out
