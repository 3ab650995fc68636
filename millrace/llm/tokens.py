"""Token ids of texts, many documents at a time, with the tokenizers library (inside tasks).

Pre-tokenizers never join what is before a single blank with what is after it, so a text is
encoded piece by piece, and the ids of a piece are remembered: each word is tokenized once per
worker, as long as it is remembered. Blanks next to other white space or at the ends of a
text stay inside their piece. The strings of special tokens, which hold no blank, are cut out and
encoded as these, as the library does. Plain words, of Latin letters and perhaps a full stop or comma,
need no normalizer and no pre-tokenizer but a split at blanks, which is faster.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache
from itertools import compress
from operator import not_

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are encoded in runs of about so many bytes; those longer than twice this are cut at blanks between letters.
RUN_BYTES = 1 << 22
#: Pieces that a worker remembers at most (some 170 bytes each); then it starts anew.
REMEMBERED = 1_500_000

_CUT = re.compile("[A-Za-z](?= [A-Za-z])")
_SPACE = "[" + "".join(f"\\x{{{ord(c):X}}}" for c in map(chr, range(0x3001)) if c.isspace()) + "]"
_ODD = f" {_SPACE}|{_SPACE} |^ | $"
# Letters that are one letter in lower case too, so that a word stays a word.
_PLAIN = re.compile("[A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u012f\u0131-\u024f]+[.,]?").fullmatch
_OTHER_SPACE = re.compile(r"[^\S ]+")
_BETWEEN = re.compile(r"(?<=\S) (?=\S)")


@lru_cache(maxsize=4)
def tokenizer(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def id_type(path: str) -> np.dtype:
    """The smallest unsigned type for the vocabulary's ids."""
    return np.dtype("<u2" if tokenizer(path).get_vocab_size() <= 1 << 16 else "<u4")


def _plain_tokenizer(whole):
    """The same model for texts whose words are parted by blanks, in the letters that stand for bytes."""
    from tokenizers import Tokenizer

    kind = json.loads(whole.to_str())
    kind["normalizer"], kind["added_tokens"] = None, []
    kind["pre_tokenizer"] = {"type": "Split", "pattern": {"String": " "}, "behavior": "Removed", "invert": False}
    return Tokenizer.from_str(json.dumps(kind))


class Encoder:
    """Encodes pieces that follow a blank; `remembered` has the ids of those that it knows."""

    def __init__(self, path: str, most: int):
        self.tokenizer, self.most = tokenizer(path), most
        self.remembered: dict[str, bytes] = {}
        self.plain = _plain_tokenizer(self.tokenizer)
        self.lowers = json.loads(self.tokenizer.to_str())["normalizer"] is not None
        # Byte-level vocabularies have a letter for each byte: that of a printable one is its own.
        own = [*range(33, 127), *range(161, 173), *range(174, 256)]
        others = [b for b in range(256) if b not in own]
        self.letters = {b: 256 + i for i, b in enumerate(others)}
        self.spelled = np.arange(256, dtype="<u4")  # but a blank stays one
        self.spelled[[b for b in others if b != 32]] = [self.letters[b] for b in others if b != 32]
        names = self.tokenizer.get_vocab()
        self.sizes = np.zeros(max(names.values()) + 1, dtype=np.int64)
        for name, id in names.items():
            self.sizes[id] = len(name.removesuffix("</w>"))  # one letter for each byte

    def each(self, strings: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(strings, add_special_tokens=False)
        return [np.array(e.ids, dtype="<u4").tobytes() for e in found]

    def _cut(self, ids: list[int], sizes: list[int]) -> list[bytes] | None:
        """Ids of pieces encoded as one text: tokens stand for bytes, and each piece for `sizes` bytes."""
        ids = np.array(ids, dtype="<u4")
        ends, bounds = np.cumsum(self.sizes[ids]), np.cumsum(sizes)
        at = np.minimum(np.searchsorted(ends, bounds), len(ids) - 1)
        if not len(ids) or ends[-1] != bounds[-1] or (ends[at] != bounds).any() or min(sizes) < 1:
            return None
        raw, cuts = ids.tobytes(), (4 * (at + 1)).tolist()
        return [raw[i:j] for i, j in zip([0, *cuts], cuts)]

    def _plain_pieces(self, pieces: list[str]) -> list[bytes]:
        text = " ".join(pieces)
        text = text.lower() if self.lowers else text
        sizes = [len(p.encode()) + (not self.lowers) for p in text.split(" ")]
        # In the letters of the vocabulary; the blank before a word is its first letter, if there is one.
        letters = self.spelled[np.frombuffer(text.encode(), dtype=np.uint8)].tobytes().decode("utf-32-le")
        letters = letters.replace(".", " .").replace(",", " ,")
        if not self.lowers:
            blank = chr(self.letters[32])
            letters = " ".join([x if x in (".", ",") else blank + x for x in letters.split(" ")])
        found = self.plain.encode_batch_fast([letters], add_special_tokens=False)[0].ids
        return self._cut(found, sizes) or self.each([" " + p for p in pieces])

    def _other_pieces(self, pieces: list[str]) -> list[bytes]:
        whole = " " + " ".join(pieces)
        if self.lowers:
            parts = _OTHER_SPACE.sub("", unicodedata.normalize("NFC", whole)).lower().split(" ")[1:]
            sizes = [len(p.encode()) for p in parts]
        else:
            sizes = [len(p.encode()) + 1 for p in pieces]
        found = self.tokenizer.encode_batch_fast([whole], add_special_tokens=False)[0].ids
        cut = self._cut(found, sizes) if len(sizes) == len(pieces) else None
        return cut or self.each([" " + p for p in pieces])

    def _after_blank(self, pieces: list[str]) -> list[bytes]:
        """The ids of each piece, from encoding many of them as one text."""
        plain = list(map(bool, map(_PLAIN, pieces)))
        chosen = list(compress(pieces, plain))
        others = list(compress(pieces, map(not_, plain)))
        found = iter(self._plain_pieces(chosen) if chosen else ())
        rest = iter(self._other_pieces(others) if others else ())
        return [next(found) if x else next(rest) for x in plain]

    def after_blank(self, distinct: list[str]) -> list[bytes]:
        known = self.remembered
        out = list(map(known.get, distinct))
        missing = [p for p, x in zip(distinct, out) if x is None]
        if not missing:
            return out
        if len(known) + len(missing) > self.most:
            known.clear()
        new = self._after_blank(missing)
        known.update(zip(missing, new))
        fresh = iter(new)
        return [next(fresh) if x is None else x for x in out]

    def run(self, column: pa.Array) -> list[np.ndarray]:
        """Ids of texts: cut at blanks, each distinct piece looked up once, and put together again."""
        odd = pc.match_substring_regex(column, _ODD).to_numpy(zero_copy_only=False)
        cut = pc.split_pattern(column, pattern=" ")
        if odd.any():
            cut = cut.to_pylist()
            for i in np.flatnonzero(odd):
                cut[i] = _BETWEEN.split(column[int(i)].as_py())
            cut = pa.array(cut, pa.large_list(pa.large_string()))
        first = cut.offsets.to_numpy() - cut.offsets[0].as_py()
        encoded = cut.flatten().dictionary_encode()
        distinct, which = encoded.dictionary.to_numpy(zero_copy_only=False).tolist(), encoded.indices.to_numpy().copy()
        heads = [distinct[i] for i in which[first[:-1]]]
        which[first[:-1]] = np.arange(len(distinct), len(distinct) + len(heads))
        known = [*self.after_blank(distinct), *self.each(heads)]
        sizes = np.fromiter(map(len, known), dtype=np.int64, count=len(known)) // 4
        ids, start = np.frombuffer(b"".join(known), dtype="<u4"), np.cumsum(sizes) - sizes
        n = sizes[which]
        upto = np.r_[0, np.cumsum(n)]
        flat = ids[np.repeat(start[which] - upto[:-1], n) + np.arange(upto[-1])]
        return np.split(flat, upto[first[1:-1]])


@lru_cache(maxsize=4)
def encoder(path: str, most: int) -> Encoder:
    return Encoder(path, most)


def _parts(text: str) -> list[str]:
    parts, at = [], 0
    while len(text) - at > 2 * RUN_BYTES:
        found = _CUT.search(text, at + RUN_BYTES)
        if not found:
            break
        parts.append(text[at : found.end()])
        at = found.end()
    return [*parts, text[at:]]


def encoded(column: pa.Array, path: str, remembered: int | None = None) -> Iterator[np.ndarray]:
    """The ids of each text in order, without special tokens; null is the empty text."""
    run = encoder(path, REMEMBERED if remembered is None else remembered).run
    column = column.cast(pa.large_string()).fill_null("")
    sizes = pc.binary_length(column).to_numpy()
    at = 0
    while at < len(sizes):
        end = at + max(1, int(np.searchsorted(np.cumsum(sizes[at : at + (1 << 16)]), RUN_BYTES, side="right")))
        if sizes[at] > 2 * RUN_BYTES:
            yield np.concatenate([run(pa.array([part], pa.large_string()))[0] for part in _parts(column[at].as_py())])
        else:
            yield from run(column.slice(at, end - at))
        at = end
