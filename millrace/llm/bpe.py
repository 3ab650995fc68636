"""BPE encoding by backtracking over longest matches, and decoding by an offset table.

A vocabulary's merges name every token after the two that it is made of, so undoing them, the
latest first, shows whether a merge would have crossed the border between two neighbouring
tokens: if none does, the pair is compatible. A sequence of tokens is what the merges make of a
text if and only if all of its neighbours are compatible, and there is one such sequence. It is
found from the left: take the longest token that begins here, if it is compatible with the one
before; else the next shorter; if none is left, give up the token before. A position that was
given up once is never reached again, so the work is linear in the text, whatever the text is.

The longest token from every position, if it is not just a symbol, comes from one pass of an Aho-Corasick automaton of the
reversed tokens over the reversed text. Tokens that the merges never make by themselves are not
in it.

Normalizer, pre-tokenizer and special strings are those of the tokenizer's file, as the library
applies them; special strings are cut out of the raw text first. Where white space only parts
words, each distinct run of other characters is encoded once as long as a worker remembers it.

Decoding looks up the bytes of each id between two offsets of one table: without a decoder in
the file tokens are joined by a blank, with a byte-level one their bytes are put together, and
what is not UTF-8 is replaced.

Null texts are empty, and empty texts have no ids; null ids are an empty text. Ids outside of
the vocabulary are left out, as the library does. Repeated rows and ids are rows like others, and
empty tables give no rows. Other columns are carried along; helper names start with `_bpe`.
"""

from __future__ import annotations

import json
import os
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.llm.runs import Words, slices
from millrace.llm.words import utf8

#: What a worker remembers of encoded strings at most, in bytes; then it starts anew.
REMEMBERED_BYTES = 96 << 20
#: Bytes that a remembered string takes besides its own and its ids'.
_ENTRY = 200
#: Pairs of tokens whose compatibility is remembered at most.
PAIRS = 1 << 18
#: Characters of pieces that are encoded together.
RUN = 1 << 16
_LATIN = re.compile("[!-~\u00c0-\u024f]+").fullmatch
_LETTERS = bytes(range(33, 127)) + bytes(range(161, 173)) + bytes(range(174, 256))


def _letters() -> dict[str, int]:
    """Byte-level vocabularies spell a byte as its own character if that can be seen, else as one from 256 on."""
    others = [b for b in range(256) if b not in _LETTERS]
    return {chr(b): b for b in _LETTERS} | {chr(256 + i): b for i, b in enumerate(others)}


class Merges:
    """Tokens by number: symbols first, then what each merge makes, in the order of the merges."""

    def __init__(self, symbols: list[str], merges: list[tuple[str, str]], suffix: str = ""):
        #: What a symbol stands for in a piece; symbols with the suffix stand at its end.
        self.end = 1 << 12
        self.number = {name: k for k, name in enumerate(symbols)}
        spelled = [chr(ord(s.removesuffix(suffix)) + self.end) if suffix and len(s) > 1 else s for s in symbols]
        self.left, self.right = list(range(len(symbols))), list(range(len(symbols)))
        self.made: dict[tuple[int, int], int] = {}
        for a, b in merges:
            k, pair = len(self.left), (self.number[a], self.number[b])
            name = a.removesuffix(suffix) + b if suffix and a.endswith(suffix) else a + b
            if pair in self.made or name in self.number:
                raise ValueError(f"{name} is made by two merges")
            self.number[name], self.made[pair] = k, k
            self.left.append(pair[0]), self.right.append(pair[1])
            spelled.append(spelled[pair[0]] + spelled[pair[1]])
        self.spelled, self.size, self.suffix = spelled, list(map(len, spelled)), suffix
        self._search()
        #: The number of what is before the first token of a piece: a symbol that is in no merge.
        self.start = len(self.left)
        self.left.append(self.start), self.right.append(self.start)
        #: For each token, which tokens behind it are known to be compatible.
        self.known: list[dict[int, bool]] = [{} for _ in self.left]
        self.held = 0

    def _search(self) -> None:
        import ahocorasick

        base = len(self.left) - len(self.made)
        alone = [True] * base
        for k in range(base, len(self.left)):
            a, b = self.left[k], self.right[k]
            alone.append(alone[a] and alone[b] and self.apart(a, b, k))
        of = {s: k for k, s in enumerate(self.spelled) if alone[k]}
        self.automaton = ahocorasick.Automaton()
        for s, k in of.items():
            if k >= base:
                self.automaton.add_word(s[::-1], k)
        self.automaton.make_automaton()
        #: The symbol that a character stands for.
        self.symbol = np.full(max(map(ord, self.spelled[:base])) + 1, -1, dtype=np.int32)
        self.symbol[list(map(ord, self.spelled[:base]))] = np.arange(base)
        #: The longest token that a token begins with, but for itself; -1 if there is none.
        self.shorter = [next((of[s[:n]] for n in range(len(s) - 1, 0, -1) if s[:n] in of), -1) for s in self.spelled]

    def apart(self, a: int, b: int, before: int | None = None) -> bool:
        """Whether no merge (or none earlier than `before`) crosses the border between tokens a and b."""
        latest = len(self.left) if before is None else before
        while True:
            # What the two make, if it was made before the last token undone: it came first.
            if self.made.get((a, b), latest) < latest:
                return False
            whole = self.left[a] == a, self.left[b] == b
            if all(whole):
                return True
            # Undo the later of the two; merges of one rank go from left to right.
            if whole[1] or (a > b and not whole[0]):
                latest, a = a, self.right[a]
            else:
                latest, b = b + 1, self.left[b]

    def encode(self, pieces: list[str]) -> list[list[int]]:
        """The numbers of what the merges make of each piece, in symbols."""
        if self.suffix:
            pieces = [p[:-1] + chr(ord(p[-1]) + self.end) for p in pieces]
        out: list[list[int]] = []
        for part in _runs(pieces):
            out += self._run(part)
        return out

    def _run(self, pieces: list[str]) -> list[list[int]]:
        # All pieces as one text; a line feed is in no token.
        text = "\n".join(pieces)
        n = len(text)
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        longest, reached = array("i", self.symbol[codes].tobytes()), n
        longest.append(-1)
        for at, token in self.automaton.iter(text[::-1]):
            # Longest first for every end, which is the beginning of the token.
            if n - 1 - at < reached:
                reached = n - 1 - at
                longest[reached] = token
        size, shorter, known, apart, start = self.size, self.shorter, self.known, self.apart, self.start
        if self.held > PAIRS:
            self.held = 0
            for row in known:
                row.clear()
        open_ = bytearray(b"\1") * (n + 1)
        out, at = [], 0
        for piece in pieces:
            end = at + len(piece)
            token, last, found = longest[at], start, []
            while at < end:
                after = at + size[token]
                if open_[after]:
                    row = known[last]
                    fits = row.get(token)
                    if fits is None:
                        fits = row[token] = apart(last, token)
                        self.held += 1
                    if fits:
                        found.append(token)
                        at, last, token = after, token, longest[after]
                        continue
                token = shorter[token]
                if token < 0:
                    # The end of the token given up is closed now, so its next shorter one is tried.
                    open_[at] = 0
                    token = found.pop()
                    at -= size[token]
                    last = found[-1] if found else start
            out.append(found)
            at = end + 1
        return out


def _runs(pieces: list[str]) -> Iterator[list[str]]:
    """Pieces in runs of some length together; a longer piece is a run by itself."""
    at = 0
    while at < len(pieces):
        size, end = len(pieces[at]), at + 1
        while end < len(pieces) and size + len(pieces[end]) <= RUN:
            size, end = size + len(pieces[end]) + 1, end + 1
        yield pieces[at:end]
        at = end


class Bpe:
    """A tokenizer's file: encoding and decoding many texts at a time."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        kind = json.loads(self.library.to_str())
        model = kind["model"]
        suffix = model.get("end_of_word_suffix") or ""
        if model["type"] != "BPE" or any(model.get(k) for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges")):
            raise ValueError("not a byte-level BPE of plain merges")
        letters = _letters()
        symbols = [s for c in letters for s in ((c, c + suffix) if suffix else (c,))]
        names = model["vocab"]
        self.merges = Merges(symbols, [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]], suffix)
        self.id = np.array([names[name] for name in self.merges.number], dtype="<u4")
        special = {t["content"]: t["id"] for t in kind["added_tokens"]}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in kind["added_tokens"]):
            raise ValueError("special strings are looked for in the raw text only")
        self.special = special
        self.spelling = {b: c for c, b in letters.items()}
        self.cut = re.compile("|".join(map(re.escape, sorted(special, key=len, reverse=True)))) if special else None
        # Whether white space only parts words, so that these can be encoded by themselves.
        self.parted = all(self.pieces(f"Abc{s}x ") == [*self.pieces("Abc"), *self.pieces("x")] for s in " \t\n\v\f\r")
        self.plain = self._plain_pattern(kind) if self.parted else None
        self.known: dict[str, bytes] = {}
        self.known_pieces: dict[str, bytes] = {}
        self.held = 0
        self._offsets({**names, **special}, kind["decoder"], letters)

    @staticmethod
    def _plain_pattern(kind: dict):
        """The file's own pattern of pieces, if normalizing precomposed Latin text means lower case only."""
        steps = kind["normalizer"] or {}
        names = {x["type"] for x in steps.get("normalizers", [steps])} - {None}
        first = (kind["pre_tokenizer"].get("pretokenizers") or [kind["pre_tokenizer"]])[0]
        spaces = [x["pattern"].get("Regex") for x in steps.get("normalizers", []) if x["type"] == "Replace"]
        if names != {"NFC", "Replace", "Lowercase"} or spaces != ["\\s+"] or first["type"] != "Split" or first["behavior"] != "Removed" or not first["invert"]:
            return None
        return regex.compile(first["pattern"]["Regex"]).findall

    def pieces(self, text: str) -> list[str]:
        if self.library.normalizer is not None:
            text = self.library.normalizer.normalize_str(text)
        return [p for p, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]

    def _parts(self, text: str) -> list[str | bytes]:
        """The pieces of a text, and the ids of special strings."""
        if self.cut is None or "<" not in text and not self.cut.search(text):
            if self.plain and _LATIN(text):
                text, word = text.lower(), text.isalpha()
                if text.isascii():
                    return [text] if word else self.plain(text)
                return [p.encode().decode("latin-1").translate(self.spelling) for p in self.plain(text)]
            return self.pieces(text)
        parts, at = [], 0
        for hit in self.cut.finditer(text):
            parts += [*self.pieces(text[at : hit.start()]), self.special[hit[0]].to_bytes(4, "little")]
            at = hit.end()
        return parts + self.pieces(text[at:])

    def strings(self, texts: list[str]) -> list[bytes]:
        """The ids of texts, or of parts of one between white space, as bytes."""
        found = list(map(self.known.get, texts))
        missing = [t for t, x in zip(texts, found) if x is None]
        if not missing:
            return found
        if self.held > REMEMBERED_BYTES:
            self.known, self.known_pieces, self.held = {}, {}, 0
        pieces = self.known_pieces
        split = list(map(self._parts, missing))
        new = list(dict.fromkeys(p for parts in split for p in parts if p not in pieces and type(p) is str))
        numbers = self.merges.encode(new)
        flat = self.id[np.fromiter(chain.from_iterable(numbers), dtype=np.int64)].tobytes()
        ends = (4 * np.cumsum(list(map(len, numbers)), dtype=np.int64)).tolist()
        pieces.update(zip(new, map(flat.__getitem__, map(slice, [0, *ends], ends))))
        made = [b"".join([p if type(p) is bytes else pieces[p] for p in parts]) for parts in split]
        self.held += sum(map(len, new)) + _ENTRY * len(new)
        if self.parted:
            self.known.update(zip(missing, made))
            self.held += sum(map(len, missing)) + sum(map(len, made)) + _ENTRY * len(made)
        fresh = iter(made)
        return [next(fresh) if x is None else x for x in found]

    def encode(self, texts: list[bytes]) -> Iterator[bytes]:
        """The ids of each text, unsigned little-endian numbers of 32 bits."""
        for part in slices(texts):
            if not self.parted:
                yield from self.strings([t.decode() for t in part])
                continue
            words = Words(part)
            strings = words.encoded()
            ids = self.strings([s[:-1].decode() for s in strings.dictionary.to_pylist()])
            size, which = np.fromiter(map(len, ids), dtype=np.int64, count=len(ids)) // 4, strings.indices.to_numpy()
            flat = np.frombuffer(b"".join(ids), dtype="<u4")[_places((np.cumsum(size) - size)[which], size[which])].tobytes()
            ends = 4 * np.r_[0, np.cumsum(size[which])][words.first]
            yield from (flat[a:b] for a, b in zip(ends[:-1], ends[1:]))

    def _offsets(self, names: dict[str, int], decoder: dict | None, letters: dict[str, int]) -> None:
        if decoder is not None and decoder["type"] != "ByteLevel":
            raise ValueError(f"decoder {decoder['type']}")
        self.blank = decoder is None
        entries = [b""] * (max(names.values()) + 1)
        for name, id in names.items():
            entries[id] = name.encode() + b" " if self.blank else bytes(letters[c] for c in name)
        self.table = np.frombuffer(b"".join(entries), dtype=np.uint8)
        self.offset = np.r_[0, np.cumsum(list(map(len, entries)))]

    def decode(self, ids: list[bytes]) -> Iterator[bytes]:
        """The text of each sequence of ids."""
        for raw in ids:
            one = np.frombuffer(raw, dtype="<u4")
            one = one[one < len(self.offset) - 1]
            start, size = self.offset[one], np.diff(self.offset)[one]
            raw = self.table[_places(start, size)].tobytes()
            yield raw[:-1] if self.blank else raw.decode("utf-8", "replace").encode()


def _places(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    upto = np.cumsum(size) - size
    return np.repeat(start - upto, size) + np.arange(size.sum())


@lru_cache(maxsize=2)
def bpe(path: str) -> Bpe:
    return Bpe(path)


def _mapped(rows: DataFrame, column: str, made: str, kind: str, each) -> DataFrame:
    """`rows` with a column more, by `each` over lists of values; runs of a batch are passed on as they are done."""
    schema = StructType([f for f in rows.schema.fields if f.name != made]).add(made, kind)
    names = schema.names

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, at = utf8(batch.column(column)), 0
            for part in slices(values):
                own = batch.slice(at, len(part))
                new = pa.array(list(each(part)), pa.binary())
                yield pa.RecordBatch.from_arrays([*[own.column(n) for n in names[:-1]], new.cast(pa.string()) if kind == "string" else new], names=names)
                at += len(part)

    return rows.mapInArrow(step, schema)


def encoded(docs: DataFrame, path: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """`docs` (or only its columns `keep`) with `_bpe_ids`, unsigned little-endian numbers of 32 bits."""
    kept = [c for c in (docs.columns if keep is None else keep) if not c.startswith("_bpe")]
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text}`").cast("string").alias("_bpe_text"))
    each = lambda texts: bpe(path).encode(texts)
    return _mapped(rows, "_bpe_text", "_bpe_ids", "binary", each).drop("_bpe_text")


def decoded(rows: DataFrame, path: str, ids: str = "_bpe_ids") -> DataFrame:
    """`rows` with `_bpe_decoded`, the texts of `ids`."""
    each = lambda values: bpe(path).decode(values)
    return _mapped(rows, ids, "_bpe_decoded", "string", each)
