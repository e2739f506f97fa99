"""Fast exact encoding with a public tokenizer.

A byte-level or word-level BPE never merges across the borders that its
pre-tokenizer sets. Batches of texts are cut at such borders, found from the
classes of neighbouring characters; what lies between two cuts, a unit, is
mostly a word with the space before it. Arrow numbers the different units of a
batch, so that each is looked up once; the model of the tokenizers library
encodes units not met before, and their ids are remembered for the next texts.
Units with letters beyond the Latin blocks go through the library whole; so do
texts with rare white space, and texts that hold the string of an added token,
which the library makes one id.
"""

from __future__ import annotations

import json
import os
import sys
import types
from array import array
from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

#: Units remembered in each of two generations; when the young one is full it becomes the old one.
GENERATION = 250_000
#: The pattern of the byte-level pre-tokenizer, which the tokenizer files do not spell out (fixed value).
BYTE_LEVEL = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Bytes of text that are cut at a time; a longer text is cut by itself.
SLICE = 8 << 20
#: From here on a unit is left to the library: below, no character combines with another or is cased by its neighbours.
_FAR = "ɐ"
#: White space beyond _FAR, and what is white space to Python but not to the tokenizers.
_RARE_SPACE = "[\x1c-\x1f\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
#: Classes of characters: letters, numbers, the space, other white space, the apostrophe, all else, and those left to the library.
_LETTER, _NUMBER, _SPACE, _WHITE, _QUOTE, _ELSE, _LIBRARY = range(7)


def _class_of(c: str) -> int:
    if max(c.lower()) >= _FAR:
        return _LIBRARY
    if c in " '":
        return _SPACE if c == " " else _QUOTE
    return next((k for k, p in ((_LETTER, r"\p{L}"), (_NUMBER, r"\p{N}"), (_WHITE, r"\s")) if regex.match(p, c)), _ELSE)


def _border(a: int, b: int) -> int:
    """Whether a text is always cut between neighbours of these classes: 0 no,
    1 yes, 2 if b is the last white space before other text. A quote may begin
    a piece with the letters that follow, and a space belongs to what follows."""
    white = (_SPACE, _WHITE)
    if b in white:
        return 2 if a in white else 1
    if a in white:
        return int(a == _WHITE)
    if _LIBRARY in (a, b) or (a, b) == (_QUOTE, _LETTER):
        return 0
    return int((a if a != _QUOTE else _ELSE) != (b if b != _QUOTE else _ELSE))


#: Classes by code point, as far as two bytes of UTF-8 go.
_CLASSES = np.array([_class_of(chr(k)) for k in range(ord(_FAR))] + [_LIBRARY] * (0x800 - ord(_FAR)), np.uint8)
_BYTES = np.concatenate([_CLASSES[:128], np.full(128, _LIBRARY, np.uint8)])
_BORDERS = np.array([_border(a, b) if max(a, b) <= _LIBRARY else 0 for a in range(8) for b in range(8)], np.uint8)


def cuts(text: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where units of texts begin, and the class of each byte. ``text``: their
    UTF-8 bytes one behind the other, ``starts``: where each begins, and the end."""
    kind = _BYTES[text]
    lead = np.flatnonzero((text >= 0xC2) & (text < 0xE0))  # of two bytes
    code = (text[lead].astype(np.uint16) & 31) << 6 | text[lead + 1] & 63
    kind[lead] = kind[lead + 1] = _CLASSES[code]
    begins = np.zeros(len(text) + 1, bool)
    begins[starts] = True
    cut = np.zeros(len(text), np.uint8)
    cut[1:] = _BORDERS[kind[:-1] << 3 | kind[1:]]
    cut[lead + 1] = 0
    run = np.flatnonzero(cut == 2)
    after = run + 1 + (text[run] >= 0x80)
    here = ~begins[after]
    here[here] &= (kind[after[here]] != _SPACE) & (kind[after[here]] != _WHITE)
    cut[run] = here
    return np.flatnonzero((cut > 0) | begins[:-1]), kind


def _lowered(text: np.ndarray, at: np.ndarray, kind: np.ndarray) -> np.ndarray:
    """``text`` with A-Z in lower case, but for units that are left to the library."""
    upper = np.flatnonzero((text >= 65) & (text <= 90))
    if len(far := np.flatnonzero(kind == _LIBRARY)):
        upper = upper[~np.isin(np.searchsorted(at, upper, "right"), np.searchsorted(at, far, "right"))]
    text = text.copy()
    text[upper] |= 32
    return text


def byte_letters() -> dict[int, str]:
    """The byte-level alphabet: a printable character for every byte. Bytes
    that print stand for themselves, the others follow from 256 on."""
    prints = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in prints]
    return {b: chr(b) for b in prints} | {b: chr(256 + k) for k, b in enumerate(rest)}


class _Known(dict):
    """Unit -> ids. What is missing is looked up in the generation before, or learned."""

    def __init__(self, learn, old: dict):
        self.learn, self.old = learn, old

    def __missing__(self, key: str) -> bytes:
        found = self.old.get(key)
        if found is None:
            found = self.learn(key)
        self[key] = found
        return found


class ChunkEncoder:
    """``batch(texts)``, ``ids(text)``: ids as little-endian unsigned 32-bit bytes, no special tokens
    added. Their strings in a text are ordinary text if ``special_as_text``,
    else the ids that the library's default setting gives them."""

    def __init__(self, path: str, special_as_text: bool = True):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task per core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        with open(path, encoding="utf-8") as f:
            settings = json.load(f)
        added = [t for t in settings.get("added_tokens", ()) if not (special_as_text and t["special"])]
        #: strings that the library looks for before it normalises; one that it looks for afterwards may show in any text
        self.added = ["" if t["normalized"] and settings.get("normalizer") else t["content"] for t in added]
        #: with a normaliser, white space of any kind separates and is dropped; else it stays with what follows
        self.drops_space = settings.get("normalizer") is not None
        steps = settings["pre_tokenizer"].get("pretokenizers", [])
        self.pieces_of = regex.compile(next((s["pattern"]["Regex"] for s in steps if s["type"] == "Split"), BYTE_LEVEL)).findall
        self.letters = byte_letters()
        self.model = self.tokenizer.model.tokenize
        self.known = _Known(self._unit, {})

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _piece(self, piece: str) -> bytes:
        return self._shown(piece if piece.isascii() and piece.isalpha() else piece.encode().decode("latin-1").translate(self.letters))

    def _shown(self, piece: str) -> bytes:
        """The ids of a piece in the byte-level alphabet, where ASCII letters stand for themselves."""
        return array("I", [t.id for t in self.model(piece)]).tobytes()

    def _unit(self, unit: str) -> bytes:
        if self.drops_space:
            lower = unit.strip().lower()
            if not lower.isascii() and max(lower) >= _FAR:
                return self._whole(unit)
            unit = lower
        elif not unit.isascii() and max(unit) >= _FAR:
            return self._whole(unit)
        if unit.isalpha():
            return self._piece(unit)
        if unit[:1] == " " and unit[1:].isalpha():
            return self._shown(self.letters[32] + unit[1:]) if unit.isascii() else self._piece(unit)
        return b"".join(map(self._piece, self.pieces_of(unit)))

    def ids(self, text: str | None) -> bytes:
        return next(self.batch(pa.array([text], pa.string())))

    def batch(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text of an Arrow array; null is empty."""
        if len(self.known) > GENERATION:
            self.known = _Known(self.known.learn, dict(self.known))
        texts = pc.fill_null(texts, "")
        whole = pc.match_substring_regex(texts, _RARE_SPACE).to_numpy(zero_copy_only=False).copy()
        for a in self.added:
            whole |= pc.match_substring(texts, a).to_numpy(zero_copy_only=False)
        rows = pc.if_else(pa.array(whole), "", texts)
        starts = np.frombuffer(rows.buffers()[1], np.int32, len(rows) + 1, 4 * rows.offset)
        text = np.frombuffer(rows.buffers()[2] or b"", np.uint8)[starts[0]:starts[-1]]
        starts = starts - starts[0]
        at, kind = cuts(text, starts)
        if self.drops_space:
            text = _lowered(text, at, kind)
        at = np.append(at, len(text)).astype(np.int32)
        units = pa.StringArray.from_buffers(len(at) - 1, pa.py_buffer(at), pa.py_buffer(text)).dictionary_encode()
        known = list(map(self.known.__getitem__, units.dictionary.to_numpy(zero_copy_only=False).tolist()))
        found = pa.array(known, pa.large_binary()).take(units.indices)
        _, ends, data = found.buffers()
        borders = np.frombuffer(ends, np.int64, len(at))[np.searchsorted(at, starts)].tolist()
        data = memoryview(data or b"")
        for k, (a, b) in enumerate(pairwise(borders)):
            yield self._whole(texts[k].as_py()) if whole[k] else bytes(data[a:b])


def encoder(path: str) -> ChunkEncoder:
    """The encoder of this Python process: what a worker learned in one task serves its next ones."""
    kept = sys.modules.setdefault("_ledgerstar_encoders", types.ModuleType("_ledgerstar_encoders"))
    if path not in kept.__dict__:
        kept.__dict__[path] = ChunkEncoder(path, special_as_text=False)
    return kept.__dict__[path]


def encoded_batches(path: str, batches: Iterable[pa.RecordBatch]) -> Iterator[tuple]:
    """Arrow batches of (id, text) as (id, ids) rows."""
    for batch in batches:
        names, texts = batch.columns
        if not len(texts):
            continue
        number = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy().astype(np.int64)) // SLICE
        for a, b in pairwise([0, *(np.flatnonzero(np.diff(number)) + 1).tolist(), len(texts)]):
            yield from zip((v.as_py() for v in names[a:b]), encoder(path).batch(texts[a:b]), strict=True)


def encoded_rows(path: str, rows: Iterable[tuple]) -> Iterator[tuple]:
    """(id, text) rows as (id, ids)."""
    names, texts = list(zip(*rows, strict=True)) or ((), ())
    return encoded_batches(path, [pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(texts, pa.string())], ["id", "text"])])
