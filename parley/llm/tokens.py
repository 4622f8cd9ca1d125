"""Token ids of whole texts by a vocabulary file of the tokenizers library.

Encoding goes by segments at which the tokenizer itself always begins anew, so that the ids of a
text are those of its segments one after another: before white space that follows another
character, and between a Latin letter or digit and ASCII punctuation. Segments met before come from a
bounded cache. Of new ones, runs of Latin letters go to the library's model at once (what the
tokenizer does before is plain for them: lower case where the file says so, and bytes as the
model's letters), all others through the whole tokenizer. Where words end in a mark of their own, the new
words of many texts go to the model in one call, and their ids are cut apart at these marks.
"""

from __future__ import annotations

import codecs
import json
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from .textops import run_hash, text_buffers

# Unicode white space, Latin letters (but the dotted capital I, whose small form ends
# in a mark that joins what follows) and digits, ASCII punctuation.
_WHITE = r"\t-\r \x85\xa0  -     　"
_LETTER = r"0-9A-Za-zÀ-ÖØ-öø-įı-ɏ"
_PUNCT = r"!-/:-@\[-`{-~"
#: With the white space before a word kept (byte-level), and without (word ends; it is dropped).
SPACED = re.compile(rf"[{_WHITE}]*[{_LETTER}]+(?![^{_WHITE}{_PUNCT}])|[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
BARE = re.compile(rf"[{_LETTER}]+(?![^{_WHITE}{_PUNCT}])|[^{_WHITE}]+")
CACHE, WORDS = 60_000, 200_000
#: Bytes of text whose words are looked up together, and how many new words go to the model in one string.
TOGETHER, RUN = 1 << 21, 1000
_LATIN = "A-Za-zÀ-ÖØ-öø-įı-ɏ"
#: Runs of Latin letters of which each has one small letter of its own, after a space or nothing.
_PLAIN = re.compile(rf" ?[{_LATIN}]+")
#: For words, in the syntax of Arrow's expressions: such letters alone, and what may follow them from an ASCII punctuation mark on, a segment of its own.
#: With the space before a word, where it is kept, or without.
_LETTERED = {space: rf"^{space}[{_LATIN}]+$" for space in ("", " ")}
_PARTED = {space: rf"^(?P<head>{space}[{_LATIN}]+)(?P<rest>[{_PUNCT}][^{_WHITE}]*)$" for space in ("", " ")}
#: Unicode white space beyond ASCII by its UTF-8 bytes.
_WIDE = tuple(c.encode() for c in "\x85\xa0\u1680\u2028\u2029\u202f\u205f\u3000" + "".join(map(chr, range(0x2000, 0x200B))))


def _letters() -> str:
    """The byte-level rule, by byte: printable bytes of Latin-1 stand for themselves, the others, in order,
    for the characters from 256 on."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    hidden = [b for b in range(256) if b not in shown]
    return "".join(chr(b if b in shown else 256 + hidden.index(b)) for b in range(256))


_LETTERS = _letters()
#: The same with a space for a line break.
_LINES = _LETTERS[:10] + " " + _LETTERS[11:]


def vocabulary(name: str) -> str:
    """The path of a public vocabulary file."""
    import public_tokenizers

    return public_tokenizers.path(name)


class _Cache(dict):
    """Piece of text to the bytes of its ids; asks ``learn`` for what it lacks. Beyond ``most`` pieces
    it begins anew, but still takes over from the ones before what is asked for again."""

    def __init__(self, learn: Callable, most: int) -> None:
        super().__init__()
        self.learn, self.most, self.before = learn, most, {}

    def __missing__(self, piece: str | bytes) -> bytes:
        found = self.before.get(piece)
        if found is None:
            found = self.learn(piece)
        self[piece] = found
        return found

    def turn(self) -> None:
        if len(self) > self.most:
            self.before = dict(self)
            self.clear()


def _runs(flat: np.ndarray, begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The runs flat[begin : begin + size] one after another."""
    upto = np.cumsum(size)
    total = int(upto[-1]) if len(upto) else 0
    kind = np.int32 if max(total, len(flat)) < 1 << 31 else np.int64
    return flat[np.repeat((begin - upto + size).astype(kind), size) + np.arange(total, dtype=kind)]


def _white(raw: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 text belong to white space."""
    out = (raw == 32) | ((raw > 8) & (raw < 14))
    at = np.flatnonzero((raw == 0xC2) | ((raw > 0xE0) & (raw < 0xE4)))
    for c in _WIDE:
        hit = at[at + len(c) <= len(raw)]
        for i, b in enumerate(c):
            hit = hit[raw[hit + i] == b]
        for i in range(len(c)):
            out[hit + i] = True
    return out


def _spaced(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Runs of white space each with the word after it, of all texts, and where each text's begin among them."""
    raw, off = text_buffers(texts)
    raw, off = np.ascontiguousarray(raw[off[0] : off[-1]]), off - off[0]
    first = _white(raw)
    first[1:] &= ~first[:-1].copy()
    first[off[:-1][off[:-1] < off[1:]]] = True
    starts = np.flatnonzero(first)
    bounds = np.append(starts, len(raw)).astype(np.int32)
    return pa.StringArray.from_buffers(len(starts), pa.py_buffer(bounds), pa.py_buffer(raw)), np.searchsorted(starts, off)


def _bare(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Words between ASCII white space of all texts, and where each text's begin among them."""
    lists = pc.ascii_split_whitespace(texts)
    return lists.flatten(), lists.offsets.to_numpy() - lists.offsets[0].as_py()


def _keys(words: pa.Array) -> np.ndarray:
    """A row of two 64-bit hashes for each word: by both a word is known."""
    raw, off = text_buffers(words)
    raw, off = raw[off[0] : off[-1]], off - off[0]
    return np.stack([run_hash(raw, off[:-1], off[1:], which) for which in (0, 1)], 1)


class _Words:
    """Distinct words by their keys, with their ids, in flat arrays and an open-addressed table."""

    def __init__(self) -> None:
        self.keys, self.flat = np.empty((0, 2), np.uint64), np.empty(0, "<u4")
        self.begin = self.size = np.empty(0, np.int64)
        self.table = np.full(1 << 16, -1, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return (keys[:, 0] & np.uint64(len(self.table) - 1)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The place of each word, -1 for one that isn't there."""
        out, slot, todo = np.full(len(keys), -1, np.int64), self._slots(keys), np.arange(len(keys))
        while len(todo):
            at = self.table[slot[todo]]
            todo, at = todo[at >= 0], at[at >= 0]
            hit = (self.keys[at] == keys[todo]).all(1)
            out[todo[hit]] = at[hit]
            todo = todo[~hit]
            slot[todo] = (slot[todo] + 1) & (len(self.table) - 1)
        return out

    def add(self, keys: np.ndarray, size: np.ndarray, ids: np.ndarray) -> None:
        """Take up words that aren't there yet."""
        first = len(self.keys)
        self.begin = np.concatenate([self.begin, len(self.flat) + np.cumsum(size) - size])
        self.size, self.flat, self.keys = np.concatenate([self.size, size]), np.concatenate([self.flat, ids]), np.concatenate([self.keys, keys])
        if 2 * len(self.keys) > len(self.table):
            self.table = np.full(4 << len(self.keys).bit_length(), -1, np.int32)
            first = 0
        todo, slot = np.arange(first, len(self.keys)), self._slots(self.keys[first:])
        while len(todo):
            free = self.table[slot] < 0
            self.table[slot[free]] = todo[free]
            left = self.table[slot] != todo
            todo, slot = todo[left], (slot[left] + 1) & (len(self.table) - 1)

    def ids(self, at: np.ndarray) -> np.ndarray:
        return _runs(self.flat, self.begin[at], self.size[at])


class Encoder:
    """Texts to the bytes of their ids, as little-endian unsigned 32-bit integers."""

    def __init__(self, path: str, segments: re.Pattern, special: bool = False) -> None:
        from tokenizers import Tokenizer, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.segments = segments.findall
        self.bare = segments.pattern == BARE.pattern  # a pattern that came with a task is another object
        self.small = "Lowercase" in str(self.tokenizer.normalizer)
        self.model = self.tokenizer.model
        self.cache = _Cache(self._learn, CACHE)
        self.words, self.before = _Words(), _Words()  # with the white space before them, or without it where it is dropped
        self.plain = Tokenizer(self.model)
        self.plain.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model, added = whole["model"], {t["content"]: t["id"] for t in whole["added_tokens"] if special}
        if any(t["normalized"] or t["single_word"] or t["lstrip"] or t["rstrip"] for t in whole["added_tokens"] if special):
            raise ValueError("special tokens that take what stands around them")
        self.special = re.compile("(" + "|".join(map(re.escape, sorted(added, key=len, reverse=True))) + ")") if added else None
        self.special_ids = {t: array("I", [i]).tobytes() for t, i in added.items()}
        space = "" if self.bare else " "
        self.lettered, self.parted = _LETTERED[space], _PARTED[space]
        mark = model["end_of_word_suffix"] if self.bare else _LETTERS[32]
        self.marked = np.zeros(max(model["vocab"].values()) + 1, bool)  # tokens that end a word, or begin one with its space
        self.marked[[i for t, i in model["vocab"].items() if (t.endswith if self.bare else t.startswith)(mark)]] = True

    def _lettered(self, word: str) -> str:
        return codecs.charmap_decode((word.lower() if self.small else word).encode(), "strict", _LETTERS)[0]

    def _learn(self, segment: str) -> bytes:
        if _PLAIN.fullmatch(segment):
            found = [t.id for t in self.model.tokenize(self._lettered(segment))]
        else:
            found = self.tokenizer.encode(segment, add_special_tokens=False).ids
        return array("I", found).tobytes()

    def _learn_lettered(self, words: pa.Array, keys: np.ndarray) -> None:
        """Take up words of Latin letters: their ids are cut apart at the model's mark for the end of a word, or the space before it."""
        if not len(words):
            return
        lists = pa.ListArray.from_arrays(pa.array([*range(0, len(words), RUN), len(words)], pa.int32()), words)
        runs = [codecs.charmap_decode((r.lower() if self.small else r).encode(), "strict", _LINES)[0] for r in pc.binary_join(lists, "\n").to_pylist()]
        ids = np.array([i for e in self.plain.encode_batch_fast(runs, add_special_tokens=False) for i in e.ids], "<u4")
        at = np.flatnonzero(self.marked[ids])
        if len(at) != len(words):
            raise ValueError("the vocabulary doesn't mark where words end")
        stops = at + 1 if self.bare else np.append(at, len(ids))[1:]
        self.words.add(keys, np.diff(stops, prepend=0), ids)

    def _learn_words(self, new: pa.Array, keys: np.ndarray) -> None:
        """Take up words: from those kept before the cache began anew, else by their segments."""
        known, only = self.words, lambda mask: (new.filter(pa.array(mask)), keys[mask])
        kept = self.before.find(keys)
        if (kept >= 0).any():
            at = kept[kept >= 0]
            known.add(keys[kept >= 0], self.before.size[at], self.before.ids(at))
            new, keys = only(kept < 0)
        lettered = pc.match_substring_regex(new, self.lettered).to_numpy(zero_copy_only=False)
        self._learn_lettered(*only(lettered))
        new, keys = only(~lettered)
        parts = pc.extract_regex(new, self.parted)
        parted = parts.is_valid().to_numpy(zero_copy_only=False)
        heads, rests = (pc.struct_field(parts.filter(pa.array(parted)), x).dictionary_encode() for x in ("head", "rest"))
        head_keys = _keys(heads.dictionary)
        lacks = known.find(head_keys) < 0
        self._learn_lettered(heads.dictionary.filter(pa.array(lacks)), head_keys[lacks])
        size, ids = self._segments(rests.dictionary, lambda x: [x])
        a, z = known.find(head_keys)[heads.indices.to_numpy()], rests.indices.to_numpy()
        begin = np.stack([known.begin[a], len(known.flat) + (np.cumsum(size) - size)[z]], 1).ravel()
        both = np.stack([known.size[a], size[z]], 1).ravel()
        known.add(keys[parted], known.size[a] + size[z], _runs(np.concatenate([known.flat, ids]), begin, both))
        known.add(keys[~parted], *self._segments(new.filter(pa.array(~parted)), self.segments))

    def _segments(self, words: pa.Array, cut: Callable) -> tuple[np.ndarray, np.ndarray]:
        found = [b"".join(map(self.cache.__getitem__, cut(w))) for w in words.to_pylist()]
        return np.array([len(x) // 4 for x in found], np.int64), np.frombuffer(b"".join(found), "<u4")

    def _encode_words(self, texts: pa.Array) -> Iterator[bytes]:
        every, begins = (_bare if self.bare else _spaced)(texts)
        coded = every.dictionary_encode()
        keys = _keys(coded.dictionary)
        if len(self.words.keys) > WORDS:
            self.before, self.words = self.words, _Words()
        at = self.words.find(keys)
        if (at < 0).any():
            self._learn_words(coded.dictionary.filter(pa.array(at < 0)), keys[at < 0])
            at = self.words.find(keys)
        self.cache.turn()
        word = at[coded.indices.to_numpy()]
        ids = self.words.ids(word).tobytes()
        stops = 4 * np.append(0, np.cumsum(self.words.size[word]))[begins]
        for i, j in zip(stops[:-1].tolist(), stops[1:].tolist()):
            yield ids[i:j]

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text; null is empty."""
        texts = texts.fill_null("")
        held = texts.buffers()[2] if self.special is not None else None
        raw = held.to_pybytes() if held else b""
        if not any(t.encode() in raw for t in self.special_ids):
            yield from self._encode_ordinary(texts)
            return
        parts = [self.special.split(t) for t in texts.to_pylist()]  # every other one is a special token
        ordinary = self._encode_ordinary(pa.array([p for x in parts for p in x[::2]], texts.type))
        for x in parts:
            yield b"".join(self.special_ids[p] if i & 1 else next(ordinary) for i, p in enumerate(x))

    def _encode_ordinary(self, texts: pa.Array) -> Iterator[bytes]:
        size = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(texts):
            stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + 2 * TOGETHER, "right")))
            yield from self._encode_words(texts.slice(at, stop - at))
            at = stop


def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The batches joined to about TOGETHER bytes: fewer distinct words in all."""
    held: list[pa.RecordBatch] = []
    for b in batches:
        held.append(b)
        if sum(x.nbytes for x in held) >= TOGETHER:
            yield from pa.Table.from_batches(held).combine_chunks().to_batches()
            held = []
    if held:
        yield from pa.Table.from_batches(held).combine_chunks().to_batches()


_encoders: dict[tuple[str, str, bool], Encoder] = {}


def encoder(path: str, segments: re.Pattern, special: bool = False) -> Encoder:
    """The encoder of a vocabulary file, one for each Python worker. With ``special`` the file's special tokens in a text are found, as the library
    does unless told otherwise; without, they are ordinary text."""
    os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core
    key = (path, segments.pattern, special)
    if key not in _encoders:
        _encoders[key] = Encoder(path, segments, special)
    return _encoders[key]
