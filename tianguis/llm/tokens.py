"""Token ids of whole texts by a published tokenizer file, with a bounded store of text units.

A batch's texts are cut into units at places that no match of the tokenizers' patterns
crosses, whatever stands around them.  So a unit's ids do not depend on its neighbours: each
distinct unit is encoded once for each worker process (as long as the store remembers it),
and a text's ids are gathered from the store.  Cutting, finding the distinct units and
gathering run over whole batches in Arrow and numpy.

The strings of a file's added tokens (such as an end mark) are found in texts as the library
finds them: each is one unit, with the id of that token.
"""

from __future__ import annotations

import os
import re
from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Units that a worker process remembers before it begins anew.
STORE_UNITS = 300_000
#: Texts are cut into units together up to so many bytes (a longer text by itself).
SLICE_BYTES = 2 << 20
#: Units that the library encodes as one text.
JOINED = 256

Ids = tuple[np.ndarray, np.ndarray]  # all ids, and how many each item has


def _byte_class(chars: str) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars.encode("latin-1"))] = True
    return out


_SPACE = _byte_class(" \t\n\r\x0b\x0c")
_ANY_SPACE = _byte_class(" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f")
_WORD = _byte_class("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789")
#: ASCII marks but the apostrophe, which some patterns join to the letters behind it.
_MARK = _byte_class('!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')
_LEADS = _byte_class("\xc2\xe1\xe2\xe3")
#: The bytes of white space beyond ASCII, as numbers of three bytes.
_WIDE_SPACE = [int.from_bytes(chr(c).encode().ljust(3, b"\0"), "big") for c in (0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]


def _marks_apart(data: np.ndarray, cut: np.ndarray) -> None:
    """Cuts between an ASCII letter or digit and an ASCII mark: every pattern ends a match there, and nothing composes across it."""
    word, mark = _WORD[data], _MARK[data]
    cut[1:] |= (word[:-1] & mark[1:]) | (mark[:-1] & word[1:])


def spaced_cuts(data: np.ndarray) -> np.ndarray:
    """Cuts for patterns that keep white space: before a lone space or line break, so that a unit begins with it.

    In longer runs of white space a match may take all but the last character; they are not cut.
    """
    space = _ANY_SPACE[data]
    at = np.nonzero(_LEADS[data])[0]
    if len(at):
        far = np.append(data, np.zeros(2, np.uint8)).astype(np.int32)
        two = far[at] == 0xC2
        wide = np.isin(far[at] << 16 | far[at + 1] << 8 | np.where(two, 0, far[at + 2]), _WIDE_SPACE)
        for k in (0, 1):
            space[at[wide] + k] = True
        space[at[wide & ~two] + 2] = True
    cut = np.zeros(len(data), bool)
    cut[1:-1] = ((data[1:-1] == 32) | (data[1:-1] == 10)) & ~space[:-2] & ~space[2:]
    _marks_apart(data, cut)
    return cut


def bare_cuts(data: np.ndarray) -> np.ndarray:
    """Cuts for patterns that drop white space: where ASCII white space begins and where it ends."""
    space = _SPACE[data]
    cut = np.zeros(len(data), bool)
    cut[1:] = space[1:] != space[:-1]
    _marks_apart(data, cut)
    return cut


def gather(values: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """``counts[i]`` values from ``first[i]`` on, for all i, one run after another."""
    ends = np.cumsum(counts, dtype=np.int64)
    total = int(ends[-1]) if len(ends) else 0
    at = np.repeat(first - (ends - counts), counts)
    at += np.arange(total)
    return values[at]


class Store:
    """Keys to runs of ids: what is missing is made by ``make``; begins anew when ``limit`` keys are held."""

    def __init__(self, make: Callable[[list], Ids], limit: int = STORE_UNITS):
        self.make, self.limit = make, limit
        self._forget()

    def _forget(self) -> None:
        self.place: dict = {}
        self.ids, self.first, self.counts = np.empty(0, np.uint32), np.empty(0, np.int64), np.empty(0, np.int64)

    def places(self, keys: list) -> np.ndarray:
        """The place of each of some distinct keys; good until the next call."""
        if len(self.place) > self.limit:
            self._forget()
        found = list(map(self.place.get, keys))
        if None in found:
            missing = [k for k, p in zip(keys, found) if p is None]
            ids, counts = self.make(missing)
            self.place.update(zip(missing, range(len(self.counts), len(self.counts) + len(missing))))
            self.first = np.concatenate([self.first, len(self.ids) + np.cumsum(counts) - counts])
            self.counts, self.ids = np.concatenate([self.counts, counts]), np.concatenate([self.ids, ids])
            found = list(map(self.place.get, keys))
        return np.array(found, np.int64)

    def gathered(self, places: np.ndarray) -> Ids:
        counts = self.counts[places]
        return gather(self.ids, self.first[places], counts), counts


class Coder:
    """Ids of texts: ``cuts`` marks where units begin, ``encode_units`` encodes distinct units.

    ``whole`` are strings that are units by themselves wherever they stand.
    """

    def __init__(self, encode_units: Callable[[list[str]], Ids], cuts: Callable[[np.ndarray], np.ndarray], limit: int = STORE_UNITS, whole: tuple[str, ...] = ()):
        self.cuts, self.store = cuts, Store(encode_units, limit)
        # the longest first, as one may begin like another
        self.whole = re.compile(b"|".join(re.escape(w.encode()) for w in sorted(whole, key=len, reverse=True))) if whole else None
        self.size = 0  # of the vocabulary, where known

    def encode(self, texts: pa.Array) -> Ids:
        """All ids of an array of strings, and how many each text has; null texts are empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        if not len(texts) or not texts.buffers()[2]:
            return np.empty(0, np.uint32), np.zeros(len(texts), np.int64)
        offsets = np.frombuffer(texts.buffers()[1], np.int32)[texts.offset : texts.offset + len(texts) + 1]
        data = np.frombuffer(texts.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        starts = offsets - offsets[0]
        parts, i = [], 0
        while i < len(texts):
            k = max(i + 1, int(np.searchsorted(starts, starts[i] + SLICE_BYTES, side="right")) - 1)
            parts.append(self._encode(data[starts[i] : starts[k]], starts[i : k + 1] - starts[i]))
            i = k
        ids, counts = zip(*parts)
        return np.concatenate(ids), np.concatenate(counts)

    def _encode(self, data: np.ndarray, starts: np.ndarray) -> Ids:
        if not len(data):
            return np.empty(0, np.uint32), np.zeros(len(starts) - 1, np.int64)
        cut = self.cuts(data)
        cut[starts[starts < len(data)]] = True
        if self.whole:
            for first, last in zip(starts, starts[1:]):
                for found in self.whole.finditer(data, first, last):
                    cut[found.start() + 1 : found.end()] = False
                    cut[found.start()] = True
                    if found.end() < len(data):
                        cut[found.end()] = True
        at = np.nonzero(cut)[0].astype(np.int32)
        units = pa.Array.from_buffers(pa.string(), len(at), [None, pa.py_buffer(np.append(at, np.int32(len(data)))), pa.py_buffer(data)]).dictionary_encode()
        places = self.store.places(units.dictionary.to_numpy(zero_copy_only=False).tolist())[units.indices.to_numpy()]
        ids, counts = self.store.gathered(places)
        ends = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(ends[np.searchsorted(at, starts)])


def with_end(ids: np.ndarray, counts: np.ndarray, end_id: int) -> Ids:
    """The same with ``end_id`` after each item's ids."""
    return np.insert(ids, np.cumsum(counts), end_id), counts + 1


def binary_array(ids: np.ndarray, counts: np.ndarray) -> pa.Array:
    """Runs of ids as an Arrow array of binaries, without a Python object for each."""
    offsets = np.concatenate([[0], np.cumsum(counts)]) * ids.itemsize
    return pa.Array.from_buffers(pa.binary(), len(counts), [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(ids))])


def flat_ids(lists: list[list[int]]) -> Ids:
    counts = np.fromiter(map(len, lists), np.int64, len(lists))
    return np.fromiter((k for ids in lists for k in ids), np.uint32, int(counts.sum())), counts


def _library_units(tok, keeps_space: bool) -> Callable[[list[str]], Ids]:
    """Encodes units by the library, many of them as one text where their ids can be told apart again.

    Units that begin with white space have one token each that does, words one token each that
    ends a word.  Each unit has at least one such token, so if a joined text has as many of
    them as units, they part its ids exactly; else its units are encoded one by one.
    """
    vocabulary = tok.get_vocab()
    marks = np.zeros(max(vocabulary.values()) + 1, bool)
    # the byte-level alphabet writes a space and a line break so
    marks[[k for t, k in vocabulary.items() if (t[:1] in ("Ġ", "Ċ") if keeps_space else t.endswith("</w>"))]] = True

    def encode(texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

    def units_of(units: list[str]) -> Ids:
        likely = [u[:1] in (" ", "\n") for u in units] if keeps_space else [u.isalpha() for u in units]
        counts, parts = np.zeros(len(units), np.int64), []
        joined, single = [i for i, yes in enumerate(likely) if yes], [i for i, yes in enumerate(likely) if not yes]
        groups = [joined[i : i + JOINED] for i in range(0, len(joined), JOINED)]
        order: list[int] = []
        for group, ids in zip(groups, encode([("" if keeps_space else " ").join([units[i] for i in g]) for g in groups])):
            ids = np.array(ids, np.uint32)
            at = np.nonzero(marks[ids])[0]
            if len(at) != len(group):
                single += group
                continue
            counts[group] = np.diff(np.append(at, len(ids))) if keeps_space else np.diff(np.append(-1, at))
            parts.append(ids)
            order += group
        ids, counts[single] = flat_ids(encode([units[i] for i in single]))
        parts.append(ids)
        order += single
        # back into the order of the units
        made = np.concatenate(parts)
        first = np.empty(len(units), np.int64)
        first[order] = np.cumsum(counts[order]) - counts[order]
        return gather(made, first, counts), counts

    return units_of


_CODERS: dict[str, Coder] = {}


def library_coder(path: str) -> Coder:
    """The coder of a file of the tokenizers library; one for each worker process and file."""
    if path not in _CODERS:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tok = Tokenizer.from_file(path)
        keeps_space = tok.normalizer is None
        # the library looks for these first, in the text as it stands, and encodes what lies between them by itself
        added = tok.get_added_tokens_decoder().values()
        if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added):
            raise ValueError(f"{path}: added tokens that depend on what stands around them")
        coder = Coder(_library_units(tok, keeps_space), spaced_cuts if keeps_space else bare_cuts, whole=tuple(t.content for t in added))
        coder.size = tok.get_vocab_size()
        _CODERS[path] = coder
    return _CODERS[path]
