"""Byte-level BPE encoding and decoding by DuckDB inside Spark tasks.

Spark partitions the texts; in a task, a DuckDB connection holds the merge table (every pair
of tokens whose joined bytes are a token, with its rank).  The bytes of the words that are
not tokens themselves become rows (word, position, token); a recursive query joins
neighbours to the merge table and contracts each word's leftmost pair of least rank, until
no pair is left.  Decoding joins ids to their bytes and aggregates them in order.

Only distinct words are encoded, see ``tokens``.  Before that, words are cut between bytes
that are neighbours in no token: no merge can cross such a place.

Parts that are still long are encoded in pieces, and the seams between pieces are proved.
Tokens t1..tn are the encoding of their joined bytes if each two neighbours are the encoding
of theirs: until a first merge crosses a place between ti and ti+1, both sides contract as
they do by themselves, in the same order (a region's next merge is its own leftmost pair of
least rank, whatever happens elsewhere); so that merge would be made in the encoding of the
two alone, which has none there.  Where a seam's neighbours fail this, the tokens around it
are encoded anew together, ever more of them, until all neighbours pass.
"""

from __future__ import annotations

import base64
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tokens import Coder, Ids, binary_array, flat_ids, gather, spaced_cuts

#: Ids that one query decodes, about.
DECODE_IDS = 250_000
#: Sum of squared lengths of the words in one recursive query: a bound of the rows that its rounds make.
QUERY_ROWS = 3_000_000
#: Bytes of a part that is encoded whole, and of the pieces of a longer one.
LONG_WORD, PIECE = 256, 48
#: Windows around a seam that have grown to so many bytes go by the keyed query.
KEYED_WORD = 2048
_MEMORY = "150MB"
#: Less is remembered than elsewhere: DuckDB needs room, too.
STORE_UNITS = 450_000

# All rows of every round stay in the recursion's result; the last round of a word counts.
_SHORT = """
with recursive s(round, w, p, t) as (
  select 0, w, p, t from words
  union all
  (with z as (select *, lead(t) over next as n, lead(p) over next as np from s window next as (partition by w order by p)),
   hit as (select w, min(r::bigint * 1048576 + p) as least, arg_min(np, r::bigint * 1048576 + p) as gone
           from z join merges on a = t and b = n group by w)
   select round + 1, s.w, p, case when p = least % 1048576 then (least // 1048576)::int else t end
   from s join hit using (w) where p <> gone)
)
select s.w, t from s join (select w, max(round) as round from s group by w) using (w, round) order by s.w, p
"""

# Long windows: one row for each position, changed in place.  In a round all pairs of the least
# rank are contracted from the left, unless the new token could take part in a pair of a lower
# or equal rank (solo): then the leftmost alone.
_LONG = """
with recursive s(w, p, t) using key (w, p) as (
  select w, p, t from words
  union
  (with z as (select w, p, t, lead(t) over next as n, lead(p) over next as np, row_number() over next as i
              from recurring.s where t >= 0 window next as (partition by w order by p)),
   pair as (select z.w, p, np, i, r, solo, min(r) over (partition by z.w) as least from z join merges on a = t and b = n),
   run as (select *, i - row_number() over by_place as run, row_number() over by_place as place
           from pair where r = least window by_place as (partition by w order by i)),
   hit as (select * from (select *, row_number() over (partition by w, run order by i) as turn from run)
           where case when solo then place = 1 else turn % 2 = 1 end)
  select w, p, r from hit union all select w, np, -1 from hit)
)
select w, t from s where t >= 0 order by w, p
"""

_DECODE = "select d, string_agg(bytes, '' order by p) as text from ids join vocabulary using (t) group by d"


class Bpe:
    """A vocabulary of ranks in a DuckDB connection."""

    def __init__(self, path: str, pattern: str):
        import duckdb
        import regex

        self.pattern = regex.compile(pattern)
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.tokens = {r: token for token, r in self.ranks.items()}
        self.of_byte = np.array([self.ranks.get(bytes([i]), -1) for i in range(256)], np.int32)
        rows = [(x, y, r) for token, r in self.ranks.items() for i in range(1, len(token)) if (x := self.ranks.get(token[:i])) is not None and (y := self.ranks.get(token[i:])) is not None]
        a, b, r = (np.array(c, np.int32) for c in zip(*rows)) if rows else (np.empty(0, np.int32),) * 3
        solo = np.isin(r, np.concatenate([a[r <= a], b[r <= b]]))
        pairs = np.zeros(1 << 16, bool)
        for token in self.ranks:
            v = np.frombuffer(token, np.uint8).astype(np.int64)
            pairs[v[:-1] * 256 + v[1:]] = True
        self.joins = pairs
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": _MEMORY, "temp_directory": tempfile.gettempdir()})
        self.db.register("m", pa.table({"a": a, "b": b, "r": r, "solo": solo}))
        self.db.execute("create table merges as select * from m")
        # bytes as the characters of the same numbers
        self.db.register("v", pa.table({"t": pa.array(list(self.ranks.values()), pa.int32()), "bytes": [k.decode("latin-1") for k in self.ranks]}))
        self.db.execute("create table vocabulary as select * from v")

    def _contract(self, w: np.ndarray, p: np.ndarray, data: np.ndarray, query: str) -> tuple[np.ndarray, np.ndarray]:
        """Words and tokens, in order, from the bytes ``data`` at places ``p`` of words ``w``."""
        self.db.register("words", pa.table({"w": w.astype(np.int32), "p": p.astype(np.int32), "t": self.of_byte[data]}))
        out = self.db.execute(query).fetchnumpy()
        return np.asarray(out["w"]), np.asarray(out["t"])

    def _encode_parts(self, data: np.ndarray, starts: np.ndarray) -> Ids:
        """Ids of each part of ``data``; each must be short or else a window around a seam."""
        lengths = np.diff(np.append(starts, len(data)))
        part = np.repeat(np.arange(len(starts)), lengths)
        place = np.arange(len(data)) - starts[part]
        keyed = lengths > KEYED_WORD
        # short ones go together; each long one goes by itself
        group = np.where(keyed, -1, np.cumsum(np.where(keyed, 0, lengths**2)) // QUERY_ROWS)
        jobs = [(group[part] == g, _SHORT) for g in np.unique(group[group >= 0])] + [(part == i, _LONG) for i in np.nonzero(keyed)[0]]
        made = [self._contract(part[take], place[take], data[take], query) for take, query in jobs]
        of_part, ids = (np.concatenate(c) for c in zip(*made))
        if keyed.any():
            order = np.argsort(of_part, kind="stable")
            of_part, ids = of_part[order], ids[order]
        return ids.astype(np.uint32), np.bincount(of_part, minlength=len(starts))

    def _encode_list(self, words: list[bytes]) -> list[list[int]]:
        if not words:
            return []
        sizes = np.array([len(w) for w in words], np.int64)
        ids, counts = self._encode_parts(np.frombuffer(b"".join(words), np.uint8), np.cumsum(sizes) - sizes)
        return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])]

    def _encode_long(self, word: bytes) -> list[int]:
        """Ids of a long part: pieces, then windows around the seams that fail."""
        runs = self._encode_list([word[i : i + PIECE] for i in range(0, len(word), PIECE)])
        reach, proved = 4, {}
        while True:
            seams = [(a[-1], b[0]) for a, b in zip(runs, runs[1:])]
            new = list({p for p in seams if p not in proved})
            made = self._encode_list([self.tokens[a] + self.tokens[b] for a, b in new])
            proved.update((p, list(p) == ids) for p, ids in zip(new, made))
            bad = [i for i, p in enumerate(seams) if not proved[p]]
            if not bad:
                return [k for run in runs for k in run]
            # windows of ``reach`` tokens on both sides; those that touch become one
            ends = np.cumsum([len(run) for run in runs])
            flat = [k for run in runs for k in run]
            windows: list[list[int]] = []
            for i in bad:
                low, high = max(0, int(ends[i]) - reach), min(len(flat), int(ends[i]) + reach)
                if windows and low <= windows[-1][1]:
                    windows[-1][1] = high
                else:
                    windows.append([low, high])
            again = self._encode_list([b"".join(self.tokens[k] for k in flat[low:high]) for low, high in windows])
            # what lies between windows keeps its own seams: they were proved or are windows' edges now
            out, at = [], 0
            for (low, high), ids in zip(windows, again):
                out += [flat[at:low], ids]
                at = high
            runs, reach = [run for run in [*out, flat[at:]] if run], reach * 2

    def encode_words(self, words: list[bytes]) -> Ids:
        """Ids of each word; a word that is a token is that token."""
        known = np.array([self.ranks.get(x, -1) for x in words], np.int64)
        open_words = [i for i in np.nonzero(known < 0)[0].tolist() if words[i]]
        counts = (known >= 0).astype(np.int64)
        ids = known[known >= 0].astype(np.uint32)
        if not open_words:
            return ids, counts
        data = np.frombuffer(b"".join(words[i] for i in open_words), np.uint8)
        sizes = np.array([len(words[i]) for i in open_words], np.int64)
        first = np.zeros(len(data), bool)
        first[np.cumsum(sizes) - sizes] = True
        # a part begins where a word does, and between bytes that are neighbours in no token
        cut = first.copy()
        cut[1:] |= ~self.joins[data[:-1].astype(np.int64) * 256 + data[1:]]
        starts = np.nonzero(cut)[0]
        lengths = np.diff(np.append(starts, len(data)))
        word_of_part = np.cumsum(first)[starts] - 1
        long = lengths > LONG_WORD
        parts = np.zeros(len(starts), np.int64)
        small = np.repeat(~long, lengths)
        runs = []
        if (~long).any():
            made, parts[~long] = self._encode_parts(data[small], np.cumsum(lengths[~long]) - lengths[~long])
            runs.append(made)
        if long.any():
            made, parts[long] = flat_ids([self._encode_long(data[a : a + n].tobytes()) for a, n in zip(starts[long], lengths[long])])
            runs.append(made)
            order = np.concatenate([np.nonzero(~long)[0], np.nonzero(long)[0]])
            at = np.empty(len(parts), np.int64)
            at[order] = np.cumsum(parts[order]) - parts[order]
            runs = [gather(np.concatenate(runs), at, parts)]
        counts[open_words] = np.bincount(word_of_part, parts, len(open_words)).astype(np.int64)
        out = np.empty(int(counts.sum()), np.uint32)
        is_token = np.repeat(known >= 0, counts)
        out[is_token], out[~is_token] = ids, runs[0]
        return out, counts

    def encode_units(self, units: list[str]) -> Ids:
        """Ids of each text unit: the pattern's matches, encoded each by itself."""
        matches = [self.pattern.findall(u) for u in units]
        flat = [m for ms in matches for m in ms]
        distinct = {m: i for i, m in enumerate(dict.fromkeys(flat))}
        ids, counts = self.encode_words([m.encode("utf-8") for m in distinct])
        at = np.array([distinct[m] for m in flat], np.int64)
        first = np.cumsum(counts) - counts
        counts = counts[at]
        ids = gather(ids, first[at], counts)
        ends = np.concatenate([[0], np.cumsum(counts)])
        return ids, np.diff(ends[np.cumsum([0, *map(len, matches)])])

    def decode(self, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
        """The bytes of each run of ``counts`` ids."""
        runs = np.repeat(np.arange(len(counts), dtype=np.int32), counts)
        self.db.register("ids", pa.table({"d": runs, "p": np.arange(len(ids), dtype=np.int64), "t": ids.astype(np.int32)}))
        found = self.db.execute(_DECODE).fetchnumpy()
        out = [b""] * len(counts)
        for d, text in zip(found["d"].tolist(), found["text"]):
            out[d] = text.encode("latin-1")
        return out


_HELD: dict[tuple[str, str], tuple[Bpe, Coder]] = {}


def _held(path: str, pattern: str) -> tuple[Bpe, Coder]:
    """One vocabulary and store for each worker process."""
    if (path, pattern) not in _HELD:
        bpe = Bpe(path, pattern)
        _HELD[path, pattern] = bpe, Coder(bpe.encode_units, spaced_cuts, STORE_UNITS)
    return _HELD[path, pattern]


def encode(text: Column, path: str, pattern: str) -> Column:
    """Ids of whole texts as little-endian unsigned 32-bit integers (binary).

    ``path`` is a file of base64 tokens and ranks, ``pattern`` splits texts into words and must
    end a match at white space and between a letter and a mark; no string is a special
    token.  Null and empty texts give an empty binary.  Equal texts give equal ids.  Every
    single byte must be a token.
    """

    @F.arrow_udf(T.BinaryType())
    def encoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        coder = _held(path, pattern)[1]
        for texts in batches:
            yield binary_array(*coder.encode(texts))

    return encoded(text)


def _decoded(bpe: Bpe, ids: np.ndarray, counts: np.ndarray) -> list[bytes]:
    """The bytes of each run of ids, in blocks of at most DECODE_IDS ids; a longer run is decoded piece by piece and joined."""
    pieces = np.maximum(-(-counts // DECODE_IDS), 1)
    first = np.concatenate([[0], np.cumsum(pieces)])
    sizes = np.full(first[-1], DECODE_IDS, np.int64)
    sizes[first[1:] - 1] = counts - (pieces - 1) * DECODE_IDS
    out: list[bytes] = []
    ends = np.cumsum(sizes)
    i = 0
    while i < len(sizes):
        start = ends[i] - sizes[i]
        k = max(i + 1, int(np.searchsorted(ends, start + DECODE_IDS, side="right")))
        out += bpe.decode(ids[start : ends[k - 1]], sizes[i:k])
        i = k
    return [out[a] if b == a + 1 else b"".join(out[a:b]) for a, b in zip(first, first[1:])]


def decode(ids: Column, path: str, pattern: str) -> Column:
    """The bytes (binary) that ids, as ``encode`` gives them, stand for.  Null gives an empty binary."""

    @F.arrow_udf(T.BinaryType())
    def decoded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe = _held(path, pattern)[0]
        for rows in batches:
            raw = [x or b"" for x in rows.to_pylist()]
            yield pa.array(_decoded(bpe, np.frombuffer(b"".join(raw), "<u4"), np.array([len(x) // 4 for x in raw], np.int64)), pa.binary())

    return decoded(ids)


def round_trip(text: Column, path: str, pattern: str) -> Column:
    """Struct of ``ids`` (as ``encode``) and ``decoded`` (``decode`` of those ids), by one worker of each task.

    Two columns of their own would hold two workers a task, each with a vocabulary.
    """
    schema = T.StructType([T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.BinaryType())])

    @F.arrow_udf(schema)
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        bpe, coder = _held(path, pattern)
        for texts in batches:
            ids, counts = coder.encode(texts)
            yield pa.StructArray.from_arrays([binary_array(ids, counts), pa.array(_decoded(bpe, ids, counts), pa.binary())], names=["ids", "decoded"])

    return both(text)
