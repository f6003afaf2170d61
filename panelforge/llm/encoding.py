"""Whole-text encoding with the ``tokenizers`` library, each distinct word piece encoded once.

Both public vocabularies used here split a text into words before they look for tokens, so a text
may be cut where no word can reach across, and each distinct piece need go to the tokenizer only
once for each Python worker. Cuts are made

* before a run of white space that follows a non-space character (and, for vocabularies that drop
  white space, behind it as well),
* between a letter and one of the marks ``MARKS`` behind it,
* with ``specials``, around the strings of the file's added tokens and nowhere in them.

Pieces are looked up in a bounded cache; the ids are gathered with numpy. The result equals
encoding the whole text (tested on whole tables).
"""

from __future__ import annotations

import os
import re
from itertools import repeat

import numpy as np
import pyarrow as pa

from panelforge.llm.textops import SPACE, own_cache, pieces, tidy

MARKS = np.zeros(256, bool)
MARKS[list(b'.,;:!?|*#$%&"()')] = True
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = True
UPPER = np.zeros(256, bool)
UPPER[65:91] = True
#: Pieces that a worker remembers (about 180 bytes each). Beyond them it forgets those used once since
#: the last time, and at least half.
REMEMBERED = 600_000
#: Pieces handed to the tokenizer at once; its result objects hold about a kilobyte each.
AT_ONCE = 8192
#: Pieces that are handed over as one text, an added token between them.
JOINED = 1024
#: Batches after which a worker gives freed memory back.
BATCHES = 2

_workers: dict[tuple, Encoder] = {}
own_cache("encoders", _workers.clear)


class Encoder:
    """``lower``: the vocabulary ignores case and drops white space. ``specials``: strings of the
    file's added tokens get their ids, as in the library's default; else they are ordinary text."""

    #: Pattern of the added tokens' strings, if texts are searched for them.
    added: re.Pattern | None = None
    #: The string and id of the added token that pieces are joined by, if there is one.
    joint: tuple[str, int] | None = None
    #: Batches so far.
    batches = 0
    #: The table of this worker that holds it.
    cache = "encoders"

    def __init__(self, path: str, lower: bool = False, spans: bool = False, specials: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one worker on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = not specials
        if specials:
            added = list(self.tokenizer.get_added_tokens_decoder().values())
            if any(t.normalized or t.lstrip or t.rstrip or t.single_word for t in added):
                raise ValueError(f"{path}: added tokens that look at their surroundings are not supported")
            if added:  # the longest first, as the library matches them
                strings = sorted((t.content.encode() for t in added), key=len, reverse=True)
                self.added = re.compile(b"|".join(map(re.escape, strings)))
                self.joint = self._joint([s.decode() for s in strings])
        self.lower, self.spans = lower, spans
        self._clear()

    def _joint(self, strings: list[str]) -> tuple[str, int] | None:
        """The longest added string, if no added string can begin in a piece and end in it."""
        longest = strings[0]
        if any(s.endswith(longest[:k]) for s in strings for k in range(1, len(longest))):
            return None
        self.own = frozenset(strings)
        return longest, self.tokenizer.token_to_id(longest)

    def _clear(self) -> None:
        self.known: dict[str, int] = {}
        self.size = np.zeros(1 << 12, np.int64)
        self.first = np.zeros(1 << 12, np.int64)
        self.uses = np.zeros(1 << 12, np.int32)
        self.used = 0
        self.flat = [np.zeros(1 << 14, np.int32) for _ in range(3 if self.spans else 1)]

    def _solve(self, new: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
        """(number of ids of each piece, [all ids, and with ``spans`` their begins and ends])."""
        encode = self.tokenizer.encode_batch if self.spans else self.tokenizer.encode_batch_fast
        sizes, columns = [], []
        for at in range(0, len(new), AT_ONCE):
            some = new[at : at + AT_ONCE]
            if self.joint and not self.spans and self.own.isdisjoint(some):
                size, ids = self._solve_joined(some)
                sizes.append(size)
                columns.append([ids])
                continue
            found = encode(some, add_special_tokens=False)
            ids = [e.ids for e in found]
            sizes.append(np.array([len(v) for v in ids], np.int64))
            own = [np.array([x for v in ids for x in v], np.int64)]
            if self.spans:
                spans = np.array([s for e in found for s in e.offsets], np.int64).reshape(-1, 2)
                own += [spans[:, 0], spans[:, 1]]
            columns.append(own)
        return np.concatenate(sizes), [np.concatenate(c) for c in zip(*columns)]

    def _solve_joined(self, new: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(number of ids of each piece, all ids): as the added token cuts a text before it is encoded, its
        ids tell the pieces apart, and one result object holds many of them."""
        string, mark = self.joint
        texts = [string.join(new[at : at + JOINED]) + string for at in range(0, len(new), JOINED)]
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ids = np.concatenate([np.array(e.ids, np.int64) for e in found])
        ends = np.flatnonzero(ids == mark)
        if len(ends) != len(new):
            raise ValueError(f"{len(new)} pieces came back from the tokenizer as {len(ends)}")
        return np.diff(ends, prepend=-1) - 1, ids[ids != mark]

    def _store(self, new: list[str], sizes: np.ndarray, columns: list[np.ndarray]) -> None:
        at, total = len(self.known), self.used + len(columns[0])
        while len(self.size) < at + len(new):
            self.size, self.first, self.uses = (np.concatenate([v, np.zeros_like(v)]) for v in (self.size, self.first, self.uses))
        self.size[at : at + len(new)] = sizes
        self.first[at : at + len(new)] = self.used + np.cumsum(sizes) - sizes
        for i, column in enumerate(columns):
            while len(self.flat[i]) < total:
                self.flat[i] = np.concatenate([self.flat[i], np.zeros_like(self.flat[i])])
            self.flat[i][self.used : total] = column
        self.used = total
        self.known.update(zip(new, range(at, at + len(new))))

    def _forget(self) -> None:
        """Keep the pieces that were used in two batches or more since the last time; half of the room
        at most, those of most batches."""
        uses = self.uses[: len(self.known)]
        keep = np.flatnonzero(uses > 1)
        if len(keep) > REMEMBERED // 2:
            keep = np.sort(np.argpartition(uses, -(REMEMBERED // 2))[-(REMEMBERED // 2) :])
        if not len(keep):
            return self._clear()
        names, size = list(self.known), self.size[keep]
        last = np.cumsum(size)
        at = np.repeat(self.first[keep] - last + size, size) + np.arange(last[-1])
        kept = [names[i] for i in keep.tolist()], size, [flat[at] for flat in self.flat]
        self._clear()
        self._store(*kept)

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Starts of the pieces."""
        space = SPACE[data]
        cut = np.zeros(len(data), bool)
        at = np.flatnonzero(space[1:] & ~space[:-1]) + 1
        wide = data[at - 1] >= 0x80
        if wide.any():  # the character before may be a wide space
            w = at[wide]
            b1, b2 = data[w - 1], data[w - 2]
            b3 = np.where(w >= 3, data[w - 3], 0)
            blank = (b2 == 0xC2) & ((b1 == 0x85) | (b1 == 0xA0))
            blank |= (b3 == 0xE1) & (b2 == 0x9A) & (b1 == 0x80) | (b3 == 0xE3) & (b2 == 0x80) & (b1 == 0x80)
            blank |= (b3 == 0xE2) & ((b2 == 0x80) & ((b1 <= 0x8A) | (b1 == 0xA8) | (b1 == 0xA9) | (b1 == 0xAF)) | (b2 == 0x81) & (b1 == 0x9F))
            at = np.concatenate([at[~wide], w[~blank]])
        cut[at] = True
        if self.lower:
            cut[1:] |= space[:-1] & ~space[1:]
        at = np.flatnonzero(MARKS[data[1:]]) + 1
        before = data[at - 1]
        letter = LETTER[before]
        latin = (before >= 0x80) & (at >= 2) & (data[at - 2] == 0xC3) & (before != 0x97) & (before != 0xB7)
        cut[at[letter | latin]] = True
        begin = offsets[:-1]
        cut[begin[begin < len(data)]] = True
        return np.flatnonzero(cut)

    def _marked(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """(begin, end) of the added tokens' strings in the texts."""
        if self.added is None:
            return np.zeros((0, 2), np.int64)
        raw = np.ascontiguousarray(data).tobytes()
        if not self.added.search(raw):
            return np.zeros((0, 2), np.int64)
        found = [m.span() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()) for m in self.added.finditer(raw, a, b)]
        return np.array(found, np.int64).reshape(-1, 2)

    def _around(self, marked: np.ndarray, starts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """``starts`` with cuts at both ends of the marked strings and none in them."""
        if not len(marked):
            return starts
        at = np.searchsorted(marked[:, 0], starts, "right") - 1
        inside = (at >= 0) & (starts > marked[at, 0]) & (starts < marked[at, 1])
        out = np.union1d(starts[~inside], marked)
        return out[out < offsets[-1]]

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
        """([ids], first id of each text and the end); with ``spans`` also the ids' character spans."""
        if not len(data):
            return [np.zeros(0, np.int64) for _ in self.flat], np.zeros(len(offsets), np.int64)
        marked = self._marked(data, offsets)
        if self.lower:
            after = np.append(data[1:], 0)
            plain = UPPER[data] & ((after < 0x80) | (after == 0xC2) | (after == 0xC3))
            data = np.where(plain, data + 32, data).astype(np.uint8)
        starts = self._around(marked, self._cuts(data, offsets), offsets)
        body, bounds = data, np.append(starts, len(data))
        if self.lower and not self.spans:  # white space has no ids: its pieces and bytes go
            solid = ~SPACE[data]
            starts = starts[solid[starts]]
            head = np.append(0, np.cumsum(solid))
            body, bounds = data[solid], head[np.append(starts, len(data))]
        if not len(starts):
            return [np.zeros(0, np.int64) for _ in self.flat], np.zeros(len(offsets), np.int64)
        chunk = pa.Array.from_buffers(pa.string(), len(starts), [None, pa.py_buffer(bounds.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(body))])
        chunk = chunk.dictionary_encode()
        names = chunk.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.known) + len(names) > REMEMBERED:
            self._forget()
        known = np.fromiter(map(self.known.get, names, repeat(-1)), np.int64, len(names))
        new = np.flatnonzero(known < 0)
        if len(new):
            known[new] = np.arange(len(self.known), len(self.known) + len(new))
            fresh = [names[i] for i in new.tolist()]
            self._store(fresh, *self._solve(fresh))
        self.uses[known] += 1
        word = known[chunk.indices.to_numpy()]
        size = self.size[word]
        last = np.cumsum(size)
        at = np.repeat(self.first[word] - last + size, size) + np.arange(last[-1])
        out = [flat[at].astype(np.int64) for flat in self.flat]
        if self.spans:  # from places in the piece to places in the text
            head = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            text = np.searchsorted(offsets, starts, "right") - 1
            shift = np.repeat(head[starts] - head[offsets[text]], size)
            out[1], out[2] = out[1] + shift, out[2] + shift
        return out, np.concatenate([[0], last])[np.searchsorted(starts, offsets)]

    def texts(self, column: pa.Array, max_bytes: int = 2 << 20):
        """For each text of the column, its arrays (ids, and spans if asked for). Null counts as empty."""
        if self.batches % BATCHES == 0:
            tidy(self.cache)  # of the batches before
        self.batches += 1
        for _, _, data, offsets in pieces(column, max_bytes):
            found, first = self.encode(data, offsets)
            for i in range(len(offsets) - 1):
                yield [v[first[i] : first[i + 1]] for v in found]


def encoder(path: str, lower: bool = False, spans: bool = False) -> Encoder:
    """This Python worker's encoder for a vocabulary file (loaded and filled once): ids are those of
    the library's ``encode`` of whole texts with ``add_special_tokens=False``."""
    key = (path, lower, spans)
    if key not in _workers:
        _workers[key] = Encoder(path, lower, spans, specials=True)
    return _workers[key]
