"""SentencePiece encoding and decoding: Viterbi over a double-array trie of scored pieces.

The pieces and log scores come from a public model file. White space is the marker U+2581, one is
put before every non-empty text. A character that no piece covers alone may become an unknown
node, scored ten below the lowest piece, which falls back to the pieces of its UTF-8 bytes. The
best path maximises the exact sum of scores (double precision); on a tie the path whose last
piece starts earlier wins. Decoding maps markers to spaces, joins byte pieces to characters and
drops the first marker.

Where no piece of the vocabulary has a marker behind another character, a best path never crosses
from a word into the next marker, so a text is cut there (and beside line feeds that no piece
holds), each distinct chunk is solved once for each Python worker, and all new chunks of a batch
go through the trie and the Viterbi recursion side by side in numpy.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from panelforge.llm.encoding import Encoder
from panelforge.llm.tables import ship
from panelforge.llm.textops import CONTINUATION, own_cache

MARKER = "▁"
UNKNOWN_PENALTY = 10.0
#: Text that one Viterbi search takes, beyond a single longer chunk.
CHUNK_BYTES = 1 << 18


@dataclass(frozen=True)
class Vocabulary:
    """A double-array trie over piece bytes (the marker as a space) and the tables around it."""

    base: np.ndarray
    check: np.ndarray
    piece: np.ndarray  # id of the piece that ends at a node, or -1
    score: np.ndarray  # by id
    unknown_score: float
    byte_id: np.ndarray  # id of each byte's piece, or -1
    unknown_id: int
    surface: tuple[bytes, ...]  # what each id decodes to
    depth: int
    cut_words: bool
    cut_lines: bool


def double_array(entries: dict[bytes, int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(base, check, value): from node s, byte b leads to t = base[s] + b + 1 where check[t] == s."""
    children: dict[bytes, list[int]] = {b"": []}
    for word in entries:
        for i in range(len(word)):
            head = word[:i]
            if word[: i + 1] not in children:
                children[word[: i + 1]] = []
                children[head].append(word[i])
    size = 16 * len(children) + 65536
    base, check, value = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
    taken = bytearray(size)
    taken[0], at, far, level = 1, 1, 1, [(b"", 0)]
    while level:
        following = []
        for word, node in level:
            own = sorted(children[word])
            if not own:
                continue
            first, tries = (at if len(own) == 1 else far), 0
            while True:  # a free place where all children fit
                b = first - own[0] - 1
                if b >= 0 and not any([taken[b + c + 1] for c in own]):
                    break
                first, tries = first + 1, tries + 1
            if len(own) == 1:
                at = first
            elif tries > 64:  # the places before are too full to be searched again
                far = first
            base[node] = b
            for c in own:
                taken[b + c + 1] = 1
                check[b + c + 1] = node
                name = word + bytes([c])
                value[b + c + 1] = entries.get(name, -1)
                following.append((name, b + c + 1))
        level = following
    end = max(i for i in range(size) if taken[i]) + 258
    return base[:end].copy(), check[:end].copy(), value[:end].copy()


def load_vocabulary(path: str) -> Vocabulary:
    """The pieces of a SentencePiece model file, read with the public library."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    names = [model.id_to_piece(i) for i in range(model.get_piece_size())]
    entries, byte_id, surface, lowest = {}, np.full(256, -1, np.int64), [], 0.0
    score = np.array([model.get_score(i) for i in range(len(names))], np.float64)
    for i, name in enumerate(names):
        if model.is_byte(i):
            byte = int(name[1:-1], 16)
            byte_id[byte] = i
            surface.append(bytes([byte]))
        elif model.is_control(i) or model.is_unknown(i):
            surface.append(b"")
        else:
            raw = name.replace(MARKER, " ").encode()
            surface.append(raw)
            if not model.is_unused(i):
                entries[raw] = i
                lowest = min(lowest, score[i])
    base, check, piece = double_array(entries)
    normal = [e.decode() for e in entries]
    return Vocabulary(
        base, check, piece, score, lowest - UNKNOWN_PENALTY, byte_id, model.unk_id(), tuple(surface),
        max(map(len, entries)), not any(re.search(r"[^ ] ", e) for e in normal), not any("\n" in e for e in normal),
    )


def viterbi(v: Vocabulary, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, number of ids of each), for texts with spaces as markers."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    stop = np.cumsum(sizes)
    begin = stop - sizes
    n = len(data)
    owner = np.repeat(np.arange(len(texts)), sizes)
    heads = np.flatnonzero(~CONTINUATION[data])
    after = np.append(heads[1:], n)  # where the next character starts
    # all pieces at all characters: walk the trie from every character side by side
    found = []
    alone = np.zeros(n, bool)
    at, node, who = heads, np.zeros(len(heads), np.int64), np.arange(len(heads))
    for d in range(v.depth):
        live = at + d < stop[owner[at]]
        at, node, who = at[live], node[live], who[live]
        to = v.base[node] + data[at + d] + 1
        live = v.check[to] == node
        at, node, who = at[live], to[live], who[live]
        if not len(at):
            break
        ids = v.piece[node]
        has = ids >= 0
        found.append((at[has], at[has] + d + 1, ids[has]))
        alone[at[has & (after[who] == at + d + 1)]] = True
    lost = ~alone[heads]
    found.append((heads[lost], after[lost], np.full(int(lost.sum()), -1)))
    start, end, ids = (np.concatenate(x) for x in zip(*found))
    worth = np.where(ids >= 0, v.score[ids], v.unknown_score)
    # one step for each place in the texts, all texts at once; earlier starts come first and keep ties
    place = start - begin[owner[start]]
    order = np.argsort(place, kind="stable")
    start, end, ids, worth, place = start[order], end[order], ids[order], worth[order], place[order]
    shift = owner[start]  # a slot for the end of each text
    best = np.full(n + len(texts), -np.inf)
    back, used = np.zeros(n + len(texts), np.int64), np.full(n + len(texts), -1, np.int64)
    best[begin + np.arange(len(texts))] = 0.0
    start_slot, end_slot = start + shift, end + shift
    cuts = np.flatnonzero(np.diff(place, prepend=-1))
    for lo, hi in zip(cuts, np.append(cuts[1:], len(place))):
        score = best[start_slot[lo:hi]] + worth[lo:hi]
        better = np.flatnonzero(score > best[end_slot[lo:hi]])
        slot = end_slot[lo:hi][better]
        best[slot], back[slot], used[slot] = score[better], start_slot[lo:hi][better], ids[lo:hi][better]
    # follow all paths back together
    slot, home = stop + np.arange(len(texts)), begin + np.arange(len(texts))
    path, text = [], np.arange(len(texts))
    while True:
        open_ = slot > home
        slot, home, text = slot[open_], home[open_], text[open_]
        if not len(slot):
            break
        path.append((text, back[slot], used[slot], slot))
        slot = back[slot]
    if not path:
        return np.zeros(0, np.int64), np.zeros(len(texts), np.int64)
    text, first, ids, last = (np.concatenate(x) for x in zip(*path))
    order = np.argsort(first, kind="stable")
    text, first, ids, last = text[order], first[order], ids[order], last[order]
    counts = np.ones(len(ids), np.int64)
    unknown = np.flatnonzero(ids < 0)
    if len(unknown) and (v.byte_id >= 0).all():
        counts[unknown] = last[unknown] - first[unknown]
        marks = unknown[data[first[unknown] - text[unknown]] == 0x20]
        counts[marks] = 3
    out = np.repeat(ids, counts)
    ahead = np.cumsum(counts) - counts
    for i in unknown:  # the bytes of an unknown character
        if (v.byte_id >= 0).all():
            raw = data[first[i] - text[i] : last[i] - text[i]].tobytes().replace(b" ", MARKER.encode())
            out[ahead[i] : ahead[i] + counts[i]] = v.byte_id[np.frombuffer(raw, np.uint8)]
        else:
            out[ahead[i]] = v.unknown_id
    return out, np.bincount(text, weights=counts, minlength=len(texts)).astype(np.int64)


class UnigramEncoder(Encoder):
    """Whole texts to ids, each distinct chunk solved once."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary, self.lower, self.spans = vocabulary, False, False
        self._clear()

    cache = "unigrams"

    def _solve(self, new: list[str]):
        raw, ids, sizes, at = [w.encode() for w in new], [], [], 0
        while at < len(raw):  # the search holds some hundred bytes for each character
            end, room = at + 1, CHUNK_BYTES - len(raw[at])
            while end < len(raw) and room >= len(raw[end]):
                room -= len(raw[end])
                end += 1
            found, count = viterbi(self.vocabulary, raw[at:end])
            ids.append(found)
            sizes.append(count)
            at = end
        return np.concatenate(sizes), [np.concatenate(ids)]

    def _cuts(self, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        cut = np.zeros(len(data), bool)
        if self.vocabulary.cut_words:
            mark = data == 0x20
            cut[1:] = mark[1:] & ~mark[:-1]
        if self.vocabulary.cut_lines:
            line = data == 10
            cut |= line
            cut[1:] |= line[:-1]
        begin = offsets[:-1]
        cut[begin[begin < len(data)]] = True
        return np.flatnonzero(cut)

    def texts(self, column: pa.Array, max_bytes: int = 4 << 20):
        column = pc.replace_substring(pc.fill_null(column, ""), MARKER, " ")
        marked = pc.binary_join_element_wise(" ", column, "")
        yield from super().texts(pc.if_else(pc.equal(column, ""), "", marked), max_bytes)


_encoders: dict[str, UnigramEncoder] = {}
own_cache("unigrams", _encoders.clear)


def _encoder(shared) -> UnigramEncoder:
    if shared.id not in _encoders:
        _encoders.clear()
        _encoders[shared.id] = UnigramEncoder(shared.value)
    return _encoders[shared.id]


class _Shared:
    """A broadcast vocabulary (its size is that of the model file) with a key for the workers."""

    def __init__(self, spark, vocabulary):
        self._value = spark.sparkContext.broadcast(vocabulary)
        self.id = f"{spark.sparkContext.applicationId}-{self._value._jbroadcast.id()}"

    @property
    def value(self):
        return self._value.value


ENCODED = "struct<ids:binary,n_tokens:bigint,n_bytes:bigint>"


def encode_pieces(df: DataFrame, vocabulary: Vocabulary, text_col: str = "text", result_col: str = "pieces") -> DataFrame:
    """``df`` with a struct ``result_col``: ``ids`` (little-endian unsigned 32 bits), ``n_tokens``, and
    ``n_bytes``, the ids that are byte pieces. Null and empty texts have no ids. Texts of any length
    are encoded whole. Other columns pass through; one map over the rows, no shuffle."""
    spark = df.sparkSession
    ship(spark)
    shared = _Shared(spark, vocabulary)

    def encode(texts: pa.Array) -> pa.Array:
        tool = _encoder(shared)
        is_byte = np.zeros(len(tool.vocabulary.surface), bool)
        is_byte[tool.vocabulary.byte_id[tool.vocabulary.byte_id >= 0]] = True
        found = [ids for (ids,) in tool.texts(texts)]
        columns = [pa.array([v.astype("<u4").tobytes() for v in found], pa.binary()), pa.array([len(v) for v in found], pa.int64()), pa.array([int(is_byte[v].sum()) for v in found], pa.int64())]
        return pa.StructArray.from_arrays(columns, names=["ids", "n_tokens", "n_bytes"])

    return df.withColumn(result_col, arrow_udf(encode, ENCODED).asNondeterministic()(F.col(text_col)))


def decode_pieces(df: DataFrame, vocabulary: Vocabulary, ids_col: str = "ids", result_col: str = "decoded") -> DataFrame:
    """``df`` with the text of ``ids_col`` in ``result_col``; null ids count as none (empty text).
    Bytes that form no character become U+FFFD. Other columns pass through; no shuffle."""
    spark = df.sparkSession
    ship(spark)
    shared = _Shared(spark, vocabulary)

    def decode(column: pa.Array) -> pa.Array:
        surface = _encoder(shared).vocabulary.surface
        flat = np.frombuffer(b"".join(surface), np.uint8)
        size = np.array([len(s) for s in surface])
        first = np.cumsum(size) - size
        out = []
        for raw in column.to_pylist():
            ids = np.frombuffer(raw or b"", "<u4")
            n = size[ids]
            at = np.repeat(first[ids] - np.cumsum(n) + n, n) + np.arange(n.sum())
            text = flat[at].tobytes()
            out.append(text.removeprefix(b" ").decode("utf-8", "replace"))
        return pa.array(out, pa.string())

    return df.withColumn(result_col, arrow_udf(decode, "string").asNondeterministic()(F.col(ids_col)))

