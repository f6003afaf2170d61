"""Token counts of fields and sections by offset-mapped attribution.

A document's fields are joined to one text, which is encoded once, as a whole, with the character
span of each token. The spans are then joined with the spans of the sections (both are sorted, so
a binary search for each token). A token that crosses a boundary goes to the section that holds
most of its characters, the earlier one on a tie; a token without characters of its own (white
space that the vocabulary trims) goes to the section in which it starts. So the counts of a
document's sections add up to its tokens.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import arrow_udf

from panelforge.llm.encoding import encoder
from panelforge.llm.tables import ship
from panelforge.llm.textops import CONTINUATION, pieces

SECTIONS = "array<struct<field:int,section:bigint,start:bigint,stop:bigint,n_tokens:bigint,n_crossing:bigint>>"
_NAMES = ("field", "section", "start", "stop", "n_tokens", "n_crossing")
_KIND = pa.list_(pa.struct([("field", pa.int32())] + [(n, pa.int64()) for n in _NAMES[1:]]))


def allocate(starts: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token, whether it crosses a boundary), for sorted section ``starts`` (the
    first at 0) and token spans [begin, end)."""
    first = np.searchsorted(starts, begin, "right") - 1
    last = np.searchsorted(starts, np.maximum(end - 1, begin), "right") - 1
    to = first.copy()
    for i in np.flatnonzero(first != last):
        cuts = np.concatenate([[begin[i]], starts[first[i] + 1 : last[i] + 1], [end[i]]])
        to[i] = first[i] + int(np.argmax(np.diff(cuts)))
    return to, first != last


def token_counts(
    docs: DataFrame,
    vocabulary: str,
    fields: tuple[str, ...] = ("source", "text"),
    line_fields: tuple[str, ...] = ("text",),
    id_col: str = "doc_id",
    lower: bool = False,
) -> DataFrame:
    """(id, field, section, start, stop, n_tokens, n_crossing, doc_tokens), a row for each section.

    Fields are joined by one newline, which belongs to the section before it. A field in
    ``line_fields`` has one section for each line (its newline included), any other field is one
    section. ``start`` and ``stop`` are code points in the joined text.

    A null field counts as empty and still has one (empty) section; an empty section has no
    tokens, unless one that starts there has no characters. Repeated ids give the rows of each
    document; other columns are ignored; an empty table gives an empty table. Texts of any length
    are encoded whole. One map over the rows, no shuffle.
    """
    ship(docs.sparkSession)
    by_line = [f in line_fields for f in fields]

    def count(*columns: pa.Array) -> pa.Array:
        columns = [pc.fill_null(c.cast(pa.string()), "") for c in columns]
        sizes = np.stack([pc.utf8_length(c).to_numpy(zero_copy_only=False) for c in columns], axis=1) if len(columns[0]) else np.zeros((0, len(fields)), np.int64)
        joined = pc.binary_join_element_wise(*columns, "\n")
        tool, out = encoder(vocabulary, lower, spans=True), []
        for row, _, data, offsets in pieces(joined, 4 << 20):
            (_, begin, end), first = tool.encode(data, offsets)
            chars = np.concatenate([[0], np.cumsum(~CONTINUATION[data])])
            for i in range(len(offsets) - 1):
                lines = chars[offsets[i] : offsets[i + 1]][data[offsets[i] : offsets[i + 1]] == 10] - chars[offsets[i]] + 1
                starts, of, number, at = [], [], [], 0
                for f, size in enumerate(sizes[row + i].tolist()):
                    inner = lines[(lines > at) & (lines <= at + size)] if by_line[f] else lines[:0]
                    starts += [at, *inner.tolist()]
                    of += [f] * (1 + len(inner))
                    number += range(1 + len(inner))
                    at += size + 1
                total = at - 1
                place = np.array(starts)
                to, crossing = allocate(place, begin[first[i] : first[i + 1]], end[first[i] : first[i + 1]])
                n = np.bincount(to, minlength=len(place)).tolist()
                x = np.bincount(to[crossing], minlength=len(place)).tolist()
                stops = [*starts[1:], total]
                out.append([dict(zip(_NAMES, v)) for v in zip(of, number, starts, stops, n, x)])
        return pa.array(out, _KIND)

    rows = docs.select(F.col(id_col).alias("_id"), arrow_udf(count, SECTIONS).asNondeterministic()(*[F.col(f) for f in fields]).alias("s"))
    total = F.aggregate("s", F.lit(0).cast("long"), lambda a, x: a + x["n_tokens"])
    rows = rows.select("_id", total.alias("doc_tokens"), F.explode("s").alias("s"))
    name = F.element_at(F.array(*[F.lit(f) for f in fields]), F.col("s.field") + 1)
    return rows.select(F.col("_id").alias(id_col), name.alias("field"), "s.section", "s.start", "s.stop", "s.n_tokens", "s.n_crossing", "doc_tokens")
