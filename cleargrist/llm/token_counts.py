"""Token counts of sections by offset-mapped attribution.

A document is encoded once, as a whole, since cutting it first would change tokens at the cuts.
The tokens of a byte-level vocabulary are consecutive byte strings of the text, so the running
sum of their lengths gives each token's span; spans are interval-joined with the document's
sections by binary search, inside the task that has encoded the text. A token that crosses a
boundary is allocated by a rule:

- ``first``: to the section that holds its first byte,
- ``most``: to the section that holds most of its bytes, the earlier one of equals,
- ``share``: to every section it touches, by its share of the token's bytes.

Under every rule a document's counts add up to its number of tokens.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from pathlib import Path

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cleargrist.llm import arrays as A
from cleargrist.llm.tables import keyed, rows_between, sized, stored

# Fixed value: how texts are cut into pieces before byte pairs are merged, for this vocabulary.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
RULES = ("first", "most", "share")
#: The section of tokens outside all given sections.
OUTSIDE = -1


# The regular expression's matcher recurses over white space, and its stack ends before a million
# characters do. What it makes of a long run is known: a piece of all of it, but for the last
# character if something else follows. These are the characters that it takes for white space.
_BLANK = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
LONG_RUN = 10_000


@dataclass(frozen=True)
class Encoder:
    """An encoder of a vocabulary, the length in bytes of each token, and one that cuts no pieces."""

    pieces: tiktoken.Encoding
    whole: tiktoken.Encoding
    lengths: np.ndarray
    long_run: int = LONG_RUN

    def sizes(self, text: str) -> np.ndarray:
        """The length in bytes of each token of a text."""
        found, at = [], 0
        if len(text) >= self.long_run:
            for run in re.finditer(f"[{_BLANK}]{{{self.long_run},}}", text):
                end = run.end() if run.end() == len(text) else run.end() - 1
                found += self.pieces.encode_ordinary(text[at : run.start()])
                found += self.whole.encode_ordinary(text[run.start() : end])
                at = end
        found += self.pieces.encode_ordinary(text[at:])
        return self.lengths[np.asarray(found, np.int64)]


@lru_cache(maxsize=2)
def _encoder(ranks: bytes, pattern: str) -> Encoder:
    pairs = (line.split() for line in ranks.splitlines() if line)
    table = {base64.b64decode(token): int(rank) for token, rank in pairs}
    lengths = np.zeros(max(table.values()) + 1, np.int64)
    for token, rank in table.items():
        lengths[rank] = len(token)
    pieces, whole = (
        tiktoken.Encoding("own", pat_str=cut, mergeable_ranks=table, special_tokens={})
        for cut in (pattern, r"(?s).+")
    )
    return Encoder(pieces, whole, lengths)


def token_spans(block: A.Block, ranks: bytes, pattern: str) -> tuple[np.ndarray, np.ndarray]:
    """First byte and end of every token of a block's texts, in order."""
    encoder = _encoder(ranks, pattern)
    sizes = [
        encoder.sizes(block.text(row).decode("utf-8", "replace"))
        if block.ends[row] > block.starts[row]
        else np.zeros(0, np.int64)
        for row in range(len(block))
    ]
    ends = np.cumsum(np.concatenate(sizes)) if sizes else np.zeros(0, np.int64)
    return np.concatenate([[0], ends[:-1]])[: len(ends)], ends


def allocate(
    starts: np.ndarray, ends: np.ndarray, bounds: np.ndarray, rule: str
) -> tuple[np.ndarray, np.ndarray]:
    """Tokens of each section, and tokens that it shares with another one.

    ``bounds`` are the sections' first bytes, in order; a section ends where the next one begins,
    and the sections cover all tokens.
    """
    n = len(bounds)
    first = np.searchsorted(bounds, starts, side="right") - 1
    last = np.searchsorted(bounds, ends - 1, side="right") - 1
    crossing = np.flatnonzero(first != last)
    whole = first == last
    counts = np.bincount(first[whole], minlength=n).astype(float)
    shared = np.zeros(n)
    limits = np.append(bounds, ends[-1] if len(ends) else 0)
    for i in crossing.tolist():
        touched = np.arange(first[i], last[i] + 1)
        part = np.minimum(limits[touched + 1], ends[i]) - np.maximum(limits[touched], starts[i])
        touched, part = touched[part > 0], part[part > 0]
        shared[touched] += 1
        if rule == "share":
            counts[touched] += part / part.sum()
        else:
            counts[touched[0 if rule == "first" else int(np.argmax(part))]] += 1
    return counts, shared


def _line_sections(block: A.Block) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, number and first byte of each line; a line ends with its line feed."""
    lines = A.lines(block)
    first = np.searchsorted(lines.rows, np.arange(len(block)))
    return lines.rows, np.arange(len(lines.rows)) - first[lines.rows], lines.starts


def _given_sections(
    block: A.Block, given: pa.ListArray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The same for given spans of code points, with the gaps between them as OUTSIDE."""
    rows, numbers, starts = [], [], []
    for row, spans in enumerate(given.to_pylist()):
        text = block.data[block.starts[row] : block.ends[row]]
        lead = np.append(np.flatnonzero(A.LEAD[text]), len(text))
        at = 0
        for span in sorted(spans or (), key=lambda s: (s["start"], s["end"], s["section"])):
            low, high = (int(lead[min(max(span[c], 0), len(lead) - 1)]) for c in ("start", "end"))
            low = max(low, at)
            if low > at:
                rows.append(row), numbers.append(OUTSIDE), starts.append(block.starts[row] + at)
            rows.append(row), numbers.append(span["section"]), starts.append(block.starts[row] + low)
            at = max(high, low)
        if at < len(text) or not spans:
            rows.append(row), numbers.append(OUTSIDE), starts.append(block.starts[row] + at)
    return np.array(rows, np.int64), np.array(numbers, np.int64), np.array(starts, np.int64)


def count_tokens(
    docs: DataFrame,
    vocabulary: str,
    sections: DataFrame | None = None,
    rule: str = "most",
    pattern: str = PATTERN,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per document and section: id, ``section``, ``n_tokens`` and ``n_crossing``.

    ``vocabulary`` is the path of a file of byte-level tokens and ranks; its bytes, about a
    megabyte, are broadcast. ``sections`` has rows (id, ``section`` bigint, ``start``, ``end``) in
    code points; where they overlap, the earlier one keeps the common part, and tokens outside all
    of them count for section -1. Without it every line, its line feed included, is a section, by
    number from 0. ``n_tokens`` is a double, and whole but under the rule ``share``; ``n_crossing``
    counts the tokens that a section shares with another. A null or empty text has one section
    without tokens; sections of unknown ids, or with nulls, are left out; repeated rows count each
    for itself; an empty table gives an empty table. A text of any length is encoded, whatever its
    runs of white space; that holds for patterns which, like this one, make one piece of a long run
    but for its last character before other text.
    """
    if rule not in RULES:
        raise ValueError(f"unknown rule {rule!r}, use one of {', '.join(RULES)}")
    if not Path(vocabulary).is_file():
        raise FileNotFoundError(f"no vocabulary at {vocabulary}")
    rows = keyed(docs, id_col, text_col).select("id", "text")
    by_line = sections is None
    ranks = docs.sparkSession.sparkContext.broadcast(Path(vocabulary).read_bytes())
    if not by_line:
        spans = F.struct(*(F.col(c).cast("long").alias(c) for c in ("section", "start", "end")))
        known = sections.dropna(subset=[id_col, "section", "start", "end"])
        listed = known.groupBy(F.col(id_col).alias("own")).agg(F.collect_list(spans).alias("given"))
        listed = stored(listed, "sections")
        size = 64 + 32 * known.count() // max(1, listed.count())
        rows = rows.join(sized(listed, size), rows["id"] == listed["own"], "left")
        rows = rows.select("id", "text", "given")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for source in batches:
            for block in A.blocks(source.column("text")):
                if by_line:
                    of, number, bounds = _line_sections(block)
                else:
                    given = rows_between(source, "given", block.first, len(block))
                    of, number, bounds = _given_sections(block, given)
                tokens, crossing = allocate(*token_spans(block, ranks.value, pattern), bounds, rule)
                ids = rows_between(source, "id", block.first, len(block)).take(pa.array(of))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(number), pa.array(tokens), pa.array(crossing.astype(np.int64))],
                    ["id", "section", "n_tokens", "n_crossing"],
                )

    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, section long, n_tokens double, n_crossing long"
    counted = rows.mapInArrow(count, schema)
    if not by_line:
        # The gaps of a document are one section.
        outside = counted.filter(F.col("section") == OUTSIDE).groupBy("id", "section")
        outside = outside.agg(F.sum("n_tokens").alias("n_tokens"), F.sum("n_crossing").alias("n_crossing"))
        counted = counted.filter(F.col("section") != OUTSIDE).unionByName(outside)
    return counted.withColumnRenamed("id", id_col)
