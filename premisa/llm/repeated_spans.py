"""Removal of long byte strings that occur more than once anywhere in a corpus.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts at another place, in any document or the same one.

1. Every string of that length is assigned to its minimizer, the least hash among its ``GRAM``-byte substrings (the
   leftmost of equals). Equal strings have equal minimizers, so only neighbourhoods ("segments") of equal minimizers need be
   compared; all strings of a document lie in one segment each.
2. Segments whose minimizer occurs once are dropped by a join with the counts.
3. Segments that occur as a whole more than once are repeated throughout. One copy of each goes on.
4. Different segments of one minimizer are compared in blocks of about ``BLOCK_BYTES``: a Burrows-Wheeler transform of the
   block is expanded breadth first, from the empty string, by one character to the left each round; round l sets exactly the
   places where neighbouring suffixes have l characters in common. It stops at ``LENGTH``: places not set by then are
   neighbours with a longer common prefix, that is, repeated strings.
5. A minimizer whose different segments have more than ``HOT_BYTES`` does not fit into a block. Its strings are hashed one
   by one (128 bits) and counted by a grouped aggregate instead, which spreads over all tasks.

Defined cases: a null text is an empty one; texts shorter than ``LENGTH`` lose nothing; equal rows are documents of their own
and repeat each other; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premisa.llm.common import ready, written
from premisa.llm.hashing import mix, parts, powers, prefix_sums, span_hashes

LENGTH = 200
GRAM = 32
BLOCK_BYTES = 1 << 20
HOT_BYTES = BLOCK_BYTES
#: Longer texts are worked on in pieces of this size.
PIECE_BYTES = 1 << 22
NULL_ID = -(1 << 63)
_PLACE = np.uint64((1 << 24) - 1)

ANCHORS = "doc_id long, text_hash long, s long, n long, gram long, segment long"


def minima(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each run of ``width`` neighbours, in a constant number of passes."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, dtype=np.uint64)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    ahead = np.minimum.accumulate(table, axis=1).ravel()
    behind = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    n = len(values) - width + 1
    return np.minimum(behind[:n], ahead[width - 1 : width - 1 + n])


def segments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, ...]:
    """(text, start, bytes, gram hash, segment hash) of the segments of each text; a start counts from its text."""
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none.astype(np.uint64), none.astype(np.uint64)
    sums = prefix_sums(data)
    at = np.arange(len(data) - gram + 1)
    grams = span_hashes(sums, at, at + gram)
    low = minima((grams & ~_PLACE) | at.astype(np.uint64), length - gram + 1)
    anchor = (low & _PLACE).astype(np.int64)
    sizes = np.diff(offsets)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(anchor)]
    valid = np.arange(len(anchor)) + length <= offsets[1:][text]
    new = np.ones(len(anchor) + 1, dtype=bool)
    new[1:-1] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]) | (valid[1:] != valid[:-1])
    first = np.flatnonzero(new)
    start, end = first[:-1], first[1:] - 1 + length
    keep = valid[start]
    start, end = start[keep], end[keep]
    place = anchor[start]
    with np.errstate(over="ignore"):
        whole = mix(span_hashes(sums, start, end) + (place - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
                    + (end - start).astype(np.uint64))
    return text[start], start - offsets[text[start]], end - start, grams[place], whole


def _pieces(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(number of the first text, place in it, bytes, offsets): one long text becomes several pieces that overlap."""
    if len(data) <= PIECE_BYTES:
        yield 0, 0, data, offsets
        return
    for i in range(len(offsets) - 1):
        for a in range(offsets[i], max(offsets[i] + 1, offsets[i + 1] - LENGTH + 1), PIECE_BYTES):
            part = data[a : min(a + PIECE_BYTES + LENGTH - 1, offsets[i + 1])]
            yield i, int(a - offsets[i]), part, np.array([0, len(part)])


def _anchored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, data, offsets in parts(batch.column("text")):
            for i, shift, piece, bounds in _pieces(data, offsets):
                text, start, size, gram, whole = segments(piece, bounds)
                rows = pa.array(text + first + i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").take(rows), batch.column("text_hash").take(rows), pa.array(start + shift),
                     pa.array(size), pa.array(gram.view(np.int64)), pa.array(whole.view(np.int64))],
                    ["doc_id", "text_hash", "s", "n", "gram", "segment"])


def suffix_order(text: np.ndarray, least: int) -> np.ndarray:
    """The suffixes of ``text`` (small whole numbers) in the order of their first ``least`` symbols."""
    n, top = len(text), int(text.max()) + 2
    step = max(1, min(4, int(62 / math.log2(top))))
    rank = np.zeros(n, dtype=np.int64)
    padded = np.concatenate([text.astype(np.int64) + 1, np.zeros(step, np.int64)])
    for i in range(step):
        rank = rank * top + padded[i : n + i]
    while True:
        order = np.argsort(rank, kind="stable")
        ordered = rank[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.concatenate([[1], (ordered[1:] != ordered[:-1]).astype(np.int64)]))
        if step >= least or rank[order[-1]] == n:
            return order
        after = np.zeros(n, dtype=np.int64)
        after[:-step] = rank[step:]
        rank = rank * (n + 1) + after
        step *= 2


def repeated_starts(text: np.ndarray, length: int) -> np.ndarray:
    """Places in ``text`` whose next ``length`` symbols occur at another place too (ends of the text never match).

    Breadth-first interval expansion on the Burrows-Wheeler transform: a round takes intervals of suffixes that share a
    prefix of l symbols, extends each by every symbol that precedes one of them, and marks the right ends found for the
    first time with l. Only intervals with a new right end go on, so each place is handled once over all rounds.
    """
    n = len(text)
    order = suffix_order(text, length)
    before = text[order - 1]  # of the first suffix: the last symbol, which must be unique
    sorted_ = np.argsort(before, kind="stable")
    moved = np.empty(n, dtype=np.int64)  # the suffix one symbol longer
    moved[sorted_] = np.arange(n)
    same = before[sorted_[1:]] == before[sorted_[:-1]]
    later, earlier = np.full(n, n, dtype=np.int64), np.full(n, -1, dtype=np.int64)  # the next and last with that symbol
    later[sorted_[:-1][same]], earlier[sorted_[1:][same]] = sorted_[1:][same], sorted_[:-1][same]
    unset = np.ones(n + 1, dtype=bool)
    unset[[0, n]] = False
    left, right = np.zeros(1, np.int64), np.full(1, n, np.int64)
    for _ in range(length):
        width = right - left
        at = np.arange(width.sum()) + np.repeat(left - (np.cumsum(width) - width), width)
        opens, closes = earlier[at] < np.repeat(left, width), later[at] >= np.repeat(right, width)
        a, b = np.sort(moved[at[opens]]), np.sort(moved[at[closes]]) + 1
        fresh = unset[b]
        unset[b] = False
        left, right = a[fresh], b[fresh]
        if not len(left):
            break
    joined = np.flatnonzero(unset)
    return np.unique(np.concatenate([order[joined - 1], order[joined]]))


def _block(frame: pd.DataFrame) -> pd.DataFrame:
    """Repeated strings among the segments of a block: (doc_id, text_hash, s, n) of the runs they cover."""
    frame = frame.sort_values(["gram", "segment"], kind="stable")
    found = [np.frombuffer(x, dtype=np.uint8) for x in frame["data"]]
    sizes = np.array([len(x) + 1 for x in found])
    text = np.empty(sizes.sum(), dtype=np.int64)
    ends = np.cumsum(sizes) - 1
    inside = np.ones(len(text), dtype=bool)
    inside[ends] = False
    text[inside] = np.concatenate(found).astype(np.int64) + len(found)
    text[ends] = np.arange(len(found))  # a different mark behind each segment
    starts = repeated_starts(text, LENGTH)
    which = np.searchsorted(ends, starts)
    place = starts - (ends[which] - sizes[which] + 1)
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (which[1:] != which[:-1]) | (place[1:] != place[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    rows = frame.iloc[which[first]]
    return pd.DataFrame({
        "doc_id": rows["doc_id"].to_numpy(), "text_hash": rows["text_hash"].to_numpy(),
        "s": rows["s"].to_numpy() + place[first], "n": place[last] - place[first] + LENGTH,
    })


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the segments listed beside a text."""
    for batch in batches:
        rows = [[] for _ in range(6)]
        held = 0
        lists = batch.column("wanted")
        for i in range(batch.num_rows):
            data = (batch.column("text")[i].as_py() or "").encode()
            doc, text_hash = batch.column("doc_id")[i].as_py(), batch.column("text_hash")[i].as_py()
            for w in lists[i].as_py():
                part = data[w["s"] : w["s"] + w["n"]]
                for out, x in zip(rows, (doc, text_hash, w["s"], w["gram"], w["segment"], part), strict=True):
                    out.append(x)
                held += len(part)
            if held > 16 << 20:
                yield _segment_rows(rows)
                rows, held = [[] for _ in range(6)], 0
        yield _segment_rows(rows)


def _segment_rows(rows: list[list]) -> pa.RecordBatch:
    kinds = (pa.int64(),) * 5 + (pa.binary(),)
    names = ["doc_id", "text_hash", "s", "gram", "segment", "data"]
    return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(rows, kinds, strict=True)], names)


def _strings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Two hashes of every string of the asked length in segments."""
    for batch in batches:
        for i in range(batch.num_rows):
            data = np.frombuffer(batch.column("data")[i].as_py(), dtype=np.uint8)
            at = np.arange(len(data) - LENGTH + 1)
            other = np.concatenate([[np.uint64(0)], np.cumsum(mix(data.astype(np.uint64) + np.uint64(7)) * powers(0xD6E8FEB86659FD93, len(data)), dtype=np.uint64)])
            undo = powers(pow(0xD6E8FEB86659FD93, -1, 1 << 64), len(data) + 1)
            h1 = span_hashes(prefix_sums(data), at, at + LENGTH)
            h2 = mix((other[at + LENGTH] - other[at]) * undo[at])
            row = lambda name, i=i, at=at: pa.array(np.full(len(at), batch.column(name)[i].as_py(), dtype=np.int64))
            doc = pa.array([batch.column("doc_id")[i].as_py()], pa.int64()).take(pa.array(np.zeros(len(at), np.int64)))
            yield pa.RecordBatch.from_arrays(
                [doc, row("text_hash"), pa.array(at + batch.column("s")[i].as_py()), pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64))],
                ["doc_id", "text_hash", "s", "h1", "h2"])


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the union of (start, end) spans."""
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for i in range(batch.num_rows):
            data = (batch.column("text")[i].as_py() or "").encode()
            runs = merged([(x["s"], x["s"] + x["n"]) for x in batch.column("spans")[i].as_py() or []])
            left, at = hashlib.sha256(), 0
            for s, e in runs:
                left.update(data[at:s])
                at = e
            left.update(data[at:])
            rows.append((batch.column("doc_id")[i].as_py(), len(data), sum(e - s for s, e in runs), len(runs), left.hexdigest(),
                         [{"s": s, "n": e - s} for s, e in runs]))
        columns = list(zip(*rows, strict=True)) or [[]] * 6
        kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("s", pa.int64()), ("n", pa.int64())])))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                                         ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "removed"])


def repeated(texts: DataFrame) -> DataFrame:
    """Spans (doc_id, text_hash, s, n) that repeated strings cover; they may overlap and occur twice."""
    anchors = written(texts.mapInArrow(_anchored, ANCHORS), "anchors")
    often = anchors.groupBy("gram").agg(F.count("*").alias("c")).where("c > 1").select("gram")
    again = written(anchors.join(often, "gram"), "anchors")
    kinds = written(again.groupBy("gram", "segment").agg(
        F.count("*").alias("c"), F.min(F.struct("doc_id", "text_hash", "s", "n")).alias("x")), "segments")
    whole = again.join(kinds.where("c > 1").select("gram", "segment"), ["gram", "segment"])
    spans = whole.select("doc_id", "text_hash", "s", "n").distinct()
    mixed = kinds.groupBy("gram").agg(F.count("*").alias("m"), F.sum("x.n").alias("held")).where("m > 1").select("gram", "held")
    asked = kinds.join(mixed, "gram").select("gram", "segment", "x.*")
    # the bytes of one copy of each segment that must be compared
    lists = asked.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("s", "n", "gram", "segment")).alias("wanted"))
    with_text = texts.join(lists, ["doc_id", "text_hash"]).select("doc_id", "text_hash", "text", "wanted")
    data = with_text.mapInArrow(_cut, "doc_id long, text_hash long, s long, gram long, segment long, data binary")
    data = written(data.dropDuplicates(["gram", "segment"]).join(mixed, "gram"), "segment-bytes")
    size = data.agg(F.sum(F.length("data"))).first()[0] or 0
    blocks = max(1, math.ceil(size / BLOCK_BYTES))
    cool = data.where(f"held <= {HOT_BYTES}").withColumn("block", F.pmod(F.xxhash64("gram"), F.lit(blocks)))
    compared = cool.groupBy("block").applyInPandas(_block, "doc_id long, text_hash long, s long, n long")
    strings = written(data.where(f"held > {HOT_BYTES}").mapInArrow(
        _strings, "doc_id long, text_hash long, s long, h1 long, h2 long"), "strings")
    twice = strings.groupBy("h1", "h2").agg(F.count("*").alias("c")).where("c > 1").select("h1", "h2")
    hot = strings.join(twice, ["h1", "h2"]).select("doc_id", "text_hash", "s", F.lit(LENGTH).cast("long").alias("n"))
    return written(spans.unionByName(compared).unionByName(hot), "spans")


def deduplicated(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, removed (array of start and bytes)."""
    ready(docs.sparkSession)
    texts = docs.select(F.coalesce(F.col("doc_id").cast("long"), F.lit(NULL_ID)).alias("doc_id"),
                        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    texts = texts.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    spans = repeated(texts).groupBy("doc_id", "text_hash").agg(F.collect_set(F.struct("s", "n")).alias("spans"))
    both = texts.join(spans, ["doc_id", "text_hash"], "left")
    both = both.withColumn("doc_id", F.nullif(F.col("doc_id"), F.lit(NULL_ID)))
    return both.select("doc_id", "text", "spans").mapInArrow(
        _kept, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, removed array<struct<s: long, n: long>>")
