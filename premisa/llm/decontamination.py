"""Benchmark decontamination: edit-tolerant search for benchmark items inside documents.

Texts are lower-cased and cut into words (runs of letters and digits). An item of n words matches a passage within
k = n // 5 word edits. By pigeonhole such a passage holds one of the item's k + 1 pieces unchanged, so only windows around
a piece can match: this loses nothing and leaves a clean document without windows. Item-sized windows, at every shift up to
k, are embedded by CGK random walks, which turn edit distance into Hamming distance; keys of sampled positions of several
independent walks look the items up (bit-sampling LSH). What is found is verified by the exact edit distance of the item to
the best passage around the window.

``WALKS`` walks with ``TABLES`` keys of ``SAMPLED`` positions: see ``recall`` in the tests, 0.99 and more at k edits.

Items are taken in blocks of about ``BLOCK_BYTES``, one pass over the documents each, so the part sent to tasks is bounded
whatever the size of the benchmark.

Defined cases: null and empty texts match nothing; an item without words, or null, matches nothing; an item of fewer than
five words must occur unchanged; repeated rows are searched each; other columns are not read by ``contaminated`` and pass
through ``decontaminated`` untouched; an empty benchmark leaves every document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premisa.llm.common import ready
from premisa.llm.hashing import mix, parts, prefix_sums, sequence_hashes, span_hashes

EDITS = 5  # one edit for so many words
WALKS, TABLES, SAMPLED = 8, 6, 4
BLOCK_BYTES = 16 << 20
#: Windows embedded at once.
WINDOWS = 4096
END_MARK = np.uint64(0x5851F42D4C957F2D)

FOUND = "doc_id long, item_id long, edits int, start_word long, n_words long"

_WORD = np.zeros(256, dtype=bool)
_WORD[128:] = True
for _a, _b in ((48, 58), (65, 91), (97, 123)):
    _WORD[_a:_b] = True


def word_hashes(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(number of the first text, word hashes, first word of each text and the end) for runs of texts."""
    lowered = pc.utf8_lower(texts.cast(pa.large_string()).fill_null(""))
    for first, data, offsets in parts(lowered):
        inside = _WORD[data]
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        starts = np.flatnonzero(inside & (edge[:-1] | ~np.concatenate([[False], inside[:-1]])))
        ends = np.flatnonzero(inside & (edge[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
        yield first, span_hashes(prefix_sums(data), starts, ends), np.searchsorted(starts, offsets)


def embedded(windows: np.ndarray, lengths: np.ndarray, walk: int) -> np.ndarray:
    """CGK embedding of each row (its first ``lengths`` entries count) into three times as many symbols."""
    n = windows.shape[1]
    rows, at = np.arange(len(windows)), np.zeros(len(windows), dtype=np.int64)
    padded = np.concatenate([windows, np.full((len(windows), 1), END_MARK)], axis=1)
    out = np.full((len(windows), 3 * n), END_MARK)
    for j in range(3 * n):
        at = np.minimum(at, lengths)
        symbol = np.where(at < lengths, padded[rows, at], END_MARK)
        out[:, j] = symbol
        at = at + (mix(symbol + np.uint64((walk << 32) + j + 1)) & np.uint64(1)).astype(np.int64)
    return out


def keys_of(windows: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Bit-sampling keys, one column for each walk and table; the length and the table are part of a key."""
    columns = []
    with np.errstate(over="ignore"):
        for walk in range(WALKS):
            image = embedded(windows, lengths, walk)
            for t in range(TABLES):
                key = mix(lengths.astype(np.uint64) + np.uint64(walk * TABLES + t + 1 << 32))
                for s in range(SAMPLED):
                    draw = int(mix(np.array([(walk * TABLES + t) * SAMPLED + s + 1], dtype=np.uint64))[0])
                    place = (draw % (1 << 32) * 3 * lengths) >> 32  # the same share of the way for every length
                    key = mix(key * np.uint64(31) + image[np.arange(len(image)), place])
                columns.append(key)
    return np.stack(columns, axis=1)


class Items:
    """A block of benchmark items, ready for search."""

    def __init__(self, ids: list[int], texts: list[str]):
        self.ids, self.words = [], []
        for first, hashes, starts in word_hashes(pa.array(texts, pa.large_string())):
            for i in range(len(starts) - 1):
                if starts[i + 1] > starts[i]:
                    self.ids.append(ids[first + i])
                    self.words.append(hashes[starts[i] : starts[i + 1]])
        self.edits = [len(w) // EDITS for w in self.words]
        pieces: dict[int, list[tuple[int, int, int]]] = {}  # piece length -> (hash, item, place in the item)
        for item, (w, k) in enumerate(zip(self.words, self.edits, strict=True)):
            cuts = [len(w) * p // (k + 1) for p in range(k + 2)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                pieces.setdefault(b - a, []).append((int(sequence_hashes(w[a:b], b - a)[0]), item, a))
        self.pieces = {}
        for n, found in pieces.items():
            found.sort()
            hashes = np.array([h for h, _, _ in found], dtype=np.uint64)
            seen = np.zeros(1 << 20, dtype=bool)
            seen[hashes & np.uint64((1 << 20) - 1)] = True
            self.pieces[n] = (hashes, np.array([i for _, i, _ in found]), np.array([a for _, _, a in found]), seen)
        keys = [keys_of(w[None, :], np.array([len(w)]))[0] for w in self.words]
        flat = np.concatenate(keys) if keys else np.zeros(0, np.uint64)
        order = np.argsort(flat, kind="stable")
        self.keys, self.key_items = flat[order], order // (WALKS * TABLES)

    def anchors(self, words: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """Distinct (text, item, window start) around each unchanged piece; starts are places in ``words``."""
        out = []
        for n, (hashes, items, places, seen) in self.pieces.items():
            runs = sequence_hashes(words, n)
            at = np.flatnonzero(seen[runs & np.uint64((1 << 20) - 1)])
            text = np.searchsorted(starts, at, side="right") - 1
            ok = at + n <= starts[text + 1]
            at, text = at[ok], text[ok]
            low, high = np.searchsorted(hashes, runs[at], "left"), np.searchsorted(hashes, runs[at], "right")
            which = _ranges(low, high)
            again = np.repeat(np.arange(len(at)), high - low)
            out.append(np.stack([text[again], items[which], at[again] - places[which]], axis=1))
        return np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 3), np.int64)

    def search(self, words: np.ndarray, starts: np.ndarray) -> list[tuple[int, int, int, int, int]]:
        """(text, item, edits, start word, words) of the best passage for each text and item that match."""
        found: dict[tuple[int, int], tuple[int, int, int]] = {}
        tried: set[tuple[int, int, int]] = set()
        anchors = self.anchors(words, starts)
        room = WINDOWS
        for a in range(0, len(anchors), room):
            text, item, at = anchors[a : a + room].T
            k = np.array(self.edits)[item]
            again = np.repeat(np.arange(len(text)), 2 * k + 1)
            shift = _ranges(-k, k + 1)
            size = np.array([len(w) for w in self.words])[item]
            windows = np.unique(np.stack([text[again], size[again], at[again] + shift], axis=1), axis=0)
            for b in range(0, len(windows), WINDOWS):
                for t, i, place in self.looked_up(words, starts, windows[b : b + WINDOWS]):
                    n, k = len(self.words[i]), self.edits[i]
                    if (t, i, place // max(1, k)) in tried:
                        continue
                    tried.add((t, i, place // max(1, k)))
                    low, high = max(int(starts[t]), place - 2 * k), min(int(starts[t + 1]), place + n + 2 * k)
                    edits, begin, end = nearest(self.words[i], words[low:high])
                    best = (edits, low + begin - int(starts[t]), end - begin)
                    if edits <= k and best < found.get((t, i), (k + 1, 0, 0)):
                        found[t, i] = best
        return [(t, i, *best) for (t, i), best in sorted(found.items())]

    def looked_up(self, words: np.ndarray, starts: np.ndarray, windows: np.ndarray) -> list[tuple[int, int, int]]:
        """(text, item, place) where a window shares a key with an item."""
        text, size, at = windows.T
        low, high = np.maximum(at, starts[text]), np.minimum(at + size, starts[text + 1])
        cols = low[:, None] + np.arange(size.max())[None, :]
        inside = cols < high[:, None]
        image = np.where(inside, words[np.minimum(cols, len(words) - 1)], END_MARK)
        lengths = size  # a window that a text's edge cuts short is padded
        keys = keys_of(image, lengths)
        a, b = np.searchsorted(self.keys, keys, "left"), np.searchsorted(self.keys, keys, "right")
        hit = np.flatnonzero((b > a).ravel())
        which = _ranges(a.ravel()[hit], b.ravel()[hit])
        rows = np.repeat(hit // keys.shape[1], (b - a).ravel()[hit])
        pairs = np.unique(np.stack([text[rows], self.key_items[which], at[rows]], axis=1), axis=0)
        return [tuple(map(int, p)) for p in pairs]


def _ranges(low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """low[0] .. high[0]-1, low[1] .. high[1]-1, and so on."""
    n = high - low
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n)


def nearest(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, begin, end) of the part of ``text`` with the least word edit distance to ``item``; the first such."""
    m = len(text)
    places = np.arange(m + 1)
    cost, begin = np.zeros(m + 1, dtype=np.int64), places.copy()
    span = m + 2
    for symbol in item:
        # pack (cost, -begin) so that ties prefer the later begin: the shorter passage
        packed = cost * span + (m - begin)
        step = packed + span
        step[1:] = np.minimum(step[1:], packed[:-1] + np.where(text == symbol, 0, span))
        step = np.minimum.accumulate(step - places * span) + places * span
        cost, begin = step // span, m - step % span
    end = int(np.argmin(cost))
    return int(cost[end]), int(begin[end]), end


def blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The items, a bounded number of bytes at a time."""
    ready(benchmark.sparkSession)
    rows = benchmark.where("text is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / BLOCK_BYTES))
    for b in range(n):
        part = rows.where(F.pmod(F.xxhash64("text"), F.lit(n)) == b).orderBy("item_id", "text").collect()
        yield Items([r[0] for r in part], [r[1] for r in part])


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document row and item that match: doc_id, item_id, edits, start_word, n_words."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    out = None
    for items in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def search(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            items = sent.value
            for batch in batches:
                for first, words, starts in word_hashes(batch.column("text")):
                    found = items.search(words, starts)
                    docs_of = batch.column("doc_id").take(pa.array([first + t for t, *_ in found], pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [docs_of, pa.array([items.ids[i] for _, i, *_ in found], pa.int64()),
                         pa.array([e for _, _, e, _, _ in found], pa.int32()),
                         pa.array([s for _, _, _, s, _ in found], pa.int64()),
                         pa.array([n for *_, n in found], pa.int64())],
                        ["doc_id", "item_id", "edits", "start_word", "n_words"])

        part = rows.mapInArrow(search, FOUND)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item."""
    for items in blocks(benchmark):
        sent = docs.sparkSession.sparkContext.broadcast(items)

        def clean(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, dtype=bool)
                for first, words, starts in word_hashes(batch.column("text")):
                    keep[[first + t for t, *_ in sent.value.search(words, starts)]] = False
                yield batch.filter(pa.array(keep))

        docs = docs.mapInArrow(clean, docs.schema)
    return docs
