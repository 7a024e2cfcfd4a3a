"""Packing documents into as few token sequences of fixed capacity as possible.

Lengths are whole numbers up to the capacity, so the instance is its histogram: at most ``capacity`` counts, whatever the
number of documents. The histogram is solved on the driver in bulk. First Martello-Toth reduction fixes sets that
provably dominate every other set with the same longest piece; they leave the instance, which shrinks. Then best fit,
longest first, packs the remainder. Every step places many pieces of one length at once, so the plan is a short table of
(length, range of ranks) -> (range of sequences, offset). Pieces are numbered within their length in parallel and joined
with that table.

Tokens: white space separates tokens in this tokenizer family, so words are encoded apart, once for each worker and word,
and documents put together from them; this equals encoding the whole text.

Defined cases: a null or empty text is the end token alone; repeated rows are packed each; an empty table gives an empty
result; other columns are not read; a text of any length is cut into pieces of the capacity.
"""

from __future__ import annotations

import bisect
import json
import os
import zlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from premisa.llm.common import numbered, ready, written

CAPACITY = 4096
END = 1
#: Words that a worker remembers, in each of two generations; longer words are not remembered.
REMEMBERED_WORDS = 300_000
REMEMBERED_LETTERS = 60
#: Rows of the plan that may be broadcast, about 50 bytes each.
BROADCAST_PLAN = 500_000

PIECES = "row_id long, doc_id long, piece int, start long, length long, ids_crc32 long"

#: Words that are encoded together.
_TOGETHER = 500
#: How a special token begins.
_MARK = "<|"
#: What is a token of its own behind a letter or digit, at the end of a word.
_TAILS = [".", ",", ";", ":", "!", "?"]
_TAIL_OF = np.array([_TAILS.index(chr(b)) + 1 if chr(b) in _TAILS else 0 for b in range(256)])
_ALNUM = np.array([bytes([b]).isalnum() for b in range(256)])

_encoders: dict[int, WordEncoder] = {}


class WordEncoder:
    """Token ids of texts, as little-endian 32-bit bytes, with a bounded memory of words.

    ``new`` has the ids of words met lately, ``old`` is the generation before.
    """

    def __init__(self, definition: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.normalizer = self.tokenizer.normalizer
        # a special token between words: the library cuts there before all else
        special = [x for x in json.loads(definition)["added_tokens"] if x["special"] and not x["normalized"] and x["content"].startswith(_MARK)]
        self.between = next(((x["content"], x["id"]) for x in special if not (x["single_word"] or x["lstrip"] or x["rstrip"])), None)
        self.tails = pa.array([b"", *self._alone(_TAILS)], pa.large_binary())
        vocabulary, suffix = self.tokenizer.get_vocab(), json.loads(definition)["model"].get("end_of_word_suffix")
        self.last = np.zeros(max(vocabulary.values()) + 1, dtype=bool)  # ids that end a run of letters
        self.last[[i for token, i in vocabulary.items() if suffix and token.endswith(suffix)]] = True
        self.old: dict[str, bytes] = {}
        self.new: dict[str, bytes] = {}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype="<u4")

    def _alone(self, words: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(words, add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _apart(self, words: list[str]) -> list[bytes]:
        """The ids of words of any kind but special tokens, encoded as one text with a special token between them."""
        if self.between is None:
            return self._alone(words)
        mark, number = self.between
        found = self._ids(mark.join(words))
        cuts = np.flatnonzero(found == number)
        if len(cuts) != len(words) - 1:
            return self._alone(words)
        whole = found.tobytes()
        return [whole[i:j] for i, j in zip([0, *(4 * cuts + 4).tolist()], [*(4 * cuts).tolist(), len(whole)], strict=True)]

    def _together(self, words: list[str]) -> list[bytes]:
        """The same for words of letters, which end where a token ends that ends a run of letters: encoded as one text."""
        found = self._ids(" ".join(words))
        ends = (4 * np.flatnonzero(self.last[found]) + 4).tolist()
        if len(ends) != len(words):  # each has one at least: not all are letters to the tokenizer
            return self._apart(words)
        whole = found.tobytes()
        return [whole[i:j] for i, j in pairwise([0, *ends])]

    def encoded(self, words: list[str]) -> dict[str, bytes]:
        """The ids of each word."""
        out: dict[str, bytes] = {}
        letters = [w for w in words if w.isalpha()]
        normal = [w for w in letters if w.isascii() and w.islower()]  # the tokenizer would normalise them to themselves
        same = set(normal)
        others = [w for w in words if not w.isalpha()]
        marked = [w for w in others if _MARK in w]
        unmarked = [w for w in others if _MARK not in w]
        for encode, skip, of in ((self._together, True, normal), (self._together, False, [w for w in letters if w not in same]),
                                 (self._apart, False, unmarked), (self._alone, False, marked)):
            self.tokenizer.normalizer = None if skip else self.normalizer
            for first in range(0, len(of), _TOGETHER):
                run = of[first : first + _TOGETHER]
                out.update(zip(run, encode(run), strict=True))
        return out

    def learned(self, words: list[str]) -> list[bytes]:
        """The ids of the words, each given once; short ones are remembered."""
        found = list(map(self.new.get, words))
        fresh = [i for i, ids in enumerate(found) if ids is None]
        if fresh:
            asked = [words[i] for i in fresh]
            known = {w: ids for w, ids in zip(asked, map(self.old.get, asked), strict=True) if ids is not None}
            known.update(self.encoded([w for w in asked if w not in known]))
            for i, w in zip(fresh, asked, strict=True):
                found[i] = known[w]
            self.new.update((w, known[w]) for w in asked if len(w) <= REMEMBERED_LETTERS)
        return found

    def batch(self, texts: list[str | None]) -> Iterator[bytes]:
        """ASCII white space splits: the tokenizer never joins across it, nor a letter with the mark behind it.

        It lowers letters itself, so ASCII letters may be lowered before: fewer words are to be remembered.
        """
        if len(self.new) > REMEMBERED_WORDS:
            self.old, self.new = self.new, {}
        # special tokens have a case: a text that may hold one keeps it
        plain = [(t or "").encode() for t in texts]
        plain = pa.array([t if _MARK.encode() in t else t.lower() for t in plain], pa.large_string())
        split = pc.ascii_split_whitespace(plain)
        words = split.values.dictionary_encode()
        bare, tail = _bare(words.dictionary.cast(pa.large_binary()))
        bare = bare.cast(pa.large_string()).dictionary_encode()
        found = pa.array(self.learned(bare.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        found = pc.binary_join_element_wise(found.take(bare.indices), self.tails.take(tail), pa.scalar(b"", pa.large_binary()))
        ids = found.take(words.indices)
        _, ends, data = ids.buffers()
        ends = np.frombuffer(ends, dtype=np.int64)[ids.offset : ids.offset + len(ids) + 1] if len(ids) else np.zeros(1, np.int64)
        data = memoryview(data or b"")
        for i, j in pairwise(ends[split.offsets.to_numpy()].tolist()):
            yield bytes(data[i:j])


def _bare(words: pa.Array) -> tuple[pa.Array, pa.Array]:
    """Words without one of ``_TAILS`` behind an ASCII letter or digit; and which tail that was, or 0."""
    _, ends, data = words.buffers()
    if not len(words) or not data:
        return words, pa.array(np.zeros(len(words), np.int64))
    ends, data = np.frombuffer(ends, dtype=np.int64)[words.offset : words.offset + len(words) + 1], np.frombuffer(data, dtype=np.uint8)
    long = np.diff(ends) > 1
    tail = np.where(long, _TAIL_OF[data[np.maximum(ends[1:] - 1, 0)]], 0)
    tail = np.where(_ALNUM[data[np.maximum(ends[1:] - 2, 0)]], tail, 0)
    return pc.if_else(pa.array(tail > 0), pc.binary_slice(words, 0, -1), words), pa.array(tail)


def _groups(texts: list[str | None], size: int = 2_000_000) -> Iterator[tuple[int, list[str | None]]]:
    """Runs of texts of about ``size`` characters, so that memory does not follow the batch."""
    first, held = 0, 0
    for i, t in enumerate(texts):
        held += len(t or "")
        if held >= size:
            yield first, texts[first : i + 1]
            first, held = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def tokenized(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, ids: bool = True) -> DataFrame:
    """One row per piece: row_id, doc_id, piece, start, length, ids_crc32 and, if wanted, ids (little-endian 32-bit)."""
    ready(docs.sparkSession)
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = docs.sparkSession.sparkContext.broadcast(f.read())
    end = END.to_bytes(4, "little")

    def pieces(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        key = zlib.crc32(definition.value.encode())
        if key not in _encoders:  # kept while the worker lives
            _encoders[key] = WordEncoder(definition.value)
        encoder = _encoders[key]
        for frame in frames:
            rows, docs_of, texts = frame["row_id"].tolist(), frame["doc_id"].tolist(), frame["text"].tolist()
            for first, group in _groups(texts):
                out = []
                for k, data in enumerate(encoder.batch(group), first):
                    data += end
                    for piece, at in enumerate(range(0, len(data), 4 * capacity)):
                        part = data[at : at + 4 * capacity]
                        row = (rows[k], docs_of[k], piece, at // 4, len(part) // 4, zlib.crc32(part))
                        out.append((*row, part) if ids else row)
                names = ["row_id", "doc_id", "piece", "start", "length", "ids_crc32"] + ["ids"] * ids
                made = pd.DataFrame(out, columns=names)
                made["doc_id"] = made["doc_id"].astype("Int64")
                yield made

    plain = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
    )
    return plain.mapInPandas(pieces, PIECES + (", ids binary" if ids else ""))


class Plan:
    """Where the pieces of each length go; ``rows``: (length, first rank, pieces, per sequence, first sequence, offset)."""

    def __init__(self, counts: dict[int, int], capacity: int = CAPACITY):
        if any(not 0 < x <= capacity for x in counts):
            raise ValueError("a length outside 1..capacity")
        self.capacity, self.left = capacity, {x: n for x, n in counts.items() if n > 0}
        self.ranks = dict.fromkeys(self.left, 0)
        self.sequences = 0
        self.rows: list[tuple[int, int, int, int, int, int]] = []

    def take(self, length: int, pieces: int, each: int, sequence: int, offset: int) -> None:
        self.rows.append((length, self.ranks[length], pieces, each, sequence, offset))
        self.ranks[length] += pieces
        self.left[length] -= pieces
        if not self.left[length]:
            del self.left[length]

    def fix(self, a: int, b: int | None, times: int) -> None:
        """``times`` sequences of a piece of length a and, if given, one of length b."""
        self.take(a, times, 1, self.sequences, 0)
        if b is not None:
            self.take(b, times, 1, self.sequences, a)
        self.sequences += times

    def reduce(self) -> None:
        """Martello-Toth dominance: for each length, from the longest, fix the set that no other set can beat."""
        for a in sorted(self.left, reverse=True):
            while a in self.left:
                room, sizes = self.capacity - a, sorted(self.left)
                spare = lambda x, a=a: self.left[x] - (x == a)  # noqa: E731  pieces of a length besides the one at hand
                smallest = [x for x in sizes[:4] for _ in range(min(3, spare(x)))][:3]
                if not smallest or smallest[0] > room:
                    self.fix(a, None, self.left[a])  # nothing fits beside it
                    break
                k = bisect.bisect_right(sizes, room) - 1
                while k >= 0 and not spare(sizes[k]):
                    k -= 1
                b = sizes[k]
                alone = len(smallest) < 2 or sum(smallest[:2]) > room  # no two pieces fit beside it
                pairs = len(smallest) < 3 or sum(smallest) > room  # no three do
                if b == room or alone or pairs and b >= self._best_pair(a, room, sizes):
                    self.fix(a, b, self.left[a] // 2 if a == b else min(self.left[a], self.left[b]))
                else:
                    break

    def _best_pair(self, a: int, room: int, sizes: list[int]) -> int:
        """The largest total of two pieces that fits into ``room``."""
        spare = [x for x in sizes if self.left[x] - (x == a) > 0 and x <= room]
        best, i, j = 0, 0, len(spare) - 1
        while i <= j:
            total = spare[i] + spare[j]
            if total > room or i == j and self.left[spare[i]] - (spare[i] == a) < 2:
                j -= 1
            else:
                best, i = max(best, total), i + 1
        return best

    def best_fit(self) -> None:
        """Longest first, each into the fullest sequence that has room; ranges of equal sequences move together."""
        open_: dict[int, list[tuple[int, int]]] = {}  # room -> ranges (first sequence, number)
        rooms: list[int] = []

        def put(room: int, first: int, n: int) -> None:
            if n and room:
                if room not in open_:
                    open_[room] = []
                    bisect.insort(rooms, room)
                open_[room].append((first, n))

        for x in sorted(self.left, reverse=True):
            while x in self.left:
                at = bisect.bisect_left(rooms, x)
                if at == len(rooms):  # new sequences for all that is left of this length
                    room, first, n = self.capacity, self.sequences, -(-self.left[x] // (self.capacity // x))
                    self.sequences += n
                else:
                    room = rooms[at]
                    first, n = open_[room].pop()
                    if not open_[room]:
                        del open_[room], rooms[at]
                each, offset = room // x, self.capacity - room
                whole = min(n, self.left[x] // each)
                if whole:
                    self.take(x, whole * each, each, first, offset)
                    put(room - each * x, first, whole)
                first, n = first + whole, n - whole
                if n and x in self.left and self.left[x] < each:
                    some = self.left[x]
                    self.take(x, some, some, first, offset)
                    put(room - some * x, first, 1)
                    first, n = first + 1, n - 1
                put(room, first, n)

    def solve(self) -> list[tuple[int, int, int, int, int, int]]:
        self.reduce()
        self.best_fit()
        return self.rows


def placed(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Stored pieces with sequence_id and offset; ``pieces`` needs a unique ``unit`` and ``length``."""
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    rows = Plan(counts, capacity).solve()
    plan = pieces.sparkSession.createDataFrame(
        rows, "p_length long, p_rank long, p_pieces long, p_each long, p_sequence long, p_offset long"
    )
    if len(rows) <= BROADCAST_PLAN:
        plan = F.broadcast(plan)
    ranked = numbered(pieces, ["length"], "unit", "rank")
    inside = F.col("rank") - F.col("p_rank")
    fits = (F.col("length") == F.col("p_length")) & (inside >= 0) & (inside < F.col("p_pieces"))
    return ranked.join(plan, fits).select(
        *pieces.columns,
        (F.col("p_sequence") + F.expr("(rank - p_rank) div p_each")).alias("sequence_id"),
        (F.col("p_offset") + (inside % F.col("p_each")) * F.col("length")).alias("offset"),
    )


def packed_documents(docs: DataFrame, tokenizer_file: str, capacity: int = CAPACITY, ids: bool = False) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset (and ids)."""
    pieces = tokenized(docs, tokenizer_file, capacity, ids).withColumn("unit", F.monotonically_increasing_id())
    found = placed(written(pieces, "pieces"), capacity)
    return found.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset", *["ids"] * ids)


def sequences(packed: DataFrame) -> DataFrame:
    """The sequences themselves: sequence_id, n_tokens, ids; each holds at most the capacity. Needs ``ids``."""
    parts = packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"), F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("p")
    )
    joined = F.aggregate("p", F.lit(b""), lambda a, x: F.concat(a, x["ids"]))
    return parts.select("sequence_id", "n_tokens", joined.alias("ids"))
