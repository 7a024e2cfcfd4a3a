"""Exact token counts of every prefix of a text, for byte-level BPE vocabularies.

A prefix dynamic program over the bytes of a pre-token keeps, for each prefix, the last token of its encoding and the number
of tokens. Exactly one token that ends there can follow the last token of the prefix before it: two tokens may be
neighbours if merging the bytes of both gives these two again, and an encoding is right if all its neighbours are. So the
count of the whole and of every shorter prefix come from one walk. The program runs once for each distinct unit (a
pre-token with the white space that decides its cut); the counts of a text are put together from the units' counts, added
to the number of tokens before each unit.

``prefix_counts`` stores the counts with the rows; ``tokens_before``, ``truncated`` and ``fitting`` answer questions about
budgets from them, without the tokenizer. A count is that of the prefix as a text of its own: it may fall when a longer
prefix merges better.

Pre-tokens are cut by the pattern that byte-level tokenizers share. Scripts whose character classes differ between Unicode
versions are cut by the tokenizer library itself. Added special tokens inside a text are one token each, as the library
does by default; in a prefix that ends inside one they are ordinary text.

Defined cases: a null or empty text has no tokens and the single prefix count 0; other columns pass through untouched, in
a struct; repeated rows are counted each; an empty table gives an empty result; a text of any length is read whole.
"""

from __future__ import annotations

import json
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from premisa.llm.common import packed, ready, unpacked

#: Characters of text worked on at once; four bytes of counts are held for each.
WORK_CHARACTERS = 2_000_000
#: Units, their characters, and pairs of neighbours a worker remembers from one run of texts to the next.
REMEMBERED_UNITS, REMEMBERED_CHARACTERS, REMEMBERED_PAIRS = 500_000, 8_000_000, 1_000_000

# Contractions of byte-level BPE tokenizers, and code points whose classes all Unicode versions share.
CONTRACTIONS = ("'s", "'t", "'re", "'ve", "'m", "'ll", "'d")
SETTLED = r"[\x00-՗ऀ-౛ -⁯₠-₿　-鿿가-힣\U0001d400-\U0001d7ff]*"

# the letters and numbers below U+0250
LATIN, NUMBERS = "A-Za-zªµºÀ-ÖØ-öø-ɏ", "0-9²³¹¼-¾"

# a pre-token with all white space before it, where the last of it is its own blank; or a run of white space
_UNIT = regex.compile(r" ?\p{L}+|'s|'t|'re|'ve|'m|'ll|'d|(?:\s+(?= ))? ?(?:\p{L}+|\p{N}+|[^\s\p{L}\p{N}]+)|\s+")
_LATIN_UNIT = re.compile(rf" ?[{LATIN}]+|'s|'t|'re|'ve|'m|'ll|'d|(?:\s+(?= ))? ?(?:[{LATIN}]+|[{NUMBERS}]+|[^\s{LATIN}{NUMBERS}]+)|\s+")
_LATIN = re.compile("[\x00-ɏ\u2000-\u206f]*")
_SETTLED = regex.compile(SETTLED)
_SPACE = regex.compile(r"\s+")
_EDGE = regex.compile(r"(?<=\S)(?=\s)")

_counters: dict[int, PrefixCounter] = {}


def byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in the vocabulary: printable bytes themselves, the others from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    out = {chr(b): b for b in printable}
    hidden = [b for b in range(256) if chr(b) not in out]
    return out | {chr(256 + k): b for k, b in enumerate(hidden)}


class Units(dict):
    """Number of each unit; a new one is counted when it is first looked up."""

    def __init__(self, counter: PrefixCounter):
        super().__init__()
        self.counter = counter
        self.size, self.first, self.whole, self.counts = array("q"), array("q"), array("q"), array("i")

    def __missing__(self, unit: str) -> int:
        found, whole = self.counter.unit(unit)
        self[unit] = n = len(self.size)
        self.size.append(len(unit))
        self.first.append(len(self.counts))
        self.whole.append(whole)
        self.counts.extend(found)
        return n


class PrefixCounter:
    """Token counts of all prefixes, for one vocabulary."""

    def __init__(self, definition: str):
        import ahocorasick
        from tokenizers import Tokenizer

        about = json.loads(definition)
        model, before = about["model"], about.get("pre_tokenizer") or {}
        plain = all(not model.get(k) for k in ("dropout", "byte_fallback", "ignore_merges", "continuing_subword_prefix", "end_of_word_suffix"))
        if model.get("type", "BPE") != "BPE" or about.get("normalizer") or not plain:
            raise ValueError("not a plain byte-level BPE vocabulary")
        if before.get("type") != "ByteLevel" or before.get("add_prefix_space") or not before.get("use_regex", True):
            raise ValueError("pre-tokens are not those of a byte-level tokenizer")
        self.special = []
        for x in about.get("added_tokens", []):
            if x["normalized"] or x["lstrip"] or x["rstrip"] or x["single_word"]:
                raise ValueError(f"an added token with rules of its own: {x['content']!r}")
            self.special.append(x["content"])
        longest_first = sorted(self.special, key=lambda s: (-len(s), s))
        self.specials = regex.compile("|".join(map(regex.escape, longest_first)) or r"(?!)")
        self.library = Tokenizer.from_str(definition).pre_tokenizer
        letters = byte_letters()
        latin = lambda token: "".join(chr(letters[c]) for c in token)  # noqa: E731  a character for each byte
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.ranks = {(latin(a), latin(b)): k for k, (a, b) in reversed(list(enumerate(merges)))}
        self.tokens = ahocorasick.Automaton()
        made = {chr(b) for b in range(256)} | {a + b for a, b in self.ranks}
        for token in made:
            self.tokens.add_word(token, token)
        self.tokens.make_automaton()
        self.pairs: dict[tuple[str, str], bool] = {}
        self.units = Units(self)

    def merged(self, text: str) -> list[str]:
        """The tokens of a short string: the neighbours of the smallest rank merge first, the leftmost of equals."""
        parts = list(text)
        while len(parts) > 1:
            rank, at = min((self.ranks.get((parts[i], parts[i + 1]), len(self.ranks)), i) for i in range(len(parts) - 1))
            if rank == len(self.ranks):
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def neighbours(self, a: str, b: str) -> bool:
        found = self.pairs.get((a, b))
        if found is None:
            if len(self.pairs) >= REMEMBERED_PAIRS:
                self.pairs.clear()
            found = self.pairs[a, b] = (a, b) not in self.ranks and self.merged(a + b) == ([a, b] if a else [b])
        return found

    def piece(self, text: str) -> list[int]:
        """Counts of the prefixes of one pre-token, by code points from the first on."""
        data = text.encode("utf-8", "surrogatepass")
        last: list[str] = [""] * (len(data) + 1)
        count = [0] * (len(data) + 1)
        for end, token in self.tokens.iter(data.decode("latin-1")):  # longer tokens first
            end += 1
            if not count[end]:
                before = end - len(token)
                if self.neighbours(last[before], token):
                    last[end], count[end] = token, count[before] + 1
        if len(data) == len(text):
            return count[1:]
        # a code point ends where the next byte does not go on with one
        return [count[i] for i in range(1, len(data) + 1) if i == len(data) or data[i] & 0xC0 != 0x80]

    def unit(self, unit: str) -> tuple[list[int], int]:
        """Counts of a unit's prefixes as ends of a text; and its tokens where more text follows."""
        found = _SPACE.match(unit)
        run = found.end() if found else 0
        if run == len(unit):  # the last white space becomes a pre-token of its own before more text
            counts = self.piece(unit)
            return counts, (counts[-2] + self.piece(unit[-1])[0] if run > 1 else counts[-1])
        if run > 1:  # all but the last blank are one pre-token, unless the text ends with them
            space, body = self.piece(unit[:run]), self.piece(unit[run - 1 :])
            counts = space + [space[-2] + n for n in body[1:]]
        elif unit in CONTRACTIONS and len(unit) == 3:
            counts = [1, 1 + self.piece(unit[1])[0], self.piece(unit)[-1]]
        else:
            counts = self.piece(unit)
        return counts, counts[-1]

    def cut(self, text: str) -> list[str]:
        """The units of a text without special tokens."""
        if _LATIN.fullmatch(text):
            return _LATIN_UNIT.findall(text)
        if _SETTLED.fullmatch(text):
            return _UNIT.findall(text)
        units: list[str] = []
        open_ = False  # the last unit is white space so far
        for _, (a, b) in self.library.pre_tokenize_str(text):
            piece = text[a:b]
            blank = _SPACE.match(piece)
            blank = blank is not None and blank.end() == len(piece)
            if open_ and (blank or piece[0] == " "):
                units[-1] += piece
            else:
                units.append(piece)
            open_ = blank
        return units

    def plain(self, texts: list[str]) -> list[np.ndarray]:
        """Counts of all prefixes, from the empty one on, of texts without special tokens."""
        if len(self.units) > REMEMBERED_UNITS or len(self.units.counts) > REMEMBERED_CHARACTERS:
            self.units = Units(self)
        number = self.units.__getitem__
        ids, ends = array("q"), [0]
        for text in texts:
            at = 0
            while at < len(text):  # long texts in runs that end where units do
                edge = _EDGE.search(text, at + WORK_CHARACTERS) if len(text) - at > WORK_CHARACTERS else None
                upto = edge.start() if edge else len(text)
                units = self.cut(text[at:upto] if at or edge else text)
                ids.extend(map(number, units))
                at = upto
            ends.append(len(ids))
        u = np.frombuffer(ids, dtype=np.int64) if len(ids) else np.zeros(0, np.int64)
        size, first, whole = (np.frombuffer(x, dtype=np.int64)[u] for x in (self.units.size, self.units.first, self.units.whole))
        counts = np.frombuffer(self.units.counts, dtype=np.int32) if len(u) else np.zeros(0, np.int32)
        before = np.concatenate([[0], np.cumsum(whole)])
        place = np.concatenate([[0], np.cumsum(size)])
        starts = np.array(ends)
        # tokens before each unit, within its text
        base = before[:-1] - np.repeat(before[starts[:-1]], np.diff(starts))
        at = np.arange(place[-1]) + np.repeat(first - place[:-1], size)
        flat = (counts[at] + np.repeat(base, size)).astype(np.int32)
        out = [np.concatenate([[0], flat[place[i] : place[j]]]).astype(np.int32) for i, j in zip(starts[:-1], starts[1:], strict=True)]
        return out

    def counts(self, texts: list[str]) -> list[np.ndarray]:
        """For each text the token counts of its prefixes of 0, 1, ... code points."""
        with_special = [i for i, t in enumerate(texts) if self.special and self.specials.search(t)]
        if not with_special:
            return self.plain(texts)
        out = self.plain(["" if i in set(with_special) else t for i, t in enumerate(texts)])
        for i in with_special:
            out[i] = self._around_specials(texts[i])
        return out

    def _around_specials(self, text: str) -> np.ndarray:
        found, at, base = [np.zeros(1, dtype=np.int32)], 0, 0
        for m in self.specials.finditer(text):
            counts = self.plain([text[at : m.end() - 1]])[0]  # up to its last character it is ordinary text
            upto = counts[m.start() - at] + 1
            found += [base + counts[1:], np.array([base + upto])]
            at, base = m.end(), base + upto
        found.append(base + self.plain([text[at:]])[0][1:])
        return np.concatenate(found).astype(np.int32)


def _runs(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about WORK_CHARACTERS together."""
    first, held = 0, 0
    for i, n in enumerate(sizes):
        held += n
        if held >= WORK_CHARACTERS:
            yield first, i + 1
            first, held = i + 1, 0
    if first < len(sizes):
        yield first, len(sizes)


def prefix_counts(docs: DataFrame, tokenizer_file: str, text: str = "text") -> DataFrame:
    """``row`` (the input row) and ``counts``: the tokens of the text's first 0, 1, 2, ... code points."""
    spark = docs.sparkSession
    ready(spark)
    with open(tokenizer_file, encoding="utf-8") as f:
        definition = spark.sparkContext.broadcast(f.read())

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = zlib.crc32(definition.value.encode())
        if key not in _counters:  # kept while the worker lives
            _counters[key] = PrefixCounter(definition.value)
        for batch in batches:
            texts = batch.column("text").fill_null("")
            for a, b in _runs(pa.compute.utf8_length(texts).to_pylist()):
                found = _counters[key].counts(texts.slice(a, b - a).to_pylist())
                ends = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int32)
                counts = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(found)))
                yield pa.RecordBatch.from_arrays([batch.column("row").slice(a, b - a), counts], ["row", "counts"])

    rows = packed(docs).select("row", F.col(f"row.`{text}`").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], T.StructField("counts", T.ArrayType(T.IntegerType()))])
    return rows.mapInArrow(counted, schema)


def tokens_before(counts: Column, characters: Column | int) -> Column:
    """Tokens of the first ``characters`` code points; of the whole text if it is shorter."""
    n = characters if isinstance(characters, Column) else F.lit(characters)
    return F.get(counts, F.least(F.greatest(n, F.lit(0)), F.size(counts) - 1).cast("int")).cast("long")


def fitting(counts: Column, budget: Column | int) -> Column:
    """Code points of the longest prefix with at most ``budget`` tokens."""
    b = budget if isinstance(budget, Column) else F.lit(budget)
    from_end = F.array_position(F.transform(F.reverse(counts), lambda n: n <= b), True)
    return F.greatest(F.size(counts) - from_end, F.lit(0)).cast("long")


def truncated(prefixes: DataFrame, budget: int, text: str = "text") -> DataFrame:
    """The input rows of ``prefix_counts``, their texts cut to the longest prefix of at most ``budget`` tokens."""
    kind = prefixes.schema["row"].dataType[text].dataType
    if not isinstance(kind, T.StringType):
        raise TypeError(f"{text} is not a string column")
    short = F.substring(F.col(f"row.`{text}`"), F.lit(1), fitting(F.col("counts"), budget).cast("int"))
    return unpacked(prefixes.select(F.col("row").withField(f"`{text}`", short).alias("row")))


def token_counts(docs: DataFrame, tokenizer_file: str, limit: int = 512) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, and whether these are more than ``limit``."""
    found = prefix_counts(docs.select("doc_id", "text"), tokenizer_file)
    tokens = F.element_at("counts", -1).cast("long")
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        F.octet_length(F.coalesce(F.col("row.text").cast("string"), F.lit(""))).cast("long").alias("n_bytes"),
        tokens.alias("n_tokens"),
        (tokens > limit).alias("over_limit"),
    )
