"""Near-duplicate classes by ProbMinHash over weighted word shingles, banding and exact verification.

A text is the bag of its five-word shingles, each weighted by its count (a shorter text is one shingle). For each
shingle exponential arrivals of a Poisson process, whose rate is the weight, fall on random registers; a register keeps
the shingle that arrives first, and a text is done as soon as its next arrivals come later than all registers hold. Two
texts agree on a register with the probability of their probability Jaccard similarity. Bands of registers make the
candidates; the similarity of candidates is then computed from all their shingles, stored once a text, and links join texts into classes.

Copies (equal word sequences) are merged before anything else. All members of a bucket are held against its most central
one, the one that meets most texts in all its buckets. In buckets that still span several classes, every member outside the
bucket's largest class is then compared with all members of other classes, each pair in the first bucket that both share:
first by ``WIDE`` registers, drawn for members of such buckets only, then by their shingles. This happens inside blocks of about ``BLOCK`` by
``BLOCK`` members, which hold both: a block joins the classes that it finds linked and makes one row for each two classes joined, so it makes
fewer rows than it has members, however many pairs are alike or nearly so. First each of these members meets one block, which is
all of a bucket of ``BLOCK`` members and puts larger groups of copies into one class; buckets of more members that still span several classes
then have all their blocks compared. So two texts of a bucket are either compared or in one class by other links. So many registers tell
pairs under the threshold apart that few shingles are compared in vain: at six standard
deviations a pair at the threshold is lost once in a thousand million, and most pairs below 0.7 are dropped.

Rows are told apart by their texts, never by doc_id: each distinct word sequence gets a number, links and classes are of
these numbers, and a class takes its name, the smallest doc_id, at the end.

Defined cases: null, empty and wordless texts have no shingle and are copies of each other; rows with one doc_id, or with a
null one, and different texts are different documents, whose classes may have the same name; null is the smallest doc_id;
repeated rows are copies; other columns are not read by ``classes`` and pass through ``deduplicated`` untouched; an empty
table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premisa.llm.common import packed, ready, unpacked, written
from premisa.llm.hashing import mix, parts, powers, prefix_sums, sequence_hashes, span_hashes, word_spans

WORDS = 5
THRESHOLD = 0.8
#: 26 bands of 5: a pair at the threshold shares a bucket with probability 1 - (1 - 0.8**5)**26 = 0.99997.
BANDS, ROWS = 26, 5
REGISTERS = BANDS * ROWS
#: Registers that a pair at the threshold agrees on at least, but for one in some million (six standard deviations).
LEAST_AGREEING = int(REGISTERS * THRESHOLD - 6 * (REGISTERS * THRESHOLD * (1 - THRESHOLD)) ** 0.5)
#: Registers of members of open buckets, four bits each; what a pair at the threshold agrees on at least (six deviations).
WIDE = 1024
SAME = THRESHOLD + (1 - THRESHOLD) / 16
LEAST_WIDE = int(WIDE * SAME - 6 * (WIDE * SAME * (1 - SAME)) ** 0.5)
#: Members on a side of a block, and their distinct shingles.
BLOCK, ROOM = 512, 1 << 19
#: Shingles and registers that a task draws at once.
AT_ONCE = 1 << 20
NULL_ID = -(1 << 63)
#: A table of few rows is not made by many tasks: rows of a task at least, of texts (or pairs of bags) and of numbers.
TASK_TEXTS, TASK_NUMBERS = 2_500, 50_000

Bag = tuple[np.ndarray, np.ndarray]


def bags(data: np.ndarray, offsets: np.ndarray) -> tuple[list[Bag], np.ndarray]:
    """For each text its distinct shingles with their counts; and two hashes of each text's word sequence."""
    starts, ends, first = word_spans(data, offsets)
    words = span_hashes(prefix_sums(data), starts, ends)
    runs = sequence_hashes(words, WORDS)
    out = []
    with np.errstate(over="ignore"):
        sums = [np.concatenate([[np.uint64(0)], np.cumsum(w * powers(b, len(words)), dtype=np.uint64)])
                for w, b in ((words, 0xD6E8FEB86659FD93), (mix(words), 0xA0761D6478BD642F))]
        whole = np.zeros((len(offsets) - 1, 2), dtype=np.uint64)
        for i in range(len(offsets) - 1):
            a, b = first[i], first[i + 1]
            for k, base in enumerate((0xD6E8FEB86659FD93, 0xA0761D6478BD642F)):
                undo = np.uint64(pow(base, -int(a), 1 << 64))
                whole[i, k] = mix(np.array([(sums[k][b] - sums[k][a]) * undo + np.uint64(b - a)]))[0]
            if b - a >= WORDS:
                out.append(np.unique(runs[a : b - WORDS + 1], return_counts=True))
            else:
                out.append((whole[i, :1], np.ones(1, dtype=np.int64)) if b > a else (runs[:0], np.zeros(0, np.int64)))
    return out, whole


def signatures(of: list[Bag], registers: int = REGISTERS) -> np.ndarray:
    """The shingle in each register of each bag (0 in the registers of an empty bag)."""
    m = registers
    sizes = [len(x) for x, _ in of]
    element = np.concatenate([x for x, _ in of]) if of else np.zeros(0, np.uint64)
    weight = np.concatenate([w for _, w in of]).astype(np.float64) if of else np.zeros(0)
    text = np.repeat(np.arange(len(of)), sizes)
    when = np.full(len(of) * m, np.inf)
    who = np.zeros(len(of) * m, dtype=np.uint64)
    latest = np.full(len(of), np.inf)
    at = np.zeros(len(element))
    step = 0
    while len(element):
        step += 1
        with np.errstate(over="ignore"):
            draw = mix(element + np.uint64(step * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
            at = at - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
            place = text * m + (mix(draw) % np.uint64(m)).astype(np.int64)
        live = at < latest[text]
        if not live.all():
            element, weight, text, at, place = element[live], weight[live], text[live], at[live], place[live]
        np.minimum.at(when, place, at)
        won = when[place] == at
        who[place[won]] = element[won]
        touched = np.unique(text) if len(text) < 4 * len(of) else np.arange(len(of))
        latest[touched] = when.reshape(-1, m)[touched].max(axis=1)
        live = at < latest[text]
        if not live.all():
            element, weight, text, at = element[live], weight[live], text[live], at[live]
    return who.reshape(-1, m)


def similarity(a: Bag, b: Bag) -> float:
    """Probability Jaccard similarity of two weighted bags; with equal weights the plain Jaccard similarity."""
    if len(a[0]) and len(b[0]) and a[1].max() == b[1].max() == 1:
        both = len(np.intersect1d(a[0], b[0], assume_unique=True))
        return both / (len(a[0]) + len(b[0]) - both)
    keys = np.union1d(a[0], b[0])
    wa, wb = np.zeros(len(keys)), np.zeros(len(keys))
    wa[np.searchsorted(keys, a[0])] = a[1]
    wb[np.searchsorted(keys, b[0])] = b[1]
    ratio = np.divide(wa, wb, out=np.full(len(keys), np.inf), where=wb > 0)
    order = np.argsort(ratio, kind="stable")
    ratio, wa, wb = ratio[order], wa[order], wb[order]
    below = np.concatenate([[0.0], np.cumsum(wb)])  # weights in b of the keys with smaller ratios
    above = np.concatenate([np.cumsum(wa[::-1])[::-1], [0.0]])  # weights in a of the others
    both = np.flatnonzero((wa > 0) & (wb > 0))
    i = np.searchsorted(ratio, ratio[both])
    return float((wa[both] / (above[i] + ratio[both] * below[i])).sum())


def _signed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start, data, offsets in parts(batch.column("text")):
            n = len(offsets) - 1
            of, whole = bags(data, offsets)
            found = signatures(of)
            with np.errstate(over="ignore"):
                keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), (n, BANDS)).copy()
                for r in range(ROWS):
                    keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + found[:, r::ROWS])
            empty = np.array([len(x) == 0 for x, _ in of])
            yield pa.RecordBatch.from_pydict({
                **{k: batch.column(k).slice(start, n) for k in ("doc", "t1", "t2")},
                "h1": pa.array(whole[:, 0].view(np.int64)),
                "h2": pa.array(whole[:, 1].view(np.int64)),
                "empty": pa.array(empty),
                "keys": pa.ListArray.from_arrays(pa.array(np.arange(0, n * BANDS + 1, BANDS, dtype=np.int32)),
                                                 pa.array(keys.view(np.int64).ravel())),
                "registers": pa.array([x.tobytes() for x in (found >> np.uint64(56)).astype(np.uint8)], pa.binary()),
            })


def _lists(of: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    ends = np.cumsum([0, *map(len, of)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate([*of, np.zeros(0, of[0].dtype)]), kind))


def _bagged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, text) to (id, shingles, counts): the bag of the text; no counts where all of them are one."""
    for batch in batches:
        for start, data, offsets in parts(batch.column("text")):
            of, _ = bags(data, offsets)
            counts = [w.astype(np.int32) if (w > 1).any() else np.zeros(0, np.int32) for _, w in of]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id").slice(start, len(of)), _lists([x.view(np.int64) for x, _ in of], pa.int64()),
                 _lists(counts, pa.int32())], ["id", "shingles", "counts"])


def _stored(batch: pa.RecordBatch, prefix: str = "") -> Iterator[Bag]:
    """The bags in the columns shingles and counts of a batch."""
    shingles, counts = batch.column(f"{prefix}shingles"), batch.column(f"{prefix}counts")
    keys, weights = shingles.values.to_numpy().view(np.uint64), counts.values.to_numpy()
    for (i, j), (k, m) in zip(pairwise(shingles.offsets.to_numpy()), pairwise(counts.offsets.to_numpy()), strict=True):
        yield keys[i:j], weights[k:m] if m > k else np.ones(j - i, np.int32)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b) and the bags of both to the linked (a, b)."""
    for batch in batches:
        both = zip(_stored(batch, "a_"), _stored(batch, "b_"), strict=True)
        alike = pa.array([similarity(a, b) >= THRESHOLD - 1e-12 for a, b in both], pa.bool_())
        yield batch.select(["a", "b"]).filter(alike)


def _bytes(column: pa.Array) -> np.ndarray:
    """Binary values of REGISTERS bytes each, as rows."""
    return np.frombuffer(b"".join(column.to_pylist()), dtype=np.uint8).reshape(-1, REGISTERS)


def _near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs (a, b, a_registers, b_registers) to the (a, b) whose registers agree often enough."""
    for batch in batches:
        agree = (_bytes(batch.column("a_registers")) == _bytes(batch.column("b_registers"))).sum(axis=1)
        yield batch.select(["a", "b"]).filter(pa.array(agree >= LEAST_AGREEING))


def _widened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, shingles, counts) to (id, wide): WIDE registers of four bits, two to a byte."""
    for batch in batches:
        of = list(_stored(batch))
        ends = np.cumsum([len(x) + WIDE for x, _ in of])
        for run in np.split(np.arange(len(of)), np.flatnonzero(np.diff(ends // AT_ONCE)) + 1):
            found = (signatures([of[i] for i in run], WIDE) >> np.uint64(60)).astype(np.uint8)
            wide = found[:, ::2] << 4 | found[:, 1::2]
            ids = batch.column("id").take(pa.array(run))
            yield pa.RecordBatch.from_arrays([ids, pa.array([x.tobytes() for x in wide], pa.binary())], ["id", "wide"])


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks, a key and an array ``of`` of (minor, id, class_id, keys, wide, shingles, counts), to links (a, b) that join two classes
    of the block each: minor members are held against the others that share no bucket of an earlier band with them."""
    for batch in batches:
        of, here = batch.column("of"), batch.column("key").to_numpy()
        for k, (i, j) in enumerate(pairwise(of.offsets.to_numpy())):
            links = _links_of(pa.RecordBatch.from_struct_array(of.values.slice(i, j - i)), here[k])
            if links:
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*links, strict=True)], ["a", "b"])


def _links_of(block: pa.RecordBatch, key: int) -> list[tuple[int, int]]:
    """Fewer links than classes: one is kept only if its texts are not in one class by those before."""
    minor, ids, named = (block.column(c).to_numpy(zero_copy_only=False) for c in ("minor", "id", "class_id"))
    keys = block.column("keys").flatten().to_numpy().reshape(-1, BANDS)
    halves = np.frombuffer(b"".join(block.column("wide").to_pylist()), dtype=np.uint8).reshape(len(ids), -1)
    wide = np.concatenate([halves >> 4, halves & 15], axis=1)
    band = int(np.flatnonzero(keys[0] == key)[0])
    right, named, of, found = np.flatnonzero(~minor), named.copy(), None, []
    for x in np.flatnonzero(minor):
        y = right[named[right] != named[x]]
        y = y[~(keys[y, :band] == keys[x, :band]).any(axis=1)]
        agree = (wide[y] == wide[x]).sum(axis=1)
        near = np.flatnonzero(agree >= LEAST_WIDE)
        if not len(near):
            continue
        if of is None:
            of = list(_stored(block))
            once = [bool((w == 1).all()) for _, w in of]
            shingles, code = np.unique(np.concatenate([s for s, _ in of]), return_inverse=True)
            code = np.split(code, np.cumsum([len(s) for s, _ in of])[:-1])
            seen = np.zeros(len(shingles), dtype=bool)
        seen[code[x]] = True
        for z in y[near[np.argsort(-agree[near], kind="stable")]]:
            if named[z] == named[x]:
                continue
            if once[x] and once[z]:
                both = np.count_nonzero(seen[code[z]])
                alike = both / (len(code[x]) + len(code[z]) - both)
            else:
                alike = similarity(of[x], of[z])
            if alike >= THRESHOLD - 1e-12:
                found.append((min(ids[x], ids[z]), max(ids[x], ids[z])))
                named[named == named[z]] = named[x]
        seen[code[x]] = False
    return found


def _few(df: DataFrame, rows: int, each: int) -> DataFrame:
    """``df``, which has about ``rows`` rows, in no more tasks than such a table needs."""
    return df.coalesce(max(2 * df.sparkSession.sparkContext.defaultParallelism, math.ceil(rows / each)))


def _side(table: DataFrame, x: str, *names: str) -> DataFrame:
    return table.select(F.col("id").alias(x), *[F.col(name).alias(f"{x}_{name}") for name in names])


def _linked(near: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) whose bags are similar enough. The side with many partners is joined last, where Spark can split
    it, and goes straight into the verification."""
    both = near.join(_side(texts, "b", "shingles", "counts"), "b").join(_side(texts, "a", "shingles", "counts"), "a")
    both = both.select("a", "b", "a_shingles", "a_counts", "b_shingles", "b_counts")
    return _few(both, near.count(), TASK_TEXTS).mapInArrow(_verified, "a long, b long")


def _open(members: DataFrame, found: DataFrame, rows: int) -> DataFrame:
    """The members of buckets that span several classes, stored: id, key, class_id, major (the bucket's largest class), and
    how many blocks its members outside that class, and all of them, make. ``members`` has id, key and size, the shingles."""
    named = members.join(found, "id", "left").withColumn("class_id", F.coalesce("class_id", "id"))
    sizes = named.groupBy("key", "class_id").agg(F.count("*").alias("n"), F.sum("size").alias("size"))
    sizes = sizes.groupBy("key").agg(F.sum("n").alias("n"), F.sum("size").alias("size"), F.max(F.struct("n", "size", "class_id")).alias("most"))
    blocks = lambda n, size: F.ceil(F.greatest(n / BLOCK, size / ROOM)).cast("int")
    open_ = sizes.where("n > most.n").select(
        "key", F.col("most.class_id").alias("major"), blocks(F.col("n") - F.col("most.n"), F.col("size") - F.col("most.size")).alias("across"),
        blocks(F.col("n"), F.col("size")).alias("down"))
    return written(_few(named.drop("size").join(open_, "key"), rows, TASK_NUMBERS), "open-buckets")


def _blocks(named: DataFrame, drawn: DataFrame, every: bool) -> DataFrame:
    """Blocks of members outside a bucket's largest class by blocks of all members: its key, and an array ``of`` of (minor, id,
    class_id, and the columns of ``drawn``). If not ``every`` block, each member outside the largest class is in one."""
    dealt = lambda seed, n: F.pmod(F.xxhash64(F.lit(seed), "id"), F.col(n)).cast("int")
    cell = lambda minor, i, j: F.struct(F.lit(minor).alias("minor"), i.alias("i"), j.alias("j"))
    upto = lambda n, at: F.transform(F.sequence(F.lit(0), F.col(n) - 1), at)
    if every:
        minors = upto("down", lambda j: cell(True, dealt(1, "across"), j))
        others = upto("across", lambda i: cell(False, i, dealt(2, "down")))
    else:
        minors, others = F.array(cell(True, F.lit(0), dealt(1, "down"))), F.array(cell(False, F.lit(0), dealt(2, "down")))
    cells = F.when(F.col("class_id") != F.col("major"), F.concat(others, minors)).otherwise(others)
    of = F.struct("minor", "id", "class_id", *[c for c in drawn.columns if c != "id"])
    dealt_ = named.select("key", "id", "class_id", F.inline(cells)).join(drawn, "id")
    return dealt_.groupBy("key", "i", "j").agg(F.collect_list(of).alias("of")).select("key", "of")


def components(links: DataFrame) -> DataFrame:
    """Connected components: (id, class_id), the smallest id of each; ids without links are left out.

    Large-star and small-star rounds on tables in the shared folder; a hub's links are only grouped by partial minima and
    joined, never collected.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges = written(_few(edges, links.count(), TASK_NUMBERS), "links")
    before, rows = None, edges.count()
    while True:
        both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        large = _few(large, 2 * rows, TASK_NUMBERS)
        # each node to the smallest of its smaller neighbours, and these to it
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = joined.select(F.inline(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))))
        small = _few(small.where("u <> v"), 2 * rows, TASK_NUMBERS).distinct()
        small = written(_few(small, 2 * rows, TASK_NUMBERS), "links")
        rows, seen = small.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        edges = small
        if (rows, seen) == before:
            break
        before = rows, seen
    roots = edges.select(F.col("v").alias("id"), F.col("v").alias("class_id")).distinct()
    found = edges.select(F.col("u").alias("id"), F.col("v").alias("class_id")).unionByName(roots)
    return written(_few(found, 2 * rows, TASK_NUMBERS), "classes")


def _rows(doc: str, text: str) -> list[Column]:
    """What tells the rows of ``docs`` apart: doc_id (NULL_ID for null) and 128 bits of the text."""
    words = F.col(text).cast("string")
    return [F.coalesce(F.col(doc).cast("long"), F.lit(NULL_ID)).alias("doc"),
            F.xxhash64(words).alias("t1"), F.xxhash64(F.lit(1), words).alias("t2")]


def _classes(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All rows with the row that names their class (doc, name), and these rows (doc, t1, t2), one of each class."""
    ready(docs.sparkSession)
    source = docs.select(*_rows("doc_id", "text"), F.col("text").cast("string").alias("text"))
    signed = written(source.mapInArrow(
        _signed, "doc long, t1 long, t2 long, h1 long, h2 long, empty boolean, keys array<long>, registers binary"), "signatures")
    # one row, and a number, for all copies
    own = signed.groupBy("h1", "h2").agg(F.min(F.struct("doc", "t1", "t2", "empty", "keys", "registers")).alias("x"))
    own = _few(own, signed.count(), TASK_TEXTS)
    own = written(own.select(F.monotonically_increasing_id().alias("id"), "h1", "h2", "x.*"), "representatives")
    rows = own.count()
    spread = own.where("not empty").select("id", F.explode("keys").alias("key"))
    crowd = spread.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    buckets = written(_few(spread.join(crowd, "key"), BANDS * rows, TASK_NUMBERS), "buckets")
    entries = buckets.count()
    central = buckets.groupBy("id").agg(F.sum("n").alias("met"))
    buckets = written(_few(buckets.select("id", "key").join(central, "id"), entries, TASK_NUMBERS), "buckets")
    wanted = buckets.select("id").distinct()
    asked = own.select("id", "doc", "t1", "t2").join(wanted, "id")
    texts = source.join(asked, ["doc", "t1", "t2"]).groupBy("doc", "t1", "t2", "id").agg(F.min("text").alias("text"))
    texts = _few(texts.select("id", "text"), rows, TASK_TEXTS).mapInArrow(_bagged, "id long, shingles array<long>, counts array<int>")
    texts = written(texts, "candidates")
    registers = written(_few(own.select("id", "registers").join(wanted, "id", "left_semi"), rows, TASK_TEXTS), "registers")
    heads = buckets.groupBy("key").agg(F.max(F.struct("met", (-F.col("id")).alias("i"))).alias("h"))
    pairs = buckets.join(heads.select("key", (-F.col("h.i")).alias("a")), "key").where("a <> id")
    pairs = _few(pairs.select("a", F.col("id").alias("b")), entries, TASK_NUMBERS).distinct()
    near = pairs.join(_side(registers, "b", "registers"), "b").join(_side(registers, "a", "registers"), "a")
    near = _few(near.select("a", "b", "a_registers", "b_registers"), entries, TASK_NUMBERS).mapInArrow(_near, "a long, b long")
    links = written(_linked(written(near, "pairs"), texts), "links")
    found = components(links)
    # the head of a bucket has been compared with all of it
    members = buckets.select("id", "key").join(heads.select("key", (-F.col("h.i")).alias("a")), "key").where("a <> id").drop("a")
    members = members.join(texts.select("id", F.size("shingles").alias("size")), "id")
    drawn = None
    for every in False, True:
        open_ = _open(members, found, entries)
        if every:
            open_ = open_.where("down > 1")  # a bucket of one block has been compared
        if open_.isEmpty():
            break
        if drawn is None:  # classes only grow: the second time no other bucket is open
            wide = _few(texts.join(open_.select("id").distinct(), "id", "left_semi"), rows, TASK_TEXTS)
            wide = wide.mapInArrow(_widened, "id long, wide binary")
            drawn = written(_few(own.select("id", "keys").join(wide, "id"), rows, TASK_TEXTS), "registers")
        new = written(_blocks(open_, drawn.join(texts, "id"), every).mapInArrow(_joined, "a long, b long"), "links")
        if not new.isEmpty():
            links = links.unionByName(new)
            found = components(links)
        if open_.where("down > 1").isEmpty():
            break
    named = own.select("id", "h1", "h2", F.struct("doc", "t1", "t2").alias("row")).join(found, "id", "left")
    named = written(_few(named.withColumn("class_id", F.coalesce("class_id", "id")), rows, TASK_NUMBERS), "named")
    least = named.groupBy("class_id").agg(F.min("row").alias("row"))
    of = named.select("h1", "h2", "class_id").join(least, "class_id").select("h1", "h2", F.col("row.doc").alias("name"))
    return signed.select("doc", "h1", "h2").join(of, ["h1", "h2"]).select("doc", "name"), least.select("row.*")


def classes(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id and class_id, the smallest doc_id of its near-duplicate class."""
    rows, _ = _classes(docs)
    return rows.select(*[F.nullif(F.col(x), F.lit(NULL_ID)).alias(y) for x, y in (("doc", "doc_id"), ("name", "class_id"))])


def deduplicated(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` without near duplicates: of each class one row, of those with its smallest doc_id."""
    _, kept = _classes(docs)
    rows = packed(docs)
    rows = rows.select("row", *_rows("row.doc_id", "row.text"))
    return unpacked(rows.join(kept, ["doc", "t1", "t2"], "left_semi").dropDuplicates(["doc", "t1", "t2"]))
