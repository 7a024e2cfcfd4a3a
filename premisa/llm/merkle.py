"""Merkle manifest of a table: a digest tree over its rows for each source, a tree over the sources, a proof for each row.

Rows are hashed where they are read. Their places come from one range shuffle (``premisa.ordering``). The trees, of fan-out
three, are built in blocks of 81 neighbours, four levels at a time, so each round passes on one node in 81.

Proofs come from pointer jumping. Each node starts with a pointer to its parent and the digests of its siblings. In round k
a node at a level that 2**(k+1) divides takes the segment of the node that its pointer of distance 2**k leads to, and
points 2**(k+1) levels up; after about log2(depth) self-joins every leaf has reached its root. A pointer of distance d is shared by at
most 3**d leaves, so no key of these joins is hot while the other side is large; a small one is counted and broadcast.

Defined cases: a null field is hashed as ``-``; null doc_ids come first within their source, the null source first among
the sources; rows with equal doc_ids stand in the order of their digests; equal rows have proofs of their own; an empty
table gives an empty result; columns that are not among the hashed ones are not read. A null doc_id is never tampered with.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from premisa.llm.common import written
from premisa.ordering import positioned

FAN_OUT = 3
#: Levels built at once: a block holds FAN_OUT**LEVELS neighbours, 81 rows of about 150 bytes.
LEVELS = 4
BLOCK = FAN_OUT**LEVELS
#: Rows of one side of a join that may be broadcast, about 100 bytes for each level of their segments.
BROADCAST_ROWS = 20_000
SALTS = 32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def encoded(columns: list[Column]) -> Column:
    """The fields of a row as one string: ``-`` for null, else the number of UTF-8 bytes, ``:`` and the value."""
    each = [c.cast("string") for c in columns]
    return F.concat(*[F.coalesce(F.concat(F.octet_length(c).cast("string"), F.lit(":"), c), F.lit("-")) for c in each])


def digest(text: Column) -> Column:
    return F.unhex(F.sha2(text, 256))


def _hex(data: Column) -> Column:
    return F.lower(F.hex(data))


def leaves(docs: DataFrame, tampered_text: Column, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """row_id, doc_id, source, leaf and the leaf of the tampered row (null where the text is as it was), stored."""
    of = lambda text: [text if f == "text" else F.col(f"`{f}`") for f in fields]
    changed = ~tampered_text.eqNullSafe(F.col("text"))
    found = docs.select(
        F.monotonically_increasing_id().alias("row_id"), F.col("doc_id"), F.col("source").cast("string").alias("source"),
        digest(encoded(of(F.col("text")))).alias("leaf"),
        F.when(changed, digest(encoded(of(tampered_text)))).alias("tampered"),
    )
    return written(found, "leaves")


class Forest:
    """Trees over nodes (tree, idx, size, digest, payload): idx from 0 within its tree, size the leaves of the tree."""

    def __init__(self, nodes: DataFrame):
        self.payload = nodes.schema["payload"].dataType
        self.blocks: list[DataFrame] = []
        while True:
            self.blocks.append(self._round(nodes))
            rest = self.blocks[-1].where("size_up > 1")
            if rest.isEmpty():
                break
            nodes = rest.select(
                "tree", F.col("block").alias("idx"), F.col("size_up").alias("size"), F.element_at("levels", -1)[0].alias("digest"),
                F.lit(None).cast(self.payload).alias("payload"))
        self.depth = LEVELS * len(self.blocks)

    @staticmethod
    def _round(nodes: DataFrame) -> DataFrame:
        """Blocks of neighbours, stored: tree, block, size, members, levels (digests of 0 to LEVELS levels above), size_up."""
        member = F.struct("idx", "digest", "payload")
        of = nodes.groupBy("tree", F.expr(f"idx div {BLOCK}").alias("block")).agg(
            F.max("size").alias("size"), F.sort_array(F.collect_list(member)).alias("members"))
        run = "array_join(transform(slice(below, 3 * i + 1, 3), d -> lower(hex(d))), '')"
        up = f"transform(sequence(0, (size(below) - 1) div 3), i -> unhex(sha2({run}, 256)))"
        # a tree goes on while more than one node remains in all of it
        step = f"if(ceil(size / power(3D, j)) > 1, transform(array(element_at(done, -1)), below -> {up})[0], array())"
        levels = (f"aggregate(sequence(0, {LEVELS - 1}), array(transform(members, m -> m.digest)), "
                  f"(done, j) -> concat(done, array(cast({step} as array<binary>))))")
        of = of.select("tree", "block", "size", "members", F.expr(levels).alias("levels"))
        above = F.expr(f"cast(ceil(size / power(3D, {LEVELS})) as bigint)")
        return written(of.withColumn("size_up", above), "blocks")

    def tops(self) -> DataFrame:
        """tree, digest: the last node of each tree, found in the block with which it ends."""
        found = [b.where("size_up = 1").select("tree", F.expr("filter(levels, x -> size(x) > 0)").alias("x")) for b in self.blocks]
        every = found[0]
        for x in found[1:]:
            every = every.unionByName(x)
        return every.select("tree", F.element_at("x", -1)[0].alias("digest"))

    def pointers(self, number: int) -> DataFrame:
        """tree, level, idx, segment (digests of the siblings left and right) of the nodes of one round that have a parent."""
        left = "unhex(array_join(transform(slice(x, k - k % 3 + 1, k % 3), d -> hex(d)), ''))"
        right = "unhex(array_join(transform(slice(x, k + 2, 2 - k % 3), d -> hex(d)), ''))"
        node = (f"struct(cast(j as int) as j, block * cast(power(3D, {LEVELS} - j) as bigint) + k as idx, "
                f"array({left}, {right}) as segment, if(j = 0, members[k].digest, null) as digest, if(j = 0, members[k].payload, null) as payload)")
        nodes = (f"flatten(transform(slice(levels, 1, {LEVELS}), (x, j) -> if(ceil(size / power(3D, j)) > 1, "
                 f"transform(x, (d, k) -> {node}), array())))")
        found = self.blocks[number].select("tree", F.explode(F.expr(nodes)).alias("n"))
        return found.select("tree", (F.col("n.j") + LEVELS * number).alias("level"), "n.idx", "n.segment", "n.digest", "n.payload")

    def proofs(self) -> DataFrame:
        """tree, digest, payload, segment: each leaf with the siblings on its way to the top, from below."""
        first = self.pointers(0)
        # a tree of one leaf has no pointer
        alone = self.blocks[0].where("size = 1").select(
            "tree", F.lit(0).alias("level"), F.lit(0).cast("long").alias("idx"), F.array().cast("array<binary>").alias("segment"),
            F.expr("members[0].digest").alias("digest"), F.expr("members[0].payload").alias("payload"))
        leaf = first.where("level = 0").unionByName(alone)
        upper = first.where("level > 0")
        for k in range(1, len(self.blocks)):
            upper = upper.unionByName(self.pointers(k))
        upper = written(upper.select("tree", "level", "idx", "segment"), "pointers")
        distance = 1
        while distance < self.depth:
            far = f"level % {2 * distance} = {distance}"
            leaf = _jumped(leaf, upper.where(f"level = {distance}"), distance)
            if 2 * distance < self.depth:
                stay = upper.where(f"level % {2 * distance} = 0")
                upper = written(_jumped(stay, upper.where(far), distance), "pointers")
            distance *= 2
        return leaf.drop("level", "idx")


def _jumped(nodes: DataFrame, ancestors: DataFrame, distance: int) -> DataFrame:
    """``nodes``, whose pointers lead ``distance`` levels up, with the segments of the nodes found there appended."""
    found = ancestors.select(F.col("tree").alias("_tree"), F.col("level").alias("_level"), F.col("idx").alias("_idx"), F.col("segment").alias("_more"))
    if found.count() <= BROADCAST_ROWS:
        found = F.broadcast(found)
    up = F.expr(f"idx div {FAN_OUT**distance}") if FAN_OUT**distance < 1 << 63 else F.lit(0).cast("long")
    here = (F.col("tree") == F.col("_tree")) & (F.col("level") + distance == F.col("_level")) & (up == F.col("_idx"))
    more = F.coalesce("_more", F.array().cast("array<binary>"))
    joined = nodes.join(found, here, "left").withColumn("segment", F.concat("segment", more))
    return joined.drop("_tree", "_level", "_idx", "_more")


def folded(start: Column, segment: Column) -> Column:
    """The top that a leaf (hexadecimal digest) and its siblings lead to."""
    steps = F.call_function("div", F.size(segment), F.lit(2)).cast("int")
    at = lambda i: _hex(F.get(segment, i))
    pairs = F.transform(F.sequence(F.lit(1), steps), lambda i: F.struct(at(2 * i - 2).alias("l"), at(2 * i - 1).alias("r")))
    pairs = F.when(steps > 0, pairs).otherwise(F.array())
    return F.aggregate(pairs, start, lambda acc, x: F.sha2(F.concat(x["l"], acc, x["r"]), 256))


def _with_source(rows: DataFrame, sources: DataFrame, number: int, same, names: list[str]) -> DataFrame:
    """``rows`` joined with a row of each source; few sources are broadcast, else both sides are dealt by a salt as well."""
    if number <= BROADCAST_ROWS:
        return rows.join(F.broadcast(sources), same).drop(*names)
    salted = sources.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    dealt = rows.withColumn("_deal", F.expr(f"cast(rand(7) * {SALTS} as int)"))
    return dealt.join(salted, same & (F.col("_deal") == F.col("_salt"))).drop("_salt", "_deal", *names)


def manifest(docs: DataFrame, tampered_text: Column, fields: tuple[str, ...] = FIELDS) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, leaf, tampered, subroot, root (hexadecimal) and segment, its proof."""
    rows = positioned(leaves(docs, tampered_text, fields), [
        F.col("source").asc_nulls_first(), F.col("doc_id").asc_nulls_first(), F.col("leaf"), F.col("row_id")], "pos", "leaves")
    sources = written(rows.groupBy("source").agg(F.min("pos").alias("first"), F.count("*").alias("size")), "sources")
    sources = positioned(sources, [F.col("source").asc_nulls_first()], "tree", "sources")
    sources = sources.select(F.col("source").alias("_source"), "first", "size", "tree")
    number = sources.count()
    placed = _with_source(rows, sources, number, F.col("source").eqNullSafe(F.col("_source")), ["_source"])
    forest = Forest(placed.select(
        "tree", (F.col("pos") - F.col("first")).alias("idx"), "size", F.col("leaf").alias("digest"),
        F.struct("doc_id", "source", "tampered").alias("payload")))
    tops = written(forest.tops(), "subroots")
    over = Forest(tops.select(
        F.lit(0).cast("long").alias("tree"), F.col("tree").alias("idx"), F.lit(number).cast("long").alias("size"), "digest",
        F.struct(F.col("tree").alias("of")).alias("payload")))
    top = over.tops().first()
    root = bytes(top["digest"]) if top else None
    subroots = over.proofs().select(F.col("payload.of").alias("_of"), F.col("digest").alias("subroot"), F.col("segment").alias("_above"))
    subroots = written(subroots.withColumn("root", F.lit(root).cast("binary")), "subroots")
    found = _with_source(forest.proofs(), subroots, number, F.col("tree") == F.col("_of"), ["_of"])
    return found.select(
        "payload.doc_id", "payload.source", _hex(F.col("digest")).alias("leaf"), _hex(F.col("payload.tampered")).alias("tampered"),
        _hex(F.col("subroot")).alias("subroot"), _hex(F.col("root")).alias("root"), F.concat("segment", "_above").alias("segment"))


def without_newlines(doc_id: Column, text: Column) -> Column:
    """The tampering to be detected: texts of rows whose doc_id has an even CRC-32 lose their line feeds."""
    even = F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0
    return F.when(even, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)


def verified(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: its digests and proof, and whether the tampered row still leads to the root."""
    found = manifest(docs, without_newlines(F.col("doc_id"), F.col("text").cast("string")))
    proof = F.sha2(F.array_join(F.transform("segment", _hex), ""), 256)
    found = found.select(
        "doc_id", "leaf", "subroot", "root", proof.alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("segment")).alias("folded_root"))
    return found.withColumn("verified", F.col("folded_root") == F.col("root"))
