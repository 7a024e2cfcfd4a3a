"""The manifest against a plain tree in Python."""

import hashlib
import random
import zlib

import pytest

from premisa.llm import merkle

SCHEMA = "text string, n_chars long, doc_id long, segment int, lang string, source string, leaf string, tree long"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row, text):
    out = ""
    for v in (row["doc_id"], row["source"], row["lang"], row["n_chars"], text):
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return sha(out)


def climbed(nodes):
    """Top of a tree and, for each leaf, its (left, right) siblings from below."""
    paths, under = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        ups, unders = [], []
        for i in range(0, len(nodes), 3):
            run = nodes[i : i + 3]
            for k in range(len(run)):
                for x in under[i + k]:
                    paths[x].append((run[:k], run[k + 1 :]))
            ups.append(sha("".join(run)))
            unders.append(sum(under[i : i + 3], []))
        nodes, under = ups, unders
    return nodes[0], paths


def expected(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r["source"], []).append(r)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in order:
        held = sorted(groups[s], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf_of(r, r["text"])))
        trees.append((held, *climbed([leaf_of(r, r["text"]) for r in held])))
    root, above = climbed([t[1] for t in trees])
    out = []
    for (held, subroot, paths), upper in zip(trees, above, strict=True):
        for r, path in zip(held, paths, strict=True):
            leaf, path = leaf_of(r, r["text"]), path + upper
            even = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 2 == 0
            at = leaf_of(r, r["text"].replace("\n", "")) if even and r["text"] is not None else leaf
            for left, right in path:
                at = sha("".join(left) + at + "".join(right))
            proof = sha("".join("".join(x) + "".join(y) for x, y in path))
            out.append((r["doc_id"], leaf, subroot, root, proof, at, at == root))
    return sorted(out, key=str)


def rows_of(sizes, seed=3):
    rng = random.Random(seed)
    rows = []
    for source, n in sizes.items():
        for i in range(n):
            text = rng.choice([None, "", "a\nb", "plain", "ä€\n𝄞", "x" * 3000])
            rows.append((text, rng.choice([None, 3]), rng.choice([None, i, i, i, 5]), 1, rng.choice([None, "en", "-"]), source, "x", 9))
    return rows


@pytest.mark.parametrize("sizes", [
    {"a": 1}, {"a": 4, None: 1}, {None: 82, "b": 10, "": 81, "é": 1, "z": 9}, {"hot": 260} | {f"s{i}": 1 + i % 3 for i in range(90)}])
def test_against_a_plain_tree(spark, sizes):
    docs = spark.createDataFrame(rows_of(sizes), SCHEMA).repartition(3)
    got = merkle.verified(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(map(tuple, got.collect()), key=str) == expected(docs.collect())


def test_shuffled_joins_and_salts(spark, monkeypatch):
    monkeypatch.setattr(merkle, "BROADCAST_ROWS", 2)
    docs = spark.createDataFrame(rows_of({"hot": 100, "x": 28, None: 4, "y": 1}), SCHEMA)
    assert sorted(map(tuple, merkle.verified(docs).collect()), key=str) == expected(docs.collect())


def test_repeated_rows_and_empty_table(spark):
    one = ("same\ntext", 9, 4, 1, "en", "a", "x", 9)
    docs = spark.createDataFrame([one] * 20, SCHEMA)
    assert sorted(map(tuple, merkle.verified(docs).collect()), key=str) == expected(docs.collect())
    assert merkle.verified(docs.limit(0)).collect() == []


def test_deep_tree(spark):
    """A tree of more than eight levels, which takes three rounds of blocks."""
    docs = spark.range(7000).selectExpr("id as doc_id", "'s' as source", "'en' as lang", "id as n_chars", "concat('t\\n', id) as text")
    assert sorted(map(tuple, merkle.verified(docs).collect()), key=str) == expected(docs.collect())
