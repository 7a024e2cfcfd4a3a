"""Secret scan: candidates by shape, false positives removed by a random forest. DataFrame functions only.

A candidate is every run of at least twelve token characters of a word that holds a digit or is assigned to a name, and the
whole right side of an assignment to a credential name (or the password of a login in an address) whatever its length and
symbols; a right side ends at its closing quote, or without quotes at a quote, comma, semicolon, ampersand or the word's end.
Its features are its length and make-up, how likely its letters follow each other in prose, the share of its letters that stand in
dictionary words, the words around it and the path (source) it was found in. Letter transitions and the dictionary are counted
over all words of all documents, of any script; a word is in the dictionary if one language has it ``LEAST_COUNT`` times.

Candidates are rows of their own from the moment they are found (texts are split once and never shuffled for it), so the
dictionary is looked up by a join of their distinct letter runs. The forest is trained here on labelled findings; no table of the
data has any, so ``labelled_texts`` makes a bounded set of texts from templates with known answers (``FINDINGS`` rows; keys of
common issuers, assigned passwords and tokens; against them numbers, hashes, identifiers, dates, placeholders, test
fixtures), which go through the same scan. The trained trees are arrays that one expression walks.

Defined cases: null and empty texts hold no secret; a null source is an ordinary path; a secret is masked wherever its
value occurs in the document (one of under twelve characters only where no letter or digit is next to it);
repeated rows are scanned each; other columns pass through ``masked`` untouched; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from premisa.llm.common import WORD_BREAK, packed, tree_nodes, unpacked, words, written

LEAST_LENGTH = 12
LEAST_COUNT = 20
#: Frequent words that the made texts are written with.
POOL = 200
FINDINGS = 6000
TREES, DEPTH, SEED = 20, 6, 7
CUTOFF = 0.5
#: Bytes of secrets that may be broadcast for masking.
BROADCAST_BYTES = 32 << 20
MASK = "[SECRET]"

# Shapes and words.
RUN = r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+|[A-Za-z0-9+/_-]{12,}={0,2}"
NAME = r"(?i:pass(?:word|wd)?|pwd|secret|token|api_?key|auth|credential|private|access)[_A-Za-z0-9-]{0,20}[\"']?[=:]{1,2}"
PLAIN = r"[^\"'&,;]*[^\"'&,;.:)\]}>]"
ASSIGNED = (rf"(?<=[=:\"'])(?:(?<={NAME}\")[^\"]+(?=\"|$)|(?<={NAME}')[^']+(?='|$)|(?<={NAME}){PLAIN}"
            r"|(?<=://[^\s/:@]{0,64}:)[^@/\s]+(?=@))")
#: For a word whose assignment is in the words before it.
RIGHT_SIDE = rf"(?<=^\")[^\"]+(?=\"|$)|(?<=^')[^']+(?='|$)|^{PLAIN}"
LOGIN = r"://[^\s/:@]*:$"
ISSUERS = r"^(AKIA|ASIA)[A-Z0-9]{16}$|^gh[pousr]_[A-Za-z0-9]{36}$|^xox[abprs]-|^eyJ[A-Za-z0-9_-]+\\.|^sk_live_|^AIza"
CREDENTIAL = r"(?i)(pass|passwd|password|pwd|secret|token|api_?key|auth|credential|private|access)[_a-z]*[^a-z]*$"
HARMLESS = r"(?i)(example|sample|dummy|test|fake|sha|commit|revision|md5|checksum|digest|uuid|card|account|order|invoice|build|version|file|id)[^a-z]*$"
PATHS = r"(?i)(test|example|fixture|mock|sample|docs?/)"
ALPHABET = "abcdefghijklmnopqrstuvwxyz0123456789"
CLASSES = 28  # a to z, a digit, anything else

FEATURES = (
    "length", "transitions", "coverage", "digits", "capitals", "symbols", "distinct", "switches", "hexadecimal",
    "issuer", "credential", "harmless", "quoted", "assigned", "path",
)


def corpus_words(docs: DataFrame) -> DataFrame:
    """Every distinct word of letters, in lower case, with its counts over all documents and in the language that has it most."""
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    each = docs.select(lang.alias("lang"), F.explode(words(F.col("text").cast("string"))).alias("w"))
    each = each.groupBy("lang", "w").agg(F.count("*").alias("n")).where(r"w rlike '^\\p{L}+[.,;:!?]?$'")
    each = each.groupBy("lang", F.expr(r"lower(rtrim('.,;:!?', w))").alias("w")).agg(F.sum("n").alias("n"))
    return each.groupBy("w").agg(F.sum("n").alias("n"), F.max("n").alias("most"))


def transitions(counts: DataFrame) -> list[float]:
    """Log probabilities of the transitions between character classes, CLASSES squared."""
    pairs = counts.select("n", F.expr(f"transform(split(w, ''), c -> {_class('c')})").alias("c")).select(
        "n", F.explode(F.expr(f"transform(slice(c, 2, size(c)), (x, i) -> c[i] * {CLASSES} + x)")).alias("c"))
    seen = {r["c"]: r["n"] for r in pairs.groupBy("c").agg(F.sum("n").alias("n")).collect()}  # CLASSES squared at most
    table = []
    for a in range(CLASSES):
        row = [seen.get(a * CLASSES + b, 0) + 0.5 for b in range(CLASSES)]
        table += [round(math.log(x / sum(row)), 4) for x in row]
    return table


def _literal(pattern: str) -> str:
    return "'" + pattern.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _class(c: str) -> str:
    return (f"case when {c} between 'a' and 'z' then ascii({c}) - 97 when {c} between '0' and '9' then 26 else 27 end")


def _let(value: str, name: str, use: str) -> str:
    """Bind ``value`` once: a lambda variable is computed once, a repeated expression may not be."""
    return f"transform(array({value}), {name} -> {use})[0]"


def candidates(docs: DataFrame, path: str = "source") -> DataFrame:
    """One row per candidate, stored: doc_id, t1 and t2 (128 bits of the text), path, at (number of the word), start (code
    points from 0), head (the word before the value), value, assigned, before2, before."""
    text = F.col("text").cast("string")
    source = F.col(path).cast("string") if path in docs.columns else F.lit(None).cast("string")
    df = docs.select(
        F.monotonically_increasing_id().alias("row_id"), "doc_id", source.alias("path"), F.xxhash64(text).alias("t1"),
        F.xxhash64(F.lit(1), text).alias("t2"), F.coalesce(text, F.lit("")).alias("text"))
    # an assignment inside the word, one that ends before it, or a long word with a digit
    last = "rtrim('\\x22\\x27', coalesce(get(w, i - 1), ''))".replace("\\x22", '"').replace("\\x27", "\\'")
    shape = (f"(instr(x, '=') > 0 or instr(x, ':') > 0) and x rlike '[=:].' or length(x) >= {LEAST_LENGTH} and x rlike '[0-9]' "
             f"or {last} like '%=' or {last} like '%:'")
    place = "struct(i as at, x as word, coalesce(get(w, i - 2), '') as before2, coalesce(get(w, i - 1), '') as before)"
    split = f"filter(split(text, {_literal(WORD_BREAK)}), x -> x <> '')"
    found = _let(split, "w", f"filter(transform(w, (x, i) -> if({shape}, {place}, null)), p -> p is not null)")
    # code points from the last such word (or the text's start) on: words with the white space behind them, added up
    edge = r"(?<=[\x20\x09-\x0D])(?=[^\x20\x09-\x0D])"
    gap = ("aggregate(slice(s, if(k = 0, 0, p[k - 1].at + lead) + 1, x.at + lead - if(k = 0, 0, p[k - 1].at + lead)), 0L, (a, y) -> a + length(y))")
    located = _let("if(text rlike '^[\\\\x20\\\\x09-\\\\x0D]', 1, 0)", "lead", _let(f"split(text, {_literal(edge)})", "s", (
        f"transform(p, (x, k) -> struct(x.at as at, x.word as word, x.before2 as before2, x.before as before, {gap} as gap))")))
    located = _let(found, "p", f"if(size(p) = 0, null, {located})")
    each = df.select("row_id", "doc_id", "path", "t1", "t2", F.explode(F.expr(located)).alias("p"))
    each = written(each.select("row_id", "doc_id", "path", "t1", "t2", "p.*"), "places")
    # values between marks: first the right sides of assignments, then the runs in what is left
    after = f"concat(before2, before) rlike {_literal(f'{NAME}[{chr(34)}{chr(39)}]?$')}"
    marked = "'\x01$0\x01'"
    plain = "translate(word, '\x01', '\x02')"
    sides = (f"split(case when {after} then regexp_replace({plain}, {_literal(f'{RIGHT_SIDE}|{ASSIGNED}')}, {marked}) "
             f"when word rlike '[=:].' then regexp_replace({plain}, {_literal(ASSIGNED)}, {marked}) else {plain} end, '\x01', -1)")
    split_run = f"split(regexp_replace(s, {_literal(RUN)}, {marked}), '\x01', -1)"
    pieces = (f"flatten(transform({sides}, (s, k) -> if(k % 2 = 1, array(struct(s as value, 'a' as kind)), "
              f"transform({split_run}, (r, m) -> struct(r as value, if(m % 2 = 1, 'r', '') as kind)))))")
    values = _let(pieces, "p", (
        "filter(transform(p, (v, k) -> if(v.kind = '' or v.value = '', null, struct(concat_ws('', transform(slice(p, 1, k), y -> y.value)) as head, "
        "v.value as value, v.kind = 'a' as assigned))), c -> c is not null)"))
    first = F.sum("gap").over(Window.partitionBy("row_id").orderBy("at"))
    each = each.withColumn("first", first).withColumn("c", F.explode(F.expr(values)))
    each = each.select(
        "doc_id", "t1", "t2", "path", F.col("at").cast("long").alias("at"), (F.col("first") + F.length("c.head")).alias("start"),
        "c.head", "c.value", "c.assigned", "before2", "before")
    return written(each.where("assigned or value rlike '[0-9]' or head rlike '[=:]' or before rlike '[=:]$'"), "secret-candidates")


def coverage(found: DataFrame, dictionary: DataFrame) -> DataFrame:
    """value, covered: the share of each distinct value's characters that stand in runs of letters which are dictionary words."""
    runs = r"regexp_extract_all(value, '\\p{Lu}?\\p{Ll}+|\\p{Lu}+(?!\\p{Ll})|\\p{Lo}+', 0)"
    each = found.select("value").distinct().select("value", F.explode(F.expr(f"transform(filter({runs}, x -> length(x) > 2), x -> lower(x))")).alias("w"))
    # distinct runs first: a frequent one meets the dictionary once
    known = written(each.select("w").distinct().join(dictionary.select("w"), "w", "left_semi"), "known")
    each = each.groupBy("w", "value").agg(F.count("*").alias("times")).join(known, "w", "left_semi")
    return each.groupBy("value").agg(F.sum(F.length("w") * F.col("times")).alias("letters")).select(
        "value", (F.col("letters").cast("double") / F.length("value")).alias("covered"))


def featured(found: DataFrame, table: list[float], dictionary: DataFrame) -> DataFrame:
    """The stored candidates with a column for each of FEATURES, stored."""
    of = written(coverage(found, dictionary), "coverage")
    low = "lower(value)"
    share = lambda kept: f"cast(length(regexp_replace(value, '{kept}', '')) as double) / length(value)"
    around = "concat_ws(' ', before2, before, head)"
    codes = f"transform(split({low}, ''), c -> {_class('c')})"
    steps = f"aggregate(slice(c, 2, size(c)), struct(0D as total, c[0] as last), (a, x) -> struct(a.total + log_odds[a.last * {CLASSES} + x] as total, x as last), a -> a.total)"
    sql = {
        "length": "cast(least(length(value), 200) as double)",
        "transitions": f"if(length(value) < 2, 0D, {_let(codes, 'c', steps)} / (length(value) - 1))",
        "coverage": "coalesce(covered, 0D)",
        "digits": share("[^0-9]"),
        "capitals": share("[^A-Z]"),
        "symbols": share("[A-Za-z0-9]"),
        "distinct": "cast(size(array_distinct(split(value, ''))) as double) / length(value)",
        "switches": "cast(length(regexp_replace(regexp_replace(value, '[0-9]+', '0'), '[^0]+', 'a')) as double) / length(value)",
        "hexadecimal": f"if({low} rlike '^[0-9a-f]+$' and {low} rlike '[a-f]', 1D, 0D)",
        "issuer": f"if(value rlike '{ISSUERS}', 1D, 0D)",
        "credential": f"if({around} rlike '{CREDENTIAL}' or assigned and head rlike {_literal(LOGIN)}, 1D, 0D)",
        "harmless": f"if({around} rlike '{HARMLESS}' or {low} rlike '(example|sample|dummy|xxxx|your)', 1D, 0D)",
        "quoted": "if(head rlike '[\"\\\\x27]$', 1D, 0D)",
        "assigned": "if(head rlike '[=:][\"\\\\x27]?$' or before rlike '[=:]$', 1D, 0D)",
        "path": f"if(coalesce(path, '') rlike '{PATHS}', 1D, 0D)",
    }
    joined = found.join(of, "value", "left").withColumn("log_odds", F.expr(_numbers(table)))
    return written(joined.select(*found.columns, *[F.expr(x).alias(f"f_{name}") for name, x in sql.items()]), "featured")


def labelled_texts(spark: SparkSession, pool: list[str], rows: int = FINDINGS) -> DataFrame:
    """``rows`` texts with known answers: doc_id, text, source, secret (the value in it that is one; null if none is)."""
    plain_words = F.split(F.lit(" ".join(pool or ["name", "value", "item"])), " ")
    size = len(pool or "xxx")
    word = lambda k: f"pool[cast(pmod(hash(id, {k}), {size}) as int)]"
    pick = lambda k, *of: f"element_at(array({', '.join(of)}), 1 + cast(pmod(hash(id, {k}), {len(of)}) as int))"
    between = lambda k, low, high: f"cast({low} + pmod(hash(id, {k}), {high - low + 1}) as int)"
    quoted = lambda *of: [f"'{x}'" for x in of]
    # the ingredients are stored, so that no expression holds another more than once
    made = spark.range(0, rows, 1, 1).withColumn("pool", plain_words)
    made = made.select("id", *[F.expr(word(k)).alias(f"w{k}") for k in range(1, 8)], *[F.expr(x).alias(name) for name, x in {
        "hexa": "concat(sha2(cast(id as string), 256), sha2(concat('b', id), 256))",
        "mixed": "translate(base64(unhex(sha2(concat('m', id), 512))), '=\\n\\r', '')",
        "digits": "concat(abs(xxhash64(id, 1)), abs(xxhash64(id, 2)), abs(xxhash64(id, 3)))",
        "name": pick(11, *quoted("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "auth_token", "client_secret", "access_key")),
        "quiet": pick(16, *quoted("commit", "sha256:", "md5", "checksum", "revision", "digest", "build", "uuid")),
        "number": pick(19, *quoted("card", "account", "order", "invoice", "id")),
        "sign": pick(24, "''", "'!'", "'@'", "'#'", "'$'"),
        "close": pick(27, "''", "'$'", "'#x'"),
        "fill": pick(23, *quoted("your_api_key_here", "xxxxxxxxxxxxxxxx1", "example_password_1", "changeme_changeme")),
    }.items()])
    made = written(made, "findings").withColumn("plain", F.expr("translate(mixed, '+/', 'xY')")).withColumn("upper", F.expr("translate(upper(mixed), '+/0189', 'KMQWER')"))
    made = made.select("*", *[F.expr(x).alias(name) for name, x in {
        "value": pick(12, f"substr(hexa, 1, {between(13, 16, 64)})", f"substr(plain, 1, {between(14, 14, 44)})", f"substr(mixed, 1, {between(15, 16, 44)})"),
        "short": f"concat(initcap(substr(w7, 1, 4)), sign, substr(plain, 1, {between(26, 3, 9)}), pmod(id, 90) + 10, close)",
        "issued": pick(28, "concat('AKIA', substr(upper, 1, 16))", "concat('ghp_', substr(plain, 1, 36))"),
        "token": pick(17, "concat('ghp_', substr(plain, 1, 36))", "concat('xoxb-', substr(digits, 1, 12), '-', substr(plain, 1, 24))", "concat('sk_live_', substr(plain, 1, 24))", "concat('AIza', substr(plain, 1, 35))"),
        "uuid": "concat_ws('-', substr(hexa, 1, 8), substr(hexa, 9, 4), substr(hexa, 13, 4), substr(hexa, 17, 4), substr(hexa, 21, 12))",
    }.items()])
    made = written(made, "findings")
    # (text, the secret in it or null, path or null)
    kinds = [
        ("concat('AKIA', substr(upper, 1, 16))", "concat('AKIA', substr(upper, 1, 16))", None),
        ("token", "token", None),
        ("concat(name, '=', value)", "value", None),
        ("concat(name, ' = \"', value, '\"')", "value", None),
        ("concat(name, ': ', value)", "value", None),
        ("concat(name, ' ', value)", "value", None),
        (f"substr(digits, 1, {between(18, 12, 20)})", None, None),
        (f"concat(number, ' ', substr(digits, 1, {between(20, 12, 18)}))", None, None),
        (f"concat(quiet, ' ', substr(hexa, 1, {pick(21, '32', '40', '64')}))", None, None),
        ("concat(if(pmod(id, 2) = 0, 'uuid ', ''), uuid)", None, None),
        ("concat(w3, '_', w4, '_', w5, pmod(id, 100))", None, None),
        ("concat(w3, initcap(w4), initcap(w5), pmod(id, 1000))", None, None),
        ("concat(2000 + pmod(id, 30), '-0', 1 + pmod(id, 9), '-1', pmod(id, 9), 'T1', pmod(id, 9), '-00')", None, None),
        ("concat(w3, '-', w4, '-', 2000 + pmod(id, 30), '-v', pmod(id, 9))", None, None),
        ("concat(name, '=', fill)", None, None),
        ("concat(name, '=', value)", None, "'tests/fixtures/settings.py'"),
        ("concat(w6, ': ', w3, w4, w5)", None, None),
        ("concat(name, '=', short)", "short", None),
        ("concat(name, '=\"', short, '\"')", "short", None),
        ("concat('{\"', name, '\":\"', issued, '\",\"', w3, '\":1}')", "issued", None),
        ("concat('{\"key\":\"', issued, '\",\"', w3, '\":1}')", "issued", None),
        ("concat(w3, ',', issued, ',', w4)", "issued", None),
        ("concat('postgres://', w3, ':', short, '@', w4, ':5432/app')", "short", None),
        ("concat(name, '=', w3)", None, None),
        ("concat(name, ': ', w3)", None, None),
    ]
    case = lambda of: "case " + " ".join(f"when pmod(id, {len(kinds)}) = {k} then {x}" for k, x in enumerate(of)) + " end"
    return written(made.select(
        F.col("id").alias("doc_id"), F.expr(f"concat(w1, ' ', w2, ' ', {case(t for t, _, _ in kinds)}, ' ', w6)").alias("text"),
        F.expr(case(s or "null" for _, s, _ in kinds)).alias("secret"),
        F.expr(case(p or "concat('src', pmod(id, 20))" for _, _, p in kinds)).alias("source")), "findings")


def trained(spark: SparkSession, table: list[float], dictionary: DataFrame, rows: int = FINDINGS) -> RandomForestClassificationModel:
    """A forest that tells secrets from other candidates, fitted on the candidates of the labelled texts."""
    pool = [r["w"] for r in dictionary.where("length(w) >= 3").orderBy(F.desc("n"), "w").limit(POOL).collect()]
    texts = labelled_texts(spark, pool, rows)
    found = featured(candidates(texts), table, dictionary).join(texts.select("doc_id", "secret"), "doc_id")
    flat = found.select(F.expr("if(value <=> secret, 1D, 0D)").alias("label"), *[f"f_{x}" for x in FEATURES])
    vectors = VectorAssembler(inputCols=[f"f_{x}" for x in FEATURES], outputCol="features").transform(flat)
    # one partition in one order: the same forest on any cluster
    vectors = vectors.select("label", "features").coalesce(1).sortWithinPartitions("label", *[f"f_{x}" for x in FEATURES])
    return RandomForestClassifier(numTrees=TREES, maxDepth=DEPTH, seed=SEED, cacheNodeIds=False).fit(vectors)


def _numbers(values: list[float]) -> str:
    """A constant array of doubles, written as one string: a small plan, folded once."""
    return f"cast(split('{','.join(map(repr, values))}', ',') as array<double>)"


def score(model: RandomForestClassificationModel) -> Column:
    """The share of trees that say secret. All nodes are one array, five numbers each: feature (-1 in a leaf), threshold, the
    places of both children, and what a leaf says; a row walks down each tree from its root."""
    nodes: list[float] = []
    roots: list[float] = []
    for tree in model.trees:
        roots.append(float(len(nodes)))
        for feature, at_most, left, right, says in tree_nodes(tree):
            nodes += [float(feature), at_most, roots[-1] + 5 * left, roots[-1] + 5 * right, says]
    child = "if(f[cast(nodes[n] as int)] <= nodes[n + 1], nodes[n + 2], nodes[n + 3])"
    leaf = f"aggregate(sequence(1, {DEPTH}), cast(r as int), (n, i) -> if(nodes[n] < 0, n, cast({child} as int)), n -> nodes[n + 4])"
    whole = f"aggregate({_numbers(roots)}, 0D, (a, r) -> a + {leaf}) / {len(roots)}D"
    return F.expr(_let(_numbers(nodes), "nodes", _let(f"array({', '.join(f'f_{x}' for x in FEATURES)})", "f", whole)))


def scanned(docs: DataFrame, path: str = "source") -> DataFrame:
    """One row per secret, stored: the columns of its candidate (see ``candidates``), score, kind."""
    spark = docs.sparkSession
    counts = written(corpus_words(docs), "words")
    table, dictionary = transitions(counts), written(counts.where(f"most >= {LEAST_COUNT}"), "dictionary")
    found = featured(candidates(docs, path), table, dictionary)
    kind = "case when value like 'AKIA%' or value like 'ASIA%' then 'access key' when f_issuer > 0 then 'issued token' when f_credential > 0 then 'credential' else 'other' end"
    judged = found.select("doc_id", "t1", "t2", "path", "at", "start", "value", score(trained(spark, table, dictionary)).alias("score"), F.expr(kind).alias("kind"))
    return written(judged.where(F.col("score") >= CUTOFF), "secrets")


def secrets(docs: DataFrame) -> DataFrame:
    """One row per secret: doc_id, word_index, start (code points, from 0), length, kind, score, value_sha256."""
    return scanned(docs).select(
        "doc_id", F.col("at").alias("word_index"), F.col("start").cast("long").alias("start"), F.length("value").cast("long").alias("length"),
        "kind", F.round("score", 4).alias("score"), F.sha2("value", 256).alias("value_sha256"))


def masked(docs: DataFrame) -> DataFrame:
    """``docs`` with every secret's value replaced by MASK; n_chars, where it is a column, follows the text."""
    found = scanned(docs).select("t1", "t2", "path", "value").distinct()
    found = found.groupBy("t1", "t2", "path").agg(F.collect_set("value").alias("values"), F.sum(F.octet_length("value") + 48).alias("bytes"))
    found = written(found, "values")
    size = found.agg(F.sum("bytes")).first()[0] or 0
    found = found.select("t1", "t2", F.col("path").alias("p"), "values")
    if size <= BROADCAST_BYTES:
        found = F.broadcast(found)
    text = F.col("row.text").cast("string")
    path = F.col("row.source").cast("string") if "source" in docs.columns else F.lit(None).cast("string")
    rows = packed(docs)
    same = (F.xxhash64(text) == found["t1"]) & (F.xxhash64(F.lit(1), text) == found["t2"]) & path.eqNullSafe(F.col("p"))
    rows = rows.join(found, same, "left")
    values = "array_sort(values, (a, b) -> case when length(a) <> length(b) then length(b) - length(a) when a < b then -1 when a > b then 1 else 0 end)"
    # a short value only where it stands alone
    alone = r"concat('(?<![A-Za-z0-9])\\Q', replace(v, '\\E', '\\E\\\\E\\Q'), '\\E(?![A-Za-z0-9])')"
    masking = f"if(length(v) < {LEAST_LENGTH}, regexp_replace(t, {alone}, '{MASK}'), replace(t, v, '{MASK}'))"
    clean = F.expr(f"aggregate({values}, cast(row.text as string), (t, v) -> {masking})")
    rows = rows.withColumn("text", F.when(F.col("values").isNotNull(), clean).otherwise(text))
    row = F.col("row").withField("text", F.col("text").cast(docs.schema["text"].dataType))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        row = row.withField("n_chars", F.when(F.col("values").isNotNull(), F.length("text").cast(kind)).otherwise(F.col("row.n_chars")))
    return unpacked(rows.select(row.alias("row")))
