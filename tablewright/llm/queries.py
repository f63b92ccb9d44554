"""Registered queries of the training-data operators and their SQL, where SQL can say it.

Each query applies its operator to the whole of its table and derives the
figures of its contract from what the operator returns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from tablewright.llm import (
    exact, language, ledger, licenses, linedup, lzparse, merkle, mixing, secret_scan, simhash, toxicity, trie, winnowing,
)

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def keep(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return keep


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ASCII letters in lower case; DuckDB's lower() would change letters beyond ASCII too
LOWER_SQL = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
WORDS_SQL = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


@query()
def op1_simhash_near_duplicates(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, folder, "documents"), "doc_id", "text", words=3, distance=2)


OP4_SQL = rf"""
WITH doc_words AS (
  SELECT doc_id, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
item_words AS (
  SELECT item_id, regexp_extract_all({LOWER_SQL}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(w[i:i + size - 1], ' ') AS s
  FROM (SELECT item_id, w, least(10, len(w)) AS size, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
        FROM item_words WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM item_windows),
tokens AS (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p, len(w) AS n FROM doc_words),
runs AS (
  SELECT doc_id, p, n, [t, {', '.join(f'lead(t, {i}) OVER o' for i in range(1, 10))}] AS r
  FROM tokens WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
met AS (
  SELECT r.doc_id, r.p, z.size, i.item_id
  FROM runs r JOIN sizes z ON r.p + z.size - 1 <= r.n
  JOIN item_windows i ON i.size = z.size AND i.s = array_to_string(r.r[1:z.size], ' ')),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT doc_id, unnest(range(p, p + size)) AS q FROM met) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM met) GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(c.n_hit, 0)::BIGINT AS n_hit,
       coalesce(m.n_items, 0)::BIGINT AS n_items, sha256(coalesce(m.items, '')) AS items_sha256,
       coalesce(c.n_hit, 0) > 0 AS contaminated
FROM doc_words d LEFT JOIN covered c ON d.doc_id = c.doc_id LEFT JOIN named m ON d.doc_id = m.doc_id
"""


@query(OP4_SQL)
def op4_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    hits = winnowing.benchmark_hits(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return hits.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


OP5_SQL = f"""
WITH doc_words AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
tokens AS (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p, len(w) AS n FROM doc_words),
runs AS (
  SELECT doc_id, p, n, md5(string_agg(t, ' ') OVER (
    PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING)) AS s FROM tokens),
repeated AS (
  SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY s) AS c FROM runs WHERE p + 34 <= n)
  WHERE c > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS p FROM repeated),
kept AS (
  SELECT t.doc_id, string_agg(t.t, ' ' ORDER BY t.p) AS body
  FROM tokens t LEFT JOIN gone g ON t.doc_id = g.doc_id AND t.p = g.p WHERE g.p IS NULL GROUP BY t.doc_id),
lost AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(l.n, 0)::BIGINT AS n_removed,
       sha256(coalesce(k.body, '')) AS kept_sha256
FROM doc_words d LEFT JOIN kept k ON d.doc_id = k.doc_id LEFT JOIN lost l ON d.doc_id = l.doc_id
"""


@query(OP5_SQL)
def op5_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lzparse.repeated_passages(table(spark, folder, "documents")).select(
        "doc_id", "n_words", "n_removed", "kept_sha256"
    )


OP2_SQL = rf"""
WITH doc_words AS (SELECT doc_id, coalesce(text, '') AS text, {WORDS_SQL} AS w FROM documents),
tokens AS (SELECT doc_id, unnest(w) AS t, unnest(range(1, len(w) + 1)) AS p, len(w) AS n FROM doc_words),
runs AS (
  SELECT doc_id, p, n, t || ' ' || lead(t, 1) OVER o || ' ' || lead(t, 2) OVER o AS s
  FROM tokens WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
twice AS (SELECT doc_id, p FROM (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, s) AS c FROM runs WHERE p + 2 <= n) WHERE c > 1),
repeated AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, unnest(range(p, p + 3)) AS q FROM twice) GROUP BY doc_id),
lines AS (
  SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM doc_words)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
measures AS (
  SELECT d.doc_id, len(d.w)::BIGINT AS n_words, len(array_to_string(d.w, ''))::BIGINT AS word_chars,
    len(regexp_replace(d.text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
    coalesce(l.n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(r.n, 0)::BIGINT AS n_repeat_words,
    coalesce(l.n_lines, 0) AS n_lines, len(regexp_replace(d.text, '[^A-Z]', '', 'g')) AS n_upper,
    len(regexp_replace(d.text, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS n_letters,
    len(regexp_replace(d.text, '[^!]', '', 'g')) AS n_exclaim
  FROM doc_words d LEFT JOIN repeated r ON d.doc_id = r.doc_id LEFT JOIN lines l ON d.doc_id = l.doc_id),
judged AS (
  SELECT *, {" + ".join(f"CASE WHEN {r.fails} THEN {1 << i} ELSE 0 END" for i, r in enumerate(ledger.RULES))} AS failed
  FROM measures)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, failed::BIGINT AS failed,
       (failed & {ledger.mask(ledger.POLICIES[0].strict)}) > 0 AS base_failed,
       (failed & {ledger.mask(ledger.POLICIES[-1].strict)}) = 0 AS kept
FROM judged
"""


@query(OP2_SQL)
def op2_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    book = ledger.ledger(table(spark, folder, "documents"))
    return ledger.verdicts(book).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "failed",
        (~ledger.kept_by(ledger.POLICIES[0])).alias("base_failed"), "kept",
    )


@query()
def op3_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(table(spark, folder, "documents")).documents.select(
        "doc_id", "size", "source_size", "target", "taken"
    )


@query()
def op8_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    known = table(spark, folder, "labels").where(~held_out).select("doc_id", "toxic")
    return toxicity.score(docs, toxicity.fit(docs, known)).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


@query()
def op9_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return linedup.without_repeated_lines(docs).select(
        "doc_id", "n_deleted", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


@query()
def op6_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = licenses.licence_passages(table(spark, folder, "documents"))
    return found.select(
        "doc_id", F.size("passages").cast("bigint").alias("n_passages"),
        F.array_join(F.array_sort(F.array_distinct("passages.template")), ",").alias("licenses"),
        F.array_join(F.transform("passages", lambda p: F.concat_ws(":", p["template"], p["start"], p["end"])), ",").alias("passages"),
        F.round(F.coalesce(F.array_max("passages.dice"), F.lit(0.0)), 6).alias("best_dice"),
    )


@query()
def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    found, _ = secret_scan.scan(table(spark, folder, "documents"), repository="doc_id", owner="source")

    def of(kind: str):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("bigint")

    def digest(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id", of("assign").alias("n_assign"), of("access").alias("n_access"), of("hex").alias("n_hex"),
        F.sha2(digest(F.filter("spans", lambda s: s["kind"] != "opaque")), 256).alias("base_sha256"),
        digest(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["live"])).cast("bigint").alias("n_live"),
    )


@query()
def op10_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    dictionaries = language.learn(docs.where(~held_out))
    return language.identify(docs.select("doc_id", "text"), dictionaries).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected"
    )


def crc32_sql(value: str) -> str:
    """Unsigned CRC-32 of a number's decimal digits, bit by bit."""
    step = "xor(x >> 1, 3988292384 * (x & 1))"
    byte = f"list_reduce(list_concat([xor(c, d)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, i: {step})"
    digits = f"list_transform(string_split(({value})::VARCHAR, ''), lambda k: ord(k)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {digits}), lambda c, d: {byte}), 4294967295)"


LEAF_SQL = " || ".join(
    f"CASE WHEN {c} IS NULL THEN '-' ELSE strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR END"
    for c in ("doc_id", "source", "lang", "n_chars", "{text}")
)
#: Levels of all trees of a table of leaves (tree, pos, digest), and their last level.
LEVELS_SQL = """
{up}(tree, level, pos, digest) AS (
  SELECT tree, 0, pos, digest FROM {leaves}
  UNION ALL
  SELECT tree, any_value(level) + 1, pos // 3, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY tree) AS n FROM {up}) WHERE n > 1 GROUP BY tree, pos // 3),
{top} AS (SELECT tree, max(level) AS height, arg_max(digest, level) AS digest FROM {up} GROUP BY tree),
{up}_steps AS (
  SELECT u.tree, u.level, u.pos,
    coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos < u.pos), '') AS before,
    coalesce(string_agg(s.digest, '' ORDER BY s.pos) FILTER (s.pos > u.pos), '') AS after
  FROM {up} u JOIN {top} t ON t.tree = u.tree AND u.level < t.height
  JOIN {up} s ON s.tree = u.tree AND s.level = u.level AND s.pos // 3 = u.pos // 3
  GROUP BY u.tree, u.level, u.pos)"""
OP11_SQL = f"""
WITH RECURSIVE leaves AS (
  SELECT doc_id, coalesce('1' || source, '0') AS tree, sha256({LEAF_SQL.format(text="text")}) AS digest,
    CASE WHEN {crc32_sql("doc_id")} % 2 = 0 THEN sha256({LEAF_SQL.format(text="replace(text, chr(10), '')")})
      ELSE sha256({LEAF_SQL.format(text="text")}) END AS claimed,
    row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos FROM documents),
{LEVELS_SQL.format(up="low", leaves="leaves", top="subroots")},
sources AS (SELECT '' AS tree, tree AS of, row_number() OVER (ORDER BY tree) - 1 AS pos, digest FROM subroots),
{LEVELS_SQL.format(up="high", leaves="sources", top="roots")},
steps AS (
  SELECT l.doc_id, s.level, s.before, s.after
  FROM leaves l JOIN low_steps s ON s.tree = l.tree AND s.pos = l.pos // (3 ** s.level)::BIGINT
  UNION ALL
  SELECT l.doc_id, 1000 + s.level, s.before, s.after
  FROM leaves l JOIN sources o ON o.of = l.tree JOIN high_steps s ON s.pos = o.pos // (3 ** s.level)::BIGINT),
paths AS (SELECT doc_id, list(before || '|' || after ORDER BY level) AS path FROM steps GROUP BY doc_id),
folded AS (
  SELECT l.doc_id, l.digest AS leaf, s.digest AS subroot, r.digest AS root,
    sha256(replace(array_to_string(coalesce(p.path, []), ''), '|', '')) AS proof_sha256,
    list_reduce(list_concat([l.claimed], coalesce(p.path, [])),
      lambda d, step: sha256(split_part(step, '|', 1) || d || split_part(step, '|', 2))) AS folded_root
  FROM leaves l JOIN subroots s ON s.tree = l.tree CROSS JOIN roots r LEFT JOIN paths p ON p.doc_id = l.doc_id)
SELECT *, folded_root = root AS verified FROM folded
"""


@query(OP11_SQL)
def op11_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    text = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    claimed = merkle.leaf_digest([text if c == "text" else F.col(c) for c in merkle.FIELDS])
    found = merkle.manifest(docs, carry={"claimed": claimed})
    return found.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof_digest(F.col("proof")).alias("proof_sha256"),
        merkle.fold(F.col("claimed"), F.col("proof")).alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


OP12_SQL = r"""
WITH normal AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
groups AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY t)
SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
FROM normal n JOIN groups g ON n.t = g.t
"""


@query(OP12_SQL)
def op12_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_groups(table(spark, folder, "documents"))


OP13_SQL = rf"""
WITH own AS (
  SELECT conv_id, {crc32_sql("conv_id")} % 4 AS h,
    list({{'r': coalesce(role, ''), 't': coalesce(text, '')}} ORDER BY turn NULLS FIRST) AS turns
  FROM conversations GROUP BY conv_id),
rebuilt AS (
  SELECT o.conv_id, list_concat(coalesce(b.turns[1:o.h], []), o.turns[o.h + 1:]) AS s
  FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 20),
prefixes AS (SELECT conv_id, s, d AS depth, s[1:d] AS p FROM (SELECT *, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT depth, p, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (len(s) = depth), '')) AS ends_sha256,
    CASE WHEN depth = 0 THEN 0 ELSE len(regexp_extract_all(p[depth].t, '[^\x20\x09-\x0D]+')) END AS words
  FROM prefixes GROUP BY depth, p),
children AS (SELECT p[1:depth - 1] AS p, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
counted AS (SELECT n.*, coalesce(c.n, 0) AS n_children FROM nodes n LEFT JOIN children c ON c.p = n.p),
sums AS (
  SELECT p[1:d] AS p, sum((n_children = 0)::BIGINT) AS n_leaves, sum((n_convs - 1) * words) AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM counted) GROUP BY 1)
SELECT c.conv_id, c.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, c.n_convs::BIGINT AS n_convs,
  c.n_children::BIGINT AS n_children, s.n_leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, c.ends_sha256
FROM counted c JOIN sums s ON s.p = c.p LEFT JOIN nodes u ON c.depth > 0 AND u.p = c.p[1:c.depth - 1]
"""


@query(OP13_SQL)
def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    placed = trie.in_order(trie.turns(table(spark, folder, "conversations")))
    convs, rows = trie.with_openings(placed, every=20, most=3, taken=F.crc32(F.col("conv").cast("string")) % 4)
    return trie.prefix_trie(convs, rows)
