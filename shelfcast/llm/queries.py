"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.llm import bpe, chat, crf, decontamination, langid, merkle, quality, repair, secrets, sharding, simhash, token_counts, warc
from shelfcast.llm.text import n_bytes
from shelfcast.session import cut_lineage

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

#: Byte limit of a shard: small, so that the tables at hand split as well.
SHARD_LIMIT = 1 << 20


def _table(spark: SparkSession, tables: str, name: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{tables}/{name}.parquet").select(*columns)


def _register(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(query: Query) -> Query:
        QUERIES[name] = query
        if sql is not None:
            ORACLES[name] = sql
        return query

    return add


@_register(
    "op1_sharding",
    f"""
WITH rows AS (
  SELECT row_number() OVER () AS r, doc_id, CAST(strlen(coalesce(text, '')) AS BIGINT) AS n_bytes,
    lpad(bin(CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '\\N')), 1, 15) AS BIGINT)), 60, '0') AS bits
  FROM documents),
nodes AS (
  SELECT substr(bits, 1, d) AS shard, CAST(d AS INTEGER) AS local_depth, CAST(sum(n_bytes) AS BIGINT) AS shard_bytes,
    count(*) AS shard_rows
  FROM rows, range(0, 61) AS depths(d) GROUP BY 1, 2),
fitting AS (SELECT * FROM nodes WHERE shard_bytes <= {SHARD_LIMIT} OR shard_rows = 1)
SELECT doc_id, n_bytes, shard, local_depth, shard_bytes, shard_rows
FROM rows, range(0, 61) AS depths(d), fitting
WHERE shard = substr(bits, 1, CAST(d AS INTEGER)) AND local_depth = d
QUALIFY row_number() OVER (PARTITION BY r ORDER BY local_depth) = 1""",
)
def op1_sharding(spark: SparkSession, tables: str) -> DataFrame:
    docs = _table(spark, tables, "documents", "doc_id", "text")
    sized = docs.select("doc_id", n_bytes(F.col("text")).alias("n_bytes"))
    return sharding.assign_shards(sized, ["doc_id"], F.col("n_bytes"), SHARD_LIMIT)


@_register("op2_bpe")
def op2_bpe(spark: SparkSession, tables: str) -> DataFrame:
    tokenizer = public_tokenizers.path("word_bpe_49k.json")
    encoded = bpe.encode(_table(spark, tables, "documents", "doc_id", "text"), tokenizer)
    digests = {"n_tokens": bpe.n_tokens(F.col("ids")), "ids_sha256": F.sha2("ids", 256)}
    decoded = bpe.decode(encoded.withColumns(digests), tokenizer, carry=["doc_id", *digests])
    return decoded.select("doc_id", *digests, F.sha2("decoded", 256).alias("decoded_sha256"))


@_register("op3_simhash")
def op3_simhash(spark: SparkSession, tables: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, tables, "documents", "doc_id", "text"), shingle=3, max_bits=2)
    return found.select("doc_id", "fingerprint", "component_id")


@_register("op4_token_counts")
def op4_token_counts(spark: SparkSession, tables: str) -> DataFrame:
    docs = _table(spark, tables, "documents", "doc_id", "text")
    return token_counts.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json"))


_SQL_ASSIGN = (
    r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"
    + r"""["'']?\x20*[:=]\x20*["'']?"""
)


@_register(
    "op5_secret_scans",
    rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner, coalesce(lang, '') AS repo
  FROM documents),
patterns(rank, kind, pattern) AS (VALUES
  (0, 'assign', '{_SQL_ASSIGN}[A-Za-z0-9+/_.=-]+'), (1, 'access', 'AKIA[A-Z0-9]{{16,}}'),
  (2, 'hex', '[0-9a-f]{{24,}}'), (3, 'owned', '[A-Za-z0-9+/_-]{{20,}}')),
found AS (
  SELECT r, owner, repo, rank, kind, string_split_regex(text, pattern) AS gaps, regexp_extract_all(text, pattern) AS matches
  FROM docs, patterns),
placed AS (
  SELECT r, owner, repo, rank, kind, matches[i] AS match,
    CAST(list_sum(list_transform(gaps[1:i], lambda g: length(g)))
      + coalesce(list_sum(list_transform(matches[1:i - 1], lambda m: length(m))), 0) AS BIGINT) AS s
  FROM (SELECT *, unnest(range(1, len(matches) + 1)) AS i FROM found)),
valued AS (
  SELECT *, s + length(match) AS e,
    CASE WHEN rank = 0 THEN regexp_replace(match, '^{_SQL_ASSIGN}', '') ELSE match END AS value FROM placed),
candidates AS (
  SELECT * FROM valued WHERE CASE rank WHEN 0 THEN length(value) >= 6
    WHEN 3 THEN regexp_matches(value, '[0-9]') AND regexp_matches(value, '[A-Za-z]') ELSE true END),
owners AS (
  SELECT value, count(DISTINCT owner) AS n_owners FROM candidates GROUP BY value),
judged AS (SELECT c.*, n_owners <= 1 AS live FROM candidates c JOIN owners USING (value)),
spans AS (
  SELECT * FROM judged a WHERE rank < 3 OR (live AND NOT EXISTS (
    SELECT 1 FROM judged b WHERE b.r = a.r AND b.rank < 3 AND b.s < a.e AND a.s < b.e))),
grouped AS (
  SELECT r, count(*) FILTER (rank = 0) AS n_assign, count(*) FILTER (rank = 1) AS n_access, count(*) FILTER (rank = 2) AS n_hex,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) FILTER (rank < 3) AS base,
    string_agg(kind || ':' || s || ':' || e, ',' ORDER BY s, rank) AS spans,
    count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_copied
  FROM spans GROUP BY r)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live,
  coalesce(n_copied, 0) AS n_copied
FROM docs LEFT JOIN grouped USING (r)""",
)
def op5_secret_scans(spark: SparkSession, tables: str) -> DataFrame:
    docs = _table(spark, tables, "documents", "doc_id", "text", "source", "lang")
    found = secrets.find_secrets(docs)
    count = lambda test: F.size(F.filter("found", test)).cast("long")
    of_rank = lambda rank: count(lambda s: s["rank"] == rank)
    base = F.filter("found", lambda s: s["rank"] < len(secrets.BASE))
    return found.select(
        "doc_id",
        *[of_rank(i).alias(f"n_{kind}") for i, kind in enumerate(secrets.BASE)],
        F.sha2(secrets.joined(base), 256).alias("base_sha256"),
        secrets.joined(F.col("found")).alias("spans"),
        count(lambda s: s["live"]).alias("n_live"),
        count(lambda s: ~s["live"]).alias("n_copied"),
    )


@_register(
    "op7_quality_rules",
    r"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, source FROM documents),
split AS (
  SELECT r, doc_id, source, text,
    list_filter(string_split_regex(text, '[\x20\x09-\x0D]+'), lambda w: w <> '') AS words,
    list_filter(string_split(text, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM docs),
windows AS (
  SELECT r, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS w
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM split)),
repeated AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, w) >= 2),
covered AS (
  SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM repeated) GROUP BY r),
counts AS (
  SELECT r, doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')) AS BIGINT) AS word_chars,
    CAST(length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(len(lines) AS BIGINT) AS n_lines, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
    coalesce(n, 0) AS n_repeat_words
  FROM split LEFT JOIN covered USING (r)),
failed AS (
  SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base, n_symbols > 0.1 * word_chars AS symbols,
    n_dup_lines > 0.6 * n_lines AS dup_lines FROM counts),
hosts AS (
  SELECT source, count(*) AS n, count(*) FILTER (base) AS b, count(*) FILTER (symbols) AS s, count(*) FILTER (dup_lines) AS d
  FROM failed WHERE source IS NOT NULL GROUP BY source),
moments AS (
  SELECT avg(b / n) AS mb, var_pop(b / n) AS vb, avg(s / n) AS ms, var_pop(s / n) AS vs, avg(d / n) AS md, var_pop(d / n) AS vd
  FROM hosts),
priors AS (
  SELECT mb, ms, md,
    CASE WHEN vb > 0 THEN least(greatest(mb * (1 - mb) / vb - 1, 1), 1e6) ELSE 1e6 END AS kb,
    CASE WHEN vs > 0 THEN least(greatest(ms * (1 - ms) / vs - 1, 1), 1e6) ELSE 1e6 END AS ks,
    CASE WHEN vd > 0 THEN least(greatest(md * (1 - md) / vd - 1, 1), 1e6) ELSE 1e6 END AS kd FROM moments),
rates AS (
  SELECT source, coalesce((b + mb * kb) / (n + kb) / nullif(mb, 0), 1) AS eb, coalesce((s + ms * ks) / (n + ks) / nullif(ms, 0), 1) AS es,
    coalesce((d + md * kd) / (n + kd) / nullif(md, 0), 1) AS ed FROM hosts, priors),
verdicts AS (
  SELECT source, round(greatest(least(es * eb, 2.0), 0.5), 6) AS strict_s, round(greatest(least(ed * eb, 2.0), 0.5), 6) AS strict_d FROM rates)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, base AS base_failed,
  coalesce(greatest(strict_s, strict_d) >= 2, false) AS host_bad,
  NOT (base OR n_symbols * coalesce(strict_s, 1) > CAST(0.1 AS DOUBLE) * word_chars
    OR n_dup_lines * coalesce(strict_d, 1) > CAST(0.6 AS DOUBLE) * n_lines) AS kept
FROM failed LEFT JOIN verdicts USING (source)""",
)
def op7_quality_rules(spark: SparkSession, tables: str) -> DataFrame:
    return quality.judge(_table(spark, tables, "documents", "doc_id", "text", "source"))


@_register("op8_decontamination")
def op8_decontamination(spark: SparkSession, tables: str) -> DataFrame:
    docs = _table(spark, tables, "documents", "doc_id", "text")
    found = decontamination.find_contamination(docs, _table(spark, tables, "benchmark", "item_id", "text"))
    match = found.select("doc_id", F.inline("matches"))
    measures = [F.round(c, 6).alias(c) for c in ("score", "question_overlap", "answer_overlap")]
    return match.select("doc_id", F.col("item").alias("item_id"), *measures)


@_register("op9_language_id")
def op9_language_id(spark: SparkSession, tables: str) -> DataFrame:
    docs = _table(spark, tables, "documents", "doc_id", "text", "lang")
    network = langid.train(docs)
    found = langid.identify(docs.select("doc_id", "text", langid.held_out(F.col("doc_id")).alias("held_out")), network, carry=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")


@_register("op10_chat_formatting")
def op10_chat_formatting(spark: SparkSession, tables: str) -> DataFrame:
    turns = _table(spark, tables, "conversations", "conv_id", "turn", "role", "text")
    spoken = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"),
        F.col("id").cast(turns.schema["turn"].dataType).alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(spoken).alias("text"),
    )
    return chat.read_back(chat.format_conversations(turns.unionByName(extra)))


@_register(
    "op6_warc",
    """
WITH bodies AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
hashed AS (
  SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS hex, first_value(page_id) OVER w AS first,
    row_number() OVER w AS place
  FROM bodies WINDOW w AS (PARTITION BY payload ORDER BY page_id NULLS LAST))
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    CAST(1 + (CAST('0x' || substr(hex, CAST(5 * (i // 4) + 1 AS INTEGER), 5) AS BIGINT) >> CAST(5 * (3 - i % 4) AS INTEGER)) % 32
      AS INTEGER), 1)), '') AS payload_digest,
  CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN place > 1 THEN first END AS refers_to
FROM hashed""",
)
def op6_warc(spark: SparkSession, tables: str) -> DataFrame:
    read = warc.archived_pages(_table(spark, tables, "pages", "page_id", "url", "html"), payloads=False)
    return read.select(
        F.col("key").cast("long").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        F.col("type").alias("record_type"),
        F.col("refers_to_key").cast("long").alias("refers_to"),
    )


def _sql_crc32(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit."""
    start, reflected = 0xFFFFFFFF, 0xEDB88320
    byte = f"list_transform(range(1, strlen({text}) + 1), lambda i: CAST(ascii(substr({text}, CAST(i AS BIGINT), 1)) AS BIGINT))"
    bits = f"list_reduce(list_prepend(xor(c, b), range(8)), lambda x, k: xor(x >> 1, {reflected} * (x & 1)))"
    return f"xor({start}, list_reduce(list_prepend(CAST({start} AS BIGINT), {byte}), lambda c, b: {bits}))"


def _sql_leaf(n_chars: str) -> str:
    fields = ["CAST(doc_id AS VARCHAR)", "source", "lang", f"CAST({n_chars} AS VARCHAR)", "text"]
    return "sha256(" + " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields) + ")"


def _sql_tree(name: str, leaves: str) -> str:
    """Recursive tree over ``leaves`` (g, idx, h, n): every two nodes in a row become one."""
    return f"""
{name} AS (
  SELECT g, 0 AS level, idx, h, n FROM {leaves}
  UNION ALL
  SELECT g, level + 1, idx // 2, sha256(string_agg(h, '' ORDER BY idx)), (n + 1) // 2 FROM {name} WHERE n > 1
  GROUP BY g, level, idx // 2, n)"""


def _sql_fold(name: str, start: str, tree: str) -> str:
    """Recursive walk of every leaf (r, g, idx, n, cur, proof) of ``start`` up to the root of its tree."""
    return f"""
{name} AS (
  SELECT r, g, 0 AS level, idx, n, cur, proof FROM {start}
  UNION ALL
  SELECT w.r, w.g, w.level + 1, w.idx // 2, (w.n + 1) // 2,
    sha256(CASE WHEN w.idx % 2 = 1 THEN coalesce(s.h, '') || w.cur ELSE w.cur || coalesce(s.h, '') END),
    w.proof || coalesce(s.h, '')
  FROM {name} w LEFT JOIN {tree} s ON s.g = w.g AND s.level = w.level AND s.idx = xor(w.idx, 1)
  WHERE w.n > 1)"""


@_register(
    "op11_merkle",
    f"""
WITH RECURSIVE rows AS (
  SELECT row_number() OVER () AS r, doc_id, CASE WHEN lang IS NULL THEN '' ELSE '+' || lang END AS g, {_sql_leaf("n_chars")} AS leaf,
    CASE WHEN doc_id IS NOT NULL AND {_sql_crc32("CAST(doc_id AS VARCHAR)")} % 7 = 0 THEN {_sql_leaf("(CAST(n_chars AS HUGEINT) + 1)")} ELSE {_sql_leaf("n_chars")} END AS shown
  FROM documents),
leaves AS (
  SELECT r, doc_id, g, leaf AS h, shown AS cur, '' AS proof, count(*) OVER (PARTITION BY g) AS n,
    row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS idx FROM rows),
{_sql_tree("tree", "leaves")},
subroots AS (
  SELECT '' AS g, g AS name, h, count(*) OVER () AS n, row_number() OVER (ORDER BY g) - 1 AS idx FROM tree WHERE n = 1),
{_sql_tree("top", "subroots")},
{_sql_fold("climbed", "leaves", "tree")},
second AS (
  SELECT c.r, '' AS g, s.idx, s.n, c.cur, c.proof FROM climbed c JOIN subroots s ON s.name = c.g WHERE c.n = 1),
{_sql_fold("finished", "second", "top")}
SELECT doc_id, l.h AS leaf, s.h AS subroot, t.h AS root, sha256(f.proof) AS proof_sha256, f.cur AS folded_root, f.cur = t.h AS verified
FROM leaves l JOIN subroots s ON s.name = l.g JOIN finished f ON f.r = l.r AND f.n = 1 JOIN top t ON t.n = 1""",
)
def op11_merkle(spark: SparkSession, tables: str) -> DataFrame:
    docs = _table(spark, tables, "documents", "doc_id", "source", "lang", "n_chars", "text")
    names = ("doc_id", "source", "lang", "n_chars", "text")
    leaf = merkle.leaf_hash(*[F.col(c) for c in names])
    more = merkle.leaf_hash(*[F.col(c).cast("decimal(20,0)") + 1 if c == "n_chars" else F.col(c) for c in names])
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    hashed = cut_lineage(docs.select("doc_id", "lang", leaf.alias("leaf"), F.when(tampered, more).alias("tampered")))
    tree = merkle.manifest(hashed, "lang", ["doc_id"], carry=["doc_id", "tampered"])
    folded = tree.withColumn("folded_root", merkle.fold(F.coalesce("tampered", "leaf"), F.col("path")))
    return folded.select(
        "doc_id", "leaf", "subroot", "root", merkle.proof(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


@_register("op12_quality_classifier")
def op12_quality_classifier(spark: SparkSession, tables: str) -> DataFrame:
    docs = _table(spark, tables, "documents", "doc_id", "text")
    field = crf.train(docs, _table(spark, tables, "labels", "doc_id", "quality"))
    rows = docs.select("doc_id", "text", crf.held_out(F.col("doc_id")).alias("held_out"))
    return crf.score_quality(rows, field, carry=["doc_id", "held_out"]).select("doc_id", "held_out", "score", "predicted")


def _sql_cheapest() -> str:
    """Recursive costs from the last row to the first: per state the least (cost, letters, repaired lines)."""
    states = ("none", "s", "u", "a")
    following, speaker = {"none": "u", "s": "u", "u": "a", "a": "u"}, {"u": "user", "a": "assistant"}
    kept = {"none": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}

    def edit(letter: str, cost: str, line: str, after: str) -> str:
        text = f"chr(10) || {line} || {after}.r" if line else f"{after}.r"
        return f"{{'c': {after}.c + {cost}, 'a': '{letter}' || {after}.a, 'r': {text}}}"

    def least(options: list[str]) -> str:
        return f"list_sort([{', '.join(options)}], 'ASC', 'NULLS LAST')[1]"

    moves = {}
    for q in states:
        keep = " ".join(f"WHEN initial = '{i}' THEN {edit('K', 'extra', chr(39) * 2 + ' || role || ' + repr(':') + ' || text', f'd.{to}')}" for i, to in kept[q].items())
        to = following[q]
        rerole = edit("R", "2 + extra", f"'{speaker[to]}:' || text", f"d.{to}")
        moves[q] = least([edit("D", "3", "", f"d.{q}"), f"CASE WHEN must_go THEN NULL {keep} END", f"CASE WHEN NOT must_go THEN {rerole} END"])

    def inserted(q: str) -> str:
        one, two = following[q], following[following[q]]
        once = edit("I", "2", f"'{speaker[one]}:'", f"m.{one}")
        twice = edit("II", "4", f"'{speaker[one]}:' || chr(10) || '{speaker[two]}:'", f"m.{two}")
        return least([f"m.{q}", once, twice])

    end = {"none": "0, '', ''", "s": "4, 'II', chr(10) || 'user:' || chr(10) || 'assistant:'", "u": "2, 'I', chr(10) || 'assistant:'", "a": "0, '', ''"}
    ends = ", ".join(f"{{'c': CAST({e.split(', ')[0]} AS BIGINT), 'a': {e.split(', ')[1]}, 'r': {e.split(', ')[2]}}} AS {q}" for q, e in end.items())
    return f"""
cheapest AS (
  SELECT g, count(*) + 1 AS place, {ends} FROM coded GROUP BY g
  UNION ALL
  SELECT g, place, {", ".join(f"{inserted(q)} AS {q}" for q in states)}
  FROM (SELECT c.g, c.place, {", ".join(f"{moves[q]} AS {q}" for q in states)} FROM cheapest d JOIN coded c ON c.g = d.g AND c.place = d.place - 1) m)"""


@_register(
    "op13_conversation_repair",
    rf"""
WITH RECURSIVE said AS (
  SELECT conv_id, coalesce('+' || conv_id, '') AS g, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS place FROM conversations),
fate AS (SELECT *, {_sql_crc32("place")} % 20 AS f FROM said),
broken AS (
  SELECT g, turn, CASE WHEN f = 4 THEN 'user' ELSE role END AS role,
    CASE f WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE f WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM fate),
placed AS (
  SELECT g, turn, role, text, substr(role, 1, 1) AS initial, NOT regexp_matches(text, '[^ 	-
]') AS is_blank,
    regexp_matches(text, '[.!?][ 	-
]*\z') AS ended,
    row_number() OVER (PARTITION BY g ORDER BY turn NULLS FIRST, role, sha256(strlen(role) || ':' || role || text)) AS place FROM broken),
faults AS (
  SELECT *, NOT is_blank AND row_number() OVER (PARTITION BY g, role, text ORDER BY place) > 1 AS is_again,
    lag(initial) OVER (PARTITION BY g ORDER BY place) || initial NOT IN ('su', 'ua', 'au') AS is_illegal FROM placed),
coded AS (
  SELECT *, is_blank OR is_again AS must_go, CASE WHEN is_blank OR is_again OR ended THEN 0 ELSE 1 END AS extra FROM faults),
{_sql_cheapest()},
counts AS (
  SELECT g, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (is_blank) AS blank, count(*) FILTER (is_again) AS duplicate,
    count(*) FILTER (extra = 1) AS truncated, count(*) FILTER (is_illegal) AS illegal FROM coded GROUP BY g),
repaired AS (SELECT g, "none".c AS cost, "none".a AS audit, sha256(substr("none".r, 2)) AS repaired_sha256 FROM cheapest WHERE place = 1)
SELECT n.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, g FROM said) n LEFT JOIN counts USING (g) LEFT JOIN repaired USING (g)""",
)
def op13_conversation_repair(spark: SparkSession, tables: str) -> DataFrame:
    turns = _table(spark, tables, "conversations", "conv_id", "turn", "role", "text")
    return repair.repair(repair.damaged(turns), turns)
