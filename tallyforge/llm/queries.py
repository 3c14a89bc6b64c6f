"""Queries of the operators over the whole tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyforge.llm import (
    aligned_pieces,
    byte_gru,
    class_lm,
    conversations,
    jaccard_join,
    licences,
    merkle,
    packing,
    prefix_bpe,
    sharding,
    templates,
    toxicity,
)
from tallyforge.llm.corpus import documents
from tallyforge.llm.digest_index import new_index

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir))


def op2_table_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(documents(spark, sf_dir))


def op3_byte_gru_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_gru.identify(documents(spark, sf_dir))


def op4_class_ngram_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.score_corpus(documents(spark, sf_dir))


def op5_prefix_trie_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_bpe.encoded_digests(documents(spark, sf_dir))


def op6_template_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return templates.contaminated_pairs(documents(spark, sf_dir), benchmark)


def op7_licence_compression(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan(documents(spark, sf_dir))


def op8_size_aware_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(documents(spark, sf_dir))


def op9_lexicon_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_corpus(spark, sf_dir)


def op10_digest_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    found = new_index(spark, docs.count()).add(docs, "documents")
    return found.select(
        "doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def op11_aligned_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return aligned_pieces.encoded_digests(documents(spark, sf_dir))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(documents(spark, sf_dir))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired_damage(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_token_packing,
        op2_table_sharding,
        op3_byte_gru_language,
        op4_class_ngram_scores,
        op5_prefix_trie_bpe,
        op6_template_contamination,
        op7_licence_compression,
        op8_size_aware_jaccard,
        op9_lexicon_toxicity,
        op10_digest_index,
        op11_aligned_pieces,
        op12_merkle_manifest,
        op13_conversation_repair,
    )
}


def _sharding_sql() -> str:
    owners = ", ".join(map(str, sharding.fill_table(sharding.SHARDS, sharding.SLOTS)))
    return f"""
WITH owner AS (SELECT unnest([{owners}]) AS n, unnest(range({sharding.SLOTS})) AS slot),
placed AS (
  SELECT *, (('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT % {sharding.SLOTS})::INTEGER AS slot
  FROM documents
)
SELECT doc_id, text, lang, source, n_chars, slot, 'shard-' || lpad(n::VARCHAR, 3, '0') AS shard
FROM placed JOIN owner USING (slot)"""


_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"""


def _crc32_sql(text: str) -> str:
    """crc32 of an ASCII text; ``crc_table`` holds the table of its 256 remainders as ``entries``."""
    codes = f"list_concat([4294967295], list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT))"
    return f"xor(4294967295, list_reduce({codes}, lambda c, b: xor(c // 256, entries[xor(c, b) % 256 + 1])))"


_CRC_TABLE = """crc_table AS (
  SELECT list_transform(range(256), lambda n: list_reduce(
    [n, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END)) AS entries
)"""


def _merkle_sql() -> str:
    def row_hash(text: str) -> str:
        values = ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)
        return f"sha256({' || '.join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values)})"

    def climb(name: str, leaves: str) -> str:
        return f"""{name} AS (
  SELECT grp, 0 AS level, idx, n, digest FROM {leaves}
  UNION ALL
  SELECT grp, level + 1, idx // 3, max((n + 2) // 3), sha256(string_agg(digest, '' ORDER BY idx))
  FROM {name} WHERE n > 1 GROUP BY grp, level, idx // 3
)"""

    def folded(name: str, leaves: str, tree: str) -> str:
        return f"""{name} AS (
  SELECT grp, pos, 0 AS level, pos AS idx, n, digest, '' AS siblings FROM {leaves}
  UNION ALL
  SELECT f.grp, f.pos, f.level + 1, f.idx // 3, max((f.n + 2) // 3),
    sha256(string_agg(CASE WHEN t.idx = f.idx THEN f.digest ELSE t.digest END, '' ORDER BY t.idx)),
    max(f.siblings) || coalesce(string_agg(t.digest, '' ORDER BY t.idx) FILTER (t.idx <> f.idx), '')
  FROM {name} f JOIN {tree} t ON t.grp = f.grp AND t.level = f.level AND t.idx // 3 = f.idx // 3
  WHERE f.n > 1 GROUP BY f.grp, f.pos, f.level, f.idx
)"""

    return f"""
WITH RECURSIVE {_CRC_TABLE},
hashed AS (
  SELECT doc_id, coalesce('+' || source, '') AS grp, {row_hash("text")} AS leaf,
    CASE WHEN {_crc32_sql("doc_id::VARCHAR")} % 2 = 0 THEN {row_hash("replace(text, chr(10), '')")}
      ELSE {row_hash("text")} END AS other
  FROM documents, crc_table
),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY grp) AS n, leaf AS digest
  FROM hashed
),
{climb("tree", "leaves")},
subroots AS (
  SELECT '' AS grp, grp AS name, digest, row_number() OVER (ORDER BY grp) - 1 AS idx, count(*) OVER () AS n
  FROM tree WHERE n = 1
),
{climb("top", "subroots")},
{folded("below", "(SELECT grp, idx AS pos, n, other AS digest FROM leaves)", "tree")},
changed AS (SELECT name AS grp, pos AS leaf_pos, b.digest, s.idx AS pos, s.n, b.siblings
  FROM below b JOIN subroots s ON s.name = b.grp WHERE b.n = 1),
{folded("above", "(SELECT grp || '/' || leaf_pos AS grp, pos, n, digest FROM changed)",
        "(SELECT c.grp || '/' || c.leaf_pos AS grp, t.level, t.idx, t.digest FROM top t, changed c)")}
SELECT l.doc_id, l.leaf, s.digest AS subroot, r.digest AS root, sha256(c.siblings || a.siblings) AS proof_sha256,
  a.digest AS folded_root, a.digest = r.digest AS verified
FROM leaves l JOIN subroots s ON s.name = l.grp JOIN changed c ON c.grp = l.grp AND c.leaf_pos = l.idx
  JOIN above a ON a.grp = l.grp || '/' || l.idx AND a.n = 1, (SELECT digest FROM top WHERE n = 1) r"""


_WHITE = r"\x20\x09-\x0D"

_REPAIR_SQL = f"""
WITH RECURSIVE {_CRC_TABLE},
named AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(conv_id::VARCHAR, ' ') AS conv, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name
  FROM conversations
),
coded AS (SELECT *, {_crc32_sql("name")} % 20 AS code FROM named, crc_table),
damaged AS (
  SELECT conv, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role,
    CASE code WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN code = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM coded WHERE code <> 0
),
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv ORDER BY turn NULLS FIRST, role, text, copy) AS i,
    row_number() OVER (PARTITION BY conv, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
  FROM damaged
),
judged AS (
  SELECT *, left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv ORDER BY i) AS before,
    CASE WHEN NOT regexp_matches(text, '[^{_WHITE}]') THEN 'blank' WHEN again THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][{_WHITE}]*$') THEN 'truncated' ELSE '' END AS fault
  FROM numbered
),
counted AS (
  SELECT conv, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal
  FROM judged GROUP BY conv
),
-- States: 0 nothing yet, 1 behind s, 2 behind u, 3 behind a.
follow(state, role, behind) AS (VALUES (0, 'user', 2), (1, 'user', 2), (2, 'assistant', 3), (3, 'user', 2)),
inserted AS (
  SELECT state, 0 AS many, state AS at_state, []::VARCHAR[] AS added FROM follow
  UNION ALL
  SELECT i.state, many + 1, behind, list_append(added, role || ':') FROM inserted i JOIN follow f ON f.state = i.at_state
  WHERE many < 2
),
moves AS (
  SELECT state, 'D' AS edits, state AS behind, NULL::VARCHAR AS role, NULL::VARCHAR AS initial, 3 AS cost, added FROM inserted WHERE many = 0
  UNION ALL
  SELECT 0, 'K', 1, NULL, 's', 0, []::VARCHAR[]
  UNION ALL
  SELECT i.state, repeat('I', many) || kind, f.behind, CASE kind WHEN 'R' THEN f.role END,
    CASE kind WHEN 'K' THEN left(f.role, 1) END, 2 * many + CASE kind WHEN 'R' THEN 2 ELSE 0 END, added
  FROM inserted i JOIN follow f ON f.state = i.at_state, (VALUES ('K'), ('R')) kinds(kind)
),
best AS (
  SELECT conv, 0 AS i, 0 AS state, {{'cost': 0, 'audit': '', 'made': []::VARCHAR[]}} AS way FROM counted
  UNION ALL
  SELECT b.conv, b.i + 1, m.behind, min({{
    'cost': b.way.cost + m.cost + CASE WHEN fault = 'truncated' AND edits <> 'D' THEN 1 ELSE 0 END,
    'audit': b.way.audit || m.edits,
    'made': CASE m.edits WHEN 'D' THEN b.way.made
      ELSE list_append(list_concat(b.way.made, m.added), coalesce(m.role, r.role) || ':' || r.text) END}})
  FROM best b JOIN judged r ON r.conv = b.conv AND r.i = b.i + 1 JOIN moves m ON m.state = b.state
  WHERE (m.edits = 'D' OR fault NOT IN ('blank', 'duplicate')) AND coalesce(m.initial = r.initial, true)
  GROUP BY b.conv, b.i, m.behind
),
closing(state, edits, added) AS (VALUES (0, '', []), (3, '', []), (2, 'I', ['assistant:']), (1, 'II', ['user:', 'assistant:'])),
chosen AS (
  SELECT conv, min({{'cost': way.cost + 2 * len(edits), 'audit': way.audit || edits, 'made': list_concat(way.made, added)}}) AS way
  FROM best JOIN counted USING (conv) JOIN closing USING (state) WHERE i = n GROUP BY conv
)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(way.cost, 0) AS cost,
  coalesce(way.audit, '') AS audit, sha256(coalesce(array_to_string(way.made, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, conv FROM named) LEFT JOIN counted USING (conv) LEFT JOIN chosen USING (conv)"""


ORACLE_SQL: dict[str, str] = {
    "op13_conversation_repair": _REPAIR_SQL,
    "op12_merkle_manifest": _merkle_sql(),
    "op2_table_sharding": _sharding_sql(),
    "op8_size_aware_jaccard": f"""
WITH RECURSIVE split AS (SELECT doc_id, {_WORDS} AS w FROM documents),
tokens AS (SELECT doc_id, len(w) AS n, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split),
runs AS (
  SELECT doc_id, n, pos, concat_ws(' ', word, lead(word, 1) OVER o, lead(word, 2) OVER o, lead(word, 3) OVER o,
    lead(word, 4) OVER o) AS h
  FROM tokens WINDOW o AS (PARTITION BY doc_id ORDER BY pos)
),
hashes AS (SELECT DISTINCT doc_id, h FROM runs WHERE pos <= n - 4 OR (n < 5 AND pos = 1)),
sets AS (SELECT doc_id, count(h) AS size FROM documents LEFT JOIN hashes USING (doc_id) GROUP BY doc_id),
counted AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM hashes a JOIN hashes b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL
),
links AS (
  SELECT a, b FROM counted JOIN sets x ON x.doc_id = a JOIN sets y ON y.doc_id = b
  WHERE 100 * shared >= 75 * (x.size + y.size - shared)
),
reach AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT doc_id, size AS n_shingles, component_id
FROM sets JOIN (SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a) USING (doc_id)""",
    "op10_digest_index": """
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
}
