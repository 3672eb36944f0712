"""The registered queries of the operators, each over its whole table, with production parameters."""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clusterkit.llm.alignment import alignment_report
from clusterkit.llm.bpe_trie import bpe_digest
from clusterkit.llm.common import table
from clusterkit.llm.decontaminate import contamination
from clusterkit.llm.lm_score import lm_scores
from clusterkit.llm.pii import pii_digest
from clusterkit.llm.quality import quality_report
from clusterkit.llm.repair import damaged, repair_report, turns
from clusterkit.llm.repeats import drop_repeats
from clusterkit.llm.simhash import simhash_classes
from clusterkit.llm.token_counts import token_counts
from clusterkit.llm.token_files import token_files_digest
from clusterkit.llm.top_k import top_k, whole_vectors
from clusterkit.llm.url_filter import judge_urls


def vocabulary_path(name: str = "byte_bpe_50k.json") -> str:
    """A vocabulary file, from the installed package of public tokenizers."""
    import public_tokenizers

    return os.path.realpath(public_tokenizers.path(name))


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(table(spark, sf_dir, "documents"))


def op2_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents")).drop("rejected_by")


def op3_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_digest(table(spark, sf_dir, "documents"), vocabulary_path())


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary_path(), limit=1024)


def op5_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files_digest(table(spark, sf_dir, "documents"), vocabulary_path(), end_id=0)


def op6_pii_anchors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_digest(table(spark, sf_dir, "documents"))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_url_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"))


def op9_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drop_repeats(table(spark, sf_dir, "documents"), length=400, with_kept=False)


def op10_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scores(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair_report(damaged(turns(table(spark, sf_dir, "conversations"))))


def op12_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(whole_vectors(table(spark, sf_dir, "embeddings"), scale=64), lambda i: i % 20 == 0, k=20)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment_report(table(spark, sf_dir, "documents"), vocabulary_path(), vocabulary_path("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_simhash": op1_simhash,
    "op2_quality_cascade": op2_quality_cascade,
    "op3_bpe_trie": op3_bpe_trie,
    "op4_token_counts": op4_token_counts,
    "op5_token_files": op5_token_files,
    "op6_pii_anchors": op6_pii_anchors,
    "op7_decontaminate": op7_decontaminate,
    "op8_url_trees": op8_url_trees,
    "op9_repeats": op9_repeats,
    "op10_lm_score": op10_lm_score,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_top_k": op12_top_k,
    "op13_token_alignment": op13_token_alignment,
}

# The cascade's order changes no verdict, so a plain conjunction says the same.
_QUALITY = r"""
WITH w AS (
    SELECT doc_id, coalesce(text, '') AS t,
        regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
        list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
    FROM documents
), windows AS (
    SELECT doc_id, i, list_slice(words, i, i + 4) AS k FROM w, unnest(range(1, len(words) - 3)) AS u(i)
), again AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, k) AS c FROM windows) WHERE c > 1
), covered AS (
    SELECT doc_id, count(DISTINCT i + j) AS n FROM again, unnest(range(5)) AS v(j) GROUP BY doc_id
), m AS (
    SELECT w.doc_id, len(words)::BIGINT AS n_words,
        length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
        (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
        (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
        coalesce(covered.n, 0)::BIGINT AS n_repeat_words,
        len(lines) AS n_lines,
        length(regexp_replace(t, '[^\pL]', '', 'g')) AS letters,
        length(regexp_replace(t, '[^\p{Lu}]', '', 'g')) AS capitals,
        length(t) - length(replace(t, '!', '')) AS marks
    FROM w LEFT JOIN covered USING (doc_id)
), b AS (
    SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    NOT (base_failed OR 10 * n_symbols > n_words OR 2 * n_dup_lines > n_lines
        OR (letters >= 20 AND 10 * capitals > 6 * letters) OR marks > n_words
        OR 10 * letters < 4 * word_chars OR word_chars NOT BETWEEN 2 * n_words AND 20 * n_words) AS kept
FROM b
"""

# Every start of a 400-byte string, by content: right for any size, but slow beyond small tables.
_REPEATS = """
WITH d AS (
    SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents
), s AS (
    SELECT doc_id, i, md5(b[i:i + 399]) AS h FROM d, unnest(range(1, octet_length(b) - 398)) AS u(i)
), twice AS (
    SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY h) AS c FROM s) WHERE c > 1
), runs AS (
    SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM (
        SELECT *, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 400 THEN 0 ELSE 1 END AS fresh FROM twice)
), spans AS (
    SELECT doc_id, min(i) AS a, max(i) + 400 AS e FROM runs GROUP BY doc_id, run
), cuts AS (
    SELECT doc_id, list({'a': a, 'e': e} ORDER BY a) AS cut, sum(e - a)::BIGINT AS n_removed, count(*) AS n_spans,
        string_agg((a - 1)::VARCHAR || ':' || (e - 1)::VARCHAR, ',' ORDER BY a) AS spans
    FROM spans GROUP BY doc_id
), kept AS (
    SELECT doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
        coalesce(n_spans, 0)::BIGINT AS n_spans, coalesce(spans, '') AS spans,
        CASE WHEN cut IS NULL THEN [b] ELSE list_transform(range(0, len(cut) + 1), lambda k:
            b[CASE WHEN k = 0 THEN 1 ELSE cut[k].e END : CASE WHEN k = len(cut) THEN octet_length(b) ELSE cut[k + 1].a - 1 END])
        END AS pieces
    FROM d LEFT JOIN cuts USING (doc_id)
)
SELECT doc_id, n_bytes, n_removed, n_spans, sha256(list_reduce(pieces, lambda x, y: x || y)) AS kept_sha256, spans FROM kept
"""

_TOP_K = """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
    WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scores AS (
    SELECT q.vec_id AS query_id, d.vec_id, list_inner_product(q.v, d.v)::BIGINT AS score
    FROM v q JOIN v d ON q.vec_id % 20 = 0 AND d.vec_id <> q.vec_id AND len(d.v) = len(q.v)
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scores)
WHERE rank <= 20
"""

def _repair_sql() -> str:
    """Viterbi's states as one text each, cost in eight digits and then the edits, so that the least
    text is the cheapest path and of equals the least; the turns follow each other by recursion. crc32
    is worked out bit by bit, as DuckDB has none."""
    def add(state: str, cost: str, letter: str) -> str:
        return f"(lpad((left({state}, 8)::BIGINT + {cost})::VARCHAR, 8, '0') || substr({state}, 9) || '{letter}')"

    def least(*paths: str) -> str:
        # least() passes over nulls: states that cannot be reached.
        return f"least({', '.join(paths)})" if len(paths) > 1 else paths[0]

    after = {"z": (("s", "s"), ("u", "u")), "s": (("u", "u"),), "u": (("a", "a"),), "a": (("u", "u"),)}
    reached: dict[str, list[str]] = {x: [add(x, "2", "D")] for x in "zsua"}
    for old, moves in after.items():
        for initial, new in moves:
            reached[new].append(f"CASE WHEN NOT must AND initial = '{initial}' THEN {add(old, 'extra', 'K')} END")
            if initial != "s":
                reached[new].append(f"CASE WHEN NOT must AND initial <> '{initial}' THEN {add(old, 'extra + 1', 'R')} END")
    turns = ", ".join(f"{least(*paths)} AS {x}" for x, paths in reached.items())
    # One turn at a time: what the turn gives, then the insertions after it.
    insert_u = least("u", *(add(x, "5", "I") for x in "zsa"))
    return f"""
WITH RECURSIVE crc AS MATERIALIZED (
    SELECT list(c ORDER BY n) AS t FROM (SELECT n, list_reduce(list_prepend(n, range(8)),
        lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END) AS c FROM range(256) r(n))
), keyed AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
        coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations
), faulted AS (
    SELECT k.*, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(key, ''), lambda c: ord(c)::BIGINT)),
        lambda x, b: xor(x >> 8, crc.t[(xor(x, b) & 255) + 1])), 4294967295::BIGINT) % 20 AS fault FROM keyed k CROSS JOIN crc
), damaged AS (
    SELECT conv_id, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role,
        CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text
    FROM faulted, range(CASE WHEN fault = 3 THEN 2 ELSE 1 END) WHERE fault <> 0
), ordered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
        left(role, 1) AS initial, regexp_replace(text, '[\x20\x09-\x0D]', '', 'g') AS body FROM damaged
), marked AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
        lag(initial) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM ordered
), faults AS MATERIALIZED (
    SELECT *, body = '' AS blank, body <> '' AND again AS duplicate,
        body <> '' AND NOT again AND right(body, 1) NOT IN ('.', '!', '?') AS truncated FROM marked
), steps AS MATERIALIZED (
    SELECT conv_id, n, initial, blank OR duplicate AS must, CASE WHEN truncated THEN 5 ELSE 0 END AS extra FROM faults
), walk AS (
    SELECT conv_id, 0::BIGINT AS n, '00000000' AS z, NULL::VARCHAR AS s, '00000005I' AS u, '00000010II' AS a
    FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT conv_id, n, z, s, u, {least("a", add("u", "5", "I"))} FROM (
        SELECT conv_id, n, z, s, {insert_u} AS u, a FROM (
            SELECT w.conv_id, t.n, {turns} FROM walk w JOIN steps t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.n = w.n + 1))
), ends AS MATERIALIZED (
    SELECT conv_id, left(least(z, a), 8)::BIGINT AS cost, substr(least(z, a), 9) AS audit FROM walk
    QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY n DESC) = 1
), letters AS (
    SELECT conv_id, i, audit[i] AS letter, length(audit) - length(replace(audit, 'D', '')) AS gone, audit FROM ends, range(1, length(audit) + 1) r(i)
), placed AS (
    SELECT conv_id, letter, i, length(audit) - gone AS kept,
        length(replace(left(audit, i), 'I', '')) AS n, length(replace(left(audit, i), 'D', '')) AS place FROM letters
), lines AS (
    SELECT p.conv_id, p.i, CASE WHEN letter = 'K' THEN f.role WHEN (kept - place) % 2 = 0 THEN 'assistant' ELSE 'user' END
        || ':' || CASE WHEN letter = 'I' THEN '' ELSE f.text END AS line
    FROM placed p LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.n = p.n WHERE letter <> 'D'
), texts AS (
    SELECT conv_id, string_agg(line, chr(10) ORDER BY i) AS t FROM lines GROUP BY conv_id
), counts AS (
    SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank,
        count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
        count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM faults GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
    coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, cost, audit, sha256(coalesce(t, '')) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM e.conv_id LEFT JOIN texts x ON x.conv_id IS NOT DISTINCT FROM e.conv_id
"""


#: The others cannot be put in SQL; tests/llm holds them against brute force.
SQL: dict[str, str] = {"op2_quality_cascade": _QUALITY, "op9_repeats": _REPEATS, "op11_conversation_repair": _repair_sql(), "op12_top_k": _TOP_K}
