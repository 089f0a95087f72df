"""Registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableworks.llm.common import table
from tableworks.llm.context_trees import score_texts
from tableworks.llm.fill_middle import fill_in_middle, restore_text
from tableworks.llm.line_dedup import MIN_CHARS, MIN_SITES, dedup_lines
from tableworks.llm.nbest_pieces import encode_nbest
from tableworks.llm.near_dedup import THRESHOLD_PERCENT, near_duplicates
from tableworks.llm.packing import pack_documents
from tableworks.llm.phrases import collocations
from tableworks.llm.pii import pseudonymize
from tableworks.llm.quality_rules import judge_quality
from tableworks.llm.rule_ensemble import score_quality
from tableworks.llm.secret_scan import scan
from tableworks.llm.token_counts import count_tokens
from tableworks.llm.vector_graph import nearest


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents"))
    digest = F.md5("candidate").alias("candidate_md5")
    return found.select("doc_id", "place", F.length("candidate").alias("length"), digest, "held_out", "score", "is_secret")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    clean = dedup_lines(table(spark, sf_dir, "documents"), with_counts=True)
    return clean.select("doc_id", "n_lines", "n_removed", F.length("text").cast("long").alias("clean_chars"), F.md5("text").alias("clean_md5"))


def op3_sentencepiece_nbest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_nbest(table(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"), with_ids=False)


def op4_vector_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op5_context_tree_weighting(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(table(spark, sf_dir, "documents"))


def op6_hyperminhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op7_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(table(spark, sf_dir, "documents"), with_counts=True)


def op8_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_quality(table(spark, sf_dir, "documents"))
    return judged.drop("rejected_by")  # the first rule depends on the measured order


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"))


def op10_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    restored = restore_text(F.col("fim_text"), F.col("form"))
    digests = F.sha2("fim_text", 256).alias("output_sha256"), F.sha2(restored, 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op12_phrase_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": op1_secret_scan,
    "op2_line_dedup": op2_line_dedup,
    "op3_sentencepiece_nbest": op3_sentencepiece_nbest,
    "op4_vector_graph": op4_vector_graph,
    "op5_context_tree_weighting": op5_context_tree_weighting,
    "op6_hyperminhash_near_dedup": op6_hyperminhash_near_dedup,
    "op7_pii_pseudonyms": op7_pii_pseudonyms,
    "op8_quality_cascade": op8_quality_cascade,
    "op9_packing": op9_packing,
    "op10_rule_ensemble": op10_rule_ensemble,
    "op11_fill_middle": op11_fill_middle,
    "op12_phrase_graph": op12_phrase_graph,
    "op13_token_counts": op13_token_counts,
}

# Fixed value: words as the contracts define them, for DuckDB's regular expressions.
_WORDS = r"'[^\x20\x09-\x0D]+'"
_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLE_SQL: dict[str, str] = {
    "op2_line_dedup": f"""
        WITH d AS (SELECT doc_id, coalesce(source, '') AS site, text FROM documents),
        l AS (
            SELECT doc_id, site, unnest(string_split(text, chr(10))) AS line,
                   unnest(range(len(string_split(text, chr(10))))) AS pos
            FROM d),
        k AS (SELECT *, trim(line, ' ' || chr(9) || chr(13)) AS key FROM l),
        bad AS (
            SELECT key, min((doc_id, pos)) AS first FROM k
            WHERE length(key) >= {MIN_CHARS} GROUP BY key HAVING count(DISTINCT site) >= {MIN_SITES}),
        later AS (
            SELECT k.*, bad.key IS NOT NULL AND (k.doc_id, k.pos) <> bad.first AS bad
            FROM k LEFT JOIN bad ON k.key = bad.key),
        m AS (SELECT *, bad AS gone FROM later)
        SELECT d.doc_id, count(m.doc_id)::BIGINT AS n_lines,
               count(*) FILTER (gone)::BIGINT AS n_removed,
               CASE WHEN d.text IS NOT NULL THEN length(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), ''))::BIGINT END AS clean_chars,
               CASE WHEN d.text IS NOT NULL THEN md5(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) END AS clean_md5
        FROM d LEFT JOIN m ON d.doc_id = m.doc_id
        GROUP BY d.doc_id, d.text""",
    "op6_hyperminhash_near_dedup": f"""
        WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOWER}, {_WORDS}) AS ws FROM documents),
        s AS (
            SELECT DISTINCT doc_id, unnest(CASE
                WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' '))
                WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] END) AS shingle
            FROM w),
        n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
        p AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS both_have
            FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
        e AS (
            SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y
            WHERE 100 * both_have >= {THRESHOLD_PERCENT} * (nx.c + ny.c - both_have)),
        linked AS (SELECT x, y FROM e UNION ALL SELECT y, x FROM e),
        reach AS (
            SELECT doc_id AS node, doc_id AS root FROM documents
            UNION SELECT linked.y, reach.root FROM reach JOIN linked ON linked.x = reach.node)
        SELECT node AS doc_id, coalesce(n.c, 0)::BIGINT AS n_shingles, min(root) AS component_id, node = min(root) AS kept
        FROM reach LEFT JOIN n ON n.doc_id = node GROUP BY node, n.c""",
    "op8_quality_cascade": f"""
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
        w AS (SELECT doc_id, t, regexp_extract_all(t, {_WORDS}) AS ws FROM d),
        u AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM w),
        g AS (
            SELECT doc_id, pos, word || ' ' || lead(word) OVER q || ' ' || lead(word, 2) OVER q AS tri
            FROM u WINDOW q AS (PARTITION BY doc_id ORDER BY pos)),
        h AS (SELECT doc_id, pos, count(*) OVER (PARTITION BY doc_id, tri) AS c FROM g WHERE tri IS NOT NULL),
        r AS (
            SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest([pos, pos + 1, pos + 2]) AS place FROM h WHERE c >= 2)
            GROUP BY doc_id),
        l AS (
            SELECT doc_id, count(*) AS n, count(*) - count(DISTINCT line) AS dup
            FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d) WHERE regexp_matches(line, {_WORDS}) GROUP BY doc_id),
        m AS (
            SELECT doc_id, count(*) FILTER (regexp_matches(word, '(!!|\\?\\?|\\.\\.\\.)$')) AS marked,
                   count(*) FILTER (regexp_matches(word, '[A-Za-z]|[^\\x00-\\x7F]')) AS lettered
            FROM u GROUP BY doc_id),
        o AS (SELECT doc_id, max(c) AS top FROM (SELECT doc_id, word, count(*) AS c FROM u GROUP BY doc_id, word) GROUP BY doc_id),
        a AS (
            SELECT w.doc_id, len(ws) AS n_words, length(regexp_replace(t, '[\\x20\\x09-\\x0D]', '', 'g')) AS word_chars,
                   length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.dup, 0) AS n_dup_lines,
                   coalesce(r.n, 0) AS n_repeat_words, coalesce(l.n, 0) AS lines, coalesce(marked, 0) AS marked,
                   coalesce(lettered, 0) AS lettered, coalesce(top, 0) AS top,
                   length(regexp_replace(t, '[^A-Z]', '', 'g')) AS upper, length(regexp_replace(t, '[^A-Za-z]', '', 'g')) AS letters
            FROM w LEFT JOIN r ON r.doc_id = w.doc_id LEFT JOIN l ON l.doc_id = w.doc_id
                   LEFT JOIN m ON m.doc_id = w.doc_id LEFT JOIN o ON o.doc_id = w.doc_id),
        f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a)
        SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
               n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
               NOT (base_failed OR 10 * n_symbols > 3 * n_words OR (letters >= 40 AND 10 * upper > 6 * letters)
                    OR 10 * marked > 3 * n_words OR 10 * lettered < 6 * n_words
                    OR word_chars < 2 * n_words OR word_chars > 14 * n_words
                    OR (lines >= 4 AND 2 * n_dup_lines > lines) OR (n_words >= 20 AND 10 * top > 4 * n_words)) AS kept
        FROM f""",
    "op11_fill_middle": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || doc_id::VARCHAR) AS x FROM documents),
        u AS (
            SELECT doc_id, t, regexp_extract_all(t, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS us,
                   ('0x' || x[1:8])::BIGINT AS h1, ('0x' || x[9:16])::BIGINT AS h2, ('0x' || x[17:24])::BIGINT AS h3, ('0x' || x[25:32])::BIGINT AS h4
            FROM d),
        c AS (
            SELECT *, len(us) AS n, least(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS a, greatest(h1 % (len(us) + 1), h2 % (len(us) + 1)) AS b,
                   CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
                        WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
            FROM u),
        p AS (
            SELECT doc_id, n, form, t, array_to_string(us[1:a], '') AS pre, array_to_string(us[a + 1:b], '') AS mid, array_to_string(us[b + 1:], '') AS suf
            FROM c)
        SELECT doc_id, n::BIGINT AS n, form,
               CASE WHEN form <> 'plain' THEN length(pre)::BIGINT END AS prefix_chars,
               CASE WHEN form <> 'plain' THEN length(mid)::BIGINT END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                      ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
               sha256(t) AS restored_sha256
        FROM p""",
    "op12_phrase_graph": f"""
        WITH d AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
        p AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS ws FROM d),
        g AS (
            SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase
            FROM (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM p), (VALUES (1), (2), (3)) v(k) WHERE i + k - 1 <= len(ws)),
        f AS (SELECT lang, k, phrase, count(*) AS c FROM g GROUP BY lang, k, phrase),
        c AS (SELECT lang, k, phrase, c, string_split(phrase, ' ') AS ws FROM f WHERE k >= 2 AND c >= 10),
        o AS (
            SELECT lang, part, max(c) AS longer
            FROM (SELECT lang, c, unnest([ws[1] || ' ' || ws[2], ws[2] || ' ' || ws[3]]) AS part FROM c WHERE k = 3) GROUP BY lang, part),
        kept AS (SELECT c.* FROM c LEFT JOIN o ON c.lang = o.lang AND c.phrase = o.part WHERE longer IS NULL OR 100 * longer < 50 * c.c),
        cuts AS (
            SELECT kept.lang, kept.phrase, kept.c AS a, cut, lf.c AS l, rf.c AS r,
                   ((1000000::HUGEINT * kept.c * kept.c) // (lf.c::HUGEINT * rf.c))::BIGINT AS score
            FROM (SELECT *, unnest(range(1, k)) AS cut FROM kept) kept
            JOIN f lf ON lf.lang = kept.lang AND lf.phrase = array_to_string(kept.ws[1:cut], ' ')
            JOIN f rf ON rf.lang = kept.lang AND rf.phrase = array_to_string(kept.ws[cut + 1:], ' ')),
        low AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM cuts),
        ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM low WHERE nth = 1),
        n AS (SELECT lang, sum(c)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang)
        SELECT ranked.lang, rank, phrase, a, l, r, n.n, score FROM ranked JOIN n ON n.lang = ranked.lang WHERE rank <= 2000""",
}
