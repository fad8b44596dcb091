"""The operators' named queries over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from obslake.llm import chat, html, language, lm, neardup, packing, pieces, quality, resample, search, simhash, tokenfile, trie
from obslake.llm.common import read


def op1_cross_parsing_language(spark, sf_dir):
    return language.identified(read(spark, sf_dir, "documents"))


def op2_pivot_distance_search(spark, sf_dir):
    return search.nearest(read(spark, sf_dir, "embeddings"))


def op3_best_fit_packing(spark, sf_dir):
    return packing.packed_documents(read(spark, sf_dir, "documents"))


def op4_pitman_yor_scores(spark, sf_dir):
    return lm.scored(read(spark, sf_dir, "documents"))


def op5_sampled_pieces(spark, sf_dir):
    return pieces.encoded(read(spark, sf_dir, "documents"))


def op6_preference_formatting(spark, sf_dir):
    found = chat.preferences(*chat.swapped_answers(read(spark, sf_dir, "conversations")))

    def shown(spans):
        return F.array_join(F.transform(spans, lambda span: F.concat_ws("-", span["start"], span["end"])), ",")

    return found.withColumns({name: shown(name) for name in ("chosen_spans", "rejected_spans")})


def op7_simhash_fingerprints(spark, sf_dir):
    return simhash.fingerprinted(read(spark, sf_dir, "documents"))


def op8_host_suffix_array_text(spark, sf_dir):
    return html.main_text(read(spark, sf_dir, "pages"))


def op9_order_minhash_near_duplicates(spark, sf_dir):
    return neardup.near_classes(read(spark, sf_dir, "documents"))


def op10_co_training_quality(spark, sf_dir):
    return quality.scored(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op11_segment_resampling(spark, sf_dir):
    return resample.resampled(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op12_arrow_token_files(spark, sf_dir):
    return tokenfile.placed(read(spark, sf_dir, "documents"))


def op13_conversation_trie(spark, sf_dir):
    return trie.prefix_trie(read(spark, sf_dir, "conversations"), block=trie.BLOCK)


QUERIES = {
    "op1_cross_parsing_language": op1_cross_parsing_language,
    "op2_pivot_distance_search": op2_pivot_distance_search,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_pitman_yor_scores": op4_pitman_yor_scores,
    "op5_sampled_pieces": op5_sampled_pieces,
    "op6_preference_formatting": op6_preference_formatting,
    "op7_simhash_fingerprints": op7_simhash_fingerprints,
    "op8_host_suffix_array_text": op8_host_suffix_array_text,
    "op9_order_minhash_near_duplicates": op9_order_minhash_near_duplicates,
    "op10_co_training_quality": op10_co_training_quality,
    "op11_segment_resampling": op11_segment_resampling,
    "op12_arrow_token_files": op12_arrow_token_files,
    "op13_conversation_trie": op13_conversation_trie,
}

#: a part of a WITH clause: the 256 codes of CRC-32
_CODES = """
        codes AS (
            SELECT list(code ORDER BY n) AS codes FROM (
                SELECT n, list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, n) AS code
                FROM (SELECT unnest(range(256)) AS n)
            )
        )"""


def _crc32(text: str) -> str:
    """SQL for the CRC-32 of a text's UTF-8 bytes where `codes` is in scope."""
    numbers = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda d: CAST('0x' || d AS BIGINT))"
    return f"xor(4294967295, list_reduce({numbers}, lambda c, b: xor(c >> 8, codes[xor(c & 255, b) + 1]), 4294967295))"


SQL: dict[str, str] = {
    "op2_pivot_distance_search": """
        WITH v AS (
            SELECT CAST(vec_id AS BIGINT) AS vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
            FROM embeddings
            WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id AS vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM v a JOIN v b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
        FROM scored QUALIFY rank <= 5
    """,
    "op6_preference_formatting": """
        WITH said AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
            FROM conversations WHERE conv_id IS NOT NULL AND turn IS NOT NULL
        ), last AS (
            SELECT conv_id, turn AS last, text FROM said WHERE role = 'assistant'
            QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC, text DESC) = 1
        ), paired AS (
            SELECT a.conv_id, a.last, b.text AS other FROM last a JOIN last b ON xor(a.conv_id, 1) = b.conv_id
        ), sides AS (
            SELECT conv_id AS pair_id, 0 AS side, turn, role, text FROM said JOIN paired USING (conv_id)
            UNION ALL
            SELECT conv_id, 1, turn, role, CASE WHEN turn = last AND role = 'assistant' THEN other ELSE text END
            FROM said JOIN paired USING (conv_id)
        ), rendered AS (
            SELECT pair_id, side, role, text, '<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) AS rendered,
                row_number() OVER (PARTITION BY pair_id, side ORDER BY turn, role, text) AS place
            FROM sides
        ), placed AS (
            SELECT *, sum(length(rendered)) OVER (PARTITION BY pair_id, side ORDER BY place) AS upto FROM rendered
        ), compared AS (
            SELECT coalesce(a.pair_id, b.pair_id) AS pair_id,
                coalesce(min(coalesce(a.place, b.place)) FILTER (a.rendered IS DISTINCT FROM b.rendered) - 1, count(*)) AS prompt_turns
            FROM (SELECT * FROM placed WHERE side = 0) a
            FULL JOIN (SELECT * FROM placed WHERE side = 1) b ON a.pair_id = b.pair_id AND a.place = b.place
            GROUP BY ALL
        )
        SELECT pair_id,
            coalesce(string_agg(rendered, '' ORDER BY place) FILTER (side = 0 AND place <= prompt_turns), '') AS prompt,
            CAST(any_value(prompt_turns) AS INTEGER) AS prompt_turns,
            coalesce(string_agg(rendered, '' ORDER BY place) FILTER (side = 0 AND place > prompt_turns), '') AS chosen,
            coalesce(string_agg(rendered, '' ORDER BY place) FILTER (side = 1 AND place > prompt_turns), '') AS rejected,
            coalesce(string_agg((upto - length(text) - 11) || '-' || (upto - 1), ',' ORDER BY place)
                FILTER (side = 0 AND place > prompt_turns AND role = 'assistant'), '') AS chosen_spans,
            coalesce(string_agg((upto - length(text) - 11) || '-' || (upto - 1), ',' ORDER BY place)
                FILTER (side = 1 AND place > prompt_turns AND role = 'assistant'), '') AS rejected_spans
        FROM placed JOIN compared USING (pair_id) GROUP BY pair_id
    """,
    "op11_segment_resampling": f"""
        WITH {_CODES}, texts AS (
            SELECT 0 AS side, row_number() OVER () AS row, doc_id, text FROM documents
            UNION ALL SELECT 1, row_number() OVER (), NULL, text FROM benchmark
        ), words AS (
            SELECT side, row, doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS words
            FROM texts
        ), features AS (
            SELECT side, row, unnest(words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) AS feature
            FROM words
        ), hashed AS (
            SELECT feature, {_crc32("feature")} % 10000 AS bucket FROM (SELECT DISTINCT feature FROM features), codes
        ), counted AS (
            SELECT bucket, CAST(count(*) FILTER (side = 0) AS DOUBLE) AS s, CAST(count(*) FILTER (side = 1) AS DOUBLE) AS t
            FROM features JOIN hashed USING (feature) GROUP BY bucket
        ), totals AS (
            SELECT sum(s) AS corpus, sum(t) AS target FROM counted
        ), gains AS (
            SELECT bucket, floor(1000 * ln((t + 1) * (corpus + 10000) / ((s + 1) * (target + 10000)))) AS gain FROM counted, totals
        ), weights AS (
            SELECT row, count(*) AS n_features, floor(sum(gain) / count(*)) AS weight
            FROM features JOIN hashed USING (feature) JOIN gains USING (bucket) WHERE side = 0 GROUP BY row
        ), scored AS (
            SELECT row, doc_id, len(words) >= 20 AND doc_id IS NOT NULL AS may,
                coalesce(n_features, 0) AS n_features, CAST(coalesce(weight, 0) AS BIGINT) AS weight,
                CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(sha256('7:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE)
                    / 4294967296))) AS BIGINT) AS score
            FROM words LEFT JOIN weights USING (row) WHERE side = 0
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY may ORDER BY score DESC, doc_id) AS place, count(*) OVER (PARTITION BY may) AS n FROM scored
        )
        SELECT doc_id, n_features, weight, score, CASE WHEN may AND place <= 25 * n // 100 THEN place END AS rank FROM ranked
    """,
    "op13_conversation_trie": f"""
        WITH {_CODES}, digests AS (
            SELECT conv_id, turn, coalesce(text, '') AS text,
                sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS digest
            FROM conversations WHERE conv_id IS NOT NULL
        ), turns AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) AS place FROM digests
        ), convs AS (
            SELECT c, c - c % 5 AS base, {_crc32("CAST(c AS VARCHAR)")} % 9 AS h FROM (SELECT DISTINCT conv_id AS c FROM digests), codes
        ), rebuilt AS (
            SELECT c, 0 AS part, place, digest, text FROM convs JOIN turns ON conv_id = base WHERE c <> base AND place <= h
            UNION ALL
            SELECT c, 1, place, digest, text FROM convs JOIN turns ON conv_id = c WHERE c = base OR place > h
        ), paths AS (
            SELECT c, coalesce(list(digest ORDER BY part, place) FILTER (digest IS NOT NULL), []) AS path,
                coalesce(list(octet_length(encode(text)) ORDER BY part, place) FILTER (digest IS NOT NULL), []) AS sizes
            FROM convs LEFT JOIN rebuilt USING (c) GROUP BY c
        ), prefixes AS (
            SELECT c, unnest(range(0, len(path) + 1)) AS depth, path, sizes FROM paths
        ), nodes AS (
            SELECT path[1:depth] AS node, CAST(depth AS BIGINT) AS depth, min(c) AS conv_id, count(*) AS n_convs,
                (count(*) - 1) * coalesce(any_value(sizes[depth]), 0) AS saved,
                sha256(coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (len(path) = depth), '')) AS ends_sha256
            FROM prefixes GROUP BY node, prefixes.depth
        ), parents AS (
            SELECT a.*, b.conv_id AS parent_conv_id FROM nodes a LEFT JOIN nodes b ON a.depth = b.depth + 1 AND a.node[1:b.depth] = b.node
        ), counted AS (
            SELECT a.*, (SELECT count(*) FROM nodes b WHERE b.depth = a.depth + 1 AND b.node[1:a.depth] = a.node) AS n_children FROM parents a
        )
        SELECT a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children,
            CAST(count(*) FILTER (b.n_children = 0) AS BIGINT) AS n_leaves, CAST(sum(b.saved) AS BIGINT) AS saved_tokens, a.ends_sha256
        FROM counted a JOIN counted b ON b.depth >= a.depth AND b.node[1:a.depth] = a.node
        GROUP BY a.node, a.conv_id, a.depth, a.parent_conv_id, a.n_convs, a.n_children, a.ends_sha256
    """,
}
