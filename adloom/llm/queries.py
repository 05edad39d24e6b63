"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

from adloom.llm import (bag_minhash, decision_list, decontaminate, hard_negatives, html_text, language, line_dedup, packing, suffix_dedup,
                        token_alignment, tool_calls, toxicity, warc)

QUERIES = {
    "op1_toxicity": toxicity.op1_toxicity,
    "op2_quality_rules": decision_list.op2_quality_rules,
    "op3_decontamination": decontaminate.op3_decontamination,
    "op4_packing": packing.op4_packing,
    "op5_warc": warc.op5_warc,
    "op6_language": language.op6_language,
    "op7_suffix_dedup": suffix_dedup.op7_suffix_dedup,
    "op8_near_duplicates": bag_minhash.op8_near_duplicates,
    "op9_tool_calls": tool_calls.op9_tool_calls,
    "op10_html_text": html_text.op10_html_text,
    "op11_hard_negatives": hard_negatives.op11_hard_negatives,
    "op12_line_dedup": line_dedup.op12_line_dedup,
    "op13_token_alignment": token_alignment.op13_token_alignment,
}

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words(text: str) -> str:
    return f"coalesce(regexp_extract_all({_LOWER.format(text)}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), [])"


# What learned models, tokenizers, signatures and byte windows decide, SQL does not express;
# those queries are tested against brute force in tests/llm.
ORACLE: dict[str, str] = {
    "op3_decontamination": f"""WITH item AS (SELECT CAST(item_id AS VARCHAR) AS id, {_words("text")} AS w FROM benchmark),
      parts AS (SELECT DISTINCT id, CASE WHEN len(w) < 10 THEN w ELSE w[k:k + 9] END AS part
        FROM (SELECT id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS k FROM item WHERE len(w) > 0)),
      doc AS (SELECT doc_id, {_words("text")} AS w FROM documents),
      size AS (SELECT DISTINCT len(part) AS n FROM parts),
      place AS (SELECT doc_id, k, n, w[k:k + n - 1] AS part
        FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM doc, size WHERE len(w) >= n)),
      hit AS (SELECT doc_id, k, n, id FROM place JOIN parts USING (part)),
      counted AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(k, k + n)) AS pos FROM hit) GROUP BY doc_id),
      named AS (SELECT doc_id, count(DISTINCT id) AS n_items, string_agg(DISTINCT id, ',' ORDER BY id) AS ids FROM hit GROUP BY doc_id)
      SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
        sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
      FROM doc LEFT JOIN counted USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op5_warc": """WITH page AS (SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
      led AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM page)
      SELECT page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
          (CAST('0x' || substr(hex, 1 + CAST(5 * (i // 4) AS INTEGER), 5) AS BIGINT) >> CAST(15 - 5 * (i % 4) AS INTEGER)) & 31 AS INTEGER), 1)), '') AS payload_digest,
        CASE WHEN first = page_id THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN first <> page_id THEN first END AS refers_to FROM led""",
    "op9_tool_calls": """WITH RECURSIVE call AS (SELECT conv_id, turn, text, CASE WHEN role = 'user' THEN 'ask' ELSE 'configure' END AS name,
          turn - 2 AS back FROM conversations WHERE role IN ('user', 'system')),
      linked AS (SELECT c.*, d.turn AS dep FROM call c LEFT JOIN call d ON c.conv_id = d.conv_id AND c.back = d.turn),
      placed AS (SELECT conv_id, turn, 0 AS level FROM linked WHERE dep IS NULL
        UNION ALL SELECT l.conv_id, l.turn, p.level + 1 FROM linked l JOIN placed p ON l.conv_id = p.conv_id AND l.dep = p.turn),
      answer AS (SELECT conv_id, turn - 1 AS turn, min(text) AS result, count(*) AS n FROM conversations
        WHERE role IS NULL OR role NOT IN ('user', 'system') GROUP BY ALL),
      judged AS (SELECT *, concat_ws('; ',
          CASE WHEN name = 'ask' AND length(text) < 40 THEN '$.question: too short' WHEN name = 'configure' AND length(text) < 1 THEN '$.instructions: too short' END,
          CASE WHEN back >= 0 AND dep IS NULL THEN concat('unknown dependency call-', conv_id, '-', back) END) AS errors FROM linked)
      SELECT conv_id, concat('call-', conv_id, '-', turn) AS call_id, turn, name, CAST(level AS INTEGER) AS level,
        row_number() OVER (PARTITION BY conv_id ORDER BY level, turn) - 1 AS call_order, CAST(coalesce(n, 0) AS BIGINT) AS n_results,
        false AS orphan, errors = '' AS valid, errors,
        concat('{"arguments":{', CASE WHEN name = 'ask' THEN concat('"question":', to_json(text), ',"turn":', turn) ELSE concat('"instructions":', to_json(text)) END,
          '},"id":"call-', conv_id, '-', turn, '","name":"', name, '","result":', coalesce(CAST(to_json(result) AS VARCHAR), 'null'), '}') AS message
      FROM judged JOIN placed USING (conv_id, turn) LEFT JOIN answer USING (conv_id, turn)
      UNION ALL SELECT conv_id, concat('call-', conv_id, '-', turn), turn + 1, NULL, NULL, NULL, n, true, false, 'no call', NULL
      FROM answer ANTI JOIN call USING (conv_id, turn)""",
    "op11_hard_negatives": """WITH v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q FROM embeddings
        WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      pair AS (SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
        FROM v a JOIN v b ON a.vec_id % 50 = 0 AND b.vec_id <> a.vec_id),
      positive AS (SELECT anchor_id, other AS positive_id, score AS positive_score FROM pair WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= 5)
      SELECT anchor_id, positive_id, CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS INTEGER) AS rank,
        other AS negative_id, positive_score, score AS negative_score
      FROM positive JOIN pair USING (anchor_id) WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
      QUALIFY rank <= 3""",
    "op12_line_dedup": f"""WITH line AS (SELECT n, k, lines[k] AS line, {_LOWER.format("trim(lines[k], e' \\t\\n\\x0B\\f\\r')")} AS key
        FROM (SELECT n, lines, unnest(range(1, len(lines) + 1)) AS k
          FROM (SELECT row_number() OVER () AS n, string_split(coalesce(text, ''), e'\n') AS lines FROM documents))),
      common AS (SELECT key FROM line WHERE key <> '' GROUP BY key HAVING count(DISTINCT n) >= 10),
      kept AS (SELECT n, count(*) AS n_lines, count(c.key) AS n_dropped, coalesce(string_agg(line, e'\n' ORDER BY k) FILTER (c.key IS NULL), '') AS text
        FROM line LEFT JOIN common c ON line.key = c.key GROUP BY n)
      SELECT doc_id, n_lines, n_dropped, sha256(kept.text) AS kept_sha256
      FROM (SELECT row_number() OVER () AS n, doc_id FROM documents) JOIN kept USING (n)""",
}
