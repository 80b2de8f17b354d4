"""The registered queries of this subpackage, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.near_duplicates import jaccard_join

    return jaccard_join(_read(spark, sf_dir, "documents"))


def op2_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.language_model import score_texts

    return score_texts(_read(spark, sf_dir, "documents"))


def op3_kd_tree_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.sharding import shard

    return shard(_read(spark, sf_dir, "documents"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.substrings import repeated_bytes

    return repeated_bytes(_read(spark, sf_dir, "documents"))


def op5_license_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.licenses import scan

    return scan(_read(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.quality import quality_scores

    return quality_scores(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.html import extract

    return extract(_read(spark, sf_dir, "pages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.tokens import token_counts

    return token_counts(_read(spark, sf_dir, "documents"))


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.packing import pack_documents

    return pack_documents(_read(spark, sf_dir, "documents"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.decontaminate import contamination

    return contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.prefix_trie import conversation_trie

    return conversation_trie(_read(spark, sf_dir, "conversations"))


def op12_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.collocations import collocations

    return collocations(_read(spark, sf_dir, "documents"))


def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tidelog.llm.forest import nearest

    return nearest(_read(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": op1_ngram_jaccard_join,
    "op2_lm_scoring": op2_lm_scoring,
    "op3_kd_tree_sharding": op3_kd_tree_sharding,
    "op4_suffix_array_dedup": op4_suffix_array_dedup,
    "op5_license_scans": op5_license_scans,
    "op6_quality_rules": op6_quality_rules,
    "op7_html_extraction": op7_html_extraction,
    "op8_token_counts": op8_token_counts,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_phrase_collocations": op12_phrase_collocations,
    "op13_nearest_neighbours": op13_nearest_neighbours,
}

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

SQL: dict[str, str] = {
    "op1_ngram_jaccard_join": rf"""WITH RECURSIVE t AS (SELECT coalesce(text, '') AS text, min(doc_id) AS tid, count(*) AS n_docs FROM documents WHERE doc_id IS NOT NULL GROUP BY 1),
 w AS (SELECT tid, list_filter(string_split_regex(translate(text, '{_UPPER}', '{_UPPER.lower()}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM t),
 sh AS (SELECT DISTINCT tid, array_to_string(w[i : i + 4], ' ') AS s FROM (SELECT tid, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
 n AS (SELECT tid, count(*) AS n FROM sh GROUP BY tid),
 common AS (SELECT x.tid AS a, y.tid AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.tid <> y.tid GROUP BY ALL),
 link AS (SELECT a, b FROM common JOIN n p ON p.tid = a JOIN n q ON q.tid = b WHERE 5 * c >= 4 * (p.n + q.n - c)),
 reach AS (SELECT DISTINCT a AS tid, a AS root FROM link UNION SELECT link.b, reach.root FROM reach JOIN link ON link.a = reach.tid),
 class AS (SELECT tid, min(root) AS class_id FROM reach GROUP BY tid),
 links AS (SELECT a AS tid, count(*) AS n_links, sum(n_docs) AS linked FROM link JOIN t ON t.tid = b GROUP BY a)
 SELECT d.doc_id, CASE WHEN n.tid IS NULL THEN d.doc_id ELSE coalesce(class_id, t.tid) END AS class_id, coalesce(n_links, 0) AS n_links, CAST(CASE WHEN n.tid IS NULL THEN 0 ELSE n_docs - 1 + coalesce(linked, 0) END AS BIGINT) AS n_linked_docs
 FROM documents d JOIN t ON t.text = coalesce(d.text, '') LEFT JOIN n ON n.tid = t.tid LEFT JOIN class ON class.tid = t.tid LEFT JOIN links ON links.tid = t.tid WHERE d.doc_id IS NOT NULL""",
    "op4_suffix_array_dedup": """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents WHERE doc_id IS NOT NULL),
 w AS (SELECT doc_id, i, substr(h, 2 * i + 1, 100) AS s FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 49)) AS i FROM d)),
 f AS (SELECT s, min(doc_id) AS m FROM w GROUP BY s),
 c AS (SELECT doc_id, i FROM w JOIN f USING (s) WHERE m < doc_id),
 g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS fresh FROM c),
 r AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM g),
 sp AS (SELECT doc_id, run, min(i) AS a, max(i) + 50 AS b FROM r GROUP BY doc_id, run),
 k AS (SELECT doc_id, b AS x, lead(a) OVER (PARTITION BY doc_id ORDER BY a) AS y FROM sp UNION ALL SELECT doc_id, 0, min(a) FROM sp GROUP BY doc_id),
 kept AS (SELECT k.doc_id, string_agg(substr(h, CAST(2 * x + 1 AS BIGINT), CAST(coalesce(2 * y, length(h)) - 2 * x AS BIGINT)), '' ORDER BY x) AS h FROM k JOIN d USING (doc_id) GROUP BY k.doc_id),
 n AS (SELECT doc_id, CAST(sum(b - a) AS BIGINT) AS n_removed, count(*) AS n_spans FROM sp GROUP BY doc_id)
 SELECT d.doc_id, CAST(length(d.h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(kept.h, d.h))) AS kept_sha256 FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)""",
    "op12_phrase_collocations": rf"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, string_split_regex(translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents),
 p AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM (SELECT lang, unnest(ps) AS p FROM d)),
 g AS (SELECT lang, m, array_to_string(w[i : i + m - 1], ' ') AS phrase FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM p, (SELECT unnest([1, 2, 3, 4]) AS m))),
 f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL),
 c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE m >= 2 AND a >= 30),
 cut AS (SELECT c.lang, c.phrase, c.m, c.a, k, l.a AS l, r.a AS r, CAST((2000000::HUGEINT * c.a) // (l.a + r.a) AS BIGINT) AS score FROM (SELECT *, unnest(range(1, m)) AS k FROM c) c
 JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1 : k], ' ') JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[k + 1 : c.m], ' ')),
 best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
 kept AS (SELECT * FROM best b WHERE NOT EXISTS (SELECT 1 FROM c y WHERE y.lang = b.lang AND y.m > b.m AND 100 * y.a >= 80 * b.a AND contains(' ' || y.phrase || ' ', ' ' || b.phrase || ' '))),
 n AS (SELECT lang, CAST(sum(a) AS BIGINT) AS n FROM f WHERE m = 1 GROUP BY lang)
 SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept JOIN n USING (lang) QUALIFY rank <= 2000""",
    # exact neighbours: tables of up to budget / trees rows are searched exhaustively
    "op13_nearest_neighbours": """WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings WHERE vec_id IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0)
 SELECT q.vec_id AS query_id, CAST(row_number() OVER (PARTITION BY q.vec_id ORDER BY list_inner_product(q.v, c.v) DESC, c.vec_id) AS INTEGER) AS rank, c.vec_id, list_inner_product(q.v, c.v) AS score
 FROM v q JOIN v c ON q.vec_id % 20 = 0 AND c.vec_id <> q.vec_id QUALIFY rank <= 20""",
    "op11_conversation_trie": r"""WITH o AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
 ls AS (SELECT conv_id, list(struct_pack(r := role, t := text) ORDER BY turn NULLS FIRST, role, text) AS own FROM o GROUP BY conv_id),
 crc AS (SELECT conv_id, own, xor(list_reduce(flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
 lambda c, v: CASE WHEN xor(c, v) % 2 = 1 THEN xor(xor(c, v) // 2, 3988292384) ELSE xor(c, v) // 2 END, 4294967295::BIGINT), 4294967295::BIGINT) % 4 AS h FROM ls),
 re AS (SELECT a.conv_id, list_concat(coalesce(b.own[1 : a.h], []), a.own[a.h + 1 :]) AS w FROM crc a LEFT JOIN ls b ON b.conv_id = a.conv_id - a.conv_id % 20),
 pre AS (SELECT conv_id, d, len(w) AS n, md5(CAST(to_json(w[1 : d]) AS VARCHAR)) AS k, CASE WHEN d > 0 THEN md5(CAST(to_json(w[1 : d - 1]) AS VARCHAR)) END AS pk, CASE WHEN d > 0 THEN w[d].t ELSE '' END AS txt FROM (SELECT conv_id, w, unnest(range(0, len(w) + 1)) AS d FROM re)),
 nd AS (SELECT k, d AS depth, min(conv_id) AS conv_id, any_value(pk) AS pk, count(*) AS n_convs, len(list_filter(string_split_regex(any_value(txt), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS words,
 sha256(coalesce(string_agg(CASE WHEN n = d THEN CAST(conv_id AS VARCHAR) END, ',' ORDER BY conv_id), '')) AS ends_sha256 FROM pre GROUP BY k, d),
 kids AS (SELECT pk AS k, count(*) AS c FROM nd WHERE pk IS NOT NULL GROUP BY pk),
 x AS (SELECT nd.*, coalesce(c, 0) AS n_children FROM nd LEFT JOIN kids USING (k)),
 below AS (SELECT p.k, CAST(sum(CASE WHEN x.n_children = 0 THEN 1 ELSE 0 END) AS BIGINT) AS n_leaves, CAST(sum((x.n_convs - 1) * x.words) AS BIGINT) AS saved_tokens FROM x JOIN pre p ON p.conv_id = x.conv_id AND p.d <= x.depth GROUP BY p.k)
 SELECT x.conv_id, x.depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens, x.ends_sha256 FROM x JOIN below USING (k) LEFT JOIN nd y ON y.k = x.pk""",
}
