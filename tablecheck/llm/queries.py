"""The registered queries of this folder and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, chaining, jaccard, multiindex, packing, pstable, quality, runs, secrets, token_counts, toxicity, trie, warc


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_secret_ownership(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents")
    return secrets.digest(secrets.scan(docs, repo=F.concat_ws("/", "source", "lang")))


def op2_min_slack_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(_read(spark, sf_dir, "documents"), packing.WordEncoder(public_tokenizers.path("word_bpe_49k.json"), end_id=2))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op3_warc_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = warc.chunk_rows(warc.plan_records(_read(spark, sf_dir, "pages")))
    table = warc.read_archives(warc.write_archives(chunks))
    number = lambda c: F.regexp_extract(c, "^<urn:record:(.*)>$", 1).try_cast("long")
    return table.where("is_last").select(
        number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"),
        (F.col("payload_digest") == F.col("declared_digest")).alias("intact"), (F.col("chunk_no") + 1).alias("n_chunks"),
    )


def op4_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.Vocabulary.read(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    coded = bpe.encode_decode(_read(spark, sf_dir, "documents"), vocabulary)
    return coded.select("doc_id", F.expr("octet_length(ids) div 4").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op5_ordinal_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, _read(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", F.round("severity", 6).alias("severity"), F.round("p_toxic", 6).alias("p_toxic"), "grade", "toxic")


def op6_collinear_chaining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chaining.passages(_read(spark, sf_dir, "documents")).drop("version").withColumnRenamed("ref_id", "ref_doc_id")


def op7_grouped_prefix_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(_read(spark, sf_dir, "documents"))


def op8_pstable_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pstable.near_vectors(_read(spark, sf_dir, "embeddings"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counter = token_counts.Counter(public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.PATTERN)
    return token_counts.count_tokens(_read(spark, sf_dir, "documents"), counter)


def op10_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(_read(spark, sf_dir, "documents"))


def op11_inverted_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return multiindex.search(_read(spark, sf_dir, "embeddings"), asks=F.col("id") % 20 == 0)


def op12_synchronising_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return runs.digest(runs.periodic_runs(_read(spark, sf_dir, "documents"), text=runs.planted()))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = F.col("conv")
    return trie.prefix_trie(_read(spark, sf_dir, "conversations"), head=F.pmod(F.crc32(conv.cast("string")), F.lit(6)), base=conv - conv % 100, max_head=5)


QUERIES = {
    "op1_secret_ownership": op1_secret_ownership,
    "op2_min_slack_packing": op2_min_slack_packing,
    "op3_warc_chunks": op3_warc_chunks,
    "op4_byte_bpe": op4_byte_bpe,
    "op5_ordinal_toxicity": op5_ordinal_toxicity,
    "op6_collinear_chaining": op6_collinear_chaining,
    "op7_grouped_prefix_join": op7_grouped_prefix_join,
    "op8_pstable_vectors": op8_pstable_vectors,
    "op9_token_counts": op9_token_counts,
    "op10_quality_cascade": op10_quality_cascade,
    "op11_inverted_multi_index": op11_inverted_multi_index,
    "op12_synchronising_runs": op12_synchronising_runs,
    "op13_prefix_trie": op13_prefix_trie,
}


def _secret_spans(kind: int, pattern: str, group: int, least: int) -> str:
    pattern = pattern.replace("'", "''")
    return f"""SELECT doc_id, owner, repo, {kind} AS kind, i, hits[i] AS hit, vals[i] AS val,
      list_sum(list_transform(gaps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS start
    FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM (
      SELECT doc_id, owner, repo, string_split_regex(text, '{pattern}') AS gaps, regexp_extract_all(text, '{pattern}') AS hits, regexp_extract_all(text, '{pattern}', {group}) AS vals
      FROM d WHERE regexp_matches(text, '{pattern}')))
    WHERE length(vals[i]) >= {least}"""


_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

#: CRC-32 of a decimal number: bytes by list_reduce, eight steps of the reflected polynomial each.
_CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split({}::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
  lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""

ORACLES: dict[str, str] = {
    "op1_secret_ownership": f"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS owner, concat_ws('/', source, lang) AS repo, coalesce(text, '') AS text FROM documents),
found AS ({" UNION ALL ".join(_secret_spans(*x) for x in ((0, secrets.ASSIGN, 1, 6), (1, "AKIA[A-Z0-9]{16,}", 0, 20), (2, "[0-9a-f]{24,}", 0, 24), (3, "[A-Za-z0-9+/_-]{20,}", 0, 20)))}),
spans AS (SELECT *, start + length(hit) AS stop FROM found WHERE kind < 3 OR (regexp_matches(val, '[0-9]') AND regexp_matches(val, '[a-z]') AND regexp_matches(val, '[A-Z]'))),
apart AS (SELECT * FROM spans s WHERE kind < 3 OR NOT EXISTS (SELECT 1 FROM spans b WHERE b.doc_id = s.doc_id AND b.kind < 3 AND b.start < s.stop AND s.start < b.stop)),
owned AS (SELECT val, count(DISTINCT owner) AS n_owners, count(DISTINCT (owner, repo)) AS n_repos FROM apart GROUP BY val),
judged AS (SELECT *, n_owners < 3 AND n_repos < 8 AND len(list_distinct(string_split(val, ''))) > 5 AS live, ['assign', 'access', 'hex', 'generic'][kind + 1] || ':' || start || ':' || stop AS name FROM apart JOIN owned USING (val)),
kept AS (SELECT * FROM judged WHERE kind < 3 OR live),
lists AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
  string_agg(name, ',' ORDER BY start, kind) FILTER (kind < 3) AS base, string_agg(name, ',' ORDER BY start, kind) AS spans,
  count(*) FILTER (live) AS n_live, count(*) FILTER (NOT live) AS n_example, max(n_owners) AS max_owners, max(n_repos) AS max_repos FROM kept GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex, sha256(coalesce(base, '')) AS base_sha256,
  coalesce(spans, '') AS spans, coalesce(n_live, 0) AS n_live, coalesce(n_example, 0) AS n_example,
  coalesce(max_owners, 0) AS max_owners, coalesce(max_repos, 0) AS max_repos
FROM documents LEFT JOIN lists USING (doc_id)""",
    "op3_warc_chunks": f"""
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS n, sha256(coalesce(html, '')) AS digest FROM pages),
f AS (SELECT digest, min(page_id) AS first FROM p WHERE n >= 100 GROUP BY digest),
r AS (SELECT p.*, CASE WHEN first <> page_id THEN first END AS refers_to FROM p LEFT JOIN f USING (digest))
SELECT page_id, n AS payload_bytes, digest AS payload_digest, CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to,
  true AS intact, CASE WHEN refers_to IS NULL THEN greatest(1, CAST(ceil(n / {warc.CHUNK_BYTES}.0) AS BIGINT)) ELSE 1 END AS n_chunks FROM r""",
    "op7_grouped_prefix_join": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w FROM documents),
s AS (SELECT doc_id, list_distinct(CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
both_ways AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, t.b FROM reach r JOIN both_ways t ON r.b = t.a)
SELECT doc_id, len(s) AS n_shingles, least(doc_id, coalesce((SELECT min(b) FROM reach WHERE a = doc_id), doc_id)) AS component_id FROM s""",
    "op8_pstable_vectors": """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.x, b.x) >= 0.95),
reach AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM reach r JOIN l ON r.b = l.a),
c AS (SELECT vec_id, (SELECT count(*) FROM l WHERE a = vec_id) AS n_links, least(vec_id, coalesce((SELECT min(b) FROM reach WHERE a = vec_id), vec_id)) AS component_id FROM v)
SELECT *, vec_id = component_id AS kept FROM c""",
    # The exact search: tables of up to 2,000 vectors are searched whole (``least``), larger ones by share.
    "op11_inverted_multi_index": """
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL),
s AS (SELECT a.vec_id AS query_id, b.vec_id, list_inner_product(a.x, b.x) AS score FROM v a JOIN v b ON a.vec_id % 20 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score FROM s QUALIFY rank <= 20""",
    "op13_prefix_trie": f"""
WITH t AS (SELECT conv_id, struct_pack(r := coalesce(role, ''), t := coalesce(text, '')) AS turn, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, conv_id - conv_id % 100 AS base, {_CRC32.format("conv_id")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)),
r AS (SELECT c.conv_id, 0 AS own, pos, turn FROM c JOIN t ON t.conv_id = base AND pos <= h UNION ALL SELECT c.conv_id, 1, pos, turn FROM c JOIN t ON t.conv_id = c.conv_id AND pos > h),
s AS (SELECT conv_id, coalesce(turns, []) AS turns FROM c LEFT JOIN (SELECT conv_id, list(turn ORDER BY own, pos) AS turns FROM r GROUP BY conv_id) USING (conv_id)),
p AS (SELECT conv_id, turns, d, turns[1:d] AS node FROM (SELECT *, unnest(range(len(turns) + 1)) AS d FROM s)),
n AS (SELECT node, d, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (d = len(turns)), '') AS ends FROM p GROUP BY node, d),
k AS (SELECT node[1:d - 1] AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN d > 0 THEN (n_convs - 1) * length(node[d].t) ELSE 0 END AS saved FROM n LEFT JOIN k USING (node)),
u AS (SELECT node[1:a] AS node, sum(saved) AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves FROM (SELECT *, unnest(range(d + 1)) AS a FROM f) GROUP BY 1)
SELECT f.conv_id, f.d AS depth, up.conv_id AS parent_conv_id, f.n_convs, f.n_children, n_leaves, saved_tokens::BIGINT AS saved_tokens, sha256(f.ends) AS ends_sha256
FROM f JOIN u USING (node) LEFT JOIN n up ON f.d > 0 AND up.node = f.node[1:f.d - 1]""",
    "op10_quality_cascade": rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS text, {_WORDS} AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i + 4], ' ') AS gram FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) > 4)),
twice AS (SELECT doc_id, gram FROM g GROUP BY doc_id, gram HAVING count(*) > 1),
r AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM g JOIN twice USING (doc_id, gram), range(5) t(j) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^ 	-
]') GROUP BY doc_id),
c AS (SELECT doc_id, len(w) AS n_words, length(regexp_replace(text, '[ 	-
]', '', 'g')) AS word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols,
  coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_lines, 0) AS n_lines, coalesce(r.n, 0) AS n_repeat_words,
  length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^A-Za-z]', '', 'g')) AS n_letters, length(regexp_replace(text, '[^!]', '', 'g')) AS n_marks
  FROM w LEFT JOIN l USING (doc_id) LEFT JOIN r USING (doc_id)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT (base_failed OR 10 * n_symbols > word_chars OR 10 * n_dup_lines > 3 * n_lines OR 2 * n_upper > n_letters OR 10 * n_marks > 3 * n_words OR NOT word_chars BETWEEN 2 * n_words AND 20 * n_words) AS kept FROM b""",
}
