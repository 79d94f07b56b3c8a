"""The operators as registered queries over the given tables, and their SQL where it exists."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from panelwise.llm import chat, descent, divergence, encoding, jaccard, materialize, near_vectors, packing, quality, token_counts, top_k, toxicity, variants
from panelwise.llm.common import table
from panelwise.llm.labelled import scored

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")


def query(fn: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_chat_formatting(spark: SparkSession, sf: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    planted = spark.sql(f"SELECT -1L AS conv_id, n AS turn, if(n = 0, 'user', 'assistant') AS role, '{said}' AS text FROM (SELECT explode(sequence(0L, 1L)) AS n)")
    turns = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text").unionByName(planted)
    return chat.digest(chat.examples(turns))


_SAFE = "replace({0}, chr(92), chr(92) || chr(92))"
for _plain, _escaped in (("<s>", "<~s>"), ("</s>", "<~/s>"), ("[INST]", "[~INST]"), ("[/INST]", "[~/INST]")):
    _SAFE = f"replace({_SAFE}, '{_plain}', replace('{_escaped}', '~', chr(92)))"

ORACLES["op1_chat_formatting"] = f"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(20 + length({_SAFE.format('role')}) + length({_SAFE.format('text')})) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id"""


@query
def op3_token_counts(spark: SparkSession, sf: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf, "documents"), WORDS)


@query
def op10_embedding_near_dedup(spark: SparkSession, sf: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf, "embeddings"))


@query
def op9_exact_top_k(spark: SparkSession, sf: str) -> DataFrame:
    return top_k.top_k(table(spark, sf, "embeddings"), is_query="vec_id % 20 = 0")


ORACLES["op9_exact_top_k"] = """
WITH whole AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(CAST(q.v AS DOUBLE[]), CAST(c.v AS DOUBLE[])) AS BIGINT) AS score
  FROM whole q JOIN whole c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20"""


@query
def op2_quality_classifier(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    voters = quality.fit(docs, table(spark, sf, "labels"))
    return scored(quality.quality_scores(docs.select("doc_id", "text"), voters), 0.5)


@query
def op5_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    lexicon = toxicity.fit(docs, table(spark, sf, "labels"))
    return scored(toxicity.toxicity_scores(docs.select("doc_id", "text"), lexicon), 0.7)


@query
def op8_ngram_jaccard_join(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard.jaccard_groups(table(spark, sf, "documents"))


ORACLES["op8_ngram_jaccard_join"] = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM words WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b WHERE 100 * i >= 75 * (x.n + y.n - i)),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM words LEFT JOIN sizes USING (doc_id) LEFT JOIN (SELECT a AS doc_id, min(b) AS low FROM reach GROUP BY a) USING (doc_id)"""


@query
def op4_best_fit_packing(spark: SparkSession, sf: str) -> DataFrame:
    return packing.packed(table(spark, sf, "documents"), WORDS)


@query
def op7_bpe_encoding_decoding(spark: SparkSession, sf: str) -> DataFrame:
    return encoding.digests(encoding.round_trip(table(spark, sf, "documents"), BYTES))


@query
def op6_training_order(spark: SparkSession, sf: str) -> DataFrame:
    """Written to shards and read back: the place, length and ids' digest of each sequence."""
    made = materialize.materialize(table(spark, sf, "documents"), WORDS)
    return materialize.read(spark, made).select("doc_id", "piece", "slot", "shard", "length", F.crc32("ids").alias("ids_crc32"))


@query
def op11_nearest_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    return descent.nearest(table(spark, sf, "embeddings"), is_query="vec_id % 20 = 0")


@query
def op13_source_divergence(spark: SparkSession, sf: str) -> DataFrame:
    return divergence.source_divergence(table(spark, sf, "documents"))


_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_P, _F = "1 + (1000000000::HUGEINT * ({0} + 2)) // ({1} + 2 * {2})", "(({0} - {1}) * ({0} - {1})) // ({0} + {1})"

ORACLES["op13_source_divergence"] = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
occurring AS (SELECT d, lang, source, unnest(terms) AS term FROM docs),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM occurring GROUP BY ALL),
kept AS (SELECT lang, term FROM occurring GROUP BY ALL HAVING count(DISTINCT d) >= 10),
langs AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
sides AS (SELECT DISTINCT lang, source FROM docs),
full_counts AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n FROM sides s JOIN kept k USING (lang) LEFT JOIN counts c USING (lang, source, term)),
shares AS (
  SELECT lang, source, term, n, {_P.format('n', 'sum(n) OVER (PARTITION BY lang, source)', 'v')} AS p FROM full_counts JOIN langs USING (lang)),
whole AS (
  SELECT lang, term, {_P.format('n', 'sum(n) OVER (PARTITION BY lang)', 'v')} AS q
  FROM (SELECT lang, term, sum(n)::HUGEINT AS n FROM full_counts GROUP BY ALL) JOIN langs USING (lang)),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(sum({_F.format('x.p', 'y.p')}), 0)::BIGINT AS value
  FROM sides a JOIN sides b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN shares x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN shares y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term GROUP BY ALL
  UNION ALL
  SELECT lang, source, 'term', term, ({_F.format('p', 'q')})::BIGINT FROM shares JOIN whole USING (lang, term) WHERE n > 0 AND p > q)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM found)
WHERE part = 'pair' OR rank <= 10"""


@query
def op12_spelling_variants(spark: SparkSession, sf: str) -> DataFrame:
    return variants.spelling_variants(table(spark, sf, "documents"))


ORACLES["op12_spelling_variants"] = rf"""
WITH RECURSIVE steps AS (
  SELECT b, b AS c, 0 AS k FROM range(256) t(b)
  UNION ALL SELECT b, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, k + 1 FROM steps WHERE k < 8),
crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS id, unnest(regexp_extract_all({_LOWER}, '[a-z\x{{C0}}-\x{{FF}}]+')) AS run FROM documents),
counted AS (SELECT id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
summed AS (
  SELECT run, n, xor(list_reduce([4294967295] || flatten(list_transform(string_split(id || run, ''),
    lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [192 + unicode(x) // 64, 128 + unicode(x) % 64] END)),
    lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295) AS h FROM counted, crc),
words AS (
  SELECT word, sum(n)::BIGINT AS n
  FROM (SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM summed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
places AS (SELECT word, n, substr(word, 1, i - 1) AS a, substr(word, i + 1) AS b FROM (SELECT *, unnest(range(1, length(word) + 1)) AS i FROM words)),
near AS (
  SELECT x.word, y.word AS other, y.n AS other_n FROM places x JOIN places y ON x.a || '_' || x.b = y.a || '_' || y.b AND x.word <> y.word
  UNION SELECT p.word, w.word, w.n FROM places p JOIN words w ON w.word = p.a || p.b
  UNION SELECT w.word, p.word, p.n FROM places p JOIN words w ON w.word = p.a || p.b),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(less := -other_n, other := other)) AS best FROM near GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -best.less >= 5 * n THEN best.other END AS form, CASE WHEN -best.less >= 5 * n THEN -best.less END AS form_n
  FROM words LEFT JOIN best USING (word)),
ups AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT ups.word, forms.form FROM ups JOIN forms ON forms.word = ups.root WHERE forms.form IS NOT NULL)
SELECT f.word, f.form, u.root, f.n, f.n_near, f.form_n FROM forms f
JOIN (SELECT ups.word, ups.root FROM ups JOIN forms ON forms.word = ups.root WHERE forms.form IS NULL) u USING (word)"""
