"""The queries over the shared test tables, each with the SQL it must agree with, if SQL can say it."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybrook.llm import (
    op1_bpe,
    op2_secrets,
    op3_embeddings,
    op4_ngram_join,
    op5_warc,
    op6_lm_scores,
    op7_decontaminate,
    op8_html,
    op9_toxicity,
    op10_licenses,
    op11_chunk_bpe,
    op12_spelling,
    op13_alignment,
)
from tallybrook.llm.common import stored, table
from tallybrook.scratch import shared_folder

QUERIES: dict = {}
SQL: dict[str, str] = {}


def _query(run):
    QUERIES[run.__name__] = run
    return run


def tokenizer() -> tuple[bytes, str]:
    """Ranks and pattern of the byte-level vocabulary that the queries use."""
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return Path(path).read_bytes(), public_tokenizers.PATTERN


@_query
def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document; counts and digests."""
    return op1_bpe.digests(table(spark, sf_dir, "documents"), *tokenizer())


@_query
def op5_warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write all pages as WARC records and read the archives back."""
    folder = shared_folder(spark, "warc")
    op5_warc.write_archives(table(spark, sf_dir, "pages"), folder)
    records = op5_warc.read_archives(spark, folder, payloads=False)
    return records.select(
        op5_warc.page_of("record_id").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", op5_warc.page_of("refers_to").alias("refers_to"),
    )


@_query
def op10_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and labels of every document."""
    return op10_licenses.detect(table(spark, sf_dir, "documents")).drop("detections")


@_query
def op2_secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document, by fixed patterns and by the character models."""
    docs = table(spark, sf_dir, "documents")
    model = op2_secrets.train(op2_secrets.labelled_samples(docs))
    found = op2_secrets.find(docs, model)
    return found.select(
        "doc_id",
        *[op2_secrets.count("base", kind).alias(f"n_{kind}") for kind in ("assign", "access", "hex")],
        F.sha2(op2_secrets.joined("base"), 256).alias("base_sha256"),
        op2_secrets.joined("spans").alias("spans"),
    )


@_query
def op9_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document, learned from the labels outside the held-out fifth."""
    docs = table(spark, sf_dir, "documents")
    model = op9_toxicity.train(docs, table(spark, sf_dir, "labels"))
    held_out = F.coalesce(op9_toxicity.remainder(F.col("doc_id")) == 0, F.lit(False))
    return op9_toxicity.score(docs, model).select(
        "doc_id", held_out.alias("held_out"), "score", "predicted"
    )


@_query
def op7_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document and the benchmark items that it contains."""
    return op7_decontaminate.contained(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


@_query
def op6_lm_scores_by_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How much likelier each document is under a model of good documents than of all."""
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return op6_lm_scores.score(docs, op6_lm_scores.train(docs, good))


@_query
def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents alike in at least 85 % of their four-word shingles."""
    return op4_ngram_join.near_duplicates(table(spark, sf_dir, "documents"), words=4, num=85, den=100)


@_query
def op3_embedding_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of vectors of one label with a cosine of at least 0.98."""
    return op3_embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


# base 32 of a SHA-1 digest: each five hex digits are four characters
SQL["op5_warc_round_trip"] = """WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS h,
    max(page_id) OVER (PARTITION BY coalesce(html, '')) AS top FROM pages)
SELECT page_id, CAST(strlen(html) AS BIGINT) AS payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(((
    CAST('0x' || substr(h, CAST(5 * (i // 4) + 1 AS INT), 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31) + 1 AS INT), 1)
    FOR i IN range(32)], '') AS payload_digest,
  CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id = top THEN NULL ELSE top END AS refers_to
FROM p"""


@_query
def op8_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article of every page, without its host's template."""
    return op8_html.extract(table(spark, sf_dir, "pages"))


def two_tokenizers() -> tuple[str, bytes]:
    """Place of the byte-level tokenizer, and the sentencepiece model."""
    import public_tokenizers

    model = public_tokenizers.path("piece_bpe_32k.model")
    return public_tokenizers.path("byte_bpe_50k.json"), Path(model).read_bytes()


@_query
def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in every document, and how common the links are."""
    found = op13_alignment.linked(table(spark, sf_dir, "documents"), *two_tokenizers())
    return op13_alignment.scored(stored(found, "token-links"))


@_query
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents one letter from a far more frequent word, and where that leads."""
    vocabulary = stored(op12_spelling.words(table(spark, sf_dir, "documents")), "vocabulary")
    return op12_spelling.variants(vocabulary)


# crc32 byte by byte from its table of 256; near words share all but one position, or one is
# the other without a position
SQL["op12_spelling_variants"] = """WITH RECURSIVE t AS (
  SELECT [list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) FOR i IN range(256)] AS crc),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run FROM documents),
counted AS (
  SELECT run, coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run AS tagged, count(*) AS n FROM runs
  WHERE length(run) >= 6 GROUP BY ALL),
marked AS (
  SELECT run, n, xor(4294967295, list_reduce(
    list_prepend(4294967295, [CAST('0x' || substr(hex(tagged), CAST(2 * i + 1 AS INT), 2) AS BIGINT)
      FOR i IN range(CAST(strlen(tagged) AS BIGINT))]),
    lambda c, b: xor(t.crc[CAST((xor(c, b) & 255) + 1 AS INT)], c >> 8))) AS h FROM counted, t),
spelled AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) + 2 AS INT))
    ELSE run END AS word, n FROM marked),
v AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cut AS (
  SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)),
near AS (
  SELECT a.word, b.word AS other, b.n AS m FROM cut a JOIN cut b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT a.word, b.word, b.n FROM cut a JOIN v b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cut a JOIN v b ON a.rest = b.word),
ranked AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY m DESC, other) AS r FROM near),
best AS (SELECT word, count(*) AS n_near, max(m) FILTER (r = 1) AS m, max(other) FILTER (r = 1) AS other FROM ranked GROUP BY word),
forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN m >= 5 * n THEN other END AS form,
    CASE WHEN m >= 5 * n THEN m END AS form_n FROM v LEFT JOIN best USING (word)),
walk AS (
  SELECT word, word AS root FROM forms WHERE form IS NULL
  UNION ALL SELECT f.word, w.root FROM walk w JOIN forms f ON f.form = w.word)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN walk USING (word)"""


@_query
def op11_chunk_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every document with the word-end vocabulary; counts and digests."""
    import public_tokenizers

    path = public_tokenizers.path("word_bpe_49k.json")
    return op11_chunk_bpe.digests(table(spark, sf_dir, "documents"), path)


# Words of a text: runs of anything but ASCII white space, A-Z in lower case.
_WORDS = """regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+')"""

# all runs of five words, or of as many as the shortest items have, against those of the items
SQL["op7_benchmark_leaks"] = f"""WITH item AS (
  SELECT row_number() OVER () AS r, item_id, {_WORDS} AS w FROM benchmark),
held AS (
  SELECT DISTINCT r, item_id, least(len(w), 5) AS size, array_to_string(w[k : k + least(len(w), 5) - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS k FROM item WHERE len(w) > 0)),
need AS (SELECT r, count(*) AS n FROM held GROUP BY r),
doc AS (SELECT row_number() OVER () AS d, doc_id, {_WORDS} AS w FROM documents),
runs AS (
  SELECT DISTINCT d, doc_id, size, array_to_string(w[k : k + size - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS k
    FROM doc, (SELECT DISTINCT size FROM held) WHERE len(w) >= size))
SELECT doc_id, item_id, count(*) / any_value(n) AS containment
FROM runs JOIN held USING (size, run) JOIN need USING (r)
GROUP BY d, doc_id, r, item_id HAVING count(*) >= 0.8 * any_value(n) - 1e-12"""


def _reachable(links: str) -> str:
    """Smallest id reachable from each id of ``links`` (a, b), both ways in it."""
    return f"""reach AS (
  SELECT a AS id, b AS other FROM {links}
  UNION SELECT r.id, l.b FROM reach r JOIN {links} l ON r.other = l.a)"""


# pairs of sets that share a shingle, their intersection counted
SQL["op4_ngram_jaccard"] = f"""WITH RECURSIVE doc AS (SELECT doc_id, {_WORDS} AS w FROM documents),
held AS (
  SELECT DISTINCT doc_id, array_to_string(w[k : k + least(len(w), 4) - 1], ' ') AS run
  FROM (SELECT *, unnest(range(1, greatest(len(w) - 3, 1) + 1)) AS k FROM doc WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM held GROUP BY doc_id),
shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n FROM held x JOIN held y USING (run)
  WHERE x.doc_id <> y.doc_id GROUP BY ALL),
link AS (
  SELECT a, b FROM shared JOIN size s ON a = s.doc_id JOIN size t ON b = t.doc_id
  WHERE 100 * shared.n >= 85 * (s.n + t.n - shared.n)),
{_reachable("link")}
SELECT doc_id, coalesce(size.n, 0) AS n_shingles, least(doc_id, coalesce(low, doc_id)) AS component_id
FROM documents LEFT JOIN size USING (doc_id)
LEFT JOIN (SELECT id, min(other) AS low FROM reach GROUP BY id) ON id = doc_id"""

# every pair of one label; vectors of other lengths never link
SQL["op3_embedding_duplicates"] = f"""WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
  SELECT x.vec_id AS a, y.vec_id AS b FROM v x JOIN v y ON x.label = y.label AND x.vec_id <> y.vec_id
    AND len(x.e) = len(y.e)
  WHERE list_dot_product(x.e, y.e) / sqrt(list_dot_product(x.e, x.e) * list_dot_product(y.e, y.e)) >= 0.98),
{_reachable("link")}
SELECT vec_id, coalesce(n, 0) AS n_links, least(vec_id, coalesce(low, vec_id)) AS component_id,
  vec_id <= coalesce(low, vec_id) AS kept
FROM embeddings LEFT JOIN (SELECT a, count(*) AS n FROM link GROUP BY a) ON a = vec_id
LEFT JOIN (SELECT id, min(other) AS low FROM reach GROUP BY id) ON id = vec_id"""
