"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadenza.llm import decontaminate, embeddings, html_text, jaccard, packing, pii, ranked_search, shards, substrings, token_counts, toxicity, warc, whitening
from cadenza.llm.scratch import new_path


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data in every document: counts and places of the base kinds, all places, and how many these are."""
    out = pii.find_pii(_read(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("pii", lambda s: s["k"] < pii.BASE)
    counts = [F.size(F.filter("pii", pii.is_kind(kind))).cast("long").alias(f"n_{kind}") for kind in pii.KINDS[: pii.BASE]]
    return out.select("doc_id", *counts, F.sha2(pii.listed(base).cast("binary"), 256).alias("base_sha256"), pii.listed(F.col("pii")).alias("spans"), F.size("pii").cast("long").alias("n_spans"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards by Karmarkar-Karp differencing, equal texts together."""
    out = shards.shard_documents(_read(spark, sf_dir, "documents"), 24)
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The near-duplicate class of every document at a Jaccard similarity of 0.8 of five-word shingles."""
    return jaccard.join_documents(_read(spark, sf_dir, "documents"))


def _vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of at most 4096 tokens."""
    return packing.pack_documents(_read(spark, sf_dir, "documents"), _vocabulary("word_bpe_49k.json"), 4096)


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the words that windows of 50 words share with a smaller doc_id."""
    out = substrings.dedup_substrings(_read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors linked at a cosine of 0.9 or more, whatever their labels."""
    out = embeddings.near_duplicates(_read(spark, sf_dir, "embeddings"), 0.9)
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    return html_text.extract(_read(spark, sf_dir, "pages")).withColumn("n_chars", F.length("text").cast("long"))


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A toxicity score of every document, learned from the labels that aren't held out."""
    documents, labels = _read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")
    grammar = toxicity.train(documents, labels.where(~toxicity.held_out(F.col("doc_id"))))
    out = toxicity.score(documents, grammar)
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tokens of every document."""
    out = token_counts.count_tokens(_read(spark, sf_dir, "documents"), _vocabulary("piece_bpe_32k.model"))
    return out.withColumn("over_limit", F.col("n_tokens") > 4096)


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that contain at least 0.8 of a benchmark item's five-word shingles."""
    return decontaminate.containments(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), 0.8)


def op11_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page as a record of archives that are written and read back; pages with equal payloads revisit the last of them."""
    path = new_path(spark, "archives")
    warc.write_pages(_read(spark, sf_dir, "pages"), path, least=0)
    records = warc.read_records(spark, path, payloads=False)
    columns = [warc.page_of(F.col("record_id")).alias("page_id"), F.col("payload_length").alias("payload_bytes"), "payload_digest", "record_type"]
    return records.select(*columns, warc.page_of(F.col("refers_to")).alias("refers_to"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 documents of highest lexical score for every benchmark item."""
    return ranked_search.search(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), 50)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector on the first 16 components of all different vectors, at unit deviation."""
    return whitening.whiten(_read(spark, sf_dir, "embeddings"), 16)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages of corpus_pipeline over documents."""
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict:
    ops = (op1_pii, op2_sharding, op3_jaccard_join, op4_packing, op5_substring_dedup, op6_embedding_dedup, op7_html_text, op8_toxicity, op9_token_counts, op10_decontamination, op11_warc, op12_ranked_search, op13_whitening, pipeline)
    return {f.__name__: f for f in ops}


def _shingles(table: str, key: str) -> str:
    """SQL: r (a row's number), id and g of each distinct shingle, and n, their number, of a table's texts."""
    words = r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"
    sets = "list_distinct(CASE WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE [array_to_string(w[i : i + 4], ' ') FOR i IN range(1, len(w) - 3)] END)"
    rows = f"SELECT row_number() OVER () AS r, {key} AS id, {words} AS w FROM {table}"
    return f"SELECT r, id, len(s) AS n, unnest(s) AS g FROM (SELECT r, id, {sets} AS s FROM ({rows}) WHERE len(w) > 0)"


OP10_SQL = f"""
WITH items AS ({_shingles("benchmark", "item_id")}), docs AS ({_shingles("documents", "doc_id")})
SELECT d.id AS doc_id, i.id AS item_id, i.n AS n_item, count(*) AS n_shared, count(*)::DOUBLE / i.n AS containment
FROM items i JOIN docs d ON i.g = d.g WHERE i.id IS NOT NULL
GROUP BY d.r, d.id, i.r, i.id, i.n HAVING 10 * count(*) >= 8 * i.n
"""


def _components(links: str) -> str:
    """SQL: reach (a, b) of all pairs that links (a, b), symmetric, join over any number of steps."""
    return f"reach AS (SELECT a, b FROM {links} UNION SELECT r.a, l.b FROM reach r JOIN {links} l ON r.b = l.a)"


OP3_SQL = f"""
WITH RECURSIVE docs AS (SELECT row_number() OVER () AS r, doc_id, text FROM documents), sets AS ({_shingles("(SELECT r AS doc_r, text FROM docs)", "doc_r")}),
shared AS (SELECT a.id AS a, b.id AS b, a.n AS na, b.n AS nb, count(*) AS k FROM sets a JOIN sets b ON a.g = b.g AND a.id <> b.id GROUP BY ALL),
links AS (SELECT a, b FROM shared WHERE 100 * k >= 80 * (na + nb - k)),
{_components("links")}
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, least(d.doc_id, min(o.doc_id)) AS component_id
FROM docs d LEFT JOIN (SELECT DISTINCT id, n FROM sets) s ON s.id = d.r LEFT JOIN reach ON reach.a = d.r LEFT JOIN docs o ON o.r = reach.b
GROUP BY d.r, d.doc_id
"""

OP5_SQL = r"""
WITH docs AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (SELECT doc_id, i, array_to_string(w[i : i + 49], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM docs WHERE doc_id IS NOT NULL)),
seen AS (SELECT doc_id, i, min(doc_id) OVER (PARTITION BY g) AS first FROM windows),
gone AS (SELECT doc_id, list(DISTINCT j) AS js FROM (SELECT doc_id, unnest(range(i, i + 50)) AS j FROM seen WHERE first < doc_id) GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(len(js), 0)::BIGINT AS n_removed,
  sha256(CASE WHEN js IS NULL THEN array_to_string(w, ' ') ELSE array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(js, j)), lambda j: w[j]), ' ') END) AS kept_sha256
FROM docs d LEFT JOIN gone g ON g.doc_id = d.doc_id
"""

OP6_SQL = f"""
WITH RECURSIVE vectors AS (SELECT row_number() OVER () AS r, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
sound AS (
  SELECT r, len(v) AS dim, v, sqrt(list_sum(list_transform(v, lambda c: c * c))) AS norm FROM vectors
  WHERE len(v) > 0 AND list_bool_and(list_transform(v, lambda c: c IS NOT NULL AND isfinite(c))) AND list_bool_or(list_transform(v, lambda c: c <> 0))
),
links AS (SELECT a.r AS a, b.r AS b FROM sound a JOIN sound b ON a.dim = b.dim AND a.r <> b.r WHERE list_dot_product(a.v, b.v) / (a.norm * b.norm) >= 0.9),
{_components("links")},
roots AS (SELECT v.r, least(v.vec_id, min(o.vec_id)) AS component_id FROM vectors v LEFT JOIN reach ON reach.a = v.r LEFT JOIN vectors o ON o.r = reach.b GROUP BY v.r, v.vec_id)
SELECT v.vec_id, (SELECT count(*) FROM links l WHERE l.a = v.r) AS n_links, component_id, coalesce(v.vec_id = component_id, false) AS kept
FROM vectors v JOIN roots USING (r)
"""


_BASE32 = " || ".join(f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((('0x' || substr(code, {5 * k + 1}, 5))::BIGINT >> {s}) & 31)::BIGINT, 1)" for k in range(8) for s in (15, 10, 5, 0))

OP11_SQL = f"""
WITH pages AS (SELECT page_id, encode(coalesce(html, '')) AS payload, sha1(coalesce(html, '')) AS code FROM pages),
groups AS (SELECT *, max(page_id) OVER (PARTITION BY code) AS last FROM pages)
SELECT page_id, octet_length(payload)::BIGINT AS payload_bytes, {_BASE32} AS payload_digest,
  CASE WHEN last IS NOT NULL AND page_id IS DISTINCT FROM last THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM groups
"""

OP12_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents WHERE text IS NOT NULL),
items AS (SELECT row_number() OVER () AS q, item_id, list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark WHERE text IS NOT NULL),
asked AS (SELECT q, item_id, unnest(t) AS term FROM items),
sums AS (SELECT count(*) FILTER (len(t) > 0) AS n, sum(len(t))::BIGINT AS l FROM docs),
held AS (SELECT r, doc_id, size, term, count(*) AS tf FROM (SELECT r, doc_id, len(t) AS size, unnest(t) AS term FROM docs) WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
df AS (SELECT term, count(*) AS df FROM held GROUP BY 1),
parts AS (SELECT r, doc_id, h.term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)))::BIGINT * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * size * n) // l))) AS part FROM held h JOIN df USING (term), sums),
scores AS (SELECT q, item_id, r, doc_id, sum(part)::BIGINT AS score FROM asked JOIN parts USING (term) GROUP BY ALL HAVING sum(part) > 0),
ranked AS (SELECT item_id, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM scores)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def _op1_sql() -> str:
    """Matches in order and their places, from the lengths of the parts between them; checks and context as in ``pii``."""
    letter = r"\p{L}"
    patterns = {
        "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+", "card": "[0-9](?:[ -]?[0-9])+", "phone": r"\+[0-9][ ().0-9-]+[0-9]",
        "iban": r"\b(?:" + pii.IBAN + r")\b", "local": r"\(?[0-9]{2,4}\)?(?:[ /-]?[0-9]{2,4}){2,4}", "secret": "[A-Za-z0-9+/_-]{20,}=*",
    }
    matches = " UNION ALL ".join(f"SELECT r, t, '{kind}' AS kind, {k} AS k, string_split_regex(t, '{p}') AS parts, regexp_extract_all(t, '{p}') AS hits FROM docs" for k, (kind, p) in enumerate(patterns.items()))
    context = {kind: f"regexp_matches(before, '(?i)(?:^|[^{letter}])(?:{pii.CONTEXT[kind]})(?:[^{letter}]|$)')" for kind in ("local", "secret")}
    luhn = "list_sum(list_transform(range(1, length(d) + 1), lambda i: CASE WHEN (length(d) - i) % 2 = 1 THEN (d[i]::INT * 2) // 10 + (d[i]::INT * 2) % 10 ELSE d[i]::INT END)) % 10 = 0"
    turned = "list_transform(range(1, length(b) + 1), lambda i: CASE WHEN b[i] BETWEEN '0' AND '9' THEN b[i] ELSE (ascii(b[i]) - 55)::VARCHAR END)"
    counts = ", ".join(f"count(*) FILTER (kind = '{kind}')::BIGINT AS n_{kind}" for kind in pii.KINDS[: pii.BASE])
    span = "kind || ':' || start || ':' || stop"
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
matches AS ({matches}),
places AS (SELECT r, t, kind, k, hits[i] AS hit, list_sum(list_transform(parts[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(hits[1 : i - 1], lambda x: length(x))), 0) AS start
  FROM (SELECT *, unnest(range(1, len(hits) + 1)) AS i FROM matches)),
found AS (SELECT *, (start + length(hit))::BIGINT AS stop, regexp_replace(hit, '[^0-9]', '', 'g') AS d, replace(hit, ' ', '')[5:] || hit[1:4] AS b,
    substring(t, (greatest(0, start - {pii.CONTEXT_CHARS}) + 1)::BIGINT, (start - greatest(0, start - {pii.CONTEXT_CHARS}))::BIGINT) AS before FROM places),
checked AS (SELECT * FROM found WHERE CASE kind
  WHEN 'email' THEN true
  WHEN 'ip' THEN regexp_full_match(hit, '{pii.PART}(?:\.{pii.PART}){{3}}')
  WHEN 'card' THEN length(d) BETWEEN 12 AND 19 AND {luhn}
  WHEN 'phone' THEN length(d) BETWEEN 9 AND 15
  WHEN 'iban' THEN list_reduce(list_transform(string_split(array_to_string({turned}, ''), ''), lambda c: c::INT), lambda a, c: (a * 10 + c) % 97) = 1
  WHEN 'local' THEN length(d) BETWEEN 7 AND 15 AND {context["local"]} AND NOT regexp_matches(before, '[A-Za-z0-9.+-]$') AND NOT regexp_matches(substring(t, stop + 1, 2), '^(?:[A-Za-z0-9.-]|[ /-][0-9])')
  ELSE regexp_full_match(hit, '[A-Za-z0-9+/_-]+={{0,2}}') AND NOT (hit[-1] = '=' AND regexp_matches(substring(t, stop + 1, 1), '[A-Za-z0-9+/_-]')) AND regexp_matches(hit, '[0-9]') AND regexp_matches(hit, '[A-Za-z]') AND len(list_distinct(string_split(hit, ''))) >= {pii.DISTINCT} AND {context["secret"]}
END),
kept AS (SELECT * FROM checked c WHERE kind <> 'local' OR NOT EXISTS (SELECT 1 FROM checked o WHERE o.r = c.r AND o.k < {pii.BASE} AND o.start < c.stop AND c.start < o.stop))
SELECT doc_id, {counts}, sha256(coalesce(string_agg({span}, ',' ORDER BY start, k) FILTER (k < {pii.BASE}), '')) AS base_sha256, coalesce(string_agg({span}, ',' ORDER BY start, k), '') AS spans, count(kind)::BIGINT AS n_spans
FROM docs LEFT JOIN kept USING (r) GROUP BY r, doc_id
"""


def oracle_sql() -> dict[str, str]:
    """SQL for the queries that it can express; the others are tested against brute force in tests/llm."""
    return {"op1_pii": _op1_sql(), "op3_jaccard_join": OP3_SQL, "op5_substring_dedup": OP5_SQL, "op6_embedding_dedup": OP6_SQL, "op10_decontamination": OP10_SQL, "op11_warc": OP11_SQL, "op12_ranked_search": OP12_SQL}
