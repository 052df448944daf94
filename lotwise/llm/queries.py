"""The registered queries of this subpackage, each over its whole table, and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lotwise.llm import (
    backoff_lm,
    decontaminate,
    embedding_dedup,
    fill_in_middle,
    html_extract,
    license_scan,
    packing,
    phrases,
    quality,
    secret_scan,
    sentence_pieces,
    simhash,
    url_rules,
)
from lotwise.llm.common import read


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        decontaminate.n_hit().alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"),
        decontaminate.is_contaminated().alias("contaminated"),
    )


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(read(spark, sf_dir, "documents")).drop("digest")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    weights = quality.fit(docs, read(spark, sf_dir, "labels").where(~quality.is_held_out()))
    scored = quality.with_scores(docs.select("doc_id", "text"), weights, "score", keep=["doc_id"])
    return scored.select(
        "doc_id",
        quality.is_held_out().alias("held_out"),
        "score",
        (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted"),
    )


def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_scan.with_secrets(read(spark, sf_dir, "documents"), keep=["doc_id"])
    count = lambda kind: F.size(F.filter("secrets", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("secrets", lambda s: s["kind"] != "guess")
    return found.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(_listed(base), 256).alias("base_sha256"),
        _listed(F.col("secrets")).alias("spans"),
        count("guess").alias("n_guess"),
        F.array_max(F.transform("secrets", lambda s: s["guess_log10"])).alias("most_guesses_log10"),
    )


def _listed(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["begin"], s["end"])), ",")


def op5_pack(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_texts(read(spark, sf_dir, "documents"))


def op6_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.main_texts(read(spark, sf_dir, "pages")).withColumn("n_chars", F.char_length("text").cast("long"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(read(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("bits")), 16, "0").alias("fingerprint"), "component_id")


def op8_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_lm.scores(read(spark, sf_dir, "documents")).withColumn("log10_score", F.round("log10_score", 6))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages").select("page_id", "url")
    rules = url_rules.mine(url_rules.labelled_urls(pages, read(spark, sf_dir, "labels")), "url", "bad")
    return url_rules.judge(pages, rules)


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_duplicates(read(spark, sf_dir, "embeddings"))
    return found.withColumn("component_id", F.col("component_id").cast("long"))


def op11_sentence_pieces(spark: SparkSession, sf_dir: str, model_file: str | None = None) -> DataFrame:
    if model_file is None:
        import public_tokenizers

        model_file = public_tokenizers.path("piece_bpe_32k.model")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return sentence_pieces.encode(docs, sentence_pieces.Vocabulary(model_file), decoded="decoded").select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle.transform(read(spark, sf_dir, "documents"))
    restored = fill_in_middle.restored_text(F.col("output"), F.col("form"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored, 256).alias("restored_sha256"),
    )


def op13_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(read(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL),
win AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS size, array_to_string(w[b:b + least(13, len(w)) - 1], ' ') AS words
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS b FROM item WHERE len(w) > 0)),
doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
placed AS (
  SELECT r, size, b, array_to_string(w[b:b + size - 1], ' ') AS words
  FROM (SELECT r, w, size, unnest(range(1, len(w) - size + 2)) AS b
        FROM doc, (SELECT DISTINCT size FROM win) WHERE len(w) >= size)),
hit AS (SELECT r, win.size, b, item_id FROM placed JOIN win ON placed.size = win.size AND placed.words = win.words),
places AS (SELECT r, count(DISTINCT place) AS n FROM (SELECT r, unnest(range(b, b + size)) AS place FROM hit) GROUP BY r),
items AS (SELECT r, count(*) AS n, string_agg(item_id, ',' ORDER BY item_id) AS ids
          FROM (SELECT DISTINCT r, item_id FROM hit) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(places.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(items.n, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(places.n, 0) > 0 AND 20 * coalesce(places.n, 0) >= len(w) AS contaminated
FROM doc LEFT JOIN places USING (r) LEFT JOIN items USING (r)
"""


OP8_SQL = r"""
WITH doc AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents),
word AS (SELECT r, w[i] AS w, w[i - 1] AS v, w[i - 2] AS u, i, len(w) AS size FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS i FROM doc)),
one AS (SELECT *, count(*) OVER (PARTITION BY w) - count(*) OVER (PARTITION BY r, w) AS c1,
               (SELECT count(*) FROM word) - size AS others FROM word),
two AS (SELECT *, CASE WHEN i > 1 THEN count(*) OVER (PARTITION BY v, w) - count(*) OVER (PARTITION BY r, v, w) END AS c2,
               lag(c1) OVER (PARTITION BY r ORDER BY i) AS before1 FROM one),
three AS (SELECT *, CASE WHEN i > 2 THEN count(*) OVER (PARTITION BY u, v, w) - count(*) OVER (PARTITION BY r, u, v, w) END AS c3,
                 lag(c2) OVER (PARTITION BY r ORDER BY i) AS before2 FROM two),
scored AS (
  SELECT r, log10(CASE WHEN c3 > 0 THEN c3 / before2 ELSE CASE WHEN i > 2 THEN 0.4::DOUBLE ELSE 1::DOUBLE END
                  * CASE WHEN c2 > 0 THEN c2 / before1 ELSE CASE WHEN i > 1 THEN 0.4::DOUBLE ELSE 1::DOUBLE END
                  * CASE WHEN c1 > 0 THEN c1 / others ELSE 0.4::DOUBLE / (others + 1) END END END) AS score FROM three),
summed AS (SELECT r, count(*) AS n, sum(score) AS score FROM scored GROUP BY r)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_words, round(coalesce(score, 0.0), 6) AS log10_score FROM doc LEFT JOIN summed USING (r)
"""

OP10_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS e,
         sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) AS norm
  FROM embeddings),
ok AS (SELECT * FROM v WHERE label IS NOT NULL AND norm > 0 AND isfinite(norm) AND len(list_filter(e, lambda x: x IS NULL)) = 0),
link AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
    ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
   AND list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.98),
reach AS (SELECT a AS id, a AS other FROM link UNION SELECT r.id, l.b FROM reach r JOIN link l ON l.a = r.other),
lowest AS (SELECT id, min(other) AS component FROM reach GROUP BY id),
counts AS (SELECT a AS id, count(*) AS n FROM link GROUP BY a)
SELECT v.vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(component, v.vec_id) AS component_id,
       v.vec_id = coalesce(component, v.vec_id) AS kept
FROM v LEFT JOIN lowest ON lowest.id = v.vec_id LEFT JOIN counts ON counts.id = v.vec_id
"""


OP12_SQL = r"""
WITH doc AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256(concat('7:', doc_id)) AS h FROM documents),
drawn AS (
  SELECT *, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS k1, ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS k2,
         ('0x' || h[17:24])::BIGINT % 100 AS r3, ('0x' || h[25:32])::BIGINT % 100 AS r4 FROM doc),
cut AS (
  SELECT *, array_to_string(u[1:least(k1, k2)], '') AS p, array_to_string(u[least(k1, k2) + 1:greatest(k1, k2)], '') AS m,
         array_to_string(u[greatest(k1, k2) + 1:], '') AS s,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r3 >= 100 THEN 'plain'
              WHEN r4 < 50 THEN 'spm' ELSE 'psm' END AS form FROM drawn)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""

OP13_SQL = r"""
WITH piece AS (
  SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w
  FROM documents),
place AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM piece WHERE len(w) > 0),
f AS (SELECT lang, size, array_to_string(w[i:i + size - 1], ' ') AS phrase, count(*) AS f
      FROM place, (SELECT unnest([1, 2, 3]) AS size) WHERE i + size - 1 <= len(w) GROUP BY ALL),
total AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang),
cut AS (
  SELECT lang, size, phrase, f AS a, unnest(range(1, size)) AS k, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 10),
scored AS (
  SELECT cut.lang, cut.size, cut.phrase, a, k, x.f AS l, y.f AS r, (1000000::HUGEINT * a * a) // (x.f::HUGEINT * y.f) AS score
  FROM cut JOIN f x ON x.lang = cut.lang AND x.size = k AND x.phrase = array_to_string(w[1:k], ' ')
           JOIN f y ON y.lang = cut.lang AND y.size = cut.size - k AND y.phrase = array_to_string(w[k + 1:], ' ')),
weakest AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, phrase, max(a) AS longer
  FROM (SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS phrase FROM cut WHERE size = 3)
  GROUP BY lang, phrase),
kept AS (SELECT weakest.* FROM weakest LEFT JOIN inside USING (lang, phrase) WHERE size = 3 OR longer IS NULL OR 100 * longer < 50 * a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN total USING (lang) QUALIFY rank <= 2000
"""


def _op2_sql() -> str:
    """Every window of every template's length, and every stretch of one and a half times that which begins with a shingle
    of the template or is the last, counted from the shingles shared with the template. Templates have five words or more."""
    values = ", ".join("('{}', '{}')".format(k, v.replace("'", "''")) for k, v in license_scan.TEMPLATES.items())
    words = r"regexp_extract_all(lower(coalesce(text, '')), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
    return f"""
WITH template AS (SELECT license, {words} AS w FROM (VALUES {values}) AS t(license, text)),
known AS (SELECT DISTINCT license, len(w) AS length, array_to_string(w[i:i + 4], ' ') AS shingle
          FROM (SELECT license, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM template)),
total AS (SELECT license, length, count(*) AS shingles FROM known GROUP BY ALL),
doc AS (SELECT row_number() OVER () AS r, doc_id, {words} AS w FROM (SELECT DISTINCT doc_id, text FROM documents)),
placed AS (SELECT r, len(w) AS n, i, array_to_string(w[i:i + 4], ' ') AS shingle
           FROM (SELECT r, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM doc WHERE len(w) > 0)),
hit AS (SELECT r, i - 1 AS place, least(5, n) AS run, greatest(n - length, 0) AS last, license, length, shingle
        FROM placed JOIN known USING (shingle)),
narrow AS (SELECT r, license, start, count(DISTINCT shingle) AS found
           FROM (SELECT *, unnest(range(greatest(place + run - length, 0), least(place, last) + 1)) AS start FROM hit)
           GROUP BY r, license, start),
begin AS (SELECT r, license, place AS start FROM hit WHERE place <= last UNION SELECT r, license, last FROM hit),
wide AS (SELECT r, license, start, count(DISTINCT shingle) AS found FROM begin JOIN hit USING (r, license)
         WHERE place >= start AND place + run <= start + length + length // 2 GROUP BY r, license, start),
best AS (SELECT r, license, start, found / shingles AS containment
         FROM (SELECT *, 0 AS kind FROM narrow UNION ALL SELECT *, 1 FROM wide) JOIN total USING (license)
         QUALIFY row_number() OVER (PARTITION BY r, license ORDER BY found DESC, kind, start) = 1)
SELECT doc_id, license, containment, start AS first_word FROM best JOIN doc USING (r) WHERE containment >= 0.8
"""


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2].isdigit() and callable(f)}


def all_oracles() -> dict[str, str]:
    return {
        "op1_decontaminate": OP1_SQL,
        "op2_license_scan": _op2_sql(),
        "op8_backoff_lm": OP8_SQL,
        "op10_embedding_dedup": OP10_SQL,
        "op12_fill_in_middle": OP12_SQL,
        "op13_phrases": OP13_SQL,
    }
