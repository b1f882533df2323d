"""The operators over the given tables, with SQL where it can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stratalake.llm import bpe, conversations, decontaminate, hmm, language, lines, minhash, pii, quality, setjoin, toxicity, warc, whiten
from stratalake.llm.shared import fold, scratch, shipped, table


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(shipped(spark), sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(fold("doc_id", 4) != 2)
    model = toxicity.Toxicity(spark, docs, labels)
    scored = docs.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(shipped(spark), sf_dir, "documents").withColumn("held_out", fold("doc_id", 5) == 0)
    languages = language.Languages(spark, docs.where("not held_out").select("doc_id", "text", "lang"))
    found = docs.select("doc_id", "held_out", languages.predict(F.col("text")).alias("found"))
    return found.select(
        "doc_id",
        "held_out",
        F.col("found.lang").alias("lang_pred"),
        F.col("found.score").alias("score"),
        F.col("found.rejected").alias("rejected"),
    )


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(shipped(spark), sf_dir, "documents")
    return decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).drop("text_hash")


def op4_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.line_classes(table(shipped(spark), sf_dir, "documents")).drop("text_hash")


def op4_all_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of every length: those below ``lines.MIN_CHARS`` have classes of equal lines."""
    return lines.line_classes(table(shipped(spark), sf_dir, "documents"), least=1).drop("text_hash")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(shipped(spark), sf_dir, "documents")
    found = docs.select("doc_id", pii.personal_data(F.col("text"), hosts=True).alias("found"))

    def of(*kinds: str) -> Column:
        return F.filter("found", lambda s: s["kind"].isin(*kinds))

    def joined(spans: Column) -> Column:
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    return found.select(
        "doc_id",
        *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE_KINDS],
        F.sha2(joined(of(*pii.BASE_KINDS)).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("found")).alias("spans"),
    )


def op6_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(shipped(spark), sf_dir, "documents"), words=4).drop("text_hash")


def _link_sql(words: int, columns: str) -> str:
    """Shingle sets of so many words, all their links, and what is reached by them."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), s AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i + {words - 1}], ' ') FOR i IN range(1, len(w) - {words - 2})]) END AS s
  FROM w
), x AS (SELECT doc_id, unnest(s) AS g FROM s
), p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM x a JOIN x b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2
), l AS (
  SELECT a, b FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b
  WHERE 100 * c >= 80 * (len(sa.s) + len(sb.s) - c)
), e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l
), r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM documents
  UNION SELECT r.doc_id, e.b FROM r JOIN e ON e.a = r.reached
), c AS (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY 1)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id{columns} FROM s JOIN c USING (doc_id)
"""


OP6_SQL = _link_sql(4, ", doc_id = component_id AS kept")
OP12_SQL = _link_sql(5, "")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = scratch(shipped(spark))
    archives = warc.write_archives(warc.record_types(table(spark, sf_dir, "pages")), f"{folder}/crawl")
    index = warc.normalise(archives, f"{folder}/records")
    return warc.read_records(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


OP7_SQL = """
WITH p AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages
), f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM p)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to
FROM f
"""


def op8_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(shipped(spark), sf_dir, "documents")
    return hmm.score(docs.select("doc_id", "text", (fold("doc_id", 5) == 1).alias("held_out")))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    codec = bpe.Codec(shipped(spark), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = table(spark, sf_dir, "documents").select("doc_id", codec.encode(F.col("text")).alias("ids"))
    return docs.withColumn("raw", codec.decode(F.col("ids"))).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("raw", 256).alias("decoded_sha256"),
    )


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(table(shipped(spark), sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def _op10_sql() -> str:
    """The counts, the sketches of the three levels, their fences and the verdict."""
    shares = {
        "symbols": "n_symbols * 1000 // greatest(word_chars, 1)",
        "upper": "n_upper * 1000 // greatest(word_chars, 1)",
        "punctuation": "n_punct * 1000 // greatest(word_chars, 1)",
        "dup_lines": "n_dup_lines * 1000 // greatest(n_lines, 1)",
        "repeats": "n_repeat_words * 1000 // greatest(n_words, 1)",
        "word_length": "word_chars * 100 // greatest(n_words, 1)",
    }
    least = {share: spread for share, (_, spread) in quality.SHARES.items()}
    levels = {"own": "lang, source", "of_lang": "lang", "of_all": ""}
    sketches = []
    for level, keys in levels.items():
        named = f"{keys}, " if keys else ""
        group = f"{named}share"
        sketches.append(f"""
{level}_c AS (SELECT {group}, bucket, sum(n) AS n FROM sketch GROUP BY {group}, bucket
), {level}_q AS (
  SELECT {group}, CASE WHEN bucket < 32 THEN bucket ELSE (bucket % 16 + 16) << (bucket // 16 - 1) END AS edge,
    sum(n) OVER (PARTITION BY {group}) AS docs, sum(n) OVER (PARTITION BY {group} ORDER BY bucket) AS below
  FROM {level}_c
), {level} AS (
  SELECT {group}, docs, min(edge) FILTER (4 * below >= 3 * docs) AS q3, min(edge) FILTER (4 * below >= docs) AS q1,
    q3 + {quality.FENCE} * greatest(q3 - q1, CASE share {" ".join(f"WHEN '{k}' THEN {v}" for k, v in least.items())} END) AS fence
  FROM {level}_q GROUP BY {group}, docs
)""")
    return rf"""
WITH w AS (
  SELECT doc_id, lang, source, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l
  FROM documents
), win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 6)) AS i FROM w)
), rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS n FROM win) WHERE n > 1
), cov AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT doc_id, i, unnest(range(0, 8)) AS k FROM rep) GROUP BY doc_id
), c AS (
  SELECT doc_id, lang, source, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
    length(t) - length(translate(t, '#*$%&|<>', '')) AS n_symbols,
    length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', '')) AS n_upper,
    length(t) - length(translate(t, '!?;:"''()[]{{}}=+-_/\~^`@', '')) AS n_punct,
    len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words
  FROM w LEFT JOIN cov USING (doc_id)
), m AS (
  SELECT *, n_words < {quality.MIN_WORDS} OR 100 * n_repeat_words > {quality.MAX_REPEAT_PERCENT} * n_words AS base_failed FROM c
), s AS ({" UNION ALL ".join(f"SELECT doc_id, lang, source, base_failed, '{k}' AS share, ({v})::BIGINT AS v FROM m" for k, v in shares.items())}
), sketch AS (
  SELECT lang, source, share, CASE WHEN v < 32 THEN v ELSE 16 * (length(bin(v)) - 5) + (v >> (length(bin(v)) - 5)) END AS bucket,
    count(*) AS n
  FROM s WHERE NOT base_failed GROUP BY 1, 2, 3, 4
), {", ".join(sketches)}, verdict AS (
  SELECT s.doc_id, bool_and(s.v <= CASE WHEN own.docs >= {quality.MIN_DOCS} THEN own.fence
    WHEN of_lang.docs >= {quality.MIN_DOCS} THEN of_lang.fence ELSE of_all.fence END) AS within
  FROM s
  JOIN own ON own.lang IS NOT DISTINCT FROM s.lang AND own.source IS NOT DISTINCT FROM s.source AND own.share = s.share
  JOIN of_lang ON of_lang.lang IS NOT DISTINCT FROM s.lang AND of_lang.share = s.share
  JOIN of_all ON of_all.share = s.share
  GROUP BY s.doc_id
)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce(within, false) AS kept
FROM m LEFT JOIN verdict USING (doc_id)
"""


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten.long_form(whiten.whiten(table(shipped(spark), sf_dir, "embeddings")))


def op12_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setjoin.jaccard_classes(table(shipped(spark), sf_dir, "documents"))


def op13_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(shipped(spark), sf_dir, "conversations")
    return conversations.repair(conversations.damage(rows), rows)


CHECKS = {
    "op1_toxicity": (op1_toxicity, None),
    "op2_language": (op2_language, None),
    "op3_decontaminate": (op3_decontaminate, None),
    "op4_lines": (op4_lines, None),
    "op5_pii": (op5_pii, None),
    "op6_minhash": (op6_minhash, OP6_SQL),
    "op7_warc": (op7_warc, OP7_SQL),
    "op8_hmm": (op8_hmm, None),
    "op9_bpe": (op9_bpe, None),
    "op10_quality": (op10_quality, _op10_sql()),
    "op11_whitening": (op11_whitening, None),
    "op12_jaccard_join": (op12_jaccard_join, OP12_SQL),
    "op13_conversations": (op13_conversations, None),
    "op4_all_lines": (op4_all_lines, None),
}
