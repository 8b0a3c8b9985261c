"""The registered queries of this subpackage over the given tables, next to their SQL oracles."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe_automaton, chat_format, compression, dart_minhash, exact_dedup, html_wrapper, language_id, line_dedup, mixing, quality_rules, spelling, token_alignment, warc
from .shared import documents, fold_number

#: Where the vocabulary files are; read on the driver and sent to the executors by Spark.
TOKENIZERS = os.environ.get("TOKENIZER_FOLDER", "/opt/tokenizers")
#: Least score of a document that counts as good.
GOOD = 0.3
#: Words of a repeated passage inside of longer lines that makes it go.
PASSAGE_WORDS = 20


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judged(documents(spark, sf_dir))


def quality_model(docs: DataFrame, labels: DataFrame) -> compression.Model:
    """The classifier learnt from the rows outside fold 0 of 5."""
    return compression.fit(docs, labels.filter(fold_number(F.col("doc_id"), 5) != 0))


def op2_compression_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    model = quality_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return compression.scored(docs, model).select(
        "doc_id", (fold_number(F.col("doc_id"), 5) == 0).alias("held_out"), "score", (F.col("score") >= GOOD).cast("int").alias("predicted")
    )


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.repeats(documents(spark, sf_dir), passage_words=PASSAGE_WORDS).drop("row", "text_hash")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    held_out = fold_number(F.col("doc_id"), 4) == 2
    net = language_id.fit(docs.filter(~held_out))
    return language_id.predicted(docs, net).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op5_dart_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dart_minhash.near_groups(documents(spark, sf_dir)).drop("text_hash")


def op6_bpe_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_automaton.token_digest(documents(spark, sf_dir), f"{TOKENIZERS}/byte_bpe_50k.json")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(documents(spark, sf_dir)).drop("text_hash")


def op8_html_wrapper(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_wrapper.extracted(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def op9_chat_prefix_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    added = spark.range(1).select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(-7).cast("long").alias("conv_id"), F.lit(k).cast("long").alias("turn"), F.lit(r).alias("role"), F.lit(said).alias("text"))
                    for k, r in enumerate(("user", "assistant"))
                ]
            )
        )
    )
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return chat_format.digest(chat_format.examples(turns.unionByName(added)))


def op10_mix_wfq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir)).drop("source")


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(documents(spark, sf_dir), every=199)


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.alignment(documents(spark, sf_dir), f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(spark.read.parquet(f"{sf_dir}/pages.parquet"))


QUERIES = {
    "op1_quality_rules": op1_quality_rules,
    "op2_compression_classifier": op2_compression_classifier,
    "op3_line_dedup": op3_line_dedup,
    "op4_language_id": op4_language_id,
    "op5_dart_minhash": op5_dart_minhash,
    "op6_bpe_automaton": op6_bpe_automaton,
    "op7_exact_dedup": op7_exact_dedup,
    "op8_html_wrapper": op8_html_wrapper,
    "op9_chat_prefix_target": op9_chat_prefix_target,
    "op10_mix_wfq": op10_mix_wfq,
    "op11_spelling": op11_spelling,
    "op12_token_alignment": op12_token_alignment,
    "op13_warc": op13_warc,
}

def _quality_sql() -> str:
    """The measures, sketches, fences and verdicts of op1 over whole texts."""
    values = {
        "symbols": "1000 * n_symbols // n_words",
        "upper": "1000 * n_upper // greatest(word_chars, 1)",
        "marks": "1000 * n_marks // n_words",
        "word_length": "100 * word_chars // n_words",
        "repeated": "1000 * n_repeat_words // n_words",
        "dup_lines": "1000 * n_dup_lines // greatest(n_lines, 1)",
    }
    rules = quality_rules.RULES
    limits = ", ".join(f"('{r}', {rules[r][1]}, {rules[r][2]}, {str(rules[r][3]).upper()})" for r in values)
    pairs = ", ".join(f"{{'rule': '{r}', 'v': {v}}}" for r, v in values.items())
    verdicts = ", ".join(
        f"max(CASE WHEN rule = '{r}' AND (v < low OR v > high) THEN '{r}' END)" for r in values
    )
    measures = ", ".join(quality_rules.MEASURES)
    word = r"[^\x20\x09-\x0D]+"
    return rf"""
WITH docs AS (SELECT row_number() OVER () AS r, doc_id, lang, source, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT r, unnest(w) AS w, generate_subscripts(w, 1) AS pos FROM (SELECT r, regexp_extract_all(text, '{word}') AS w FROM docs)),
windows AS (
  SELECT r, pos, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS g
  FROM words WINDOW o AS (PARTITION BY r ORDER BY pos)),
again AS (
  SELECT r, COUNT(DISTINCT p) AS n FROM (
    SELECT r, unnest(range(pos, pos + 5)) AS p
    FROM (SELECT r, pos, COUNT(*) OVER (PARTITION BY r, g) AS c FROM windows WHERE g IS NOT NULL) WHERE c > 1)
  GROUP BY r),
lines AS (
  SELECT r, COUNT(*) AS n, COUNT(*) - COUNT(DISTINCT line) AS dup
  FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM docs) WHERE regexp_matches(line, '{word}') GROUP BY r),
measured AS (
  SELECT r, doc_id, lang, source, len(regexp_extract_all(text, '{word}')) AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]', '', 'g')) AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(lines.dup, 0) AS n_dup_lines,
         coalesce(again.n, 0) AS n_repeat_words, coalesce(lines.n, 0) AS n_lines,
         length(regexp_replace(text, '[^A-Z]', '', 'g')) AS n_upper, length(regexp_replace(text, '[^!?]', '', 'g')) AS n_marks
  FROM docs LEFT JOIN again USING (r) LEFT JOIN lines USING (r)),
base AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM measured),
valued AS (SELECT r, lang, source, base_failed, p.rule AS rule, p.v AS v FROM (SELECT *, unnest([{pairs}]) AS p FROM base WHERE n_words > 0)),
bucketed AS (
  SELECT lang, source, rule, (v // scale) * scale AS bucket
  FROM (SELECT *, (1::BIGINT << greatest(length(bin(v)) - 7, 0)::BIGINT) AS scale FROM valued WHERE NOT base_failed)),
sketches AS (
  SELECT 0 AS level, lang, source, rule, bucket FROM bucketed UNION ALL SELECT 1, lang, NULL, rule, bucket FROM bucketed
  UNION ALL SELECT 2, NULL, NULL, rule, bucket FROM bucketed),
counted AS (
  SELECT level, lang, source, rule, bucket, COUNT(*) AS n, (1::BIGINT << greatest(length(bin(bucket)) - 7, 0)::BIGINT) AS width
  FROM sketches GROUP BY ALL),
running AS (
  SELECT *, sum(n) OVER (w ORDER BY bucket) AS upto, sum(n) OVER w AS rows FROM counted WINDOW w AS (PARTITION BY level, lang, source, rule)),
ends AS (
  SELECT level, lang, source, r.rule AS rule, k, two_sided,
         arg_min({{'v': bucket, 'w': width}}, bucket) FILTER (100 * upto >= (100 - p) * rows) AS below,
         min(bucket) FILTER (100 * upto >= 50 * rows) AS middle,
         arg_min({{'v': bucket, 'w': width}}, bucket) FILTER (100 * upto >= p * rows) AS above
  FROM running r JOIN (VALUES {limits}) l(rule, p, k, two_sided) ON l.rule = r.rule
  WHERE level = 2 OR rows * (100 - p) >= 100 * {quality_rules.LEAST_BEYOND} GROUP BY ALL),
fences AS (
  SELECT level, lang, source, rule, CASE WHEN two_sided THEN below.v - k * greatest(abs(below.v - middle), below.w) // 10 END AS low,
         above.v + k * greatest(abs(above.v - middle), above.w) // 10 AS high
  FROM ends),
chosen AS (
  SELECT r, v.rule AS rule, v, arg_min(f.level, f.level) AS level,
         arg_min({{'low': low, 'high': high}}, f.level) AS fence
  FROM valued v LEFT JOIN fences f ON f.rule = v.rule AND (f.level = 2 OR f.lang IS NOT DISTINCT FROM v.lang AND
       (f.level = 1 OR f.source IS NOT DISTINCT FROM v.source))
  GROUP BY ALL),
verdicts AS (
  SELECT r, min(level) AS level, concat_ws(',', {verdicts}) AS failed
  FROM (SELECT r, rule, v, level, fence.low AS low, fence.high AS high FROM chosen) GROUP BY r)
SELECT doc_id, {measures}, base_failed, coalesce(failed, '') AS failed_rules, level AS threshold_level,
       NOT base_failed AND coalesce(failed, '') = '' AS kept
FROM base LEFT JOIN verdicts USING (r)"""


ORACLES = {
    "op1_quality_rules": _quality_sql(),
    "op7_exact_dedup": """
WITH folded AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), groups AS (
  SELECT norm, max(doc_id) AS keep_id, count(*) AS group_size FROM folded GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM folded JOIN groups USING (norm)
""",
    "op9_chat_prefix_target": r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, k, r, '\### Assistant: </turn> ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(k, r)
), placed AS (
  SELECT *, row_number() OVER conv AS pos, count(*) OVER (PARTITION BY conv_id) AS n,
         length('### : ' || role || text || ' </turn>' || chr(10))
         + length(regexp_replace(role, '[^\\#<:]', '', 'g')) + length(regexp_replace(text, '[^\\#<]', '', 'g')) AS written
  FROM turns WINDOW conv AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
), sized AS (
  SELECT *, sum(written) OVER (PARTITION BY conv_id ORDER BY pos) AS prefix FROM placed
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
       coalesce(sum(prefix) FILTER (role = 'assistant' OR pos = n), 0)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
""",
    "op10_mix_wfq": r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5('mix' || coalesce(doc_id::VARCHAR, '')) AS shuffled
  FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight
  FROM sized GROUP BY source
), ratios AS (
  SELECT *, 2 * source_size AS cap, (2 * source_size)::DOUBLE / weight AS ratio FROM sources
), levels AS (
  SELECT *, ((sum(source_size) OVER ()) * 1.5::DOUBLE
             - coalesce(sum(cap) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::DOUBLE)
            / (sum(weight) OVER () - coalesce(sum(weight) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE AS level,
         row_number() OVER w AS k
  FROM ratios WINDOW w AS (ORDER BY ratio, source NULLS LAST)
), goals AS (
  SELECT source, source_size,
         least(cap::DOUBLE, coalesce((SELECT arg_min(level, k) FROM levels WHERE cap >= level * weight) * weight, cap::DOUBLE)) AS target
  FROM levels
), served AS (
  SELECT s.*, g.source_size, g.target,
         sum(size) OVER (PARTITION BY s.source ORDER BY shuffled, doc_id, size ROWS UNBOUNDED PRECEDING) AS served
  FROM sized s JOIN goals g ON s.source IS NOT DISTINCT FROM g.source
), queue AS (
  SELECT *, (served + pass * source_size)::DOUBLE / target AS finish
  FROM served CROSS JOIN (VALUES (0), (1)) p(pass) WHERE size > 0
), mixed AS (
  SELECT *, sum(size) OVER (ORDER BY finish, source NULLS LAST, shuffled, doc_id, size, pass ROWS UNBOUNDED PRECEDING) AS mixed FROM queue
), taken AS (
  SELECT doc_id, source, size, sum(size)::BIGINT AS taken FROM mixed
  WHERE mixed <= (SELECT sum(size) * 1.5 FROM sized) GROUP BY doc_id, source, size
)
SELECT s.doc_id, s.size, s.source_size, s.target, coalesce(t.taken, 0)::BIGINT AS taken
FROM served s LEFT JOIN taken t
  ON s.doc_id IS NOT DISTINCT FROM t.doc_id AND s.source IS NOT DISTINCT FROM t.source AND s.size = t.size
""",
    "op11_spelling": r"""
WITH RECURSIVE byte_values AS (SELECT unnest(range(256)) AS b),
steps AS (
  SELECT 0 AS k, b, b AS c FROM byte_values UNION ALL
  SELECT k + 1, b, xor(c >> 1, CASE WHEN c % 2 = 1 THEN 3988292384 ELSE 0 END) FROM steps WHERE k < 8
), crc_table AS (SELECT b, c AS t FROM steps WHERE k = 8),
runs AS (
  SELECT doc_id, run, COUNT(*) AS n FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\x{C0}-\x{FF}]+')),
                             'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents)
  GROUP BY ALL
), hashed AS (
  SELECT doc_id, run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS raw FROM runs WHERE length(run) >= 6
), effects AS (
  SELECT 0 AS d, b, t AS e FROM crc_table UNION ALL
  SELECT d + 1, s.b, xor(e >> 8, c.t) FROM effects s JOIN crc_table c ON c.b = e % 256
  WHERE d + 1 < (SELECT max(length(raw)) // 2 FROM hashed)
), starts AS (
  SELECT 0 AS d, 4294967295 AS s UNION ALL
  SELECT d + 1, xor(s >> 8, t) FROM starts JOIN crc_table ON b = s % 256 WHERE d < (SELECT max(length(raw)) // 2 FROM hashed)
), letters AS (
  SELECT doc_id, run, n, length(raw) // 2 AS size, unnest(range(length(raw) // 2)) AS i, raw FROM hashed
), sums AS (
  SELECT doc_id, run, n, size, bit_xor(e) AS x
  FROM (SELECT doc_id, run, n, size, size - 1 - i AS d, 16 * (instr('0123456789ABCDEF', raw[2 * i + 1]) - 1)
               + instr('0123456789ABCDEF', raw[2 * i + 2]) - 1 AS b FROM letters) JOIN effects USING (d, b)
  GROUP BY ALL
), crcs AS (SELECT doc_id, run, n, xor(xor(x, s), 4294967295) AS h FROM sums JOIN starts ON d = size),
words AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word,
         sum(n)::BIGINT AS n
  FROM crcs GROUP BY 1 HAVING sum(n) >= 5 AND length(word) >= 6
), cuts AS (
  SELECT word, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, unnest(range(length(word))) AS i FROM words)
), near AS (
  SELECT a.word AS word, b.word AS other FROM cuts a JOIN cuts b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT cuts.word, words.word FROM cuts JOIN words ON rest = words.word
  UNION SELECT words.word, cuts.word FROM cuts JOIN words ON rest = words.word
), best AS (
  SELECT near.word AS word, COUNT(*) AS n_near, arg_min({'w': other, 'n': n}, (-n, other)) AS b
  FROM near JOIN words ON words.word = other GROUP BY 1
), forms AS (
  SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b.n >= 5 * n THEN b.w END AS form, CASE WHEN b.n >= 5 * n THEN b.n END AS form_n
  FROM words LEFT JOIN best USING (word)
), roots AS (
  SELECT word, word AS root FROM forms WHERE form IS NULL UNION ALL
  SELECT forms.word, roots.root FROM roots JOIN forms ON forms.form = roots.word
)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN roots USING (word)
""",
    "op13_warc": """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS digest FROM pages),
kept AS (SELECT payload, max(page_id) AS keeper FROM payloads GROUP BY payload),
fives AS (
  SELECT page_id, list_transform(range(8), lambda g: list_reduce(
           list_transform(range(5), lambda k: instr('0123456789abcdef', digest[5 * g + k + 1]) - 1), lambda x, y: 16 * x + y)) AS parts
  FROM payloads
), digests AS (
  SELECT page_id, list_aggregate(list_transform(parts, lambda v: list_aggregate(list_transform([15, 10, 5, 0],
           lambda s: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(v >> s) % 32 + 1]), 'string_agg', '')), 'string_agg', '') AS payload_digest
  FROM fives
)
SELECT page_id, strlen(payload) AS payload_bytes, payload_digest,
       CASE WHEN page_id = keeper THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> keeper THEN keeper END AS refers_to
FROM payloads JOIN kept USING (payload) JOIN digests USING (page_id)
""",
}
