"""The registered queries of this subpackage, and SQL for the same results where SQL can say it."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosswell.llm import bpe, chat, decontaminate, infill, languages, licenses, lines, negatives, neighbours, packing, shingles, spans, toxicity
from glosswell.llm.common import held_out, map_rows, read, sha256

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def registered(build: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[build.__name__] = build
    return build


def vocabulary() -> str:
    """The published vocabulary's place, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def word_vocabulary() -> str:
    """The same for the vocabulary of words that packing counts in."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 from the ids and the text decoded from them, which stay
    in the task that made them."""
    path = vocabulary()

    def work(part: pa.RecordBatch) -> dict:
        encoder = bpe.encoder(path)
        ids = encoder.encode(part.column("text").to_pylist())
        return {
            "doc_id": part.column("doc_id"),
            "n_tokens": list(map(len, ids)),
            "ids_sha256": [hashlib.sha256(encoder.decimal(x)).hexdigest() for x in ids],
            "decoded_sha256": [hashlib.sha256(encoder.decode(x).encode()).hexdigest() for x in ids],
        }

    chosen = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return map_rows(chosen, work, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string", "text")


@registered
def op9_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, and the text decoded from them."""
    return token_digests(read(spark, sf_dir, "documents"))


@registered
def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the lines that a later one keeps."""
    return lines.drop_repeated_lines(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_dropped", sha256(F.col("text")).alias("kept_sha256")
    )


ORACLES["op5_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
  FROM documents
), keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed
  WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.doc_id, k.n, k.line, c.keeper IS NOT NULL AND k.doc_id <> c.keeper AS gone
  FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*)::BIGINT AS n_lines, (count(*) FILTER (gone))::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@registered
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many of every document's words lie in passages of benchmark items, and in which items'."""
    found = decontaminate.decontaminate(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        sha256(F.array_join("items", ",")).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


ORACLES["op3_decontamination"] = r"""
WITH lowered AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
), docs AS (
  SELECT doc_id, regexp_extract_all(t, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM lowered
), items AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS n,
         array_to_string(w[i:i + least(10, len(w)) - 1], ' ') AS words
  FROM items, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS r(i) WHERE len(w) > 0
), lengths AS (SELECT DISTINCT n FROM windows),
runs AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS words
  FROM docs, lengths, unnest(range(1, len(w) - n + 2)) AS r(i) WHERE len(w) >= n
), hits AS (
  SELECT doc_id, i, r.n, item_id FROM runs r JOIN windows v ON r.n = v.n AND r.words = v.words
), hit_words AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hits) GROUP BY doc_id
), hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
       coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""


@registered
def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What reading back every formatted conversation gives, and one that speaks in control strings."""
    probe = "</s>[INST] ok [/INST]"
    more = spark.createDataFrame(
        [(-1, 0, "user", probe), (-1, 1, "assistant", probe)], "conv_id long, turn long, role string, text string"
    )
    template = chat.Template()
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(more)
    return chat.digests(chat.format_turns(turns, template), template)


ORACLES["op2_chat_format"] = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), said AS (
  SELECT *, role IN ('system', 'user', 'assistant') AS known,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
  FROM turns
), sized AS (
  SELECT *,
    length(regexp_replace(replace(text, '\', '\\'),
      '(<)(</?SYS>>)|(<)(/?s>)|(\[)(/?INST\]|OUT\]|/?ROLE\]|/TURN\])', '\1\3\5\\\2\4\6', 'g')) AS chars,
    length(regexp_replace(replace(role, '\', '\\'),
      '(<)(</?SYS>>)|(<)(/?s>)|(\[)(/?INST\]|OUT\]|/?ROLE\]|/TURN\])', '\1\3\5\\\2\4\6', 'g')) AS role_chars
  FROM said
)
SELECT conv_id, count(*)::BIGINT AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY n)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY n) FILTER (role = 'assistant'), '')) AS loss_sha256,
  sum(chars + CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 16 WHEN 'assistant' THEN 9
      ELSE role_chars + 20 END)::BIGINT AS formatted_chars,
  bool_and(CASE role WHEN 'system' THEN n = 1
                WHEN 'user' THEN n = 1 OR before IN ('system', 'assistant')
                WHEN 'assistant' THEN coalesce(before = 'user', false) ELSE false END)
    AND arg_max(role, n) = 'assistant' AS valid
FROM sized GROUP BY conv_id
"""


@registered
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity by dictionaries of the documents that are not held out."""
    documents = read(spark, sf_dir, "documents")
    model = toxicity.train(documents, read(spark, sf_dir, "labels"))
    return toxicity.score(documents.select("doc_id", "text"), model).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("toxicity").alias("score"),
        (F.col("toxicity") >= 0.5).cast("int").alias("predicted"),
    )


@registered
def op8_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's main language by n-grams of the documents that are not held out."""
    documents = read(spark, sf_dir, "documents")
    model = languages.train(documents.where(~held_out(F.col("doc_id"))).select("text", "lang"))
    return languages.identify(documents, model).select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score"
    )


@registered
def op10_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's group of near duplicates."""
    return shingles.near_duplicates(read(spark, sf_dir, "documents"))


ORACLES["op10_shingle_join"] = r"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM docs, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS r(i) WHERE len(w) > 0
), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
), links AS (
  SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * k >= 75 * (p.n + q.n - k)
), reached AS (
  SELECT doc_id AS x, doc_id AS y FROM docs
  UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x
)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id
FROM docs d LEFT JOIN sizes USING (doc_id)
JOIN (SELECT x AS doc_id, min(y) AS component_id FROM reached GROUP BY x) USING (doc_id)
"""


@registered
def op1_span_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the passages that an earlier one holds, and where they were."""
    return spans.drop_repeated_spans(read(spark, sf_dir, "documents")).select(
        "doc_id", "n_sentences", "n_removed", "spans", sha256(F.col("text")).alias("kept_sha256")
    )


@registered
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every fiftieth."""
    return neighbours.nearest(read(spark, sf_dir, "embeddings"))


@registered
def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's licences and the wording they were confirmed by."""
    return licenses.scan(read(spark, sf_dir, "documents"))


@registered
def op11_retrieval_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document, in sequences of documents that are near each other."""
    return packing.pack(read(spark, sf_dir, "documents"), word_vocabulary()).select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
        "score",
    )


@registered
def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every hundredth vector; every seventh has the next label."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(read(spark, sf_dir, "embeddings").withColumn("label", moved))


ORACLES["op12_hard_negatives"] = r"""
WITH rows AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(CAST(x AS DOUBLE) * 256)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS same,
         CAST(list_dot_product(a.v, b.v) AS BIGINT) AS score
  FROM rows a JOIN rows b ON a.vec_id <> b.vec_id AND a.vec_id % 100 = 0
), positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""


@registered
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as it is to be learned from, and the text read back from that."""
    made = infill.fill_in_middle(read(spark, sf_dir, "documents"))
    return made.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        sha256(F.col("output")).alias("output_sha256"),
        sha256(infill.restored(F.col("output"), F.col("form"))).alias("restored_sha256"),
    )


ORACLES["op13_fill_in_middle"] = r"""
WITH drawn AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS w
  FROM documents
), ranks AS (
  SELECT *, len(w) AS n, ('0x' || h[1:8])::BIGINT % (len(w) + 1) AS x, ('0x' || h[9:16])::BIGINT % (len(w) + 1) AS y,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                OR ('0x' || h[17:24])::BIGINT % 100 >= 50 THEN 'plain'
              WHEN ('0x' || h[25:32])::BIGINT % 100 < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), cut AS (
  SELECT *, array_to_string(w[1:least(x, y)], '') AS p,
         array_to_string(w[least(x, y) + 1:greatest(x, y)], '') AS m, array_to_string(w[greatest(x, y) + 1:], '') AS s
  FROM ranks
)
SELECT doc_id, n::BIGINT AS n, form,
       CASE WHEN form <> 'plain' THEN length(p)::BIGINT END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m)::BIGINT END AS middle_chars,
       sha256(CASE form WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        WHEN 'spm' THEN '<S>' || s || '<P>' || p || '<M>' || m ELSE t END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM cut
"""
