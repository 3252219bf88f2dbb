"""The registered queries of the text operators, and their SQL where it exists.

Each query applies one operator, with its production parameters, to the whole
of its tables and derives the columns of its result from the operator's.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from airlag.llm import langid, pii, quality
from airlag.llm.common import crc_remainder, materialize, read
from airlag.llm.cross_tokenizer import cross_alignment
from airlag.llm.decontaminate import contamination
from airlag.llm.fingerprints import edit_likeness
from airlag.llm.line_dedup import dedup_lines
from airlag.llm.near_dedup import near_duplicates
from airlag.llm.packing import cut_pieces, place_pieces
from airlag.llm.run_index import dedup_substrings
from airlag.llm.spelling import spelling_variants
from airlag.llm.token_counts import token_counts
from airlag.llm.token_files import read_token_files, scratch_token_folder, write_token_files

BYTE_BPE = "byte_bpe_50k.json"
WORD_BPE = "word_bpe_49k.json"
PIECE_BPE = "piece_bpe_32k.model"


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    tokenizer = public_tokenizers.path(BYTE_BPE)
    manifest = write_token_files(docs, tokenizer, scratch_token_folder(spark))
    return read_token_files(spark, manifest)


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
    "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
OP2_SQL = f"""
WITH doc AS (
  SELECT doc_id, {_WORDS} AS words FROM documents
), item AS (
  SELECT CAST(item_id AS VARCHAR) AS item_id, {_WORDS} AS words FROM benchmark
), item_window AS (
  SELECT DISTINCT item_id, least(len(words), 10) AS n, array_to_string(words[i : i + 9], ' ') AS body
  FROM item, unnest(range(1, greatest(len(words) - 9, 1) + 1)) AS t(i) WHERE len(words) > 0
), doc_window AS (
  SELECT doc_id, i, n, array_to_string(words[i : i + n - 1], ' ') AS body
  FROM doc, (SELECT DISTINCT n FROM item_window), unnest(range(1, len(words) - n + 2)) AS t(i)
), hit AS (
  SELECT DISTINCT doc_id, i, n, item_id FROM doc_window JOIN item_window USING (n, body)
), covered AS (
  SELECT doc_id, count(DISTINCT k) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS k FROM hit) GROUP BY doc_id
), found AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id
)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    pieces = cut_pieces(docs, public_tokenizers.path(WORD_BPE))
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place_pieces(materialize(digests))


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(read(spark, sf_dir, "documents"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(read(spark, sf_dir, "documents"), public_tokenizers.path(BYTE_BPE))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(read(spark, sf_dir, "documents"))

    def number(kind: int) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")

    return found.select(
        "doc_id",
        *[number(i).alias(f"n_{kind}") for i, kind in enumerate(pii.KINDS)],
        F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"),
        pii.joined(F.array_sort(F.concat("base", "added"))).alias("spans"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(read(spark, sf_dir, "documents"))
    runs = F.transform("removed", lambda r: F.concat_ws("-", r["first_line"], r["last_line"]))
    return found.select(
        "doc_id",
        "n_lines",
        "n_removed",
        F.array_join(runs, ",").alias("removed"),
        F.sha2(F.col("text").cast("binary"), 256).alias("text_sha256"),
    )


OP7_SQL = """
WITH line AS (
  SELECT doc_id, hash AS text_hash, i - 1 AS line_no, lines, lines[i] AS line,
         greatest(len(regexp_extract_all(lines[i], '\\S+')), 1) AS words
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines, md5(text) AS hash
        FROM documents) d, unnest(range(1, len(lines) + 1)) AS t(i)
), placed AS (
  SELECT *, sum(words) OVER (PARTITION BY doc_id ORDER BY line_no) AS stop,
         sum(words) OVER (PARTITION BY doc_id ORDER BY line_no) - words AS start,
         sum(words) OVER (PARTITION BY doc_id) AS total
  FROM line
), sized AS (
  SELECT *, count(*) OVER (PARTITION BY doc_id ORDER BY start RANGE BETWEEN 0 PRECEDING AND 49 FOLLOWING) AS l,
         count(*) OVER (PARTITION BY doc_id ORDER BY stop RANGE BETWEEN 49 PRECEDING AND 0 FOLLOWING) AS r
  FROM placed
), run AS (
  SELECT DISTINCT doc_id, line_no AS first_line, line_no + l - 1 AS last_line,
         array_to_string(lines[line_no + 1 : line_no + l], chr(10)) AS body
  FROM sized WHERE start + 50 <= total
  UNION
  SELECT DISTINCT doc_id, line_no - r + 1, line_no,
         array_to_string(lines[line_no - r + 2 : line_no + 1], chr(10))
  FROM sized WHERE stop >= 50
), later AS (
  SELECT doc_id, first_line, last_line,
         row_number() OVER (PARTITION BY body ORDER BY doc_id, first_line) AS copy
  FROM run
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(first_line, last_line + 1)) AS line_no FROM later WHERE copy > 1
), island AS (
  SELECT doc_id, line_no, line_no - row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS k FROM gone
), cut AS (
  SELECT doc_id, min(line_no) AS a, max(line_no) AS b FROM island GROUP BY doc_id, k
), cuts AS (
  SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS removed, sum(b - a + 1) AS n FROM cut GROUP BY doc_id
), kept AS (
  SELECT line.doc_id, string_agg(line, chr(10) ORDER BY line_no) AS text
  FROM line ANTI JOIN gone USING (doc_id, line_no) GROUP BY line.doc_id
)
SELECT d.doc_id, CAST(len(string_split(d.text, chr(10))) AS BIGINT) AS n_lines,
       CAST(coalesce(c.n, 0) AS BIGINT) AS n_removed, coalesce(c.removed, '') AS removed,
       sha256(coalesce(k.text, '')) AS text_sha256
FROM documents d LEFT JOIN cuts c USING (doc_id) LEFT JOIN kept k USING (doc_id)
"""


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = edit_likeness(read(spark, sf_dir, "documents"))
    spelled = {c: F.lower(F.hex(c)) for c in ("fingerprint", "edited_fingerprint")}
    return found.withColumns(spelled)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    held_out = crc_remainder() == 2
    model = quality.fit(docs, labels.where(~held_out))
    scored = quality.score_quality(docs, model)
    predicted = (F.col("score") >= 0.7).cast("int")
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    held_out = crc_remainder() == 2
    model = langid.fit(docs.where(~held_out))
    found = langid.predict_language(docs, model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(read(spark, sf_dir, "documents"))
    sizes = F.transform("spans", lambda s: s["stop"] - s["start"])
    return found.select(
        "doc_id",
        "n_bytes",
        F.aggregate(sizes, F.lit(0).cast("long"), lambda a, b: a + b).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op12_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling_variants(read(spark, sf_dir, "documents"))
    return found.select("word", "form", "root", "n", "n_near", "form_n")


OP12_SQL = """
WITH RECURSIVE run AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id,
         unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                   '[A-Za-zÀ-ÿ]+')) AS run
  FROM documents
), crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(CAST(i AS BIGINT), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                          lambda c, k: CASE WHEN c % 2 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i))
), hashed AS (
  SELECT run, xor(4294967295, list_reduce(
           list_prepend(4294967295::BIGINT, list_transform(range(1, CAST(octet_length(b) AS BIGINT) + 1),
             lambda i: CAST('0x' || substr(hex(b), 2 * i - 1, 2) AS BIGINT))),
           lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8))) AS h, n
  FROM (SELECT run, encode(id || ':' || run) AS b, count(*) AS n FROM run WHERE len(run) >= 5 GROUP BY ALL), crc_table
), word AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % 97 = 0
                THEN run[1 : CAST(h % len(run) AS BIGINT)] || run[CAST(h % len(run) AS BIGINT) + 2 :]
                ELSE run END AS word, n FROM hashed)
  WHERE len(word) >= 5 GROUP BY word HAVING sum(n) >= 3
), hole AS (
  SELECT word, n, len(word) AS l, i, word[1 : i - 1] || word[i + 1 :] AS rest
  FROM word, unnest(range(1, len(word) + 1)) AS t(i)
), near AS (
  SELECT a.word, b.word AS other FROM hole a JOIN hole b USING (rest, l, i) WHERE a.word <> b.word
  UNION SELECT a.word, b.rest FROM hole a JOIN hole b ON a.word = b.word JOIN word w ON w.word = b.rest
  UNION SELECT b.rest, b.word FROM hole b JOIN word w ON w.word = b.rest
), best AS (
  SELECT near.word, count(*) AS n_near, max(o.n) AS best_n
  FROM near JOIN word o ON o.word = near.other GROUP BY near.word
), form AS (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= 2 * w.n THEN best_n END AS form_n,
         (SELECT min(o.word) FROM near JOIN word o ON o.word = near.other
          WHERE near.word = w.word AND o.n = best_n AND best_n >= 2 * w.n) AS form
  FROM word w LEFT JOIN best USING (word)
), walk AS (
  SELECT word, word AS root FROM form
  UNION SELECT walk.word, form.form FROM walk JOIN form ON form.word = walk.root WHERE form.form IS NOT NULL
)
SELECT f.word, f.form, walk.root, f.n, f.n_near, f.form_n
FROM form f JOIN walk ON walk.word = f.word JOIN form r ON r.word = walk.root WHERE r.form IS NULL
"""


def op13_cross_tokenizer(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    return cross_alignment(docs, public_tokenizers.path(BYTE_BPE), public_tokenizers.path(PIECE_BPE))


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_files, op2_decontamination, op3_packing, op4_near_dedup, op5_token_counts,
        op6_pii, op7_line_dedup, op8_fingerprints, op9_quality, op10_language,
        op11_substring_dedup, op12_spelling, op13_cross_tokenizer,
    )
}

ORACLE: dict[str, str] = {
    "op2_decontamination": OP2_SQL, "op7_line_dedup": OP7_SQL, "op12_spelling": OP12_SQL,
}
