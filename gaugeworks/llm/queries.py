"""One query per operator over whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gaugeworks.llm import (
    bm25_packing,
    bpe_bitmap,
    cross_polytope,
    language_id,
    license_zstd,
    line_dedup,
    orchard_codes,
    prefix_trie,
    quality_forest,
    simhash_tiles,
    suffix_columns,
    super_minhash,
    token_files,
)
from gaugeworks.llm.shared import shared_folder

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
MULTI_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables. Workers get the folder of this package, should it not be installed there."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Learns from text and lang of rows that are not held out, and predicts every row from its text."""
    documents = table(spark, sf_dir, "documents")
    held_out = language_id.held_out(F.col("doc_id"))
    model = language_id.fit(documents.where(~held_out).select("text", "lang"))
    found = documents.select("doc_id", held_out.alias("held_out"), language_id.predict(F.col("text"), model).alias("p"))
    return found.select("doc_id", "held_out", "p.*")


def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Writes all documents as token files and returns what is read back from them."""
    documents = table(spark, sf_dir, "documents")
    path = shared_folder(spark, "token-files")
    token_files.write_token_files(documents, path, BYTE_BPE, end_id=2)
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many units of each document go, their code points, and the MD5 of what stays (null text: null)."""
    kept = line_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"), spans_as="spans")
    lost = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["end"] - s["start"])
    return kept.select("doc_id", F.size("spans").cast("bigint").alias("n_removed"), lost.alias("removed_chars"), F.md5("text").alias("kept_md5"))


OP3_SQL = """
WITH cut AS (
  SELECT doc_id, string_split(regexp_replace(text, '([.!?][\\x09-\\x0D ]+|\\n)', '\\1' || chr(1), 'g'), chr(1)) AS pieces
  FROM documents WHERE text IS NOT NULL
), pieces AS (
  SELECT doc_id, unnest(pieces) AS piece, generate_subscripts(pieces, 1) AS place FROM cut
), normal AS (
  SELECT *, trim(regexp_replace(translate(piece, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x09-\\x0D ]+', ' ', 'g'), ' ') AS norm
  FROM pieces
), numbered AS (
  SELECT *, CASE WHEN norm = '' THEN 0 ELSE len(string_split(norm, ' ')) END AS n,
         count(*) FILTER (norm <> '' AND len(string_split(norm, ' ')) >= 6)
           OVER (PARTITION BY doc_id ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS unit
  FROM normal
), units AS (
  SELECT doc_id, unit, sum(n) AS n, string_agg(piece, '' ORDER BY place) AS text,
         string_agg(norm, ' ' ORDER BY place) FILTER (norm <> '') AS norm
  FROM numbered GROUP BY doc_id, unit
), ranked AS (
  SELECT *, n > 0 AND row_number() OVER (PARTITION BY norm ORDER BY doc_id, unit) > 1 AS later FROM units
), runs AS (
  SELECT *, unit - row_number() OVER (PARTITION BY doc_id, later ORDER BY unit) AS run FROM ranked
), judged AS (
  SELECT *, later AND sum(n) OVER (PARTITION BY doc_id, later, run) >= 16 AS gone FROM runs
)
SELECT d.doc_id, coalesce(n_removed, 0) AS n_removed, coalesce(removed_chars, 0) AS removed_chars,
       CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(kept, '')) END AS kept_md5
FROM documents d LEFT JOIN (
  SELECT doc_id, count(*) FILTER (gone) AS n_removed,
         CAST(coalesce(sum(length(text)) FILTER (gone), 0) AS BIGINT) AS removed_chars,
         string_agg(text, '' ORDER BY unit) FILTER (NOT gone) AS kept
  FROM judged GROUP BY doc_id
) r ON d.doc_id = r.doc_id
"""


def op4_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = suffix_columns.remove_repeated_strings(documents, length=200)
    n_bytes = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint")
    return found.select(
        "doc_id",
        n_bytes.alias("n_bytes"),
        (n_bytes - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_tiles.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, radius=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op6_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_polytope.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25_packing.pack_documents(table(spark, sf_dir, "documents"), BYTE_BPE, end_id=0, window=1024)


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = bpe_bitmap.round_trip(F.col("text"), MULTI_RANKS, public_tokenizers.PATTERN)
    return table(spark, sf_dir, "documents").select("doc_id", coded.alias("coded")).select("doc_id", "coded.*")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality_forest.fit(documents, table(spark, sf_dir, "labels"))
    return quality_forest.judge(documents.select("doc_id", "text"), model, "verdict").select("doc_id", "verdict.*")


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each license found in a document."""
    return license_zstd.scan_licenses(table(spark, sf_dir, "documents"))


def op11_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Codes of all vectors, their errors, the error of their label and the digest of the final codebooks."""
    found, books = orchard_codes.compress(table(spark, sf_dir, "embeddings"))
    digits = F.transform("code", lambda i: F.lpad(F.lower(F.hex(i)), 2, "0"))
    sha = F.lit(books.sha256()).alias("codebooks_sha256")
    return found.select("vec_id", F.array_join(digits, "").alias("code"), "error", "label_error", sha)


#: The first codebooks, six rounds and the final codes, one table expression for each step.
OP11_SQL = """
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v, len(embedding) // 8 AS w
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS (
  SELECT vec_id, (i - 1) // w AS part, (i - 1) % w AS place, v[i] AS x
  FROM (SELECT *, unnest(range(1, 8 * w + 1)) AS i FROM kept)
), b0 AS (
  SELECT part, rank AS entry, place, x
  FROM parts JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS rank FROM kept) USING (vec_id) WHERE rank < 16
)""" + "".join(
    f""", a{i} AS (
  SELECT vec_id, part, entry, d FROM (
    SELECT p.vec_id, p.part, b.entry, sum((p.x - b.x) * (p.x - b.x)) AS d
    FROM parts p JOIN b{i} b ON p.part = b.part AND p.place = b.place GROUP BY p.vec_id, p.part, b.entry)
  QUALIFY row_number() OVER (PARTITION BY vec_id, part ORDER BY d, entry) = 1
)""" + (f""", b{i + 1} AS (
  SELECT b.part, b.entry, b.place, coalesce(m.x, b.x) AS x FROM b{i} b LEFT JOIN (
    SELECT part, entry, place, (CAST(sum(x) AS BIGINT) - ((CAST(sum(x) AS BIGINT) % count(*)) + count(*)) % count(*)) // count(*) AS x
    FROM parts JOIN a{i} USING (vec_id, part) GROUP BY part, entry, place
  ) m ON b.part = m.part AND b.entry = m.entry AND b.place = m.place
)""" if i < 6 else "")
    for i in range(7)
) + """, coded AS (
  SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a6 GROUP BY vec_id
), books AS (SELECT sha256(string_agg(CAST(x AS VARCHAR), ',' ORDER BY part, entry, place)) AS codebooks_sha256 FROM b6)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), books
"""


def op12_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicates at a similarity of 0.8 of sets of 4 words, one row for each document."""
    return super_minhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, percent=80)


OP12_SQL = """
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[\x09-\x0D ]+'), lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')))
                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s
  FROM words
), items AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), links AS (
  SELECT a.doc_id AS u, b.doc_id AS v FROM items a JOIN items b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT doc_id AS u, doc_id AS v FROM sets UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u
), components AS (SELECT u AS doc_id, min(v) AS component_id FROM reach GROUP BY u)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN components USING (doc_id)
"""


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the trie of conversations whose heads come from every twentieth one."""
    return prefix_trie.conversation_trie(table(spark, sf_dir, "conversations"), every=20)


#: CRC-32 of the decimal number is taken bit by bit: eight shifts for each byte.
OP13_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), whole AS (
  SELECT conv_id, list({'r': role, 't': text} ORDER BY pos) AS own,
         xor(4294967295, list_reduce(list_concat([4294967295], list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda x: CAST(ord(x) AS BIGINT))),
           lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: xor(x >> 1, 3988292384 * (x & 1))))) % 4 AS h
  FROM t GROUP BY conv_id
), rebuilt AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS seq
  FROM whole c LEFT JOIN whole b ON b.conv_id = c.conv_id - c.conv_id % 20
), prefixes AS (
  SELECT conv_id, d, CAST(seq[1:d] AS VARCHAR) || len(seq[1:d]) AS id, CASE WHEN d > 0 THEN CAST(seq[1:d - 1] AS VARCHAR) || (d - 1) END AS parent,
         CASE WHEN d > 0 THEN len(list_filter(regexp_split_to_array(seq[d].t, '[\x09-\x0D ]+'), lambda x: x <> '')) ELSE 0 END AS words, d = len(seq) AS ends
  FROM (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT id, any_value(parent) AS parent, any_value(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
         sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM prefixes GROUP BY id
), kids AS (SELECT parent AS id, count(*) AS n FROM nodes GROUP BY parent
), valued AS (SELECT nodes.*, coalesce(n, 0) AS n_children, (n_convs - 1) * words AS tokens FROM nodes LEFT JOIN kids USING (id)
), below AS (
  SELECT a.id, sum(CASE WHEN v.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(v.tokens) AS saved_tokens
  FROM valued v JOIN prefixes p ON p.conv_id = v.conv_id AND p.d <= v.depth JOIN nodes a ON a.id = p.id GROUP BY a.id
)
SELECT v.conv_id, v.depth, up.conv_id AS parent_conv_id, v.n_convs, v.n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
       CAST(saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM valued v JOIN below USING (id) LEFT JOIN nodes up ON up.id = v.parent
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_language_id": op1_language_id,
    "op2_token_files": op2_token_files,
    "op3_line_dedup": op3_line_dedup,
    "op4_repeated_strings": op4_repeated_strings,
    "op5_simhash": op5_simhash,
    "op6_nearest": op6_nearest,
    "op7_packing": op7_packing,
    "op8_bpe": op8_bpe,
    "op9_quality": op9_quality,
    "op10_licenses": op10_licenses,
    "op11_orchard_codes": op11_orchard_codes,
    "op12_minhash": op12_minhash,
    "op13_prefix_trie": op13_prefix_trie,
}

#: SQL in DuckDB for the same rows.
ORACLE: dict[str, str] = {
    "op3_line_dedup": OP3_SQL,
    "op11_orchard_codes": OP11_SQL,
    "op12_minhash": OP12_SQL,
    "op13_prefix_trie": OP13_SQL,
}
