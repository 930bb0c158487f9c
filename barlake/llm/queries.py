"""The registered queries of this subpackage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barlake.llm import quality, toxicity
from barlake.llm.chat import format_chats
from barlake.llm.decontamination import decontaminate
from barlake.llm.jaccard import link_documents
from barlake.llm.language_model import score_texts
from barlake.llm.mixing import pareto_mix
from barlake.llm.resampling import importance_resample
from barlake.llm.simhash import edited_fingerprints, with_near_rows
from barlake.llm.storage import read, written
from barlake.llm.substrings import remove_repeated_windows
from barlake.llm.suffixes import remove_repeated_substrings
from barlake.llm.trie import ordered_turns, prefix_trie, rebuilt
from barlake.llm.warc import archived


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With the number of rows within three bits for a query set: ids divisible by 100."""
    prints = written(edited_fingerprints(read(spark, sf_dir, "documents")), "prints")
    return with_near_rows(prints, F.col("doc_id") % 100 == 0).drop("f0", "f1")


def _remainder(divisor: int) -> Column:
    """crc32 of the id as text, by the divisor."""
    return F.crc32(F.col("doc_id").cast("string")) % divisor


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").filter(toxicity.learnt_from(F.col("doc_id")))
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(_remainder(3) == 1, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"),
    )


def op3_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = _remainder(7)
    part = F.when(remainder == 2, 2).when(remainder == 3, 1).otherwise(0)
    return score_texts(read(spark, sf_dir, "documents"), part, order=3)


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return format_chats(read(spark, sf_dir, "conversations"))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    back = archived(read(spark, sf_dir, "pages"))
    return back.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate(docs, read(spark, sf_dir, "benchmark"))
    ids = F.array_sort(F.transform("_items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        F.col("_words").alias("n_words"),
        F.col("_hits").alias("n_hit"),
        F.size("_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(ids, ","), 256).alias("items_sha256"),
        (F.col("_hits") > 0).alias("contaminated"),
    )


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pareto_mix(read(spark, sf_dir, "documents"))


def op8_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeated_windows(read(spark, sf_dir, "documents"))
    return kept.select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


def op9_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return link_documents(read(spark, sf_dir, "documents"), n=4, percent=85)


def op10_suffixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    removed = F.aggregate(
        "_removed", F.lit(0).cast("long"), lambda total, span: total + span["end"] - span["start"]
    )
    return remove_repeated_substrings(docs).select(
        "doc_id",
        F.col("_bytes").alias("n_bytes"),
        removed.alias("n_removed"),
        F.size("_removed").cast("long").alias("n_spans"),
        F.sha2("_kept", 256).alias("kept_sha256"),
    )


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read(spark, sf_dir, "labels").filter(quality.learnt_from(F.col("doc_id")))
    scored = quality.score(docs, quality.fit(docs, labels))
    return scored.select(
        "doc_id",
        F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    drawn = importance_resample(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie(*rebuilt(*ordered_turns(read(spark, sf_dir, "conversations"))))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_simhash": op1_simhash,
        "op2_toxicity": op2_toxicity,
        "op3_language_model": op3_language_model,
        "op4_chat": op4_chat,
        "op5_warc": op5_warc,
        "op6_decontamination": op6_decontamination,
        "op7_mixing": op7_mixing,
        "op8_substrings": op8_substrings,
        "op9_jaccard": op9_jaccard,
        "op10_suffixes": op10_suffixes,
        "op11_quality": op11_quality,
        "op12_resampling": op12_resampling,
        "op13_prefix_trie": op13_prefix_trie,
        "pipeline": pipeline,
    }


# Words between blanks, and words of digits and letters, of one table's texts.
_BLANK = r"[^ \t-\r]+"
_LETTERS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _words_sql(text: str, pattern: str, lower: bool) -> str:
    text = f"coalesce({text}, '')"
    text = _LOWER.format(text) if lower else text
    return f"regexp_extract_all({text}, '{pattern}')"


_WARC_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS h, sha1(coalesce(html, '')) AS s,
         min(page_id) OVER (PARTITION BY coalesce(html, '')) AS first
  FROM pages)
SELECT page_id, CAST(octet_length(encode(h)) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + ((CAST('0x' || substr(s, 1 + 5 * (i // 4), 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31),
         1) FOR i IN range(32)], '') AS payload_digest,
       CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id > first THEN first END AS refers_to
FROM p"""

_LEAKS_SQL = f"""
WITH d AS (SELECT doc_id, {_words_sql("text", _LETTERS, True)} AS w FROM documents),
b AS (SELECT item_id, {_words_sql("text", _LETTERS, True)} AS w FROM benchmark),
m AS (SELECT item_id, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0),
item_windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS i FROM m)),
doc_windows AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS k
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM d, (SELECT DISTINCT n FROM m) WHERE len(w) >= n)),
found AS (SELECT doc_id, i, n, item_id FROM doc_windows JOIN item_windows USING (n, k)),
hits AS (SELECT doc_id, count(DISTINCT j) AS n_hit
         FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found)
          GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)"""

_WINDOWS_SQL = f"""
WITH d AS (SELECT doc_id, {_words_sql("text", _BLANK, False)} AS w FROM documents),
x AS (SELECT doc_id, i, md5(array_to_string(w[i:i + 49], ' ')) AS k
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d)),
firsts AS (SELECT k, min(doc_id) AS first FROM x GROUP BY k),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS j
         FROM x JOIN firsts USING (k) WHERE first < doc_id),
numbered AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS j FROM d),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY j) AS t
         FROM numbered ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id),
removed AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id) LEFT JOIN removed USING (doc_id)"""

_SUFFIXES_SQL = """
WITH d AS (SELECT row_number() OVER () AS r, doc_id, encode(coalesce(text, '')) AS b FROM documents),
x AS (SELECT r, i, md5(b[i:i + 199]) AS k
      FROM (SELECT r, b, unnest(range(1, octet_length(b) - 198)) AS i FROM d
            WHERE octet_length(b) >= 200)),
hits AS (SELECT r, i FROM x SEMI JOIN (SELECT k FROM x GROUP BY k HAVING count(*) > 1) USING (k)),
runs AS (SELECT r, i, sum(CAST(new AS INT)) OVER (PARTITION BY r ORDER BY i) AS run
         FROM (SELECT r, i, coalesce(i > lag(i) OVER (PARTITION BY r ORDER BY i) + 200, true) AS new
               FROM hits)),
spans AS (SELECT r, min(i) AS s, max(i) + 199 AS e FROM runs GROUP BY r, run),
pieces AS (
  SELECT r, s, hex(b[coalesce(lag(e) OVER (PARTITION BY r ORDER BY s), 0) + 1:s - 1]) AS h
  FROM spans JOIN d USING (r)
  UNION ALL
  SELECT r, max(e) + 1, hex(any_value(b)[max(e) + 1:octet_length(any_value(b))])
  FROM spans JOIN d USING (r) GROUP BY r),
kept AS (SELECT r, unhex(string_agg(h, '' ORDER BY s)) AS b FROM pieces GROUP BY r),
sums AS (SELECT r, count(*) AS n_spans, CAST(sum(e - s + 1) AS BIGINT) AS n_removed FROM spans GROUP BY r)
SELECT doc_id, CAST(octet_length(d.b) AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed,
       coalesce(n_spans, 0) AS n_spans, sha256(coalesce(kept.b, d.b)) AS kept_sha256
FROM d LEFT JOIN kept USING (r) LEFT JOIN sums USING (r)"""

_JACCARD_SQL = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_words_sql("text", _BLANK, True)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i
            FROM d WHERE len(w) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
shared AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS m
           FROM s a JOIN s b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
          WHERE 100 * m >= 85 * (x.n + y.n - m)),
reach AS (SELECT doc_id, doc_id AS other FROM documents
          UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a),
groups AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id),
degrees AS (SELECT a AS doc_id, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, coalesce(n_links, 0) AS n_links
FROM groups LEFT JOIN sizes USING (doc_id) LEFT JOIN degrees USING (doc_id)"""



def _crc32_sql(text: str, table: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of ``text``; ``table`` is a list of 256 numbers."""
    bytes_ = (
        f"[CAST('0x' || substr(hex(encode({text})), 2 * i - 1, 2) AS BIGINT) "
        f"FOR i IN range(1, CAST(strlen({text}) AS BIGINT) + 1)]"
    )
    step = f"xor(c // 256, {table}[CAST(xor(c % 256, b) AS BIGINT) + 1])"
    return (
        f"xor(list_reduce(list_prepend(4294967295, {bytes_}), lambda c, b: {step}), 4294967295)"
    )


# The table of CRC-32: eight steps of its polynomial, bits reversed, for each byte.
_CRC_TABLE_SQL = """crc AS (
  SELECT list(list_reduce(list_prepend(b, range(8)),
                          lambda c, i: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384)
                                            ELSE c // 2 END) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b))"""

_RESAMPLING_SQL = f"""
WITH {_CRC_TABLE_SQL},
d AS (SELECT doc_id, {_words_sql("text", _LETTERS, True)} AS w FROM documents),
dw AS (SELECT doc_id, unnest(w) AS w FROM d),
bw AS (SELECT unnest({_words_sql("text", _LETTERS, True)}) AS w FROM benchmark),
buckets AS (SELECT w, {_crc32_sql("w", "t")} % 10000 AS b
            FROM (SELECT w FROM dw UNION SELECT w FROM bw), crc),
s AS (SELECT b, count(*) AS n FROM dw JOIN buckets USING (w) GROUP BY b),
t AS (SELECT b, count(*) AS n FROM bw JOIN buckets USING (w) GROUP BY b),
sums AS (SELECT (SELECT count(*) FROM dw) AS s, (SELECT count(*) FROM bw) AS t),
gains AS (
  SELECT b, CAST(floor(1000 * ln(
      (CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * (sums.s + 10000)
      / ((CAST(coalesce(s.n, 0) AS DOUBLE) + 1) * (sums.t + 10000)))) AS BIGINT) AS gain
  FROM (SELECT DISTINCT b FROM buckets) LEFT JOIN s USING (b) LEFT JOIN t USING (b), sums),
weights AS (SELECT doc_id, sum(gain) AS weight
            FROM dw JOIN buckets USING (w) JOIN gains USING (b) GROUP BY doc_id),
scored AS (
  SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features,
         CAST(coalesce(weight, 0) AS BIGINT) AS weight,
         CAST(coalesce(weight, 0) + floor(-1000 * ln(-ln((CAST('0x' || substr(
           sha256('2024:' || doc_id), 1, 8) AS BIGINT) + 0.5::DOUBLE) / 4294967296::DOUBLE)))
           AS BIGINT) AS score
  FROM d LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS r
           FROM scored WHERE n_features >= 20),
quota AS (SELECT 10 * count(*) // 100 AS q FROM ranked)
SELECT doc_id, n_features, weight, score, CASE WHEN r <= q THEN r END AS rank
FROM scored LEFT JOIN ranked USING (doc_id), quota"""


_TRIE_SQL = f"""
WITH {_CRC_TABLE_SQL},
t AS (SELECT conv_id, turn, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS said
      FROM conversations WHERE conv_id IS NOT NULL),
l AS (SELECT conv_id, list(said ORDER BY turn NULLS FIRST, md5(length(said.role) || ':' || said.role
                           || said.text), strlen(said.text)) AS turns
      FROM t GROUP BY conv_id),
c AS (SELECT conv_id, turns, conv_id - conv_id % 5 AS giver,
             CAST({_crc32_sql("CAST(conv_id AS VARCHAR)", "crc.t")} % 9 AS BIGINT) AS h FROM l, crc),
r AS (SELECT c.conv_id, list_concat(coalesce(g.turns[1:h], []), c.turns[h + 1:]) AS turns
      FROM c LEFT JOIN l g ON g.conv_id = c.giver),
m AS (SELECT conv_id, d, turns[1:d] AS prefix, len(turns) = d AS ends
      FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM r)),
nodes AS (SELECT d, prefix, min(conv_id) AS node, count(*) AS n,
                 coalesce(strlen(prefix[-1].text), 0) AS size,
                 sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                                 FILTER (ends), '')) AS ends_sha256
          FROM m GROUP BY d, prefix),
mm AS (SELECT conv_id, d, node FROM m JOIN nodes USING (d, prefix)),
up AS (SELECT u.node, u.d, mm.node AS parent
       FROM nodes u JOIN mm ON mm.conv_id = u.node AND mm.d = u.d - 1),
kids AS (SELECT parent AS node, d - 1 AS d, count(*) AS n FROM up GROUP BY ALL),
below AS (SELECT mm.node, mm.d, sum((u.n - 1) * u.size) AS saved, count_if(k.n IS NULL) AS leaves
          FROM nodes u LEFT JOIN kids k USING (node, d)
          JOIN mm ON mm.conv_id = u.node AND mm.d <= u.d GROUP BY mm.node, mm.d)
SELECT node AS conv_id, d AS depth, up.parent AS parent_conv_id, nodes.n AS n_convs,
       coalesce(kids.n, 0) AS n_children, CAST(leaves AS BIGINT) AS n_leaves,
       CAST(saved AS BIGINT) AS saved_tokens, ends_sha256
FROM nodes JOIN below USING (node, d) LEFT JOIN up USING (node, d) LEFT JOIN kids USING (node, d)"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL of the queries that it can express."""
    return {
        "op5_warc": _WARC_SQL,
        "op6_decontamination": _LEAKS_SQL,
        "op8_substrings": _WINDOWS_SQL,
        "op9_jaccard": _JACCARD_SQL,
        "op10_suffixes": _SUFFIXES_SQL,
        "op12_resampling": _RESAMPLING_SQL,
        "op13_prefix_trie": _TRIE_SQL,
    }
