"""The registered queries of this package: each operator over its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bidlens.llm import (
    alignment, bpe, chat, collocation, decontaminate, exactdedup, htmltext, linededup, quality, simhash, substring,
    suffixes, tokencount,
)
from bidlens.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")
WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, sql: str | None = None):
    def keep(build):
        QUERIES[name] = build
        if sql is not None:
            ORACLES[name] = sql
        return build
    return keep


@query("op1_bpe")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"), BYTE_BPE)


@query("op2_simhash")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_groups(table(spark, sf_dir, "documents"))


@query("op3_decontaminate")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.overlaps(table(spark, sf_dir, "documents"),
                                  table(spark, sf_dir, "benchmark"))


@query("op4_token_counts")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokencount.token_counts(table(spark, sf_dir, "documents"), WORD_BPE)


@query("op5_exact_dedup", r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
           FROM documents),
     g AS (SELECT body, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY body)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
FROM t JOIN g USING (body)""")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exactdedup.exact_groups(table(spark, sf_dir, "documents"))


@query("op6_substring_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op7_html_text")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text(table(spark, sf_dir, "pages")).withColumn(
        "n_chars", F.length("text").cast("long"))


@query("op8_line_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_quality")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query("op10_chat_format", r"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
           FROM conversations
           UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
           UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
     e AS (SELECT *, length(regexp_replace(replace(role || ' ' || text, '\', '\\'),
                                           '(</?s>|\[/?INST\])', '\1#', 'g')) - 1 AS shown FROM t)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text))
           AS turns_sha256,
       cast(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS bigint) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text)
           FILTER (role = 'assistant'), '')) AS loss_sha256,
       cast(sum(shown + CASE role WHEN 'assistant' THEN 14 ELSE 13 END) AS bigint) AS formatted_chars
FROM e GROUP BY conv_id""")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    added = spark.createDataFrame(
        [(-1, 0, "user", "</s>[INST] ok [/INST]"), (-1, 1, "assistant", "</s>[INST] ok [/INST]")],
        "conv_id long, turn long, role string, text string")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(chat.chat_format(turns.unionByName(added), BYTE_BPE), BYTE_BPE)


@query("op11_collocations", r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''),
                  'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
           FROM documents),
     w AS (SELECT lang, [x FOR x IN regexp_split_to_array(piece, '[\x20\x09]+') IF x <> ''] AS words FROM p),
     s AS (SELECT lang, words, unnest([1, 2, 3, 4]) AS size FROM w),
     i AS (SELECT lang, words, size, unnest(range(1, len(words) - size + 2)) AS pos FROM s),
     g AS (SELECT lang, size, array_to_string(list_slice(words, pos, pos + size - 1), ' ') AS phrase FROM i),
     f AS (SELECT lang, size, phrase, count(*) AS n FROM g GROUP BY ALL HAVING count(*) >= 30),
     t AS (SELECT lang, sum(len(words))::BIGINT AS n FROM w GROUP BY lang),
     c AS (SELECT lang, size, phrase, n AS a, string_split(phrase, ' ') AS words FROM f WHERE size > 1),
     o AS (SELECT lang, size, a, words, unnest(range(1, 4)) AS pos FROM c WHERE size > 2),
     v AS (SELECT lang, size, a, words, pos, unnest(range(2, size)) AS n FROM o),
     m AS (SELECT lang, array_to_string(list_slice(words, pos, pos + n - 1), ' ') AS phrase, max(a) AS longer
           FROM v WHERE pos + n - 1 <= size GROUP BY ALL),
     k AS (SELECT c.*, unnest(range(1, size)) AS cut FROM c LEFT JOIN m USING (lang, phrase)
           WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a),
     q AS (SELECT k.lang, k.phrase, k.a, k.cut, l.n AS l, r.n AS r, (2000000::HUGEINT * k.a) // (l.n + r.n) AS score
           FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(list_slice(words, 1, cut), ' ')
                  JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(list_slice(words, cut + 1, k.size), ' ')),
     b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) AS nth FROM q),
     z AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank
           FROM b WHERE nth = 1)
SELECT z.lang, rank, phrase, a, l, r, t.n, score::BIGINT AS score FROM z JOIN t USING (lang) WHERE rank <= 2000""")
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation.collocations(table(spark, sf_dir, "documents"))


@query("op12_suffix_array")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffixes.dedup_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


@query("op13_alignment")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"), BYTE_BPE, PIECES)
