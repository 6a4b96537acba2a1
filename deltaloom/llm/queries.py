"""The queries opN_<name> over whole tables, with production parameters, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from .common import table


def op1_crf_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language import identify

    return identify(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 4 == 2)


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import dedup_bytes

    return dedup_bytes(table(spark, sf_dir, "documents"), k=100)


def op3_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .chat import canonical_turns, format_chats, read_back

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", F.coalesce("text", F.lit("")).alias("text"))
    control = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", control), (-7, 1, "assistant", control)], "conv_id long, turn long, role string, text string")
    record = F.to_json(F.struct("turn", "role", "text"))
    turns = canonical_turns(rows.unionByName(own), "conv_id", record, "turn")
    return read_back(format_chats(turns, "conv_id"), "conv_id")


def op4_simhash_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import leaks

    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .html import extract_pages

    return extract_pages(table(spark, sf_dir, "pages"))


def op6_secret_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets import findings, train

    docs = table(spark, sf_dir, "documents")
    return findings(docs, train(spark, docs))


def op7_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring import dedup_words

    return dedup_words(table(spark, sf_dir, "documents"), k=13)


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicates

    found = near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=80)
    return found.withColumn("kept", F.col("doc_id") == F.col("component_id"))


def op9_quality_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import judge

    return judge(table(spark, sf_dir, "documents"))


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), 2048, 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_crf_language, op2_suffix_dedup, op3_chat_format, op4_simhash_decontamination, op5_main_text, op6_secret_forest, op7_debruijn_dedup, op8_minhash_dedup, op9_quality_outliers, op10_best_fit_packing)
}
_WORDS = r"regexp_extract_all({text}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _sql() -> dict[str, str]:
    """SQL of the queries that it can express; all of it in other words than the operators."""
    import re

    from .chat import BODY, CONTROL, END, TURN

    escapes = "|".join(re.escape(c[0]) + r"\\*" + re.escape(c[1:]) for c in CONTROL).replace("'", "''")
    size = lambda c: f"length({c}) + len(regexp_extract_all({c}, '{escapes}'))"
    return {
        "op3_chat_format": f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
UNION ALL SELECT -7, n, CASE n WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) r(n))
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
sha256(coalesce(string_agg(text, '' ORDER BY turn, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
CAST(sum({len(TURN) + len(BODY) + len(END)} + {size("role")} + {size("text")}) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id""",
        "op7_debruijn_dedup": f"""
WITH w AS (SELECT doc_id, {_WORDS.format(text="coalesce(text, '')")} AS w FROM documents),
x AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM w)),
m AS (SELECT g, min(doc_id) AS d FROM x GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM x JOIN m USING (g) WHERE d < doc_id),
one AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS i FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM one ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""",
        "op8_minhash_dedup": f"""
WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(text=_LOWER)} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, least(len(w), 1) + 1))) AS i FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
e2 AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT doc_id, doc_id AS c FROM documents UNION SELECT e2.b, r.c FROM r JOIN e2 ON e2.a = r.doc_id)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, component_id, w.doc_id = component_id AS kept
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT doc_id, min(c) AS component_id FROM r GROUP BY doc_id) USING (doc_id)""",
    }


SQL: dict[str, str] = _sql()
