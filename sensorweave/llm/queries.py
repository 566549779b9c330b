"""Registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorweave.llm.collocations import collocations
from sensorweave.llm.common import fold, table
from sensorweave.llm.decontaminate import contamination_report
from sensorweave.llm.exact_dedup import mark_duplicates
from sensorweave.llm.language_id import identify, train
from sensorweave.llm.lexical_search import search
from sensorweave.llm.packing import pack
from sensorweave.llm.pieces import encoding_report
from sensorweave.llm.pii import personal_data_report
from sensorweave.llm.quality import score_quality, train_quality
from sensorweave.llm.simhash import near_duplicates
from sensorweave.llm.suffix_dedup import repeat_report
from sensorweave.llm.token_counts import count_tokens
from sensorweave.llm.toxicity import score_toxicity, train_toxicity


OP5_SQL = """
WITH texts AS (SELECT doc_id, COALESCE(text, '') AS text FROM documents),
     classes AS (SELECT text, MAX(doc_id) AS keep_id, COUNT(*) AS group_size FROM texts GROUP BY text)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(text) AS text_sha256
FROM texts JOIN classes USING (text)
"""


WORDS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)
OP8_SQL = f"""
WITH docs AS (SELECT doc_id, {WORDS_SQL} AS w FROM documents),
     tests AS (SELECT item_id, {WORDS_SQL} AS w FROM benchmark),
     sized AS (SELECT item_id, w, least(10, len(w)) AS k FROM tests WHERE len(w) > 0),
     windows AS (SELECT DISTINCT item_id, k, list_slice(w, i, i + k - 1) AS win
                 FROM sized, unnest(range(1, len(w) - k + 2)) AS t(i)),
     places AS (SELECT doc_id, p, k, list_slice(w, p, p + k - 1) AS win
                FROM (SELECT docs.*, k FROM docs, (SELECT DISTINCT k FROM windows)), unnest(range(1, len(w) - k + 2)) AS t(p)),
     hits AS (SELECT doc_id, p, k, item_id FROM places JOIN windows USING (k, win)),
     covered AS (SELECT doc_id, count(DISTINCT word) AS n_hit
                 FROM (SELECT doc_id, unnest(range(p, p + k)) AS word FROM hits) GROUP BY doc_id),
     found AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
               FROM (SELECT DISTINCT doc_id, cast(item_id AS varchar) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, cast(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN found USING (doc_id)
"""


TERMS_SQL = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
    "'[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"
)
OP12_SQL = f"""
WITH docs AS (SELECT row_number() OVER () AS d, doc_id, {TERMS_SQL} AS w FROM documents),
     tests AS (SELECT row_number() OVER () AS i, item_id, {TERMS_SQL} AS w FROM benchmark),
     asked AS (SELECT DISTINCT i, item_id, unnest(w) AS term FROM tests),
     sizes AS (SELECT d, doc_id, len(w)::BIGINT AS n FROM docs WHERE len(w) > 0),
     corpus AS (SELECT count(*)::BIGINT AS held, sum(n)::BIGINT AS words FROM sizes),
     tfs AS (SELECT d, term, count(*) AS tf FROM (SELECT d, unnest(w) AS term FROM docs)
             WHERE term IN (SELECT term FROM asked) GROUP BY d, term),
     dfs AS (SELECT term, count(*) AS df FROM tfs GROUP BY term),
     weighed AS (SELECT term, floor(1000 * ln((2 * held + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w FROM dfs, corpus),
     scored AS (SELECT i, item_id, doc_id, d,
                       sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * held) // words))))::BIGINT AS score
                FROM asked JOIN weighed USING (term) JOIN tfs USING (term) JOIN sizes USING (d), corpus
                GROUP BY i, item_id, doc_id, d),
     ranked AS (SELECT item_id, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id)::INTEGER AS rank, doc_id, score
                FROM scored WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


OP13_SQL = """
WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
     cut AS (SELECT lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM pieces),
     totals AS (SELECT lang, sum(len(w))::BIGINT AS n FROM cut GROUP BY lang),
     grams AS (SELECT lang, k, list_slice(w, i, i + k - 1) AS g
               FROM cut, unnest(range(1, 6)) AS s(k), unnest(range(1, len(w) - k + 2)) AS t(i)),
     counts AS (SELECT lang, k, g, array_to_string(g, ' ') AS phrase, count(*) AS f FROM grams GROUP BY lang, k, g HAVING count(*) >= 100),
     cuts AS (SELECT c.lang, c.phrase, c.k, c.g, c.f AS a, j, x.f AS l, y.f AS r, n,
                     ((1000::HUGEINT * c.f * n) // (x.f::HUGEINT * y.f))::BIGINT AS score
              FROM counts c, unnest(range(1, c.k)) AS t(j)
              JOIN counts x ON x.lang = c.lang AND x.g = list_slice(c.g, 1, j)
              JOIN counts y ON y.lang = c.lang AND y.g = list_slice(c.g, j + 1, c.k)
              JOIN totals ON totals.lang = c.lang),
     lowest AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
     inner_phrases AS (SELECT lang, list_slice(g, i, i + m - 1) AS g, max(f) AS longer
                       FROM counts, unnest(range(2, k)) AS s(m), unnest(range(1, k - m + 2)) AS t(i) GROUP BY 1, 2),
     kept AS (SELECT lowest.* FROM lowest LEFT JOIN inner_phrases p ON p.lang = lowest.lang AND p.g = lowest.g
              WHERE p.longer IS NULL OR 100 * p.longer < 100 * a)
SELECT lang, rank, phrase, a, l, r, n, score
FROM (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM kept)
WHERE rank <= 2000
"""


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return count_tokens(table(spark, sf_dir, "documents"), vocabulary, limit=512)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), width=3, distance=3)


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data_report(table(spark, sf_dir, "documents"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    learned = fold("doc_id", 5) != 0
    model = train_toxicity(docs.filter(learned), labels.filter(learned))
    return score_toxicity(docs, model).select("doc_id", (~learned).alias("held_out"), "score", "predicted")


def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mark_duplicates(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return pack(table(spark, sf_dir, "documents"), vocabulary, capacity=2048, end_id=1)


def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeat_report(table(spark, sf_dir, "documents"), width=50)


def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), window=10)


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    learned = fold("doc_id", 5) != 0
    model = train_quality(docs.filter(learned))
    return score_quality(docs, model).select("doc_id", (~learned).alias("held_out"), "score", "predicted")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = train(docs.filter(fold("doc_id", 4) != 2))
    held_out = fold("doc_id", 4) == 2
    return identify(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = public_tokenizers.path("piece_bpe_32k.model")
    return encoding_report(table(spark, sf_dir, "documents"), model)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=50)


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"), least=100, top=2000, covered=100)


def registry() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_token_counts": op1_token_counts,
        "op2_simhash": op2_simhash,
        "op3_pii": op3_pii,
        "op4_toxicity": op4_toxicity,
        "op5_exact_dedup": op5_exact_dedup,
        "op6_packing": op6_packing,
        "op7_suffix_dedup": op7_suffix_dedup,
        "op8_decontaminate": op8_decontaminate,
        "op9_quality": op9_quality,
        "op10_language_id": op10_language_id,
        "op11_pieces": op11_pieces,
        "op12_lexical_search": op12_lexical_search,
        "op13_collocations": op13_collocations,
    }


def oracle_registry() -> dict[str, str]:
    return {"op5_exact_dedup": OP5_SQL, "op8_decontaminate": OP8_SQL, "op12_lexical_search": OP12_SQL, "op13_collocations": OP13_SQL}
