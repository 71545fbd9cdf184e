"""The registered queries of this package: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from caseload.llm.decontaminate import contamination
from caseload.llm.exact_dedup import exact_duplicates
from caseload.llm.html_text import extract_text
from caseload.llm.language_id import held_out_fold, identify_languages
from caseload.llm.line_dedup import line_report
from caseload.llm.lm_score import score_documents
from caseload.llm.packing import pack_documents
from caseload.llm.periodic_runs import periodic_runs
from caseload.llm.simhash import near_duplicates
from caseload.llm.spelling import spelling_variants
from caseload.llm.storage import shared_folder
from caseload.llm.token_counts import count_tokens
from caseload.llm.token_files import token_file_digests, write_token_files
from caseload.llm.toxicity import toxicity_scores

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(_table(spark, sf_dir, "documents"))


def packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = identify_languages(docs, learn_from=~held_out_fold())
    return found.select("doc_id", held_out_fold().alias("held_out"), "lang_pred", "score")


def lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(_table(spark, sf_dir, "documents"))


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        "contaminated", "n_near")


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(_table(spark, sf_dir, "documents"), keep="largest")


def token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_folder(spark, "token-files")
    write_token_files(_table(spark, sf_dir, "documents"), folder, public_tokenizers.path("byte_bpe_50k.json"))
    return token_file_digests(spark, folder)


def line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_report(_table(spark, sf_dir, "documents"))


def token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = count_tokens(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"),
                          cache=shared_folder(spark, "token-counts"))
    return counts.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > 512).alias("over_limit"))


def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(_table(spark, sf_dir, "pages"))


def toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = toxicity_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), learn_from=~held_out_fold())
    return found.select("doc_id", held_out_fold().alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


#: The words of a text; of every tenth document by the hash h of its id, a tail made periodic by g = floor(h / 10): word i from
#: a = g % n on is the original word a + (i - a) % p.
REPEATED_TAIL = """CASE WHEN crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 10 = 0 THEN
 transform(array(named_struct('ws', filter(split(text, r'[\\x20\\x09-\\x0D]+'), w -> w <> ''),
  'g', crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) DIV 10)), d -> CASE WHEN size(d.ws) = 0 THEN '' ELSE
 transform(array(named_struct('ws', d.ws, 'a', CAST(d.g % size(d.ws) AS INT),
  'p', CAST(1 + (size(d.ws) - d.g % size(d.ws)) DIV (3 + d.g % 8) AS INT))), t ->
 array_join(transform(sequence(0, size(t.ws) - 1), i -> CASE WHEN i < t.a THEN t.ws[i] ELSE t.ws[t.a + (i - t.a) % t.p] END), ' '))[0]
 END)[0] ELSE text END"""


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", F.expr(REPEATED_TAIL).alias("text"))
    # The longest run; of equally long ones the first, then that of the smallest period.
    best = F.array_max(F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    listed = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    found = periodic_runs(docs).withColumns({"best": best, "listed": F.array_join(listed, "")})
    return found.select("doc_id", F.size("runs").cast("long").alias("n_runs"), (-F.col("best.start")).alias("start"), "best.length",
                        (-F.col("best.period")).alias("period"), F.expr("1000 * best.length DIV -best.period").alias("exponent_milli"),
                        F.sha2("listed", 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))


def _letter_dropped(doc_id: Column, word: Column) -> Column:
    """The word without one letter where the hash of `id:word` is divisible by 199."""
    h = F.crc32(F.concat(doc_id.cast("string"), F.lit(":"), word).cast("binary"))
    place = (h % F.length(word)).cast("int")
    return F.when(h % 199 == 0, F.concat(word.substr(F.lit(1), place), word.substr(place + 2, F.length(word)))).otherwise(word)


def spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = spelling_variants(_table(spark, sf_dir, "documents"), rewrite=_letter_dropped)
    return found.select("word", "form", "root", "n", "n_near", "form_n")


def queries() -> dict[str, Query]:
    return {
        "op1_simhash": simhash,
        "op2_packing": packing,
        "op3_language_id": language_id,
        "op4_lm_score": lm_score,
        "op5_decontamination": decontamination,
        "op6_exact_dedup": exact_dedup,
        "op7_token_files": token_files,
        "op8_line_dedup": line_dedup,
        "op9_token_counts": token_counts,
        "op10_html_text": html_text,
        "op11_toxicity": toxicity,
        "op12_periodic_runs": runs,
        "op13_spelling_variants": spelling,
        "pipeline": corpus_pipeline.run,
    }


EXACT_DEDUP_SQL = """SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
 doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))"""

DECONTAMINATION_SQL = """WITH w AS (
 SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS ws FROM benchmark WHERE text IS NOT NULL),
p AS (SELECT DISTINCT item_id, n, array_to_string(ws[i:i+n-1], ' ') AS phrase
 FROM (SELECT item_id, ws, least(10, len(ws)) AS n, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
g AS (SELECT doc_id, n, i, array_to_string(ws[i:i+n-1], ' ') AS phrase
 FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM w, sizes WHERE len(ws) >= n)),
m AS (SELECT g.doc_id, g.n, g.i, p.item_id FROM g JOIN p ON p.phrase = g.phrase AND p.n = g.n),
h AS (SELECT doc_id, count(DISTINCT j) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS j FROM m) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(k, ',' ORDER BY k) AS items
 FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS k FROM m) GROUP BY doc_id),
tk AS (SELECT doc_id, i AS pos, ws[i] AS term FROM (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
f AS (SELECT term, count(*) AS f FROM tk GROUP BY term),
pt AS (SELECT phrase, n, k, string_split(phrase, ' ')[k + 1] AS term
 FROM (SELECT phrase, n, unnest(range(0, n)) AS k FROM (SELECT DISTINCT phrase, n FROM p))),
ra AS (SELECT * FROM pt LEFT JOIN f USING (term) QUALIFY row_number() OVER (PARTITION BY phrase ORDER BY coalesce(f, 0), k) = 1),
c AS (SELECT doc_id, phrase, n, pos - k AS start FROM tk JOIN ra USING (term)),
cl AS (SELECT c.doc_id, c.phrase FROM c JOIN pt ON pt.phrase = c.phrase JOIN tk ON tk.doc_id = c.doc_id AND tk.term = pt.term
  AND tk.pos BETWEEN c.start + pt.k - 3 AND c.start + pt.k + 3
 GROUP BY c.doc_id, c.phrase, c.start, c.n HAVING count(DISTINCT pt.k) = c.n),
nr AS (SELECT doc_id, count(*) AS n_near FROM (SELECT cl.doc_id, item_id FROM cl JOIN p USING (phrase)
 EXCEPT SELECT doc_id, item_id FROM m) GROUP BY doc_id)
SELECT w.doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
 sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated, coalesce(n_near, 0) AS n_near
FROM w LEFT JOIN h USING (doc_id) LEFT JOIN it USING (doc_id) LEFT JOIN nr USING (doc_id)"""


def oracle_sql() -> dict[str, str]:
    return {"op6_exact_dedup": EXACT_DEDUP_SQL, "op5_decontamination": DECONTAMINATION_SQL}
