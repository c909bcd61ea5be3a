"""Driver queries of the operators: thin, one per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from strata.llm.columnar_search import top_k
from strata.llm.common import read_table
from strata.llm.context_mixing import score_texts
from strata.llm.decontaminate import contamination
from strata.llm.fill_middle import fill_in_middle
from strata.llm.html_text import extract
from strata.llm.line_dedup import dedup_lines
from strata.llm.multi_index import nearest
from strata.llm.ngram_join import ngram_components
from strata.llm.quality import score_quality
from strata.llm.sentencepiece import encode
from strata.llm.substring_dedup import remove_repeats
from strata.llm.toxicity import score_toxicity
from strata.llm.whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op2_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_toxicity(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op4_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(read_table(spark, sf_dir, "documents"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_lines(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_lines", "n_removed", F.sha2("text", 256).alias("kept_sha256"), F.length("text").alias("n_chars"))


def op6_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_texts(read_table(spark, sf_dir, "documents"))


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_components(read_table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_quality(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "labels"))


def op9_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract(read_table(spark, sf_dir, "pages"))


def op10_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def op11_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(read_table(spark, sf_dir, "embeddings"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle(read_table(spark, sf_dir, "documents"))


def op13_columnar_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)


def _importable(query: Query) -> Query:
    """Python workers on this machine find the package where the driver found it, whatever their folder."""
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(corpus_pipeline.__file__).resolve().parent))
        return query(spark, sf_dir)
    return run


def registry() -> dict[str, Query]:
    return {name: _importable(query) for name, query in {
        "op1_substring_dedup": op1_substring_dedup,
        "op2_multi_index": op2_multi_index,
        "op3_toxicity": op3_toxicity,
        "op4_sentencepiece": op4_sentencepiece,
        "op5_line_dedup": op5_line_dedup,
        "op6_context_mixing": op6_context_mixing,
        "op7_ngram_join": op7_ngram_join,
        "op8_quality": op8_quality,
        "op9_html_text": op9_html_text,
        "op10_decontaminate": op10_decontaminate,
        "op11_whitening": op11_whitening,
        "op12_fill_middle": op12_fill_middle,
        "op13_columnar_search": op13_columnar_search,
        "pipeline": corpus_pipeline.run,
    }.items()}


_WORDS = "list_filter(regexp_split_to_array(coalesce(text, ''), '[ \\t\\n\\x0B\\f\\r]+'), lambda x: x <> '')"

#: Windows by their word sequence, with the smallest document that one starts in.
_OP1 = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
p AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS s FROM d WHERE len(w) >= 50),
x AS (SELECT doc_id, s, array_to_string(w[s:s + 49], ' ') AS k FROM p),
f AS (SELECT k, min(doc_id) AS least FROM x GROUP BY k),
g AS (SELECT DISTINCT doc_id, unnest(range(s, s + 50)) AS i FROM x JOIN f USING (k) WHERE least < doc_id),
gone AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id),
j AS (SELECT doc_id, w, coalesce(gone, []) AS gone FROM d LEFT JOIN gone USING (doc_id))
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(gone) AS BIGINT) AS n_removed,
  sha256(array_to_string([w[i] FOR i IN range(1, len(w) + 1) IF NOT list_contains(gone, i)], ' ')) AS kept_sha256
FROM j
"""

#: Links over all shared shingles, then the smallest document reachable.
_OP7 = f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} AS w
  FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS k
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 3, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.k = b.k AND a.doc_id <> b.doc_id
      GROUP BY a.doc_id, b.doc_id),
l AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 80 * (a.n + b.n - c)),
r AS (SELECT doc_id AS x, doc_id AS y FROM d UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
m AS (SELECT x, min(y) AS component_id FROM r GROUP BY x)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, m.component_id
FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.x = d.doc_id
"""

_OP10_WORDS = ("regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', "
               "'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')")

_OP10 = f"""
WITH b AS (SELECT item_id, {_OP10_WORDS} AS w FROM benchmark),
v AS (SELECT item_id, w, least(13, len(w)) AS n, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s
      FROM b WHERE len(w) > 0),
win AS (SELECT DISTINCT item_id, n, array_to_string(w[s:s + n - 1], ' ') AS k FROM v),
d AS (SELECT doc_id, {_OP10_WORDS} AS w FROM documents),
sizes AS (SELECT DISTINCT n FROM win),
p AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n),
x AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS k FROM p),
m AS (SELECT x.doc_id, x.n, x.s, win.item_id FROM x JOIN win ON x.n = win.n AND x.k = win.k),
h AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS i FROM m) GROUP BY doc_id),
i AS (SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items FROM m GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(len(items), 0) AS BIGINT) AS n_items, sha256(array_to_string(coalesce(items, []), ',')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN i USING (doc_id)
"""

_OP12 = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
  sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
u AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS x, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS y,
  CAST('0x' || substr(h, 17, 8) AS BIGINT) % 100 AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) % 100 AS h4 FROM d),
c AS (SELECT *, least(x, y) AS a, greatest(x, y) AS b, CASE
  WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 >= 90 THEN 'plain'
  WHEN h4 < 20 THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT *, substr(t, 1, a) AS one, substr(t, a + 1, b - a) AS two, substr(t, b + 1) AS three FROM c)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CAST(CASE WHEN form <> 'plain' THEN a END AS BIGINT) AS prefix_chars,
  CAST(CASE WHEN form <> 'plain' THEN b - a END AS BIGINT) AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || one || '<S>' || three || '<M>' || two
    ELSE '<S>' || three || '<P>' || one || '<M>' || two END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""

_OP13 = """
WITH v AS (SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda c: floor(64 * CAST(c AS DOUBLE))) AS x
  FROM embeddings WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
  AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, c.r AS cr, CAST(list_inner_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.r <> c.r),
k AS (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id, cr) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM k WHERE rank <= 20
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL where it can express a query and run it over whole tables."""
    return {"op1_substring_dedup": _OP1, "op7_ngram_join": _OP7, "op10_decontaminate": _OP10,
            "op12_fill_middle": _OP12, "op13_columnar_search": _OP13}
