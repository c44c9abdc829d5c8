"""Queries of the corpus operators and, where SQL can express them on whole tables, their SQL."""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sluice.llm import leakage, lines, mainbody, mixture, spam
from sluice.session import shared_dir, table


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    """Each occurrence of a line that recurs excessively in its source."""
    pages = table(spark, folder, "unified_all_cms_content")
    gone = lines.repeated_lines(pages).gone
    # An id may stand in two sources: its numbers are united, a row each.
    return gone.groupBy("id").agg(F.array_distinct(F.flatten(F.collect_list("line_nos"))).alias("n")).select("id", F.explode("n").alias("line_no"))


def p1_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Which lines those are: source, an exact form, how many documents of the source have it."""
    pages = table(spark, folder, "unified_all_cms_content")
    repeated = lines.repeated_lines(pages)
    return repeated.counts.join(lines.example_lines(pages, repeated), ["source", "key"]).select("source", "line", "n_ids", "source_ids")


def p1_clean(spark: SparkSession, folder: str) -> DataFrame:
    """Each record's content without those lines."""
    pages = table(spark, folder, "unified_all_cms_content")
    return lines.without_repeated(pages, lines.repeated_lines(pages))


def _body_model(spark: SparkSession, folder: str) -> mainbody.Model:
    """The model of a folder's pages: fitted once, kept in the shared folder under the table's path, size and time of change, and the code's state."""
    name = "unified_all_cms_content"
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}.parquet")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    state = f"{path} {files.getContentSummary(path).getLength()} {files.getFileStatus(path).getModificationTime()} {mainbody.signature()}"
    kept = f"{shared_dir(spark)}/main-body-model-{hashlib.md5(state.encode()).hexdigest()}"
    done = spark._jvm.org.apache.hadoop.fs.Path(kept + "/_SUCCESS")
    if not done.getFileSystem(spark._jsc.hadoopConfiguration()).exists(done):
        mainbody.save(mainbody.fit(table(spark, folder, name)), spark, kept)
    return mainbody.load(spark, kept)


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    """The lines of each page that belong to its main body."""
    pages = table(spark, folder, "unified_all_cms_content")
    return mainbody.body_numbers(pages, model=_body_model(spark, folder))


def p5_texts(spark: SparkSession, folder: str) -> DataFrame:
    """The main body of each page as text."""
    pages = table(spark, folder, "unified_all_cms_content")
    return mainbody.body_texts(pages, model=_body_model(spark, folder))


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents with the test items that leaked into them."""
    found = leakage.leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))
    return found.select(F.col("document").alias("doc_id"), F.col("item").alias("item_id"))


def p6_items(spark: SparkSession, folder: str) -> DataFrame:
    """Which test items leaked, into how many documents, and how much of them at most."""
    found = leakage.leaks(table(spark, folder, "documents"), table(spark, folder, "eval_items"))
    return found.groupBy(F.col("item").alias("item_id")).agg(F.count("*").alias("n_documents"), F.max("windows").alias("most_windows"), F.max("containment").alias("most_containment"))


def p7_found(spark: SparkSession, folder: str) -> DataFrame:
    """Sources that stay below their share even at the cap."""
    _, report = mixture.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))
    return report.where("short").select("source")


def p7_mix(spark: SparkSession, folder: str) -> DataFrame:
    """The mix: each document of it and its copies."""
    mixed, _ = mixture.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))
    return mixed.select(F.col("document").alias("doc_id"), "source", "copies")


def p7_shares(spark: SparkSession, folder: str) -> DataFrame:
    """Target and actual share of each source."""
    return mixture.mix(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))[1]


def p8_found(spark: SparkSession, folder: str) -> DataFrame:
    """Documents made of keywords, links or product tags rather than sentences."""
    return spam.spam_measures(table(spark, folder, "documents"), spam_only=True).select(F.col("document").alias("doc_id"))


def p8_measures(spark: SparkSession, folder: str) -> DataFrame:
    """What that is decided by: characters of each document by kind."""
    return spam.spam_measures(table(spark, folder, "documents")).withColumnRenamed("document", "doc_id")


QUERIES = {
    "p1_found": p1_found,
    "p1_lines": p1_lines,
    "p1_clean": p1_clean,
    "p5_found": p5_found,
    "p5_texts": p5_texts,
    "p6_found": p6_found,
    "p6_items": p6_items,
    "p7_found": p7_found,
    "p7_mix": p7_mix,
    "p7_shares": p7_shares,
    "p8_found": p8_found,
    "p8_measures": p8_measures,
}
# DuckDB has no NFKC and no entity decoder: the SQL below is equal where letters need neither, as in the given tables.
_LINES = r"""WITH pages AS (SELECT id, source, CASE WHEN json_valid(attributes) THEN json_extract_string(attributes, '$.content') END AS content FROM unified_all_cms_content WHERE id IS NOT NULL),
split AS (SELECT id, source, unnest(string_split(content, chr(10))) AS line, generate_subscripts(string_split(content, chr(10)), 1) AS line_no FROM pages WHERE content IS NOT NULL),
keyed AS (SELECT *, regexp_replace(lower(nfc_normalize(line)), '[^\pL]', '', 'g') AS key FROM split),
sizes AS (SELECT source, count(DISTINCT id) AS source_ids FROM pages GROUP BY source),
counts AS (SELECT source, key, count(DISTINCT id) AS n_ids FROM keyed WHERE key <> '' GROUP BY source, key),
many AS (SELECT * FROM counts JOIN sizes USING (source) WHERE n_ids >= 5 AND n_ids * 20 >= source_ids)
"""

_ZERO = "".join(rf"\x{{{p:x}}}" for p in (0xAD, 0x200B, 0x200C, 0x200D, 0x2060, 0xFEFF))
_WORDS = (
    r"regexp_extract_all(lower(strip_accents(regexp_replace(regexp_replace(regexp_replace(coalesce(text, ''), '&(nbsp|ndash|ldquo|rdquo);', ' ', 'g'), '<[^<>]*>', ' ', 'g'), '["
    + _ZERO
    + r"]', '', 'g'))), '[\pL\pN]+')"
)
_LEAKS = f"""WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM eval_items),
sizes AS (SELECT DISTINCT least(10, len(w)) AS n FROM i WHERE len(w) > 0),
dw AS (SELECT doc_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(list_slice(w, k, k + n - 1), ' '))) AS v FROM d, sizes WHERE len(w) >= n),
iw AS (SELECT DISTINCT item_id, n, unnest(list_transform(range(1, len(w) - n + 2), lambda k: array_to_string(list_slice(w, k, k + n - 1), ' '))) AS v FROM i JOIN sizes ON n = least(10, len(w)))
"""

SQL: dict[str, str] = {
    "p1_clean": _LINES
    + """, gone AS (SELECT source, id, list(DISTINCT line_no) AS gone FROM keyed JOIN many USING (source, key) GROUP BY source, id),
parts AS (SELECT DISTINCT id, string_split(content, chr(10)) AS l, gone FROM pages LEFT JOIN gone USING (source, id)),
kept AS (SELECT id, l, list_filter(l, lambda x, i: NOT list_contains(coalesce(gone, []), i)) AS k FROM parts)
SELECT DISTINCT id, array_to_string(k, chr(10)) AS content, CAST(coalesce(len(l) - len(k), 0) AS INTEGER) AS n_removed FROM kept""",
    "p6_found": _LEAKS + "SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (n, v)",
    "p6_items": _LEAKS
    + """, found AS (SELECT doc_id, item_id, count(DISTINCT v) AS c FROM dw JOIN iw USING (n, v) GROUP BY doc_id, item_id), totals AS (SELECT item_id, count(DISTINCT v) AS total FROM iw GROUP BY item_id)
SELECT item_id, count(*) AS n_documents, max(c) AS most_windows, max(c / total) AS most_containment FROM found JOIN totals USING (item_id) GROUP BY item_id""",
    "p1_found": _LINES + "SELECT DISTINCT id, CAST(line_no AS INTEGER) AS line_no FROM keyed JOIN many USING (source, key)",
    "p1_lines": _LINES + "SELECT source, min(line) AS line, n_ids, source_ids FROM keyed JOIN many USING (source, key) GROUP BY source, key, n_ids, source_ids",
    # Any measure of size gives the same sources; here it is characters.
    "p7_found": """WITH sizes AS (SELECT source, sum(length(text)) AS size FROM documents GROUP BY source)
SELECT source FROM mix_targets LEFT JOIN sizes USING (source) WHERE target_share > 0 AND max_repeats * coalesce(size, 0) < target_share * (SELECT sum(size) FROM sizes)""",
}
