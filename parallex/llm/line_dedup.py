"""Cross-site boilerplate lines by distinct-site spread.

One HyperLogLog sketch of the sites per line hash, built in every task and
merged by the aggregation. Lines whose estimate is clearly below ``min_sites``
stay, lines clearly above go, and only the lines within three standard errors
(one site at least) of the threshold get an exact distinct count of their sites.
A line is removed wherever it occurs.

A line is a ``\\n``-separated part of the text, compared without white space at
its ends; blank lines are never boilerplate. NULL texts have no lines. A NULL
site is one site of its own. Repeated rows add no site. An empty table gives an
empty result. Texts of any number of lines are handled whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parallex.llm.common import at, documents, numbered, text_key, without
from parallex.session import pin

MIN_SITES = 8
LG_K = 12
_ERROR = 3 * 1.04 / (1 << LG_K) ** 0.5
_BLANK = " \t\r\x0b\x0c"


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n")


def _bare(line: Column) -> Column:
    return F.btrim(line, F.lit(_BLANK))


def _exploded(docs: DataFrame, site: str, text: str) -> DataFrame:
    """``(key, site, pos, line)``: one row per non-blank line; ``line`` is a digest."""
    return (docs.select(text_key(F.col(text)).alias("key"),
                        F.coalesce(F.concat(F.lit("="), F.col(site).cast("string")), F.lit("")).alias("site"),
                        F.posexplode(F.transform(_lines(F.col(text)), _bare)).alias("pos", "line"))
            .where("line <> ''").withColumn("line", F.unhex(F.md5("line"))))


def boilerplate(docs: DataFrame, site: str = "source", text: str = "text", min_sites: int = MIN_SITES) -> DataFrame:
    """``(line,)``: digests of the lines on at least ``min_sites`` distinct sites."""
    lines = _exploded(docs, site, text)
    slack = max(1.0, min_sites * _ERROR)
    spread = pin(lines.groupBy("line").agg(F.hll_sketch_estimate(F.hll_sketch_agg("site", LG_K)).alias("sites"))
                 .where(F.col("sites") >= min_sites - slack))
    near = spread.where(F.col("sites") <= min_sites + slack).select("line")
    exact = (lines.select("line", "site").join(near, "line", "left_semi").distinct()
             .groupBy("line").count().where(F.col("count") >= min_sites).select("line"))
    return spread.where(F.col("sites") > min_sites + slack).select("line").unionByName(exact)


def remove_boilerplate(docs: DataFrame, site: str = "source", text: str = "text",
                       min_sites: int = MIN_SITES) -> DataFrame:
    """``docs`` with the boilerplate lines cut out of ``text``, plus ``n_lines``
    (non-blank lines before) and ``n_removed``. Columns with these names are
    replaced; a NULL text stays NULL."""
    rows, site, column = numbered(docs), at(docs, site), at(docs, text)
    found = pin(boilerplate(rows, site, column, min_sites))
    hits = (_exploded(rows, site, column).select("key", "pos", "line").join(found, "line")
            .groupBy("key").agg(F.collect_set("pos").alias("gone")))
    joined = rows.withColumn("key", text_key(F.col(column))).join(hits, "key", "left").withColumn("lines", _lines(F.col(column)))
    # positions that stay, by set difference: linear in the number of lines
    stay = F.array_sort(F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), F.col("gone")))
    cleaned = F.when(F.col("gone").isNull(), F.col(column)).otherwise(
        F.array_join(F.transform(stay, lambda i: F.get(F.col("lines"), i)), "\n"))
    return joined.select(
        *[(cleaned if c == text else F.col(at(docs, c))).alias(c) for c in without(docs, ["n_lines", "n_removed"])],
        F.size(F.filter("lines", lambda x: _bare(x) != "")).cast("long").alias("n_lines"),
        F.coalesce(F.size("gone"), F.lit(0)).cast("long").alias("n_removed"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = remove_boilerplate(documents(spark, sf_dir).select("doc_id", "source", "text"))
    return out.select("doc_id", "n_lines", "n_removed",
                      F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce('=' || source, '') AS site,
                  string_split(coalesce(text, ''), chr(10)) AS ls FROM documents),
l AS (SELECT r, site, unnest(range(1, len(ls) + 1)) AS pos, unnest(ls) AS raw FROM d),
b AS (SELECT *, trim(raw, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line FROM l),
g AS (SELECT line FROM b WHERE line <> '' GROUP BY line HAVING count(DISTINCT site) >= 8),
m AS (SELECT b.*, g.line IS NOT NULL AS gone FROM b LEFT JOIN g USING (line))
SELECT doc_id, count(*) FILTER (line <> '') AS n_lines, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(raw, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m JOIN d USING (r) GROUP BY r, doc_id
"""
