"""Inputs of the registered queries, derived from the driver tables by plain SQL.

Each text reads the same in Spark SQL and DuckDB; where an array has to be unnested the
two dialects have a text each.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

_GENE = "CAST(floor(floor({0} / 3) / 10) AS BIGINT)"
_SITE = "1 + {0} % 3"

SQL: dict[str, str | tuple[str, str]] = {
    "site_counts": """
        SELECT sample_id, cohort, chrom, context, pos, CAST(SUM(mc) AS BIGINT) AS mC, CAST(SUM(cov) - SUM(mc) AS BIGINT) AS uC
        FROM (
          SELECT CAST(l_suppkey AS STRING) AS sample_id,
                 CASE WHEN l_suppkey % 2 = 0 THEN 'control' ELSE 'disease' END AS cohort,
                 CAST(1 + l_partkey % 3 AS STRING) AS chrom,
                 CASE WHEN CAST(floor(l_partkey / 3) AS BIGINT) % 4 < 2 THEN 'CG'
                      WHEN CAST(floor(l_partkey / 3) AS BIGINT) % 4 = 2 THEN 'CHG' ELSE 'CHH' END AS context,
                 100 + 2 * CAST(floor(l_partkey / 3) AS BIGINT) AS pos,
                 CAST(l_quantity AS BIGINT) AS cov,
                 CAST(floor(CAST(l_quantity AS BIGINT) *
                   (CASE WHEN l_suppkey % 2 = 1 AND l_partkey % 5 = 0
                         THEN 5 + CAST(floor(CAST(round(l_discount * 100) AS BIGINT) / 2) AS BIGINT)
                         ELSE CAST(round(l_discount * 100) AS BIGINT) END) / 10) AS BIGINT) AS mc
          FROM lineitem) t
        GROUP BY sample_id, cohort, chrom, context, pos""",
    "genes": f"""
        SELECT DISTINCT CAST({_SITE.format('p_partkey')} AS STRING) AS chrom, {_GENE.format('p_partkey')} AS g,
               CAST(100 + 20 * {_GENE.format('p_partkey')} AS BIGINT) AS gene_start, CAST(120 + 20 * {_GENE.format('p_partkey')} AS BIGINT) AS gene_end,
               CASE WHEN {_GENE.format('p_partkey')} % 2 = 0 THEN '+' ELSE '-' END AS strand
        FROM part""",
    "regions": """
        SELECT chrom, concat(chrom, '-', CAST(g AS STRING)) AS gene_id, feature_type, CAST(s AS BIGINT) AS region_start, CAST(e AS BIGINT) AS region_end, strand FROM (
          SELECT chrom, g, strand, 'gene_body' AS feature_type, gene_start AS s, gene_end AS e FROM genes
          UNION ALL SELECT chrom, g, strand, 'exon', gene_start, gene_start + 6 FROM genes
          UNION ALL SELECT chrom, g, strand, 'exon', gene_end - 6, gene_end FROM genes
          UNION ALL SELECT chrom, g, strand, 'intron', gene_start + 6, gene_end - 6 FROM genes
          UNION ALL SELECT chrom, g, strand, 'promoter', CASE WHEN strand = '+' THEN gene_start - 10 ELSE gene_end END, CASE WHEN strand = '+' THEN gene_start ELSE gene_end + 10 END FROM genes
          UNION ALL SELECT chrom, g, strand, 'terminator', CASE WHEN strand = '+' THEN gene_end ELSE gene_start - 6 END, CASE WHEN strand = '+' THEN gene_end + 6 ELSE gene_start END FROM genes) x""",
    "sites": """
        SELECT DISTINCT CAST(1 + p_partkey % 3 AS STRING) AS chrom, 100 + 2 * CAST(floor(p_partkey / 3) AS BIGINT) AS pos FROM part""",
    "runs": """
        SELECT CAST(l_linenumber AS BIGINT) AS run_id, CAST(1 + l_partkey % 3 AS STRING) AS chrom, 100 + 2 * CAST(floor(l_partkey / 3) AS BIGINT) AS pos,
               l_discount * 10 AS effect_size, (1 + l_orderkey % 1000) / 1001.0E0 AS p_value, l_discount - 0.05E0 AS delta_mean, l_orderkey AS tie
        FROM lineitem""",
    "read_cpgs": (
        """SELECT CAST(label AS STRING) AS sample_id, vec_id AS read_id, CAST(i AS BIGINT) AS i, CAST(100 + 2 * i AS BIGINT) AS pos, CAST(CASE WHEN v > 0 THEN 1 ELSE 0 END AS BIGINT) AS meth
           FROM (SELECT label, vec_id, posexplode(embedding) AS (i, v) FROM embeddings) t""",
        """SELECT CAST(label AS STRING) AS sample_id, vec_id AS read_id, CAST(i - 1 AS BIGINT) AS i, CAST(98 + 2 * i AS BIGINT) AS pos, CAST(CASE WHEN embedding[i] > 0 THEN 1 ELSE 0 END AS BIGINT) AS meth
           FROM (SELECT label, vec_id, embedding, unnest(generate_series(1, len(embedding))) AS i FROM embeddings) t"""),
    "fragments": """
        SELECT CAST(user_id AS STRING) AS sample_id, CAST(1 + user_id % 3 AS STRING) AS chrom, event_id * 37 % 1000000 AS frag_start, CAST(floor(value) AS BIGINT) AS isize
        FROM events WHERE CAST(floor(value) AS BIGINT) BETWEEN 1 AND 2000""",
    "covariates": "SELECT CAST(s_suppkey AS STRING) AS sample_id, CAST(20 + s_nationkey AS DOUBLE) AS age, s_acctbal AS balance FROM supplier",
    "composition": """
        SELECT c_nationkey AS sample_id, c_mktsegment AS part, CAST(COUNT(*) AS DOUBLE) / SUM(COUNT(*)) OVER (PARTITION BY c_nationkey) AS share
        FROM customer GROUP BY c_nationkey, c_mktsegment""",
    "features": """
        SELECT CAST(l_suppkey AS STRING) AS sample_id, p_brand AS feature_id, SUM(l_quantity) AS value
        FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey, p_brand""",
    "gene_sets": f"""
        SELECT DISTINCT 'type' AS library, p_type AS term, concat(CAST({_SITE.format('p_partkey')} AS STRING), '-', CAST({_GENE.format('p_partkey')} AS STRING)) AS gene FROM part
        UNION ALL
        SELECT DISTINCT 'brand' AS library, p_brand AS term, concat(CAST({_SITE.format('p_partkey')} AS STRING), '-', CAST({_GENE.format('p_partkey')} AS STRING)) AS gene FROM part""",
    "order_genes": f"""
        SELECT DISTINCT l_orderkey AS k, concat(CAST({_SITE.format('l_partkey')} AS STRING), '-', CAST({_GENE.format('l_partkey')} AS STRING)) AS gene FROM lineitem""",
    "edges": """
        SELECT a.gene AS src, b.gene AS dst, COUNT(*) AS weight FROM order_genes a JOIN order_genes b ON a.k = b.k AND a.gene < b.gene GROUP BY a.gene, b.gene""",
    "stages": f"""
        SELECT CAST(y - MIN(y) OVER () AS BIGINT) AS stage_index, entity, score FROM (
          SELECT CAST(extract(year FROM l_shipdate) AS BIGINT) AS y, concat(CAST({_SITE.format('l_partkey')} AS STRING), '-', CAST({_GENE.format('l_partkey')} AS STRING)) AS entity,
                 SUM(CAST(round(l_extendedprice * 100) AS BIGINT)) / 100.0E0 AS score
          FROM lineitem GROUP BY 1, 2) x""",
    "predictions": """
        SELECT id, y_true, CASE WHEN p1 >= 0.5E0 THEN 1 ELSE 0 END AS y_pred, p1 FROM (
          SELECT o_orderkey AS id, CAST(o_custkey % 2 AS BIGINT) AS y_true, CAST(o_orderkey * 48271 % 1000 + 500 * (o_custkey % 2) AS DOUBLE) / 1500.0E0 AS p1 FROM orders) x""",
    "survival": """
        SELECT o_orderkey AS id, CAST(datediff('day', TIMESTAMP '1992-01-01 00:00:00', o_orderdate) AS BIGINT) AS time, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS event, o_totalprice AS risk FROM orders""",
    "qc_metrics": """
        SELECT CAST(l_suppkey AS STRING) AS sample_id, 'quantity' AS metric, AVG(l_quantity) AS value FROM lineitem GROUP BY l_suppkey
        UNION ALL SELECT CAST(l_suppkey AS STRING), 'discount', AVG(l_discount) FROM lineitem GROUP BY l_suppkey
        UNION ALL SELECT CAST(l_suppkey AS STRING), 'tax', AVG(l_tax) FROM lineitem GROUP BY l_suppkey
        UNION ALL SELECT CAST(l_suppkey AS STRING), 'price', AVG(l_extendedprice) FROM lineitem GROUP BY l_suppkey""",
    "cycles": """
        SELECT CAST(l_suppkey AS STRING) AS sample_id, CAST(1 + l_partkey % 100 AS BIGINT) AS cycle, AVG(l_quantity) AS quality FROM lineitem GROUP BY l_suppkey, 1 + l_partkey % 100""",
}


def _needs(text: str) -> list[str]:
    return [n for n in SQL if re.search(rf"\b{n}\b", text)]


def _chain(names: list[str], duck: bool) -> list[str]:
    """Fixtures in the order in which each can read the ones before it."""
    out: list[str] = []
    for n in names:
        text = SQL[n] if isinstance(SQL[n], str) else SQL[n][duck]
        for m in [*_chain([k for k in _needs(text) if k != n], duck), n]:
            if m not in out:
                out.append(m)
    return out


def duck(text: str, rounds: list[str]) -> str:
    """A DuckDB query over the base tables, with fixtures as common table expressions."""
    names = _chain(_needs(text), True)
    ctes = [f"{n} AS ({(SQL[n] if isinstance(SQL[n], str) else SQL[n][1]).strip()})" for n in names]
    body = text.strip()
    if ctes:
        head = next((h for h in ("WITH RECURSIVE ", "WITH ") if body.startswith(h)), "")
        body = f"{head}{', '.join(ctes)}, {body[len(head):]}" if head else f"WITH {', '.join(ctes)} {body}"
    if rounds:
        body = f"SELECT * REPLACE ({', '.join(f'round(CAST({c} AS DOUBLE) + 1e-10, 6) AS {c}' for c in rounds)}) FROM ({body})"
    return body


class Tables:
    """Base tables and fixtures of a folder as DataFrames, by name."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __getattr__(self, name: str) -> DataFrame:
        if name in BASE:
            return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        if name not in SQL:
            raise AttributeError(name)
        text = SQL[name] if isinstance(SQL[name], str) else SQL[name][0]
        text = re.sub(r"datediff\('day', (TIMESTAMP '[^']*'), (\w+)\)", r"datediff(\2, \1)", text)
        read = [n for n in [*BASE, *SQL] if n != name and re.search(rf"\b{n}\b", text)]
        for n in read:
            text = re.sub(rf"(FROM|JOIN) {n}\b", rf"\1 {{{n}}}", text)
        read = [n for n in read if f"{{{n}}}" in text]
        return self.spark.sql(text, **{n: getattr(self, n) for n in read})
