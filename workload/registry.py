"""Registered queries and the SQL that says what each must return."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL where one can be written."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql
        return fn

    return add


# --- shared SQL fragments -------------------------------------------------


def doc_ctes(target: str = "source") -> str:
    return f"""
    tok AS (SELECT CAST(doc_id AS VARCHAR) AS row_id, {target} AS target,
                   unnest(regexp_extract_all(lower(text), '[a-z]{{3,}}')) AS term FROM documents),
    cells AS (SELECT row_id, target, term, CAST(count(*) AS DOUBLE) AS value FROM tok GROUP BY ALL),
    rws AS (SELECT CAST(doc_id AS VARCHAR) AS row_id, {target} AS target FROM documents)"""


ORDERS = """
    cells AS (SELECT CAST(l_orderkey AS VARCHAR) AS row_id, o_orderpriority AS target, p_brand AS term,
                     sum(l_quantity) AS value
              FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey
              GROUP BY ALL HAVING sum(l_quantity) <> 0),
    rws AS (SELECT DISTINCT CAST(l_orderkey AS VARCHAR) AS row_id, o_orderpriority AS target
            FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

DOCS = doc_ctes()


def legacy_cut(name: str, src: str, value: str, percent: float, by: str = "") -> str:
    """CTEs ``{name}`` with the percentile by position p(n+1)/100 as ``cut``."""
    part = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    group = f"GROUP BY {by}" if by else ""
    return f"""
    {name}_r AS (SELECT {keys}{value} AS v, row_number() OVER ({part} ORDER BY {value}) AS rn,
                        count(*) OVER ({part}) AS n FROM {src}),
    {name}_p AS (SELECT *, CAST({percent} AS DOUBLE) * (n + 1) / CAST(100 AS DOUBLE) AS pos FROM {name}_r),
    {name}_q AS (SELECT {keys}max(CASE WHEN rn = greatest(1, least(n, floor(pos))) THEN v END) AS a,
                        max(CASE WHEN rn = greatest(1, least(n, floor(pos) + 1)) THEN v END) AS b,
                        max(CASE WHEN pos < 1 OR pos >= n THEN 0 ELSE pos - floor(pos) END) AS f
                 FROM {name}_p {group}),
    {name} AS (SELECT {keys}a + f * (b - a) AS cut FROM {name}_q)"""


def median_cut(name: str, src: str, value: str, by: str = "") -> str:
    """CTEs ``{name}`` with the element at n div 2 (from 0) as ``cut``."""
    part = f"PARTITION BY {by}" if by else ""
    keys = f"{by}, " if by else ""
    return f"""
    {name}_r AS (SELECT {keys}{value} AS v, row_number() OVER ({part} ORDER BY {value}) AS rn,
                        count(*) OVER ({part}) AS n FROM {src}),
    {name} AS (SELECT {keys}v AS cut FROM {name}_r WHERE rn = n // 2 + 1)"""


HASHES = """
    bodies AS (SELECT row_id, string_agg(term || ':' || CAST(CAST(value AS DECIMAL(18,6)) AS VARCHAR), ' ' ORDER BY term)
                      AS body FROM cells GROUP BY row_id),
    hashes AS (SELECT r.row_id, r.target, md5(r.target || '|' || coalesce(b.body, '')) AS row_hash
               FROM rws r LEFT JOIN bodies b ON r.row_id = b.row_id)"""

CELLS_OUT = "row_id, target, term, round(value, 6) AS value"
