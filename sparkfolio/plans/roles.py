"""Roles that the star-schema tables play in the queries, and the register of queries with their oracles.

orders are parents (id, source, title, city, start_date, url, ...), lineitem
children, events the run log. A role's text is valid in both engines.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sparkfolio.session import TABLES, load_table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}

PARENTS = """SELECT o_orderkey AS id, o_orderpriority AS source,
 CASE WHEN o_orderkey % 97 = 0 THEN ' Menu ' WHEN o_orderkey % 101 = 0 THEN 'ab' WHEN o_orderkey % 103 = 0 THEN NULL WHEN o_orderkey % 107 = 0 THEN 'Panel talk' ELSE concat('Customer ', CAST(o_custkey % 500 AS string)) END AS title,
 CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderkey % 7 = 0 THEN '' ELSE concat('City ', CAST(o_custkey % 40 AS string)) END AS city,
 CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE concat('Gallery ', CAST(o_custkey % 12 AS string)) END AS location,
 CASE WHEN o_orderkey % 13 = 0 THEN NULL ELSE substr(CAST(o_orderdate AS string), 1, 10) END AS start_date,
 CASE WHEN o_orderkey % 17 = 0 THEN '' WHEN o_orderkey % 3 = 0 THEN substr(CAST(o_orderdate AS string), 1, 4) WHEN o_orderkey % 7 = 1 THEN '1990-01-01' ELSE concat(substr(CAST(o_orderdate AS string), 1, 4), '-12-31') END AS end_date,
 concat('https://example.org/exhibitions/', CAST(o_orderkey % 9000 AS string)) AS url,
 CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE lower(substr(o_orderpriority, 3)) END AS parser_key,
 CASE o_orderkey % 6 WHEN 0 THEN 'tate_modern' WHEN 1 THEN 'tate' WHEN 2 THEN 'venice_biennale' WHEN 3 THEN 'liverpool_biennial' WHEN 4 THEN 'moma' ELSE '' END AS site_key,
 CASE WHEN o_orderkey % 35 = 0 THEN NULL WHEN o_orderkey % 5 = 0 THEN '' ELSE concat('Order of status ', o_orderstatus, ' for ', o_orderpriority, CASE WHEN o_orderkey % 3 = 0 THEN ' with a longer closing remark' ELSE '' END) END AS concept,
 CASE WHEN o_orderkey % 4 = 1 THEN NULL WHEN o_orderkey % 4 = 2 THEN '' WHEN o_orderkey % 8 = 3 THEN 'A short preface' ELSE concat('A preface in two lines that is long enough', chr(10), 'to stand in for a concept of ', o_orderpriority) END AS preface,
 CASE WHEN o_orderkey % 3 = 0 THEN concat('English preface ', CAST(o_custkey % 90 AS string)) ELSE '  ' END AS preface_en, CAST(NULL AS string) AS concept_en,
 CASE WHEN o_orderkey % 4 = 0 THEN '[]' WHEN o_orderkey % 9 = 1 THEN 'Jane Doe' WHEN o_orderkey % 10 = 3 THEN NULL ELSE '["A","B"]' END AS curators,
 CASE WHEN o_orderkey % 8 = 5 THEN 'x[' WHEN o_orderkey % 8 = 6 THEN NULL ELSE '["t1"]' END AS tags,
 CASE o_orderkey % 3 WHEN 0 THEN NULL WHEN 1 THEN '[]' ELSE '["a.jpg"]' END AS images,
 CASE o_orderkey % 5 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE 'museum' END AS institution_type,
 CAST(CASE o_orderkey % 7 WHEN 0 THEN 9 WHEN 1 THEN 0 ELSE NULL END AS bigint) AS series_id FROM orders"""
CHILDREN = """SELECT l_orderkey * 100 + l_linenumber AS id, l_orderkey AS exhibition_id, l_linenumber AS line,
 CASE WHEN l_partkey % 53 = 0 THEN concat('https://x.org/', s_name) WHEN l_partkey % 59 = 0 THEN repeat(s_name, 12) WHEN l_partkey % 61 = 0 THEN 'Various Artists' WHEN l_partkey % 67 = 0 THEN ' ' ELSE s_name END AS artist_name,
 CASE WHEN l_partkey % 50 = 0 THEN '' WHEN l_partkey % 51 = 0 THEN lower(s_name) WHEN l_partkey % 52 = 0 THEN concat(s_name, ' ') ELSE p_name END AS work_title,
 CASE WHEN l_partkey % 9 = 0 THEN '' ELSE concat(p_type, ' ', l_returnflag) END AS medium
 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN part ON l_partkey = p_partkey"""
RUNS = """SELECT event_id AS id, concat(event_type, '-', CAST(user_id % 30 AS string)) AS parser_key, ts AS started_at,
 CAST(floor(value) AS bigint) AS urls_discovered, CASE WHEN event_id % 6 = 0 THEN CAST(0 AS bigint) ELSE CAST(floor(value / 2) AS bigint) END AS saved,
 CASE WHEN event_type = 'error' AND event_id % 2 = 0 THEN 'failed' ELSE '' END AS error_message,
 CASE WHEN event_id % 9 = 0 THEN 'dry_run' ELSE 'full' END AS run_type FROM events"""

_NAME = re.compile(r"\b(FROM|JOIN) (" + "|".join(TABLES) + r")\b")


def role(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    """A role's relation over the tables of ``sf_dir``."""
    return spark.sql(_NAME.sub(r"\1 {\2}", text), **{t: load_table(spark, sf_dir, t) for t in {m[1] for m in _NAME.findall(text)}})


def query(oracle: str | None = None, with_: dict[str, str] | None = None):
    """Register a function of (spark, sf_dir) under its name, with its oracle over named roles."""

    def add(f):
        QUERIES[f.__name__] = f
        if oracle:
            used = with_ or {k: v for k, v in {"parents": PARENTS, "children": CHILDREN, "runs": RUNS}.items() if re.search(rf"\b{k}\b", oracle)}
            ORACLE_SQL[f.__name__] = (f"WITH {', '.join(f'{k} AS ({v})' for k, v in used.items())} " if used else "") + oracle
        return f

    return add


def parents(s, d):
    return role(s, d, PARENTS)


def children(s, d):
    return role(s, d, CHILDREN)


def run_log(s, d):
    return role(s, d, RUNS)
