"""How a plans module lists its queries, and SQL fragments that several checks share."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# the space characters of lexloom.functions.text.SPACE_CHARS as an RE2 class
SPACE = (
    r"\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
EDGE_SPACE = f"^[{SPACE}]+|[{SPACE}]+$"

Query = Callable[[SparkSession, str], DataFrame]


class Registry:
    """Collects the queries of one module and their SQL twins."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, sql: str | None = None, name: str | None = None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            title = name or query.__name__
            self.queries[title] = query
            if sql is not None:
                self.oracles[title] = sql
            return query

        return register


def words(expr: str) -> str:
    """SQL list of the whitespace tokens of ``expr``."""
    return f"regexp_extract_all({expr}, '([^{SPACE}]+)', 1)"


def bucket(expr: str, dims: int = 64) -> str:
    return f"(('0x' || substr(md5({expr}), 1, 8))::BIGINT % {dims})"


REVIEWS = """reviews AS (
  SELECT d.doc_id, d.text, l.quality AS label,
         CASE WHEN d.doc_id % 10 < 8 THEN 'train' WHEN d.doc_id % 10 = 8 THEN 'validation'
              ELSE 'test' END AS split
  FROM documents d JOIN labels l USING (doc_id))"""

PLAYLISTS = """playlists AS (
  SELECT l_orderkey AS seq_id,
         row_number() OVER (PARTITION BY l_orderkey
                            ORDER BY l_shipdate, l_linenumber, l_partkey) - 1 AS pos,
         CAST(l_partkey AS VARCHAR) AS item,
         count(*) OVER (PARTITION BY l_orderkey) AS n_items
  FROM lineitem)"""

REPLIES = r"""replies AS (
  SELECT doc_id,
         CASE WHEN doc_id % 8 = 7 THEN 500 ELSE 200 END AS status,
         CASE WHEN doc_id % 8 < 2 THEN '{"response": "' || quality || '"}'
              WHEN doc_id % 8 = 2 THEN '{"response": "' || quality || '\n"}'
              WHEN doc_id % 8 = 3 THEN '{"response": "<think>weighing\nboth sides</think>\n' || quality || '"}'
              WHEN doc_id % 8 = 4 THEN '{"response": "<think>still weighing"}'
              WHEN doc_id % 8 = 5 THEN '{"response": "The review is positive"}'
              WHEN doc_id % 8 = 6 THEN '{"done": true}'
              ELSE 'server error' END AS body
  FROM labels),
reply_text AS (
  SELECT doc_id, status,
         CASE WHEN status <> 200 THEN 'http_error' WHEN NOT json_valid(body) THEN 'bad_json'
              ELSE 'ok' END AS state,
         CASE WHEN status = 200 AND json_valid(body)
              THEN trim(coalesce(json_extract_string(body, '$.response'), ''), E' \t\n\r') END AS reply
  FROM replies)"""

SCORES = """scored AS (
  SELECT vec_id AS key, label % 2 AS truth,
         [embedding[1]::DOUBLE, embedding[2]::DOUBLE, embedding[3]::DOUBLE] AS s
  FROM embeddings)"""

# hashed counts of every text in a relation texts(key, text), scaled to length one
HASHED = f"""hashed AS (
  SELECT key, b, n / sqrt(sum(n * n) OVER (PARTITION BY key)) AS x
  FROM (SELECT key, b, count(*)::DOUBLE AS n
        FROM (SELECT key, {bucket('w')} AS b
              FROM (SELECT key, unnest({words('lower(text)')}) AS w FROM texts))
        GROUP BY key, b))"""
