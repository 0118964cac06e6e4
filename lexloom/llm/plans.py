"""The registered queries of the subpackage, each beside its SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.llm.chunking import remove_chunks
from lexloom.llm.decontaminate import find_leaks
from lexloom.llm.hmm import hmm_scores
from lexloom.llm.licences import licences
from lexloom.llm.lines import line_report
from lexloom.llm.minhash import Sketch, near_duplicates
from lexloom.llm.mixing import mix_sources
from lexloom.llm.perplexity import quality_rules
from lexloom.llm.pu import pu_scores
from lexloom.llm.runs import periodic_runs
from lexloom.llm.secrets import find_secrets, spans_text
from lexloom.llm.suffix_dedup import remove_repeats
from lexloom.llm.trie import prefix_trie, rebuilt_conversations
from lexloom.plans.registry import Registry
from lexloom.sources.tables import read_table

_R = Registry()
QUERIES, ORACLES = _R.queries, _R.oracles

WORD = r"[^\x20\x09-\x0D]+"


@_R.add(
    rf"""WITH RECURSIVE low AS (
      SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
               'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
    sets AS (
      SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) = 1 THEN [w[1]]
               ELSE list_distinct(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) END AS s FROM low),
    one AS (SELECT min(doc_id) AS rep, any_value(s) AS s FROM sets WHERE len(s) > 0 GROUP BY list_sort(s)),
    items AS (SELECT rep, unnest(s) AS x, len(s) AS n FROM one),
    ranked AS (SELECT rep, x, n, row_number() OVER (PARTITION BY rep ORDER BY f, x) AS p
               FROM items JOIN (SELECT x, count(*) AS f FROM items GROUP BY x) USING (x)),
    probe AS (SELECT rep, x, n FROM ranked WHERE p <= n - (80 * n + 99) // 100 + 1),
    candidates AS (SELECT DISTINCT a.rep AS a, b.rep AS b FROM probe a JOIN probe b
                   ON a.x = b.x AND a.rep < b.rep AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
    links AS (SELECT a, b FROM (SELECT c.a, c.b, len(p.s) AS m, len(q.s) AS n, len(list_intersect(p.s, q.s)) AS i
                FROM candidates c JOIN one p ON p.rep = c.a JOIN one q ON q.rep = c.b) WHERE 100 * i >= 80 * (m + n - i)),
    ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
    reach(node, seen) AS (SELECT rep, rep FROM one UNION SELECT r.node, e.b FROM reach r JOIN ways e ON e.a = r.seen),
    comp AS (SELECT node, min(seen) AS component FROM reach GROUP BY node)
    SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(c.component, s.doc_id) AS component_id,
           s.doc_id = coalesce(c.component, s.doc_id) AS kept
    FROM sets s LEFT JOIN one o ON list_sort(o.s) = list_sort(s.s) AND len(s.s) > 0 LEFT JOIN comp c ON c.node = o.rep"""
)
def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents over two-word shingles."""
    return near_duplicates(read_table(spark, sf_dir, "documents"), Sketch(shingle=2))


@_R.add(
    """WITH bytes AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
    windows AS (SELECT doc_id, p, substring(h, 2 * p + 1, 100) AS s
                FROM (SELECT doc_id, h, unnest(range(length(h) // 2 - 49)) AS p FROM bytes WHERE length(h) >= 100)),
    firsts AS (SELECT hash(s) AS k, md5(s) AS m, min(doc_id) AS f, max(doc_id) AS l FROM windows GROUP BY k, m),
    bad AS (SELECT w.doc_id, w.p FROM windows w JOIN firsts x ON x.k = hash(w.s) AND x.m = md5(w.s) WHERE x.f < w.doc_id),
    steps AS (SELECT doc_id, p, p - coalesce(lag(p) OVER (PARTITION BY doc_id ORDER BY p), -1000) > 50 AS fresh FROM bad),
    runs AS (SELECT doc_id, p, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY p) AS r FROM steps),
    spans AS (SELECT doc_id, r, min(p) AS a, max(p) + 50 AS b FROM runs GROUP BY doc_id, r),
    gaps AS (SELECT doc_id, r, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM spans),
    cut AS (SELECT g.doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
                   string_agg(substring(h, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS head
            FROM gaps g JOIN bytes USING (doc_id) GROUP BY g.doc_id)
    SELECT doc_id, (length(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed,
           coalesce(n_spans, 0)::BIGINT AS n_spans,
           sha256(unhex(coalesce(head || substring(h, 2 * last + 1), h))) AS kept_sha256
    FROM bytes LEFT JOIN cut USING (doc_id)"""
)
def op6_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without its 50-byte strings that earlier documents have."""
    return remove_repeats(read_table(spark, sf_dir, "documents")).drop("kept_bytes")


@_R.add()
def op9_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of every text without the content-defined chunks that stand earlier."""
    return remove_chunks(read_table(spark, sf_dir, "documents")).drop("kept_bytes")


@_R.add()
def op2_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text statistics and the verdict of the language's perplexity band, for all documents."""
    return quality_rules(read_table(spark, sf_dir, "documents"))


def fold(modulus: int, of: str = "doc_id") -> Column:
    """crc32 of the id as text, by the modulus."""
    return F.pmod(F.crc32(F.col(of).cast("string").cast("binary")), F.lit(modulus))


@_R.add()
def op10_hmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hidden Markov and smoothed unigram scores of all documents; a seventh of them is held out."""
    docs = read_table(spark, sf_dir, "documents")
    return hmm_scores(docs.withColumn("held_out", fold(7) == 2))


@_R.add()
def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents that have a passage of a benchmark item, up to one edit in 16 bytes, and the items."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, read_table(spark, sf_dir, "benchmark"))
    return found.where("size(item_ids) > 0").select("doc_id", F.lit(True).alias("contaminated"), "item_ids")


@_R.add()
def op7_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each document that stand, exactly or nearly, in an earlier one, and where they stand first."""
    return line_report(read_table(spark, sf_dir, "documents"))


@_R.add()
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix of all documents takes from each, sources weighing 5, 2, 1 in turn."""
    return mix_sources(read_table(spark, sf_dir, "documents")).drop("tag")


@_R.add()
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality scores of all documents, learned from positives of two thirds of the ids and all texts."""
    labels = read_table(spark, sf_dir, "labels").where(fold(3) != 1).select("doc_id", "quality")
    held_out = F.coalesce(fold(3) == 1, F.lit(False)).alias("held_out")
    return pu_scores(read_table(spark, sf_dir, "documents"), labels).select("doc_id", held_out, "score", "predicted")


@_R.add()
def op3_licences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licence of every document, its own or that of the nearest directory; a document's path is source/lang/id."""
    docs = read_table(spark, sf_dir, "documents")
    path = F.concat(F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.col("doc_id").cast("string")), F.lit(".txt"))
    return licences(docs.select("doc_id", path.alias("path"), "text"))


#: DuckDB has no crc32: the table of its polynomial by rule, and a decimal number's checksum as a macro of its digits.
CRC_TABLE = """crc_table AS (
      SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b, range(8)),
               lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t)"""


def crc_sql(number: str) -> str:
    """crc32 of ``number`` in decimal; ``t`` of ``crc_table`` must be in reach."""
    digits = f"list_transform(string_split({number}::VARCHAR, ''), lambda d: ascii(d)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {digits}), lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1])), 4294967295)"


def checksum(of: str) -> Column:
    """crc32 of a number in decimal."""
    return F.crc32(F.col(of).cast("string").cast("binary"))


def planted_repeats(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)``; a tenth of the texts get a stretch that repeats to the end, as the id's checksum says."""
    h = checksum("doc_id")
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"), F.lit(1)))
    drawn = docs.select("doc_id", "text", words.alias("words"), F.floor(h / 10).alias("g"))
    n = F.size("words")
    drawn = drawn.withColumn("a", F.when(n > 0, (F.col("g") % n).cast("int")))
    p = F.lit(1) + F.floor((n - F.col("a")) / (F.lit(3) + F.col("g") % 8)).cast("int")
    drawn = drawn.withColumn("p", p)
    copies = F.ceil((n - F.col("a")) / F.col("p")).cast("int")
    repeated = F.flatten(F.array_repeat(F.slice("words", F.col("a") + 1, F.col("p")), copies))
    planted = F.concat(F.slice("words", F.lit(1), F.col("a")), F.slice(repeated, F.lit(1), n - F.col("a")))
    return drawn.select("doc_id", F.when(n > 0, F.concat_ws(" ", planted)).otherwise(F.col("text")).alias("text"))


def _runs_sql(levels: int = 15) -> str:
    """Names of 1, 2, 4 ... words by doubling; the next place of a name of ``w`` words tells periods in ``(w / 2, w]``."""
    names = ["g0 AS (SELECT rid, n, i, hash(w) AS g FROM words)"]
    names += [
        f"g{k} AS (SELECT rid, n, i, hash(g, lead(g, {1 << k - 1}) OVER (PARTITION BY rid ORDER BY i)) AS g FROM g{k - 1} WHERE n >= {1 << k})"
        for k in range(1, levels)
    ]
    seeds = " UNION ALL ".join(
        f"SELECT rid, i, {1 << k} AS w, lead(i) OVER (PARTITION BY rid, g ORDER BY i) - i AS q FROM g{k} WHERE i + {1 << k} <= n" for k in range(levels)
    )
    return ",\n    ".join([*names, f"seeds AS (SELECT * FROM ({seeds}) WHERE q <= w AND 2 * q > w)"])


@_R.add(
    rf"""WITH {CRC_TABLE},
    given AS (SELECT row_number() OVER () AS rid, doc_id, {crc_sql("doc_id")} AS h,
                     regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents, crc_table),
    drawn AS (SELECT rid, doc_id, h, w, len(w) AS n, CASE WHEN len(w) > 0 AND h % 10 = 0 THEN (h // 10) % len(w) END AS a FROM given),
    texts AS (SELECT rid, doc_id, n, CASE WHEN a IS NULL THEN w
                ELSE w[1:a] || list_transform(range(a, n), lambda i: w[a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) + 1]) END AS w FROM drawn),
    words AS (SELECT rid, n, unnest(range(n)) AS i, unnest(w) AS w FROM texts),
    {_runs_sql()},
    islands AS (SELECT rid, q, w, i, i - row_number() OVER (PARTITION BY rid, w, q ORDER BY i) AS r FROM seeds),
    runs AS (SELECT rid, min(i) AS s, count(*) - 1 + w + q AS len, q FROM islands GROUP BY rid, w, q, r
             HAVING count(*) - 1 + w + q >= greatest(6, 4 * q)),
    dropped AS (SELECT DISTINCT rid, unnest(range(s + q, s + len)) AS i FROM runs),
    kept AS (SELECT rid, string_agg(w, ' ' ORDER BY i) AS c FROM words ANTI JOIN dropped USING (rid, i) GROUP BY rid),
    best AS (SELECT rid, count(*) AS n_runs, min((-len, s, q)) AS b, string_agg(s || ',' || len || ',' || q || chr(10), '' ORDER BY s, q) AS l
             FROM (SELECT rid, s, len::BIGINT AS len, q FROM runs) GROUP BY rid)
    SELECT doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, b[2]::BIGINT AS start, (-b[1])::BIGINT AS length, b[3]::BIGINT AS period,
           (1000 * -b[1] // b[3])::BIGINT AS exponent_milli, sha256(coalesce(l, '')) AS runs_sha256, sha256(coalesce(c, '')) AS collapsed_sha256
    FROM texts LEFT JOIN best USING (rid) LEFT JOIN kept USING (rid)"""
)
def op13_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs of repeating words of all documents, a tenth of them with a planted one, and digests of what is left."""
    found = periodic_runs(planted_repeats(read_table(spark, sf_dir, "documents")))
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("s"), (-r["period"]).alias("p"))))
    listed = F.concat_ws("", F.transform("runs", lambda r: F.concat_ws("", F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))))
    found = found.withColumn("best", longest)
    return found.select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        "best.length",
        (-F.col("best.p")).alias("period"),
        F.expr("1000 * best.length div -best.p").alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@_R.add(
    rf"""WITH {CRC_TABLE},
    turns AS (SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, m) AS i, m, size
              FROM (SELECT conv_id, turn, strlen(coalesce(text, ''))::BIGINT AS size,
                           md5(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS m
                    FROM conversations WHERE conv_id IS NOT NULL)),
    ids AS (SELECT conv_id AS c, conv_id - conv_id % 5 AS b, {crc_sql("conv_id")} % 9 AS h
            FROM (SELECT DISTINCT conv_id FROM turns), crc_table),
    moved AS (SELECT c, 0 AS part, i, m, size FROM ids JOIN turns t ON t.conv_id = b AND i <= h WHERE c <> b
              UNION ALL SELECT c, 1, i, m, size FROM ids JOIN turns t ON t.conv_id = c AND (i > h OR c = b)),
    whole AS (SELECT c, coalesce(list(m ORDER BY part, i) FILTER (m IS NOT NULL), []) AS w, coalesce(list(size ORDER BY part, i) FILTER (m IS NOT NULL), []) AS z
              FROM ids LEFT JOIN moved USING (c) GROUP BY c),
    prefixes AS (SELECT c, d, w[1:d] AS p, coalesce(z[d], 0) AS size, len(w) = d AS last
                 FROM (SELECT c, w, z, unnest(range(len(w) + 1)) AS d FROM whole)),
    nodes AS (SELECT d, p, min(c) AS conv_id, count(*) AS n_convs, any_value(size) AS size,
                     sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (last), '')) AS ends_sha256 FROM prefixes GROUP BY d, p),
    family AS (SELECT d, p[1:d - 1] AS p, conv_id FROM nodes WHERE d > 0),
    kids AS (SELECT d - 1 AS d, p, count(*) AS n FROM family GROUP BY ALL),
    full_nodes AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k USING (d, p)),
    below AS (SELECT u AS d, p[1:u] AS p, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * size) AS saved
              FROM (SELECT d, p, n_convs, size, n_children, unnest(range(d + 1)) AS u FROM full_nodes) GROUP BY 1, 2)
    SELECT n.conv_id, n.d::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children, b.n_leaves,
           b.saved::BIGINT AS saved_tokens, n.ends_sha256
    FROM full_nodes n JOIN below b USING (d, p) LEFT JOIN nodes up ON up.d = n.d - 1 AND up.p = n.p[1:n.d - 1]"""
)
def op12_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prefix trie of all conversations, each begun with turns of its group of five's first."""
    talks = read_table(spark, sf_dir, "conversations")
    rebuilt = rebuilt_conversations(talks, F.expr("conv_id - conv_id % 5"), checksum("conv_id") % 9, keep=8)
    return prefix_trie(rebuilt)


def _any_case(word: str) -> str:
    return "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in word)


ASSIGN = rf"""({"|".join(map(_any_case, ("password", "passwd", "secret", "token", "api_?key")))})[\"\'']?\x20*[:=]\x20*[\"\'']?([A-Za-z0-9+/_.=-]+)"""


def _places_sql(kind: int, pattern: str, value: str) -> str:
    """Code-point places of a pattern's matches, between two marks that no text has."""
    return rf"""SELECT rid, {kind} AS kind, a, a + length(m) AS b, {value} AS v
      FROM (SELECT rid, j, split_part(s, chr(57345), 1) AS m,
                   coalesce(sum(length(s) - (j > 1)::INT) OVER (PARTITION BY rid ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS a
            FROM (SELECT rid, unnest(p) AS s, generate_subscripts(p, 1) AS j
                  FROM (SELECT rid, string_split(regexp_replace(t, '{pattern}', chr(57344) || '\0' || chr(57345), 'g'), chr(57344)) AS p FROM given)))
      WHERE j > 1"""


@_R.add(
    rf"""WITH given AS (SELECT row_number() OVER () AS rid, doc_id, source, source || '/' || lang AS repo, coalesce(text, '') AS t FROM documents),
    base AS ({_places_sql(0, ASSIGN, f"regexp_extract(m, '{ASSIGN}', 2)")} AND length(v) >= 6
             UNION ALL {_places_sql(1, "AKIA[A-Z0-9]+", "m")} AND length(m) >= 20
             UNION ALL {_places_sql(2, "[0-9a-f]+", "m")} AND length(m) >= 24),
    bare AS ({_places_sql(3, "[0-9A-Za-z+/_=-]+", "m")} AND length(m) >= 16),
    every_place AS (SELECT * FROM base UNION ALL SELECT * FROM bare w WHERE NOT EXISTS (SELECT 1 FROM base x WHERE x.rid = w.rid AND x.a < w.b AND x.b > w.a)),
    looked AS (SELECT *, length(v) >= 16 AND len(list_distinct(string_split(v, ''))) >= 8 AND len(regexp_extract_all(v, '[0-9]')) >= 3
                         AND len(regexp_extract_all(v, '[A-Za-z]')) >= 3 AS live FROM every_place),
    places AS (SELECT l.*, g.source, g.repo FROM looked l JOIN given g USING (rid) WHERE kind < 3 OR live),
    owners AS (SELECT v, count(*) AS n_owners FROM (SELECT DISTINCT v, source FROM places) GROUP BY v),
    judged AS (SELECT rid, kind, a, b, CASE WHEN n_owners >= 3 THEN 'example' WHEN live THEN 'live' ELSE 'weak' END AS verdict,
                      ['assign', 'access', 'hex', 'owned'][kind + 1] || ':' || a || ':' || b AS span FROM places JOIN owners USING (v)),
    summed AS (SELECT rid, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access, count(*) FILTER (kind = 2) AS n_hex,
                      count(*) FILTER (kind = 3) AS n_owned, count(*) FILTER (verdict = 'live') AS n_live, count(*) FILTER (verdict = 'example') AS n_example,
                      string_agg(span, ',' ORDER BY a, kind) FILTER (kind < 3) AS base, string_agg(span, ',' ORDER BY a, kind) AS spans
               FROM judged WHERE kind < 3 OR verdict = 'live' GROUP BY rid)
    SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans, coalesce(n_owned, 0)::BIGINT AS n_owned,
           coalesce(n_live, 0)::BIGINT AS n_live, coalesce(n_example, 0)::BIGINT AS n_example
    FROM given LEFT JOIN summed USING (rid)"""
)
def op11_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of all documents; a document's owner is its source, its repository the source's part in its language."""
    docs = read_table(spark, sf_dir, "documents")
    given = docs.select("doc_id", F.col("source").alias("owner"), F.concat("source", F.lit("/"), "lang").alias("repo"), "text")

    def number(field: str, value: str) -> Column:
        return F.size(F.filter("findings", lambda f: f[field] == value)).cast("bigint")

    return find_secrets(given).select(
        "doc_id",
        *(number("kind", k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(spans_text(F.filter("findings", lambda f: f["kind"] != "owned")), 256).alias("base_sha256"),
        spans_text("findings").alias("spans"),
        number("kind", "owned").alias("n_owned"),
        number("verdict", "live").alias("n_live"),
        number("verdict", "example").alias("n_example"),
    )
