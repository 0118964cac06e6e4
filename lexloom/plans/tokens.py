"""Token tables over the documents, subwords, next-token statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexloom.functions import text as tx
from lexloom.operators import backoff as bk
from lexloom.operators import ngrams as ng
from lexloom.operators import subwords as sw
from lexloom.operators import tokens as tk
from lexloom.operators import wordpiece as wp
from lexloom.operators.frames import softmax_over, top_n, unnest
from lexloom.plans.registry import Registry, words
from lexloom.session import cut_lineage
from lexloom.sources import tables as tb

_R = Registry()
QUERIES, ORACLES = _R.queries, _R.oracles

VOCAB_SIZE = 5000
N_MERGES = 12


def _vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tk.build_vocab(tb.docs(spark, sf_dir), VOCAB_SIZE, min_count=2)


TOKENS = f"""tok AS (
  SELECT doc_id, unnest(t) AS token, generate_subscripts(t, 1) - 1 AS pos
  FROM (SELECT doc_id, {words('text')} AS t FROM documents))"""

VOCAB = f"""{TOKENS},
vocab AS (
  SELECT * FROM (VALUES (0, '[PAD]', 0::BIGINT), (1, '[UNK]', 0), (2, '[CLS]', 0), (3, '[SEP]', 0)) s(id, token, n)
  UNION ALL
  SELECT (row_number() OVER (ORDER BY n DESC, token) + 3)::INTEGER AS id, token, n
  FROM (SELECT token, count(*) AS n FROM tok WHERE token NOT IN ('[PAD]', '[UNK]', '[CLS]', '[SEP]')
        GROUP BY token HAVING count(*) >= 2 ORDER BY n DESC, token LIMIT {VOCAB_SIZE}))"""

ENCODED = f"""{VOCAB},
body AS (
  SELECT doc_id, list(coalesce(v.id, 1) ORDER BY pos) AS ids FROM tok LEFT JOIN vocab v USING (token) GROUP BY doc_id),
encoded AS (
  SELECT d.doc_id, list_concat(list_concat([2], coalesce(b.ids, [])), [3]) AS ids
  FROM documents d LEFT JOIN body b USING (doc_id))"""


@_R.add(f"WITH {VOCAB} SELECT id, token, n FROM vocab")
def vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _vocab(spark, sf_dir)


def _encoded(spark: SparkSession, sf_dir: str, words_table: DataFrame) -> DataFrame:
    return tk.encode(tb.docs(spark, sf_dir), words_table)


@_R.add(f"WITH {ENCODED} SELECT doc_id, len(ids) AS n_ids, array_to_string(ids, ' ') AS ids FROM encoded")
def encoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _encoded(spark, sf_dir, _vocab(spark, sf_dir)).select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_ids"),
        F.array_join(F.col("ids").cast("array<string>"), " ").alias("ids"),
    )


@_R.add(
    f"""WITH {VOCAB}
    SELECT d.doc_id, coalesce(t.text, '') AS text FROM documents d LEFT JOIN (
      SELECT doc_id, string_agg(coalesce(v.token, '[UNK]'), ' ' ORDER BY pos) AS text
      FROM tok LEFT JOIN vocab v USING (token) GROUP BY doc_id) t USING (doc_id)"""
)
def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Texts encoded and decoded again; words outside the vocabulary come back as unknown."""
    words_table = cut_lineage(_vocab(spark, sf_dir))
    return tk.decode(_encoded(spark, sf_dir, words_table), words_table)


@_R.add(
    f"""WITH {ENCODED},
    sized AS (SELECT doc_id, doc_id // 32 AS batch, ids, len(ids) AS n, max(len(ids)) OVER (PARTITION BY doc_id // 32) AS m FROM encoded)
    SELECT doc_id, batch, m AS n_padded, n AS n_real,
           md5(array_to_string(list_concat(ids, list_transform(range(m - n), lambda i: 0)), ' ')) AS ids_md5
    FROM sized"""
)
def padded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches of 32 documents padded to their longest one, with the attention mask's sum."""
    ids = cut_lineage(_encoded(spark, sf_dir, _vocab(spark, sf_dir))).withColumn("batch", F.floor(F.col("doc_id") / 32))
    padded_ids = tk.pad_batch(ids, "batch")
    return padded_ids.select(
        "doc_id",
        "batch",
        F.size("ids").cast("bigint").alias("n_padded"),
        F.aggregate("mask", F.lit(0), lambda s, x: s + x).cast("bigint").alias("n_real"),
        F.md5(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_md5"),
    )


@_R.add(
    f"""SELECT doc_id, array_to_string(list_transform({words('text')}, lambda t, i: CASE WHEN i = 1 THEN t ELSE 'Ġ' || t END), ' ') AS marked
    FROM documents"""
)
def space_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = tx.mark_leading_space(tx.ws_tokens("text"))
    return tb.docs(spark, sf_dir).select("doc_id", F.array_join(marked, " ").alias("marked"))


# Frequent words of the four languages, to be looked up.
LOOKED_UP = ["the", "la", "und", "de"]


@_R.add(
    f"WITH {TOKENS} SELECT doc_id, pos::INTEGER AS pos, token AS word FROM tok WHERE token IN ('the', 'la', 'und', 'de')"
)
def token_positions(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = tx.mark_leading_space(tx.ws_tokens("text"))
    return tk.find_token(tb.docs(spark, sf_dir), marked, LOOKED_UP)


@_R.add(f"WITH {TOKENS} SELECT doc_id, pos::INTEGER AS pos, token FROM tok")
def token_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tk.token_breakdown(tb.docs(spark, sf_dir), tx.ws_tokens("text"))


@_R.add(
    f"""WITH pieces AS (SELECT DISTINCT unnest(string_split(text, ' ')) AS token FROM documents),
    body AS (SELECT token, replace(replace(replace(replace(token, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n'),
                                           chr(13), chr(92) || 'r'), chr(9), chr(92) || 't') AS b,
                    contains(token, '''') AS s, contains(token, '"') AS d FROM pieces)
    SELECT token, CASE WHEN s AND NOT d THEN '"' || b || '"'
                       WHEN s THEN '''' || replace(b, '''', chr(92) || '''') || ''''
                       ELSE '''' || b || '''' END AS shown FROM body"""
)
def token_display(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct piece between two spaces, with its newlines made visible."""
    pieces = unnest(tb.docs(spark, sf_dir), tx.split_fields("text", " ")).distinct()
    return pieces.select("token", tx.show_token("token").alias("shown"))


@_R.add(
    f"""WITH v AS (
      SELECT 'whitespace' AS variant, unnest({words('text')}) AS token FROM documents
      UNION ALL SELECT 'lower letters', unnest(regexp_extract_all(lower(text), '{tx.LETTER_RUN}', 1)) FROM documents
      UNION ALL SELECT 'character', unnest(regexp_extract_all(text, '(?s)(.)', 1)) FROM documents),
    c AS (SELECT variant, token, count(*) AS n FROM v GROUP BY ALL)
    SELECT variant, sum(n)::BIGINT AS tokens, count(*) AS distinct_tokens, count(*) FILTER (n >= 2) AS vocab_size,
           round(sum(n)::DOUBLE / (SELECT count(*) FROM documents), 6) AS tokens_per_doc,
           round(coalesce(sum(n) FILTER (n < 2), 0)::DOUBLE / sum(n)::DOUBLE, 6) AS unknown_rate
    FROM c GROUP BY variant"""
)
def tokenizer_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    full = tk.tokenizer_report(tb.docs(spark, sf_dir))
    return full.withColumn("tokens_per_doc", F.round("tokens_per_doc", 6)).withColumn(
        "unknown_rate", F.round("unknown_rate", 6)
    )


SYMBOLS = f"""{TOKENS},
w0 AS (SELECT token, count(*) AS n, regexp_replace(token, '(?s)(.)', ' \\1 ', 'g') AS symbols FROM tok GROUP BY token)"""


def _pair_cte(step: int) -> str:
    return f"""p{step} AS (
  SELECT s[i] AS l, s[i + 1] AS r, sum(n)::BIGINT AS n
  FROM (SELECT s, n, unnest(range(1, len(s))) AS i
        FROM (SELECT string_split(trim(symbols), '  ') AS s, n FROM w{step}))
  GROUP BY 1, 2)"""


def _merge_ctes(n_merges: int) -> str:
    parts = [SYMBOLS]
    for step in range(n_merges):
        parts.append(_pair_cte(step))
        parts.append(f"m{step} AS (SELECT l, r, n FROM p{step} ORDER BY n DESC, l, r LIMIT 1)")
        parts.append(
            f"w{step + 1} AS (SELECT token, w.n, replace(symbols, ' ' || l || '  ' || r || ' ', ' ' || l || r || ' ') AS symbols"
            f" FROM w{step} w CROSS JOIN m{step})"
        )
    return ",\n".join(parts)


@_R.add(f'WITH {SYMBOLS}, {_pair_cte(0)} SELECT l AS "left", r AS "right", n FROM p0')
def subword_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pair counts of the first round."""
    return sw.pair_counts(sw.word_table(tb.docs(spark, sf_dir)))


@_R.add(
    f"WITH {_merge_ctes(N_MERGES)} "
    + " UNION ALL ".join(f'SELECT {i + 1} AS step, l AS "left", r AS "right", n FROM m{i}' for i in range(N_MERGES))
)
def subword_merges(spark: SparkSession, sf_dir: str) -> DataFrame:
    merges = sw.learn_subwords(tb.docs(spark, sf_dir), N_MERGES)
    rows = [(i + 1, *merge) for i, merge in enumerate(merges)]
    return spark.createDataFrame(rows, "step int, left string, right string, n bigint")


@_R.add(
    f"""WITH {_merge_ctes(N_MERGES)},
    pieces AS (SELECT doc_id, string_agg(replace(trim(symbols), '  ', ' '), ' ' ORDER BY pos) AS pieces
               FROM tok JOIN w{N_MERGES} USING (token) GROUP BY doc_id)
    SELECT d.doc_id, CASE WHEN pieces IS NULL THEN 0 ELSE len(string_split(pieces, ' ')) END AS n_pieces,
           coalesce(pieces, '') AS pieces FROM documents d LEFT JOIN pieces USING (doc_id)"""
)
def subword_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = tb.docs(spark, sf_dir)
    pieces = sw.apply_subwords(docs, sw.learn_subwords(docs, N_MERGES))
    return pieces.select(
        "doc_id", F.size("pieces").cast("bigint").alias("n_pieces"), F.array_join("pieces", " ").alias("pieces")
    )


PIECE_WORDS = 2000
WORDPIECES = f"""{TOKENS},
counted_words AS (SELECT token, count(*) AS n FROM tok GROUP BY token),
letters AS (SELECT DISTINCT unnest(regexp_extract_all(token, '(?s)(.)', 1)) AS c FROM counted_words WHERE n > 1),
known AS (SELECT token AS piece, false AS inside FROM (SELECT token FROM counted_words ORDER BY n DESC, token LIMIT {PIECE_WORDS})
          UNION SELECT c, false FROM letters UNION SELECT c, true FROM letters
          UNION SELECT token[-3:], true FROM (SELECT token FROM counted_words ORDER BY n DESC, token LIMIT {PIECE_WORDS}) WHERE length(token) > 3),
sizes AS (SELECT DISTINCT inside, length(piece) AS l FROM known),
cuts AS (WITH RECURSIVE r(token, spot, pieces, stuck) AS (
    SELECT token, 1, []::VARCHAR[], false FROM counted_words
    UNION ALL
    SELECT token, spot + coalesce(l, 0), list_append(pieces, CASE WHEN spot > 1 THEN '##' || piece ELSE piece END), l IS NULL
    FROM (SELECT r.token, r.spot, r.pieces, max(k.l) AS l, max_by(k.piece, k.l) AS piece FROM r
          LEFT JOIN (SELECT s.token, s.spot, z.l, k.piece FROM r s JOIN sizes z ON z.inside = (s.spot > 1) AND s.spot + z.l - 1 <= length(s.token)
                     JOIN known k ON k.inside = z.inside AND k.piece = substr(s.token, s.spot, z.l)) k ON k.token = r.token AND k.spot = r.spot
          WHERE NOT r.stuck AND r.spot <= length(r.token) GROUP BY r.token, r.spot, r.pieces))
  SELECT token, CASE WHEN stuck THEN ['[UNK]'] ELSE pieces END AS pieces FROM r WHERE stuck OR spot > length(token))"""


def _piece_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A vocabulary that is counted, not learned: frequent words, their endings, and the letters of words seen twice."""
    counts = cut_lineage(tk.token_counts(tb.docs(spark, sf_dir), tx.ws_tokens("text")))
    top = cut_lineage(top_n(counts, PIECE_WORDS, "n", "token").select("token"))
    letters = counts.where("n > 1").select(F.explode(F.regexp_extract_all("token", F.lit("(?s)(.)"), F.lit(1))).alias("piece")).distinct()
    ends = top.where("length(token) > 3").select(F.concat(F.lit(wp.INSIDE), F.expr("right(token, 3)")).alias("piece"))
    inside = letters.select(F.concat(F.lit(wp.INSIDE), "piece").alias("piece"))
    return top.select(F.col("token").alias("piece")).union(letters).union(inside).union(ends)


@_R.add(
    f"""WITH {WORDPIECES},
    joined AS (SELECT doc_id, string_agg(array_to_string(pieces, ' '), ' ' ORDER BY pos) AS pieces, sum(len(pieces))::BIGINT AS n_pieces
               FROM tok JOIN cuts USING (token) GROUP BY doc_id)
    SELECT doc_id, coalesce(n_pieces, 0) AS n_pieces, coalesce(pieces, '') AS pieces FROM documents LEFT JOIN joined USING (doc_id)"""
)
def wordpiece_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in word pieces, the longest known piece first."""
    trie = wp.piece_trie(_piece_vocab(spark, sf_dir))
    pieces = tb.docs(spark, sf_dir).select("doc_id", wp.wordpieces(tx.ws_tokens("text"), trie).alias("pieces"))
    pieces = pieces.withColumn("pieces", F.coalesce("pieces", F.array().cast("array<string>")))
    return pieces.select("doc_id", F.size("pieces").cast("bigint").alias("n_pieces"), F.array_join("pieces", " ").alias("pieces"))


@_R.add(
    f"""WITH {WORDPIECES}, v AS (
      SELECT 'whitespace' AS variant, unnest({words('text')}) AS token FROM documents
      UNION ALL SELECT 'lower letters', unnest(regexp_extract_all(lower(text), '{tx.LETTER_RUN}', 1)) FROM documents
      UNION ALL SELECT 'character', unnest(regexp_extract_all(text, '(?s)(.)', 1)) FROM documents
      UNION ALL SELECT 'subword', unnest(pieces) FROM tok JOIN cuts USING (token)),
    c AS (SELECT variant, token, count(*) AS n FROM v GROUP BY ALL)
    SELECT variant, sum(n)::BIGINT AS tokens, count(*) AS distinct_tokens, count(*) FILTER (n >= 2) AS vocab_size,
           round(sum(n)::DOUBLE / (SELECT count(*) FROM documents), 6) AS tokens_per_doc,
           round(coalesce(sum(n) FILTER (n < 2), 0)::DOUBLE / sum(n)::DOUBLE, 6) AS unknown_rate
    FROM c GROUP BY variant"""
)
def tokenizer_report_subword(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four tokenizers on the documents, word pieces among them."""
    trie = wp.piece_trie(_piece_vocab(spark, sf_dir))
    full = tk.tokenizer_report(tb.docs(spark, sf_dir), extra={"subword": wp.wordpieces(tx.ws_tokens("text"), trie)})
    return full.withColumn("tokens_per_doc", F.round("tokens_per_doc", 6)).withColumn("unknown_rate", F.round("unknown_rate", 6))


GRAMS = f"""{TOKENS},
steps AS (SELECT doc_id, pos, token, lag(token) OVER w AS before, lead(token) OVER w AS nxt
          FROM tok WINDOW w AS (PARTITION BY doc_id ORDER BY pos)),
grams AS (
  SELECT 1 AS prefix_len, token AS prefix, nxt AS next FROM steps WHERE nxt IS NOT NULL
  UNION ALL SELECT 2, before || ' ' || token, nxt FROM steps WHERE nxt IS NOT NULL AND before IS NOT NULL),
counted AS (SELECT prefix_len, prefix, next, count(*) AS n FROM grams GROUP BY ALL),
ranked AS (SELECT prefix_len, prefix, next, n, sum(n) OVER (PARTITION BY prefix_len, prefix) AS total,
                  row_number() OVER (PARTITION BY prefix_len, prefix ORDER BY n DESC, next) AS rank
           FROM counted),
prompts AS (SELECT conv_id || ':' || turn AS prompt_id, {words('text')} AS t FROM conversations),
ends AS (
  SELECT prompt_id, 1 AS prefix_len, t[-1] AS prefix FROM prompts WHERE len(t) >= 1
  UNION ALL SELECT prompt_id, 2, t[-2] || ' ' || t[-1] FROM prompts WHERE len(t) >= 2),
best AS (SELECT prompt_id, max(prefix_len) AS prefix_len FROM ends SEMI JOIN counted USING (prefix_len, prefix) GROUP BY prompt_id),
completed AS (SELECT e.prompt_id, e.prefix_len, r.rank::INTEGER AS rank, r.next, r.n, r.n::DOUBLE / r.total AS share
              FROM ends e JOIN best USING (prompt_id, prefix_len) JOIN ranked r USING (prefix_len, prefix) WHERE r.rank <= 4)"""


def _prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every message of every conversation is a prompt."""
    prompt_id = F.concat_ws(":", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return tb.messages(spark, sf_dir).select(prompt_id.alias("prompt_id"), "text")


def _completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ng.complete(tb.docs(spark, sf_dir), _prompts(spark, sf_dir), k=4)


@_R.add(
    f"""WITH {GRAMS} SELECT prefix, (rank)::INTEGER AS rank, next, n, round(ln(n), 6) AS score, round(n::DOUBLE / total, 6) AS share
    FROM ranked WHERE prefix_len = 1 AND rank <= 3"""
)
def next_token_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three likeliest next tokens of every token."""
    table = ng.next_tokens(ng.next_counts(tb.docs(spark, sf_dir)), k=3)
    return table.select(
        "prefix", "rank", "next", "n", F.round("score", 6).alias("score"), F.round("share", 6).alias("share")
    )


@_R.add(f"WITH {GRAMS} SELECT prompt_id, prefix_len, rank, next, n, round(ln(n), 6) AS score, round(share, 6) AS share FROM completed")
def next_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four likeliest next tokens of every message, from the documents, with back-off."""
    return _completed(spark, sf_dir).withColumn("score", F.round("score", 6)).withColumn(
        "share", F.round("share", 6)
    )


@_R.add(
    f"""WITH {GRAMS},
    heat AS (SELECT prefix, next, n, unnest([0.5, 1.0])::DOUBLE AS temperature FROM counted WHERE prefix_len = 1),
    drawn AS (SELECT prefix, temperature, next,
                     round(ln(n) / temperature - ln(-ln((('0x' || substr(md5('42' || chr(10) || printf('%.6f', temperature) || chr(10) || prefix || chr(10) || next),
                                                                          1, 13))::BIGINT::DOUBLE + 0.5) / 4503599627370496)), 9) AS key FROM heat)
    SELECT prefix, temperature, (row_number() OVER w)::INTEGER AS rank, next FROM drawn
    WINDOW w AS (PARTITION BY prefix, temperature ORDER BY key DESC, next) QUALIFY row_number() OVER w <= 2"""
)
def next_token_draws(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two continuations of every token, drawn at two temperatures."""
    drawn = ng.draw_tokens(ng.next_counts(tb.docs(spark, sf_dir)), 2, [0.5, 1.0])
    return drawn.select("prefix", "temperature", "rank", "next")


# the chain of contexts that prompts end in: seen continuations and their interpolated probabilities
CHAIN = f"""{GRAMS},
single AS (SELECT token AS next, count(*) AS n, count(*)::DOUBLE / (SELECT count(*) FROM tok) AS p FROM tok GROUP BY token),
asked AS (SELECT * FROM counted SEMI JOIN ends USING (prefix_len, prefix)),
contexts AS (SELECT prefix_len, prefix, sum(n) AS total, 0.75 * count(*) / sum(n) AS weight FROM asked GROUP BY ALL),
seen1 AS (SELECT a.prefix, a.next, s.p AS below, (a.n - 0.75) / c.total + c.weight * s.p AS p
          FROM asked a JOIN contexts c USING (prefix_len, prefix) JOIN single s ON s.next = a.next WHERE prefix_len = 1),
seen2 AS (SELECT a.prefix, a.next, s.p AS below, (a.n - 0.75) / c.total + c.weight * s.p AS p
          FROM asked a JOIN contexts c USING (prefix_len, prefix)
          JOIN seen1 s ON s.prefix = split_part(a.prefix, ' ', 2) AND s.next = a.next WHERE prefix_len = 2),
first_best AS (SELECT next, p FROM single ORDER BY round(p, 9) DESC, next LIMIT 4),
all1 AS (SELECT prefix, next, p FROM seen1 UNION ALL
         SELECT c.prefix, f.next, c.weight * f.p FROM contexts c CROSS JOIN first_best f
         WHERE c.prefix_len = 1 AND NOT EXISTS (SELECT 1 FROM seen1 s WHERE s.prefix = c.prefix AND s.next = f.next)),
all2 AS (SELECT prefix, next, p FROM seen2 UNION ALL
         SELECT c.prefix, f.next, c.weight * f.p FROM contexts c JOIN all1 f ON f.prefix = split_part(c.prefix, ' ', 2)
         WHERE c.prefix_len = 2 AND NOT EXISTS (SELECT 1 FROM seen2 s WHERE s.prefix = c.prefix AND s.next = f.next)),
lists AS (SELECT '' AS prefix, next, p FROM first_best UNION ALL SELECT * FROM all1 UNION ALL SELECT * FROM all2),
places AS (SELECT prefix, next, p, row_number() OVER (PARTITION BY prefix ORDER BY round(p, 9) DESC, next) AS rank FROM lists),
longest AS (SELECT prompt_id, coalesce(max(prefix_len), 0)::INTEGER AS prefix_len, coalesce(max_by(prefix, prefix_len), '') AS prefix
            FROM prompts LEFT JOIN (SELECT * FROM ends SEMI JOIN contexts USING (prefix_len, prefix)) USING (prompt_id) GROUP BY prompt_id)"""


@_R.add(
    f"""WITH {CHAIN} SELECT prompt_id, prefix_len, rank::INTEGER AS rank, next, round(p, 6) AS prob
    FROM longest JOIN places USING (prefix) WHERE rank <= 4"""
)
def next_tokens_backoff(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The four likeliest of all tokens after every message, by the back-off chain down to single tokens."""
    found = bk.complete_backoff(tb.docs(spark, sf_dir), _prompts(spark, sf_dir), k=4)
    return found.withColumn("prob", F.round("prob", 6))


@_R.add(
    f"""WITH {GRAMS} SELECT prefix_len::INTEGER AS prefix_len, count(DISTINCT prefix) AS n_contexts, true AS whole FROM counted GROUP BY prefix_len
    UNION ALL SELECT 0, 1, true"""
)
def backoff_mass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All contexts of up to two tokens, and whether the probabilities after each add up to one."""
    mass = bk.context_mass(*bk.backoff_chain(tb.docs(spark, sf_dir)))
    whole = F.bool_and(F.abs(F.col("mass") - 1) < 1e-9)
    return mass.groupBy("prefix_len").agg(F.count(F.lit(1)).alias("n_contexts"), whole.alias("whole"))


@_R.add(
    f"""WITH {GRAMS}, t AS (SELECT unnest([0.5, 1.0, 2.0])::DOUBLE AS temperature),
    p AS (SELECT prompt_id, temperature, rank, next,
                 exp(ln(n) / temperature) / sum(exp(ln(n) / temperature)) OVER (PARTITION BY prompt_id, temperature) AS prob
          FROM completed CROSS JOIN t),
    c AS (SELECT *, coalesce(sum(prob) OVER (PARTITION BY prompt_id, temperature ORDER BY rank
                             ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                 ('0x' || substr(md5('42:' || prompt_id), 1, 8))::BIGINT::DOUBLE / 4294967296 AS u FROM p)
    SELECT prompt_id, temperature, rank, next, round(prob, 6) AS prob, rank = 1 AS greedy,
           rank = max(rank) FILTER (before <= u) OVER (PARTITION BY prompt_id, temperature) AS drawn FROM c"""
)
def next_token_temperature(spark: SparkSession, sf_dir: str) -> DataFrame:
    probs = ng.temperature_probs(_completed(spark, sf_dir), [0.5, 1.0, 2.0], "prompt_id")
    return probs.withColumn("prob", F.round("prob", 6))


@_R.add(
    f"""WITH {TOKENS}, c AS (SELECT lang, token, count(*) AS n FROM tok JOIN documents USING (doc_id) GROUP BY ALL)
    SELECT lang, token, round(n::DOUBLE / sum(n) OVER (PARTITION BY lang), 6) AS prob FROM c"""
)
def softmax_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Softmax of ln(count) over the tokens of each language: the token's share."""
    docs = tb.docs(spark, sf_dir, "lang")
    counts = (
        unnest(docs, tx.ws_tokens("text"), "lang")
        .groupBy("lang", "token")
        .agg(F.log(F.count(F.lit(1)).cast("double")).alias("score"))
    )
    probs = softmax_over(counts, "lang", "score", by="token")
    return probs.select("lang", "token", F.round("prob", 6).alias("prob"))
