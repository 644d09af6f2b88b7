"""The corpus operators as queries over the given tables, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from helixmill.llm import (
    chat_format,
    dart_minhash,
    decontamination,
    filter_audit,
    license_scan,
    line_dedup,
    mixing,
    ngram_lm,
    order_minhash,
    phrase_mining,
    substring_dedup,
    toxicity,
    url_filter,
)

TOXIC_AT = 0.3
RULES = [
    url_filter.Rule("com", "/en/", "block"),
    url_filter.Rule("example.com", "/en/7", "allow"),
    url_filter.Rule("net", "/de/", "allow"),
    url_filter.Rule("example.net", "/de/8", "block"),
    url_filter.Rule("org", "/es/", "block"),
]
#: Host names with one of these words are listed where no rule decides.
HOST_WORDS = ["spam", "pills", "casino", "porn", "xxx", "viagra", "warez", "malware"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def remainder(n: int) -> Column:
    """CRC-32 of doc_id as text, modulo n."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % n


def training_rows(n: int, held_out: int) -> Column:
    return remainder(n) != held_out


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), training_rows(4, 2))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    predicted = (F.col("score") >= TOXIC_AT).cast("int")
    held_out = F.coalesce(remainder(4) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", predicted.alias("predicted"))


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    mixed = mixing.with_copies(docs)
    size = mixing.word_count(F.col("text"))
    taken = (size * F.col("__copies")).alias("taken")
    return mixed.select("doc_id", size.alias("size"), F.col("__source_size").alias("source_size"), F.col("__target").alias("target"), taken)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = url_filter.hosts_with_words(pages, HOST_WORDS)
    return url_filter.judged(pages, RULES, listed).select("page_id", "host", "path", "rule", "verdict")


def op4_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    classes = dart_minhash.near_duplicates(table(spark, sf_dir, "documents"))
    return classes.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def op5_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.with_next(table(spark, sf_dir, "documents"))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    path = F.concat_ws("/", "source", "lang", F.col("doc_id").cast("string"))
    return license_scan.licences(docs, path)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.without_repeats(table(spark, sf_dir, "documents"), with_text=False)
    return kept.withColumnRenamed("kept", "kept_sha256")


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    clean = line_dedup.without_boilerplate(docs)
    return clean.select("doc_id", "source", F.col("__n_lines").alias("n_lines"), F.col("__n_dropped").alias("n_dropped"), "text")


def op10_ngram_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = ngram_lm.scored(docs, training_rows(5, 1))
    held_out = F.coalesce(remainder(5) == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, [("user", said), ("assistant", said)])], "conv_id long, messages array<struct<role:string,content:string>>")
    chats = chat_format.formatted(rows.unionByName(extra, allowMissingColumns=True), "conv_id")
    back = chat_format.read_back(chats)
    turns = F.array_join(F.transform("turns", lambda x: F.concat(x["role"], F.lit("\n"), x["text"], F.lit("\n"))), "")
    loss = F.array_join("loss", "")
    return back.select(
        F.col("key").alias("conv_id"), F.size("turns").cast("long").alias("n_turns"), F.sha2(turns.cast("binary"), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss.cast("binary"), 256).alias("loss_sha256"), "formatted_chars",
    )


def op12_phrase_mining(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_mining.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "text")
    return filter_audit.audit(docs, table(spark, sf_dir, "labels"), filter_audit.text_filters(), "lang")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_toxicity": op1_toxicity,
        "op2_mixing": op2_mixing,
        "op3_url_filter": op3_url_filter,
        "op4_near_dedup": op4_near_dedup,
        "op5_order_minhash": op5_order_minhash,
        "op6_license_scan": op6_license_scan,
        "op7_substring_dedup": op7_substring_dedup,
        "op8_decontamination": op8_decontamination,
        "op9_line_dedup": op9_line_dedup,
        "op10_ngram_lm": op10_ngram_lm,
        "op11_chat_format": op11_chat_format,
        "op12_phrase_mining": op12_phrase_mining,
        "op13_filter_audit": op13_filter_audit,
    }


_WORD = r"'[^\x20\x09-\x0D]+'"

_OP2 = rf"""
WITH sizes AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, {_WORD})), 0) AS BIGINT) AS size FROM documents
), per AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS s FROM sizes GROUP BY source
), weighted AS (
  SELECT source, s, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM per
), ordered AS (
  SELECT *, row_number() OVER (ORDER BY 3.0 * s / w, source NULLS LAST) AS k FROM weighted
), before AS (
  -- words and weight that are left if the k-1 sources of the lowest limits get just those
  SELECT *, sum(s) OVER () - coalesce(sum(3 * s) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
    sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS free
  FROM ordered
), cut AS (
  SELECT min(k) AS k FROM before WHERE 3 * s * free >= rest * w
), share AS (
  SELECT k, CAST(rest AS DOUBLE) AS rest, CAST(free AS DOUBLE) AS free FROM before WHERE k = (SELECT k FROM cut)
), target AS (
  SELECT b.source, b.s, CASE WHEN b.k < share.k THEN CAST(3 * b.s AS DOUBLE) ELSE share.rest * b.w / share.free END AS target
  FROM before b, share
), rates AS (
  SELECT d.doc_id, d.size, t.s, t.target, CASE WHEN t.s > 0 THEN t.target / t.s ELSE 0.0 END AS rate,
    CAST(CAST('0x' || substr(md5('mix:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 13) AS BIGINT) AS DOUBLE) / 4503599627370496.0 AS u
  FROM sizes d JOIN target t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, s AS source_size, target,
  CAST(size * least(floor(rate) + CASE WHEN u < rate - floor(rate) THEN 1 ELSE 0 END, 3) AS BIGINT) AS taken
FROM rates
"""

_OP3 = r"""
WITH parts AS (
  SELECT page_id,
    CASE WHEN url LIKE '%://%' THEN translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE '' END AS host,
    CASE WHEN url LIKE '%://%' THEN regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1) ELSE '' END AS path
  FROM pages
), rules(h, p, v) AS (
  VALUES ('com', '/en/', 'block'), ('example.com', '/en/7', 'allow'), ('net', '/de/', 'block'), ('example.net', '/de/8', 'block'), ('org', '/es/', 'block')
), fits AS (
  SELECT page_id, h || p AS rule, v, row_number() OVER (PARTITION BY page_id ORDER BY length(h) + length(p) DESC, length(h) DESC) AS k
  FROM parts, rules WHERE (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
)
SELECT a.page_id, a.host, a.path, f.rule,
  coalesce(f.v, CASE WHEN list_has_any(regexp_split_to_array(a.host, '[.\-]'), ['spam', 'pills', 'casino', 'porn', 'xxx', 'viagra', 'warez', 'malware']) THEN 'block' ELSE 'allow' END) AS verdict
FROM parts a LEFT JOIN fits f ON a.page_id = f.page_id AND f.k = 1
"""

_OP8 = rf"""
WITH words AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORD}) AS w FROM documents
), runs AS (
  SELECT doc_id, unnest(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))) AS g FROM words WHERE len(w) >= 5
), items AS (
  SELECT DISTINCT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), {_WORD}) AS w FROM benchmark WHERE text IS NOT NULL
), grams AS (
  SELECT item_id, unnest(list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')))) AS g FROM items WHERE len(w) >= 5
), sizes AS (SELECT item_id, count(*) AS n FROM grams GROUP BY item_id),
found AS (SELECT doc_id, item_id, count(*) AS c FROM runs JOIN grams USING (g) GROUP BY ALL)
SELECT doc_id, item_id, n AS n_shingles, CAST(c AS DOUBLE) / n AS containment
FROM found JOIN sizes USING (item_id) WHERE CAST(c AS DOUBLE) / n >= 0.8
"""

_OP9 = f"""
WITH pages AS (SELECT source, count(*) AS n FROM documents GROUP BY source),
lines AS (
  SELECT DISTINCT doc_id, source, trim(line) AS line FROM (SELECT doc_id, source, unnest(string_split(text, chr(10))) AS line FROM documents) WHERE trim(line) <> ''
), counts AS (SELECT source, line, count(*) AS c FROM lines GROUP BY ALL),
bad AS (
  SELECT counts.source, list(line) AS lines FROM counts JOIN pages ON counts.source IS NOT DISTINCT FROM pages.source
  WHERE c >= {line_dedup.LEAST} AND c > {line_dedup.RATIO} * n GROUP BY counts.source
), cut AS (
  SELECT doc_id, d.source, string_split(text, chr(10)) AS l,
    list_filter(string_split(text, chr(10)), lambda x: NOT coalesce(list_contains(lines, trim(x)), false) OR trim(x) = '') AS k
  FROM documents d LEFT JOIN bad ON d.source IS NOT DISTINCT FROM bad.source
)
SELECT doc_id, source, CAST(coalesce(len(l), 0) AS BIGINT) AS n_lines, CAST(coalesce(len(l) - len(k), 0) AS BIGINT) AS n_dropped,
  CASE WHEN l IS NULL THEN NULL WHEN len(k) = 0 THEN '' ELSE array_to_string(k, chr(10)) END AS text
FROM cut
"""

_OP7 = rf"""
WITH words AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, {_WORD}), []) AS w FROM documents
), windows AS (
  SELECT doc_id, unnest(range(1, len(w) - 33)) AS i, unnest(list_transform(range(1, len(w) - 33), lambda i: array_to_string(w[i:i+34], ' '))) AS g
  FROM words WHERE len(w) >= 35
), repeated AS (SELECT g FROM windows GROUP BY g HAVING count(*) > 1),
hits AS (SELECT doc_id, i FROM windows WHERE g IN (SELECT g FROM repeated)),
marks AS (
  SELECT doc_id, i AS pos, 1 AS step FROM hits UNION ALL SELECT doc_id, i + 35, -1 FROM hits
), steps AS (SELECT doc_id, pos, sum(step) AS step FROM marks GROUP BY ALL),
placed AS (
  SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM words WHERE len(w) > 0
), covered AS (
  SELECT p.doc_id, p.pos, p.word, sum(coalesce(s.step, 0)) OVER (PARTITION BY p.doc_id ORDER BY p.pos) AS c
  FROM placed p LEFT JOIN steps s ON p.doc_id = s.doc_id AND p.pos = s.pos
), kept AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (c > 0) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (c = 0), '') AS k
  FROM covered GROUP BY doc_id
)
SELECT w.doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM words w LEFT JOIN kept USING (doc_id)
"""


_OP11 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\### Assistant: </turn> ok')
), written AS (
  SELECT *, CASE WHEN role IN ('system', 'user', 'assistant') THEN role ELSE '=' || replace(url_encode(role), '%20', '+') END AS name,
    regexp_replace(text, '(\\*)(#{3,}|</turn>)', '\\\1\2', 'g') AS body
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS LAST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS LAST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(name) + 6 + length(body) + 9) AS BIGINT) AS formatted_chars
FROM written GROUP BY conv_id
"""

_OP12 = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p
  FROM documents
), words AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM pieces),
grams AS (
  SELECT lang, len(g) AS k, array_to_string(g, ' ') AS p, g FROM (
    SELECT lang, unnest(flatten(list_transform(range(1, 5), lambda s: list_transform(range(1, greatest(len(w) - s + 2, 1)), lambda i: w[i:i + s - 1])))) AS g FROM words
  )
), f AS (SELECT lang, k, p, any_value(g) AS g, count(*) AS n FROM grams GROUP BY lang, k, p),
cand AS (SELECT * FROM f WHERE k > 1 AND n >= 30),
cuts AS (SELECT lang, p, g, n AS a, k AS size, unnest(range(1, k)) AS k FROM cand),
scored AS (
  SELECT c.lang, c.p, c.a, c.k, x.n AS l, y.n AS r, CAST(c.a AS HUGEINT) * 2000000 // (x.n + y.n) AS score
  FROM cuts c JOIN f x ON x.lang = c.lang AND x.p = array_to_string(c.g[:c.k], ' ') JOIN f y ON y.lang = c.lang AND y.p = array_to_string(c.g[c.k + 1:], ' ')
), low AS (SELECT *, row_number() OVER (PARTITION BY lang, p ORDER BY score, k) AS i FROM scored),
inside AS (
  SELECT lang, array_to_string(q, ' ') AS p, max(n) AS longer FROM (
    SELECT lang, n, unnest(flatten(list_transform(range(2, k), lambda s: list_transform(range(1, k - s + 2), lambda i: g[i:i + s - 1])))) AS q FROM cand WHERE k > 2
  ) GROUP BY ALL
), free AS (
  SELECT low.* FROM low LEFT JOIN inside ON low.lang = inside.lang AND low.p = inside.p
  WHERE i = 1 AND (longer IS NULL OR 100 * longer < 80 * a)
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, p) AS rank FROM free),
totals AS (SELECT lang, sum(n) AS n FROM f WHERE k = 1 GROUP BY lang)
SELECT lang, rank, p AS phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

_OP13 = rf"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), {_WORD}) AS w FROM documents
), least AS (SELECT text, min(doc_id) AS least FROM words GROUP BY text),
known AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS toxic FROM labels GROUP BY doc_id),
failed AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, {{'A': len(w) < 200, 'B': 100 * len(list_distinct(w)) < 50 * len(w),
    'C': 100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text), 'D': regexp_matches(text, '[#$%&*|]'),
    'E': coalesce(words.doc_id > least, false)}} AS f
  FROM words JOIN least USING (text) LEFT JOIN known ON words.doc_id = known.doc_id
), kinds AS (SELECT part, good, toxic, f, count(*) AS n FROM failed GROUP BY ALL),
letters(x) AS (VALUES ('A'), ('B'), ('C'), ('D'), ('E')),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS o FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
), steps AS (SELECT o, unnest(range(1, 6)) AS step FROM orders),
told AS (
  SELECT part, o, step, n, good, toxic,
    [CASE x WHEN 'A' THEN f.A WHEN 'B' THEN f.B WHEN 'C' THEN f.C WHEN 'D' THEN f.D ELSE f.E END FOR x IN string_split(o, '')] AS r
  FROM kinds, steps
), gone AS (
  SELECT *, r[step] AS fails, list_bool_or(r[:step - 1]) IS TRUE AS before, len(list_filter(r, lambda x: x)) AS k FROM told
), sums AS (
  SELECT part, o AS filter_order, CAST(step AS INT) AS step,
    CAST(coalesce(sum(n) FILTER (NOT fails AND NOT before), 0) AS BIGINT) AS kept,
    CAST(coalesce(sum(n) FILTER (fails AND NOT before), 0) AS BIGINT) AS removed,
    CAST(coalesce(sum(n) FILTER (fails AND before), 0) AS BIGINT) AS redundant,
    CAST(coalesce(sum(n) FILTER (fails AND k = 1), 0) AS BIGINT) AS unique_fails,
    CAST(coalesce(sum(n) FILTER (fails AND NOT before AND good), 0) AS BIGINT) AS good_lost,
    CAST(coalesce(sum(n) FILTER (fails AND NOT before AND toxic), 0) AS BIGINT) AS toxic_lost
  FROM gone GROUP BY ALL
)
SELECT *, CAST(sum(removed) OVER (PARTITION BY part, filter_order[step]) AS BIGINT) AS shapley FROM sums
"""


def oracle_sql() -> dict[str, str]:
    """DuckDB SQL for the operators that it can express; tests hold the others to brute force."""
    return {"op2_mixing": _OP2, "op3_url_filter": _OP3, "op7_substring_dedup": _OP7, "op8_decontamination": _OP8, "op9_line_dedup": _OP9, "op11_chat_format": _OP11, "op12_phrase_mining": _OP12, "op13_filter_audit": _OP13}
