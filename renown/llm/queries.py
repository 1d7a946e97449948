"""The registered queries of the operators and their SQL twins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from renown.llm import attention_lm, collocations, conversation_repair, dimension_scan, line_dedup, mixing, setsketch, sharding, spaced_seeds, substring_dedup, suffix_dedup, token_prefix, toxicity

TOKEN_LIMIT = 2048


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of eight shards with equal row counts."""
    placed = sharding.shard(_documents(spark, sf_dir).select("doc_id", "text"), 8)
    text = F.col("record.text")
    return placed.select(
        F.col("record.doc_id").alias("doc_id"),
        sharding.record_size(text).alias("size"),
        F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 13-word windows that an earlier document has."""
    kept = substring_dedup.remove_repeats(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the 200-byte strings that occur more than once."""
    kept = suffix_dedup.remove_repeats(_documents(spark, sf_dir))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256")
    )


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose three-word shingles agree to 85 percent."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return setsketch.near_duplicates(docs, n=3, percent=85).drop("tie")


def op5_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of every text under the attention model and under unigram counts."""
    import public_tokenizers

    return attention_lm.score_texts(_documents(spark, sf_dir), str(public_tokenizers.path("word_bpe_49k.json")))


def held_out(key: str = "doc_id") -> Column:
    """Rows whose labels are never learnt from."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % 5 == 0


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document under a model of the labelled rows that are not held out."""
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(~held_out())
    scored = toxicity.score(docs, toxicity.fit(docs, labels), carry=("doc_id",))
    return scored.select(
        F.col("record.doc_id").alias("doc_id"),
        F.coalesce(held_out("record.doc_id"), F.lit(False)).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
        "evidence",
    )


def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors by cosine of every fiftieth one."""
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return dimension_scan.search(vectors, F.col("vec_id") % 50 == 0)


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words each document gives to a mix of the sources at weights 3, 1, 2."""
    mixed = mixing.mix(_documents(spark, sf_dir), carry=("doc_id",))
    return mixed.select(
        F.col("record.doc_id").alias("doc_id"), "size", "source_size", F.round("target", 6).alias("target"), F.col("taken").cast("bigint").alias("taken"), "copies"
    )


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item, with the item and where it lies."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = spaced_seeds.contamination(_documents(spark, sf_dir), benchmark, carry=("doc_id",))
    return found.select(F.col("record.doc_id").alias("doc_id"), F.explode("hits").alias("hit")).select("doc_id", "hit.*")


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text, read off the last prefix."""
    import public_tokenizers

    docs = _documents(spark, sf_dir)
    counted = token_prefix.count_tokens(docs, str(public_tokenizers.path("word_bpe_49k.json")), carry=("doc_id",))
    return counted.select(
        F.col("record.doc_id").alias("doc_id"), "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit")
    )


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents without the lines that an earlier document has."""
    kept = line_dedup.remove_repeats(_documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two to four words of each language."""
    return collocations.collocations(_documents(spark, sf_dir))


def damaged(turns: DataFrame) -> DataFrame:
    """The rows of ``conversations`` with the faults that the hash of their place deals to them."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    dealt = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20
    text = F.when(dealt == 1, F.lit("")).when(dealt == 2, F.regexp_replace(blank("text"), "[.!?]", "")).otherwise(blank("text"))
    role = F.when(dealt == 4, F.lit("user")).otherwise(blank("role"))
    times = F.when(dealt == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))
    return turns.where(dealt != 0).select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(times).alias("_time")).drop("_time")


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults, cheapest edits and digest of the repaired rows of every damaged conversation."""
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    repaired = conversation_repair.repair(damaged(turns))
    found = (
        turns.select("conv_id").distinct()
        .unionByName(repaired.summary, allowMissingColumns=True)
        .unionByName(conversation_repair.digest(repaired.rows), allowMissingColumns=True)
    )
    numbers = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    empty = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"  # SHA-256 of nothing
    return found.groupBy("conv_id").agg(
        *[F.coalesce(F.max(c), F.lit(0)).cast("bigint").alias(c) for c in numbers],
        F.coalesce(F.max("audit"), F.lit("")).alias("audit"),
        F.coalesce(F.max("repaired_sha256"), F.lit(empty)).alias("repaired_sha256"),
    )


OP2_SQL = r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), g AS (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d),
h AS (SELECT doc_id, p, array_to_string(w[p:p + 12], ' ') AS s FROM g),
f AS (SELECT s, min(doc_id) AS least FROM h GROUP BY s),
c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS k FROM h JOIN f USING (s) WHERE least < doc_id),
r AS (SELECT doc_id, list(k) AS ks, count(*) AS n FROM c GROUP BY doc_id),
v AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
t AS (
  SELECT v.doc_id, string_agg(word, ' ' ORDER BY v.k) AS kept FROM v LEFT JOIN c ON c.doc_id = v.doc_id AND c.k = v.k
  WHERE c.k IS NULL GROUP BY v.doc_id
)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN r USING (doc_id) LEFT JOIN t USING (doc_id)
"""

OP4_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), g AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: array_to_string(w[i:i + 2], ' ')) END) AS s FROM d
), n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared FROM g a JOIN g b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * shared >= 85 * (nx.n + ny.n - shared)),
r AS (SELECT doc_id AS x, doc_id AS c FROM d UNION SELECT l.y, r.c FROM r JOIN l ON r.x = l.x),
m AS (SELECT x, min(c) AS c FROM r GROUP BY x)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id, doc_id = c AS kept
FROM d LEFT JOIN n USING (doc_id) JOIN m ON m.x = doc_id
"""

OP8_SQL = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT source, source_size, [3.0, 1.0, 2.0][1 + ((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT]::DOUBLE AS weight FROM s
), total AS (SELECT 1.5::DOUBLE * sum(source_size) AS words FROM s),
rounds AS (
  SELECT 0 AS k, (SELECT words FROM total) / (SELECT sum(weight) FROM w) AS lvl
  UNION ALL
  SELECT k + 1, ((SELECT words FROM total)
      - (SELECT coalesce(sum(2.0::DOUBLE * source_size), 0) FROM w WHERE lvl * weight >= 2.0::DOUBLE * source_size))
    / (SELECT sum(weight) FROM w WHERE lvl * weight < 2.0::DOUBLE * source_size)
  FROM rounds WHERE k < 60
), t AS (
  SELECT source, source_size, least(2.0::DOUBLE * source_size, (SELECT max(lvl) FROM rounds WHERE NOT isnan(lvl)) * weight) AS target FROM w
), r AS (
  SELECT doc_id, size, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
    row_number() OVER (PARTITION BY d.source ORDER BY size, doc_id) AS k
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, round(target, 6) AS target,
  (size * (floor(k * rate + 0.381966) - floor((k - 1) * rate + 0.381966)))::BIGINT AS taken,
  (floor(k * rate + 0.381966) - floor((k - 1) * rate + 0.381966))::INT AS copies
FROM r
"""

# Two substitutions leave one of three blocks of four words intact, so the windows are found by joining those.
OP9_SQL = r"""
WITH dw AS (
  SELECT doc_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\x00-\x7f])+') AS w FROM documents
), iw AS (
  SELECT item_id AS id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '(?:[0-9a-z]|[^\x00-\x7f])+') AS w FROM benchmark
), db AS (SELECT id, w, unnest(range(1, len(w) - 2)) AS p FROM dw),
ib AS (SELECT id, w, unnest(range(1, len(w) - 2)) AS p FROM iw),
cand AS (
  SELECT DISTINCT d.id AS doc_id, i.id AS item_id, d.p - o AS dp, i.p - o AS ip
  FROM (SELECT id, p, array_to_string(w[p:p + 3], ' ') AS g FROM db) d
  JOIN (SELECT id, p, array_to_string(w[p:p + 3], ' ') AS g FROM ib) i USING (g)
  CROSS JOIN (VALUES (0), (4), (8)) AS t(o)
  WHERE d.p - o >= 1 AND i.p - o >= 1
), win AS (
  SELECT c.doc_id, c.item_id, c.dp, c.ip FROM cand c JOIN dw d ON c.doc_id = d.id JOIN iw i ON c.item_id = i.id
  WHERE c.dp + 11 <= len(d.w) AND c.ip + 11 <= len(i.w)
    AND len(list_filter(range(0, 12), lambda k: d.w[c.dp + k] = i.w[c.ip + k])) >= 10
), covered AS (SELECT doc_id, item_id, unnest(range(dp - 1, dp + 11)) AS word FROM win)
SELECT doc_id, item_id, n_windows, n_words, first_word, last_word
FROM (SELECT doc_id, item_id, count(*)::INT AS n_windows FROM win GROUP BY ALL)
JOIN (SELECT doc_id, item_id, count(DISTINCT word)::INT AS n_words, min(word)::INT AS first_word, max(word)::INT AS last_word
      FROM covered GROUP BY ALL) USING (doc_id, item_id)
"""

OP11_SQL = r"""
WITH d AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS p FROM documents
), k AS (
  SELECT *, translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM d
), f AS (SELECT key, min(doc_id) AS first FROM k WHERE length(key) >= 10 GROUP BY key),
m AS (SELECT k.*, first IS NOT NULL AND first < doc_id AS gone FROM k LEFT JOIN f ON k.key = f.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY p) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP12_SQL = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents
), w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, m, array_to_string(w[i:i + m - 1], ' ') AS phrase FROM (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, (VALUES (1), (2), (3), (4)) AS t(m))),
f AS (SELECT lang, m, phrase, count(*) AS a FROM g GROUP BY ALL),
c AS (SELECT lang, m, phrase, a, string_split(phrase, ' ') AS w FROM f WHERE m > 1 AND a >= 30),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE m = 1 GROUP BY lang),
parts AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:m], ' ') AS tail FROM (SELECT *, unnest(range(1, m)) AS k FROM c)),
cut AS (
  SELECT p.lang, p.phrase, p.a, k, x.a AS l, y.a AS r, ((2000000::HUGEINT * p.a) // (x.a + y.a))::BIGINT AS score
  FROM parts p JOIN f x ON x.lang = p.lang AND x.phrase = p.head JOIN f y ON y.lang = p.lang AND y.phrase = p.tail
), best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inside AS (
  SELECT lang, array_to_string(w[i:i + s - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(1, m - s + 2)) AS i FROM (SELECT *, unnest(range(2, m)) AS s FROM c)) GROUP BY ALL
), alive AS (
  SELECT b.* FROM best b LEFT JOIN inside i ON i.lang = b.lang AND i.phrase = b.phrase
  WHERE most IS NULL OR 100::HUGEINT * most < 80::HUGEINT * b.a
), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM alive)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""

# The checksum is computed bit by bit; the recursion goes along the rows of each conversation.
OP13_SQL = r"""
WITH RECURSIVE place AS (
  SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations
), dealt AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(name, ''), lambda ch: ascii(ch)::BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)),
      4294967295::BIGINT) % 20 AS fate
  FROM place
), rows AS (
  SELECT conv_id, turn, CASE WHEN fate = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN fate = 1 THEN '' WHEN fate = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN fate = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM dealt WHERE fate <> 0
), numbered AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text)) AS k FROM rows
), faults AS (
  SELECT *, left(role, 1) AS initial,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*\z') THEN 'truncated' ELSE '' END AS fault,
    left(lag(role) OVER (PARTITION BY conv_id ORDER BY k), 1) || left(role, 1) AS pair
  FROM numbered
), inserts(st, m, mid) AS (VALUES (0,0,0),(0,1,2),(0,2,3),(1,0,1),(1,1,2),(1,2,3),(2,0,2),(2,1,3),(2,2,2),(3,0,3),(3,1,2),(3,2,3)),
letters(letter) AS (VALUES ('D'), ('R'), ('K')),
edits AS (
  SELECT conv_id, k, st, CASE WHEN letter = 'D' THEN mid WHEN letter = 'K' AND initial = 's' THEN 1 WHEN mid = 2 THEN 3 ELSE 2 END AS nst,
    m * 3 + CASE letter WHEN 'D' THEN 4 WHEN 'R' THEN 3 ELSE 0 END + CASE WHEN letter <> 'D' AND fault = 'truncated' THEN 3 ELSE 0 END AS c,
    repeat('I', m) || letter AS s
  FROM faults, inserts, letters
  WHERE letter = 'D' OR (fault IN ('', 'truncated') AND (letter = 'R' OR (initial = 's' AND mid = 0) OR (initial = 'u' AND mid <> 2) OR (initial = 'a' AND mid = 2)))
), dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS k, 0 AS st, {'c': 0::BIGINT, 's': ''} AS best FROM faults
  UNION ALL
  SELECT p.conv_id, p.k + 1, e.nst, min({'c': p.best.c + e.c, 's': p.best.s || e.s})
  FROM dp p JOIN edits e ON e.conv_id IS NOT DISTINCT FROM p.conv_id AND e.k = p.k + 1 AND e.st = p.st
  GROUP BY p.conv_id, p.k + 1, e.nst
), ends AS (
  SELECT dp.conv_id, min({'c': best.c + CASE st WHEN 1 THEN 6 WHEN 2 THEN 3 ELSE 0 END, 's': best.s || CASE st WHEN 1 THEN 'II' WHEN 2 THEN 'I' ELSE '' END}) AS best
  FROM dp JOIN (SELECT conv_id, max(k) AS n FROM faults GROUP BY conv_id) l ON l.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.k = l.n
  GROUP BY dp.conv_id
), steps AS (
  SELECT conv_id, unnest(string_split(best.s, '')) AS letter, generate_subscripts(string_split(best.s, ''), 1) AS p FROM ends
), counted AS (
  SELECT *, sum((letter <> 'I')::INT) OVER w AS k, sum((letter <> 'D')::INT) OVER w AS o FROM steps WINDOW w AS (PARTITION BY conv_id ORDER BY p)
), kept AS (
  SELECT c.conv_id, c.p, c.o, c.letter, f.role, f.text,
    max((c.o = 1 AND c.letter = 'K' AND f.initial = 's')::INT) OVER (PARTITION BY c.conv_id) AS led
  FROM counted c LEFT JOIN faults f ON f.conv_id IS NOT DISTINCT FROM c.conv_id AND f.k = c.k AND c.letter <> 'I' WHERE c.letter <> 'D'
), repaired AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (o - led) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY p)) AS digest
  FROM kept GROUP BY conv_id
), sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
    count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair IS NOT NULL AND pair NOT IN ('su', 'ua', 'au')) AS illegal
  FROM faults GROUP BY conv_id
)
SELECT i.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated,
  coalesce(illegal, 0)::BIGINT AS illegal, coalesce(best.c, 0)::BIGINT AS cost, coalesce(best.s, '') AS audit, coalesce(digest, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i LEFT JOIN sums ON sums.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN ends ON ends.conv_id IS NOT DISTINCT FROM i.conv_id LEFT JOIN repaired ON repaired.conv_id IS NOT DISTINCT FROM i.conv_id
"""

QUERIES = {"op1_sharding": op1_sharding, "op2_substring_dedup": op2_substring_dedup, "op3_suffix_dedup": op3_suffix_dedup, "op4_near_duplicates": op4_near_duplicates, "op5_language_model": op5_language_model, "op6_toxicity": op6_toxicity, "op7_neighbours": op7_neighbours, "op8_mixing": op8_mixing, "op9_decontamination": op9_decontamination, "op10_token_counts": op10_token_counts, "op11_line_dedup": op11_line_dedup, "op12_collocations": op12_collocations, "op13_conversation_repair": op13_conversation_repair}
ORACLES = {"op2_substring_dedup": OP2_SQL, "op4_near_duplicates": OP4_SQL, "op8_mixing": OP8_SQL, "op9_decontamination": OP9_SQL, "op11_line_dedup": OP11_SQL, "op12_collocations": OP12_SQL, "op13_conversation_repair": OP13_SQL}


def queries() -> dict:
    import corpus_pipeline

    return QUERIES | {"pipeline": corpus_pipeline.run}


def oracles() -> dict[str, str]:
    return ORACLES
