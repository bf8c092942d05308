"""The operators of this package as registered queries, and their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.llm import byte_pairs, quality_votes
from vitrine.llm.contamination import find_contamination
from vitrine.llm.fill_middle import fill_in_middle, restored
from vitrine.llm.language import identify, is_held_out, train
from vitrine.llm.main_text import extract_main_text
from vitrine.llm.pieces import encode
from vitrine.llm.repeated_bytes import remove_repeated_bytes
from vitrine.llm.repeated_words import remove_repeated_words
from vitrine.llm.resampling import resample
from vitrine.llm.similar_sets import similar_groups
from vitrine.llm.tool_calls import canonical, link
from vitrine.llm.turn_repair import digests, repair


# A parameter: the tokenizer files are installed beside the library, never in it.
PIECE_MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_main_text(spark: SparkSession, folder: str) -> DataFrame:
    """Main text of every page."""
    return extract_main_text(_table(spark, folder, "pages"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Words left after removing 13-word windows an earlier document has."""
    result = remove_repeated_words(_table(spark, folder, "documents"), window=13)
    return result.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Words of each document that lie in a 10-word window of a benchmark item."""
    result = find_contamination(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark"), window=10, keep_text=False
    )
    return result.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op4_ngram_jaccard(spark: SparkSession, folder: str) -> DataFrame:
    """Connected documents whose 5-word shingle sets have a Jaccard similarity of 0.8 or more."""
    return similar_groups(_table(spark, folder, "documents"), words=5, percent=80)


def op5_language_id(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every document, learned from those that aren't held out."""
    docs = _table(spark, folder, "documents")
    model = train(docs.filter(~is_held_out()))
    return identify(docs, model).select(
        "doc_id", is_held_out().alias("held_out"), "lang_pred", "score", "rejected"
    )


def op6_importance_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Every document's importance for texts labelled good, and whether it is drawn."""
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    good = labels.filter("quality = 1 AND toxic = 0").select("doc_id").distinct()
    # merged at any size, because the labels grow with the documents
    return resample(docs, docs.join(good.hint("merge"), "doc_id", "left_semi"))


def op7_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document, and whether decoding gives it back."""
    return encode(_table(spark, folder, "documents"), PIECE_MODEL)


def op8_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counted features of every document, and whether it is kept."""
    return quality_votes.judge(_table(spark, folder, "documents")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "posterior",
    )


_TURN_SCHEMA = canonical(
    {
        "type": "object",
        "required": ["text"],
        "properties": {"text": {"type": "string"}, "after": {"type": "string"}},
        "additionalProperties": False,
    }
)


def op9_tool_calls(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations as tool calls: what is said to the assistant calls it, its next turn is the result.

    The call's id is its turn; it depends on the call two turns before.
    """
    turns = _table(spark, folder, "conversations").withColumn("turn", F.col("turn").cast("long"))
    said = F.struct(F.struct((F.col("turn") - 2).cast("string").alias("$ref")).alias("after"), "text")
    calls = turns.filter("role <> 'assistant'").select(
        "conv_id",
        "turn",
        F.lit(0).alias("position"),
        F.col("turn").cast("string").alias("call_id"),
        F.when(F.col("role") == "system", "instruct").otherwise("reply").alias("name"),
        F.to_json(said).alias("arguments"),
        F.array((F.col("turn") - 2).cast("string")).alias("refs"),
    )
    results = turns.filter("role = 'assistant'").select(
        "conv_id", "turn", (F.col("turn") - 1).cast("string").alias("call_id"), F.col("text").alias("content")
    )
    schemas = spark.range(2).select(
        F.when(F.col("id") == 0, "reply").otherwise("instruct").alias("name"), F.lit(_TURN_SCHEMA).alias("schema")
    )
    result = link(calls, results, schemas)
    return result.withColumn("errors", F.array_join("errors", ";"))


def op10_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Bytes left after removing 200-byte strings that occur more than once."""
    result = remove_repeated_bytes(_table(spark, folder, "documents"), length=200)
    return result.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op11_fill_middle(spark: SparkSession, folder: str) -> DataFrame:
    """Every document cut at two line ends, its middle put last; and what it gives when put back."""
    result = fill_in_middle(_table(spark, folder, "documents"), seed=7, rate=100, suffix_first=50)
    return result.select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(F.col("form"), F.col("output")), 256).alias("restored_sha256"),
    )


def op12_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    """Token ids of every document, and the bytes they decode to."""
    import public_tokenizers

    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    result = byte_pairs.encode(_table(spark, folder, "documents"), ranks, public_tokenizers.PATTERN, decoded=True)
    return result.select(
        "doc_id",
        "n_tokens",
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def _damaged(turns: DataFrame) -> DataFrame:
    """Conversations with one row in twenty each dropped, emptied, cut off, repeated, or given to the user."""
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.lit(":"),
                   F.coalesce(F.col("turn").cast("string"), F.lit(" ")))
    role, text = (F.coalesce(name, F.lit(" ")) for name in ("role", "text"))
    damage = F.crc32(key) % 20
    return turns.filter(damage != 0).select(
        "conv_id",
        "turn",
        F.when(damage == 4, "user").otherwise(role).alias("role"),
        F.when(damage == 1, "").when(damage == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        F.explode(F.when(damage == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy"),
    )


def op13_turn_repair(spark: SparkSession, folder: str) -> DataFrame:
    """Every conversation, damaged and repaired: its faults, the cheapest edits and a digest of what they leave."""
    turns = _table(spark, folder, "conversations")
    repaired = repair(_damaged(turns))
    found = repaired.conversations.withColumnRenamed("conv_id", "found")
    lines = digests(repaired.turns).withColumnRenamed("conv_id", "kept")
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return (
        turns.select("conv_id").distinct()
        .join(found, F.expr("conv_id <=> found"), "left")
        .join(lines, F.expr("conv_id <=> kept"), "left")
        .select(
            "conv_id",
            *(F.coalesce(F.col(name).cast("long"), F.lit(0).cast("long")).alias(name) for name in counts),
            F.coalesce("audit", F.lit("")).alias("audit"),
            F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
        )
    )


QUERIES = {
    f.__name__: f
    for f in (
        op1_main_text,
        op2_substring_dedup,
        op3_decontamination,
        op4_ngram_jaccard,
        op5_language_id,
        op6_importance_resampling,
        op7_sentencepiece,
        op8_quality_rules,
        op9_tool_calls,
        op10_suffix_dedup,
        op11_fill_middle,
        op12_byte_bpe,
        op13_turn_repair,
    )
}



def _edited(state: str, cost: str, letter: str, line: str = "") -> str:
    """SQL of a state's cost, edits and lines after one more edit."""
    lines = f"list_append({state}.t, {line})" if line else f"{state}.t"
    return f"{{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {lines}}}"


def _least(*states: str) -> str:
    return f"list_min([{', '.join(states)}])"


def _entered(kind: str, name: str, *origins: str) -> str:
    """SQL of all ways into a state from ``origins`` by keeping a row or giving it the role ``name``."""
    ways = [_edited(o, f"{cost}", letter, line) for o in origins for cost, letter, line in (
        (f"extra + CASE WHEN kind = '{kind}' THEN 0 ELSE 1000000000 END", "K", "role || ':' || text"),
        ("extra + 3", "R", f"'{name}:' || text"),
    )]
    return ", ".join(ways)


_ASCII_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES = {
    "op2_substring_dedup": r"""
WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i:i + 12], ' ')) AS h
  FROM d, unnest(range(1, len(w) - 11)) AS u(i)
), firsts AS (
  SELECT h, min(doc_id) AS first_doc FROM windows GROUP BY h
), gone AS (
  SELECT DISTINCT doc_id, i + k AS pos
  FROM windows JOIN firsts USING (h), range(13) AS r(k)
  WHERE first_doc < doc_id
), words AS (
  SELECT doc_id, pos, w[pos] AS word FROM d, unnest(range(1, len(w) + 1)) AS u(pos)
), kept AS (
  SELECT doc_id, count(g.pos) AS n_removed,
         string_agg(word, ' ' ORDER BY words.pos) FILTER (WHERE g.pos IS NULL) AS kept_text
  FROM words LEFT JOIN gone g USING (doc_id, pos) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept_text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op3_decontamination": rf"""
WITH d AS (
  SELECT doc_id,
         coalesce(regexp_extract_all({_ASCII_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM documents
), b AS (
  SELECT CAST(item_id AS VARCHAR) AS item,
         coalesce(regexp_extract_all({_ASCII_LOWER.format('text')}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
  FROM benchmark
), items AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS phrase
  FROM b, unnest(range(1, greatest(len(w) - 9, least(len(w), 1)) + 1)) AS u(i)
), lengths AS (
  SELECT DISTINCT n FROM items
), windows AS (
  SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM d, lengths, unnest(range(1, greatest(len(w) - n + 2, 1))) AS u(i)
), hits AS (
  SELECT doc_id, i, n, item FROM windows JOIN items USING (n, phrase)
), by_doc AS (
  SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS named
  FROM hits GROUP BY doc_id
), hit_words AS (
  SELECT doc_id, count(DISTINCT i + k) AS n_hit
  FROM hits, unnest(range(n)) AS r(k) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(named, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN by_doc USING (doc_id) LEFT JOIN hit_words USING (doc_id)
""",
    "op4_ngram_jaccard": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x20\x09-\x0D]+'), []) AS w
  FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
  FROM d, unnest(range(1, greatest(len(w) - 4, least(len(w), 1)) + 1)) AS u(i)
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y
  FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id
  JOIN sizes p ON p.doc_id = a.doc_id JOIN sizes q ON q.doc_id = b.doc_id
  GROUP BY a.doc_id, b.doc_id, p.n, q.n
  HAVING 100 * count(*) >= 80 * (p.n + q.n - count(*))
), reached AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT doc_id, y FROM reached JOIN links ON other = x
)
SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, component_id
FROM (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id) LEFT JOIN sizes USING (doc_id)
""",
    "op9_tool_calls": r"""
WITH calls AS (
  SELECT conv_id, turn, CASE WHEN role = 'system' THEN 'instruct' ELSE 'reply' END AS name, text
  FROM conversations WHERE role <> 'assistant'
), results AS (
  SELECT conv_id, turn, turn - 1 AS call_turn, text FROM conversations WHERE role = 'assistant'
)
SELECT c.conv_id, CAST(c.turn AS VARCHAR) AS call_id, CAST(c.turn AS BIGINT) AS turn, 0 AS position,
       CASE WHEN r.turn IS NULL THEN 'unanswered' ELSE 'linked' END AS status,
       CAST(c.turn AS BIGINT) AS after_turn, 0 AS after_steps, '' AS errors,
       '{"call":{"arguments":{"after":{"$ref":"' || (c.turn - 2) || '"},"text":' || CAST(to_json(c.text) AS VARCHAR)
       || '},"id":"' || c.turn || '","name":"' || name || '"},"result":'
       || coalesce(CAST(to_json(r.text) AS VARCHAR), 'null') || '}' AS json
FROM calls c LEFT JOIN results r ON r.conv_id = c.conv_id AND r.call_turn = c.turn
UNION ALL
SELECT r.conv_id, CAST(r.call_turn AS VARCHAR), CAST(r.turn AS BIGINT), 0, 'orphan', CAST(r.turn AS BIGINT), 0, '',
       '{"content":' || CAST(to_json(r.text) AS VARCHAR) || ',"role":"tool","tool_call_id":"' || r.call_turn || '"}'
FROM results r LEFT JOIN calls c ON r.conv_id = c.conv_id AND r.call_turn = c.turn
WHERE c.turn IS NULL
""",
    "op10_suffix_dedup": r"""
WITH d AS (
  SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents
), windows AS (
  SELECT doc_id, i, md5(substr(x, 2 * i + 1, 400)) AS h FROM d, unnest(range(length(x) // 2 - 199)) AS u(i)
), counted AS (
  SELECT doc_id, i, count(*) OVER (PARTITION BY h) AS n FROM windows
), starts AS (
  SELECT doc_id, i, i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS step FROM counted WHERE n > 1
), numbered AS (
  SELECT doc_id, i, sum(CASE WHEN step <= 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS span FROM starts
), spans AS (
  SELECT doc_id, span, min(i) AS a, max(i) + 200 AS b FROM numbered GROUP BY doc_id, span
), gaps AS (
  SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS before FROM spans
), kept AS (
  SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last,
         string_agg(substr(x, CAST(2 * before + 1 AS BIGINT), CAST(2 * (a - before) AS BIGINT)), '' ORDER BY a) AS head
  FROM gaps JOIN d USING (doc_id) GROUP BY doc_id
)
SELECT doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(unhex(coalesce(head, '') || substr(x, CAST(2 * coalesce(last, 0) + 1 AS BIGINT)))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
""",
    "op11_fill_middle": r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\n]*\n|[^\n]+') AS u,
         sha256('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), draws AS (
  SELECT *, len(u) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d
), cuts AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain'
              WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM draws
), parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(u[b + 1:n], ''), '') AS s
  FROM cuts
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form,
       CASE WHEN form <> 'plain' THEN CAST(length(p) AS BIGINT) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN CAST(length(m) AS BIGINT) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
""",
    "op13_turn_repair": rf"""
WITH RECURSIVE bytes AS (
  SELECT list(list_reduce([n] || range(8), lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)
              ORDER BY n) AS t
  FROM range(256) AS r(n)
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '),
                                     ''), lambda x: ord(x)) AS k
  FROM conversations
), drawn AS (
  SELECT conv_id, turn, role, text,
         xor(list_reduce([4294967295] || CAST(k AS BIGINT[]), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS d
  FROM keyed, bytes
), damaged AS (
  SELECT conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
         CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM drawn, range(CASE WHEN d = 3 THEN 2 ELSE 1 END) WHERE d <> 0
), placed AS (
  SELECT *, dense_rank() OVER (ORDER BY conv_id) AS conv,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
         rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed
  FROM damaged
), judged AS (
  SELECT *, role[1] AS kind,
         CASE WHEN trimmed = '' THEN 'blank'
              WHEN row_number() OVER (PARTITION BY conv, role, text ORDER BY i) > 1 THEN 'duplicate'
              WHEN NOT regexp_matches(trimmed, '[.!?]$') THEN 'truncated' ELSE '' END AS fault,
         coalesce(lag(role[1]) OVER (PARTITION BY conv ORDER BY i) || role[1] NOT IN ('su', 'ua', 'au'), false) AS illegal
  FROM placed
), steps AS (
  SELECT conv, i, role, text, kind,
         CASE WHEN fault IN ('blank', 'duplicate') THEN 2000000000 WHEN fault = 'truncated' THEN 3 ELSE 0 END AS extra
  FROM judged
), costs AS (
  SELECT conv, CAST(0 AS BIGINT) AS i, {{'c': CAST(0 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])}} AS n,
         {{'c': CAST(1000000000 AS BIGINT), 'a': '', 't': CAST([] AS VARCHAR[])}} AS s,
         {{'c': CAST(3 AS BIGINT), 'a': 'I', 't': ['user:']}} AS u,
         {{'c': CAST(6 AS BIGINT), 'a': 'II', 't': ['user:', 'assistant:']}} AS a
  FROM (SELECT DISTINCT conv FROM steps)
  UNION ALL
  SELECT conv, i, n, s, u, {_least("a", _edited("u", "3", "I", "'assistant:'"))}
  FROM (
    SELECT conv, i, n, s, a, {_least("u", *(_edited(o, "3", "I", "'user:'") for o in "nsa"))} AS u
    FROM (
      SELECT conv, steps.i, {_edited("n", "4", "D")} AS n,
             {_least(_edited("s", "4", "D"), _edited("n", "extra + CASE WHEN kind = 's' THEN 0 ELSE 1000000000 END", "K", "role || ':' || text"))} AS s,
             {_least(_edited("u", "4", "D"), _entered("u", "user", "n", "s", "a"))} AS u,
             {_least(_edited("a", "4", "D"), _entered("a", "assistant", "u"))} AS a
      FROM costs JOIN steps USING (conv) WHERE steps.i = costs.i + 1
    )
  )
), counted AS (
  SELECT conv, any_value(conv_id) AS conv_id, max(i) AS i,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (illegal) AS illegal
  FROM judged GROUP BY conv
), repaired AS (
  SELECT counted.*, {_least("n", "a")} AS best FROM counted JOIN costs USING (conv, i)
)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, CAST(coalesce(blank, 0) AS BIGINT) AS blank,
       CAST(coalesce(duplicate, 0) AS BIGINT) AS duplicate, CAST(coalesce(truncated, 0) AS BIGINT) AS truncated,
       CAST(coalesce(illegal, 0) AS BIGINT) AS illegal, CAST(coalesce(best.c, 0) AS BIGINT) AS cost,
       coalesce(best.a, '') AS audit, sha256(coalesce(array_to_string(best.t, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS o LEFT JOIN repaired ON o.conv_id IS NOT DISTINCT FROM repaired.conv_id
""",
}
