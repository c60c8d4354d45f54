"""Registered queries of the training-data operators, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from . import byte_bpe, chat_format, decontaminate, line_dedup, mpeg_audio, near_duplicates, prefix_trie, quality, repeated_spans, token_counts, toxicity, turn_repair, word_bpe
from .common import table


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = repeated_spans.remove_repeated_spans(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = token_counts.zipf_scores(byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_50k.tiktoken")))
    return token_counts.token_counts(table(spark, sf_dir, "documents"), scores, public_tokenizers.PATTERN)


def op4_mpeg_audio(spark: SparkSession, sf_dir: str) -> DataFrame:
    read = mpeg_audio.describe_media(mpeg_audio.to_media(table(spark, sf_dir, "documents")))
    feature = F.concat_ws(
        ";",
        *(F.concat(F.lit(f"{name}="), F.col(name).cast("string")) for name in ("frames", "samples", "hz", "bad_checksums", "foreign_bytes", "table_frames", "least_kbits", "most_kbits")),
        F.concat(F.lit("offsets_sha256="), F.sha2(F.array_join(F.col("offsets").cast("array<string>"), ","), 256)),
    )
    return read.select("doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", feature.alias("feature"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.range(2).select(F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(added)
    out = chat_format.format_records(chat_format.conversation_records(rows), paths="paths")
    out = out.select("conv_id", "formatted", "loss_spans", chat_format.read_turns(F.col("formatted")).alias("turns"), chat_format.masked_text(F.col("formatted"), F.col("loss_spans")).alias("masked"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(lines, 256).alias("turns_sha256"),
        F.length("masked").cast("long").alias("loss_chars"),
        F.sha2("masked", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.remove_repeated_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("n_gone").cast("long").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_benchmark(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("found") > 0).alias("contaminated"), F.col("found.item_id").alias("item_ids"), F.col("found.edits").alias("edits"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.score_toxicity(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op10_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = byte_bpe.read_ranks(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"))
    return byte_bpe.encode_digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op11_word_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_bpe.encode_digests(table(spark, sf_dir, "documents"), word_bpe.read_vocabulary(public_tokenizers.path("word_bpe_49k.json")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return turn_repair.repair_damaged(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_token_counts": op3_token_counts,
    "op4_mpeg_audio": op4_mpeg_audio,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_chat_format": op6_chat_format,
    "op7_line_dedup": op7_line_dedup,
    "op8_decontamination": op8_decontamination,
    "op9_toxicity": op9_toxicity,
    "op10_byte_bpe": op10_byte_bpe,
    "op11_word_bpe": op11_word_bpe,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_turn_repair": op13_turn_repair,
}


def _escaped(text: str) -> str:
    out = f"replace({text}, '\\', '\\\\')"
    for c in chat_format.CONTROL:
        out = f"replace({out}, '{c}', '{c[0]}\\{c[1:]}')"
    return out


OP6_SQL = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]')
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length({_escaped("role")}) + length({_escaped("text")}) + {len(chat_format.START) + len(chat_format.END) + 2}) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""
#: Lines within one edit agree in their first or last 7 of at least 16 characters.
OP7_SQL = r"""
WITH lines AS (
  SELECT doc_id, pos, trim(p, ' ' || chr(9) || chr(13) || chr(11) || chr(12)) AS line FROM (
    SELECT doc_id, unnest(string_split(text, chr(10))) AS p, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM documents)),
firsts AS (SELECT line, min(doc_id * 1000000 + pos) AS first FROM lines WHERE line <> '' GROUP BY line),
long AS (SELECT * FROM firsts WHERE length(line) >= 16),
pairs AS (
  SELECT a.line, a.first, b.line AS other FROM long a JOIN long b ON left(a.line, 7) = left(b.line, 7) WHERE b.first < a.first AND abs(length(a.line) - length(b.line)) <= 1
  UNION SELECT a.line, a.first, b.line FROM long a JOIN long b ON right(a.line, 7) = right(b.line, 7) WHERE b.first < a.first AND abs(length(a.line) - length(b.line)) <= 1),
edited AS (SELECT DISTINCT line FROM pairs WHERE levenshtein(line, other) <= 1),
judged AS (
  SELECT l.doc_id, l.pos, l.line <> '' AND (e.line IS NOT NULL OR f.first < l.doc_id * 1000000 + l.pos) AS gone
  FROM lines l LEFT JOIN firsts f ON l.line = f.line LEFT JOIN edited e ON l.line = e.line),
kept AS (
  SELECT j.doc_id, count(*) FILTER (WHERE gone) AS n_removed,
    coalesce(string_agg(string_split(d.text, chr(10))[j.pos], chr(10) ORDER BY j.pos) FILTER (WHERE NOT gone), '') AS text
  FROM judged j JOIN documents d ON j.doc_id = d.doc_id GROUP BY j.doc_id)
SELECT doc_id, n_removed, sha256(text) AS kept_sha256 FROM kept
"""


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of an ASCII string: eight steps a byte over the reflected polynomial."""
    step = "list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))"
    codes = f"list_transform(string_split({text}, ''), lambda c: CAST(ascii(c) AS BIGINT))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {codes}), lambda a, b: {step}), 4294967295)"


_COUNT_WORDS = r"len(regexp_extract_all(text, '[^\x20\x09-\x0D]+'))"
#: A prefix is the joined MD5 of its turns, 32 characters each.
OP12_SQL = f"""
WITH filled AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
turns AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM filled),
convs AS (SELECT conv_id, {_crc32("CAST(conv_id AS VARCHAR)")} % 4 AS h, conv_id - conv_id % 20 AS lender FROM (SELECT DISTINCT conv_id FROM turns)),
parts AS (
  SELECT c.conv_id, 0 AS part, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.lender WHERE pos <= h
  UNION ALL SELECT c.conv_id, 1, pos, role, text FROM convs c JOIN turns t ON t.conv_id = c.conv_id WHERE pos > h),
lists AS (SELECT conv_id, list(md5(length(role) || ':' || role || text) ORDER BY part, pos) AS turns, list({_COUNT_WORDS} ORDER BY part, pos) AS words FROM parts GROUP BY conv_id),
rebuilt AS (SELECT c.conv_id, coalesce(turns, []) AS turns, coalesce(words, []) AS words FROM convs c LEFT JOIN lists l ON l.conv_id = c.conv_id),
members AS (SELECT conv_id, d, array_to_string(turns[1:d], '') AS prefix, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS w, d = len(turns) AS ended FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT prefix, min(d) AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, (count(*) - 1) * min(w) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE ended), '')) AS ends_sha256
  FROM members GROUP BY prefix),
kids AS (SELECT prefix[:32 * (depth - 1)] AS prefix, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1),
tree AS (SELECT n.*, coalesce(k.n, 0) AS n_children FROM nodes n LEFT JOIN kids k ON k.prefix = n.prefix),
totals AS (
  SELECT prefix[:32 * d] AS prefix, count(*) FILTER (WHERE n_children = 0) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, depth + 1)) AS d FROM tree) GROUP BY 1)
SELECT t.conv_id, t.depth, p.conv_id AS parent_conv_id, t.n_convs, t.n_children, n_leaves, saved_tokens, t.ends_sha256
FROM tree t JOIN totals s ON s.prefix = t.prefix LEFT JOIN nodes p ON t.depth > 0 AND p.prefix = t.prefix[:32 * (t.depth - 1)]
"""


def _edited(state: str, cost: str, letter: str) -> str:
    """A state's cost, eight digits, and audit with an edit before it; least() then compares costs, then audits."""
    return f"lpad(CAST(CAST({state}[:8] AS BIGINT) + {cost} AS VARCHAR), 8, '0') || '{letter}' || {state}[9:]"


def _taken(start: str, letter: str, after: str) -> str:
    keep = lambda initial, state: f"CASE WHEN NOT lost AND initial = '{initial}' THEN {_edited(state, 'cut', 'K')} ELSE '99999999' END"
    also = f", {keep('s', 'c1')}" if start == "c0" else ""
    return f"least({_edited(start, '2', 'D')}, {keep(letter, after)}, CASE WHEN NOT lost THEN {_edited(after, 'cut + 1', 'R')} ELSE '99999999' END{also})"


_SPACED = r"[\x20\x09-\x0D]"
#: The costs of the grammar's four states (c0 nothing, c1 s, c2 u, c3 ua), from the last turn back.
OP13_SQL = f"""
WITH RECURSIVE dealt AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {_crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind FROM conversations),
rows AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role, CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(CASE WHEN kind = 3 THEN [0, 1] ELSE [0] END) AS copy FROM dealt WHERE kind > 0),
placed AS (
  SELECT *, role[:1] AS initial, row_number() OVER w AS pos, lag(role[:1]) OVER w AS led,
    row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again
  FROM rows WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
faults AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN again THEN 'duplicate' WHEN NOT regexp_matches(text, '[.!?]{_SPACED}*\\z') THEN 'truncated' END AS fault FROM placed),
judged AS (SELECT *, coalesce(fault IN ('blank', 'duplicate'), false) AS lost, CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END AS cut FROM faults),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE fault = 'blank') AS blank, count(*) FILTER (WHERE fault = 'duplicate') AS duplicate,
    count(*) FILTER (WHERE fault = 'truncated') AS truncated, count(*) FILTER (WHERE led IS NOT NULL AND led || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
states(conv_id, i, c0, c1, c2, c3) AS (
  SELECT conv_id, n, '00000000', '00000010II', '00000005I', '00000000' FROM counts
  UNION ALL SELECT conv_id, i - 1, least(b0, {_edited("c2", "5", "I")}), least(b1, {_edited("c2", "5", "I")}), c2, c3
  FROM (SELECT conv_id, i, b0, b1, least(b2, {_edited("b3", "5", "I")}) AS c2, least(b3, {_edited("b2", "5", "I")}) AS c3
    FROM (SELECT s.conv_id, i, {_taken("c0", "u", "c2")} AS b0, {_taken("c1", "u", "c2")} AS b1, {_taken("c2", "a", "c3")} AS b2, {_taken("c3", "u", "c2")} AS b3
      FROM states s JOIN judged j ON j.conv_id IS NOT DISTINCT FROM s.conv_id AND j.pos = s.i))),
audits AS (SELECT conv_id, CAST(c0[:8] AS BIGINT) AS cost, c0[9:] AS audit FROM states WHERE i = 0),
letters AS (SELECT conv_id, letter, idx, count(*) FILTER (WHERE letter <> 'I') OVER w AS pos, count(*) FILTER (WHERE letter <> 'D') OVER w AS place
  FROM (SELECT conv_id, unnest(string_split(audit, '')) AS letter, generate_subscripts(string_split(audit, ''), 1) AS idx FROM audits WHERE audit <> '') WINDOW w AS (PARTITION BY conv_id ORDER BY idx)),
edits AS (SELECT l.*, j.role, j.text, bool_or(letter = 'K' AND initial = 's') OVER (PARTITION BY l.conv_id) AS led FROM letters l LEFT JOIN judged j ON letter <> 'I' AND j.conv_id IS NOT DISTINCT FROM l.conv_id AND j.pos = l.pos),
lines AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN letter = 'K' THEN role WHEN (place % 2 = 1) = led THEN 'assistant' ELSE 'user' END || ':' || CASE WHEN letter = 'I' THEN '' ELSE text END, chr(10) ORDER BY idx)) AS repaired_sha256
  FROM edits WHERE letter <> 'D' GROUP BY conv_id)
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit,
  coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN counts n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN audits a ON a.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN lines l ON l.conv_id IS NOT DISTINCT FROM c.conv_id
"""

ORACLES: dict[str, str] = {"op6_chat_format": OP6_SQL, "op7_line_dedup": OP7_SQL, "op12_prefix_trie": OP12_SQL, "op13_turn_repair": OP13_SQL}
