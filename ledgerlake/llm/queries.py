"""One query per operator over its whole table, with SQL where SQL can express it.

The queries are thin: they call the operator and derive the digest columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@register("op1_mix_sources")
def op1(spark, sf):
    """Mix of all documents: 150% of all words, weights 3, 1, 2, two epochs at most."""
    from ledgerlake.llm.mixing import mix_plan
    plan = mix_plan(table(spark, sf, "documents"))
    return plan.select("doc_id", "size", "source_size", "target", "taken",
                       F.coalesce(F.size("pieces"), F.lit(0)).alias("n_pieces"),
                       F.col("pieces").getItem(0).getField("shard").alias("first_shard"))


@register("op8_feistel_shards")
def op8(spark, sf):
    """All documents in 40 shards by the law ``rows``."""
    from ledgerlake.llm.sharding import shard_documents
    return shard_documents(table(spark, sf, "documents"), shards=40)


@register("op10_token_counts")
def op10(spark, sf):
    """Tokens of every document under the public 50k byte-level vocabulary."""
    import public_tokenizers
    from ledgerlake.llm.token_count import count_tokens
    return count_tokens(table(spark, sf, "documents"), str(public_tokenizers.path("byte_bpe_50k.json")), 512)


@register("op3_quality_nbsvm")
def op3(spark, sf):
    """Quality of every document."""
    from ledgerlake.llm.quality import classify
    return classify(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register("op4_toxicity_grades")
def op4(spark, sf):
    """Severity of every document."""
    from ledgerlake.llm.toxicity import grade_documents
    return grade_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))


@register("op5_warc_revisits", """
SELECT page_id, payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN original END AS refers_to
FROM (SELECT *, payload_bytes >= 100 AND page_id > original AS again
      FROM (SELECT page_id, cast(strlen(coalesce(html, '')) AS bigint) AS payload_bytes,
                   sha256(coalesce(html, '')) AS payload_digest,
                   min(page_id) OVER (PARTITION BY coalesce(html, '')) AS original FROM pages))""")
def op5(spark, sf):
    """All pages written as WARC archives with revisits, and read back."""
    from ledgerlake.llm.common import scratch
    from ledgerlake.llm.warc import archive_pages
    return archive_pages(table(spark, sf, "pages"), scratch(spark, "warc"))


@register("op6_simhash_near_dedup")
def op6(spark, sf):
    """SimHash components of all documents: 3-word shingles, two bits."""
    from ledgerlake.llm.simhash import near_duplicates
    return near_duplicates(table(spark, sf, "documents")).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op7_exact_dedup_stream", r"""
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256
FROM (SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size, sha256(norm) AS text_sha256
      FROM (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
      WINDOW same AS (PARTITION BY norm))""")
def op7(spark, sf):
    """Exact duplicates of all documents, through a stream with keyed state."""
    from ledgerlake.llm.exact_dedup import exact_dedup
    return exact_dedup(spark, f"{sf}/documents.parquet")


@register("op2_decontamination")
def op2(spark, sf):
    """Passages of benchmark items in all documents."""
    from ledgerlake.llm.decontamination import find_contamination
    return find_contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"))


@register("op9_suffix_dedup")
def op9(spark, sf):
    """Bytes of all documents without the 50-byte strings that an earlier document holds."""
    from ledgerlake.llm.suffix_dedup import remove_repeats
    return remove_repeats(table(spark, sf, "documents"), 50)


@register("op13_pack_sequences")
def op13(spark, sf):
    """Pieces of all documents in sequences of at most 2048 tokens of the public 49k vocabulary."""
    import public_tokenizers
    from ledgerlake.llm.packing import pack_documents
    return pack_documents(table(spark, sf, "documents"), str(public_tokenizers.path("word_bpe_49k.json")), 2048)


@register("op11_lexical_search", r"""
WITH words AS (
  SELECT doc_id, pos, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT *, row_number() OVER () AS pos FROM documents)),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
sizes AS (SELECT pos, doc_id, count(*) AS n FROM words GROUP BY ALL),
whole AS (SELECT cast(count(*) AS bigint) AS n_docs, cast(sum(n) AS bigint) AS n_terms FROM sizes),
counts AS (SELECT pos, term, count(*) AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY ALL),
weights AS (SELECT term, cast(floor(1000 * ln((2 * n_docs + 2)::double / (2 * count(*) + 1)::double)) AS bigint) AS w
            FROM counts, whole GROUP BY term, n_docs),
scores AS (
  SELECT item_id, pos, doc_id, cast(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * n * n_docs) // n_terms)))) AS bigint) AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN sizes USING (pos), whole GROUP BY ALL)
SELECT item_id, cast(rank AS integer) AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0)
WHERE rank <= 50""")
def op11(spark, sf):
    """The 50 best documents of every benchmark item, over all documents."""
    from ledgerlake.llm.lexical import ranked
    return ranked(table(spark, sf, "documents"), table(spark, sf, "benchmark"), 50)


def _repair_sql() -> str:
    """DuckDB SQL of the conversation repair: a recursive step per row that carries the least
    (cost, audit, lines) of each of the four places in the pattern."""
    def least(*options: str) -> str:
        return f"list_min([{', '.join(options)}])"

    def add(place: str, cost: str, letter: str, line: str = "''") -> str:
        return (f"{{'c': {place}.c + {cost}, 'a': {place}.a || '{letter}', "
                f"'r': {place}.r || {line}}}")

    user, helper = "chr(10) || 'user:'", "chr(10) || 'assistant:'"
    delete = [add(f"p{s}", "2", "D") for s in range(4)]
    keep, rewrite = "CASE WHEN gone THEN 1000000 ELSE 5 * cut END", "CASE WHEN gone THEN 1000000 ELSE 1 + 5 * cut END"
    own = "chr(10) || role || ':' || text"

    def kept(place: int, initial: str) -> str:
        return add(f"p{place}", f"CASE WHEN initial = '{initial}' THEN {keep} ELSE 1000000 END", "K", own)

    q0 = delete[0]
    q1 = least(delete[1], kept(0, "s"))
    q2 = least(delete[2], *(kept(p, "u") for p in (0, 1, 3)), *(add(f"p{p}", rewrite, "R", f"{user} || text") for p in (0, 1, 3)))
    q3 = least(delete[3], kept(2, "a"), add("p2", rewrite, "R", f"{helper} || text"))
    return f"""
WITH RECURSIVE bits AS (
  SELECT list_transform(range(256), lambda i: list_reduce(list_prepend(i::bigint, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384, c >> 1) ELSE c >> 1 END)) AS t),
keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(
           coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' '), ''), lambda x: ascii(x)::bigint)),
           lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8))) % 20 AS kind
  FROM conversations, bits),
damaged AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM keyed, range(CASE WHEN kind = 3 THEN 2 ELSE 1 END) WHERE kind <> 0),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 AS again,
         NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') AS is_blank, left(role, 1) AS initial
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos FROM damaged)),
turns AS (
  SELECT *, is_blank OR again AS gone,
         (NOT is_blank AND NOT again AND NOT regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*\\z'))::bigint AS cut,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY pos) || initial AS pair FROM placed),
totals AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (is_blank) AS blank,
         count(*) FILTER (again AND NOT is_blank) AS duplicate, cast(sum(cut) AS bigint) AS truncated,
         count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM turns GROUP BY conv_id),
walk AS (
  SELECT conv_id, 0::bigint AS pos, {{'c': 0::bigint, 'a': '', 'r': ''}} AS p0, {{'c': 1000000::bigint, 'a': '', 'r': ''}} AS p1,
         {{'c': 5::bigint, 'a': 'I', 'r': {user}}} AS p2, {{'c': 10::bigint, 'a': 'II', 'r': {user} || {helper}}} AS p3
  FROM totals
  UNION ALL
  SELECT conv_id, pos, p0, p1, p2, {least("p3", add("p2", "5", "I", helper))} AS p3
  FROM (SELECT conv_id, pos, p0, p1, {least("p2", *(add(f"p{p}", "5", "I", user) for p in (0, 1, 3)))} AS p2, p3
        FROM (SELECT conv_id, pos, p0, p1, p2, {least("p3", add("p2", "5", "I", helper))} AS p3
              FROM (SELECT t.conv_id, t.pos, {q0} AS p0, {q1} AS p1, {q2} AS p2, {q3} AS p3
                    FROM walk w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.pos = w.pos + 1)))),
done AS (
  SELECT w.conv_id, {least("p0", "p3")} AS best FROM walk w JOIN totals t
  ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.n = w.pos)
SELECT i.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(best.c, 0) AS cost,
       coalesce(best.a, '') AS audit, sha256(substr(coalesce(best.r, ''), 2)) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) i
LEFT JOIN totals t ON t.conv_id IS NOT DISTINCT FROM i.conv_id
LEFT JOIN done d ON d.conv_id IS NOT DISTINCT FROM i.conv_id"""


@register("op12_conversation_repair", _repair_sql())
def op12(spark, sf):
    """Cheapest repair of every conversation after the stated damage."""
    from ledgerlake.llm.conversations import damage, repair
    turns = table(spark, sf, "conversations")
    return repair(damage(turns), turns)
