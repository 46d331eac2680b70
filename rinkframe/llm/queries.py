"""The operators of this package bound to the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from rinkframe.llm import (
    align,
    audit,
    bpe,
    chat,
    decontam,
    hyperminhash,
    licenses,
    linededup,
    packing,
    quality,
    suffixes,
    toxicity,
    urls,
)
from rinkframe.llm.registry import QUERIES, query  # noqa: F401
from rinkframe.llm.store import keep


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query("op1_toxicity")
def op1_toxicity(spark, table):
    """Scores of all documents by a model learnt on two thirds of the labels."""
    held_out = F.crc32(F.col("doc_id").cast("string")) % 3 == 1
    model = toxicity.fit(table("documents"), table("labels").filter(~held_out))
    scored = toxicity.score(table("documents").select("doc_id", "text"), model)
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


OP2_SQL = r"""
WITH numbered AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
    unnest(range(len(string_split(text, chr(10))))) AS spot
  FROM documents
), firsts AS (
  SELECT line, length(line) AS n, min((doc_id, spot)) AS head FROM numbered
  WHERE length(line) >= 30 OR regexp_matches(line, '[^\s\x0B]') GROUP BY line
), near AS (
  SELECT DISTINCT CASE WHEN a.head < b.head THEN b.line ELSE a.line END AS line
  FROM firsts a JOIN firsts b ON a.n BETWEEN b.n - 2 AND b.n AND a.line <> b.line AND (a.n < b.n OR a.line < b.line)
  WHERE a.n >= 15 AND levenshtein(a.line, b.line) <= least(2, a.n // 15)
), judged AS (
  SELECT n.doc_id, n.spot, n.line, f.line IS NOT NULL AND ((n.doc_id, n.spot) <> f.head OR r.line IS NOT NULL) AS gone
  FROM numbered n LEFT JOIN firsts f ON n.line = f.line LEFT JOIN near r ON n.line = r.line
)
SELECT d.doc_id, count(j.spot) AS n_lines, count(*) FILTER (WHERE gone) AS n_removed,
  sha256(coalesce(string_agg(j.line, chr(10) ORDER BY j.spot) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM documents d LEFT JOIN judged j ON d.doc_id = j.doc_id GROUP BY d.doc_id
"""


@query("op2_lines", OP2_SQL)
def op2_lines(spark, table):
    """All documents without lines that stand, or nearly stand, earlier; every line that is
    not blank takes part, as in the pipeline."""
    out = linededup.dedup_lines(table("documents").select("doc_id", "text"), least_chars=1)
    return out.select("doc_id", F.col("lines.total").alias("n_lines"),
                      F.col("lines.removed").alias("n_removed"), F.sha2("text", 256).alias("kept_sha256"))


@query("op3_leaks")
def op3_leaks(spark, table):
    """Benchmark items in all documents."""
    return decontam.leaks(table("documents").select("doc_id", "text"), table("benchmark"))


OP4_SQL = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  SELECT *, 12 + length(role) + 10 + 11 + length(text)
    + 1 * (length(text) - length(replace(text, '\', '')))
    + (length(text) - length(replace(text, '<|', ''))) // 2
    + (length(text) - length(replace(text, '<s>', ''))) // 3
    + (length(text) - length(replace(text, '</s>', ''))) // 4
    + (length(text) - length(replace(text, '[INST]', ''))) // 6
    + (length(text) - length(replace(text, '[/INST]', ''))) // 7
    + (length(text) - length(replace(text, '<<SYS>>', ''))) // 7
    + (length(text) - length(replace(text, '<</SYS>>', ''))) // 8 AS size
  FROM rows
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
    FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(size) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query("op4_chat", OP4_SQL)
def op4_chat(spark, table):
    """All conversations formatted; the digests are read back from the output."""
    said = "</s>[INST] ok [/INST]"
    planted = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id bigint, turn bigint, role string, text string")
    rows = table("conversations").select("conv_id", F.col("turn").cast("bigint").alias("turn"), "role", "text")
    chunks = chat.format_conversations(rows.unionByName(planted))
    turns = chat.read_back(F.col("formatted"))
    chunks = chunks.select(
        "conv_id", "chunk", F.length("formatted").cast("bigint").alias("chars"),
        F.size(turns).cast("bigint").alias("n"),
        F.array_join(F.transform(turns, lambda t: F.concat(
            t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("turns"),
        chat.masked_text(F.col("formatted"), F.col("loss_spans")).alias("loss"))

    def whole(part):
        listed = F.array_sort(F.collect_list(F.struct("chunk", part)))
        return F.array_join(F.transform(listed, lambda c: c[part]), "")

    joined = chunks.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"), whole("turns").alias("turns"), whole("loss").alias("loss"),
        F.sum("chars").alias("formatted_chars"))
    return joined.select(
        "conv_id", "n_turns", F.sha2("turns", 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"),
        F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


OP5_SQL = r"""
WITH parts AS (
  SELECT page_id,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path
  FROM pages
), ruled AS (
  SELECT *, CASE
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN ('.' || host) LIKE '%.example.org' AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN ('.' || host) LIKE '%.com' AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host || path,
      '(^|[^0-9A-Za-z])(spam-farm\.|cheap-pills\.|(casino|phishing)([^0-9A-Za-z]|$))|/wp-login\.php([^0-9A-Za-z]|$)')
      THEN 'block'
    ELSE 'allow' END AS verdict
FROM ruled
"""


@query("op5_urls", OP5_SQL)
def op5_urls(spark, table):
    """Verdicts on the URLs of all pages."""
    rules = [
        urls.Rule("allow", "org", "/"),
        urls.Rule("block", "example.org", "/es/"),
        urls.Rule("block", "example.org", "/en/1"),
        urls.Rule("allow", "com", "/fr/"),
        urls.Rule("block", "com", "/de/"),
        *urls.PATTERNS,
    ]
    judged = urls.judge(table("pages").select("page_id", "url"), rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


@query("op6_packing")
def op6_packing(spark, table):
    """Every piece of every document in sequences of 2048 tokens."""
    return packing.pack(table("documents"), tokenizer_path(), with_ids=False)


@query("op7_licenses")
def op7_licenses(spark, table):
    """Licence phrases and templates in all documents."""
    found = licenses.scan(table("documents").select("doc_id", "text"))
    return found.select("doc_id", *[f"license.{c}" for c in (
        "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")])


@query("op8_repeats")
def op8_repeats(spark, table):
    """Bytes of all documents that stand in an earlier one in strings of 50."""
    removed = suffixes.remove_repeats(table("documents").select("doc_id", "text"))
    n = F.aggregate("spans", F.lit(0).cast("bigint"), lambda total, s: total + s["length"])
    return removed.select("doc_id", "n_bytes", n.alias("n_removed"),
                          F.size("spans").cast("bigint").alias("n_spans"),
                          F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_quality")
def op9_quality(spark, table):
    """Counts, base rules and the verdict of weak supervision for all documents."""
    judged = quality.judge(table("documents").select("doc_id", "text"))
    return judged.select("doc_id", *[f"quality.{c}" for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "posterior", "kept")])


@query("op10_near_duplicates")
def op10_near_duplicates(spark, table):
    """Components of near-duplicates among all documents."""
    return hyperminhash.near_duplicates(table("documents").select("doc_id", "text"))


@query("op11_bpe")
def op11_bpe(spark, table):
    """Token ids of all documents, and the texts that they decode to."""
    docs, path = table("documents").select("doc_id", "text"), tokenizer_path()
    coded = bpe.encode(docs, path, lexicon=bpe.build_lexicon(docs, path)).drop("text")
    return bpe.decode(coded, path).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


OP12_SQL = r"""
WITH read AS (
  SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), earliest AS (
  SELECT t, min(doc_id) AS first FROM read GROUP BY t
), said AS (
  SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic
  FROM labels GROUP BY doc_id
), judged AS (
  SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
    CAST(len(words) < 200 AS INT)
    + 2 * CAST(100 * len(list_distinct(words)) < 50 * len(words) AS INT)
    + 4 * CAST(100 * (length(t) - length(regexp_replace(t, '[A-Z]', '', 'g'))) > 2 * length(t) AS INT)
    + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
    + 16 * CAST(coalesce(doc_id > first, false) AS INT) AS mask
  FROM read JOIN earliest USING (t) LEFT JOIN said USING (doc_id)
), cells AS (
  SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM judged GROUP BY part, mask
), active AS (
  SELECT part, s, coalesce(sum(n) FILTER (mask & s = 0), 0) AS n,
    coalesce(sum(good) FILTER (mask & s = 0), 0) AS good, coalesce(sum(toxic) FILTER (mask & s = 0), 0) AS toxic
  FROM cells, (SELECT unnest(range(32)) AS s) GROUP BY part, s
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c
), orders AS (
  SELECT a.c || b.c || d.c || e.c || f.c AS o FROM letters a, letters b, letters d, letters e, letters f
  WHERE len(list_distinct([a.c, b.c, d.c, e.c, f.c])) = 5
), steps AS (
  SELECT o, step, CAST(1 << (ascii(substr(o, step, 1)) - 65) AS BIGINT) AS bit,
    CAST(list_sum(list_transform(string_split(substr(o, 1, step), ''), lambda x: 1 << (ascii(x) - 65))) AS BIGINT) AS here
  FROM orders, (SELECT unnest([1, 2, 3, 4, 5]) AS step)
), walked AS (
  SELECT x.part, o, step, bit, x.n AS kept, w.n - x.n AS removed, w.good - x.good AS good_lost,
    w.toxic - x.toxic AS toxic_lost
  FROM steps JOIN active x ON x.s = here JOIN active w ON w.s = here - bit AND w.part = x.part
)
SELECT w.part, o AS filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(z.n - f.n - removed AS BIGINT) AS redundant,
  CAST(u.n - l.n AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY w.part, bit) AS BIGINT) AS shapley
FROM walked w
JOIN active z ON z.part = w.part AND z.s = 0 JOIN active f ON f.part = w.part AND f.s = bit
JOIN active u ON u.part = w.part AND u.s = 31 - bit JOIN active l ON l.part = w.part AND l.s = 31
"""


@query("op12_filter_audit", OP12_SQL)
def op12_filter_audit(spark, table):
    """What five filters remove from every source, in all 120 orders."""
    return audit.audit(audit.failure_cells(table("documents"), table("labels")))


@query("op13_alignment")
def op13_alignment(spark, table):
    """Tokens of all documents aligned between two vocabularies, and how usual the links are."""
    a, b = tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model")
    digest = F.when(F.col("n_a") > 0, F.sha2("groups", 256)).otherwise("")
    aligned = keep(align.align(table("documents"), a, b)
                   .withColumn("groups_sha256", digest).drop("groups"), "aligned")
    judged = align.judge_links(aligned, align.side_size(b))
    return aligned.join(judged, "row", "left").select(
        "doc_id", "n_a", "n_b", "n_groups", "n_links",
        F.coalesce("n_best", F.lit(0)).cast("bigint").alias("n_best"),
        F.coalesce("count_sum", F.lit(0)).cast("bigint").alias("count_sum"), "groups_sha256")
