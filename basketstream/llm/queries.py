"""One registered query per text operator, over the given tables, and their SQL oracles.

Each query takes (spark, sf_dir), applies its operator to the whole table and
derives its digest columns from the operator's rows.
"""

from pyspark.sql import DataFrame, functions as F

from basketstream.llm import (
    chat, exact_dedup, packing, phrase_index, quality_model, quality_rules, repair, sentencepiece_codec, simhash, toxicity, url_filter, warc,
    whitening,
)
from basketstream.llm.common import ready, table
from basketstream.llm.labelled import remainder

REGISTRY = {}
ORACLES = {}


def query(function):
    """Register a query; the session gets the settings the operators rely on first."""

    def run(spark, sf_dir) -> DataFrame:
        return function(ready(spark), sf_dir)

    REGISTRY[function.__name__] = run
    return function


@query
def op1_packing(spark, sf):
    pieces = packing.pack(table(spark, sf, "documents"), extra={"ids_crc32": F.crc32("ids")}, keep_ids=False)
    return pieces.select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


@query
def op3_simhash(spark, sf):
    marked = simhash.mark_components(table(spark, sf, "documents"))
    return marked.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op8_exact_dedup(spark, sf):
    marked = exact_dedup.mark_rows(table(spark, sf, "documents"))
    return marked.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


ORACLES["op8_exact_dedup"] = r"""
WITH texts AS (
    SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS text_sha256
    FROM documents
)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, text_sha256
FROM texts WINDOW same AS (PARTITION BY text_sha256)
"""


@query
def op9_quality_rules(spark, sf):
    judged = quality_rules.score_documents(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", "kept", "rule")


URL_RULES = [
    ("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"),
]


@query
def op10_url_filter(spark, sf):
    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, URL_RULES)) + " AS rules (rule, verdict)")
    return url_filter.judge(table(spark, sf, "pages"), rules)


ORACLES["op10_url_filter"] = r"""
WITH rest AS (
    SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), parts AS (
    SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
           regexp_extract(rest, '^[^/?#]*(/[^?#]*)', 1) AS path
    FROM rest
), judged AS (
    SELECT *, CASE
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/en/1') THEN 'example.org/en/1'
        WHEN (host = 'example.org' OR ends_with(host, '.example.org')) AND starts_with(path, '/es/') THEN 'example.org/es/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/fr/') THEN 'com/fr/'
        WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/de/') THEN 'com/de/'
        WHEN (host = 'org' OR ends_with(host, '.org')) AND starts_with(path, '/') THEN 'org/' END AS rule
    FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""


@query
def op5_chat(spark, sf):
    given = table(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    control = "</s>[INST] ok [/INST]"
    extra = spark.sql(f"SELECT * FROM VALUES (-1L, 0L, 'user', '{control}'), (-1L, 1L, 'assistant', '{control}') AS rows (conv_id, turn, role, text)")
    read = chat.read_back(chat.format_messages(chat.as_tree(given.unionByName(extra))))
    digest = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(digest.cast("binary"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"), F.sha2(F.col("loss_text").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"))


ORACLES["op5_chat"] = r"""
WITH rows AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
    SELECT *, length(text)
        + length(regexp_replace(text, '\\|\[/?(INST|SYS|ROLE)\]|\[(OUT|TEXT)\]|</?s>', '\0.', 'g')) - length(text)
        + CASE role WHEN 'user' THEN 13 WHEN 'assistant' THEN 9 WHEN 'system' THEN 11
               ELSE 19 + length(role) + length(regexp_replace(role, '\\|\[/?(INST|SYS|ROLE)\]|\[(OUT|TEXT)\]|</?s>', '\0.', 'g')) - length(role)
          END AS chars
    FROM rows
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(chars)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query
def op6_warc(spark, sf):
    _, index = warc.archive(table(spark, sf, "pages"))
    return warc.read_records(index).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


ORACLES["op6_warc"] = r"""
WITH sized AS (
    SELECT page_id, coalesce(html, '') AS payload, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), digits AS (
    SELECT page_id, payload_bytes, max(page_id) OVER (PARTITION BY payload) AS last,
           [('0x' || substr(hex, 5 * i + 1, 5))::BIGINT FOR i IN range(8)] AS parts
    FROM sized
)
SELECT page_id, payload_bytes,
       array_to_string([array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', ((n >> s) & 31) + 1, 1)
                                         FOR s IN [15, 10, 5, 0]], '') FOR n IN parts], '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM digits
"""


QUALITY_THRESHOLD = 0.3


@query
def op7_quality_model(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = quality_model.train(docs, labels, remainder("doc_id", 5) != 0)
    return model.score(docs).select(
        "doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= QUALITY_THRESHOLD).cast("int").alias("predicted"))


TOXICITY_THRESHOLD = 0.7


@query
def op4_toxicity(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    return toxicity.score_corpus(docs, labels, remainder("doc_id", 3) != 1).select(
        "doc_id", F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= TOXICITY_THRESHOLD).cast("int").alias("predicted"), "evidence")


@query
def op2_sentencepiece(spark, sf):
    """Per document: number and CRC-32 of its ids, and whether decoding gives the text back (its U+2581 as spaces)."""
    docs = table(spark, sf, "documents").select("doc_id", "text")
    plain = F.replace(F.coalesce("text", F.lit("")), F.lit("▁"), F.lit(" "))
    coded = sentencepiece_codec.encode(docs, carry=F.sha2(plain.cast("binary"), 256))
    return sentencepiece_codec.decode(coded).select(
        "doc_id", F.size("ids").cast("long").alias("n_ids"), "ids_crc32",
        (F.sha2(F.col("text").cast("binary"), 256) == F.col("carried")).alias("round_trip"))


def damaged(turns: DataFrame) -> DataFrame:
    """Rows of ``conversations`` with the faults that the CRC-32 of ``conv_id:turn`` deals out; nulls are one space."""
    blank = lambda name: F.coalesce(F.col(name).cast("string"), F.lit(" "))
    dealt = F.crc32(F.concat_ws(":", blank("conv_id"), blank("turn")).cast("binary")) % 20
    text = F.when(F.col("dealt") == 1, "").when(F.col("dealt") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = turns.select("conv_id", "turn", blank("role").alias("role"), blank("text").alias("text"), dealt.alias("dealt")).where("dealt <> 0")
    return rows.select(
        "conv_id", "turn", F.when(F.col("dealt") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"),
        F.explode(F.array_repeat(F.lit(0), F.when(F.col("dealt") == 3, 2).otherwise(1))).alias("copy")).drop("copy")


@query
def op11_conversation_repair(spark, sf):
    given = table(spark, sf, "conversations")
    summary, edits = repair.repair(damaged(given))
    found = summary.alias("s").join(repair.digests(edits).alias("d"), F.col("s.conv").eqNullSafe(F.col("d.conv")), "left")
    every = given.select("conv_id").distinct().alias("c")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return every.join(found, F.col("c.conv_id").eqNullSafe(F.col("s.conv")), "left").select(
        "conv_id", *(F.coalesce(n, F.lit(0)).cast("long").alias(n) for n in counts), F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("sha256", F.sha2(F.lit(b""), 256)).alias("repaired_sha256"))


# The search again as a table of the best (cost, audit) per conversation, rows done and state:
# 0 nothing yet, 1 after system, 2 after user, 3 after assistant. One insertion between two
# rows, or two in front of the end of a lone system row, is all that can pay.
ORACLES["op11_conversation_repair"] = r"""
WITH RECURSIVE crc_bits AS (
    SELECT i, CASE WHEN b7 & 1 = 1 THEN xor(b7 >> 1, 3988292384) ELSE b7 >> 1 END AS v FROM (
    SELECT i, CASE WHEN b6 & 1 = 1 THEN xor(b6 >> 1, 3988292384) ELSE b6 >> 1 END AS b7 FROM (
    SELECT i, CASE WHEN b5 & 1 = 1 THEN xor(b5 >> 1, 3988292384) ELSE b5 >> 1 END AS b6 FROM (
    SELECT i, CASE WHEN b4 & 1 = 1 THEN xor(b4 >> 1, 3988292384) ELSE b4 >> 1 END AS b5 FROM (
    SELECT i, CASE WHEN b3 & 1 = 1 THEN xor(b3 >> 1, 3988292384) ELSE b3 >> 1 END AS b4 FROM (
    SELECT i, CASE WHEN b2 & 1 = 1 THEN xor(b2 >> 1, 3988292384) ELSE b2 >> 1 END AS b3 FROM (
    SELECT i, CASE WHEN b1 & 1 = 1 THEN xor(b1 >> 1, 3988292384) ELSE b1 >> 1 END AS b2 FROM (
    SELECT i, CASE WHEN i & 1 = 1 THEN xor(i >> 1, 3988292384) ELSE i >> 1 END AS b1 FROM range(256) AS r(i))))))))
), crc_table AS (
    SELECT list(v::BIGINT ORDER BY i) AS t FROM crc_bits
), given AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
           coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key
    FROM conversations
), coded AS (
    SELECT g.*, xor(list_reduce(list_transform(string_split(key, ''), lambda x: ascii(x)::BIGINT),
        lambda c, x: xor(c >> 8, list_extract(t, (xor(c, x) & 255)::BIGINT + 1)), 4294967295), 4294967295) % 20 AS dealt
    FROM given g, crc_table
), damaged AS (
    SELECT conv_id, turn, CASE WHEN dealt = 4 THEN 'user' ELSE role END AS role,
           CASE WHEN dealt = 1 THEN '' WHEN dealt = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
           unnest(range(CASE WHEN dealt = 3 THEN 2 ELSE 1 END)) AS copy
    FROM coded WHERE dealt <> 0
), placed AS (
    SELECT *, coalesce(conv_id::VARCHAR, ' ') AS conv, left(role, 1) AS initial,
           row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, left(text, 64), sha256(text), copy) AS i,
           count(*) OVER (PARTITION BY conv_id) AS n
    FROM damaged
), judged AS (
    SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'b'
                   WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
                   WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 't' ELSE '' END AS fault,
           lag(initial) OVER (PARTITION BY conv_id ORDER BY i) || initial NOT IN ('su', 'ua', 'au') AS illegal
    FROM placed
), starts AS (
    SELECT DISTINCT conv, n FROM judged
), moves(letter, state, given, after, dear) AS (
    VALUES ('K', 0, 's', 1, 0), ('K', 0, 'u', 2, 0), ('K', 1, 'u', 2, 0), ('K', 2, 'a', 3, 0), ('K', 3, 'u', 2, 0),
           ('R', 0, '', 2, 2), ('R', 1, '', 2, 2), ('R', 2, '', 3, 2), ('R', 3, '', 2, 2),
           ('D', 0, '', 0, 3), ('D', 1, '', 1, 3), ('D', 2, '', 2, 3), ('D', 3, '', 3, 3)
), reached AS (
    SELECT conv, n, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit FROM starts
    UNION ALL
    SELECT conv, n, i, state, b.cost, b.audit FROM (
        SELECT r.conv, r.n, r.i + 1 AS i, m.after AS state,
               min({'cost': r.cost + m.dear + CASE WHEN m.letter <> 'D' AND j.fault = 't' THEN 1 ELSE 0 END, 'audit': r.audit || m.letter}) AS b
        FROM (
            SELECT conv, n, i, state, cost, audit FROM reached
            UNION ALL SELECT conv, n, i, CASE state WHEN 2 THEN 3 ELSE 2 END, cost + 2, audit || 'I' FROM reached
        ) r
        JOIN judged j ON j.conv = r.conv AND j.i = r.i + 1
        JOIN moves m ON m.state = r.state AND (m.letter <> 'K' OR m.given = j.initial) AND (m.letter = 'D' OR j.fault NOT IN ('b', 'd'))
        GROUP BY r.conv, r.n, r.i, m.after)
), ended AS (
    SELECT conv, min({'cost': cost, 'audit': audit}) AS b FROM (
        SELECT conv, n, i, state, cost, audit FROM reached WHERE state IN (0, 3)
        UNION ALL SELECT conv, n, i, 3, cost + 2, audit || 'I' FROM reached WHERE state = 2
        UNION ALL SELECT conv, n, i, 3, cost + 4, audit || 'II' FROM reached WHERE state = 1
    ) WHERE i = n GROUP BY conv
), letters AS (
    SELECT conv, p, substr(audit, p, 1) AS letter,
           p - length(replace(left(audit, p), 'I', '')) AS inserted, length(replace(left(audit, p), 'D', '')) AS place,
           length(replace(audit, 'D', '')) % 2 AS odd
    FROM (SELECT conv, b.audit AS audit, unnest(range(1, length(b.audit) + 1)) AS p FROM ended)
), lines AS (
    SELECT l.conv, l.p, CASE WHEN letter = 'K' THEN j.role WHEN (place - odd) % 2 = 1 THEN 'user' ELSE 'assistant' END
           || ':' || CASE WHEN letter = 'I' THEN '' ELSE j.text END AS line
    FROM letters l LEFT JOIN judged j ON j.conv = l.conv AND j.i = l.p - l.inserted AND letter <> 'I'
    WHERE letter <> 'D'
), hashed AS (
    SELECT conv, sha256(string_agg(line, chr(10) ORDER BY p)) AS hash FROM lines GROUP BY conv
), counted AS (
    SELECT conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
           count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (illegal) AS illegal
    FROM judged GROUP BY conv
)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(e.b.cost, 0)::BIGINT AS cost,
       coalesce(e.b.audit, '') AS audit, coalesce(h.hash, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id, coalesce(conv_id::VARCHAR, ' ') AS conv FROM conversations) o
LEFT JOIN counted c USING (conv) LEFT JOIN ended e USING (conv) LEFT JOIN hashed h USING (conv)
"""


@query
def op12_decontamination(spark, sf):
    marked = phrase_index.mark_documents(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
    return marked.select(
        F.col("id").alias("doc_id"), "n_words", "n_hit", "n_items",
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLES["op12_decontamination"] = r"""
WITH docs AS (
    SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
        'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
    SELECT DISTINCT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), windows AS (
    SELECT DISTINCT item_id, least(len(w), 10) AS k, array_to_string(w[s:s + least(len(w), 10) - 1], ' ') AS phrase
    FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS s FROM items WHERE len(w) > 0)
), runs AS (
    SELECT r, k, s, array_to_string(w[s:s + k - 1], ' ') AS phrase FROM (
        SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM docs, (SELECT DISTINCT k FROM windows) WHERE len(w) >= k)
), hits AS (
    SELECT r, s, k, item_id FROM runs JOIN windows USING (k, phrase)
), counts AS (
    SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(range(s, s + k)) AS p FROM hits) GROUP BY r
), found AS (
    SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids
    FROM (SELECT DISTINCT r, item_id::VARCHAR AS item FROM hits) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN counts USING (r) LEFT JOIN found USING (r)
"""


@query
def op13_whitening(spark, sf):
    return whitening.whitened(table(spark, sf, "embeddings")).withColumn("deviation", F.col("deviation").try_cast("long")).select(
        "vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")
