"""The registered queries of the operators, each over its whole table, and their DuckDB SQL."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from murmur.llm import chat, warc
from murmur.llm.common import table
from murmur.llm.decontam import decontaminate
from murmur.llm.exact import exact_duplicates
from murmur.llm.fim import fill_in_middle, restored
from murmur.llm.html import extract_pages
from murmur.llm.minhash import near_duplicates
from murmur.llm.packing import pack
from murmur.llm.phrases import collocations
from murmur.llm.setjoin import jaccard_components
from murmur.llm.suffix import remove_repeats
from murmur.llm.tokens import count_tokens, sentencepiece_vocabulary
from murmur.llm.toxicity import toxicity
from murmur.session import scratch_path


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), words=2, percent=80)


def op2_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations, and one (-7) whose texts hold the template's own strings; read back from the output."""
    text = "\\### Assistant: </turn> ok"
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    own = spark.createDataFrame([(-7, 0, "user", text), (-7, 1, "assistant", text)], rows.schema)
    out = chat.format_chats(rows.union(own))
    out = out.select("conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return out.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.sha2(lines, 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"),
                      F.sha2("loss", 256).alias("loss_sha256"), F.length("formatted").cast("long").alias("formatted_chars"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as WARC records into the shared folder, then the archives read back."""
    warc.register(spark)
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    warc.write_pages(table(spark, sf_dir, "pages"), path)
    archive = spark.read.format("warc").load(path)
    full = archive.where("record_type = 'response'").select("record_id", F.octet_length("payload").cast("long").alias("payload_bytes"), F.sha1("payload").alias("payload_digest"), "record_type", "refers_to")
    again = spark.read.format("warc").option("payload", "false").load(path).where("record_type = 'revisit'").select(
        "record_id", F.col("payload_length").alias("payload_bytes"), F.substring_index("payload_digest", ":", -1).alias("payload_digest"), "record_type", "refers_to")
    page = lambda c: F.regexp_extract(c, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")
    return full.union(again).select(page("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", page("refers_to").alias("refers_to"))


def op7_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("removed")


def op8_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts under the pieces of piece_bpe_32k.model, their stored scores taken as a unigram model's."""
    return count_tokens(table(spark, sf_dir, "documents"), sentencepiece_vocabulary(public_tokenizers.path("piece_bpe_32k.model")))


def op9_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans", "items")


def op10_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_pages(table(spark, sf_dir, "pages"))


def op11_fim(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fill_in_middle(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                      F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


def op13_setjoin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), words=4, percent=85)


QUERIES = {f.__name__: f for f in (op1_minhash, op2_exact, op3_toxicity, op4_chat, op5_packing, op6_warc, op7_suffix, op8_tokens, op9_decontaminate, op10_html,
                                   op11_fim, op12_phrases, op13_setjoin)}

ORACLE = {
    "op2_exact": """
        WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS n, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', '', 'g') AS t FROM documents),
             g AS (SELECT *, first_value(doc_id) OVER (PARTITION BY t ORDER BY n DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size FROM d)
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM g""",
    "op4_chat": """
        WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                   UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'), (-7, 1, 'assistant', '\\### Assistant: </turn> ok')),
             n AS (SELECT *, lag(role) OVER w AS before, lead(role) OVER w AS after FROM c WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)),
             -- one backslash before each control string; a header of 6 and the title opens a run of one role, 8 part its turns, 9 end it
             l AS (SELECT *, length(text) + len(regexp_extract_all(text, '### |<turn/>|</turn>'))
                             + CASE WHEN before IS NOT DISTINCT FROM role THEN 0 ELSE 6 + length(role) END
                             + CASE WHEN after IS NOT DISTINCT FROM role THEN 8 ELSE 9 END AS size FROM n)
        SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
               CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
               sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn, role, text), '')) AS loss_sha256,
               CAST(sum(size) AS BIGINT) AS formatted_chars
        FROM l GROUP BY conv_id""",
    "op6_warc": """
        WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
             g AS (SELECT *, max(page_id) OVER (PARTITION BY html) AS last FROM p)
        SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest, CASE WHEN n >= 1000 AND page_id <> last THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN n >= 1000 AND page_id <> last THEN last END AS refers_to
        FROM g""",
    "op9_decontaminate": """
        WITH dw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
             bw AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
             wi AS (SELECT item_id, least(13, len(w)) AS k, unnest(range(0, len(w) - least(13, len(w)) + 1)) AS p, w FROM bw WHERE len(w) > 0),
             win AS (SELECT DISTINCT item_id, k, array_to_string(w[p + 1:p + k], ' ') AS s FROM wi),
             ks AS (SELECT DISTINCT k FROM win),
             dp AS (SELECT doc_id, k, w, unnest(range(0, len(w) - k + 1)) AS p FROM dw, ks WHERE len(w) >= k),
             hits AS (SELECT doc_id, p, win.k, item_id FROM dp JOIN win ON win.k = dp.k AND win.s = array_to_string(w[p + 1:p + dp.k], ' ')),
             words AS (SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + k)) AS i FROM hits) GROUP BY doc_id),
             its AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id, ',' ORDER BY item_id) AS ids FROM hits GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
        FROM dw LEFT JOIN words USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op11_fim": """
        WITH d AS (SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
             u AS (SELECT *, regexp_extract_all(text, '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u,
                          CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d),
             c AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS lo, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS hi,
                          CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR h3 % 100 >= 50 THEN 'plain' WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM u),
             p AS (SELECT *, array_to_string(u[1:lo], '') AS pre, array_to_string(u[lo + 1:hi], '') AS mid, array_to_string(u[hi + 1:], '') AS suf FROM c)
        SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
               sha256(CASE form WHEN 'plain' THEN text WHEN 'spm' THEN '<S>' || suf || '<P>' || pre || '<M>' || mid ELSE '<P>' || pre || '<S>' || suf || '<M>' || mid END) AS output_sha256,
               sha256(text) AS restored_sha256
        FROM p""",
    "op12_phrases": """
        WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^.,;:!?\\x0A-\\x0D]+')) AS piece FROM documents),
             w AS MATERIALIZED (SELECT row_number() OVER () AS id, lang, regexp_extract_all(piece, '[^\\x20\\x09]+') AS w FROM p),
             total AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
             x AS (SELECT id, lang, unnest(w) AS a, unnest(range(len(w))) AS i FROM w),
             y AS (SELECT lang, a, lead(a, 1) OVER o AS b, lead(a, 2) OVER o AS c, lead(a, 3) OVER o AS d FROM x WINDOW o AS (PARTITION BY id ORDER BY i)),
             f AS MATERIALIZED (SELECT lang, k, g, count(*) AS f
                   FROM (SELECT lang, 1 AS k, a AS g FROM y UNION ALL SELECT lang, 2, a || ' ' || b FROM y UNION ALL SELECT lang, 3, a || ' ' || b || ' ' || c FROM y
                         UNION ALL SELECT lang, 4, a || ' ' || b || ' ' || c || ' ' || d FROM y) WHERE g IS NOT NULL GROUP BY lang, k, g HAVING count(*) >= 30),
             cand AS (SELECT lang, k, g, f AS a, string_split(g, ' ') AS w FROM f WHERE k > 1),
             two AS MATERIALIZED (SELECT lang, g, a, cut, array_to_string(w[1:cut], ' ') AS first, array_to_string(w[cut + 1:], ' ') AS rest FROM cand, (VALUES (1), (2), (3)) AS s(cut) WHERE cut < k),
             cut AS (SELECT t.lang, t.g, t.a, t.cut, x.f AS l, y.f AS r, CAST((CAST(2000000 AS HUGEINT) * t.a) // (x.f + y.f) AS BIGINT) AS score
                     FROM two t JOIN f x ON x.lang = t.lang AND x.g = t.first JOIN f y ON y.lang = t.lang AND y.g = t.rest),
             best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, cut) = 1),
             part AS (SELECT c.lang, array_to_string(c.w[i:i + m - 1], ' ') AS g, max(c.a) AS longer FROM cand c, (VALUES (2), (3)) AS s(m), (VALUES (1), (2), (3)) AS t(i)
                      WHERE m < c.k AND i + m - 1 <= c.k GROUP BY ALL),
             stay AS (SELECT b.* FROM best b LEFT JOIN part USING (lang, g) WHERE longer IS NULL OR 100 * CAST(longer AS HUGEINT) < 80 * CAST(a AS HUGEINT)),
             ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, g) AS rank FROM stay)
        SELECT lang, rank, g AS phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000""",
}
