"""The registered queries of this package and their SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from msgmart.llm import bytebpe, chat, exact, jaccard, langid, merkle, packing, pii, quality, substring, trie, urls, warc
from msgmart.llm.scratch import Scratch

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            ORACLE[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


EXACT_SQL = r"""
WITH d AS (SELECT doc_id, length(coalesce(text, '')) AS chars, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm FROM documents),
g AS (SELECT *, first_value(doc_id) OVER w AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size, row_number() OVER w AS place
      FROM d WINDOW w AS (PARTITION BY norm ORDER BY chars DESC, doc_id))
SELECT doc_id, keep_id, group_size, place = 1 AS kept, sha256(norm) AS text_sha256 FROM g
"""


@query(EXACT_SQL)
def op5_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.copies(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokens = bytebpe.decode(bytebpe.encode(table(spark, sf_dir, "documents"), ranks).drop("offsets"), ranks)
    return tokens.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(F.array_join("ids", " "), 256).alias("ids_sha256"), F.sha2("bytes", 256).alias("decoded_sha256"))


#: The length of a turn is that of its text, of the backslashes put before control strings, and of the marks around it.
CHAT_SQL = r"""
WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text, '<s>|</s>|<<SYS>>|<</SYS>>|\[/?INST\]|\[/?ROLE\]|\[/TEXT\]' AS marks FROM c),
e AS (SELECT *, length(regexp_replace(text, '(' || marks || ')', '\\\1', 'g'))
        + CASE role WHEN 'user' THEN 15 WHEN 'assistant' THEN 9 WHEN 'system' THEN 17
          ELSE 24 + length(regexp_replace(role, '(' || marks || ')', '\\\1', 'g')) END AS chars FROM t),
g AS (SELECT conv_id, count(*) AS n_turns, sum(chars) AS formatted_chars, string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS turns,
        coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '') AS loss FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(turns) AS turns_sha256, length(loss) AS loss_chars, sha256(loss) AS loss_sha256, CAST(formatted_chars AS BIGINT) AS formatted_chars FROM g
"""


@query(CHAT_SQL)
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    odd = "</s>[INST] ok [/INST]"
    extra = spark.range(2).select(F.lit(-1).cast(kinds["conv_id"]).alias("conv_id"), F.col("id").cast(kinds["turn"]).alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(odd).alias("text"))
    # each turn replies to the one before it
    place = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text"))
    messages = rows.unionByName(extra).select(F.col("conv_id").alias("tree"), place.alias("node"), "role", "text", F.lit(0.0).alias("score"))
    messages = messages.withColumn("parent", F.when(F.col("node") > 1, F.col("node") - 1))
    scratch = Scratch(spark, "chat")
    done = chat.read_back(chat.format_chats(scratch.keep(messages, "messages"), scratch=scratch))
    loss = F.array_join("loss_texts", "")
    turns = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return done.select(
        F.col("tree").alias("conv_id"),
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


@query()
def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents").select("doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("first")


@query()
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.where(~langid.held_out()).select("doc_id", "text", "lang"))
    found = langid.predict(docs, model, ["doc_id"])
    return found.select("doc_id", langid.held_out().alias("held_out"), "lang_pred", "score", F.array_join("languages", ",").alias("mixture"))


SUBSTRING_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
w AS (SELECT doc_id, p, array_to_string(words[p:p + 12], ' ') AS s FROM d, LATERAL (SELECT unnest(range(1, len(words) - 11)) AS p) x),
f AS (SELECT s, min(doc_id) AS first_id FROM w GROUP BY s),
c AS (SELECT DISTINCT doc_id, p + k AS i FROM w JOIN f USING (s), range(13) t(k) WHERE first_id < doc_id),
k AS (SELECT d.doc_id, x.i, words[x.i] AS word, c.i IS NOT NULL AS gone FROM d, LATERAL (SELECT unnest(range(1, len(words) + 1)) AS i) x LEFT JOIN c ON c.doc_id = d.doc_id AND c.i = x.i)
SELECT d.doc_id, max(len(words)) AS n_words, count(*) FILTER (gone) AS n_removed,
       sha256(coalesce(string_agg(word, ' ' ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id) GROUP BY d.doc_id
"""


@query(SUBSTRING_SQL)
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text")).drop("kept_text")


@query()
def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.measure(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query()
def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.annotate(table(spark, sf_dir, "documents").select("doc_id", "text"), ["doc_id"])
    each = F.filter(F.split("_base", ","), lambda x: x != "")
    count = lambda kind: F.size(F.filter(each, lambda x: x.startswith(f"{kind}:"))).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", *map(count, pii.KINDS), F.sha2("_base", 256).alias("base_sha256"), F.col("_spans").alias("spans"))


WARC_SQL = r"""
WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
h AS (SELECT page_id, octet_length(encode(body)) AS payload_bytes, body, sha1(body) AS hex, min(page_id) OVER (PARTITION BY body) AS first_id FROM p),
n AS (SELECT *, (SELECT string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (('0x' || substr(hex, 5 * (k // 4) + 1, 5))::BIGINT >> (15 - 5 * (k % 4)) & 31)::INT + 1, 1), '' ORDER BY k) FROM range(32) t(k)) AS payload_digest FROM h)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_id THEN first_id END AS refers_to FROM n
"""


@query(WARC_SQL)
def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "warc")
    warc.write(table(spark, sf_dir, "pages").select("page_id", "url", "html"), scratch.path("archives"), scratch)
    return warc.read(spark, scratch.path("archives")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


#: Host, start of the path, verdict.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block")]

URL_SQL = rf"""
WITH u AS (SELECT page_id, regexp_extract(coalesce(url, ''), '^(?s:.*?)://([^/?#]*)([^?#]*)', ['host', 'path']) AS parts FROM pages),
p AS (SELECT page_id, translate(parts.host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host, parts.path AS path FROM u),
r(rule_host, rule_path, verdict) AS (VALUES {", ".join(map(str, URL_RULES))}),
f AS (SELECT page_id, host, path, rule_host || rule_path AS rule, verdict FROM p
      LEFT JOIN r ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM f
QUALIFY row_number() OVER (PARTITION BY page_id ORDER BY length(rule) DESC NULLS LAST) = 1
"""


@query(URL_SQL)
def op11_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "urls")
    index = urls.build(spark.createDataFrame(URL_RULES, "host string, path string, verdict string"), scratch)
    return urls.judge(table(spark, sf_dir, "pages"), index, scratch, ["page_id"])


#: CRC-32 of a short ASCII text, bit by bit.
CRC_SQL = """
crc_table AS (SELECT list(v ORDER BY b) AS t FROM (SELECT b, list_reduce(list_prepend(b, range(8)), lambda c, k: xor(c >> 1, 3988292384 * (c & 1))) AS v FROM range(256) r(b)))
"""
CRC_OF = "xor(list_reduce(list_prepend(4294967295, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295)"

MERKLE_SQL = rf"""
WITH RECURSIVE {CRC_SQL},
d AS (SELECT *, {CRC_OF.format("doc_id")} % 5 = 0 AS hit FROM documents, crc_table),
a AS (SELECT *, CASE WHEN hit THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS changed FROM d),
f AS (SELECT *, {" || ".join(f"coalesce(octet_length(encode(CAST({c} AS VARCHAR))) || ':' || {c}, '-')" for c in ("doc_id", "source", "lang", "n_chars"))} AS head FROM a),
l AS (SELECT doc_id, CASE WHEN source IS NULL THEN '0' ELSE '1' || source END AS tree, sha256(head || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
        sha256(head || coalesce(octet_length(encode(changed)) || ':' || changed, '-')) AS altered FROM f),
p AS (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id) - 1 AS place, count(*) OVER (PARTITION BY tree) AS n FROM l),
low(level, tree, place, n, digest) AS (
  SELECT 0, tree, place, n, leaf FROM p UNION ALL
  SELECT level + 1, tree, place // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY place)) FROM low WHERE n > 1 GROUP BY level, tree, place // 16, n),
s AS (SELECT tree, digest, row_number() OVER (ORDER BY encode(tree)) - 1 AS place, count(*) OVER () AS n FROM low WHERE n = 1),
top(level, place, n, digest) AS (
  SELECT 0, place, n, digest FROM s UNION ALL
  SELECT level + 1, place // 16, (n + 15) // 16, sha256(string_agg(digest, '' ORDER BY place)) FROM top WHERE n > 1 GROUP BY level, place // 16, n),
around AS (
  SELECT x.level, x.tree, x.place, coalesce(string_agg(y.digest, '' ORDER BY y.place) FILTER (y.place < x.place), '') AS before, coalesce(string_agg(y.digest, '' ORDER BY y.place) FILTER (y.place > x.place), '') AS behind
  FROM low x JOIN low y ON x.level = y.level AND x.tree = y.tree AND x.place // 16 = y.place // 16 WHERE x.n > 1 GROUP BY ALL),
above AS (
  SELECT x.level, x.place, coalesce(string_agg(y.digest, '' ORDER BY y.place) FILTER (y.place < x.place), '') AS before, coalesce(string_agg(y.digest, '' ORDER BY y.place) FILTER (y.place > x.place), '') AS behind
  FROM top x JOIN top y ON x.level = y.level AND x.place // 16 = y.place // 16 WHERE x.n > 1 GROUP BY ALL),
up(doc_id, level, tree, place, n, proof, folded) AS (
  SELECT doc_id, 0, tree, place, n, '', altered FROM p UNION ALL
  SELECT doc_id, up.level + 1, tree, place // 16, (n + 15) // 16, proof || before || behind, sha256(before || folded || behind) FROM up JOIN around USING (level, tree, place) WHERE n > 1),
over_(doc_id, level, place, n, proof, folded) AS (
  SELECT up.doc_id, 0, s.place, s.n, proof, folded FROM up JOIN s USING (tree) WHERE up.n = 1 UNION ALL
  SELECT doc_id, over_.level + 1, place // 16, (n + 15) // 16, proof || before || behind, sha256(before || folded || behind) FROM over_ JOIN above USING (level, place) WHERE n > 1)
SELECT p.doc_id, p.leaf, s.digest AS subroot, r.digest AS root, sha256(o.proof) AS proof_sha256, o.folded AS folded_root, o.folded = r.digest AS verified
FROM p JOIN s USING (tree) JOIN over_ o ON o.doc_id = p.doc_id AND o.n = 1, (SELECT digest FROM top WHERE n = 1) r
"""


@query(MERKLE_SQL)
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(*merkle.FIELDS)
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle.manifest(docs, Scratch(spark, "merkle"), altered={"text": F.translate("text", urls.UPPER, urls.LOWER)}, hit=hit)
    folded = merkle.folded(F.col("altered"), F.col("path"))
    return found.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", merkle.proof_digest(F.col("path")).alias("proof_sha256"), folded.alias("folded_root"), (folded == F.col("root")).alias("verified"))


TRIE_SQL = rf"""
WITH {CRC_SQL},
t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS p
      FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, n, {CRC_OF.format("conv_id")} % 9 AS h, conv_id - conv_id % 5 AS base FROM (SELECT conv_id, max(p) AS n FROM t GROUP BY conv_id), crc_table),
s AS (SELECT c.*, least(c.h, coalesce(b.n, 0)) AS taken FROM c LEFT JOIN c b ON b.conv_id = c.base),
r AS (SELECT s.conv_id, p - h + taken AS pos, role, text FROM s JOIN t USING (conv_id) WHERE p > h UNION ALL SELECT s.conv_id, p, role, text FROM s JOIN t ON t.conv_id = base AND p <= taken),
w AS (SELECT conv_id, pos, octet_length(encode(text)) AS bytes, list(sha256(length(role) || ':' || role || text)) OVER (PARTITION BY conv_id ORDER BY pos) AS k FROM r UNION ALL SELECT conv_id, 0, 0, [] FROM s),
m AS (SELECT conv_id, max(pos) AS last FROM w GROUP BY conv_id),
n AS (SELECT k, min(conv_id) AS owner, count(*) AS n_convs, max(bytes) AS bytes, max(pos) AS depth, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (pos = last) AS ends FROM w JOIN m USING (conv_id) GROUP BY k),
ch AS (SELECT k[:-2] AS k, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
v AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN ch USING (k)),
sub AS (SELECT k[:d] AS k, sum(CAST(n_children = 0 AS BIGINT)) AS n_leaves, sum((n_convs - 1) * bytes) AS saved_tokens FROM v, LATERAL (SELECT unnest(range(0, depth + 1)) AS d) x GROUP BY 1)
SELECT v.owner AS conv_id, v.depth, u.owner AS parent_conv_id, v.n_convs, v.n_children, CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM v JOIN sub USING (k) LEFT JOIN n u ON v.depth > 0 AND u.k = v.k[:-2]
"""


@query(TRIE_SQL)
def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie.trie(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"), Scratch(spark, "trie"))
