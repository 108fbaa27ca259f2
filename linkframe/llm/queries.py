"""The operators applied to the given tables: one query each, with DuckDB SQL where SQL can express it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import chat, decontamination, fingerprints, jaccard_join, labels, nbsvm, packing, ranked_search, robust_rules, sharding, spelling, toxicity, url_filter, warc

SHARDS = 24
TOKENIZER = "word_bpe_49k.json"
HOST_RULES = [
    url_filter.host_rule("com", "/", "allow"), url_filter.host_rule("example.com", "/en/", "block"),
    url_filter.host_rule("www.example.com", "/en/", "allow"), url_filter.host_rule("net", "/es/", "block"),
    url_filter.host_rule("net", "/fr/", "block"),
]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, method = _table(spark, sf_dir, "documents").select("doc_id", "text"), toxicity.Counterfactual()
    model = method.fit(labels.training_sample(docs, _table(spark, sf_dir, "labels"), "toxic", method.most_labelled))
    scored = docs.select("doc_id", labels.held_out(F.col("doc_id")).alias("held_out"), model.score(F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return decontamination.Tiling().pairs(docs, _table(spark, sf_dir, "benchmark"))


def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    index = warc.write(warc.plan(pages, "page_id", "url", F.col("html").cast("binary")))
    return warc.read(index).select(
        F.col("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to")


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, method = _table(spark, sf_dir, "documents").select("doc_id", "text"), nbsvm.NbSvm()
    model = method.fit(labels.training_sample(docs, _table(spark, sf_dir, "labels"), "quality", method.most_labelled))
    score = nbsvm.score(spark, model, F.col("text"))
    scored = docs.select("doc_id", labels.held_out(F.col("doc_id")).alias("held_out"), score.alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(_table(spark, sf_dir, "documents"), SHARDS)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op6_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.ChosenPath().join(_table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "n_copies")


def op7_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.read_back(chat.expand(rows))


def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(_table(spark, sf_dir, "pages"), HOST_RULES + url_filter.SPAM, keep=["page_id", "url"])
    is_host = F.col("rule").isin([r.text for r in HOST_RULES])
    return judged.select(
        "page_id", "host", "path", F.when(is_host, F.col("rule")).alias("rule"), "verdict",
        F.when(~is_host, F.col("rule")).alias("pattern"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = packing.pieces(_table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
    return packing.pack(cut).withColumnRenamed("row", "doc_id")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = robust_rules.RobustRules()
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    stats = robust_rules.materialize(robust_rules.describe(docs).drop("text"), "stats")
    judged = rules.judge(stats, rules.fit(stats))
    return judged.select("doc_id", *robust_rules.STATS, "base_failed", "kept", F.round("distance", 6).alias("distance"))


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.WeightedSampling().prints(_table(spark, sf_dir, "documents"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.SpellingVariants().group(_table(spark, sf_dir, "documents"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.RankedSearch().search(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_toxicity, op2_decontamination, op3_warc, op4_quality_classifier, op5_sharding, op6_ngram_jaccard_join, op7_chat_formatting,
    op8_url_filters, op9_packing, op10_quality_rules, op11_fingerprints,
    op12_spelling_variants, op13_ranked_search,
)}

#: SHA-1 in base32: five hex digits are twenty bits, four letters.
_BASE32 = """array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    1 + (((('0x' || substr(hex, cast(5 * (i // 4) + 1 AS BIGINT), 5))::BIGINT) >> (15 - 5 * (i % 4))) & 31), 1)), '')"""
_SPAM = ",\n        ".join(f"({r.rank}, '{r.text}', '{r.pattern.removeprefix('(?is)')}')" for r in url_filter.SPAM)
ORACLES = {
    "op3_warc": f"""
        WITH payloads AS (SELECT page_id, coalesce(html, '') AS html, sha1(encode(coalesce(html, ''))) AS hex FROM pages),
        firsts AS (SELECT *, min(page_id) OVER (PARTITION BY hex) AS first FROM payloads)
        SELECT page_id, cast(octet_length(encode(html)) AS BIGINT) AS payload_bytes, {_BASE32} AS payload_digest,
            CASE WHEN page_id IS NOT DISTINCT FROM first THEN 'response' ELSE 'revisit' END AS record_type,
            CASE WHEN page_id IS DISTINCT FROM first THEN first END AS refers_to
        FROM firsts""",
    "op7_chat_formatting": rf"""
        WITH rows AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
        ), formatted AS (
            SELECT *, 4 + length(replace(replace(replace(role, '\', '\\'), '</turn>', '\l/turn>'), ':', '\c'))
                + coalesce(list_sum(list_transform(regexp_extract_all(role, '#{{3,}}'), lambda x: length(x) - 2)), 0)
                + 2 + length(replace(replace(text, '\', '\\'), '</turn>', '\l/turn>'))
                + coalesce(list_sum(list_transform(regexp_extract_all(text, '#{{3,}}'), lambda x: length(x) - 2)), 0) + 8 AS n
            FROM rows
        ), numbered AS (
            SELECT *, row_number() OVER w AS nth, sum(n) OVER (w ROWS UNBOUNDED PRECEDING) AS prefix,
                count(*) OVER (PARTITION BY conv_id) AS turns
            FROM formatted WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)
        )
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY nth)) AS turns_sha256,
            coalesce(length(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant')), 0) AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY nth) FILTER (role = 'assistant'), '')) AS loss_sha256,
            cast(sum(prefix) FILTER (role = 'assistant' OR nth = turns) AS BIGINT) AS formatted_chars,
            count(*) FILTER (role = 'assistant' OR nth = turns) AS n_examples
        FROM numbered GROUP BY conv_id""",
    "op8_url_filters": rf"""
        WITH parts AS (
            SELECT page_id, translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path
            FROM pages
        ), spam(rank, name, pattern) AS (VALUES
        {_SPAM}
        ), judged AS (
            SELECT page_id, host, path, CASE
                WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND starts_with(path, '/en/') THEN 'www.example.com/en/'
                WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/en/') THEN 'example.com/en/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/es/') THEN 'net/es/'
                WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/fr/') THEN 'net/fr/'
                WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/') THEN 'com/' END AS rule,
                (SELECT arg_min(name, (-rank, name)) FROM spam WHERE regexp_matches(host || path, pattern, 'is')) AS spam
            FROM parts
        )
        SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block'
            WHEN rule IS NOT NULL THEN 'allow' WHEN spam IS NOT NULL THEN 'block' ELSE 'allow' END AS verdict,
            CASE WHEN rule IS NULL THEN spam END AS pattern
        FROM judged""",
    "op12_spelling_variants": r"""
        WITH RECURSIVE steps(byte, c, nth) AS (
            SELECT i, i, 0 FROM range(256) r(i)
            UNION ALL SELECT byte, CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, nth + 1 FROM steps WHERE nth < 8
        ), crc_table AS (SELECT list(c ORDER BY byte) AS t FROM steps WHERE nth = 8),
        found AS (
            SELECT coalesce(cast(doc_id AS VARCHAR), '') AS name, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]+')) AS run FROM documents
        ), runs AS (
            SELECT name, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run, count(*) AS times
            FROM found WHERE length(run) >= 5 GROUP BY ALL
        ), bytes AS (
            SELECT run, times, flatten(list_transform(range(1, length(name) + length(run) + 2), lambda i:
                CASE WHEN unicode(substr(name || ':' || run, i, 1)) < 128 THEN [unicode(substr(name || ':' || run, i, 1))::BIGINT]
                ELSE [192 + (unicode(substr(name || ':' || run, i, 1)) >> 6)::BIGINT, 128 + (unicode(substr(name || ':' || run, i, 1)) & 63)::BIGINT] END)) AS b
            FROM runs
        ), hashed AS (
            SELECT run, times, xor(list_reduce(list_prepend(4294967295::BIGINT, b), lambda a, x: xor(a >> 8, t[(xor(a, x) & 255) + 1])), 4294967295::BIGINT) AS h
            FROM bytes, crc_table
        ), spelt AS (
            SELECT times, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word FROM hashed
        ), words AS (
            SELECT word, sum(times)::BIGINT AS n FROM spelt WHERE length(word) >= 5 GROUP BY word HAVING sum(times) >= 3
        ), cut AS (
            SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
        ), pairs AS (
            SELECT a.word, b.word AS other, b.n AS n_other FROM cut a JOIN cut b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
            UNION SELECT a.word, b.word, b.n FROM cut a JOIN words b ON a.rest = b.word
            UNION SELECT b.word, a.word, a.n FROM cut a JOIN words b ON a.rest = b.word
        ), counted AS (SELECT word, count(*) AS n_near, max(n_other) AS most FROM pairs GROUP BY word),
        forms AS (
            SELECT w.word, w.n, coalesce(c.n_near, 0) AS n_near, CASE WHEN c.most >= 2 * w.n THEN c.most END AS form_n,
                CASE WHEN c.most >= 2 * w.n THEN (SELECT min(p.other) FROM pairs p WHERE p.word = w.word AND p.n_other = c.most) END AS form
            FROM words w LEFT JOIN counted c ON w.word = c.word
        ), ways(word, goal) AS (
            SELECT word, word FROM forms UNION ALL SELECT s.word, f.form FROM ways s JOIN forms f ON s.goal = f.word WHERE f.form IS NOT NULL
        )
        SELECT f.word, f.form, s.goal AS root, f.n, f.n_near, f.form_n
        FROM forms f JOIN ways s ON f.word = s.word JOIN forms e ON s.goal = e.word WHERE e.form IS NULL""",
    "op13_ranked_search": r"""
        WITH docs AS (
            SELECT row_number() OVER () AS row, doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM documents
        ), tokens AS (SELECT row, doc_id, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term FROM docs),
        sizes AS (SELECT row, count(*) AS n FROM tokens GROUP BY row),
        whole AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM sizes),
        counts AS (SELECT row, doc_id, term, count(*)::BIGINT AS tf FROM tokens GROUP BY ALL),
        weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counts, whole GROUP BY term, docs),
        asked AS (
            SELECT DISTINCT item, item_id, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
            FROM (SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(coalesce(text, ''), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark)
        ), scores AS (
            SELECT item, item_id, row, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))))::BIGINT AS score
            FROM asked JOIN counts USING (term) JOIN weights USING (term) JOIN sizes USING (row), whole GROUP BY ALL
        ), ranked AS (SELECT *, row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id ASC NULLS LAST, row) AS rank FROM scores WHERE score > 0)
        SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM ranked WHERE rank <= 10""",
}
