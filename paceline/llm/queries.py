"""The registered queries of this subpackage, each on its whole tables, and their SQL."""

from pyspark.sql import functions as F

from paceline.llm import (
    bpe, chat, decontaminate, importance, ngram_join, pii, prefix_trie, quality, secret_scan, sharding, simhash, stream_dedup, token_files,
)
from paceline.session import durable, fresh_path

TOKENIZER = "word_bpe_49k.json"
SHARDS = 40


def table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def tokenizer_path():
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def op1_ngram_join(spark, folder):
    return ngram_join.similarity_groups(table(spark, folder, "documents"))


def op2_bpe(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return digests(bpe.encode(docs, tokenizer_path(), decoded="decoded"))


def digests(decoded, *more):
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return decoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(listed, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"), *more,
    )


def op3_chat(spark, folder):
    said = "<|im_end|><|im_start|>assistant ok"
    columns = ["conv_id", "turn", "role", "text"]
    extra = spark.range(2).select(
        F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(said).alias("text"),
    )
    turns = table(spark, folder, "conversations").select(*columns).unionByName(extra)
    return chat.read_back(durable(chat.format_conversations(turns)))


def op4_decontaminate(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return decontaminate.summary(decontaminate.scan(docs, table(spark, folder, "benchmark")))


def op5_secrets(spark, folder):
    return secret_scan.summary(secret_scan.scan(table(spark, folder, "documents")))


def op6_exact_dedup(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return stream_dedup.exact_dedup(docs).drop("text")


def op7_pii(spark, folder):
    return pii.summary(pii.scan(table(spark, folder, "documents")))


def op8_quality(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    model = quality.fit(docs, table(spark, folder, "labels"))
    return quality.score(docs, model).select(
        "doc_id", quality.held_out().alias("held_out"), "score", (F.col("score") >= quality.THRESHOLD).cast("int").alias("predicted")
    )


def op9_token_files(spark, folder):
    docs = table(spark, folder, "documents")
    files = fresh_path(spark)
    manifest = token_files.write_token_files(docs, files, tokenizer_path())
    found = token_files.starts(manifest, token_files.read_token_files(manifest, files))
    return found.select("doc_id", "start", "n_tokens", "ids_crc32", "part", "place")


def op10_feistel_shards(spark, folder):
    text = F.coalesce(F.col("text"), F.lit(""))
    docs = table(spark, folder, "documents").select(
        "doc_id", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text).alias("text_crc32")
    )
    rows = sharding.shuffled_shards(docs, ["doc_id"], SHARDS, seed=20240229)
    return rows.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "row_number",
    )


def op11_importance(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text")
    return importance.ranked(docs, table(spark, folder, "benchmark")).drop("n_words")


def op12_simhash(spark, folder):
    return simhash.similarity_groups(table(spark, folder, "documents"))


def op13_prefix_trie(spark, folder):
    turns = durable(prefix_trie.coded_turns(table(spark, folder, "conversations")))
    return prefix_trie.trie_of(*rebuilt(turns))


def rebuilt(turns, every=20, longest=4):
    """(coded turns, conversations): each one begins with the first h turns of every 20th conversation, then come its own after its first h."""
    known = turns.groupBy("conv").agg(F.max("pos").alias("size"))
    base, head = F.col("conv") - F.col("conv") % every, F.crc32(F.col("conv").cast("string").cast("binary")) % longest
    plan = known.select("conv", base.alias("base"), head.alias("h"))
    sizes = known.select(F.col("conv").alias("base"), F.col("size").alias("there"))
    plan = durable(plan.join(sizes, "base", "left").select("*", F.least("h", F.coalesce("there", F.lit(0))).alias("taken")).drop("there"))
    heads = turns.where(F.col("pos") < longest).withColumnRenamed("conv", "base").join(plan, "base").where(F.col("pos") <= F.col("taken"))
    own = turns.join(plan, "conv").where(F.col("pos") > F.col("h")).withColumn("pos", F.col("pos") - F.col("h") + F.col("taken"))
    names = ["conv", "pos", "digest", "words"]
    return heads.select(*names).unionByName(own.select(*names)), plan.select("conv")


QUERIES = {f.__name__: f for f in (op1_ngram_join, op2_bpe, op3_chat, op4_decontaminate, op5_secrets, op6_exact_dedup, op7_pii, op8_quality, op9_token_files, op10_feistel_shards, op11_importance, op12_simhash, op13_prefix_trie)}



def crc32_sql(text):
    """The unsigned CRC-32 of a text's UTF-8 bytes in DuckDB: one step for each bit, lowest bit first."""
    digit = f"instr('0123456789ABCDEF', substr(hex({text}), CAST(2 * (k // 8) + CASE WHEN k % 8 < 4 THEN 2 ELSE 1 END AS BIGINT), 1)) - 1"
    bits = f"list_transform(range(4 * length(hex({text}))), lambda k: (({digit}) >> CAST(k % 4 AS INTEGER)) & 1)"
    step = "lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), {step}), 4294967295)"


SQL = {
    "op1_ngram_join": r"""
        WITH RECURSIVE d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x20\x09-\x0D]+') AS w
            FROM documents),
        grams AS (
            SELECT DISTINCT doc_id, array_to_string(w[k : k + 2], ' ') AS gram
            FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS k FROM d WHERE len(w) > 0)),
        sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
        shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS common
            FROM grams x JOIN grams y ON x.gram = y.gram AND x.doc_id <> y.doc_id GROUP BY ALL),
        links AS (
            SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * common >= 90 * (p.n + q.n - common)),
        reached AS (
            SELECT doc_id, doc_id AS other FROM d
            UNION
            SELECT reached.doc_id, links.b FROM reached JOIN links ON links.a = reached.other)
        SELECT doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, min(other) AS component_id
        FROM reached LEFT JOIN sizes USING (doc_id) GROUP BY doc_id, n
    """,
    "op4_decontaminate": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        b AS (
            SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark),
        windows AS (
            SELECT DISTINCT item, least(len(w), 10) AS n,
                array_to_string(w[k : k + 9], ' ') AS words
            FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS k FROM b WHERE len(w) > 0)),
        lengths AS (SELECT DISTINCT n FROM windows),
        runs AS (
            SELECT doc_id, k, n, array_to_string(w[k : k + n - 1], ' ') AS words
            FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS k FROM d), lengths
            WHERE k + n - 1 <= len(w)),
        hits AS (SELECT doc_id, k, runs.n AS n, item FROM runs JOIN windows USING (words) WHERE runs.n = windows.n),
        covered AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(k, k + n)) AS p FROM hits) GROUP BY doc_id),
        named AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
            FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id)
        SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
            CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
            coalesce(n_hit, 0) > 0 AS contaminated
        FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)
    """,
    "op11_importance": rf"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(
                translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM documents),
        own AS (SELECT doc_id, word, count(*) AS n FROM (SELECT doc_id, unnest(w) AS word FROM d) GROUP BY ALL),
        wanted AS (
            SELECT word, count(*) AS n FROM (
                SELECT unnest(regexp_extract_all(
                    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')) AS word
                FROM benchmark)
            GROUP BY word),
        words AS (
            SELECT word, {crc32_sql('word')} % 10000 AS bucket
            FROM (SELECT word FROM own UNION SELECT word FROM wanted)),
        s AS (SELECT bucket, sum(n) AS n FROM own JOIN words USING (word) GROUP BY bucket),
        t AS (SELECT bucket, sum(n) AS n FROM wanted JOIN words USING (word) GROUP BY bucket),
        totals AS (SELECT CAST((SELECT coalesce(sum(n), 0) FROM s) AS DOUBLE) AS s, CAST((SELECT coalesce(sum(n), 0) FROM t) AS DOUBLE) AS t),
        gains AS (
            SELECT s.bucket AS bucket, CAST(floor(1000 * ln(
                (CAST(coalesce(t.n, 0) AS DOUBLE) + 1) * (totals.s + 10000)
                / ((CAST(s.n AS DOUBLE) + 1) * (totals.t + 10000)))) AS BIGINT) AS gain
            FROM s LEFT JOIN t USING (bucket), totals),
        weights AS (
            SELECT doc_id, CAST(floor(CAST(sum(n * gain) AS DOUBLE) / sum(n)) AS BIGINT) AS weight
            FROM own JOIN words USING (word) JOIN gains USING (bucket) GROUP BY doc_id),
        scored AS (
            SELECT doc_id, CAST(len(w) AS BIGINT) AS n_features, coalesce(weight, 0) AS weight,
                coalesce(weight, 0) + CAST(floor(-1000 * ln(-ln(
                    (CAST(CAST('0x' || substr(sha256('2024:' || doc_id), 1, 8) AS BIGINT) AS DOUBLE) + 0.5::DOUBLE)
                    / 4294967296::DOUBLE))) AS BIGINT) AS score
            FROM d LEFT JOIN weights USING (doc_id)),
        placed AS (
            SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS place, count(*) OVER () AS n
            FROM scored WHERE n_features >= 20)
        SELECT doc_id, n_features, weight, score, CASE WHEN place <= floor(10 * n / 100) THEN place END AS rank
        FROM scored LEFT JOIN placed USING (doc_id)
    """,
    "op13_prefix_trie": rf"""
        WITH turns AS (
            SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS said,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
            FROM conversations WHERE conv_id IS NOT NULL),
        plan AS (
            SELECT c, c - c % 20 AS base, {crc32_sql("CAST(c AS VARCHAR)")} % 4 AS h FROM (SELECT DISTINCT c FROM turns)),
        new AS (
            SELECT plan.c AS c, 0 AS part, pos, role, said FROM plan JOIN turns ON turns.c = base AND pos <= h
            UNION ALL
            SELECT c, 1 AS part, pos, role, said FROM plan JOIN turns USING (c) WHERE pos > h),
        seqs AS (
            SELECT plan.c AS c, coalesce(list(struct_pack(role := role, said := said) ORDER BY part, pos) FILTER (WHERE pos IS NOT NULL), []) AS seq
            FROM plan LEFT JOIN new USING (c) GROUP BY plan.c),
        paths AS (
            SELECT c, d, seq[1:d] AS prefix, len(seq) = d AS ending,
                CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(seq[d].said, '[^\x20\x09-\x0D]+')) END AS words
            FROM (SELECT c, seq, unnest(range(0, len(seq) + 1)) AS d FROM seqs)),
        named AS (SELECT *, min(c) OVER (PARTITION BY d, prefix) AS low FROM paths),
        nodes AS (
            SELECT low, d, count(*) AS n, any_value(words) AS words,
                string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (WHERE ending) AS ends
            FROM named GROUP BY low, d),
        upper AS (SELECT x.low, x.d, y.low AS parent FROM nodes x LEFT JOIN named y ON y.c = x.low AND y.d = x.d - 1),
        children AS (SELECT parent AS low, d - 1 AS d, count(*) AS n_children FROM upper WHERE d > 0 GROUP BY ALL),
        below AS (
            SELECT a.low, a.d, sum((x.n - 1) * x.words) AS saved, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves
            FROM nodes x LEFT JOIN children k USING (low, d) JOIN named a ON a.c = x.low AND a.d <= x.d GROUP BY ALL)
        SELECT low AS conv_id, CAST(d AS BIGINT) AS depth, parent AS parent_conv_id, CAST(n AS BIGINT) AS n_convs,
            CAST(coalesce(n_children, 0) AS BIGINT) AS n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
            CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
        FROM nodes JOIN upper USING (low, d) JOIN below USING (low, d) LEFT JOIN children USING (low, d)
    """,
    "op6_exact_dedup": r"""
        WITH t AS (
            SELECT doc_id, length(coalesce(text, '')) AS chars,
                regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS content
            FROM documents)
        SELECT doc_id, first_value(doc_id) OVER w AS keep_id,
            CAST(count(*) OVER (PARTITION BY content) AS BIGINT) AS group_size,
            doc_id = first_value(doc_id) OVER w AS kept, sha256(content) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY content ORDER BY chars DESC, doc_id)
    """,
}
