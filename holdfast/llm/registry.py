"""The registered queries of the operators and the pipeline, and their SQL."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from pyspark.sql import functions as F

from holdfast.llm import (
    bpe,
    chat_format,
    embedding_dedup,
    exact_dedup,
    html_extraction,
    packing,
    pii,
    prefix_trie,
    quality,
    simhash,
    substring_dedup,
    token_files,
    vector_codes,
)
from holdfast.runtime import scratch_path

TOKENIZER = "byte_bpe_50k.json"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query("op1_token_files")
def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(
        table(spark, sf_dir, "documents"), path, public_tokenizers.path(TOKENIZER), end_id=2
    )
    return token_files.token_index(spark, path)


@query("op2_bpe")
def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return bpe.round_trip(table(spark, sf_dir, "documents").select("doc_id", "text"), path).select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(decimal, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op10_packing")
def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER), end_id=1)
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )


@query(
    "op9_exact_dedup",
    r"""
    WITH normal AS (
        SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents
    ), groups AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM normal GROUP BY t)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
    FROM normal JOIN groups USING (t)
    """,
)
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query("op8_simhash")
def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_groups(table(spark, sf_dir, "documents"), words=3, radius=3)
    return found.select("doc_id", F.lpad(F.lower(F.hex("print")), 16, "0").alias("fingerprint"), "component_id")


@query("op7_quality")
def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", quality.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@query("op4_embedding_dedup")
def op4_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"), threshold=0.93)


@query("op5_substring_dedup")
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=13)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op6_pii")
def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.train(docs))

    def listed(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    counts = [F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}") for kind in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(listed("base"), 256).alias("base_sha256"), listed("spans").alias("spans"))


@query("op3_html_extraction")
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    found = html_extraction.extract(pages, html_extraction.train(pages))
    return found.select("page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))


#: A turn as the formatted text shows it, and whether it had to be escaped, in SQL.
SHOWN_TURNS = r"""
    shown AS (
        SELECT conv_id, turn, role, text,
            CASE WHEN role IN ('system', 'user', 'assistant', 'tool') THEN upper(role[1]) || role[2:] ELSE 'Role ' || role END AS label,
            regexp_matches(role || chr(10) || text, '#\\*## |<\\*/turn>') OR (
                role NOT IN ('system', 'user', 'assistant', 'tool') AND regexp_matches(role, ':\\* ')) AS conflict
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
              UNION ALL SELECT -7, n, ['user', 'assistant'][n + 1], '\### Assistant: </turn> ok' FROM range(2) t(n))
    ), bodies AS (
        SELECT *, CASE WHEN conflict THEN regexp_replace(regexp_replace(text, '#(\\*)## ', '#\\\1## ', 'g'), '<(\\*)/turn>', '<\\\1/turn>', 'g')
            ELSE text END AS body,
            CASE WHEN conflict THEN regexp_replace(regexp_replace(regexp_replace(
                label, '#(\\*)## ', '#\\\1## ', 'g'), '<(\\*)/turn>', '<\\\1/turn>', 'g'), ':(\\*) ', ':\\\1 ', 'g') ELSE label END AS head
        FROM shown
    )
"""


@query(
    "op11_chat_format",
    f"""
    WITH {SHOWN_TURNS}
    SELECT conv_id, count(*) AS n_turns,
        sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, body)) AS turns_sha256,
        sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
        sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, body) FILTER (role = 'assistant'), '')) AS loss_sha256,
        sum(length('### ' || head || ': ' || body || '</turn>' || chr(10)))::BIGINT AS formatted_chars
    FROM bodies GROUP BY conv_id
    """,
)
def op11_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"),
        F.lit(r"\### Assistant: </turn> ok").alias("text"),
    )
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").union(planted)
    output = chat_format.format_conversations(rows)
    text = chat_format.formatted(F.col("segments"))
    read = output.select("conv_id", chat_format.parse(text).alias("turns"), chat_format.learnt(F.col("segments")).alias("learnt"), F.char_length(text).cast("long").alias("formatted_chars"))
    told = F.transform("turns", lambda turn: F.concat(turn["role"], F.lit("\n"), turn["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(told, ""), 256).alias("turns_sha256"),
        F.char_length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        "formatted_chars",
    )


#: Conversations rebuilt, as lists of (role, text); `step` is one bit of a CRC-32.
REBUILT = """
    turns AS (
        SELECT conv_id, list({'r': role, 't': text} ORDER BY turn NULLS FIRST, sha256(length(role) || ':' || role || text)) AS ts
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
        GROUP BY conv_id
    ), heads AS (
        SELECT conv_id, ts, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
            lambda crc, byte: list_reduce(list_concat([xor(crc, byte)], list_transform(range(8), lambda i: 0::BIGINT)),
                lambda x, i: xor(x >> 1, (x & 1) * 3988292384))), 4294967295) % 9 AS h
        FROM turns
    ), rebuilt AS (
        SELECT c.conv_id, list_concat(coalesce(b.ts, [])[:c.h], c.ts[c.h + 1:]) AS ts
        FROM heads c LEFT JOIN turns b ON b.conv_id = c.conv_id - c.conv_id % 5
    )
"""


@query(
    "op12_prefix_trie",
    f"""
    WITH {REBUILT}, prefixes AS (
        SELECT conv_id, d AS depth, ts[:d] AS p, d = len(ts) AS ends
        FROM (SELECT conv_id, ts, unnest(range(len(ts) + 1)) AS d FROM rebuilt)
    ), nodes AS (
        SELECT p, depth, min(conv_id) AS conv_id, count(*) AS n_convs, coalesce(octet_length(encode(p[depth].t)), 0) AS bytes,
            sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
        FROM prefixes GROUP BY p, depth
    ), family AS (
        SELECT n.*, (SELECT count(*) FROM nodes c WHERE c.depth = n.depth + 1 AND c.p[:n.depth] = n.p) AS n_children,
            (SELECT u.conv_id FROM nodes u WHERE u.depth = n.depth - 1 AND u.p = n.p[:n.depth - 1]) AS parent_conv_id
        FROM nodes n
    ), below AS (
        SELECT t.depth, t.p, count(*) FILTER (s.n_children = 0) AS n_leaves, sum((s.n_convs - 1) * s.bytes)::BIGINT AS saved_tokens
        FROM family t JOIN family s ON s.depth >= t.depth AND s.p[:t.depth] = t.p GROUP BY t.depth, t.p
    )
    SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 FROM family JOIN below USING (depth, p)
    """,
)
def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    ordered = prefix_trie.ordered_turns(table(spark, sf_dir, "conversations"))
    ends = F.array_join(F.col("ends").cast("array<string>"), ",")
    found = prefix_trie.prefix_trie(*prefix_trie.borrowed_start(ordered))
    return found.withColumn("ends_sha256", F.sha2(ends, 256)).drop("ends")


def _assigned(name: str, books: str) -> str:
    """SQL: every part of every vector with the index of its nearest entry in `books`, from 1, and the distance."""
    return f"""
    {name} AS (
        SELECT part, vec_id, label, x, least.i AS i, least.d AS d FROM (
            SELECT points.*, list_min(list_transform(entries, lambda e, k: {{
                'd': list_sum(list_transform(list_zip(x, e), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'i': k}})) AS least
            FROM points JOIN {books} USING (part))
    )"""


def _improved(name: str, books: str, assigned: str) -> str:
    """SQL: the codebooks after a round."""
    return f"""
    {name} AS (
        SELECT part, list(coalesce(mean, entry) ORDER BY i) AS entries FROM (
            SELECT part, unnest(entries) AS entry, generate_subscripts(entries, 1) AS i FROM {books}
        ) LEFT JOIN (
            SELECT part, i, list(mean ORDER BY spot) AS mean FROM (
                SELECT part, i, spot, floor(sum(c)::DOUBLE / count(*))::BIGINT AS mean
                FROM (SELECT part, i, unnest(x) AS c, generate_subscripts(x, 1) AS spot FROM {assigned}) GROUP BY part, i, spot
            ) GROUP BY part, i
        ) USING (part, i) GROUP BY part
    )"""


@query(
    "op13_vector_codes",
    f"""
    WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ), points AS (
        SELECT vec_id, label, p AS part, v[p * (len(v) // 16) + 1:(p + 1) * (len(v) // 16)] AS x
        FROM kept, (SELECT unnest(range(16)) AS p)
    ), books0 AS (
        SELECT part, list(x ORDER BY vec_id) AS entries FROM points
        WHERE vec_id IN (SELECT vec_id FROM kept ORDER BY vec_id LIMIT 64) GROUP BY part
    ), {_assigned("near0", "books0")}, {_improved("books1", "books0", "near0")},
    {_assigned("near1", "books1")}, {_improved("books2", "books1", "near1")}, {_assigned("near2", "books2")},
    coded AS (
        SELECT vec_id, any_value(label) AS label, string_agg(printf('%02x', i - 1), '' ORDER BY part) AS code, sum(d)::BIGINT AS error
        FROM near2 GROUP BY vec_id
    )
    SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
        (SELECT sha256(string_agg(array_to_string(flatten(entries), ','), ',' ORDER BY part)) FROM books2) AS codebooks_sha256
    FROM coded
    """,
)
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    blocks = vector_codes.VectorBlocks(table(spark, sf_dir, "embeddings"), parts=16)
    books = vector_codes.fit(blocks, entries=64, rounds=2)
    listed = ",".join(str(number) for part in books.entries for entry in part for number in entry)
    found = vector_codes.with_label_errors(blocks.encoded(books), blocks.rows)
    return found.select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(hashlib.sha256(listed.encode()).hexdigest()).alias("codebooks_sha256"),
    )
