"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import alignment, chat, column_wise, language, lookup_sketch, merkle, near_duplicates, packing, substrings, warc
from tidemark.llm.decontamination import contamination
from tidemark.llm.token_counts import count_tokens
from tidemark.llm.token_files import read_token_files, write_token_files
from tidemark.session import stored

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    def add(run):
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@register()
def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return count_tokens(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), limit=2048
    )


@register()
def op2_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    manifest = write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), end_id=0)
    return read_token_files(manifest, docs.schema["doc_id"].dataType)


@register()
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.encode_pieces(
        table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json")
    )
    digests = packed.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.place(digests).withColumnRenamed("id", "doc_id")


@register(
    """
    WITH w AS (
      SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
      FROM documents
    ), windows AS (
      SELECT doc_id, i, words[i : i + 12] AS run
      FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)
    ), owners AS (
      SELECT run, min(doc_id) AS owner FROM windows GROUP BY run
    ), lost AS (
      SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i
      FROM windows JOIN owners USING (run) WHERE owner < doc_id
    ), lists AS (
      SELECT doc_id, list(i) AS gone FROM lost GROUP BY doc_id
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
      sha256(array_to_string(
        list_transform(
          list_filter(range(1, len(words) + 1), lambda k: NOT list_contains(coalesce(gone, []), k)), lambda k: words[k]
        ), ' ')) AS kept_sha256
    FROM w LEFT JOIN lists USING (doc_id)
    """
)
def op3_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return substrings.remove_repeated(docs).select(
        "row.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256")
    )


_WORDS_8 = """list_filter(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '')"""


@register(
    f"""
    WITH d AS (SELECT doc_id, {_WORDS_8} AS words FROM documents),
    b AS (SELECT item_id, {_WORDS_8} AS words FROM benchmark),
    runs AS (
      SELECT DISTINCT item_id, words[i : i + 12] AS run
      FROM (SELECT item_id, words, unnest(range(1, greatest(len(words) - 12, 1) + 1)) AS i FROM b WHERE len(words) > 0)
    ), sizes AS (SELECT DISTINCT len(run) AS n FROM runs),
    places AS (
      SELECT doc_id, i, words[i : i + n - 1] AS run
      FROM (SELECT doc_id, words, n, unnest(range(1, len(words) - n + 2)) AS i FROM d, sizes WHERE len(words) >= n)
    ), found AS (SELECT doc_id, i, run, item_id FROM places JOIN runs USING (run)),
    hits AS (
      SELECT doc_id, count(DISTINCT k) AS n_hit
      FROM (SELECT doc_id, unnest(range(i, i + len(run))) AS k FROM found) GROUP BY doc_id
    ), items AS (
      SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS listed
      FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
    )
    SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit,
      coalesce(n_items, 0)::BIGINT AS n_items, sha256(coalesce(listed, '')) AS items_sha256,
      coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
    FROM d LEFT JOIN hits USING (doc_id) LEFT JOIN items USING (doc_id)
    """
)
def op8_contamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = contamination(docs, table(spark, sf_dir, "benchmark"))
    return marked.select(
        "row.doc_id",
        "n_words",
        "n_hit",
        "n_items",
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        "contaminated",
    )


@register(
    """
    WITH p AS (
      SELECT page_id, url, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
      FROM pages
    ), f AS (
      SELECT payload_digest, min(page_id) AS first FROM p WHERE payload_bytes >= 100 GROUP BY payload_digest
    )
    SELECT page_id, payload_bytes, payload_digest, url AS requested_uri,
      CASE WHEN first < page_id THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN first < page_id THEN first END AS refers_to
    FROM p LEFT JOIN f USING (payload_digest)
    """
)
def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    archives = warc.write_archives(warc.captures_of(pages))
    captures = stored(warc.assemble(archives, payloads=False), "captures")
    page = F.col("metadata.fields")["page-id"].cast(pages.schema["page_id"].dataType)
    # What a revisit refers to: the capture of the response that it names.
    responses = captures.where("response.type = 'response'").select(
        F.col("response.record_id").alias("of"),
        page.alias("refers_to"),
        F.col("response.payload_sha256").alias("named_sha256"),
    )
    return captures.join(responses.hint("merge"), F.col("response.refers_to") == F.col("of"), "left").select(
        page.alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        # Of the bytes that the archive has.
        F.coalesce("response.payload_sha256", "named_sha256").alias("payload_digest"),
        F.col("response.type").alias("record_type"),
        "refers_to",
        F.col("request.target_uri").alias("requested_uri"),
    )


def _escaped_length(column: str) -> str:
    extra = " + ".join(
        f"(length({column}) - length(replace({column}, '{s}', ''))) // {len(s)}" for s in ("\\", *chat.RESERVED)
    )
    return f"length({column}) + {extra}"


@register(
    f"""
    WITH c AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, * FROM (VALUES (0, 'user', '</s>[INST] ok [/INST]'), (1, 'assistant', '</s>[INST] ok [/INST]'))
    )
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
      coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
      sum(CASE WHEN role = 'assistant' THEN 7 ELSE 14 + {_escaped_length("role")} END
        + {_escaped_length("text")})::BIGINT AS formatted_chars
    FROM c GROUP BY conv_id
    """
)
def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    return chat.conversation_digests(chat.format_conversations(turns.unionByName(extra), tokenizer), tokenizer)


def held_out() -> Column:
    """Rows that nothing is learned from: crc32 of the id as text, modulo 4, is 2."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2


@register()
def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    filters = language.fit(docs.where(~held_out()))
    found = language.identify(docs.select("doc_id", "text"), filters)
    return found.select("row.doc_id", "lang_pred", "score", "known").withColumn("held_out", held_out())


@register(
    """
    WITH RECURSIVE w AS (
      SELECT doc_id, list_filter(string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
      FROM documents
    ), shingles AS (
      SELECT DISTINCT doc_id, words[i : i + 2] AS s
      FROM (SELECT doc_id, words, unnest(range(1, greatest(len(words) - 2, 1) + 1)) AS i FROM w WHERE len(words) > 0)
    ), sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
    common AS (
      SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c
      FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL
    ), links AS (
      SELECT a, b FROM common JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
      WHERE 100 * c >= 85 * (x.n + y.n - c)
    ), reached(doc_id, other) AS (
      SELECT doc_id, doc_id FROM documents
      UNION
      SELECT r.doc_id, l.b FROM reached r JOIN links l ON l.a = r.other
    ), least AS (SELECT doc_id, min(other) AS component_id FROM reached GROUP BY doc_id)
    SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
    FROM least LEFT JOIN sizes USING (doc_id)
    """
)
def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = near_duplicates.components(docs, similarity=0.85, shingle=3)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", "kept")


@register()
def op4_lookup_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lookup_sketch.compare_versions(table(spark, sf_dir, "documents"))


@register(
    """
    WITH t AS (
      SELECT row_number() OVER () AS r, doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents
    ), b AS (SELECT r, doc_id, x, length(x) // 2 AS n FROM t),
    -- Windows are cut from parts of a text: to find a place in a long string takes time.
    parts AS (
      SELECT r, doc_id, o, x[2 * o + 1 : 2 * o + 1198] AS part, least(500, n - 99 - o) AS many
      FROM (SELECT r, doc_id, x, n, unnest(range(0, n - 99, 500)) AS o FROM b WHERE n >= 100 AND doc_id IS NOT NULL)
    ), windows AS (
      SELECT r, doc_id, o + k AS i, part[2 * k + 1 : 2 * k + 200] AS run
      FROM (SELECT r, doc_id, o, part, unnest(range(0, many)) AS k FROM parts)
    ), firsts AS (SELECT run, min({'d': doc_id, 'i': i}) AS f FROM windows GROUP BY run),
    lost AS (
      SELECT r, i, lag(i) OVER w AS before, lead(i) OVER w AS next
      FROM windows JOIN firsts USING (run) WHERE f < {'d': doc_id, 'i': i}
      WINDOW w AS (PARTITION BY r ORDER BY i)
    ), spans AS (
      SELECT r, min(i) AS a, max(i) + 100 AS z
      FROM (SELECT r, i, sum(CASE WHEN i <= before + 100 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS g FROM lost)
      GROUP BY r, g
    ), pieces AS (
      SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS from_ FROM spans
    ), heads AS (
      SELECT r, count(*) AS n_spans, sum(z - a) AS n_removed, max(z) AS last,
        string_agg(x[2 * from_ + 1 : 2 * a], '' ORDER BY a) AS head
      FROM pieces JOIN b USING (r) GROUP BY r
    )
    SELECT doc_id, n::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
      sha256(unhex(coalesce(head, '') || x[2 * coalesce(last, 0) + 1 :])) AS kept_sha256
    FROM b LEFT JOIN heads USING (r)
    """
)
def op11_column_wise_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return column_wise.remove_repeated(docs).select(
        "row.doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


@register()
def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = alignment.align(
        table(spark, sf_dir, "documents"),
        public_tokenizers.path("byte_bpe_50k.json"),
        public_tokenizers.path("piece_bpe_32k.model"),
    )
    return found.withColumnRenamed("id", "doc_id")


_FIELD = "coalesce(strlen({0}::VARCHAR)::VARCHAR || ':' || {0}::VARCHAR, '-')"
_HEAD = " || ".join(_FIELD.format(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
# DuckDB has no crc32: of a decimal number's bytes it is a fold over 256 table entries made here.
_CRC = """
    WITH RECURSIVE entry(i, k, c) AS (
      SELECT i::BIGINT, 0, i::BIGINT FROM range(256) t(i)
      UNION ALL
      SELECT i, k + 1, CASE WHEN c % 2 = 1 THEN xor(3988292384::BIGINT, c // 2) ELSE c // 2 END FROM entry WHERE k < 8
    ), crcs AS (SELECT list(c ORDER BY i) AS crc FROM entry WHERE k = 8),
"""


@register(
    f"""
    {_CRC}
    sums(doc_id, rest, c) AS (
      SELECT DISTINCT doc_id, doc_id::VARCHAR, 4294967295::BIGINT FROM documents WHERE doc_id IS NOT NULL
      UNION ALL
      SELECT doc_id, rest[2:], xor(crc[1 + xor(c, ord(rest[1]))::BIGINT % 256], c // 256) FROM sums, crcs WHERE rest <> ''
    ), picked AS (SELECT doc_id FROM sums WHERE rest = '' AND xor(c, 4294967295::BIGINT) % 5 = 0),
    digests AS (
      SELECT doc_id, source, sha256({_HEAD} || {_FIELD.format("text")}) AS leaf,
        sha256({_HEAD} || CASE WHEN p.doc_id IS NULL THEN {_FIELD.format("text")} ELSE {_FIELD.format(_LOWERED)} END) AS shown
      FROM documents LEFT JOIN picked p USING (doc_id)
    ), leaves AS (
      SELECT doc_id, leaf, shown, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree,
        row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
        count(*) OVER (PARTITION BY source) AS n
      FROM digests
    ), up(tree, level, pos, h, n) AS (
      SELECT tree, 0, pos, leaf, n FROM leaves
      UNION ALL
      SELECT tree, level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16 FROM up
      WHERE n > 1 GROUP BY tree, level, pos // 16, n
    ), subroots AS (SELECT tree, h AS subroot, count(*) OVER () AS trees FROM up WHERE n = 1),
    top(level, pos, h, n) AS (
      SELECT 0, tree, subroot, trees FROM subroots
      UNION ALL
      SELECT level + 1, pos // 16, sha256(string_agg(h, '' ORDER BY pos)), (n + 15) // 16 FROM top
      WHERE n > 1 GROUP BY level, pos // 16, n
    ), whole AS (SELECT h AS root FROM top WHERE n = 1),
    runs AS (
      SELECT tree, level, pos // 16 AS run, list(h ORDER BY pos) AS hs FROM up WHERE n > 1 GROUP BY tree, level, pos // 16
      UNION ALL
      SELECT -1, level, pos // 16, list(h ORDER BY pos) FROM top WHERE n > 1 GROUP BY level, pos // 16
    ), climb(doc_id, leaf, home, tree, level, pos, folded, proof) AS (
      SELECT doc_id, leaf, tree, tree, 0, pos, shown, '' FROM leaves
      UNION ALL
      SELECT c.doc_id, c.leaf, c.home, coalesce(r.tree, -1), CASE WHEN r.tree IS NULL THEN 0 ELSE c.level + 1 END,
        CASE WHEN r.tree IS NULL THEN c.home ELSE c.pos // 16 END,
        CASE WHEN r.tree IS NULL THEN c.folded ELSE sha256(array_to_string(hs[: c.pos % 16], '')
          || c.folded || array_to_string(hs[c.pos % 16 + 2 :], '')) END,
        CASE WHEN r.tree IS NULL THEN c.proof ELSE c.proof || array_to_string(hs[: c.pos % 16], '')
          || array_to_string(hs[c.pos % 16 + 2 :], '') END
      FROM climb c LEFT JOIN runs r ON r.tree = c.tree AND r.level = c.level AND r.run = c.pos // 16
      WHERE r.tree IS NOT NULL OR c.tree >= 0
    ), tops AS (SELECT max(level) AS highest FROM top)
    SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
    FROM climb JOIN tops ON climb.tree = -1 AND climb.level = highest JOIN subroots ON subroots.tree = home, whole
    """
)
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    head = [F.col(c) for c in ("doc_id", "source", "lang", "n_chars")]
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    leaves = docs.select(
        F.col("source").alias("tree"),
        F.col("doc_id").alias("id"),
        merkle.leaf_digest(*head, F.col("text")).alias("leaf"),
        F.when(tampered, merkle.leaf_digest(*head, merkle.ascii_lower(F.col("text")))).alias("shown"),
    )
    return merkle.climb(merkle.build(leaves)).select(
        F.col("id").alias("doc_id"),
        "leaf",
        "subroot",
        "root",
        F.col("proof").alias("proof_sha256"),
        "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )
