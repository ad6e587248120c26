"""Registered queries of the operators, with the SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from snapledger.llm.common import table

QUERIES: dict = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def register(function):
        QUERIES[function.__name__] = function
        if sql:
            SQL[function.__name__] = sql
        return function

    return register


@query()
def op5_covering_simhash(spark, sf_dir):
    from snapledger.llm.simhash import simhash_components

    return simhash_components(table(spark, sf_dir, "documents"), shingle=3, radius=2).select(
        "doc_id", "fingerprint", "component_id"
    )


@query()
def op10_rotated_codes(spark, sf_dir):
    from snapledger.llm.embeddings import embedding_links

    return embedding_links(table(spark, sf_dir, "embeddings"), threshold=0.98)


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query()
def op4_best_fit_packing(spark, sf_dir):
    from snapledger.llm.packing import cut, place

    pieces = cut(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))
    # The digest stands in for the ids from here on.
    digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return place(digests).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


@query()
def op8_token_counts(spark, sf_dir):
    from snapledger.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"))


@query()
def op9_token_blocks(spark, sf_dir):
    from snapledger.llm.token_files import read_token_files, write_token_files
    from snapledger.session import scratch_path

    path = scratch_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents")
    write_token_files(docs, path, tokenizer_path("word_bpe_49k.json"), end_id=2)
    return read_token_files(spark, path).select(
        "doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32")
    )


OP1_ESCAPED = """
    replace(replace(replace(coalesce({}, ''), '\\', '\\\\'), '</turn>', '<\\/turn>'), '### ', '#\\## ')
"""


@query(
    f"""
    WITH turns AS (
        SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM (
            SELECT conv_id, turn, role, text FROM conversations
            UNION ALL VALUES (-7, 0, 'user', '\\### Assistant: </turn> ok'),
                             (-7, 1, 'assistant', '\\### Assistant: </turn> ok'))
    )
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text))
               AS turns_sha256,
           CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text)
               FILTER (role = 'assistant'), '')) AS loss_sha256,
           CAST(sum(14 + length(replace({OP1_ESCAPED.format("role")}, ':' || chr(10), ':\\' || chr(10)))
               + length({OP1_ESCAPED.format("text")})) AS BIGINT) AS formatted_chars,
           count(*) FILTER (role = 'assistant') AS n_examples
    FROM turns GROUP BY conv_id
    """
)
def op1_prefix_examples(spark, sf_dir):
    from snapledger.llm.chat import loss_text, prefix_examples, read_turns

    said = "\\### Assistant: </turn> ok"
    trap = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.element_at(F.array(F.lit("user"), F.lit("assistant")), F.col("id").cast("int") + 1).alias(
            "role"
        ),
        F.lit(said).alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    examples = prefix_examples(turns.unionByName(trap))
    replies = F.array_sort(
        F.collect_list(
            F.when(
                F.col("example").isNotNull(),
                F.struct(
                    "example",
                    loss_text(F.col("text"), F.col("loss_start"), F.col("loss_end")).alias("reply"),
                ),
            )
        )
    )
    read = examples.groupBy("conv_id").agg(
        F.max(F.when(F.col("widest"), F.col("text"))).alias("text"), replies.alias("replies")
    )
    turn = F.transform(
        "turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    loss = F.array_join(F.transform("replies", lambda r: r["reply"]), "")
    return read.withColumn("turns", read_turns(F.col("text"))).select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(turn, ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        F.length("text").cast("long").alias("formatted_chars"),
        F.size("replies").cast("long").alias("n_examples"),
    )


@query()
def op2_toxic_spans(spark, sf_dir):
    from snapledger.llm.toxicity import held_out, toxic_spans, train

    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").where(~held_out("doc_id"))
    return toxic_spans(docs, train(docs, labels)).select(
        "doc_id", held_out("doc_id").alias("held_out"), "score", "predicted", "spans"
    )


@query()
def op7_term_disclosure(spark, sf_dir):
    from snapledger.llm.disclosure import KINDS, personal_data

    def listed(spans):
        texts = F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))
        )
        return F.array_join(texts, ",")

    def number(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return personal_data(docs).select(
        "doc_id",
        *[number(kind) for kind in KINDS],
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


@query()
def op6_sketch_fingerprints(spark, sf_dir):
    from snapledger.llm.sketches import fingerprints

    return fingerprints(table(spark, sf_dir, "documents"))


@query()
def op3_raked_mixture(spark, sf_dir):
    from snapledger.llm.mixing import layout_topic, raked_sample, word_count

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    dims = {"source": F.col("source"), "lang": F.col("lang"), "topic": layout_topic(F.col("text"))}
    return raked_sample(docs, dims, word_count(F.col("text"))).select(
        "doc_id", "mix_source", "mix_lang", "mix_topic", "factor", "probability", "kept", "copies"
    )


OP11_CRC = """
    xor(4294967295, list_reduce(
        [4294967295::BIGINT] || flatten(list_transform(
            string_split(CAST(conv_id AS VARCHAR), ''),
            lambda c: [CAST(ord(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0])),
        lambda a, e: CASE WHEN xor(a, e) & 1 = 1 THEN xor(xor(a, e) >> 1, 3988292384) ELSE xor(a, e) >> 1 END))
"""


@query(
    f"""
    WITH own AS (
        SELECT conv_id, list({{'role': role, 'text': text}} ORDER BY turn NULLS FIRST, role, sha256(text)) AS turns
        FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
              FROM conversations WHERE conv_id IS NOT NULL)
        GROUP BY conv_id
    ), heads AS (
        SELECT conv_id, turns, conv_id - conv_id % 100 AS source, {OP11_CRC} % 6 AS h FROM own
    ), rebuilt AS (
        SELECT c.conv_id, list_concat(coalesce(list_slice(s.turns, 1, c.h), []),
                                      list_slice(c.turns, c.h + 1, len(c.turns))) AS turns
        FROM heads c LEFT JOIN own s ON s.conv_id = c.source
    ), chained AS (
        SELECT conv_id, len(turns) AS n, list_reduce([''] || list_transform(turns,
                   lambda t: sha256(len(t.role) || ':' || t.role || t.text)), lambda a, t: a || t) AS ids,
               list_transform(turns, lambda t: length(t.text)) AS chars
        FROM rebuilt
    ), prefixes AS (
        SELECT conv_id, n, unnest(range(n + 1)) AS depth, ids, chars FROM chained
    ), placed AS (
        SELECT sha256(left(ids, 64 * depth)) AS node, depth, conv_id, n,
               coalesce(chars[depth], 0) AS chars,
               sha256(left(ids, 64 * (depth - 1))) AS parent, ids
        FROM prefixes
    ), nodes AS (
        SELECT node, depth, any_value(left(ids, 64 * depth)) AS path, min(conv_id) AS conv_id,
               count(*) AS n_convs, any_value(parent) AS parent, any_value(chars) AS chars,
               sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)
                   FILTER (n = depth), '')) AS ends_sha256
        FROM placed GROUP BY node, depth
    ), children AS (
        SELECT parent AS node, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY parent
    ), counted AS (
        SELECT n.*, coalesce(c.n_children, 0) AS n_children FROM nodes n LEFT JOIN children c USING (node)
    ), above AS (
        SELECT sha256(left(path, 64 * up)) AS node, CAST(n_children = 0 AS BIGINT) AS leaf,
               (n_convs - 1) * chars AS saved
        FROM (SELECT *, unnest(range(depth + 1)) AS up FROM counted)
    ), sums AS (
        SELECT node, CAST(sum(leaf) AS BIGINT) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens
        FROM above GROUP BY node
    )
    SELECT a.conv_id, CAST(a.depth AS BIGINT) AS depth, p.conv_id AS parent_conv_id, a.n_convs,
           a.n_children, n_leaves, saved_tokens, a.ends_sha256
    FROM counted a JOIN sums USING (node) LEFT JOIN nodes p ON a.depth > 0 AND p.node = a.parent
    """
)
def op11_prefix_trie(spark, sf_dir):
    from snapledger.llm.conversation_trie import prefix_trie, turn_paths, with_shared_openings

    turns = table(spark, sf_dir, "conversations")
    return prefix_trie(with_shared_openings(turn_paths(turns)))


# Vectors that take part, as lists of whole numbers in double precision: products are exact.
WHOLE_VECTORS = """
    SELECT row_number() OVER () AS k, {columns},
           list_transform(embedding, lambda x: floor({scale} * CAST(x AS DOUBLE))) AS v
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
"""


@query(
    f"""
    WITH rows AS ({WHOLE_VECTORS.format(columns="vec_id, label", scale=256)} AND label IS NOT NULL),
    rel AS (
        SELECT k, vec_id, v, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label FROM rows
    ), scored AS (
        SELECT a.k AS anchor, a.vec_id AS anchor_id, b.k, b.vec_id, a.label = b.label AS same,
               CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
        FROM rel a JOIN rel b ON a.k <> b.k AND len(a.v) = len(b.v) WHERE a.vec_id % 100 = 0
    ), positives AS (
        SELECT * FROM scored WHERE same QUALIFY row_number() OVER (
            PARTITION BY anchor ORDER BY score DESC, vec_id NULLS LAST) <= 5
    )
    SELECT p.anchor_id, p.vec_id AS positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor, p.k ORDER BY n.score DESC, n.vec_id NULLS LAST, n.k) AS INTEGER) AS rank,
           n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
    FROM positives p JOIN scored n ON p.anchor = n.anchor AND NOT n.same
        AND 80 * p.score <= 100 * n.score AND 100 * n.score <= 100 * p.score
    QUALIFY rank <= 5
    """
)
def op12_hard_negatives(spark, sf_dir):
    from snapledger.llm.hard_negatives import hard_negatives

    vec_id, label = F.col("vec_id"), F.col("label").cast("long")
    noisy = F.when(vec_id % 7 == 0, (label + 1) % 10).otherwise(label)
    return hard_negatives(table(spark, sf_dir, "embeddings"), vec_id % 100 == 0, noisy)


@query(
    f"""
    WITH rel AS ({WHOLE_VECTORS.format(columns="vec_id", scale=64)}),
    scored AS (
        SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score,
               CAST(row_number() OVER (PARTITION BY a.k ORDER BY list_inner_product(a.v, b.v) DESC,
                   b.vec_id NULLS LAST, b.k) AS INTEGER) AS rank
        FROM rel a JOIN rel b ON a.k <> b.k AND len(a.v) = len(b.v) WHERE a.vec_id % 20 = 0
    )
    SELECT query_id, rank, vec_id, score FROM scored WHERE rank <= 20
    """
)
def op13_vector_file_search(spark, sf_dir):
    from snapledger.llm.vector_files import nearest

    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20, scale=64)
