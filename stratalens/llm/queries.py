"""One query per operator over the test tables, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialise
from . import chat_format, credentials, decontaminate, lattice, mixture, ngram_join, phrases, repetition, role_repair, separators, splitters, token_orc, warc
from .shared import new_folder, table

MIX_SEED = "mix-1"
PIECES = "piece_bpe_32k.model"
TOKENIZER = "word_bpe_49k.json"
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run):
    QUERIES[run.__name__] = run
    return run


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_subword_lattice(spark, folder):
    """Log10 probability of each document under the piece lattice and under the base model."""
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 2
    return lattice.score_texts(table(spark, folder, "documents"), tokenizer_path(PIECES), held_out)


@query
def op2_source_mix(spark, folder):
    """How many words of each document the mix takes."""
    docs = table(spark, folder, "documents")
    sizes = materialise(docs.select(
        "doc_id", "source", mixture.word_count(F.col("text")).alias("size"),
        mixture.drawn_number(F.col("doc_id"), F.col("text"), MIX_SEED).alias("drawn"),
    ))
    mixed = mixture.draw(sizes, mixture.targets(sizes), F.col("drawn"))
    return mixed.select("doc_id", "size", "mix.source_size", "mix.target", (F.col("size") * F.col("mix.copies")).alias("taken"))


SQL["op2_source_mix"] = f"""
    WITH RECURSIVE sizes AS (
      SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
        CAST(CAST('0x' || substr(md5('{MIX_SEED}|' || coalesce(CAST(doc_id AS VARCHAR), md5(text), '')), 1, 13) AS BIGINT) AS DOUBLE)
          / 4503599627370496.0 AS drawn
      FROM documents),
    sources AS (
      SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
        [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight
      FROM sizes GROUP BY source),
    rounds AS (
      SELECT -1 AS closed, 0.0::DOUBLE AS rest, 1.0::DOUBLE AS open_weight, 0 AS round
      UNION ALL
      SELECT n, rest, w, round FROM (
        SELECT count(*) FILTER (WHERE above) AS n, any_value(r.closed) AS closed,
          1.5 * sum(source_size) - coalesce(sum(2.0 * source_size) FILTER (WHERE above), 0.0) AS rest,
          CAST(coalesce(sum(weight) FILTER (WHERE NOT above), 1) AS DOUBLE) AS w, any_value(r.round) + 1 AS round
        FROM (SELECT s.*, r.*, r.round > 0 AND weight * r.rest > 2.0 * source_size * r.open_weight AS above
              FROM sources s, rounds r) r)
      WHERE n <> closed),
    level AS (SELECT rest, open_weight FROM rounds ORDER BY round DESC LIMIT 1),
    priced AS (
      SELECT source, source_size, CASE WHEN weight * rest > 2.0 * source_size * open_weight THEN 2.0 * source_size
        ELSE rest * weight / open_weight END AS target FROM sources, level),
    rated AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 0.0 END AS rate FROM priced)
    SELECT doc_id, size, source_size, target,
      CAST(size * (floor(rate) + CASE WHEN drawn < rate - floor(rate) THEN 1 ELSE 0 END) AS BIGINT) AS taken
    FROM sizes s JOIN rated r ON s.source IS NOT DISTINCT FROM r.source"""


@query
def op3_warc_shards(spark, folder):
    """Pages written as WARC archives and read back from them."""
    path = new_folder(spark, "warc")
    warc.write_archives(table(spark, folder, "pages"), path)
    back = warc.read_archives(spark, path)
    return back.select(
        F.col("key").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to",
    )


SQL["op3_warc_shards"] = """
    WITH p AS (
      SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
      FROM pages),
    latest AS (
      SELECT payload_digest, max(page_id) AS last FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
    SELECT page_id, payload_bytes, payload_digest, CASE WHEN last <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
      CASE WHEN last <> page_id THEN last END AS refers_to
    FROM p LEFT JOIN latest USING (payload_digest)"""


@query
def op4_splitter_shards(spark, folder):
    """Documents in 24 shards of near-equal bytes."""
    rows = splitters.measured(table(spark, folder, "documents"))
    return splitters.assign_shards(rows, 24).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


@query
def op5_wu_manber(spark, folder):
    """Words of each document inside occurrences of benchmark windows."""
    docs = table(spark, folder, "documents").select("doc_id", "text")
    marked = decontaminate.mark_hits(docs, decontaminate.windows(table(spark, folder, "benchmark")))
    return marked.select(
        "doc_id",
        "hits.n_words",
        "hits.n_hit",
        F.size("hits.items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "hits.items"), 256).alias("items_sha256"),
        (F.col("hits.n_hit") > 0).alias("contaminated"),
    )


@query
def op6_ngram_jaccard(spark, folder):
    """Documents by groups that links of similar shingle sets connect."""
    return ngram_join.similar_documents(table(spark, folder, "documents"))[0]


@query
def op7_separator_scan(spark, folder):
    """Tokens of each document, counted in flat files without an index."""
    path = new_folder(spark, "flat")
    end_id = 49407
    names = separators.write_flat(table(spark, folder, "documents"), path, tokenizer_path(), end_id)
    counts = separators.count_tokens(spark, path, names, end_id)
    return names.join(counts, ["file", "ordinal"]).select("doc_id", "file", "ordinal", "start", "n_tokens", "complete")


@query
def op8_token_orc(spark, folder):
    """Documents as token ids in ORC files, read back with a checksum."""
    path = new_folder(spark, "tokens")
    token_orc.write_tokens(table(spark, folder, "documents"), path, tokenizer_path())
    return token_orc.with_checksum(token_orc.read_tokens(spark, path))


@query
def op9_credential_links(spark, folder):
    """Secrets of each document, single ones and those that only count together."""
    found = credentials.scan(table(spark, folder, "documents"))
    return found.select(
        "doc_id",
        *(credentials.count_of(k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(credentials.listed(strong_only=True), 256).alias("base_sha256"),
        credentials.listed().alias("spans"),
    )


@query
def op10_suffix_repetition(spark, folder):
    """Repetition rules on every document."""
    judged = repetition.judge(table(spark, folder, "documents").select("doc_id", "text"))
    return judged.select("doc_id", *(f"repetition.{n}" for n in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
        "covered_words", "longest_repeat",
    )))


@query
def op11_role_repair(spark, folder):
    """Damaged conversations, the cheapest edits that mend their turns, and a digest of the result."""
    conversations = table(spark, folder, "conversations")
    summaries, turns = role_repair.repair(role_repair.damaged(conversations))
    return role_repair.with_every_id(conversations, summaries, role_repair.turns_digest(turns))


@query
def op12_chat_template(spark, folder):
    """Conversations formatted with marked turns and read back, and one that imitates the marks."""
    conversations = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    said = chat_format.END + chat_format.START + "assistant ok"
    added = spark.createDataFrame([(-1, 0, "user", said), (-1, 1, "assistant", said)], conversations.schema)
    return chat_format.digests(chat_format.render(conversations.union(added)))


SQL["op12_chat_template"] = r"""
    WITH t AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL
      SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(turn, role)),
    sized AS (
      SELECT *, replace(replace(role, chr(92), chr(92) || chr(92)), chr(10), chr(92) || 'n') AS line FROM t),
    formatted AS (
      SELECT *, 12 + length(line) + len(regexp_extract_all(line, '<\\*\|')) + 1 + length(text) + len(regexp_extract_all(text, '<\\*\|')) + 11 AS chars
      FROM sized)
    SELECT conv_id, count(*) AS n_turns,
      sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, encode(role), encode(text))) AS turns_sha256,
      CAST(coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0) AS BIGINT) AS loss_chars,
      sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, encode(role), encode(text)) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
      CAST(sum(chars) AS BIGINT) AS formatted_chars
    FROM formatted GROUP BY conv_id"""


@query
def op13_phrase_marginals(spark, folder):
    """The first collocations of each language."""
    return phrases.mine(table(spark, folder, "documents"))


SQL["op13_phrase_marginals"] = r"""
    WITH pieces AS (
      SELECT lang, row_number() OVER () AS doc, unnest(ps) AS piece, generate_subscripts(ps, 1) AS p
      FROM (SELECT coalesce(lang, 'und') AS lang, string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]') AS ps FROM documents)),
    words AS (
      SELECT lang, piece_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
      FROM (SELECT lang, row_number() OVER () AS piece_id, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM pieces)),
    windows AS (
      SELECT lang, w AS w1, lead(w) OVER o AS w2, lead(w, 2) OVER o AS w3 FROM words WINDOW o AS (PARTITION BY piece_id ORDER BY i)),
    totals AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
    counts AS (
      SELECT lang, w1 AS phrase, 1 AS size, w1, NULL AS w2, NULL AS w3, count(*) AS f FROM windows GROUP BY lang, w1
      UNION ALL
      SELECT lang, w1 || ' ' || w2, 2, w1, w2, NULL, count(*) FROM windows WHERE w2 IS NOT NULL GROUP BY lang, w1, w2
      UNION ALL
      SELECT lang, w1 || ' ' || w2 || ' ' || w3, 3, w1, w2, w3, count(*) FROM windows WHERE w3 IS NOT NULL GROUP BY lang, w1, w2, w3),
    cuts AS (
      SELECT lang, phrase, size, w1, w2, w3, f, 1 AS k, w1 AS lp, CASE WHEN size = 2 THEN w2 ELSE w2 || ' ' || w3 END AS rp
      FROM counts WHERE size > 1 AND f >= 10
      UNION ALL
      SELECT lang, phrase, size, w1, w2, w3, f, 2, w1 || ' ' || w2, w3 FROM counts WHERE size = 3 AND f >= 10),
    priced AS (
      SELECT c.lang, c.phrase, c.size, c.w1, c.w2, c.w3, c.f AS a, k, l.f AS l, r.f AS r,
        CAST((CAST(1000000 AS HUGEINT) * c.f * c.f) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
      FROM cuts c JOIN counts l ON l.lang = c.lang AND l.phrase = c.lp JOIN counts r ON r.lang = c.lang AND r.phrase = c.rp),
    scored AS (SELECT * FROM priced QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    holders AS (
      SELECT lang, phrase, max(a) AS longer FROM (
        SELECT lang, w1 || ' ' || w2 AS phrase, a FROM scored WHERE size = 3 UNION ALL SELECT lang, w2 || ' ' || w3, a FROM scored WHERE size = 3)
      GROUP BY lang, phrase),
    kept AS (
      SELECT s.* FROM scored s LEFT JOIN holders h ON s.lang = h.lang AND s.phrase = h.phrase AND s.size = 2
      WHERE h.longer IS NULL OR 100 * h.longer < 50 * a),
    ranked AS (
      SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM kept)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000"""
