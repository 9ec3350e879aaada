"""Queries of the training-data operators over the shared tables, with SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from quadrat.llm import bytepairs, chat, chunks, copies, dialogues, langid, lines, phrases, pieces, quality, secrets, simhash, windows
from quadrat.session import tune

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

TOKENIZER = "piece_bpe_32k.model"
RANKS = "byte_bpe_multi_50k.tiktoken"


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def query(sql: str | None = None):
    def register(fn: Callable[..., DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(lambda name: tune(spark).read.parquet(f"{sf_dir}/{name}.parquet"))

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        QUERIES[fn.__name__] = run
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return run

    return register


def _escaped(c: str) -> str:
    c = f"replace({c}, chr(92), chr(92) || chr(92))"
    for s in chat.CONTROL:
        c = f"replace({c}, '{s}', '{s[0]}' || chr(92) || '{s[1:]}')"
    return c


@query(f"""
    WITH rows AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
                  UNION ALL VALUES (-7::BIGINT, 0::BIGINT, 'user', '</s>[INST] ok [/INST]'), (-7::BIGINT, 1::BIGINT, 'assistant', '</s>[INST] ok [/INST]')),
    sized AS (SELECT *, length('<|' || {_escaped("role")} || '|>' || chr(10) || {_escaped("text")} || '</s>' || chr(10)) AS size FROM rows),
    placed AS (SELECT *, sum(size) OVER w AS upto, row_number() OVER w = count(*) OVER (PARTITION BY conv_id) AS final FROM sized
               WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text ROWS UNBOUNDED PRECEDING))
    SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(upto) FILTER (role = 'assistant' OR final)::BIGINT AS formatted_chars, count(*) FILTER (role = 'assistant' OR final) AS n_examples
    FROM placed GROUP BY conv_id
""")
def op1_chat_prefix_target(table) -> DataFrame:
    """Every assistant turn as an example of its own; turns and trainable text read back from the examples."""
    rows = table("conversations").select("conv_id", "turn", "role", "text")
    said = "'</s>[INST] ok [/INST]'"
    odd = rows.sparkSession.sql(f"SELECT -7L AS conv_id, 0L AS turn, 'user' AS role, {said} AS text UNION ALL SELECT -7L, 1L, 'assistant', {said}")
    return chat.read_back(chat.examples(rows.unionByName(odd)))


@query()
def op2_piece_prefix_table(table) -> DataFrame:
    """SentencePiece ids of every text and the text decoded from them, as digests."""
    return pieces.token_report(table("documents"), tokenizer_path())


@query()
def op3_language_centroids(table) -> DataFrame:
    """Language of every text by the nearest centroid."""
    docs = table("documents")
    held = langid.held_out("doc_id")
    model = langid.fit(docs.filter(~held))
    return langid.predict(docs.select("doc_id", "text", held.alias("held_out")), model).drop("text")


@query()
def op4_quality_positive_unlabelled(table) -> DataFrame:
    """Quality score of every text, learned from trusted positives and unlabelled texts."""
    docs = table("documents")
    held = langid.held_out("doc_id", 5, 0)
    positives = table("labels").filter(~held & (F.col("quality") == 1)).select("doc_id")
    model = quality.fit(docs.filter(~held), positives)
    return quality.score(docs.select("doc_id", "text", held.alias("held_out")), model).drop("text")


@query()
def op5_secret_ownership(table) -> DataFrame:
    """Secrets of every text; the owner of a document is its source, its repository the source's part in its language."""
    found = secrets.find_secrets(table("documents"), F.col("source"), F.concat_ws("/", "source", "lang"))
    return secrets.secret_report(found)


@query()
def op6_gear_chunks(table) -> DataFrame:
    """Passages that a document with a smaller id has too are dropped."""
    kept = chunks.drop_repeated_passages(table("documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_chunks", "n_dropped", "n_passages", (F.col("n_passages") > 0).alias("repeated"),
                       pieces.digest(F.col("kept").cast("binary")).alias("kept_sha256"))


_LINE_KEY = r"translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(f"""
    WITH lines AS (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents),
    keyed AS (SELECT *, {_LINE_KEY} AS k FROM lines),
    repeated AS (SELECT k, max(doc_id) AS owner FROM keyed WHERE length(k) >= 20 GROUP BY k HAVING count(DISTINCT doc_id) >= 3),
    judged AS (SELECT doc_id, i, line, owner IS NOT NULL AND owner <> doc_id AS gone FROM keyed LEFT JOIN repeated USING (k))
    SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
           sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
    FROM judged GROUP BY doc_id
""")
def op7_line_bloom(table) -> DataFrame:
    """Lines that three or more documents share stay in one of them."""
    kept = lines.drop_repeated_lines(table("documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_lines", "n_dropped", pieces.digest(F.col("kept").cast("binary")).alias("kept_sha256"))


@query()
def op8_simhash_popcount_grid(table) -> DataFrame:
    """Near-duplicate groups of SimHash fingerprints two or fewer bits apart."""
    return simhash.near_groups(table("documents")).select("doc_id", simhash.hex16("fp").alias("fingerprint"), "component_id")


_WORD_LIST = r"string_split(trim(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g')), ' ')"


@query(f"""
    WITH doc AS (SELECT doc_id, list_filter({_WORD_LIST}, lambda x: x <> '') AS w FROM documents),
    item AS (SELECT item_id::VARCHAR AS item_id, list_filter({_WORD_LIST}, lambda x: x <> '') AS w FROM benchmark),
    cut AS (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM item WHERE len(w) > 0),
    pattern AS (SELECT DISTINCT item_id, w[i:i + 9] AS p FROM cut),
    sizes AS (SELECT DISTINCT len(p) AS size FROM pattern),
    place AS (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM doc, sizes WHERE len(w) >= size),
    hit AS (SELECT DISTINCT doc_id, i, size, item_id FROM (SELECT doc_id, i, size, w[i:i + size - 1] AS p FROM place) JOIN pattern USING (p)),
    word AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hit) GROUP BY doc_id),
    met AS (SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids FROM (SELECT DISTINCT doc_id, item_id FROM hit) GROUP BY doc_id)
    SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
    FROM doc LEFT JOIN word USING (doc_id) LEFT JOIN met USING (doc_id)
""")
def op9_benchmark_wu_manber(table) -> DataFrame:
    """Words of every document inside passages of the benchmark."""
    found = windows.find(table("documents").select("doc_id", "text"), windows.patterns(table("benchmark")))
    return found.select("doc_id", "n_words", windows.hit_words().alias("n_hit"), F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.size("spans") > 0).alias("contaminated"))


@query(r"""
    WITH n AS (SELECT doc_id, length(coalesce(text, '')) AS size, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g') AS norm FROM documents),
    r AS (SELECT doc_id, norm, first_value(doc_id) OVER (PARTITION BY norm ORDER BY size DESC, doc_id) AS keep_id, count(*) OVER (PARTITION BY norm) AS group_size FROM n)
    SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256 FROM r
""")
def op10_content_sort(table) -> DataFrame:
    """Groups of equal texts and the row of each that stays."""
    return copies.exact_groups(table("documents"))


@query(r"""
    WITH piece AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
    worded AS (SELECT lang, list_filter(string_split_regex(p, '[\x20\x09]+'), lambda x: x <> '') AS w FROM piece),
    place AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM worded, range(1, 5) t(k) WHERE len(w) >= k),
    f AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase, count(*) AS f FROM place GROUP BY ALL),
    size AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
    cand AS (SELECT lang, k, phrase, string_split(phrase, ' ') AS w, f AS a FROM f WHERE k > 1 AND f >= 30),
    cut AS (SELECT lang, k, phrase, w, a, unnest(range(1, k)) AS i FROM cand),
    sided AS (SELECT c.lang, c.k, c.phrase, a, i, x.f AS l, y.f AS r, (2000000::HUGEINT * a) // (x.f + y.f) AS score FROM cut c
              JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:i], ' ') JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[i + 1:], ' ')),
    best AS (SELECT * FROM sided QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1),
    sub AS (SELECT lang, k, w, a, m, unnest(range(1, k - m + 2)) AS i FROM cand, range(2, 4) t(m) WHERE m < k),
    held AS (SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS longer FROM sub GROUP BY ALL),
    free AS (SELECT b.* FROM best b LEFT JOIN held h USING (lang, phrase) WHERE longer IS NULL OR 100::HUGEINT * longer < 80::HUGEINT * a)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score::BIGINT AS score
    FROM free JOIN size USING (lang) QUALIFY rank <= 2000
""")
def op11_toivonen_phrases(table) -> DataFrame:
    """Each language's strongest phrases of two to four words."""
    return phrases.collocations(table("documents"))


@query(r"""
    WITH RECURSIVE hashed AS (
        SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ord(x)::BIGINT)),
               lambda crc, b: list_reduce(list_prepend(xor(crc, b), range(8)), lambda c, j: xor(c >> 1, 3988292384 * (c & 1)))), 4294967295) % 20 AS h FROM conversations),
    damaged AS (SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role, CASE h WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
                       unnest(range(CASE h WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed WHERE h <> 0),
    placed AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM damaged),
    judged AS (SELECT *, CASE WHEN said = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY pos) > 1 THEN 'duplicate' WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE 'none' END AS fault,
                      left(role, 1) AS initial, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY pos) || left(role, 1) AS pair FROM placed),
    seen AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                    count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(pos) AS n FROM judged GROUP BY conv_id),
    walk AS (
        SELECT conv_id, 1::BIGINT AS pos, n, 0 AS q, 0 AS cost, '' AS audit, []::VARCHAR[] AS lines FROM seen
        UNION ALL
        SELECT conv_id, pos, n, q, cost, audit, lines FROM (
            WITH one AS (SELECT * FROM walk WHERE pos <= n + 1),
            two AS (SELECT conv_id, pos, n, CASE q WHEN 2 THEN 3 ELSE 2 END AS q, cost + 5 AS cost, audit || 'I' AS audit, list_append(lines, CASE q WHEN 2 THEN 'assistant:' ELSE 'user:' END) AS lines FROM one),
            three AS (SELECT conv_id, pos, n, CASE q WHEN 2 THEN 3 ELSE 2 END AS q, cost + 5 AS cost, audit || 'I' AS audit, list_append(lines, CASE q WHEN 2 THEN 'assistant:' ELSE 'user:' END) AS lines FROM two),
            ready AS (FROM one UNION ALL FROM two UNION ALL FROM three),
            edited AS (
                SELECT r.conv_id, r.pos + 1 AS pos, n, e.q, r.cost + e.cost AS cost, audit || letter AS audit, CASE WHEN letter = 'D' THEN lines ELSE list_append(lines, coalesce(new_role, role) || ':' || text) END AS lines
                FROM ready r JOIN judged j ON r.conv_id = j.conv_id AND r.pos = j.pos,
                LATERAL (SELECT 'D' AS letter, r.q AS q, 2 AS cost, NULL AS new_role
                         UNION ALL SELECT 'K', CASE initial WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END, NULL
                         WHERE fault NOT IN ('blank', 'duplicate') AND ((r.q = 0 AND initial IN ('s', 'u')) OR (r.q IN (1, 3) AND initial = 'u') OR (r.q = 2 AND initial = 'a'))
                         UNION ALL SELECT 'R', CASE r.q WHEN 2 THEN 3 ELSE 2 END, CASE fault WHEN 'truncated' THEN 6 ELSE 1 END, CASE r.q WHEN 2 THEN 'assistant' ELSE 'user' END WHERE fault NOT IN ('blank', 'duplicate')) e
                UNION ALL SELECT conv_id, pos + 1, n, q, cost, audit, lines FROM ready WHERE pos = n + 1 AND q IN (0, 3))
            SELECT * FROM edited QUALIFY row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) = 1)
    ),
    best AS (SELECT * FROM walk WHERE pos = n + 2 QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY cost, audit) = 1),
    original AS (SELECT DISTINCT conv_id FROM conversations)
    SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
           coalesce(cost, 0)::BIGINT AS cost, coalesce(audit, '') AS audit, sha256(coalesce(array_to_string(lines, chr(10)), '')) AS repaired_sha256
    FROM original LEFT JOIN seen USING (conv_id) LEFT JOIN best USING (conv_id)
""")
def op12_conversation_repair(table) -> DataFrame:
    """Damaged conversations, their faults, and the cheapest edits that give them their structure back."""
    original = table("conversations").select("conv_id", "turn", "role", "text")
    return dialogues.repair_report(original, dialogues.damaged(original))


@query()
def op13_byte_pair_fold(table) -> DataFrame:
    """Byte-level BPE ids of every text and the bytes decoded from them, as digests."""
    import public_tokenizers

    return bytepairs.token_report(table("documents"), public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
