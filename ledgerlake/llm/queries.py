"""Registered queries of the training-data operators and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlake.llm import (
    bestfit, chat, chunks, langid, lexical, mixing, packing, pii, quality, simhash, substrings, toxicity, whitening,
)
from ledgerlake.llm.common import held_out, table


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = langid.identify(docs, ~held_out(F.col("doc_id")))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.in_reply_order(chat.link_replies(table(spark, sf_dir, "conversations")))


OP3_SQL = r"""
WITH RECURSIVE m AS (SELECT row_number() OVER () AS r, conv_id, turn, role, coalesce(text, '') AS t FROM conversations),
l AS (SELECT r, i, x, len(regexp_replace(regexp_extract(x, '^[ \t]*(?:>[ \t]?)+'), '[^>]', '', 'g')) AS level,
             regexp_replace(x, '^[ \t]*(?:>[ \t]?)+', '') AS body
      FROM (SELECT r, unnest(range(1, len(s) + 1)) AS i, unnest(s) AS x FROM (SELECT r, string_split_regex(t, '\r?\n') AS s FROM m))),
n AS (SELECT *, coalesce(lead(level) OVER (PARTITION BY r ORDER BY i), 0) AS below,
             CASE WHEN level > 0 AND trim(regexp_replace(body, '\s+', ' ', 'g')) <> '' THEN level ELSE 0 END AS kind FROM l),
own AS (SELECT r, string_agg(body, chr(10) ORDER BY i) FILTER (level = 0 AND NOT (below > 0 AND
               regexp_matches(body, '^\s*(?:On .*wrote|Am .*schrieb.*|Le .*a écrit|El .*escribió|.* (?:writes|said)) ?:\s*$'))) AS o FROM n GROUP BY r),
clean AS (SELECT r, regexp_replace(regexp_replace(coalesce(o, ''), '\n\s*\n', chr(10) || chr(10), 'g'), '\A\s+|\s+\z', '', 'g') AS text FROM own),
b AS (SELECT *, sum(new) OVER (PARTITION BY r ORDER BY i) AS run
      FROM (SELECT *, (kind <> coalesce(lag(kind) OVER (PARTITION BY r ORDER BY i), 0))::INT AS new FROM n)),
q AS (SELECT r, run, min(level) AS level, min(i) AS pos, string_agg(body, ' ' ORDER BY i) AS whole, list(body ORDER BY i) AS bodies
      FROM b WHERE kind > 0 GROUP BY r, run),
tried AS (SELECT r, level, pos, unnest(c) AS c, unnest(range(len(c))) AS nth
          FROM (SELECT *, [whole] || bodies || string_split(regexp_replace(regexp_replace(whole, '\s+', ' ', 'g'), '([.!?]) ', '\1' || chr(10), 'g'), chr(10)) AS c FROM q)),
cand AS (SELECT r, level, pos, nth, norm, len(string_split(norm, ' ')) AS n
         FROM (SELECT *, trim(regexp_replace(lower(c), '[^\p{L}\p{N}]+', ' ', 'g')) AS norm FROM tried) WHERE norm <> ''),
p AS (SELECT DISTINCT conv_id, turn, norm FROM (
        SELECT r, trim(regexp_replace(lower(unnest([text] || string_split_regex(text, '\n[ \t]*\n') || string_split(text, chr(10))
               || string_split(regexp_replace(regexp_replace(text, '\s+', ' ', 'g'), '([.!?]) ', '\1' || chr(10), 'g'), chr(10)))), '[^\p{L}\p{N}]+', ' ', 'g')) AS norm FROM clean)
      JOIN m USING (r) WHERE turn IS NOT NULL AND norm <> ''),
here AS (SELECT conv_id, norm, min(turn) AS turn FROM p GROUP BY ALL),
away AS (SELECT norm, conv_id, turn, row_number() OVER (PARTITION BY norm ORDER BY conv_id) AS place FROM here WHERE conv_id IS NOT NULL),
k AS (SELECT * FROM (
        SELECT cand.r, level, pos, n, nth, coalesce(here.turn < m.turn, false) AS inside, a.conv_id IS NOT DISTINCT FROM m.conv_id AS mine,
               CASE WHEN inside THEN m.conv_id WHEN n >= 3 AND mine THEN b.conv_id WHEN n >= 3 THEN a.conv_id END AS fc,
               CASE WHEN inside THEN here.turn WHEN n >= 3 AND mine THEN b.turn WHEN n >= 3 THEN a.turn END AS ft
        FROM cand JOIN m USING (r) LEFT JOIN here ON here.conv_id = m.conv_id AND here.norm = cand.norm
        LEFT JOIN away a ON a.norm = cand.norm AND a.place = 1 LEFT JOIN away b ON b.norm = cand.norm AND b.place = 2)
      WHERE inside OR fc IS NOT NULL),
best AS (SELECT r, fc, ft FROM k QUALIFY row_number() OVER (PARTITION BY r ORDER BY level, pos, n DESC, nth) = 1),
e AS (SELECT conv_id, turn, min(ft) AS up FROM best JOIN m USING (r) WHERE fc = conv_id AND ft < turn GROUP BY ALL),
w AS (SELECT conv_id, turn, up AS thread_turn, 1::BIGINT AS depth FROM e
      UNION ALL SELECT w.conv_id, w.turn, e.up, w.depth + 1 FROM w JOIN e ON e.conv_id = w.conv_id AND e.turn = w.thread_turn),
t AS (SELECT conv_id, turn, min(thread_turn) AS thread_turn, max(depth) AS depth FROM w GROUP BY ALL)
SELECT m.conv_id, m.turn, role, text, (SELECT count(*) FROM q WHERE q.r = m.r)::BIGINT AS n_quotes, fc AS quoted_conv, ft AS quoted_turn,
       coalesce(thread_turn, m.turn) AS thread_turn, coalesce(depth, 0)::BIGINT AS depth,
       '<|' || replace(replace(coalesce(role, 'unknown'), '<|', '< |'), '|>', '| >') || '|>' || chr(10)
       || replace(replace(text, '<|', '< |'), '|>', '| >') || chr(10) AS rendered
FROM m JOIN clean USING (r) LEFT JOIN best USING (r) LEFT JOIN t ON t.conv_id = m.conv_id AND t.turn = m.turn
"""


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", mixing.word_count(F.col("text")).alias("words"))
    mixed = mixing.mix(docs, size=F.col("words"))
    rows = mixed.select("doc_id", *[F.col("mix")[c].alias(c) for c in ("size", "source_size", "target", "taken", "position")])
    order = [F.col("position").asc_nulls_last(), "doc_id"]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


OP4_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(md5('mix:' || doc_id::VARCHAR), '~') AS h,
                  coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, (1 + (row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3)::DOUBLE AS w FROM s),
l AS (SELECT *, sum(source_size) OVER () - coalesce(sum(3 * source_size) OVER o, 0) AS rest,
             sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS w_rest
      FROM w WINDOW o AS (ORDER BY 3 * source_size / w, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT *, w * rest >= 3 * source_size * w_rest AS capped FROM l),
t AS (SELECT source, source_size, (w - 1)::INT AS slot, CASE WHEN capped THEN 3.0::DOUBLE * source_size
             ELSE w * (max(rest::DOUBLE) FILTER (NOT capped AND w_rest = top) OVER ()) / top END AS target
      FROM (SELECT *, max(w_rest) FILTER (NOT capped) OVER () AS top FROM f)),
c AS (SELECT d.*, source_size, target, slot,
             coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY h, doc_id, size, r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pre
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(0, least(size, floor(target) - pre)) + greatest(0, least(size, floor(target) - source_size - pre))
        + greatest(0, least(size, floor(target) - 2 * source_size - pre)))::BIGINT AS taken,
       -- where the schedule's integral reaches the first word: weights 2t; 1 up to 3 at the middle and down again; 4 - 2t
       CASE WHEN least(size, floor(target) - pre) > 0 THEN
         CASE WHEN pre = 0 THEN 0.0::DOUBLE
              WHEN slot = 0 THEN 2.0::DOUBLE * share / (0.0::DOUBLE + sqrt(4.0::DOUBLE * share))
              WHEN slot = 1 AND 2 * share < 1 THEN 2.0::DOUBLE * (2 * share) / (1.0::DOUBLE + sqrt(1.0::DOUBLE + 8.0::DOUBLE * (2 * share)))
              WHEN slot = 1 AND 2 * share = 1 THEN 0.5::DOUBLE
              WHEN slot = 1 THEN 0.5::DOUBLE + 2.0::DOUBLE * (2 * share - 1) / (3.0::DOUBLE + sqrt(9.0::DOUBLE + -8.0::DOUBLE * (2 * share - 1)))
              ELSE 2.0::DOUBLE * (3 * share) / (4.0::DOUBLE + sqrt(16.0::DOUBLE + -4.0::DOUBLE * (3 * share))) END END AS position
FROM (SELECT *, pre::DOUBLE / target AS share FROM c)
"""


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.digest(packing.pack(table(spark, sf_dir, "documents"), tokenizer_file()))


def op6_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chunks.compare_with_edits(table(spark, sf_dir, "documents"))


def op7_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.digest(substrings.deduplicate(table(spark, sf_dir, "documents")))


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents")).drop("host_rate")


OP8_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, source, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS l FROM d),
g AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
again AS (SELECT r, i FROM g QUALIFY count(*) OVER (PARTITION BY r, g) > 1),
cover AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest(range(i, i + 5)) AS p FROM again) GROUP BY r),
m AS (SELECT doc_id, source, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words
      FROM w LEFT JOIN cover USING (r)),
b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m),
h AS (SELECT source, count(*)::DOUBLE AS n, (count(*) FILTER (base_failed OR 100 * n_symbols > 10 * n_words OR 100 * n_dup_lines > 5 * n_words
             OR word_chars < 2 * n_words OR word_chars > 15 * n_words))::DOUBLE AS f FROM b WHERE source IS NOT NULL GROUP BY source),
c AS (SELECT sum(f) / sum(n) AS m, sum(f * f / n) / sum(n) AS q, count(*) / sum(n) AS hn FROM h),
p AS (SELECT m, CASE WHEN q - m * m - m * (1 - m) * hn > 1e-12
             THEN least(1e6, greatest(1.0, m * (1 - m) / (q - m * m - m * (1 - m) * hn) - 1)) ELSE 1e6 END AS s FROM c)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND coalesce((f + m * s) / (n + s) < 0.5, true) AS kept
FROM b CROSS JOIN p LEFT JOIN h USING (source)
"""


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.digest(pii.detect(table(spark, sf_dir, "documents")))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), ~held_out(F.col("doc_id")))
    found = toxicity.score(docs, model)
    return found.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted")
    )


def op11_lexical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP11_SQL = r"""
WITH words AS (SELECT r, doc_id, unnest(regexp_extract_all(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
               FROM (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents)),
asked AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
size AS (SELECT r, doc_id, count(*)::BIGINT AS n FROM words GROUP BY r, doc_id),
total AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS terms FROM size),
posting AS (SELECT r, term, count(*)::BIGINT AS tf FROM words WHERE term IN (SELECT term FROM asked) GROUP BY r, term),
weight AS (SELECT term, floor(1000 * ln((2 * max(docs) + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM posting CROSS JOIN total GROUP BY term),
part AS (SELECT r, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms))) AS part
         FROM posting JOIN size USING (r) JOIN weight USING (term) CROSS JOIN total),
score AS (SELECT item_id, r, doc_id, sum(part)::BIGINT AS score FROM asked JOIN part USING (term) GROUP BY item_id, r, doc_id)
SELECT item_id, rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id ASC NULLS LAST)::INTEGER AS rank FROM score WHERE score > 0)
WHERE rank <= 10
"""


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op13_bestfit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bestfit.pack(table(spark, sf_dir, "documents"), tokenizer_file(), keep_ids=False)


_QUERIES = (
    op1_simhash, op2_language, op3_chat, op4_mixing, op5_packing, op6_chunks, op7_substrings, op8_quality, op9_pii, op10_toxicity,
    op11_lexical, op12_whitening, op13_bestfit,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return {"op3_chat": OP3_SQL, "op4_mixing": OP4_SQL, "op8_quality": OP8_SQL, "op11_lexical": OP11_SQL}
