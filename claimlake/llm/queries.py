"""The numbered queries of this subpackage and the pipeline, and their DuckDB
twins where SQL can express them.  Each applies its operator to its whole table."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlake.llm import (conversation, decontaminate, hilbert, line_dedup, mixture, neighbours, pii, rule_quality, secret_scan,
                           simhash, spelling, substring_dedup, token_count)
from claimlake.llm.common import table

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op1_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.token_counts(table(spark, sf_dir, "documents"))


def op2_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))


def op3_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"))


def op4_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find(table(spark, sf_dir, "documents"))


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("spans")


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix(table(spark, sf_dir, "documents"))


def op9_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = hilbert.assign(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rule_quality.scored(docs, rule_quality.train(docs, table(spark, sf_dir, "labels")))


def op11_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation.repair(conversation.damage(table(spark, sf_dir, "conversations")), present_col="present")


def op12_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.digests(table(spark, sf_dir, "documents"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


QUERIES = {
    "op1_tokens": op1_tokens,
    "op2_substrings": op2_substrings,
    "op3_neighbours": op3_neighbours,
    "op4_pii": op4_pii,
    "op5_decontaminate": op5_decontaminate,
    "op6_secrets": op6_secrets,
    "op7_simhash": op7_simhash,
    "op8_mix": op8_mix,
    "op9_shards": op9_shards,
    "op10_quality": op10_quality,
    "op11_conversations": op11_conversations,
    "op12_lines": op12_lines,
    "op13_spelling": op13_spelling,
    "pipeline": corpus_pipeline.run,
}

_WORDS = (f"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), "
          r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')")

_STRIP = "chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

#: CRC-32 of a text's UTF-8 bytes, by table; needs the CTE crc_table.
_CRC_TABLE = """crc_table AS (SELECT list(c ORDER BY i) AS tab FROM (SELECT i, list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM (SELECT unnest(range(256)) AS i)))"""


def _crc32(text: str) -> str:
    octets = f"list_transform(range(octet_length(encode({text}))), lambda i: CAST('0x' || substr(hex({text}), CAST(2 * i + 1 AS INTEGER), 2) AS BIGINT))"
    return (f"xor(4294967295, list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {octets}), "
            "lambda c, b: xor(c >> 8, tab[1 + (xor(c, b) & 255)])))")


_ENDS_WELL = "regexp_matches(text, '[.!?][\\x20\\x09-\\x0D]*$')"


def _repair_sql() -> str:
    """Cheapest repairs from the last row on: (cost, audit) for each grammar state."""
    worst = "{'c': 1000000000, 'a': ''}"

    def best(*choices: str) -> str:
        return f"list_min([{', '.join(choices)}])"

    def then(cost: str, letter: str, state: int) -> str:
        return f"{{'c': v{state}.c + {cost}, 'a': '{letter}' || v{state}.a}}"

    to_user, given = 2, [2, 2, 3, 2]
    keep = [[("s", 1), ("u", to_user)], [("u", to_user)], [("a", 3)], [("u", to_user)]]
    extra = "CASE WHEN fault = 'truncated' THEN 5 ELSE 0 END"
    steps = []
    for q in range(4):
        stays = f"CASE WHEN fault IN ('blank', 'duplicate') THEN {worst} "
        kept = stays + " ".join(f"WHEN ini = '{i}' THEN {then(extra, 'K', s)}" for i, s in keep[q]) + f" ELSE {worst} END"
        steps.append(best(then("2", "D", q), kept, stays + f"ELSE {then(f'1 + {extra}', 'R', given[q])} END") + f" AS w{q}")
    inserts = []
    for q in range(4):  # one row before this one; two would lead back or to what one reaches
        to = given[q]
        inserts.append(best(f"w{q}", f"{{'c': w{to}.c + 5, 'a': 'I' || w{to}.a}}") + f" AS v{q}")
    return f"""
WITH RECURSIVE {_CRC_TABLE},
     lots AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                     {_crc32("concat(coalesce(CAST(conv_id AS VARCHAR), ' '), ':', coalesce(CAST(turn AS VARCHAR), ' '))")} % 20 AS lot
              FROM conversations, crc_table),
     hurt AS (SELECT conv_id, turn, CASE WHEN lot = 4 THEN 'user' ELSE role END AS role,
                     CASE lot WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
                     unnest(CASE WHEN lot = 3 THEN [0, 1] ELSE [0] END) AS copy FROM lots WHERE lot <> 0),
     placed AS (SELECT *, left(role, 1) AS ini, row_number() OVER w AS pos, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS nth,
                       count(*) OVER (PARTITION BY conv_id) AS n, lag(left(role, 1)) OVER w AS earlier
                FROM hurt WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy)),
     judged AS (SELECT *, CASE WHEN NOT regexp_matches(text, '[^\\x20\\x09-\\x0D]') THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                               WHEN NOT {_ENDS_WELL} THEN 'truncated' ELSE 'none' END AS fault FROM placed),
     stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
                      count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
                      count(*) FILTER (earlier IS NOT NULL AND earlier || ini NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id),
     going AS (SELECT conv_id, max(n) AS left_over, {{'c': 0, 'a': ''}} AS v0, {{'c': 10, 'a': 'II'}} AS v1, {{'c': 5, 'a': 'I'}} AS v2, {{'c': 0, 'a': ''}} AS v3
               FROM judged GROUP BY conv_id
               UNION ALL
               SELECT conv_id, left_over, {', '.join(inserts)}
               FROM (SELECT g.conv_id, g.left_over - 1 AS left_over, {', '.join(steps)}
                     FROM going AS g JOIN judged AS j ON g.conv_id IS NOT DISTINCT FROM j.conv_id AND j.pos = g.left_over)),
     solved AS (SELECT conv_id, v0.c AS cost, v0.a AS audit FROM going WHERE left_over = 0),
     edits AS (SELECT conv_id, unnest(range(1, len(audit) + 1)) AS k, audit FROM solved),
     acts AS (SELECT conv_id, k, audit[k] AS act, count(*) FILTER (audit[k] <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS pos FROM edits),
     stay AS (SELECT a.conv_id, a.k, a.act, j.role, j.text,
                     row_number() OVER (PARTITION BY a.conv_id ORDER BY a.k) AS place,
                     max(CASE WHEN a.act = 'K' AND j.ini = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY a.conv_id) AS has_system
              FROM acts AS a LEFT JOIN judged AS j ON a.act <> 'I' AND a.conv_id IS NOT DISTINCT FROM j.conv_id AND a.pos = j.pos WHERE a.act <> 'D'),
     fixed AS (SELECT conv_id, k, CASE WHEN act = 'K' THEN role WHEN (place - has_system) % 2 = 1 THEN 'user' ELSE 'assistant' END
                                  || ':' || coalesce(text, '') AS line FROM stay),
     joined AS (SELECT conv_id, string_agg(line, chr(10) ORDER BY k) AS body FROM fixed GROUP BY conv_id)
SELECT c.conv_id, coalesce(s.gaps, 0) AS gaps, coalesce(s.blank, 0) AS blank, coalesce(s.duplicate, 0) AS duplicate,
       coalesce(s.truncated, 0) AS truncated, coalesce(s.illegal, 0) AS illegal, CAST(coalesce(r.cost, 0) AS BIGINT) AS cost,
       coalesce(r.audit, '') AS audit, sha256(coalesce(b.body, '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) AS c LEFT JOIN stats AS s ON c.conv_id IS NOT DISTINCT FROM s.conv_id
     LEFT JOIN solved AS r ON c.conv_id IS NOT DISTINCT FROM r.conv_id LEFT JOIN joined AS b ON c.conv_id IS NOT DISTINCT FROM b.conv_id"""


ORACLES = {
    "op11_conversations": _repair_sql(),
    "op12_lines": f"""
WITH lines AS (SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS pos
               FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
     keyed AS (SELECT *, translate(trim(line, {_STRIP}), '{_UPPER}', '{_LOWER}') AS k FROM lines),
     many AS (SELECT k, max(doc_id) AS keeper FROM keyed WHERE length(k) >= 40 GROUP BY k HAVING count(DISTINCT doc_id) >= 5),
     marked AS (SELECT l.doc_id, l.line, l.pos, coalesce(m.keeper <> l.doc_id, false) AS gone FROM keyed AS l LEFT JOIN many AS m USING (k))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id""",
    "op13_spelling": f"""
WITH RECURSIVE {_CRC_TABLE},
     runs AS (SELECT d, w, count(*) AS c
              FROM (SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS d,
                           unnest(regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-zÀ-ÿ]+')) AS w FROM documents)
              GROUP BY d, w),
     lots AS (SELECT w, c, {_crc32("d || ':' || w")} AS h FROM runs, crc_table),
     slips AS (SELECT c, CASE WHEN h % 97 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word FROM lots),
     words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM slips WHERE length(word) >= 5 GROUP BY word HAVING sum(c) >= 3),
     holes AS (SELECT word, i, left(word, i - 1) || substr(word, i + 1) AS hole FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
     near AS (SELECT x.word AS a, y.word AS b FROM holes AS x JOIN holes AS y ON x.hole = y.hole AND x.i = y.i AND x.word <> y.word
              UNION SELECT x.word, y.word FROM holes AS x JOIN words AS y ON x.hole = y.word
              UNION SELECT y.word, x.word FROM holes AS x JOIN words AS y ON x.hole = y.word),
     tops AS (SELECT p.a AS word, count(*) AS n_near, max({{'n': w.n}}).n AS top_n, arg_min(p.b, {{'n': -w.n, 'w': p.b}}) AS top
              FROM near AS p JOIN words AS w ON p.b = w.word GROUP BY p.a),
     formed AS (SELECT w.word, w.n, coalesce(t.n_near, 0) AS n_near, CASE WHEN t.top_n >= 2 * w.n THEN t.top END AS form,
                       CASE WHEN t.top_n >= 2 * w.n THEN t.top_n END AS form_n FROM words AS w LEFT JOIN tops AS t USING (word)),
     walk AS (SELECT word, word AS at FROM formed
              UNION ALL SELECT k.word, f.form FROM walk AS k JOIN formed AS f ON k.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.form, k.at AS root, f.n, f.n_near, f.form_n
FROM formed AS f JOIN walk AS k ON f.word = k.word JOIN formed AS e ON k.at = e.word AND e.form IS NULL""",
    "op5_decontaminate": f"""
WITH items AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
     sized AS (SELECT item, ws, least(10, len(ws)) AS m FROM items WHERE len(ws) > 0),
     wins AS (SELECT DISTINCT item, m, array_to_string(ws[i:i + m - 1], ' ') AS win
              FROM (SELECT item, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM sized)),
     docs AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
     occ AS (SELECT o.doc_id, o.i, o.m, w.item
             FROM (SELECT doc_id, ws, m, unnest(range(1, len(ws) - m + 2)) AS i
                   FROM docs, (SELECT DISTINCT m FROM wins)) AS o
             JOIN wins AS w ON w.m = o.m AND array_to_string(o.ws[o.i:o.i + o.m - 1], ' ') = w.win),
     hits AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + m)) AS pos FROM occ) GROUP BY doc_id),
     named AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
               FROM (SELECT DISTINCT doc_id, item FROM occ) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(n.n_items, 0) AS n_items,
       sha256(coalesce(n.items, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM docs AS d LEFT JOIN hits AS h USING (doc_id) LEFT JOIN named AS n USING (doc_id)""",
    "op8_mix": r"""
WITH sized AS (SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
                      md5('7:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS k FROM documents),
     src AS (SELECT source, sum(size) AS s, [5, 2, 1][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS w
             FROM sized GROUP BY source),
     run AS (SELECT *, sum(s) OVER () - coalesce(sum(3 * s) OVER b, 0) AS t_left, sum(w) OVER () - coalesce(sum(w) OVER b, 0) AS w_left
             FROM src WINDOW b AS (ORDER BY 3 * s / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
     cap AS (SELECT *, 3 * s * w_left < t_left * w AS capped FROM run),
     goal AS (SELECT source, s, CASE WHEN capped THEN CAST(3 * s AS DOUBLE)
                     ELSE CAST(sum(s) OVER () - coalesce(sum(3 * s) FILTER (WHERE capped) OVER (), 0) AS DOUBLE) * w
                          / (sum(w) FILTER (WHERE NOT capped) OVER ()) END AS target FROM cap),
     quota AS (SELECT *, CAST(round_even(target, 0) AS BIGINT) AS q FROM goal),
     seq AS (SELECT z.doc_id, z.size, CAST(g.s AS BIGINT) AS source_size, g.target, g.q,
                    coalesce(sum(z.size) OVER (PARTITION BY z.source ORDER BY z.k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
             FROM sized AS z JOIN quota AS g ON z.source IS NOT DISTINCT FROM g.source)
SELECT doc_id, size, source_size, target,
       CASE WHEN source_size = 0 THEN 0 ELSE CAST(q // source_size * size + greatest(0, least(size, q % source_size - before)) AS BIGINT) END AS taken
FROM seq""",
}
