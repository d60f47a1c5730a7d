"""One query per operator over the whole of its table, with the SQL of its result where SQL can state it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm import (
    decontam, html, lines, mixing, pii, quality, simhash, suffixes, tokens, toxicity, tries, urls, variants)

TOKENIZER = "word_bpe_49k.json"
TOKEN_LIMIT = 2048


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    counts = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    found = quality.cascade(docs, measures=counts)
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    return found.select("doc_id", *counts, base.alias("base_failed"), "kept")


def op2_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return suffixes.remove_repeats(docs).select("doc_id", "n_bytes", "n_removed", "n_spans",
                                                F.sha2("kept", 256).alias("kept_sha256"))


def op3_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", "text")
    return lines.remove_boilerplate(docs)


def op4_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = decontam.digest(decontam.find(docs, _table(spark, folder, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op5_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html.extract(_table(spark, folder, "pages").select("page_id", "html")).select("page_id", "text")


def op6_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    model = toxicity.train_on_labels(docs, _table(spark, folder, "labels"))
    found = toxicity.score(docs, model, keep_text=False)
    return found.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op7_simhash(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return simhash.near_duplicates(docs)


def op8_source_mix(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "source", "text")
    return mixing.taken(docs).select("doc_id", "size", "source_size", "target", "taken")


def op9_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return urls.judge(_table(spark, folder, "pages").select("page_id", "url")).select(
        "page_id", "host", "path", "rule", "verdict", "template", "purity")


def op10_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    return pii.find(docs).select("doc_id", *(f"n_{k}" for k in pii.BASE), "base_sha256", "spans", "n_spans")


def op11_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return variants.group(_table(spark, folder, "documents").select("doc_id", "text"))


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    found = tokens.count(docs, public_tokenizers.path(TOKENIZER), keep_text=False)
    return found.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > TOKEN_LIMIT).alias("over_limit"))


def op13_conversation_trie(spark: SparkSession, folder: str) -> DataFrame:
    talks = tries.crossed(_table(spark, folder, "conversations"))
    return tries.nodes(talks).select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                     "saved_tokens", "ends_sha256")


OP1_SQL = r"""
WITH w AS (SELECT doc_id, text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words,
                  list_filter(string_split(coalesce(text, ''), chr(10)),
                              lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS lines FROM documents),
tri AS (SELECT doc_id, list_transform(generate_series(1, len(words) - 2),
               lambda i: words[i] || chr(10) || words[i + 1] || chr(10) || words[i + 2]) AS grams FROM w),
flat AS (SELECT doc_id, unnest(grams) AS g, generate_subscripts(grams, 1) AS i FROM tri),
twice AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM flat) WHERE c > 1),
hit AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM twice, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(words)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             length(regexp_replace(coalesce(text, ''), '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
             (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words,
             len(lines) AS n_lines, length(regexp_replace(coalesce(text, ''), '[^A-Z]', '', 'g')) AS n_upper,
             length(regexp_replace(coalesce(text, ''), '[^!]', '', 'g')) AS n_exclaims
      FROM w LEFT JOIN hit ON w.doc_id = hit.doc_id),
f AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > 10 * n_words OR word_chars < 2 * n_words OR word_chars > 15 * n_words
            OR 100 * n_dup_lines > 30 * n_lines OR 100 * n_upper > 50 * word_chars
            OR 100 * n_exclaims > 30 * n_words) AS kept FROM f"""

OP3_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, text,
                  string_split(text, chr(10)) AS ls FROM documents),
l AS (SELECT r, source, text, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM d),
boiler AS (SELECT line FROM l WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY line
           HAVING count(DISTINCT coalesce(source, chr(0))) >= 10 AND count(DISTINCT text) > 1),
rest AS (SELECT r, string_agg(line, chr(10) ORDER BY i) AS kept, count(*) AS n FROM l
         WHERE line NOT IN (SELECT line FROM boiler) GROUP BY r)
SELECT doc_id, source, CASE WHEN text IS NULL THEN NULL ELSE coalesce(kept, '') END AS text,
       coalesce(len(ls), 0)::BIGINT AS n_lines, (coalesce(len(ls), 0) - coalesce(n, 0))::BIGINT AS n_removed
FROM d LEFT JOIN rest USING (r)"""

OP8_SQL = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size
           FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5, 2, 1][(row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
lv AS (SELECT *, 3 * source_size AS cap, sum(source_size) OVER () AS total,
              coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / weight, encode(source) NULLS LAST
                       ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
              sum(weight) OVER (ORDER BY 3 * source_size / weight, encode(source) NULLS LAST
                       ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rest FROM w),
fit AS (SELECT max((total - below)::BIGINT / rest::BIGINT) AS level FROM lv
        WHERE (total - below)::BIGINT / rest::BIGINT * weight <= cap),
t AS (SELECT source, source_size, coalesce(least(level * weight, cap::DOUBLE), cap::DOUBLE) AS target
      FROM lv LEFT JOIN fit ON true),
o AS (SELECT d.doc_id, d.size, t.source_size, t.target, round(t.target)::BIGINT AS take,
             sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(d.doc_id::VARCHAR, '')), d.doc_id, size
                             ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS b
      FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       (greatest(least(b + size, take) - least(b, take), 0)
        + greatest(least(b + source_size + size, take) - least(b + source_size, take), 0)
        + greatest(least(b + 2 * source_size + size, take) - least(b + 2 * source_size, take), 0))::BIGINT AS taken
FROM o"""

# CRC-32 of ASCII or UTF-8 bytes, by a table made from its polynomial.
CRC = r"""
crc AS (SELECT list(list_reduce(list_concat([i], [0, 0, 0, 0, 0, 0, 0, 0]),
                    lambda a, b: CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t
        FROM (SELECT unnest(generate_series(0, 255))::BIGINT AS i))"""


def _crc(text: str) -> str:
    codes = (f"list_transform(generate_series(1, octet_length(encode({text}))), "
             f"lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT)")
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), "
            "lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1])), 4294967295)")


OP11_SQL = rf"""
WITH RECURSIVE {CRC},
runs AS (SELECT doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS run
         FROM documents),
low AS (SELECT doc_id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS w, count(*) AS n
        FROM runs WHERE length(run) >= 5 GROUP BY 1, 2),
h AS (SELECT w, n, {_crc("coalesce(doc_id::VARCHAR, '') || ':' || w")} AS h FROM low, crc),
made AS (SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, (h % length(w))::INT) || substr(w, (h % length(w))::INT + 2)
                     ELSE w END AS word, n FROM h),
v AS (SELECT word, sum(n)::BIGINT AS n FROM made WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
cut AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
        FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS i FROM v)),
pairs AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b
              ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
          UNION SELECT a.word, a.n, b.word, b.n FROM cut a JOIN v b ON a.rest = b.word
          UNION SELECT b.word, b.n, a.word, a.n FROM cut a JOIN v b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, max(other_n) AS top FROM pairs GROUP BY word),
form AS (SELECT v.word, v.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN top >= 2 * v.n THEN top END AS form_n,
                CASE WHEN top >= 2 * v.n THEN (SELECT min(encode(p.other)) FROM pairs p WHERE p.word = v.word
                                               AND p.other_n = top) END AS form
         FROM v LEFT JOIN best ON best.word = v.word),
named AS (SELECT word, n, n_near, form_n, decode(form) AS form FROM form),
chain AS (SELECT word, word AS root, form AS next FROM named
          UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN named f ON f.word = c.next)
SELECT named.word, named.form, chain.root, named.n, named.n_near, named.form_n
FROM named JOIN chain ON chain.word = named.word AND chain.next IS NULL"""

OP13_SQL = rf"""
WITH {CRC},
t AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS text,
             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(octet_length(encode(coalesce(
                                role, ''))) || ':' || coalesce(role, '') || coalesce(text, ''))) AS p
      FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, list(struct_pack(role := role, text := text) ORDER BY p) AS turns FROM t GROUP BY c),
h AS (SELECT c, turns, {_crc("c::VARCHAR")} % 9 AS h FROM own, crc),
s AS (SELECT h.c, list_concat(coalesce(list_slice(b.turns, 1, h), []), coalesce(list_slice(h.turns, h + 1, len(h.turns)), []))
             AS turns FROM h LEFT JOIN own b ON b.c = h.c - h.c % 5),
p AS (SELECT c, d, list_slice(turns, 1, d) AS pre, len(turns) AS size,
             CASE WHEN d = 0 THEN 0 ELSE octet_length(encode(turns[d].text)) END AS bytes
      FROM (SELECT *, unnest(generate_series(0, len(turns))) AS d FROM s)),
n AS (SELECT d, pre, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS own_saved,
             string_agg(CASE WHEN size = d THEN c::VARCHAR END, ',' ORDER BY c) AS ends FROM p GROUP BY d, pre),
named AS (SELECT p.c, n.*, lag(n.conv_id) OVER (PARTITION BY p.c ORDER BY p.d) AS parent
          FROM p JOIN n ON n.d = p.d AND n.pre = p.pre),
node AS (SELECT DISTINCT ON (d, conv_id) d, conv_id, parent, n_convs, own_saved, ends FROM named ORDER BY d, conv_id, c),
kids AS (SELECT d - 1 AS d, parent AS conv_id, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
full_node AS (SELECT node.*, coalesce(kids.n, 0) AS n_children FROM node LEFT JOIN kids USING (d, conv_id)),
under AS (SELECT a.d, a.conv_id, sum(x.own_saved) AS saved, count(*) FILTER (x.n_children = 0) AS leaves
          FROM (SELECT DISTINCT a.d, a.conv_id, b.d AS xd, b.conv_id AS xc FROM named a JOIN named b
                ON a.c = b.c AND b.d >= a.d) a JOIN full_node x ON x.d = a.xd AND x.conv_id = a.xc GROUP BY ALL)
SELECT conv_id, d::BIGINT AS depth, parent AS parent_conv_id, n_convs, n_children::BIGINT AS n_children,
       leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(ends, '')) AS ends_sha256
FROM full_node JOIN under USING (d, conv_id)"""

QUERIES = {
    "op1_quality_rules": (op1_quality_rules, OP1_SQL),
    "op2_suffix_dedup": (op2_suffix_dedup, None),
    "op3_line_dedup": (op3_line_dedup, OP3_SQL),
    "op4_decontamination": (op4_decontamination, None),
    "op5_html_text": (op5_html_text, None),
    "op6_toxicity": (op6_toxicity, None),
    "op7_simhash": (op7_simhash, None),
    "op8_source_mix": (op8_source_mix, OP8_SQL),
    "op9_url_filter": (op9_url_filter, None),
    "op10_personal_data": (op10_personal_data, None),
    "op11_spelling_variants": (op11_spelling_variants, OP11_SQL),
    "op12_token_counts": (op12_token_counts, None),
    "op13_conversation_trie": (op13_conversation_trie, OP13_SQL),
}
