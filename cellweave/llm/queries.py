"""The registered queries of these operators, and their SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellweave.llm import archives, blocks, collocations, decontaminate, language, licences, mixing, preferences, prefixes, simhash, topk, urls, weighted
from cellweave.llm.common import table

SQL: dict[str, str] = {}


def op1_archives(spark, sf_dir):
    return archives.archived(table(spark, sf_dir, "pages")).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


SQL["op1_archives"] = """WITH p AS (SELECT page_id, coalesce(html, '') AS body FROM pages),
d AS (SELECT page_id, CAST(strlen(body) AS BIGINT) AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first FROM d)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to FROM f"""


def op2_decontaminate(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


SQL["op2_decontaminate"] = r"""WITH d AS (
  SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
b AS (SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
wins AS (SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM wins),
places AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)),
found AS (SELECT DISTINCT doc_id, n, i, item FROM places JOIN wins USING (n, win)),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM found) GROUP BY doc_id),
ids AS (SELECT doc_id, count(*) AS n_items, sha256(string_agg(item, ',' ORDER BY item)) AS s
  FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, coalesce(s, sha256('')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN ids USING (doc_id)"""


def op3_urls(spark, sf_dir):
    return urls.judged(table(spark, sf_dir, "pages")).select("page.page_id", "host", "path", "rule", "verdict", "score")


def op4_preferences(spark, sf_dir):
    found = preferences.formatted(preferences.last_answer_pairs(table(spark, sf_dir, "conversations")))
    return found.select(
        "pair.pair_id", "prompt_turns", "prompt", "chosen", preferences.spans_text(F.col("chosen_spans")).alias("chosen_spans"),
        "rejected", preferences.spans_text(F.col("rejected_spans")).alias("rejected_spans"))


_SAFE = "replace(replace({}, '<|im_start|>', '< |im_start|>'), '<|im_end|>', '< |im_end|>')"
_HEADER = "'<|im_start|>' || " + _SAFE.format("x.role") + " || chr(10)"
_BODY = _SAFE.format("x.text") + " || '<|im_end|>'"


def _rendered(turns: str) -> str:
    return f"coalesce(array_to_string(list_transform({turns}, lambda x: {_HEADER} || {_BODY} || chr(10)), ''), '')"


def _spans(turns: str) -> str:
    heads, bodies = f"list_transform({turns}, lambda x: length({_HEADER}))", f"list_transform({turns}, lambda x: length({_BODY}) + 1)"
    start = (f"CAST(coalesce(list_sum(({heads})[1:i]), 0) + coalesce(list_sum(({bodies})[1:i - 1]), 0) AS BIGINT)")
    return (f"coalesce(array_to_string(list_transform(list_filter(range(1, len({turns}) + 1), lambda i: ({turns})[i].role = 'assistant'), "
            f"lambda i: {start} || '-' || ({start} + ({bodies})[i] - 1)), ','), '')")


SQL["op4_preferences"] = f"""WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations WHERE conv_id IS NOT NULL),
g AS (SELECT conv_id AS id, list({{'role': coalesce(role, 'user'), 'text': coalesce(text, '')}}
  ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS turns FROM t GROUP BY conv_id),
k AS (SELECT id, turns, list_max(list_filter(range(1, len(turns) + 1), lambda i: turns[i].role = 'assistant')) AS k FROM g),
p AS (SELECT a.id, a.turns[1:a.k] AS good, list_append(a.turns[1:a.k - 1], b.turns[b.k]) AS bad
  FROM k a JOIN k b ON b.id = xor(a.id, 1) WHERE a.k IS NOT NULL AND b.k IS NOT NULL),
n AS (SELECT id, good, bad, coalesce(list_min(list_filter(range(1, greatest(len(good), len(bad)) + 1),
  lambda i: good[i] IS DISTINCT FROM bad[i])) - 1, len(good)) AS n FROM p),
c AS (SELECT id, CAST(n AS INTEGER) AS n, good[1:n] AS shared, good[n + 1:] AS good, bad[n + 1:] AS bad FROM n)
SELECT id AS pair_id, n AS prompt_turns, {_rendered('shared')} AS prompt, {_rendered('good')} AS chosen, {_spans('good')} AS chosen_spans,
  {_rendered('bad')} AS rejected, {_spans('bad')} AS rejected_spans FROM c"""


def op5_licences(spark, sf_dir):
    found = licences.recognised(table(spark, sf_dir, "documents"))
    return found.withColumn("licences", F.array_join("licences", ","))


def _licence_sql() -> str:
    forms = ", ".join(f"('{s}', '{i}')" for i, known in licences.SENTENCES.items() for s in known)
    parts = [f"""WITH known(sentence, sentence_id) AS (VALUES {forms}),
cut AS (SELECT DISTINCT doc_id, string_split(regexp_replace(regexp_replace(text, '([.!?;])[ \t\r\n]+', '\1' || chr(1), 'g'),
  '\r?\n[ \t\r]*\n', chr(1), 'g'), chr(1)) AS s FROM documents),
whole AS (SELECT doc_id, i AS pos, s[i] AS sentence FROM (SELECT doc_id, s, unnest(range(1, len(s) + 1)) AS i FROM cut)),
pieces AS (SELECT doc_id, pos, 0 AS line, sentence FROM whole UNION ALL SELECT doc_id, pos, j AS line, l[j] AS sentence FROM (
  SELECT doc_id, pos, l, unnest(range(1, len(l) + 1)) AS j FROM (SELECT doc_id, pos, string_split(sentence, chr(10)) AS l FROM whole
  WHERE contains(sentence, chr(10))))),
plain AS (SELECT doc_id, pos, line, regexp_replace(trim(regexp_replace(lower(sentence), '[^a-z0-9]+', ' ', 'g')),
  '^neither the name of .+ nor the names of ', 'neither the name of holder nor the names of ') AS sentence FROM pieces),
found AS (SELECT DISTINCT doc_id, pos, line, sentence_id FROM plain JOIN known USING (sentence)),
r0 AS (SELECT doc_id, count(*) AS n, string_agg('<' || sentence_id || '>', '' ORDER BY pos, line, sentence_id) AS sequence,
  string_agg('<' || sentence_id || '>', '' ORDER BY pos, line, sentence_id) AS rest, CAST([] AS VARCHAR[]) AS named FROM found GROUP BY doc_id)"""]
    for k, (licence, ids) in enumerate(licences.RULES):
        run = licences.run_of(ids)
        alone = " AND len(named) = 0" if licence in licences.ONLY_ALONE else ""
        parts.append(f"r{k + 1} AS (SELECT doc_id, n, sequence, CASE WHEN TRUE{alone} THEN replace(rest, '{run}', '|') ELSE rest END AS rest, "
                     f"CASE WHEN contains(rest, '{run}'){alone} "
                     f"AND NOT list_contains(named, '{licence}') THEN list_append(named, '{licence}') ELSE named END AS named FROM r{k})")
    return ",\n".join(parts) + f"""
SELECT d.doc_id, coalesce(n, 0) AS n_sentences, coalesce(sequence, '') AS sequence, coalesce(array_to_string(named, ','), '') AS licences,
  CAST(coalesce(len(regexp_extract_all(rest, '<')), 0) AS BIGINT) AS n_unmatched
FROM (SELECT DISTINCT doc_id FROM documents) d LEFT JOIN r{len(licences.RULES)} r ON d.doc_id IS NOT DISTINCT FROM r.doc_id"""


SQL["op5_licences"] = _licence_sql()


def op6_near_copies(spark, sf_dir):
    found = simhash.near_copies(table(spark, sf_dir, "documents"))
    return found.select("doc_id", simhash.as_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op7_language(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = language.held_out(F.col("doc_id"))
    return language.predicted(docs.select("doc_id", "text"), docs.where(~out)).select(
        "doc.doc_id", language.held_out(F.col("doc.doc_id")).alias("held_out"), "lang_pred", "score")


def op8_fingerprints(spark, sf_dir):
    return weighted.fingerprinted(table(spark, sf_dir, "documents"))


def op9_main_text(spark, sf_dir):
    found = blocks.extracted(table(spark, sf_dir, "pages"))
    return found.select("page.page_id", "page.url", "text", F.char_length("text").cast("bigint").alias("n_chars"))


def op10_mix(spark, sf_dir):
    found = mixing.decide(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


SQL["op10_mix"] = r"""WITH s AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
p AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place FROM s GROUP BY source),
r AS (SELECT *, CAST([5, 2, 1][CAST(place % 3 + 1 AS INTEGER)] AS DOUBLE) AS weight, source_size * 2.0::DOUBLE AS room FROM p),
l AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE
    - coalesce(sum(room) OVER (ORDER BY room / weight, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY room / weight, place ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM r),
t AS (SELECT source, source_size, least(room, max(level) OVER () * weight) AS target FROM l),
q AS (SELECT *, CASE WHEN source_size > 0 THEN least(target / source_size, 2.0::DOUBLE) ELSE 0.0::DOUBLE END AS rate,
  CAST('0x' || substr(md5('mix:' || coalesce(source, '') || CASE WHEN source IS NULL THEN '?' ELSE '' END), 1, 8) AS BIGINT)
    / 4294967296.0::DOUBLE AS u FROM t),
n AS (SELECT s.*, q.* EXCLUDE (source), row_number() OVER (PARTITION BY s.source ORDER BY size, doc_id % 1024, doc_id) AS i
  FROM s JOIN q ON s.source IS NOT DISTINCT FROM q.source)
SELECT doc_id, size, source_size, target, CAST((floor(rate * i + u) - floor(rate * (i - 1) + u)) * size AS BIGINT) AS taken FROM n"""


def op11_topk(spark, sf_dir):
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


SQL["op11_topk"] = """WITH v AS (SELECT DISTINCT vec_id, list_transform(CAST(embedding AS DOUBLE[]), lambda x: CAST(floor(1024 * x) AS BIGINT)) AS v
  FROM embeddings WHERE embedding IS NOT NULL
  AND list_bool_and(list_transform(CAST(embedding AS DOUBLE[]), lambda x: coalesce(isfinite(x), FALSE))) IS NOT FALSE),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum([q.v[i] * c.v[i] for i in range(1, len(q.v) + 1)]) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id IS DISTINCT FROM c.vec_id),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id NULLS LAST) AS place FROM s)
SELECT query_id, CAST(place AS INTEGER) AS rank, vec_id, score FROM r WHERE place <= 10"""


def op12_collocations(spark, sf_dir):
    return collocations.collocations(table(spark, sf_dir, "documents"))


SQL["op12_collocations"] = r"""WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
i AS (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w),
e AS (SELECT lang, unnest([array_to_string(w[i : i + k - 1], ' ') for k in range(1, 4) if i + k - 1 <= len(w)]) AS phrase FROM i),
f AS (SELECT lang, phrase, count(*) AS f FROM e GROUP BY ALL),
sizes AS (SELECT lang, CAST(sum(len(w)) AS BIGINT) AS n FROM w GROUP BY lang),
c AS (SELECT lang, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE f >= 10 AND contains(phrase, ' ')),
cuts AS (SELECT lang, phrase, a, k, array_to_string(w[1:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest
  FROM (SELECT *, unnest(range(1, len(w))) AS k FROM c)),
s AS (SELECT cuts.lang, cuts.phrase, a, k, x.f AS l, y.f AS r,
    CAST(CAST(1000000 AS HUGEINT) * a * a // (CAST(x.f AS HUGEINT) * y.f) AS BIGINT) AS score
  FROM cuts JOIN f x ON x.lang = cuts.lang AND x.phrase = first JOIN f y ON y.lang = cuts.lang AND y.phrase = rest),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
around AS (SELECT lang, inside, max(a) AS a FROM (
    SELECT lang, a, unnest([array_to_string(w[1:2], ' '), array_to_string(w[2:3], ' ')]) AS inside FROM c WHERE len(w) = 3) GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN around o ON o.lang = low.lang AND o.inside = low.phrase WHERE o.a IS NULL OR 100 * o.a < 50 * low.a)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept JOIN sizes USING (lang) QUALIFY rank <= 2000"""


def op13_prefix_trie(spark, sf_dir):
    return prefixes.conversation_trie(table(spark, sf_dir, "conversations"))


# crc32 bit by bit: the polynomial is a fixed value.
_CRC = """xor(4294967295, list_reduce(list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)), lambda crc, b:
  list_reduce(CAST(range(8) AS BIGINT[]), lambda x, i: xor(x >> 1, (x & 1) * 3988292384), xor(crc, b)), CAST(4294967295 AS BIGINT)))"""
SQL["op13_prefix_trie"] = f"""WITH t AS (SELECT conv_id, turn, sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, ''))[1:32] AS k,
  length(coalesce(text, '')) AS len FROM conversations WHERE conv_id IS NOT NULL),
c AS (SELECT conv_id, list({{'k': k, 'len': len}} ORDER BY turn NULLS FIRST, k) AS turns, CAST({_CRC.format('conv_id')} % 6 AS BIGINT) AS h FROM t GROUP BY conv_id),
r AS (SELECT c.conv_id, list_concat(coalesce(b.turns, [])[1:c.h], c.turns[c.h + 1:]) AS turns
  FROM c LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100),
s AS (SELECT conv_id, turns, array_to_string(list_transform(turns, lambda x: x.k), '') AS path FROM r),
p AS (SELECT conv_id, d, path[1:32 * d] AS node, CASE WHEN d = 0 THEN 0 ELSE turns[d].len END AS len
  FROM (SELECT *, unnest(range(0, len(turns) + 1)) AS d FROM s)),
n AS (SELECT d, node, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(len) AS len FROM p GROUP BY d, node),
k AS (SELECT d - 1 AS d, node[1:32 * (d - 1)] AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL),
a AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN k USING (d, node)),
u AS (SELECT e AS d, node[1:32 * e] AS node, sum(n_convs * len - len) AS saved, count_if(n_children = 0) AS n_leaves
  FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM a) GROUP BY ALL),
x AS (SELECT len(turns) AS d, path AS node, sha256(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id)) AS ends FROM s GROUP BY ALL)
SELECT a.conv_id, a.d AS depth, o.conv_id AS parent_conv_id, a.n_convs, a.n_children, CAST(u.n_leaves AS BIGINT) AS n_leaves,
  CAST(u.saved AS BIGINT) AS saved_tokens, coalesce(x.ends, sha256('')) AS ends_sha256
FROM a JOIN u USING (d, node) LEFT JOIN x USING (d, node) LEFT JOIN n o ON o.d = a.d - 1 AND o.node = a.node[1:32 * (a.d - 1)]"""

QUERIES = {f.__name__: f for f in (
    op1_archives, op2_decontaminate, op3_urls, op4_preferences, op5_licences, op6_near_copies, op7_language, op8_fingerprints,
    op9_main_text, op10_mix, op11_topk, op12_collocations, op13_prefix_trie)}
