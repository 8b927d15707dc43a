"""The registered corpus queries: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import ann, jaccard, langid, lexical, linededup, merkle, mix, packing, pii, quality, substring, suffixdedup, urlfilter
from .common import read_table
from .registry import ORACLE, QUERIES, query  # noqa: F401

TOKENIZER = "word_bpe_49k.json"
WORDS = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
DUCK_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

MIX_SQL = rf"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '{WORDS}')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '-') || ':' || coalesce(text, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT source, source_size, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3)::INT + 1]::BIGINT AS weight
  FROM s),
f AS (
  SELECT *, row_number() OVER o AS place, sum(source_size) OVER () AS total,
         coalesce(sum(source_size) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
         sum(weight) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open
  FROM w WINDOW o AS (ORDER BY source_size / weight, source NULLS LAST)),
u AS (SELECT *, (total * 3 - before * 4)::DOUBLE / (open * 2)::DOUBLE AS unit FROM f),
v AS (SELECT *, min(CASE WHEN unit * weight <= source_size * 2 THEN place END) OVER () AS first FROM u),
l AS (SELECT *, max(CASE WHEN place = first THEN unit END) OVER () AS level FROM v),
t AS (
  SELECT source, source_size, CASE WHEN first IS NULL OR place < first THEN (source_size * 2)::DOUBLE ELSE level * weight END AS target
  FROM l),
p AS (SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS passes FROM t),
r AS (SELECT *, target - passes * source_size AS rest FROM p),
units AS (SELECT source, h, sum(size) AS size FROM d GROUP BY source, h),
run AS (
  SELECT units.source, units.h, units.size, r.rest, sum(units.size) OVER (PARTITION BY units.source ORDER BY units.h) AS upto
  FROM units JOIN r ON units.source IS NOT DISTINCT FROM r.source WHERE r.rest > 0),
cut AS (
  SELECT source, arg_min(CASE WHEN upto - rest <= rest - (upto - size) THEN h + 1 ELSE h END, h) AS threshold
  FROM run WHERE upto >= rest GROUP BY source)
SELECT d.doc_id, d.size, r.source_size, r.target,
       (d.size * (r.passes + CASE WHEN d.h < coalesce(cut.threshold, 0) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source LEFT JOIN cut ON d.source IS NOT DISTINCT FROM cut.source
"""


@query("op1_source_mix", MIX_SQL)
def op1_source_mix(spark, sf_dir):
    return mix.mix(read_table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


_SITES = "|".join(g.strip("*") for g in urlfilter.BLOCK_GLOBS)
URL_SQL = rf"""
WITH p AS (
  SELECT page_id,
         translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), '{UPPER}', '{LOWER}') AS host,
         coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages),
r AS (
  SELECT *, CASE
    WHEN suffix(host, '.example.org') AND starts_with(path, '/en/1') OR host = 'example.org' AND starts_with(path, '/en/1') THEN 'example.org/en/1'
    WHEN (suffix(host, '.example.org') OR host = 'example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
    WHEN (suffix(host, '.com') OR host = 'com') AND starts_with(path, '/fr/') THEN 'com/fr/'
    WHEN (suffix(host, '.com') OR host = 'com') AND starts_with(path, '/de/') THEN 'com/de/'
    WHEN (suffix(host, '.org') OR host = 'org') AND starts_with(path, '/') THEN 'org/'
  END AS rule FROM p)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('org/', 'com/fr/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host, '({_SITES})') THEN 'block'
    ELSE 'allow' END AS verdict
FROM r
"""


@query("op2_url_filter", URL_SQL)
def op2_url_filter(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return urlfilter.url_filter(pages).select("page_id", "host", "path", "rule", "verdict")


# the cleaned documents; the pipeline's SQL uses them too
LINES_CTE = f"""
lines AS (
  SELECT doc_id, text, generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos,
         unnest(string_split(coalesce(text, ''), chr(10))) AS line
  FROM {{docs}}),
keyed AS (SELECT *, translate(trim(line, {DUCK_BLANKS}), '{UPPER}', '{LOWER}') AS key FROM lines),
shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT coalesce(doc_id, -1)) >= 3),
judged AS (
  SELECT keyed.*, (shared.key IS NOT NULL AND keyed.doc_id IS DISTINCT FROM shared.keeper) AS lost
  FROM keyed LEFT JOIN shared ON keyed.key = shared.key),
cleaned AS (
  SELECT doc_id, text, count(*)::BIGINT AS n_lines, count(*) FILTER (lost)::BIGINT AS n_dropped,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT lost), '') AS kept
  FROM judged GROUP BY doc_id, text)"""


@query("op4_line_dedup", "WITH " + LINES_CTE.format(docs="documents") + """
SELECT doc_id, n_lines, n_dropped, sha256(kept) AS kept_sha256 FROM cleaned""")
def op4_line_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = linededup.line_dedup(docs)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


_PHRASES = quality.BOILERPLATE_REGEX
_END = quality.SENTENCE_END_REGEX.replace("'", "''")
QUALITY_SQL = rf"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS words FROM documents),
win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 4], ' ') AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 3)) AS i FROM d WHERE len(words) >= 5)),
twice AS (SELECT doc_id, w FROM win GROUP BY doc_id, w HAVING count(*) > 1),
covered AS (
  SELECT doc_id, count(DISTINCT p) AS n
  FROM (SELECT win.doc_id, unnest(range(i, i + 5)) AS p FROM win JOIN twice ON win.doc_id = twice.doc_id AND win.w = twice.w)
  GROUP BY doc_id),
lines AS (
  SELECT *, len(regexp_extract_all(line, '{WORDS}')) AS n
  FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM d)),
judged AS (
  SELECT doc_id, line, n, (
      regexp_matches(line, '{_PHRASES}')
      OR (len(regexp_extract_all(line, '{quality.SEPARATOR_REGEX}')) > 0
          AND len(regexp_extract_all(line, '{quality.SEPARATOR_REGEX}')) * 4 >= n)
      OR len(regexp_extract_all(line, '{quality.CLUSTER_REGEX}')) * 10 >= n * 3
      OR (n < 4 AND NOT regexp_matches(line, '{_END}'))) AS fails
  FROM lines WHERE n > 0),
per AS (
  SELECT doc_id, count(*) - count(DISTINCT line) AS n_dup_lines, sum(CASE WHEN fails THEN n ELSE 0 END) AS lost
  FROM judged GROUP BY doc_id),
base AS (
  SELECT d.doc_id, len(words)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(t, '{quality.SYMBOLS}'))::BIGINT AS n_symbols,
         coalesce(n_dup_lines, 0)::BIGINT AS n_dup_lines, coalesce(covered.n, 0)::BIGINT AS n_repeat_words, coalesce(lost, 0) AS lost
  FROM d LEFT JOIN per USING (doc_id) LEFT JOIN covered USING (doc_id))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND lost * 100 <= n_words * 40 AS kept
FROM base
"""


@query("op10_quality_rules", QUALITY_SQL)
def op10_quality_rules(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.quality(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query("op7_best_fit_pack")
def op7_best_fit_pack(spark, sf_dir):
    import public_tokenizers
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.best_fit_pack(docs, public_tokenizers.path(TOKENIZER))


def held_out():
    """Whether a document's fold is the one that is not learnt from."""
    fold = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(5))
    return F.coalesce(fold == 0, F.lit(True))


@query("op5_language_id")
def op5_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = langid.fit(docs.where(~held_out()))
    return langid.identify(docs.select("doc_id", "text"), model).select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "ambiguous")


@query("op3_nearest_vectors")
def op3_nearest_vectors(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return ann.nearest(vectors, vectors.where(F.col("vec_id") % 100 == 0))


SUBSTRING_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORDS}') AS words FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(words[i:i + 34], ' ')) AS w
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 33)) AS i FROM d WHERE len(words) >= 35)),
twice AS (SELECT w FROM win GROUP BY w HAVING count(*) > 1),
hit AS (SELECT doc_id, i FROM win SEMI JOIN twice ON win.w = twice.w),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 35)) AS p FROM hit),
word AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM d),
kept AS (
  SELECT word.doc_id, string_agg(word, ' ' ORDER BY word.p) AS kept, count(*) AS n
  FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.p = gone.p GROUP BY word.doc_id)
SELECT d.doc_id, len(words)::BIGINT AS n_words, (len(words) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN kept ON d.doc_id = kept.doc_id
"""


@query("op9_substring_dedup", SUBSTRING_SQL)
def op9_substring_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return substring.substring_dedup(docs).select("doc_id", "n_words", "n_removed", "kept_sha256")


@query("op6_suffix_dedup")
def op6_suffix_dedup(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return suffixdedup.suffix_dedup(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


JACCARD_CTE = rf"""
sh_words AS (
  SELECT rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{WORDS}') AS w FROM {{docs}}),
sh AS (
  SELECT DISTINCT rid, s FROM (
    SELECT rid, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                            WHEN len(w) > 0 THEN [array_to_string(w, ' ') || ' '] ELSE [] END) AS s FROM sh_words)),
sizes AS (SELECT rid, count(*) AS n FROM sh GROUP BY rid),
often AS (SELECT s FROM sh GROUP BY s HAVING count(*) > 1),
lists AS (SELECT sh.rid, sh.s FROM sh SEMI JOIN often ON sh.s = often.s),
pairs AS (
  SELECT a.rid AS x, b.rid AS y, count(*) AS i FROM lists a JOIN lists b ON a.s = b.s AND a.rid < b.rid GROUP BY ALL),
links AS (
  SELECT x, y FROM pairs JOIN sizes p ON p.rid = x JOIN sizes q ON q.rid = y WHERE 100 * i >= 75 * (p.n + q.n - i)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (
  SELECT rid AS a, rid AS b FROM sh_words
  UNION
  SELECT reach.a, edges.y FROM reach JOIN edges ON reach.b = edges.x),
joined AS (
  SELECT w.rid, w.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m.component_id
  FROM sh_words w LEFT JOIN sizes USING (rid)
  JOIN (SELECT a AS rid, min(d.doc_id) AS component_id FROM reach JOIN sh_words d ON d.rid = reach.b GROUP BY a) m USING (rid))"""

JACCARD_SQL = ("WITH RECURSIVE numbered AS (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)," + JACCARD_CTE.format(docs="numbered")
               + " SELECT doc_id, n_shingles, component_id FROM joined")


@query("op8_jaccard_join", JACCARD_SQL)
def op8_jaccard_join(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard.jaccard_join(docs).select("doc_id", "n_shingles", "component_id")


@query("op11_personal_data")
def op11_personal_data(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    out = pii.find(docs, pii.fit(docs))
    base = F.filter("spans", lambda p: p["base"])

    def said(spans):
        return F.array_join(F.transform(spans, lambda p: F.concat_ws(":", p["kind"], p["start"].cast("string"), p["end"].cast("string"))), ",")

    return out.select("doc_id", *[F.size(F.filter(base, lambda p: p["kind"] == k)).cast("long").alias(f"n_{k}") for k in pii.KINDS],
                      F.sha2(said(base), 256).alias("base_sha256"), said(F.col("spans")).alias("spans"))


# crc32 of a short text, a bit at a time
_CRC = """xor(list_reduce(list_prepend(4294967295::BIGINT, range(8 * length({s}))), lambda a, i:
    xor(xor(a, CASE WHEN i % 8 = 0 THEN ascii(substr({s}, (i // 8 + 1)::INT, 1)) ELSE 0 END) >> 1,
        (xor(a, CASE WHEN i % 8 = 0 THEN ascii(substr({s}, (i // 8 + 1)::INT, 1)) ELSE 0 END) & 1) * 3988292384)), 4294967295)"""


def _said(value: str) -> str:
    return f"coalesce(octet_length(encode(({value})::VARCHAR))::VARCHAR || ':' || ({value})::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_said(c) for c in ("doc_id", "source", "lang", "n_chars", text)) + ")"


MERKLE_SQL = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, {_leaf("text")} AS leaf,
         CASE WHEN {_CRC.format(s="doc_id::VARCHAR")} % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS told
  FROM documents),
g AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS grp FROM (SELECT DISTINCT source FROM documents)),
l AS (
  SELECT grp, doc_id, leaf, told, row_number() OVER (PARTITION BY grp ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source),
trees AS (
  SELECT 0 AS level, grp, pos, leaf AS h FROM l
  UNION ALL
  SELECT level + 1, grp, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER (PARTITION BY grp) AS n FROM trees) WHERE n > 1 GROUP BY level, grp, pos // 3),
subroots AS (SELECT grp, arg_max(h, level) AS subroot, max(level) AS height FROM trees GROUP BY grp),
top AS (
  SELECT 0 AS level, grp AS pos, subroot AS h FROM subroots
  UNION ALL
  SELECT level + 1, pos // 3, sha256(string_agg(h, '' ORDER BY pos))
  FROM (SELECT *, count(*) OVER () AS n FROM top) WHERE n > 1 GROUP BY level, pos // 3),
root AS (SELECT arg_max(h, level) AS root, max(level) AS height FROM top),
-- levels of a leaf's way: those of its group's tree, then those of the top tree
nodes AS (
  SELECT trees.grp, trees.level, pos, h FROM trees JOIN subroots USING (grp) WHERE trees.level < height
  UNION ALL
  SELECT grp, height + top.level, pos, h FROM subroots CROSS JOIN top WHERE top.level < (SELECT height FROM root)),
way AS (
  SELECT l.grp, l.pos AS leaf_pos, 0 AS level, l.pos, told AS h, '' AS proof, height FROM l JOIN subroots USING (grp)
  UNION ALL
  SELECT w.grp, leaf_pos, w.level + 1, CASE WHEN w.level + 1 = any_value(height) THEN w.grp ELSE w.pos // 3 END,
         sha256(string_agg(CASE WHEN n.pos = w.pos THEN w.h ELSE n.h END, '' ORDER BY n.pos)),
         any_value(proof) || coalesce(string_agg(n.h, '' ORDER BY n.pos) FILTER (n.pos <> w.pos), ''), any_value(height)
  FROM (SELECT * REPLACE (CASE WHEN level = height THEN grp ELSE pos END AS pos) FROM way) w
  JOIN nodes n ON n.grp = w.grp AND n.level = w.level AND n.pos // 3 = w.pos // 3
  GROUP BY w.grp, leaf_pos, w.level, w.pos),
ends AS (SELECT grp, leaf_pos, arg_max(h, level) AS folded_root, arg_max(proof, level) AS proof FROM way GROUP BY grp, leaf_pos)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded_root, folded_root = root AS verified
FROM l JOIN subroots USING (grp) JOIN ends ON ends.grp = l.grp AND leaf_pos = l.pos CROSS JOIN root
"""


@query("op12_merkle_manifest", MERKLE_SQL)
def op12_merkle_manifest(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select(*merkle.COLUMNS)
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    whole = [F.col(c) for c in merkle.COLUMNS]
    changed = merkle.leaf(*whole[:-1], F.replace("text", F.lit("\n"), F.lit("")))
    made = merkle.manifest(docs, keep={"tampered": F.when(even, changed)})

    def text(c):
        return F.lower(F.hex(c))

    out = made.proofs(F.coalesce("tampered", "digest"))
    return out.select(F.col("key").alias("doc_id"), text("digest").alias("leaf"), text("subroot").alias("subroot"), text("root").alias("root"),
                      F.sha2(text("proof"), 256).alias("proof_sha256"), text("folded").alias("folded_root"), (F.col("folded") == F.col("root")).alias("verified"))


_TERMS = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
LEXICAL_SQL = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_TERMS}') AS t FROM documents),
docs AS (SELECT * FROM d WHERE len(t) > 0),
total AS (SELECT count(*) AS n, sum(len(t))::BIGINT AS l FROM docs),
items AS (
  SELECT iid, item_id, term, count(*) AS times
  FROM (SELECT row_number() OVER () AS iid, item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '{_TERMS}')) AS term
        FROM benchmark)
  GROUP BY ALL),
tf AS (
  SELECT rid, doc_id, n_own, term, count(*) AS tf
  FROM (SELECT rid, doc_id, len(t) AS n_own, unnest(t) AS term FROM docs) x SEMI JOIN items USING (term) GROUP BY ALL),
w AS (SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
      FROM (SELECT term, count(*) AS df FROM tf GROUP BY term) CROSS JOIN total),
scored AS (
  SELECT iid, item_id, rid, doc_id,
         sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n_own * n) // l))))::BIGINT AS score
  FROM items JOIN tf USING (term) JOIN w USING (term) CROSS JOIN total GROUP BY ALL),
ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS LAST) AS rank, doc_id, score FROM scored WHERE score > 0)
SELECT item_id, rank::INT AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""


@query("op13_ranked_search", LEXICAL_SQL)
def op13_ranked_search(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return lexical.rank(docs, read_table(spark, sf_dir, "benchmark").select("item_id", "text"))
