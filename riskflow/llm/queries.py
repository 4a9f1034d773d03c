"""Registered queries of the corpus operators and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import ann, collocations, langid, line_rules, line_spread, minhash, mixing, ngram_join, packing, prefix_trie, quality_rank, secret_scan, url_rules
from .common import materialize, n_words, table

_WORDS = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"


def op1_adaptive_scan(spark, sf_dir):
    return ann.search(table(spark, sf_dir, "embeddings"))


def op2_byte_gru(spark, sf_dir):
    return langid.identify_documents(table(spark, sf_dir, "documents"))


def op3_quality_rank(spark, sf_dir):
    return quality_rank.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_url_rules(spark, sf_dir):
    return url_rules.filter_urls(table(spark, sf_dir, "pages"), url_rules.default_rules(spark))


OP4_SQL = """
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS host FROM u),
p AS (SELECT page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') AS path FROM h),
r(rh, rp, verdict) AS (VALUES """ + ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in url_rules.RULES) + """),
m AS (SELECT host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS verdict
      FROM (SELECT DISTINCT host, path FROM p) JOIN r
        ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY host, path)
SELECT p.page_id, p.host, p.path, m.rule, coalesce(m.verdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.host = m.host AND p.path = m.path
"""


def op5_secret_scan(spark, sf_dir):
    return secret_scan.scan(table(spark, sf_dir, "documents"))


def op6_ngram_join(spark, sf_dir):
    return ngram_join.near_groups(table(spark, sf_dir, "documents"))


def op7_line_spread(spark, sf_dir):
    out = line_spread.remove_spread_lines(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "source", F.md5("text").alias("text_md5"), "lines", "lines_removed")


OP7_SQL = rf"""
WITH d AS (SELECT doc_id, source, text FROM documents),
l AS (SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
             generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM d WHERE text IS NOT NULL),
t AS (SELECT *, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS key FROM l),
b AS (SELECT key, min(doc_id) AS doc, min(struct_pack(d := doc_id, p := pos)) AS at
      FROM t WHERE length(key) >= {line_spread.MIN_CHARS}
      GROUP BY key HAVING count(DISTINCT source) >= {line_spread.MIN_SITES}),
m AS (SELECT t.doc_id, t.source, t.pos, t.line,
             b.key IS NOT NULL AND b.at <> struct_pack(d := t.doc_id, p := t.pos) AS gone
      FROM t LEFT JOIN b ON t.key = b.key),
g AS (SELECT doc_id, string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS text,
             count(*) AS lines, count(*) FILTER (WHERE gone) AS lines_removed FROM m GROUP BY doc_id)
SELECT d.doc_id, d.source, CASE WHEN d.text IS NULL THEN NULL ELSE md5(coalesce(g.text, '')) END AS text_md5,
       coalesce(g.lines, 0) AS lines, coalesce(g.lines_removed, 0) AS lines_removed
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""


def op9_mixing(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", n_words(F.col("text")).alias("words"))
    out = mixing.plan(materialize(docs), F.col("words"))
    return out.select("doc_id", "size", "source_size", "target",
                      (F.col("size") * F.col("copies")).alias("taken"))


def op8_retrieval_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


OP9_SQL = rf"""
WITH d AS (SELECT doc_id, source, {_WORDS} AS size, md5(coalesce(doc_id::VARCHAR, '')) AS dg FROM documents),
p AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT source, source_size, 3 * source_size AS cap,
             (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS w FROM p),
r AS (SELECT *, sum(source_size) OVER () - coalesce(sum(cap) OVER a, 0) AS words,
             sum(w) OVER () - coalesce(sum(w) OVER a, 0) AS weights
      FROM w WINDOW a AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
c AS (SELECT *, cap * weights <= w * words AS capped FROM r),
v AS (SELECT max(weights) AS weights, arg_max(words, weights) AS words FROM c WHERE NOT capped),
t AS (SELECT source, source_size, CASE WHEN capped THEN cap::DOUBLE
             ELSE (c.w * v.words)::BIGINT::DOUBLE / v.weights::DOUBLE END AS target,
             ('0x' || substr(md5('{mixing.SEED}:' || coalesce(source, chr(0))), 1, 5))::BIGINT::DOUBLE / 1048576 AS u
      FROM c, v),
e AS (SELECT *, greatest(length(bin(size)) - 7, 0) AS bits FROM d),
k AS (SELECT *, bits * 64 + (size >> bits::INT) AS cls, substr(dg, 1, 2) AS salt FROM e),
n AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY cls, salt, size, dg) AS place FROM k)
SELECT n.doc_id, n.size, t.source_size, t.target,
       CASE WHEN n.size = 0 THEN 0 ELSE n.size * least(3, (floor(place * (target / source_size) + u)
            - floor((place - 1) * (target / source_size) + u))::BIGINT) END::BIGINT AS taken
FROM n JOIN t ON n.source IS NOT DISTINCT FROM t.source
"""

def op10_line_rules(spark, sf_dir):
    return line_rules.measure(table(spark, sf_dir, "documents"))


def op11_minhash(spark, sf_dir):
    return minhash.fingerprints(table(spark, sf_dir, "documents"))


def minhash_classes(spark, sf_dir):
    """The other half of operator 11: classes of near duplicates by signature bands."""
    return minhash.near_duplicates(table(spark, sf_dir, "documents"))


def op12_collocations(spark, sf_dir):
    return collocations.mine(table(spark, sf_dir, "documents"))


OP12_SQL = rf"""
WITH p AS (SELECT lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                  '[.,;:!?\x0A-\x0D]')) AS piece
           FROM (SELECT coalesce(lang, 'und') AS lang, text FROM documents)),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
k AS (SELECT unnest(range(1, {collocations.LONGEST + 1})) AS k),
g AS (SELECT lang, k, w, unnest(range(1, len(w) - k + 2)) AS i FROM w, k WHERE len(w) >= k),
c AS (SELECT lang, k, w[i:i + k - 1] AS ws, count(*) AS n FROM g GROUP BY ALL),
t AS (SELECT lang, sum(n)::BIGINT AS n FROM c WHERE k = 1 GROUP BY lang),
f AS (SELECT * FROM c WHERE n >= {collocations.THRESHOLD}),
x AS (SELECT lang, ws[i:i + j - 1] AS ws, max(n) AS n
      FROM (SELECT lang, ws, n, k, j, unnest(range(1, k - j + 2)) AS i
            FROM (SELECT lang, ws, n, k, unnest(range(2, k)) AS j FROM f WHERE k > 2)) GROUP BY ALL),
s AS (SELECT f.lang, f.ws, f.k, f.n AS a, unnest(range(1, f.k)) AS j
      FROM f LEFT JOIN x ON x.lang = f.lang AND x.ws = f.ws WHERE f.k > 1 AND (x.n IS NULL OR x.n < f.n)),
v AS (SELECT s.lang, s.ws, s.j, s.a, l.n AS l, r.n AS r, t.n,
             ((1000::HUGEINT * s.a * t.n) // (l.n::HUGEINT * r.n))::BIGINT AS score
      FROM s JOIN f l ON l.lang = s.lang AND l.ws = s.ws[1:s.j] JOIN f r ON r.lang = s.lang AND r.ws = s.ws[s.j + 1:]
             JOIN t ON t.lang = s.lang),
b AS (SELECT lang, ws, a, n, unnest(arg_min(struct_pack(l := l, r := r, score := score), struct_pack(score := score, j := j))) FROM v GROUP BY lang, ws, a, n),
o AS (SELECT *, array_to_string(ws, ' ') AS phrase FROM b),
z AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o)
SELECT * FROM z WHERE rank <= {collocations.TOP}
"""


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.shared_prefixes(table(spark, sf_dir, "conversations"))


#: crc32 bit by bit: a byte is mixed in, and -1 stands for one shift.
OP13_SQL = r"""
WITH t AS (SELECT conv_id AS c, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, md5(role) || md5(text) AS dg, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS w,
             row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, md5(role) || md5(text)) AS pos FROM t),
v AS (SELECT c, xor(list_reduce(list_concat([4294967295::BIGINT],
               flatten(list_transform(string_split(c::VARCHAR, ''), lambda x: list_concat([ascii(x)::BIGINT], [-1::BIGINT, -1, -1, -1, -1, -1, -1, -1])))),
               lambda a, x: CASE WHEN x >= 0 THEN xor(a, x) WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END), 4294967295::BIGINT) % 4 AS h
      FROM (SELECT DISTINCT c FROM t)),
b AS (SELECT v.c, o.pos, o.dg, o.w FROM v JOIN o ON o.c = v.c - v.c % 20 AND o.pos <= v.h),
k AS (SELECT v.c, v.h, count(b.pos) AS m FROM v LEFT JOIN b ON b.c = v.c GROUP BY v.c, v.h),
r AS (SELECT c, pos, dg, w FROM b UNION ALL SELECT o.c, o.pos - k.h + k.m, o.dg, o.w FROM o JOIN k ON o.c = k.c WHERE o.pos > k.h),
p AS (SELECT c, pos AS depth, w, list(dg) OVER (PARTITION BY c ORDER BY pos) AS path FROM r),
q AS (SELECT c, depth, w, md5(array_to_string(path, ',')) AS node,
             CASE WHEN depth = 1 THEN '' ELSE md5(array_to_string(path[:-2], ',')) END AS up FROM p
      UNION ALL SELECT c, 0, 0, '', NULL FROM v),
e AS (SELECT v.c, count(r.pos) AS depth FROM v LEFT JOIN r ON r.c = v.c GROUP BY v.c),
f AS (SELECT q.node, sha256(string_agg(q.c::VARCHAR, ',' ORDER BY q.c)) AS sha FROM q JOIN e ON q.c = e.c AND q.depth = e.depth GROUP BY q.node),
n AS (SELECT node, depth, min(up) AS up, min(c) AS conv_id, count(*) AS n_convs, min(w) AS w FROM q GROUP BY node, depth),
g AS (SELECT up, count(*) AS kids FROM n WHERE depth > 0 GROUP BY up),
y AS (SELECT n.*, coalesce(g.kids, 0) AS n_children, (n_convs - 1) * w AS saved FROM n LEFT JOIN g ON n.node = g.up),
s AS (SELECT q.node, count(*) FILTER (WHERE y.n_children = 0) AS n_leaves, sum(y.saved)::BIGINT AS saved_tokens
      FROM y JOIN q ON q.c = y.conv_id AND q.depth <= y.depth GROUP BY q.node)
SELECT y.conv_id, y.depth, z.conv_id AS parent_conv_id, y.n_convs, y.n_children, s.n_leaves, s.saved_tokens,
       coalesce(f.sha, sha256('')) AS ends_sha256
FROM y JOIN s ON s.node = y.node LEFT JOIN n z ON z.node = y.up LEFT JOIN f ON f.node = y.node
"""

QUERIES = {
    "op1_adaptive_scan": op1_adaptive_scan,
    "op2_byte_gru": op2_byte_gru,
    "op3_quality_rank": op3_quality_rank,
    "op4_url_rules": op4_url_rules,
    "op5_secret_scan": op5_secret_scan,
    "op6_ngram_join": op6_ngram_join,
    "op7_line_spread": op7_line_spread,
    "op8_retrieval_packing": op8_retrieval_packing,
    "op9_mixing": op9_mixing,
    "op10_line_rules": op10_line_rules,
    "op11_minhash": op11_minhash,
    "minhash_classes": minhash_classes,
    "op12_collocations": op12_collocations,
    "op13_prefix_trie": op13_prefix_trie,
}
ORACLES = {"op4_url_rules": OP4_SQL, "op7_line_spread": OP7_SQL, "op9_mixing": OP9_SQL,
           "op12_collocations": OP12_SQL, "op13_prefix_trie": OP13_SQL}
