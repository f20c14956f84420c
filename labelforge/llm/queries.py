"""Registered queries of this subpackage, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import bpe as op4
from . import conversations as op12
from . import exact as op7
from . import fingerprint as op6
from . import katz as op9
from . import language as op11
from . import lines as op10
from . import ngram_join as op1
from . import packing as op3
from . import quality as op8
from . import spelling as op13
from . import substring as op2
from . import urls as op5
from .base import table

QUERIES: dict = {}
SQL: dict = {}


def query(sql: str | None = None):
    def add(fn):
        QUERIES[fn.__name__] = fn
        if sql:
            SQL[fn.__name__] = sql
        return fn
    return add


WORD = r"[^\x20\x09-\x0D]+"
FOLD = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

NGRAM_SQL = rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce({FOLD}, ''), '{WORD}') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
  ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
e AS (SELECT doc_id, unnest(s) AS g FROM s),
p AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS i FROM e a JOIN e b USING (g) WHERE a.doc_id <> b.doc_id GROUP BY ALL),
links AS (SELECT u, v FROM p JOIN s a ON a.doc_id = u JOIN s b ON b.doc_id = v WHERE 100 * i >= 75 * (len(a.s) + len(b.s) - i)),
r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT r.doc_id, links.v FROM r JOIN links ON links.u = r.c)
SELECT doc_id, len(s)::BIGINT AS n_shingles, c AS component_id FROM s JOIN (SELECT doc_id, min(c) AS c FROM r GROUP BY 1) USING (doc_id)"""


@query(NGRAM_SQL)
def op1_ngram_join(spark, sf_dir):
    return op1.ngram_join(table(spark, sf_dir, "documents"))


SUBSTRING_SQL = rf"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{WORD}') AS w FROM documents),
g AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS p, unnest(list_transform(range(1, len(w) - 33), lambda i: md5(array_to_string(w[i:i + 34], ' ')))) AS h FROM w WHERE len(w) >= 35),
r AS (SELECT doc_id, p FROM g WHERE h IN (SELECT h FROM g GROUP BY h HAVING count(*) > 1)),
c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS p FROM r),
d AS (SELECT doc_id, list(p) AS ps, count(*) AS n FROM c GROUP BY 1)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(list_filter(w, lambda x, i: NOT coalesce(list_contains(ps, i), false)), ' '), '')) AS kept_sha256
FROM w LEFT JOIN d USING (doc_id)"""


@query(SUBSTRING_SQL)
def op2_substring_dedup(spark, sf_dir):
    out = op2.substring_dedup(table(spark, sf_dir, "documents"))
    return out.select("payload.doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


EXACT_SQL = f"""
WITH t AS (SELECT doc_id, sha256(coalesce({FOLD}, '')) AS text_sha256 FROM documents),
g AS (SELECT *, max(doc_id) OVER (PARTITION BY text_sha256) AS keep_id, count(*) OVER (PARTITION BY text_sha256) AS group_size FROM t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM g"""


@query(EXACT_SQL)
def op7_exact_dedup(spark, sf_dir):
    """The older half of the id range is history, the younger half arrives."""
    docs = table(spark, sf_dir, "documents")
    lo, hi = docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    return op7.exact_dedup(docs, F.col("doc_id") <= ((lo or 0) + (hi or 0)) // 2)


LINES_SQL = """
WITH t AS (SELECT doc_id, source, string_split(text, chr(10)) AS l FROM documents),
c AS (SELECT source, line, count(*) AS c FROM (SELECT source, unnest(list_distinct(l)) AS line FROM t) WHERE trim(line) <> '' GROUP BY ALL),
b AS (SELECT c.source, list(line) AS cut FROM c JOIN (SELECT source, count(*) AS pages FROM documents GROUP BY 1) p
  ON c.source IS NOT DISTINCT FROM p.source WHERE c.c >= 5 AND 100 * c.c > 8 * pages GROUP BY 1),
k AS (SELECT doc_id, l, list_filter(l, lambda x: NOT coalesce(list_contains(cut, x), false)) AS k
  FROM t LEFT JOIN b ON t.source IS NOT DISTINCT FROM b.source)
SELECT doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(l) - len(k), 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(k, chr(10)), '')) AS kept_sha256 FROM k"""


@query(LINES_SQL)
def op10_line_dedup(spark, sf_dir):
    out = op10.line_dedup(table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


@query()
def op3_packing(spark, sf_dir):
    return op3.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op4_bpe(spark, sf_dir):
    out = op4.encode(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"), decode=True)
    return out.select(F.col("key").alias("doc_id"), (F.length("ids") / 4).cast("long").alias("n_tokens"),
                      F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


RULES = [("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/")]
_HOST = "translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
URL_SQL = f"""
WITH u AS (SELECT page_id, CASE WHEN contains(url, '://') THEN url[instr(url, '://') + 3:] ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, {_HOST} AS host, regexp_extract(rest[length(regexp_extract(rest, '^[^/?#]*')) + 1:], '^[^?#]*') AS path FROM u),
r(verdict, h, t) AS (VALUES {', '.join(str(x) for x in RULES)}),
m AS (SELECT page_id, h || t AS rule, verdict, row_number() OVER (PARTITION BY page_id ORDER BY length(h || t) DESC, length(h) DESC) AS n
  FROM p JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, t))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN (SELECT * FROM m WHERE n = 1) USING (page_id)"""


@query(URL_SQL)
def op5_url_filter(spark, sf_dir):
    return op5.url_filter(table(spark, sf_dir, "pages"), RULES)


@query()
def op6_fingerprints(spark, sf_dir):
    return op6.fingerprints(table(spark, sf_dir, "documents"))


@query()
def op8_quality(spark, sf_dir):
    out = op8.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return out.select("doc_id", "held_out", "score", "predicted")


@query()
def op9_katz(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return op9.katz_scores(docs, F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 != 2)


@query()
def op11_language(spark, sf_dir):
    return op11.identify(table(spark, sf_dir, "documents")).select("doc_id", "held_out", "lang_pred", "score")


#: CRC-32 in SQL: the table of byte steps, and the digest of a list of bytes.
CRC_TABLE = """bits(i, k, c) AS (SELECT i, 0, i FROM range(256) r(i) UNION ALL
  SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM bits WHERE k < 8),
tab AS (SELECT list(c ORDER BY i) AS t FROM bits WHERE k = 8)"""


def crc_sql(values: str) -> str:
    return f"xor(list_reduce({values}, lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]), 4294967295::BIGINT), 4294967295)"


CONVERSATION_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
k AS (SELECT *, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
d AS (SELECT conv_id, turn, {crc_sql("list_transform(string_split(key, ''), lambda x: unicode(x)::BIGINT)")} % 20 AS d, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text FROM k, tab),
a AS (SELECT conv_id, turn, CASE d WHEN 4 THEN 'user' ELSE role END AS role,
  CASE d WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE d WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM d WHERE d <> 0),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
  rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS body, role[1] AS ini FROM a),
f AS (SELECT *, CASE WHEN body = '' THEN 'b' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd' WHEN right(body, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '-' END AS fault,
  lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM o),
pat(st, ini, nx) AS (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins AS (SELECT st AS p, 0 AS n, st FROM range(4) r(st) UNION ALL SELECT p, n + 1, nx FROM ins JOIN pat USING (st) WHERE ini <> 's' AND n < 2),
op(st, nx, c, op, role, ini) AS (SELECT st, st, 2, 'D', '', NULL FROM range(4) r(st) UNION ALL SELECT st, nx, 0, 'K', '', ini FROM pat
  UNION ALL SELECT st, nx, 1, 'R', CASE ini WHEN 'u' THEN 'user' ELSE 'assistant' END, NULL FROM pat WHERE ini <> 's'),
dp AS (
  SELECT DISTINCT conv_id, 0::BIGINT AS i, 0::BIGINT AS st, 0::BIGINT AS cost, '' AS audit, []::VARCHAR[] AS rep FROM f
  UNION ALL
  SELECT conv_id, i, st, b.cost, b.audit, b.rep FROM (
    SELECT dp.conv_id, f.i, op.nx::BIGINT AS st, min({{'cost': (dp.cost + 5 * ins.n + op.c + CASE WHEN op.op <> 'D' AND f.fault = 't' THEN 5 ELSE 0 END)::BIGINT,
      'audit': dp.audit || repeat('I', ins.n) || op.op,
      'rep': dp.rep || list_transform(range(ins.n), lambda j: CASE WHEN (ins.p = 2) = (j = 0) THEN 'assistant:' ELSE 'user:' END)
        || CASE op.op WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [f.role || ':' || f.text] ELSE [op.role || ':' || f.text] END}}) AS b
    FROM dp JOIN f ON f.conv_id IS NOT DISTINCT FROM dp.conv_id AND f.i = dp.i + 1 JOIN ins ON ins.p = dp.st
    JOIN op ON op.st = ins.st AND (op.op = 'D' OR f.fault IN ('-', 't')) AND (op.ini IS NULL OR op.ini = f.ini)
    GROUP BY dp.conv_id, f.i, op.nx)),
n AS (SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
  count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY 1),
z AS (SELECT dp.conv_id, min({{'cost': cost + 5 * ins.n, 'audit': audit || repeat('I', ins.n), 'rep': rep || CASE ins.n WHEN 0 THEN []
    WHEN 1 THEN ['assistant:'] ELSE ['user:', 'assistant:'] END}}) AS b
  FROM dp JOIN n ON n.conv_id IS NOT DISTINCT FROM dp.conv_id AND dp.i = n.n JOIN ins ON ins.p = dp.st AND ins.st IN (0, 3) GROUP BY 1)
SELECT c.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
  coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(b.cost, 0)::BIGINT AS cost, coalesce(b.audit, '') AS audit,
  sha256(coalesce(array_to_string(b.rep, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM c.conv_id"""


@query(CONVERSATION_SQL)
def op12_conversations(spark, sf_dir):
    rows = op12.damaged(table(spark, sf_dir, "conversations"))
    return op12.joined(op12.repair(rows, dropped=F.col("dropped"))).withColumnRenamed("conv", "conv_id")


SPELLING_SQL = rf"""
WITH RECURSIVE {CRC_TABLE},
r AS (SELECT doc_id, unnest(regexp_extract_all({FOLD}, '[A-Za-z\x{{C0}}-\x{{FF}}]+')) AS w FROM documents),
g AS (SELECT doc_id, w, count(*) AS n FROM r GROUP BY ALL),
p AS (SELECT *, coalesce(doc_id::VARCHAR, '') || ':' || w AS key FROM g),
h AS (SELECT w, n, {crc_sql("flatten(list_transform(string_split(key, ''), lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [195::BIGINT, unicode(x)::BIGINT - 64] END))")} AS h FROM p, tab),
v AS (SELECT CASE WHEN h % 199 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
w AS (SELECT word, sum(n)::BIGINT AS n FROM v WHERE length(word) >= 6 GROUP BY 1 HAVING sum(n) >= 5),
k AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w),
d AS (SELECT DISTINCT word, n, left(word, i - 1) || substr(word, i + 1) AS cut FROM k),
s AS (SELECT word, n, i, left(word, i - 1) || '*' || substr(word, i + 1) AS wild FROM k),
e AS (SELECT a.word, b.word AS other, b.n AS m FROM s a JOIN s b USING (wild, i) WHERE a.word <> b.word
  UNION SELECT d.word, w.word, w.n FROM d JOIN w ON d.cut = w.word UNION SELECT w.word, d.word, d.n FROM d JOIN w ON d.cut = w.word),
b AS (SELECT word, count(*) AS n_near, min({{'rest': -m, 'form': other}}) AS best FROM e GROUP BY 1),
f AS (SELECT word, n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN -best.rest >= 5 * n THEN best.form END AS form,
  CASE WHEN -best.rest >= 5 * n THEN -best.rest END AS form_n FROM w LEFT JOIN b USING (word)),
c AS (SELECT word, word AS at FROM f UNION ALL SELECT c.word, f.form FROM c JOIN f ON f.word = c.at WHERE f.form IS NOT NULL),
z AS (SELECT c.word, c.at AS root FROM c JOIN f ON f.word = c.at WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM f JOIN z USING (word)"""


@query(SPELLING_SQL)
def op13_spelling(spark, sf_dir):
    words = op13.word_counts(table(spark, sf_dir, "documents")).where("n >= 5")
    return op13.spelling_groups(op13.stored(words, "words"))
