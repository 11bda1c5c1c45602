"""Registered queries of the text operators and their DuckDB oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, common, fingerprints, jaccard_join, language_id, mixing, prefix_trie, quality_fm, quality_rules, sharding,
               substring_dedup, token_files, url_filter, whitening)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


#: The public vocabulary files (a package of the box); their place is a parameter of the operators.
def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return public_tokenizers.path(name)


END_ID = 2


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = substring_dedup.remove_repeats(docs)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("text", 256).alias("kept_sha256"))


ORACLE["op1_substring_dedup"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, unnest(range(1, len(w) - 33)) AS i, unnest(list_transform(range(1, len(w) - 33),
               lambda i: array_to_string(w[i:i + 34], ' '))) AS g FROM d WHERE len(w) >= 35),
hit AS (SELECT r, i FROM win WHERE g IN (SELECT g FROM win GROUP BY g HAVING count(*) > 1)),
gone AS (SELECT DISTINCT r, i + o AS p FROM hit, range(0, 35) t(o)),
word AS (SELECT r, unnest(range(1, len(w) + 1)) AS p, unnest(w) AS x FROM d),
kept AS (SELECT word.r, count(gone.p) AS n_removed,
                coalesce(string_agg(x, ' ' ORDER BY word.p) FILTER (WHERE gone.p IS NULL), '') AS t
         FROM word LEFT JOIN gone ON word.r = gone.r AND word.p = gone.p GROUP BY word.r)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (r)
"""


@query
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_file("byte_bpe_50k.tiktoken")
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    out = bpe.decode(bpe.encode(docs, path), path)
    return out.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"),
                      F.sha2("decoded", 256).alias("decoded_sha256"))


@query
def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_files.round_trip(docs, tokenizer_file("byte_bpe_50k.json"), END_ID, added_tokens=True)


def _fold(n: int):
    return F.crc32(F.col("doc_id").cast("string")) % n


@query
def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(_fold(4) == 2, F.lit(False))
    model = language_id.fit(docs.filter(_fold(4) != 2), order=F.xxhash64("doc_id", "text"))
    out = language_id.predict(docs.select("doc_id", "text"), model)
    return out.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")


@query
def op4_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    labels = common.table(spark, sf_dir, "labels").select("doc_id", "quality")
    model = quality_fm.fit(docs, labels.filter(_fold(3) != 1))
    out = quality_fm.score(docs, model)
    return out.select("doc_id", F.coalesce(_fold(3) == 1, F.lit(False)).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_join.join(docs).select("doc_id", "n_shingles", "component_id")


ORACLE["op6_jaccard_join"] = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM d),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
hot AS (SELECT g FROM s GROUP BY g HAVING count(*) > 1),
t AS (SELECT * FROM s WHERE g IN (SELECT g FROM hot)),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met FROM t a JOIN t b ON a.g = b.g AND a.doc_id <> b.doc_id
      GROUP BY 1, 2),
e AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
      WHERE 100 * met >= 80 * (x.n + y.n - met)),
r AS (SELECT doc_id AS a, doc_id AS b FROM n UNION SELECT r.a, e.b FROM r JOIN e ON r.b = e.a)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.c, d.doc_id)::BIGINT AS component_id
FROM d LEFT JOIN n ON d.doc_id = n.doc_id LEFT JOIN (SELECT a, min(b) AS c FROM r GROUP BY a) c ON d.doc_id = c.a
"""


#: The rules that the URL query is given.
URL_RULES = [("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"),
             ("com", "/fr/", "allow"), ("com", "/de/", "block")]


@query
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = common.table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict", "score")


def _url_sql() -> str:
    """The same models in SQL: rules, gram counts, interpolation order by order, and the best split."""
    longest = sorted(URL_RULES, key=lambda r: -len(r[0] + r[1]))
    fits = [f"WHEN (host = '{h}' OR host LIKE '%.{h}') AND starts_with(path, '{p}') THEN" for h, p, _ in longest]
    rule = " ".join(f"{f} '{h}{p}'" for f, (h, p, _) in zip(fits, longest, strict=True))
    given = " ".join(f"{f} '{v}'" for f, (_, _, v) in zip(fits, longest, strict=True))
    k, m = url_filter.ORDER, url_filter.STRENGTH
    steps = [f"q AS (SELECT DISTINCT g, {1 / url_filter.ALPHABET}::DOUBLE AS pa, {1 / url_filter.ALPHABET}::DOUBLE AS pb FROM g)"]
    for j in range(k + 1):
        before = "q" if j == 0 else f"q{j - 1}"
        steps.append(f"""q{j} AS (SELECT q.g, (coalesce(n.a, 0) + {m}::DOUBLE * q.pa) / (coalesce(t.a, 0) + {m}::DOUBLE) AS pa,
               (coalesce(n.b, 0) + {m}::DOUBLE * q.pb) / (coalesce(t.b, 0) + {m}::DOUBLE) AS pb FROM {before} q
          LEFT JOIN (SELECT substr(g, {k + 1 - j}) AS e, sum(a) AS a, sum(b) AS b FROM c GROUP BY 1) n ON n.e = substr(q.g, {k + 1 - j})
          LEFT JOIN (SELECT substr(g, {k + 1 - j}, {j}) AS x, sum(a) AS a, sum(b) AS b FROM c GROUP BY 1) t
                 ON t.x = substr(q.g, {k + 1 - j}, {j}))""")
    return rf"""
WITH p AS (SELECT page_id, coalesce(url, '') AS s, CASE WHEN contains(url, '://') THEN substr(url, position('://' IN url) + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, s, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
r AS (SELECT *, CASE {rule} END AS rule, CASE {given} END AS given FROM h),
u AS (SELECT s, any_value(given) AS label, ('0x' || substr(md5(s), 1, 8))::BIGINT % 5 AS fold FROM r WHERE s <> '' GROUP BY s),
g AS (SELECT s, unnest(list_transform(range(1, length(s) + 2), lambda i: substr(repeat(chr(2), {k}) || s || chr(3), i, {k + 1}))) AS g FROM u),
c AS (SELECT g, count(*) FILTER (WHERE label = 'allow') AS a, count(*) FILTER (WHERE label = 'block') AS b
      FROM g JOIN u USING (s) WHERE fold > 0 AND label IS NOT NULL GROUP BY g),
{", ".join(steps)},
z AS (SELECT s, avg(ln(pa) - ln(pb)) AS score FROM g JOIN q{k} USING (g) GROUP BY s),
b AS (SELECT floor(score * {url_filter.BINS}) AS bin, count(*) FILTER (WHERE label = 'allow') AS a,
             count(*) FILTER (WHERE label = 'block') AS b FROM z JOIN u USING (s) WHERE fold = 0 AND label IS NOT NULL GROUP BY 1),
d AS (SELECT bin, lead(bin) OVER w AS nxt, (sum(a) OVER () - sum(a) OVER w) / nullif(sum(a) OVER (), 0)
             + (sum(b) OVER w) / nullif(sum(b) OVER (), 0) AS good FROM b WINDOW w AS (ORDER BY bin)),
y AS (SELECT (min(bin) + 1 + max(nxt)) / 2.0 / {url_filter.BINS} AS least FROM d
      WHERE good = (SELECT max(good) FROM d) AND nxt IS NOT NULL)
SELECT page_id, host, path, rule, coalesce(given, CASE WHEN coalesce(score, 0) >= coalesce(least, 0) THEN 'allow' ELSE 'block' END) AS verdict,
       coalesce(score, 0)::DOUBLE AS score
FROM r LEFT JOIN z USING (s) CROSS JOIN (SELECT max(least) AS least FROM y)
"""


ORACLE["op3_url_filter"] = _url_sql()


@query
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return quality_rules.judge(docs).drop("source")


ORACLE["op7_quality_rules"] = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT r, unnest(range(1, len(w) - 1)) AS i, unnest(list_transform(range(1, len(w) - 1),
               lambda i: array_to_string(w[i:i + 2], ' '))) AS g FROM d WHERE len(w) >= 3),
rep AS (SELECT r, count(DISTINCT i + o) AS n FROM
          (SELECT r, i FROM win WHERE (r, g) IN (SELECT (r, g) FROM win GROUP BY r, g HAVING count(*) > 1)) h,
          range(0, 3) x(o) GROUP BY r),
ln AS (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d),
dup AS (SELECT r, count(*) - count(DISTINCT l) AS n FROM ln WHERE regexp_matches(l, '[^\x20\x09-\x0D]') GROUP BY r),
m AS (SELECT d.r, doc_id, source, len(w)::BIGINT AS n_words,
             coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS word_chars,
             (length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
             coalesce(dup.n, 0)::BIGINT AS n_dup_lines, coalesce(rep.n, 0)::BIGINT AS n_repeat_words
      FROM d LEFT JOIN rep ON d.r = rep.r LEFT JOIN dup ON d.r = dup.r),
f AS (SELECT *, n_words < 50 AS short, 100 * n_repeat_words > 50 * n_words AS repeats,
             10 * n_symbols > word_chars AS symbols, n_dup_lines > 10 AS lines FROM m),
h AS (SELECT source, rule, sum(hit::INT)::DOUBLE AS bad, count(*) AS n FROM
        (SELECT source, unnest(['short', 'repeats', 'symbols', 'lines']) AS rule,
                unnest([short, repeats, symbols, lines]) AS hit FROM f) GROUP BY source, rule),
p AS (SELECT rule, avg(bad / n) AS mean, var_pop(bad / n) AS v FROM h GROUP BY rule),
q AS (SELECT rule, mean, CASE WHEN v > 0 THEN least(1e6, greatest(0, mean * (1 - mean) / v - 1)) ELSE 1e6 END AS s FROM p),
z AS (SELECT source, max(((bad + mean * s) / (n + s) > least(0.5, CASE WHEN s < 1e6 THEN mean + 3 * sqrt(mean * (1 - mean) / (s + 1))
                                                                ELSE 0.5 END))::INT) = 1 AS rejected
      FROM h JOIN q USING (rule) GROUP BY source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, short OR repeats AS base_failed,
       NOT (short OR repeats) AND NOT rejected AS kept
FROM f JOIN z ON f.source IS NOT DISTINCT FROM z.source
"""


@query
def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "text")
    rows = fingerprints.neighbours(docs, derived={"fingerprint": fingerprints.sketch})
    rows = rows.withColumn("edited", fingerprints.half_edited(F.col("text"), F.col("next_text")))
    rows = rows.select("doc_id", F.char_length("text").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
                       "fingerprint", "next_fingerprint", fingerprints.word_array(F.col("edited")).alias("w"))
    rows = rows.withColumn("edited_fingerprint", fingerprints.sketch(F.col("w")))
    like = fingerprints.likeness
    return rows.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
                       like(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
                       like(F.col("fingerprint"), F.col("next_fingerprint")).alias("near_next"),
                       fingerprints.containment(F.col("fingerprint"), F.col("edited_fingerprint")).alias("inside_edited"))


ORACLE["op9_fingerprints"] = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
x AS (SELECT doc_id, t, coalesce(lead(t) OVER o, first_value(t) OVER o) AS u,
             coalesce(lead(doc_id) OVER o, first_value(doc_id) OVER o) AS next_id FROM d WINDOW o AS (ORDER BY doc_id DESC)),
e AS (SELECT doc_id, next_id, length(t) AS n, t,
             substr(t, 1, length(t) - length(t) // 2) || substr(u, 1, length(t) // 2) AS s FROM x),
a AS (SELECT doc_id, 0 AS kind, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w FROM e UNION ALL
      SELECT doc_id, 1, regexp_extract_all(s, '[^\x20\x09-\x0D]+') FROM e),
g AS (SELECT doc_id, kind, list_distinct(list_transform(
        CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END,
        lambda y: md5(y))) AS h FROM a),
k AS (SELECT doc_id, kind, list_sort(list_transform(
        CASE WHEN len(list_filter(h, lambda y: y < '2')) > 0 THEN list_filter(h, lambda y: y < '2')
             WHEN len(h) > 0 THEN [list_min(h)] ELSE [] END, lambda y: y[1:12])) AS m FROM g),
z AS (SELECT e.*, p.m AS p, q.m AS q, r.m AS r FROM e JOIN k p ON p.doc_id = e.doc_id AND p.kind = 0
      JOIN k q ON q.doc_id = e.doc_id AND q.kind = 1 JOIN k r ON r.doc_id = next_id AND r.kind = 0)
SELECT doc_id, n::BIGINT AS n_chars, sha256(s) AS edited_sha256, coalesce(array_to_string(p, ''), '') AS fingerprint,
       coalesce(array_to_string(q, ''), '') AS edited_fingerprint,
       CASE WHEN p = q THEN 1.0::DOUBLE WHEN len(p) = 0 OR len(q) = 0 THEN 0.0
            ELSE len(list_intersect(p, q))::DOUBLE / (len(p) + len(q) - len(list_intersect(p, q))) END AS near_edited,
       CASE WHEN p = r THEN 1.0::DOUBLE WHEN len(p) = 0 OR len(r) = 0 THEN 0.0
            ELSE len(list_intersect(p, r))::DOUBLE / (len(p) + len(r) - len(list_intersect(p, r))) END AS near_next,
       CASE WHEN len(p) = 0 THEN 1.0::DOUBLE ELSE len(list_intersect(p, q))::DOUBLE / len(p) END AS inside_edited
FROM z
"""


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = common.table(spark, sf_dir, "documents").select("doc_id", "source", mixing.size_of("text").alias("words"))
    out = mixing.sample(docs, F.col("words"))
    return out.select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"))


ORACLE["op10_mixing"] = r"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM documents),
s AS (SELECT source, count(*) AS docs, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, [5.0, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source COLLATE C NULLS LAST) - 1) % 3]::DOUBLE AS w,
             3.0::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, row_number() OVER o AS place,
             (sum(source_size) OVER () - (sum(cap) OVER o - cap)) / (sum(w) OVER () - (sum(w) OVER o - w)) AS lev
      FROM w WINDOW o AS (ORDER BY cap / w, source NULLS LAST ROWS UNBOUNDED PRECEDING)),
t AS (SELECT source, docs, source_size,
             least(cap, w * (SELECT arg_min(lev, place) FROM l WHERE lev * w <= cap))::DOUBLE AS target FROM l),
p AS (SELECT source, docs, source_size, target, CASE WHEN source_size > 0 THEN target / source_size ELSE 0 END AS rate,
             floor(('0x' || substr(md5('17:' || (source IS NULL)::VARCHAR || ':' || coalesce(source, '')), 1, 8))::BIGINT
                   / 4194304) / 1024.0::DOUBLE AS shift,
             ceil(docs / 20000)::BIGINT AS cut FROM t),
k AS (SELECT d.doc_id, d.size, p.source_size, p.target, p.rate, p.shift, row_number() OVER (PARTITION BY p.source ORDER BY
             length(bin(d.size)), ('0x' || substr(md5(coalesce(d.doc_id::VARCHAR, '')), 1, 8))::BIGINT % p.cut, d.size, d.doc_id) AS i
      FROM d JOIN p ON d.source IS NOT DISTINCT FROM p.source)
SELECT doc_id, size, source_size, target, (floor(shift + rate * i) - floor(shift + rate * (i - 1)))::BIGINT * size AS taken FROM k
"""


@query
def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    stages = common.Stages(spark, "trie")
    turns = prefix_trie.number(common.table(spark, sf_dir, "conversations"), stages)
    turns = prefix_trie.branch(turns, stages, lead=F.col("conv") - F.col("conv") % 5,
                               taken=F.crc32(F.col("conv").cast("string").cast("binary")) % 9, most=8)
    return prefix_trie.ends_digest(prefix_trie.build(turns, stages))


# CRC-32 byte by byte over the digits of distinct ids; every node is counted to all its prefixes.
ORACLE["op11_prefix_trie"] = r"""
WITH poly AS (SELECT range AS i, list_reduce(list_prepend(range::BIGINT, range(0, 8)),
       lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) AS v FROM range(0, 256)),
tab AS (SELECT list(v ORDER BY i) AS t FROM poly),
q AS (SELECT conv_id AS c, list(row(coalesce(role, ''), coalesce(text, ''))
             ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS s
      FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id),
h AS (SELECT c, s, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
             list_transform(range(1, length(c::VARCHAR) + 1), lambda i: ascii(substr(c::VARCHAR, i, 1))::BIGINT)),
             lambda a, b: xor(t[1 + (xor(a, b) & 255)], a >> 8))) % 9 AS h FROM q, tab),
r AS (SELECT h.c, coalesce(l.s[1:h.h], []) || coalesce(h.s[h.h + 1:], []) AS s FROM h LEFT JOIN q l ON l.c = h.c - h.c % 5),
p AS (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM r),
n AS (SELECT s[1:d] AS x, d, min(c) AS conv_id, count(*) AS n_convs, coalesce(octet_length(encode(s[1:d][d][2])), 0) AS bytes,
             coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE len(s) = d), '') AS ends FROM p GROUP BY s[1:d], d,
             coalesce(octet_length(encode(s[1:d][d][2])), 0)),
k AS (SELECT x[1:d - 1] AS x, count(*) AS kids FROM n WHERE d > 0 GROUP BY 1),
m AS (SELECT n.*, coalesce(kids, 0) AS kids FROM n LEFT JOIN k ON n.x = k.x),
u AS (SELECT x[1:a] AS x, sum((kids = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * bytes)::BIGINT AS saved_tokens
      FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM m) GROUP BY 1)
SELECT m.conv_id, m.d::BIGINT AS depth, o.conv_id AS parent_conv_id, m.n_convs, m.kids AS n_children, n_leaves, saved_tokens,
       sha256(m.ends) AS ends_sha256
FROM m JOIN u ON m.x = u.x LEFT JOIN n o ON m.d > 0 AND o.x = m.x[1:m.d - 1]
"""


@query
def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce("text", F.lit(""))
    docs = common.table(spark, sf_dir, "documents").select(
        "doc_id", "source", (F.octet_length(text) + 16).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    order = mixing.hash32(F.concat_ws(":", F.lit(str(sharding.SEED)), F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                      F.col("text_crc32").cast("string")))
    out = sharding.assign(docs, order=F.struct(order.alias("h"), F.col("doc_id"), F.col("text_crc32"), F.col("size")))
    return out.select("doc_id", "size", "text_crc32", F.lit(sharding.LAW).alias("law"), "shard", "slot",
                      F.lit(None).cast("int").alias("grown_shard"))


# DuckDB has no CRC-32, so the CRC of the text is worked out byte by byte over distinct texts.
ORACLE["op12_sharding"] = r"""
WITH RECURSIVE poly AS (SELECT range AS i, list_reduce(list_prepend(range::BIGINT, range(0, 8)),
       lambda c, k: CASE WHEN c & 1 = 1 THEN xor(3988292384::BIGINT, c >> 1) ELSE c >> 1 END) AS v FROM range(0, 256)),
tab AS (SELECT list(v ORDER BY i) AS t FROM poly),
u AS (SELECT DISTINCT coalesce(text, '') AS x FROM documents),
crc AS (SELECT x, xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT,
              list_transform(range(0, octet_length(encode(x))), lambda i: ('0x' || substr(hex(encode(x)), 2 * i + 1, 2))::BIGINT)),
              lambda c, b: xor(t[1 + (xor(c, b) & 255)], c >> 8))) AS c FROM u, tab),
d AS (SELECT doc_id, source, (octet_length(encode(coalesce(text, ''))) + 16)::BIGINT AS size, c AS text_crc32,
             CASE WHEN source IS NULL THEN 'n' ELSE 'v' || source END AS s FROM documents JOIN crc ON x = coalesce(text, '')),
h AS (SELECT *, ('0x' || substr(md5('29:' || coalesce(doc_id::VARCHAR, '') || ':' || text_crc32), 1, 8))::BIGINT AS h,
             floor(('0x' || substr(md5('29:' || s), 1, 8))::BIGINT / 4194304) / 1024.0::DOUBLE AS u FROM d),
r AS (SELECT *, row_number() OVER (PARTITION BY s ORDER BY h, doc_id NULLS FIRST, text_crc32, size) - 1 AS k,
             count(*) OVER (PARTITION BY s) AS n FROM h),
p AS (SELECT *, row_number() OVER (ORDER BY (k + u) / n, s, k) - 1 AS place, count(*) OVER () AS total FROM r)
SELECT doc_id, size, text_crc32, 'rows' AS law, (place * 40 // total)::INTEGER AS shard,
       (place - (place * 40 // total * total + 39) // 40)::BIGINT AS slot, NULL::INTEGER AS grown_shard FROM p
"""


@query
def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = common.table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whitening.whiten(vectors)
