"""Registered queries of the training-data operators: each applies its
operator, with production parameters, to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (bpe, decontaminate, importance, jaccard_join, line_dedup, merkle, nn_descent, quality_classifier,
               quality_rules, secret_scan, suffix_dedup, url_filter, warc)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary() -> str:
    """Path of the word vocabulary; only the driver reads it."""
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    found = secret_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    kind = lambda x: F.substring_index(x, ":", 1)
    count = lambda name: F.size(F.filter("found", lambda x: kind(x) == name)).cast("long").alias(f"n_{name}")
    base = F.filter("found", lambda x: kind(x).isin(*secret_scan.BASE))
    return found.select("doc_id", *[count(name) for name in secret_scan.BASE],
                        F.sha2(F.array_join(base, ","), 256).alias("base_sha256"), F.array_join("found", ",").alias("spans"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules and class decisions for every page url."""
    return url_filter.judge_pages(_table(spark, sf_dir, "pages"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate components of all documents."""
    return jaccard_join.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows in every document."""
    return decontaminate.report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base rules and CRF line labelling over every document."""
    return quality_rules.apply_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def digest_tokens(docs: DataFrame) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of ``docs``, encoded and
    decoded again."""
    encoded = bpe.encode(docs.select("doc_id", "text"), vocabulary()).drop("text")
    return bpe.decode(encoded, vocabulary()).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op6_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded."""
    return digest_tokens(_table(spark, sf_dir, "documents"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines found in 10 documents or more, dropped everywhere."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.drop_repeated_lines(docs, min_docs=10, min_chars=1).select(
        "doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    return warc.archive_and_read(_table(spark, sf_dir, "pages")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "valid")


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Strings of 200 bytes that occur twice, removed from every document."""
    kept = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document scored by boosted trees."""
    return quality_classifier.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op11_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document weighed towards the benchmark, the drawn ones ranked."""
    return importance.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_nn_descent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest other vectors of every vector whose id 50 divides."""
    return nn_descent.nearest(_table(spark, sf_dir, "embeddings"), F.col("id") % 50 == 0)


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf and proof in the manifest, checked after tampering."""
    return merkle.verify(merkle.proofs(*merkle.manifest(_table(spark, sf_dir, "documents"))))


QUERIES = {
    "op1_secret_scan": op1_secret_scan,
    "op2_url_filter": op2_url_filter,
    "op3_jaccard_join": op3_jaccard_join,
    "op4_decontaminate": op4_decontaminate,
    "op5_quality_rules": op5_quality_rules,
    "op6_bpe": op6_bpe,
    "op7_line_dedup": op7_line_dedup,
    "op8_warc": op8_warc,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_importance": op11_importance,
    "op12_nn_descent": op12_nn_descent,
    "op13_merkle_manifest": op13_merkle_manifest,
}

_LINES = """
    SELECT doc_id, i AS pos, string_split(coalesce(text, ''), chr(10))[i] AS line
    FROM documents, LATERAL (SELECT unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS i)"""
_SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

_UP, _LOW = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ'", "'abcdefghijklmnopqrstuvwxyz'"
_WORDS = (f"[x FOR x IN string_split_regex(translate(coalesce(text, ''), {_UP}, {_LOW}), "
          r"'[\x00-\x2F\x3A-\x60\x7B-\x7F]+') IF x <> '']")

#: CRC-32 in SQL: the register after each byte (one row, a list t), and the checksum of a string.
_CRC_TABLE = """tab AS (
    SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, e: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS t
    FROM range(256) AS r(i))"""


def _crc(s: str) -> str:
    return (f"xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(strlen({s})), "
            f"lambda k: ('0x' || substr(hex(encode({s})), 2 * k + 1, 2))::BIGINT)), "
            "lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)")


def _framed(value: str) -> str:
    return f"coalesce(strlen({value}::VARCHAR) || ':' || {value}::VARCHAR, '-')"


def _leaf(n_chars: str) -> str:
    return "sha256(" + " || ".join(_framed(x) for x in ("doc_id", "source", "lang", n_chars, "text")) + ")"


ORACLE_SQL = {
    # The pages hold no canonical links or redirects, so classes are single urls here; the tests
    # compare propagation with a brute-force version.
    "op2_url_filter": f"""
WITH r AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)([^?#]*)', 1), {_UP}, {_LOW}) AS host,
             regexp_extract(rest, '^([^/?#]*)([^?#]*)', 2) AS path FROM r),
m AS (SELECT *, CASE
    WHEN (host = 'www.example.com' OR host LIKE '%.www.example.com') AND path LIKE '/en/%' THEN 'www.example.com/en/'
    WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/en/%' THEN 'example.com/en/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/es/%' THEN 'net/es/'
    WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/fr/%' THEN 'net/fr/'
    WHEN (host = 'com' OR host LIKE '%.com') AND path LIKE '/%' THEN 'com/' END AS rule FROM p)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.com/en/', 'net/es/', 'net/fr/') THEN 'block' ELSE 'allow' END AS verdict FROM m""",
    "op3_jaccard_join": f"""
WITH RECURSIVE t AS (
    SELECT doc_id, [x FOR x IN string_split_regex(translate(coalesce(text, ''), {_UP}, {_LOW}), '[ \\x09-\\x0D]+') IF x <> ''] AS w
    FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
      FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM t WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n, sha256(string_agg(s, chr(10) ORDER BY s)) AS c FROM g GROUP BY doc_id),
r AS (SELECT c, min(doc_id) AS rep, any_value(n) AS n FROM n GROUP BY c),
rg AS (SELECT g.doc_id, g.s, r.n FROM g JOIN r ON g.doc_id = r.rep),
i AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k, any_value(x.n) AS na, any_value(y.n) AS nb
      FROM rg x JOIN rg y ON x.s = y.s AND x.doc_id < y.doc_id GROUP BY x.doc_id, y.doc_id),
l AS (SELECT a, b FROM i WHERE 100 * k >= 80 * (na + nb - k)),
e AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
reach AS (SELECT rep AS a, rep AS b FROM r UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
low AS (SELECT a, min(b) AS component_id FROM reach GROUP BY a),
d AS (SELECT a, count(*) AS n_links FROM e GROUP BY a)
SELECT t.doc_id, coalesce(n.n, 0) AS n_shingles, coalesce(low.component_id, t.doc_id) AS component_id,
       coalesce(d.n_links, 0) AS n_links
FROM t LEFT JOIN n ON t.doc_id = n.doc_id LEFT JOIN r ON n.c = r.c
LEFT JOIN low ON r.rep = low.a LEFT JOIN d ON r.rep = d.a""",
    "op4_decontaminate": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
g AS (SELECT item_id, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i, w FROM b WHERE len(w) > 0),
items AS (SELECT DISTINCT item_id, array_to_string(w[i:i + 9], ' ') AS k, least(len(w), 10) AS n FROM g),
sizes AS (SELECT DISTINCT n FROM items),
s AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n),
h AS (SELECT s.doc_id, s.i, s.n, items.item_id
      FROM s JOIN items ON array_to_string(s.w[s.i:s.i + s.n - 1], ' ') = items.k AND s.n = items.n),
c AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
l AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS x FROM h) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c ON d.doc_id = c.doc_id LEFT JOIN l ON d.doc_id = l.doc_id""",
    "op7_line_dedup": f"""
WITH l AS (
    SELECT doc_id, pos, line,
           translate(trim(line, {_SPACES}), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS k
    FROM ({_LINES})),
hot AS (SELECT k FROM l WHERE k <> '' GROUP BY k HAVING count(DISTINCT doc_id) >= 10),
m AS (SELECT l.doc_id, l.pos, l.line, hot.k IS NOT NULL AS dropped FROM l LEFT JOIN hot ON l.k = hot.k)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM m GROUP BY doc_id""",
    "op8_warc": """
WITH p AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS n, sha256(coalesce(html, '')) AS d FROM pages),
f AS (SELECT d, min(page_id) AS low FROM p WHERE n >= 100 GROUP BY d)
SELECT p.page_id, p.n AS payload_bytes, p.d AS payload_digest,
       CASE WHEN p.n >= 100 AND p.page_id <> f.low THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.n >= 100 AND p.page_id <> f.low THEN f.low END AS refers_to, true AS valid
FROM p LEFT JOIN f ON p.d = f.d""",
    "op11_importance": f"""
WITH {_CRC_TABLE},
d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT {_WORDS} AS w FROM benchmark),
g AS (SELECT r, unnest(list_concat(w, [w[j] || ' ' || w[j + 1] FOR j IN range(1, len(w))],
                                   [w[j] || ' ' || w[j + 1] || ' ' || w[j + 2] FOR j IN range(1, len(w) - 1)])) AS x FROM d),
q AS (SELECT unnest(list_concat(w, [w[j] || ' ' || w[j + 1] FOR j IN range(1, len(w))],
                                [w[j] || ' ' || w[j + 1] || ' ' || w[j + 2] FOR j IN range(1, len(w) - 1)])) AS x FROM b),
u AS MATERIALIZED (SELECT x, {_crc('x')} % 10000 AS bucket FROM (SELECT x FROM g UNION SELECT x FROM q), tab),
s AS (SELECT bucket, count(*) AS n FROM g JOIN u USING (x) GROUP BY bucket),
t AS (SELECT bucket, count(*) AS n FROM q JOIN u USING (x) GROUP BY bucket),
z AS (SELECT (SELECT count(*) FROM g)::DOUBLE AS sn, (SELECT count(*) FROM q)::DOUBLE AS tn),
gain AS (SELECT bucket, floor(1000 * ln((coalesce(t.n, 0)::DOUBLE + 1) * (sn + 10000) / ((s.n::DOUBLE + 1) * (tn + 10000))))::BIGINT AS v
         FROM s LEFT JOIN t USING (bucket), z),
a AS (SELECT r, count(*) AS n_features, sum(v)::BIGINT AS weight FROM g JOIN u USING (x) JOIN gain USING (bucket) GROUP BY r),
c AS (SELECT d.r, doc_id, len(w) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
             coalesce(weight, 0) + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT + 0.5::DOUBLE)
             / 4294967296::DOUBLE)))::BIGINT AS score FROM d LEFT JOIN a USING (r)),
k AS (SELECT r, row_number() OVER (ORDER BY score DESC, doc_id NULLS LAST, n_features, weight) AS rank, count(*) OVER () AS n FROM c WHERE n_words >= 20)
SELECT c.doc_id, c.n_features, c.weight, c.score, CASE WHEN k.rank <= 5 * k.n // 100 THEN k.rank END AS rank FROM c LEFT JOIN k USING (r)""",
    "op13_merkle_manifest": f"""
WITH RECURSIVE {_CRC_TABLE},
d AS (SELECT doc_id, lang, {_leaf('n_chars')} AS leaf,
             CASE WHEN {_crc('doc_id::VARCHAR')} % 7 = 0 THEN {_leaf('(n_chars + 1)')} ELSE {_leaf('n_chars')} END AS held
      FROM documents, tab),
p AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id, leaf) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM d),
lv AS (SELECT lang, n, 0 AS lev, i, leaf AS h FROM p
       UNION ALL
       SELECT lang, n, lev + 1, i // 2, sha256(string_agg(h, '' ORDER BY i)) FROM lv
       WHERE (n - 1) >> lev > 0 GROUP BY lang, n, lev, i // 2),
s AS (SELECT lang, h AS subroot, row_number() OVER (ORDER BY encode(lang) NULLS FIRST) - 1 AS pl, count(*) OVER () AS m
      FROM lv WHERE (n - 1) >> lev = 0),
rt AS (SELECT m, 0 AS lev, pl, subroot AS h FROM s
       UNION ALL
       SELECT m, lev + 1, pl // 2, sha256(string_agg(h, '' ORDER BY pl)) FROM rt WHERE (m - 1) >> lev > 0 GROUP BY m, lev, pl // 2),
steps AS (
    SELECT p.lang, p.i, l.lev, CASE WHEN x.h IS NULL THEN 'A' WHEN x.i < l.i THEN 'L' || x.h ELSE 'R' || x.h END AS step
    FROM p JOIN lv l ON l.lang IS NOT DISTINCT FROM p.lang AND l.i = p.i >> l.lev AND (p.n - 1) >> l.lev > 0
    LEFT JOIN lv x ON x.lang IS NOT DISTINCT FROM l.lang AND x.lev = l.lev AND x.i = xor(l.i, 1)
    UNION ALL
    SELECT p.lang, p.i, 1000 + l.lev, CASE WHEN x.h IS NULL THEN 'A' WHEN x.pl < l.pl THEN 'L' || x.h ELSE 'R' || x.h END
    FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang JOIN rt l ON l.pl = s.pl >> l.lev AND (s.m - 1) >> l.lev > 0
    LEFT JOIN rt x ON x.lev = l.lev AND x.pl = xor(l.pl, 1)),
paths AS (SELECT lang, i, list(step ORDER BY lev) AS steps FROM steps GROUP BY lang, i),
f AS (SELECT p.doc_id, p.leaf, s.subroot, (SELECT h FROM rt WHERE (m - 1) >> lev = 0) AS root,
             sha256(array_to_string(list_transform(coalesce(paths.steps, []), lambda x: substr(x, 2)), '')) AS proof_sha256,
             list_reduce(list_prepend(p.held, coalesce(paths.steps, [])), lambda h, x: CASE x[1]
                 WHEN 'L' THEN sha256(substr(x, 2) || h) WHEN 'R' THEN sha256(h || substr(x, 2)) ELSE sha256(h) END) AS folded_root
      FROM p JOIN s ON s.lang IS NOT DISTINCT FROM p.lang
      LEFT JOIN paths ON paths.lang IS NOT DISTINCT FROM p.lang AND paths.i = p.i)
SELECT *, folded_root = root AS verified FROM f""",
}
