"""The text operators as queries over the test tables, with their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

import corpus_pipeline
from tagloom.llm import codes, embedding_dedup, jaccard, language, licences, mixing, neighbours, packing, passages, phrases, token_counts, topk, url_filter
from tagloom.llm.licence_texts import LICENCES, NOTICES, SPELLINGS

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Decorates ``f(spark, sf_dir) -> DataFrame``."""
    def register(make: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = make
        if sql is not None:
            ORACLES[name] = sql
        return make
    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


HELD_OUT = "coalesce(crc32(cast(cast(doc_id as string) as binary)) % 3 = 1, false)"


@query("op1_language_id")
def _language(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    model = language.train(documents, F.expr(f"NOT {HELD_OUT}"))
    keyed = documents.select("doc_id", "text", F.expr(HELD_OUT).alias("held_out"))
    return language.predict(keyed, model, ["doc_id", "held_out"])


@query("op5_mixing", """WITH sized AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS BIGINT) AS size FROM documents),
  per_source AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS weight FROM sized GROUP BY source),
  rates AS (SELECT *, 3.0::DOUBLE * source_size / weight AS own_rate,
    ((SELECT sum(source_size) FROM per_source) - coalesce(sum(3.0::DOUBLE * source_size) OVER (ORDER BY 3.0::DOUBLE * source_size / weight ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY 3.0::DOUBLE * source_size / weight ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS rate FROM per_source),
  aimed AS (SELECT source, source_size, least(3.0::DOUBLE * source_size, weight * coalesce((SELECT max(rate) FROM rates WHERE rate <= own_rate), 0)) AS target FROM rates),
  planned AS (SELECT d.doc_id, d.size, d.source, a.source_size, a.target, CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0 END AS ratio,
    (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'null') || '#7'), 1, 12) AS BIGINT) + 0.5::DOUBLE) / 281474976710656 AS u
    FROM sized d JOIN aimed a ON d.source IS NOT DISTINCT FROM a.source),
  odds AS (SELECT *, floor(ratio) AS whole, greatest(1e-9, least(1 - 1e-9, ratio - floor(ratio))) AS p, target - floor(ratio) * source_size AS lacking FROM planned),
  ranked AS (SELECT *, u * (1 - p) / (u * (1 - p) + p * (1 - u)) AS rank FROM odds),
  summed AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY rank, doc_id, size ROWS UNBOUNDED PRECEDING) AS run FROM ranked)
  SELECT doc_id, size, source_size, target, CAST((whole + CASE WHEN lacking > 0 AND size > 0 AND run - size / 2.0::DOUBLE <= lacking AND run - size < lacking THEN 1 ELSE 0 END) * size AS BIGINT) AS taken FROM summed""")
def _mixing(spark, sf_dir):
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]

_ADDRESS = """CASE WHEN {host} <> '' THEN {host} || regexp_extract({url}, '(?s)^.*?://[^/?#]*([^#]*)', 1) END"""


def _host(url):
    return f"translate(coalesce(regexp_extract({url}, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


# RE2 has no look-ahead: the tag is cut out first, then its attribute
_TAG = """regexp_extract(html, '(?is)<{tag}\\b[^>]*\\b{attribute}\\s*=\\s*["'']?{value}\\b[^>]*>')"""
_HREF = """regexp_extract({tag}, '(?is)\\b{attribute}\\s*=\\s*["'']?{before}([^"''\\s>]+)', 1)"""
_LINKS = [_HREF.format(tag=_TAG.format(tag="link", attribute="rel", value="canonical"), attribute="href", before=""),
          _HREF.format(tag=_TAG.format(tag="meta", attribute="http-equiv", value="refresh"), attribute="content", before="""\\s*[\\d.]*\\s*;\\s*url\\s*=\\s*["'']?""")]


@query("op10_url_filter", f"""WITH RECURSIVE seen AS (SELECT page_id, url, html, {_host("url")} AS host, coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
  addressed AS (SELECT *, {_ADDRESS.format(host="host", url="url")} AS address FROM seen),
  linked AS ({" UNION ALL ".join(f"SELECT address, url, host, path, {link} AS link FROM addressed" for link in _LINKS)}),
  resolved AS (SELECT address, CASE WHEN contains(link, '://') THEN link WHEN starts_with(link, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || link
    WHEN starts_with(link, '/') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || '://' || host || link WHEN regexp_matches(link, '^[?#]') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || '://' || host || path || link
    ELSE regexp_extract(url, '(?s)^(.*?)://', 1) || '://' || host || coalesce(nullif(regexp_extract(path, '(?s)^(.*/)', 1), ''), '/') || link END AS target FROM linked WHERE link <> ''),
  edges AS (SELECT address AS src, {_ADDRESS.format(host=_host("target"), url="target")} AS dst FROM resolved),
  sides AS (SELECT src, dst FROM edges WHERE src IS NOT NULL AND dst IS NOT NULL UNION SELECT dst, src FROM edges WHERE src IS NOT NULL AND dst IS NOT NULL),
  reached(node, other) AS (SELECT DISTINCT src, src FROM sides UNION SELECT r.node, s.dst FROM reached r JOIN sides s ON s.src = r.other),
  rules(rule_host, rule_path, own) AS (VALUES {", ".join(str(r) for r in URL_RULES)}),
  fitting AS (SELECT page_id, url, rule_host || rule_path AS rule, own, row_number() OVER (PARTITION BY page_id, url ORDER BY length(rule_host || rule_path) DESC) AS place
    FROM seen JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)),
  ruled AS (SELECT a.page_id, a.host, a.path, a.address, f.rule, f.own FROM addressed a LEFT JOIN fitting f ON f.page_id = a.page_id AND f.url = a.url AND f.place = 1),
  places AS (SELECT DISTINCT other, regexp_extract(other, '(?s)^([^/?]*)', 1) AS host, regexp_extract(other, '(?s)^[^/?]*([^?]*)', 1) AS path FROM reached),
  judged AS (SELECT other, arg_max(own, length(rule_host || rule_path)) AS own FROM places JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path) GROUP BY other),
  spread AS (SELECT node FROM reached JOIN judged USING (other) GROUP BY node HAVING bool_or(own = 'block') AND NOT bool_or(own = 'allow'))
  SELECT page_id, host, path, rule, coalesce(own, CASE WHEN address IN (SELECT node FROM spread) THEN 'block' ELSE 'allow' END) AS verdict FROM ruled""")
def _url_filter(spark, sf_dir):
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


@query("op3_token_counts")
def _token_counts(spark, sf_dir):
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _canonical(text: str) -> str:
    words = f"""regexp_replace(regexp_replace(replace(replace(lower({text}), '©', ' copyright '), '(c)', ' copyright '), '\\r\\n?', chr(10), 'g'), '[^\\p{{L}}\\p{{N}}\\n]+', ' ', 'g')"""
    for spelling, usual in SPELLINGS.items():
        words = f"replace({words}, {_quoted(spelling)}, {_quoted(usual)})"
    return f"regexp_replace({words}, ' ?\\n ?', chr(10), 'g')"


def _whole(lines: str) -> str:
    words = f"regexp_replace(regexp_replace({lines}, '\\n{{2,}}', ' ' || chr(31) || ' ', 'g'), '\\n', ' ', 'g')"
    for spelling, usual in SPELLINGS.items():
        if " " in spelling:
            words = f"replace({words}, {_quoted(spelling)}, {_quoted(usual)})"
    words = f"replace(' ' || {words}, ' all rights reserved', ' ' || chr(31))"
    joined = f"trim(regexp_replace(regexp_replace({words}, '{licences.STATEMENT}', ' \\1', 'g'), '[ \\x1f]+', ' ', 'g'), ' ')"
    return f"sha256(nullif(regexp_replace({joined}, '{licences.TITLE}', ''), ''))"


@query("op4_license_scan", f"""WITH known(name, text) AS (VALUES {", ".join(f"({_quoted(n)}, {_quoted(t)})" for n, t in LICENCES.items())}),
  known_digests AS (SELECT digest, min(name) AS licence FROM (SELECT name, {_whole("lines")} AS digest FROM (SELECT name, {_canonical("text")} AS lines FROM known)) GROUP BY digest),
  notices(line, name) AS (VALUES {", ".join(f"({_quoted(t)}, {_quoted(n)})" for t, n in NOTICES.items())}),
  known_lines AS (SELECT trim({_canonical("line")}, ' ') AS line, min(name) AS name FROM notices GROUP BY 1),
  read AS (SELECT row_number() OVER () AS row, doc_id, {_canonical("coalesce(text, '')")} AS lines FROM documents),
  digests AS (SELECT row, doc_id, {_whole("lines")} AS digest FROM read),
  named AS (SELECT row, string_agg(DISTINCT name, ',' ORDER BY name) AS notices FROM (SELECT row, trim(unnest(string_split(lines, chr(10))), ' ') AS line FROM read) JOIN known_lines USING (line) GROUP BY row)
  SELECT doc_id, licence, coalesce(notices, '') AS notices FROM digests LEFT JOIN known_digests USING (digest) LEFT JOIN named USING (row)""")
def _license_scan(spark, sf_dir):
    return licences.scan(table(spark, sf_dir, "documents"))


@query("op9_best_fit_packing")
def _packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"))


@query("op8_embedding_near_dedup")
def _embedding_near_dedup(spark, sf_dir):
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op7_nearest_neighbours")
def _nearest(spark, sf_dir):
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.expr("vec_id % 100 = 0"))


@query("op2_ngram_jaccard")
def _ngram_jaccard(spark, sf_dir):
    return jaccard.components(table(spark, sf_dir, "documents"), k=4, percent=85)


@query("op6_substring_dedup")
def _substring_dedup(spark, sf_dir):
    return passages.duplicates(table(spark, sf_dir, "documents"))


_FINITE = "embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"


def _nearest_entries(to: str, book: str) -> str:
    return f"""{to} AS (SELECT row, part, p, min(CAST(list_sum(list_transform(range(1, len(p) + 1), lambda i: (p[i] - e[i]) * (p[i] - e[i]))) AS BIGINT) * 64 + entry) AS best FROM pieces JOIN {book} USING (part) GROUP BY row, part, p)"""


def _moved_book(to: str, near: str, book: str) -> str:
    return f"""{to} AS (SELECT b.part, b.entry, coalesce(m.e, b.e) AS e FROM {book} b LEFT JOIN
    (SELECT part, entry, list((s - ((s % c) + c) % c) // c ORDER BY i) AS e FROM (SELECT part, best % 64 AS entry, i, CAST(sum(p[i]) AS BIGINT) AS s, count(*) AS c FROM {near}, range(1, len(p) + 1) r(i) GROUP BY ALL) GROUP BY part, entry) m
    ON m.part = b.part AND m.entry = b.entry)"""


@query("op11_vector_codes", f"""WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST) - 1 AS row, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings WHERE {_FINITE}),
  pieces AS (SELECT row, part, v[part * (len(v) // 16) + 1 : (part + 1) * (len(v) // 16)] AS p FROM kept, range(16) r(part)),
  book0 AS (SELECT part, row AS entry, p AS e FROM pieces WHERE row < 64),
  {_nearest_entries("near0", "book0")}, {_moved_book("book1", "near0", "book0")}, {_nearest_entries("near1", "book1")}, {_moved_book("book2", "near1", "book1")}, {_nearest_entries("near2", "book2")},
  coded AS (SELECT row, string_agg(printf('%02x', best % 64), '' ORDER BY part) AS code, CAST(sum(best // 64) AS BIGINT) AS error FROM near2 GROUP BY row),
  digest AS (SELECT sha256(string_agg(array_to_string(e, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book2)
  SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM kept JOIN coded USING (row), digest""")
def _vector_codes(spark, sf_dir):
    return codes.compress(table(spark, sf_dir, "embeddings"))


def _cut_score(a: str, first: str, rest: str) -> str:
    return f"CAST(CAST(2000000 AS HUGEINT) * {a} // ({first} + {rest}) AS BIGINT)"


@query("op12_collocations", f"""WITH pieces AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\\x0A-\\x0D]')), '[^\\x20\\x09]+') AS w FROM documents),
  counts AS (SELECT lang, size, array_to_string(w[i : i + size - 1], ' ') AS phrase, count(*) AS f FROM pieces, range(1, 5) s(size), unnest(range(1, len(w) - size + 2)) p(i) GROUP BY ALL),
  frequent AS (SELECT *, string_split(phrase, ' ') AS w FROM counts WHERE f >= 30),
  cuts AS (SELECT lang, size, phrase, f, w, k, array_to_string(w[:k], ' ') AS first, array_to_string(w[k + 1:], ' ') AS rest FROM frequent, range(1, 4) c(k) WHERE k < size),
  scored AS (SELECT c.lang, c.size, c.phrase, c.f AS a, c.w, min((({_cut_score("c.f", "x.f", "y.f")}), k, x.f, y.f)) AS worst FROM cuts c JOIN frequent x ON x.lang = c.lang AND x.phrase = c.first JOIN frequent y ON y.lang = c.lang AND y.phrase = c.rest GROUP BY ALL),
  hidden AS (SELECT DISTINCT s.lang, s.phrase FROM scored s JOIN frequent x ON x.lang = s.lang AND x.size > s.size AND 100 * x.f >= 80 * s.a AND contains(' ' || x.phrase || ' ', ' ' || s.phrase || ' ')),
  kept AS (SELECT * FROM scored s ANTI JOIN hidden h ON h.lang = s.lang AND h.phrase = s.phrase),
  ranked AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY worst[1] DESC, a DESC, phrase) AS rank, phrase, a, worst[3] AS l, worst[4] AS r, worst[1] AS score FROM kept),
  totals AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM counts WHERE size = 1 GROUP BY lang)
  SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000""")
def _collocations(spark, sf_dir):
    return phrases.collocations(table(spark, sf_dir, "documents"))


@query("op13_exact_topk", f"""WITH kept AS (SELECT row_number() OVER () AS row, vec_id, list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS v FROM embeddings WHERE {_FINITE}),
  scored AS (SELECT q.row AS query_row, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score FROM kept q JOIN kept c ON q.row <> c.row WHERE q.vec_id % 20 = 0),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY query_row ORDER BY score DESC, vec_id ASC NULLS LAST) AS rank FROM scored)
  SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM ranked WHERE rank <= 20""")
def _exact_topk(spark, sf_dir):
    return topk.search(table(spark, sf_dir, "embeddings"), F.expr("vec_id % 20 = 0"), k=20, scale=64)


@query("pipeline", corpus_pipeline.ORACLE_SQL)
def _pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)
