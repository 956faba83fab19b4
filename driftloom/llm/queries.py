"""The subpackage's queries, each over its whole table with production settings, and SQL where it can say the same."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from driftloom.llm import decontamination, embedding_cells, language, licences, mixing, pseudonyms, simhash, spelling, substrings, suffix_arrays, token_output, toxicity, word_runs
from driftloom.llm.common import table

TOKENIZER = "word_bpe_49k.json"


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_output.token_digests(table(spark, sf_dir, "documents"), tokenizer_path())


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, count = pseudonyms.with_pseudonyms(table(spark, sf_dir, "documents").select("doc_id", "text"), pseudonyms.DEMO_KEY)
    return rows.select("doc_id", "text", rows[count].cast("long").alias("n_replaced"))


def op4_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_arrays.repeated_passages(table(spark, sf_dir, "documents"))


def op5_licence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licences.scan_licences(table(spark, sf_dir, "documents"), licences.known_licences(spark))


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mixture_report(table(spark, sf_dir, "documents"))


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_report(table(spark, sf_dir, "documents"))


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats_report(table(spark, sf_dir, "documents"))


def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op10_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_cells.linked_vectors(table(spark, sf_dir, "embeddings"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_report(table(spark, sf_dir, "documents"))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return word_runs.periodic_report(table(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP2_SQL = rf"""
WITH items AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
windows AS (SELECT DISTINCT item, least(13, len(w)) AS size, w[i : i + least(13, len(w)) - 1] AS words
  FROM (SELECT item, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM items WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT size FROM windows),
docs AS (SELECT doc_id, coalesce({_WORDS}, []) AS w FROM documents),
places AS (SELECT doc_id, size, i, w[i : i + size - 1] AS words
  FROM (SELECT doc_id, size, w, unnest(range(1, len(w) - size + 2)) AS i FROM docs, sizes WHERE len(w) >= size)),
hits AS (SELECT doc_id, i, p.size, item FROM places p JOIN windows v ON p.size = v.size AND p.words = v.words),
covered AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS k FROM hits) GROUP BY doc_id),
named AS (SELECT doc_id, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS listed FROM hits GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)"""

# Blank-separated words. Windows are told apart by their text, which no word's blank can blur.
_PLACES = r"""
docs AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
places AS (SELECT doc_id, i, array_to_string(w[i : i + {n} - 1], ' ') AS words
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - {n} + 2)) AS i FROM docs WHERE len(w) >= {n})),
again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY words ORDER BY doc_id, i) AS nth FROM places) WHERE nth > 1),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + {n})) AS k FROM again)"""

OP4_SQL = f"""
WITH {_PLACES.format(n=50)},
runs AS (SELECT doc_id, k, k - row_number() OVER (PARTITION BY doc_id ORDER BY k) AS run FROM gone)
SELECT doc_id, (min(k) - 1)::BIGINT AS first_word, count(*)::BIGINT AS n_words,
  array_to_string(any_value(w)[min(k) : max(k)], ' ') AS passage
FROM runs JOIN docs USING (doc_id) GROUP BY doc_id, run"""

def _canonical(text: str) -> str:
    out = f"regexp_replace(lower({text}), '{licences.COPYRIGHT_LINE}', '', 'g')"
    for pattern, plain in licences.SPELLINGS:
        out = f"regexp_replace({out}, '{pattern}', '{plain.replace('$', chr(92))}', 'g')"
    return rf"regexp_replace({out}, '[^\p{{L}}\p{{N}}\n]+', ' ', 'g')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_WHOLE = r"trim(regexp_replace({}, '[ \n]+', ' ', 'g'))"
OP5_SQL = f"""
WITH known AS (SELECT sha256({_WHOLE.format(_canonical("text"))}) AS digest, min(license_id) AS license_id
  FROM (VALUES {", ".join(f"({_quoted(k)}, {_quoted(t)})" for k, t in licences.KNOWN)}) AS v(license_id, text) GROUP BY 1),
docs AS (SELECT doc_id, {_canonical("text")} AS lines FROM documents),
units AS (SELECT doc_id, 0 AS line, {_WHOLE.format("lines")} AS canonical FROM docs
  UNION ALL SELECT doc_id, unnest(range(1, len(string_split(lines, chr(10))) + 1)), trim(unnest(string_split(lines, chr(10)))) FROM docs),
rows_ AS (SELECT doc_id, line::INTEGER AS line, CASE WHEN canonical <> '' THEN sha256(canonical) END AS digest FROM units WHERE line = 0 OR canonical <> '')
SELECT doc_id, line, r.digest, license_id FROM rows_ r LEFT JOIN known k ON r.digest = k.digest WHERE line = 0 OR license_id IS NOT NULL"""

OP8_SQL = f"""
WITH {_PLACES.format(n=20)},
cut AS (SELECT doc_id, list(k) AS ks FROM gone GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(ks), 0)::BIGINT AS n_removed,
  sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(ks, []), i)), ' ')) AS kept_sha256
FROM docs LEFT JOIN cut USING (doc_id)"""

OP10_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings),
fit AS (SELECT vec_id, label, e FROM v WHERE label IS NOT NULL AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
  AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM fit a JOIN fit b ON a.label = b.label AND a.vec_id <> b.vec_id
  AND list_cosine_similarity(a.e, b.e) >= 0.98),
reach AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a),
smallest AS (SELECT a AS vec_id, min(b) AS component_id FROM reach GROUP BY a),
counted AS (SELECT a AS vec_id, count(*) AS n FROM links GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM v JOIN smallest USING (vec_id) LEFT JOIN counted USING (vec_id)"""



def _crc32(text: str) -> str:
    """SQL for the unsigned crc32 of a text with code points below 2048, bit by bit."""
    points = f"list_transform(string_split({text}, ''), lambda c: ord(c))"
    coded = f"flatten(list_transform({points}, lambda c: CASE WHEN c < 128 THEN [c] ELSE [192 + (c >> 6), 128 + (c & 63)] END))"
    steps = f"flatten(list_transform({coded}, lambda b: [b::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))"
    fold = "CASE WHEN x >= 0 THEN xor(a, x) WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {steps}), lambda a, x: {fold}), 4294967295)"


_RUNS = "regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')"
OP11_SQL = f"""
WITH RECURSIVE runs AS (SELECT doc_id, translate(run, '{spelling._UPPER}', '{spelling._LOWER}') AS run, count(*) AS n
  FROM (SELECT doc_id, unnest({_RUNS}) AS run FROM documents) WHERE length(run) >= 7 GROUP BY ALL),
hashed AS (SELECT run, n, {_crc32("doc_id || ':' || run")} AS h FROM runs),
words AS (SELECT CASE WHEN h % 31 = 0 THEN run[:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, sum(n)::BIGINT AS n
  FROM hashed GROUP BY 1 HAVING length(word) >= 7 AND sum(n) >= 2),
cuts AS (SELECT word, n, length(word) AS size, i, word[:i] || word[i + 2:] AS less FROM (SELECT word, n, unnest(range(length(word))) AS i FROM words)),
dropped AS (SELECT DISTINCT word, n, less FROM cuts),
near AS (SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cuts a JOIN cuts b ON a.size = b.size AND a.i = b.i AND a.less = b.less AND a.word <> b.word
  UNION ALL SELECT d.word, d.n, w.word, w.n FROM dropped d JOIN words w ON d.less = w.word
  UNION ALL SELECT w.word, w.n, d.word, d.n FROM dropped d JOIN words w ON d.less = w.word),
ranked AS (SELECT *, count(*) OVER (PARTITION BY word) AS n_near, row_number() OVER (PARTITION BY word ORDER BY other_n DESC, encode(other)) AS nth FROM near),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near, CASE WHEN other_n >= 10 * w.n THEN other END AS form,
  CASE WHEN other_n >= 10 * w.n THEN other_n END::BIGINT AS form_n FROM words w LEFT JOIN ranked r ON r.word = w.word AND nth = 1),
chain AS (SELECT word, word AS last, form AS next FROM formed
  UNION ALL SELECT c.word, c.next, f.form FROM chain c JOIN formed f ON f.word = c.next)
SELECT f.word, form, c.last AS root, n, n_near, form_n FROM formed f JOIN chain c ON c.word = f.word AND c.next IS NULL"""

# Words q apart are found as equal stretches of five words, which every run's shift holds at least.
OP12_SQL = rf"""
WITH given AS (SELECT doc_id, text, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w, {_crc32("doc_id::VARCHAR")} AS h FROM documents),
placed AS (SELECT doc_id, w, h % 10 = 0 AND len(w) > 0 AS turned, (h // 10) % greatest(len(w), 1) AS a, h // 10 AS g FROM given),
docs AS (SELECT doc_id, CASE WHEN turned THEN list_transform(range(len(w)), lambda i:
  w[CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (len(w) - a) // (3 + g % 8)) END + 1]) ELSE w END AS w FROM placed),
fives AS (SELECT doc_id, i, array_to_string(w[i + 1 : i + 5], ' ') AS five FROM (SELECT doc_id, w, unnest(range(len(w) - 4)) AS i FROM docs WHERE len(w) > 4)),
pairs AS (SELECT a.doc_id, a.i, b.i - a.i AS q FROM fives a JOIN fives b ON a.doc_id = b.doc_id AND a.five = b.five AND a.i < b.i),
islands AS (SELECT doc_id, q, min(i) AS s, count(*) + 4 + q AS size
  FROM (SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS island FROM pairs) GROUP BY doc_id, q, island),
runs AS (SELECT doc_id, s, size, min(q) AS q FROM islands GROUP BY ALL HAVING size >= greatest(6, 4 * min(q))),
gone AS (SELECT doc_id, list(DISTINCT k) AS ks FROM (SELECT doc_id, unnest(range(s + q, s + size)) AS k FROM runs) GROUP BY doc_id),
listed AS (SELECT doc_id, count(*) AS n_runs, string_agg(s || ',' || size || ',' || q || chr(10), '' ORDER BY s, q) AS listed FROM runs GROUP BY doc_id),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY size::DOUBLE / q DESC, s, q) AS nth FROM runs) WHERE nth = 1)
SELECT d.doc_id, coalesce(n_runs, 0)::BIGINT AS n_runs, s::BIGINT AS start, size::BIGINT AS length, q::BIGINT AS period, (1000 * size // q)::BIGINT AS exponent_milli,
  sha256(coalesce(listed, '')) AS runs_sha256, sha256(array_to_string(list_filter(w, lambda x, i: NOT list_contains(coalesce(ks, []), i - 1)), ' ')) AS collapsed_sha256
FROM docs d LEFT JOIN listed USING (doc_id) LEFT JOIN best USING (doc_id) LEFT JOIN gone USING (doc_id)"""

QUERIES = {
    "op1_token_output": (op1_token_output, None),
    "op2_decontamination": (op2_decontamination, OP2_SQL),
    "op3_pseudonyms": (op3_pseudonyms, None),
    "op4_suffix_arrays": (op4_suffix_arrays, OP4_SQL),
    "op5_licence_scan": (op5_licence_scan, OP5_SQL),
    "op6_source_mixing": (op6_source_mixing, None),
    "op7_language_id": (op7_language_id, None),
    "op8_substring_dedup": (op8_substring_dedup, OP8_SQL),
    "op9_simhash": (op9_simhash, None),
    "op10_embedding_dedup": (op10_embedding_dedup, OP10_SQL),
    "op11_spelling_variants": (op11_spelling_variants, OP11_SQL),
    "op12_periodic_runs": (op12_periodic_runs, OP12_SQL),
    "op13_toxicity": (op13_toxicity, None),
}
