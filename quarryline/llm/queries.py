"""The registered queries of this subpackage, each over its whole table with production parameters, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .chat_format import format_chats
from .common import Scratch, documents, fresh_dir
from .decontaminate import decontaminate
from .digest_cache import token_counts
from .fertility import fertility_rules
from .gam import quality_scores
from .jaccard import jaccard_components
from .license_scan import license_scan
from .packing import pack_documents
from .pseudonyms import pseudonymise
from .secret_scan import secret_report
from .suffix_dedup import remove_repeats
from .turn_repair import damaged, repair_report
from .whitening import by_component, whiten


def op1_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fertility_rules(documents(spark, sf_dir))


#: A conversation whose texts hold the template's own control strings.
HOSTILE = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


def op2_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    hostile = spark.createDataFrame(HOSTILE, "conv_id long, turn long, role string, text string")
    return format_chats(chats.unionByName(hostile)).select("conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_rewrites", "n_unlocated", "is_whole")


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(documents(spark, sf_dir), length=400)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op5_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), k=3, percent=90).select("doc_id", "n_shingles", "component_id", "class_id", "n_links")


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(documents(spark, sf_dir)).drop("spans")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With a cache of its own, empty at first: every distinct text is encoded."""
    return token_counts(documents(spark, sf_dir), f"{fresh_dir(spark, 'token-cache')}/counts")


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


#: The key of the registered query and the pipeline; a deployment sets its own.
PSEUDONYM_KEY = "demonstration key, not a secret"


def op9_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymise(documents(spark, sf_dir), PSEUDONYM_KEY)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(documents(spark, sf_dir)).drop("ids")


def op11_turn_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    chats = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    return repair_report(damaged(chats), chats)


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return by_component(whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))


def op13_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_report(documents(spark, sf_dir))


def whitening_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op12_whitening that SQL can express."""
    return op12_whitening(spark, sf_dir).select("vec_id", "component", "n", "deviation", (F.col("identity_error") < 1e-4).alias("is_identity"))


def secret_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op13_secret_scan that SQL can express."""
    return op13_secret_scan(spark, sf_dir).select("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")


def fertility_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op1_fertility that SQL can express."""
    return op1_fertility(spark, sf_dir).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")


def license_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The columns of op6_license_scan that SQL can express."""
    return op6_license_scan(spark, sf_dir).select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


def token_counts_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op7_token_counts twice on one cache: whether the second count, which is the cache's, is the first one's."""
    path = f"{fresh_dir(spark, 'token-cache')}/counts"
    first = Scratch(spark, "first-counts").save(token_counts(documents(spark, sf_dir), path))
    n = spark.read.parquet(path).count()
    second = Scratch(spark, "second-counts").save(token_counts(documents(spark, sf_dir), path))
    added = spark.read.parquet(path).count() - n
    both = second.join(first.select("doc_id", F.col("n_tokens").alias("n_before")), "doc_id")
    return both.select("doc_id", "n_bytes", (F.col("n_tokens") == F.col("n_before")).alias("same"), F.lit(added).cast("long").alias("n_added"))


_OPERATORS = (op1_fertility, op2_chat_format, op3_suffix_dedup, op4_decontamination, op5_jaccard, op6_license_scan, op7_token_counts, op8_quality, op9_pseudonyms, op10_packing, op11_turn_repair, op12_whitening, op13_secret_scan)
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (*_OPERATORS, fertility_base, license_base, token_counts_again, whitening_base, secret_base)}

_CHATS = """(SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok')"""

ORACLES: dict[str, str] = {
    "op2_chat_format": f"""SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(17 + length(regexp_replace(role, '([\\\\<>])', '\\\\\\1', 'g')) + length(regexp_replace(text, '([\\\\<>])', '\\\\\\1', 'g'))) AS BIGINT) AS formatted_chars,
  CAST(0 AS BIGINT) AS n_rewrites, CAST(0 AS BIGINT) AS n_unlocated, true AS is_whole
FROM {_CHATS} GROUP BY conv_id""",
    "fertility_base": r"""WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  windows AS (SELECT doc_id, i, w[i:i + 4] AS five FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w)),
  twice AS (SELECT doc_id, five FROM windows GROUP BY doc_id, five HAVING count(*) > 1),
  repeated AS (SELECT doc_id, count(DISTINCT i + d) AS n FROM windows JOIN twice USING (doc_id, five), range(5) AS r(d) GROUP BY doc_id),
  lines AS (SELECT doc_id, count(*) - count(DISTINCT line) AS n FROM (SELECT doc_id, unnest(string_split(t, chr(10))) AS line FROM w) WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY doc_id),
  counts AS (SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(list_sum(list_transform(w, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
    CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(coalesce(l.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(r.n, 0) AS BIGINT) AS n_repeat_words
    FROM w LEFT JOIN lines l USING (doc_id) LEFT JOIN repeated r USING (doc_id))
SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM counts""",
    "license_base": r"""WITH w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
  phrases(p, label) AS (VALUES (['gnu', 'general', 'public', 'license'], 'gpl'), (['apache', 'license'], 'apache'), (['cc', 'by'], 'cc-by'), (['mit', 'license'], 'mit')),
  found AS (SELECT doc_id, i - 1 AS place, label FROM (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM w), phrases WHERE w[i] = p[1] AND w[i:i + len(p) - 1] = p)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, count(label) AS n_base, min(place) AS first_word, max(place) AS last_word, coalesce(string_agg(DISTINCT label, ',' ORDER BY label), '') AS base_labels
FROM w LEFT JOIN found USING (doc_id) GROUP BY doc_id, len(w)""",
    "op11_turn_repair": """WITH RECURSIVE codes AS (SELECT list_transform(range(256), lambda i: list_reduce(list_concat([CAST(i AS BIGINT)], CAST(range(8) AS BIGINT[])), lambda c, x: xor(c >> 1, CASE WHEN c & 1 = 1 THEN 3988292384 ELSE 0 END))) AS table_of),
  given AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS tag FROM conversations),
  told AS (SELECT *, xor(list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(range(1, length(tag) + 1), lambda i: CAST(ascii(tag[i]) AS BIGINT))), lambda c, b: xor(c >> 8, table_of[(xor(c, b) & 255) + 1])), 4294967295) % 20 AS what FROM given, codes),
  turns AS (SELECT conv_id, turn, CASE WHEN what = 4 THEN 'user' ELSE role END AS role, CASE WHEN what = 1 THEN '' WHEN what = 2 THEN translate(text, '.!?', '') ELSE text END AS text, copy FROM told, range(2) AS r(copy) WHERE what <> 0 AND (copy = 0 OR what = 3)),
  numbered AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, sha256(text), copy) AS k, rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS said FROM turns),
  judged AS (SELECT *, role[1] AS i, CASE WHEN said = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY k) > 1 THEN 'duplicate' WHEN right(said, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault, lag(role[1]) OVER (PARTITION BY conv_id ORDER BY k) AS before FROM numbered),
  walk AS (
    SELECT conv_id, CAST(0 AS BIGINT) AS k, {'c': 0, 'a': '', 's': ''} AS v0, {'c': 9999999999, 'a': '', 's': ''} AS v1, {'c': 5, 'a': 'I', 's': 'user:'} AS v2, {'c': 10, 'a': 'II', 's': 'user:' || chr(10) || 'assistant:'} AS v3 FROM (SELECT DISTINCT conv_id FROM conversations)
    UNION ALL
    SELECT conv_id, k, n0, n1,
      least(n2, {'c': n0.c + 5, 'a': n0.a || 'I', 's': n0.s || CASE WHEN n0.s = '' THEN '' ELSE chr(10) END || 'user:'}, {'c': n1.c + 5, 'a': n1.a || 'I', 's': n1.s || chr(10) || 'user:'}, {'c': n3.c + 5, 'a': n3.a || 'I', 's': n3.s || chr(10) || 'user:'}),
      least(n3, {'c': n2.c + 5, 'a': n2.a || 'I', 's': n2.s || chr(10) || 'assistant:'}, {'c': n0.c + 10, 'a': n0.a || 'II', 's': n0.s || CASE WHEN n0.s = '' THEN '' ELSE chr(10) END || 'user:' || chr(10) || 'assistant:'}, {'c': n1.c + 10, 'a': n1.a || 'II', 's': n1.s || chr(10) || 'user:' || chr(10) || 'assistant:'})
    FROM (SELECT conv_id, k,
      {'c': v0.c + 2, 'a': v0.a || 'D', 's': v0.s} AS n0,
      least({'c': v1.c + 2, 'a': v1.a || 'D', 's': v1.s}, {'c': v0.c + CASE WHEN i = 's' THEN stay ELSE 9999999999 END, 'a': v0.a || 'K', 's': role || ':' || text}) AS n1,
      least({'c': v2.c + 2, 'a': v2.a || 'D', 's': v2.s}, {'c': v0.c + as_user, 'a': v0.a || ku, 's': v0.s || CASE WHEN v0.s = '' THEN '' ELSE chr(10) END || user_said}, {'c': v1.c + as_user, 'a': v1.a || ku, 's': v1.s || chr(10) || user_said}, {'c': v3.c + as_user, 'a': v3.a || ku, 's': v3.s || chr(10) || user_said}) AS n2,
      least({'c': v3.c + 2, 'a': v3.a || 'D', 's': v3.s}, {'c': v2.c + as_assistant, 'a': v2.a || ka, 's': v2.s || chr(10) || assistant_said}) AS n3
    FROM (SELECT j.*, v0, v1, v2, v3, CASE WHEN fault IN ('blank', 'duplicate') THEN 9999999999 WHEN fault = 'truncated' THEN 5 ELSE 0 END AS stay, stay + CASE WHEN i = 'u' THEN 0 ELSE 1 END AS as_user, stay + CASE WHEN i = 'a' THEN 0 ELSE 1 END AS as_assistant,
        CASE WHEN i = 'u' THEN 'K' ELSE 'R' END AS ku, CASE WHEN i = 'a' THEN 'K' ELSE 'R' END AS ka, CASE WHEN i = 'u' THEN role ELSE 'user' END || ':' || text AS user_said, CASE WHEN i = 'a' THEN role ELSE 'assistant' END || ':' || text AS assistant_said
      FROM walk JOIN judged j ON j.conv_id IS NOT DISTINCT FROM walk.conv_id AND j.k = walk.k + 1))),
  ends AS (SELECT conv_id, least(v0, v3) AS best FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY k DESC) AS last FROM walk) WHERE last = 1),
  counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (k > 1 AND before || i NOT IN ('su', 'ua', 'au')) AS illegal FROM judged GROUP BY conv_id)
SELECT e.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(best.c AS BIGINT) AS cost, best.a AS audit, sha256(best.s) AS repaired_sha256
FROM ends e LEFT JOIN counts c ON e.conv_id IS NOT DISTINCT FROM c.conv_id""",
    "whitening_base": """WITH v AS (SELECT vec_id, list_transform(embedding, lambda c: CAST(floor(1024 * CAST(c AS DOUBLE)) AS BIGINT) + 100000) AS x FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
  entries AS (SELECT unnest(range(len(x))) AS d, unnest(x) AS e FROM v),
  sums AS (SELECT list(s ORDER BY d) AS s FROM (SELECT d, CAST(sum(e) AS BIGINT) AS s FROM entries GROUP BY d)),
  n AS (SELECT count(*) AS n FROM v)
SELECT vec_id, CAST(c AS INTEGER) AS component, n, CAST(list_sum(list_transform(x, lambda e, i: (n * e - s[i]) * (n * e - s[i]))) AS BIGINT) AS deviation, true AS is_identity FROM v, sums, n, range(1, 9) AS r(c)""",
    "secret_base": r"""WITH t AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
  kinds(k, kind, re, least, g) AS (VALUES (0, 'assign', '([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)', 8, 2), (1, 'access', '(AKIA[A-Z0-9]{12,})', 16, 1), (2, 'hex', '([0-9a-f]{32,})', 32, 1)),
  matches AS (SELECT doc_id, k, kind, least, regexp_extract_all(t, re) AS m, regexp_extract_all(t, re, g) AS v, list_transform(string_split_regex(t, re), lambda x: length(x)) AS between FROM t, kinds),
  places AS (SELECT doc_id, k, kind, list_transform(m, lambda x, i: list_sum(between[:i]) + coalesce(list_sum(list_transform(m[:i - 1], lambda y: length(y))), 0)) AS low, list_transform(m, lambda x: length(x)) AS size, list_transform(v, lambda x: length(x) >= least) AS ok FROM matches),
  spans AS (SELECT doc_id, k, kind, unnest(low) AS low, unnest(size) AS size, unnest(ok) AS ok FROM places)
SELECT doc_id, count(*) FILTER (ok AND k = 0) AS n_assign, count(*) FILTER (ok AND k = 1) AS n_access, count(*) FILTER (ok AND k = 2) AS n_hex,
  sha256(coalesce(string_agg(kind || ':' || CAST(low AS BIGINT) || ':' || CAST(low + size AS BIGINT), ',' ORDER BY low, k) FILTER (ok), '')) AS base_sha256
FROM t LEFT JOIN spans USING (doc_id) GROUP BY doc_id""",
    "token_counts_again": "SELECT doc_id, CAST(octet_length(encode(coalesce(text, ''))) AS BIGINT) AS n_bytes, true AS same, CAST(0 AS BIGINT) AS n_added FROM documents",
    "op3_suffix_dedup": """WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
  windows AS (SELECT doc_id, i, hash(substr(h, 2 * i + 1, 800)) AS k FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 399)) AS i FROM d)),
  twice AS (SELECT k FROM windows GROUP BY k HAVING count(*) > 1),
  hits AS (SELECT doc_id, i, CAST(coalesce(i > 400 + lag(i) OVER (PARTITION BY doc_id ORDER BY i), true) AS INT) AS new FROM windows SEMI JOIN twice USING (k)),
  runs AS (SELECT doc_id, min(i) AS low, max(i) + 400 AS high FROM (SELECT doc_id, i, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM hits) GROUP BY doc_id, run),
  gaps AS (SELECT doc_id, low, high, coalesce(lag(high) OVER (PARTITION BY doc_id ORDER BY low), 0) AS since FROM runs),
  cut AS (SELECT doc_id, count(*) AS n_spans, CAST(sum(high - low) AS BIGINT) AS n_removed, max(high) AS last, string_agg(substr(h, 2 * since + 1, 2 * (low - since)), '' ORDER BY low) AS head FROM gaps JOIN d USING (doc_id) GROUP BY doc_id)
SELECT doc_id, CAST(length(h) // 2 AS BIGINT) AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(head, '') || substr(h, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN cut USING (doc_id)""",
    "op5_jaccard": r"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
  sets AS (SELECT doc_id, list_sort(list_distinct(CASE WHEN len(w) >= 3 THEN list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END)) AS s FROM w),
  known AS (SELECT doc_id, len(s) AS n, CASE WHEN len(s) > 0 THEN min(doc_id) OVER (PARTITION BY s) ELSE doc_id END AS class_id FROM sets),
  tokens AS (SELECT class_id AS c, n, unnest(s) AS t FROM known JOIN sets USING (doc_id) WHERE class_id = doc_id),
  pairs AS (SELECT a.c AS a, b.c AS b FROM tokens a JOIN tokens b ON a.t = b.t AND a.c < b.c AND 100 * a.n >= 90 * b.n AND 100 * b.n >= 90 * a.n GROUP BY a.c, b.c, a.n, b.n HAVING 100 * count(*) >= 90 * (a.n + b.n - count(*))),
  links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
  reach AS (SELECT a AS c, a AS r FROM links UNION SELECT reach.c, links.b FROM reach JOIN links ON reach.r = links.a),
  ends AS (SELECT c, min(r) AS component FROM reach GROUP BY c),
  counts AS (SELECT a AS c, count(*) AS n_links FROM links GROUP BY a)
SELECT doc_id, CAST(n AS BIGINT) AS n_shingles, coalesce(component, class_id) AS component_id, class_id, coalesce(n_links, 0) AS n_links
FROM known LEFT JOIN ends ON class_id = ends.c LEFT JOIN counts ON class_id = counts.c""",
}
