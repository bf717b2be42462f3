"""The registered queries of the corpus operators: each over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def held_out(doc_id: str = "doc_id"):
    """Documents that language ID does not learn from: crc32 of the id's text leaves 2 on division by 4."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import classify, fit

    docs = _read(spark, sf_dir, "documents").withColumn("held_out", held_out())
    model = fit(docs.where(~F.col("held_out")))
    return classify(docs.select("doc_id", "text", "held_out"), model).drop("text")


def op2_mcd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import quality

    return quality(_read(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import decontaminate

    return decontaminate(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark")).drop("items")


def op4_bagminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bagminhash import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents"))


def op5_license_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .licenses import scan

    got = scan(_read(spark, sf_dir, "documents"))
    return got.select("doc_id", "n_sentences", F.array_join("sentence_ids", ",").alias("sentence_ids"), F.array_join("licenses", ",").alias("licenses"), "n_licenses")


def op6_page_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pages import extract

    return extract(_read(spark, sf_dir, "pages"))


def op7_curve_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack

    return pack(_read(spark, sf_dir, "documents"))


def op8_feistel_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .pii import pseudonymise, session_key

    docs = _read(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymise(docs, session_key(spark), counts=True)


def op9_wavelet_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .wavelet import wavelet_tokens

    return wavelet_tokens(_read(spark, sf_dir, "documents"))


def op10_repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffixes import remove_repeats

    return remove_repeats(_read(spark, sf_dir, "documents"))


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .negatives import mine

    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    got = mine(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, shifted)
    return got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .multiindex import near_duplicates

    return near_duplicates(_read(spark, sf_dir, "documents"))


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .trie import rebuilt, trie

    got = trie(rebuilt(_read(spark, sf_dir, "conversations")))
    return got.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_language_id, op2_mcd_quality, op3_decontamination, op4_bagminhash, op5_license_rules, op6_page_text, op7_curve_packing, op8_feistel_pii, op9_wavelet_tokens, op10_repeated_passages, op11_hard_negatives, op12_simhash, op13_prefix_trie, pipeline)}
def _words(column: str) -> str:
    up = "".join(map(chr, range(65, 91)))
    return rf"regexp_extract_all(translate(coalesce({column}, ''), '{up}', '{up.lower()}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _license_sql() -> str:
    """The scan in SQL, from the same fixed table and rules."""
    from .licenses import RULES, SENTENCES, longer, plain

    known = ", ".join(f"('{plain(v)}', '{k}')" for k, v in SENTENCES.items())
    stands = [f"regexp_matches(j, '{'([|].*)?'.join(f'[|]{i}' for i in ids)}[|]')" for _, ids in RULES]
    rules = ", ".join(f"CASE WHEN {' AND NOT '.join([own, *(stands[j] for j in above)])} THEN '{name}' END" for (name, _), own, above in zip(RULES, stands, longer(RULES)))
    cut = r"regexp_split_to_array(regexp_replace(coalesce(text, ''), '([.!?])\s+', '\1' || chr(10), 'g'), '[;:]?\s*\n\s*')"
    norm = r"trim(regexp_replace(lower(s), '[^\pL\pN+]+', ' ', 'g'))"
    return f"""WITH known(sentence, id) AS (VALUES {known}),
d AS (SELECT doc_id, list_filter(list_transform({cut}, lambda s: {norm}), lambda s: s <> '') AS s FROM documents),
e AS (SELECT doc_id, unnest(s) AS sentence, generate_subscripts(s, 1) AS pos FROM d),
i AS (SELECT doc_id, string_agg(id, '|' ORDER BY pos) AS ids FROM e JOIN known USING (sentence) GROUP BY doc_id),
j AS (SELECT d.doc_id, len(s) AS n_sentences, coalesce(ids, '') AS ids, '|' || coalesce(ids, '') || '|' AS j FROM d LEFT JOIN i USING (doc_id)),
l AS (SELECT doc_id, n_sentences, ids, list_filter([{rules}], lambda x: x IS NOT NULL) AS l FROM j),
u AS (SELECT doc_id, n_sentences, ids, list_filter(l, lambda x, k: list_position(l, x) = k) AS l FROM l)
SELECT doc_id, n_sentences, replace(ids, '|', ',') AS sentence_ids, coalesce(array_to_string(l, ','), '') AS licenses, CAST(len(l) AS BIGINT) AS n_licenses FROM u"""


def _trie_sql() -> str:
    """Prefixes as lists; crc32 bit by bit."""
    bits = "flatten(list_transform(range(1, len(s) + 1), lambda i: [CAST(ascii(s[i]) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    crc = f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {bits}), lambda a, e: xor(xor(a, e) >> 1, (xor(a, e) & 1) * 3988292384)), 4294967295)"
    return f"""WITH t AS (SELECT conv_id AS c, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS t, turn FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list(t ORDER BY turn NULLS FIRST, t.role, t.text) AS ts FROM t GROUP BY c), h AS (SELECT c, ts, {crc} % 6 AS h FROM (SELECT *, CAST(c AS VARCHAR) AS s FROM o)),
r AS (SELECT h.c, list_concat(coalesce(b.ts[1:h.h], []), h.ts[h.h + 1:]) AS ts FROM h LEFT JOIN o b ON b.c = h.c - h.c % 100),
p AS (SELECT c, unnest(range(len(ts) + 1)) AS depth, ts FROM r), q AS (SELECT c, depth, ts[1:depth] AS k, len(ts) = depth AS at_end FROM p),
n AS (SELECT depth, k, min(c) AS conv_id, count(*) AS n_convs, coalesce(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c) FILTER (at_end), '') AS ends FROM q GROUP BY depth, k),
x AS (SELECT n.*, coalesce(len(k[depth].text), 0) * (n_convs - 1) AS own FROM n),
ch AS (SELECT k[1:depth - 1] AS k, depth - 1 AS depth, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY ALL), y AS (SELECT x.*, coalesce(n_children, 0) AS n_children FROM x LEFT JOIN ch USING (k, depth)),
a AS (SELECT unnest(range(depth + 1)) AS top, y.* FROM y), s AS (SELECT top AS depth, k[1:top] AS k, sum(own) AS saved, count(*) FILTER (n_children = 0) AS n_leaves FROM a GROUP BY ALL)
SELECT y.conv_id, y.depth, u.conv_id AS parent_conv_id, y.n_convs, y.n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens, sha256(y.ends) AS ends_sha256
FROM y JOIN s USING (depth, k) LEFT JOIN y u ON u.depth = y.depth - 1 AND u.k = y.k[1:y.depth - 1]"""


#: The other operators have no SQL: their tests hold them against brute force, round trips or held-out accuracy.
ORACLE_SQL: dict[str, str] = {
    "op3_decontamination": f"""WITH d AS (SELECT doc_id, {_words("text")} AS w FROM documents), b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_words("text")} AS w FROM benchmark WHERE item_id IS NOT NULL),
v AS (SELECT item, w, least(10, len(w)) AS n FROM b WHERE len(w) > 0), win AS (SELECT item, n, array_to_string(w[s : s + n - 1], ' ') AS k FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM v)),
lens AS (SELECT DISTINCT n FROM win), dw AS (SELECT doc_id, n, s, array_to_string(w[s : s + n - 1], ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, lens WHERE len(w) >= n)),
hit AS (SELECT DISTINCT doc_id, s, dw.n, item FROM dw JOIN win ON dw.k = win.k AND dw.n = win.n),
p AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hit) GROUP BY doc_id),
i AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated FROM d LEFT JOIN p USING (doc_id) LEFT JOIN i USING (doc_id)""",
    "op5_license_rules": _license_sql(),
    "op11_hard_negatives": """WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v FROM embeddings
WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score FROM e a JOIN e b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
p AS (SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5),
n AS (SELECT p.anchor_id, positive_id, positive_score, id AS negative_id, score AS negative_score, row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY score DESC, id) AS rank
FROM p JOIN s ON p.anchor_id = s.anchor_id AND NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM n WHERE rank <= 3""",
    "op13_prefix_trie": _trie_sql(),
}
