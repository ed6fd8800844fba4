"""The thin queries of the contract, one for each operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bit_planes, block_naming, bpe, collocations, fingerprints, html_text, language_id, lattice, ngram_join, packing, secret_scan, suffix_tree_lm, treaps
from .common import Scratch, remainder, table, tune


def op1_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lattice.near_duplicates(table(spark, sf_dir, "embeddings"))


def op2_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder("doc_id", 4) == 2)
    samples = language_id.fit(docs.filter(~F.col("held_out")))
    return language_id.predict(docs.select("doc_id", "held_out", "text"), samples).drop("text")


def op4_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.compare(table(spark, sf_dir, "documents"))


def op6_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digest(bpe.round_trip(table(spark, sf_dir, "documents")))


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.digest(secret_scan.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


def op8_bit_planes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bit_planes.digest(bit_planes.read_shards(bit_planes.store(spark, table(spark, sf_dir, "documents"))))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def _tuned(f):
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        tune(spark)
        return f(spark, sf_dir)

    return run


def op10_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", (remainder("doc_id", 7) == 2).alias("held_out"), "text")
    scratch = Scratch(spark, "lm")
    return suffix_tree_lm.score(docs, *suffix_tree_lm.learn(docs.filter(~F.col("held_out")), scratch), scratch)


def op11_block_naming(spark: SparkSession, sf_dir: str) -> DataFrame:
    return block_naming.exact(table(spark, sf_dir, "documents"), Scratch(spark, "exact"))


def op12_treaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treaps.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), Scratch(spark, "treaps"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), Scratch(spark, "collocations"))


def queries() -> dict:
    return {k: _tuned(f) for k, f in globals().items() if k.startswith("op")}


#: All pairs of vectors by cosine in double precision, and what they reach.
OP1 = """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND list_dot_product(e, e) > 0),
 links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id WHERE list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
 reach(id, r) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.r = links.a), c AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id), k AS (SELECT a, count(*) AS n FROM links GROUP BY a)
 SELECT id AS vec_id, coalesce(n, 0) AS n_links, component_id, id = component_id AS kept FROM c LEFT JOIN k ON a = id"""

#: Distinct 5-word shingles of whole texts, all pairs with one in common, and what similar pairs reach.
OP2 = """WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \\t-\\r]+'), lambda x: x <> '') AS w FROM documents),
 s AS (SELECT doc_id, CASE WHEN w IS NULL OR len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM w),
 n AS (SELECT doc_id, CAST(len(s) AS BIGINT) AS n FROM s), x AS (SELECT doc_id, unnest(s) AS h FROM s), i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM x a JOIN x b ON a.h = b.h AND a.doc_id < b.doc_id GROUP BY a.doc_id, b.doc_id),
 l AS (SELECT a, b FROM i JOIN n p ON p.doc_id = a JOIN n q ON q.doc_id = b WHERE 100 * k >= 75 * (p.n + q.n - k)), links AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
 reach(id, r) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.id, links.b FROM reach JOIN links ON reach.r = links.a), c AS (SELECT id, min(r) AS component_id FROM reach GROUP BY id)
 SELECT doc_id, n AS n_shingles, component_id FROM n JOIN c ON id = doc_id"""

#: Groups of equal lowered texts; the row of the largest doc_id stays.
OP11 = """WITH t AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents), g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY t)
 SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256 FROM t JOIN g USING (t)"""

#: Terms of documents and items, weights by document frequency, and the twenty best scores of each item.
OP12 = r"""WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
 s AS (SELECT count(*) AS nn, CAST(sum(len(t)) AS BIGINT) AS ll FROM d WHERE len(t) > 0), p AS (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM d), tf AS (SELECT doc_id, n, term, count(*) AS tf FROM p GROUP BY doc_id, n, term), df AS (SELECT term, count(*) AS df FROM tf GROUP BY term),
 q AS (SELECT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark), c AS (SELECT item_id, term, count(*) AS c FROM q GROUP BY item_id, term),
 w AS (SELECT item_id, term, c * CAST(floor(1000 * ln((2 * nn + 2) / (2 * df + 1))) AS BIGINT) AS w FROM c JOIN df USING (term), s),
 r AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * nn) // ll)))) AS BIGINT) AS score FROM w JOIN tf USING (term), s GROUP BY item_id, doc_id),
 k AS (SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score FROM r WHERE score > 0) SELECT * FROM k WHERE rank <= 20"""

#: All n-grams of pieces, the lowest cut of each candidate, those within a longer one as frequent left out.
OP13 = r"""WITH d AS (SELECT coalesce(lang, 'und') AS lang, regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\n-\r]') AS p FROM documents), p AS (SELECT lang, unnest(p) AS p FROM d),
 w AS (SELECT lang, list_filter(regexp_split_to_array(p, '[ \t]+'), lambda x: x <> '') AS w FROM p), g AS (SELECT lang, w, unnest(range(1, 6)) AS n FROM w), i AS (SELECT lang, w, n, unnest(range(1, CAST(len(w) - n + 2 AS BIGINT))) AS i FROM g WHERE len(w) >= n),
 f AS (SELECT lang, n AS size, array_to_string(w[i:i + n - 1], ' ') AS phrase, count(*) AS f FROM i GROUP BY 1, 2, 3), t AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE size = 1 GROUP BY lang), c AS (SELECT lang, size, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND f >= 100),
 k AS (SELECT *, unnest(range(1, size)) AS k FROM c), x AS (SELECT k.lang, k.phrase, k.a, k.k, l.f AS l, r.f AS r, t.n, CAST((1000 * CAST(k.a AS HUGEINT) * t.n) // (CAST(l.f AS HUGEINT) * r.f) AS BIGINT) AS score
 FROM k JOIN f l ON l.lang = k.lang AND l.phrase = array_to_string(k.w[1:k.k], ' ') JOIN f r ON r.lang = k.lang AND r.phrase = array_to_string(k.w[k.k + 1:], ' ') JOIN t ON t.lang = k.lang),
 b AS (SELECT *, row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) AS nth FROM x), o AS (SELECT lang, phrase, a, l, r, n, score FROM b WHERE nth = 1 AND NOT EXISTS (SELECT 1 FROM c WHERE c.lang = b.lang AND c.a = b.a AND c.size > len(string_split(b.phrase, ' ')) AND contains(' ' || c.phrase || ' ', ' ' || b.phrase || ' '))),
 z AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score FROM o) SELECT * FROM z WHERE rank <= 2000"""


def oracle_sql() -> dict[str, str]:
    """Of the operators whose whole result SQL can express in reasonable time; the others are tested against brute force."""
    return {"op1_lattice": OP1, "op2_ngram_join": OP2, "op11_block_naming": OP11, "op12_treaps": OP12, "op13_collocations": OP13}
