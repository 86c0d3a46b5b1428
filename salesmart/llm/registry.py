"""The queries of this subpackage and their reference SQL.

A query is a thin call of an operator with its production parameters over the
whole table; ``SQL`` has the statements for those that DuckDB can express.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    best_fit_packing,
    decontamination,
    embedding_dedup,
    embedding_whitening,
    exact_dedup,
    html_extraction,
    language_id,
    merkle_manifest,
    simhash_dedup,
    source_mixing,
    substring_dedup,
    token_counts,
    toxicity,
)
from .common import held_out, staged, table

WORD_VOCABULARY = "word_bpe_49k.json"
BYTE_VOCABULARY = "byte_bpe_50k.json"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select(*columns)


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(documents(spark, sf_dir, "doc_id", "text"))


OP1_SQL = r"""
WITH keyed AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM keyed
WINDOW w AS (PARTITION BY text_sha256 ORDER BY n DESC, doc_id)
"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(
        documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "labels").select("doc_id", "toxic")
    )


def op3_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.embedding_dedup(table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))


def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(documents(spark, sf_dir, "doc_id", "text"))


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path(WORD_VOCABULARY)
    )


def op6_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return html_extraction.extract_pages(pages, "page_id", "html", "url").select("page_id", "url", "text", "n_chars")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(documents(spark, sf_dir, "doc_id", "text"))


def packed(docs: DataFrame) -> DataFrame:
    parts = staged(best_fit_packing.pieces(docs, public_tokenizers.path(BYTE_VOCABULARY)), "pieces")
    return best_fit_packing.pack(parts).withColumnRenamed("id", "doc_id")


#: Fixed values of the production mix: domains are groups of sources.
MIX = source_mixing.Mix(
    weights={
        "domain": {"crawl": 2, "reference": 4, "community": 3},
        "lang": {"en": 4, "de": 2, "fr": 2, "es": 2},
    }
)


def domain_of(source: Column) -> Column:
    """The tables name no domain: src0 is the crawl, src1 to src9 are reference, others community."""
    return (
        F.when(source == "src0", "crawl").when(source.rlike("^src[1-9]$"), "reference").otherwise("community")
    )


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang", "source")
    mixed, (domain, tokens, quota, copies) = source_mixing.mix_sources(docs, domain_of(F.col("source")), MIX)
    return mixed.select(
        "doc_id",
        F.col(domain).alias("domain"),
        "lang",
        "source",
        F.col(tokens).alias("n_tokens"),
        F.col(quota).alias("leaf_quota"),
        F.col(copies).alias("copies"),
    )


def _level_sql(level: str, parents: list[str], source: str, budget: str) -> str:
    """One level of the tree in SQL; ``source`` has path, cap, weight and the parent's budget."""
    by = "PARTITION BY " + ", ".join(parents) if parents else ""
    path = ", ".join([*parents, level])
    return f"""
{level}_in AS ({source}),
{level}_left AS (
  SELECT *, {budget} - coalesce(sum(cap) OVER (t ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS remaining,
         sum(weight) OVER (t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
         row_number() OVER t AS place
  FROM {level}_in WINDOW t AS ({by} ORDER BY cap::DOUBLE / weight, {level})
),
{level}_rate AS (
  SELECT *, first_value(CASE WHEN cap * open_weight >= weight * remaining THEN place END IGNORE NULLS) OVER o AS from_place,
         first_value(CASE WHEN cap * open_weight >= weight * remaining THEN remaining END IGNORE NULLS) OVER o AS num,
         first_value(CASE WHEN cap * open_weight >= weight * remaining THEN open_weight END IGNORE NULLS) OVER o AS den
  FROM {level}_left
  WINDOW o AS ({by} ORDER BY place ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
),
{level}_out AS (
  SELECT {path}, CASE WHEN place >= from_place THEN weight * num // den ELSE cap END AS budget FROM {level}_rate
)"""


def _op8_sql() -> str:
    def weight(level: str) -> str:
        cases = "".join(f" WHEN '{k}' THEN {w}" for k, w in MIX.weights.get(level, {}).items())
        return f"CASE {level}{cases} ELSE {MIX.default} END" if cases else str(MIX.default)

    levels = [
        _level_sql(
            "domain", [], f"SELECT domain, sum(cap) AS cap, {weight('domain')} AS weight FROM leaf GROUP BY domain",
            f"least((SELECT sum(n) FROM d) * {MIX.percent} // 100, (SELECT sum(cap) FROM leaf))",
        ),
        _level_sql(
            "lang", ["domain"],
            f"SELECT l.domain, lang, sum(cap) AS cap, {weight('lang')} AS weight, any_value(budget) AS budget "
            "FROM leaf l JOIN domain_out USING (domain) GROUP BY l.domain, lang",
            "budget",
        ),
        _level_sql(
            "source", ["domain", "lang"],
            f"SELECT l.domain, l.lang, source, cap, {weight('source')} AS weight, budget "
            "FROM leaf l JOIN lang_out USING (domain, lang)",
            "budget",
        ),
    ]
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source, lang AS l0, source AS s0,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS n,
         CASE WHEN source = 'src0' THEN 'crawl' WHEN regexp_matches(source, '^src[1-9]$') THEN 'reference'
              ELSE 'community' END AS domain
  FROM documents
),
leaf AS (
  SELECT domain, lang, source, sum(n) AS have, sum(n) * {MIX.max_epochs} AS cap
  FROM d GROUP BY ALL HAVING sum(n) > 0
),{",".join(levels)},
quota AS (
  SELECT domain, lang, source, have, budget AS quota, budget // have AS epochs, budget % have AS extra
  FROM source_out JOIN leaf USING (domain, lang, source)
),
turned AS (
  SELECT d.*, q.quota, q.epochs, q.extra,
         sum(n) OVER (PARTITION BY domain, lang, source
                      ORDER BY md5('{MIX.seed}:' || epochs::VARCHAR || ':' || doc_id::VARCHAR), doc_id, n
                      ROWS UNBOUNDED PRECEDING) AS upto
  FROM d LEFT JOIN quota q USING (domain, lang, source)
)
SELECT doc_id, domain, l0 AS lang, s0 AS source, n AS n_tokens, coalesce(quota, 0)::BIGINT AS leaf_quota,
       CASE WHEN n > 0 AND quota IS NOT NULL THEN epochs + (upto <= extra)::INT ELSE 0 END::BIGINT AS copies
FROM turned
"""


def op9_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_dedup.simhash_dedup(documents(spark, sf_dir, "doc_id", "text"), width=3, reach=2)
    return found.select("doc_id", simhash_dedup.hex_digits(F.col("fp")).alias("fingerprint"), "component_id")


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    found = language_id.language_mixture(
        language_id.train(docs.where(~held_out(F.col("doc_id")))), F.col("text"), spark
    )
    return (
        docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), found.alias("found"))
        .select("doc_id", "held_out", F.col("found.lang").alias("lang_pred"), F.col("found.score").alias("score"),
                F.col("found.langs").alias("langs"), F.col("found.shares").alias("shares"))
    )


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_whitening.embedding_whitening(table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))


def op12_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontamination(
        documents(spark, sf_dir, "doc_id", "text"), table(spark, sf_dir, "benchmark").select("item_id", "text")
    )


UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The manifest; where 5 divides the crc32 of the id, a text with lower-cased A-Z is claimed."""
    return merkle_manifest.merkle_manifest(
        documents(spark, sf_dir, "doc_id", "source", "lang", "n_chars", "text"),
        claims={"text": F.translate(F.col("text"), UPPER, LOWER)},
        claimed=held_out(F.col("doc_id")),
    )


def _op13_sql(below: int, above: int) -> str:
    """The manifest with ``below`` levels in a source and ``above`` levels over them; a level of one node keeps it."""
    def one(c: str) -> str:
        return f"coalesce(strlen({c}::VARCHAR) || ':' || {c}::VARCHAR, '-')"

    def leaf(text: str) -> str:
        return f"sha256({' || '.join([*map(one, ('doc_id', 'source', 'lang', 'n_chars')), one(text)])})"

    # the bits of a CRC, one by one
    bit = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    crc = (
        "xor(list_reduce(list_transform(string_split(doc_id::VARCHAR, ''), lambda s: ascii(s)::BIGINT), "
        f"lambda a, b: list_reduce(range(8), lambda c, i: {bit}, xor(a, b)), 4294967295), 4294967295)"
    )
    ctes = [
        f"""rows_ AS (
  SELECT doc_id, source, {leaf('text')} AS leaf,
         CASE WHEN {crc} % 5 = 0 THEN {leaf(f"translate(text, '{UPPER}', '{LOWER}')")} END AS claimed
  FROM documents
)""",
        """ranked AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place,
         dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS tree, count(*) OVER (PARTITION BY source) AS nodes
  FROM rows_
)""",
        "n0 AS (SELECT tree, place AS node, nodes, leaf AS h FROM ranked)",
    ]
    for level in range(below + above):
        if level == below:
            ctes.append(f"n{level} AS (SELECT 0 AS tree, tree AS node, count(*) OVER () AS nodes, h FROM up{level})")
        # what stands before and after a node in its run
        ctes.append(
            f"""s{level} AS (
  SELECT *, node // 16 AS parent,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
         coalesce(string_agg(h, '') OVER (w ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
  FROM n{level} WINDOW w AS (PARTITION BY tree, node // 16 ORDER BY node)
)"""
        )
        ctes.append(
            f"""{'up' if level + 1 == below else 'n'}{level + 1} AS (
  SELECT tree, parent AS node, (nodes + 15) // 16 AS nodes, CASE WHEN nodes > 1 THEN sha256(string_agg(h, '' ORDER BY node)) ELSE any_value(h) END AS h
  FROM s{level} GROUP BY tree, parent, nodes
)"""
        )
    ctes.append("f0 AS (SELECT doc_id, leaf, tree, tree AS source_rank, place, coalesce(claimed, leaf) AS d, '' AS proof, leaf AS own FROM ranked)")
    for level in range(below + above):
        if level == below:
            key, turned = "0", "f.source_rank"
        elif level > below:
            key, turned = "0", "f.place"
        else:
            key, turned = "f.tree", "f.place"
        ctes.append(
            f"""f{level + 1} AS (
  SELECT doc_id, leaf, f.tree, source_rank, {turned} // 16 AS place,
         CASE WHEN nodes > 1 THEN sha256(l || d || r) ELSE d END AS d,
         CASE WHEN nodes > 1 THEN proof || l || r ELSE proof END AS proof
  FROM f{level} f JOIN s{level} s ON s.tree = {key} AND s.node = {turned}
)"""
        )
    last = below + above
    return f"""WITH {', '.join(ctes)}
SELECT doc_id, leaf, u.h AS subroot, n.h AS root, sha256(proof) AS proof_sha256, d AS folded_root, d = n.h AS verified
FROM f{last} f JOIN up{below} u ON u.tree = f.source_rank JOIN n{last} n ON true"""


OP12_SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS r, doc_id,
         regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
),
items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS m, list_slice(w, i, i + least(len(w), 10) - 1) AS ws
  FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)
),
places AS (
  SELECT r, i, m, list_slice(w, i, i + m - 1) AS ws
  FROM (SELECT r, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM docs, (SELECT DISTINCT m FROM windows) WHERE len(w) >= m)
),
hits AS (SELECT r, i, p.m, item_id FROM places p JOIN windows v ON v.m = p.m AND v.ws = p.ws),
words AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(i, i + m)) AS word_at FROM hits) GROUP BY r),
named AS (
  SELECT r, count(*) AS n_items, string_agg(item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
  FROM (SELECT DISTINCT r, item_id FROM hits WHERE item_id IS NOT NULL) GROUP BY r
)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN words USING (r) LEFT JOIN named USING (r)
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_exact_dedup,
        op2_toxicity,
        op3_embedding_near_dedup,
        op4_substring_dedup,
        op5_token_counts,
        op6_html_extraction,
        op7_best_fit_packing,
        op8_source_mixing,
        op9_simhash_near_dedup,
        op10_language_id,
        op11_embedding_whitening,
        op12_benchmark_decontamination,
        op13_merkle_manifest,
    )
}

SQL: dict[str, str] = {
    "op1_exact_dedup": OP1_SQL,
    "op8_source_mixing": _op8_sql(),
    "op12_benchmark_decontamination": OP12_SQL,
    "op13_merkle_manifest": _op13_sql(below=6, above=3),
}
