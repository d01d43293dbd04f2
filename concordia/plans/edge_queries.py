"""Edges between vocabularies."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import code_index, graph
from ..operators import edges as E
from ..session import shared_folder
from .registry import query, read

# Test vocabularies: parts and suppliers as concepts, order lines as relationships between them.
_VOCAB = """
coded AS (
  SELECT p_partkey AS id, p_brand || '-' || p_partkey AS code, p_brand AS vocab, CASE WHEN p_size % 3 = 1 THEN 'S' WHEN p_size % 3 = 0 THEN 'C' END AS mark FROM part
  UNION ALL
  SELECT s_suppkey + 10000000, 's' || s_suppkey, 'SUPP', CASE WHEN s_nationkey % 4 <> 0 THEN 'S' END FROM supplier WHERE s_suppkey % 9 <> 0),
live AS (SELECT l_partkey AS id, l_suppkey + 10000000 AS target_id FROM lineitem WHERE l_returnflag = 'R' AND l_quantity <= 40),
goal AS (SELECT id AS target_id, vocab AS target_vocab, code AS target_code FROM coded WHERE mark = 'S')"""


def _mapped(loose: str) -> str:
    """Live relationships from concepts with a loose mark to standard ones: each side is narrowed first."""
    return f"""
WITH {_VOCAB}, loose AS (SELECT id, code AS src_code, vocab AS src_vocab FROM coded WHERE {loose})
SELECT 'OMOP' AS src_authority, src_code, src_vocab, target_vocab, target_code, target_id AS target_concept_id, 'omop_maps_to' AS evidence
FROM live INNER JOIN loose USING (id) INNER JOIN goal USING (target_id)"""


_STRICT, _COMPAT = _mapped("coalesce(mark, '-') NOT IN ('S')"), _mapped("mark NOT IN ('S')")


def _maps(spark, sf_dir, mode):
    p, s, l = read(spark, sf_dir, "part", "supplier", "lineitem")
    size = F.col("p_size") % 3
    a = p.select(F.col("p_partkey").alias("concept_id"), F.concat("p_brand", F.lit("-"), "p_partkey").alias("concept_code"), F.col("p_brand").alias("vocabulary_id"), F.when(size == 0, "C").when(size == 1, "S").alias("standard_concept"))
    b = s.select((F.col("s_suppkey") + 10000000).alias("concept_id"), F.when(F.col("s_suppkey") % 9 != 0, F.concat(F.lit("s"), "s_suppkey")).alias("concept_code"), F.lit("SUPP").alias("vocabulary_id"), F.when(F.col("s_nationkey") % 4 != 0, "S").alias("standard_concept"))
    q = F.col("l_quantity")
    rel = l.select(F.col("l_partkey").alias("concept_id_1"), (F.col("l_suppkey") + 10000000).alias("concept_id_2"), F.when(F.col("l_returnflag") == "R", "Maps to").otherwise("Is a").alias("relationship_id"), F.when(q > 40, "D").when(q > 20, "").alias("invalid_reason"))
    return E.maps_to_edges(rel, a.unionByName(b), mode)


@query(_STRICT)
def maps_to_edges(spark, sf_dir):
    return _maps(spark, sf_dir, "strict")


@query(_COMPAT)
def maps_to_edges_compat(spark, sf_dir):
    return _maps(spark, sf_dir, "compat")


_CODES = f"SELECT target_concept_id, string_agg(DISTINCT src_vocab || ':' || src_code, '|' ORDER BY src_vocab || ':' || src_code) AS codes, count(DISTINCT src_vocab || ':' || src_code) AS n FROM ({_STRICT}) GROUP BY target_concept_id"


def _written(codes):
    return F.array_join(F.array_sort(F.transform(codes, lambda x: F.concat_ws(":", x["vocabulary"], x["code"]))), "|")


@query(_CODES)
def alternate_codes(spark, sf_dir):
    codes = E.alternate_codes(_maps(spark, sf_dir, "strict"))
    return codes.select("target_concept_id", _written(F.col("alternate_codes")).alias("codes"), F.size("alternate_codes").cast("long").alias("n"))


def _attached(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey"), (F.col("s_suppkey") + 10000000).alias("canonical_concept_id"))
    return E.attach_alternate_codes(s, E.alternate_codes(_maps(spark, sf_dir, "strict")))


@query(f"SELECT s_suppkey, coalesce(codes, '') AS codes, coalesce(n, 0) AS n FROM supplier LEFT JOIN ({_CODES}) ON s_suppkey + 10000000 = target_concept_id")
def attach_codes(spark, sf_dir):
    return _attached(spark, sf_dir).select("s_suppkey", _written(F.col("alternate_codes")).alias("codes"), F.size("alternate_codes").cast("long").alias("n"))


@query(f"SELECT count(*) FILTER (n > 0) AS with_codes, count(*) AS total FROM (SELECT coalesce(n, 0) AS n FROM supplier LEFT JOIN ({_CODES}) ON s_suppkey + 10000000 = target_concept_id)")
def with_alternates(spark, sf_dir):
    return _attached(spark, sf_dir).agg(F.count_if(F.size("alternate_codes") > 0).alias("with_codes"), F.count(F.lit(1)).alias("total"))


@query(f"SELECT DISTINCT target_concept_id - 10000000 AS s_suppkey FROM ({_STRICT}) WHERE src_vocab = 'Brand#11'")
def code_containment(spark, sf_dir):
    return _attached(spark, sf_dir).filter(E.holds_code("alternate_codes", "Brand#11")).select("s_suppkey")


@query(f"SELECT DISTINCT target_concept_id - 10000000 AS s_suppkey, src_code AS code FROM ({_STRICT}) WHERE src_vocab = 'Brand#11'")
def code_lookup(spark, sf_dir):
    """As code_containment, by an index of codes to which half of the elements were added later."""
    s = _attached(spark, sf_dir)
    path = f"{shared_folder(spark)}/concordia/codes-{uuid.uuid4().hex}"
    code_index.write(s.filter("s_suppkey % 2 = 0"), path, "s_suppkey")
    code_index.append(s, path, "s_suppkey")
    return code_index.lookup(spark, path, "Brand#11").withColumnRenamed("key", "s_suppkey")


@query(f"SELECT DISTINCT target_concept_id - 10000000 AS s_suppkey, src_vocab AS vocabulary, src_code AS code FROM ({_STRICT})")
def code_explode(spark, sf_dir):
    return _attached(spark, sf_dir).select("s_suppkey", F.inline("alternate_codes"))


@query("SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 1 ELSE 0 END + CASE WHEN s_suppkey % 3 = 0 THEN 1 ELSE 0 END AS n FROM supplier")
def build_codes(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").withColumn("a", F.when(F.col("s_suppkey") % 2 == 0, "x")).withColumn("b", F.when(F.col("s_suppkey") % 3 == 0, "y").otherwise(""))
    return s.select("s_suppkey", F.size(E.build_codes(("s_name", "a"), ("s_name", "b"))).alias("n"))


@query("SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'O') != 'F'")
def null_not_equal_compat(spark, sf_dir):
    return read(spark, sf_dir, "orders").filter(F.nullif(F.col("o_orderstatus"), F.lit("O")) != "F").select("o_orderkey")


@query("SELECT o_orderkey FROM orders WHERE nullif(o_orderstatus, 'O') IS DISTINCT FROM 'F'")
def null_not_equal_strict(spark, sf_dir):
    return read(spark, sf_dir, "orders").filter(~F.nullif(F.col("o_orderstatus"), F.lit("O")).eqNullSafe(F.lit("F"))).select("o_orderkey")


# Test edges: documents refer to codes of ontologies; suppliers are the elements that have such codes.
_EDGES = """
link AS (
  SELECT source AS src_authority, CAST(doc_id AS VARCHAR) AS src_code, CASE lang WHEN 'en' THEN 'HP' WHEN 'fr' THEN 'MONDO' WHEN 'de' THEN 'HPO' ELSE 'ZZ' END AS target_vocab,
    CAST(doc_id * 7 % 120 AS VARCHAR) AS target_code, 'made' AS evidence FROM documents),
element AS (
  SELECT CASE s_nationkey % 3 WHEN 0 THEN 'HPO' WHEN 1 THEN 'Mondo' ELSE 'LOINC' END AS target_source_authority, CASE WHEN s_suppkey % 50 <> 0 THEN {prefix} || s_suppkey END AS target_source_code, s_name AS target_item
  FROM supplier),
alias(target_vocab, target_source_authority) AS (VALUES ('HP', 'HPO'), ('HPO', 'HPO'), ('MONDO', 'Mondo')),
named AS (SELECT * FROM alias INNER JOIN element USING (target_source_authority))"""
_ALL = "src_authority, src_code, target_vocab, target_code, evidence, target_source_authority, target_source_code, target_item"


def _edges(spark, sf_dir, prefix=""):
    d, s = read(spark, sf_dir, "documents", "supplier")
    vocabulary = F.when(F.col("lang") == "en", "HP").when(F.col("lang") == "fr", "MONDO").when(F.col("lang") == "de", "HPO").otherwise("ZZ")
    ed = d.select(F.col("source").alias("src_authority"), F.col("doc_id").cast("string").alias("src_code"), vocabulary.alias("target_vocab"), (F.col("doc_id") * 7 % 120).cast("string").alias("target_code"), F.lit("made").alias("evidence"))
    k = F.col("s_nationkey") % 3
    ws = s.select(F.when(k == 0, "HPO").when(k == 1, "Mondo").otherwise("LOINC").alias("source_authority"), F.when(F.col("s_suppkey") % 50 != 0, F.concat(F.lit(prefix), F.col("s_suppkey").cast("string"))).alias("source_code"), F.col("s_name").alias("item"))
    return ed, ws


# Three kinds of rows: the code is there; the vocabulary has elements without a code; it has none at all.
_RESOLVED = f"""
WITH {_EDGES.format(prefix="''")}
SELECT {_ALL} FROM link INNER JOIN named USING (target_vocab) WHERE target_source_code = target_code
UNION ALL
SELECT {_ALL} FROM link INNER JOIN named USING (target_vocab) WHERE target_source_code IS NULL
UNION ALL
SELECT src_authority, src_code, target_vocab, target_code, evidence, NULL, NULL, NULL FROM link WHERE target_vocab NOT IN (SELECT target_vocab FROM named)"""


@query(_RESOLVED)
def resolve_edges_compat(spark, sf_dir):
    return E.resolve_edges(*_edges(spark, sf_dir), mode="compat")


@query(f"""
WITH {_EDGES.format(prefix="'HP:'")}, bare AS (SELECT *, split_part(target_source_code, ':', 2) AS target_code FROM named)
SELECT {_ALL} FROM link INNER JOIN bare USING (target_vocab, target_code)""")
def resolve_edges_strict(spark, sf_dir):
    return E.resolve_edges(*_edges(spark, sf_dir, "HP:"))


@query(f"""
WITH hit AS (SELECT count(*) FILTER (target_source_code IS NOT NULL) AS n_resolved FROM ({_RESOLVED})), every AS (SELECT count(*) AS n_total FROM documents)
SELECT n_resolved, n_total, round(n_resolved / CASE WHEN n_total > 1 THEN n_total ELSE 1 END, 6) AS ratio FROM hit, every""")
def resolved_ratio(spark, sf_dir):
    ed, ws = _edges(spark, sf_dir)
    return E.resolved_ratio(E.resolve_edges(ed, ws, "compat"), ed).withColumn("ratio", F.round("ratio", 6))


@query("""
SELECT 'HPO' AS src_authority, p_partkey::VARCHAR AS src_code, v AS target_vocab, c AS target_code, 'hpo_xref' AS evidence
FROM part, LATERAL (VALUES ('SNOMED', p_size::VARCHAR), ('UMLS', 'x'), ('OMIM', '6' || p_size)) t(v, c) WHERE p_partkey % 3 = 0 AND v <> 'UMLS'
""")
def harvest_edges(spark, sf_dir):
    p, k = read(spark, sf_dir, "part"), F.col("p_partkey")
    tokens = F.array(F.concat(F.lit(" sctid : "), F.col("p_size").cast("string")), F.lit("UMLS:x"), F.concat(F.lit("MIM:6"), F.col("p_size").cast("string")), F.lit("no colon"))
    staged = p.select(F.when(k % 3 == 0, "HPO").when(k % 3 == 1, "LOINC").alias("source_authority"), k.cast("string").alias("source_code"), F.to_json(F.struct(tokens.alias("hpo_xrefs"))).alias("metadata_"))
    return E.harvest_edges(staged)


@query("""
WITH e AS (SELECT DISTINCT l_partkey AS id, l_suppkey AS target_code FROM lineitem)
SELECT target_code, id, min(id) OVER (PARTITION BY target_code) AS representative, count(*) OVER (PARTITION BY target_code) - 1 AS links FROM e
""")
def coreference_classes(spark, sf_dir):
    """Parts that refer to the same supplier, as classes: a pair is two members of one."""
    return E.coreference_classes(_references(spark, sf_dir)).select("target_code", _number("id"), _number("representative"), "links")


def _number(c):
    return F.substring_index(c, ":", -1).cast("long").alias(c)


def _references(spark, sf_dir):
    width = 12  # ids of one width, so that their order as texts is their order as numbers
    l = read(spark, sf_dir, "lineitem")
    return l.select(F.lit("P").alias("src_authority"), F.lpad(F.col("l_partkey").cast("string"), width, "0").alias("src_code"), F.lit("S").alias("target_vocab"), F.col("l_suppkey").alias("target_code"))


@query("""
WITH e AS (SELECT DISTINCT l_partkey AS id, l_suppkey AS t FROM lineitem)
SELECT DISTINCT least(a.id, b.id) AS id_a, greatest(a.id, b.id) AS id_b FROM e a JOIN e b ON a.t = b.t AND a.id <> b.id WHERE a.id % 20 = 0
""")
def coreference_search(spark, sf_dir):
    """All pairs of the parts that are asked for: those whose key is divisible by 20."""
    members = E.coreferences(_references(spark, sf_dir)).select("target_vocab", "target_code", _number("id"))
    asked = read(spark, sf_dir, "part").filter("p_partkey % 20 = 0").select(F.col("p_partkey").alias("id"))
    return E.pairs_of(members, ["target_vocab", "target_code"], asked)


@query("""
SELECT s_nationkey % 5 AS canonical_concept_id, s_suppkey AS id, min(s_suppkey) OVER w AS representative, count(*) OVER w - 1 AS links FROM supplier WINDOW w AS (PARTITION BY s_nationkey % 5)
""")
def same_concept_classes(spark, sf_dir):
    s = read(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), (F.col("s_nationkey") % 5).alias("canonical_concept_id"))
    return E.same_concept_classes(s)


@query("""
WITH m AS (SELECT DISTINCT l_suppkey AS id, l_orderkey AS target_code FROM lineitem),
k AS (SELECT m.*, s_nationkey % 5 AS concept FROM m JOIN supplier ON s_suppkey = id),
c AS (SELECT target_code, id, min(id) OVER w AS representative, count(*) OVER w - 1 AS links FROM k WINDOW w AS (PARTITION BY target_code, concept)),
p AS (SELECT a.target_code, a.id AS id_a, b.id AS id_b FROM m a JOIN m b ON a.target_code = b.target_code AND b.id = a.id + 17)
SELECT 'concept' AS evidence, target_code, id, representative, links FROM c WHERE links > 0
UNION ALL SELECT 'curated', target_code, id_a, id_a, 1 FROM p
UNION ALL SELECT 'curated', target_code, id_b, id_a, 1 FROM p
""")
def equivalence_claims(spark, sf_dir):
    l, s = read(spark, sf_dir, "lineitem", "supplier")
    members = l.select(F.lit("O").alias("target_vocab"), F.col("l_orderkey").alias("target_code"), F.col("l_suppkey").alias("id"))
    elements = s.select(F.col("s_suppkey").alias("id"), (F.col("s_nationkey") % 5).alias("canonical_concept_id"))
    curated = s.select((F.col("s_suppkey") + 17).alias("id_a"), F.col("s_suppkey").alias("id_b"))
    return E.equivalence_claims(members, elements, curated).drop("target_vocab")


@query(f"SELECT s_suppkey, coalesce(n, 0)::INTEGER AS num_alternates FROM supplier LEFT JOIN ({_CODES}) ON s_suppkey + 10000000 = target_concept_id ORDER BY num_alternates DESC, s_suppkey")
def alternates_order(spark, sf_dir):
    """Elements by their number of alternate codes."""
    return E.by_alternates(_attached(spark, sf_dir), "s_suppkey").select("s_suppkey", "num_alternates")


@query("""
SELECT lower(trim(regexp_replace(regexp_replace(p_type, '[^A-Za-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))) AS name, count(DISTINCT p_brand) AS n_sources, count(DISTINCT p_partkey) AS n_ids FROM part GROUP BY 1 HAVING count(DISTINCT p_brand) > 1
""")
def normalized_match(spark, sf_dir):
    return E.name_groups(read(spark, sf_dir, "part"), "p_partkey", "p_type", "p_brand").select("name", "n_sources", "n_ids")


@query("""
WITH p AS (SELECT lower(trim(regexp_replace(regexp_replace(p_type, '[^A-Za-z0-9 ]+', ' ', 'g'), ' +', ' ', 'g'))) AS name, p_partkey AS id, p_brand FROM part)
SELECT name, id, representative, n_ids FROM (SELECT DISTINCT name, id FROM p) JOIN (SELECT name, min(id) AS representative, count(DISTINCT id) AS n_ids FROM p GROUP BY name HAVING count(DISTINCT p_brand) > 1) USING (name)
""")
def normalized_classes(spark, sf_dir):
    """The members of names that several brands have."""
    return E.name_classes(read(spark, sf_dir, "part"), "p_partkey", "p_type", "p_brand").select("name", "id", "representative", "n_ids")


@query()
def connected_components(spark, sf_dir):
    l = read(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("a"), (F.col("l_suppkey") + 10000000).alias("b"))
    return graph.components(l)
