"""Sources on small files of our own."""

import datetime as dt
import json
import tarfile
import zipfile

import pytest
from pyspark.sql import functions as F

from concordia.operators import dedup, edges, sixaxis, validation
from concordia.plans.build import build
from concordia.schema import ELEMENT, to_elements
from concordia.sources import delimited, fetch, registry, semistructured

DAY = dt.date(2024, 5, 6)


def rows(df):
    return [r.asDict(recursive=True) for r in df.collect()]


def by(df, key="source_code"):
    return {r[key]: r for r in rows(df)}


def put(path, text, encoding="utf-8"):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text, encoding=encoding)
    return str(path)


def test_concepts(spark, tmp_path):
    tab = lambda *lines: "\n".join("\t".join(x) for x in lines) + "\n"
    put(tmp_path / "CONCEPT.csv", tab(
        ["concept_id", "concept_name", "domain_id", "vocabulary_id", "concept_class_id", "standard_concept", "concept_code", "valid_start_date", "valid_end_date", "invalid_reason"],
        ["1", "Sodium, blood", "Measurement", "LOINC", "Lab Test", "S", "2951-2", "", "", ""], ["2", "Sodium", "", "LOINC", "Component", "", "LP1", "", "", ""], ["3", "Blood", "", "LOINC", "System", "", "LP2", "", "", ""],
        ["x", "bad id", "Drug", "RxNorm", "c", "S", "9", "", "", ""], ["4", "Aspirin", "Drug", "RxNorm", "c", "S", "", "", "", ""], ["5", " ", "Drug", "RxNorm", "c", "S", "7", "", "", ""],
    ))
    put(tmp_path / "VOCABULARY.csv", tab(["vocabulary_id", "vocabulary_name", "vocabulary_reference", "vocabulary_version", "vocabulary_concept_id"], ["LOINC", "n", "r", "2.7", "0"], ["RxNorm", "n", "r", " ", "0"]))
    put(tmp_path / "CONCEPT_SYNONYM.csv", tab(["concept_id", "concept_synonym_name"], ["1", "Na; natrium"], ["1", " "], ["1", "Na"]))
    put(tmp_path / "CONCEPT_RELATIONSHIP.csv", tab(["concept_id_1", "concept_id_2", "relationship_id", "valid_start_date", "valid_end_date", "invalid_reason"], ["1", "2", "Has component", "", "", ""], ["1", "3", "Has system", "", "", "D"]))
    read = lambda n: delimited.read_delimited(spark, f"{tmp_path}/{n}.csv")
    axes = sixaxis.six_axes(read("CONCEPT"), read("CONCEPT_RELATIONSHIP"))
    assert {r["omop_concept_id"]: (r["axis_component"], r["axis_system"]) for r in rows(axes)} == {"1": ("Sodium", None), "2": (None, None), "3": (None, None)}
    axes = axes.withColumn("omop_concept_id", F.col("omop_concept_id").cast("long"))
    got = by(delimited.concepts(spark, read("CONCEPT"), read("VOCABULARY"), read("CONCEPT_SYNONYM"), axes, retrieved=DAY))
    assert set(got) == {"2951-2", "4"}
    one = got["2951-2"]
    assert (one["item_type"], one["source_version"], one["alternate_names"], one["canonical_concept_id"]) == ("numeric", "Athena-LOINC-2.7", "Na|natrium", 1)
    assert json.loads(one["metadata_"])["axis_component"] == "Sodium" and "omop_domain_id" in json.loads(one["metadata_"])
    assert got["4"]["source_version"] == "Athena-RxNorm-unknown" and got["4"]["item_type"] == "enum"
    assert rows(registry.SOURCES["concepts"](spark, str(tmp_path), standard_only=False)).__len__() == 4


def test_lab_codes(spark, tmp_path):
    path = put(tmp_path / "l.csv", "\n".join([
        "LOINC_NUM,COMPONENT,PROPERTY,TIME_ASPCT,SYSTEM,SCALE_TYP,METHOD_TYP,CLASS,LONG_COMMON_NAME,SHORTNAME,RELATEDNAMES2,EXAMPLE_UCUM_UNITS,EXAMPLE_UNITS,STATUS",
        '1-1,"Sodium, total",SCnc,Pt,Ser,Qn,,CHEM,"Sodium, in ""serum""",Na SerPl,"Na; sodium, Na",mmol/L,mEq/L,active', "2-2,Old,,,,Ord,,,,,,,,DEPRECATED", "3-3,Plain,,,,Nar,,,,,,,,",
    ]))
    got = by(delimited.lab_codes(delimited.read_delimited(spark, path), version="9", retrieved=DAY))
    assert set(got) == {"1-1", "3-3"}
    a, b = got["1-1"], got["3-3"]
    assert (a["item"], a["description"], a["item_type"], a["unit_of_measure"], a["unit_vocabulary"], a["alternate_names"]) == ("Na SerPl", 'Sodium, in "serum"', "numeric", "mmol/L", "UCUM", "Na|sodium")
    assert json.loads(a["metadata_"])["axis_scale"] == "QN" and (b["item"], b["description"], b["item_type"], b["unit_vocabulary"]) == ("Plain", "Plain", "string", None)


def test_protocols(spark, tmp_path):
    path = put(tmp_path / "p.csv", "variable name,Variable_Description,Variable_Type,Variable_Unit,Variable_Min,Variable_Max,Protocol_ID,Variable_Values\nage,Age,Integer,years,0,120,P1,\nsex,,Categorical,,1,9,,0|1\nbad,x,decimal,,5,1,P2,\nworse,x,decimal,,oops,1,P2,\n")
    got = by(delimited.protocols(delimited.read_delimited(spark, path), retrieved=DAY))
    assert (got["age"]["plausible_min"], got["age"]["plausible_max"], got["age"]["member_of_collections"], got["age"]["unit_vocabulary"]) == (0.0, 120.0, ["PhenX-P1"], "free-text")
    assert (got["sex"]["item_type"], got["sex"]["plausible_min"], got["sex"]["description"], got["sex"]["values"]) == ("enum", None, "sex", "0|1")
    assert all(got[k]["plausible_min"] is None and got[k]["plausible_max"] is None for k in ("bad", "worse"))


def test_data_elements(spark, tmp_path):
    path = put(tmp_path / "n.csv", "CDE ID,CDE Name,Definition,Data Type,Permissible Values,PV Descriptions,Variable Name,Sub-Domain,Domain Name,External Id Loinc,External Id Snomed,Measurement Type\nC1,Name,What,Numeric Values,1;2,one;two,Var,Sub,Dom,\"1-1; 2-2\",SCTID:5,week\n" + "x" * 41 + ",N,D,Text,,,V,,,,,\nC2,Only name,,Date,,,,,,N/A,-,\n", "utf-8-sig")
    got = by(delimited.data_elements(delimited.read_delimited(spark, path, ","), retrieved=DAY))
    assert set(got) == {"C1", "C2"}
    one = got["C1"]
    assert (one["item"], one["values"], one["member_of_collections"], one["unit_of_measure"]) == ("Var", "1|2 | one|two", ["NINDS-Dom", "NINDS-Dom-Sub"], "week")
    assert json.loads(one["metadata_"])["ninds_xrefs"] == ["LOINC:1-1", "LOINC:2-2", "SCTID:5"]
    assert "ninds_xrefs" not in json.loads(got["C2"]["metadata_"]) and got["C2"]["item_type"] == "date"
    assert {(r["target_vocab"], r["target_code"], r["evidence"]) for r in rows(edges.harvest_edges(delimited.data_elements(delimited.read_delimited(spark, path, ","))))} == {("LOINC", "1-1", "ninds_xref"), ("LOINC", "2-2", "ninds_xref"), ("SNOMED", "5", "ninds_xref")}


def test_codelists(spark, tmp_path):
    path = put(tmp_path / "SDTM Terminology 2026-03-27.txt", "Code\tCodelist Code\tCodelist Name\tCDISC Submission Value\tCDISC Synonym(s)\tCDISC Definition\tNCI Preferred Term\nC1\tCL1\tSex\tF\tFemale; woman\tA person\tFemale\nC2\t\t\t\t\t\tMale\n")
    got = by(registry.SOURCES["codelists"](spark, path))
    assert (got["C1"]["source_version"], got["C1"]["alternate_names"], got["C1"]["item"]) == ("CDISC-SDTM-2026-03-27", "Female|woman", "F")
    assert (got["C2"]["item"], got["C2"]["description"], got["C2"]["metadata_"]) == ("Male", "Male", None)


def test_project_files(spark, tmp_path):
    put(tmp_path / "GP2_things_cdes.csv", "Item,Description,ItemType,Values,AlternateItemNames\nage,,Numeric,,a | b|a\n,no item,,,\n")
    put(tmp_path / "Lab_CDEs.csv", "Item,Description\nx,What x is\n")
    got = by(delimited.project_files(spark, str(tmp_path), retrieved=DAY), "item")
    assert (got["age"]["collection"], got["age"]["description"], got["age"]["alternate_names"], got["age"]["item_type"]) == ("GP2", "age (GP2)", "a|b", "numeric")
    assert got["x"]["collection"] == "Lab" and len(got["x"]["id"]) == 64


OBO = """format-version: 1.2
! header

[Term]
id: HP:1
name: Tall ! not short
def: "Being tall." [A:1]
synonym: "high" EXACT []
synonym: "high" RELATED []
xref: snomedct:12, "x"
xref: nothing
is_a: HP:0 ! root

[Term]
id: HP:2
name: Gone
is_obsolete: true

[Term]
id: GO:3
name: Other

[Typedef]
id: part_of
"""


def test_ontology(spark, tmp_path):
    path = put(tmp_path / "h.obo", OBO)
    terms = by(semistructured.ontology_terms(spark, path), "id")
    assert set(terms) == {"HP:1", "HP:2", "GO:3"} and terms["HP:1"]["is_a"] == ["HP:0"] and terms["HP:1"]["name"] == "Tall"
    got = by(registry.SOURCES["hpo"](spark, path, version="v"))
    assert list(got) == ["HP:1"]
    assert (got["HP:1"]["description"], got["HP:1"]["alternate_names"], json.loads(got["HP:1"]["metadata_"])) == ("Being tall.", "high", {"hpo_xrefs": ["SNOMEDCT:12"]})


def test_yaml(spark, tmp_path):
    pytest.importorskip("yaml")
    put(tmp_path / "objects" / "entities.yaml", "subject:\n  display_name: Subject\n  type: string\n  description: |\n    Who it is\nodd: 3\n")
    put(tmp_path / "objects" / "bad.yaml", "a: [1\n")
    got = by(registry.SOURCES["yaml"](spark, str(tmp_path), version="v"))
    assert list(got) == ["BIDS:objects:subject"] and got["BIDS:objects:subject"]["item_type"] == "string" and got["BIDS:objects:subject"]["description"] == "Who it is"


def test_anchors(spark, tmp_path):
    put(tmp_path / "01_a.json", json.dumps([{"item": "A", "priority": "Required", "metadata_": {"companion_fields": ["B"]}, "unknown": 1}, {"item": "B", "priority": "Optional"}]))
    put(tmp_path / "02_b.json", json.dumps([{"item": "C", "priority": "Required-for-longitudinal"}]))
    anchors = semistructured.anchors(spark, str(tmp_path))
    assert {r["item"]: r["theme"] for r in rows(anchors)} == {"A": "01_a", "B": "01_a", "C": "02_b"}
    context = validation.submission(spark, ["A"], is_longitudinal=True)
    assert {(r["code"], r["item"], r["field"]) for r in rows(validation.missing_anchors(anchors, context).unionByName(validation.missing_companions(anchors, context)))} == {("ANCHOR_MISSING", "C", None), ("MISSING_COMPANION_FIELD", "A", "B")}
    put(tmp_path / "03_c.json", json.dumps([{"item": "A"}]))
    with pytest.raises(ValueError, match="more than once: A"):
        semistructured.anchors(spark, str(tmp_path))


def element(**more):
    return {"item": "i", "description": "d", "source_authority": "OMOP", "source_version": "1", "source_retrieved_date": "2024-01-01"} | more


def test_json_elements(spark, tmp_path):
    path = put(tmp_path / "e.json", json.dumps([element(member_of_collections=[" b", "a", "b"], alternate_names="x| y |x")]))
    got = rows(semistructured.json_elements(spark, path))[0]
    assert (got["member_of_collections"], got["alternate_names"], got["cardinality"], got["is_active"], got["equivalent_ids"]) == (["a", "b"], "x|y", "single", True, [])
    with pytest.raises(ValueError, match="extra"):
        to_elements(spark.createDataFrame([("a",)], "extra string"))


def test_build(spark, tmp_path):
    """Staged sources to elements: a table hides lines of its name, malformed lines are skipped."""
    stage = tmp_path / "stage"
    make = lambda items: to_elements(spark.read.schema(ELEMENT).json(spark.sparkContext.parallelize([json.dumps(i) for i in items])))
    make([element(source_authority="HPO", source_code="HP:1", metadata_=json.dumps({"hpo_xrefs": ["OMIM:5", "UMLS:1"]}), canonical_concept_id=7), element(source_authority="HPO", source_code="HP:1", description="other", unit_of_measure="cm", member_of_collections=["c"])]).write.parquet(f"{stage}/hpo.parquet")
    put(stage / "hpo.jsonl", json.dumps(element(source_authority="HPO", source_code="HP:9")) + "\n")
    put(stage / "omim.jsonl", json.dumps(element(source_authority="OMIM", source_code="5", item="five")) + "\nnot json\n")
    concepts = spark.createDataFrame([(1, "c1", "V", None), (7, "c7", "W", "S")], "concept_id long, concept_code string, vocabulary_id string, standard_concept string")
    relations = spark.createDataFrame([(1, 7, "Maps to", None)], "concept_id_1 long, concept_id_2 long, relationship_id string, invalid_reason string")
    got = by(build(spark, str(stage), str(tmp_path / "out"), concepts=concepts, relationships=relations))
    assert set(got) == {"HP:1", "5"}
    assert (got["HP:1"]["unit_of_measure"], got["HP:1"]["source_row_count"], got["HP:1"]["member_of_collections"]) == ("cm", 2, ["c"])
    resolved = rows(spark.read.parquet(f"{tmp_path}/out/resolved"))
    assert [(r["src_code"], r["target_item"]) for r in resolved] == [("HP:1", "five")]


def test_resolution_cases(spark):
    """Code matches, authority without the code, no such authority, and an authority's row without a code."""
    ed = spark.createDataFrame([("a", "1", v, c, "e") for v, c in (("HP", "x"), ("HP", "y"), ("ATC", "z"), ("MONDO", "q"))], "src_authority string, src_code string, target_vocab string, target_code string, evidence string")
    ws = spark.createDataFrame([("HPO", "x", "ix"), ("Mondo", None, "none")], "source_authority string, source_code string, item string")
    assert {(r["target_vocab"], r["target_code"], r["target_item"]) for r in rows(edges.resolve_edges(ed, ws, "compat"))} == {("HP", "x", "ix"), ("ATC", "z", None), ("MONDO", "q", "none")}
    assert [r["target_item"] for r in rows(edges.resolve_edges(ed, ws))] == ["ix"]


def test_fetch(tmp_path):
    for bad in (None, "", "file:///etc/passwd", "ftp://h/x", "javascript:x", "http://", "data:,x"):
        with pytest.raises(ValueError):
            fetch.checked_url(bad)
    for bad in (None, "", "-upload-pack=x", "file:///x", "ext::sh"):
        with pytest.raises(ValueError):
            fetch.checked_repository(bad)
    assert fetch.checked_url("https://example.org/x") and fetch.checked_repository("https://example.org/r.git")
    for name in ("/abs", "../up", "a/../../b", "c:/x", "..\\x"):
        with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
            z.writestr(name, "x")
        with pytest.raises(ValueError):
            fetch.extract(tmp_path / "z.zip", tmp_path / "out")
    with zipfile.ZipFile(tmp_path / "ok.zip", "w") as z:
        z.writestr("a/b.txt", "x")
    assert fetch.extract(tmp_path / "ok.zip", tmp_path / "out") == ["a/b.txt"] and (tmp_path / "out/a/b.txt").read_text() == "x"
    with tarfile.open(tmp_path / "l.tar", "w") as t:
        link = tarfile.TarInfo("l")
        link.type, link.linkname = tarfile.SYMTYPE, "../../etc"
        t.addfile(link)
    with pytest.raises(ValueError):
        fetch.extract(tmp_path / "l.tar", tmp_path / "out")
    assert fetch.first_match(tmp_path, "*.nope", "*.zip").name == "ok.zip"
    with pytest.raises(FileNotFoundError):
        fetch.first_match(tmp_path, "*.none")


def test_dedup_elements(spark):
    """All scalars come from one row, its nulls included; a null code is a code."""
    base = [element(source_code="1", item="a", unit_of_measure="cm", values=None, alternate_names="p|q"), element(source_code="1", item="b", values="v", alternate_names="q|r"), element(item="n"), element(item="m")]
    df = to_elements(spark.read.schema(ELEMENT).json(spark.sparkContext.parallelize([json.dumps(i) for i in base])))
    got = by(dedup.dedup_elements(df))
    assert (got["1"]["item"], got["1"]["values"], got["1"]["alternate_names"], got["1"]["source_row_count"]) == ("a", None, "p|q|r", 2)
    assert got[None]["source_row_count"] == 2
    assert by(dedup.dedup_elements(df, "compat"))["1"]["alternate_names"] == "p|q|q|r"
