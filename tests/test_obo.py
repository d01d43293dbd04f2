"""The ontology data source: cuts of any size, against a plain walk over the lines, and against Spark's own reader."""

import random
import re

import pytest
from pyspark.sql.datasource import EqualTo, In, StringStartsWith

from concordia.sources import obo, semistructured


def content(seed, end):
    rng = random.Random(seed)
    lines = ["format-version: 1.2", ""]
    for k in range(40):
        lines.append(rng.choice(["[Term]", "[Term]", "[Term] ", "[Typedef]"]))
        lines.append(f"id: {rng.choice(['HP', 'GO'])}:{k}")
        for _ in range(rng.randrange(6)):
            lines.append(rng.choice(["name: Ünï ! c", "xref: A:1 ! b", "is_a: HP:0", "name: x", "comment", " xref: B:2\t", "def:none", 'synonym: "a: b" EXACT []', "is_obsolete: true"]))
        if rng.random() < 0.4:
            lines.append(rng.choice(["", " ", "\t"]))
        if rng.random() < 0.2:
            lines.append("xref: after:a_blank")
    return end.join(lines) + (end if seed % 2 else "")


def plain(text):
    out, own = [], None
    for line in re.split(r"\r?\n", text):
        line = line.strip()
        if line.startswith("[") and line.endswith("]"):
            own = {"kind": line[1:-1]}
            out.append(own)
        elif not line:
            own = None
        elif own is not None and ": " in line:
            k, v = line.split(": ", 1)
            v = re.sub(r"\s*!\s*.*$", "", v).strip()
            if k in obo.LISTED:
                own.setdefault(k, []).append(v)
            else:
                own[k] = v
    return [(t["kind"], *[t.get(k) for k in obo.SINGLE], *[t.get(k, []) for k in obo.LISTED]) for t in out]


@pytest.mark.parametrize("seed, end, size", [(1, "\n", 50), (2, "\r\n", 7), (3, "\r\n", 1 << 20)])
def test_any_cut(spark, tmp_path, seed, end, size):
    text = content(seed, end)
    (tmp_path / "x.obo").write_bytes(text.encode())
    got = obo.read_stanzas(spark, str(tmp_path / "x.obo"), splitBytes=size).orderBy("at").collect()
    assert [tuple(r)[:-2] for r in got] == plain(text)
    terms = sorted(tuple(r)[1:] for r in plain(text) if r[0] == "Term")
    by_path = {id(f): sorted(map(tuple, f.collect()), key=repr) for f in (
        semistructured.ontology_terms(spark, str(tmp_path / "x.obo")), semistructured.ontology_terms(spark, f"file://{tmp_path}/x.obo"),
        semistructured.parse_stanzas(spark.read.option("lineSep", "\n[").text(str(tmp_path / "x.obo"))),
    )}
    assert all(found == sorted(terms, key=repr) for found in by_path.values())


def test_filters_are_pushed(spark, tmp_path):
    (tmp_path / "x.obo").write_text(content(4, "\n"))
    reader = obo.FilteringReader({"path": str(tmp_path / "x.obo")})
    left = list(reader.pushFilters([EqualTo(("kind",), "Term"), In(("id",), ("HP:1", "HP:2", "GO:1")), StringStartsWith(("id",), "HP"), EqualTo(("name",), "x")]))
    assert left == [EqualTo(("name",), "x")]
    assert not reader._wanted("Typedef", "HP:1") and not reader._wanted("Term", "GO:1") and not reader._wanted("Term", None) and reader._wanted("Term", "HP:2")
    df = obo.read_stanzas(spark, str(tmp_path / "x.obo"), pushFilters=True).filter("kind = 'Term' and id like 'HP:%'")
    assert "Filter (kind" not in df._jdf.queryExecution().executedPlan().toString()
    assert sorted(r["id"] for r in df.collect()) == sorted(r[1] for r in plain(content(4, "\n")) if r[0] == "Term" and r[1].startswith("HP:"))


def test_empty_and_missing(spark, tmp_path):
    (tmp_path / "none.obo").write_text("")
    assert obo.read_stanzas(spark, str(tmp_path)).collect() == []
    with pytest.raises(Exception, match="nowhere"):
        obo.read_stanzas(spark, str(tmp_path / "nowhere")).collect()


def test_one_table_with_two_filters(spark, tmp_path):
    (tmp_path / "x.obo").write_text(content(6, "\n"))
    terms = semistructured.ontology_terms(spark, str(tmp_path / "x.obo"))
    both = terms.filter("id like 'HP:%'").unionByName(terms.filter("id like 'GO:%'"))
    assert sorted(r["id"] for r in both.collect()) == sorted(r[1] for r in plain(content(6, "\n")) if r[0] == "Term")
