"""String expressions. Every function takes and returns Columns; nothing here runs Python per row."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# Canonical vocabulary names, and other spellings of them.
CANONICAL_VOCABULARIES = (
    "OMIM", "MONDO", "HP", "ICD10", "ICD10CM", "ICD10PCS", "ICD9CM", "ICD9Proc", "MESH", "SNOMED", "NCIT", "LOINC", "RxNorm",
    "ATC", "MEDDRA", "ORPHANET", "DOID", "caDSR", "CDISC", "HGNC", "ENSEMBL", "EFO", "NCBIGENE", "UniProtKB", "PubMed", "PMID",
)
VOCABULARY_ALIASES = {
    "HPO": "HP", "OMIM-PS": "OMIM", "MIM": "OMIM", "MONDO_GENETIC": "MONDO", "ICD-10": "ICD10", "ICD-10-CM": "ICD10CM", "ICD-10-PCS": "ICD10PCS",
    "ICD-9-CM": "ICD9CM", "ICD9": "ICD9CM", "ICD-9": "ICD9CM", "MSH": "MESH", "MESHA": "MESH", "SCTID": "SNOMED", "SNOMEDCT": "SNOMED", "SNOMED_CT": "SNOMED",
    "SNOMED CT": "SNOMED", "SCT": "SNOMED", "NCI": "NCIT", "NCI_THESAURUS": "NCIT", "MEDDRAID": "MEDDRA", "DiseasesDB": "DiseasesDB", "Orphanet": "ORPHANET",
    "ORDO": "ORPHANET", "DO": "DOID", "Disease_Ontology": "DOID", "Cadsr": "caDSR", "CADSR": "caDSR", "Cdisc": "CDISC", "RXNORM": "RxNorm", "Rxnorm": "RxNorm",
    "EnsEMBL": "ENSEMBL", "Ensembl": "ENSEMBL", "Hgnc": "HGNC", "PMID": "PubMed", "Pubmed": "PubMed",
}
#: Fixed pattern of a reference: vocabulary, colon, code.
XREF_PATTERN = r"^\s*([A-Za-z][A-Za-z0-9_\- ]*?)\s*:\s*(.+?)\s*$"
#: Fixed values that mean no reference.
NULL_TOKENS = ("", "-", "N/A", "n/a", "None")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def trim_ws(c) -> Column:
    """Without white space of any kind at either end; trim() knows only spaces."""
    return F.regexp_replace(col(c), r"^[\s ]+|[\s ]+$", "")


def blank_to_null(c) -> Column:
    """The trimmed text, null if nothing is left."""
    trimmed = trim_ws(c)
    return F.when(trimmed != "", trimmed)


def first_filled(*columns) -> Column:
    """The first of the columns that isn't blank, trimmed."""
    return F.coalesce(*[blank_to_null(c) for c in columns])


def literal_map(values: dict) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(values.items())])


def mapped(c, values: dict) -> Column:
    """values[c], null where there is none."""
    return F.try_element_at(literal_map(values), col(c))


def tokens(c, delimiter: str = r"\|") -> Column:
    """Trimmed parts that aren't empty, each once, in order of first occurrence."""
    return F.array_distinct(F.filter(F.transform(F.split(col(c), delimiter), trim_ws), lambda x: x != ""))


def _joined(parts: Column) -> Column:
    return F.when(F.size(parts) > 0, F.array_join(parts, "|"))


def normalize_pipes(*columns) -> Column:
    """One list from several, parted by |, ; or a comma; null if it would be empty."""
    every = F.concat(*[F.coalesce(tokens(c, r"[|;,]"), F.array().cast("array<string>")) for c in columns])
    return _joined(F.array_distinct(every))


def normalize_names(c) -> Column:
    """A list parted by | alone; null if it would be empty."""
    return _joined(F.coalesce(tokens(c), F.array().cast("array<string>")))


def normalize_collections(c) -> Column:
    """Names trimmed, sorted, each once; null entries and blanks left out."""
    names = F.filter(F.transform(col(c), trim_ws), lambda x: x.isNotNull() & (x != ""))
    return F.sort_array(F.array_distinct(names))


def normalize_id(c) -> Column:
    """The prefix before the first colon in upper case; ids without one as they are."""
    c = trim_ws(c)
    at = F.instr(c, ":")
    return F.when(at > 0, F.concat(F.upper(F.substr(c, F.lit(1), at - 1)), F.substr(c, at))).otherwise(c)


def quoted(c) -> Column:
    """What stands in quotation marks at the beginning, up to the next mark; null if nothing does."""
    return F.nullif(F.regexp_extract(col(c), r'^"([^"]+)"', 1), F.lit(""))


def ontology_definition(c) -> Column:
    return F.coalesce(quoted(c), F.nullif(col(c), F.lit("")))


def ontology_xref(c) -> Column:
    """The id at the beginning of a reference line, its prefix in upper case; null without a prefix."""
    first = F.regexp_replace(F.split_part(trim_ws(c), F.lit(" "), F.lit(1)), ",+$", "")
    return F.when(F.contains(first, F.lit(":")), normalize_id(first))


def normalize_vocabulary(c) -> Column:
    """The canonical name: exact names and aliases first, then either in any case; null if unknown."""
    exact = VOCABULARY_ALIASES | {v: v for v in CANONICAL_VOCABULARIES}
    folded = {a.upper(): v for a, v in reversed(VOCABULARY_ALIASES.items())} | {v.upper(): v for v in CANONICAL_VOCABULARIES}
    name = trim_ws(c)
    return F.coalesce(mapped(name, exact), mapped(F.upper(name), folded))


def parse_xref(c) -> Column:
    """struct<vocabulary, code> of a reference token; null if it isn't one or its vocabulary is unknown."""
    vocabulary = normalize_vocabulary(F.nullif(F.regexp_extract(col(c), XREF_PATTERN, 1), F.lit("")))
    code = trim_ws(F.regexp_extract(col(c), XREF_PATTERN, 2))
    return F.when(vocabulary.isNotNull() & (code != ""), F.struct(vocabulary.alias("vocabulary"), code.alias("code")))


def xref_tokens(vocabulary: str, c) -> Column:
    """Tokens with a prefix from a list parted by ; or commas; the vocabulary's where a token has none."""
    raw = F.coalesce(col(c), F.lit(""))
    parts = F.filter(F.transform(F.split(raw, "[;,]"), trim_ws), lambda x: x != "")
    named = F.transform(parts, lambda x: F.when(F.contains(x, F.lit(":")), x).otherwise(F.concat(F.lit(f"{vocabulary}:"), x)))
    return F.when(trim_ws(raw).isin(*NULL_TOKENS), F.array().cast("array<string>")).otherwise(named)


def strip_bom(c) -> Column:
    return F.regexp_replace(col(c), "^﻿+", "")


def collection_of_file(name) -> Column:
    """A collection's name from a project file's name (without its folder)."""
    stem = F.regexp_replace(col(name), r"\.[^.]*$", "")
    short = F.regexp_replace(F.regexp_replace(stem, "_cdes", ""), "_CDEs", "")
    return (
        F.when(F.contains(short, F.lit("Answer ALS")), "Answer-ALS").when(F.contains(short, F.lit("CARD_and_PathND")), "CARD-PathND")
        .when(F.startswith(short, F.lit("GP2")), "GP2").otherwise(short)
    )


def default_description(description, item, collection) -> Column:
    return F.coalesce(blank_to_null(description), F.concat(col(item), F.lit(" ("), col(collection), F.lit(")")))


def search_text_library(description, authority, code, collection, collections, metadata) -> Column:
    """Parts joined by " | ": description, source, collection, collections, and string entries of a JSON object in order of keys."""
    source = F.concat_ws(" ", col(authority), F.nullif(col(code), F.lit("")))
    values = F.from_json(col(metadata), "map<string,string>")
    keys = F.sort_array(F.map_keys(values))
    texts = F.filter(F.transform(keys, lambda k: F.when(_is_json_string(metadata, k), F.concat_ws(" ", k, values[k]))), lambda x: x.isNotNull())
    names = F.when(F.size(col(collections)) > 0, F.array_join(col(collections), " "))
    return F.concat_ws(" | ", col(description), source, F.nullif(col(collection), F.lit("")), names, F.nullif(F.array_join(texts, " "), F.lit("")))


def _is_json_string(metadata, key: Column) -> Column:
    """Whether an entry of a JSON object is a string: its text form in the object begins with a quotation mark."""
    objects = F.from_json(col(metadata), "map<string,variant>")
    return F.schema_of_variant(objects[key]) == "STRING"


def search_text_script(description, authority, code, collection=None) -> Column:
    """Parts joined by spaces; blanks left out."""
    parts = [description, authority, code, *([collection] if collection is not None else [])]
    return F.concat_ws(" ", *[F.nullif(col(p), F.lit("")) for p in parts])


def search_text_sql(description, authority, code, collection, collections, metadata) -> Column:
    """As the SQL function writes it: blanks stay, and a source without a code keeps its space."""
    return F.concat_ws(" | ", col(description), F.concat(col(authority), F.lit(" "), F.coalesce(col(code), F.lit(""))), col(collection), F.array_join(col(collections), " "), col(metadata))


def search_text_plain(description, name) -> Column:
    """The description alone, or the name where it is blank: what small collections are encoded by."""
    return F.coalesce(F.nullif(col(description), F.lit("")), F.nullif(col(name), F.lit("")), F.lit(""))


def camel_case(c) -> Column:
    """Words joined, each with a capital: names as the contract's fields write them."""
    words = F.filter(F.split(col(c), r"[^A-Za-z0-9]+"), lambda x: x != "")
    return F.array_join(F.transform(words, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substr(w, F.lit(2)))), "")


def normalized_words(c) -> Column:
    """Lower case, punctuation out, white space single: what equal names have in common."""
    return trim_ws(F.regexp_replace(F.regexp_replace(F.lower(col(c)), r"[^\p{L}\p{N}\s]+", " "), r"\s+", " "))


def left(c, n: int) -> Column:
    return F.substring(col(c), 1, n)
