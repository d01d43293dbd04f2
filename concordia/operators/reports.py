"""Reports and cohort rules: coverage, conformance, visits, founders, content screening, crosswalks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .dedup import same_keys


def coverage(df: DataFrame, by: list[str], conditions: dict[str, Column]) -> DataFrame:
    """For each group its rows and the share that meets each condition."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"), *[F.avg(F.coalesce(c, F.lit(False)).cast("int").cast("double")).alias(k) for k, c in conditions.items()])


def conformance_level(themes: DataFrame, by: list[str], level: str = "level", covered: str = "covered") -> DataFrame:
    """For each group the highest level up to which every level is covered; levels count from 1."""
    gap = F.min(F.when(~F.col(covered), F.col(level)))
    return themes.groupBy(*by).agg(F.coalesce(gap - 1, F.max(level)).alias("conformance_level"))


def visit_numbers(df: DataFrame, subject: list[str], date: str, tie: list[str]) -> DataFrame:
    """Rows with visit_number, from 0, by date within the subject."""
    order = Window.partitionBy(*subject).orderBy(date, *tie)
    return df.withColumn("visit_number", F.row_number().over(order) - 1)


def years_from_baseline(df: DataFrame, subject: list[str], date: str) -> DataFrame:
    """Rows with the years since their subject's first date; an aggregate and a join, so no subject's rows are sorted in one task."""
    first = df.groupBy(*subject).agg(F.min(F.to_date(date)).alias("__first"))
    years = F.datediff(F.to_date(date), "__first").cast("double") / 365.25
    return same_keys(df, first, subject).withColumn("years_from_baseline", years).drop("__first")


def founders(individuals: DataFrame) -> DataFrame:
    """(individual_id, is_founder): founders have no parent among the individuals."""
    ids = individuals.select(F.col("individual_id").alias("__id")).distinct()
    out = individuals
    for side in ("mother_id", "father_id"):
        out = out.join(ids.select(F.col("__id").alias(f"__{side}")), F.col(side) == F.col(f"__{side}"), "left")
    return out.select("individual_id", (F.col("__mother_id").isNull() & F.col("__father_id").isNull()).alias("is_founder"))


#: Patterns of content that must not be published (fixed values).
FORBIDDEN = {
    "private_key": r"-----BEGIN [A-Z ]*PRIVATE KEY-----", "aws_key": r"AKIA[0-9A-Z]{16}", "github_token": r"gh[pousr]_[A-Za-z0-9]{36}", "password": r"(?i)password\s*[=:]\s*\S{6,}",
    "api_key": r"(?i)api[_-]?key\s*[=:]\s*\S{8,}", "secret": r"(?i)secret\s*[=:]\s*\S{8,}", "bearer": r"(?i)bearer\s+[A-Za-z0-9._-]{20,}", "connection": r"(?i)(postgres|mysql|mongodb)://[^ ]+:[^ ]+@",
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]{2,}",
    "passwd": r"(?i)(passwd|pwd)\s*[=:]\s*\S{8,}", "aws_name": r"(?i)aws[_-]?(access[_-]?key|secret)", "basic_auth": r"(?i)authorization:\s*basic\s+[A-Za-z0-9+/=]{20,}",
    "ssh_key": r"(?i)ssh-rsa\s+AAAA[0-9A-Za-z+/]+", "social_security": r"\b[0-9]{3}-[0-9]{2}-[0-9]{4}\b", "card_number": r"\b[0-9]{16}\b",
}
#: What a text that one of those patterns matches holds in lower case, whatever else: looked for first, as it is found much faster.
NEEDED = {
    "private_key": "private key-----", "aws_key": "akia", "github_token": "_", "password": "password", "api_key": "api", "secret": "secret", "bearer": "bearer", "connection": "://", "email": "@",
    "passwd": "wd", "aws_name": "aws", "basic_auth": "authorization:", "ssh_key": "ssh-rsa",
}
BINARY_SUFFIXES = (".png", ".jpg", ".pdf", ".zip", ".parquet", ".gz")
LARGE_BYTES = 50 * 1024 * 1024


def _line_ends(c: Column) -> Column:
    return F.length(c) - F.length(F.replace(c, F.lit("\n")))


def _hits(text: Column, name: str, pattern: str) -> Column:
    """Array of (pattern, line, snippet) of a text's matches: lines are counted over the pieces between matches, and the matches."""
    p = F.lit(pattern)
    between = F.zip_with(F.split(text, pattern), F.regexp_extract_all(text, p, F.lit(0)), lambda piece, hit: F.struct(piece.alias("piece"), hit.alias("hit")))
    start = F.struct(F.lit(1).alias("line"), F.array().cast("array<struct<pattern:string,line:int,snippet:string>>").alias("found"))

    def step(state: Column, x: Column) -> Column:
        line = state["line"] + _line_ends(x["piece"])
        own = F.struct(F.lit(name).alias("pattern"), line.cast("int").alias("line"), F.substring(x["hit"], 1, 50).alias("snippet"))
        return F.struct((line + _line_ends(x["hit"])).alias("line"), F.array_append(state["found"], own).alias("found"))

    matched = F.filter(between, lambda x: x["hit"].isNotNull())
    may = F.rlike(text, p)
    if FORBIDDEN.get(name) == pattern and name in NEEDED:
        may = F.contains(F.lower(text), F.lit(NEEDED[name])) & may
    return F.when(may, F.aggregate(matched, start, step, lambda state: state["found"]))


def screen_content(files: DataFrame, path: str, text: str, patterns: dict[str, str] = FORBIDDEN) -> DataFrame:
    """(path, pattern, line, snippet): every place that a pattern matches in files that aren't binary; one pass over the texts."""
    binary = F.rlike(F.lower(F.col(path)), F.lit("(" + "|".join(s.replace(".", r"\.") for s in BINARY_SUFFIXES) + ")$"))
    found = F.flatten(F.array_compact(F.array(*[_hits(F.col(text), name, pattern) for name, pattern in patterns.items()])))
    return files.filter(~binary).select(F.col(path).alias("path"), F.inline(found))


def screen_files(files: DataFrame, forbidden_folders: tuple[str, ...] = (), forbidden_suffixes: tuple[str, ...] = ()) -> DataFrame:
    """(path, reason) of files that are too large, in forbidden folders, or of forbidden kinds."""
    p = F.col("path")
    in_folder = F.lit(False)
    for folder in forbidden_folders:
        in_folder = in_folder | F.startswith(p, F.lit(folder))
    of_kind = F.lit(False)
    for suffix in forbidden_suffixes:
        of_kind = of_kind | F.endswith(F.lower(p), F.lit(suffix))
    reasons = F.array(F.when(F.col("length") > LARGE_BYTES, "too large"), F.when(in_folder, "forbidden folder"), F.when(of_kind, "forbidden kind"))
    return files.select("path", F.explode(F.array_compact(reasons)).alias("reason"))


def active_crosswalk(elements: DataFrame, crosswalk: DataFrame, schema_id: str | None = None) -> DataFrame:
    """Active elements (of a schema, if one is given) with their crosswalk's columns."""
    kept = elements.filter("is_active") if schema_id is None else elements.filter(F.col("is_active") & (F.col("schema_id") == schema_id))
    return kept.join(crosswalk, "canonical_concept_id", "left")


def curation_winners(claims: DataFrame, key: list[str], accession: str = "accession") -> DataFrame:
    """Of elements that claim the same thing, the one with the older accession stays; the others name it."""
    first = claims.groupBy(*key).agg(F.min(accession).alias("__first"))
    replaced = F.when(F.col(accession) != F.col("__first"), F.col("__first"))
    return same_keys(claims, first, key).withColumn("replaced_by", replaced).withColumn("is_active", F.col("replaced_by").isNull()).drop("__first")
