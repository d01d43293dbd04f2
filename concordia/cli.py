"""Command line: info, validate, parse-priority, stage, bundle."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import functions as F

from . import bundle as bundles
from .functions.priority import FLAGS, parse_priority
from .operators import validation
from .session import session
from .sources import registry, semistructured


def info(a) -> int:
    anchors = semistructured.anchors(session(), a.anchors)
    anchors.groupBy("theme").agg(F.count(F.lit(1)).alias("anchors")).orderBy("theme").show(1000, False)
    return 0


def validate(a) -> int:
    spark = session()
    try:
        elements = semistructured.json_elements(spark, a.collection)
        elements.count()
    except Exception as e:
        print(f"not a collection: {str(e).splitlines()[0]}", file=sys.stderr)
        return 1
    context = validation.submission_of(elements, **{f: True for f in a.flag})
    findings = validation.validate(elements, semistructured.anchors(spark, a.anchors), context).persist()
    findings.orderBy("severity", "code", "item").show(1000, False)
    ok = validation.summary(findings).first()["ok"]
    print("valid" if ok else "not valid")
    return 0 if ok else 1


def priority(a) -> int:
    session().createDataFrame([(a.text,)], "p string").select(parse_priority("p").alias("rule")).select("rule.*").show(truncate=False)
    return 0


def stage(a) -> int:
    options = dict(o.split("=", 1) for o in a.option)
    print(registry.stage(session(), a.source, a.out, **options), "elements")
    return 0


def bundle(a) -> int:
    if not a.source.endswith(".json"):
        print("only JSON collections", file=sys.stderr)
        return 2
    spark = session()
    manifest = bundles.write_bundle(semistructured.json_elements(spark, a.source), a.out, a.version)
    print(f"{manifest['n_elements']} elements, {len(manifest['files'])} files in {a.out}")
    return 0


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="concordia", description=__doc__)
    sub = p.add_subparsers(required=True)
    c = sub.add_parser("info", help="anchors by theme")
    c.add_argument("--anchors", required=True)
    c.set_defaults(run=info)
    c = sub.add_parser("validate", help="findings of a collection")
    c.add_argument("collection")
    c.add_argument("--anchors", required=True)
    c.add_argument("--flag", action="append", default=[], choices=FLAGS)
    c.set_defaults(run=validate)
    c = sub.add_parser("parse-priority", help="what a priority says")
    c.add_argument("text")
    c.set_defaults(run=priority)
    c = sub.add_parser("stage", help="write a source's elements")
    c.add_argument("source", choices=sorted(registry.SOURCES))
    c.add_argument("out")
    c.add_argument("option", nargs="*", help="name=value, as path=...")
    c.set_defaults(run=stage)
    c = sub.add_parser("bundle", help="write a bundle of a collection")
    c.add_argument("source")
    c.add_argument("out")
    c.add_argument("--version", required=True)
    c.set_defaults(run=bundle)
    a = p.parse_args(argv)
    return a.run(a)


if __name__ == "__main__":
    sys.exit(main())
