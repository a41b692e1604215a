"""Command line: ``find``, ``classify``, ``compare`` and ``match`` over folders of Parquet tables or text files."""

from __future__ import annotations

import argparse
from dataclasses import fields

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from locusloom.config import Params
from locusloom.functions.loci import locus_parts
from locusloom.operators.compare import match_calls, match_metrics
from locusloom.plans import pipeline
from locusloom.session import saved, scratch, ship_package
from locusloom.sources.alignments import parse_annotation, parse_sam, read_calls, read_overrides
from locusloom.sources.sinks import write_table


def _params(parser: argparse.ArgumentParser) -> None:
    for f in fields(Params):
        flag = f"--{f.name.replace('_', '-')}"
        if isinstance(f.default, bool):
            parser.add_argument(flag, action="store_true")
        else:
            parser.add_argument(flag, type=type(f.default), default=f.default)


def _given(args: argparse.Namespace) -> Params:
    return Params(**{f.name: getattr(args, f.name) for f in fields(Params)})


def _calls(spark: SparkSession, path: str):
    """Loci of a table of calls, with their places."""
    rows = spark.read.parquet(path).where("final_class = 'PHAS'")
    contig, start, end = locus_parts(F.col("identifier"))
    return rows.select(F.lit(1).alias("run"), contig.alias("chromosome"), "identifier", start.alias("start"), end.alias("end")).dropna().distinct()


def _text_calls(spark: SparkSession, path: str, one_based: bool):
    """Loci of calls given as text, whatever their class."""
    rows = read_calls(spark, path, one_based)
    return rows.select(F.lit(1).alias("run"), "chromosome", "identifier", (F.col("start") + 1).alias("start"), "end").distinct()


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="locusloom", description=__doc__)
    steps = parser.add_subparsers(dest="step", required=True)
    find = steps.add_parser("find", help="SAM text to scored clusters; the library is the file's name")
    find.add_argument("sam", nargs="+")
    classify = steps.add_parser("classify", help="scored clusters to calls")
    classify.add_argument("scored")
    classify.add_argument("--overrides")
    compare = steps.add_parser("compare", help="two tables of calls to one")
    compare.add_argument("run_a")
    compare.add_argument("run_b")
    compare.add_argument("--overlap-buffer", type=int, default=0)
    compare.add_argument("--prefer", default="auto", help="auto, run_a or run_b; auto takes the run that is not pooled")
    compare.add_argument("--label-a", default="run_a")
    compare.add_argument("--label-b", default="run_b")
    match = steps.add_parser("match", help="calls against a BED or GFF file of known loci")
    match.add_argument("calls")
    match.add_argument("truth")
    match.add_argument("--form", choices=("bed", "gff"), default="bed")
    match.add_argument("--flank", type=int, default=250)
    match.add_argument("--text-calls", action="store_true", help="the calls are tab-separated text")
    match.add_argument("--zero-based", action="store_true", help="text calls whose starts count from 0")
    for step in (find, classify, compare, match):
        step.add_argument("--out", required=True)
        step.add_argument("--text", action="store_true", help="tab-separated text in place of Parquet")
    _params(find)
    _params(classify)
    args = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName("locusloom").getOrCreate()
    ship_package(spark)

    def write(df, name: str) -> None:
        if args.text:
            write_table(df, f"{args.out}/{name}")
        else:
            df.write.parquet(f"{args.out}/{name}")

    with scratch(spark):
        _run(args, spark, write)


def _run(args: argparse.Namespace, spark: SparkSession, write) -> None:
    if args.step == "find":
        lines = spark.read.text(args.sam).select("value", F.regexp_extract("_metadata.file_name", r"^(.*?)(?:\.sam)?(?:\.gz)?$", 1).alias("alib"))
        p = _given(args)
        rows = parse_sam(lines).withColumn("tag_id", F.substring_index("name", "|", 1))
        write(pipeline.find(pipeline.prepared(rows, p), p), "scored")
    elif args.step == "classify":
        given = read_overrides(spark, args.overrides) if args.overrides else None
        for name, df in pipeline.result_tables(saved(pipeline.classify(spark.read.parquet(args.scored), _given(args), given), "calls")).items():
            write(df, name)
    elif args.step == "compare":
        inside = [p for p in (args.run_a, args.run_b) if f"{args.out.rstrip('/')}/".startswith(f"{p.rstrip('/')}/")]
        if inside:
            raise ValueError(f"--out must not lie in {inside[0]}")
        for name, df in pipeline.compare_calls(spark.read.parquet(args.run_a), spark.read.parquet(args.run_b), args.overlap_buffer, args.prefer, (args.label_a, args.label_b)).items():
            write(df, name)
    else:
        truth = parse_annotation(spark.read.text(args.truth), args.form)
        truth = truth.select(F.lit(1).alias("run"), "chromosome", F.col("name").alias("identifier"), (F.col("start") + 1).alias("start"), "end")
        matches = match_calls(_text_calls(spark, args.calls, not args.zero_based) if args.text_calls else _calls(spark, args.calls), truth, ["run", "chromosome"], args.flank)
        write(matches, "matches")
        write(match_metrics(matches, ["run"], "chromosome"), "metrics")


if __name__ == "__main__":
    main()
