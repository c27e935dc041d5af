"""``spark-submit`` entry point of the ingest job and, as ``analyse ...``, of the analysis."""

from __future__ import annotations

import argparse
import sys
from collections.abc import Sequence

from proxysift.operators import adapt_for_analysis, clean_records
from proxysift.params import AnalysisParams, JobParams
from proxysift.plans import JOBS, run_analysis, run_job
from proxysift.session import build_session
from proxysift.sources import read_ranked_domains


def _pairs(text: str) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in text.split(",") if pair)


def parse_args(argv: Sequence[str] | None = None) -> JobParams:
    cli = argparse.ArgumentParser("proxysift", description="Parse raw proxy logs into tables.")
    cli.add_argument("-p", "--parser", required=True, choices=sorted(JOBS))
    cli.add_argument("-i", "--input-format", required=True, dest="in_format")
    cli.add_argument("-o", "--output-format", required=True, dest="out_format")
    cli.add_argument("-s", "--input-path", required=True, dest="in_path")
    cli.add_argument("-d", "--output-path", required=True, dest="out_path")
    cli.add_argument(
        "-m", "--save-mode", default="error", choices=["error", "append", "overwrite", "ignore"]
    )
    cli.add_argument("--input-options", type=_pairs, default={}, dest="in_options", metavar="k=v,...")
    cli.add_argument("--output-options", type=_pairs, default={}, dest="out_options", metavar="k=v,...")
    return JobParams(**vars(cli.parse_args(argv)))


def parse_analysis_args(argv: Sequence[str]) -> argparse.Namespace:
    cli = argparse.ArgumentParser("proxysift analyse", description="Rank the least likely records of a table.")
    cli.add_argument("-s", "--input-path", required=True, help="table that the ingest wrote")
    cli.add_argument("-r", "--ranked-path", required=True, help="ranked list of domains")
    cli.add_argument("-d", "--output-path", required=True)
    cli.add_argument("--top", type=int)
    cli.add_argument("--threshold", type=float, default=AnalysisParams.threshold)
    cli.add_argument("--topics", type=int, default=AnalysisParams.topics)
    cli.add_argument("--iterations", type=int, default=AnalysisParams.iterations)
    cli.add_argument("--optimizer", default=AnalysisParams.optimizer, choices=["online", "em", "drawn"])
    cli.add_argument("--model-path")
    return cli.parse_args(argv)


def analyse(argv: Sequence[str]) -> None:
    args = parse_analysis_args(argv)
    params = AnalysisParams(
        top=args.top, threshold=args.threshold, topics=args.topics, iterations=args.iterations,
        optimizer=args.optimizer, model_path=args.model_path,
    )
    spark = build_session("analyse")
    records = clean_records(adapt_for_analysis(spark.read.parquet(args.input_path)))
    run_analysis(spark, records, read_ranked_domains(spark, args.ranked_path), params, args.output_path)


def main(argv: Sequence[str] | None = None) -> None:
    given = list(sys.argv[1:] if argv is None else argv)
    if given[:1] == ["analyse"]:
        return analyse(given[1:])
    params = parse_args(given)
    spark = build_session(params.parser)
    try:
        print(run_job(spark, params))
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
