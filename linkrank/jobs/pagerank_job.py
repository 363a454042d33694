"""Rank the pages of a link dump and save the result.

    spark-submit linkrank/jobs/pagerank_job.py INPUT OUTPUT [ITERATIONS] [DAMPING]
        [--semantics rows-zero|distinct-drop] [--layout csv|by-url|text]
        [--mode error|overwrite] [--num-partitions N] [--top K] [--progress]
        [--checkpoint-every STEPS] [--hot-links N]

Rows-zero reads blank-separated triples and saves CSV; distinct-drop splits
lines at whitespace and saves text. A failure ends the program with an error.
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

if __package__ in (None, ""):
    sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

from pyspark.sql import Observation, SparkSession

from linkrank.operators import report_lines, top_k
from linkrank.plans import RankSemantics, pagerank
from linkrank.session import fit_width, require_absent
from linkrank.sinks import CSV, LAYOUTS, TEXT, default_mode, write_ranks
from linkrank.sources import read_triples_csv, read_triples_text


def parse_arguments(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="pagerank_job", description="Rank the pages of a link dump.")
    parser.add_argument("input", help="triples as text; .bz2 and .gz are read as they are")
    parser.add_argument("output", help="path to save the ranks at")
    parser.add_argument("iterations", nargs="?", type=int, default=10)
    parser.add_argument("damping", nargs="?", type=float, default=0.85)
    parser.add_argument(
        "--semantics", choices=[s.value for s in RankSemantics], default=RankSemantics.ROWS_ZERO.value
    )
    parser.add_argument("--layout", choices=LAYOUTS, help="default: csv for rows-zero, else text")
    parser.add_argument("--mode", choices=["error", "overwrite"], help="default: overwrite for by-url, else error")
    parser.add_argument("--num-partitions", type=int, help="shuffle width; default: as configured, or from the input size")
    parser.add_argument("--checkpoint-every", type=int, default=2, help="steps between checkpoints")
    parser.add_argument("--hot-links", type=int, help="links from which a page is spread; default: a mean partition")
    parser.add_argument("--top", type=int, default=5, help="ranks to print")
    parser.add_argument("--strip-brackets", action="store_true", help="take URL parts from inside <...>")
    parser.add_argument("--progress", action="store_true", help="print the number of pages after each step")
    return parser.parse_args(arguments)


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    semantics = RankSemantics(args.semantics)
    rows_zero = semantics is RankSemantics.ROWS_ZERO
    layout = args.layout or (CSV if rows_zero else TEXT)
    mode = args.mode or default_mode(layout)
    if mode == "error":
        require_absent(spark, args.output)  # now rather than after the ranking
    # Counted while the lines are read for ranking, not by a second scan.
    rejected = Observation("input")
    if rows_zero:
        edges = read_triples_csv(spark, args.input)
    else:
        edges = read_triples_text(spark, args.input, rejected)
    fit_width(edges, args.num_partitions)
    edges = edges.persist()  # laying out the links reads them twice
    steps: list[int] = []

    def show_step(step: int, pages: int) -> None:
        steps.append(step)
        print(f"Step {step}: {pages} pages", flush=True)

    ranks = pagerank(
        edges,
        args.iterations,
        args.damping,
        semantics,
        num_partitions=args.num_partitions,
        checkpoint_every=args.checkpoint_every,
        hot_links=args.hot_links,
        on_step=show_step if args.progress else None,
    )
    edges.unpersist()
    write_ranks(ranks, args.output, layout, mode, args.strip_brackets)
    if rows_zero:
        top_k(ranks, args.top).show(args.top, truncate=False)
    else:
        for row in report_lines(ranks, args.top).orderBy("position").collect():
            print(row.line)
        for row in top_k(ranks, 1).collect():
            print(f"Highest rank: {row.page} ({row.pagerank:.6f})")
        print(f"Lines without a link: {rejected.get['rejected_lines']}")
    if args.progress:
        print(f"Steps done: {len(steps)}")


def main(arguments: list[str] | None = None) -> None:
    args = parse_arguments(arguments)
    spark = (
        SparkSession.builder.appName("linkrank")
        # Checkpoints no longer referred to are deleted while the job runs.
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    try:
        run(spark, args)
    finally:
        spark.stop()


if __name__ == "__main__":
    main()
