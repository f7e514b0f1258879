"""Command line: results of a vote page, maps of results. A folder of maps is previewed by ``python -m http.server``.

python -m seatloom.cli results --config FILE [--url URL] [--local_html FILE] [--save_html FILE] [--output_... FILE]
python -m seatloom.cli maps --config FILE --results_csv FILE --geojson FILE [--output_dir DIR]
"""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import functions as F
from pyspark.sql import types as T

from seatloom.functions.text import thousands
from seatloom.operators import extract, results
from seatloom.session import session
from seatloom.sources import blocs, boundaries, files, map_pages, pages

log = logging.getLogger("seatloom")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="seatloom", description="Constituency vote analytics on Spark.")
    sub = parser.add_subparsers(dest="command", required=True)
    r = sub.add_parser("results", help="a vote page to three CSV tables")
    r.add_argument("--config", default="config/coalitions.json", help="bloc configuration (JSON)")
    r.add_argument("--url", default="", help="page to fetch")
    r.add_argument("--local_html", default="", help="page to read if none can be fetched")
    r.add_argument("--save_html", default="", help="where to keep the page that was fetched")
    r.add_argument("--mark", default=extract.MARK, help="text that the page's data script holds before its object")
    r.add_argument("--output_seat_results", default="results/seat_results.csv")
    r.add_argument("--output_party_votes", default="results/party_totals.csv")
    r.add_argument("--output_party_by_seat", default="results/party_by_seat.csv")
    m = sub.add_parser("maps", help="a map page for each bloc")
    m.add_argument("--config", default="config/coalitions.json")
    m.add_argument("--results_csv", default="results/seat_results.csv")
    m.add_argument("--geojson", default="data/constituencies.geojson")
    m.add_argument("--output_dir", default="site", help="gets index.html and maps/")
    m.add_argument("--credit", action="append", help="a line about the data under the map; may be given again")
    return parser


def run_results(args: argparse.Namespace) -> None:
    spark = session()
    known = blocs.read_blocs(spark, args.config)
    html = pages.fetch(args.url) if args.url else None
    if html and args.save_html:
        with open(args.save_html, "w", encoding="utf-8") as f:
            f.write(html)
        log.info("The page is kept in %s", args.save_html)
    if html:
        page = pages.as_page(spark, args.url, html)
    elif args.local_html:
        log.info("Taking the page from %s", args.local_html)
        page = pages.read_pages(spark, args.local_html)
    else:
        raise RuntimeError("the page can't be fetched and no local file is given")
    seats, votes = (x.cache() for x in extract.election(page, args.mark))
    votes_sum = {"votes": F.sum("votes")}
    tables = [
        (args.output_seat_results, results.seat_results(seats, votes, known), (), {"votes": F.sum("total_votes")}),
        (args.output_party_votes, results.ranked_parties(votes), (), votes_sum),
        (args.output_party_by_seat, results.party_by_seat(votes), ("seat_pos", "res_pos"), votes_sum),
    ]
    for path, df, order, metrics in tables:
        told = files.write_ordered_csv(df, path, order, metrics)
        log.info("%s: %d rows, %d votes", path, told["rows"], told["votes"] or 0)
    log.info("Largest parties:")
    shown = files.read_csv(spark, args.output_party_votes, T.StructType().add("party", "string").add("votes", "long"), row_pos=True)
    for r in shown.orderBy("row_pos").limit(results.SUMMARY).select("party", thousands(F.col("votes")).alias("shown")).collect():
        log.info("  %s: %s", r.party, r.shown)


def run_maps(args: argparse.Namespace) -> None:
    spark = session()
    for path in map_pages.write_maps(boundaries.read_boundaries(spark, args.geojson), files.read_seat_results(spark, args.results_csv), blocs.read_blocs(spark, args.config), args.output_dir, tuple(args.credit or map_pages.CREDITS)):
        log.info("Map page: %s", path)


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(message)s")
    if args.command == "results":
        run_results(args)
    else:
        run_maps(args)


if __name__ == "__main__":
    main()
