"""Command line: `single`, `dir`, `assemble` and `inventory`."""

from __future__ import annotations

import argparse
import logging
import sys

from folioforge.config import DEFAULTS
from folioforge.operators.selection import parse


def _session():
    from pyspark.sql import SparkSession

    return SparkSession.builder.appName("folioforge").getOrCreate()


def _flag(p: argparse.ArgumentParser, name: str) -> None:
    p.add_argument(f"--{name}", action=argparse.BooleanOptionalAction, default=True)


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="folioforge", description="Bulk processing of scanned documents on Spark.")
    top.add_argument("-v", "--verbose", action="store_true")
    top.add_argument("-q", "--quiet", action="store_true")
    sub = top.add_subparsers(dest="command", required=True)
    for name in ("single", "dir"):
        p = sub.add_parser(name)
        p.add_argument("src")
        p.add_argument("dst")
        p.add_argument("-l", "--language", default=DEFAULTS.language)
        p.add_argument("--upscale-ratio", type=float, default=DEFAULTS.upscale)
        for f in ("deskew", "clean", "rotate-pages"):
            _flag(p, f)
        if name == "single":
            p.add_argument("--pages", default="all")
        else:
            p.add_argument("--save-pictures", action="store_true")
            p.add_argument("--only-pictures", action="store_true")
            p.add_argument("--partitions", type=int)
    for name in ("assemble", "inventory"):
        p = sub.add_parser(name)
        p.add_argument("root")
        p.add_argument("dst")
    return top


def main(argv: list[str] | None = None) -> int:
    a = parser().parse_args(argv)
    logging.basicConfig(level=logging.DEBUG if a.verbose else logging.ERROR if a.quiet else logging.INFO, format="%(levelname)s %(message)s")
    from folioforge.plans import documents, report

    options = {} if a.command not in ("single", "dir") else {"language": a.language, "upscale_ratio": a.upscale_ratio, "deskew": a.deskew, "clean": a.clean, "rotate_pages": a.rotate_pages}
    errors: dict[str, str] = {}
    try:
        if a.command == "single":
            documents.process_single_pdf(a.src, a.dst, parse(a.pages), **options)
        elif a.command == "dir":
            found = documents.process_directory(_session(), a.src, a.dst, save_pictures=a.save_pictures, only_pictures=a.only_pictures, partitions=a.partitions, **options)
            errors = {k: v for k, v in found.items() if v is not None}
        elif a.command == "assemble":
            errors = {r["dir"]: r["error"] for r in documents.assemble_directories(_session(), a.root, a.dst).collect() if r["status"] == "error"}
        else:
            from folioforge.operators.inventory import inventory
            from folioforge.sources.dirlist import children

            report.write_report(inventory(children(_session(), a.root)), a.dst)
    except Exception as e:
        errors = {getattr(a, "src", None) or a.root: str(e)}
    for name, error in errors.items():
        print(f"{name}: {error}", file=sys.stderr)
    return int(bool(errors))


if __name__ == "__main__":
    sys.exit(main())
