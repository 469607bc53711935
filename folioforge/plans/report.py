"""The inventory's Markdown report: small frames of a persisted inventory, rendered on the driver."""

from __future__ import annotations

from datetime import datetime
from pathlib import Path

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioforge.operators import inventory as inv

# Headings of the categories.
TITLES = {"unprocessed_without_djvu": "Not processed, without DjVu", "partial": "Partly processed", "with_djvu": "With DjVu", "complete_without_djvu": "Processed, without DjVu"}


def render(inventory: DataFrame, now: datetime | None = None) -> str:
    """The report; one row per directory comes to the driver, as the report lists them all."""
    own = inventory.persist()
    try:
        t = inv.totals(own).first()
        usage = inv.suffix_usage(own).orderBy("suffix").collect()
        rows = inv.categorised(inv.coverage(own)).orderBy("path").collect()
    finally:
        own.unpersist()
    lines = ["# Processing status", "", f"Made on {(now or datetime.now()).strftime('%Y-%m-%d %H:%M:%S')}", ""]

    def section(category: str) -> None:
        found = [r for r in rows if r["category"] == category]
        lines.extend([f"## {TITLES[category]} ({len(found)})", "", "| Directory | Originals | Processed | Coverage | Suffixes |", "| --- | --- | --- | --- | --- |"])
        lines.extend(f"| {r['path']} | {r['original_count']} | {r['processed_count']} | {r['coverage']} | {r['suffix_text']} |" for r in found)
        lines.append("")

    for c in inv.CATEGORIES[:2]:
        section(c)
    lines.extend(["## Totals", "", f"- Directories: {t['directories']}"])
    lines.extend(f"- {c.replace('_', ' ').capitalize()}: {t[c]} ({t[c + '_percent']}%)" for c in ("with_djvu", "complete", "partial", "none"))
    lines.extend(["", "## Suffixes", "", "| Suffix | Directories |", "| --- | --- |"])
    lines.extend(f"| `{r['suffix']}` | {r['directories']} |" for r in usage)
    lines.append("")
    for c in inv.CATEGORIES[2:]:
        section(c)
    return "\n".join(lines)


def write_report(inventory: DataFrame, path: str | Path, now: datetime | None = None) -> Path:
    path = Path(path)
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(render(inventory, now), encoding="utf-8")
    return path


def status_counts(inventory: DataFrame) -> DataFrame:
    return inventory.groupBy("status").agg(F.count("*").alias("directories"))
